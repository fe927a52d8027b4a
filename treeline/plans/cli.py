"""``python -m treeline.plans.cli --workdir DIR COMMAND``. Settings of a ``.env`` file in the current directory hold where the environment has none."""

from __future__ import annotations

import argparse
import importlib
import sys
from pathlib import Path

from ..session import session
from ..sources.settings import load_environment
from . import artwork, factory

UNCHANGED = 2


def _named(path: str):
    """The function of MODULE:FUNCTION."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def main(args: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(prog="treeline")
    parser.add_argument("--workdir", default="work")
    parser.add_argument("--server", default="cn")
    parser.add_argument("--master", default=None)
    parser.add_argument("--tool", action="append", default=[], help="a package or program whose version goes into the manifest")
    parser.add_argument("--extractor", type=_named, help="MODULE:FUNCTION that fills the directory it is given")
    parser.add_argument("--attempts", type=int, default=5, help="of the extractor")
    parser.add_argument("--parser", type=_named, help="MODULE:FUNCTION that takes a script's text and gives its lines")
    parser.add_argument("--excel-dir", type=Path, help="the tables of the images steps, instead of the candidate's")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("check", "fetch", "merge", "story", "summarize", "package", "images-latest-tag", "images-fetch", "images-index", "images-variants", "images-package"):
        commands.add_parser(name)
    for name in ("validate", "run"):
        p = commands.add_parser(name)
        p.add_argument("--probes-file")
        p.add_argument("--probe-operator", action="append", default=[])
        p.add_argument("--probe-event", action="append", default=[])
        if name == "run":
            p.add_argument("--force", action="store_true")
            p.add_argument("--publish", action="store_true")
    for name in ("publish", "images-publish"):
        commands.add_parser(name).add_argument("--execute", action="store_true")
    commands.add_parser("baseline").add_argument("--clobber", action="store_true")
    for name in ("images-extract", "images-run"):  # MODULE:FUNCTION takes a bundle's bytes and gives (name, kind, PNG) of its textures
        p = commands.add_parser(name)
        p.add_argument("--decoder", required=True)
        p.add_argument("--publish", action="store_true")
        p.add_argument("--force", action="store_true")
    a = parser.parse_args(args)
    load_environment(Path(".env"))
    work = factory.Work(spark or session("treeline", a.master), Path(a.workdir), a.server, excel=a.excel_dir, tools=a.tool)
    work.parse = a.parser or work.parse
    if a.command in ("validate", "run"):
        work.probes = factory.loaded_probes(work, a.probes_file and Path(a.probes_file), {"operators": a.probe_operator, "events": a.probe_event})
    if a.command == "check":
        remote, changed = factory.check(work)
        print(remote)
        return 0 if changed else UNCHANGED
    if a.command == "images-latest-tag":
        from ..operators.release import latest_image_version
        from ..sources.registry import Registry

        found = latest_image_version(Registry(work.path / "registry").releases(work.spark)).first()
        print(f"images-{found['version']}" if found else "")
        return 0
    if a.command == "fetch":
        return factory.fetch(work, a.extractor, a.attempts)
    if a.command == "run":
        return factory.run(work, a.force, a.publish, a.extractor, a.attempts)
    if a.command == "publish":
        return factory.publish(work, a.execute)
    if a.command == "baseline":
        return factory.fetch_baseline(work, a.clobber)
    if a.command == "images-publish":
        return artwork.publish(work, a.execute)
    if a.command in ("images-extract", "images-run"):
        decode = _named(a.decoder)
        return artwork.extract(work, decode) if a.command == "images-extract" else artwork.run(work, decode, release_it=a.publish, force=a.force)
    if a.command.startswith("images-"):
        return {"images-fetch": artwork.fetch, "images-index": artwork.build_index, "images-variants": artwork.make_variants, "images-package": artwork.package}[a.command](work)
    return {"merge": factory.merge, "story": factory.convert_stories, "summarize": factory.summarize, "validate": factory.validate, "package": factory.package}[a.command](work)


if __name__ == "__main__":
    sys.exit(main())
