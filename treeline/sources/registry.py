"""A release registry in a directory: ``<tag>/release.json`` and the assets beside it."""

from __future__ import annotations

import json
import shutil
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.release import mismatched_assets, upload_order, verify_asset
from .archives import file_sha256, write_json
from .attempts import retried

SCHEMA = "tag string, is_draft boolean, created long, assets array<struct<name:string,size:long,digest:string>>"
ASSETS = "name string, size long, digest string"


class Registry:
    def __init__(self, root: str | Path, attempts: int = 3, wait: float = 10.0):
        """attempts, wait: of each upload that fails with an OSError (the wait grows by as much each time)."""
        self.root, self.attempts, self.wait = Path(root), attempts, wait

    def _state(self, tag: str) -> dict | None:
        path = self.root / tag / "release.json"
        return json.loads(path.read_text("utf-8")) if path.exists() else None

    def releases(self, spark: SparkSession) -> DataFrame:
        """All releases; one that can't be read is an error, not an absence."""
        rows = []
        for path in sorted(self.root.glob("*/release.json")):
            state = json.loads(path.read_text("utf-8"))
            rows.append((path.parent.name, bool(state["isDraft"]), int(state["created"]), self.assets(path.parent.name)))
        return spark.createDataFrame(rows, SCHEMA)

    def assets(self, tag: str) -> list[tuple[str, int, str]]:
        return [(p.name, p.stat().st_size, f"sha256:{file_sha256(p)}") for p in sorted((self.root / tag).glob("*")) if p.name != "release.json" and not p.name.startswith(".")]

    def publish(self, spark: SparkSession, tag: str, files: list[Path], execute: bool = False) -> list[str]:
        """Draft, upload what is missing or wrong (smallest first), verify, then undraft. Without ``execute`` only the plan is returned. A published release is repaired in the same way."""
        local = spark.createDataFrame([(p.name, p.stat().st_size, f"sha256:{file_sha256(p)}") for p in files], ASSETS)
        open_assets = lambda: mismatched_assets(local, spark.createDataFrame(self.assets(tag), ASSETS))
        plan = [r["name"] for r in upload_order(open_assets()).collect()]
        if not execute:
            return plan
        state = self._state(tag)
        if state is None:
            state = {"isDraft": True, "created": 1 + max([int(json.loads(p.read_text("utf-8"))["created"]) for p in self.root.glob("*/release.json")], default=0)}
            write_json(self.root / tag / "release.json", state)
        by_name = {p.name: p for p in files}
        for name in plan:
            retried(partial(self._upload, tag, by_name[name]), self.attempts, self.wait)
        wrong = [r["name"] for r in open_assets().collect()]
        if wrong:
            raise ValueError(f"assets of {tag} differ after upload: {wrong}")
        if state["isDraft"]:
            write_json(self.root / tag / "release.json", state | {"isDraft": False})
        return plan

    def _upload(self, tag: str, file: Path) -> None:
        part = self.root / tag / f".{file.name}.part"
        shutil.copyfile(file, part)
        part.replace(self.root / tag / file.name)

    def fetch(self, tag: str, manifest_assets: dict[str, dict], target: Path) -> list[Path]:
        """Copy assets after their digests have been verified."""
        out = []
        for name, wanted in sorted(manifest_assets.items()):
            data = (self.root / tag / name).read_bytes()
            verify_asset(name, data, wanted.get("size"), wanted.get("digest"))
            target.mkdir(parents=True, exist_ok=True)
            (target / name).write_bytes(data)
            out.append(target / name)
        return out
