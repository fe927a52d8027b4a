"""Settings from the surroundings: an environment file, and the versions of tools."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Iterable
from importlib import metadata
from pathlib import Path


def load_environment(file: Path) -> list[str]:
    """The names that were set from lines ``NAME=value``. A name that is set already keeps its value; blank lines, comments and lines without ``=`` are passed over; quotes around a value go."""
    new = []
    for line in file.read_text("utf-8").splitlines() if file.is_file() else []:
        name, equals, value = line.strip().partition("=")
        name = name.strip()
        if equals and name and not name.startswith("#") and name not in os.environ:
            os.environ[name] = value.strip().strip("'\"")
            new.append(name)
    return new


def tool_versions(packages: Iterable[str] = (), programs: Iterable[str] = ()) -> dict[str, str]:
    """The versions of the installed ones among some Python packages and programs (what ``--version`` prints)."""
    found = {}
    for name in packages:
        try:
            found[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            continue
    for name in programs:
        if path := shutil.which(name):
            done = subprocess.run([path, "--version"], capture_output=True, text=True, check=False)
            found[name] = done.stdout.strip() or done.stderr.strip()
    return found
