"""Files in the folder that the driver and all executors share.

The folder is the one named by ``spark.checkpoint.dir``; only where that is unset (tests, a laptop)
a temporary one is made. Files are opened through ``pyarrow.fs``, so any store it knows will do.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared root as a URI or path."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="treeline-")
        spark.sparkContext.setCheckpointDir(_own[app])
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder that no other call uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends at these files."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def put_file(folder: str, name: str, chunks) -> str:
    """Write to a name of this attempt's own, then rename: a repeated or speculative task leaves one whole file."""
    store, root = locate(folder)
    store.create_dir(root, recursive=True)
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    store.move(part, f"{root}/{name}")
    return f"{folder}/{name}"


def open_file(path: str):
    """Random access to one file."""
    store, root = locate(path)
    return store.open_input_file(root)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies at the same path for them; otherwise ship it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])
    return spark
