"""A directory tree as rows (path, is_dir, size, sha256, content).

Spark's own binary source leaves out hidden and empty files, so the listing is made here: the driver lists names and
sizes, and executors read the files, each once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, is_dir boolean, size long, sha256 string, content binary"
FILES_PER_TASK = 500


def store_of(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def scan(spark: SparkSession, root: str, suffix: str = "", content: bool = True) -> DataFrame:
    """All files and directories below a root, hidden and empty ones too. Drop ``content`` before joins."""
    store, base = store_of(root)
    base = base.rstrip("/")
    listed = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    rows = [(i.path[len(base) + 1 :], i.type == fs.FileType.Directory, i.size or 0) for i in listed if i.path.endswith(suffix) or i.type == fs.FileType.Directory]
    rows = [r for r in rows if r[0].endswith(suffix) or not suffix]
    names = spark.createDataFrame(sorted(rows), "path string, is_dir boolean, size long").repartition(max(1, -(-len(rows) // FILES_PER_TASK)), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, top = store_of(root)
        for batch in batches:
            for row in batch.to_pylist():  # one file at a time: contents may be large
                data = None
                if not row["is_dir"]:
                    with own.open_input_stream(f"{top.rstrip('/')}/{row['path']}", compression=None) as f:
                        data = f.read()
                digest = None if data is None else hashlib.sha256(data).hexdigest()
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]]), pa.array([row["is_dir"]]), pa.array([row["size"]], pa.int64()), pa.array([digest], pa.string()), pa.array([data if content else None], pa.binary())], ["path", "is_dir", "size", "sha256", "content"])

    return names.mapInArrow(read, SCHEMA)


def of_files(spark: SparkSession, files: dict[str, bytes]) -> DataFrame:
    """A small tree held in memory, with its directories."""
    dirs = {"/".join(p.split("/")[:i]) for p in files for i in range(1, p.count("/") + 1)}
    rows = [(d, True, 0, None, None) for d in sorted(dirs)] + [(p, False, len(c), hashlib.sha256(c).hexdigest(), bytearray(c)) for p, c in sorted(files.items())]
    return spark.createDataFrame(rows, SCHEMA)


def hashed(table: DataFrame, path, content) -> DataFrame:
    """Any table as a tree without directories."""
    return table.select(path.alias("path"), F.lit(False).alias("is_dir"), F.octet_length(content).cast("long").alias("size"), F.sha2(content.cast("binary"), 256).alias("sha256"), content.cast("binary").alias("content"))
