"""The artwork index from decoded textures and PNG files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import thumbnail_size
from ..functions.text import art_kind, art_shard, skin_id

LARGE, PREVIEW = 1024, 256


def png_size(content) -> tuple:
    """Width and height from the header, as columns; null where it is no PNG."""
    head = F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A"
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")
    return F.when(head, number(17)), F.when(head, number(21))


def extracted(textures: DataFrame) -> DataFrame:
    """One texture for each bundle and skin, sprites first. textures: bundle, name, kind, pos."""
    named = textures.withColumn("skin_id", skin_id(F.col("name"))).filter("skin_id is not null")
    order = Window.partitionBy("bundle", "skin_id").orderBy((F.col("kind") != "Sprite").cast("int"), "pos")
    return named.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def measured(files: DataFrame) -> DataFrame:
    """file, w, h, bytes, sha256 of PNG files (file, content)."""
    w, h = png_size(F.col("content"))
    return files.select("file", w.alias("w"), h.alias("h"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def index(files: DataFrame, valid: DataFrame, tier: str = "original") -> DataFrame:
    """skin_id, kind, shard and the tier's measures, of files ``<skin_id>.<tier>.png`` with a valid skin."""
    suffix = f".{tier}.png"
    own = measured(files.filter(F.col("file").endswith(suffix))).withColumn("skin_id", F.expr(f"substring(file, 1, length(file) - {len(suffix)})"))
    own = own.join(valid.select("skin_id"), "skin_id", "left_semi")
    return own.select("skin_id", art_kind(F.col("skin_id")).alias("kind"), art_shard(F.col("skin_id")).alias("shard"), F.struct("file", "w", "h", "bytes", "sha256").alias(tier))


def index_gaps(files: DataFrame, valid: DataFrame) -> DataFrame:
    """skin_id, problem: ``skipped`` files of unknown skins, and ``missing`` files of valid ones."""
    have = files.filter(F.col("file").endswith(".original.png")).select(F.expr("substring(file, 1, length(file) - 13)").alias("skin_id")).distinct()
    return have.join(valid, "skin_id", "left_anti").select("skin_id", F.lit("skipped").alias("problem")).union(valid.select("skin_id").join(have, "skin_id", "left_anti").select("skin_id", F.lit("missing").alias("problem")))


def planned_variants(rows: DataFrame, width: str = "w", height: str = "h") -> DataFrame:
    """rows with the sizes that the large and preview tiers will have."""
    lw, lh = thumbnail_size(F.col(width), F.col(height), LARGE)
    pw, ph = thumbnail_size(F.col(width), F.col(height), PREVIEW)
    return rows.withColumns({"large_w": lw, "large_h": lh, "preview_w": pw, "preview_h": ph})


def pillow_resize(content: bytes, width: int, height: int) -> bytes:
    """Lanczos scaling by Pillow, where that is installed."""
    import io

    from PIL import Image

    with Image.open(io.BytesIO(content)) as image:
        out = io.BytesIO()
        image.resize((width, height), Image.LANCZOS).save(out, "PNG")
        return out.getvalue()


def variants(files: DataFrame, longest: int, tier: str, resize: Callable[[bytes, int, int], bytes] = pillow_resize) -> DataFrame:
    """file, content, error for the scaled copies of PNG files (file, content); one that fits is copied as it is."""
    w, h = png_size(F.col("content"))
    sized = files.select("file", "content", w.alias("w"), h.alias("h"))
    lw, lh = thumbnail_size(F.col("w"), F.col("h"), longest)
    sized = sized.select(F.replace(F.col("file"), F.lit(".original.png"), F.lit(f".{tier}.png")).alias("file"), "content", "w", "h", lw.alias("tw"), lh.alias("th"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, errors = [], []
            for r in batch.to_pylist():
                content = error = None
                try:
                    if r["w"] is None:
                        raise ValueError("not a PNG file")
                    content = r["content"] if (r["w"], r["h"]) == (r["tw"], r["th"]) else resize(r["content"], r["tw"], r["th"])
                except Exception as e:  # noqa: BLE001  one file's failure is its own
                    error = f"{type(e).__name__}: {e}"
                out.append(content)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([batch["file"], pa.array(out, pa.binary()), pa.array(errors, pa.string())], ["file", "content", "error"])

    return sized.mapInArrow(run, "file string, content binary, error string")


def all_or_nothing(made: DataFrame) -> DataFrame:
    """The variants, or an error if any failed: an index never advances halfway."""
    failed = [r["file"] for r in made.filter("error is not null").select("file").limit(20).collect()]
    if failed:
        raise ValueError(f"variants failed: {', '.join(failed)}")
    return made.drop("error")
