"""Sizes of scaled images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thumbnail_size(width: Column, height: Column, longest: int) -> tuple[Column, Column]:
    """Width and height after scaling to fit a square, never up, with the closest aspect ratio of the two roundings."""
    w, h = width.cast("double"), height.cast("double")
    aspect, m = w / h, F.lit(float(longest))
    x_low, x_high, y_low, y_high = F.floor(m * aspect), F.ceil(m * aspect), F.floor(m / aspect), F.ceil(m / aspect)
    narrow = F.when(F.abs(aspect - x_low / m) <= F.abs(aspect - x_high / m), x_low).otherwise(x_high)
    flat = F.when((y_low == 0) | (F.abs(aspect - m / F.nullif(y_low, F.lit(0))) <= F.abs(aspect - m / y_high)), y_low).otherwise(y_high)
    fits = (width <= longest) & (height <= longest)
    one = F.lit(1).cast("long")
    return (
        F.when(fits, width.cast("long")).when(aspect <= 1, F.greatest(narrow, one)).otherwise(F.lit(longest).cast("long")),
        F.when(fits, height.cast("long")).when(aspect <= 1, F.lit(longest).cast("long")).otherwise(F.greatest(flat, one)),
    )
