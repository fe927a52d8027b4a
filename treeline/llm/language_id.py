"""Language identification by rank-order profiles and the out-of-place distance.

The profile of a language is its most frequent n-grams of 1 to 3 letters, most frequent first. A
document's own ranking is compared with each: every n-gram costs the difference of its two ranks, or the
profile size where the profile lacks it. The language with the least sum is predicted. N-grams are of
lower-case letters; anything else counts as a blank between words, and no n-gram reaches over one.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is every text where no
language was learned. Ties go to the language that sorts first. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared_store import written
from .text_arrays import LETTER, classes, code_points, slices

PROFILE_SIZE = 400  #: n-grams in a language's profile
DOCUMENT_SIZE = 400  #: n-grams of a document that are compared
FLUSH = 300_000  #: distinct n-grams that a training task holds before it hands them on
UNKNOWN = "und"


def _grams(points: np.ndarray) -> np.ndarray:
    """The n-grams of one text (its code points, lower case) as integers of 21 bits a letter."""
    inside = classes()[points] == LETTER
    a = np.zeros(len(points) + 2, np.int64)
    a[1:-1] = np.where(inside, points, 32)
    a[0] = a[-1] = 32
    keep = np.append(True, (a[1:] != 32) | (a[:-1] != 32))
    a = a[keep]
    one = a[a != 32]
    two = a[:-1] << 21 | a[1:]
    three = (a[:-2] << 42 | a[1:-1] << 21 | a[2:])[a[1:-1] != 32]
    return np.concatenate([one, two, three])


def _ranked(points: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by value."""
    grams, n = np.unique(_grams(points), return_counts=True)
    return grams[np.argsort(-n, kind="stable")][:size]


def _lower(texts: list[str]) -> Iterator[np.ndarray]:
    points, offsets = code_points([t.lower() for t in texts])
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield points[a:b]


def learn_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profiles from every labelled row. The result is bounded: languages times ``size`` integers."""
    slim = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("t")).filter("lang is not null and t is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out(name: str) -> pa.RecordBatch:
            grams, n = held.pop(name)
            return pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            names = np.array(batch["lang"].to_pylist(), object)
            texts = batch["t"].to_pylist()
            for part in slices([len(t) for t in texts]):
                own = names[part]
                for name in sorted(set(own)):
                    chosen = [t for t, x in zip(texts[part], own, strict=True) if x == name]
                    points, _ = code_points(["\n".join(chosen).lower()])
                    grams, n = np.unique(_grams(points), return_counts=True)
                    if name in held:
                        g, m = held[name]
                        grams, back = np.unique(np.append(g, grams), return_inverse=True)
                        n = np.bincount(back, np.append(m, n)).astype(np.int64)
                    held[name] = grams, n
                    if sum(len(g) for g, _ in held.values()) > FLUSH:
                        yield out(name)
        for name in list(held):
            yield out(name)

    counts = slim.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = written(counts.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= size), "profiles")
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").toLocalIterator():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Classifier:
    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), max([size, *map(len, profiles.values())])
        self.tables = []
        for name in self.names:
            grams = np.array(profiles[name], np.int64)
            order = np.argsort(grams)
            self.tables.append((grams[order], order))

    def predict(self, points: np.ndarray) -> tuple[str, float]:
        own = _ranked(points, DOCUMENT_SIZE)
        own = own[own != (32 << 21 | 32)]
        if not len(own) or not self.names or not (classes()[points] == LETTER).any():
            return UNKNOWN, 0.0
        far = []
        for grams, place in self.tables:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            far.append(np.where(grams[at] == own, np.minimum(np.abs(place[at] - np.arange(len(own))), self.size), self.size).sum())
        best = int(np.argmin(far))
        return self.names[best], float(1 - far[best] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns in ``keep`` (all, if None), then the prediction and its score (1: the profile's own ranking; 0: nothing in common)."""
    keep = docs.columns if keep is None else keep
    slim = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(profiles, PROFILE_SIZE)
        for batch in batches:
            texts = [t or "" for t in batch["t"].to_pylist()]
            for part in slices([len(t) for t in texts]):
                found = [classifier.predict(p) for p in _lower(texts[part])]
                labels, scores = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([*(batch[f"c{i}"][part] for i in range(len(keep))), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], [*(f"c{i}" for i in range(len(keep))), "label", "score"])

    schema = ", ".join([*(f"c{i} {slim.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(keep))), "label string, score double"])
    return slim.mapInArrow(run, schema).toDF(*keep, *names)


def held_out(key: str = "doc_id"):
    """The fold that nothing is learned from, as a column."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
