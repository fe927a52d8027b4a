"""Nearest neighbours by largest inner product, from randomly rotated one-bit codes.

A vector less the mean of all is rotated at random; the signs of its coordinates, packed into 64-bit words,
are its code, and two scalars correct it: its length, and the inner product of its direction with its code.
From the bits of a code and the bit planes of a query (its rotated coordinates in 8 bits), popcounts estimate
the inner product, with an error bound that holds with high probability. The ``LIKELY`` * k vectors with the largest estimates
are scored in double precision with the original components; the k-th best of these scores is the floor that the upper bounds of
others must reach to be scored so too.

All queries meet all vectors, in blocks of bounded size; a pair of blocks is a task's work and returns k rows a
query. Equal vectors are searched once: of each, the k + 1 smallest ids stand for all.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids and
vectors of another length than the most frequent one (the shorter of two as frequent). Rows that repeat an id with the
same vector count once. Ties go to the smaller id. With fewer candidates than k, all are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared_store import written

VECTOR_BLOCK, QUERY_BLOCK = 16_384, 4_096
BOUND = 2.5  #: standard errors in the bound
LIKELY = 8  #: times k vectors are scored for the floor
PLANES = 8  #: bits of a query's coordinates


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of uint64 words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of vectors and their correction scalars."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        rest = vectors - centre
        self.length = np.linalg.norm(rest, axis=1)
        turned = (rest / np.where(self.length > 0, self.length, 1)[:, None]) @ turn
        self.dim, self.turn, self.centre = vectors.shape[1], turn, centre
        self.bits = packed(turned > 0)
        self.ones = np.bitwise_count(self.bits).sum(axis=1).astype(np.float64)
        self.agree = np.where(self.length > 0, np.abs(turned).sum(axis=1) / math.sqrt(self.dim), 1.0)

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products with each query, and the bound on their error."""
        turned = queries @ self.turn
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-300)
        levels = np.rint((turned - low) / step).astype(np.int64)
        inside = np.zeros((len(queries), len(self.bits)))
        for j in range(PLANES):
            plane = packed(levels >> j & 1 == 1)
            for w in range(self.bits.shape[1]):
                inside += np.bitwise_count(self.bits[None, :, w] & plane[:, None, w]) * float(1 << j)
        inside = low * self.ones + step * inside
        root = math.sqrt(self.dim)
        found = (2 * inside - turned.sum(axis=1, keepdims=True)) / root / self.agree
        size = np.linalg.norm(queries, axis=1, keepdims=True)
        wrong = BOUND * (size * np.sqrt(np.maximum(0, 1 - self.agree**2)) / math.sqrt(max(1, self.dim - 1)) + step / math.sqrt(12)) / self.agree
        return (queries @ self.centre)[:, None] + self.length * found, self.length * wrong + 1e-9


def nearest_in_block(query_ids: np.ndarray, queries: np.ndarray, ids: list[np.ndarray], vectors: np.ndarray, k: int, centre: np.ndarray, turn: np.ndarray) -> list[tuple[int, int, float]]:
    """(query, id, inner product) of the k best in these vectors, by bounds and reranking."""
    codes, out = Codes(vectors, centre, turn), []
    lead = np.array([x[0] for x in ids], np.int64)
    want = min(k + 1, len(vectors))  # one of the vectors may be the query's own
    for begin in range(0, len(queries), 256):
        part = queries[begin : begin + 256]
        about, wrong = codes.estimate(part)
        first = len(vectors) - min(LIKELY * want, len(vectors))
        likely = np.argpartition(about, first, axis=1)[:, first:] if first else np.tile(np.arange(len(vectors)), (len(part), 1))
        for i, q in enumerate(part):
            # Exact scores of the likeliest bound the last of the best from below, closer than the codes' own bounds.
            floor = -np.partition(-np.einsum("ij,j->i", vectors[likely[i]], q), want - 1)[want - 1]
            pick = np.union1d(likely[i], np.flatnonzero(about[i] + wrong[i] >= floor))
            score = np.einsum("ij,j->i", vectors[pick], q)
            order = np.lexsort((lead[pick], -score))[:want]
            me = int(query_ids[begin + i])
            rows = sorted((-score[o], int(x)) for o in order for x in ids[pick[o]] if x != me)[:k]
            out += [(me, x, -s) for s, x in rows]
    return out


def usable(v: Column) -> Column:
    """Whether a vector takes part, but for its length."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0)


def search(table: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", seed: int = 11) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest rows of each query row."""
    given = table.select(F.col(key).cast("long").alias("k"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("v"), is_query.alias("q"))
    rows = given.filter(F.col("k").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()  # one row
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return table.sparkSession.createDataFrame([], result)
    dim = sizes[0]["d"]
    rows = rows.filter(F.size("v") == dim)
    # Each task hands on at most k + 1 rows of a vector, so a vector that a third of all rows hold is no hot key.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("k"))
    once = rows.groupBy("v", "k").agg(F.max("q").alias("q"))
    distinct = written(once.withColumn("r", rank).filter(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("k")).alias("ids")), "ann-vectors")
    queries = written(once.filter("q").select(F.col("k").alias("id"), "v"), "ann-queries")
    sums = distinct.agg(F.count("*").alias("n"), F.array(*[F.avg(F.col("v")[i]) for i in range(dim)]).alias("c")).first()
    asked = queries.count()
    centre, turn = np.array(sums["c"], np.float64), rotation(dim, seed)
    vector_blocks, query_blocks = -(-sums["n"] // VECTOR_BLOCK), max(1, -(-asked // QUERY_BLOCK))
    left = distinct.select("ids", "v", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(vector_blocks)).alias("vb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    right = queries.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(vector_blocks - 1).cast("long"))).alias("vb"))

    def run(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = nearest_in_block(asked["id"].to_numpy(), np.stack(asked["v"]), list(vectors["ids"]), np.stack(vectors["v"]), k, centre, turn) if len(vectors) and len(asked) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    pairs = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
