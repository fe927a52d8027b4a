"""Similarity join on word n-grams, with Bayesian pruning of candidates.

Texts with the same set of n-grams are one text with copies. The distinct ones get a MinHash signature; texts that
agree in a band of it meet in a bucket. Pairs that meet are compared a few MinHash values at a time, and a pair is dropped as
soon as the posterior probability that its similarity reaches the threshold (uniform prior) is below the tolerance.
Texts with a survivor meet again in the same bucket, now with their whole n-gram sets, and survivors are compared exactly.
A pair belongs to the bucket of the first band in which it agrees, so it is counted once. Only verified links
make groups: what agrees by boilerplate alone chains nothing together. No pair is ever a row: tasks return link counts and
spanning edges.

Buckets of any size are cut into blocks, by rows and by the n-grams in them, and a pair of blocks is one task's work. A bucket of
many rows is told how many blocks it has by a broadcast of a bounded number of such buckets.

With 32 bands of 4 values a pair of similarity 0.8 is never met with probability 5e-8, and the tolerance of
1e-6 bounds the loss by pruning in the same way.

Edge cases: a text of fewer words than an n-gram has one n-gram of all its words; a text that is null or has no word
has no links and is its own class. Rows with the same id and n-grams are copies; a null id is a class of
its own. Rows with the same id and different n-grams are told apart. Words are runs of letters, digits and non-ASCII characters, in lower case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components, joined
from .shared_store import written
from .text_arrays import Words, shingle_hashes, slices

HASHES, BANDS = 128, 32
STEP = 16  #: MinHash values that are compared at a time
TOLERANCE = 1e-6
BLOCK = 512  #: texts in a block
WEIGHT = 1 << 20  #: n-grams in a block, of texts that are compared exactly
TILE = 256  #: rows and columns of pairs at once; their signatures take 32 MB


@cache
def _multipliers() -> np.ndarray:
    return np.random.default_rng(2024).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 MinHash values, 16 bits of each."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(shingles), 1024):
        product = shingles[begin : begin + 1024, None] * _multipliers()
        product ^= product >> np.uint64(29)
        product *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(low, product.min(axis=0), out=low)
    return (low >> np.uint64(16)).astype(np.uint16)


@cache
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n values, the fewest matches with which a pair is kept: P(similarity >= threshold | m of n) = P(Binomial(n + 1, threshold) <= m)."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def surviving(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Indexes of the pairs (rows of two signature arrays) that no comparison drops."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for n, least in least_matches(threshold).items():
        matches = matches + (left[alive, n - STEP : n] == right[alive, n - STEP : n]).sum(axis=1)
        stay = matches >= least
        alive, matches = alive[stay], matches[stay]
    return alive


def digest_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sets(docs: DataFrame, size: int, text: str, key: str) -> DataFrame:
    """k, hash of the text, digest of the n-gram set (null without words), signature, number of n-grams."""
    slim = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["t"].to_pylist()]
            for part in slices([len(t) for t in texts]):
                words, digests, signs, weights = Words(texts[part]), [], [], []
                for i in range(len(texts[part])):
                    own = shingle_hashes(words.of(i), size)
                    digests.append(digest_of(own))
                    signs.append(signature(own).tobytes() if len(own) else None)
                    weights.append(len(own))
                arrays = [batch["k"][part], batch["h"][part], pa.array(digests, pa.binary()), pa.array(signs, pa.binary()), pa.array(weights, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["k", "h", "digest", "sig", "weight"])

    return slim.mapInArrow(run, "k long, h long, digest binary, sig binary, weight long")


def _groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal values of ``names``."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        change = np.zeros(len(table), bool)
        for n in names:
            column = table[n].to_numpy()
            change[1:] |= column[1:] != column[:-1]
        first = {n: table[n][0].as_py() for n in names}
        if held and any(held[-1][n][-1].as_py() != first[n] for n in names):
            yield pa.concat_tables(held).combine_chunks()
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), len(table)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(a, b - a))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _blocked(rows: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Deal the rows of each bucket to pairs of blocks (bi <= bj): every pair of rows meets in exactly one of them.

    sizes: bucket, n (rows), nb (blocks); total: the sum of n, or more.
    """
    dealt = joined(rows, sizes, "bucket", total).drop("n").withColumn("b", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return dealt.withColumn("bi", F.least("b", "other")).withColumn("bj", F.greatest("b", "other"))


def _pairs(b: np.ndarray, bi: int, bj: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The index pairs of one block pair, a bounded number at a time."""
    one, two = np.flatnonzero(b == bi), np.flatnonzero(b == bj)
    for i in range(0, len(one), TILE):
        for j in range(i if bi == bj else 0, len(two), TILE):
            some, others = one[i : i + TILE], two[j : j + TILE]
            x, y = np.repeat(some, len(others)), np.tile(others, len(some))
            if bi == bj and i == j:
                x, y = x[x < y], y[x < y]
            yield x, y


def _kept(sigs: np.ndarray, bands: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no comparison drops and whose first common band is that of their bucket: a pair is kept in one bucket alone. bands: that of each row."""
    keep = surviving(sigs[x], sigs[y], threshold)
    x, y = x[keep], y[keep]
    lanes = sigs.view(np.uint64)
    same = lanes[x] == lanes[y]
    home = same.any(axis=1) & (same.argmax(axis=1) == bands[x])
    return x[home], y[home]


def _roots(n: int, x: np.ndarray, y: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The least index that each of n joins through the edges."""
    root = np.arange(n) if root is None else root
    while True:
        old = root.copy()
        np.minimum.at(root, x, old[y])
        np.minimum.at(root, y, old[x])
        root = root[root]
        if (root == old).all():
            return root


def _signatures(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint16).reshape(len(rows), HASHES)


def candidates(texts: DataFrame, threshold: float) -> DataFrame:
    """bucket, node of the texts with a candidate there: both agree in the bucket's band, in none before, and survive the pruning. texts: node, sig."""
    width = HASHES // BANDS * 2
    hashed = lambda i: F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width)).bitwiseAND(F.lit(-BANDS)).bitwiseOR(F.lit(i))  # noqa: E731  the low bits tell the band
    met = texts.select("node", F.explode(F.array(*[hashed(i) for i in range(BANDS)])).alias("bucket"))
    sizes = met.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int"))
    met = _blocked(met, sizes, BANDS * texts.count()).join(texts.select("node", "sig"), "node")
    dealt = met.repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Table] = []
        small: list[pa.Table] = []
        count = rows = 0

        def emit(group: pa.Table, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> int:
            sigs, bands, some = _signatures(group), group["bucket"].to_numpy() & (BANDS - 1), np.zeros(len(group), bool)
            for x, y in pairs:
                x, y = _kept(sigs, bands, x, y, threshold)
                some[x] = some[y] = True
            found.append(group.select(["bucket", "node"]).filter(pa.array(some)))
            return len(found[-1])

        def flush() -> int:
            """Pairs of rows in small groups, all at once."""
            if not small:
                return 0
            begin = np.cumsum([0, *(len(g) for g in small)])
            xy = [np.triu_indices(len(g), 1) for g in small]
            x = np.concatenate([a + o for (a, _), o in zip(xy, begin, strict=False)])
            y = np.concatenate([b + o for (_, b), o in zip(xy, begin, strict=False)])
            n = emit(pa.concat_tables(small), [(x, y)])
            small.clear()
            return n

        for g in _groups(batches, ["bucket", "bi", "bj"]):
            bi, bj = g["bi"][0].as_py(), g["bj"][0].as_py()
            if bi == bj and len(g) <= 16:
                small.append(g)
                count += len(g) * (len(g) - 1) // 2
                if count > 20_000:
                    rows += flush()
                    count = 0
            else:
                rows += emit(g, _pairs(g["b"].to_numpy(), bi, bj))
            if rows > 10_000:
                yield from pa.concat_tables(found).to_batches()
                found.clear()
                rows = 0
        flush()
        if found:
            yield from pa.concat_tables(found).to_batches()

    return dealt.mapInArrow(run, "bucket long, node long").distinct()


def intersections(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of pairs of sorted distinct sets."""
    used, where = np.unique(np.append(x, y), return_inverse=True)
    sets, x, y = [sets[i] for i in used], where[: len(x)], where[len(x) :]
    if len(x) <= 3 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y, strict=True)], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for begin in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], column[a:b] - begin] = 1
        common += held @ held.T
    return common[x, y].astype(np.int64)


def verified(found: DataFrame, distinct: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """node, links (documents linked in this block pair), root: exact work on the candidates. found: bucket, node; distinct: node, rep, h, digest, sig, weight, copies; texts: rep, h, t."""
    some = written(found.join(distinct, "node"), "ngram-candidates")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("w") / WEIGHT)).cast("int")
    sizes = some.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).select("bucket", "n", blocks.alias("nb"))
    dealt = _blocked(some, sizes, some.count()).join(texts, ["rep", "h"]).drop("rep", "h", "weight").repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["bucket", "bi", "bj"]):
            words = Words(g["t"].to_pylist())
            sets = [shingle_hashes(words.of(i), size) for i in range(len(g))]
            # The text that a node's id and hash have brought may be another.
            own = {n: i for i, (n, d) in enumerate(zip(g["node"].to_pylist(), g["digest"].to_pylist(), strict=True)) if digest_of(sets[i]) == d}
            pick = np.array(sorted(own.values()), np.int64)
            sets, g = [sets[i] for i in pick], g.take(pa.array(pick))
            nodes, copies, sigs = g["node"].to_numpy(), g["copies"].to_numpy(), _signatures(g)
            bands = g["bucket"].to_numpy() & (BANDS - 1)
            lengths = np.array([len(s) for s in sets], np.int64)
            links, root = np.zeros(len(g), np.int64), np.arange(len(g))
            for x, y in _pairs(g["b"].to_numpy(), g["bi"][0].as_py(), g["bj"][0].as_py()):
                x, y = _kept(sigs, bands, x, y, threshold)
                if not len(x):
                    continue
                both = intersections(sets, x, y)
                true = both >= threshold * (lengths[x] + lengths[y] - both) - 1e-9
                x, y = x[true], y[true]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                root = _roots(len(g), x, y, root)
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[root[some]])], ["node", "links", "root"])

    return dealt.mapInArrow(run, "node long, links long, root long")


def _classified(docs: DataFrame, threshold: float, size: int, text: str, key: str) -> tuple[DataFrame, DataFrame, bool]:
    """k and digest of all rows; and of all distinct n-gram sets digest, node, rep (least id), class_id, leads (whether it's the one that its class keeps), n_links; and whether each row has an id of its own."""
    sets = written(_sets(docs, size, text, key), "ngram-sets")
    some = sets.filter("digest is not null and k is not null")
    # Copies of one text leave a map task as one row. The written number tells texts apart even where ids repeat.
    distinct = some.groupBy("digest").agg(F.min(F.struct("k", "h", "sig", "weight")).alias("m"), F.count("*").alias("copies"))
    distinct = distinct.select("digest", F.col("m.k").alias("rep"), F.col("m.h").alias("h"), F.col("m.sig").alias("sig"), F.col("m.weight").alias("weight"), "copies", F.monotonically_increasing_id().alias("node"))
    distinct = written(distinct, "ngram-texts")
    texts = docs.select(F.col(key).cast("long").alias("rep"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    ids = sets.agg(F.count("*").alias("rows"), F.count("k").alias("ids"), F.countDistinct("k").alias("distinct")).first()
    if ids["ids"] > ids["distinct"]:  # equal rows of an id leave a map task as one
        texts = texts.groupBy("rep", "h").agg(F.first("t").alias("t"))
    found = written(verified(candidates(distinct, threshold), distinct, texts, threshold, size), "ngram-links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = distinct.join(linked, "node", "left").join(components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))), "node", "left")
    placed = placed.select("digest", "node", "rep", "copies", "links", F.coalesce("component", "node").alias("component"))
    # One row per class leaves each map task.
    leaders = placed.groupBy("component").agg(F.min(F.struct("rep", "node")).alias("lead"))
    placed = placed.join(leaders, "component")
    unique = ids["rows"] == ids["distinct"]
    return sets, placed.select("digest", "node", "rep", F.col("lead.rep").alias("class_id"), (F.col("lead.node") == F.col("node")).alias("leads"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), unique


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, class_id (the least id it is linked to, directly or not) and n_links (documents with similarity of the threshold or more)."""
    sets, placed, _ = _classified(docs, threshold, size, text, key)
    out = sets.select("k", F.when(F.col("k").isNotNull(), F.col("digest")).alias("digest")).join(placed.select("digest", "class_id", "n_links"), "digest", "left")
    return out.select(F.col("k").alias(key), F.coalesce("class_id", "k").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = 0.8, size: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs, less all but one (the least id) of each class. Rows without words or id stay."""
    sets, placed, unique = _classified(docs, threshold, size, text, key)
    if unique:
        gone = sets.join(placed.filter("leads"), F.col("k") == F.col("rep"), "left_anti").filter("digest is not null").select(F.col("k").alias("__near_k"))
        return docs.join(gone, docs[key].cast("long") == gone["__near_k"], "left_anti")
    # Ids repeat or are null: rows are told apart by their n-grams, and the first of equal rows stays.
    marked = _with_digest(docs, size, text).withColumn("__near_id", F.col(key).cast("long"))
    leads = placed.filter("leads").select(F.col("digest").alias("__near_digest"), F.col("rep").alias("__near_id"))
    first = Window.partitionBy("__near_digest", "__near_id").orderBy(F.xxhash64(F.col(text)))
    kept = marked.join(leads, ["__near_digest", "__near_id"], "left_semi").withColumn("__near_n", F.row_number().over(first)).filter("__near_n = 1")
    rest = marked.filter("__near_digest is null or __near_id is null")
    return kept.select(*docs.columns).unionByName(rest.select(*docs.columns))


def _with_digest(docs: DataFrame, size: int, text: str) -> DataFrame:
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for part in slices([len(t) for t in texts]):
                words = Words(texts[part])
                digests = [digest_of(shingle_hashes(words.of(i), size)) for i in range(len(texts[part]))]
                some = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(digests, pa.binary())], [*(f"c{i}" for i in range(len(some.columns))), "d"])

    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    slim = docs.select(*columns)
    schema = ", ".join([*(f"c{i} {slim.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(columns))), "d binary"])
    return slim.mapInArrow(run, schema).toDF(*docs.columns, "__near_digest")
