"""Benchmark decontamination by latent semantic retrieval.

Passages are taken once each, however often the corpus repeats them, and without the verbatim parts of items: TF-IDF
weights come from the frequencies of ``BUCKETS`` hashed words in all of them, and are above zero for words that all hold, so
that tables of one text work as well. A randomised SVD of TF-IDF passages,
distributed over the rows, gives a latent basis; its one pass reads all of these passages and all benchmark items, and its large
matrices never come to the driver: they are added in parts and stay in the shared folder, where tasks open them.
Those of the ``COMMON`` first directions that many items have a part in hold what all texts of a language have in common and
are left out; a passage that many documents repeat is not.
Every window of every document is projected (differences of prefix sums)
and compared by cosine with the items of its length class; runs of ``GRAM`` words of an item, found by their hashes, make candidates as well,
whatever their coordinates. Candidates are decided by the longest common
subsequence of words of the item and the window with its surroundings, and by the item's closing words, which
stand for its answer: a paraphrase counts with a shorter common subsequence if the answer is there.

Benchmarks of more than ``ITEMS`` items are taken in blocks of about that size.

Edge cases: null texts and texts without words match nothing. Items without words are passed over; items of fewer
than 8 words must be there as a whole, and are found by a hash of all their words. Equal items and repeated rows all give rows. An empty benchmark gives none.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared_store import new_folder, open_file, put_file, written
from .text_arrays import Words, mixed, slices, span_hashes

BUCKETS, RANK, COMMON = 1 << 15, 64, 4
PASSAGE = 64
CUT, TOGETHER = 32, 24  #: one pair of words in so many ends a passage; passages to a matrix product
SHARED, SHARED_PART = 8, 0.05  #: items, and part of all items, that have a part in a common direction
GRAM = 8  #: words of an item that, found verbatim, make a candidate
ITEMS = 20_000
PARTS = 16  #: of the latent basis; a file each
CELLS = 1 << 21  #: cosines that are computed at a time
SIZES = (16, 32, 64)  #: words in a window; windows overlap by half
BLOCK = 8  #: words that are summed at once; it divides half of each size
COSINE = 0.5  #: of a candidate
WHOLE, PARAPHRASE, ANSWER_WORDS, ANSWER = 0.7, 0.5, 5, 0.8


def _slim(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


class Grams:
    """Where runs of ``size`` words stand: a table from their hashes to (item, place in the item)."""

    def __init__(self, size: int, items: list[np.ndarray], places: list[list[int]]):
        self.size = size
        item = np.repeat(np.arange(len(items)), [len(p) for p in places])
        place = np.array([at for p in places for at in p], np.int64)
        hashes = np.concatenate([np.zeros(0, np.uint64), *(span_hashes(w, np.array(p, np.int64), np.array(p, np.int64) + size) for w, p in zip(items, places, strict=True) if p)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], item[order], place[order]
        bits = min(22, (1024 + 16 * len(hashes)).bit_length())
        self.some, self.shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
        self.some[self.hashes >> self.shift] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in words, row of the table) of every occurrence within one text."""
        starts = np.arange(max(0, len(words.hashes) - self.size + 1))
        hashes = span_hashes(words.hashes, starts, starts + self.size)
        at = np.flatnonzero(self.some[hashes >> self.shift])
        first, last = (np.searchsorted(self.hashes, hashes[at], side) for side in ("left", "right"))
        text = np.searchsorted(words.offsets, at, "right") - 1
        count = np.where(at + self.size <= words.offsets[text + 1], last - first, 0)
        row = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(text, count), np.repeat(at, count), row


def _places(n: int) -> list[int]:
    """Where runs of GRAM words begin that cover n words."""
    return sorted({*range(0, n - GRAM + 1, GRAM), n - GRAM}) if n >= GRAM else []


def _known(items: DataFrame, text: str) -> Grams:
    words = [w.hashes for r in _slim(items, text).distinct().toLocalIterator() for w in [Words([r["t"]])]]
    return Grams(GRAM, words, [_places(len(w)) for w in words])


def corpus_passages(docs: DataFrame, known: Grams, text: str) -> DataFrame:
    """The distinct passages of the corpus, as ``b``: buckets of words in order, two bytes each.

    A passage ends where the hash of two words says so, or after PASSAGE words, so that what documents share gives the
    same passages wherever it stands in them. Verbatim parts of items are left out, as the items come by themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["t"].to_pylist()
            for part in slices([len(t) for t in texts]):
                words = Words(texts[part])
                h = words.hashes
                if not len(h):
                    continue
                begins = np.zeros(len(h) + 1, bool)
                begins[words.offsets] = True
                begins[2:-1] |= mixed(h[:-2] * np.uint64(3) + h[1:-1]) % np.uint64(CUT) == 0
                _, at, _ = known.find(words)
                inside = np.cumsum(np.bincount(at, minlength=len(h) + GRAM) - np.bincount(at + GRAM, minlength=len(h) + GRAM))[: len(h)] > 0
                begins[1:-1] |= inside[1:] != inside[:-1]
                first = np.flatnonzero(begins[:-1])
                place = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
                first = np.flatnonzero((place % PASSAGE == 0)[~inside])
                data = _buckets(h[~inside]).astype(np.uint16)
                if len(data):
                    ends = np.append(first, len(data)).astype(np.int32) * 2
                    yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data)])], ["b"])

    return _slim(docs, text).mapInArrow(run, "b binary").distinct()


def item_passages(items: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_buckets(Words([t]).hashes).astype(np.uint16) for t in batch["t"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([w[i : i + PASSAGE].tobytes() for w in own for i in range(0, len(w), PASSAGE)], pa.binary())], ["b"])

    return _slim(items, text).mapInArrow(run, "b binary").distinct()


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Where each passage begins, and the buckets of all."""
    column = batch["b"]
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 2
    return offsets, np.frombuffer(column.buffers()[2] or b"", np.uint16)


def _counts(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Some passages at a time: their rows, the buckets they hold and how often each passage holds each (dense, for BLAS)."""
    offsets, data = _flat(batch)
    place = np.zeros(BUCKETS, np.int64)
    for begin in range(0, len(batch), TOGETHER):
        some = slice(begin, min(begin + TOGETHER, len(batch)))
        flat = data[offsets[some.start] : offsets[some.stop]]
        used = np.zeros(BUCKETS, bool)
        used[flat] = True
        held = np.flatnonzero(used)
        place[held] = np.arange(len(held))
        n = some.stop - some.start
        owner = np.repeat(np.arange(n), np.diff(offsets[some.start : some.stop + 1]))
        yield some, held, np.bincount(owner * len(held) + place[flat], minlength=n * len(held)).reshape(n, -1)


def passage_frequencies(passages: DataFrame) -> tuple[np.ndarray, int, int]:
    """In how many passages each bucket occurs, the number of passages and of words. BUCKETS numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, total = np.zeros(BUCKETS, np.int64), 0, 0
        for batch in batches:
            offsets, data = _flat(batch)
            held = np.repeat(np.arange(len(offsets) - 1) * BUCKETS, np.diff(offsets)) + data[offsets[0] : offsets[-1]]
            held.sort()
            held = held[np.append(True, held[1:] != held[:-1])[: len(held)]]
            seen += np.bincount(held % BUCKETS, minlength=BUCKETS)
            n, total = n + len(batch), total + int(offsets[-1] - offsets[0])
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(seen[some], [n, total]))], ["bucket", "n"])

    out, n, total = np.zeros(BUCKETS, np.int64), 0, 0
    for row in passages.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        if row["bucket"] >= 0:
            out[row["bucket"]] = row["n"]
        elif row["bucket"] == -1:
            n = row["n"]
        else:
            total = row["n"]
    return out, n, total


def _test_matrix(seed: int, width: int) -> np.ndarray:
    """Every task makes the same random matrix for itself."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, width), np.float32)


def sketch(corpus: DataFrame, items: DataFrame, idf: np.ndarray, words_in_all: int, seed: int, width: int) -> DataFrame:
    """A'(A P) for the random matrix P and the TF-IDF rows A of all passages and items: PARTS rows (part, m), each some of its rows."""
    # A tenth of the weight falls to the items together, but to none so much that it makes a direction of its own among the first.
    passages, n = words_in_all / PASSAGE, max(1, items.count())
    weight = math.sqrt(max(1.0, min(0.1 * passages / n, 0.003 * passages)))
    tasks = max(4, corpus.sparkSession.sparkContext.defaultParallelism)  # each makes one matrix
    both = corpus.withColumn("w", F.sqrt(F.length("b") / F.lit(2.0 * PASSAGE)))  # weight goes by words
    both = both.union(items.withColumn("w", F.lit(weight))).coalesce(tasks)
    rows = BUCKETS // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = _test_matrix(seed, width)
        total = np.zeros_like(probe)
        for batch in batches:
            w = batch["w"].to_numpy(zero_copy_only=False)
            for some, held, counts in _counts(batch):
                a = counts.astype(np.float32) * idf[held]
                a *= (w[some] / np.maximum(np.sqrt(np.einsum("ij,ij->i", a, a)), 1e-9)).astype(np.float32)[:, None]
                total[held] += a.T @ (a @ probe[held])
        for part in range(PARTS):
            m = total[part * rows : (part + 1) * rows]
            if m.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["part", "m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # PARTS at most, together one matrix
        for batch in batches:
            for part, m in zip(batch["part"].to_pylist(), batch["m"], strict=True):
                sums.setdefault(part, np.zeros((rows, width)))[:] += np.frombuffer(m.as_buffer(), np.float32).reshape(rows, width)
        for part, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([m.astype(np.float32).tobytes()], pa.binary())], ["part", "m"])

    return written(both.mapInArrow(run, "part int, m binary").repartition(PARTS, "part").mapInArrow(add, "part int, m binary"), "latent-sketch")


def latent_basis(corpus: DataFrame, items: DataFrame, idf: np.ndarray, words_in_all: int, seed: int = 5) -> str:
    """A folder of idf-weighted coordinates of every bucket, from a randomised SVD of all passages in one pass.

    With Y = A'(A P), the product Y (P'Y)^-1 Y' approximates A'A. Its eigenvectors are Y times a small matrix, made from Y'Y
    and P'Y, which tasks add up; the large matrices stay in the shared folder.
    """
    width = RANK + COMMON + 8
    made, rows = sketch(corpus, items, idf, words_in_all, seed, width), BUCKETS // PARTS

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = _test_matrix(seed, width)
        for batch in batches:
            for part, m in zip(batch["part"].to_pylist(), batch["m"], strict=True):
                y = np.frombuffer(m.as_buffer(), np.float32).reshape(rows, width).astype(np.float64)
                both = np.stack([y.T @ y, probe[part * rows : (part + 1) * rows].T.astype(np.float64) @ y])
                yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary())], ["m"])

    yy, py = np.zeros((2, width, width))
    for row in made.mapInArrow(products, "m binary").toLocalIterator():  # PARTS pairs of width x width
        y, p = np.frombuffer(row["m"]).reshape(2, width, width)
        yy, py = yy + y, py + p
    turn = _eigenvectors(yy, py)
    folder = new_folder(corpus.sparkSession, "latent-basis")

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, m in zip(batch["part"].to_pylist(), batch["m"], strict=True):
                y = np.frombuffer(m.as_buffer(), np.float32).reshape(rows, width).astype(np.float64)
                put_file(folder, str(part), [((y @ turn) * idf[part * rows : (part + 1) * rows, None]).astype(np.float32).tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    parts = [r["part"] for r in made.select("part").collect()]  # PARTS at most
    made.mapInArrow(coordinates, "n long").agg(F.sum("n")).collect()
    use = np.ones(turn.shape[1], bool)
    use[:COMMON] = ~_shared(items, idf, folder, parts, turn.shape[1])[: len(use)]
    use[np.flatnonzero(use)[RANK:]] = False
    use = use if use.any() else ~use
    put_file(folder, "use", [pickle.dumps((parts, use))])
    return folder


def _eigenvectors(yy: np.ndarray, py: np.ndarray) -> np.ndarray:
    """T such that the columns of Y T are orthonormal and are the first eigenvectors of Y (P'Y)^-1 Y', most important first."""
    py = (py + py.T) / 2
    size, along = np.linalg.eigh(py)
    keep = size > 1e-7 * max(size.max(), 1e-30)  # small tables have fewer directions
    root = along[:, keep] / np.sqrt(np.maximum(size[keep], 1e-30))  # Y root (Y root)' is the approximation
    values, turn = np.linalg.eigh(root.T @ yy @ root)
    order = np.argsort(-values)
    order = order[: max(1, int((values > 1e-5 * values.max()).sum()))][: RANK + COMMON]
    return root @ turn[:, order] / np.sqrt(np.maximum(values[order], 1e-30))


def read_basis(folder: str, parts: list[int], directions: int) -> np.ndarray:
    rows, out = BUCKETS // PARTS, np.zeros((BUCKETS, directions), np.float32)
    for part in parts:
        with open_file(f"{folder}/{part}") as f:
            out[part * rows : (part + 1) * rows] = np.frombuffer(f.read(), np.float32).reshape(rows, -1)
    return out


def _shared(items: DataFrame, idf: np.ndarray, folder: str, parts: list[int], directions: int) -> np.ndarray:
    """Which of the first directions many items have a part in: Σ²(c²) / Σ(c⁴) of their coordinates c is near their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = None
        for batch in batches:
            basis = read_basis(folder, parts, directions)[:, :COMMON] if basis is None else basis
            for _, held, counts in _counts(batch):
                a = counts * idf[held]
                c = (counts @ basis[held]) / np.maximum(np.sqrt(np.einsum("ij,ij->i", a, a)), 1e-9)[:, None]
                n = c.shape[1]
                columns = [pa.array(range(n), pa.int32()), pa.array([len(c)] * n, pa.int64()), pa.array((c**2).sum(axis=0), pa.float64()), pa.array((c**4).sum(axis=0), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["d", "n", "s2", "s4"])

    found = items.mapInArrow(run, "d int, n long, s2 double, s4 double").groupBy("d").agg(*[F.sum(x).alias(x) for x in ("n", "s2", "s4")])
    out = np.zeros(COMMON, bool)
    for r in found.collect():
        out[r["d"]] = r["s4"] > 0 and r["s2"] ** 2 / r["s4"] >= max(SHARED, SHARED_PART * r["n"])
    return out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common subsequence, a bit for each element of a."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for x in b.tolist():
        hit = places.get(x)
        if hit:
            u = row & hit
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


class Matcher:
    def __init__(self, ids: list, texts: list[str | None], basis: np.ndarray):
        self.ids = ids
        words = Words([t or "" for t in texts])
        self.words = [words.of(i) for i in range(len(texts))]
        self.basis, self.passages = basis, {}
        self.grams = Grams(GRAM, self.words, [_places(len(w)) for w in self.words])
        self.short = [Grams(n, self.words, [[0] if len(w) == n else [] for w in self.words]) for n in sorted({len(w) for w in self.words}) if 0 < n < GRAM]
        for size in SIZES:
            chosen = [(i, w[at : at + size]) for i, w in enumerate(self.words) if len(w) and self._size(len(w)) == size for at in range(0, max(1, len(w) - size // 2), size)]
            vectors = np.array([basis[_buckets(w)].sum(axis=0) for _, w in chosen], np.float32).reshape(-1, basis.shape[1])
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            self.passages[size] = np.array([i for i, _ in chosen], np.int64), vectors / np.where(norms > 0, norms, 1)

    @staticmethod
    def _size(n: int) -> int:
        return next((s for s in SIZES if n <= 1.4 * s), SIZES[-1])

    def find(self, texts: list[str]) -> list[tuple[int, int, float, float]]:
        """(text, item, common subsequence as a share of the item, cosine) of all matches."""
        words = Words(texts)
        n = np.diff(words.offsets)
        if not len(words.hashes):
            return []
        blocks, sums = self._sums(words, n)
        best: dict[tuple[int, int], tuple[float, float]] = {}
        self._verbatim(words, best)
        for size in SIZES:
            owner, vectors = self.passages[size]
            if not len(owner):
                continue
            step = size // 2
            count = np.where(n > 0, np.maximum(1, -(-(n - step) // step)), 0)
            text = np.repeat(np.arange(len(n)), count)
            at = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step
            begin = words.offsets[:-1][text] + at
            end = np.minimum(begin + size, words.offsets[1:][text])
            first = blocks[:-1][text] + at // BLOCK
            last = np.minimum(first + size // BLOCK, blocks[1:][text])
            together = max(64, CELLS // len(owner))
            for a in range(0, len(text), together):
                v = sums[last[a : a + together]] - sums[first[a : a + together]]
                norms = np.sqrt(np.einsum("ij,ij->i", v, v))
                cosines = v @ vectors.T
                w, p = np.nonzero(cosines >= COSINE * np.maximum(norms, 1e-6)[:, None])
                for x, y, c in zip((w + a).tolist(), p.tolist(), (cosines[w, p] / np.maximum(norms[w], 1e-6)).tolist(), strict=True):
                    pair = int(text[x]), int(owner[y])
                    if pair in best and best[pair][0] >= WHOLE:
                        continue
                    item = self.words[pair[1]]
                    reach = step + max(0, len(item) - size)
                    region = words.hashes[max(begin[x] - reach, words.offsets[pair[0]]) : min(end[x] + reach, words.offsets[pair[0] + 1])]
                    share = self.decide(item, region)
                    if share and share > best.get(pair, (0.0, 0.0))[0]:
                        best[pair] = share, c
        return [(t, i, share, c) for (t, i), (share, c) in best.items()]

    def _sums(self, words: Words, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first block of BLOCK words of each text, and prefix sums of the coordinates over blocks."""
        blocks = np.zeros(len(n) + 1, np.int64)
        np.cumsum(-(-n // BLOCK), out=blocks[1:])
        text = np.repeat(np.arange(len(n)), np.diff(blocks))
        begin = words.offsets[:-1][text] + (np.arange(len(text)) - blocks[text]) * BLOCK
        left = words.offsets[1:][text] - begin
        buckets = np.append(_buckets(words.hashes), np.zeros(BLOCK, np.int64))
        total = self.basis[buckets[begin]]
        for j in range(1, BLOCK):
            total += self.basis[buckets[begin + j]] * (left > j)[:, None]
        sums = np.zeros((len(total) + 1, total.shape[1]), np.float32)
        np.cumsum(total, axis=0, out=sums[1:])
        return blocks, sums

    def _verbatim(self, words: Words, best: dict[tuple[int, int], tuple[float, float]]) -> None:
        """Short items as a whole, and candidates that hold GRAM words of an item in a row, whatever their coordinates."""
        for grams in self.short:
            text, at, row = grams.find(words)
            pairs, first = np.unique(np.stack([text, grams.item[row]], axis=1), axis=0, return_index=True)
            for (t, i), begin in zip(pairs.tolist(), at[first].tolist(), strict=True):
                best[t, i] = 1.0, self._cosine(self.words[i], words.hashes[begin : begin + grams.size])
        text, at, row = self.grams.find(words)
        for t, i, begin in np.unique(np.stack([text, self.grams.item[row], at - self.grams.place[row]], axis=1), axis=0).tolist():
            pair, item = (t, i), self.words[i]
            if pair in best and best[pair][0] >= WHOLE:
                continue
            low, high, reach = words.offsets[t], words.offsets[t + 1], len(item) // 2
            share = self.decide(item, words.hashes[max(begin - reach, low) : min(begin + len(item) + reach, high)])
            if share and share > best.get(pair, (0.0, 0.0))[0]:
                best[pair] = share, self._cosine(item, words.hashes[max(begin, low) : min(begin + len(item), high)])

    def _cosine(self, item: np.ndarray, window: np.ndarray) -> float:
        own, v = (self.basis[_buckets(w)].sum(axis=0) for w in (item, window))
        return float(own @ v / max(1e-9, np.linalg.norm(own) * np.linalg.norm(v)))

    @staticmethod
    def decide(item: np.ndarray, region: np.ndarray) -> float | None:
        share = common_subsequence(item, region) / len(item)
        if len(item) < 8:
            return share if share == 1 else None
        if share >= WHOLE:
            return share
        answer = item[-ANSWER_WORDS:]
        return share if share >= PARAPHRASE and common_subsequence(answer, region) >= ANSWER * len(answer) else None


@lru_cache(maxsize=1)
def _matcher(items: str, basis: str) -> Matcher:
    """A worker keeps the one that its last task used."""
    with open_file(items) as f:
        ids, texts = pickle.loads(f.read())
    with open_file(f"{basis}/use") as f:
        parts, use = pickle.loads(f.read())
    return Matcher(ids, texts, np.ascontiguousarray(read_basis(basis, parts, len(use))[:, use]))


def _matchers(docs: DataFrame, benchmark: DataFrame, text: str, item_key: str, item_text: str) -> Iterator[Callable[[], Matcher]]:
    """What opens a matcher in a task, for each block of items. Basis and items lie in the shared folder."""
    blocks = -(-benchmark.count() // ITEMS)
    if not blocks:
        return
    corpus = written(corpus_passages(docs, _known(benchmark, item_text), text), "passages")
    seen, n, total = passage_frequencies(corpus)
    idf = np.log((2 + n) / (1 + seen)).astype(np.float32)
    basis = latent_basis(corpus, item_passages(benchmark, item_text), idf, total)
    slim = benchmark.select(F.col(item_key).alias("i"), F.col(item_text).alias("t"))
    for b in range(blocks):
        part = slim.filter(F.pmod(F.xxhash64(F.col("i").cast("string"), "t"), F.lit(blocks)) == b) if blocks > 1 else slim
        held = [(r["i"], r["t"]) for r in part.toLocalIterator()]  # about ITEMS
        path = put_file(new_folder(docs.sparkSession, "items"), str(b), [pickle.dumps(([i for i, _ in held], [t for _, t in held]))])
        yield partial(_matcher, path, basis)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item, lcs_ratio, cosine of every document that holds a benchmark item. Both keys may be of any atomic type."""
    slim = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = benchmark.schema[item_key].dataType
    schema = f"{key} {slim.schema['k'].dataType.simpleString()}, {item_key} {kind.simpleString()}, lcs_ratio double, cosine double"
    out, arrow = docs.sparkSession.createDataFrame([], schema), to_arrow_type(kind)
    for opened in _matchers(docs, benchmark, text, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], opened: Callable[[], Matcher] = opened) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m, texts = opened(), batch["t"].to_pylist()
                for part in slices([len(t) for t in texts]):
                    found = m.find(texts[part])
                    at, items, share, cosine = zip(*found, strict=True) if found else ((), (), (), ())
                    ids, shares, cosines = pa.array([m.ids[i] for i in items], arrow), pa.array(share, pa.float64()), pa.array(cosine, pa.float64())
                    yield pa.RecordBatch.from_arrays([batch["k"][part].take(pa.array(at, pa.int64())), ids, shares, cosines], [key, item_key, "lcs_ratio", "cosine"])

        out = out.union(slim.mapInArrow(run, schema))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs that hold no benchmark item; nothing is shuffled."""
    place, out = docs.columns.index(text), docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    for opened in _matchers(docs, benchmark, text, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], opened: Callable[[], Matcher] = opened) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m, texts = opened(), [t or "" for t in batch.column(place).to_pylist()]
                clean = np.ones(len(texts), bool)
                for part in slices([len(t) for t in texts]):
                    for t, *_ in m.find(texts[part]):
                        clean[part.start + t] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*docs.columns)
