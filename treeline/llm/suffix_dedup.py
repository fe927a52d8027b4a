"""Removal of byte strings that a document with a smaller id has too, over a run-length index.

Every string of ``LENGTH`` bytes holds a minimizer: of its substrings of ``GRAM`` bytes, the one with the least hash. Equal
strings have the same one, wherever they stand. So work is dealt by minimizer, and each part of it is exact alone:

1. Chunks of documents are written to the shared folder. A string holds its minimizer with ``SIDE`` bytes more, before
   or after it; each chunk sends the distinct hashes of such longer strings.
2. Those of one document alone are dropped. The answer is a code for each that was sent: alone, shared, or
   shared by so many chunks that its strings are dealt by their own hash instead, one by one.
3. Each chunk cuts the stretches of strings with the same minimizer that are shared so far (``LENGTH`` to 2 * ``LENGTH``
   bytes) and sends each distinct one with the least document id that has it.
4. Parts of these, of bounded size, are indexed by a run-compressed Burrows-Wheeler transform with sampled run
   ends. The stretches stream through it; each window of ``LENGTH`` bytes that matches tells the least id of
   all documents that have it, and is compared byte for byte with a sample's place. The answer is those ids.
5. Each chunk marks the windows with a smaller id than their document's, and removes the bytes they cover.

What travels is a few compressed arrays for each pair of a chunk and a part; texts are not shuffled. Within a chunk a stretch
or minimizer is sent once, however often it repeats, so no key is hot.

Edge cases: a null text is empty. Rows with equal ids don't remove from each other; a row with a null id
keeps all its bytes and removes none. Matches never reach over the end of a document. Long texts are taken whole.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .run_length_index import RunLengthIndex
from .shared_store import new_folder, open_file, put_file, written
from .text_arrays import BATCH_CHARS, _power_tables, mixed, same_spans, slices, span_hashes

LENGTH, GRAM = 50, 12
SIDE = (LENGTH - GRAM) // 2
PLACE_BITS = 24  #: of a position beside its hash; pieces of text are shorter than 2 ** PLACE_BITS
PIECE = 1 << 22
CHUNK, PART = 8 << 20, 8 << 20  #: bytes of text
INDEXED = 128 << 10  #: bytes that one index holds; its tables then fit the cache
SPREAD = 20_000  #: chunks with a minimizer beyond which its strings are dealt one by one; below it, they are a few MB of a part
ALONE, SHARED, COMMON = 0, 1, 2
NOWHERE = np.iinfo(np.int64).max
RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _zip(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(raw)}Q", *map(len, raw)) + b"".join(raw))


def _unzip(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(kinds), []
    for n, kind in zip(struct.unpack_from(f"<{len(kinds)}Q", raw), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


class Chunk:
    """Some documents: ids, which of them are null, and the bytes end to end."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, offsets: np.ndarray, data: np.ndarray):
        self.ids, self.known, self.offsets, self.data = ids, known, offsets, data

    def packed(self) -> bytes:
        return _zip(self.ids, self.known, self.offsets, self.data)

    @classmethod
    def read(cls, path: str) -> Chunk:
        with open_file(path) as f:
            return cls(*_unzip(f.read(), "i8", "?", "i8", "u1"))

    def runs(self) -> Runs:
        """All runs of windows with the same minimizer, in order."""
        size = np.diff(self.offsets)
        pieces = np.maximum(1, -(-(size - LENGTH + 1) // (PIECE - LENGTH + 1)))  # long documents in pieces that overlap
        doc = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = self.offsets[doc] + nth * (PIECE - LENGTH + 1)
        end = np.minimum(begin + PIECE, self.offsets[doc + 1])
        found = [self._runs(begin[part], end[part], doc[part]) for part in slices((end - begin).tolist(), BATCH_CHARS)]
        return Runs(*(np.concatenate([getattr(f, x) for f in found]) if found else np.zeros(0, np.int64) for x in Runs.__annotations__))

    def _runs(self, begins: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> Runs:
        if len(begins) > 1 and (begins[1:] != ends[:-1]).any():  # pieces of one document: each alone
            found = [self._runs(begins[i : i + 1], ends[i : i + 1], docs[i : i + 1]) for i in range(len(begins))]
            return Runs(*(np.concatenate([getattr(f, x) for f in found]) for x in Runs.__annotations__))
        data = self.data[begins[0] : ends[-1]]
        span, n = LENGTH - GRAM + 1, len(data) - LENGTH + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return Runs(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64))
        up, down = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])
        least = hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: -(span - width)], least[span - width :])
        cover = np.zeros(len(data) + 1, np.int32)  # windows that reach over the end of their document
        relative = np.append(begins, ends[-1:]) - begins[0]
        np.add.at(cover, np.maximum(relative[:-1], relative[1:] - LENGTH + 1), 1)
        np.add.at(cover, relative[1:], -1)
        valid = np.cumsum(cover)[:n] == 0
        same = np.zeros(n + 1, bool)
        same[1:-1] = valid[1:] & valid[:-1] & (least[1:] == least[:-1])
        begin, end = np.flatnonzero(valid & ~same[:-1]), np.flatnonzero(valid & ~same[1:]) + 1
        place = (least[begin] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        doc = docs[np.searchsorted(relative, begin, "right") - 1]
        with_side = lambda at: mixed((sums[np.minimum(at + GRAM + SIDE, len(data))] - sums[np.maximum(at, 0)]) * down[np.maximum(at, 0)])
        return Runs(begin + begins[0], end - begin, np.clip(place - SIDE + 1 - begin, 0, end - begin), doc, hashes[place], with_side(place - SIDE), with_side(place))


@dataclass
class Runs:
    """Runs of windows: begin, how many, how many of them hold the side before the minimizer (the others that after it), document, and the hashes of the minimizer alone, with the side before and with that after."""

    begin: np.ndarray
    windows: np.ndarray
    early: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    before: np.ndarray
    after: np.ndarray


def _key(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part, and a number within it."""
    return ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.uint32)


class Sent:
    """The distinct (part, number) of a chunk's minimizers with a side, and for both halves of each run which of them it has."""

    def __init__(self, chunk: Chunk, parts: int):
        runs = chunk.runs()
        known = chunk.known[runs.doc]
        self.runs = runs = Runs(*(getattr(runs, x)[known] for x in Runs.__annotations__))
        first, second = np.flatnonzero(runs.early > 0), np.flatnonzero(runs.early < runs.windows)
        part, number = _key(np.append(runs.before[first], runs.after[second]), parts)
        key, which = np.unique(part << 32 | number.astype(np.int64), return_inverse=True)
        self.part, self.number = key >> 32, (key & 0xFFFFFFFF).astype(np.uint32)
        ids = chunk.ids[runs.doc]
        low, high = np.full(len(key), NOWHERE), np.full(len(key), -NOWHERE)
        for half, at in ((first, which[: len(first)]), (second, which[len(first) :])):
            np.minimum.at(low, at, ids[half])
            np.maximum.at(high, at, ids[half])
        self.several = low < high
        self.which = np.full((2, len(runs.begin)), -1)
        self.which[0, first], self.which[1, second] = which[: len(first)], which[len(first) :]


class Stretches:
    """The distinct stretches of a chunk that may be shared, sorted by part; for each place, which of them stands there."""

    def __init__(self, chunk: Chunk, sent: Sent, codes: np.ndarray, parts: int):
        runs = sent.runs
        early, late = np.append(codes, ALONE).astype(np.uint8)[sent.which]
        # Windows of a run that go together: both halves, or the one that is shared.
        skip, take = np.where(early == SHARED, 0, runs.early), np.where(early == SHARED, runs.early, 0) + np.where(late == SHARED, runs.windows - runs.early, 0)
        pick = np.flatnonzero(take)
        common = np.append(np.flatnonzero(early == COMMON), np.flatnonzero(late == COMMON))
        many = np.append(runs.early[early == COMMON], (runs.windows - runs.early)[late == COMMON])
        start = np.append(runs.begin[early == COMMON], (runs.begin + runs.early)[late == COMMON])
        single = np.repeat(start, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        begin, windows = np.append((runs.begin + skip)[pick], single), np.append(take[pick], np.ones(len(single), np.int64))
        doc = np.append(runs.doc[pick], np.repeat(runs.doc[common], many))
        own = self._hashes(chunk.data, begin, windows)
        part, number = _key(np.append(runs.hashes[pick], own[len(pick) :]), parts)
        order = np.lexsort((own, part << 32 | number.astype(np.int64)))
        part, number, own = part[order], number[order], own[order]
        new = np.append(True, (part[1:] != part[:-1]) | (number[1:] != number[:-1]) | (own[1:] != own[:-1]))[: len(part)]
        new |= _unlike_first(chunk.data, begin[order], begin[order] + windows[order] + LENGTH - 1, new)
        self.place, self.doc, self.which = begin[order], doc[order], np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.part, self.number, self.begin, self.windows = part[first], number[first], begin[order][first], windows[order][first]
        self.least = np.minimum.reduceat(chunk.ids[self.doc], first) if len(first) else np.zeros(0, np.int64)

    @staticmethod
    def _hashes(data: np.ndarray, begin: np.ndarray, windows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(begin), np.uint64)
        base = np.sort(begin)
        order = np.argsort(begin, kind="stable")
        at = 0
        while at < len(base):  # in stretches of the data that the power tables cover
            end = np.searchsorted(base, base[at] + BATCH_CHARS // 2, "left")
            some = order[at:end]
            b, e = begin[some], begin[some] + windows[some] + LENGTH - 1
            out[some] = span_hashes(data[b[0] : e.max()], b - b[0], e - b[0])
            at = end
        return out


def _bytes_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return data[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def _unlike_first(data: np.ndarray, begin: np.ndarray, end: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Which stretches differ, byte for byte, from the first of their group; ``new`` marks where groups begin.

    Where one does, its hash has met another's: it and all after it in the group stand alone.
    """
    first = np.flatnonzero(new)
    lead = first[np.cumsum(new) - 1]
    out = np.zeros(len(new), bool)
    later = np.flatnonzero(~new)
    out[later] = ~same_spans(data, begin[later], end[later], data, begin[lead[later]], end[lead[later]])
    for a in np.unique(lead[out]):  # hardly ever any
        b = first[np.searchsorted(first, a, "right")] if a < first[-1] else len(new)
        out[a + 1 : b] |= np.maximum.accumulate(out[a + 1 : b])
    return out


def _indexed(number: np.ndarray, windows: np.ndarray, least: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each window of all stretches, in order, the least document id that has it."""
    size = windows + LENGTH - 1
    begin = np.cumsum(size) - size
    out = np.full(windows.sum(), NOWHERE)
    first_window = np.cumsum(windows) - windows
    own = Stretches._hashes(data, begin, windows)
    order = np.lexsort((own, number))
    new = np.append(True, (number[order][1:] != number[order][:-1]) | (own[order][1:] != own[order][:-1]))[: len(order)]
    new |= _unlike_first(data, begin[order], begin[order] + size[order], new)
    lead = np.flatnonzero(new)
    text, label, which = order[lead], np.minimum.reduceat(least[order], lead), np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    group = number[text]
    cuts, held = [0], 0
    for a, b in zip(*(lambda x: (x, np.append(x[1:], len(group))))(np.flatnonzero(np.append(True, group[1:] != group[:-1]))), strict=True):
        bytes_here = int(size[text[a:b]].sum())
        if held and held + bytes_here > INDEXED:
            cuts.append(int(a))
            held = 0
        held += bytes_here
    found = []
    for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True):
        some = text[a:b]
        part = _bytes_of(data, begin[some], size[some])
        index = RunLengthIndex(part, size[some], label[a:b], LENGTH)
        at = np.cumsum(size[some]) - size[some]
        ids, place = index.stream(part, at, size[some])
        w = windows[some]
        starts = np.repeat(at, w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        found.append(np.where(index.occurs(place, part, starts), ids, NOWHERE))
    flat = np.concatenate(found)
    origin = np.append(0, np.cumsum(windows[text]))[which]
    shift = np.arange(windows.sum()) - np.repeat(first_window, windows)
    out[:] = flat[np.repeat(origin, windows) + shift]
    return out


def _runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return first.astype(np.uint32), values[first]


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", texts: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of each row; and kept (binary), if ``texts``."""
    spark = docs.sparkSession
    folder = new_folder(spark, "chunks")
    slim = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("b"))
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // PART))

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        numbers = count()

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            keys, values = table["k"].combine_chunks(), table["b"].combine_chunks()
            raw = values.cast(pa.large_binary())
            offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
            data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            chunk = Chunk(keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_valid().to_numpy(zero_copy_only=False), offsets - offsets[0], data)
            body = chunk.packed()
            mark = hashlib.sha1(body).hexdigest()
            # The name is the chunk's identity: equal chunks elsewhere are others, a repeated task's are the same.
            path = put_file(folder, f"{TaskContext.get().partitionId():06d}-{next(numbers):06d}-{mark}", [body])
            sent = Sent(chunk, parts)
            cuts = np.searchsorted(sent.part, np.arange(parts + 1))
            rows = [(p, path, _zip(sent.number[a:b], np.packbits(sent.several[a:b]))) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            rows = rows or [(int(mark[:8], 16) % parts, path, _zip(sent.number, np.packbits(sent.several)))]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.binary()))], ["part", "chunk", "blob"])

        total_bytes = 0
        for batch in batches:
            sizes = pc.binary_length(batch["b"]).to_pylist()
            for s in slices(sizes, CHUNK // 8):
                n = sum(sizes[s])
                if held and total_bytes + n > CHUNK:
                    yield out()
                    total_bytes = 0
                held.append(batch.slice(s.start, s.stop - s.start))
                total_bytes += n
        if held:
            yield out()

    def shared(rows: pd.DataFrame) -> pd.DataFrame:
        sent = [_unzip(b, "u4", "u1") for b in rows["blob"]]
        number = np.concatenate([n for n, _ in sent])
        several = np.concatenate([np.unpackbits(s, count=len(n)).astype(bool) for n, s in sent])
        _, back, chunks = np.unique(number, return_inverse=True, return_counts=True)
        any_several = np.bincount(back, several, len(chunks)) > 0
        codes = np.where(chunks > SPREAD, COMMON, np.where((chunks > 1) | any_several, SHARED, ALONE)).astype(np.uint8)[back]
        ends = np.cumsum([len(n) for n, _ in sent])
        return rows[["part", "chunk"]].assign(blob=[_zip(c) for c in np.split(codes, ends[:-1])])

    def all_codes(sent: Sent, rows: pd.DataFrame) -> np.ndarray:
        """The answers of all parts, in the order in which the chunk sent its minimizers."""
        return np.concatenate([_unzip(b, "u1")[0] for _, b in sorted(zip(rows["part"], rows["blob"], strict=True))])

    def stretched(rows: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk.read(rows["chunk"].iloc[0])
        sent = Sent(chunk, parts)
        have = Stretches(chunk, sent, all_codes(sent, rows), parts)
        cuts, out = np.searchsorted(have.part, np.arange(parts + 1)), []
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                data = _bytes_of(chunk.data, have.begin[a:b], have.windows[a:b] + LENGTH - 1)
                out.append((p, rows["chunk"].iloc[0], _zip(have.number[a:b], have.windows[a:b].astype(np.uint8), have.least[a:b], data)))
        return pd.DataFrame(out, columns=["part", "chunk", "blob"])

    def matched(rows: pd.DataFrame) -> pd.DataFrame:
        sent = [_unzip(b, "u4", "u1", "i8", "u1") for b in rows["blob"]]
        windows = np.concatenate([s[1] for s in sent]).astype(np.int64)
        least = _indexed(np.concatenate([s[0] for s in sent]), windows, np.concatenate([s[2] for s in sent]), np.concatenate([s[3] for s in sent]))
        ends = np.cumsum([s[1].sum(dtype=np.int64) for s in sent])
        return rows[["part", "chunk"]].assign(blob=[_zip(*_runs_of(x)) for x in np.split(least, ends[:-1])])

    def marked(rows: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk.read(rows["chunk"].iloc[0])
        sent = Sent(chunk, parts)
        have = Stretches(chunk, sent, all_codes(sent, rows[rows["kind"] == 1]), parts)
        edge = np.zeros(len(chunk.data) + 1, np.int32)
        answers = rows[rows["kind"] == 2]
        for p, blob in zip(answers["part"], answers["blob"], strict=True):
            a, b = np.searchsorted(have.part, [p, p + 1])
            first, values = _unzip(blob, "u4", "i8")
            windows = have.windows[a:b]
            least = np.repeat(values, np.diff(np.append(first, windows.sum())))
            origin = np.cumsum(windows) - windows
            x, y = np.searchsorted(have.which, [a, b])
            which, n = have.which[x:y] - a, windows[have.which[x:y] - a]
            shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit = least[np.repeat(origin[which], n) + shift] < np.repeat(chunk.ids[have.doc[x:y]], n)
            at = (np.repeat(have.place[x:y], n) + shift)[hit]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LENGTH, -1)
        gone = np.cumsum(edge[:-1]) > 0
        out = []
        for i, (a, b) in enumerate(zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)):
            lost = gone[a:b]
            kept = chunk.data[a:b][~lost].tobytes()
            spans = int(lost[:1].sum() + np.count_nonzero(lost[1:] & ~lost[:-1]))
            out.append((int(chunk.ids[i]) if chunk.known[i] else None, int(b - a), int(lost.sum()), spans, hashlib.sha256(kept).hexdigest(), *([kept] if texts else [])))
        frame = pd.DataFrame(out, columns=["k", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])])
        return frame.astype({"k": "Int64"})

    blobs = "part long, chunk string, blob binary"
    codes = written(slim.mapInArrow(chunked, blobs).groupBy("part").applyInPandas(shared, blobs), "minimizer-codes")
    found = codes.groupBy("chunk").applyInPandas(stretched, blobs).groupBy("part").applyInPandas(matched, blobs)
    both = codes.withColumn("kind", F.lit(1)).union(found.withColumn("kind", F.lit(2)))
    schema = f"k long, {RESULT}" + ", kept binary" * texts
    return both.groupBy("chunk").applyInPandas(marked, schema).withColumnRenamed("k", key)
