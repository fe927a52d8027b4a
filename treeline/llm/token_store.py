"""Token ids in sorted-string-table shards: one immutable file per key range.

A shard is a sequence of compressed blocks, then a sparse index with the last key of each block, a
Bloom filter over the keys, and a footer of fixed size. In a block, a key is stored as the length it
shares with the key before it and the rest. A lookup asks the filter, finds the block by binary
search in the index and reads that block alone.

A key is a 0 for a null id or a 1, the id as 8 big-endian bytes with its sign bit flipped, and a
4-byte count of earlier rows with the same id, so byte order is id order, nulls first. A value is the
row's token ids, little-endian, in the narrowest of 2 or 4 bytes that holds the vocabulary.

Edge cases: a null or empty text is stored with its end id alone. Rows with the same id, equal or not,
are all kept, in the order of their texts. An empty table gives no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pretokens import split
from .shared_store import new_folder, open_file, put_file, written
from .text_arrays import slices
from .token_counts import byte_letters

MAGIC = b"TLSST001"
FOOTER = struct.Struct("<8sQQQQQQQ")  # magic; index offset, length; filter offset, length; rows; tokens; width
BLOCK_BYTES = 64 << 10
FILTER_BITS, FILTER_HASHES = 10, 7
MANIFEST = "shard int, path string, n_docs long, n_tokens long"


def key_of(doc_id: int | None, nth: int = 0) -> bytes:
    return (b"\0" + bytes(8) if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))) + struct.pack(">I", nth)


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:9])[0] - (1 << 63) if key[0] else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return n, at


def _filter_places(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(FILTER_HASHES)]


class ShardWriter:
    """Collects the bytes of a shard; rows must come in key order."""

    def __init__(self, width: int):
        self.width, self.rows, self.tokens, self.offset = width, 0, 0, 0
        self.block, self.last, self.index, self.keys = bytearray(), b"", [], []
        self.press = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: np.ndarray) -> bytes:
        """Bytes to write now, maybe none."""
        if self.rows and key <= self.keys[-1]:
            raise ValueError("keys must ascend")
        shared = next((i for i, (x, y) in enumerate(zip(key, self.last)) if x != y), min(len(key), len(self.last)))
        value = ids.astype("<u2" if self.width == 2 else "<u4", copy=False).tobytes()
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = key
        self.keys.append(key)
        self.rows, self.tokens = self.rows + 1, self.tokens + len(ids)
        return self._end_block() if len(self.block) >= BLOCK_BYTES else b""

    def _end_block(self) -> bytes:
        out = self.press.compress(bytes(self.block))
        self.index.append((self.last, self.offset, len(out)))
        self.offset += len(out)
        self.block, self.last = bytearray(), b""
        return out

    def end(self) -> bytes:
        out = self._end_block() if self.block else b""
        index = b"".join(struct.pack("<I", len(k)) + k + struct.pack("<QQ", o, n) for k, o, n in self.index)
        bits = max(64, FILTER_BITS * self.rows)
        flags = np.zeros(bits, np.uint8)
        for key in self.keys:
            flags[_filter_places(key, bits)] = 1
        bloom = struct.pack("<Q", bits) + np.packbits(flags, bitorder="little").tobytes()
        return out + index + bloom + FOOTER.pack(MAGIC, self.offset, len(index), self.offset + len(index), len(bloom), self.rows, self.tokens, self.width)


class ShardReader:
    """Lookups by binary search, and a scan in key order, of one shard."""

    def __init__(self, path: str):
        self.file = open_file(path)
        size = self.file.size()
        magic, at, n, self._bloom_at, self._bloom_n, self.rows, self.tokens, self.width = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        index, self.last, self.blocks, p = self._read(at, n), [], [], 0
        while p < n:
            (k,) = struct.unpack_from("<I", index, p)
            self.last.append(index[p + 4 : p + 4 + k])
            self.blocks.append(struct.unpack_from("<QQ", index, p + 4 + k))
            p += 20 + k
        self._bloom = None

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        data, at, key = zstandard.ZstdDecompressor().decompress(self._read(*self.blocks[i])), 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            rest, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            yield key, np.frombuffer(data, "<u2" if self.width == 2 else "<u4", size // self.width, at + rest)
            at += rest + size

    def scan(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.blocks)):
            yield from self._block(i)

    def may_have(self, key: bytes) -> bool:
        if self._bloom is None:
            raw = self._read(self._bloom_at, self._bloom_n)
            self._bloom = struct.unpack_from("<Q", raw)[0], raw[8:]
        bits, flags = self._bloom
        return all(flags[p >> 3] >> (p & 7) & 1 for p in _filter_places(key, bits))

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        key = key_of(doc_id, nth)
        if not self.blocks or not self.may_have(key):
            return None
        i = bisect_left(self.last, key)
        return next((v for k, v in self._block(i) if k == key), None) if i < len(self.blocks) else None


class KnownIds(dict):
    """The ids of each pre-token as bytes, by the library's model where the table lacks it; a full table starts again."""

    KEPT = 500_000  #: pre-tokens that a worker remembers
    LONGEST = 64  #: characters of those that it remembers

    def __init__(self, model, width: int):
        super().__init__()
        self.tokenize, self.code, self.letters = model.tokenize, "H" if width == 2 else "I", "".join(byte_letters())

    def __missing__(self, token: str) -> bytes:
        ids = [t.id for t in self.tokenize(charmap_decode(token.encode(), "strict", self.letters)[0])]
        found = struct.pack(f"<{len(ids)}{self.code}", *ids)
        if len(token) <= self.LONGEST:
            if len(self) >= self.KEPT:
                self.clear()
            self[token] = found
        return found


class Encoder:
    """Ids of whole texts, by the tokenizers library. Its model encodes each distinct pre-token once; a bounded table keeps the ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cuts = spec.get("pre_tokenizer") or {}
        self.plain = cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts["add_prefix_space"] and not spec.get("normalizer")
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.known = KnownIds(self.library.model, self.width)

    def _bytes(self, text: str) -> bytes:
        if not self.plain or any(s in text for s in self.specials):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join([b"".join(map(self.known.__getitem__, found)) for found in split(text)])

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self._bytes(t), self.kind) for t in texts]


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int | None = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write all rows to shards of ascending id ranges in the shared folder; returns their manifest, a written table."""
    folder = new_folder(docs.sparkSession, "token-shards")
    slim = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    ordered = slim.repartitionByRange(F.col("k").asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), "t")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(vocabulary), TaskContext.get().partitionId()
        writer, tail = ShardWriter(encoder.width), np.array([] if end_id is None else [end_id], encoder.kind)

        def chunks() -> Iterator[bytes]:
            last, nth = object(), 0
            for batch in batches:
                for part in slices(pc.binary_length(batch["t"]).to_pylist()):
                    for k, ids in zip(batch["k"][part].to_pylist(), encoder.texts(batch["t"][part].to_pylist()), strict=True):
                        last, nth = k, nth + 1 if k == last else 0
                        yield writer.add(key_of(k, nth), np.append(ids, tail))
            yield writer.end()

        path = put_file(folder, f"shard-{shard:06d}.sst", chunks())
        yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n_docs": writer.rows, "n_tokens": writer.tokens}], schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return written(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_digests(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Scan the shards: for each row its id, start (ids of all rows before it), n_tokens and ids_crc32."""
    # One row per shard: a few per thousand partitions, whatever the size of the texts.
    placed = manifest.withColumn("before", F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.filter("n_docs > 0").select("shard", "path", F.coalesce("before", F.lit(0)).alias("before"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, out = row["before"], []
                for k, ids in ShardReader(row["path"]).scan():
                    out.append((id_of(k), at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["k", "start", "n_tokens", "ids_crc32"])

    dealt = placed.repartition(max(1, manifest.count()), "shard")
    return dealt.mapInArrow(run, "k long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("k", key)
