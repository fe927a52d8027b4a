"""Token counts by rank-synchronous merging of byte pairs.

All distinct pre-tokens of a batch lie end to end in one ragged array of symbols. In each round every
sequence merges all places of its own lowest-ranked pair, and sequences without a ranked pair leave.
The merge rounds of thousands of sequences so cost a few array operations. Counts of pre-tokens that a
worker has seen are kept in a bounded table.

Edge cases: a null or empty text has 0 bytes and 0 tokens. Texts of any length are counted whole; one
longer than a batch makes a batch alone. Repeated rows give repeated rows. Special strings of the
vocabulary count as one token each, as the tokenizers library has them by default. A null id stays null.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import Known, cut
from .text_arrays import slices

KEPT = 1_000_000  #: pre-tokens that a worker remembers
ROUND_SYMBOLS = 2_000_000  #: symbols that are merged at once


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable, else the next free one from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class BytePairs:
    """A byte-level BPE vocabulary (a tokenizers .json file) as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or model.get("ignore_merges") or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        self.size = max(ids.values()) + 1
        self.of_byte = np.array([ids[c] for c in byte_letters()], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)  # by rank
        self.specials = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], len(self.pairs))

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """How many symbols are left of each sequence."""
        out = np.zeros(len(sequences), np.int64)
        for part in slices([len(s) for s in sequences], ROUND_SYMBOLS):
            out[part] = self._counts(sequences[part])
        return out

    def _counts(self, sequences: list[bytes]) -> np.ndarray:
        lengths = np.array([len(s) for s in sequences], np.int64)
        out = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        none = len(self.pairs)
        while len(symbols):
            same = owner[1:] == owner[:-1]
            rank = np.full(len(symbols), none, np.int64)
            rank[:-1][same] = self.rank(symbols[:-1][same], symbols[1:][same])
            first = np.flatnonzero(np.append(True, ~same))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            out[owner[first]] = sizes
            goes_on = lowest < none
            if not goes_on.any():
                break
            hit = (rank == np.repeat(lowest, sizes)) & (rank < none)
            at = np.flatnonzero(hit)
            run = np.append(True, np.diff(at) != 1)  # pairs that overlap are taken from the left, every other one
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.repeat(goes_on, sizes)
            keep[at + 1] = False
            gone = np.bincount(owner[at], minlength=len(out))
            symbols, owner = symbols[keep], owner[keep]
            ended = np.zeros(len(out), bool)
            ended[owner] = True
            out[ended] -= gone[ended]
        return out


class Counter:
    """Counts of pre-tokens, in a table that is bounded."""

    def __init__(self, path: str):
        self.model = BytePairs(path)
        self.known, self.values = Known(), np.zeros(0, np.int64)

    def of(self, tokens) -> np.ndarray:
        one, back, row = tokens.distinct(self.known)
        counts = np.append(self.values, 0)[row]
        new = np.flatnonzero(row < 0)
        if len(new):
            counts[new] = self.model.counts([tokens.text(i).encode("utf-8", "replace") for i in one[new]])
            if len(self.values) + len(new) > KEPT or self.known.full:
                self.known, self.values = Known(), np.zeros(0, np.int64)
            added, order = self.known.add(tokens, one[new])
            self.values = np.append(self.values, counts[new[added]])[order]
        return counts[back]

    def texts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        pieces, owner, out = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            if self.model.special and self.model.special.search(text):
                out[i] = len(self.model.special.findall(text))
                parts = self.model.special.split(text)
            pieces += parts
            owner += [i] * len(parts)
        owner = np.array(owner, np.int64)
        for part in slices([len(p) for p in pieces]):
            tokens = cut(pieces[part])
            if len(tokens.starts):
                sums = np.append(0, np.cumsum(self.of(tokens)))
                np.add.at(out, owner[part], sums[tokens.first[1:]] - sums[tokens.first[:-1]])
        return out


@lru_cache(1)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For each row its key, n_bytes (UTF-8) and n_tokens. ``vocabulary``: the path of a tokenizers .json file that every executor has."""
    slim = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            sizes = pc.binary_length(batch["t"])
            for part in slices(sizes.to_pylist()):
                texts = batch["t"][part].to_pylist()
                yield pa.RecordBatch.from_arrays([batch["k"][part], pc.cast(sizes[part], pa.int64()), pa.array(counter.texts(texts))], ["k", "n_bytes", "n_tokens"])

    kind = slim.schema["k"].dataType.simpleString()
    return slim.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long").withColumnRenamed("k", key)
