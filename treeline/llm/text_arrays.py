"""Texts as flat numpy arrays: code points, character classes, words and hashes of spans.

Spans are hashed with a polynomial modulo 2**64 over prefix sums, so that a batch of texts costs a
fixed number of passes over one array, whatever the number of spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
BATCH_CHARS = 500_000

#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            table[i] = LETTER
        elif kind == "N":
            table[i] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, below n."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BATCH_CHARS + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.empty(size, np.uint64)
            out[0], done = 1, 1
            while done < size:
                step = min(done, size - done)
                out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            tables.append(out)
        if size > 4 * BATCH_CHARS:
            return tables[0], tables[1]
        _powers = tables[0], tables[1]
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of uint64 values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A uint64 hash of values[start:end] for every span; it depends on nothing outside the span."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def same_spans(a: np.ndarray, a_begin: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_begin: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For each pair of spans, a[begin:end] and b[begin:end], whether they are equal, value by value."""
    size = a_end - a_begin
    same = size == b_end - b_begin
    pick = np.flatnonzero(same & (size > 0))
    ends = np.cumsum(size[pick])
    cuts = [*np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, BATCH_CHARS)), len(pick)]
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        some = pick[first:last]
        n = size[some]
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        differ = a[np.repeat(a_begin[some], n) + shift] != b[np.repeat(b_begin[some], n) + shift]
        if differ.any():
            same[some[np.repeat(np.arange(len(some)), n)[differ]]] = False
    return same


def slices(lengths: Sequence[int], limit: int = BATCH_CHARS) -> Iterator[slice]:
    """Cut a list into runs of about ``limit`` characters; a longer text makes a run alone."""
    begin = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield slice(begin, len(lengths))


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as uint32, and the offset at which each begins, with the end as last."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


@cache
def _word_bytes() -> np.ndarray:
    """True for bytes that belong to words: ASCII letters and digits, and every byte of a longer character."""
    table = np.zeros(256, bool)
    table[128:] = True
    for c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
        table[c] = True
    return table


class Words:
    """The lower-case words of a batch of texts: hashes in order, and the offset of each text's first word."""

    def __init__(self, texts: Sequence[str]):
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        offsets = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(b) + 1 for b in raw], out=offsets[1:])
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[1:] = _word_bytes()[data]
        edges = np.diff(inside)
        starts = np.flatnonzero(edges == 1)
        ends = np.flatnonzero(edges == -1)
        self.hashes = span_hashes(data, starts, ends)
        self.offsets = np.searchsorted(starts, offsets)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i] : self.offsets[i + 1]]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of runs of ``size`` words, sorted; of all words together, where there are fewer."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(size, len(words))):
        out = mixed(out * np.uint64(3) + words[i : i + n])
    return np.unique(out)
