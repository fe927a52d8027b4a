"""Cut texts into the pre-tokens of byte-level BPE vocabularies.

The cut is that of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. ``cut`` works it out
from the classes of neighbouring characters, for a batch as arrays; ``split`` gives the strings of one
text by that pattern, with the classes written out as ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np

from .text_arrays import BATCH_CHARS, LETTER, NUMBER, OTHER, SPACE, classes, code_points, same_spans, span_hashes

_SHORT = [ord(c) for c in "stmd"]
_LONG = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


@dataclass
class PreTokens:
    """Spans in one string of code points; ``first`` has the index of each text's first span, with the end as last."""

    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    _keys: np.ndarray | None = None

    def keys(self) -> np.ndarray:
        if self._keys is None:
            self._keys = span_hashes(self.points, self.starts, self.ends)
        return self._keys

    def text(self, i: int) -> str:
        return self.points[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")

    def distinct(self, known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One span of each distinct pre-token, which of them each span is, and its row in the table (-1: not in it).

        Spans of equal hash are compared with the first of them, and that with the table's; one that differs counts as distinct itself.
        """
        keys, one, back = np.unique(self.keys(), return_index=True, return_inverse=True)
        lead = one[back]
        size = self.ends - self.starts
        other = size != size[lead]
        shift = np.where(other, 0, self.starts[lead] - self.starts).astype(np.int32)
        # The spans lie end to end and cover all points.
        differ = np.flatnonzero(self.points != self.points.take(np.arange(len(self.points), dtype=np.int32) + np.repeat(shift, size)))
        other[np.searchsorted(self.starts, differ, "right") - 1] = True
        other = np.flatnonzero(other)
        back[other] = len(one) + np.arange(len(other))
        row = known.find(keys, self, one)
        return np.append(one, other), back, np.append(row, np.full(len(other), -1))


class Known:
    """Pre-tokens in order of their hashes, with their code points: one for each hash."""

    POINTS = 8_000_000  #: code points beyond which the table is full

    def __init__(self):
        self.keys, self.points = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begin = self.end = np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return len(self.points) > self.POINTS

    def _at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row that each hash would have, and whether it has one."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def find(self, keys: np.ndarray, tokens: PreTokens, one: np.ndarray) -> np.ndarray:
        """The row of each of the spans ``one`` with these hashes; -1 where the table has none that is equal."""
        row = np.full(len(keys), -1)
        at, have = self._at(keys)
        have = np.flatnonzero(have)
        same = same_spans(self.points, self.begin[at[have]], self.end[at[have]], tokens.points, tokens.starts[one[have]], tokens.ends[one[have]])
        row[have[same]] = at[have[same]]
        return row

    def add(self, tokens: PreTokens, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Add those of the spans whose hash the table lacks; which these are, and the order of old rows and these in the new table."""
        keys, first = np.unique(tokens.keys()[spans], return_index=True)
        new = first[~self._at(keys)[1]]
        size = (tokens.ends - tokens.starts)[spans[new]]
        begin = np.cumsum(size) - size
        points = tokens.points[np.repeat(tokens.starts[spans[new]] - begin, size) + np.arange(size.sum())]
        all_keys = np.append(self.keys, tokens.keys()[spans[new]])
        order = np.argsort(all_keys)
        start = np.append(self.begin, len(self.points) + begin)
        self.end = np.append(self.end, len(self.points) + begin + size)[order]
        self.keys, self.begin, self.points = all_keys[order], start[order], np.append(self.points, points)
        return new, order


def cut(texts: Sequence[str]) -> PreTokens:
    points, offsets = code_points(texts)
    n = len(points)
    if not n:
        none = np.zeros(0, np.int64)
        return PreTokens(points, none, none, np.zeros(len(texts) + 1, np.int64))
    kind = classes()[points]
    begins = np.zeros(n + 1, bool)  # of texts
    begins[offsets] = True
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[begins[:n]] = 255
    edge = kind != before
    space = kind == SPACE
    ends_text = begins[1:]
    next_edge = np.ones(n, bool)
    next_edge[:-1] = edge[1:]
    last_space = space & next_edge & ~ends_text  # the last of a run that something follows
    edge |= last_space
    joined = np.flatnonzero(last_space & (points == 0x20)) + 1  # a plain space goes with what follows it
    edge[joined] = False
    quote = np.flatnonzero((points == 0x27) & edge & (kind == OTHER))
    if len(quote):
        quote = quote[next_edge[quote] & ~ends_text[quote]]
        a = points[quote + 1]
        b = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        b[ends_text[quote + 1]] = 0
        short = np.isin(a, _SHORT)
        long = np.zeros(len(quote), bool)
        for x, y in _LONG:
            long |= (a == x) & (b == y)
        for chosen, size in ((short, 2), (long & ~short, 3)):
            at = quote[chosen]
            for i in range(1, size):
                edge[at + i] = False
            after = at + size
            edge[after[after < n]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    return PreTokens(points, starts, ends, np.searchsorted(starts, offsets))


def _ranges(kind: int, top: int) -> str:
    """The code points of a class below ``top``, as they stand in brackets."""
    inside = np.zeros(top + 2, np.int8)
    inside[1:-1] = classes()[:top] == kind
    edges = np.flatnonzero(np.diff(inside)).tolist()
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2], strict=True))


@cache
def _pattern(top: int) -> re.Pattern[str]:
    """The pattern for texts whose code points are all below ``top``: the fewer ranges, the faster."""
    letter, number, space = _ranges(LETTER, top), _ranges(NUMBER, top), _ranges(SPACE, top)
    return re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{letter}{number}{space}]+|[{space}]+(?![^{space}])|[{space}]+")


_beyond = re.compile("[\U00010000-\U0010ffff]")


def split(text: str, limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """The pre-tokens of a text in order, in lists of about ``limit`` characters; a longer pre-token makes a longer list."""
    find = _pattern(0x80 if text.isascii() else 0x110000 if _beyond.search(text) else 0x10000).findall
    at, size = 0, limit
    while len(text) - at > size:
        found = find(text, at, at + size)
        if len(found) < 3:
            size *= 2
            continue
        # What follows may change the last two: it lengthens a run, or makes "'r" one with the "e" after it.
        at += size - len(found.pop()) - len(found.pop())
        size = limit
        yield found
    yield find(text, at)
