"""A run-length compressed Burrows-Wheeler index over many short strings, for streaming windows of a fixed length.

The strings are joined by separators, the suffixes sorted by prefix doubling, and the transform kept as runs: for
each its character, first place, how many of that character come before, and the text position at its end (the
sample). A pattern streams in from its last byte; its interval narrows by two rank queries a byte, on all patterns
at once, and the text position of the interval's last suffix is carried along from the samples. Where ``length`` or more bytes
have matched, the interval's first place tells the group of all suffixes with the same first ``length`` bytes.
"""

from __future__ import annotations

import numpy as np

START = 7  #: symbols of 9 bits in a 63-bit key


class RunLengthIndex:
    def __init__(self, data: np.ndarray, lengths: np.ndarray, labels: np.ndarray, length: int):
        """data: the bytes of all strings end to end; labels: a number for each string, of which a window's group keeps the least."""
        self.length = length
        ends = np.cumsum(lengths)
        self.n = n = len(data) + len(lengths) + 1
        text = np.zeros(n, np.int64)
        text[np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths) + 1] = data.astype(np.int64) + 1
        self.begins = ends - lengths + np.arange(len(lengths)) + 1
        self.small = (text - 1).astype(np.uint8)  # a separator looks like a byte 255, but places come from streaming, which never crosses one
        sa, rank = self._sort(text)
        # Groups: neighbours in suffix order whose first `length` symbols agree, as two overlapping halves of known rank.
        half = START * 4
        window = np.zeros(n, bool)  # windows that end inside their string
        size = np.maximum(lengths - length + 1, 0)
        places = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.begins, size)
        window[places] = True
        second = np.append(rank, np.zeros(length, rank.dtype))[length - half :]
        one, two = rank[sa], second[sa]
        same = np.zeros(n, bool)
        same[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & window[sa[1:]] & window[sa[:-1]]
        self.groups = np.flatnonzero(~same)
        label = np.full(n, np.iinfo(np.int64).max)
        label[places] = np.repeat(labels, size)
        self.least = np.minimum.reduceat(label[sa], self.groups)
        self.last = int(sa[-1])  # where the last of all suffixes begins
        last = text[sa - 1]
        first = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        char, run = last[first], np.diff(np.append(first, n))
        kind = np.int32 if 258 * (n + 1) < 2**31 else np.int64  # narrow numbers keep the tables of a small index in cache
        self.kind = kind
        self.less = np.append(0, np.cumsum(np.bincount(text, minlength=257))).astype(kind)
        order = np.argsort(char, kind="stable")
        self.char, self.first, self.run = char[order], first[order], run[order]
        self.key = self.char * (n + 1) + self.first
        before = np.cumsum(self.run) - self.run
        lead = np.flatnonzero(np.append(True, self.char[1:] != self.char[:-1]))
        self.before = before - np.repeat(before[lead], np.diff(np.append(lead, len(self.char))))
        self.sample = sa[self.first + self.run - 1]
        self.char, self.first, self.run, self.key, self.before, self.sample = (x.astype(kind) for x in (self.char, self.first, self.run, self.key, self.before, self.sample))

    def _sort(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array, and every suffix's rank by its first 4 * START symbols."""
        n = len(text)
        wide = np.append(text, np.zeros(START, np.int64))
        key = np.zeros(n, np.int64)
        for i in range(START):
            key = key << 9 | wide[i : i + n]
        sa = np.argsort(key)
        rank = np.empty(n, np.int64)
        head = np.append(True, key[sa][1:] != key[sa][:-1])
        rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        span, kept = START, None
        while True:
            if span == 4 * START:
                kept = rank.copy()
            ordered = rank[sa]
            tied = np.zeros(n, bool)
            tied[1:] = ordered[1:] == ordered[:-1]
            tied[:-1] |= tied[1:]
            at = np.flatnonzero(tied)
            if not len(at) and kept is not None:
                return sa, kept
            if len(at):
                pos = sa[at]
                after = np.where(pos + span < n, rank[np.minimum(pos + span, n - 1)] + 1, 0)
                key = rank[pos] * (n + 1) + after
                order = np.argsort(key)
                sa[at] = pos[order]
                key = key[order]
                group = rank[sa[at]]
                head = np.append(True, key[1:] != key[:-1])
                rank[sa[at]] = np.where(True, np.maximum.accumulate(np.where(head, at, 0)), group)
            span *= 2

    def _step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Put a symbol before each pattern."""
        base = c * self.kind(self.n + 1)
        out = []
        for p in (lo, hi):
            j = np.searchsorted(self.key, base + p, "left") - 1
            mine = (j >= 0) & (self.char[j] == c)
            out.append(np.where(mine, self.before[j] + np.minimum(p - self.first[j], self.run[j]), 0) + self.less[c])
        inside = hi <= self.first[j] + self.run[j]  # the last suffix of the interval goes on; else the run's end gives a new one
        return out[0], out[1], np.where(inside, at - 1, self.sample[j] - 1)

    def stream(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window of ``length`` bytes of the patterns, in order: the least label of its group (the largest int64, if it occurs nowhere) and a text position where it occurs."""
        size = np.maximum(lengths - self.length + 1, 0)
        out = np.cumsum(size) - size
        least, place = np.full(size.sum(), np.iinfo(np.int64).max), np.full(size.sum(), -1)
        order = np.argsort(-lengths, kind="stable")
        begins, lengths, out, size = begins[order], lengths[order], out[order], size[order]
        lo, hi, at = np.zeros(len(order), self.kind), np.full(len(order), self.n, self.kind), np.full(len(order), self.last, self.kind)
        broken = np.zeros(len(order), bool)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            m = int(np.searchsorted(-lengths, -back, "right"))
            i = lengths[:m] - back
            c = data[begins[:m] + i].astype(self.kind) + self.kind(1)
            lo[:m], hi[:m], at[:m] = self._step(c, lo[:m], hi[:m], at[:m])
            broken[:m] |= lo[:m] >= hi[:m]
            if back >= self.length:
                ok = ~broken[:m]
                group = np.searchsorted(self.groups, lo[:m][ok], "right") - 1
                least[(out[:m] + i)[ok]], place[(out[:m] + i)[ok]] = self.least[group], at[:m][ok]
        if broken.any() and (lengths[broken] > self.length).any():  # a pattern that is nowhere as a whole: window by window
            some = np.flatnonzero(broken)
            count = size[some]
            shift = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            where = np.repeat(out[some], count) + shift
            least[where], place[where] = self.stream(data, np.repeat(begins[some], count) + shift, np.full(len(shift), self.length))
        return least, place

    def occurs(self, place: np.ndarray, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Whether the text at each place has the same ``length`` bytes as data at each begin: the exact check."""
        ok = place >= 0
        for i in range(self.length):
            some = np.flatnonzero(ok)
            ok[some] = self.small[place[some] + i] == data[begins[some] + i]
        return ok
