import hashlib
import random

import numpy as np
import pytest

from treeline.llm import suffix_dedup
from treeline.llm.run_length_index import RunLengthIndex

from .documents import SCHEMA, documents, frame


def brute(rows, n=50):
    known = [r for r in rows if r[0] is not None]
    first = {}
    for r in known:
        b = (r[1] or "").encode()
        for i in range(len(b) - n + 1):
            first[b[i : i + n]] = min(first.get(b[i : i + n], r[0]), r[0])
    out = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1) if r[0] is not None else ():
            if first[b[i : i + n]] < r[0]:
                gone[i : i + n] = True
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((r[0], len(b), int(gone.sum()), int(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [{}, {"CHUNK": 2000, "PART": 3000, "INDEXED": 4000}, {"CHUNK": 1500, "PART": 20000, "SPREAD": 1}])
def test_against_brute_force(spark, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    rows = documents()
    rng = random.Random(4)
    for i in range(100, 130):  # pieces of others, some just too short, and periodic text
        a, b = rng.choice(rows)[1] or "", rng.choice(rows)[1] or ""
        rows.append((i, a[: rng.randrange(40, 70)] + "|" + b[-rng.randrange(40, 300) :] + "xy" * rng.randrange(80), "en", "a", 1, "k", 1, "x"))
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_hashes_that_meet_change_nothing(monkeypatch):
    real = suffix_dedup.Stretches._hashes
    monkeypatch.setattr(suffix_dedup.Stretches, "_hashes", staticmethod(lambda *a: real(*a) % np.uint64(3)))
    chunk = suffix_dedup.Chunk(np.array([5, 6, 7]), np.ones(3, bool), np.array([0, 60, 120, 180]), np.frombuffer((b"q" * 30 + b"r" * 30) + (b"s" * 60) + (b"q" * 30 + b"r" * 30), np.uint8))
    begin, size = np.array([0, 60, 120]), np.full(3, 60)
    assert suffix_dedup._unlike_first(chunk.data, begin, begin + size, np.array([True, False, False])).tolist() == [False, True, True]
    # All stretches in one group of one index, with equal hashes for a third of them.
    windows = size - suffix_dedup.LENGTH + 1
    least = suffix_dedup._indexed(np.zeros(3, np.int64), windows, chunk.ids, chunk.data)
    assert least.tolist() == [5] * 11 + [6] * 11 + [5] * 11
    text = {r[0]: (r[1] or "").encode() for r in documents()}
    ids = np.array(sorted(k for k in text if k is not None))
    body = [text[i] for i in ids]
    whole = suffix_dedup.Chunk(ids, np.ones(len(ids), bool), np.append(0, np.cumsum([len(b) for b in body])), np.frombuffer(b"".join(body), np.uint8))
    sent = suffix_dedup.Sent(whole, 1)
    have = suffix_dedup.Stretches(whole, sent, np.where(sent.several, suffix_dedup.SHARED, suffix_dedup.ALONE), 1)
    data = suffix_dedup._bytes_of(whole.data, have.begin, have.windows + suffix_dedup.LENGTH - 1)
    least = suffix_dedup._indexed(have.number, have.windows, have.least, data)
    origin = np.cumsum(have.windows) - have.windows
    first = {}
    for i, b in zip(ids, body, strict=True):
        for s in range(len(b) - suffix_dedup.LENGTH + 1):
            first.setdefault(b[s : s + suffix_dedup.LENGTH], int(i))
    for place, which in zip(have.place, have.which, strict=True):
        for s in range(have.windows[which]):
            window = whole.data[place + s : place + s + suffix_dedup.LENGTH].tobytes()
            assert least[origin[which] + s] == first[window]


def test_no_documents(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_kept_bytes(spark):
    rows = [(i, "q" * 60 + str(i), "en", "a", 1, "k", 1, "x") for i in range(2)]
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(frame(spark, rows), texts=True).collect()}
    assert got == {0: b"q" * 60 + b"0", 1: b"1"}


def test_index_streams_windows():
    rng = random.Random(3)
    for _ in range(10):
        base = "".join(rng.choice("ab") for _ in range(200))
        strings = sorted({base[s : s + rng.randint(50, 76)] for s in range(0, 120, 3)})
        labels = np.array([rng.randint(0, 1000) for _ in strings])
        flat = lambda x: (np.frombuffer("".join(x).encode(), np.uint8), np.array([len(s) for s in x]))
        index = RunLengthIndex(*flat(strings), labels, 50)
        assert len(index.run) < index.n  # runs are fewer than suffixes in repetitive text
        patterns = [*strings, strings[0][:30] + "zz" + strings[0], base[:90], "q" * 55]
        data, lengths = flat(patterns)
        begins = np.cumsum(lengths) - lengths
        least, place = index.stream(data, begins, lengths)
        windows = [(p[i : i + 50], b + i) for p, b in zip(patterns, begins, strict=True) for i in range(len(p) - 49)]
        assert least.tolist() == [min([int(l) for s, l in zip(strings, labels, strict=True) if w in s], default=suffix_dedup.NOWHERE) for w, _ in windows]
        assert index.occurs(place, data, np.array([b for _, b in windows])).tolist() == [any(w in s for s in strings) for w, _ in windows]
