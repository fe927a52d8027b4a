import re
from collections import Counter

import numpy as np
import pytest

from treeline.llm import components, jaccard_join

from .documents import SCHEMA, documents, frame


def grams(text, size=5):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows):
    """class and links of every row, by comparing all rows."""
    sets = [grams(r[1]) if r[0] is not None else frozenset() for r in rows]
    group, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both >= 0.8 * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                group[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], least.get(find(i)) if r[0] is not None else None, links[i]) for i, r in enumerate(rows)]


def test_against_brute_force(spark):
    got = Counter(tuple(r) for r in jaccard_join.near_duplicates(frame(spark)).collect())
    assert got == Counter(brute(documents()))


@pytest.mark.parametrize("block", [4, 256])
def test_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        own = words[:]
        own[i * 3] = f"changed{i}"
        rows.append((i, " ".join(own), "en", "a", 1, "k", 1, "x"))
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted(brute(rows)) and got[5][2] == 39


def test_chain_and_blocks_by_weight(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "WEIGHT", 250)
    monkeypatch.setattr(components, "HUB", 3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100]), "en", "a", 1, "k", 1, "x") for i in range(40)]
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted(brute(rows)) and {r[1] for r in got} == {0} and max(r[2] for r in got) < 10


def test_one_id_with_many_rows(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:i], f"c{i}", *words[i + 1 :]]) for i in range(12)]
    rows = [(7, t, "en", "a", 1, "k", 1, "x") for t in texts * 20] + [(i, texts[i % 12], "en", "a", 1, "k", 1, "x") for i in range(100, 110)]
    got = Counter(tuple(r) for r in jaccard_join.near_duplicates(frame(spark, rows)).collect())
    assert got == Counter(brute(rows))


def test_keep_one(spark):
    rows = documents()
    unique = [r for r in rows if r[0] is not None and r[0] != 4]
    kept = {r["doc_id"] for r in jaccard_join.keep_one(frame(spark, unique)).collect()}
    assert kept == {k for (k, c, _), r in zip(brute(unique), unique, strict=True) if k == c or not grams(r[1])}
    out = jaccard_join.keep_one(frame(spark))  # with repeated and null ids
    assert out.columns == frame(spark).columns
    some = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sum(k == 4 for k, _ in some) == 1 and (None, rows[5][1]) in some and len(some) == len(kept) + 2
    assert jaccard_join.keep_one(frame(spark, [])).count() == jaccard_join.near_duplicates(frame(spark, [])).count() == 0


def test_one_id_with_different_texts(spark):
    rows = [(1, "a b c d e f g", "en", "a", 1, "k", 1, "x"), (1, "h i j k l m n", "en", "a", 1, "k", 1, "x"), (2, "h i j k l m n", "en", "a", 1, "k", 1, "x")]
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(frame(spark, rows)).collect())
    assert got == [(1, 1, 0), (1, 1, 1), (2, 1, 1)]
    assert sorted((r["doc_id"], r["text"][0]) for r in jaccard_join.keep_one(frame(spark, rows)).collect()) == [(1, "a"), (1, "h")]


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard_join.least_matches(0.8)
    assert all(0 < m < 0.8 * n for n, m in least.items())
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1000, np.uint64)
    near = np.append(base[:900], rng.integers(0, 1 << 63, 100, np.uint64))
    far = np.append(base[:300], rng.integers(0, 1 << 63, 700, np.uint64))
    a, b, c = (jaccard_join.signature(np.unique(x))[None] for x in (base, near, far))
    assert len(jaccard_join.surviving(a, b, 0.8)) == 1 and len(jaccard_join.surviving(a, c, 0.8)) == 0


@pytest.mark.parametrize("hub", [3, 256])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB", hub)
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (7, 7)] + [(200, x) for x in range(201, 230)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, **{i: 200 for i in range(200, 230)}}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
