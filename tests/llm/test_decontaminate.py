import datetime
import random

import numpy as np
import pytest

from treeline.llm import decontaminate
from treeline.llm.text_arrays import Words

from .documents import documents, frame, prose


def cases():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice([15, 30, 50, 120]))) for i in range(12)] + [(90, None), (91, ""), (92, "two words")]
    rows = documents()
    planted = set()
    for i in range(12):
        words = items[i][1].split()
        whole = f"{prose(rng, 70)} {items[i][1]} {prose(rng, 50)}"
        changed = [w for j, w in enumerate(words) if j % 6 or j > len(words) - 7]  # a paraphrase that keeps its end
        rows.append((1000 + i, whole.upper(), "en", "a", 1, "k", 1, "x"))
        rows.append((2000 + i, f"{prose(rng, 33)} {' '.join(changed)} {prose(rng, 80)}", "en", "a", 1, "k", 1, "x"))
        rows.append((3000 + i, f"{prose(rng, 60)} {' '.join(words[: len(words) // 4])} {prose(rng, 60)}", "en", "a", 1, "k", 1, "x"))
        planted |= {(1000 + i, i), (2000 + i, i)}
    return rows, items, planted


def test_planted_items_are_found_and_no_others(spark):
    rows, items, planted = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(frame(spark, rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert all(0.5 <= r["lcs_ratio"] <= 1 for r in found)
    clean = decontaminate.without_contaminated(frame(spark, rows), benchmark)
    assert clean.columns == frame(spark).columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -99 for r in clean.collect()) == sorted(-99 if r[0] is None else r[0] for r in rows if not 1000 <= (r[0] or 0) < 3000)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert decontaminate.contaminated(frame(spark), none).count() == 0
    assert decontaminate.without_contaminated(frame(spark), none).count() == frame(spark).count()
    assert decontaminate.contaminated(frame(spark, []), some).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    rows, items, planted = cases()
    monkeypatch.setattr(decontaminate, "ITEMS", 5)
    found = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 90))] for _ in range(2))
        table = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, table[j + 1] = table[j + 1], last + 1 if x == y else max(table[j + 1], table[j])
        assert decontaminate.common_subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == table[-1]


def rows_of(texts):
    return [(i, t, "en", "a", 1, "k", 1, "x") for i, t in enumerate(texts)]


def paraphrase(item):
    """Keeps the end of the item and no 8 words in a row."""
    words = item.split()
    return " ".join(w for j, w in enumerate(words) if j % 6 or j > len(words) - 6)


@pytest.mark.parametrize("copies", ["document", "passage"])
def test_an_item_in_a_third_of_the_rows_is_found_elsewhere(spark, copies):
    rng = random.Random(4)
    items = [(i, prose(rng, 30)) for i in range(6)]
    hot = f"{prose(rng, 20)} {items[0][1]} {prose(rng, 20)}"
    texts = [prose(rng, 80) for _ in range(200)]
    texts += [hot if copies == "document" else f"{prose(rng, 20)} {items[0][1]} {prose(rng, 20)}" for _ in range(120)]
    want = {(k, 0) for k in range(200, 320)}
    for k in range(40):
        item = items[k % 6 if k < 12 else 0]
        want.add((len(texts), item[0]))
        texts.append(f"{prose(rng, 33)} {paraphrase(item[1]) if k % 2 else item[1]} {prose(rng, 31)}")
    found = decontaminate.contaminated(frame(spark, rows_of(texts)), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_every_item_is_in_the_basis(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SAMPLE", 4, raising=False)
    rng = random.Random(6)
    items = [(i, " ".join(f"only{i}x{rng.randrange(40)}" for _ in range(30))) for i in range(40)]
    texts = [prose(rng, 80) for _ in range(60)] + [f"{prose(rng, 33)} {paraphrase(t)} {prose(rng, 31)}" for _, t in items]
    found = decontaminate.contaminated(frame(spark, rows_of(texts)), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(60 + i, i) for i in range(40)}


def test_short_items_are_found(spark):
    rng = random.Random(8)
    items = [(10 * n + j, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(40)}zz" for _ in range(n))) for n in range(1, 16) for j in range(4)]
    texts = [prose(rng, 80) for _ in range(60)] + [f"{prose(rng, 41)} {t} {prose(rng, 38)}" for _, t in items]
    found = decontaminate.contaminated(frame(spark, rows_of(texts)), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["lcs_ratio"] for r in found.collect()}
    want = {(60 + k, i) for k, (i, _) in enumerate(items)}
    held = {(d, i) for d, t in enumerate(texts) for i, x in items if f" {x} " in f" {t} "}
    assert want <= held <= set(found)
    assert all(found[pair] == 1 for pair in held)


@pytest.mark.parametrize("copies", [1, 5])
@pytest.mark.parametrize("form", [str, paraphrase])
def test_a_table_of_one_text(spark, copies, form):
    item = prose(random.Random(3), 30)
    docs = frame(spark, rows_of([form(item)] * copies))
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(k, 7) for k in range(copies)]
    assert decontaminate.without_contaminated(docs, benchmark).count() == 0


def test_recall_against_all_windows(spark):
    """Every item against every window of the shorter documents, and of paraphrases planted into them."""
    rng = random.Random(12)
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r["text"] and len(r["text"]) < 2000][:60]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    for k in range(60):
        words, host = items[k % len(items)][1].split(), docs[k % 40].split()
        n, at = rng.choice([3, 4, 5, 8]), rng.randrange(len(host) + 1)
        changed = [w if j % n or j > len(words) - 7 else rng.choice(["", "indeed", "quoth"]) for j, w in enumerate(words)]
        docs.append(" ".join([*host[:at], *changed, *host[at:]]))
    texts = Words(docs)
    wanted = set()
    for i, text in items:
        item = Words([text]).hashes
        for d in range(len(docs)):
            own = texts.of(d)
            if len(np.intersect1d(own, item)) < decontaminate.PARAPHRASE * len(np.unique(item)) * 0.5:
                continue
            width = len(item) + len(item) // 2
            if any(decontaminate.Matcher.decide(item, own[a : a + width]) for a in range(0, max(1, len(own) - len(item) // 2), max(1, len(item) // 8))):
                wanted.add((d, i))
    found = decontaminate.contaminated(frame(spark, rows_of(docs)), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in found}
    print(f"{len(wanted)} by brute force, recall {len(found & wanted) / len(wanted):.3f}, {len(found - wanted)} more")
    assert len(wanted) >= 40 and len(found & wanted) >= 0.9 * len(wanted) and len(found - wanted) <= 0.05 * len(wanted)


def test_item_ids_of_other_types(spark):
    rows, items, planted = cases()
    for kind, make in (("int", int), ("date", lambda i: datetime.date(2000, 1, 1) + datetime.timedelta(i)), ("string", str)):
        benchmark = spark.createDataFrame([(make(i), t) for i, t in items], f"item_id {kind}, text string")
        found = decontaminate.contaminated(frame(spark, rows), benchmark).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, make(i)) for d, i in planted}
