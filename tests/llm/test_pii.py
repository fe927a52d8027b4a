import bisect
import random
import re
from itertools import accumulate

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from treeline.llm import pii

from .documents import frame

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    fine = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")), "card": lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda m: 8 <= len(digits(m)) <= 15}
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if fine[k](m.group())]


TEXTS = [
    None, "", "a@b.c", "x@y.z@w.v", "a@b.c_d@e.f", "🙂 é mail: jo.e+1@mail-1.example.co.uk, é 10.0.0.255!", "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1 1.2.3",
    "card 4539 1488 0343 6467 4539148803436467 4539-1488-0343-6468 12 34", "call +1 (377) 555-0271 or (377) 555-0272, + 1 2, +12 3 4 5 6 7 8    ", "9" * 5000, "a" * 20000, "1 " * 5000, "a.b@" * 2000 + "c.d", "+1" * 500,
    "4465758382889437 4465758382889437", "user [at] example [dot] com; user at example dot com; look at it. there",
]


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, k int")
    for r in pii.find_personal_data(docs).collect():
        text = texts[r["doc_id"]] or ""
        want = base(text)
        assert [tuple(x) for x in r["base"]] == want, text[:100]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        spans = [tuple(x) for x in r["spans"]]
        assert set(want) <= set(spans) and spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), x[1]))


def test_base_spans(spark):
    check(spark, TEXTS)


def test_random_texts(spark):
    found: list[str] = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text(alphabet="ab@.%+- 0123456789()é🙂", max_size=60))
    def gather(t):
        found.append(t)

    gather()
    check(spark, found)


def test_documents_without_personal_data_have_no_spans(spark):
    assert pii.find_personal_data(frame(spark)).filter("size(spans) > 0").count() == 0
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_weak_labels_find_more(spark):
    texts = ["please call 377 555 0272 or (377) 555-0273 at work"] * 5 + ["+1 377 555 0271"] * 40 + ["write to user [at] example [dot] com"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in pii.find_personal_data(docs).collect()}
    assert found[0] == [("phone", 12, 24), ("phone", 28, 42)] and found[10] == [("phone", 0, 15)]
    assert found[45] == [("email", 9, 36)]


#: Loose shapes with the answer that a reader would give; what overlaps a base span is no span of its own.
LOOSE = [
    ("phone: 377-555-0272", ["377-555-0272"]),
    ("fax 377.555.0272", ["377.555.0272"]),
    ("(377) 555-0272", ["(377) 555-0272"]),
    ("write to jo.e(at)mail.example(dot)org", ["jo.e(at)mail.example(dot)org"]),
    ("carte 1 4539148803436467", ["4539148803436467"]),
    ("+1 (377) 555-0272", ["+1 (377) 555-0272"]),
    ("order 377 555-0272", []),
    ("part 377-555-0272 of the invoice", []),
    ("377-911-0272", []),
    ("222-222-2222 serial", []),
    ("we met at noon dot dot", []),
    ("look at it dot there", []),
    ("carte 1 4539148803436468", []),
    ("tracking 1 9139148803436461", []),
]


def test_the_classifier_accepts_and_rejects(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LOOSE * 4)], "doc_id long, text string")
    for r in pii.find_personal_data(docs).collect():
        text, want = LOOSE[r["doc_id"] % len(LOOSE)]
        assert [text[x["start"] : x["end"]] for x in r["spans"]] == want, text
    luhn_fails = base("9139148803436461")
    assert not luhn_fails


def test_many_matches_in_one_text(spark):
    rng = random.Random(3)
    some = ["a@b.c", "1.2.3.4", "+1 377 555 0271", "377-555-0273", "4539148803436467", "4539148803436467 1 4539148803436467", "é", "x [at] y.org"]
    text = " , ".join(rng.choice(some) for _ in range(9000))  # more than two levels of running sums
    check(spark, [text, "1.2.3.4 , " * 70])
    r = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    fixed = [tuple(x) for x in r["base"]]
    added = [tuple(x) for x in r["spans"] if tuple(x) not in set(fixed)]
    assert added and {text[b:e] for _, b, e in added} <= {"377-555-0273", "4539148803436467", "x [at] y.org"}
    edges = sorted((b, e) for _, b, e in fixed)
    at = [b for b, _ in edges]
    for _, b, e in added:
        i = bisect.bisect_left(at, e)
        assert all(y <= b for _, y in edges[max(0, i - 3) : i])
    assert sum(k == "phone" and text[b:e] == "377-555-0273" for k, b, e in added) == text.count("377-555-0273")


def test_running_values(spark):
    rng = random.Random(1)
    rows = [(n, [rng.randrange(100) for _ in range(n)]) for n in (1, 63, 64, 65, 128, 4095, 4096, 4097, 9000)]
    plus, most = (lambda x, y: x + y), (lambda x, y: F.greatest(x, y))
    done = spark.createDataFrame(rows, "n int, v array<int>").select("v", pii.running(F.col("v"), plus, F.lit(5)).alias("s"), pii.running(F.col("v"), most, F.lit(0)).alias("m"))
    for r in done.collect():
        assert r["s"] == list(accumulate(r["v"][:-1], initial=5))
        assert r["m"] == list(accumulate(r["v"][:-1], max, initial=0))


def test_estimation_prefers_reliable_labelers():
    good, bad = (1, 1, 0, 0, 1, 0), (-1, 0, -1, -1, -1, -1)
    reliable, weights = pii.estimate([("card", good, False, 900), ("card", bad, False, 900)])
    score = lambda votes: sum(w * v for w, v in zip(weights["card"], [1.0, *map(float, votes)], strict=True))
    assert score(good) > 2.2 and score(bad) < -2.2 and all(0.5 < a < 1 for a in reliable["card"].values())
    assert weights["ip"][0] == 0 and all(w > 0 for w in weights["ip"][1:])
