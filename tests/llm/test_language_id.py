import unicodedata
import zlib
from collections import Counter

from pyspark.sql import functions as F

from treeline.llm import language_id

from .documents import frame


def fold(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = language_id.learn_profiles(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, profiles).filter(language_id.held_out()).select("lang", "lang_pred", "score").collect()
    assert found and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_labels_of_the_held_out_fold_are_not_seen(spark):
    rows = [(i, "alpha beta gamma" if i % 2 else "zzz yyy xxx", "odd" if i % 2 else "even") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spoilt = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("wrong")).otherwise(F.col("lang")))
    learn = lambda d: language_id.learn_profiles(d.filter(~language_id.held_out()))
    assert learn(docs) == learn(spoilt) and set(learn(docs)) == {"odd", "even"}
    assert [r["h"] for r in docs.orderBy("doc_id").select(language_id.held_out().alias("h")).collect()] == [fold(i) for i in range(60)]


def test_difficult_texts(spark):
    docs = frame(spark)
    profiles = language_id.learn_profiles(docs)
    found = language_id.identify(docs, profiles, keep=["doc_id", "text", "k"]).collect()
    assert len(found) == docs.count()
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    assert language_id.identify(docs, {}).filter("lang_pred <> 'und' or score <> 0").count() == 0
    assert language_id.learn_profiles(frame(spark, [])) == {}


def test_out_of_place_distance():
    """Against plain dictionaries."""
    from collections import Counter

    def grams(text):
        out = []
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            padded = f" {word} "
            out += list(word) + [padded[i : i + 2] for i in range(len(padded) - 1)] + [padded[i : i + 3] for i in range(len(padded) - 2)]
        return Counter(out)

    import numpy as np

    points = np.array([ord(c) for c in "the cat, the DOG's cat".lower()], np.uint32)
    found, n = np.unique(language_id._grams(points), return_counts=True)
    key = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    assert dict(zip(found.tolist(), n.tolist())) == {key(g): c for g, c in grams("the cat, the dog's cat").items()}


def plain_grams(text):
    """The n-grams of 1 to 3 letters of each word with a blank on both sides, counted."""
    out = Counter()
    words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
    for w in words:
        padded = f" {w} "
        out.update(w)
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


def ranked(counts, size):
    value = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], value(x[0])))][:size]


def test_predictions_against_plain_dictionaries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    totals = {}
    for r in rows:
        if not fold(r["doc_id"]) and r["lang"] is not None and r["text"] is not None:
            totals.setdefault(r["lang"], Counter()).update(plain_grams(r["text"]))
    size = language_id.PROFILE_SIZE
    places = {lang: {g: i for i, g in enumerate(ranked(c, size))} for lang, c in totals.items()}
    profiles = language_id.learn_profiles(docs.filter(~language_id.held_out()))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, profiles, keep=["doc_id"]).collect()}
    for r in rows:
        own = ranked(plain_grams(r["text"] or ""), language_id.DOCUMENT_SIZE)
        if not own:
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        far = {lang: sum(min(abs(p[g] - i), size) if g in p else size for i, g in enumerate(own)) for lang, p in places.items()}
        best = min(sorted(far), key=far.get)
        assert got[r["doc_id"]][0] == best and abs(got[r["doc_id"]][1] - (1 - far[best] / (size * len(own)))) < 1e-9
