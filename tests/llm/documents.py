"""Small documents with every difficulty: nulls, empty and long texts, copies, near copies, repeated rows, clashing columns."""

import random

WORDS = "the of and in that is was erent thation reand onster ingly houre blent sheat tornd vield quast mopping zerion calden worthy".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, t int, __x string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def documents(seed=1):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(5, 120)) for _ in range(25)]
    passage = prose(rng, 40)
    texts += [texts[0], texts[0], texts[1]]
    for i in (2, 3, 2):
        words = texts[i].split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words) + " tail")
    texts += [f"{prose(rng, 9)} {passage} {prose(rng, 9)}" for _ in range(6)]
    texts += [None, "", " \n\t ", "...", "a", "x" * 3000, "ab" * 2000, prose(rng, 6000), "é ü 🙂 日本語 　 naïve l'été don't '", "one two three", "one two three", "end <|endoftext|> of text"]
    rows = [(i, x, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", None]), len(x or ""), "k", i, "x") for i, x in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, texts[5], "en", "a", 1, None, None, None), (-7, texts[6], None, None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
