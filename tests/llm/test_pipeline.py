import random

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from .documents import prose
from .test_jaccard_join import brute
from .test_mixing import poisson


def test_stages_against_brute_force(spark, tmp_path):
    import hashlib
    import math
    from collections import Counter

    rng = random.Random(5)
    items = [(i, prose(rng, 30)) for i in range(3)]
    rows = [(i, prose(rng, rng.randrange(20, 90)), "en", f"s{i % 3}", 0) for i in range(40)]
    rows += [(40, rows[3][1], "en", "s0", 0), (41, rows[4][1] + " more", "en", "s1", 0), (42, f"{prose(rng, 20)} {items[0][1]}", "en", "s1", 0), (43, None, None, None, None), (44, "", "en", "s0", 0), (45, "123 !", None, "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), [rows]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"s{i}"))
        docs = spark.read.parquet(str(tmp_path / f"s{i}"))
        kept.append(sorted(map(tuple, docs.collect())))
    want = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert kept[1] == sorted(want)
    want = [r for r, (k, c, _) in zip(want, brute(want), strict=True) if k == c]
    assert kept[2] == sorted(want)
    want = [r for r in want if r[0] != 42]
    assert kept[3] == sorted(want)
    n = Counter(r[3] for r in want)
    total = sum(math.sqrt(c) for c in n.values())
    copies = []
    for r in want:
        rate = math.sqrt(n[r[3]]) / total * len(want) / n[r[3]]
        copies += [r] * poisson(int(hashlib.md5(f"7:1:{r[0]}".encode()).hexdigest()[:13], 16) / 2**52, rate)
    assert kept[4] == sorted(copies)
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    final = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in final] == [(r[0], len(library.encode(r[1], add_special_tokens=False).ids) + 1) for r in sorted(copies)]
