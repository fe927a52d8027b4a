import hashlib
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from treeline.llm import mixing

from .documents import documents, frame


def poisson(u, rate):
    k, p, c = 0, math.exp(-rate), math.exp(-rate)
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


@pytest.mark.parametrize(("weights", "budget"), [(None, None), ({"a": 0.2, "b": 0.8, "gone": 3.0}, 2000.0), ({}, None)])
def test_against_brute_force(spark, weights, budget):
    rows = documents()
    n = Counter(r[3] for r in rows)
    w = {s: math.sqrt(c) if weights is None else weights.get(s, 0.0) if s else 0.0 for s, c in n.items()}
    total = sum(w.values())
    want = Counter()
    for r in rows:
        rate = w[r[3]] / total * (budget or len(rows)) / n[r[3]] if total else 0.0
        parts = max(1, math.ceil(rate / mixing.STEP))
        count = 0
        for i in range(1, parts + 1):
            h = hashlib.md5(f"7:{i}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()
            count += poisson(int(h[:13], 16) / 2**52, rate / parts)
        for c in range(count):
            want[r[0], r[1], c, count] += 1
    got = Counter((r["doc_id"], r["text"], r["__mix_copy"], r["__mix_n"]) for r in mixing.replicate(frame(spark), weights, budget=budget).collect())
    assert got == want


def test_shares_are_close_to_the_targets(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "case when id % 10 = 0 then 'b' else 'a' end as source")
    n = Counter(r["source"] for r in mixing.replicate(docs, {"a": 1.0, "b": 1.0}, budget=8000.0).collect())
    assert abs(n["a"] - 4000) < 300 and abs(n["b"] - 4000) < 300


def test_columns_and_empty_table(spark):
    docs = frame(spark)
    assert mixing.replicate(docs).drop("__mix_copy", "__mix_n").columns == docs.columns
    assert mixing.replicate(frame(spark, [])).count() == 0


def test_sql_agrees(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{path}'")
    want = sorted(c.sql(f"select doc_id, copy, n_copies from ({mixing.REPLICATE_SQL})").fetchall())
    got = mixing.replicate(spark.read.parquet(path)).select("doc_id", "__mix_copy", "__mix_n").collect()
    assert sorted(map(tuple, got)) == want


def test_sql_agrees_on_repeated_and_null_ids(spark, tmp_path):
    docs = frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs.union(docs.filter("doc_id > 3")).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = Counter(c.sql(f"select doc_id, text, copy, n_copies from ({mixing.REPLICATE_SQL})").fetchall())
    got = mixing.replicate(spark.read.parquet(str(tmp_path / "documents.parquet"))).select("doc_id", "text", "__mix_copy", "__mix_n").collect()
    assert Counter(map(tuple, got)) == want


def test_clashing_names_and_rows_without_ids(spark):
    names = ["doc_id", "source", "__mix_n0", "__mix_source", "__mix_place", "__mix_cdf", "__mix_parts", "__mix_rows", "__mix_rate"]
    docs = spark.range(4000).selectExpr("cast(null as long) as doc_id", "'a' as source", *[f"id as {x}" for x in names[2:]])
    made = mixing.replicate(docs, budget=12000.0)
    assert made.columns == [*names, "__mix_copy", "__mix_n"]
    where = Counter(r[0] for r in made.select(F.spark_partition_id()).collect())
    assert len(where) > 1 or made.rdd.getNumPartitions() == 1
    assert max(where.values()) < 0.9 * sum(where.values()) or len(where) == 1
