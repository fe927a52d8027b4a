import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from treeline.llm import ann


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(rng.standard_normal((900, 24)).astype(np.float32))]
    rows += [(2000 + i, rows[7][1], 2) for i in range(60)]  # one very common vector
    rows += [(5000, None, 0), (5020, [0.0] * 24, 0), (5040, [float("nan")] * 24, 0), (5060, [1.0, None] * 12, 0), (5080, [float("inf")] * 24, 0), (5100, [1.0] * 7, 0), (None, rows[1][1], 0), rows[40]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ok = {r[0]: np.array(r[1], np.float64) for r in rows if r[0] is not None and r[1] and len(r[1]) == 24 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])}
    assert set(got) == {i for i in ok if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        want = sorted((-float((v * ok[q]).sum()), i) for i, v in ok.items() if i != q)[:20]
        assert [f[0] for f in found] == list(range(1, 21))
        hits += len({i for _, i in want} & {f[1] for f in found})
        assert np.allclose([f[2] for f in found], sorted([float(ok[q] @ ok[f[1]]) for f in found], reverse=True))
    assert hits >= 0.97 * 20 * len(got)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (20, [0.5, 0.5])], schema)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()] == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ann.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(few.filter("vec_id = 1"), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((500, 64)), rng.standard_normal((40, 64))
    codes = ann.Codes(x, x.mean(axis=0), ann.rotation(64, 3))
    about, wrong = codes.estimate(q)
    assert (np.abs(about - q @ x.T) <= wrong).mean() > 0.97


def test_recall_and_reranked_share(monkeypatch):
    """Recall against brute force, and the share of pairs whose scores are computed, on a whole table."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    v, ids = np.array(table["embedding"].to_pylist(), np.float64), table["vec_id"].to_numpy()
    asked = ids % 20 == 0
    picked = []
    union = np.union1d
    monkeypatch.setattr(np, "union1d", lambda a, b: picked.append(len(union(a, b))) or union(a, b))
    found = ann.nearest_in_block(ids[asked], v[asked], [np.array([i]) for i in ids], v, 20, v.mean(axis=0), ann.rotation(v.shape[1], 11))
    hits = 0
    for q in ids[asked]:
        score = v @ v[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -score))] if i != q][:20]
        hits += len({i for a, i, _ in found if a == q} & set(best))
    recall, share = hits / (20 * asked.sum()), sum(picked) / (asked.sum() * len(v))
    print(f"recall {recall:.4f}, reranked {share:.3f}")
    assert recall >= 0.97 and share < 0.5
