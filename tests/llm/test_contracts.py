"""The registered queries on a whole small table: their columns, folds and digests."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from treeline.llm import queries

from .test_pii import base

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ann": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op3_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op4_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op5_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op9_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10_token_store": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def run(spark, name):
    made = queries.QUERIES[name](spark, SF)
    assert {k: dict(made.dtypes)[k] for k in COLUMNS[name]} == COLUMNS[name]
    return made.collect()


def test_nearest(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    v, ids = np.array(table["embedding"].to_pylist(), np.float64), table["vec_id"].to_numpy()
    place = {i: n for n, i in enumerate(ids)}
    got = {}
    for r in run(spark, "op1_ann"):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - v[place[q]] @ v[place[i]]) < 1e-12 for _, i, s in found)
        score = v @ v[place[q]]
        hits += len({i for _, i, _ in found} & set([i for i in ids[np.lexsort((ids, -score))] if i != q][:20]))
    assert hits >= 0.97 * 20 * len(got)


def test_repeats(spark, texts):
    first = {}
    raw = {i: t.encode() for i, t in texts.items()}
    for i in sorted(raw):
        for a in range(len(raw[i]) - 49):
            first.setdefault(raw[i][a : a + 50], i)
    for r in run(spark, "op3_suffix_dedup"):
        b = raw[r["doc_id"]]
        gone = np.zeros(len(b) + 1, bool)
        for a in range(len(b) - 49):
            if first[b[a : a + 50]] < r["doc_id"]:
                gone[a : a + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_archives(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = run(spark, "op4_warc")
    assert len(got) == len(pages)
    for r in got:
        body = pages[r["page_id"]]
        lead = first[body]
        want = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if lead == r["page_id"] else "revisit", None if lead == r["page_id"] else lead)
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == want


def test_personal_data(spark, texts):
    for r in run(spark, "op5_pii"):
        want = base(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{b}:{e}" for k, b, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == x for x, *_ in want) for k in ("email", "ip", "card", "phone"))


def test_tokens(spark, texts):
    own = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    own.no_truncation()
    own.no_padding()
    ids = {i: own.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    for r in run(spark, "op7_token_counts"):
        n = len(ids[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)
    start = 0
    for r in sorted(run(spark, "op10_token_store"), key=lambda r: r["doc_id"]):
        mine = [*ids[r["doc_id"]], 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(mine), zlib.crc32(np.array(mine, "<u4").tobytes()))
        start += len(mine)


def test_languages(spark, texts):
    known = set(pq.read_table(f"{SF}/documents.parquet")["lang"].to_pylist()) - {None}
    got = run(spark, "op9_language_id")
    assert len(got) == len(texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in known | {"und"} and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[r["doc_id"]]))


def test_near_duplicates_and_contamination(spark, texts):
    got = queries.op6_jaccard_join(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts) and all(r["class_id"] <= r["doc_id"] for r in got)
    same = {}
    for r in got:
        same.setdefault(texts[r["doc_id"]], set()).add(r["class_id"])
    assert all(len(classes) == 1 for t, classes in same.items() if t.strip())
    found = queries.op8_decontamination(spark, SF).collect()
    items = {r["item_id"]: r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert verbatim <= {(r["doc_id"], r["item_id"]) for r in found}
