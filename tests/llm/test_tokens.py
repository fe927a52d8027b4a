import json
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from treeline.llm import pretokens, token_counts, token_store
from treeline.llm.pretokens import cut, split

from .documents import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aé'strevlmd  \n\t1²!.　\x1c🙂", max_size=30), max_size=4))
def test_pretokens_are_those_of_the_pattern(texts):
    found, pattern = cut(texts), regex.compile(public_tokenizers.PATTERN)
    for i, t in enumerate(texts):
        assert [found.text(j) for j in range(found.first[i], found.first[i + 1])] == pattern.findall(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aé'strevlmd  \n\t1²!.\u3000\x1c🙂𝐀𝟏", max_size=30), st.integers(1, 9))
def test_pretokens_of_a_text_in_pieces_are_those_of_the_pattern(text, limit):
    assert [x for found in split(text, limit) for x in found] == regex.findall(public_tokenizers.PATTERN, text)


def test_every_code_point_is_in_the_same_class_alone_and_in_arrays():
    text = "".join(f"{chr(i)}a1.{chr(i)} {chr(i)}" for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    for some in (text[: 7 * 0x80], text[: 7 * 0xF800], text):
        found = cut([some])
        assert [x for part in split(some) for x in part] == [some[a:b] for a, b in zip(found.starts.tolist(), found.ends.tolist(), strict=True)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_counts_and_ids_are_those_of_the_library(texts):
    library = Tokenizer.from_file(PATH) if not hasattr(test_counts_and_ids_are_those_of_the_library, "t") else test_counts_and_ids_are_those_of_the_library.t
    test_counts_and_ids_are_those_of_the_library.t = library
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert token_counts._counter(PATH).texts(texts).tolist() == [len(x) for x in ids]
    assert [x.tolist() for x in token_store._encoder(PATH).texts(texts)] == ids


def test_hashes_that_meet_change_nothing(library, monkeypatch):
    real = pretokens.span_hashes
    monkeypatch.setattr(pretokens, "span_hashes", lambda *a: real(*a) % np.uint64(13))
    texts = [r[1] for r in documents() if r[1]]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    counter, encoder = token_counts.Counter(PATH), token_store.Encoder(PATH)
    for some in (slice(0, 20), slice(0, None), slice(20, None), slice(5, 9)):  # a table that is empty, then one that holds others of the same hashes
        assert counter.texts(texts[some]).tolist() == [len(x) for x in ids[some]]
        assert [x.tolist() for x in encoder.texts(texts[some])] == ids[some]


@pytest.mark.parametrize("limit", ["KEPT", "POINTS"])
def test_a_full_table_starts_again(library, monkeypatch, limit):
    monkeypatch.setattr(token_counts if limit == "KEPT" else pretokens.Known, limit, 50)
    texts = [r[1] for r in documents() if r[1]]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    counter, encoder = token_counts.Counter(PATH), token_store.Encoder(PATH)
    for i in range(0, len(texts), 3):
        assert counter.texts(texts[i : i + 3]).tolist() == [len(x) for x in ids[i : i + 3]]
        assert [x.tolist() for x in encoder.texts(texts[i : i + 3])] == ids[i : i + 3]


def test_count_tokens(spark, library):
    rows = documents()
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(frame(spark), PATH).collect())
    want = sorted((r[0] is not None, r[0] or 0, len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert got == want
    assert token_counts.count_tokens(frame(spark, []), PATH).count() == 0


def test_store_round_trip(spark, library):
    rows = sorted(documents(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    manifest = token_store.write_shards(frame(spark), PATH)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_store.read_digests(manifest).collect())
    want, start = [], 0
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((start, r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_store.read_digests(token_store.write_shards(frame(spark, []), PATH)).count() == 0


def test_store_lookup(spark, library, tmp_path):
    writer = token_store.ShardWriter(2)
    docs = {i: np.arange(i % 50, dtype=np.uint32) for i in range(-3000, 3000, 3)}
    body = b"".join(writer.add(token_store.key_of(i), x) for i, x in sorted(docs.items())) + writer.end()
    (tmp_path / "s.sst").write_bytes(body)
    reader = token_store.ShardReader(str(tmp_path / "s.sst"))
    assert len(reader.blocks) > 1
    for i in range(-3000, 3000):
        found = reader.get(i)
        assert (found is None) == (i not in docs) and (found is None or found.tolist() == docs[i].tolist())
    assert [token_store.id_of(k) for k, _ in reader.scan()] == sorted(docs)
    with pytest.raises(ValueError):
        writer.add(token_store.key_of(-9999), docs[0])


def test_encoding_costs_little_beside_the_library(library):
    rng = random.Random(3)
    syllables = [a + b + c for a in "bdfglmnprst" for b in "aeiou" for c in "nrstl"]
    often = ["".join(rng.choices(syllables, k=2)) for _ in range(2000)]
    text = [" ".join("".join(rng.choices(syllables, k=4)) if rng.random() < 0.09 else rng.choice(often) for _ in range(400)) for _ in range(500)]
    token_store.Encoder(PATH).texts(text[:1])
    took = {"own": [], "library": []}
    for _ in range(3):
        encoder = token_store.Encoder(PATH)
        for name, f in (("own", encoder.texts), ("library", lambda x: [library.encode(t, add_special_tokens=False).ids for t in x])):
            start = time.process_time()
            f(text)
            took[name].append(time.process_time() - start)
    assert min(took["own"]) < 0.33 * min(took["library"]), took


def test_the_table_of_ids_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_store.KnownIds, "KEPT", 10)
    encoder = token_store.Encoder(PATH)
    for i in range(100):
        texts = [f"again x{'y' * i}", "z" * 500]
        assert [x.tolist() for x in encoder.texts(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.known) <= 10 and max(map(len, encoder.known)) <= 64


@pytest.mark.parametrize("change", [{"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}, {"truncation": {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}}])
def test_other_vocabularies(tmp_path, change):
    with open(PATH, encoding="utf-8") as f:
        (tmp_path / "v.json").write_text(json.dumps(json.load(f) | change), encoding="utf-8")
    own = Tokenizer.from_file(str(tmp_path / "v.json"))
    own.no_truncation()
    texts = ["one two  three four's", "x <|endoftext|> of a text", ""]
    assert [x.tolist() for x in token_store.Encoder(str(tmp_path / "v.json")).texts(texts)] == [own.encode(t, add_special_tokens=False).ids for t in texts]
