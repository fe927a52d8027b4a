import struct
import zlib

import pytest
from pyspark.sql import functions as F

from treeline.operators import art, delta, digest, gates, overlay, release, state, statistics, story
from treeline.sources.tree import of_files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def col(spark, values, name="bundle"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


# --- overlay


def test_overlay_of_trees(spark):
    base = of_files(spark, {"a.json": b'{"v":1}', "old.json": b'{"v":1}', "same.json": b"1"}).filter("not is_dir")
    fresh = of_files(spark, {"a.json": b'{"v":2}', "new.json": b'{"v":3}', "same.json": b"1"}).filter("not is_dir")
    merged = overlay.overlay(base, fresh, size="size")
    got = {r["path"]: (r["status"], bytes(r["content"])) for r in merged.collect()}
    assert got == {"a.json": ("changed", b'{"v":2}'), "new.json": ("added", b'{"v":3}'), "old.json": ("kept", b'{"v":1}'), "same.json": ("unchanged", b"1")}
    assert overlay.merge_stats(merged).first().asDict() == {"added": 1, "changed": 1, "unchanged": 1, "kept_from_baseline": 1}
    again = overlay.overlay(merged.drop("status"), fresh, size="size")  # laying it over twice changes nothing
    assert rows(again.select("path", "sha256")) == rows(merged.select("path", "sha256")) and not again.filter("status in ('added', 'changed')").count()
    assert rows(overlay.overlay(base.limit(0), fresh).select("status").distinct()) == [("added",)]


def test_null_contents_are_equal_and_first_paths_are_bounded(spark):
    a = spark.createDataFrame([(f"p{i:03}", None) for i in range(80)], "path string, sha256 string")
    assert rows(overlay.overlay(a, a).select("status").distinct()) == [("unchanged",)]
    first = overlay.first_paths(overlay.overlay(a.limit(0), a))
    assert [r["path"] for r in first.orderBy("path").collect()] == [f"p{i:03}" for i in range(50)]


def test_layout(spark):
    t = of_files(spark, {"cn/gamedata/excel/a.json": b"1", "cn/gamedata/x/skip.tmp": b"1", "jp/gamedata/b.json": b"1", "cn/other/c": b"1"})
    got = overlay.normalize_layout(t.filter("not is_dir"), "cn", excluded=["*.tmp"])
    assert [r["path"] for r in got.collect()] == ["zh_CN/gamedata/excel/a.json"]


# --- gates


def contract(names=("阿米娅", "嘉辛塔"), **more):
    excel = "zh_CN/gamedata/excel/"
    files = {excel + f: b"{}" for f in gates.REQUIRED_EXCEL}
    files[excel + "character_table.json"] = ("{" + ",".join(f'"char_{i}":{{"name":"{n}","rarity":"TIER_5"}}' for i, n in enumerate(names)) + "}").encode()
    files[excel + "stage_table.json"] = b'{"stages":{"act53side_01":{}}}'
    files[excel + "item_table.json"] = b'{"items":{"i1":{}}}'
    files["zh_CN/gamedata/levels/enemydata/enemy_database.json"] = b'{"enemies":[]}'
    return files | {f"zh_CN/gamedata/{k}": v for k, v in more.items() if v is not None}


def errors(spark, files, base=None, probes=None):
    found = gates.validate(of_files(spark, files), base and of_files(spark, base), probes)
    return sorted((r["gate"], r["subject"], r["message"]) for r in found.collect() if r["severity"] == "error")


def test_contract_holds(spark):
    assert errors(spark, contract(), contract(), {"operators": ["嘉辛塔"]}) == []
    assert errors(spark, {"x": b""}) == [("root", "zh_CN", "missing root directory")]


def test_contract_failures(spark):
    files = contract()
    del files["zh_CN/gamedata/excel/zone_table.json"]
    files["zh_CN/gamedata/excel/charword_table.json"] = b"not-json"
    files["zh_CN/gamedata/excel/handbook_info_table.json"] = b"5"
    files["zh_CN/gamedata/excel/extra.json"] = b'{"a":1} x'
    files["zh_CN/gamedata/excel/bad.json"] = b"\xff\xfe"
    found = errors(spark, files)
    assert ("contract", "gamedata/excel/zone_table.json", "required file is missing") in found
    assert ("contract", "handbook_info_table.json", "unparseable excel file") in found
    assert {s for g, s, _ in found if g == "json"} == {"zh_CN/gamedata/excel/charword_table.json", "zh_CN/gamedata/excel/extra.json", "zh_CN/gamedata/excel/bad.json"}


def test_rarity(spark):
    files = contract()
    files["zh_CN/gamedata/excel/character_table.json"] = b'{"char_001_bad":{"rarity":5},"char_2":{"rarity":null},"char_3":{"rarity":"TIER_1"},"char_4":{"rarity":"X"},"trap":{"rarity":1},"char_5":7}'
    assert [(g, s) for g, s, _ in errors(spark, files)] == [("rarity", "char_001_bad"), ("rarity", "char_4")]


def test_record_regression(spark):
    many = [f"n{i}" for i in range(100)]
    assert [(g, s) for g, s, _ in errors(spark, contract(many[:50]), contract(many))] == [("records", "character_table.json")]
    assert errors(spark, contract(many[:95]), contract(many)) == []


def test_accumulation(spark):
    base = contract() | {"zh_CN/gamedata/levels/activities/act1/level_1.json": b"{}"}
    assert [(g, s) for g, s, _ in errors(spark, contract(), base)] == [("accumulation", "zh_CN/gamedata/levels")]


def test_probes(spark):
    found = errors(spark, contract(), None, {"operators": ["nobody"], "events": ["act53side", "act99"]})
    assert found == [("probe", "act53side", "event probe is absent"), ("probe", "act99", "event probe has no stage"), ("probe", "act99", "event probe is absent"), ("probe", "nobody", "operator probe is absent")]


def test_story_coverage(spark):
    files = contract()
    files["zh_CN/gamedata/excel/story_review_table.json"] = b'{"e":{"name":"E","infoUnlockDatas":[{"storyTxt":"Obt/A"},{"storyTxt":"obt/b"},{"storyTxt":"gone"},{"storyTxt":""}]},"n":{"infoUnlockDatas":null}}'
    files["zh_CN/gamedata/story/obt/a.txt"] = b"x"
    files["zh_CN/gamedata/story/obt/b.json"] = b"{}"
    found = {(r["severity"], r["subject"], r["message"]) for r in gates.validate(of_files(spark, files), None).collect()}
    assert found == {("error", "Obt/A", "unconverted"), ("warning", "gone", "source_missing")}


def test_substring_probes_in_passes(spark, monkeypatch):
    probes = spark.createDataFrame([(f"p{i}",) for i in range(20)], "probe string")
    texts = spark.createDataFrame([("xp3y p7",), ("p11",)], "t string")
    want = rows(gates.absent_substrings(probes, texts, "probe", ["t"]))
    monkeypatch.setattr(gates, "PROBE_ROWS", 3)
    assert rows(gates.absent_substrings(probes, texts, "probe", ["t"])) == want and len(want) == 16


# --- stories


def test_parse_script():
    got = story.parse_script('[HEADER(is_skippable=true, key="a b")]\n[name="阿米娅"]你好，博士。\n\n[Dialog]\nplain')
    assert got == [
        {"id": 0, "prop": "HEADER", "attributes": {"is_skippable": "true", "key": "a b"}},
        {"id": 1, "prop": "name", "attributes": {"name": "阿米娅", "content": "你好，博士。"}},
        {"id": 2, "prop": "Dialog", "attributes": {}},
        {"id": 3, "prop": "", "attributes": {"content": "plain"}},
    ]


def test_conversion_isolates_failures(spark):
    scripts = spark.createDataFrame([("a", "e", "i", bytearray('[name="x"]hello'.encode())), ("b", "e", "i", bytearray(b"\xff"))], "ref string, event_id string, info string, content binary")
    got = {r["ref"]: (r["words"], r["error"] is None) for r in story.convert(scripts).collect()}
    assert got == {"a": (5, True), "b": (None, False)}


def test_character_dictionary(spark):
    r = spark.createDataFrame([(0, "char_002_amiya", '{"name":"阿米娅"}'), (1, "token_xxx", '{"name":"t"}'), (2, "char_1001_amiya", '{"name":"second"}'), (3, "char_9", "{}")], "pos int, key string, value string")
    assert rows(story.character_dictionary(r)) == [("amiya", "1001", "second")]


def test_case_fixes(spark):
    refs, texts = col(spark, ["Obt/RO1/x", "obt/y", "Gone"], "ref"), col(spark, ["obt/ro1/x", "OBT/ro1/x", "obt/y", "OBT/Y"], "ref")
    assert rows(story.case_fixes(refs, texts)) == [("Obt/RO1/x", "OBT/ro1/x")]


def test_word_counts_and_upsert(spark):
    chapters = spark.createDataFrame([("e1", "a"), ("e2", "b")], "event_id string, storyTxt string")
    done = spark.createDataFrame([("a", 5, None)], "ref string, words long, error string")
    assert rows(story.word_counts(chapters, done)) == [("e1", "a", 5), ("e2", None, None)]
    assert rows(story.upsert(done, done.withColumn("words", F.lit(9).cast("long")), ["ref"])) == [("a", 9, None)]


# --- digests


def test_dialogue(spark):
    import json

    items = [
        ("name", {"name": "<b>A</b>", "content": "hi {@nickname} "}), ("name", {"content": "x"}), ("name", {"name": "B", "content": ""}), ("Sticker", {"text": "note"}), ("subtitle", {"content": "sub"}),
        ("decision", {"options": '["one", {"text": "two"}, ""]'}), ("bgm", {"content": "no"}),
    ]
    text = json.dumps({"storyList": [{"prop": p, "attributes": a} for p, a in items]})
    got = spark.createDataFrame([(text,)], "s string").select(digest.dialogue(F.col("s"))).first()[0]
    assert got == "A：hi 博士\n？？？：x\n*note*\n*sub*\n【选项】one\n【选项】two"


def test_event_texts(spark):
    p = [("e1", 1, "c1", "t", "n", "first"), ("e1", 2, "c2", "t", "n", "second"), ("e1", 3, "c3", "t", "n", ""), ("e2", 1, "c", "t", "n", "x" * 900)]
    got = dict((r["event_id"], (r["parts"], r["text"])) for r in digest.event_texts(spark.createDataFrame(p, "event_id string, ord int, code string, tag string, name string, text string")).collect())
    assert got == {"e1": (2, "--- c1 [t] n ---\nfirst\n\n--- c2 [t] n ---\nsecond"), "e2": (1, "x" * 800)}


def test_summaries_retry_and_fail_alone(spark):
    def model(t):
        if t == "bad":
            raise RuntimeError("no")
        return t.upper()

    got = {r["k"]: (r["summary"], r["error"]) for r in digest.summarize(spark.createDataFrame([("a", "x"), ("b", "bad"), ("c", " ")], "k string, t string"), "k", "t", model).collect()}
    assert got == {"a": ("X", None), "b": (None, "RuntimeError: no"), "c": (digest.NO_DIALOGUE, None)}
    assert digest.sparse_stats(spark.createDataFrame([(1, 0)], "a long, b long")).first()[0] == '{"a":1}'


# --- state and index


def test_bundles(spark):
    cur = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", None)], "bundle string, hash string")
    old = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None), ("gone", "1")], "bundle string, hash string")
    assert rows(state.bundle_actions(cur, old)) == [("a", "unchanged"), ("b", "download"), ("c", "unchanged"), ("d", "download")]
    assert rows(state.removed(old, cur)) == [("gone",)]
    changed = state.bundle_actions(cur, old).filter("action = 'download'")
    assert rows(state.forced(col(spark, ["a", "b", "zz"]), changed, cur)) == [("a",)]
    assert rows(state.forced(col(spark, ["a", "c"]), changed, cur, col(spark, ["a"]))) == [("c",)]
    assert rows(state.saved_hashes(cur, col(spark, ["b"])).select("bundle")) == [("a",), ("c",), ("d",)]
    assert rows(state.stale(col(spark, ["a", "old"]), cur)) == [("old",)]


def test_state_relations(spark):
    pairs = spark.createDataFrame([("b1", "s1"), ("b1", "s2"), ("b2", "s3")], "bundle string, skin_id string")
    skins = lambda *s: col(spark, s, "skin_id")
    assert rows(state.bundles_for(pairs, skins("s2", "s9"))) == [("b1",)]
    assert rows(state.candidates_for(pairs, col(spark, ["b1"]))) == [("s1",), ("s2",)]
    assert rows(state.affected(skins("p"), pairs, col(spark, ["b2"]), col(spark, ["b9"]), skins("s1", "was"), skins("s1"))) == [("p",), ("s3",), ("was",)]
    assert rows(state.uncovered(skins("n1", "n2"), skins("n1"))) == [("n2",)]
    new = spark.createDataFrame([("b2", "s4")], "bundle string, skin_id string")
    assert rows(state.next_candidates(pairs, new, col(spark, ["b1", "b2"]), col(spark, ["b2"]))) == [("b1", "s1"), ("b1", "s2"), ("b2", "s4")]
    index = lambda **x: spark.createDataFrame(list(x.items()), "skin_id string, v string")
    assert rows(state.merge_incremental(index(a="0", b="0", c="0", d="0"), index(b="1", x="1"), skins("a", "b", "d"), skins("d"))) == [("a", "0"), ("b", "1")]


def test_checked_state():
    good = {"schemaVersion": state.VERSION, "versionId": "v", "bundleHashes": {"b": "h"}, "bundleCandidates": {"b": ["s"]}, "validSkinIds": ["s"]}
    assert state.checked_state(good) == good and state.matches_index(good, "v") and not state.matches_index(good, "w")
    for k, v in (("schemaVersion", "x"), ("versionId", ""), ("bundleHashes", {}), ("bundleHashes", {"b": 1}), ("bundleCandidates", {"b": "s"}), ("validSkinIds", []), ("validSkinIds", [1])):
        assert state.checked_state(good | {k: v}) is None
    assert state.checked_state([]) is None and not state.matches_index(None, "v")
    for k, v in (("bundleHashes", {}), ("bundleCandidates", {}), ("validSkinIds", [])):
        assert state.checked_state(good | {k: v}, may_be_empty=True) == good | {k: v}
    for k, v in (("bundleHashes", {"b": ""}), ("bundleHashes", []), ("validSkinIds", [""]), ("validSkinIds", {})):
        assert state.checked_state(good | {k: v}, may_be_empty=True) is None


def test_bundles_that_are_gone_keep_no_candidates(spark):
    pairs = spark.createDataFrame([("b1", "s1"), ("gone", "s9")], "bundle string, skin_id string")
    new = spark.createDataFrame([("gone", "s8"), ("b2", "s2")], "bundle string, skin_id string")
    processed = spark.createDataFrame([("gone",), ("b2",)], "bundle string")
    assert rows(state.next_candidates(pairs, new, col(spark, ["b1", "b2"]), processed)) == [("b1", "s1"), ("b2", "s2")]


def test_manifest_versions():
    release.verify_manifest({"contractVersion": "c", "source": {"versionId": "v1"}}, "data-v1", "c", {})
    release.verify_manifest({"contractVersion": "c", "source": {}}, "upstream-v1", "c", {})
    for source in ({}, {"versionId": "v2"}, []):
        with pytest.raises(ValueError):
            release.verify_manifest({"contractVersion": "c", "source": source}, "data-v1", "c", {})


def test_a_model_is_asked_again_after_a_while(spark, tmp_path):
    log = str(tmp_path / "calls")

    def model(text):
        with open(log, "a") as f:
            f.write("x")
        if len(open(log).read()) < 3:
            raise OSError("busy")
        return "done"

    found = digest.summarize(spark.createDataFrame([("k", "t")], "k string, t string"), "k", "t", model, wait=0.05).collect()
    assert [(r["summary"], r["error"]) for r in found] == [("done", None)]


def test_valid_skins(spark):
    skins = spark.createDataFrame([("a", "char_1"), ("b", "token_1"), ("c", "char_9"), ("d", "char_2"), ("token_x", "char_1")], "skin_id string, char_id string")
    assert rows(state.valid_skins(skins, col(spark, ["char_1", "char_2"], "key"))) == [("a",), ("d",)]


def test_delta_and_since(spark):
    schema = "skin_id string, original string, large string, preview string"
    cur = spark.createDataFrame([("a", "1", "1", "1"), ("b", "1", "2", "1"), ("c", "1", "1", "1"), ("n", "1", None, None)], schema)
    old = spark.createDataFrame([("a", "1", "1", "1"), ("b", "1", "1", "1"), ("d", "1", "1", "1"), ("n", "1", None, None)], schema)
    assert rows(delta.delta(cur, old)) == [("b", "changed"), ("c", "added"), ("d", "removed")]
    assert rows(delta.delta(cur, cur)) == [] and {c for _, c in rows(delta.delta(cur, None))} == {"added"}
    assert delta.is_empty(delta.delta(cur.filter("skin_id = 'a'"), cur)) and not delta.is_empty(delta.delta(cur, old))
    since = delta.since_version(cur, old.withColumn("since_version", F.lit("v0")), "v1")
    assert rows(since.select("skin_id", "since_version")) == [("a", "v0"), ("b", "v0"), ("c", "v1"), ("n", "v0")]
    files = col(spark, ["c.original.png", "b.large.png"], "file")
    assert rows(delta.delta_files(cur, delta.delta(cur, old), files).groupBy("found").count()) == [(False, 4), (True, 2)]


def png(w, h):
    body = struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + body + struct.pack(">I", zlib.crc32(b"IHDR" + body))


def test_art_index(spark):
    files = spark.createDataFrame([("a#1.original.png", bytearray(png(100, 200))), ("b@2.original.png", bytearray(png(5, 6))), ("x.original.png", bytearray(b"no"))], "file string, content binary")
    valid = col(spark, ["a#1", "b@2", "missing"], "skin_id")
    got = {r["skin_id"]: (r["kind"], r["shard"], r["original"]["w"], r["original"]["h"], r["original"]["bytes"]) for r in art.index(files, valid).collect()}
    assert got == {"a#1": ("base", "chararts", 100, 200, 33), "b@2": ("skin", "skinpack", 5, 6, 33)}
    assert rows(art.index_gaps(files, valid)) == [("missing", "missing"), ("x", "skipped")]


def test_variants_are_all_or_nothing(spark):
    files = spark.createDataFrame([("a.original.png", bytearray(png(2048, 1024))), ("b.original.png", bytearray(png(10, 10)))], "file string, content binary")
    made = art.variants(files, 1024, "large", lambda c, w, h: f"{w}x{h}".encode())
    assert {r["file"]: bytes(r["content"]) for r in art.all_or_nothing(made).collect()} == {"a.large.png": b"1024x512", "b.large.png": png(10, 10)}
    broken = files.union(spark.createDataFrame([("c.original.png", bytearray(b"no"))], files.schema))
    with pytest.raises(ValueError, match=r"c\.large\.png"):
        art.all_or_nothing(art.variants(broken, 1024, "large", lambda c, w, h: c))


def test_extraction_prefers_sprites(spark):
    t = spark.createDataFrame([("b", "char_1_a_1", "Texture2D", 0), ("b", "char_1_a_1", "Sprite", 1), ("b", "icon", "Sprite", 2)], "bundle string, name string, kind string, pos int")
    assert rows(art.extracted(t).select("skin_id", "kind")) == [("char_1_a#1", "Sprite")]


# --- releases and statistics


def test_releases(spark):
    asset = lambda *n: [(x, 1, "d") for x in n]
    r = spark.createDataFrame(
        [("data-1", False, 9, asset("excel.zip")), ("images-v1", False, 5, asset("index.json")), ("images-v0", False, 6, asset("x")), ("images-baseline-v2", False, 8, asset("index.json")), ("images-v3", True, 9, asset("index.json")), ("data-0", False, 1, asset(*release.REQUIRED_ASSETS))],
        "tag string, is_draft boolean, created long, assets array<struct<name:string,size:long,digest:string>>",
    )
    assert rows(release.latest_image_version(r)) == [("v1",)] and rows(release.complete(r).select("tag")) == [("data-0",)]
    lists = spark.createDataFrame([('{"versionId":"v","abInfos":[{"name":"a","hash":"b"}]}',), ("{}",)], "content string")
    assert rows(release.bundle_count(lists)) == [("v", None, 1), (None, None, 0)]


def test_verify_asset():
    import hashlib

    good = f"sha256:{hashlib.sha256(b'x').hexdigest()}"
    release.verify_asset("a", b"x", 1, good)
    for size, value, match in ((1, None, "valid digest"), (1, "md5:1", "valid digest"), ("1", good, "valid size"), (2, good, "differs"), (1, good[:-1] + "g", "differs")):
        with pytest.raises(ValueError, match=match):
            release.verify_asset("a", b"x", size, value)


def test_order_statistics(spark):
    import random

    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.randrange(20)) for _ in range(301)]
    got = {r["g"]: tuple(r)[1:] for r in statistics.order_statistics(spark.createDataFrame(data, "g string, v int"), "g", "v", {"p50": 0.5, "p95": 0.95}).collect()}
    for g in "ab":
        s = sorted(v for k, v in data if k == g)
        assert got[g] == (len(s), s[0], s[-1], s[len(s) // 2], s[int(len(s) * 0.95)])
    assert rows(statistics.ratio_by(spark.createDataFrame([("a", 1.0, 0.0), ("b", 1.0, 4.0)], "g string, x double, y double"), "g", "x", "y")) == [("a", 0.0), ("b", 0.25)]
