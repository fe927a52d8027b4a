import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from treeline.plans import artwork, cli, factory
from treeline.sources import archives, tables, tree
from treeline.sources.attempts import retried
from treeline.sources.settings import load_environment, tool_versions
from treeline.sources.registry import Registry
from treeline.streaming import poll

from .test_operators import contract, png, rows


def test_scan_sees_hidden_and_empty_files(spark, tmp_path):
    for name, data in {"a#1@x+ b.json": b"1", ".hidden/x": b"2", "_u/空.txt": b"", "[uc]info/y": b"3"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {r["path"]: (r["is_dir"], r["size"], r["content"] and bytes(r["content"])) for r in tree.scan(spark, str(tmp_path)).collect()}
    assert {k: v for k, v in got.items() if not v[0]} == {"a#1@x+ b.json": (False, 1, b"1"), ".hidden/x": (False, 1, b"2"), "_u/空.txt": (False, 0, b""), "[uc]info/y": (False, 1, b"3")}
    assert {k for k, v in got.items() if v[0]} == {".hidden", "_u", "[uc]info"}
    assert [r["path"] for r in tree.scan(spark, str(tmp_path), ".txt").collect()] == ["_u/空.txt"]
    assert tree.scan(spark, str(tmp_path / "none")).count() == 0


def test_archives_depend_on_contents_alone(spark, tmp_path):
    files = tree.of_files(spark, {f"d/{i}.json": str(i).encode() * 50 for i in range(30)})
    one = archives.write_archive(files, tmp_path / "1.zip")
    two = archives.write_archive(files.repartition(7), tmp_path / "2.zip")
    assert one["sha256"] == two["sha256"] and one["files"] == 30 and one["bytes"] == sum(len(str(i)) * 50 for i in range(30))
    with zipfile.ZipFile(tmp_path / "1.zip") as z:
        assert [i.filename for i in z.infolist()] == sorted(i.filename for i in z.infolist()) and z.infolist()[0].date_time[0] == 1980
    later = archives.write_archive(tree.of_files(spark, {"d/1.json": b"later"}), tmp_path / "3.zip")
    both = spark.createDataFrame([(i, bytearray((tmp_path / n).read_bytes())) for i, n in enumerate(("1.zip", later["name"]))], "ord int, content binary")
    got = {r["path"]: bytes(r["content"]) for r in archives.read_archives(both).collect()}
    assert len(got) == 30 and got["d/1.json"] == b"later" and got["d/2.json"] == b"2" * 50


def test_activation_and_json(tmp_path):
    (tmp_path / "new").mkdir()
    (tmp_path / "old").mkdir()
    (tmp_path / "new" / "x").write_text("1")
    archives.activate(tmp_path / "new", tmp_path / "old")
    assert (tmp_path / "old" / "x").read_text() == "1" and not (tmp_path / "new").exists()
    with pytest.raises(OSError):
        archives.activate(tmp_path / "absent", tmp_path / "old")
    assert (tmp_path / "old" / "x").exists()
    archives.write_json(tmp_path / "j.json", {"é": 1})
    assert (tmp_path / "j.json").read_text("utf-8") == '{\n  "é": 1\n}\n'


def test_keyed_records_and_defaults(spark):
    t = spark.createDataFrame([('{"b":{"x":1},"a":2,"b":3}',)], "content string")
    assert [tuple(r) for r in tables.keyed_records(t).orderBy("pos").collect()] == [(1, "a", "2"), (2, "b", "3")]
    files = tree.of_files(spark, {"x/hot_update_list.json": b"bad", "y/hot_update_list.json": b'{"versionId":"v","abInfos":[]}'})
    assert tables.hot_update(files).first()["versionId"] == "v"
    assert rows(tables.default_content(files, ["none.json"])) == [("none.json", "{}")]


def test_registry(spark, tmp_path):
    registry, files = Registry(tmp_path / "r"), []
    for name, n in (("big", 500), ("small", 5)):
        (tmp_path / name).write_bytes(b"x" * n)
        files.append(tmp_path / name)
    assert registry.publish(spark, "data-1", files) == ["small", "big"] and registry.releases(spark).count() == 0
    assert registry.publish(spark, "data-1", files, True) == ["small", "big"]
    assert rows(registry.releases(spark).select("tag", "is_draft")) == [("data-1", False)]
    assert registry.publish(spark, "data-1", files, True) == []
    (tmp_path / "r/data-1/small").write_bytes(b"wrong")
    assert registry.publish(spark, "data-1", files, True) == ["small"]
    good = {n: {"size": s, "digest": d} for n, s, d in registry.assets("data-1")}
    assert len(registry.fetch("data-1", good, tmp_path / "f")) == 2
    with pytest.raises(ValueError):
        registry.fetch("data-1", {"big": {"size": 1, "digest": good["big"]["digest"]}}, tmp_path / "f")


def test_uploads_are_tried_again(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(b"x")
    registry, calls, real = Registry(tmp_path / "r", attempts=3, wait=0), [], Registry._upload

    def upload(self, tag, file):
        calls.append(file.name)
        if len(calls) < 3:
            raise OSError("away")
        real(self, tag, file)

    monkeypatch.setattr(Registry, "_upload", upload)
    assert registry.publish(spark, "data-1", [tmp_path / "a"], True) == ["a"]
    assert len(calls) == 3 and registry.publish(spark, "data-1", [tmp_path / "a"]) == []
    calls.clear()
    with pytest.raises(OSError):
        Registry(tmp_path / "r2", attempts=2, wait=0).publish(spark, "data-1", [tmp_path / "a"], True)
    with pytest.raises(KeyError):  # not of the errors that are waited out
        retried(lambda: {}["x"], 5, 1000.0)


def test_environment_file_and_tool_versions(tmp_path, monkeypatch):
    monkeypatch.setenv("TREELINE_A", "kept")
    for name in ("TREELINE_B", "TREELINE_C"):
        monkeypatch.delenv(name, raising=False)
    (tmp_path / "e").write_text("# no\n\nTREELINE_A=new\n TREELINE_B = 'b=1' \nTREELINE_C=\"\"\nnothing\n")
    import os

    assert load_environment(tmp_path / "e") == ["TREELINE_B", "TREELINE_C"] and load_environment(tmp_path / "none") == []
    assert [os.environ[f"TREELINE_{x}"] for x in "ABC"] == ["kept", "b=1", ""]
    for name in ("TREELINE_B", "TREELINE_C"):
        del os.environ[name]
    found = tool_versions(["pyarrow", "no-such-package"], ["git", "no-such-program"])
    assert set(found) == {"pyarrow", "git"} and found["git"].startswith("git version")


def lines_in_capitals(text):
    """A parser of the caller's own."""
    if "broken" in text:
        raise ValueError("broken")
    return [{"id": 0, "prop": "", "attributes": {"content": text.upper()}}]


def test_own_parser(spark):
    from treeline.operators import story

    scripts = spark.createDataFrame([("a", "e", "i", b"one"), ("b", "e", "i", b"broken"), ("c", "e", "i", b"\xff")], "ref string, event_id string, info string, content binary")
    got = {r["ref"]: r for r in story.convert(scripts, parse=lines_in_capitals).collect()}
    assert json.loads(got["a"]["story"])["storyList"][0]["attributes"]["content"] == "ONE" and got["a"]["words"] == 3
    assert got["b"]["error"] == "ValueError: broken" and got["c"]["error"].startswith("UnicodeDecodeError")


def test_extractor_and_excel_directory(spark, tmp_path):
    work, calls = factory.Work(spark, tmp_path), []

    def extractor(target):
        calls.append(target)
        if len(calls) < 3:
            raise RuntimeError("away")
        put(target, {k.replace("zh_CN", "cn"): v for k, v in contract().items()} | {"cn/hot_update_list.json": b'{"versionId":"v9","abInfos":[]}'})

    factory.fetch(work, extractor, attempts=3, wait=0)
    assert calls == [tmp_path / "extract"] * 3 and json.loads((tmp_path / "fetch.json").read_text())["problems"] is not None
    with pytest.raises(ZeroDivisionError):
        factory.fetch(work, lambda _: 1 / 0, attempts=2, wait=0)
    put(tmp_path / "own", {"skin_table.json": b'{"charSkins":{"s#1":{"charId":"char_1_a"},"s#2":{"charId":"char_2_b"}}}', "character_table.json": b'{"char_1_a":{}}'})
    work.excel = tmp_path / "own"
    assert [r["skin_id"] for r in artwork.valid(work).collect()] == ["s#1"]
    work.excel = tmp_path / "absent"
    with pytest.raises(FileNotFoundError):
        artwork.valid(work)


def put(root, files):
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)


def test_data_chain(spark, tmp_path):
    review = {"e": {"name": "Event", "infoUnlockDatas": [{"storyCode": "1", "avgTag": "t", "storyName": "n", "storyTxt": "activities/a"}, {"storyTxt": "Obt/B", "storyName": "m"}]}}
    fresh = {k.replace("zh_CN", "cn"): v for k, v in contract().items()}
    fresh["cn/gamedata/excel/story_review_table.json"] = json.dumps(review).encode()
    fresh["cn/gamedata/excel/character_table.json"] = '{"char_002_amiya":{"name":"阿米娅","rarity":"TIER_5"}}'.encode()
    fresh["cn/gamedata/story/activities/a.txt"] = '[name="阿米娅"]你好\n[Dialog]\n'.encode()
    fresh["cn/gamedata/story/obt/b.txt"] = b'[name="x"]hello'
    fresh["cn/hot_update_list.json"] = b'{"versionId":"v9","abInfos":[]}'
    fresh["cn/gamedata/excel/story_review_meta_table.json"] = json.dumps({"actArchiveResData": {"avgs": {"x": {"desc": "Opening", "contentPath": "obt/extra"}, "y": {"desc": "No", "contentPath": "obt/none"}}}}).encode()
    fresh["cn/gamedata/story/obt/extra.txt"] = b"plain"
    put(tmp_path / "extract", fresh)
    put(tmp_path / "baseline", {"zh_CN/gamedata/levels/old.json": b"{}"})
    args = ["--workdir", str(tmp_path)]
    assert cli.main([*args, "check"], spark) == 0
    assert cli.main([*args, "run", "--publish", "--probe-operator", "阿米娅"], spark) == 0
    story = tmp_path / "candidate/zh_CN/gamedata/story"
    assert json.loads((story / "activities/a.json").read_text("utf-8"))["storyList"][0]["attributes"]["name"] == "阿米娅"
    assert json.loads((story.parents[1] / "wordcount.json").read_text()) == {"e": {"activities/a": 2, "Obt/B": 5}}
    assert json.loads((story.parents[1] / "chardict.json").read_text("utf-8")) == {"amiya": {"name": "阿米娅", "id": "002"}}
    assert json.loads((story.parents[1] / "summaries.json").read_text("utf-8")) == {"Obt/B": "x：hello", "activities/a": "阿米娅：你好"}
    assert "--- 1 [t] n ---" in json.loads((story.parents[1] / "event_summaries.json").read_text("utf-8"))["e"]
    assert json.loads((story.parents[1] / "extrastory.json").read_text()) == {"extra": [{"storyName": "Opening", "storyTxt": "obt/extra"}]}
    assert set(json.loads((story.parents[1] / "storyinfo.json").read_text())) == {"activities/a", "Obt/B", "obt/extra"}
    assert (tmp_path / "candidate/zh_CN/gamedata/levels/old.json").exists()
    merged, manifest = (json.loads((tmp_path / f).read_text("utf-8")) for f in ("merge.json", "dist/manifest.json"))
    assert merged["stats"]["kept_from_baseline"] == 1 and manifest["validation"]["ok"] and set(manifest["assets"]) == {"zh_CN-excel.zip", "zh_CN-levels.zip", "zh_CN.zip"}
    assert cli.main([*args, "check"], spark) == cli.UNCHANGED and cli.main([*args, "run"], spark) == 0
    put(tmp_path / "candidate", {"zh_CN/gamedata/excel/item_table.json": b"broken"})
    assert cli.main([*args, "validate"], spark) == 1


def test_images_plan_and_package(spark, tmp_path):
    from treeline.operators import state

    hot = spark.createDataFrame([("chararts/a", "2"), ("chararts/b", "1")], "bundle string, hash string")
    saved = spark.createDataFrame([("chararts/a", "1"), ("chararts/b", "1"), ("chararts/c", "1")], "bundle string, hash string")
    old = state.checked_state({"schemaVersion": state.VERSION, "versionId": "v0", "bundleHashes": {"chararts/b": "1"}, "bundleCandidates": {"chararts/b": ["s1", "s2"]}, "validSkinIds": ["s1"]})
    valid = spark.createDataFrame([("s1",), ("s2",)], "skin_id string")
    plan = factory.images_plan(hot, saved, old, valid, "v0")
    assert plan["incremental"] and rows(plan["downloads"]) == [("chararts/a",), ("chararts/b",)] and rows(plan["removed"]) == [("chararts/c",)] and rows(plan["new_skins"]) == [("s2",)]
    full = factory.images_plan(hot, saved, None, valid, "v0")
    assert not full["incremental"] and rows(full["downloads"]) == [("chararts/a",)]
    pngs = lambda *ids: spark.createDataFrame([(f"{i}.{t}.png", bytearray(png(9, n))) for i, n in ids for t in ("original", "large", "preview")], "file string, content binary")
    skins = spark.createDataFrame([("a",), ("b",), ("c",)], "skin_id string")
    first_files, next_files = pngs(("a", 1), ("b", 1)), pngs(("a", 1), ("b", 2), ("c", 1))
    first = factory.images_index(first_files, skins)
    made = factory.images_package(first, None, "v0", first_files, tmp_path)
    assert made["mode"] == "baseline" and [a["files"] for a in made["assets"]] == [2, 2, 2, 0]
    with pytest.raises(FileNotFoundError):
        factory.images_package(first, None, "v0", first_files.filter(~F.col("file").startswith("a.large")), tmp_path)
    second = factory.images_package(factory.images_index(next_files, skins), first.withColumn("since_version", F.lit("v0")), "v1", next_files, tmp_path)
    assert (second["added"], second["changed"], second["removed"], second["empty"], second["assets"][0]["files"]) == (1, 1, 0, False, 6)


def decode(data):
    """A stand-in decoder: lines of texture name, kind and PNG size."""
    if data == b"broken":
        raise ValueError("broken")
    for line in data.decode().splitlines():
        name, kind, w, h = line.split()
        yield name, kind, png(int(w), int(h))


def resized(content, w, h):
    return png(w, h)


def test_artwork_chain(spark, tmp_path):
    from treeline.plans import artwork

    excel = tmp_path / "candidate/zh_CN/gamedata/excel"
    put(tmp_path, {"extract/hot_update_list.json": b'{"versionId":"v0","abInfos":[{"name":"chararts/a","hash":"1"},{"name":"skinpack/b","hash":"1"},{"name":"other/x","hash":"1"}]}'})
    put(excel, {"character_table.json": b'{"char_1_a":{},"char_2_b":{}}', "skin_table.json": b'{"charSkins":{"char_1_a#1":{"charId":"char_1_a"},"char_2_b@s#1":{"charId":"char_2_b"},"token_1#1":{"charId":"char_1_a"}}}'})
    put(tmp_path / "bundles", {"chararts_a.ab": b"char_1_a_1 Texture2D 9 9\nchar_1_a_1 Sprite 2048 1024\nchar_9_z_1 Sprite 1 1", "skinpack_b.ab": b"char_2_b_s#1 Sprite 50 50"})
    work = factory.Work(spark, tmp_path)
    assert artwork.run(work, decode, resized, release_it=True) == 0
    index = json.loads((tmp_path / "images-prev/index.json").read_text())
    assert set(index["artworks"]) == {"char_1_a#1", "char_2_b@s#1"} and index["artworks"]["char_1_a#1"]["large"]["w"] == 1024
    assert work.record("images-package")["mode"] == "baseline" and (tmp_path / "registry/images-baseline-v0").exists()
    state = json.loads((tmp_path / "images-prev/build-state.json").read_text())
    assert state["bundleCandidates"]["chararts/a"] == ["char_1_a#1", "char_9_z#1"]
    # A changed bundle, and a skin that is new to the tables but lies in an unchanged one.
    put(tmp_path, {"extract/hot_update_list.json": b'{"versionId":"v1","abInfos":[{"name":"chararts/a","hash":"1"},{"name":"skinpack/b","hash":"2"}]}', "bundles/skinpack_b.ab": b"char_2_b_s#1 Sprite 60 60"})
    put(excel, {"character_table.json": b'{"char_1_a":{},"char_2_b":{},"char_9_z":{}}', "skin_table.json": b'{"charSkins":{"char_1_a#1":{"charId":"char_1_a"},"char_2_b@s#1":{"charId":"char_2_b"},"char_9_z#1":{"charId":"char_9_z"}}}'})
    assert artwork.run(work, decode, resized, release_it=True) == 0
    plan, made = work.record("images-plan"), work.record("images-package")
    assert plan["incremental"] and plan["downloadedBundles"] == ["chararts/a", "skinpack/b"] and plan["newSkinIds"] == ["char_9_z#1"]
    assert (made["mode"], made["added"], made["changed"], made["removed"]) == ("delta", 1, 1, 0)
    index = json.loads((tmp_path / "images-prev/index.json").read_text())
    assert {k: a["sinceVersion"] for k, a in index["artworks"].items()} == {"char_1_a#1": "v0", "char_2_b@s#1": "v0", "char_9_z#1": "v1"} and index["baselineVersion"] == "v0"
    # A failed bundle is planned again.
    put(tmp_path, {"extract/hot_update_list.json": b'{"versionId":"v2","abInfos":[{"name":"chararts/a","hash":"9"},{"name":"skinpack/b","hash":"2"}]}', "bundles/chararts_a.ab": b"broken"})
    assert artwork.run(work, decode, resized) == 1 and "chararts/a" not in work.record("images-hashes")
    assert cli.main(["--workdir", str(tmp_path), "images-latest-tag"], spark) == 0


def test_baseline_from_the_registry(spark, tmp_path):
    from treeline.operators import release

    put(tmp_path / "candidate", contract())
    work = factory.Work(spark, tmp_path)
    work.keep("merge", {"source": {"versionId": "v1"}})
    assert factory.package(work) == 0 and factory.publish(work, True) == 0
    assert factory.fetch_baseline(work) == 0
    assert (tmp_path / "baseline/zh_CN/gamedata/excel/zone_table.json").read_bytes() == b"{}"
    (tmp_path / "registry/data-v1/zh_CN-excel.zip").write_bytes(b"wrong")
    assert factory.fetch_baseline(work) == 0  # it is there
    with pytest.raises(ValueError, match="differs"):
        factory.fetch_baseline(work, clobber=True)
    for bad, match in (({"contractVersion": 9}, "contract"), ({"contractVersion": 1, "merge": {"source": {"versionId": "v2"}}}, "holds version")):
        with pytest.raises(ValueError, match=match):
            release.verify_manifest(bad, "data-v1", 1, {})
    assert factory.fetch(factory.Work(spark, tmp_path / "none")) == 1


def test_polling_runs_once_for_a_change(spark, tmp_path):
    lists, ran = tmp_path / "in", []
    lists.mkdir()
    (lists / "1.json").write_text('{"versionId":"v1"}')
    go = lambda known: poll.poll(spark, str(lists), str(tmp_path / "cp"), lambda: known, ran.append)
    assert go("v0") == ["v1"] and go("v0") == []
    (lists / "2.json").write_text('{"versionId":"v1"}')
    assert go("v1") == [] and ran == ["v1"]


def test_probe_files(spark, tmp_path):
    (tmp_path / "probes.json").write_text('{"operators":["b"]}')
    config = tmp_path / "c.json"
    config.write_text('{"operators":["a"],"events":["e"]}')
    assert factory.loaded_probes(factory.Work(spark, tmp_path), config, {"operators": ["c"]}) == {"operators": ["b", "c"], "events": ["e"]}


def test_a_baseline_without_levels_is_fetched_again(spark, tmp_path):
    put(tmp_path / "candidate", contract())
    work = factory.Work(spark, tmp_path)
    work.keep("merge", {"source": {"versionId": "v1"}})
    assert factory.package(work) == 0 and factory.publish(work, True) == 0
    for half in (False, True):
        put(tmp_path / "baseline", {k: v for k, v in contract().items() if "/excel/" in k})
        if half:
            (tmp_path / "baseline/zh_CN/gamedata/levels/enemydata/enemy_database.json").unlink()
        assert factory.fetch_baseline(work) == 0
        assert (tmp_path / "baseline/zh_CN/gamedata/levels/enemydata/enemy_database.json").is_file()


def test_images_index_and_unchanged_version(spark, tmp_path):
    work = factory.Work(spark, tmp_path)
    put(tmp_path / "extract", {"cn/gamedata/excel/hot_update_list.json": b'{"versionId": "v1", "abInfos": []}'})
    put(tmp_path / "images-prev", {"index.json": b'{"currentVersion": "v1"}'})
    assert artwork.run(work, lambda b: []) == 0 and not (tmp_path / "images-plan.json").exists()
    excel = "candidate/zh_CN/gamedata/excel"
    put(tmp_path / excel, {"skin_table.json": b'{"charSkins": {"char_1_a#1": {"charId": "char_1_a"}, "char_1_a#2": {"charId": "char_1_a"}}}', "character_table.json": b'{"char_1_a": {}}'})
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 30, 20)
    put(tmp_path / "images", {"char_1_a#1.original.png": png, "char_9_z#1.original.png": png})
    assert artwork.build_index(work) == 0
    assert work.record("images-index") == {"entries": 1, "skipped": ["char_9_z#1"], "missing": ["char_1_a#2"]}
    made = json.loads((tmp_path / "images-index/index.json").read_text())["artworks"]["char_1_a#1"]
    assert (made["original"]["w"], made["original"]["h"], made["kind"]) == (30, 20, "base")
