"""More registered queries: the operators that read files and JSON tables, on files and JSON made from the driver's tables.

A conversation stands for an event of the story tables, its turns for the event's chapters; a part for a texture.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cache_name, sha256_hex, skin_id
from ..functions.text import is_art_bundle
from ..operators import art, delta, digest, gates, release, state, statistics, story
from ..sources import tables, tree
from .catalog import _bundles, _indexes, _t, registered

# --- releases and tables ---------------------------------------------------------------------------------------------


def _hot_lists(spark: SparkSession, d: str) -> DataFrame:
    """A hot-update list for each nation that has suppliers; every third one can't be read."""
    infos = F.array_sort(F.collect_list(F.struct(F.col("s_name").alias("name"), sha256_hex(F.col("s_name")).alias("hash"))))
    per = _t(spark, d, "supplier").groupBy("s_nationkey").agg(infos.alias("abInfos"))
    rows = _t(spark, d, "nation").join(per, F.col("n_nationkey") == F.col("s_nationkey"))
    text = F.to_json(F.struct(F.col("n_name").alias("versionId"), F.concat(F.lit("m"), "n_regionkey").alias("manifestVersion"), "abInfos"))
    return rows.select("n_nationkey", F.concat("n_name", F.lit("/hot_update_list.json")).alias("path"), F.when(F.col("n_nationkey") % 3 == 0, "{").otherwise(text).alias("content"))


@registered("""select n_name as "versionId", 'm' || n_regionkey as "manifestVersion", cast(count(*) as integer) as "abCount"
    from nation join supplier on n_nationkey = s_nationkey where n_nationkey % 3 <> 0 group by n_name, n_regionkey""")
def remote_versions(spark: SparkSession, d: str) -> DataFrame:
    return release.bundle_count(_hot_lists(spark, d)).filter("versionId is not null")


@registered("""with ok as (select n_name, n_regionkey, s_name from nation join supplier on n_nationkey = s_nationkey where n_nationkey % 3 <> 0)
    select n_name as "versionId", 'm' || n_regionkey as "manifestVersion", cast(count(*) as integer) as n, min(sha256(s_name)) as least_hash
    from ok where n_name = (select min(n_name) from ok) group by n_name, n_regionkey""")
def hot_update_provenance(spark: SparkSession, d: str) -> DataFrame:
    found = tables.hot_update(_hot_lists(spark, d))
    return found.select("versionId", "manifestVersion", F.size("abInfos").alias("n"), F.array_min(F.transform("abInfos", lambda x: x["hash"])).alias("least_hash"))


@registered("select p_partkey, 'https://cdn/' || p_brand || '/assets/' || p_size || '/' || replace(p_name, ' ', '_') as url from part")
def asset_urls(spark: SparkSession, d: str) -> DataFrame:
    url = release.asset_url(F.lit("https://cdn"), F.col("p_brand"), F.col("p_size").cast("string"), F.replace("p_name", F.lit(" "), F.lit("_")))
    return _t(spark, d, "part").select("p_partkey", url.alias("url"))


@registered("select name, size from (select p_name || p_partkey as name, p_size as size from part) t order by size, name limit 100")
def upload_order(spark: SparkSession, d: str) -> DataFrame:
    return release.upload_order(_t(spark, d, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"), F.col("p_size").alias("size"))).limit(100)


def _nation_table(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "nation").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("r")).select(F.to_json(F.map_from_entries(F.transform("r", lambda x: F.struct(x["n_name"], x["n_regionkey"])))).alias("content"))


@registered("select cast(n_nationkey as integer) as pos, n_name as key, cast(n_regionkey as varchar) as value from nation")
def keyed_table(spark: SparkSession, d: str) -> DataFrame:
    return tables.keyed_records(_nation_table(spark, d))


@registered("""select t.p as path, coalesce('{"id":' || n_nationkey || '}', '{}') as content from (select n_name as p from nation union select r_name from region) t left join nation on n_name = t.p""")
def default_content(spark: SparkSession, d: str) -> DataFrame:
    files = _t(spark, d, "nation").select(F.col("n_name").alias("path"), F.to_json(F.struct(F.col("n_nationkey").alias("id"))).alias("content"))
    names = [r[0] for r in files.select("path").union(_t(spark, d, "region").select("r_name")).distinct().collect()]  # nations and regions
    return tables.default_content(files, names)


@registered("""select 'stage_table.json' as table_name, count(*) as n from nation union all select 'item_table.json', count(*) from region
    union all select 'skin_table.json', count(distinct s_nationkey) from supplier union all select 'enemy_handbook_table.json', 1 union all select 'zone_table.json', null""")
def wrapped_counts(spark: SparkSession, d: str) -> DataFrame:
    named = lambda name, text: F.struct(F.lit(name).alias("table"), text.alias("content"))
    keys = lambda t, c: _t(spark, d, t).agg(F.map_from_entries(F.collect_set(F.struct(F.col(c).cast("string").alias("k"), F.lit(1).alias("v")))).alias(t))
    rows = keys("nation", "n_name").crossJoin(keys("region", "r_name")).crossJoin(keys("supplier", "s_nationkey"))  # three rows of one each
    files = F.array(
        named("stage_table.json", F.to_json(F.struct(F.col("nation").alias("stages")))),
        named("item_table.json", F.to_json(F.struct(F.col("region").alias("items"), F.lit(1).alias("other")))),
        named("skin_table.json", F.to_json("supplier")),
        named("enemy_handbook_table.json", F.lit('{"levels": {}}')),
        named("zone_table.json", F.lit("7")),
    )
    return gates.table_counts(rows.select(F.explode(files).alias("f")).select("f.*")).withColumnRenamed("table", "table_name")


# --- names and gates ---------------------------------------------------------------------------------------------------

_TEXTURE = """case p_partkey % 6 when 0 then 'char_' || p_partkey || '_' || lower(p_type) || '_' || (p_size % 4) when 1 then 'char_' || p_partkey || '_' || lower(p_type) || '_2+'
    when 2 then 'char_' || p_partkey || '_' || lower(p_type) || '_' || lower(p_brand) when 3 then 'build_char_' || p_partkey || '_' || lower(p_type) || '_1'
    when 4 then 'char_' || p_partkey || '_' || lower(p_type) || '_1[alpha]' else 'illust_' || p_partkey || '_' || p_name end"""
TEXTURE_SQL = f"tx as (select p_partkey, {' '.join(_TEXTURE.split())} as t from part)"
SKIN_SQL = """sk as (select p_partkey, t, case when t like 'build\\_%' escape '\\' or position('[alpha]' in t) > 0 then null
    when position('#' in t) > 0 then case when len(u) >= 4 then 'char_' || u[2] || '_' || array_to_string(u[3:len(u) - 1], '_') || '@' || u[len(u)] end
    when regexp_full_match(t, 'char_[0-9]+_[a-z0-9]+_[0-9]+\\+?') then 'char_' || u[2] || '_' || u[3] || '#' || u[4] end as skin_id
    from (select p_partkey, t, string_split(t, '_') as u from tx) x)"""


def _textures(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "part").select("p_partkey", F.expr(" ".join(_TEXTURE.split())).alias("t"), "p_size")


@registered(f"with {TEXTURE_SQL}, {SKIN_SQL} select p_partkey, t, skin_id from sk")
def texture_skin_ids(spark: SparkSession, d: str) -> DataFrame:
    return _textures(spark, d).select("p_partkey", "t", skin_id(F.col("t")).alias("skin_id"))


@registered("""with b as (select p_partkey, case p_size % 4 when 0 then 'chararts/' when 1 then 'skinpack/' when 2 then 'Chararts/' else 'audio/chararts/' end || lower(p_brand) || '/' || p_partkey || '.ab' as bundle from part)
    select p_partkey, bundle from b where left(bundle, 9) in ('chararts/', 'skinpack/')""")
def art_bundles(spark: SparkSession, d: str) -> DataFrame:
    return _art_bundles(spark, d).filter(is_art_bundle(F.col("bundle")))


@registered("select p_partkey, replace(replace(bundle, '/', '_'), '#', '__') || '.ab' as cached from (select p_partkey, case p_size % 4 when 0 then 'chararts/' when 1 then 'skinpack/' when 2 then 'Chararts/' else 'audio/chararts/' end || lower(p_brand) || '/' || p_partkey || '.ab' as bundle from part) t")
def cache_names(spark: SparkSession, d: str) -> DataFrame:
    return _art_bundles(spark, d).select("p_partkey", cache_name(F.col("bundle")).alias("cached"))


def _art_bundles(spark: SparkSession, d: str) -> DataFrame:
    kind = F.pmod("p_size", F.lit(4))
    top = F.when(kind == 0, "chararts/").when(kind == 1, "skinpack/").when(kind == 2, "Chararts/").otherwise("audio/chararts/")
    return _t(spark, d, "part").select("p_partkey", F.concat(top, F.lower("p_brand"), F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".ab")).alias("bundle"))


@registered("select r_name || '/' || p_size as path from region, (select distinct p_size from part) s where not exists (select 1 from part where p_brand = 'Brand#' || r_regionkey and part.p_size = s.p_size)")
def required_files(spark: SparkSession, d: str) -> DataFrame:
    part, region = _t(spark, d, "part"), _t(spark, d, "region")
    wanted = region.crossJoin(part.select("p_size").distinct())  # five regions
    have = part.join(region, F.col("p_brand") == F.concat(F.lit("Brand#"), F.col("r_regionkey").cast("string")))
    path = F.concat("r_name", F.lit("/"), F.col("p_size").cast("string")).alias("path")
    return gates.missing(wanted.select(path), have.select(path), "path")


@registered("""select 'no gamedata directory' as problem where not exists (select 1 from documents where source = 'src2') union all select 'no excel tables'
    union all select 'no hot-update list' where not exists (select 1 from nation where n_name = 'hot_update_list.json')""")
def extraction_gaps(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat("source", F.lit("/gamedata/excel/sub/"), F.col("doc_id").cast("string"), F.lit(".json"))
    return gates.extraction_problems(_t(spark, d, "documents").select(path.alias("path")), "src2")


@registered("""select c_custkey as pos, 'char_' || c_custkey as key from customer where c_mktsegment in ('HOUSEHOLD', 'MACHINERY') and c_custkey % 2 = 0""")
def rarity_gate(spark: SparkSession, d: str) -> DataFrame:
    rarity = F.when(F.col("c_mktsegment") == "HOUSEHOLD", '{"rarity": 5}').when(F.col("c_mktsegment") == "MACHINERY", '{"rarity": "tier_1"}').when(F.col("c_mktsegment") == "FURNITURE", '{"rarity": null}').when(F.col("c_mktsegment") == "BUILDING", '{"rarity": "TIER_6"}').otherwise('{"name": "x"}')
    prefix = F.when(F.col("c_custkey") % 2 == 0, "char_").otherwise("trap_")
    return gates.invalid_rarity(_t(spark, d, "customer").select(F.col("c_custkey").alias("pos"), F.concat(prefix, F.col("c_custkey").cast("string")).alias("key"), rarity.alias("value")))


@registered("select source as root, count(*) as entries, count(*) filter (where n_chars > 100) as candidate_entries from documents group by source having count(*) filter (where n_chars > 100) < count(*)")
def shrunk_roots(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").withColumnRenamed("source", "root")
    count = lambda x: x.groupBy("root").agg(F.count("*").alias("entries"))
    found = gates.shrunk(count(docs), count(docs.filter("n_chars > 100")))
    return found.select("root", "entries", F.coalesce("candidate_entries", F.lit(0)).alias("candidate_entries"))


@registered("""select 'contract' as gate, 'error' as severity, f as subject, 'required file is missing' as message from (select unnest(['character_table.json', 'handbook_info_table.json', 'charword_table.json',
    'enemy_handbook_table.json', 'zone_table.json', 'stage_table.json', 'item_table.json']) as n) t, lateral (select 'gamedata/excel/' || n as f) x
    union all select 'contract', 'error', 'gamedata/levels/enemydata/enemy_database.json', 'required file is missing'
    union all select 'json', 'error', path, 'not strict UTF-8 JSON' from (select 'zh_CN/gamedata/levels/' || doc_id || '.json' as path from documents order by path limit 10) j
    union all select 'json_total', 'error', cast(count(*) as varchar), 'invalid JSON files in all' from documents
    union all select 'probe', 'error', 'nobody', 'operator probe is absent'
    union all select 'story', case when conv_id % 3 = 1 then 'error' else 'warning' end, conv_id || '/' || turn, case when conv_id % 3 = 1 then 'unconverted' else 'source_missing' end from conversations where conv_id % 3 <> 0""")
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    from .workers import importable

    importable(spark)
    docs = _t(spark, d, "documents").select(F.concat(F.lit("zh_CN/gamedata/levels/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), F.lit("no json").alias("c"))
    turns = _t(spark, d, "conversations").filter("conv_id % 3 < 2")
    suffix = F.when(F.col("conv_id") % 3 == 0, ".json").otherwise(".txt")
    scripts = turns.select(F.concat(F.lit("zh_CN/gamedata/story/"), _ref(), suffix).alias("path"), F.lit("{}").alias("c"))
    review = _story_tables(spark, d).select("content").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.expr("substring(content, 2, length(content) - 2)")), ","), F.lit("}")).alias("c"))
    whole = docs.union(scripts).union(review.select(F.lit("zh_CN/gamedata/excel/story_review_table.json"), "c"))
    return gates.validate(tree.hashed(whole, F.col("path"), F.col("c")), None, {"operators": ["nobody"]})


# --- stories -----------------------------------------------------------------------------------------------------------


def _ref() -> Column:
    return F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))


def _story_tables(spark: SparkSession, d: str) -> DataFrame:
    """The review table in as many files as there are conversations."""
    chapter = F.struct(F.col("turn").cast("string").alias("storyCode"), F.col("role").alias("avgTag"), F.concat(F.lit("n"), F.col("turn").cast("string")).alias("storyName"), _ref().alias("storyTxt"), F.pmod(F.col("turn"), F.lit(2)).cast("int").alias("storySort"))
    per = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", chapter.alias("c")))).alias("c"))
    name = F.when(F.col("conv_id") % 2 == 0, "").otherwise(F.concat(F.lit("event "), F.col("conv_id").cast("string")))
    event = F.struct(F.lit("MAINLINE").alias("entryType"), name.alias("name"), F.transform("c", lambda x: x["c"]).alias("infoUnlockDatas"))
    return per.select(F.lit("story_review_table.json").alias("table"), F.to_json(F.create_map(F.col("conv_id").cast("string"), event)).alias("content"))


def _archive(spark: SparkSession, d: str) -> DataFrame:
    """The archive in a file for each conversation with an even id: its first two turns, the second without a text."""
    entry = F.struct(F.col("role").alias("desc"), F.when(F.col("turn") == 0, _ref()).otherwise("").alias("contentPath"))
    turns = _t(spark, d, "conversations").filter("conv_id % 2 = 0 and turn < 2").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").cast("string").alias("k"), entry.alias("v")))).alias("e"))
    meta = F.struct(F.struct(F.map_from_entries("e").alias("avgs")).alias("actArchiveResData"))
    return turns.select(F.lit("story_review_meta_table.json").alias("table"), F.to_json(meta).alias("content"))


_EVENT_NAME = "case when conv_id % 2 = 0 then cast(conv_id as varchar) else 'event ' || conv_id end"


@registered(f"""select cast(conv_id as varchar) as event_id, {_EVENT_NAME} as event_name, cast(row_number() over (partition by conv_id order by turn) - 1 as integer) as pos, cast(turn as varchar) as "storyCode",
    role as "avgTag", 'n' || turn as "storyName", conv_id || '/' || turn as "storyTxt", cast(turn % 2 as integer) as "storySort" from conversations""")
def chapter_enumeration(spark: SparkSession, d: str) -> DataFrame:
    return story.chapters_of(_story_tables(spark, d)).select("event_id", "event_name", "pos", "storyCode", "avgTag", "storyName", "storyTxt", "storySort")


@registered("""select ref, count(*) as n from (select conv_id || '/' || turn as ref from conversations union all select conv_id || '/0' from conversations where conv_id % 2 = 0 and turn = 0) t group by ref""")
def story_references(spark: SparkSession, d: str) -> DataFrame:
    named = story.story_references(_story_tables(spark, d).union(_archive(spark, d)))
    return named.groupBy("ref").agg(F.count("*").alias("n"))


@registered("""select conv_id || '/' || turn as "storyTxt", cast(row_number() over (partition by conv_id order by turn % 2, turn) as integer) as place from conversations where role <> 'system'""")
def chapter_order(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    have = _t(spark, d, "conversations").filter("role <> 'system'").select(_ref().alias("ref"))
    ordered = digest.chapter_order(story.chapters_of(_story_tables(spark, d)), have)
    return ordered.select("storyTxt", F.row_number().over(Window.partitionBy("event_id").orderBy("ord")).alias("place"))


@registered("""select role as "storyName", conv_id || '/0' as "storyTxt" from conversations where conv_id % 2 = 0 and turn = 0 and length(text) > 300""")
def extra_list(spark: SparkSession, d: str) -> DataFrame:
    done = _t(spark, d, "conversations").filter("length(text) > 300").select(_ref().alias("ref"))
    return story.extra_stories(story.archive_entries(_archive(spark, d)), done).select("storyName", "storyTxt")


@registered("select conv_id || '/' || turn as ref, turn % 3 = 0 as missing_source from conversations where role <> 'assistant'")
def pending_conversions(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "conversations")
    ref = _ref().alias("ref")
    return story.pending_conversions(rows.select(ref), rows.filter("role = 'assistant'").select(ref), rows.filter("turn % 3 <> 0").select(ref))


_ONE_LINE = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


def _scripts(spark: SparkSession, d: str) -> DataFrame:
    """Each turn as a script of one line, by role."""
    line = F.trim(F.regexp_replace("text", r"\s+", " "))
    by_role = F.when(F.col("role") == "user", F.concat(F.lit('[name="u"]'), line)).when(F.col("role") == "system", F.concat(F.lit("[Sticker(a=1)]"), line)).otherwise(line)
    return _t(spark, d, "conversations").select(_ref().alias("ref"), F.col("conv_id").cast("string").alias("event_id"), F.lit("info").alias("info"), F.when(F.col("turn") == 3, F.unhex(F.lit("FF"))).otherwise(by_role.cast("binary")).alias("content"))


@registered(f"select conv_id || '/' || turn as ref, case when turn <> 3 then length({_ONE_LINE}) end as words, turn = 3 as failed from conversations")
def story_conversion(spark: SparkSession, d: str) -> DataFrame:
    from .workers import importable

    importable(spark)
    return story.convert(_scripts(spark, d)).select("ref", "words", F.col("error").isNotNull().alias("failed"))


@registered(f"""select cast(e.conv_id as varchar) as event_id, c.ref as story_key, c.words from (select distinct conv_id from conversations) e
    left join (select conv_id, conv_id || '/' || turn as ref, length({_ONE_LINE}) as words from conversations where turn <> 3 and role = 'system') c on e.conv_id = c.conv_id""")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    from .workers import importable

    importable(spark)
    chapters = story.chapters_of(_story_tables(spark, d))
    return story.word_counts(chapters, story.convert(_scripts(spark, d).join(chapters.filter("avgTag = 'system'").select(F.col("storyTxt").alias("ref")), "ref", "left_semi")))


@registered("""select coalesce(n.k, o.k) as k, coalesce(n.v, o.v) as v from (select doc_id as k, source as v from documents) o full outer join (select item_id * 2 as k, 'new' as v from benchmark) n on o.k = n.k""")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    old = _t(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("source").alias("v"))
    return story.upsert(old, _t(spark, d, "benchmark").select((F.col("item_id") * 2).alias("k"), F.lit("new").alias("v")), ["k"])


# --- digests -----------------------------------------------------------------------------------------------------------


@registered(f"""select conv_id, sha256(coalesce(string_agg(line, chr(10) order by turn), '')) as text_sha from (select conv_id, turn, case role when 'user' then case when turn % 4 = 0 then '？？？' else 'u' end || '：' || {_ONE_LINE}
    when 'system' then '*' || {_ONE_LINE} || '*' else '【选项】' || {_ONE_LINE} || chr(10) || '【选项】go' end as line from conversations) t group by conv_id""")
def dialogue(spark: SparkSession, d: str) -> DataFrame:
    return _stories(spark, d).select("conv_id", sha256_hex(digest.dialogue(F.col("story"))).alias("text_sha"))


def _stories(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit(" <i>"), F.regexp_replace("text", r"\s+", " "), F.lit("</i> "))
    name = F.when(F.col("turn") % 4 == 0, "").otherwise("<b>u</b>")
    options = F.to_json(F.array(line, F.lit(""), F.lit("go")))
    item = F.when(F.col("role") == "user", F.create_map(F.lit("name"), name, F.lit("content"), line)).when(F.col("role") == "system", F.create_map(F.lit("text"), line)).otherwise(F.create_map(F.lit("options"), options))
    prop = F.when(F.col("role") == "user", "name").when(F.col("role") == "system", "Subtitle").otherwise("Decision")
    per = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.struct(F.col("turn").cast("int").alias("id"), prop.alias("prop"), F.to_json(item).alias("a"))))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: F.concat(F.lit('{"prop":"'), x["col2"]["prop"], F.lit('","attributes":'), x["col2"]["a"], F.lit("}"))), ",")
    return per.select("conv_id", F.concat(F.lit('{"storyList":['), body, F.lit("]}")).alias("story"))


@registered("select conv_id || '/' || turn as k, length(text) as v from conversations where conv_id % 2 = 0")
def pruned_cache(spark: SparkSession, d: str) -> DataFrame:
    cache = _t(spark, d, "conversations").select(_ref().alias("k"), F.length("text").cast("long").alias("v"))
    return digest.pruned(cache, _t(spark, d, "conversations").filter("conv_id % 2 = 0").select(_ref().alias("k")), "k")


@registered("select conv_id || '/' || turn as k from conversations where not (role = 'user' and length(text) > 200)")
def pending_chapters(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "conversations")
    return digest.pending(rows.select(_ref().alias("k")), rows.filter("role = 'user' and length(text) > 200").select(_ref().alias("k")), "k")


@registered(f"select conv_id || '/' || turn as k, case when turn % 5 = 4 then '（无对话内容）' else left({_ONE_LINE}, 800) end as summary, cast(null as varchar) as error from conversations")
def chapter_summaries(spark: SparkSession, d: str) -> DataFrame:
    from .workers import importable

    importable(spark)
    line = F.when(F.col("turn") % 5 == 4, " \n").otherwise(F.trim(F.regexp_replace("text", r"\s+", " ")))
    return digest.summarize(_t(spark, d, "conversations").select(_ref().alias("k"), line.alias("t")), "k", "t")


@registered("""select conv_id || '/' || turn as k, case when turn % 5 <> 4 then sha256('Summarise this chapter in its own language.' || chr(10) || 'Event: e' || conv_id || chr(10) || 'Chapter: ' ||
    case when turn % 2 = 0 then turn || ' ' else '' end || role || chr(10) || 'Part: ' || case when turn % 3 = 0 then '-' else role end || chr(10) || chr(10) || text) end as prompt_sha,
    sha256('Summarise this event in its own language.' || chr(10) || 'Event: e' || conv_id || chr(10) || chr(10) || text) as event_sha from conversations""")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    event = F.concat(F.lit("e"), F.col("conv_id").cast("string"))
    code = F.when(F.col("turn") % 2 == 0, F.col("turn").cast("string")).otherwise("")
    tag = F.when(F.col("turn") % 3 != 0, F.col("role"))
    made = digest.chapter_prompt(event, code, F.col("role"), tag, F.when(F.col("turn") % 5 == 4, " ").otherwise(F.col("text")))
    return _t(spark, d, "conversations").select(_ref().alias("k"), sha256_hex(made).alias("prompt_sha"), sha256_hex(digest.event_prompt(event, F.col("text"))).alias("event_sha"))


@registered("""select l_linenumber, '{' || concat_ws(',', case when a <> 0 then '"a":' || a end, case when b <> 0 then '"b":' || b end) || '}' as stats from
    (select l_linenumber, count(*) filter (where l_returnflag = 'A') as a, count(*) filter (where l_quantity > 49 and l_linenumber < 3) as b from lineitem group by l_linenumber) t""")
def sparse_stats(spark: SparkSession, d: str) -> DataFrame:
    counts = _t(spark, d, "lineitem").groupBy("l_linenumber").agg(F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if(F.expr("l_quantity > 49 and l_linenumber < 3")).alias("b"))
    return counts.select("l_linenumber", digest.sparse_object("a", "b").alias("stats"))


# --- bundles, artwork and packages ---------------------------------------------------------------------------------------

from .catalog import BUNDLE_SQL, INDEX_SQL  # noqa: E402


@registered(f"with {BUNDLE_SQL} select bundle, hash from cur where not exists (select 1 from orders where o_custkey = bundle and o_orderstatus = 'P')")
def authoritative_hashes(spark: SparkSession, d: str) -> DataFrame:
    failed = _t(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("bundle")).distinct()
    return state.saved_hashes(_bundles(spark, d)[0], failed)


@registered(f"with {BUNDLE_SQL} select bundle, hash from prv where not exists (select 1 from cur where cur.bundle = prv.bundle)")
def stale_cache(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _bundles(spark, d)
    return state.stale(previous, current)


@registered("select p_partkey as skin_id from part where p_size > 30 and not exists (select 1 from lineitem where l_partkey = p_partkey and l_quantity > 45)")
def coverage_guard(spark: SparkSession, d: str) -> DataFrame:
    new = _t(spark, d, "part").filter("p_size > 30").select(F.col("p_partkey").alias("skin_id"))
    return state.uncovered(new, _t(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("skin_id")))


@registered("""select l_orderkey as bundle, l_partkey as skin_id from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'O' and l_quantity <= 30
    union select l_orderkey, l_suppkey from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus in ('O', 'P') and o_orderkey in (select l_orderkey from lineitem where l_quantity > 49)
    except select l_orderkey, l_partkey from lineitem where l_quantity <= 30 and l_orderkey in (select l_orderkey from lineitem where l_quantity > 49)
        and (l_orderkey, l_partkey) not in (select l_orderkey, l_suppkey from lineitem)""")
def advanced_state(spark: SparkSession, d: str) -> DataFrame:
    """Bundles with a large quantity were processed; those of status F are gone, even where they were processed, and those of status P had none before."""
    items, orders = _t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "bundle"), _t(spark, d, "orders").select(F.col("o_orderkey").alias("bundle"), "o_orderstatus")
    processed = items.filter("l_quantity > 49").select("bundle").distinct()
    old = items.filter("l_quantity <= 30").join(orders.filter("o_orderstatus <> 'P'"), "bundle", "left_semi").select("bundle", F.col("l_partkey").alias("skin_id"))
    new = items.join(processed, "bundle", "left_semi").select("bundle", F.col("l_suppkey").alias("skin_id"))
    return state.next_candidates(old, new, orders.filter("o_orderstatus in ('O', 'P')"), processed)


_PLAN_SQL = """cur as (select 'chararts/' || c_custkey as bundle, sha256(c_name || case when c_acctbal < 0 then 'n' else '' end) as hash from customer where c_mktsegment in ('BUILDING', 'MACHINERY')),
    prv as (select 'chararts/' || c_custkey as bundle, sha256(c_name) as hash from customer where c_mktsegment <> 'MACHINERY' or c_custkey % 2 = 0)"""


@registered(f"""with {_PLAN_SQL} select 'download' as step, cur.bundle as name from cur left join prv on cur.bundle = prv.bundle where prv.hash is distinct from cur.hash
    union all select 'removed', bundle from prv where bundle not in (select bundle from cur) union all select 'new_skin', s_name from supplier""")
def fetch_plan(spark: SparkSession, d: str) -> DataFrame:
    from .factory import images_plan

    c = _t(spark, d, "customer")
    bundle = F.concat(F.lit("chararts/"), F.col("c_custkey").cast("string")).alias("bundle")
    hot = c.filter("c_mktsegment in ('BUILDING', 'MACHINERY')").select(bundle, sha256_hex(F.concat("c_name", F.when(F.col("c_acctbal") < 0, "n").otherwise(""))).alias("hash"))
    saved = c.filter("c_mktsegment <> 'MACHINERY' or c_custkey % 2 = 0").select(bundle, sha256_hex(F.col("c_name")).alias("hash"))
    plan = images_plan(hot, saved, None, _t(spark, d, "supplier").select(F.col("s_name").alias("skin_id")), None)
    named = lambda step, rows: rows.select(F.lit(step).alias("step"), F.col(rows.columns[0]).alias("name"))
    return named("download", plan["downloads"]).union(named("removed", plan["removed"])).union(named("new_skin", plan["new_skins"]))


@registered(f"""with {TEXTURE_SQL}, {SKIN_SQL}, tt as (select p_partkey % 7 as bundle, skin_id, 'Sprite' as kind, p_partkey as pos from sk union all select p_partkey % 7, skin_id, 'Texture2D', -p_partkey from sk
    union all select p_partkey % 7, skin_id, 'Sprite', p_partkey + 100000000 from sk)
    select bundle, skin_id, kind, pos from (select *, row_number() over (partition by bundle, skin_id order by case when kind = 'Sprite' then 0 else 1 end, pos) as rn from tt where skin_id is not null) x where rn = 1""")
def bundle_extraction(spark: SparkSession, d: str) -> DataFrame:
    one = _textures(spark, d).select((F.col("p_partkey") % 7).alias("bundle"), F.col("t").alias("name"), F.col("p_partkey").alias("p"))
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), pos.alias("pos")) for kind, pos in (("Sprite", F.col("p")), ("Texture2D", -F.col("p")), ("Sprite", F.col("p") + 100000000))])
    rows = one.select("bundle", "name", F.explode(kinds).alias("k")).select("bundle", "name", "k.kind", "k.pos")
    return art.extracted(rows).select("bundle", "skin_id", "kind", "pos")


_PNG = "'89504E470D0A1A0A0000000D49484452' || printf('%08X', w) || printf('%08X', h) || lpad(printf('%X', p_partkey), 8, '0')"
_PNG_SQL = f"png as (select p_partkey, 'char_' || p_partkey || case when p_size % 2 = 0 then '@a#1' else '#1' end as skin_id, w, h, {_PNG} as hx from (select p_partkey, p_size, p_size * 40 as w, p_size * 40 as h from part) t)"


def _pngs(spark: SparkSession, d: str) -> DataFrame:
    side = F.lpad(F.hex(F.col("p_size").cast("long") * 40), 8, "0")
    body = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), side, side, F.lpad(F.hex("p_partkey"), 8, "0")))
    return _t(spark, d, "part").select("p_partkey", F.concat(F.lit("char_"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 2 == 0, "@a#1").otherwise("#1")).alias("skin_id"), body.alias("content"))


@registered(f"""with {_PNG_SQL} select skin_id, case when position('@' in skin_id) > 0 then 'skin' else 'base' end as kind, case when position('@' in skin_id) > 0 then 'skinpack' else 'chararts' end as shard,
    skin_id || '.original.png' as file, cast(w as integer) as w, cast(h as integer) as h, 28 as bytes, sha256(from_hex(hx)) as sha256 from png where p_partkey % 3 <> 0""")
def artwork_index(spark: SparkSession, d: str) -> DataFrame:
    png = _pngs(spark, d)
    made = art.index(png.select(F.concat("skin_id", F.lit(".original.png")).alias("file"), "content"), png.filter("p_partkey % 3 <> 0").select("skin_id"))
    return made.select("skin_id", "kind", "shard", "original.*")


@registered(f"with {_PNG_SQL} select skin_id, case when p_partkey % 5 = 0 then 'skipped' else 'missing' end as problem from png where (p_partkey % 5 = 0) <> (p_partkey % 3 = 0)")
def index_gaps(spark: SparkSession, d: str) -> DataFrame:
    png = _pngs(spark, d)
    return art.index_gaps(png.filter("p_partkey % 5 = 0").select(F.concat("skin_id", F.lit(".original.png")).alias("file")), png.filter("p_partkey % 3 = 0").select("skin_id"))


def stamped(content: bytes, width: int, height: int) -> bytes:
    """Stands for scaling: the header with the new size alone."""
    return content[:16] + struct.pack(">II", width, height)


@registered(f"""with {_PNG_SQL} select skin_id || '.large.png' as file, case when p_partkey % 11 <> 0 then sha256(from_hex(case when w <= 1024 then hx else left(hx, 32) || '0000040000000400' end)) end as sha256, p_partkey % 11 = 0 as failed from png""")
def artwork_variants(spark: SparkSession, d: str) -> DataFrame:
    from .workers import importable

    importable(spark)
    content = F.when(F.col("p_partkey") % 11 == 0, F.lit("no png").cast("binary")).otherwise(F.col("content"))
    made = art.variants(_pngs(spark, d).select(F.concat("skin_id", F.lit(".original.png")).alias("file"), content.alias("content")), art.LARGE, "large", stamped)
    return made.select("file", F.sha2("content", 256).alias("sha256"), F.col("error").isNotNull().alias("failed"))


@registered(f"""with {INDEX_SQL}, ch as (select c.skin_id from cur c left join prv v on c.skin_id = v.skin_id where v.skin_id is null or c.o is distinct from v.o or c.l is distinct from v.l or c.p is distinct from v.p)
    select skin_id, tier, skin_id || '.' || tier || '.png' as file, not (tier = 'large' and skin_id % 4 = 0) as found from ch, (select unnest(['original', 'large', 'preview']) as tier) t""")
def delta_package_files(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _indexes(spark, d)
    files = delta.by_tier(current, ["skin_id"]).filter("not (tier = 'large' and skin_id % 4 = 0)").select(F.concat_ws(".", F.col("skin_id").cast("string"), "tier", F.lit("png")).alias("file"))
    wanted = delta.delta_files(current.withColumn("skin_id", F.col("skin_id").cast("string")), delta.delta(current, previous).withColumn("skin_id", F.col("skin_id").cast("string")), files)
    return wanted.withColumn("skin_id", F.col("skin_id").cast("long"))


@registered(f"""with {INDEX_SQL} select count(*) filter (where v.skin_id is null) as added, count(*) filter (where c.skin_id is not null and v.skin_id is not null and (c.o is distinct from v.o or c.l is distinct from v.l or c.p is distinct from v.p)) as changed,
    count(*) filter (where c.skin_id is null) as removed from cur c full outer join prv v on c.skin_id = v.skin_id""")
def package_counts(spark: SparkSession, d: str) -> DataFrame:
    return delta.package_counts(delta.delta(*_indexes(spark, d)))


@registered("""select l_returnflag as bundle, name, size from (select l_returnflag, cast(l_orderkey as varchar) || '/' || l_linenumber as name, l_quantity as size,
    row_number() over (partition by l_returnflag order by l_quantity desc, l_orderkey, l_linenumber) as rn from lineitem) t where rn <= 10""")
def sprites_by_bundle(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("bundle"), F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("name"), F.col("l_quantity").alias("size"), "l_orderkey", "l_linenumber")
    return statistics.top_per(rows, ["bundle"], [F.desc("size"), "l_orderkey", "l_linenumber"]).select("bundle", "name", "size")


@registered("select l_returnflag as bundle, count(*) as sprites, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem group by l_returnflag")
def sprite_totals(spark: SparkSession, d: str) -> DataFrame:
    return statistics.totals(_t(spark, d, "lineitem").select(F.col("l_returnflag").alias("bundle"), F.col("l_quantity").cast("long").alias("size")), "bundle", "size").withColumnsRenamed({"n": "sprites"})
