"""Registered queries on the driver's tables, each with DuckDB text that computes the same another way.

Two snapshots stand for baseline and extraction: BASE is all of ``documents``; FRESH has the labelled documents, the toxic
ones with a changed text, and the benchmark items, which BASE lacks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import art_kind, art_shard, clean_rich_text, record_count, sha256_hex, version_of_tag
from ..operators import art, delta, digest, gates, overlay, release, state, statistics, story

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(sql: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, " ".join(sql.split())
        return f

    return keep


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- snapshots ---------------------------------------------------------------------------------------------------------

BASE_SQL = "base as (select source || '/' || lang || '/' || cast(doc_id as varchar) as path, source, lang, doc_id, text from documents)"
FRESH_SQL = """fresh as (select source || '/' || lang || '/' || cast(d.doc_id as varchar) as path, source, lang, d.doc_id as doc_id,
    case when l.toxic = 1 then d.text || '!' else d.text end as text from documents d join labels l on d.doc_id = l.doc_id
    union all select 'benchmark/en/' || cast(item_id as varchar), 'benchmark', 'en', item_id, text from benchmark)"""
OVER_SQL = f"""with {BASE_SQL}, {FRESH_SQL}, ov as (select coalesce(f.path, b.path) as path, coalesce(f.source, b.source) as source,
    case when b.path is null then 'added' when f.path is null then 'kept' when sha256(b.text) = sha256(f.text) then 'unchanged' else 'changed' end as status,
    sha256(coalesce(f.text, b.text)) as content_sha from base b full outer join fresh f on b.path = f.path)"""


def _snapshot(rows: DataFrame) -> DataFrame:
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return rows.select(path.alias("path"), "source", "lang", "doc_id", F.octet_length("text").alias("size"), sha256_hex(F.col("text")).alias("sha256"))


def _base(spark: SparkSession, d: str) -> DataFrame:
    return _snapshot(_t(spark, d, "documents"))


def _fresh(spark: SparkSession, d: str) -> DataFrame:
    labelled = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id")
    labelled = labelled.withColumn("text", F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    items = _t(spark, d, "benchmark").select(F.lit("benchmark").alias("source"), F.lit("en").alias("lang"), F.col("item_id").alias("doc_id"), "text")
    return _snapshot(labelled.select("source", "lang", "doc_id", "text").union(items))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    return overlay.overlay(_base(spark, d), _fresh(spark, d), size="size")


@registered(f"{OVER_SQL} select path, status, content_sha from ov")
def merge_overlay(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select("path", "status", F.col("sha256").alias("content_sha"))


@registered(f"""{OVER_SQL} select count(*) filter (status = 'added') as added, count(*) filter (status = 'changed') as changed,
    count(*) filter (status = 'unchanged') as unchanged, count(*) filter (status = 'kept') as kept_from_baseline from ov""")
def merge_stats(spark: SparkSession, d: str) -> DataFrame:
    return overlay.merge_stats(_merged(spark, d))


@registered(f"""{OVER_SQL} select status, path from (select status, path, row_number() over (partition by status order by path) as rn
    from ov where status in ('added', 'changed')) t where rn <= 50""")
def merge_first50(spark: SparkSession, d: str) -> DataFrame:
    return overlay.first_paths(_merged(spark, d))


@registered(f"with {BASE_SQL}, {FRESH_SQL} select b.path from base b where not exists (select 1 from fresh f where f.path = b.path)")
def kept_from_baseline(spark: SparkSession, d: str) -> DataFrame:
    return overlay.kept_from_baseline(_base(spark, d), _fresh(spark, d)).select("path")


@registered("select 'zh_CN/gamedata/' || lang || '/' || cast(doc_id as varchar) as path, sha256(text) as sha256 from documents where source = 'src1' and lang not like 'e_'")
def normalize_layout(spark: SparkSession, d: str) -> DataFrame:
    tree = _base(spark, d).withColumn("path", F.concat_ws("/", "source", F.lit("gamedata"), "lang", F.col("doc_id").cast("string")))
    return overlay.normalize_layout(tree, "src1", excluded=["zh_CN/gamedata/e?/*"]).select("path", "sha256")


# --- gates -------------------------------------------------------------------------------------------------------------


@registered(f"{OVER_SQL} select source, count(*) as n from ov group by source")
def record_counts(spark: SparkSession, d: str) -> DataFrame:
    return statistics.histogram(_merged(spark, d), "source")


@registered("""with cn as (select source, count(*) as n from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1) group by source),
    bn as (select source, count(*) as n from documents group by source)
    select cn.source, bn.n as baseline_n, cn.n as candidate_n from cn join bn on cn.source = bn.source where bn.n <> 0 and cn.n < bn.n * (1 - 0.05e0)""")
def record_regression(spark: SparkSession, d: str) -> DataFrame:
    docs, toxic = _t(spark, d, "documents"), _t(spark, d, "labels").filter("toxic = 1").select("doc_id")
    count = lambda x: statistics.histogram(x, "source")
    return gates.record_regression(count(docs), count(docs.join(toxic, "doc_id", "left_anti")), "source")


@registered(f"with {BASE_SQL} select source as root, count(*) as entries from (select source, path from base union select source, source || '/' || lang from base) t group by source")
def accumulation_counts(spark: SparkSession, d: str) -> DataFrame:
    return gates.accumulation(_base(spark, d).withColumn("root", F.col("source")))


@registered("""with probes as (select distinct p_brand as p from part union select r_name from region) select p as probe from probes where not exists (select 1 from part where p_brand = p)""")
def probe_exact(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    probes = part.select(F.col("p_brand").alias("probe")).union(_t(spark, d, "region").select("r_name")).distinct()
    return gates.absent_probes(probes, part, "probe", "p_brand")


@registered("""with probes as (select distinct substring(p_type, 2, 4) as p from part union select r_name from region)
    select p as probe from probes where not exists (select 1 from part where position(p in p_type) > 0 or position(p in p_name) > 0)""")
def probe_substring(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    probes = part.select(F.substring("p_type", 2, 4).alias("probe")).union(_t(spark, d, "region").select("r_name")).distinct()
    return gates.absent_substrings(probes, part, "probe", ["p_type", "p_name"])


@registered("select o_orderkey, o_orderpriority from orders where o_orderpriority is not null and not (o_orderpriority like '1-%' or o_orderpriority like '2-%')")
def enum_prefix_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.invalid_enum(_t(spark, d, "orders"), "o_orderkey", "o_orderpriority", ["1-", "2-"])


@registered("""with refs as (select distinct upper(lang) || '/' || cast(doc_id as varchar) as ref from documents union select 'X/' || cast(conv_id as varchar) from conversations),
    txt as (select lang || '/' || cast(d.doc_id as varchar) as rel from documents d join labels l on d.doc_id = l.doc_id),
    js as (select upper(lang) || '/' || cast(d.doc_id as varchar) as rel from documents d join labels l on d.doc_id = l.doc_id where l.quality = 1),
    idx as (select distinct lower(rel) as k from txt)
    select r.ref, case when i.k is not null then 'unconverted' else 'source_missing' end as status from refs r left join idx i on lower(r.ref) = i.k where not exists (select 1 from js where js.rel = r.ref)""")
def story_refs(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    labelled = docs.join(_t(spark, d, "labels"), "doc_id")
    named = lambda lang: F.concat_ws("/", lang, F.col("doc_id").cast("string")).alias("ref")
    refs = docs.select(named(F.upper("lang"))).union(_t(spark, d, "conversations").select(F.concat(F.lit("X/"), F.col("conv_id").cast("string"))))
    return gates.story_coverage(refs, labelled.select(named(F.col("lang"))), labelled.filter("quality = 1").select(named(F.upper("lang"))))


@registered("""select case when event_type is null then null else event_type end as event_type, count(*) as n from events group by 1""")
def type_histogram(spark: SparkSession, d: str) -> DataFrame:
    return statistics.histogram(_t(spark, d, "events"), "event_type")


@registered("select event_id, cast(len(json_keys(props)) as integer) as n_keys from events")
def json_record_count(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select("event_id", record_count(F.col("props")).alias("n_keys"))


@registered("select event_id, json_valid(props) as valid from events")
def strict_json(spark: SparkSession, d: str) -> DataFrame:
    from .workers import importable

    importable(spark)
    return gates.strict_json(_t(spark, d, "events"), "event_id", "props").select(F.col("event_id").cast("long").alias("event_id"), "valid")


# --- stories and digests -----------------------------------------------------------------------------------------------


@registered("""with txt as (select lang || '/' || cast(doc_id as varchar) as rel from documents),
    refs as (select distinct upper(lang) || '/' || cast(doc_id as varchar) as ref from documents union select lang || '/' || cast(d.doc_id as varchar) from documents d join labels l on d.doc_id = l.doc_id),
    idx as (select lower(rel) as k, min(rel) as actual from txt group by lower(rel))
    select r.ref as expected, i.actual from refs r join idx i on lower(r.ref) = i.k where i.actual <> r.ref and not exists (select 1 from txt where txt.rel = r.ref)""")
def case_fix(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    named = lambda lang: F.concat_ws("/", lang, F.col("doc_id").cast("string")).alias("ref")
    labelled = docs.join(_t(spark, d, "labels").select("doc_id"), "doc_id")
    return story.case_fixes(docs.select(named(F.upper("lang"))).union(labelled.select(named(F.col("lang")))), docs.select(named(F.col("lang"))))


@registered("""select k, id, name from (select split_part(s_name, '#', 1) || cast(s_nationkey as varchar) as k, s_suppkey as id, s_name as name,
    row_number() over (partition by split_part(s_name, '#', 1) || cast(s_nationkey as varchar) order by s_suppkey desc) as rn from supplier) t where rn = 1""")
def chardict_last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "supplier").select(F.concat(F.split_part("s_name", F.lit("#"), F.lit(1)), F.col("s_nationkey").cast("string")).alias("k"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return story.last_wins(rows, "k", "id")


@registered("""select conv_id, string_agg(line, chr(10) order by turn, line) as chapter_text from (select conv_id, turn, case role when 'user' then 'user：' || text when 'system' then '*' || text || '*' else '【选项】' || text end as line
    from conversations where text <> '') t group by conv_id""")
def chapter_text(spark: SparkSession, d: str) -> DataFrame:
    role, text = F.col("role"), F.col("text")
    line = F.when(role == "user", F.concat(F.lit("user："), text)).when(role == "system", F.concat(F.lit("*"), text, F.lit("*"))).otherwise(F.concat(F.lit("【选项】"), text))
    rows = _t(spark, d, "conversations").filter(text != "").withColumn("line", line)
    return digest.ordered_text(rows, "conv_id", F.struct("turn", "line"), F.col("line")).withColumnRenamed("text", "chapter_text")


@registered("select page_id, sha256(regexp_replace(regexp_replace(replace(html, '{@nickname}', '博士'), '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g')) as cleaned_sha from pages")
def clean_rich_texts(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "pages").select("page_id", sha256_hex(clean_rich_text(F.col("html"))).alias("cleaned_sha"))


@registered("""with ch as (select conv_id as event_id, cast(conv_id as varchar) || '/' || cast(turn as varchar) as story_key, role from conversations),
    cache as (select distinct story_key from ch where role <> 'assistant'), es as (select distinct event_id from ch where role = 'system')
    select ch.event_id, cast(sum(case when c.story_key is null then 1 else 0 end) as bigint) as pending_chapters, max(case when es.event_id is null then 1 else 0 end) as missing_event_summary
    from ch left join cache c on ch.story_key = c.story_key left join es on ch.event_id = es.event_id group by ch.event_id
    having sum(case when c.story_key is null then 1 else 0 end) > 0 or max(case when es.event_id is null then 1 else 0 end) = 1""")
def dirty_events(spark: SparkSession, d: str) -> DataFrame:
    ch = _t(spark, d, "conversations").select(F.col("conv_id").alias("event_id"), F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("story_key"), "role")
    return digest.dirty_events(ch, ch.filter("role <> 'assistant'"), ch.filter("role = 'system'"), "event_id", "story_key")


@registered("""with p as (select conv_id as event_id, turn, role, text from conversations where text is not null and text <> '')
    select event_id, count(*) as parts, sha256(case when count(*) <= 1 then left(min(text), 800) else string_agg('--- ' || cast(turn as varchar) || ' [' || role || '] ' || role || ' ---' || chr(10) || text, chr(10) || chr(10) order by turn, role, text) end) as text_sha from p group by event_id""")
def event_digest_inputs(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "conversations")
    parts = c.select(F.col("conv_id").alias("event_id"), F.struct("turn", "role", "text").alias("ord"), F.col("turn").cast("string").alias("code"), F.col("role").alias("tag"), F.col("role").alias("name"), "text")
    return digest.event_texts(parts).select("event_id", "parts", sha256_hex(F.col("text")).alias("text_sha"))


# --- bundles, state and index ------------------------------------------------------------------------------------------

BUNDLE_SQL = """cur as (select c_custkey as bundle, sha256(c_name || case when c_acctbal < 0 then 'n' else '' end) as hash from customer where c_mktsegment in ('BUILDING', 'MACHINERY')),
    prv as (select c_custkey as bundle, sha256(c_name) as hash from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name <> 'ASIA')"""


def _bundles(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = _t(spark, d, "customer")
    marked = F.concat("c_name", F.when(F.col("c_acctbal") < 0, "n").otherwise(""))
    current = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("bundle"), sha256_hex(marked).alias("hash"))
    place = _t(spark, d, "nation").join(_t(spark, d, "region").filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return current, c.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("bundle"), sha256_hex(F.col("c_name")).alias("hash"))


@registered(f"with {BUNDLE_SQL} select cur.bundle, case when prv.hash = cur.hash then 'unchanged' else 'download' end as action from cur left join prv on cur.bundle = prv.bundle")
def changed_bundles(spark: SparkSession, d: str) -> DataFrame:
    return state.bundle_actions(*_bundles(spark, d))


@registered(f"with {BUNDLE_SQL} select bundle from prv where bundle not in (select bundle from cur)")
def removed_bundles(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _bundles(spark, d)
    return state.removed(previous, current)


@registered(f"""with {BUNDLE_SQL}, chg as (select cur.bundle from cur left join prv on cur.bundle = prv.bundle where prv.hash is distinct from cur.hash),
    req as (select distinct o_custkey as bundle from orders where o_orderstatus = 'F') select bundle from req where bundle not in (select bundle from chg) and bundle in (select bundle from cur)""")
def forced_bundles(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _bundles(spark, d)
    changed = state.bundle_actions(current, previous).filter("action = 'download'")
    return state.forced(_t(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("bundle")), changed, current)


@registered("select s_name as skin_id from supplier where exists (select 1 from nation join region on n_regionkey = r_regionkey where n_nationkey = s_nationkey and r_name <> 'ASIA') and s_name not like 'token_%'")
def valid_ids_semi_join(spark: SparkSession, d: str) -> DataFrame:
    nations = _t(spark, d, "nation").join(_t(spark, d, "region").filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    characters = nations.select(F.concat(F.lit("char_"), F.col("n_nationkey").cast("string")).alias("key"))
    skins = _t(spark, d, "supplier").select(F.col("s_name").alias("skin_id"), F.concat(F.lit("char_"), F.col("s_nationkey").cast("string")).alias("char_id"))
    return state.valid_skins(skins, characters)


@registered("select distinct l_orderkey as bundle from lineitem where l_partkey in (select p_partkey from part where p_size > 45)")
def bundles_for_skins(spark: SparkSession, d: str) -> DataFrame:
    pairs = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("bundle"), F.col("l_partkey").alias("skin_id"))
    return state.bundles_for(pairs, _t(spark, d, "part").filter("p_size > 45").select(F.col("p_partkey").alias("skin_id")))


@registered("select distinct l_partkey as skin_id from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'P')")
def candidates_for_bundles(spark: SparkSession, d: str) -> DataFrame:
    pairs = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("bundle"), F.col("l_partkey").alias("skin_id"))
    return state.candidates_for(pairs, _t(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("bundle")))


@registered("select doc_id, case when position('@' in text) > 0 then 'skin' else 'base' end as kind, case when position('@' in text) > 0 then 'skinpack' else 'chararts' end as shard from documents")
def classify_shard(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", art_kind(F.col("text")).alias("kind"), art_shard(F.col("text")).alias("shard"))


INDEX_SQL = """cur as (select p_partkey as skin_id, sha256(p_name || case when p_size > 45 then 'n' else '' end) as o, sha256(p_brand || case when p_retailprice < 950 then 'n' else '' end) as l, sha256(p_type) as p from part where p_size > 5),
    prv as (select p_partkey as skin_id, sha256(p_name) as o, sha256(p_brand) as l, sha256(p_type || case when p_brand like '%5' then 'n' else '' end) as p from part where p_size < 48)"""


def _indexes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = _t(spark, d, "part")
    sha = lambda text, new: sha256_hex(F.concat(text, F.when(new, "n").otherwise("")))
    no = F.lit(False)
    tiers = lambda o, l, p: [F.col("p_partkey").alias("skin_id"), sha("p_name", o).alias("original"), sha("p_brand", l).alias("large"), sha("p_type", p).alias("preview")]
    current = part.filter("p_size > 5").select(*tiers(F.col("p_size") > 45, F.col("p_retailprice") < 950, no))
    return current, part.filter("p_size < 48").select(*tiers(no, no, F.col("p_brand").endswith("5")))


@registered(f"""with {INDEX_SQL} select coalesce(c.skin_id, v.skin_id) as skin_id, case when v.skin_id is null then 'added' when c.skin_id is null then 'removed' else 'changed' end as change
    from cur c full outer join prv v on c.skin_id = v.skin_id where v.skin_id is null or c.skin_id is null or c.o is distinct from v.o or c.l is distinct from v.l or c.p is distinct from v.p""")
def index_delta(spark: SparkSession, d: str) -> DataFrame:
    return delta.delta(*_indexes(spark, d))


@registered(f"with {INDEX_SQL} select c.skin_id, case when v.skin_id is not null then 'v0' else 'v1' end as since_version from cur c left join prv v on c.skin_id = v.skin_id")
def since_version(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _indexes(spark, d)
    return delta.since_version(current, previous.withColumn("since_version", F.lit("v0")), "v1").select("skin_id", "since_version")


@registered(f"""with {INDEX_SQL}, valid as (select p_partkey as skin_id from part where p_retailprice > 905), touched as (select p_partkey as skin_id from part where p_brand like '%3'),
    partial as (select * from cur where skin_id in (select p_partkey from part where p_brand like '%3' and p_size < 30))
    select skin_id, o as original from partial where skin_id in (select skin_id from valid)
    union all select skin_id, o from prv where skin_id in (select skin_id from valid) and skin_id not in (select skin_id from touched) and skin_id not in (select skin_id from partial)""")
def merge_incremental_index(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _indexes(spark, d)
    part = _t(spark, d, "part").withColumn("skin_id", F.col("p_partkey"))
    partial = current.join(part.filter(F.col("p_brand").endswith("3") & (F.col("p_size") < 30)).select("skin_id"), "skin_id", "left_semi")
    return state.merge_incremental(previous, partial, part.filter("p_retailprice > 905"), part.filter(F.col("p_brand").endswith("3"))).select("skin_id", "original")


@registered(f"""with {INDEX_SQL}, partial as (select p_partkey as skin_id from part where p_brand like '%3'), pairs as (select l_orderkey as bundle, l_partkey as skin_id from lineitem)
    select skin_id from partial union select skin_id from pairs where bundle in (select o_orderkey from orders where o_orderpriority like '1-%') union select skin_id from prv where skin_id not in (select skin_id from cur)""")
def affected_set(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _indexes(spark, d)
    pairs = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("bundle"), F.col("l_partkey").alias("skin_id"))
    partial = _t(spark, d, "part").filter(F.col("p_brand").endswith("3")).select(F.col("p_partkey").alias("skin_id"))
    orders = _t(spark, d, "orders").select(F.col("o_orderkey").alias("bundle"), "o_orderpriority")
    urgent = orders.filter(F.col("o_orderpriority").startswith("1-"))
    return state.affected(partial, pairs, urgent, orders.filter("o_orderpriority is null"), previous, current)


@registered("""with keep as (select l_orderkey as bundle, l_partkey as skin_id from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'F') and l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P'))
    select * from keep union select l_orderkey, l_suppkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'P')""")
def next_candidates(spark: SparkSession, d: str) -> DataFrame:
    items, orders = _t(spark, d, "lineitem"), _t(spark, d, "orders").select(F.col("o_orderkey").alias("bundle"), "o_orderstatus")
    old = items.select(F.col("l_orderkey").alias("bundle"), F.col("l_partkey").alias("skin_id"))
    processed = orders.filter("o_orderstatus = 'P'")
    new = items.select(F.col("l_orderkey").alias("bundle"), F.col("l_suppkey").alias("skin_id")).join(processed, "bundle", "left_semi")
    return state.next_candidates(old, new, orders.filter("o_orderstatus <> 'F'"), processed)


@registered("""with v(tier) as (values ('original'), ('large'), ('preview')), a as (select case when p_size > 25 then 'skinpack' else 'chararts' end as shard, p_size from part)
    select a.shard || '-' || v.tier as shard_key, count(*) as files, cast(sum(p_size) as bigint) as total_bytes from a cross join v group by 1""")
def shard_inventory(spark: SparkSession, d: str) -> DataFrame:
    index = _t(spark, d, "part").select(F.when(F.col("p_size") > 25, "skinpack").otherwise("chararts").alias("shard"), F.col("p_size").alias("bytes"))
    return delta.shard_inventory(index)


@registered("""with t as (select l_orderkey, l_linenumber, cast(floor(l_extendedprice) as bigint) % 3000 + 1 as w, (cast(floor(l_quantity) as bigint) * l_partkey) % 2500 + 1 as h from lineitem),
    g as (select *, cast(w as double) / h as a from t), c as (select *, floor(1024 * a) as xf, ceil(1024 * a) as xc, floor(1024 / a) as yf, ceil(1024 / a) as yc from g)
    select l_orderkey, l_linenumber, w, h,
    cast(case when w <= 1024 and h <= 1024 then w when a <= 1 then greatest(case when abs(a - xf / 1024) <= abs(a - xc / 1024) then xf else xc end, 1) else 1024 end as bigint) as lw,
    cast(case when w <= 1024 and h <= 1024 then h when a <= 1 then 1024 else greatest(case when yf = 0 or abs(a - 1024 / yf) <= abs(a - 1024 / yc) then yf else yc end, 1) end as bigint) as lh from c""")
def variant_dims(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.floor("l_extendedprice") % 3000 + 1).alias("w"), ((F.floor("l_quantity") * F.col("l_partkey")) % 2500 + 1).alias("h"))
    return art.planned_variants(rows).select("l_orderkey", "l_linenumber", "w", "h", F.col("large_w").alias("lw"), F.col("large_h").alias("lh"))


# --- releases ----------------------------------------------------------------------------------------------------------


@registered("""with loc as (select doc_id, n_chars as size, 'sha256:' || sha256(text) as digest from documents),
    rem as (select d.doc_id, n_chars + case when quality = 0 then 1 else 0 end as size, case when toxic = 1 then null else 'sha256:' || sha256(text) end as digest from documents d join labels l on d.doc_id = l.doc_id)
    select l.doc_id, l.size from loc l left join rem r on l.doc_id = r.doc_id where not coalesce(r.size = l.size and r.digest = l.digest, false)""")
def asset_mismatch(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents")
    sha = F.concat(F.lit("sha256:"), sha256_hex(F.col("text")))
    local = docs.select("doc_id", F.col("n_chars").alias("size"), sha.alias("digest"))
    remote = docs.join(_t(spark, d, "labels"), "doc_id").select("doc_id", (F.col("n_chars") + F.when(F.col("quality") == 0, 1).otherwise(0)).alias("size"), F.when(F.col("toxic") == 1, None).otherwise(sha).alias("digest"))
    return release.mismatched_assets(local, remote, "doc_id").select("doc_id", "size")


@registered("""select doc_id, nullif(regexp_extract(case lang when 'fr' then 'data-' when 'de' then 'v-' else 'gamedata-' end || source || case when n_chars > 1500 then '-v2' else '' end, '(?:data|upstream|gamedata)-(.+?)(?:-v[0-9]+)?$', 1), '') as version_id from documents""")
def parse_version_tag(spark: SparkSession, d: str) -> DataFrame:
    tag = F.concat(F.when(F.col("lang") == "fr", "data-").when(F.col("lang") == "de", "v-").otherwise("gamedata-"), F.col("source"), F.when(F.col("n_chars") > 1500, "-v2").otherwise(""))
    return _t(spark, d, "documents").select("doc_id", version_of_tag(tag).alias("version_id"))


@registered("""select version from (select cast(o_orderkey as varchar) as version, row_number() over (order by o_orderdate desc, 'images-' || cast(o_orderkey as varchar) desc) as rn from orders
    where o_orderstatus <> 'P' and o_orderpriority not like '5-%') t where rn = 1""")
def latest_release(spark: SparkSession, d: str) -> DataFrame:
    asset = F.struct(F.when(F.col("o_orderpriority").startswith("5-"), "notes.txt").otherwise("index.json").alias("name"))
    releases = _t(spark, d, "orders").select(F.concat(F.lit("images-"), F.col("o_orderkey").cast("string")).alias("tag"), (F.col("o_orderstatus") == "P").alias("is_draft"), F.col("o_orderdate").alias("created"), F.array(asset).alias("assets"))
    return release.latest_image_version(releases)


@registered("""select l_orderkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P') group by l_orderkey
    having count(distinct case when l_shipdate is not null and l_returnflag in ('A', 'N', 'R') then l_returnflag || l_linestatus end) filter (where l_returnflag || l_linestatus in ('NO', 'RF')) = 2""")
def complete_releases(spark: SparkSession, d: str) -> DataFrame:
    assets = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.collect_set(F.concat("l_returnflag", "l_linestatus")), lambda x: F.struct(x.alias("name"))).alias("assets"))
    releases = assets.join(_t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderstatus") == "P").alias("is_draft")), "l_orderkey")
    return release.complete(releases, ["NO", "RF"]).select("l_orderkey")


@registered("select c.c_custkey, (c.c_mktsegment is distinct from n.n_name) as changed from customer c left join nation n on c.c_nationkey = n.n_nationkey and c.c_acctbal > 0")
def version_gate(spark: SparkSession, d: str) -> DataFrame:
    c, n = _t(spark, d, "customer"), _t(spark, d, "nation")
    rows = c.join(n, (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("c_acctbal") > 0), "left")
    return rows.select("c_custkey", release.version_changed(F.col("c_mktsegment"), F.col("n_name")).alias("changed"))


# --- statistics --------------------------------------------------------------------------------------------------------


@registered("""select lang, count(*) as n, min(n_chars) as mn, max(n_chars) as mx, max(case when rn = cast(floor(n0 / 2) as bigint) + 1 then n_chars end) as p50, max(case when rn = cast(floor(n0 * 0.95e0) as bigint) + 1 then n_chars end) as p95
    from (select lang, n_chars, row_number() over (partition by lang order by n_chars, doc_id) as rn, count(*) over (partition by lang) as n0 from documents) t group by lang""")
def texture_summary(spark: SparkSession, d: str) -> DataFrame:
    return statistics.order_statistics(_t(spark, d, "documents"), "lang", "n_chars", {"p50": 0.5, "p95": 0.95})


@registered("select l_returnflag, coalesce(sum(l_discount) / nullif(sum(l_tax), 0), 0e0) > 1 as more from lineitem group by l_returnflag")
def bundle_ratio(spark: SparkSession, d: str) -> DataFrame:
    return statistics.ratio_by(_t(spark, d, "lineitem"), "l_returnflag", "l_discount", "l_tax").select("l_returnflag", (F.col("ratio") > 1).alias("more"))


@registered("select doc_id, n_chars from documents order by n_chars desc, doc_id limit 10")
def largest_files(spark: SparkSession, d: str) -> DataFrame:
    return statistics.top_by(_t(spark, d, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"])


@registered("select date_trunc('hour', ts) as start, event_type, count(*) as n from events group by 1, 2")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.poll import event_counts

    return event_counts(_t(spark, d, "events"))


from . import catalog_more  # noqa: E402, F401  registers its queries here
