"""Mixing sources to target weights by Poisson replication. Native: DataFrame functions alone.

A source with share w of a budget of B rows and n rows of its own has the mean repetition rate w * B / n. Each
document turns a hash of its id and a seed into a uniform number and inverts the Poisson distribution of its
source's rate with it: that many copies of it go out, none at all for some. Copies are dealt to partitions
and ordered in them by another hash, a global shuffle.

Rates above ``STEP`` are the sum of equal smaller rates, each with a hash of its own, so that exp(-rate) stays
far from underflow; nothing is capped.

Edge cases: a null source is a source of its own; a source without a target weight gets none; the weights of
sources without rows fall to the others in proportion. Rows with the same id and source get the same count, as
the hash is of the id; null ids hash as the string ``null``. Copies of equal rows go to the same partition. Texts may be
null, empty or of any length. An empty table gives an empty one. Column names of the input clash with nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared_store import written

STEP = 16.0  #: the largest rate that one hash inverts
TERMS = 96  #: the distribution is tabulated up to here; beyond lies less than 2**-80 at rate STEP
BROADCAST_SOURCES = 10_000  #: a table of rates with more sources is joined by a shuffle


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 hash, so that any engine can repeat it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _cdf(rate: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, ... at a rate, as an array."""
    first = F.exp(-rate)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda s, k: F.struct((s["p"] * rate / k.cast("double")).alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * rate / k.cast("double"))).alias("c")),
        lambda s: s["c"],
    )


def rates(docs: DataFrame, weights: dict[str, float] | None, temperature: float, budget: float | None, source: str) -> DataFrame:
    """One row per source: rows, rate. ``weights``: targets by source; None: proportional to rows ** temperature."""
    n = docs.groupBy(F.col(source).alias("__mix_source")).agg(F.count("*").alias("__mix_rows"))
    if weights is None:
        n = n.withColumn("__mix_weight", F.pow(F.col("__mix_rows").cast("double"), F.lit(temperature)) if temperature != 0.5 else F.sqrt(F.col("__mix_rows").cast("double")))
    else:
        given = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair]) if weights else F.create_map().cast("map<string,double>")
        n = n.withColumn("__mix_weight", F.coalesce(given[F.col("__mix_source").cast("string")], F.lit(0.0)))
    n = written(n, "mix-sources")
    total = n.agg(F.sum("__mix_rows").alias("rows"), F.sum("__mix_weight").alias("weight")).first()  # two numbers
    wanted = F.lit(float(total["rows"] or 0 if budget is None else budget))
    rate = F.col("__mix_weight") / F.lit(total["weight"]) * wanted / F.col("__mix_rows").cast("double") if total["weight"] else F.lit(0.0)
    return n.select("__mix_source", "__mix_rows", rate.alias("__mix_rate"))


def replicate(
    docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, budget: float | None = None, seed: int = 7, key: str = "doc_id", source: str = "source", shuffled: bool = True
) -> DataFrame:
    """All columns of each copy, and __mix_copy (from 0), __mix_n (copies of the row). ``budget``: rows wanted in all, as many as there are by default."""
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in named.items()])  # names of the input can't clash
    table = rates(docs.select(F.col(f"`{source}`").alias("source")), weights, temperature, budget, "source")
    parts = F.greatest(F.ceil(F.col("__mix_rate") / STEP), F.lit(1)).cast("int")
    table = table.select("__mix_source", parts.alias("__mix_parts"), _cdf(F.col("__mix_rate") / parts).alias("__mix_cdf"))
    known = table.limit(BROADCAST_SOURCES + 1).count()
    table = F.broadcast(table) if known <= BROADCAST_SOURCES else table.hint("merge")
    joined = rows.join(table, rows[named[source]].eqNullSafe(table["__mix_source"]))
    name = F.coalesce(F.col(named[key]).cast("string"), F.lit("null"))
    u = lambda i: uniform(F.lit(str(seed)), i.cast("string"), name)
    count = F.aggregate(F.sequence(F.lit(1), F.col("__mix_parts")), F.lit(0), lambda n, i: n + F.size(F.filter("__mix_cdf", lambda c: c <= u(i))))
    counted = joined.withColumn("__mix_n", count).filter("__mix_n > 0").drop("__mix_source", "__mix_parts", "__mix_cdf")
    copies = counted.withColumn("__mix_copy", F.explode(F.sequence(F.lit(0), F.col("__mix_n") - 1)))
    if shuffled:
        # Rows without an id have places by all that they hold, so many of them don't meet in one partition.
        held = [x for c, x in named.items() if not re.search("map<|variant", docs.schema[c].dataType.simpleString())]
        place = F.xxhash64(F.lit(seed), name, F.col("__mix_copy"), F.when(F.col(named[key]).isNull(), F.xxhash64(*held)))
        copies = copies.withColumn("__mix_place", place).repartition(F.col("__mix_place")).sortWithinPartitions("__mix_place")
    return copies.select(*named.values(), "__mix_copy", "__mix_n").toDF(*docs.columns, "__mix_copy", "__mix_n")


#: The same for DuckDB: weights by square root of rows, as many rows as there are, seed 7. TERMS ends the recursion.
REPLICATE_SQL = f"""
with recursive src as (select source, count(*) as n, sqrt(cast(count(*) as double)) as w from documents group by source),
tot as (select sum(n) as rows_all, sum(w) as w_all from src),
rate as (select source, case when w_all > 0 then w / w_all * cast(rows_all as double) / cast(n as double) else 0e0 end as r from src, tot),
step as (select source, cast(greatest(ceil(r / {STEP}e0), 1) as integer) as parts, r / greatest(ceil(r / {STEP}e0), 1) as s from rate),
cdf as (select source, s, 0 as k, exp(-s) as p, exp(-s) as c from step
        union all select source, s, k + 1, p * s / cast(k + 1 as double), c + p * s / cast(k + 1 as double) from cdf where k < {TERMS}),
tab as (select source, list(c order by k) as cs from cdf group by source),
draw as (select d.doc_id, d.source, i.i, cast(('0x' || substr(md5('7:' || i.i || ':' || coalesce(cast(d.doc_id as varchar), 'null')), 1, 13)) as bigint) / 4503599627370496e0 as u
         from (select distinct doc_id, source from documents) d join step s on d.source is not distinct from s.source, lateral (select unnest(range(1, s.parts + 1)) as i) i),
hit as (select draw.doc_id, draw.source, draw.i, len(list_filter(tab.cs, lambda x: x <= draw.u)) as n from draw join tab on draw.source is not distinct from tab.source),
cnt as (select doc_id, source, cast(sum(n) as integer) as n from hit group by doc_id, source)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, cast(c.i as integer) as copy, cnt.n as n_copies
from documents d join cnt on d.doc_id is not distinct from cnt.doc_id and d.source is not distinct from cnt.source, lateral (select unnest(range(0, cnt.n)) as i) c
"""
