"""Mixing sources to target weights, in DataFrame functions alone.

Tokens are summed per source, each source gets a target, and target over size is its repetition rate. A document is
taken floor(rate) times, plus once more if a number in [0, 1) drawn from the md5 of seed and doc_id is below the
rate's fraction. Same rows and seed, same mix.

Targets. Sources in order of code point, null last, get the given weights in turn. They share `share` times all
tokens by weight; no target exceeds `most` times its source's tokens, and what that cuts off is shared again by
weight among the rest until no target is above. That is the water level L with sum(min(most * tokens, weight * L)) =
share * all tokens; sources sorted by tokens over weight are capped up to one place, found with running sums.

Defined cases. A null text has no tokens; its source counts all the same. Null source is a source of its own. A
null doc_id draws as the text "null". Rows with one doc_id draw alike. Sources without tokens have rate 0. An empty
table gives no rows. Other columns are kept, whatever their names; only a column called like the output gives way to it.
The sums make one row per source and task; the table of rates has one row per source and is joined, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import unused

#: Digits of the md5 that make the draw; 13 of them fit a double exactly.
DIGITS = 13
WORDS = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def draw(seed: str, doc_id: str) -> Column:
    """A number in [0, 1) that seed and doc_id fix."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    return F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def rates(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Per source of sizes (source, size): source_size, target and rate."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1)
    all_rows = Window.partitionBy()
    weighed = per.select("source", "source_size", turn.alias("weight")).select(
        "*",
        (F.col("source_size") * F.lit(float(most))).alias("cap"),
        F.sum("source_size").over(all_rows).alias("total"),
        F.sum("weight").over(all_rows).alias("all_weight"),
    )
    # the sources before a place are capped, those from it on share what is left; up to the first that isn't capped
    # these levels rise, after it they fall
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    placed = weighed.withColumn("level", level)
    open_ = F.col("weight") * F.col("level") <= F.col("cap")
    found = placed.withColumn("water", F.max(F.when(open_, F.col("level"))).over(all_rows))
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("water"), F.col("cap")))
    return found.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def mix(
    df: DataFrame,
    weights: list[int],
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    out: str = "mixed",
) -> DataFrame:
    """df with the struct column `out`: size, source_size, target, copies (how often the row is taken) and taken."""
    size, found = unused(df, "mix_size"), unused(df, "mix_rate")
    sized = df.withColumn(size, words(text))
    per = rates(sized.select(F.col(source).alias("source"), F.col(size).alias("size")), weights, share, most)
    per = per.select(F.struct("source", "source_size", "target", "rate").alias(found))
    joined = sized.join(per, F.col(source).eqNullSafe(F.col(f"{found}.source")), "left")
    rate = F.col(f"{found}.rate")
    copies = F.floor(rate) + F.when(draw(seed, doc_id) < rate - F.floor(rate), 1).otherwise(0)
    mixed = F.struct(
        F.col(size).alias("size"),
        F.col(f"{found}.source_size").alias("source_size"),
        F.col(f"{found}.target").alias("target"),
        copies.cast("int").alias("copies"),
        (F.col(size) * copies).cast("long").alias("taken"),
    )
    return joined.select(*[c for c in df.columns if c.lower() != out], mixed.alias(out))


def emit(df: DataFrame, weights: list[int], **options) -> DataFrame:
    """The rows of df, each as often as the mix takes it, with df's own columns."""
    out = unused(df, "mixed")
    taken = mix(df, weights, out=out, **options).where(F.col(f"{out}.copies") > 0)
    return taken.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col(f"{out}.copies"))).alias(unused(df, "copy"))).select(*df.columns)


def sql(weights: list[int], share: float = 1.5, most: float = 2.0, seed: str = "mix") -> str:
    """The same over a table documents, as SQL for DuckDB."""
    turns = " ".join(f"when {k} then {w}" for k, w in enumerate(weights))
    return f"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size from documents
), per as (
  select source, cast(sum(size) as bigint) as source_size from d group by source
), w as (
  select source, source_size, source_size * {float(most)!r}::double as cap, cast(sum(source_size) over () as bigint) as total,
    cast(case (row_number() over (order by source nulls last) - 1) % {len(weights)} {turns} end as double) as weight
  from per
), l as (
  select *, (total * {float(share)!r}::double - coalesce(sum(cap) over b, 0)) / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
  from w window b as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
), t as (
  select source, source_size,
    least(cap, coalesce(weight * (max(case when weight * level <= cap then level end) over ()), cap)) as target from l
), r as (
  select d.doc_id, d.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    cast(('0x' || substr(md5('{seed}:' || coalesce(cast(d.doc_id as varchar), 'null')), 1, {DIGITS})) as bigint) / {16**DIGITS}::double as u
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  cast(size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from r
"""
