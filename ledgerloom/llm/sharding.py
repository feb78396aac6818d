"""Sharding by proportional stratified interleaving, in DataFrame functions alone.

Rows of each source are shuffled by a seeded md5, and a row of rank r among n gets the fractional rank (r - 1/2) / n.
All rows in order of fractional rank interleave the sources in proportion; cutting that order into equal runs gives
shards whose row counts differ by one at most and whose mixture is that of the table.

No rank is taken over a whole source or table in one task. The shuffle key is uniform, so its leading bits cut a
source into buckets of about BUCKET_ROWS rows: ranks inside a bucket plus the rows of the buckets before. Fractional
ranks are uniform too and are cut the same way.

Defined cases. A null text has size 1 and the crc32 of the empty text. Null source is a source of its own. Rows that
agree in doc_id are ordered by the md5 of their text; rows that agree in both are alike, so either order gives the
same result. An empty table gives no rows; with fewer rows than shards some shards are empty. Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import settle

#: Rows in a bucket, and beyond MOST_BUCKETS times these rows a larger share, so that bucket counts stay few.
BUCKET_ROWS = 1_000
MOST_BUCKETS = 10_000
#: Places where the rows of one source meet its totals.
SALTS = 64


def _ranked(df: DataFrame, group: list[str], bucket: str, order: list, out: str, base_over: Window) -> DataFrame:
    """df with `out`: the row's place (from 0) in its group, ordered by bucket and then by `order`."""
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_held"))
    before = base_over.rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*group, bucket, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order)) - 1
    # dealt by all keys of the window: a partitioning by the group alone would put a hot group into one task
    placed = df.repartition(*group, bucket).withColumn("_inside", inside)
    return placed.join(bases, [*group, bucket]).withColumn(out, F.col("_base") + F.col("_inside")).drop("_base", "_inside")


def interleave(df: DataFrame, shards: int = 8, seed: str = "shard", doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes and one), text_crc32, law, shard, slot, grown_shard (null), source."""
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("stratum"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.concat(key, F.md5(body)).alias("key"),
    )
    rows = settle(rows)  # narrow, so the text is read once
    per = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    per = per.select("*", F.sum("n").over(Window.partitionBy()).alias("total"))
    bucket_rows = F.greatest(F.lit(BUCKET_ROWS), F.ceil(F.col("total") / MOST_BUCKETS))
    held = F.ceil(F.col("n") / bucket_rows)
    uniform = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / float(16**13)
    # a hot source meets its totals in SALTS places
    salted = per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["stratum", "salt"]).drop("salt")
    rows = rows.withColumn("bucket", F.floor(uniform * held))
    ranked = _ranked(rows, ["stratum"], "bucket", [F.col("key")], "rank", Window.partitionBy("stratum").orderBy("bucket"))
    # (2 rank + 1) / (2 n) as a double; equal fractions fall into the key's order
    placed = ranked.withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("n")))
    placed = placed.withColumn("stretch", F.floor(F.col("fraction") * F.ceil(F.col("total") / bucket_rows)))
    placed = _ranked(placed, [], "stretch", [F.col("fraction"), F.col("key")], "place", Window.orderBy("stretch"))
    # shard s holds the places from ceil(s * total / shards) on
    shard = F.expr(f"cast((place * {shards}) div total as int)")
    first = F.expr(f"((shard * total) + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def crc_table() -> list[int]:
    """The 256 numbers of crc32, from its rule."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return out


def sql(shards: int = 8, seed: str = "shard") -> str:
    """The same over a table documents, as SQL for DuckDB; crc32 is written out, byte by byte."""
    return f"""
with h as (
  select doc_id, source, coalesce(text, '') as body, hex(encode(coalesce(text, ''))) as h,
    md5('{seed}:' || coalesce(cast(doc_id as varchar), 'null')) || md5(coalesce(text, '')) as key from documents
), b as (
  select *, list_prepend(4294967295::bigint, list_transform(range(1, length(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::bigint)) as b from h
), t as (
  select {crc_table()}::bigint[] as tb
), c as (
  select doc_id, source, key, cast(length(h) // 2 + 1 as bigint) as size,
    xor(list_reduce(b, lambda a, x: xor(a >> 8, tb[1 + (xor(a, x) & 255)])), 4294967295) as text_crc32 from b, t
), r as (
  select *, row_number() over (partition by source order by key) - 1 as rank, count(*) over (partition by source) as n, count(*) over () as total from c
), p as (
  select *, row_number() over (order by (2 * rank + 1) / (2 * n), key) - 1 as place from r
)
select doc_id, size, text_crc32, 'rows' as law, cast(place * {shards} // total as integer) as shard,
  cast(place - ((place * {shards} // total) * total + {shards - 1}) // {shards} as bigint) as slot, cast(null as integer) as grown_shard
from p
"""
