"""Queries of sources, mappings and folders, and of passes that follow each other, with SQL for DuckDB that tells the same."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import report
from ..sources import ingest, xlsx
from ..storage import new_folder, settle
from ..streaming import landing
from . import ledgers as L
from . import reconcile as R
from . import workbooks
from .queries import CAND, ORACLES, QUERIES, plain, query

__all__ = ["ORACLES", "QUERIES"]  # of this module and of queries

# Passes that follow each other


@query(f"{CAND} select l_id, case status when 'Exact Match' then '1' else '1,2' end as passes from after1", contested=True)
def passes_tried(spark, sf_dir, ledgers=L.ledgers):
    """The passes that looked at each left row: the second one only at rows that the first left open."""
    left, right = (settle(d) for d in ledgers(spark, sf_dir))
    return R.tried(left, right, R.Profile(passes=("1", "2"))).select("l_id", F.array_join("passes", ",").alias("passes"))


@query(
    f"""{CAND}, hit2 as (
  select l.l_id, r.r_id, l.amount as l_amount, r.amount as r_amount
  from (select *, unnest(list_distinct(tokens)) as token from l where l_id in (select l_id from after1 where status <> 'Exact Match')) l
  join (select *, unnest(list_distinct(list_filter([policy_1, policy_2], lambda p: p is not null and p <> ''))) as token from r) r on l.token = r.token
  where contains(l.name, r.name) or contains(r.name, l.name)
), o2 as (
  select *, case when diff <= 200 then 0 else 2 end as kind from (
    select l_id, count(*) as size, abs(any_value(l_amount) + coalesce(sum(r_amount), 0)) as diff from hit2 group by l_id) where diff <= 1000
), free2 as (
  select h.l_id, h.r_id, kind, size from hit2 h join o2 on h.l_id = o2.l_id where h.r_id not in (select r_id from own)
), sure2 as (
  select l_id, r_id from (select *, row_number() over (partition by r_id order by size desc, l_id) as n from free2 where kind = 0) where n = 1
)
select l_id, r_id, 'Exact Match' as status from own
union all select l_id, r_id, 'Exact Match' from sure2
union all select l_id, r_id, 'Partial Match' from free2 where kind = 2 and r_id not in (select r_id from sure2)
union all select l_id, r_id, 'Partial Match' from loosely where l_id not in (select l_id from o2) and r_id not in (select r_id from sure2)""",
    contested=True)
def pass2_steals(spark, sf_dir, ledgers=L.ledgers):
    """Links after two passes over whole ledgers: what the second claims leaves the first one's partial matches."""
    left, right = (settle(d) for d in ledgers(spark, sf_dir))
    state = R.reconcile(left, right, replace(R.MODULAR, passes=("1", "2"), whole_pool=True))
    return report.final_decisions(state)[1].select("l_id", "r_id", "status")


# Mappings


@plain(
    "hybrid_mapping",
    """select n_nationkey, s as source, t as target from nation, (values ('PlacingNo', 'PlacingNo'), ('Amount', 'Amount')) v(s, t)
union all select n_nationkey, 'Ref', 'ClientName' from nation where n_nationkey % 3 = 0
union all select n_nationkey, n_name, 'PolicyNo' from nation where n_nationkey % 3 = 0""",
)
def hybrid_mapping(spark, sf_dir):
    """Mappings of many files: own names, overlaid by a JSON text that may be broken or missing."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    text = F.concat(F.lit('{"Ref": "ClientName", "gone": "Amount", "'), "n_name", F.lit('": "PolicyNo", }'))
    forms = F.when(F.col("n_nationkey") % 3 == 0, text).when(F.col("n_nationkey") % 3 == 1, F.lit('{"Ref": "ClientName"'))
    columns = F.array(F.lit("PlacingNo"), F.lit("Ref"), F.lit("Amount"), F.col("n_name"))
    return nation.select("n_nationkey", F.explode(ingest.hybrid(columns, ingest.LEFT_NAMES, forms)).alias("source", "target"))


@plain(
    "matrix_list",
    """select cast(s_suppkey as bigint) as rule_id, s_name || '|' || s_suppkey as rule from supplier join nation on s_nationkey = n_nationkey
where lower(n_name) = 'nation_9' and s_suppkey % 4 <> 0""",
)
def matrix_list(spark, sf_dir):
    """The rules of one insurer's folder; blank ones are none."""
    supplier, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    key = F.when(F.col("s_suppkey") % 4 == 0, F.lit("  ")).otherwise(F.concat("s_name", F.lit("|"), F.col("s_suppkey").cast("string")))
    items = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("folder"), F.col("s_suppkey").cast("long").alias("position"), key.alias("matrix_key"))
    return ingest.matrix_list(items, "Nation_9")


@plain(
    "mapped_columns",
    """select cast(c_custkey as varchar) as "PlacingNo_INSURER", case when c_custkey % 2 = 0 then c_name else 'other ' || c_name end as "ClientName_INSURER",
  c_mktsegment as "segment_INSURER", '0' as "Amount", cast(null as varchar) as "PolicyNo", 'PolicyNo,Amount' as missing from customer""",
)
def mapped_columns(spark, sf_dir):
    """Columns renamed, merged, dropped, marked and filled, and which names were missing."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    raw = customer.select(
        F.col("c_custkey").cast("string").alias("ref"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), F.concat(F.lit("other "), "c_name").alias("other name"),
        F.col("c_mktsegment").alias("segment"), F.lit("x").alias("Unnamed: 4"),
    )
    custom = {"ref": "PlacingNo", "name": "ClientName", "other name": "ClientName", "gone": "Amount"}
    named = ingest.apply_mapping(raw, ingest.column_mapping(raw.columns, ingest.LEFT_NAMES, custom), "_INSURER")
    plain_names = named.toDF(*[c.removesuffix("_INSURER") for c in named.columns])
    missing = ingest.check_columns(plain_names, ingest.LEFT_NAMES)
    return ingest.fill_missing(ingest.fill_missing(named, ["Amount"], "0"), ["PolicyNo"]).withColumn("missing", F.lit(",".join(missing)))


# Workbooks and folders


@plain(
    "workbook_round_trip",
    """select 'PL' || lpad(cast(c_custkey as varchar), 8, '0') as placing, c_name as client, cast(c_acctbal as double) as amount, c_mktsegment as sheet,
  (select count(distinct s.c_mktsegment) from customer s where s.c_mktsegment < customer.c_mktsegment) * 2097152
    + row_number() over (partition by c_mktsegment order by c_custkey) - 1 as place
from customer""",
)
def workbook_round_trip(spark, sf_dir):
    """Customers written to a workbook, a sheet for each segment, and read back as one ledger: headers found, sheets merged."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").orderBy("c_custkey")
    columns = [
        F.concat(F.lit("PL"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("Placing No."), F.col("c_name").alias("Client Name"),
        F.lit("10001").alias("Policy No."), F.col("c_acctbal").cast("double").alias("Balance (MUR)"), F.lit("MUR").alias("Currency"),
    ]
    segments = sorted(r[0] for r in customer.select("c_mktsegment").distinct().collect())
    path = f"{new_folder(spark, 'book')}/book.xlsx"
    xlsx.write_workbook({s: customer.where(F.col("c_mktsegment") == s).select(*columns) for s in segments}, path, spark)
    found = workbooks.read_ledger(spark, path)
    return found.select(
        F.col("`Placing No.`").alias("placing"), F.col("`Client Name`").alias("client"), S.to_amount(F.col("`Balance (MUR)`")).cast("double").alias("amount"),
        F.col("_source_sheet").alias("sheet"), F.col(ingest.PLACE).alias("place"),
    )


@plain(
    "sheet_groups",
    """select n_name as sheet, min(n_name) over (partition by n_nationkey % 3) as grp from nation""",
)
def sheet_groups(spark, sf_dir):
    """Sheets with the first sheet of their group: column names alike in other case, with white space or one more."""
    names = {r["n_name"]: r["n_nationkey"] for r in spark.read.parquet(f"{sf_dir}/nation.parquet").collect()}  # a workbook's sheets
    base = [[f"{kind}{i}" for i in range(5)] for kind in ("a", "b", "c")]
    columns = {n: [f" {c.upper()}" for c in base[k % 3]] + ["more"] * (k % 2) for n, k in sorted(names.items())}
    rows = [(sheet, group[0]) for group in ingest.group_sheets(columns) for sheet in group]
    return spark.createDataFrame(rows, "sheet string, grp string")


@plain(
    "landing_pairs",
    """select '/in/' || n_name || '/' || c_custkey as folder, '/in/' || n_name || '/' || c_custkey || '/CBL 2024.XLSX' as "left",
  '/in/' || n_name || '/' || c_custkey || '/ins.xlsx' as "right" from customer join nation on c_nationkey = n_nationkey where c_custkey % 4 = 0""",
)
def landing_pairs(spark, sf_dir):
    """Folders of two workbooks of which one is the left ledger: others hold one, three, or two without a left one."""
    customer, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation"))
    folder = F.concat(F.lit("/in/"), "n_name", F.lit("/"), F.col("c_custkey").cast("string"))
    names = [["CBL 2024.XLSX", "ins.xlsx", "notes.txt"], ["cbl.xlsx"], ["cbl.xlsx", "a.xlsx", "b.xlsx"], ["a.xlsx", "b.xlsx"]]
    files = F.get(F.array(*[F.array(*[F.lit(x) for x in n]) for n in names]), (F.col("c_custkey") % 4).cast("int"))
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(folder.alias("folder"), F.explode(files).alias("name"))
    return landing.ledger_files(rows.select(F.concat("folder", F.lit("/"), "name").alias("path")))


@plain(
    "landing_status",
    """select cast(o_custkey as varchar) as folder, arg_max(case o_orderkey % 3 when 0 then ' Pending' when 1 then 'In Progress' else 'Manual Review' end, o_orderkey) as status
from orders group by o_custkey having max(o_orderkey) % 3 = 0""",
)
def landing_status(spark, sf_dir):
    """Folders that wait, by their latest status."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.get(F.array(F.lit(" Pending"), F.lit("In Progress"), F.lit("Manual Review")), (F.col("o_orderkey") % 3).cast("int"))
    rows = settle(orders.select(F.col("o_custkey").cast("string").alias("folder"), status.alias("status"), F.timestamp_seconds("o_orderkey").alias("at")))
    return landing.latest(rows).join(landing.pending(rows), "folder")
