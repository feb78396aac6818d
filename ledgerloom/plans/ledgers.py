"""Ledgers: the canonical tables, and two test ledgers derived from orders and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

LEFT = """
select o_orderkey as l_id,
  concat('PL/', lpad(cast(o_custkey as {S}),6,'0'), '-', lpad(cast(o_orderkey as {S}),8,'0')) as PlacingNo,
  case o_orderkey % 3 when 0 then cast(10000+o_custkey as {S})
                      when 1 then concat('POL ', cast(10000+o_custkey as {S}), ' X')
                      else concat('A/B/', cast(10000+o_custkey as {S})) end as PolicyNo,
  c_name as ClientName, -cast(o_totalprice as decimal(18,2)) as Amount
from orders join customer on o_custkey = c_custkey
"""
RIGHT = """
with b as (select l.*, -Amount as P, l_id % 10 as k from left_ledger l),
     p as (select * from (values (1,0.50),(2,0.30),(3,0.20)) v(piece,w))
select l_id*10 as r_id,
  case when k=7 then null when k=8 then concat(PlacingNo,'X1') else PlacingNo end as PlacingNo,
  case when k=6 then null else cast(10000+cast(substr(PlacingNo,4,6) as int) as {S}) end as PolicyNo_1,
  case when k=6 then cast(10000+cast(substr(PlacingNo,4,6) as int) as {S}) end as PolicyNo_2,
  case when k=3 then concat('M/S ',ClientName,' LTD') else ClientName end as ClientName,
  cast(P + case when k<=3 then (l_id % 3)*40 when k=5 then 350 when k=6 then 150 else 0 end
       as decimal(18,2)) as Amount
from b where k not in (4,9)
union all
select l_id*10+piece, PlacingNo, cast(10000+cast(substr(PlacingNo,4,6) as int) as {S}), cast(null as {S}),
  ClientName, cast(round(P*w,2) as decimal(18,2))
from b, p where k=4
"""
# Ledgers whose rows contend: a nation's customers share one placing number, some amounts are split, missing or apart.
CONTESTED_LEFT = """
select c_custkey as l_id, concat('NATION', lpad(cast(c_nationkey as {S}),6,'0')) as PlacingNo,
  concat('POL ', cast(20000 + c_custkey % 50 as {S}), ' X') as PolicyNo, c_name as ClientName,
  case when c_custkey % 11 <> 0 then -cast(c_acctbal as decimal(18,2)) end as Amount
from customer
"""
CONTESTED_RIGHT = """
with b as (select c_custkey as id, concat('NATION', lpad(cast(c_nationkey as {S}),6,'0')) as PlacingNo, cast(20000 + c_custkey % 50 as {S}) as policy,
  c_name as ClientName, cast(c_acctbal as decimal(18,2)) as P, c_custkey % 6 as k from customer)
select id*10 as r_id, PlacingNo, case when k<>3 then policy end as PolicyNo_1, case when k=3 then policy end as PolicyNo_2, ClientName,
  cast(case k when 0 then P when 3 then P + 350 when 4 then P + 10000 end as decimal(18,2)) as Amount
from b where k not in (1,5)
union all
select id*10+piece, PlacingNo, policy, cast(null as {S}), case when piece = 1 then ClientName end, cast(round(P*w,2) as decimal(18,2))
from b, (select * from (values (1,0.60),(2,0.40)) v(piece,w)) q where k=1
"""


def clean_sql(left: str, right: str) -> str:
    """The same cleaning as clean_left and clean_right, as SQL for DuckDB."""
    return f"""
left_ledger as ({left.replace("{S}", "varchar")}),
right_ledger as ({right.replace("{S}", "varchar")}),
l as (
  select l_id, regexp_replace(upper(PlacingNo), '[^A-Z0-9]', '', 'g') as placing_no,
    case when PolicyNo is null then [] when len(PolicyNo) - len(replace(PolicyNo, '/', '')) > 1
      then list_transform(regexp_split_to_array(trim(PolicyNo), '\\s+'), lambda w: regexp_replace(w, '[^a-zA-Z0-9]', '', 'g'))
      when regexp_full_match(trim(PolicyNo), '\\d+') then [trim(PolicyNo)]
      else regexp_extract_all(PolicyNo, '\\b(\\d{{4,5}})\\b', 1) end as tokens,
    upper(trim(ClientName)) as name, Amount as amount
  from left_ledger
), r as (
  select r_id, regexp_replace(upper(PlacingNo), '[^A-Z0-9]', '', 'g') as placing_no,
    split_part(PolicyNo_1, '.', 1) as policy_1, PolicyNo_2 as policy_2, upper(trim(ClientName)) as name, Amount as amount
  from right_ledger
)"""


CLEAN_SQL = clean_sql(LEFT, RIGHT)
CONTESTED_SQL = clean_sql(CONTESTED_LEFT, CONTESTED_RIGHT)


def raw_ledgers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two test ledgers as they would come from files."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    left = spark.sql(LEFT.replace("orders join customer", "{orders} join {customer}").replace("{S}", "string"), orders=orders, customer=customer)
    right = spark.sql(RIGHT.replace("from left_ledger l)", "from {left_ledger} l)").replace("{S}", "string"), left_ledger=left)
    return left, right


def clean_left(left: DataFrame) -> DataFrame:
    """l_id, placing_no, tokens, name and amount of the left ledger (l_id, PlacingNo, PolicyNo, ClientName, Amount)."""
    return left.select("l_id", S.clean_key(F.col("PlacingNo")).alias("placing_no"), S.policy_tokens(F.col("PolicyNo")).alias("tokens"), S.clean_name(F.col("ClientName")).alias("name"), F.col("Amount").cast(S.AMOUNT).alias("amount"))


def clean_right(right: DataFrame) -> DataFrame:
    """r_id, placing_no, policy_1, policy_2, name and amount of the right ledger."""
    return right.select(
        "r_id", S.clean_key(F.col("PlacingNo")).alias("placing_no"), S.before_dot(F.col("PolicyNo_1")).alias("policy_1"), F.col("PolicyNo_2").alias("policy_2"),
        S.clean_name(F.col("ClientName")).alias("name"), F.col("Amount").cast(S.AMOUNT).alias("amount"),
    )


def ledgers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two test ledgers, cleaned."""
    left, right = raw_ledgers(spark, sf_dir)
    return clean_left(left), clean_right(right)


def contested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ledgers whose rows contend, cleaned."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    left, right = (spark.sql(text.replace("from customer", "from {customer}").replace("{S}", "string"), customer=customer) for text in (CONTESTED_LEFT, CONTESTED_RIGHT))
    return clean_left(left), clean_right(right)
