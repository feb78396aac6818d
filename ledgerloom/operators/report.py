"""Reports: links with both sides' columns, sets of right rows, statistics, and the ten tables of the workbook."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .claims import EXACT, NO, PARTIAL, State


# The sheets of the workbook, in order.
SHEETS = [
    "exact match cbl",
    "partial match cbl",
    "not found cbl",
    "exact match insurer",
    "partial match insurer",
    "not found insurer",
    "Exact Matches",
    "Partial Matches",
    "No Matches CBL",
    "No Matches Insurer",
]


def final_decisions(state: State) -> tuple[DataFrame, DataFrame]:
    """(decisions, links) after the last correction: rows claimed exactly leave partial matches, empty ones are none."""
    exact = state.own.where(F.col("status") == EXACT)
    loose = state.own.where(F.col("status") == PARTIAL).join(exact.select("r_id"), "r_id", "left_anti")
    links = exact.unionByName(loose.select(*exact.columns))
    has = links.select("l_id")
    if state.shared is not None:
        shared = state.shared.without(exact.select("r_id"))
        links = links.unionByName(shared.listed().withColumn("status", F.lit(PARTIAL)))
        has = has.unionByName(shared.holders())
    has = has.distinct().withColumn("has", F.lit(True))
    none = (F.col("status") == PARTIAL) & F.col("has").isNull()
    decisions = state.decisions.join(has, "l_id", "left").withColumn("status", F.when(none, NO).otherwise(F.col("status"))).drop("has")
    return decisions, links


def explode_merge(left: DataFrame, right: DataFrame, decisions: DataFrame, links: DataFrame) -> DataFrame:
    """One row per link, and one for left rows without any; left columns only on a left row's first link.

    l_id and pos stay, so that the order of the rows is known.
    """
    order = Window.partitionBy("l_id").orderBy("r_id")
    numbered = links.select("l_id", "r_id", (F.row_number().over(order) - 1).alias("pos"))
    of_left = left.join(decisions, "l_id").withColumnRenamed("l_id", "_l")
    rows = of_left.join(numbered, F.col("_l") == F.col("l_id"), "left").drop("l_id").withColumn("pos", F.coalesce("pos", F.lit(0)))
    shown = [F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in of_left.columns if c != "_l"]
    of_right = right.select(F.col("r_id"), *[F.col(c).alias(f"{c}_right") for c in right.columns if c != "r_id"])
    return rows.select(F.col("_l").alias("l_id"), "pos", "r_id", *shown).join(of_right, "r_id", "left")


def coverage(right: DataFrame, links: DataFrame) -> DataFrame:
    """(r_id, amount, status) of every right row: exact, partial only, or unmatched."""
    best = links.groupBy("r_id").agg(F.min(F.when(F.col("status") == EXACT, 0).otherwise(1)).alias("best"))
    status = F.when(F.col("best") == 0, EXACT).when(F.col("best") == 1, PARTIAL).otherwise(NO)
    return right.select("r_id", "amount").join(best, "r_id", "left").select("r_id", "amount", status.alias("status"))


def left_stats(left: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row: numbers and amounts of left rows by status."""
    rows = left.select("l_id", "amount").join(decisions.select("l_id", "status"), "l_id")
    out = []
    for name, status in (("exact", EXACT), ("partial", PARTIAL), ("no", NO)):
        out += [F.count_if(F.col("status") == status).alias(f"{name}_matches"), F.coalesce(F.sum(F.when(F.col("status") == status, F.col("amount"))), F.lit(0)).cast("decimal(28,2)").alias(f"{name}_match_amount")]
    return rows.agg(*out)


def right_stats(covered: DataFrame) -> DataFrame:
    """One row: numbers, rates and amounts of right rows by coverage; rates are null without right rows."""
    names = (("exact_match", EXACT), ("partial_match", PARTIAL), ("unmatched", NO))
    n = F.count(F.lit(1))
    out = [n.alias("total_rows")]
    for name, status in names:
        is_ = F.col("status") == status
        out += [F.count_if(is_).alias(f"{name}_rows"), F.try_divide(F.count_if(is_) * F.lit(100.0), n).alias(f"{name}_rate"), F.coalesce(F.sum(F.when(is_, F.col("amount"))), F.lit(0)).cast("decimal(28,2)").alias(f"{name}_amount")]
    return covered.agg(*out)


def tables(left: DataFrame, right: DataFrame, decisions: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """The ten tables of the workbook by sheet name."""
    of = lambda s: left.join(decisions.where(F.col("status") == s), "l_id")
    covered = coverage(right.withColumn("amount", F.lit(None)) if "amount" not in right.columns else right, links).select("r_id", "status")
    side = lambda s: right.join(covered.where(F.col("status") == s).select("r_id"), "r_id", "left_semi")
    merged = lambda s: explode_merge(left, right, decisions.where(F.col("status") == s), links)
    left_only, right_only = [of(x) for x in (EXACT, PARTIAL, NO)], [side(x) for x in (EXACT, PARTIAL, NO)]
    return dict(zip(SHEETS, [*left_only, *right_only, merged(EXACT), merged(PARTIAL), left_only[2], right_only[2]], strict=True))
