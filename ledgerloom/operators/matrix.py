"""Matrix pass: curated rules that name composite keys of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..storage import settle


def exploded(rules: DataFrame) -> DataFrame:
    """(rule_id, side, key) of rules (rule_id, rule); malformed rules are left out, repeated keys count once."""
    cut = rules.withColumn("m", S.split_matrix(F.col("rule"))).where("m is not null")
    sides = [cut.select("rule_id", F.lit(name).alias("side"), F.explode(f"m.{name}").alias("key")) for name in ("lhs", "rhs")]
    return sides[0].unionByName(sides[1]).withColumn("key", S.normalize_key(F.col("key"))).distinct()


def keyed(df: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """(row, key) of a ledger; keys that several rows have match nothing."""
    keys = df.select(row, S.normalize_key(S.build_key(*[F.col(c) for c in columns])).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias(row)).where("n = 1").select(row, "key")


def matches(rules: DataFrame, left_keys: DataFrame, right_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(l_id per rule, r_id per rule) of rules all of whose keys are there; of rules that share a row the first wins.

    A rule is one claim of a group: its left rows share its right rows. A rule that loses stands in nobody's way: rules
    that are first on all their rows win, those that share a row with a winner go, and so on until none is left.
    """
    keys = settle(exploded(rules))
    found = keys.where("side = 'lhs'").join(left_keys, "key").select("rule_id", "side", F.col("l_id").alias("row"), "key").unionByName(
        keys.where("side = 'rhs'").join(right_keys, "key").select("rule_id", "side", F.col("r_id").alias("row"), "key")
    )
    wanted = keys.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
    whole = found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("got")).join(wanted, "rule_id").where("n = got").select("rule_id")
    rest = settle(found.join(whole, "rule_id").select("rule_id", "side", "row"))
    won = rest.limit(0)
    while not rest.isEmpty():
        first = rest.groupBy("side", "row").agg(F.min("rule_id").alias("first"))
        beaten = rest.join(first, ["side", "row"]).where("rule_id <> first").select("rule_id").distinct()
        sure = settle(rest.join(beaten, "rule_id", "left_anti"))
        won = won.unionByName(sure)
        gone = rest.join(sure.select("side", "row"), ["side", "row"], "left_semi").select("rule_id").distinct()
        rest = settle(rest.join(gone, "rule_id", "left_anti"))
    return won.where("side = 'lhs'").select("rule_id", F.col("row").alias("l_id")), won.where("side = 'rhs'").select("rule_id", F.col("row").alias("r_id"))
