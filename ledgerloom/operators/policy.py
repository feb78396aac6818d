"""Pass 2: policy number and name, on right rows that pass 1 left over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..storage import settle
from . import names
from .claims import State

#: A policy number that more names of both sides have is crowded: its names aren't compared one by one.
CROWD = 32


def pool(state: State, right: DataFrame, whole: bool = False) -> DataFrame:
    """Right rows that were some left row's fallback and aren't in a partial match; all right rows with `whole`."""
    if whole:
        return right
    ids = state.fallback.select("r_id").distinct().join(state.loosely_used(), "r_id", "left_anti")
    return right.join(ids, "r_id", "left_semi")


def _scored(mine: DataFrame, theirs: DataFrame, threshold: int) -> DataFrame:
    """(l_name, r_name, score) of names alike of mine (token, l_name) and theirs (token, r_name) that share a token."""
    met = mine.join(theirs, "token").select("l_name", "r_name").distinct()
    return met.withColumn("score", S.name_score(F.col("l_name"), F.col("r_name"))).where(F.col("score") >= threshold)


def hits(left: DataFrame, right: DataFrame, threshold: int = 95, most: int = CROWD) -> DataFrame:
    """(l_id, r_id, l_amount, r_amount, score): a policy number among the tokens, and names alike."""
    asks = left.select("l_id", F.col("name").alias("l_name"), F.col("amount").alias("l_amount"), F.explode(F.array_distinct("tokens")).alias("token")).where("token <> ''")
    numbers = F.array_distinct(F.filter(F.array("policy_1", "policy_2"), lambda p: p.isNotNull() & (p != "")))
    has = right.select("r_id", F.col("name").alias("r_name"), F.col("amount").alias("r_amount"), F.explode(numbers).alias("token"))
    asks, has = settle(asks), settle(has)
    # names meet by number before rows do, so rows of names that aren't alike are never joined; where many names share a
    # number, they are looked for among all of these names instead of being compared one by one
    mine, theirs = asks.select("token", "l_name").distinct(), has.select("token", "r_name").distinct()
    many = lambda d: d.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("token")
    crowd = settle(many(mine).join(many(theirs), "token", "left_semi")) if threshold > 50 else None
    if crowd is None or crowd.isEmpty():
        pairs = _scored(mine, theirs, threshold)
    else:
        of = lambda d, c: d.join(crowd, "token", "left_semi").select(F.col(c).alias("name"))
        alone = lambda d: d.join(crowd, "token", "left_anti")
        pairs = _scored(alone(mine), alone(theirs), threshold).unionByName(names.alike(of(mine, "l_name"), of(theirs, "r_name"), threshold)).distinct()
    met = asks.join(pairs, "l_name").join(has, ["token", "r_name"]).dropDuplicates(["l_id", "r_id"])
    return met.select("l_id", "r_id", "l_amount", "r_amount", "score")


def offers(found: DataFrame, tolerance: float = 100) -> DataFrame:
    """One offer per left row: all its hits together, if their sum is in a tier (close counts as exact)."""
    per = found.groupBy("l_id").agg(
        F.count(F.lit(1)).alias("size"), F.max("score").alias("score"), S.difference(F.first("l_amount"), F.coalesce(F.sum("r_amount"), F.lit(0).cast(S.AMOUNT))).alias("diff")
    )
    tier, sure = S.amount_tier(F.col("diff"), tolerance), S.confidence(F.col("diff"), tolerance)
    rated = per.withColumn("tier", tier).withColumn("confidence", sure).where(F.col("tier") != "NO_MATCH")
    kind = F.when(F.col("tier").isin(S.LOOSE), 2).otherwise(0)
    amount = F.when(F.col("size") == 1, "Single Amount Match").otherwise("Cumulative Amount Match")
    close = F.when(F.col("tier") == "CLOSE_MATCH", "Close ").otherwise("")
    reason = F.concat(F.lit("Policy + Name Match (CS: "), F.col("score").cast("string"), F.lit("%) + "), close, amount, F.lit(" ("), F.col("confidence"), F.lit(" Confidence, "), S.money(F.col("diff")), F.lit(")"))
    return rated.select("l_id", kind.alias("kind"), "size", "confidence", "diff", reason.alias("reason"))
