"""Pass 3: names alike, by totals of groups, single rows and what is left over together."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..storage import settle


def groups(left: DataFrame, right: DataFrame, pairs: DataFrame, tolerance: float = 100) -> DataFrame:
    """Pairs of names whose totals agree: l_name, r_name, score, n_left, n_right, l_total, r_total, diff, rank.

    Rank: more right rows first, then the names' first rows.
    """
    per = lambda d, k, s: d.where("name is not null").groupBy(F.col("name").alias(f"{s}_name")).agg(F.count(F.lit(1)).alias(f"n_{k}"), F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(28,2)").alias(f"{s}_total"), F.min(f"{s}_id").alias(f"{s}_first"))
    met = pairs.join(per(left, "left", "l"), "l_name").join(per(right, "right", "r"), "r_name")
    near = met.withColumn("diff", S.difference(F.col("l_total"), F.col("r_total"))).where(F.col("diff") <= F.lit(tolerance).cast(S.AMOUNT))
    return near.select("l_name", "r_name", "score", "n_left", "n_right", "l_total", "r_total", "diff", F.struct((-F.col("n_right")).alias("size"), "l_first", "r_first").alias("rank"))


def settled_groups(found: DataFrame) -> DataFrame:
    """Groups in order of rank, each applied if neither name is in an applied one of lower rank.

    A pair of least rank on both its sides is sure; pairs that share a name with a sure one go, and so on until none is
    left: every round settles the pair of least rank of all at least. Groups with more left than right rows are never
    applied, so they stand in nobody's way.
    """
    rest = settle(found.where("n_left <= n_right"))
    out = None
    while not rest.isEmpty():
        least = lambda side: F.min("rank").over(Window.partitionBy(side))
        sure = settle(rest.withColumn("a", least("l_name")).withColumn("b", least("r_name")).where("rank = a and rank = b").drop("a", "b"))
        out = sure if out is None else out.unionByName(sure)
        rest = settle(rest.join(sure.select("l_name"), "l_name", "left_anti").join(sure.select("r_name"), "r_name", "left_anti"))
    return rest if out is None else out


def distributed(applied: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(l_id, r_id, score, diff): the i-th left row of an applied group gets its i-th right row."""

    def numbered(d: DataFrame, side: str) -> DataFrame:
        # ranks within one name: rows of names in no group are gone before
        mine = d.select(f"{side}_id", F.col("name").alias(f"{side}_name")).join(applied.select(f"{side}_name"), f"{side}_name", "left_semi")
        return mine.withColumn("i", F.row_number().over(Window.partitionBy(f"{side}_name").orderBy(f"{side}_id")))

    a = numbered(left, "l").join(applied.select("l_name", "r_name", "score", "diff"), "l_name")
    return a.join(numbered(right, "r"), ["r_name", "i"]).select("l_id", "r_id", "score", "diff")


def met(left: DataFrame, right: DataFrame, pairs: DataFrame, tolerance: float = 100) -> DataFrame:
    """(l_id, r_id, l_amount, r_amount, score, diff, tier): every right row whose name is alike.

    As many rows as left and right rows of alike names multiplied: for left rows all of whose right rows are wanted.
    """
    return _rated(_asks(left).join(pairs, "l_name").join(_has(right), "r_name"), tolerance)


def _asks(left: DataFrame) -> DataFrame:
    return left.where("name is not null").select("l_id", F.col("name").alias("l_name"), F.col("amount").alias("l_amount"))


def _has(right: DataFrame) -> DataFrame:
    return right.where("name is not null").select("r_id", F.col("name").alias("r_name"), F.col("amount").alias("r_amount"))


def _rated(rows: DataFrame, tolerance: float) -> DataFrame:
    diff = S.difference(F.col("l_amount"), F.col("r_amount"))
    return rows.select("l_id", "r_id", "l_amount", "r_amount", "score", diff.alias("diff")).withColumn("tier", S.amount_tier(F.col("diff"), tolerance))


def near(left: DataFrame, right: DataFrame, pairs: DataFrame, tolerance: float = 100) -> DataFrame:
    """The rows of met() that are within tolerance or in the close tier, without the others.

    Amounts are cut into stretches of twice the tolerance, so a row meets only those of its own stretch and the next
    ones, and the rows of one name are dealt by amount.
    """
    width = F.lit(max(Decimal("0.01"), 2 * Decimal(str(tolerance)))).cast("decimal(18,2)")
    stretch = lambda amount: F.floor(amount / width)
    asks = _asks(left).where("l_amount is not null").join(pairs, "l_name")
    asks = asks.withColumn("stretch", F.explode(F.array(*[stretch(-F.col("l_amount")) + k for k in (-1, 0, 1)])))
    has = _has(right).where("r_amount is not null").withColumn("stretch", stretch(F.col("r_amount")))
    return _rated(asks.join(has, ["r_name", "stretch"]), tolerance).where(F.col("tier").isin(*S.EXACT, "CLOSE_MATCH"))


def singles(found: DataFrame, first_only: bool = False) -> DataFrame:
    """(l_id, r_id, diff) of every right row of near() within tolerance, or of the first by id."""
    hit = found.where(F.col("tier").isin(S.EXACT))
    if first_only:
        hit = hit.groupBy("l_id").agg(F.min(F.struct("r_id", "diff")).alias("m")).select("l_id", "m.*")
    return hit.select("l_id", "r_id", "diff")


def sums(left: DataFrame, right: DataFrame, pairs: DataFrame, found: DataFrame, tolerance: float = 100) -> DataFrame:
    """Per left row: n_single, rest (rows not within tolerance alone), rest_total, rest_diff, rest_tier, close.

    found is near(). close is the first row of the close tier. The rest's total leaves rows without an amount out; it is
    the total of all names alike, summed once per name, less that of the single rows.
    """
    hit = F.col("tier").isin(S.EXACT)
    mine = found.groupBy("l_id").agg(
        F.count_if(hit).alias("n_single"),
        F.sum(F.when(hit, F.col("r_amount"))).alias("single_total"),
        F.min(F.when(F.col("tier") == "CLOSE_MATCH", F.struct("r_id", "diff"))).alias("close"),
    )
    of_name = _has(right).groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.count("r_amount").alias("known"), F.sum("r_amount").alias("total"))
    alike = pairs.join(of_name, "r_name").groupBy("l_name").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("total").alias("total"))
    per = _asks(left).join(alike, "l_name").join(mine, "l_id", "left").withColumn("n_single", F.coalesce("n_single", F.lit(0)))
    rest_total = F.when(F.col("known") > F.col("n_single"), F.col("total") - F.coalesce("single_total", F.lit(0))).cast("decimal(28,2)")
    per = per.select("l_id", "l_amount", "n_single", (F.col("n") - F.col("n_single")).alias("rest"), rest_total.alias("rest_total"), "close")
    per = per.withColumn("rest_diff", S.difference(F.col("l_amount"), F.col("rest_total")))
    return per.withColumn("rest_tier", S.amount_tier(F.col("rest_diff"), tolerance))


def choices(per: DataFrame) -> DataFrame:
    """sums() with `take`: which rows an exact offer of the left row takes, null for none.

    single: those within tolerance; all: these and the rest, which is within tolerance together; one: the close row;
    rest: all the others, whose sum is close.
    """
    rest_fits = F.col("rest_tier").isin(S.EXACT)
    rest_close = F.col("rest_tier") == "CLOSE_MATCH"
    one = F.col("close").isNotNull() & (~rest_close | (F.col("close.diff") <= F.col("rest_diff")))
    take = F.when(rest_fits, "all").when(F.col("n_single") > 0, "single").when(one, "one").when(rest_close, "rest")
    return per.withColumn("take", take)


def partials(left: DataFrame, right: DataFrame, pairs: DataFrame, chosen: DataFrame, busy: DataFrame, tolerance: float = 100) -> DataFrame:
    """(l_id, r_id, ..., tier) of left rows without an exact offer: right rows alike that are in no earlier partial match."""
    open_ = left.join(chosen.where("take is not null").select("l_id"), "l_id", "left_anti")
    return met(open_, right.join(busy.select("r_id").distinct(), "r_id", "left_anti"), pairs, tolerance)


def offers(left: DataFrame, right: DataFrame, pairs: DataFrame, busy: DataFrame, tolerance: float = 100) -> tuple[DataFrame, DataFrame]:
    """(offers, links) of single left rows, as in the other passes. Only links that are offered are made."""
    found = settle(near(left, right, pairs, tolerance))
    chosen = settle(choices(sums(left, right, pairs, found, tolerance)))
    hit = F.col("tier").isin(S.EXACT)
    few = found.join(chosen.where(F.col("take").isin("single", "one")).select("l_id", "take", "close"), "l_id")
    few = few.where(((F.col("take") == "single") & hit) | ((F.col("take") == "one") & (F.col("r_id") == F.col("close.r_id")))).drop("close")
    many = chosen.where(F.col("take").isin("all", "rest")).select("l_id", "take")
    many = met(left.join(many, "l_id", "left_semi"), right, pairs, tolerance).join(many, "l_id").where((F.col("take") == "all") | ~hit)
    sure = settle(few.unionByName(many))
    per = sure.groupBy("l_id").agg(
        F.count(F.lit(1)).alias("size"), F.max("score").alias("score"), F.first("take").alias("take"),
        F.when(F.count(F.lit(1)) == F.count("r_amount"), S.difference(F.first("l_amount"), F.sum("r_amount"))).alias("diff"),
    )
    amount = F.when(F.col("size") == 1, "Single Amount Match").otherwise("Cumulative Amount Match")
    close = F.when(F.col("take").isin("one", "rest"), "Close ").otherwise("")
    sure_of = S.confidence(F.col("diff"), tolerance)
    score = F.concat(F.lit("Name Match (CS: "), F.col("score").cast("string"), F.lit("%)"))
    text = F.coalesce(S.money(F.col("diff")), F.lit("Diff: $nan"))
    exact = per.select("l_id", F.lit(0).alias("kind"), "size", sure_of.alias("confidence"), "diff", F.concat(score, F.lit(" + "), close, amount, F.lit(" ("), sure_of, F.lit(" Confidence, "), text, F.lit(")")).alias("reason"))

    loose = settle(partials(left, right, pairs, chosen, busy, tolerance))
    in_tier = F.col("tier").isin(S.LOOSE)
    best = loose.groupBy("l_id").agg(F.count(F.lit(1)).alias("size"), F.max("score").alias("score"), F.min(F.when(in_tier, F.col("diff"))).alias("near"), F.min(F.struct("r_id", "diff"))["diff"].alias("first"))
    known = F.col("near").isNotNull()
    part = best.select(
        "l_id", F.lit(2).alias("kind"), "size", F.when(known, S.confidence(F.col("near"), tolerance)).otherwise("Very Low").alias("confidence"), F.coalesce("near", "first").alias("diff"),
        F.concat(score, F.when(known, F.concat(F.lit(" ("), S.confidence(F.col("near"), tolerance), F.lit(" Confidence, "), S.money(F.col("near")), F.lit(")"))).otherwise(" (Amount mismatch)")).alias("reason"),
    )
    return exact.unionByName(part), sure.select("l_id", "r_id").unionByName(loose.select("l_id", "r_id"))


def group_offers(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(offers, links) of applied groups."""
    reason = F.concat(F.lit("Name Group Match (CS: "), F.col("score").cast("string"), F.lit("%)"))
    made = given.select("l_id", F.lit(0).alias("kind"), F.lit(1).cast("long").alias("size"), F.lit(None).cast("string").alias("confidence"), F.col("diff"), reason.alias("reason"))
    return made, given.select("l_id", "r_id")
