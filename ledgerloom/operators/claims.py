"""Claims: which offer gets which right row, without going through offers one by one.

Offers taken in order of rank, each getting what is still free, is the same as every right row going to its offer of
least rank. So one window over right rows settles all exact claims; partial claims may share rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import settle

NO, PARTIAL, EXACT = "No Match", "Partial Match", "Exact Match"


@dataclass(frozen=True)
class Shared:
    """Links that many left rows have alike: those of one, the lead, stand for those of all its members."""

    members: DataFrame  # l_id, lead
    links: DataFrame  # lead, r_id

    def listed(self) -> DataFrame:
        """(l_id, r_id) one by one: as many rows as members times links."""
        return self.members.join(self.links, "lead").select("l_id", "r_id")

    def holders(self) -> DataFrame:
        """(l_id) of members whose lead has links."""
        return self.members.join(self.links, "lead", "left_semi").select("l_id")

    def used(self) -> DataFrame:
        """(r_id) of links whose lead has members."""
        return self.links.join(self.members, "lead", "left_semi").select("r_id")

    def without(self, taken: DataFrame) -> Shared:
        """The same without right rows that are in taken (r_id)."""
        return Shared(self.members, self.links.join(taken, "r_id", "left_anti").select("lead", "r_id"))


@dataclass(frozen=True)
class State:
    """Decisions and links after a pass; both immutable, written anew by every pass."""

    decisions: DataFrame  # l_id, status, reason, confidence, diff, total, total_stale, passes, resolved_in
    own: DataFrame  # l_id, r_id, status: links one by one
    fallback: DataFrame  # r_id
    shared: Shared | None = None  # partial links of left rows without own ones

    @property
    def links(self) -> DataFrame:
        """(l_id, r_id, status) of all links one by one."""
        return self.own if self.shared is None else self.own.unionByName(self.shared.listed().withColumn("status", F.lit(PARTIAL)))

    def loosely_used(self) -> DataFrame:
        """(r_id) of right rows in a partial match."""
        mine = self.own.where(F.col("status") == PARTIAL).select("r_id")
        return (mine if self.shared is None else mine.unionByName(self.shared.used())).distinct()


def start(left: DataFrame) -> State:
    """Every left row without a match."""
    none = left.select(
        "l_id", F.lit(NO).alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("confidence"), F.lit(None).cast("decimal(28,2)").alias("diff"),
        F.lit(None).cast("decimal(28,2)").alias("total"), F.lit(False).alias("total_stale"), F.array().cast("array<string>").alias("passes"), F.lit(None).cast("string").alias("resolved_in"),
    )
    no_link = left.select("l_id", F.col("l_id").alias("r_id"), F.lit(NO).alias("status")).where("false")
    return State(none, no_link, no_link.select("r_id"))


def owners(offers: DataFrame, links: DataFrame) -> DataFrame:
    """(l_id, r_id) of exact offers (kind below 2): each right row with the offer of least rank.

    Rank: kind, then larger offers, then l_id.
    """
    rank = Window.partitionBy("r_id").orderBy("kind", F.desc("size"), "l_id")
    asked = links.join(offers.where("kind < 2").select("l_id", "kind", "size"), "l_id")
    return asked.withColumn("n", F.row_number().over(rank)).where("n = 1").select("l_id", "r_id")


def contested(links: DataFrame) -> DataFrame:
    """Right rows that several left rows claim, with how many."""
    return links.groupBy("r_id").agg(F.count_distinct("l_id").alias("claimants")).where("claimants > 1")


def apply(state: State, offers: DataFrame, links: DataFrame, right: DataFrame, tried: DataFrame, name: str, fallback: DataFrame | None = None, shared: Shared | None = None) -> State:
    """The state after a pass. tried: l_id of the rows that the pass looked at. shared: links of partial offers that aren't in links.

    Exact offers take the rows that no earlier pass and no offer of lower rank has; partial ones those that aren't
    exact-claimed. An offer left without rows is No Match. Rows newly claimed leave the partial matches of others.
    """
    if shared is not None and state.shared is not None:
        state = State(state.decisions, settle(state.links), state.fallback)  # leads of two passes may be the same rows
    taken = state.own.where(F.col("status") == EXACT).select("r_id")
    free = links.join(taken, "r_id", "left_anti")
    sure = owners(offers, free).withColumn("status", F.lit(EXACT))
    loose = free.join(offers.where("kind = 2").select("l_id"), "l_id", "left_semi").join(sure.select("r_id"), "r_id", "left_anti").select("l_id", "r_id", F.lit(PARTIAL).alias("status"))
    fresh = settle(sure.unionByName(loose))
    newly = fresh.where(F.col("status") == EXACT).select("r_id").distinct()
    got = lambda rows, key: rows.join(right.select("r_id", "amount"), "r_id").groupBy(key).agg(F.count(F.lit(1)).alias("got"), F.sum("amount").alias("sum"))
    sums = got(fresh, "l_id")
    if shared is not None:
        open_ = shared.without(taken.unionByName(newly))
        shared = Shared(settle(shared.members), settle(open_.links))
        sums = sums.unionByName(shared.members.join(got(shared.links, "lead"), "lead").select("l_id", "got", "sum"))
    made = offers.join(sums, "l_id", "left").select(
        "l_id",
        F.when(F.col("got").isNull(), NO).when(F.col("kind") < 2, EXACT).otherwise(PARTIAL).alias("n_status"),
        F.when(F.col("got").isNull(), F.concat("reason", F.lit(" (All indices conflicted)"))).otherwise(F.col("reason")).alias("n_reason"),
        F.when(F.col("got").isNotNull(), F.col("confidence")).alias("n_confidence"),
        F.when(F.col("got").isNotNull(), F.col("diff")).alias("n_diff"),
        F.col("sum").cast("decimal(28,2)").alias("n_total"),
        F.coalesce(F.col("got") < F.col("size"), F.lit(False)).alias("n_stale"),
    )
    old = state.own.join(offers.select("l_id"), "l_id", "left_anti")
    marked = lambda rows, status: rows.join(newly.withColumn("gone", F.lit(True)), "r_id", "left").withColumn("gone", F.coalesce(F.col("gone") & (status == PARTIAL), F.lit(False)))
    counted = lambda rows, key: rows.groupBy(key).agg(F.count_if("gone").alias("lost"), F.count_if(~F.col("gone")).alias("left_over")).where("lost > 0")
    kept = settle(marked(old, F.col("status")))
    lost = counted(kept, "l_id")
    if state.shared is not None:
        members = settle(state.shared.members.join(offers.select("l_id"), "l_id", "left_anti"))
        theirs = settle(marked(state.shared.links, F.lit(PARTIAL)))
        lost = lost.unionByName(members.join(counted(theirs, "lead"), "lead").select(lost.columns))
        shared = Shared(members, theirs.where("not gone").select("lead", "r_id"))
    seen = tried.select("l_id").distinct().withColumn("seen", F.lit(True))
    now = state.decisions.join(made, "l_id", "left").join(lost, "l_id", "left").join(seen, "l_id", "left")
    new, robbed = F.col("n_status").isNotNull(), F.col("lost").isNotNull()
    none = robbed & (F.col("left_over") == 0)
    resolved = F.when(new & (F.col("n_status") == NO) | none, None).when(new, F.lit(name)).otherwise(F.col("resolved_in"))
    decisions = now.select(
        "l_id",
        F.when(new, F.col("n_status")).when(none, NO).otherwise(F.col("status")).alias("status"),
        F.when(new, F.col("n_reason")).when(none, F.concat(F.lit("Lost all insurers ("), "reason", F.lit(")"))).when(robbed, F.concat("reason", F.lit(" (Updated: some insurers claimed elsewhere)"))).otherwise(F.col("reason")).alias("reason"),
        F.when(new, F.col("n_confidence")).when(none, None).otherwise(F.col("confidence")).alias("confidence"),
        F.when(new, F.col("n_diff")).when(none, None).otherwise(F.col("diff")).alias("diff"),
        F.when(new, F.col("n_total")).when(none, None).otherwise(F.col("total")).cast("decimal(28,2)").alias("total"),
        F.when(new, F.col("n_stale")).when(none, False).otherwise(F.col("total_stale") | F.coalesce(robbed, F.lit(False))).alias("total_stale"),
        F.when(F.col("seen"), F.array_union("passes", F.array(F.lit(name)))).otherwise(F.col("passes")).alias("passes"),
        resolved.alias("resolved_in"),
    )
    after = settle(fresh.unionByName(kept.where("not gone").select("l_id", "r_id", "status")))
    spare = state.fallback if fallback is None else state.fallback.unionByName(fallback)
    return State(settle(decisions), after, settle(spare), shared)


def usage(state: State) -> DataFrame:
    """One row of counts of right rows in use and of left rows by kind of match."""
    links, of = state.links, state.decisions
    rows = links.agg(
        F.count_distinct(F.when(F.col("status") == EXACT, F.col("r_id"))).alias("exact_used"),
        F.count_distinct(F.when(F.col("status") == PARTIAL, F.col("r_id"))).alias("partial_used"),
        F.count_distinct("r_id").alias("used"),
    )
    left = of.agg(F.count_if(F.col("status") == EXACT).alias("exact_left"), F.count_if(F.col("status") == PARTIAL).alias("partial_left"))
    many = contested(links.where(F.col("status") == PARTIAL)).agg(F.count(F.lit(1)).alias("multi_claimed"))
    return rows.join(left).join(many)  # three single rows


