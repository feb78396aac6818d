"""Pairs of distinct names that are alike, without comparing every name with every other.

A score rounds to t or more if of the letters of a name (n of them) and of its window in the longer name e at most differ,
e = floor(n (2 - 2 (t - 0.5) / 100)). They break the shorter name in e places at most, so of e + 1 stretches of it one is
whole inside the longer name. Each stretch offers its rarest gram, the longer name all its grams, and an equi-join finds
all candidates. Grams have GRAM letters, fewer where stretches are shorter. Candidates that share too few grams for e go
without Python; the rest are scored.

If e is 1 (10 to 18 letters at 95) only a window that runs over the longer name's end can differ, for else the numbers of
letters that differ on the two sides are equal: the shorter name without one of its letters is the end of the longer one.
So the shorter name offers what is left without each of its letters, the longer one its ends, and names of e = 1 need
grams only where one holds the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..storage import settle

GRAM = 6


def _errors(column: str, threshold: int) -> Column:
    """How many letters may differ, in both names together."""
    return F.floor(F.length(column) * (2 - 2 * (threshold - 0.5) / 100) + 1e-9).cast("int")


def _parts(column: str, threshold: int) -> Column:
    """How many stretches of a name are looked for."""
    e = _errors(column, threshold)
    return F.when(e < 2, 1).otherwise(e + 1)


def _size(column: str, threshold: int) -> Column:
    """How many letters the grams of a name's stretches have."""
    return F.least(F.lit(GRAM), F.floor(F.length(column) / _parts(column, threshold))).cast("int")


def _pieces(column: str, first: Column, last: Column, size: Column) -> Column:
    """Distinct grams of a name that start from first to last."""
    return F.array_distinct(F.transform(F.sequence(first, last), lambda i: F.substring(F.col(column), i, size)))


def _hashed(column: str, first: Column, last: Column, size: Column) -> Column:
    """The same as numbers, which take less room than text; names that meet by chance are told apart later."""
    return F.array_distinct(F.transform(F.sequence(first, last), lambda i: F.xxhash64(size, F.substring(F.col(column), i, size))))


def _grams(names: DataFrame, column: str, sizes: DataFrame) -> DataFrame:
    """(column, size, gram): all grams of the sizes (size) asked for."""
    every = names.select(column, F.explode(F.array(*[F.lit(n) for n in range(1, GRAM + 1)])).alias("size")).where(F.length(column) >= F.col("size"))
    asked = every.join(F.broadcast(sizes), "size", "left_semi")  # GRAM rows at most
    return asked.select(column, F.explode(_hashed(column, F.lit(1), F.length(column) - F.col("size") + 1, F.col("size"))).alias("gram"))


def _anchors(names: DataFrame, column: str, threshold: int, counts: DataFrame) -> DataFrame:
    """(column, size, gram): of each stretch of a name the gram that is rarest on the other side, if a name as long has it."""
    cut = names.select(column, _parts(column, threshold).alias("parts"), _size(column, threshold).alias("size"))
    cut = cut.withColumn("width", F.floor(F.length(column) / F.col("parts")).cast("int"))
    stretch = cut.select(column, "size", "parts", "width", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    last = F.when(F.col("part") == F.col("parts") - 1, F.length(column)).otherwise((F.col("part") + 1) * F.col("width"))
    grams = stretch.select(column, "size", "part", F.explode(_hashed(column, F.col("part") * F.col("width") + 1, last - F.col("size") + 1, F.col("size"))).alias("gram"))
    # the tables are larger than the files of names that they come from: none of them is for the driver to hold
    rated = grams.hint("merge").join(counts.hint("merge"), "gram").where(F.length(column) <= F.col("longest"))
    return rated.groupBy(column, "size", "part").agg(F.min_by("gram", "n").alias("gram")).select(column, "size", "gram")


def _plausible(short: str, long: str, threshold: int) -> Column:
    """Whether the shorter name keeps enough of its grams: each differing letter spoils as many as a gram has letters."""
    size, broken = F.col("size"), _parts(short, threshold) - 1
    grams = lambda c: _pieces(c, F.lit(1), F.length(c) - size + 1, size)
    kept = F.size(F.array_intersect(grams(short), grams(long))) >= F.size(grams(short)) - broken * size
    return (F.length(short) <= F.length(long)) & (F.contains(F.col(long), F.col(short)) | kept)


def _by_grams(shorter: DataFrame, longer: DataFrame, short: str, long: str, threshold: int) -> DataFrame:
    """Candidates of which the first is the shorter name and keeps a stretch whole."""
    grams = _grams(longer, long, shorter.select(_size(short, threshold).alias("size")).distinct())
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max(F.length(long)).alias("longest"))
    met = _anchors(shorter, short, threshold, counts).hint("merge").join(grams.hint("merge"), "gram")
    return met.where(_plausible(short, long, threshold)).select("l_name", "r_name")


def _by_ends(shorter: DataFrame, longer: DataFrame, short: str, long: str, threshold: int) -> DataFrame:
    """Candidates of which the first, without one of its letters, is the end of the other; e is 1."""
    n = F.length(short)
    asks = shorter.where(_errors(short, threshold) == 1)
    without = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(F.col(short), F.lit(1), i - 1), F.substring(F.col(short), i + 1, n)))
    left = asks.select(short, F.explode(F.array_distinct(F.transform(without, lambda w: F.xxhash64(w)))).alias("end"))
    most = int(2 / (2 - 2 * (threshold - 0.5) / 100)) + 1  # from here on e is 2 or more
    lengths = longer.select(long, F.explode(F.sequence(F.lit(1), F.lit(most))).alias("length")).where(F.length(long) > F.col("length"))
    asked = lengths.join(F.broadcast(asks.select((n - 1).alias("length")).distinct()), "length", "left_semi")  # `most` rows at most
    ends = asked.select(long, F.xxhash64(F.substring(F.col(long), F.length(long) - F.col("length") + 1, F.col("length"))).alias("end"))
    return left.hint("merge").join(ends.hint("merge"), "end").select("l_name", "r_name")


def alike(left: DataFrame, right: DataFrame, threshold: int = 95) -> DataFrame:
    """(l_name, r_name, score) of distinct names of left (name) and right (name) with a score of at least threshold.

    The threshold is above 50: below it whole names may differ.
    """
    if threshold <= 50:
        raise ValueError("names are compared from a threshold of 51 on")
    a = settle(left.where("name is not null").select(F.col("name").alias("l_name")).distinct())  # read many times below
    b = settle(right.where("name is not null").select(F.col("name").alias("r_name")).distinct())
    pairs = a.hint("merge").join(b, F.col("l_name") == F.col("r_name")).select("l_name", "r_name")
    for find in (_by_grams, _by_ends):
        pairs = pairs.unionByName(find(a, b, "l_name", "r_name", threshold)).unionByName(find(b, a, "r_name", "l_name", threshold))
    found = settle(pairs.distinct())  # else Spark scores before it makes the pairs distinct, and once more after it
    return found.withColumn("score", S.name_score(F.col("l_name"), F.col("r_name"))).where(F.col("score") >= threshold)
