"""Scalar functions of the reconciliation, as column expressions.

Everything here is JVM-side but partial_ratio, whose formula no built-in has.
"""

from __future__ import annotations

import difflib
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

AMOUNT = "decimal(18,2)"
# What a reason says of the left text inside the right one, and the other way round.
INSIDE = ("CBL in Insurer: ", "Insurer in CBL: ")
#: Tiers by the difference of two amounts: multiple of the tolerance, name, confidence (fixed values).
TIERS = [
    ("0.1", "PERFECT_MATCH", "Perfect"),
    ("1", "EXACT_MATCH", "High"),
    ("2", "CLOSE_MATCH", "Medium"),
    ("5", "REVIEW_REQUIRED", "Low"),
    ("10", "INVESTIGATION_REQUIRED", "Very Low"),
]
EXACT = ["PERFECT_MATCH", "EXACT_MATCH"]
LOOSE = ["REVIEW_REQUIRED", "INVESTIGATION_REQUIRED"]


def clean_key(c: Column) -> Column:
    """Upper case, letters and digits only; null stays null."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def clean_name(c: Column) -> Column:
    """Upper case without white space at the ends; null and blank names are null, so they match nothing."""
    name = F.regexp_replace(F.upper(c), r"^\s+|\s+$", "")
    return F.when(F.length(name) > 0, name)


def before_dot(c: Column) -> Column:
    """Text before the first dot."""
    return F.split_part(c, F.lit("."), F.lit(1))


def to_amount(c: Column) -> Column:
    """Text as an amount; null where it isn't a plain number."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double").cast(AMOUNT))


def build_key(*parts: Column) -> Column:
    """Trimmed parts joined by #, null as empty."""
    return F.concat_ws("#", *[F.coalesce(F.regexp_replace(p.cast("string"), r"^\s+|\s+$", ""), F.lit("")) for p in parts])


def normalize_key(c: Column) -> Column:
    """Trimmed, without .0 before # or the end, doubled backslashes made single; null as empty."""
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")
    return F.replace(F.regexp_replace(text, r"\.0(?=#|$)", ""), F.lit("\\\\"), F.lit("\\"))


def split_matrix(c: Column) -> Column:
    """Struct of the left and right keys of a rule "l1,l2|r1,r2"; null where it isn't one."""
    sides = F.split(c, r"\|")

    def keys(side: int) -> Column:
        return F.filter(F.transform(F.split(sides[side], ","), lambda k: F.regexp_replace(k, r"^\s+|\s+$", "")), lambda k: F.length(k) > 0)

    return F.when((F.size(sides) == 2) & (F.size(keys(0)) > 0) & (F.size(keys(1)) > 0), F.struct(keys(0).alias("lhs"), keys(1).alias("rhs")))


def policy_tokens(c: Column) -> Column:
    """Tokens of a policy text.

    More than one slash: the words without special characters. Digits alone: the text. Else: all numbers of 4 or 5
    digits. Null has none.
    """
    text = F.regexp_replace(c, r"^\s+|\s+$", "")
    words = F.transform(F.split(text, r"\s+"), lambda w: F.regexp_replace(w, "[^a-zA-Z0-9]", ""))
    numbers = F.regexp_extract_all(text, F.lit(r"\b(\d{4,5})\b"), F.lit(1))
    several = F.length(text) - F.length(F.replace(text, F.lit("/"))) > 1
    return F.when(c.isNull(), F.array().cast("array<string>")).when(several, words).when(text.rlike(r"^\d+$"), F.array(text)).otherwise(numbers)


def overlap(a: Column, b: Column, least: float = 0.8, length: int = 10) -> Column:
    """Share of the longer text that the shorter one covers, where it is inside it; else null."""
    inside = F.when(F.contains(b, a), F.length(a) / F.length(b)).when(F.contains(a, b), F.length(b) / F.length(a))
    return F.when((F.length(a) >= length) & (F.length(b) >= length) & (inside >= least), inside)


def overlap_text(a: Column, b: Column, share: Column) -> Column:
    """What a match reason says of an overlap, left text first."""
    return F.concat(F.when(F.contains(b, a), INSIDE[0]).otherwise(INSIDE[1]), F.round(share.cast("decimal(20,10)") * 100, 1).cast("decimal(9,1)").cast("string"), F.lit("% overlap"))


def difference(left: Column, right: Column) -> Column:
    """The sides carry opposite signs, so amounts differ by their sum."""
    return F.abs(left + right).cast("decimal(28,2)")


def _by_tier(diff: Column, tolerance: float, pick: int, other: str) -> Column:
    t = Decimal(str(tolerance))
    out = F.when(diff.isNull(), other)
    for tier in TIERS:
        out = out.when(diff <= F.lit(t * Decimal(tier[0])), tier[pick])
    return out.otherwise(other)


def amount_tier(diff: Column, tolerance: float = 100) -> Column:
    return _by_tier(diff, tolerance, 1, "NO_MATCH")


def confidence(diff: Column, tolerance: float = 100) -> Column:
    return _by_tier(diff, tolerance, 2, "None")


def _by_cents(off: Column, tolerance: float, pick: int, other: str) -> Column:
    """_by_tier() of a difference in whole cents."""
    out = F.when(off.isNull(), other)
    for tier in TIERS:
        out = out.when(off <= int(Decimal(str(tolerance)) * Decimal(tier[0]) * 100), tier[pick])
    return out.otherwise(other)


def cents_tier(off: Column, tolerance: float = 100) -> Column:
    return _by_cents(off, tolerance, 1, "NO_MATCH")


def cents_confidence(off: Column, tolerance: float = 100) -> Column:
    return _by_cents(off, tolerance, 2, "None")


def money(diff: Column) -> Column:
    return F.concat(F.lit("Diff: $"), diff.cast("decimal(18,2)").cast("string"))


def window_similarity(a: Column, b: Column) -> Column:
    """Best share of equal characters between the shorter text and a window of the longer one, 0 to 100.

    1 - levenshtein / length over all windows; not the formula of partial_ratio, but one that SQL has too.
    """
    short = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    long = F.when(F.length(a) <= F.length(b), b).otherwise(a)
    n = F.length(short)
    starts = F.sequence(F.lit(1), F.length(long) - n + 1)
    best = F.array_min(F.transform(starts, lambda i: F.levenshtein(short, F.substring(long, i, n))))
    return F.when((n > 0), F.floor((1 - best / n) * 100 + 0.5).cast("int"))


def _partial_ratio(a: str | None, b: str | None) -> int:
    if not a or not b:
        return 0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 100
    n, most = len(short), len(long) - len(short) + 1
    starts = {max(0, block.b - block.a) for block in difflib.SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()}
    # the shorter text isn't in the longer one: all of a window can agree only if it is cut at the longer one's end,
    # and the longest such window, which is one letter short, then has the best ratio that there can be
    best, bound = 0.0, 2 * (n - 1) / (2 * n - 1)
    for start in sorted(starts, key=lambda s: s != most):
        ratio = difflib.SequenceMatcher(None, short, long[start : start + n], autojunk=False).ratio()
        if ratio > 0.995:
            return 100
        best = max(best, ratio)
        if best >= bound:
            break
    return round(100 * best)


def _score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_partial_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


#: Similarity of the shorter text and its best-aligned windows in the longer one, 0 to 100. Said to be not deterministic,
#: though it is, since Spark would else run it twice where a filter reads its result.
partial_ratio = F.pandas_udf(_score, IntegerType()).asNondeterministic()


def name_score(a: Column, b: Column) -> Column:
    """partial_ratio, which is 100 where one name holds the other; only other pairs go to Python."""
    inside = F.contains(a, b) | F.contains(b, a)
    rest = F.when(~inside, a), F.when(~inside, b)
    return F.when(a.isNull() | b.isNull(), 0).when(inside, 100).otherwise(partial_ratio(*rest))
