"""Scalar functions by table."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_cleaning(spark):
    rows = [(" pl/1-a ", "12.0", "1,234"), (None, None, None), ("", "x", "1d"), ("é1", "1.2.3", " -5.5 "), ("\tB\n", "9", "nan"), ("a", "b", "Infinity")]
    got = values(spark, rows, "a string, b string, c string", S.clean_key(F.col("a")), S.before_dot(F.col("b")), S.to_amount(F.col("c")).cast("string"), S.clean_name(F.col("a")))
    assert got == [("PL1A", "12", None, "PL/1-A"), (None, None, None, None), ("", "x", None, None), ("1", "1", "-5.50", "É1"), ("B", "9", None, "B"), ("A", "b", None, "A")]


def test_policy_tokens(spark):
    rows = [("10899",), ("POL 10769 X",), ("A/B/10330",), ("A/B 10330",), ("a/b/c d-e",), (None,), ("",), ("123456",), ("12 123 1234 12345 123456",)]
    got = [r[0] for r in values(spark, rows, "a string", S.policy_tokens(F.col("a")))]
    assert got == [["10899"], ["10769"], ["AB10330"], ["10330"], ["abc", "de"], [], [], ["123456"], ["1234", "12345"]]


@pytest.mark.parametrize(
    ("diff", "tier", "sure"),
    [("10", "PERFECT_MATCH", "Perfect"), ("10.01", "EXACT_MATCH", "High"), ("100", "EXACT_MATCH", "High"), ("100.01", "CLOSE_MATCH", "Medium"), ("200", "CLOSE_MATCH", "Medium"), ("500", "REVIEW_REQUIRED", "Low"), ("1000", "INVESTIGATION_REQUIRED", "Very Low"), ("1000.01", "NO_MATCH", "None"), (None, "NO_MATCH", "None")],
)
def test_tiers(spark, diff, tier, sure):
    d = F.lit(diff).cast("decimal(28,2)")
    assert tuple(spark.range(1).select(S.amount_tier(d), S.confidence(d)).first()) == (tier, sure)


def test_keys(spark):
    rows = [("1.0#b.0", "a,b|c"), (" x.05#1.0# ", "a|b|c"), (None, " ,|x"), ("a\\\\b", "k1 , k2|r1,r2"), ("", None)]
    got = values(spark, rows, "a string, b string", S.normalize_key(F.col("a")), S.split_matrix(F.col("b")))
    assert [g[0] for g in got] == ["1#b", "x.05#1#", "", "a\\b", ""]
    assert [None if g[1] is None else (g[1].lhs, g[1].rhs) for g in got] == [(["a", "b"], ["c"]), None, None, (["k1", "k2"], ["r1", "r2"]), None]
    assert spark.range(1).select(S.build_key(F.lit(" a "), F.lit(None), F.lit(3))).first()[0] == "a##3"


def test_overlap_and_names(spark):
    rows = [("ABCDEFGHIJ", "ABCDEFGHIJKL"), ("ABCDEFGHIJ", "ABCDEFGHIJKLM"), ("ABCDEFGHI", "ABCDEFGHIJ"), ("XABCDEFGHIJ", "ABCDEFGHIJ")]
    got = [r[0] for r in values(spark, rows, "a string, b string", F.round(S.overlap(F.col("a"), F.col("b")), 3))]
    assert got == [0.833, None, None, 0.909]
    names = [("JOHN SMITH", "MR JOHN SMYTH LTD"), ("A", "A"), (None, "A")]
    got = values(spark, names, "a string, b string", S.window_similarity(F.col("a"), F.col("b")), S.name_score(F.col("a"), F.col("b")))
    assert got == [(90, 90), (100, 100), (None, 0)]
