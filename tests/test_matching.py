"""Passes against brute force and by hand-built cases."""

import random
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.operators import claims, matrix, names, naming, placing, report
from ledgerloom.plans import reconcile as R

LEFT = "l_id long, placing_no string, tokens array<string>, name string, amount decimal(18,2)"
RIGHT = "r_id long, placing_no string, policy_1 string, policy_2 string, name string, amount decimal(18,2)"


def left(spark, *rows):
    return spark.createDataFrame([(i, p, t, n, None if a is None else Decimal(a)) for i, p, t, n, a in rows], LEFT)


def right(spark, *rows):
    return spark.createDataFrame([(i, p, x, y, n, None if a is None else Decimal(a)) for i, p, x, y, n, a in rows], RIGHT)


def outcome(state):
    decisions, links = report.final_decisions(state)
    of = {}
    for r in links.collect():
        of.setdefault(r.l_id, []).append(r.r_id)
    return {r.l_id: (r.status, sorted(of.get(r.l_id, []))) for r in decisions.collect()}


def test_substring_blocking_is_lossless(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("AB1") for _ in range(rng.randint(9, 18))) for _ in range(60)]
    more = [b + "".join(rng.choice("AB1") for _ in range(rng.randint(0, 4))) for b in base] + ["X" + b for b in base]
    a = left(spark, *[(i, b, [], "N", "1") for i, b in enumerate(base)])
    b = right(spark, *[(i, m, None, None, "N", "1") for i, m in enumerate(more)])
    got = {(r.l_id, r.r_id) for r in placing.inside(a, b).collect()}
    want = set()
    for i, x in enumerate(base):
        if len(x) < 10 or x in more:
            continue
        want |= {(i, j) for j, y in enumerate(more) if len(y) >= 10 and (x in y or y in x) and min(len(x), len(y)) / max(len(x), len(y)) >= 0.8}
    assert got == want and want


def test_combinations_follow_the_order_of_sizes():
    rng = random.Random(5)
    for _ in range(300):
        cents = [rng.randint(1, 400) for _ in range(rng.randint(2, 7))]
        target, want = -rng.randint(200, 900), None
        for r in range(2, min(5, len(cents)) + 1):
            close = None
            for c in combinations(range(len(cents)), r):
                off = abs(target + sum(cents[k] for k in c))
                if off <= 5:
                    want = c
                    break
                if off <= 10 and close is None:
                    close = c
            want = want or close
            if want:
                break
        import numpy as np

        got = placing._choose(target, np.array(cents), 5, 5)
        assert got == ([k + 1 for k in want] if want else None)


def test_claims_are_those_of_taking_offers_in_turn(spark):
    rng = random.Random(6)
    offers = [(i, rng.choice([0, 1]), 0) for i in range(40)]
    links = [(i, r) for i, _, _ in offers for r in rng.sample(range(30), rng.randint(1, 4))]
    offers = [(i, k, sum(x == i for x, _ in links)) for i, k, _ in offers]
    used, want = set(), set()
    for i, _, _ in sorted(offers, key=lambda o: (o[1], -o[2], o[0])):
        mine = {r for x, r in links if x == i} - used
        used |= mine
        want |= {(i, r) for r in mine}
    o = spark.createDataFrame(offers, "l_id long, kind int, size long")
    k = spark.createDataFrame(links, "l_id long, r_id long")
    assert {tuple(r) for r in claims.owners(o, k).collect()} == want


def test_passes_by_hand(spark):
    a = left(
        spark,
        (1, "PLACING0001", ["10001"], "ANN", "-100"),  # single
        (2, "PLACING0002", ["10002"], "BOB", "-10000"),  # three pieces
        (3, "PLACING0003", ["10003"], "CAT", "-2000"),  # review tier: partial
        (4, None, [], None, "-5"),  # nothing
        (5, "PLACING0001", [], "DAN", "-90"),  # loses the contested row to 1
        (6, "PLACING0006", [], "EVE", "-700"),  # lone close match: not used by pass 1, found by name
    )
    b = right(
        spark,
        (10, "PLACING0001", None, None, "ANN", "100"),
        (20, "PLACING0002", None, None, "BOB", "5000"), (21, "PLACING0002", None, None, "BOB", "3000"), (22, "PLACING0002", None, None, "BOB", "2000"),
        (30, "PLACING0003", None, None, "CAT X", "2350"),
        (40, None, None, None, None, "5"),
        (60, "PLACING0006", None, None, "EVE", "850"),
    )
    first = outcome(R.reconcile(a, b, R.Profile(passes=("1",))))
    assert first == {1: ("Exact Match", [10]), 2: ("Exact Match", [20, 21, 22]), 3: ("Partial Match", [30]), 4: ("No Match", []), 5: ("No Match", []), 6: ("No Match", [])}
    state = R.reconcile(a, b)
    assert outcome(state)[6] == ("Exact Match", [60])  # pass 3 takes close amounts
    assert outcome(state)[4] == ("No Match", [])  # null names match nothing
    exact = [r for s, rows in outcome(state).values() if s == "Exact Match" for r in rows]
    assert len(exact) == len(set(exact))
    covered = report.coverage(b, report.final_decisions(state)[1])
    assert {r.r_id for r in covered.collect()} == {10, 20, 21, 22, 30, 40, 60}
    merged = report.explode_merge(a, b, *report.final_decisions(state)).where("l_id = 2").orderBy("pos").collect()
    assert [(r.pos, r.r_id, r.name) for r in merged] == [(0, 20, "BOB"), (1, 21, None), (2, 22, None)]


def test_empty_ledgers(spark):
    a, b = left(spark), right(spark)
    assert outcome(R.reconcile(a, b)) == {}
    stats = report.right_stats(report.coverage(b, R.reconcile(a, b).links)).first()
    assert stats.total_rows == 0 and stats.exact_match_rate is None


@pytest.mark.parametrize("threshold", [95, 80])
def test_name_pairs_are_lossless(spark, threshold):
    """Changed, cut, longer and tiny names: every pair that the scorer rates high enough is found."""
    rng = random.Random(7)
    words = ["ALPHA", "BETA", "GAMMA", "DELTA", "OMEGA", "LTD", "AND", "SONS", "INTERNATIONAL", "TRADING"]
    a = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(40)} | {"AB", "X", "JOHN SMITHS", "JOHNX SMITH", "MAURITIUS TELECOMX", "ABCDEFGHIJ"})
    changed = {n[:k] + rng.choice("QZ") + n[k + 1 :] for n in a for k in [rng.randrange(len(n))]}
    cut = {"MR " + n[:-1] for n in a} | {n[1:] for n in a if len(n) > 1} | {"THE " + n[:k] + n[k + 1 :] for n in a for k in [rng.randrange(len(n))]}
    b = sorted(changed | cut | {"M/S " + n + " LTD" for n in a[:15]} | {"CABLE", "X", "MR JOHN SMITH", "ABC MAURITIUS TELECOM", "XABCDEFGHI"})
    got = {(r.l_name, r.r_name) for r in names.alike(left(spark, *[(i, None, [], n, "1") for i, n in enumerate(a)]), right(spark, *[(i, None, None, None, n, "1") for i, n in enumerate(b)]), threshold).collect()}
    want = {(x, y) for x in a for y in b if S._partial_ratio(x, y) >= threshold}
    assert got == want and {("JOHN SMITHS", "MR JOHN SMITH"), ("MAURITIUS TELECOMX", "ABC MAURITIUS TELECOM")} <= got


def test_groups_pair_rows_in_order_and_skip_larger_left_groups(spark):
    a = left(spark, (1, None, [], "ANN", "-60"), (2, None, [], "ANN", "-40"), (3, None, [], "BOB", "-10"), (4, None, [], "BOB", "-10"))
    b = right(spark, (10, None, None, None, "ANN", "30"), (11, None, None, None, "ANN", "70"), (12, None, None, None, "BOB", "20"))
    pairs = names.alike(a, b)
    found = naming.groups(a, b, pairs)
    given = naming.distributed(naming.settled_groups(found), a, b)
    assert {(r.l_id, r.r_id) for r in given.collect()} == {(1, 10), (2, 11)}


def test_groups_of_a_large_family_all_settle(spark):
    n = 55  # every left name's least pair is with the same right name, so each round settles one pair
    found = spark.range(n).selectExpr("concat('L', id) as l_name", "id as l").crossJoin(spark.range(n).selectExpr("concat('R', id) as r_name", "id as r"))
    found = found.selectExpr("l_name", "r_name", "1L as n_left", "1L as n_right", "struct(-1L as size, l as l_first, r as r_first) as rank").coalesce(1)
    assert {(r.l_name, r.r_name) for r in naming.settled_groups(found).collect()} == {(f"L{i}", f"R{i}") for i in range(n)}


def test_matrix_rules(spark):
    rules = spark.createDataFrame([(1, "a,b|x"), (2, "c|y"), (3, "c|z"), (4, "d|missing"), (5, "bad"), (6, "e|x")], "rule_id long, rule string")
    lk = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")], "l_id long, key string")
    rk = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z")], "r_id long, key string")
    l_rows, r_rows = matrix.matches(rules, lk, rk)
    assert {tuple(r) for r in l_rows.collect()} == {(1, 1), (1, 2), (2, 3)}
    assert {tuple(r) for r in r_rows.collect()} == {(1, 10), (2, 20)}
    # 1 beats 2, so 2 is not in the way of 3
    chain = spark.createDataFrame([(1, "a|x"), (2, "b|x,y"), (3, "c|y,z"), (4, "d|z")], "rule_id long, rule string")
    l_rows, r_rows = matrix.matches(chain, lk, rk)
    assert {tuple(r) for r in l_rows.collect()} == {(1, 1), (3, 3)} and {tuple(r) for r in r_rows.collect()} == {(1, 10), (3, 20), (3, 30)}
    df = spark.createDataFrame([(1, " a ", 1.0), (2, "a", 1.0), (3, "b", 2.0)], "l_id long, p string, q double")
    assert [tuple(r) for r in matrix.keyed(df, "l_id", ["p", "q"]).collect()] == [(3, "b#2")]
    state = R.reconcile(left(spark, (1, None, [], "N", "-5"), (2, None, [], "O", "-5")), right(spark, (10, None, None, None, "N", "10")), R.Profile(passes=()), rules, lk, rk)
    assert outcome(state) == {1: ("Exact Match", [10]), 2: ("Exact Match", [10])}
    assert state.decisions.where(F.col("resolved_in") == "matrix").count() == 2


def test_groups_against_taking_pairs_in_turn(spark):
    """Groups and their rows over many alike names whose totals contend, against pairs taken one by one by rank."""
    rng = random.Random(9)
    names_ = [f"NORTHERN TRADING COMPANY {k:02d}" for k in range(14)]
    a_rows = [(i, None, [], rng.choice(names_), str(-rng.choice([50, 100, 150]))) for i in range(40)]
    b_rows = [(1000 + i, None, None, None, rng.choice(names_), str(rng.choice([40, 60, 110, 150]))) for i in range(60)]
    a, b = left(spark, *a_rows), right(spark, *b_rows)
    got = {(r.l_id, r.r_id) for r in naming.distributed(naming.settled_groups(naming.groups(a, b, names.alike(a, b))), a, b).collect()}
    of_left, of_right = {}, {}
    for i, _, _, n, x in a_rows:
        of_left.setdefault(n, []).append((i, int(x)))
    for i, _, _, _, n, x in b_rows:
        of_right.setdefault(n, []).append((i, int(x)))
    pairs = [
        (-len(q), p[0][0], q[0][0], x, y) for x, p in of_left.items() for y, q in of_right.items()
        if S._partial_ratio(x, y) >= 95 and len(p) <= len(q) and abs(sum(v for _, v in p) + sum(v for _, v in q)) <= 100
    ]
    used, want = set(), set()
    for *_, x, y in sorted(pairs):
        if ("l", x) not in used and ("r", y) not in used:
            used |= {("l", x), ("r", y)}
            want |= {(i, j) for (i, _), (j, _) in zip(of_left[x], of_right[y], strict=False)}
    assert got == want and len(want) > 5


def test_rows_near_in_amount_are_those_of_all_rows(spark):
    """The join by stretches of amounts, and what is left over, against all rows of alike names; nulls and negative ones too."""
    rng = random.Random(10)
    amounts = [None, *range(-450, 451, 50), 0.01, -0.01, 99.99, 100.01, 200, 200.01]
    a = left(spark, *[(i, None, [], rng.choice(["ANN", "BOB SMITH", None]), (lambda v: None if v is None else str(v))(rng.choice(amounts))) for i in range(60)])
    b = right(spark, *[(i, None, None, None, rng.choice(["ANN X", "BOB SMITH", None]), (lambda v: None if v is None else str(v))(rng.choice(amounts))) for i in range(60)])
    pairs = names.alike(a, b)
    found = naming.near(a, b, pairs)
    every = naming.met(a, b, pairs).collect()
    near = {(r.l_id, r.r_id, r.tier) for r in every if r.tier in ("PERFECT_MATCH", "EXACT_MATCH", "CLOSE_MATCH")}
    assert {(r.l_id, r.r_id, r.tier) for r in found.collect()} == near and found.count() == len(near) > 50
    sums = {r.l_id: r for r in naming.sums(a, b, pairs, found).collect()}
    assert set(sums) == {r.l_id for r in every}
    for i, r in sums.items():
        rest = [x.r_amount for x in every if x.l_id == i and x.tier not in S.EXACT]
        known = [x for x in rest if x is not None]
        assert (r.rest, r.rest_total) == (len(rest), sum(known) if known else None)
