"""What passes do with ledgers that are large: how tables meet, and answers that no list of all pairs is made for."""

import difflib
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.functions import scalars as S
from ledgerloom.operators import claims, names, placing, policy, report
from ledgerloom.plans import reconcile
from ledgerloom.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grams_of_names_are_not_sent_to_the_driver(spark):
    rows = [(f"CUSTOMER NUMBER {i:06d}",) for i in range(300)]
    a, b = spark.createDataFrame(rows, "l_name string"), spark.createDataFrame(rows, "r_name string")
    a, b = storage.settle(a), storage.settle(b)
    grams = names._by_grams(a, b, "l_name", "r_name", 95)
    assert not [x for x in plan(grams).splitlines() if "BroadcastHashJoin" in x and "gram" in x]
    assert "BroadcastHashJoin" not in plan(names._by_ends(a, b, "l_name", "r_name", 95)).replace("BroadcastHashJoin [length", "")
    found = {tuple(r) for r in grams.collect()}
    assert found >= {(r[0], r[0]) for r in rows}


def test_large_settled_tables_are_not_sent_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(storage, "SMALL", 100)
    ids = spark.range(1000)
    large = storage.settle(ids)
    assert "Broadcast" not in plan(ids.join(large, "id")) and ids.join(large, "id").count() == 1000
    monkeypatch.setattr(storage, "SMALL", 10**9)
    assert "Broadcast" in plan(ids.join(storage.settle(ids), "id"))


def plain_ratio(a, b):
    """The published formula, every window of a block."""
    if a in b:
        return 100
    best = 0.0
    for block in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
        start = max(0, block.b - block.a)
        ratio = difflib.SequenceMatcher(None, a, b[start : start + len(a)], autojunk=False).ratio()
        if ratio > 0.995:
            return 100
        best = max(best, ratio)
    return round(100 * best)


def test_partial_ratio_stops_early_with_the_same_score():
    rng = random.Random(8)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    for _ in range(4000):
        a = text(rng.randint(1, 20), rng.choice(["AB", "ABCDEFGH"]))
        k = rng.randrange(len(a))
        b = rng.choice([text(rng.randint(0, 6), "AB") + a[:k] + a[k + 1 :], text(rng.randint(len(a), 30), "ABCD"), a[:k] + "X" + a[k + 1 :] + text(3, "AB")])
        if len(a) <= len(b):
            assert S._partial_ratio(a, b) == plain_ratio(a, b), (a, b)
    a = text(150, "ABCDEFGHIJ")
    assert S._partial_ratio(a, "MR " + a[:70] + a[71:]) == plain_ratio(a, "MR " + a[:70] + a[71:]) == 100


def test_names_are_scored_once(spark):
    a = spark.createDataFrame([(f"CUSTOMER {i:06d}",) for i in range(50)], "name string")
    b = a.select(F.concat(F.lit("MR "), F.expr("left(name, length(name) - 1)")).alias("name"))
    assert plan(names.alike(a, b)).count("ArrowEvalPython [") == 1


LEFT = "l_id long, placing_no string, tokens array<string>, name string, amount decimal(18,2)"
RIGHT = "r_id long, placing_no string, policy_1 string, policy_2 string, name string, amount decimal(18,2)"


def test_crowded_placing_numbers_get_what_all_pairs_give(spark):
    """Singles, nearest rows, offers and fallback of numbers that many rows share, against every pair of rows."""
    rng = random.Random(12)
    amount = lambda most: None if rng.random() < 0.1 else Decimal(rng.randint(-most, most)) / 100
    place = lambda: rng.choice(["A", "B", "C", "", None, "LONGNUMBER12", "LONGNUMBER12X"])
    a = spark.createDataFrame([(i, place(), [], "N", amount(9000 if i % 2 else 400)) for i in range(150)], LEFT)
    b = spark.createDataFrame([(i, place(), None, None, "N", amount(9000 if i % 3 else 300)) for i in range(1000, 1130)], RIGHT)
    wide = spark.createDataFrame([(900, "D", [], "N", Decimal("-9999999999999999.99")), (901, "D", [], "N", Decimal("5.00")), (902, "D", [], "N", Decimal("5.00"))], LEFT)
    a, b = a.unionByName(wide), b.unionByName(spark.createDataFrame([(2000 + i, "D", None, None, "N", Decimal("9999999999999999.98") if i else None) for i in range(4)], RIGHT))
    every = placing.candidates(a, b, 1.005)
    plain = placing.Found(every, None, 1.005)
    quick = placing.find(a, b, 1.005, most=2)
    assert quick.crowds is not None and quick.pairs.where("share is null").count() == 0
    rows = lambda d, *c: sorted(map(repr, d.select(*c).collect()))
    assert rows(quick.single(), "l_id", "r_id", "diff", "tier") == rows(placing.single(every), "l_id", "r_id", "diff", "tier")
    for most in (2, 20):
        best = placing.top(every, placing.single(every), most)
        assert rows(placing.tops(quick, most), "l_id", "r_id", "l_amount", "r_amount", "place") == rows(best, "l_id", "r_id", "l_amount", "r_amount", "place")
    assert rows(placing.combinations_of(quick), "l_id", "r_id") == rows(placing.combinations_of(plain), "l_id", "r_id")
    for got, want in zip(placing.offers(quick), placing.offers(plain), strict=True):
        assert rows(got, *got.columns) == rows(want, *got.columns) and got.count()


def test_crowded_placing_numbers_make_no_pairs(spark):
    """4,000 rows each of one placing number: 16 million pairs, of which 4,000 are wanted."""
    a = spark.range(4000).selectExpr("id as l_id", "'P' as placing_no", "array('1') as tokens", "'N' as name", "cast(-id * 300 as decimal(18,2)) as amount")
    b = spark.range(4000).selectExpr("id as r_id", "'P' as placing_no", "'1' as policy_1", "null as policy_2", "'N' as name", "cast(id * 300 as decimal(18,2)) as amount")
    found = placing.find(a, b)
    assert found.pairs.count() == 0
    offers, links, fallback = placing.offers(found)
    assert links.where("l_id = r_id").count() == links.count() == offers.count() == fallback.count() == 4000


def test_crowded_policy_numbers_get_what_all_pairs_give(spark):
    rng = random.Random(13)
    name = lambda: rng.choice([None, *(f"{t}CUSTOMER NAME {i:02d}{u}" for i in range(30) for t in ("", "MR ") for u in ("", "X"))])
    a = spark.createDataFrame([(i, None, [rng.choice(["1", "2", "3"]), "2"], name(), Decimal(1)) for i in range(80)], LEFT)
    b = spark.createDataFrame([(i, None, rng.choice(["1", "2", None, ""]), rng.choice(["3", None]), name(), Decimal(1)) for i in range(80)], RIGHT)
    rows = lambda d: sorted(map(tuple, d.select("l_id", "r_id", "score").collect()))
    plain = rows(policy.hits(a, b, 95, most=10**6))
    assert rows(policy.hits(a, b, 95, most=2)) == rows(policy.hits(a, b, 95, most=20)) == plain and plain


def test_crowded_policy_numbers_compare_few_names(spark, monkeypatch):
    a = spark.range(400).selectExpr("id as l_id", "'P' as placing_no", "array('1') as tokens", "concat('CUSTOMER NAME ', lpad(id * 37, 8, '0')) as name", "cast(1 as decimal(18,2)) as amount")
    b = a.selectExpr("l_id as r_id", "placing_no", "'1' as policy_1", "null as policy_2", "name", "amount")
    seen = []
    monkeypatch.setattr(policy, "_scored", lambda mine, theirs, threshold, f=policy._scored: (seen.append(mine.join(theirs, "token").count()), f(mine, theirs, threshold))[1])
    assert policy.hits(a, b).where("l_id = r_id").count() == 400
    assert seen == [0]


def test_keys_of_large_ids_are_plain_numbers(spark, tmp_path):
    spark.createDataFrame([(i, 1, 10.0) for i in (1, 2000000, 2000001, 9000001, 400000000)], "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "C")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r.r_id: r.key for r in QUERIES["normalize_key"](spark, str(tmp_path)).collect()}
    assert got[20000000] == "10001#10000000" and got[4000000000] == "10001#2000000000" and got[10] == "10001#5"
    assert not [k for k in got.values() if "E" in k]


def _contending(spark, rng):
    """Ledgers of few placing numbers and amounts, so that many rows of equal amount have the same partial matches."""
    pick = lambda *values: rng.choice(values)
    amount = lambda *values: None if rng.random() < 0.1 else Decimal(rng.choice(values))
    name = lambda: pick(None, *(f"CUSTOMER NAME {i:02d}" for i in range(60)))
    a = spark.createDataFrame([(i, pick("A", "A", "B", "B", "LONGNUMBER12", None), [pick("1", "2")], name(), amount(-1000, -1100, -1720, -2300, -3450, -5000)) for i in range(240)], LEFT)
    b = spark.createDataFrame([(i, pick("A", "A", "B", "B", "LONGNUMBER12X", None), pick("1", "2", None), None, name(), amount(1700, 1800, 5050)) for i in range(1000, 1240)], RIGHT)
    return storage.settle(a), storage.settle(b)


def test_partial_links_are_listed_once_for_rows_alike(spark, monkeypatch):
    """Every pass gives what it gives where each left row's candidates are listed one by one."""
    a, b = _contending(spark, random.Random(21))
    rows = lambda d: sorted(map(repr, d.select(sorted(d.columns)).collect()))
    find, profile = placing.find, reconcile.Profile(whole_pool=True)
    quick = reconcile.reconcile(a, b, profile)
    monkeypatch.setattr(placing, "find", lambda x, y, t: find(x, y, t, most=10**6))
    plain = reconcile.reconcile(a, b, profile)
    assert plain.shared is None and quick.shared.listed().count() > quick.shared.links.count() > 0
    assert quick.own.join(quick.shared.listed(), ["l_id", "r_id"]).isEmpty()
    assert rows(quick.decisions) == rows(plain.decisions)
    assert rows(quick.links) == rows(plain.links) and rows(quick.fallback.distinct()) == rows(plain.fallback.distinct())
    assert rows(claims.usage(quick)) == rows(claims.usage(plain)) and rows(policy.pool(quick, b)) == rows(policy.pool(plain, b))
    for got, want in zip(report.final_decisions(quick), report.final_decisions(plain), strict=True):
        assert rows(got) == rows(want)
    assert quick.decisions.where("status = 'Partial Match' and resolved_in = '1' and total_stale").count()


def test_rows_alike_do_not_multiply_partial_links(spark):
    """1,000 left rows with the same 500 partial matches: 500,000 links, of which 500 are written."""
    a = spark.range(1000).selectExpr("id as l_id", "'P' as placing_no", "array('1') as tokens", "'N' as name", "cast(-1000 as decimal(18,2)) as amount")
    b = spark.range(500).selectExpr("id as r_id", "'P' as placing_no", "'1' as policy_1", "null as policy_2", "'N' as name", "cast(1700 as decimal(18,2)) as amount")
    state = reconcile.reconcile(a, b, reconcile.Profile(passes=("1",)))
    assert state.own.isEmpty() and state.shared.links.count() == 500 and state.links.count() == 500_000
    decisions, links = report.final_decisions(state)
    assert decisions.where("status = 'Partial Match'").count() == 1000 and links.count() == 500_000


def test_passes_tried_does_not_run_the_last_pass(spark, monkeypatch):
    rows = [(1, "P", ["1"], "A", Decimal(-100)), (2, "P", ["1"], "B", Decimal(-900)), (3, None, ["2"], "C", Decimal(-500)), (4, "P", [], None, None)]
    a = spark.createDataFrame(rows, LEFT)
    b = spark.createDataFrame([(10, "P", "1", None, "A", Decimal(100)), (11, None, "2", None, "C", Decimal(500))], RIGHT)
    profile = reconcile.Profile(passes=("1", "2"))
    whole = {tuple([r.l_id, *r.passes]) for r in reconcile.reconcile(a, b, profile).decisions.collect()}
    monkeypatch.setattr(policy, "hits", lambda *_: 1 / 0)
    assert {tuple([r.l_id, *r.passes]) for r in reconcile.tried(a, b, profile).collect()} == whole == {(1, "1"), (2, "1", "2"), (3, "1", "2"), (4, "1", "2")}


def test_pool_is_told_without_pass_1_being_done(spark, monkeypatch):
    """The pool needs neither decisions nor a list of partial matches, and is what pass 1 leaves."""
    a, b = _contending(spark, random.Random(22))
    rows = lambda d: sorted(r.r_id for r in d.select("r_id").collect())
    wants = {t: rows(policy.pool(reconcile.reconcile(a, b, reconcile.Profile(tolerance=t, passes=("1",))), b)) for t in (100, 60)}
    find = placing.find
    for name in ("partial_crowded", "_rated_offers"):
        monkeypatch.setattr(placing, name, lambda *_: 1 / 0)
    monkeypatch.setattr(claims, "apply", lambda *_: 1 / 0)
    for most in (32, 10**6):
        monkeypatch.setattr(placing, "find", lambda x, y, t, most=most: find(x, y, t, most=most))
        for t, want in wants.items():
            assert rows(reconcile.spare(a, b, reconcile.Profile(tolerance=t))) == want
    assert all(wants.values()) and wants[100] != wants[60]


def test_right_rows_of_partial_matches_are_found_without_listing_them(spark):
    rng = random.Random(23)
    a = spark.createDataFrame([(i, rng.choice("AB"), [], "N", Decimal(rng.randint(-2500, 2500)) / 100) for i in range(60)], LEFT)
    b = spark.createDataFrame([(i, rng.choice("AB"), None, None, "N", rng.choice([None, Decimal(rng.randint(-6000, 6000)) / 100])) for i in range(400)], RIGHT)
    taken = a.where("l_id % 4 > 0")
    for tolerance in (0.001, 0.01, 0.375, 1, 1.005):
        crowds = placing.crowded(a, b, tolerance, most=2)
        want = {r.r_id for r in placing.partial_crowded(crowds, taken).collect()}
        got = [r.r_id for r in placing.loosely_crowded(crowds, taken).collect()]
        assert sorted(got) == sorted(want)
    assert got


def test_right_rows_are_not_cut_into_grams_if_all_left_rows_are_crowded(spark):
    rows = lambda n: [(i, "CROWDEDNUMBER", [], "N", Decimal(-i)) for i in range(n)]
    a = spark.createDataFrame([*rows(5), (5, "CROWDEDNUMBER", [], "N", None), (6, None, [], "N", Decimal(1))], LEFT)
    b = spark.createDataFrame([(i, p, None, None, n, -x) for i, p, _, n, x in rows(9)] + [(9, "CROWDEDNUMBERX", None, None, "N", Decimal(1))], RIGHT)
    found = placing.find(a, b, most=2)
    assert "gram" not in plan(found.pairs) and found.pairs.columns == placing.candidates(a, b).columns and found.pairs.isEmpty()
    other = spark.createDataFrame([(7, "CROWDEDNUMBE", [], "N", Decimal(1))], LEFT)
    assert {r.r_id for r in placing.find(a.unionByName(other), b, most=2).pairs.where("l_id = 7").collect()} == set(range(10))


def test_pairs_of_crowded_numbers_are_dealt_in_cells(spark, monkeypatch):
    """Every candidate once, with what candidates() says of it, however rows of numbers are cut; many tasks for one number."""
    rng = random.Random(24)
    amount = lambda: rng.choice([None, Decimal(rng.randint(-1200, 1200)), Decimal(rng.randint(-99999, 99999)) / 100, Decimal("9999999999999999.99")])
    place = lambda: rng.choice(["A", "A", "B", "", None, "LONGNUMBER12", f"N{rng.randint(0, 5)}"])
    a = spark.createDataFrame([(i, place(), [], "N", amount()) for i in range(260)], LEFT)
    b = spark.createDataFrame([(i, rng.choice([place(), "LONGNUMBER12X"]), None, None, "N", amount()) for i in range(300)], RIGHT)
    monkeypatch.setattr(placing, "EDGE", 10)
    monkeypatch.setattr(placing, "TASK", 100)
    for left in (a, a.where("placing_no = 'A'"), a.where("placing_no = 'N1'"), a.where("placing_no = ''")):
        for tolerance in (100, 1.005):
            every = placing.candidates(left, b, tolerance).withColumn("confidence", S.confidence(F.col("diff"), tolerance)).withColumn("diff", F.col("diff").cast("double"))
            got = placing.classified(left, b, tolerance)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, every.select(got.columns).collect()))
    wide = placing.classified(a.where("placing_no = 'A'"), b)
    assert wide.rdd.getNumPartitions() > 4 and sum(n > 0 for n in wide.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) > 4


def test_files_of_pairs_of_crowded_numbers_are_small(spark, monkeypatch, tmp_path):
    """Pairs are listed so that columns repeat themselves, and every pair is there once however rows are cut in strips."""
    a = spark.createDataFrame([(i * 7919, "A", [], "N", Decimal(i % 60 * 977) / 100) for i in range(600)], LEFT)
    b = spark.createDataFrame([(i * 7919, "A", None, None, "N", Decimal(i % 100 * 1013) / 100) for i in range(1000)], RIGHT)
    monkeypatch.setattr(placing, "TASK", 1 << 18)
    path = str(tmp_path / "pairs")
    placing.classified(a, b).write.parquet(path)
    assert spark.read.parquet(path).select("l_id", "r_id").distinct().count() == 600_000
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 250_000
    monkeypatch.setattr(placing, "EDGE", 21)
    monkeypatch.setattr(placing, "STRIPS", (4, 10))
    few, some = a.where("l_id < 7919 * 90"), b.where("r_id < 7919 * 130")
    want = placing.candidates(few, some).withColumn("confidence", S.confidence(F.col("diff"))).withColumn("diff", F.col("diff").cast("double"))
    got = placing.classified(few, some)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
