"""Queries of the reconciliation over the test ledgers, and SQL for DuckDB that tells the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import claims, matrix, names, naming, placing, policy, report
from ..sources import ingest
from ..storage import settle
from . import ledgers as L
from . import reconcile as R

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")})


def query(sql: str | None = None, amounts: str = "", contested: bool = False):
    """Register a query under its function's name, with its SQL after the ledgers' common tables.

    amounts: names of the SQL's columns that are decimals. contested: register it once more, as contested_<name>, over
    the ledgers whose rows contend; the function takes the ledgers to use.
    """

    def add(f: Query) -> Query:
        cast = ", ".join(f"cast({c} as double) as {c}" for c in amounts.split())
        for name, tables, use in ((f.__name__, L.CLEAN_SQL, {}), (f"contested_{f.__name__}", L.CONTESTED_SQL, {"ledgers": L.contested}))[: 1 + contested]:
            QUERIES[name] = lambda spark, sf_dir, use=use: _shown(f(spark, sf_dir, **use))
            if sql is not None:
                ORACLES[name] = f"select * {f'replace ({cast})' if cast else ''} from (with recursive {tables}{sql}) as q"
        return f

    return add


def _tier_sql(d: str, pick: int = 1, other: str = "NO_MATCH") -> str:
    return "case " + " ".join(f"when {d} <= 100 * {t[0]} then '{t[pick]}'" for t in S.TIERS) + f" else '{other}' end"


T, C = _tier_sql("abs(l_amount + r_amount)"), _tier_sql("diff", 2, "None")
CAND = f""", eq as (
  select l_id, r_id, l.amount as l_amount, r.amount as r_amount, null::double as share
  from l join r on l.placing_no = r.placing_no where l.placing_no <> '' and l.amount is not null
), sub as (
  select l_id, r_id, l.amount as l_amount, r.amount as r_amount,
    least(length(l.placing_no), length(r.placing_no)) / greatest(length(l.placing_no), length(r.placing_no)) as share
  from (select * from l where length(placing_no) >= 10 and placing_no not in (select placing_no from r where placing_no is not null)) l
    join r on length(r.placing_no) >= 10 and left(l.placing_no, 10) = left(r.placing_no, 10) and (contains(l.placing_no, r.placing_no) or contains(r.placing_no, l.placing_no))
  where least(length(l.placing_no), length(r.placing_no)) / greatest(length(l.placing_no), length(r.placing_no)) >= 0.8
), cand as (
  select *, cast(abs(l_amount + r_amount) as decimal(28,2)) as diff, {T} as tier from (from eq union all from sub)
), one as (
  select l_id, min(r_id) as r_id from cand where tier in ('PERFECT_MATCH', 'EXACT_MATCH') group by l_id
), near as (
  select *, row_number() over (partition by l_id order by diff, r_id) as near, count(*) over (partition by l_id) as n
  from cand where l_id not in (select l_id from one) and r_amount is not null
), top as (
  select l_id, r_id, l_amount, r_amount, row_number() over (partition by l_id order by case when n > 20 then near else 0 end, r_id) as place
  from near where near <= 20
), c2 as (
  select a.l_id, 2 as size, [a.r_id, b.r_id] as ids, [a.place, b.place] as places, abs(a.l_amount + a.r_amount + b.r_amount) as diff
  from top a join top b on a.l_id = b.l_id and a.place < b.place
), c3 as (
  select a.l_id, 3 as size, [a.r_id, b.r_id, c.r_id] as ids, [a.place, b.place, c.place] as places, abs(a.l_amount + a.r_amount + b.r_amount + c.r_amount) as diff
  from top a join top b on a.l_id = b.l_id and a.place < b.place join top c on a.l_id = c.l_id and b.place < c.place
), c4 as (
  select a.l_id, 4 as size, [a.r_id, b.r_id, c.r_id, d.r_id] as ids, [a.place, b.place, c.place, d.place] as places,
    abs(a.l_amount + a.r_amount + b.r_amount + c.r_amount + d.r_amount) as diff
  from top a join top b on a.l_id = b.l_id and a.place < b.place join top c on a.l_id = c.l_id and b.place < c.place join top d on a.l_id = d.l_id and c.place < d.place
), c5 as (
  select a.l_id, 5 as size, [a.r_id, b.r_id, c.r_id, d.r_id, e.r_id] as ids, [a.place, b.place, c.place, d.place, e.place] as places,
    abs(a.l_amount + a.r_amount + b.r_amount + c.r_amount + d.r_amount + e.r_amount) as diff
  from top a join top b on a.l_id = b.l_id and a.place < b.place join top c on a.l_id = c.l_id and b.place < c.place join top d on a.l_id = d.l_id and c.place < d.place
    join top e on a.l_id = e.l_id and d.place < e.place
), combo as (
  select l_id, unnest(ids) as r_id from (
    select *, row_number() over (partition by l_id order by size, case when diff <= 100 then 0 else 1 end, places) as n
    from (from c2 union all from c3 union all from c4 union all from c5) where diff <= 200
  ) where n = 1
), loose as (
  select l_id, r_id from cand where tier in ('REVIEW_REQUIRED', 'INVESTIGATION_REQUIRED')
    and l_id not in (select l_id from one) and l_id not in (select l_id from combo)
), links as (
  select l_id, r_id, 0 as kind from one union all select l_id, r_id, 1 from combo union all select l_id, r_id, 2 from loose
), offers as (
  select l_id, kind, count(*) as size from links group by l_id, kind
), own as (
  select l_id, r_id from (
    select k.l_id, k.r_id, row_number() over (partition by k.r_id order by o.kind, o.size desc, k.l_id) as n
    from links k join offers o on k.l_id = o.l_id where o.kind < 2
  ) where n = 1
), loosely as (
  select l_id, r_id from links where kind = 2 and r_id not in (select r_id from own)
), after1 as (
  select l.l_id, case when o.l_id is null then 'No Match' when o.kind < 2 and l.l_id in (select l_id from own) then 'Exact Match'
    when o.kind = 2 and l.l_id in (select l_id from loosely) then 'Partial Match' else 'No Match' end as status
  from l left join offers o on l.l_id = o.l_id
), fb as (
  select l_id, r_id from cand where l_id in (select l_id from links where kind < 2) and (l_id, r_id) not in (select (l_id, r_id) from links)
), pool as (
  select distinct r_id from fb where r_id not in (select r_id from loosely)
)"""
HITS = """, hit as (
  select l.l_id, r.r_id, l.amount as l_amount, r.amount as r_amount, 100 as score
  from (select *, unnest(list_distinct(tokens)) as token from l) l
  join (select *, unnest(list_distinct(list_filter([policy_1, policy_2], lambda p: p is not null and p <> ''))) as token from r) r on l.token = r.token
  where contains(l.name, r.name) or contains(r.name, l.name)
)"""
PAIRS = """, pairs as (
  select a.name as l_name, b.name as r_name, 100 as score from (select distinct name from l) a join (select distinct name from r) b
    on contains(a.name, b.name) or contains(b.name, a.name)
)"""
MET = (
    PAIRS
    + f""", met as (
  select l_id, r_id, l.amount as l_amount, r.amount as r_amount, score, cast(abs(l.amount + r.amount) as decimal(28,2)) as diff,
    {T.replace("l_amount", "l.amount").replace("r_amount", "r.amount")} as tier
  from l join pairs on l.name = l_name join r on r.name = r_name
), s as (
  select l_id, count(*) filter (tier in ('PERFECT_MATCH', 'EXACT_MATCH')) as n_single,
    count(*) filter (tier not in ('PERFECT_MATCH', 'EXACT_MATCH')) as rest,
    cast(sum(r_amount) filter (tier not in ('PERFECT_MATCH', 'EXACT_MATCH')) as decimal(28,2)) as rest_total,
    min(r_id) filter (tier = 'CLOSE_MATCH') as close_id, arg_min(diff, r_id) filter (tier = 'CLOSE_MATCH') as close_diff, any_value(l_amount) as l_amount
  from met group by l_id
), s2 as (
  select *, cast(abs(l_amount + rest_total) as decimal(28,2)) as rest_diff from s
), s3 as (
  select *, {_tier_sql("rest_diff")} as rest_tier from s2
), choice as (
  select *, case when rest_tier in ('PERFECT_MATCH', 'EXACT_MATCH') then 'all' when n_single > 0 then 'single'
    when close_id is not null and (rest_tier <> 'CLOSE_MATCH' or close_diff <= rest_diff) then 'one' when rest_tier = 'CLOSE_MATCH' then 'rest' end as take
  from s3
)"""
)
GROUPS = (
    PAIRS
    + """, lg as (select name, count(*) as n, sum(amount) as t, min(l_id) as f from l group by name), rg as (select name, count(*) as n, sum(amount) as t, min(r_id) as f from r group by name),
g as (
  select l_name, r_name, score, lg.n as n_left, rg.n as n_right, cast(lg.t as decimal(28,2)) as l_total, cast(rg.t as decimal(28,2)) as r_total,
    cast(abs(lg.t + rg.t) as decimal(28,2)) as diff, lg.f as l_first, rg.f as r_first
  from pairs join lg on lg.name = l_name join rg on rg.name = r_name where abs(lg.t + rg.t) <= 100
)"""
)


# Scalar functions


@query(" select l_id, placing_no from l")
def clean_placing(spark, sf_dir):
    """Cleaned placing numbers of the left ledger."""
    return L.ledgers(spark, sf_dir)[0].select("l_id", "placing_no")


@query(" select l_id, array_to_string(tokens, ' ') as tokens from l")
def policy_tokens(spark, sf_dir):
    """Policy tokens of the left ledger."""
    return L.ledgers(spark, sf_dir)[0].select("l_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    """ select l_id, case when l_id % 5 < 3 then Amount end as amount from left_ledger""", amounts="amount")
def numeric_coerce(spark, sf_dir):
    """Amounts from text: plain, with white space and in exponents; grouped digits and words are none."""
    left = L.raw_ledgers(spark, sf_dir)[0]
    cents = (F.col("Amount") * 100).cast("long").cast("string")
    text = F.col("Amount").cast("string")
    forms = F.array(text, F.concat(F.lit("  "), text, F.lit(" ")), F.concat(cents, F.lit("e-2")), F.concat(F.lit("Rs "), text), F.lit("1,234.00"))
    return left.select("l_id", S.to_amount(F.get(forms, (F.col("l_id") % 5).cast("int"))).alias("amount"))


KEYS = ["PlacingNo", "PolicyNo", "ClientName", "Amount"]
R_KEYS = ["PlacingNo", "PolicyNo_1", "ClientName", "Amount"]


def _key_sql(columns: list[str]) -> str:
    return "concat_ws('#', " + ", ".join(f"coalesce(trim(cast({c} as varchar)), '')" for c in columns) + ")"


@query(f" select l_id, {_key_sql(KEYS)} as matrix_key from left_ledger")
def matrix_key(spark, sf_dir):
    """Composite keys of the left ledger."""
    return L.raw_ledgers(spark, sf_dir)[0].select("l_id", S.build_key(*[F.col(c) for c in KEYS]).alias("matrix_key"))


@query(" select r_id, regexp_replace(concat(PolicyNo_1, '.0#', round(r_id / 2, 1)), '\\.0(#|$)', '\\1', 'g') as key from (select r_id, PolicyNo_1 from right_ledger where PolicyNo_1 is not null)")
def normalize_key(spark, sf_dir):
    """Keys that numbers read as floats have spoilt, made normal."""
    right = L.raw_ledgers(spark, sf_dir)[1].where("PolicyNo_1 is not null")
    half = (F.col("r_id") / 2).cast("decimal(20,1)").cast("string")  # a double of 10 million or more would be text as 1.0E7
    spoilt = F.concat("PolicyNo_1", F.lit(".0#"), half)
    return right.select("r_id", S.normalize_key(spoilt).alias("key"))


@query(" select l_id, concat(placing_no, ' , B ,') as rule, placing_no || '+B' as lhs, name as rhs from l")
def split_matrix(spark, sf_dir):
    """Keys of rules made of the left ledger's rows."""
    left = L.ledgers(spark, sf_dir)[0].withColumn("rule", F.concat("placing_no", F.lit(" , B ,|"), "name"))
    cut = left.withColumn("m", S.split_matrix(F.col("rule")))
    return cut.select("l_id", F.split("rule", r"\|")[0].alias("rule"), F.array_join("m.lhs", "+").alias("lhs"), F.array_join("m.rhs", "+").alias("rhs"))


@query(
    f"{CAND} select l_id, r_id, round(share * 1000)::bigint as per_mille from sub"
)
def substring_overlap(spark, sf_dir):
    """Pairs of placing numbers of which one is inside the other, with their overlap."""
    return placing.inside(*L.ledgers(spark, sf_dir)).select("l_id", "r_id", F.round(F.col("share") * 1000).cast("long").alias("per_mille"))


@query(f"{CAND} select l_id, r_id, diff, tier, {C} as confidence from cand", amounts="diff", contested=True)
def amount_classify(spark, sf_dir, ledgers=L.ledgers):
    """Difference, tier and confidence of all candidates by placing number."""
    return placing.classified(*ledgers(spark, sf_dir))


@query(
    """, p as (
  select l.l_id, r.r_id, case when length(l.name) <= length(r.name) then l.name else r.name end as a, case when length(l.name) <= length(r.name) then r.name else l.name end as b
  from l join r on l.placing_no = r.placing_no
) select l_id, r_id, cast(floor((1 - list_min(list_transform(range(1, length(b) - length(a) + 2), lambda i: levenshtein(a, substr(b, i, length(a))))) / length(a)) * 100 + 0.5) as int) as similarity from p"""
)
def name_similarity_sql(spark, sf_dir):
    """Similarity of the names of rows of equal placing number, by the best window."""
    left, right = L.ledgers(spark, sf_dir)
    met = left.select("l_id", "placing_no", F.col("name").alias("a")).join(right.select("r_id", "placing_no", F.col("name").alias("b")), "placing_no")
    return met.select("l_id", "r_id", S.window_similarity(F.col("a"), F.col("b")).alias("similarity"))


# Pass 1


@query(f"{CAND} select {T} as tier, count(*) as n, cast(sum(abs(l_amount + r_amount)) as decimal(28,2)) as total from eq group by 1", amounts="total", contested=True)
def p1_amount_tiers(spark, sf_dir, ledgers=L.ledgers):
    """Rows of equal placing number by tier."""
    eq = placing.equal(*ledgers(spark, sf_dir))
    diff = S.difference(F.col("l_amount"), F.col("r_amount"))
    return eq.groupBy(S.amount_tier(diff).alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.sum(diff).cast("decimal(28,2)").alias("total"))


@query(f"{CAND} select one.l_id, one.r_id, diff, tier from one join cand on one.l_id = cand.l_id and one.r_id = cand.r_id", amounts="diff", contested=True)
def p1_single(spark, sf_dir, ledgers=L.ledgers):
    """The first right row within tolerance of each left row."""
    return placing.find(*ledgers(spark, sf_dir)).single().select("l_id", "r_id", "diff", "tier")


@query(f"{CAND} select l_id, r_id, diff, tier from cand where share is not null", amounts="diff")
def p1_substring(spark, sf_dir):
    """Candidates by a placing number inside another."""
    return placing.candidates(*L.ledgers(spark, sf_dir)).where("share is not null").select("l_id", "r_id", "diff", "tier")


@query(f"{CAND} select l_id, r_id, place from top", contested=True)
def p1_top20(spark, sf_dir, ledgers=L.ledgers):
    """The 20 candidates nearest in amount, of left rows without a single match."""
    return placing.tops(placing.find(*ledgers(spark, sf_dir))).select("l_id", "r_id", F.col("place").cast("long").alias("place"))


@query(f"{CAND} select l_id, r_id from combo", contested=True)
def p1_combo(spark, sf_dir, ledgers=L.ledgers):
    """Combinations of two to five right rows."""
    return placing.combinations_of(placing.find(*ledgers(spark, sf_dir)))


@query(f"{CAND} select l_id, r_id from loose", contested=True)
def p1_partial(spark, sf_dir, ledgers=L.ledgers):
    """Partial candidates."""
    offers, links, _ = placing.offers(placing.find(*ledgers(spark, sf_dir)))
    return links.join(offers.where("kind = 2").select("l_id"), "l_id", "left_semi")


@query(
    f"""{CAND} select one.l_id, 'Placing Number' || case when share is null then '' else ' (CBL in Insurer: ' || cast(cast(share * 100 as decimal(9,1)) as varchar) || '% overlap)' end
  || ' + Single Amount Match (' || {C} || ' Confidence, Diff: $' || cast(cast(diff as decimal(18,2)) as varchar) || ')' as reason
from one join cand on one.l_id = cand.l_id and one.r_id = cand.r_id""")
def p1_reasons(spark, sf_dir):
    """What the report says of left rows with a single match."""
    offers, _, _ = placing.offers(placing.find(*L.ledgers(spark, sf_dir)))
    return offers.where("kind = 0").select("l_id", "reason")


def _pass1(spark, sf_dir, ledgers=L.ledgers):
    left, right = (settle(d) for d in ledgers(spark, sf_dir))
    return left, right, R.reconcile(left, right, R.Profile(passes=("1",)))


@query(f"{CAND} select l_id, r_id from own", contested=True)
def p1_claims(spark, sf_dir, ledgers=L.ledgers):
    """Which left row owns which right row after pass 1."""
    offers, links, _ = placing.offers(placing.find(*ledgers(spark, sf_dir)))
    return claims.owners(offers, links)


@query(f"{CAND} select l_id, status from after1", contested=True)
def p1_decisions(spark, sf_dir, ledgers=L.ledgers):
    """Status of every left row after pass 1."""
    return _pass1(spark, sf_dir, ledgers)[2].decisions.select("l_id", "status")


@query(f"{HITS} select r_id, count(distinct l_id) as claimants from hit group by r_id having count(distinct l_id) > 1")
def claims_multi(spark, sf_dir):
    """Right rows that several left rows would claim by policy and name."""
    return claims.contested(policy.hits(*L.ledgers(spark, sf_dir)))


@query(f"{CAND} select (select count(distinct r_id) from own) as exact_used, (select count(distinct r_id) from loosely) as partial_used, (select count(distinct r_id) from (select r_id from own union all select r_id from loosely)) as used, (select count(*) from after1 where status = 'Exact Match') as exact_left, (select count(*) from after1 where status = 'Partial Match') as partial_left, (select count(*) from (select r_id from loosely group by r_id having count(distinct l_id) > 1)) as multi_claimed", contested=True)
def usage_summary(spark, sf_dir, ledgers=L.ledgers):
    """Counts of rows in use after pass 1."""
    return claims.usage(_pass1(spark, sf_dir, ledgers)[2])


# Pass 2


@query(f"{CAND} select r_id from pool", contested=True)
def p2_pool(spark, sf_dir, ledgers=L.ledgers):
    """Right rows that pass 1 leaves for pass 2."""
    return R.spare(*ledgers(spark, sf_dir))


@query(f"{HITS} select l_id, r_id, score from hit")
def p2_policy_hits(spark, sf_dir):
    """Rows that agree in policy number and name, over whole ledgers."""
    return policy.hits(*L.ledgers(spark, sf_dir)).select("l_id", "r_id", "score")


P2 = f"{HITS}, per as (select l_id, count(*) as size, cast(abs(any_value(l_amount) + sum(r_amount)) as decimal(28,2)) as diff from hit group by l_id)"


@query(f"{P2} select l_id, size, diff, {C} as confidence, case when diff <= 200 then 0 else 2 end as kind from per where diff <= 1000", amounts="diff")
def p2_decisions(spark, sf_dir):
    """What pass 2 offers each left row over whole ledgers."""
    return policy.offers(policy.hits(*L.ledgers(spark, sf_dir))).select("l_id", "size", "diff", "confidence", "kind")


@query(
    # rows without an amount add nothing
    f"""{HITS}, per as (select l_id, count(*) as size, abs(any_value(l_amount) + coalesce(sum(r_amount), 0)) as diff from hit group by l_id)
select l_id, r_id from (select h.l_id, h.r_id, row_number() over (partition by h.r_id order by p.size desc, h.l_id) as n from hit h join per p on h.l_id = p.l_id where p.diff <= 200) where n = 1""",
    contested=True)
def p2_claims(spark, sf_dir, ledgers=L.ledgers):
    """Which left row would own which right row after pass 2 over whole ledgers: larger offers first."""
    found = settle(policy.hits(*ledgers(spark, sf_dir)))
    return claims.owners(policy.offers(found), found.select("l_id", "r_id"))


# Pass 3 over whole ledgers


def _pairs(spark, sf_dir):
    left, right = L.ledgers(spark, sf_dir)
    left, right = settle(left), settle(right)
    return left, right, settle(names.alike(left, right))


@query(f"{PAIRS} select * from pairs")
def p3_name_pairs(spark, sf_dir):
    """Pairs of names alike."""
    return _pairs(spark, sf_dir)[2]


@query(f"{GROUPS} select l_name, r_name, score, n_left, n_right, l_total, r_total, diff from g", amounts="l_total r_total diff")
def p3_groups(spark, sf_dir):
    """Pairs of names whose totals agree."""
    return naming.groups(*_pairs(spark, sf_dir)).drop("rank")


@query(f"{MET} select l_id, r_id, diff from met where tier in ('PERFECT_MATCH', 'EXACT_MATCH')", amounts="diff")
def p3_single(spark, sf_dir):
    """Right rows within tolerance whose name is alike."""
    return naming.singles(naming.near(*_pairs(spark, sf_dir)))


@query(f"{MET} select l_id, n_single, rest, rest_total, rest_diff, rest_tier, take from choice", amounts="rest_total rest_diff")
def p3_cumulative(spark, sf_dir):
    """Per left row what single rows leave over, its sum, and what is taken."""
    rows = _pairs(spark, sf_dir)
    per = naming.choices(naming.sums(*rows, naming.near(*rows)))
    return per.select("l_id", "n_single", "rest", F.col("rest_total").cast("decimal(28,2)").alias("rest_total"), "rest_diff", "rest_tier", "take")


@query(f"{MET} select l_id, r_id, diff, tier from met where l_id not in (select l_id from choice where take is not null)", amounts="diff")
def p3_partial(spark, sf_dir):
    """Name hits of left rows without an exact offer."""
    rows = _pairs(spark, sf_dir)
    none = rows[1].select("r_id").where("false")
    return naming.partials(*rows, settle(naming.choices(naming.sums(*rows, naming.near(*rows)))), none).select("l_id", "r_id", "diff", "tier")


@query(
    f"""{MET}, k as (
  select m.l_id, m.r_id, count(*) over (partition by m.l_id) as size from met m join choice c on m.l_id = c.l_id
  where take = 'all' or (take = 'single' and tier in ('PERFECT_MATCH', 'EXACT_MATCH')) or (take = 'one' and m.r_id = close_id) or (take = 'rest' and tier not in ('PERFECT_MATCH', 'EXACT_MATCH'))
) select l_id, r_id from (select l_id, r_id, row_number() over (partition by r_id order by size desc, l_id) as n from k) where n = 1""")
def p3_claims(spark, sf_dir):
    """Which left row would own which right row after pass 3 over whole ledgers, groups aside."""
    left, right, pairs = _pairs(spark, sf_dir)
    return claims.owners(*naming.offers(left, right, pairs, right.select("r_id").where("false")))


@query(
    """, b as (select distinct 'MR ' || left(name, length(name) - 1) as name from l where name is not null), a as (select distinct name from l where name is not null)
select a.name as l_name, b.name as r_name, cast(round(100 * 2 * (length(a.name) - 1) / (2 * length(a.name) - 1.0)) as int) as score from a join b
  on list_contains(list_transform(range(1, length(a.name) + 1), lambda i: left(a.name, i - 1) || substr(a.name, i + 1)), right(b.name, length(a.name) - 1))""",
    contested=True)
def p3_fuzzy_pairs(spark, sf_dir, ledgers=L.ledgers):
    """Names against the same ones with a title before them and without their last letter, none of which holds another."""
    left, _ = ledgers(spark, sf_dir)
    cut = left.select(F.concat(F.lit("MR "), F.expr("left(name, length(name) - 1)")).alias("name"))
    return names.alike(left, cut)


@query()
def p3_distribution(spark, sf_dir):
    """Left and right rows of the groups that apply, in order."""
    left, right, pairs = _pairs(spark, sf_dir)
    applied = naming.settled_groups(naming.groups(left, right, pairs))
    return naming.distributed(applied, left, right)


# Matrix rules: every left row's rule names all right rows made of it; each rule comes twice, so that the second loses


@query(
    f""", lk as (
  select l_id, k from (select l_id, {_key_sql(KEYS)} as k from left_ledger) qualify count(*) over (partition by k) = 1
), rk as (
  select r_id, k, count(*) over (partition by k) as n from (select r_id, {_key_sql(R_KEYS)} as k from right_ledger)
), made as (
  select r_id // 10 as l_id, max(n) as n from rk group by 1
)
select lk.l_id as rule_id, lk.l_id, rk.r_id from lk join made on made.l_id = lk.l_id and made.n = 1 join rk on rk.r_id // 10 = lk.l_id"""
)
def matrix_match(spark, sf_dir):
    """Rules between every left row and the right rows made of it: one, three, or none (a key that is missing)."""
    left, right = L.raw_ledgers(spark, sf_dir)
    l_keys, r_keys = settle(matrix.keyed(left, "l_id", KEYS)), settle(matrix.keyed(right, "r_id", R_KEYS))
    named = right.select(F.floor(F.col("r_id") / 10).alias("l_id"), S.normalize_key(S.build_key(*[F.col(c) for c in R_KEYS])).alias("key"))
    rhs = named.groupBy("l_id").agg(F.array_join(F.collect_list("key"), ",").alias("rhs"))
    own = left.select("l_id", S.normalize_key(S.build_key(*[F.col(c) for c in KEYS])).alias("lhs")).join(rhs, "l_id", "left")
    rule = F.concat("lhs", F.lit("|"), F.coalesce("rhs", F.lit("missing")))
    rules = own.select(F.explode(F.array(F.col("l_id"), F.col("l_id") + 10**12)).alias("rule_id"), rule.alias("rule"))
    l_rows, r_rows = matrix.matches(settle(rules), l_keys, r_keys)
    return l_rows.join(r_rows, "rule_id")


# Reports after pass 1


REPORT = f"{CAND}, done as (select l_id, r_id, 'Exact Match' as status from own union all select l_id, r_id, 'Partial Match' from loosely)"


@query(
    f"{REPORT} select l.l_id, coalesce(pos, 0) as pos, d.r_id, case when coalesce(pos, 0) = 0 then l.name end as name, case when coalesce(pos, 0) = 0 then a.status end as status, r.name as name_right, r.amount as amount_right from l join after1 a on l.l_id = a.l_id left join (select l_id, r_id, row_number() over (partition by l_id order by r_id) - 1 as pos from done) d on d.l_id = l.l_id left join r on r.r_id = d.r_id", amounts="amount_right")
def explode_merge(spark, sf_dir):
    """Links of pass 1 with columns of both sides."""
    left, right, state = _pass1(spark, sf_dir)
    decisions, links = report.final_decisions(state)
    rows = report.explode_merge(left.drop("tokens"), right, decisions, links)
    return rows.select("l_id", F.col("pos").cast("long").alias("pos"), "r_id", "name", "status", "name_right", "amount_right")


COVER = f"{REPORT}, covered as (select r.r_id, r.amount, case when r.r_id in (select r_id from own) then 'Exact Match' when r.r_id in (select r_id from loosely) then 'Partial Match' else 'No Match' end as status from r)"


@query(f"{COVER} select r_id, status from covered", contested=True)
def coverage(spark, sf_dir, ledgers=L.ledgers):
    """Every right row's coverage after pass 1."""
    _, right, state = _pass1(spark, sf_dir, ledgers)
    return report.coverage(right, report.final_decisions(state)[1]).select("r_id", "status")


def _sum_sql(status: str) -> str:
    return f"cast(coalesce(sum(amount) filter (status = '{status}'), 0) as decimal(28,2))"


@query(
    f"{CAND} select "
    + ", ".join(f"count(*) filter (status = '{s}') as {n}_matches, {_sum_sql(s)} as {n}_match_amount" for n, s in (("exact", "Exact Match"), ("partial", "Partial Match"), ("no", "No Match")))
    + " from l join after1 on l.l_id = after1.l_id", amounts="exact_match_amount partial_match_amount no_match_amount", contested=True)
def left_stats(spark, sf_dir, ledgers=L.ledgers):
    """Statistics of the left ledger after pass 1."""
    left, _, state = _pass1(spark, sf_dir, ledgers)
    return report.left_stats(left, report.final_decisions(state)[0])


@query(
    f"{COVER} select count(*) as total_rows, "
    + ", ".join(f"count(*) filter (status = '{s}') as {n}_rows, count(*) filter (status = '{s}') * 100.0::double / count(*) as {n}_rate, {_sum_sql(s)} as {n}_amount" for n, s in (("exact_match", "Exact Match"), ("partial_match", "Partial Match"), ("unmatched", "No Match")))
    + " from covered", amounts="exact_match_amount partial_match_amount unmatched_amount", contested=True)
def right_stats(spark, sf_dir, ledgers=L.ledgers):
    """Statistics of the right ledger after pass 1."""
    _, right, state = _pass1(spark, sf_dir, ledgers)
    return report.right_stats(report.coverage(right, report.final_decisions(state)[1]))


# The whole reconciliation; fuzzy names and the order of groups have no SQL


@query()
def reconcile_decisions(spark, sf_dir):
    """Decision on every left row after all passes."""
    state = R.reconcile(*(settle(d) for d in L.ledgers(spark, sf_dir)))
    return report.final_decisions(state)[0].withColumn("passes", F.array_join("passes", ","))


@query()
def reconcile_summary(spark, sf_dir):
    """Left rows, amounts and links by status and pass after all passes."""
    left, right = (settle(d) for d in L.ledgers(spark, sf_dir))  # every pass reads them several times
    decisions, links = report.final_decisions(R.reconcile(left, right))
    per = links.groupBy("l_id").agg(F.count(F.lit(1)).alias("n"))
    rows = left.select("l_id", "amount").join(decisions, "l_id").join(per, "l_id", "left")
    return rows.groupBy("status", F.coalesce("resolved_in", F.lit("-")).alias("resolved_in")).agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(28,2)").alias("amount"), F.coalesce(F.sum("n"), F.lit(0)).alias("links"))


# Ingest: customers dealt over sheets as grids of cells


def plain(name: str, sql: str):
    def add(f: Query) -> Query:
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


@plain(
    "header_detect",
    """with g as (
  select n_nationkey as sheet, 0 as row_idx, [cast('Statement of ' || n_name as varchar), null, null, null, null] as cells from nation
  union all select n_nationkey, 1 + n_nationkey % 3, ['Placing No.', 'Client Name', 'Policy No.', 'Balance (MUR)', 'Currency'] from nation
  union all select c_nationkey, 4 + (c_custkey % 20)::int, [cast(c_custkey as varchar), c_name, '100', '5', 'MUR'] from customer
) select sheet, min(row_idx) as header_row from g where cells[1] = 'Placing No.' group by sheet""",
)
def header_detect(spark, sf_dir):
    """The header row of each of many sheets."""
    nation, customer = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "customer"))
    n = F.lit(None).cast("string")
    text = lambda *v: F.array(*[F.lit(x) for x in v])
    grid = nation.select(F.col("n_nationkey").alias("sheet"), F.lit(0).alias("row_idx"), F.array(F.concat(F.lit("Statement of "), "n_name"), n, n, n, n).alias("cells"))
    grid = grid.unionByName(nation.select(F.col("n_nationkey").alias("sheet"), (1 + F.col("n_nationkey") % 3).alias("row_idx"), text("Placing No.", "Client Name", "Policy No.", "Balance (MUR)", "Currency").alias("cells")))
    grid = grid.unionByName(customer.select(F.col("c_nationkey").alias("sheet"), (4 + F.col("c_custkey") % 20).cast("int").alias("row_idx"), F.array(F.col("c_custkey").cast("string"), F.col("c_name"), F.lit("100"), F.lit("5"), F.lit("MUR")).alias("cells")))
    return ingest.header_rows(grid)


@plain(
    "sheet_similarity",
    """with w as (select n_nationkey, list_distinct(string_split(lower(trim(n_name)), '')) as w from nation)
select a.n_nationkey as a, b.n_nationkey as b, round(len(list_intersect(a.w, b.w)) * 1000000.0 / len(list_distinct(list_concat(a.w, b.w))))::bigint as similarity
from w a join w b on a.n_nationkey < b.n_nationkey""",
)
def sheet_similarity(spark, sf_dir):
    """Similarity of sets of column names (here the letters of nations' names)."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.split("n_name", "").alias("w"))
    a, b = nation.select(F.col("n_nationkey").alias("a"), F.col("w").alias("wa")), nation.select(F.col("n_nationkey").alias("b"), F.col("w").alias("wb"))
    pairs = a.join(b, F.col("a") < F.col("b"))
    return pairs.select("a", "b", F.round(ingest.similarity(F.col("wa"), F.col("wb")) * 1000000).cast("long").alias("similarity"))


@plain(
    "sheet_merge",
    """select cast(c_custkey as varchar) as id, c_name as name, case when c_custkey % 2 = 0 then c_mktsegment end as segment,
  case when c_custkey % 2 = 0 then 'even' else 'odd' end as _source_sheet from customer""",
)
def sheet_merge(spark, sf_dir):
    """Two sheets of unequal columns in one, without repeated headers."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    header = spark.createDataFrame([("id", "name", "segment")], "id string, name string, segment string")
    even, odd = customer.where("id % 2 = 0").unionByName(header), customer.where("id % 2 = 1").drop("segment").unionByName(header.drop("segment"))
    return ingest.merge_sheets({"even": even, "odd": odd})


@plain("json_mapping", "select n_nationkey, n_name as source, lower(n_name) as target from nation")
def json_mapping(spark, sf_dir):
    """Column mappings from JSON with trailing commas."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    text = F.concat(F.lit('{"'), "n_name", F.lit('": "'), F.lower("n_name"), F.lit('", }'))
    return nation.select("n_nationkey", F.explode(ingest.mapping(text)).alias("source", "target"))
