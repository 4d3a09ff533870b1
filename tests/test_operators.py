"""Operators on hand-made rows: nulls, ties, boundaries, brute-force equivalence."""
import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assurspark.functions import expressions as E
from assurspark.operators import aggregates as A
from assurspark.operators import currency as CU
from assurspark.operators import joins as J

D = dt.datetime


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ J-07
def test_or_equi_join_equals_or_join(spark):
    left = spark.createDataFrame(
        [(1, 10, 20), (2, 10, 10), (3, None, 30), (4, None, None), (5, 40, None), (6, 99, 98)],
        "id int, a long, b long")
    right = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z"), (40, "w"), (None, "n")], "k long, v string")
    for how in ("inner", "left"):
        got = J.or_equi_join(left, right, ["a", "b"], "k", how).select("id", "k", "v")
        ref = left.join(right, (right.k == left.a) | (right.k == left.b), how).select("id", "k", "v")
        assert sorted(got.collect()) == sorted(ref.collect())
        assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


# ------------------------------------------------------------------ W-01
def test_latest_per_key_matches_row_number(spark):
    rows = [(1, D(2020, 1, 5), D(2020, 1, 1)), (1, D(2020, 1, 5), D(2020, 1, 3)), (1, None, D(2021, 1, 1)),
            (2, None, D(2019, 1, 1)), (2, None, D(2019, 2, 1)), (3, D(2018, 1, 1), None)]
    df = spark.createDataFrame(rows, "k int, r timestamp_ntz, c timestamp_ntz")
    got = A.latest_per_key(df, ["k"], ["r", "c"])
    w = Window.partitionBy("k").orderBy(F.col("r").desc_nulls_last(), F.col("c").desc_nulls_last())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(ref.select("k", "r", "c").collect())


# ------------------------------------------------------------------ F-29
def test_null_aware_anti(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    vals = spark.createDataFrame([(2,)], "v long")
    with_null = spark.createDataFrame([(2,), (None,)], "v long")
    empty = spark.createDataFrame([], "v long")
    assert sorted(r.k for r in J.null_aware_anti(left, "k", vals, "v").collect()) == [1]
    assert J.null_aware_anti(left, "k", with_null, "v").count() == 0            # one NULL empties
    assert J.null_aware_anti(left, "k", with_null, "v", null_safe=True).count() == 2
    assert J.null_aware_anti(left, "k", empty, "v").count() == 3                # NULL key kept on empty list
    out = J.null_aware_anti(left, "k", vals, "v")
    assert "NestedLoop" not in plan(out)


# ------------------------------------------------------------------ J-08
def test_interval_join_inclusive_boundaries_duplicate(spark):
    facts = spark.createDataFrame([(1, D(2020, 2, 1)), (1, D(2020, 1, 15)), (2, D(2020, 1, 1))],
                                  "p long, at timestamp_ntz")
    versions = spark.createDataFrame([(1, 10, D(2020, 1, 1), D(2020, 2, 1)), (1, 11, D(2020, 2, 1), D(9999, 12, 31))],
                                     "pid long, vid long, f timestamp_ntz, t timestamp_ntz")
    got = J.interval_join(facts, versions, [("p", "pid")], "at", "f", "t").select("p", "at", "vid")
    assert sorted((r.at.day, r.vid) for r in got.collect()) == [(1, 10), (1, 11), (15, 10)]
    assert "SortMergeJoin" in plan(got) or "BroadcastHashJoin" in plan(got)


# ------------------------------------------------------------- F-01 / J-09
def _rates(spark, rows):
    return spark.createDataFrame(
        [(c, d, decimal.Decimal(str(r))) for c, d, r in rows],
        "ccurr_ccurr_id long, effective_date timestamp_ntz, foreign_exchange_middle decimal(19,8)")


def test_rate_at_date_matches_brute_force(spark):
    random.seed(7)
    rate_rows = []
    for ccy in (41, 42, 49):
        day = D(1995, 1, 1)
        for _ in range(15):
            day = day + dt.timedelta(days=random.choice([1, 3, 40, 200]))
            rate_rows.append((ccy, day, round(random.uniform(0.5, 20), 2)))
    facts = [(i, random.choice([41, 42, 43, 49, 50]), D(1995, 1, 1) + dt.timedelta(days=random.randint(0, 2500)))
             for i in range(300)]
    facts += [(1000, 41, rate_rows[0][1]), (1001, 41, rate_rows[0][1] - dt.timedelta(seconds=1))]
    rates = _rates(spark, rate_rows)
    df = spark.createDataFrame(facts, "id int, ccy long, at timestamp_ntz")
    rt = CU.RateTable(rates)
    got = {r.id: r.rate for r in rt.with_rate(df, "ccy", "at", "rate").collect()}
    got49 = {r.id: r.r49 for r in rt.with_rate(df, 49, "at", "r49").collect()}

    def brute(ccy, at):
        if ccy == CU.HOME_CCY_ID:
            return decimal.Decimal(1)
        cands = [(d, r) for c, d, r in rate_rows if c == ccy and d <= at]
        return decimal.Decimal(str(max(cands)[1])) if cands else None
    for i, ccy, at in facts:
        exp = brute(ccy, at)
        assert (got[i] is None and exp is None) or got[i] == exp, (i, ccy, at)
        exp49 = brute(49, at)
        assert (got49[i] is None and exp49 is None) or got49[i] == exp49
    assert "NestedLoop" not in plan(rt.with_rate(df, 49, "at", "r49"))


def test_converted_expression(spark):
    df = spark.createDataFrame([(decimal.Decimal("10.0000"), 41, 49, decimal.Decimal("2"), decimal.Decimal("4")),
                                (decimal.Decimal("10.0000"), 49, 49, None, None),
                                (decimal.Decimal("10.0000"), 41, 49, None, decimal.Decimal("4"))],
                               "a decimal(19,4), f long, t long, rf decimal(19,8), rt decimal(19,8)")
    out = [r.x for r in df.select(CU.converted("a", "f", "t", "rf", "rt").alias("x")).collect()]
    assert out == [decimal.Decimal("5.000000"), decimal.Decimal("10.000000"), None]


def test_latest_rates_keeps_ties(spark):
    rates = _rates(spark, [(41, D(2020, 1, 1), 1), (41, D(2020, 2, 1), 2), (41, D(2020, 2, 1), 3), (42, D(2019, 1, 1), 5)])
    codes = spark.createDataFrame([(41, "USD"), (42, "EUR")], "cmenak_id long, kod string")
    got = sorted((r.kod, float(r.xRate)) for r in CU.latest_rates(rates, codes).collect())
    assert got == [("EUR", 5.0), ("USD", 2.0), ("USD", 3.0)]


# ------------------------------------------------------------- expressions
def test_optional_filters(spark):
    df = spark.createDataFrame([("MA03",), ("MAX3",), ("FI01",), (None,)], "c string")

    def n(pred):
        return df.where(pred).count() if pred is not None else df.count()
    assert n(E.optional_eq("c", None)) == 4
    assert n(E.optional_eq("c", "")) == 1                 # NULL column matched as ''
    assert n(E.product_pattern("c", "")) == 4
    assert n(E.product_pattern("c", None)) == 3           # c LIKE c: every non-null code
    assert n(E.product_pattern("c", "MA_3")) == 2         # "_" matches one character: MA03, MAX3
    assert n(E.contains_pattern("c", "A0")) == 1
    with pytest.raises(ValueError):
        E.product_pattern("c", "[M]A03")


def test_dates_and_names(spark):
    df = spark.createDataFrame(
        [(D(2020, 1, 1, 23, 59), D(2020, 1, 2, 0, 1), "A", None, "C"), (D(2020, 1, 1), D(2020, 1, 1), None, "B", "C")],
        "s timestamp_ntz, e timestamp_ntz, f string, m string, l string")
    r = df.select(E.day_diff("e", "s").alias("d"), E.person_name("f", "m", "l").alias("n"),
                  E.half_open_days("s", None, None).alias("never"),
                  E.half_open_days("s", None, None, open_end=True).alias("always")).collect()
    assert [x.d for x in r] == [1, 0]
    assert [x.n for x in r] == ["A  C", None]
    assert [x.never for x in r] == [False, False] and [x.always for x in r] == [True, True]


def test_open_at_sentinel(spark):
    df = spark.createDataFrame([("U", None), ("R", None), ("U", D(2020, 6, 1)), ("SP", D(2019, 1, 1))],
                               "code string, settled timestamp_ntz")
    flags = [r.o for r in df.select(E.open_at("code", "settled", D(2020, 1, 1), ("R", "SP", "ZO")).alias("o")).collect()]
    assert flags == [False, True, True, False]


def test_bucketed_interval_join_equals_plain(spark):
    random.seed(3)
    versions, vid = [], 0
    for key in range(6):
        day = D(2000, 1, 1)
        for _ in range(random.randint(1, 12)):
            span = random.choice([0, 5, 40, 400, 2000])
            nxt = day + dt.timedelta(days=span)
            versions.append((key, vid, day, nxt)); vid += 1
            day = nxt
        versions.append((key, vid, day, random.choice([None, D(9999, 12, 31)]))); vid += 1
    facts = [(i, random.randint(0, 6), D(2000, 1, 1) + dt.timedelta(days=random.randint(-30, 9000)))
             for i in range(400)]
    v = spark.createDataFrame(versions, "k long, vid long, f timestamp_ntz, t timestamp_ntz")
    f = spark.createDataFrame(facts, "id int, key long, at timestamp_ntz")
    for how in ("inner",):
        for incl in (True, False):
            got = J.interval_join(f, v, [("key", "k")], "at", "f", "t", how, incl, bucket_months=6)
            ref = J.interval_join(f, v, [("key", "k")], "at", "f", "t", how, incl, bucket_months=None)
            cols = ["id", "vid"]
            assert sorted(got.select(*cols).collect()) == sorted(ref.select(*cols).collect()), (how, incl)


def test_salted_join_splits_hot_keys_and_keeps_rows(spark):
    big = spark.range(5000).select(F.col("id").alias("row"),
                                   F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"))
    small = spark.createDataFrame([(7, "hot"), (7, "hot2"), (1, "one"), (2, "two")], "sk long, v string")
    for how in ("inner", "left"):
        got = J.salted_join(big, small, "k", "sk", how, hot_rows=500, rows_per_split=100)
        ref = big.join(small, big.k == small.sk, how)
        assert sorted(got.select("row", "v").collect()) == sorted(ref.select("row", "v").collect())
    # the hot key (1734 rows) gets 18 salts: its small-side rows are replicated 18 times
    salted = J.salted_join(big, small, "k", "sk", "inner", hot_rows=500, rows_per_split=100)
    assert "xxhash64" in plan(salted) and "Generate explode(sequence" in plan(salted)
    hot = (big.groupBy("k").count().where("count >= 500").collect())
    assert [(r.k, r["count"]) for r in hot] == [(7, 1734)]


def test_scalar_code_lookup_fails_on_two_rows(spark, tables):
    """F-31: a code that is looked up as one value must not be on two rows; on none it matches nothing."""
    from assurspark.plans import production

    links = production.group_links(tables)
    assert links.count() > 0
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "subquery" in plan.lower()
    twice = tables.with_overrides({"par_t_cis_vztah": tables.par_t_cis_vztah.union(tables.par_t_cis_vztah)})
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        production.group_links(twice).count()
    none = tables.with_overrides({"par_t_cis_vztah": tables.par_t_cis_vztah.where("vztah_kod <> 'RZML'")})
    assert production.group_links(none).count() == 0
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        production.member_policies(tables.with_overrides(
            {"par_d_cl_relation": tables.par_d_cl_relation.union(tables.par_d_cl_relation)})).count()


def test_apply_function_inner_outer_and_top_one(spark):
    # the function's table has columns of the left row's names: they must not be read for it
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "c")], "k int, v string")
    table = spark.createDataFrame([(1, "x", 5), (1, "y", 7), (2, "z", None), (None, "n", 1)], "k int, v string, rank int")

    def of(key):
        return table.where(F.col("k") == key).select(F.col("v").alias("found"))

    def best(key):
        return table.where(F.col("k") == key).orderBy(F.desc_nulls_last("rank")).limit(1).select(F.col("v").alias("found"))

    def got(df):
        return sorted((tuple(r) for r in df.collect()), key=str)
    assert got(J.apply_function(left, of, ["k"])) == sorted(
        [(1, "a", "x"), (1, "a", "y"), (2, "b", "z"), (3, None, None), (None, "c", None)], key=str)
    assert got(J.apply_function(left, of, ["k"], outer=False)) == [(1, "a", "x"), (1, "a", "y"), (2, "b", "z")]
    top = J.apply_function(left, best, [F.col("k") + 0])
    assert got(top) == sorted([(1, "a", "y"), (2, "b", "z"), (3, None, None), (None, "c", None)], key=str)
    p = top._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_code_join_under_a_collation(spark):
    a = spark.createDataFrame([("usd",), ("Usd  ",), ("USD",), (" usd",), ("",), (None,)], "c string")
    b = spark.createDataFrame([("USD", 1), ("eur", 2), (None, 3)], "k string, r int")
    binary = a.join(b, E.same_code(F.col("c"), F.col("k")), "left")
    collated = a.join(b, E.same_code(F.col("c"), F.col("k"), ci=True), "left")
    assert {r["c"]: r["r"] for r in binary.collect()} == {"usd": None, "Usd  ": None, "USD": 1, " usd": None, "": None, None: None}
    assert {r["c"]: r["r"] for r in collated.collect()} == {"usd": 1, "Usd  ": 1, "USD": 1, " usd": None, "": None, None: None}
