"""Property tests: every custom operator equals a brute-force model on random
inputs (NULLs, duplicates, ties and boundaries included)."""
import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assurspark.operators import aggregates as A
from assurspark.operators import currency as CU
from assurspark.operators import joins as J

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.integers(0, 6))
day0 = dt.datetime(2020, 1, 1)
days = st.integers(0, 400).map(lambda d: day0 + dt.timedelta(days=d))


@SETTINGS
@given(st.lists(st.tuples(keys, keys), max_size=25), st.lists(keys, max_size=10), st.sampled_from(["inner", "left"]))
def test_or_join_property(spark, left_rows, right_keys, how):
    left = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left_rows)], "id int, a long, b long")
    right = spark.createDataFrame([(j, k) for j, k in enumerate(right_keys)], "rid int, k long")
    got = sorted(tuple(r) for r in J.or_equi_join(left, right, ["a", "b"], "k", how).select("id", "rid").collect())
    exp = []
    for i, (a, b) in enumerate(left_rows):
        hits = [j for j, k in enumerate(right_keys) if k is not None and (k == a or k == b)]
        exp += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    assert got == sorted(exp, key=lambda x: (x[0], -1 if x[1] is None else x[1]))


@SETTINGS
@given(st.lists(keys, max_size=20), st.lists(keys, max_size=8), st.booleans())
def test_not_in_property(spark, left_keys, values, null_safe):
    left = spark.createDataFrame([(i, k) for i, k in enumerate(left_keys)], "id int, k long")
    vals = spark.createDataFrame([(v,) for v in values], "v long")
    got = sorted(r.id for r in J.null_aware_anti(left, "k", vals, "v", null_safe=null_safe).collect())
    if null_safe:
        exp = [i for i, k in enumerate(left_keys) if k is None or k not in values]
    elif not values:
        exp = list(range(len(left_keys)))
    elif None in values:
        exp = []
    else:
        exp = [i for i, k in enumerate(left_keys) if k is not None and k not in values]
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), days), st.one_of(st.none(), days)), max_size=25))
def test_latest_per_key_property(spark, rows):
    df = spark.createDataFrame(rows, "k int, r timestamp_ntz, c timestamp_ntz")
    got = {r.k: (r.r, r.c) for r in A.latest_per_key(df, ["k"], ["r", "c"]).collect()}

    def rank(t):   # DESC NULLS LAST on r, then on c
        return (t[0] is not None, t[0] or day0, t[1] is not None, t[1] or day0)
    exp = {}
    for k, r, c in rows:
        if k not in exp or rank((r, c)) > rank(exp[k]):
            exp[k] = (r, c)
    assert got == exp


intervals = st.lists(st.tuples(st.integers(0, 3), days, st.integers(0, 900), st.booleans()), max_size=12)


@SETTINGS
@given(intervals, st.lists(st.tuples(st.integers(0, 4), days), max_size=20), st.booleans(), st.integers(1, 6))
def test_interval_join_property(spark, ivs, facts, inclusive, bucket):
    v = spark.createDataFrame(
        [(j, k, s, None if open_ else s + dt.timedelta(days=n)) for j, (k, s, n, open_) in enumerate(ivs)],
        "vid int, vk long, f timestamp_ntz, t timestamp_ntz")
    f = spark.createDataFrame([(i, k, at) for i, (k, at) in enumerate(facts)], "id int, fk long, at timestamp_ntz")
    got = sorted(tuple(r) for r in J.interval_join(f, v, [("fk", "vk")], "at", "f", "t", "inner", inclusive,
                                                   bucket_months=bucket).select("id", "vid").collect())
    exp = []
    for i, (k, at) in enumerate(facts):
        for j, (vk, s, n, open_) in enumerate(ivs):
            end = None if open_ else s + dt.timedelta(days=n)
            if vk == k and end is not None and s <= at and (at <= end if inclusive else at < end):
                exp.append((i, j))
    assert got == sorted(exp)


@SETTINGS
@given(intervals, st.lists(st.tuples(st.sampled_from([0, 1, 2, 3, 4, None]), st.one_of(days, st.none())), max_size=20), st.booleans(),
       st.integers(0, 6))
def test_left_interval_join_property(spark, ivs, facts, inclusive, bucket):
    """Every fact once per interval that holds its point, or once with NULLs."""
    v = spark.createDataFrame(
        [(j, k, s, None if open_ else s + dt.timedelta(days=n)) for j, (k, s, n, open_) in enumerate(ivs)],
        "vid int, vk long, f timestamp_ntz, t timestamp_ntz")
    f = spark.createDataFrame([(i, k, at) for i, (k, at) in enumerate(facts)], "id int, fk long, at timestamp_ntz")
    out = J.interval_join(f, v, [("fk", "vk")], "at", "f", "t", "left", inclusive, bucket_months=bucket)
    assert out.columns == ["id", "fk", "at", "vid", "vk", "f", "t"]
    plain = J.interval_join(f, v, [("fk", "vk")], "at", "f", "t", "left", inclusive, bucket_months=None)
    got, want = (sorted(map(tuple, x.collect()), key=str) for x in (out, plain))
    assert got == want
    exp = []
    for i, (k, at) in enumerate(facts):
        hits = [j for j, (vk, s, n, open_) in enumerate(ivs) if vk == k and at is not None and not open_ and s <= at
                and (at <= s + dt.timedelta(days=n) if inclusive else at < s + dt.timedelta(days=n))]
        exp += [(i, j) for j in hits or [None]]
    assert sorted(((r[0], r[3]) for r in got), key=str) == sorted(exp, key=str)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([0, 1, 2, None]), st.sampled_from([0, 1, None])), max_size=30),
       st.lists(st.tuples(st.sampled_from([0, 1, None]), st.sampled_from([0, 1, None])), max_size=8), st.integers(1, 5))
def test_left_join_present_property(spark, lefts, rights, splits):
    a = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(lefts)], "id int, x long, y long")
    b = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rights)], "rid int, bx long, by long")
    for keys_ in ([("x", "bx")], [("x", "bx"), ("y", "by")]):
        got = J.left_join_present(a, b, keys_, splits=splits)
        cond = [a[l] == b[r] for l, r in keys_]
        want = a.join(b, cond, "left")
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


amounts = st.integers(-10 ** 19, 10 ** 19)          # ten-thousandths: up to 10^15
rate_units = st.integers(1, 10 ** 12)               # 10^-8: up to 10^4


@SETTINGS
@given(st.lists(st.tuples(amounts, rate_units, rate_units, st.booleans()), min_size=1, max_size=30))
def test_conversion_equals_decimal_arithmetic(spark, rows):
    with decimal.localcontext() as ctx:
        ctx.prec = 80
        data = [(i, decimal.Decimal(a).scaleb(-4), decimal.Decimal(f).scaleb(-8), decimal.Decimal(t).scaleb(-8), 43 if same else 41)
                for i, (a, f, t, same) in enumerate(rows)]
        df = spark.createDataFrame(data, "id int, a decimal(38,4), f decimal(19,8), t decimal(19,8), c long")
        got = {r["id"]: r["x"] for r in df.select("id", CU.converted("a", "c", 43, "f", "t").alias("x")).collect()}
        for i, a, f, t, c in data:
            exact = a if c == 43 else a * f / t
            assert got[i] == exact.quantize(decimal.Decimal("0.000001"), decimal.ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.integers(0, 5), max_size=60), st.lists(keys, max_size=8), st.integers(1, 10),
       st.integers(1, 4), st.sampled_from(["inner", "left"]))
def test_salted_join_property(spark, big_keys, small_keys, hot_rows, per_split, how):
    big = spark.createDataFrame([(i, k) for i, k in enumerate(big_keys)], "id int, k long")
    small = spark.createDataFrame([(j, k) for j, k in enumerate(small_keys)], "sid int, sk long")
    got = sorted(J.salted_join(big, small, "k", "sk", how, hot_rows=hot_rows, rows_per_split=per_split)
                 .select("id", "sid").collect(), key=lambda r: (r.id, -1 if r.sid is None else r.sid))
    ref = sorted(big.join(small, big.k == small.sk, how).select("id", "sid").collect(),
                 key=lambda r: (r.id, -1 if r.sid is None else r.sid))
    assert got == ref


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([41, 42]), days, st.integers(1, 999)), max_size=12),
       st.lists(st.tuples(st.sampled_from([41, 42, 43]), days), max_size=15))
def test_rate_at_date_property(spark, rates, facts):
    uniq = {}
    for c, d, r in rates:                 # one rate per (currency, date): ties are undefined
        uniq[(c, d)] = r
    ex = spark.createDataFrame([(c, d, decimal.Decimal(r) / 100) for (c, d), r in uniq.items()],
                               "ccurr_ccurr_id long, effective_date timestamp_ntz, "
                               "foreign_exchange_middle decimal(19,8)")
    df = spark.createDataFrame([(i, c, at) for i, (c, at) in enumerate(facts)], "id int, ccy long, at timestamp_ntz")
    rt = CU.RateTable(ex)
    got = {r.id: r.rate for r in rt.with_rate(df, "ccy", "at", "rate").collect()}
    for i, (c, at) in enumerate(facts):
        if c == CU.HOME_CCY_ID:
            exp = decimal.Decimal(1)
        else:
            cands = [(d, r) for (cc, d), r in uniq.items() if cc == c and d <= at]
            exp = decimal.Decimal(max(cands)[1]) / 100 if cands else None
        assert got[i] == exp, (c, at)


@SETTINGS
@given(st.lists(st.tuples(days, st.integers(1, 999)), max_size=12), st.lists(days, max_size=15))
def test_constant_currency_rate_equals_column_path(spark, rates, facts):
    uniq = {d: r for d, r in rates}
    ex = spark.createDataFrame([(49, d, decimal.Decimal(r) / 100) for d, r in uniq.items()],
                               "ccurr_ccurr_id long, effective_date timestamp_ntz, "
                               "foreign_exchange_middle decimal(19,8)")
    df = spark.createDataFrame([(i, 49, at) for i, at in enumerate(facts)], "id int, ccy long, at timestamp_ntz")
    rt = CU.RateTable(ex)
    by_col = {r.id: r.x for r in rt.with_rate(df, "ccy", "at", "x").collect()}
    by_const = {r.id: r.x for r in rt.with_rate(df, 49, "at", "x").collect()}
    assert by_col == by_const
