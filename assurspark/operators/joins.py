"""Join operators the reports need beyond a plain ``DataFrame.join``.

No side gets a broadcast hint: the byte threshold of the session and AQE decide
from measured sizes.  The one exception is the hot-key list of ``salted_join``,
whose size is bounded by its definition.  Keys that hold a large share of a big
side are split by ``salted_join``; AQE's skew-join split covers the remaining
shuffled joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def or_equi_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_key: str,
                 how: str = "inner", key_alias: str = "_or_key") -> DataFrame:
    """J-07: ``left JOIN right ON right.k = left.a OR right.k = left.b`` without a
    nested loop.

    The candidate keys of each left row are collected into one array (NULLs
    dropped, duplicates removed so a row matching through both keys is emitted
    once, like the OR join), exploded, and joined on equality: a hash or
    sort-merge join on ``right_key``.  ``how`` may be ``inner`` or ``left``; for
    ``left`` the rows none of whose keys match (found by one anti join per key)
    are added once, padded with NULLs."""
    if how not in ("inner", "left"):
        raise ValueError("or_equi_join supports inner and left")
    cands = F.array_distinct(F.filter(F.array(*[F.col(k) for k in left_keys]),
                                      lambda x: x.isNotNull()))
    exploded = left.withColumn(key_alias, F.explode(cands))
    matched = exploded.join(right, F.col(key_alias) == right[right_key], "inner").drop(key_alias)
    if how == "inner":
        return matched
    keys = right.select(F.col(right_key).alias(key_alias))
    unmatched = left
    for k in left_keys:
        unmatched = unmatched.join(keys, unmatched[k] == keys[key_alias], "left_anti")
    pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select(*left.columns, *pad))


# Skew handling: a key with at least HOT_ROWS rows on the large side is split
# into ceil(rows / ROWS_PER_SPLIT) salted sub-keys (settable per session with
# the confs below).
HOT_ROWS = 1_000_000
ROWS_PER_SPLIT = 250_000
HOT_ROWS_CONF = "assurspark.skew.hotRows"
ROWS_PER_SPLIT_CONF = "assurspark.skew.rowsPerSplit"


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
                hot_rows: int | None = None, rows_per_split: int | None = None,
                extra: Column | None = None, hot_source: DataFrame | None = None,
                hot_key: str | None = None) -> DataFrame:
    """``big JOIN small ON big_key = small_key`` that splits hot keys.

    A key holding a large share of ``big`` (a group policy with a third of the
    claims) would put all its rows into one task.  The row count per key is
    computed with a partial aggregate; keys with at least ``hot_rows`` rows
    get ``ceil(n / rows_per_split)`` salts.  Their rows on the big side get a
    salt from a hash of the row, the matching rows of the small side are
    replicated once per salt, and one equi join on (key, salt) follows -- so a
    hot key is spread over many tasks and every match is still produced once.
    The hot-key list is bounded by ``rows(big) / hot_rows`` entries, which is
    what makes its broadcast safe.  ``how``: ``inner`` or ``left``;
    ``extra``: an additional (e.g. range) condition over columns of both sides.
    ``hot_source`` / ``hot_key``: count the keys on this frame instead of on
    ``big`` -- a narrow superset of ``big``'s rows (e.g. the window's rows of
    the base table), so the big side is not computed twice; a key hot in
    ``big`` is hot in any superset, a key hot only in the superset is salted
    needlessly but still joined exactly.
    A negative ``assurspark.skew.hotRows`` switches the salting off."""
    conf = big.sparkSession.conf
    hot_rows = hot_rows or int(conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))
    rows_per_split = rows_per_split or int(conf.get(ROWS_PER_SPLIT_CONF, str(ROWS_PER_SPLIT)))
    if hot_rows < 0:                     # salting switched off: plain equi join
        cond = big[big_key] == small[small_key]
        return big.join(small, cond if extra is None else cond & extra, how)
    src = big if hot_source is None else hot_source
    hot = (src.groupBy(F.col(hot_key or big_key).alias("_hot_k")).agg(F.count(F.lit(1)).alias("_hot_n"))
           .where(F.col("_hot_n") >= hot_rows)
           .select("_hot_k", F.ceil(F.col("_hot_n") / rows_per_split).cast("int").alias("_hot_s")))
    hot = F.broadcast(hot)
    b = big.join(hot, big[big_key] == hot["_hot_k"], "left")
    b = b.withColumn("_salt", F.when(F.col("_hot_s").isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.col("_hot_s"))))
    b = b.drop("_hot_k", "_hot_s")
    hot2 = hot.select(F.col("_hot_k").alias("_hot_k2"), F.col("_hot_s").alias("_hot_s2"))
    s = small.join(hot2, small[small_key] == hot2["_hot_k2"], "left")
    s = s.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_hot_s2"), F.lit(1)) - 1)))
    s = s.drop("_hot_k2", "_hot_s2")
    cond = (b[big_key] == s[small_key]) & (b["_salt"] == s["_salt2"])
    out = b.join(s, cond if extra is None else cond & extra, how)
    return out.drop("_salt", "_salt2")


def _month(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def interval_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]],
                  point: str | Column, start: str, end: str, how: str = "inner",
                  inclusive_end: bool = True, bucket_months: int | None = 36) -> DataFrame:
    """J-08: equi keys plus ``start <= point <= end`` (or ``< end``).

    Boundary overlaps (one version ending the day the next starts) match both
    and duplicate rows, as the reference's BETWEEN does.

    With the range as a plain residual, a key holding many intervals (a hot
    policy with thousands of versions) compares every fact of the key with
    every interval.  Here the intervals are gathered instead, one row per key, and
    every interval is shuffled once, whatever it spans: a fact searches its key's
    intervals in the row, of a key with many only those that touch its month.
    The facts are read and shuffled once, and unmatched ones need not be added.
    ``bucket_months``: calendar months an interval may span and still be found by
    month; the few long or open-ended ones are candidates of every fact of the key.
    ``bucket_months=None`` uses the plain equi + range join."""
    p = F.col(point) if isinstance(point, str) else point
    if how not in ("inner", "left"):
        raise ValueError("interval_join supports inner and left")
    if bucket_months is not None:
        return _gathered_interval_join(left, right, keys, p, start, end, how, inclusive_end, bucket_months)
    upper = (p <= right[end]) if inclusive_end else (p < right[end])
    cond = None
    for lk, rk in keys:
        e = left[lk] == right[rk]
        cond = e if cond is None else cond & e
    return left.join(right, cond & (p >= right[start]) & upper, how)


# intervals of a key that a fact searches without looking at its month
FEW_INTERVALS = 64


def _by_month(intervals: Column, start: str, end: str) -> Column:
    """Month -> those of the intervals that touch it."""
    months = F.array_distinct(F.flatten(F.transform(intervals, lambda v: F.sequence(_month(v[start]), _month(v[end])))))
    return F.map_from_entries(F.transform(months, lambda m: F.struct(
        m.alias("month"), F.filter(intervals, lambda v: (_month(v[start]) <= m) & (m <= _month(v[end]))).alias("touching"))))


def _gathered_interval_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], p: Column,
                            start: str, end: str, how: str, inclusive_end: bool, bucket_months: int) -> DataFrame:
    """``interval_join`` over intervals gathered per key: those of at most
    ``bucket_months`` months in one row, the long ones in another.  Both sides of
    that are unique and dealt by the key alone, so two left equi joins, for which the
    facts move once, give every fact its candidates; those that hold the point are
    searched in the row.  A fact without any is dropped, or kept once with NULLs
    (``left``).  The intervals are grouped by month inside the row, after the shuffle,
    and only for keys with more than ``FEW_INTERVALS``.

    A row holds one key's intervals: the versions of one contract, which lie
    behind one another.  Intervals without a key or a bound, or that end before they
    start, match nothing."""
    month_span = _month(F.col(end)) - _month(F.col(start))
    names = [f"_iv_k{i}" for i in range(len(keys))]
    usable = F.col(start) <= F.col(end)
    for _, rk in keys:
        usable = usable & F.col(rk).isNotNull()
    held = right.where(usable).select(
        *[F.col(rk).alias(n) for (_, rk), n in zip(keys, names)],
        (month_span <= bucket_months).alias("_iv_short"), F.struct(*[F.col(c) for c in right.columns]).alias("_iv"))
    many = F.size("_iv_all") > FEW_INTERVALS
    short = (held.where("_iv_short").groupBy(*names).agg(F.collect_list("_iv").alias("_iv_all"))
             .select(*names, F.when(~many, F.col("_iv_all")).alias("_iv_few"),
                     F.when(many, _by_month(F.col("_iv_all"), start, end)).alias("_iv_months")))
    long = held.where(~F.col("_iv_short")).groupBy(*names).agg(F.collect_list("_iv").alias("_iv_long"))
    probe = left.withColumn("_iv_p", p)
    if how == "inner":
        for lk, _ in keys:
            probe = probe.where(left[lk].isNotNull())
    for side in (short, long):
        cond = None
        for (lk, _), n in zip(keys, names):
            e = probe[lk] == side[n]
            cond = e if cond is None else cond & e
        probe = probe.join(side, cond, "left").drop(*[side[n] for n in names])
    none = F.array().cast(long.schema["_iv_long"].dataType)
    at = F.col("_iv_p")
    candidates = F.concat(F.coalesce("_iv_few", none), F.coalesce(F.col("_iv_months")[_month(at)], none), F.coalesce("_iv_long", none))
    hits = F.filter(candidates, lambda v: (v[start] <= at) & ((at <= v[end]) if inclusive_end else (at < v[end])))
    found = (F.explode if how == "inner" else F.explode_outer)(hits)
    return probe.select(*[probe[c] for c in left.columns], found.alias("_iv_hit")).select(
        *left.columns, *[F.col("_iv_hit")[c].alias(c) for c in right.columns])


# parts that the rows without a key are dealt to
NULL_SPLITS = 1024


def left_join_present(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]],
                      spread: list[str] | None = None, splits: int = NULL_SPLITS) -> DataFrame:
    """J-02 / J-05: ``left LEFT JOIN right`` on equal keys, where many left rows have no key.

    A left join would send all rows with a NULL key to one task.  Here the join
    has one more equi key: 0 for rows with a key and on the right, a hash of the
    row for rows without, which match nothing in either form.  So these rows
    are dealt to ``splits`` parts and every other row keeps its partition.
    ``spread``: left columns that tell such rows apart (default: all).  The
    right's 0 is computed from its key, or Catalyst would fold the condition into
    a filter of the left side."""
    some_null = None
    for lk, _ in keys:
        is_null = left[lk].isNull()
        some_null = is_null if some_null is None else some_null | is_null
    deal = F.pmod(F.xxhash64(*[left[c] for c in spread or left.columns]), F.lit(splits)) + 1
    probe = left.withColumn("_np_part", F.when(some_null, deal).otherwise(F.lit(0)))
    found = right.withColumn("_np_zero", F.pmod(F.xxhash64(*[right[rk] for _, rk in keys]), F.lit(1)))
    cond = probe["_np_part"] == found["_np_zero"]
    for lk, rk in keys:
        cond = cond & (probe[lk] == found[rk])
    return probe.join(found, cond, "left").drop("_np_part", "_np_zero")


def apply_function(left: DataFrame, function: Callable[..., DataFrame], args: list[str | Column],
                   outer: bool = True) -> DataFrame:
    """J-12 / G-02: ``left OUTER APPLY function(args)`` (``outer=False``: CROSS APPLY).

    ``function`` is a caller's table function: it gets one column per argument, each
    the value of the current left row, and returns a frame over any tables.  A lateral
    join, which Catalyst turns into one equi join (with a window where the function
    orders and limits its rows); nothing is called per row.

    The arguments go by names of their own: a name that a table inside the function
    has too, even one it has dropped, would be read from there."""
    names = [f"_apply_{i}" for i in range(len(args))]
    probe = left.select("*", *[(F.col(a) if isinstance(a, str) else a).alias(n) for a, n in zip(args, names)])
    rows = function(*[F.col(n).outer() for n in names])
    return probe.lateralJoin(rows, how="left" if outer else "inner").drop(*names)


def null_aware_anti(left: DataFrame, left_key: str, values: DataFrame, value_col: str,
                    null_safe: bool = False) -> DataFrame:
    """F-29: ``left_key NOT IN (SELECT value_col FROM values)``.

    SQL semantics: one NULL among the values makes the predicate unknown for
    every row (empty result); a NULL ``left_key`` is dropped unless the list is
    empty.  Built as a left-anti equi join (shuffle or broadcast, planner's
    choice -- the list is not assumed small) plus a guard: one aggregate over
    the list (a scalar subquery Spark evaluates once, partial aggregation
    first) tells whether it holds a NULL and whether it is empty.
    ``null_safe=True`` gives NOT EXISTS semantics instead (NULLs in the list
    are ignored)."""
    vals = values.select(F.col(value_col).alias("_nin_v"))
    out = left.join(vals, left[left_key] == F.col("_nin_v"), "left_anti")
    if null_safe:
        return out
    stats = vals.agg(F.struct((F.count(F.lit(1)) - F.count("_nin_v")).alias("nulls"),
                              F.count(F.lit(1)).alias("rows"))).scalar()
    return out.where((stats["nulls"] == 0) & (F.col(left_key).isNotNull() | (stats["rows"] == 0)))


def single_value(rows: DataFrame, column: str) -> Column:
    """F-31: ``(SELECT column FROM rows)`` as a value.  Spark runs it once, before the
    rows that are compared with it are read; two rows fail the query, as in SQL,
    and none give NULL, which equals nothing."""
    return rows.select(column).scalar()


def semi(left: DataFrame, right: DataFrame, on: Column | str | list, ) -> DataFrame:
    """J-10 / F-30: existence filter (``left_semi``) -- used where the reference joins
    a table only to require a match and the right key is the table's key."""
    return left.join(right, on, "left_semi")
