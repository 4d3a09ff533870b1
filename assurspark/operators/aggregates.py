"""Aggregation operators: top-1 per key, conditional pivots, span aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   values: list[str] | None = None) -> DataFrame:
    """W-01 / P-05 / U-02: the row with the greatest ``order`` tuple per key.

    Equivalent to ``row_number() OVER (PARTITION BY keys ORDER BY order DESC
    NULLS LAST) = 1`` with the later ``order`` columns as tie-breakers, but
    computed as ``max(struct(order..., values...))``: a hash aggregate with a
    map-side partial step, so a key holding a large share of the rows is
    reduced before the shuffle instead of being sorted in one task.  NULLs
    sort lowest in a struct, which matches DESC NULLS LAST; rows tied on all
    ``order`` columns are resolved by the ``values`` columns, so the result is
    deterministic."""
    values = [c for c in (values or []) if c not in order]
    packed = F.struct(*[F.col(c) for c in order + values])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_top"))
    return agg.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in order + values])


def value_sets(df: DataFrame, key: str, sets: dict[str, tuple[list[str], Column | None]]) -> DataFrame:
    """A-10: per key, the distinct value tuples of each named set of columns, as arrays
    of structs.  ``sets``: name -> (columns, condition on the rows that count, or None).

    One partially aggregated pass on the key.  A report that shows a key and joins its
    details under DISTINCT joins these sets instead: what a row shows is then
    distinct by construction, and nothing wide is shuffled to make it so."""
    def members(columns: list[str], condition: Column | None) -> Column:
        packed = F.struct(*columns)
        return F.collect_set(packed if condition is None else F.when(condition, packed))
    return df.groupBy(key).agg(*[members(*v).alias(name) for name, v in sets.items()])


def span_per_key(df: DataFrame, keys: list[str], maxes: dict[str, str],
                 mins: dict[str, str]) -> DataFrame:
    """P-06 / A-02: independent max and min columns per key."""
    aggs = [F.max(c).alias(a) for a, c in maxes.items()] + \
           [F.min(c).alias(a) for a, c in mins.items()]
    return df.groupBy(*keys).agg(*aggs)


def max_when(pattern_col: str | Column, pattern: str, value: Column, default: Column) -> Column:
    """A-08: ``MAX(CASE WHEN code LIKE pattern THEN value ELSE default END)``."""
    c = F.col(pattern_col) if isinstance(pattern_col, str) else pattern_col
    return F.max(F.when(c.like(pattern), value).otherwise(default))


def sum_when_null(value: Column, flag_col: Column, when_null: bool) -> Column:
    """A-07: ``SUM(value * CASE WHEN flag IS NULL THEN 1 ELSE 0 END)`` (or the reverse)."""
    ind = F.when(flag_col.isNull(), F.lit(1 if when_null else 0)).otherwise(F.lit(0 if when_null else 1))
    return F.sum(value * ind)


def sums_nulls_as_zero(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """A-01: grouped sums with NULL -> 0 applied to each input value first."""
    return df.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures])
