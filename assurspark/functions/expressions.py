"""Column expressions shared by the reports (all built-in, codegen-friendly).

Each helper returns a ``Column`` (or ``None`` meaning "no predicate"), so the
optional parameters of a report are resolved in Python and never reach the
plan as tautologies.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: date sentinels used by the reports
LOW_DATE = _dt.date(1900, 1, 1)
HIGH_DATE = _dt.date(9999, 12, 31)
HIGH_DATE_MINUS_ONE = _dt.date(9999, 12, 30)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(v: _dt.datetime | _dt.date | None) -> Column:
    """Timestamp (without zone) literal; dates become midnight."""
    if v is None:
        return F.lit(None).cast(T.TimestampNTZType())
    if not isinstance(v, _dt.datetime):
        v = _dt.datetime(v.year, v.month, v.day)
    return F.lit(v).cast(T.TimestampNTZType())


def typed_null(dtype: T.DataType | str) -> Column:
    """F-05: a NULL with a declared type (a bare NULL would be ``void``)."""
    return F.lit(None).cast(dtype)


CODE_COLLATION = "UTF8_LCASE_RTRIM"


# ------------------------------------------------------------------ filters
def current(df: DataFrame, flag: str = "valid") -> DataFrame:
    """F-06: soft-delete filter, rows whose 1/0 validity flag is 1."""
    return df.where(F.col(flag) == 1)


def localised(df: DataFrame, culture_id: int, column: str = "culture_id") -> DataFrame:
    """F-07: rows of one culture of a localised code list or view."""
    return df.where(F.col(column) == F.lit(culture_id))


def code(c: Column, ci: bool = False) -> Column:
    """A code as compared by the reports: as is (binary, Spark's default), or --
    ``ci`` -- upper-cased with trailing blanks removed, the comparison a
    case- and trailing-blank-insensitive database collation makes."""
    return F.upper(F.rtrim(c)) if ci else c


def same_code(a: Column, b: Column, ci: bool = False) -> Column:
    """A join on two code columns: binary, or -- ``ci`` -- under Spark's collation without
    case and trailing blanks, which joins by hash of the collation key."""
    return F.collate(a, CODE_COLLATION) == F.collate(b, CODE_COLLATION) if ci else a == b


def code_eq(c: str | Column, p: str, ci: bool = False) -> Column:
    """F-11: code column equals a parameter (binary or ``ci``)."""
    return code(col(c), ci) == code(F.lit(p), ci)


def optional_eq(c: str | Column, p: str | None, ci: bool = False) -> Column | None:
    """F-08: ``coalesce(p, c, '') = coalesce(c, '')`` -- null parameter = any row
    (a NULL column also passes); a set parameter matches ``coalesce(c, '')``."""
    if p is None:
        return None
    return code(F.coalesce(col(c), F.lit("")), ci) == code(F.lit(p), ci)


def optional_nonempty_eq(c: str | Column, p, ci: bool = False) -> Column | None:
    """F-09 / F-10: null (or, for strings, empty) parameter = any row; else equality."""
    if p is None or (isinstance(p, str) and p == ""):
        return None
    if isinstance(p, str):
        return code(col(c), ci) == code(F.lit(p), ci)
    return col(c) == F.lit(p)


def _check_like(p: str) -> str:
    # T-SQL LIKE has [...] classes and no default escape; Spark has neither
    # classes nor the same escape, so such patterns are refused, not guessed.
    if "[" in p or "\\" in p:
        raise ValueError(f"LIKE pattern {p!r}: character classes and backslashes are not supported")
    return p


def product_pattern(c: str | Column, p: str | None, ci: bool = False) -> Column | None:
    """F-13: ``c LIKE coalesce(p, c) OR p = ''``.

    ``''`` = any row; ``None`` = every non-null code (what ``c LIKE c`` means);
    else a LIKE match where ``_`` and ``%`` are wildcards (``ci``: case-insensitive)."""
    if p == "":
        return None
    if p is None:
        return col(c).isNotNull()
    p = _check_like(p)
    return F.upper(col(c)).like(p.upper()) if ci else col(c).like(p)


def contains_pattern(c: str | Column, p: str | None, ci: bool = False) -> Column | None:
    """F-14: ``c LIKE '%' + p + '%'``; null/empty parameter = any row."""
    if p is None or p == "":
        return None
    p = "%" + _check_like(p) + "%"
    return F.upper(col(c)).like(p.upper()) if ci else col(c).like(p)


def like(c: str | Column, p: str) -> Column:
    """F-15 / F-16: LIKE with a fixed pattern (``_`` stays a one-character wildcard)."""
    return col(c).like(_check_like(p))


def all_of(*preds: Column | None) -> Column | None:
    out = None
    for p in preds:
        if p is not None:
            out = p if out is None else (out & p)
    return out


def where_all(df: DataFrame, *preds: Column | None) -> DataFrame:
    p = all_of(*preds)
    return df if p is None else df.where(p)


def between_or_fallback(c: str | Column, lo, hi, fallback: str | Column) -> Column:
    """F-18: ``c >= coalesce(lo, fallback) AND c <= coalesce(hi, fallback)`` (inclusive;
    a missing bound falls back to another column of the row, not to 'unbounded')."""
    lo_c = ts_lit(lo) if lo is not None else col(fallback)
    hi_c = ts_lit(hi) if hi is not None else col(fallback)
    return (col(c) >= lo_c) & (col(c) <= hi_c)


def half_open_days(c: str | Column, lo, hi, open_end: bool = False) -> Column:
    """F-19: ``c >= coalesce(lo, c) AND c < coalesce(hi + 1 day, c)``.

    With ``hi`` None the reference test is ``c < c`` (never true); ``open_end``
    drops the upper bound instead."""
    lo_c = ts_lit(lo) if lo is not None else col(c)
    lower = col(c) >= lo_c
    if hi is None:
        return lower if open_end else (lower & (col(c) < col(c)))
    return lower & (col(c) < plus_days(ts_lit(hi), 1))


def before_next_day(c: str | Column, as_at) -> Column:
    """F-20: ``c < as_at + 1 day`` (keeps the whole as-at day whatever the time part)."""
    return col(c) < plus_days(ts_lit(as_at), 1)


def open_at(status_code: str | Column, settled: str | Column, as_at,
            open_codes: tuple[str, ...]) -> Column:
    """F-21: a claim is open at ``as_at`` when its settlement (or, missing, the day
    after ``as_at``) is later than ``as_at``; claims whose status is not one of
    ``open_codes`` and that have no settlement date count as settled on 1900-01-01."""
    at = ts_lit(as_at)
    eff = (F.when(~col(status_code).isin(*open_codes) & col(settled).isNull(), ts_lit(LOW_DATE))
           .otherwise(F.coalesce(col(settled), plus_days(at, 1))))
    return eff > at


def in_period_flag(c: str | Column, lo, hi) -> Column:
    """F-23: 1 if the date part of ``c`` is in [lo or 1900-01-01, hi or 9999-12-31] else 0."""
    d = F.to_timestamp_ntz(F.to_date(col(c)))
    lo_c = ts_lit(lo if lo is not None else LOW_DATE)
    hi_c = ts_lit(hi if hi is not None else HIGH_DATE)
    return F.when(d.between(lo_c, hi_c), F.lit(1)).otherwise(F.lit(0))


def date_part_between(c: str | Column, lo, hi, hi_default=HIGH_DATE_MINUS_ONE,
                      extra_days: int = 0) -> Column:
    """F-22: ``CAST(c AS DATE) BETWEEN coalesce(lo, 1900-01-01) AND coalesce(hi, default) + n``."""
    d = F.to_timestamp_ntz(F.to_date(col(c)))
    lo_c = ts_lit(lo if lo is not None else LOW_DATE)
    hi_c = plus_days(ts_lit(hi if hi is not None else hi_default), extra_days)
    return d.between(lo_c, hi_c)


# --------------------------------------------------------------- scalars
def plus_days(c: str | Column, n: int | Column) -> Column:
    """E-04: timestamp + n days (keeps the time part and the NTZ type)."""
    n_c = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add("DAY", n_c, col(c))


def day_diff(end: str | Column, start: str | Column) -> Column:
    """E-02: number of day boundaries from ``start`` to ``end`` (T-SQL DATEDIFF(DAY, start, end))."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def date_only(c: str | Column) -> Column:
    """E-05: datetime -> date."""
    return F.to_date(col(c))


def year_month(c: str | Column) -> Column:
    """E-07: 'yyyyMM' of a datetime."""
    return F.date_format(col(c), "yyyyMM")


def class_of(product_code: str | Column) -> Column:
    """E-08: class code = first two characters of the product code."""
    return F.substring(col(product_code), 1, 2)


def person_name(first: str | Column, middle: str | Column, last: str | Column) -> Column:
    """E-10: ``first + ' ' + isnull(middle,'') + ' ' + isnull(last,'')``; NULL when the
    first part is NULL (``+`` propagates NULL; ``concat_ws`` would not)."""
    return F.concat(col(first), F.lit(" "), F.coalesce(col(middle), F.lit("")), F.lit(" "),
                    F.coalesce(col(last), F.lit("")))


def currency_of_amount(amount: str | Column, preferred: str | Column,
                       fallback: str | Column) -> Column:
    """E-25: currency of an amount, NULL when the amount is NULL."""
    return F.when(col(amount).isNotNull(), F.coalesce(col(preferred), col(fallback)))


def when_flag(flag: str | Column, on_true: Column, on_false: Column) -> Column:
    """E-18: pick by a 1/0 flag (``CASE WHEN flag = 1 THEN a ELSE b END``)."""
    return F.when(col(flag) == 1, on_true).otherwise(on_false)
