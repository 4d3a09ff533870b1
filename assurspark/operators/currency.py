"""Exchange rates: latest rate per currency (P-04) and rate-at-date lookups (F-01, J-09).

Rates are home-currency units per foreign unit.  The rate table is a
dimension bounded by (#currencies x #rate dates); while it is under the byte
threshold Spark broadcasts it and the facts keep their partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# fixed values: currency ids of the home currency and of the reporting
# currency used by the production report's "...GHS" columns
HOME_CCY_ID = 43
GHS_CCY_ID = 49

AMOUNT, RATE, CONVERTED = T.DecimalType(22, 4), T.DecimalType(15, 8), T.DecimalType(38, 6)


def latest_rates(exchange: DataFrame, currencies: DataFrame) -> DataFrame:
    """P-04: rate rows whose effective date is the greatest of their currency
    (ties on that date are all kept), joined to the currency code list.

    -> ccurr_ccurr_id, kod, xRate, effective_date.  The correlated
    ``max(effective_date)`` is an aggregate joined back on (currency, date)."""
    last = (exchange.groupBy("ccurr_ccurr_id")
            .agg(F.max("effective_date").alias("_last")))
    rows = exchange.join(last, (exchange.ccurr_ccurr_id == last.ccurr_ccurr_id)
                         & (exchange.effective_date == last._last), "left_semi")
    codes = currencies.select(F.col("cmenak_id"), F.col("kod"))
    return (rows.join(codes, rows.ccurr_ccurr_id == codes.cmenak_id, "inner")
            .select("ccurr_ccurr_id", "kod", F.col("foreign_exchange_middle").alias("xRate"),
                    "effective_date"))


def _month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def rate_intervals(exchange: DataFrame) -> DataFrame:
    """Rates as half-open validity intervals ``[valid_from, valid_to)`` per currency
    (``valid_to`` NULL on the latest rate).  Of several rates of a currency on
    one date the greatest counts.

    The window is partitioned by currency, so one task holds one currency's
    rate history: bounded by the calendar (a rate a day is ~365 rows a year),
    not by the facts being converted, which never pass through this window."""
    w = Window.partitionBy("r_ccy").orderBy("r_from")
    days = (exchange.where(F.col("ccurr_ccurr_id").isNotNull() & F.col("effective_date").isNotNull())
            .groupBy(F.col("ccurr_ccurr_id").alias("r_ccy"), F.col("effective_date").alias("r_from"))
            .agg(F.max("foreign_exchange_middle").alias("r_rate")))
    return days.select("r_ccy", "r_from", F.lead("r_from").over(w).alias("r_to"), "r_rate")


class RateTable:
    """Rate-at-date lookup structure built once per report.

    Closed intervals are exploded over the calendar months they touch, so the
    equi key (currency, month) narrows each probe to about one month of rate
    rows; the open-ended latest rate of each currency is a second,
    one-row-per-currency lookup.

    ``owner``: rates of one system owner only, where the rate list has an
    ``OWNER_COLUMN``; without the column all rates belong to one owner."""

    OWNER_COLUMN = "sysown_sysown_id"

    def __init__(self, exchange: DataFrame, home_ccy: int = HOME_CCY_ID, owner: int | None = None):
        if owner is not None and self.OWNER_COLUMN in exchange.columns:
            exchange = exchange.where(F.col(self.OWNER_COLUMN) == F.lit(owner))
        self.intervals = rate_intervals(exchange)
        self.home_ccy = home_ccy
        self.closed = self.intervals.where(F.col("r_to").isNotNull()).withColumn(
            "r_month", F.explode(F.sequence(_month_index(F.col("r_from")), _month_index(F.col("r_to")))))
        self.open = self.intervals.where(F.col("r_to").isNull()).select("r_ccy", "r_from", "r_rate")

    def with_rate(self, df: DataFrame, ccy: str | Column, at: str | Column, out: str) -> DataFrame:
        """Add column ``out`` = rate of currency ``ccy`` valid at ``at`` (greatest
        effective date <= at); 1 for the home currency; NULL if none."""
        if isinstance(ccy, int):
            return self._with_rate_of(df, ccy, at, out)
        ccy_c = F.col(ccy) if isinstance(ccy, str) else ccy
        at_c = F.col(at) if isinstance(at, str) else at
        at_ts = at_c.cast(T.TimestampNTZType())
        base = df.withColumn("_rk_ccy", ccy_c).withColumn("_rk_at", at_ts) \
                 .withColumn("_rk_m", _month_index(F.col("_rk_at")))
        c = self.closed.select(F.col("r_ccy").alias("_c_ccy"), F.col("r_month").alias("_c_m"),
                               F.col("r_from").alias("_c_from"), F.col("r_to").alias("_c_to"),
                               F.col("r_rate").alias("_c_rate"))
        j = base.join(c, (F.col("_rk_ccy") == F.col("_c_ccy")) & (F.col("_rk_m") == F.col("_c_m"))
                      & (F.col("_rk_at") >= F.col("_c_from")) & (F.col("_rk_at") < F.col("_c_to")), "left")
        o = self.open.select(F.col("r_ccy").alias("_o_ccy"), F.col("r_from").alias("_o_from"),
                             F.col("r_rate").alias("_o_rate"))
        j = j.join(o, (F.col("_rk_ccy") == F.col("_o_ccy")) & (F.col("_rk_at") >= F.col("_o_from")), "left")
        rate = (F.when(F.col("_rk_ccy") == F.lit(self.home_ccy), F.lit(1).cast("decimal(19,8)"))
                .otherwise(F.coalesce(F.col("_c_rate"), F.col("_o_rate"))))
        return (j.withColumn(out, rate)
                .drop("_rk_ccy", "_rk_at", "_rk_m", "_c_ccy", "_c_m", "_c_from", "_c_to", "_c_rate",
                      "_o_ccy", "_o_from", "_o_rate"))

    def _with_rate_of(self, df: DataFrame, ccy: int, at: str | Column, out: str) -> DataFrame:
        """Rate of one fixed currency, without a join: its rate history (a row per
        rate date, bounded by the calendar) is one scalar subquery, an array per
        month, so the facts keep their partitioning whatever their months."""
        if ccy == self.home_ccy:
            return df.withColumn(out, F.lit(1).cast("decimal(19,8)"))
        at_c = (F.col(at) if isinstance(at, str) else at).cast(T.TimestampNTZType())
        one = self.intervals.where(F.col("r_ccy") == F.lit(ccy))
        entry = F.struct(F.col("r_from").alias("start"), F.col("r_to").alias("end"), F.col("r_rate").alias("rate"))
        months = (self.closed.where(F.col("r_ccy") == F.lit(ccy)).groupBy("r_month").agg(F.collect_list(entry).alias("e")))
        by_month = months.agg(F.map_from_entries(F.collect_list(F.struct("r_month", "e")))).scalar()
        last = (one.where(F.col("r_to").isNull())
                .agg(F.max(F.struct(F.col("r_from").alias("start"), F.col("r_rate").alias("rate")))).scalar())
        # columns of their own: a higher-order function may not hold a subquery
        j = df.withColumn("_rk_days", by_month[_month_index(at_c)]).withColumn("_rk_last", last)
        hits = F.filter("_rk_days", lambda x: (x["start"] <= at_c) & (at_c < x["end"]))
        rate = F.coalesce(F.get(hits, F.lit(0))["rate"],
                          F.when(at_c >= F.col("_rk_last.start"), F.col("_rk_last.rate")))
        return j.withColumn(out, rate).drop("_rk_days", "_rk_last")


def converted(amount: str | Column, from_ccy: str | Column, to_ccy: str | Column | int,
              rate_from: str | Column, rate_to: str | Column) -> Column:
    """F-01 / G-01: ``amount`` in currency ``from_ccy`` expressed in ``to_ccy``:
    unchanged when the currencies are equal, else ``amount * rate_from / rate_to``
    (NULL if a rate is missing), as DECIMAL(38,6).

    Computed in decimals: amounts of DECIMAL(22,4) (below 10^18) and rates of
    DECIMAL(15,8) (below 10^7) have an exact product of 38 digits; the quotient is
    rounded once, half up, at the sixth decimal.  Larger amounts or rates
    raise an overflow error in ANSI mode."""
    def c(x):
        return F.col(x) if isinstance(x, str) else (F.lit(x) if isinstance(x, int) else x)
    a = c(amount).cast(AMOUNT)
    val = a * c(rate_from).cast(RATE) / c(rate_to).cast(RATE)
    return (F.when(c(from_ccy) == c(to_ccy), a.cast(CONVERTED)).otherwise(val.cast(CONVERTED)))
