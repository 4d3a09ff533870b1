"""Storage layout of the logical tables: month partitions and co-located buckets.

*Month partitions.*  Reports that select a date window over a large fact table (claims
notified in a period, transactions created in a period) would otherwise read the
table's whole history.  Stored with a partition column holding the month (yyyyMM as
an int) of that date, the reports add the month predicate implied by their
window -- exact, since the month is a function of the date -- and Spark reads
only the partitions of the window (``PartitionFilters`` in the scan).
Tables without the column (e.g. the driver-derived frames) are unaffected.

*Buckets.*  The detail tables of a claim (reserves, letters, payouts, notes, ...) and of
a policy (booking, premium, partners, ...) are joined on one key by every claims
report.  Stored bucketed and sorted by that key, each is read in its join's partitioning: only
the claims of the report are shuffled, to the buckets, and no detail table moves (Spark
still sorts a bucket for a merge join, over rows that are in order already).  The tables of a key must have one number of buckets; choose it
so that a bucket of the largest table fits a task (``store_tables(buckets=...)``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# table -> (date column, partition column)
MONTH_PARTITIONED = {
    "clm_d_claim": ("notification_date", "notification_month"),
    "pay_t_transakcia": ("datum_vytvorenia", "created_month"),
}

# table -> key its rows are joined on
BUCKETED = {
    "clm_dx_reserve": "claim_id",
    "clm_dx_payout": "claim_id",
    "clm_dx_payout_ind": "claim_id",
    "clm_dx_ind_payout_details": "claim_root_id",
    "clm_dx_correspondence": "claim_id",
    "clm_dx_pay_payout": "claim_id",
    "clm_dx_pay_coinsurer": "claim_id",
    "clm_dx_ext_cost_by_role": "claim_id",
    "clm_dx_note": "claim_id",
    "rei_dx_clm_brdr_sum_recoverable": "claim_id",
    "clm_dx_policy": "policy_id",
    "pol_dx_policy_booking": "policy_id",
    "clm_dx_premium": "policy_policy_id",
    "clm_dx_policy_partner": "policy_id",
    "clm_dx_pay_premium": "policy_id",
    "clm_dx_policy_group": "policy_id",
    "inc_v_policy_history": "policy_id",
}
BUCKETS = 4096          # of a cluster's tables; a table of 1 TB has buckets of 256 MB


def month_key(c: Column) -> Column:
    """yyyyMM of a date/timestamp as an int."""
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _yyyymm(v: _dt.date) -> int:
    return v.year * 100 + v.month


def prune_months(df: DataFrame, table: str, lo: _dt.date | None, hi: _dt.date | None) -> DataFrame:
    """Add ``month BETWEEN month(lo) AND month(hi)`` when ``df`` carries the
    partition column of ``table``; ``lo`` / ``hi`` are the inclusive bounds of
    the date window the caller filters on (either may be None = open)."""
    spec = MONTH_PARTITIONED.get(table)
    if spec is None or spec[1] not in df.columns or (lo is None and hi is None):
        return df
    col = F.col(spec[1])
    pred = None
    if lo is not None:
        pred = col >= F.lit(_yyyymm(lo))
    if hi is not None:
        up = col <= F.lit(_yyyymm(hi))
        pred = up if pred is None else pred & up
    return df.where(pred)


def store(tables, names, root: str, mode: str = "overwrite") -> None:
    """Write logical tables as parquet under ``root/<name>``; the windowed fact
    tables are partitioned by month (one shuffle so each month is written by
    one task, i.e. few files per partition)."""
    for name in names:
        df = tables[name]
        path = f"{root.rstrip('/')}/{name}"
        spec = MONTH_PARTITIONED.get(name)
        if spec is None:
            df.write.mode(mode).parquet(path)
        else:
            date_col, part = spec
            (df.withColumn(part, month_key(F.col(date_col)))
             .repartition(part).write.mode(mode).partitionBy(part).parquet(path))


def store_tables(tables, names, database: str, root: str, buckets: int = BUCKETS) -> None:
    """Write logical tables below ``root`` as tables of ``database``: the tables of
    ``BUCKETED`` bucketed and sorted by their key (one file a bucket: a task of the
    shuffle writes one bucket), the others as ``store`` does."""
    for name in names:
        if name not in BUCKETED:
            store(tables, [name], root)
            continue
        key = BUCKETED[name]
        (tables[name].repartition(buckets, key).write.mode("overwrite").format("parquet")
         .option("path", _path(root, name)).bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}"))
    register_tables(tables.spark, [n for n in names if n not in BUCKETED], database, root, buckets)


def register_tables(spark: SparkSession, names, database: str, root: str, buckets: int = BUCKETS) -> None:
    """Make stored tables known to the session catalog: files written by ``store_tables``
    with the same number of buckets, in this or an earlier application."""
    for name in names:
        path = _path(root, name)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        if name in BUCKETED:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
            key = BUCKETED[name]
            spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                      f"INTO {buckets} BUCKETS LOCATION '{path}'")
            continue
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        if name in MONTH_PARTITIONED:
            spark.catalog.recoverPartitions(f"{database}.{name}")


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"
