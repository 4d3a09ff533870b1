"""Benchmark: the four reports (and their main variants) on the driver data.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.

The logical insurance tables are first derived from the driver's parquet and
stored once as parquet (``prepare_sec``, reported separately; the windowed
fact tables month-partitioned, ``sources/layout.py``) and registered as
external tables of the session catalog with their partitions -- the way the
reports run in production, where those tables exist.  Each report is then
built over the catalog tables and executed to completion with the ``noop``
sink (full plan, no driver collect); each report is timed $BENCH_REPEATS times
(default 3, each with a fresh ``Tables``, so every run plans and size-checks
again) and its median kept; ``value`` is the sum of the report medians.
Set BENCH_TABLES_DIR to reuse / place the stored tables (a shared path on a
cluster); by default a fresh temporary directory is used.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assurspark.session import local_session  # noqa: E402
from assurspark.sources import driver_fixtures, layout  # noqa: E402
from assurspark.sources.catalog import Tables  # noqa: E402
from oracles.registry import QUERIES  # noqa: E402

HEADLINE = [
    "claims_reported", "claims_reported_department", "claims_outstanding",
    "claims_outstanding_department", "claims_settled", "daily_production_c",
    "daily_production_a", "daily_production_i",
]


def prepare(spark, sf_dir: str, out_dir: str) -> None:
    derived = Tables.from_driver_data(spark, sf_dir)
    todo = [n for n in driver_fixtures.logical_names()
            if not os.path.exists(os.path.join(out_dir, n, "_SUCCESS"))]
    layout.store(derived, todo, out_dir)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    out_dir = os.environ.get("BENCH_TABLES_DIR") or tempfile.mkdtemp(prefix="run-bench-tables-")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8")),
                          memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          extra={"spark.sql.warehouse.dir": os.path.join(out_dir, "_warehouse")})
    t0 = time.perf_counter()
    prepare(spark, sf_dir, out_dir)
    prepare_sec = round(time.perf_counter() - t0, 3)

    # register the stored tables in the session catalog (external tables; month
    # partitions recovered into the catalog), as reports read them in production
    db = "assur_bench"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name in driver_fixtures.logical_names():
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
        spark.catalog.createTable(f"{db}.{name}", path=os.path.join(out_dir, name), source="parquet")
        if name in layout.MONTH_PARTITIONED:
            spark.catalog.recoverPartitions(f"{db}.{name}")

    def run(name: str) -> None:
        t = Tables.from_catalog(spark, db)
        QUERIES[name].build(t).write.format("noop").mode("overwrite").save()

    run("claims_outstanding")  # warm-up: JIT, codegen caches, parquet footers
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            t1 = time.perf_counter()
            run(name)
            runs.append(time.perf_counter() - t1)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_report_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "prepare_sec": prepare_sec,
                      "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
