"""Run a report as a batch job.

    spark-submit --py-files assurspark.zip run_report.py claims_outstanding --tables s3://bucket/insurance \\
        --as-at 2019-03-31 --out s3://bucket/reports/outstanding/2019-03-31
    python -m assurspark.cli daily_production --database insurance --basic-date C \\
        --date-from 2019-01-01 --date-to 2019-01-31 --out /data/prod/2019-01

Parameters mirror the original procedures' arguments; the result is written
as parquet (or csv) by the executors -- nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .plans import claims, production
from .plans.params import (
    ClaimsOutstandingParams, ClaimsReportedParams, ClaimsSettledParams, DailyProductionParams,
)
from .session import configure
from .sources.catalog import Tables


def _ts(s: str | None) -> dt.datetime | None:
    if s is None:
        return None
    return dt.datetime.fromisoformat(s)


def _common(p: argparse.ArgumentParser) -> None:
    p.add_argument("--tables", help="root directory with one parquet dataset per logical table")
    p.add_argument("--database", help="catalog database holding the logical tables")
    p.add_argument("--out", help="output path (required unless --explain)")
    p.add_argument("--explain", action="store_true", help="print the formatted physical plan, do not run")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "append"])
    p.add_argument("--check-keys", action="store_true", help="check the declared keys of the input tables first")
    p.add_argument("--cluster", action="store_true", help="apply the large-scale partition sizing")
    p.add_argument("--culture-id", type=int, default=3)
    p.add_argument("--branch")
    p.add_argument("--class-code")
    p.add_argument("--product")
    p.add_argument("--string-compare", default="binary", choices=["binary", "ci"])


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="assurspark.cli", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="report", required=True)

    r = sub.add_parser("claims_reported", help="R-01 claims notified in a period")
    _common(r)
    r.add_argument("--department")
    r.add_argument("--date-from")
    r.add_argument("--date-to")
    r.add_argument("--placeholder")

    o = sub.add_parser("claims_outstanding", help="R-02 claims open at a date")
    _common(o)
    o.add_argument("--department")
    o.add_argument("--as-at", required=True)
    o.add_argument("--run-ts")
    o.add_argument("--placeholder")
    o.add_argument("--fix-arms", action="store_true")

    s = sub.add_parser("claims_settled", help="R-03 claims settled statement")
    _common(s)
    s.add_argument("--department")
    s.add_argument("--date-from")
    s.add_argument("--date-to")
    s.add_argument("--placeholder")
    s.add_argument("--fix-open-end", action="store_true")

    d = sub.add_parser("daily_production", help="R-04 daily premium production")
    _common(d)
    d.add_argument("--sysown-id", type=int, default=2)
    d.add_argument("--dept")
    d.add_argument("--marketer")
    d.add_argument("--basic-date", default="C")
    d.add_argument("--date-from")
    d.add_argument("--date-to")
    d.add_argument("--user-id", type=int)
    d.add_argument("--all-certificates", action="store_true",
                   help="certificate columns for every policy (not only the pinned one)")
    d.add_argument("--fix-group-exclusion", action="store_true")
    d.add_argument("--fix-commission-nulls", action="store_true")
    d.add_argument("--fix-period-end", action="store_true")
    return ap


def build(spark: SparkSession, a: argparse.Namespace):
    if bool(a.tables) == bool(a.database):
        raise SystemExit("give exactly one of --tables or --database")
    t = Tables.from_parquet_dir(spark, a.tables) if a.tables else Tables.from_catalog(spark, a.database)
    if a.check_keys:
        t.check_keys()
    common = dict(culture_id=a.culture_id, branch=a.branch, class_code=a.class_code, product=a.product,
                  string_compare=a.string_compare)
    extra = {"placeholder": a.placeholder} if getattr(a, "placeholder", None) else {}
    if a.report == "claims_reported":
        return claims.claims_reported(t, ClaimsReportedParams(
            department=a.department, date_from=_ts(a.date_from), date_to=_ts(a.date_to), **common, **extra))
    if a.report == "claims_outstanding":
        return claims.claims_outstanding(t, ClaimsOutstandingParams(
            department=a.department, as_at=_ts(a.as_at), run_ts=_ts(a.run_ts), fix_arms=a.fix_arms,
            **common, **extra))
    if a.report == "claims_settled":
        return claims.claims_settled(t, ClaimsSettledParams(
            department=a.department, date_from=_ts(a.date_from), date_to=_ts(a.date_to),
            fix_open_end=a.fix_open_end, **common, **extra))
    kw = dict(common)
    kw.pop("culture_id")
    return production.daily_production(t, DailyProductionParams(
        culture_id=a.culture_id, sysown_id=a.sysown_id, dept=a.dept, marketer=a.marketer,
        basic_date=a.basic_date, date_from=_ts(a.date_from), date_to=_ts(a.date_to), user_id=a.user_id,
        certificate_policy_id=None if a.all_certificates else DailyProductionParams.certificate_policy_id,
        fix_group_exclusion=a.fix_group_exclusion, fix_commission_nulls=a.fix_commission_nulls,
        fix_period_end=a.fix_period_end, **kw))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"assurspark-{a.report}").getOrCreate()
    configure(spark, cluster=a.cluster)
    df = build(spark, a)
    if a.explain:
        df.explain("formatted")
        return
    if not a.out:
        raise SystemExit("--out is required")
    df.write.mode(a.mode).format(a.format).option("header", "true").save(a.out)


if __name__ == "__main__":
    main(sys.argv[1:])
