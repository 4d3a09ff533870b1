"""Plans of the reports: work in proportion to the window, nothing run while a
report is built, staff keys and rates."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from assurspark.operators import currency
from assurspark.plans import claims, production
from assurspark.plans.params import ClaimsReportedParams, DailyProductionParams
from assurspark.sources import driver_fixtures, layout
from assurspark.sources.catalog import Tables
from helpers import canonical

D = dt.datetime


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """The two windowed fact tables in the month-partitioned layout."""
    root = str(tmp_path_factory.mktemp("facts"))
    layout.store(tables, ["clm_d_claim", "pay_t_transakcia"], root)
    return tables.with_overrides({n: spark.read.parquet(f"{root}/{n}") for n in ("clm_d_claim", "pay_t_transakcia")})


def fact_scans(df, column):
    """PartitionFilters of every scan that carries the partition column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("FileScan parquet")[1:] if column in x.split("\n")[0]]
    return [re.search(r"PartitionFilters: \[([^\]]*)\]", x).group(1) for x in scans]


def test_one_week_reads_its_months_only(spark, stored):
    week = dict(date_from=D(1998, 3, 2), date_to=D(1998, 3, 8))
    reported = fact_scans(claims.claims_reported(stored, ClaimsReportedParams(**week)), "notification_month")
    assert 1 <= len(reported) <= 2 and all("notification_month" in x for x in reported)
    produced = fact_scans(production.daily_production(stored, DailyProductionParams(basic_date="A", **week)), "created_month")
    assert 1 <= len(produced) <= 8 and all("created_month" in x for x in produced)


def test_no_job_runs_while_a_report_is_built(spark, tables):
    for name in driver_fixtures.logical_names():
        tables[name]                      # parquet footers are read once, before
    fresh = tables.with_overrides({})
    sc = spark.sparkContext
    sc.setJobGroup("building", "no job expected")
    try:
        claims.claims_reported(fresh, ClaimsReportedParams(date_from=D(1998, 1, 1), date_to=D(1998, 1, 31)))
        production.daily_production(fresh, DailyProductionParams(date_from=D(1998, 1, 1), date_to=D(1998, 1, 31)))
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc.setJobGroup("tests", "")


@pytest.mark.parametrize("adjuster", [6, None])
def test_one_adjuster_or_none_on_all_claims(tables, adjuster):
    p = ClaimsReportedParams(date_from=D(1997, 1, 1), date_to=D(1998, 12, 31))
    names = ["claim_officer_pp_firstname", "claim_officer_pp_surname", "claim_officer_legal_pers_name"]
    plain = claims.claims_reported(tables, p)
    hot = tables.with_overrides({"clm_d_claim": tables.clm_d_claim.withColumn("adjuster", F.lit(adjuster).cast("bigint"))})
    got = claims.claims_reported(hot, p)
    rest = [c for c in got.columns if c not in names]
    assert canonical(got.select(rest).collect(), rest) == canonical(plain.select(rest).collect(), rest)
    shown = {tuple(r) for r in got.select(names).distinct().collect()}
    assert shown == ({(None, None, None)} if adjuster is None else {("First6", "Supplier#000000006", "Supplier#000000006 Ltd")}) \
        or (adjuster is not None and len(shown) == 1 and next(iter(shown))[0] == "First6")


def test_rates_of_two_owners_with_ties(spark):
    rows = [(1, 41, D(2020, 1, 1), 2.0), (1, 41, D(2020, 1, 1), 3.0), (1, 41, D(2020, 3, 1), 5.0),
            (2, 41, D(2020, 1, 1), 9.0), (1, 49, D(2020, 2, 1), 4.0), (1, 49, D(2020, 2, 1), 1.0)]
    exchange = spark.createDataFrame(
        rows, "sysown_sysown_id int, ccurr_ccurr_id long, effective_date timestamp_ntz, foreign_exchange_middle double")
    facts = spark.createDataFrame([(k, 41, at) for k, at in enumerate(
        [D(2019, 12, 31), D(2020, 1, 1), D(2020, 2, 29, 23), D(2020, 3, 1), D(2021, 1, 1)])], "k int, ccy long, at timestamp_ntz")
    for owner, want in ((1, [None, 3.0, 3.0, 5.0, 5.0]), (2, [None, 9.0, 9.0, 9.0, 9.0])):
        table = currency.RateTable(exchange, owner=owner)
        by_column = table.with_rate(facts, "ccy", "at", "rate")
        by_constant = table.with_rate(facts, 41, "at", "rate")
        for df in (by_column, by_constant):
            got = [None if r["rate"] is None else float(r["rate"]) for r in df.orderBy("k").collect()]
            assert got == want
    ghs = currency.RateTable(exchange, owner=1).with_rate(facts, 49, "at", "rate").orderBy("k").collect()
    assert [None if r["rate"] is None else float(r["rate"]) for r in ghs] == [None, None, 4.0, 4.0, 4.0]
