"""Stored tables: detail tables bucketed by the key they are joined on."""
import datetime as dt

import pytest

from assurspark.plans import claims
from assurspark.plans.params import ClaimsOutstandingParams, ClaimsReportedParams
from assurspark.sources import layout
from assurspark.sources.catalog import Tables
from helpers import canonical

D = dt.datetime
BUCKETS = 4
REPORTED = ClaimsReportedParams(date_from=D(1997, 1, 1), date_to=D(1998, 12, 31))
OUTSTANDING = ClaimsOutstandingParams(as_at=D(1998, 7, 1), run_ts=D(2002, 1, 1))
NAMES = sorted(layout.BUCKETED) + [
    "clm_d_claim", "clm_d_cl_claim_st", "clm_d_loss_notification", "par_d_cl_org_unit", "par_d_cl_org_level", "par_d_partner",
    "par_d_physical_person", "par_d_legal_person", "pay_t_cis_mena", "pay_d_exchange"]


@pytest.fixture(scope="module")
def database(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_tables")
    layout.store_tables(tables, NAMES, "stored_tables", root, BUCKETS)
    yield "stored_tables", root
    spark.sql("DROP DATABASE stored_tables CASCADE")


@pytest.fixture
def shuffled(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def moved_tables(df):
    """Tables read below each hash exchange, down to the next exchange."""
    def scans(plan):
        if plan.nodeName().startswith("Scan"):
            return [plan.nodeName().rsplit(".", 1)[-1].strip()]
        children = plan.children()
        own = [children.apply(i) for i in range(children.size())]
        return [s for c in own if c.nodeName() != "Exchange" for s in scans(c)]

    plan = df._jdf.queryExecution().executedPlan()
    return [scans(n.children().apply(0)) for n in nodes(plan)
            if n.nodeName() == "Exchange" and "hashpartitioning" in n.simpleString(200)]


@pytest.mark.parametrize("report, params", [(claims.claims_reported, REPORTED), (claims.claims_outstanding, OUTSTANDING)])
def test_detail_tables_are_not_shuffled(shuffled, database, report, params):
    df = report(Tables.from_catalog(shuffled, database[0]), params)
    moved = moved_tables(df)
    alone = {x for tables_ in moved if len(set(tables_)) == 1 for x in tables_}
    assert alone & set(layout.BUCKETED) == set()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("report, params", [(claims.claims_reported, REPORTED), (claims.claims_outstanding, OUTSTANDING)])
def test_stored_tables_give_the_same_report(spark, tables, database, report, params):
    want = report(tables, params)
    got = report(Tables.from_catalog(spark, database[0]), params)
    assert canonical(got.collect(), got.columns) == canonical(want.collect(), want.columns)


def test_tables_can_be_registered_again(shuffled, database):
    name, root = database
    shuffled.sql("CREATE DATABASE IF NOT EXISTS later_session")
    try:
        layout.register_tables(shuffled, ["clm_dx_reserve", "clm_dx_note", "clm_d_claim"], "later_session", root, BUCKETS)
        a, b = shuffled.table("later_session.clm_dx_reserve"), shuffled.table("later_session.clm_dx_note")
        joined = a.join(b, "claim_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan                               # read in the join's partitioning
        assert joined.count() == shuffled.table(f"{name}.clm_dx_reserve").join(shuffled.table(f"{name}.clm_dx_note"), "claim_id").count()
        assert "notification_month" in shuffled.table("later_session.clm_d_claim").columns
    finally:
        shuffled.sql("DROP DATABASE later_session CASCADE")
