"""What a report puts on disk: rows its exchanges write, counted on the run plan (no AQE, code lists broadcast only)."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from assurspark.operators import joins
from assurspark.operators.currency import RateTable
from assurspark.plans import claims, production
from assurspark.plans.params import ClaimsSettledParams, DailyProductionParams

D = dt.datetime
THREE_YEARS = dict(date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))


@pytest.fixture
def planned(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "1024", "spark.sql.shuffle.partitions": "2"}
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def moved(df):
    """[(partitioning, rows written)] of the exchanges of a frame that was collected."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            keys = re.search(r"hashpartitioning\((.*), \d+\)", node.simpleString(1000))
            found.append((keys.group(1) if keys else "", node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return found


def rows_by(df, *columns):
    """Rows written by the exchange on these columns, among others."""
    hits = [n for keys, n in moved(df) if all(re.search(rf"\b{c}#", keys) for c in columns)]
    assert hits, moved(df)
    return max(hits)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("versions", [3, 90])
def test_an_interval_is_shuffled_once_whatever_it_spans(planned, how, versions):
    """Versions of 30 months, few and many to a key: before, a row for every month of each."""
    planned.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    start = F.lit(D(1990, 1, 1)).cast("timestamp_ntz")
    month = F.make_ym_interval(F.lit(0), F.col("id").cast("int"))
    held = planned.range(versions).select((F.col("id") % 2).alias("contract"), F.col("id").alias("version"), (start + month).alias("since"),
                                          (start + month + F.make_ym_interval(F.lit(0), F.lit(30))).alias("until"))
    held = held.unionAll(planned.sql("SELECT 1L, -1L, TIMESTAMP_NTZ '1980-01-01', TIMESTAMP_NTZ '9999-12-31'")) \
        .unionAll(planned.sql("SELECT CAST(NULL AS BIGINT), -2L, TIMESTAMP_NTZ '1980-01-01', TIMESTAMP_NTZ '1980-02-01'")) \
        .unionAll(planned.sql("SELECT 0L, -3L, CAST(NULL AS TIMESTAMP_NTZ), TIMESTAMP_NTZ '1980-02-01'"))
    facts = planned.range(40).select("id", F.when(F.col("id") < 36, F.col("id") % 3).alias("zml"), (start + month + F.make_ym_interval(F.lit(0), F.col("id").cast("int"))).alias("due"))
    out = joins.interval_join(facts, held, [("zml", "contract")], "due", "since", "until", how).select("id", "version")
    plain = joins.interval_join(facts, held, [("zml", "contract")], "due", "since", "until", how, bucket_months=None).select("id", "version")
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted(map(tuple, plain.collect()), key=str) and any(v == -1 for _, v in got)
    assert sum(n for _, n in moved(out)) <= 40 + versions + 3


def test_group_versions_are_met_before_the_splits_multiply_the_rows(planned, tables):
    p = DailyProductionParams(**THREE_YEARS)
    out = production.premium_movements(tables, p, RateTable(tables.pay_d_exchange))
    assert len(out.collect()) > 0
    assert rows_by(out, "zh_zml_id", "zmlh_id") <= production.window_transactions(tables, p).count()


def test_premium_of_policies_that_are_not_shown_is_not_moved(planned, tables):
    """Before, the splits of all branches were moved and added up for the report of one."""
    out = production.daily_production(tables, DailyProductionParams(branch="no such branch", **THREE_YEARS))
    assert out.collect() == []
    assert rows_by(out, "traroz_id") == 0


def test_payouts_of_other_branches_are_cut_before_they_meet_the_transactions(planned, tables):
    out = claims.claims_settled(tables, ClaimsSettledParams(branch="no such branch", product="%", **THREE_YEARS))
    assert out.collect() == []
    assert rows_by(out, "vypla_id") == 0
