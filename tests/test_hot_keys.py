"""Joins on keys that are NULL, or one value, on every row: how the rows are dealt to tasks."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from assurspark.operators import joins


@pytest.fixture
def shuffled(spark):
    """Every join shuffled, no re-planning: what a task reads is what the plan deals out."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def task_rows(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_rows_without_a_key_are_dealt_to_many_tasks(shuffled):
    claims = shuffled.range(20_000).select("id", F.when(F.col("id") < 0, F.col("id")).alias("adjuster"), F.lit("x").alias("note"))
    staff = shuffled.range(50).select(F.col("id").alias("partner"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    plain = claims.join(staff, claims.adjuster == staff.partner, "left")
    assert task_rows(plain) == [20_000]                      # all in one task
    dealt = joins.left_join_present(claims, staff, [("adjuster", "partner")])
    rows = task_rows(dealt)
    assert sum(rows) == 20_000 and len(rows) == 16 and rows[-1] < 2 * 20_000 / 16
    assert dealt.where("name IS NOT NULL").count() == 0
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_rows_with_a_key_still_meet_their_match(shuffled):
    claims = shuffled.range(3_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 60).alias("adjuster"))
    staff = shuffled.range(50).select(F.col("id").alias("partner"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    got = joins.left_join_present(claims, staff, [("adjuster", "partner")]).collect()
    assert len(got) == 3_000
    assert all(r["name"] == (f"n{r['adjuster']}" if r["adjuster"] is not None and r["adjuster"] < 50 else None) for r in got)


def test_contract_with_ten_thousand_versions(shuffled):
    """Versions of a day each, one contract on all facts: a fact meets the versions of its month only."""
    start = dt.datetime(1995, 1, 1)
    versions = shuffled.range(10_000).select(
        (F.col("id") % 1).alias("contract"), F.col("id").alias("version"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("since"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"), F.lit(23))).alias("until"))
    facts = shuffled.range(12_000).select(
        "id", (F.col("id") % 1).alias("zml"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"), F.lit(12))).alias("due"))
    out = joins.interval_join(facts, versions, [("zml", "contract")], "due", "since", "until", "left")
    got = {r["id"]: r["version"] for r in out.collect()}
    assert len(got) == 12_000 and all(v == (k if k < 10_000 else None) for k, v in got.items())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("SortMergeJoin") == 2
    assert len(task_rows(out)) >= 1
