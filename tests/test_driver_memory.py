"""What the driver is asked to hold: tables under the broadcast threshold only, by the rows they really have."""
import datetime as dt
import re

from pyspark.sql import functions as F

from assurspark.plans import claims
from assurspark.plans.params import ClaimsSettledParams
from assurspark.plans.production import known_transactions
from assurspark.session import REPORT_CONF
from assurspark.sources.catalog import Tables

MB = 1024 * 1024


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_key_list_of_millions_is_not_broadcast(spark, tmp_path):
    """Existence joins (J-10): 8 MB of compressed ids are 120 MB and more as hashed rows."""
    path = str(tmp_path / "com")
    spark.range(0, 2_000_000, 1, 2).select(F.xxhash64("id").alias("trans_id")).write.parquet(path)
    com = spark.read.parquet(path)
    assert 2 * MB < sum(p.stat().st_size for p in (tmp_path / "com").glob("*.parquet")) < 32 * MB
    moves = spark.range(10).select(F.col("id").alias("transa_id"), F.col("id").alias("vznik_id"), F.col("id").alias("zmena_id"))
    tables = Tables.from_frames(spark, {"com_t_transaction": com})
    assert "BroadcastHashJoin" not in plan_of(known_transactions(tables, moves))


def test_code_lists_are_still_broadcast(spark, tmp_path):
    path = str(tmp_path / "codes")
    spark.range(200).select("id", F.concat(F.lit("code "), F.col("id")).alias("code")).write.parquet(path)
    facts = spark.range(100_000).withColumn("k", F.col("id") % 300)
    assert "BroadcastHashJoin" in plan_of(facts.join(spark.read.parquet(path).withColumnRenamed("id", "k"), "k", "left"))


def test_what_a_report_may_broadcast_fits_a_small_driver():
    """A dozen broadcasts at once; before a table is read, its files count ``factor`` times."""
    threshold, factor = int(REPORT_CONF["spark.sql.autoBroadcastJoinThreshold"]), float(REPORT_CONF["spark.sql.sources.fileCompressionFactor"])
    assert 12 * 20 * threshold / factor <= 300 * MB


def test_payouts_are_cut_to_the_settled_before_they_are_shuffled(spark, tables):
    """P-07: the code list of states comes below the exchange of the payouts, not above it."""
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")        # code lists only
    try:
        plan = plan_of(claims.payout_detail(tables, ClaimsSettledParams(date_from=dt.datetime(1996, 1, 1), date_to=dt.datetime(1998, 12, 31))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = plan.splitlines()
    depth = [re.search(r"[A-Z*]", line).start() if re.search(r"[A-Z*]", line) else 0 for line in lines]
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(vypla_id" in line)
    below = []
    for line, d in zip(lines[at + 1:], depth[at + 1:]):
        if d <= depth[at]:
            break
        below.append(line)
    assert any("Join [cvypst_cvypst_id" in line for line in below), plan
