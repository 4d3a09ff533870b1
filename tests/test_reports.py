"""Report behaviour on the driver-derived tables, including the reference's quirks
and the ``fix_*`` options (SURVEY Q1-Q22, regression scenarios T1-T17)."""
import datetime as dt
import re

from pyspark.sql import functions as F

from helpers import canonical

from assurspark.plans import claims, production
from assurspark.plans.params import (
    ClaimsOutstandingParams, ClaimsReportedParams, ClaimsSettledParams, DailyProductionParams,
)

D = dt.datetime


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_q1_arms_are_exclusive(tables):
    p = dict(date_from=D(1995, 1, 1), date_to=D(2002, 1, 1))
    branch_arm = claims.claims_reported(tables, ClaimsReportedParams(**p))
    dept_arm = claims.claims_reported(tables, ClaimsReportedParams(department="N3", **p))
    assert branch_arm.where(F.col("SBU_CODE").startswith("N") | F.col("SBU_CODE").startswith("R")).count() \
        == branch_arm.count()
    # department arm reports the parent branch (a region unit) as SBU
    assert dept_arm.where(~F.col("SBU_CODE").startswith("R")).count() == 0


def test_q3_missing_bounds_fall_back_to_loss_date(tables):
    df = claims.claims_reported(tables, ClaimsReportedParams())
    rows = df.select("NOTIFICATION_DATE", "LOSS_DATE").collect()
    assert all(r.NOTIFICATION_DATE == r.LOSS_DATE for r in rows)


def test_q2_outstanding_duplicates_and_fix(tables):
    base = dict(as_at=D(1998, 7, 1), run_ts=D(2002, 1, 1))
    ref = claims.claims_outstanding(tables, ClaimsOutstandingParams(**base))
    fixed = claims.claims_outstanding(tables, ClaimsOutstandingParams(fix_arms=True, **base))
    dup = ref.groupBy("CLAIM_ID").count().where("count > 1").count()
    assert dup > 0                       # department claims appear under both arms
    assert fixed.count() < ref.count()
    assert ref.where(F.col("claim_status").isin("Rejected", "Closed")).count() == 0


def test_q5_settled_open_end(tables):
    p = dict(date_from=D(1997, 1, 1), date_to=None)
    assert claims.claims_settled(tables, ClaimsSettledParams(**p)).count() == 0
    assert claims.claims_settled(tables, ClaimsSettledParams(fix_open_end=True, **p)).count() > 0


def test_q7_remark_always_empty_and_distinct(tables):
    df = claims.claims_settled(tables, ClaimsSettledParams(date_from=D(1995, 1, 1), date_to=D(2002, 1, 1)))
    assert df.where(F.col("remark") != "").count() == 0
    assert df.count() == df.distinct().count()


SHOWN_DETAILS = ["clm_dx_reserve", "clm_dx_note", "clm_dx_pay_coinsurer", "clm_dx_payout_ind", "clm_dx_ind_payout_details",
                 "clm_dx_ext_cost_by_role", "rei_dx_clm_brdr_sum_recoverable", "clm_dx_premium", "clm_dx_policy_partner",
                 "clm_dx_pay_premium", "inc_v_policy_history", "ina_t_vyplaty"]


def test_settled_is_distinct_without_a_wide_distinct(tables):
    p = ClaimsSettledParams(date_from=D(1997, 1, 1), date_to=D(1998, 12, 31))
    df = claims.claims_settled(tables, p)
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan(df))
    assert keys and max(len(k.split(",")) for k in keys) < 20
    # details and payouts that are all there twice show nothing new
    twice = tables.with_overrides({n: tables[n].unionAll(tables[n]) for n in SHOWN_DETAILS})
    got = claims.claims_settled(twice, p)
    assert canonical(got.collect(), got.columns) == canonical(df.collect(), df.columns)
    # several values of a detail are several rows, equal ones are one
    payee = tables.clm_dx_payout_ind
    other = payee.withColumn("surname_name", F.lit("x"))
    more = tables.with_overrides({"clm_dx_payout_ind": payee.unionAll(other).unionAll(other)})
    assert claims.claims_settled(more, p).count() == 2 * df.count() > 0


def test_or_join_plan_has_no_nested_loop(tables):
    df = claims.claims_settled(tables, ClaimsSettledParams(date_from=D(1997, 1, 1), date_to=D(1998, 12, 31)))
    p = plan(df)
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def _prod(tables, **kw):
    return production.daily_production(tables, DailyProductionParams(**kw))


def test_unknown_basis_date_is_empty(tables):
    assert _prod(tables, basic_date="X", date_from=D(1996, 1, 1), date_to=D(1998, 12, 31)).count() == 0


def test_t1_default_endorsement_type_and_t2_nonzero(tables):
    df = _prod(tables, basic_date="A", sysown_id=None, date_from=D(1995, 1, 1), date_to=D(2002, 1, 1))
    kinds = {r[0] for r in df.select("endorsement_type").distinct().collect()}
    assert "ENDORSEMENT" in kinds and kinds <= {"ENDORSEMENT", "CANCELLATION", "RENEWAL", "NEW POLICY"}
    assert df.where((F.col("gross_premium_orig") == 0) & (F.col("broker_commission_orig") == 0)).count() == 0


def test_q12_certificates_pinned_to_one_policy(tables):
    p = dict(basic_date="A", sysown_id=None, date_from=D(1995, 1, 1), date_to=D(2002, 1, 1))
    pinned = _prod(tables, **p)
    everyone = _prod(tables, certificate_policy_id=None, **p)
    assert pinned.where(F.col("Type_of_Industry").isNotNull()).count() == 0
    assert everyone.where(F.col("Type_of_Industry").isNotNull()).count() > 0


def test_q17_null_group_id_empties_report(tables, spark):
    p = dict(basic_date="A", sysown_id=None, date_from=D(1995, 1, 1), date_to=D(2002, 1, 1))
    links = tables.inc_t_zml_vazby
    with_null = links.unionByName(links.where("vztah_vztah_id = 1").limit(1).withColumn("ku_zmluve_id", F.lit(None).cast("bigint")))
    t2 = tables.with_overrides({"inc_t_zml_vazby": with_null})
    assert _prod(tables, **p).count() > 0
    assert _prod(t2, **p).count() == 0
    assert _prod(t2, fix_group_exclusion=True, **p).count() > 0


def test_t5_members_reported_under_group(tables):
    movements = production.premium_movements(
        tables, DailyProductionParams(date_from=D(1995, 1, 1), date_to=D(2002, 1, 1)),
        production.RateTable(tables.pay_d_exchange))
    members = tables.inc_t_zml_vazby.where("platny = 1 AND vztah_vztah_id = 1").select("zml_zml_id").distinct()
    # no valid member contract keeps its own id as the reported policy
    assert movements.join(members, movements.policy_id == members.zml_zml_id, "left_semi").count() == 0


def test_reports_have_unique_column_names(tables):
    dfs = [claims.claims_reported(tables, ClaimsReportedParams()),
           claims.claims_outstanding(tables, ClaimsOutstandingParams()),
           claims.claims_settled(tables, ClaimsSettledParams()),
           _prod(tables)]
    widths = [73, 79, 93, 98]
    for df, w in zip(dfs, widths):
        assert len(df.columns) == w
        assert len({c.lower() for c in df.columns}) == w


def _level1(tables, **kw):
    p = DailyProductionParams(date_from=D(1996, 1, 1), date_to=D(1998, 12, 31), **kw)
    return production.premium_level1(production.premium_movements(
        tables, p, production.RateTable(tables.pay_d_exchange)))


def test_q10_sum_of_differences_vs_difference_of_sums(tables):
    ref = _level1(tables)
    fixed = _level1(tables, fix_commission_nulls=True)
    # with NULL commissions, SUM(gross - commission) skips rows that SUM(gross) keeps
    assert ref.where(F.col("premium_net").isNull() | (F.col("premium_net") != F.col("premium_net1"))).count() > 0
    assert fixed.where(F.col("premium_net") != F.col("premium_net1")).count() == 0


def test_q11_scan_stops_at_date_to_when_fixed(tables):
    p = dict(date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))
    rates = production.RateTable(tables.pay_d_exchange)
    ref = production.premium_movements(tables, DailyProductionParams(**p), rates)
    fixed = production.premium_movements(tables, DailyProductionParams(fix_period_end=True, **p), rates)
    late = F.col("creation_date") > F.lit(dt.date(1998, 12, 31))
    assert fixed.where(late).count() == 0
    assert ref.where(late).count() >= 0 and ref.count() >= fixed.count()


def test_month_partitions_prune_and_keep_results(spark, tables, tmp_path):
    from assurspark.sources import layout
    names = ["clm_d_claim", "pay_t_transakcia"]
    layout.store(tables, names, str(tmp_path))
    stored = tables.with_overrides({n: spark.read.parquet(str(tmp_path / n)) for n in names})
    cases = [
        (lambda tt: claims.claims_reported(tt, ClaimsReportedParams(date_from=D(1998, 1, 1), date_to=D(1998, 12, 31))),
         "notification_month"),
        (lambda tt: claims.claims_settled(tt, ClaimsSettledParams(date_from=D(1997, 1, 1), date_to=D(1998, 12, 31))),
         "created_month"),
        (lambda tt: _prod(tt, basic_date="C", date_from=D(1996, 1, 1), date_to=D(1998, 12, 31)), "created_month"),
    ]
    for build, part in cases:
        a, b = build(tables), build(stored)
        assert canonical(a.collect(), a.columns) == canonical(b.select(*a.columns).collect(), a.columns)
        p = b._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(" + part in p or ("PartitionFilters" in p and part in p)


def test_hot_policy_is_salted_with_same_result(spark, tables):
    hot = tables.clm_d_claim.withColumn(
        "policy_policy_id", F.when(F.col("claim_id") % 3 == 0, F.lit(3)).otherwise(F.col("policy_policy_id")))
    t2 = tables.with_overrides({"clm_d_claim": hot})
    p = ClaimsOutstandingParams(as_at=D(1998, 7, 1), run_ts=D(2002, 1, 1))
    plain = claims.claims_outstanding(t2, p)
    rows_plain = plain.collect()
    spark.conf.set("assurspark.skew.hotRows", "50")
    spark.conf.set("assurspark.skew.rowsPerSplit", "10")
    try:
        salted = claims.claims_outstanding(t2, p)
        rows_salted = salted.collect()
    finally:
        spark.conf.unset("assurspark.skew.hotRows")
        spark.conf.unset("assurspark.skew.rowsPerSplit")
    assert len(rows_plain) > 0
    assert canonical(rows_plain, plain.columns) == canonical(rows_salted, salted.columns)


def test_hot_contract_movements_salted_same_result(spark, tables):
    p = DailyProductionParams(date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))

    def rows():
        df = production.premium_movements(tables, p, production.RateTable(tables.pay_d_exchange))
        return canonical(df.collect(), df.columns)
    plain = rows()
    spark.conf.set("assurspark.skew.hotRows", "5")
    spark.conf.set("assurspark.skew.rowsPerSplit", "2")
    try:
        salted = rows()
    finally:
        spark.conf.unset("assurspark.skew.hotRows")
        spark.conf.unset("assurspark.skew.rowsPerSplit")
    assert len(plain) > 0 and plain == salted


# ----------------------------------------------------- regression scenarios
_P = dict(date_from=D(1995, 1, 1), date_to=D(2002, 1, 1))


def _movements(tables, **kw):
    return production.premium_movements(tables, DailyProductionParams(**_P, **kw),
                                        production.RateTable(tables.pay_d_exchange))


def test_t4_transaction_version_wins_and_t11_migrated_policies_kept(tables):
    mv = _movements(tables)
    # T4: the version created by the transaction is the originating one when it exists
    assert mv.where(F.col("zmlh_id").isNotNull() & (F.col("policyh_id_orig") != F.col("zmlh_id"))).count() == 0
    # T11: transactions without a creating version still appear (date-valid version or none)
    assert mv.where(F.col("zmlh_id").isNull()).count() > 0


def test_t10_same_parameters_same_rows(tables):
    p = dict(basic_date="C", **_P)
    a, b = _prod(tables, **p), _prod(tables, **p)
    assert canonical(a.collect(), a.columns) == canonical(b.collect(), b.columns)


def test_t14_level2_unique_per_policy_due_date_and_period(tables):
    l2 = production.premium_level2(production.premium_level1(_movements(tables)))
    keys = ["policy_id", "to_date", "period_from", "period_to"]
    assert l2.count() == l2.select(*keys).distinct().count()


def test_t15_only_paying_agent_types_earn_commission(tables):
    none_pay = tables.cms_t_cis_spolupracovnik_typ.withColumn("create_pay_out", F.lit(0))
    t2 = tables.with_overrides({"cms_t_cis_spolupracovnik_typ": none_pay})
    cms = production.commission_by_split(t2, production.RateTable(t2.pay_d_exchange))
    assert cms.where((F.col("broker_commission") != 0) | (F.col("broker_commission_home") != 0)).count() == 0
    cms_ref = production.commission_by_split(tables, production.RateTable(tables.pay_d_exchange))
    assert cms_ref.where(F.col("broker_commission") != 0).count() > 0


def test_t17_approval_sentinel_never_reported(tables):
    df = _prod(tables, basic_date="A", sysown_id=None, **_P)
    assert df.where(F.year("policy_approval") == 9999).count() == 0


def test_t16_zero_premium_kept_when_commission_nonzero(tables):
    l1 = production.premium_level1(_movements(tables))
    # HAVING keeps a group if either sum is non-zero; NULL commission counts as unknown
    assert l1.where((F.col("premium_gross") == 0) & F.col("broker_commission").isNull()).count() == 0


def test_case_insensitive_code_parameters(tables):
    from assurspark.plans.params import CASE_INSENSITIVE
    p = dict(date_from=D(1995, 1, 1), date_to=D(2002, 1, 1))
    exact = claims.claims_reported(tables, ClaimsReportedParams(branch="R3", department="N3", product="MA%", **p))
    lower = claims.claims_reported(tables, ClaimsReportedParams(branch="r3 ", department="n3", product="ma%", **p))
    lower_ci = claims.claims_reported(tables, ClaimsReportedParams(branch="r3 ", department="n3", product="ma%",
                                                                   string_compare=CASE_INSENSITIVE, **p))
    assert exact.count() > 0 and lower.count() == 0
    cols = [c for c in exact.columns if c != "BranchCode"]          # the parameter echo differs
    assert canonical(exact.select(*cols).collect(), cols) == canonical(lower_ci.select(*cols).collect(), cols)
    q = dict(basic_date="A", sysown_id=None, **p)
    a = _prod(tables, class_code="MO", marketer="K0", **q)
    b = _prod(tables, class_code="mo", marketer="k0", string_compare=CASE_INSENSITIVE, **q)
    assert a.count() > 0 and a.count() == b.count()


def test_t8_sum_insured_from_history_version(tables):
    df = _prod(tables, basic_date="A", sysown_id=None, **_P)
    premh = tables.inc_v_policy_premium_h.select(F.col("policyh_id").alias("h_id"),
                                                 F.col("sum_insured").alias("h_sum_insured"))
    j = df.join(premh, F.coalesce("endors_policyh_id", "pol_policyh_id") == F.col("h_id"), "inner")
    assert j.count() > 0
    assert j.where(F.col("sum_insured_orig") != F.col("h_sum_insured")).count() == 0


def test_t9_basis_a_contains_basis_c(tables):
    p = dict(sysown_id=None, date_from=D(1996, 1, 1), date_to=D(1998, 12, 31))
    a = _prod(tables, basic_date="A", **p).drop("BasicDate")
    c = _prod(tables, basic_date="C", **p).drop("BasicDate")
    assert 0 < c.count() <= a.count()
    assert c.exceptAll(a).count() == 0


def test_t13_time_part_ignored_in_creation_date(tables):
    mv = _movements(tables)
    late = (mv.where(F.hour("creation_datetime") > 0).select("creation_date").orderBy("creation_date")
            .limit(1).collect())
    assert late
    day = late[0].creation_date
    upto = dt.datetime(day.year, day.month, day.day)          # midnight of that day
    mv2 = production.premium_movements(
        tables, DailyProductionParams(date_from=D(1995, 1, 1), date_to=upto),
        production.RateTable(tables.pay_d_exchange))
    same_day = mv2.where((F.col("creation_date") == F.lit(day)) & (F.hour("creation_datetime") > 0))
    assert same_day.count() > 0
    assert same_day.where(F.col("created_in_period") != 1).count() == 0


def test_t3_cancelled_billing_pair_vanishes(spark, tables):
    p = DailyProductionParams(**_P)
    rates = production.RateTable(tables.pay_d_exchange)
    mv = production.premium_movements(tables, p, rates)
    # a transaction that has its own version and is the only one of its level-1 group
    groups = mv.groupBy("policy_id", "policyh_id_orig").agg(F.countDistinct("transa_id").alias("n"),
                                                             F.min("transa_id").alias("tx"))
    tx = groups.where((F.col("n") == 1) & F.col("policyh_id_orig").isNotNull()).orderBy("tx").first().tx
    splits = tables.pay_t_trans_rozpad
    one = splits.where(F.col("transa_transa_id") == tx).limit(1)
    pair = (one.withColumn("traroz_id", F.lit(-1).cast("bigint"))
            .unionByName(one.withColumn("traroz_id", F.lit(-2).cast("bigint"))
                         .withColumn("suma", -F.col("suma")).withColumn("sum_home_currency", -F.col("sum_home_currency"))))
    t2 = tables.with_overrides({"pay_t_trans_rozpad": splits.where(F.col("transa_transa_id") != tx).unionByName(pair)})
    l1 = production.premium_level1(production.premium_movements(t2, p, rates))
    assert l1.where(F.col("max_transa_id") == tx).count() == 0
    assert production.premium_level1(mv).where(F.col("max_transa_id") == tx).count() == 1
