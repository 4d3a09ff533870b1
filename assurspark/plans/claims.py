"""Claims reports R-01 (reported), R-02 (outstanding), R-03 (settled) and their stages.

Plan shape (all three): a claim-level base is built from the claim table and
small code lists (broadcast under the byte threshold), then enriched by left joins.
The joins are ordered by key -- first every policy-keyed join, then every
claim-keyed join -- so the wide row is shuffled once per key and consecutive
sort-merge joins on the same key reuse the partitioning.  Per-claim detail
views that can hold many rows per claim (correspondence) are reduced with a
partial aggregate before they are joined.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import (
    before_next_day, between_or_fallback, class_of, code_eq, currency_of_amount, current, day_diff,
    half_open_days, like, localised, open_at, optional_eq, person_name, product_pattern, same_code,
    ts_lit, typed_null, when_flag, where_all,
)
from ..operators.aggregates import latest_per_key, span_per_key, value_sets
from ..operators.currency import latest_rates
from ..operators.joins import left_join_present, or_equi_join, semi
from ..sources.catalog import Tables
from ..sources.layout import prune_months
from .params import CASE_INSENSITIVE, ClaimsOutstandingParams, ClaimsReportedParams, ClaimsSettledParams

# fixed values: codes the claims reports test
NONLIFE = "NONLIFE"
EXTERNAL_ADJUSTER_ROLE = "EXTADJ"
OPEN_STATUS_CODES = ("R", "SP", "ZO")        # statuses that may be open without a settlement date
CLOSED_STATUS_CODES = ("B", "Z")             # excluded from the outstanding report
SETTLED_PAYOUT_STATUS = "S"
DUE_DATE_RELATION = "PR/PL"
FAC_PREFIX = "F%"
TREATY_PREFIX = "O%"
SETTLED_STATUS = "U"
NET_CLAIMS_PLACEHOLDER = "*must be computed*"

STR = T.StringType()
MONEY = T.DecimalType(19, 4)


def _dom(c) -> "F.Column":
    """Home-currency products are reported as DECIMAL(38,6)."""
    return c.cast(T.DecimalType(38, 6))


# ------------------------------------------------------------------- stages
def _org_units(t: Tables, culture_id: int) -> DataFrame:
    ou = localised(t.par_d_cl_org_unit, culture_id)
    ol = localised(t.par_d_cl_org_level, culture_id)
    return ou.join(ol, ou.orglvl_orglvl_id == ol.orglvl_id, "inner").select(
        ou.orgunit_id.alias("u_id"), ou.orgunit_orgunit_id.alias("u_parent"),
        ou.code.alias("u_code"), ou.abbrev.alias("u_abbrev"), ou.name.alias("u_name"),
        ol.level_no.alias("u_level_no"), ol.name.alias("u_level_name"))


def _claim_status(t: Tables, culture_id: int) -> DataFrame:
    return (localised(t.clm_d_cl_claim_st, culture_id)
            .select(F.col("cclmst_id"), F.col("code").alias("claim_status_code"),
                    F.col("description").alias("claim_status")))


def _rate_by_code(t: Tables) -> DataFrame:
    r = latest_rates(t.pay_d_exchange, t.pay_t_cis_mena)
    return r.select(F.col("kod").alias("x_kod"), F.col("xRate"))


def claim_dims(t: Tables, culture_id: int, settled: bool = False) -> dict[str, DataFrame]:
    """The code lists of a claims report, built once."""
    b = {f"units:{culture_id}": lambda: _org_units(t, culture_id),
         f"claim_status:{culture_id}": lambda: _claim_status(t, culture_id),
         "rate_by_code": lambda: _rate_by_code(t)}
    if settled:
        b.update({
            "payout_status": lambda: t.ina_t_cis_vyplata_stavy
            .where(F.col("kod") == SETTLED_PAYOUT_STATUS).select("cvypst_id"),
            f"payment_form:{culture_id}": lambda: localised(t.pay_v_cis_platba_forma, culture_id).select(
                "plafor_id", F.col("kod").alias("payout_method_code"),
                F.col("popis").alias("payout_method_descr")),
            "currency_codes": lambda: t.pay_t_cis_mena.select(F.col("cmenak_id"), F.col("kod").alias("currency_code")),
            "due_relation": lambda: t.pay_t_cis_typ_vztahu.where(F.col("kod") == DUE_DATE_RELATION)
            .select("typvzt_id"),
        })
    return t.dims(b)


def org_units(t: Tables, culture_id: int) -> DataFrame:
    """P-02: organisation units with their level, one culture."""
    return claim_dims(t, culture_id)[f"units:{culture_id}"]


def claim_core(t: Tables, culture_id: int, notified_from=None, notified_to=None) -> DataFrame:
    """Valid claims with status, administering unit and (valid) loss notification.

    ``notified_from`` / ``notified_to``: inclusive notification-date bounds the
    caller filters on; they only prune month partitions of a partitioned claim
    table (the caller's own predicate stays the exact filter)."""
    clm = prune_months(current(t.clm_d_claim), "clm_d_claim", notified_from, notified_to)
    cst = claim_dims(t, culture_id)[f"claim_status:{culture_id}"]
    units = org_units(t, culture_id)
    losn = current(t.clm_d_loss_notification).select(
        "losntf_id", F.col("address_street").alias("loss_street"),
        F.col("address_house_number1").alias("loss_house_number1"),
        F.col("address_house_number2").alias("loss_house_number2"),
        F.col("address_city").alias("loss_city"), F.col("postal_code").alias("loss_postal_code"),
        F.col("occurence_place_description").alias("loss_place"),
        F.col("loss_description").alias("LOSS_DESCRIPTION"))
    core = (clm.join(cst, clm.cclmst_cclmst_id == cst.cclmst_id, "inner")
            .join(units, clm.orgunit_admin_id == units.u_id, "inner")
            .join(losn, clm.losntf_losntf_id == losn.losntf_id, "left"))
    return core.select(
        "orgunit_admin_id", "claim_id", F.col("clmno").alias("claim_number"), "policy_policy_id",
        "notification_date", F.col("occurence_date").alias("LOSS_DATE"), "settlement_date",
        "registration_date", "claim_status_code", "claim_status", "loss_street",
        "loss_house_number1", "loss_house_number2", "loss_city", "loss_postal_code", "loss_place",
        "LOSS_DESCRIPTION", F.col("payment_identifier").alias("Voucher_No"), "adjuster",
        "u_parent", "u_code", "u_abbrev", "u_name", "u_level_no", "u_level_name")


_CORE_COLS = ["orgunit_admin_id", "claim_id", "claim_number", "policy_policy_id",
              "notification_date", "LOSS_DATE", "settlement_date", "registration_date",
              "claim_status_code", "claim_status", "loss_street", "loss_house_number1",
              "loss_house_number2", "loss_city", "loss_postal_code", "loss_place",
              "LOSS_DESCRIPTION", "Voucher_No", "adjuster"]


def department_arm(t: Tables, culture_id: int, core: DataFrame) -> DataFrame:
    """P-01 arm 1: the claim's unit is a department (level > 1), its parent the branch."""
    par = org_units(t, culture_id)
    parent = par.select(*[F.col(c).alias("p" + c) for c in par.columns])
    j = core.join(parent, F.col("u_parent") == F.col("pu_id"), "left")
    return j.where(F.col("u_level_no") > 1).select(
        *_CORE_COLS,
        F.col("u_code").alias("department"), F.col("u_abbrev").alias("department_code"),
        F.col("u_name").alias("department_name"), F.col("u_level_no").alias("department_level_no"),
        F.col("u_level_name").alias("department_level_name"),
        F.col("pu_code").alias("branch"), F.col("pu_abbrev").alias("branch_code"),
        F.col("pu_name").alias("branch_name"), F.col("pu_level_no").alias("branch_level_no"),
        F.col("pu_level_name").alias("branch_level_name"))


def branch_arm(core: DataFrame) -> DataFrame:
    """P-01 arm 2: the claim's own unit is reported as the branch; department columns NULL."""
    return core.select(
        *_CORE_COLS,
        typed_null(STR).alias("department"), typed_null(STR).alias("department_code"),
        typed_null(STR).alias("department_name"), typed_null(T.IntegerType()).alias("department_level_no"),
        typed_null(STR).alias("department_level_name"),
        F.col("u_code").alias("branch"), F.col("u_abbrev").alias("branch_code"),
        F.col("u_name").alias("branch_name"), F.col("u_level_no").alias("branch_level_no"),
        F.col("u_level_name").alias("branch_level_name"))


def both_arms(t: Tables, culture_id: int, core: DataFrame, arm1_filter=None, arm2_filter=None) -> DataFrame:
    """U-01: ``department_arm UNION ALL branch_arm`` from a single pass over the claims.

    Each claim row carries an array of (at most two) arm structs -- the department
    reading when its unit is below level 1, the branch reading always -- which is
    exploded; so the claim table and its joins are read once, not once per arm.
    ``arm1_filter`` / ``arm2_filter`` are predicates over the arm's output columns."""
    par = org_units(t, culture_id)
    parent = par.select(*[F.col(c).alias("p" + c) for c in par.columns])
    j = core.join(parent, F.col("u_parent") == F.col("pu_id"), "left")
    dept = F.struct(F.col("u_code").alias("department"), F.col("u_abbrev").alias("department_code"),
                    F.col("u_name").alias("department_name"), F.col("u_level_no").alias("department_level_no"),
                    F.col("u_level_name").alias("department_level_name"), F.col("pu_code").alias("branch"),
                    F.col("pu_abbrev").alias("branch_code"), F.col("pu_name").alias("branch_name"),
                    F.col("pu_level_no").alias("branch_level_no"),
                    F.col("pu_level_name").alias("branch_level_name"))
    own = F.struct(typed_null(STR).alias("department"), typed_null(STR).alias("department_code"),
                   typed_null(STR).alias("department_name"),
                   typed_null(T.IntegerType()).alias("department_level_no"),
                   typed_null(STR).alias("department_level_name"), F.col("u_code").alias("branch"),
                   F.col("u_abbrev").alias("branch_code"), F.col("u_name").alias("branch_name"),
                   F.col("u_level_no").alias("branch_level_no"), F.col("u_level_name").alias("branch_level_name"))
    arms = F.array(F.when(F.col("u_level_no") > 1, dept), own)
    out = (j.select(*_CORE_COLS, F.explode(arms).alias("_arm")).where(F.col("_arm").isNotNull())
           .select(*_CORE_COLS, F.col("_arm.*"), F.col("_arm.department_level_no").isNotNull().alias("_is_dept")))
    # arm 1 rows have a department level (always > 1); arm 2 rows never do
    if arm1_filter is not None:
        out = out.where(~F.col("_is_dept") | arm1_filter)
    if arm2_filter is not None:
        out = out.where(F.col("_is_dept") | arm2_filter)
    return out.drop("_is_dept")


def officer_names(t: Tables) -> DataFrame:
    """P-03 per staff member: valid partner -> physical / legal person (valid, left).
    The claims reports join it on the adjuster their claim rows carry."""
    p = current(t.par_d_partner).select("partner_id")
    pp = current(t.par_d_physical_person).select(
        F.col("partner_root_id").alias("pp_id"), F.col("first_name").alias("phys_person_firstname"),
        F.col("surname").alias("phys_person_surname"))
    lp = current(t.par_d_legal_person).select(
        F.col("partner_root_id").alias("lp_id"), F.col("name").alias("legal_person_name"))
    return (p.join(pp, F.col("partner_id") == F.col("pp_id"), "left")
            .join(lp, F.col("partner_id") == F.col("lp_id"), "left")
            .select(F.col("partner_id").alias("off_partner_id"), "phys_person_firstname",
                    "phys_person_surname", "legal_person_name"))


def claim_officer(t: Tables) -> DataFrame:
    """P-03 as a table of its own: valid claim -> names of its adjuster."""
    clm = current(t.clm_d_claim).select("claim_id", "adjuster")
    return clm.join(officer_names(t), F.col("adjuster") == F.col("off_partner_id"), "inner").select(
        "claim_id", "phys_person_firstname", "phys_person_surname", "legal_person_name")


def window_claims(t: Tables, p: ClaimsReportedParams) -> DataFrame:
    """Ids of the claims notified in the report's period: a narrow key set, read
    from the period's month partitions."""
    clm = prune_months(current(t.clm_d_claim), "clm_d_claim", p.date_from, p.date_to)
    return clm.where(between_or_fallback("notification_date", p.date_from, p.date_to, "occurence_date")).select(
        F.col("claim_id").alias("window_claim_id"))


def latest_rate_by_code(t: Tables) -> DataFrame:
    """P-04 keyed by currency code."""
    return t.dims({"rate_by_code": lambda: _rate_by_code(t)})["rate_by_code"]


def with_latest_rate(t: Tables, df: DataFrame, currency: str, ci: bool = False, distinct: bool = False) -> DataFrame:
    """P-04 joined to a currency code column (left).  ``ci``: codes match without regard to
    case and trailing blanks.  ``distinct``: equal rates of one date count once."""
    rates = latest_rate_by_code(t)
    return df.join(rates.distinct() if distinct else rates, same_code(F.col(currency), F.col("x_kod"), ci), "left")


def latest_correspondence(t: Tables, culture_id: int, claims: DataFrame | None = None) -> DataFrame:
    """P-05: per claim the latest-received correspondence (receive desc nulls last,
    then create desc as tie-breaker).  ``claims``: one-column frame of the claim
    ids the caller looks up; letters of other claims are dropped first."""
    co = localised(t.clm_dx_correspondence, culture_id)
    if claims is not None:
        co = semi(co, claims, F.col("claim_id") == F.col(claims.columns[0]))
    top = latest_per_key(co, ["claim_id"], ["corresp_receive_date", "corresp_create_date"])
    return top.select(F.col("claim_id").alias("co_claim_id"), "corresp_receive_date",
                      "corresp_create_date")


def correspondence_span(t: Tables, culture_id: int) -> DataFrame:
    """P-06: per claim the last receive date and the first create date."""
    co = localised(t.clm_dx_correspondence, culture_id)
    return span_per_key(co, ["claim_id"], {"corresp_receive_date": "corresp_receive_date"},
                        {"corresp_create_date": "corresp_create_date"}) \
        .withColumnRenamed("claim_id", "co_claim_id")


def policies(t: Tables, culture_id: int, product: str | None, ci: bool = False) -> DataFrame:
    """P-17: non-life policies of one culture, optional product pattern."""
    pol = localised(t.clm_dx_policy, culture_id).where(F.col("sysowner_code") == NONLIFE)
    return where_all(pol, product_pattern("product_code", product, ci))


def _reserve(t: Tables, culture_id: int, indemnity: int, prefix: str) -> DataFrame:
    r = localised(t.clm_dx_reserve, culture_id).where(F.col("indemnity") == indemnity)
    return r.select(F.col("claim_id").alias(f"{prefix}_claim_id"),
                    F.col("indemnity_reserve_balance").alias(f"{prefix}_indemnity_reserve_balance"),
                    F.col("extcost_reserve_balance").alias(f"{prefix}_extcost_reserve_balance"),
                    F.col("indemnity_reserve_change_date").alias(f"{prefix}_change_date"))


def _recoverable(t: Tables, pattern: str, prefix: str) -> DataFrame:
    r = t.rei_dx_clm_brdr_sum_recoverable.where(like("contr_type_code", pattern))
    return r.select(F.col("claim_id").alias(f"{prefix}_claim_id"),
                    F.col("recoverable").alias(f"{prefix}_recoverable"))


def policy_row(t: Tables, culture_id: int, pol: DataFrame) -> DataFrame:
    """Everything R-01 and R-02 read per policy, pre-joined into one
    policy-level row: the policy (inner), its booking (inner), premium, policy
    partners, paid premium and group policy (left).

    All of these are keyed by the policy, so joining them to each other first
    and the claims to the result once gives the same rows as joining the
    claims to each in turn -- but leaves a single claims-to-policy join, which
    AQE can split when one policy holds a large share of the claims."""
    j = pol.select(
        F.col("policy_id").alias("pol_policy_id"), "policy_number", F.col("uw_year").alias("UW_Year"),
        "date_inception", "date_maturity", "orgunit_name", "product_code", "product_name",
        "product_brand_code", "currency_code", "sysowner", "acc_orgunit_name",
        "acc_orgunit_description")
    key = F.col("pol_policy_id")
    book = t.pol_dx_policy_booking.select(F.col("policy_id").alias("bk_policy_id"),
                                          "orgunit_book_code")
    j = j.join(book, key == F.col("bk_policy_id"), "inner")
    prem = t.clm_dx_premium.select(F.col("policy_policy_id").alias("pr_policy_id"),
                                   "annual_premium", "insured_sum")
    ap = t.clm_dx_policy_partner.select(F.col("policy_id").alias("ap_policy_id"), "assured_pers",
                                        "insured_pers", "agent", "agent_number")
    pp = localised(t.clm_dx_pay_premium, culture_id).select(
        F.col("policy_id").alias("pp_policy_id"), F.col("payment_amount").alias("PAYMENT_AMOUNT"),
        "first_premium_date", "last_premium_date")
    return (j.join(prem, key == F.col("pr_policy_id"), "left")
            .join(ap, key == F.col("ap_policy_id"), "left")
            .join(pp, key == F.col("pp_policy_id"), "left")
            .join(_group(t, culture_id), key == F.col("gp_policy_id"), "left"))


def _policy_side(t: Tables, culture_id: int, base: DataFrame, pol: DataFrame) -> DataFrame:
    """The claims joined once to their policy-level row (inner); a policy with a
    large share of the claims is split by AQE's skew join."""
    row = policy_row(t, culture_id, pol)
    return base.join(row, F.col("policy_policy_id") == F.col("pol_policy_id"), "inner")


def _group(t: Tables, culture_id: int) -> DataFrame:
    return localised(t.clm_dx_policy_group, culture_id).select(
        F.col("policy_id").alias("gp_policy_id"), "group_pol_no", "group_pol_prod_code",
        "group_pol_prod_name")


def _claim_side(t: Tables, culture_id: int, j: DataFrame, correspondence: DataFrame,
                with_payout: bool = True, with_pay: bool = True) -> DataFrame:
    """Every claim-keyed left join shared by the claims reports."""
    cid = F.col("claim_id")
    j = (j.join(_reserve(t, culture_id, 1, "ri"), cid == F.col("ri_claim_id"), "left")
         .join(_reserve(t, culture_id, 0, "re"), cid == F.col("re_claim_id"), "left"))
    if with_payout:
        payout = localised(t.clm_dx_payout, culture_id).select(
            F.col("claim_id").alias("po_claim_id"), "amount_paid_indemnity", "amount_paid_extcost",
            "payee", "paymethod_indemnity", "paymethod_extcost")
        j = j.join(payout, cid == F.col("po_claim_id"), "left")
    j = j.join(correspondence, cid == F.col("co_claim_id"), "left")
    if with_pay:
        pay = localised(t.clm_dx_pay_payout, culture_id).select(
            F.col("claim_id").alias("pay_claim_id"), F.col("payout_amount").alias("PAYOUT_AMOUNT"),
            F.col("payout_currency").alias("PAYOUT_CURRENCY"))
        j = j.join(pay, cid == F.col("pay_claim_id"), "left")
    coins = t.clm_dx_pay_coinsurer.select(
        F.col("claim_id").alias("cn_claim_id"), F.col("payout_coins_amount").alias("PAYOUT_COINS_AMOUNT"),
        F.col("payout_coins_currency").alias("PAYOUT_COINS_CURRENCY"))
    ext = (localised(t.clm_dx_ext_cost_by_role, culture_id)
           .where(F.col("role_code") == EXTERNAL_ADJUSTER_ROLE)
           .select(F.col("claim_id").alias("ea_claim_id"), "amount_paid_extadj", "ext_payee"))
    notes = localised(t.clm_dx_note, culture_id).select(F.col("claim_id").alias("nt_claim_id"), "note")
    return (j.join(coins, cid == F.col("cn_claim_id"), "left")
            .join(ext, cid == F.col("ea_claim_id"), "left")
            .join(notes, cid == F.col("nt_claim_id"), "left"))


# -------------------------------------------------------------------- R-01
def claims_reported(t: Tables, p: ClaimsReportedParams) -> DataFrame:
    """R-01: claims notified in a period, one row per claim x matching detail rows.

    The two arms of the reference are mutually exclusive on the department
    parameter (equality with NULL is unknown), so only one is planned."""
    ci = p.string_compare == CASE_INSENSITIVE
    claim_dims(t, p.culture_id)
    core = claim_core(t, p.culture_id, p.date_from, p.date_to)
    period = between_or_fallback("notification_date", p.date_from, p.date_to, "LOSS_DATE")
    if p.department is not None:
        base = department_arm(t, p.culture_id, core)
        base = where_all(base, optional_eq("branch_code", p.branch, ci),
                         code_eq("department_code", p.department, ci), period)
    else:
        base = where_all(branch_arm(core), optional_eq("branch_code", p.branch, ci), period)

    j = _policy_side(t, p.culture_id, base, policies(t, p.culture_id, p.product, ci))
    j = _claim_side(t, p.culture_id, j, latest_correspondence(t, p.culture_id, window_claims(t, p)))
    j = left_join_present(j, officer_names(t), [("adjuster", "off_partner_id")], ["claim_id"])
    j = with_latest_rate(t, j, "currency_code", ci)

    na = F.lit(p.placeholder)
    return j.select(
        F.col("branch_code").alias("SBU_CODE"), F.col("branch_name").alias("SBU_NAME"),
        F.col("notification_date").alias("NOTIFICATION_DATE"),
        F.year("LOSS_DATE").alias("Year_of_loss"), F.col("LOSS_DATE"),
        F.col("loss_city").alias("loss_location_CITY"), F.col("loss_street").alias("loss_location_STREET"),
        F.col("loss_postal_code").alias("loss_location_POSTAL_CODE"),
        F.col("loss_house_number1").alias("loss_location_house_no1"),
        F.col("loss_house_number2").alias("loss_location_house_no2"),
        F.col("loss_place").alias("loss_location_description"),
        F.coalesce("assured_pers", F.lit("")).alias("assured_name"),
        F.coalesce("insured_pers", F.lit("")).alias("insured_name"),
        F.col("claim_number").alias("claim_no"), F.col("policy_number").alias("policy_no"),
        F.col("UW_Year").alias("uw_year"), F.col("date_inception").alias("policy_fm_date"),
        F.col("date_maturity").alias("policy_to_date"), F.col("LOSS_DESCRIPTION").alias("loss_description"),
        F.col("annual_premium").alias("gross_premium"), F.col("PAYMENT_AMOUNT").alias("premium_received"),
        F.col("first_premium_date").alias("date_prem_recvd_first"),
        F.col("last_premium_date").alias("date_prem_recvd_last"),
        na.alias("date_dv_signed"), F.col("corresp_receive_date").alias("date_dv_recvd"),
        F.col("corresp_create_date").alias("date_dv_created"),
        F.col("amount_paid_extadj").alias("adjuster_fee"), F.col("ext_payee").alias("adjusters_name"),
        F.col("ri_indemnity_reserve_balance").alias("claim_estimate_indemnity"),
        F.col("re_extcost_reserve_balance").alias("claim_estimate_extcost"),
        "amount_paid_indemnity", "amount_paid_extcost",
        F.col("PAYOUT_AMOUNT").alias("payout_amount_total"),
        F.col("settlement_date").alias("settled_date"), na.alias("date_rcvd_by_insured"),
        day_diff("settlement_date", F.coalesce("corresp_receive_date", "registration_date"))
        .alias("process_period"),
        F.col("orgunit_name").alias("uw_location"), F.col("insured_sum").alias("sum_insured"),
        na.alias("acknow_receipt_date"), F.col("claim_status"), F.col("note").alias("remarks"),
        F.col("ri_indemnity_reserve_balance").alias("AMOUNT_RESERVED_IND"),
        F.col("re_extcost_reserve_balance").alias("AMOUNT_RESERVED_EXTCOST"),
        F.col("ri_change_date").alias("date_of_claim_reserve_ind"),
        F.col("re_change_date").alias("date_of_claim_reserve_extcost"),
        F.col("phys_person_firstname").alias("claim_officer_pp_firstname"),
        F.col("phys_person_surname").alias("claim_officer_pp_surname"),
        F.col("legal_person_name").alias("claim_officer_legal_pers_name"),
        F.col("payee"), F.col("paymethod_indemnity").alias("settle_mode_indemnity"),
        F.col("paymethod_extcost").alias("settle_mode_extcost"), F.col("product_code"),
        F.col("product_brand_code"), F.col("currency_code").alias("policy_currency"),
        F.col("PAYOUT_CURRENCY"), F.col("PAYOUT_COINS_CURRENCY"), F.col("claim_id").alias("CLAIM_ID"),
        F.col("registration_date"), F.col("sysowner"), "group_pol_no", "group_pol_prod_code",
        "group_pol_prod_name", F.lit(p.branch).cast(STR).alias("BranchCode"),
        F.col("orgunit_book_code").alias("DepartmentCode"), class_of("product_code").alias("ClassCode"),
        F.col("product_code").alias("ProductCode"),
        ts_lit(p.date_from).alias("ClaimIntimationDateFrom"),
        ts_lit(p.date_to).alias("ClaimIntimationDateTo"),
        F.col("acc_orgunit_name").alias("acc_ou_code"),
        F.col("acc_orgunit_description").alias("acc_ou_description"),
        F.col("agent").alias("Agent_name"), F.col("agent_number").alias("Agent_code"),
        F.col("xRate").alias("Exchange_Rate"))


# -------------------------------------------------------------------- R-02
def claims_outstanding(t: Tables, p: ClaimsOutstandingParams) -> DataFrame:
    """R-02: claims open at ``as_at`` with age, reserves, home-currency estimates and
    reinsurance recoverables."""
    claim_dims(t, p.culture_id)
    core = claim_core(t, p.culture_id)
    state = (open_at("claim_status_code", "settlement_date", p.as_at, OPEN_STATUS_CODES)
             & before_next_day("registration_date", p.as_at))
    core = core.where(state & ~F.col("claim_status_code").isin(*CLOSED_STATUS_CODES))
    ci = p.string_compare == CASE_INSENSITIVE
    dept_arm_on = (p.department is not None) if p.fix_arms else True
    if dept_arm_on and p.department is None:
        # both arms: one pass, arm 2 filtered on the optional branch
        base = both_arms(t, p.culture_id, core, arm2_filter=optional_eq("branch_code", p.branch, ci))
    elif dept_arm_on:
        base = department_arm(t, p.culture_id, core)
        if p.fix_arms:
            base = where_all(base, optional_eq("branch_code", p.branch, ci),
                             code_eq("department_code", p.department, ci))
    else:
        base = where_all(branch_arm(core), optional_eq("branch_code", p.branch, ci))

    j = _policy_side(t, p.culture_id, base, policies(t, p.culture_id, p.product, ci))
    j = _claim_side(t, p.culture_id, j, correspondence_span(t, p.culture_id))
    payind = localised(t.clm_dx_payout_ind, p.culture_id).select(
        F.col("claim_id").alias("pi_claim_id"), "surname_name", "name_abbr", "middle_name")
    # keyed through the payout (no payout, no beneficiary): written on claim_id,
    # which equals the payout's claim id whenever there is one, so the row is
    # not re-shuffled on a second key
    j = j.join(payind, (F.col("claim_id") == F.col("pi_claim_id")) & F.col("po_claim_id").isNotNull(), "left")
    j = (j.join(_recoverable(t, FAC_PREFIX, "r1"), F.col("claim_id") == F.col("r1_claim_id"), "left")
         .join(_recoverable(t, TREATY_PREFIX, "r2"), F.col("claim_id") == F.col("r2_claim_id"), "left"))
    # the last join of the rows that is not on the claim: nothing keyed by it follows
    j = left_join_present(j, officer_names(t), [("adjuster", "off_partner_id")], ["claim_id"])
    j = with_latest_rate(t, j, "currency_code", ci)

    rate1 = F.coalesce(F.col("xRate"), F.lit(1))
    now = ts_lit(p.run_ts) if p.run_ts is not None else F.current_timestamp().cast(T.TimestampNTZType())
    na = F.lit(p.placeholder)
    ind = F.col("ri_indemnity_reserve_balance")
    ext = F.col("re_extcost_reserve_balance")
    pay_ccy = F.coalesce(F.col("PAYOUT_CURRENCY"), F.col("currency_code"))
    return j.select(
        F.col("branch_code").alias("SBU_CODE"), F.col("branch_name").alias("SBU_NAME"),
        F.col("notification_date").alias("NOTIFICATION_DATE"), F.col("xRate").alias("Exchange_Rate"),
        F.year("LOSS_DATE").alias("Year_of_loss"), F.col("LOSS_DATE"),
        day_diff(ts_lit(p.as_at), "registration_date").alias("age"),
        F.col("loss_city").alias("loss_location_CITY"), F.col("loss_street").alias("loss_location_STREET"),
        F.col("loss_postal_code").alias("loss_location_POSTAL_CODE"),
        F.col("loss_house_number1").alias("loss_location_house_no1"),
        F.col("loss_house_number2").alias("loss_location_house_no2"),
        F.col("loss_place").alias("loss_location_description"),
        F.coalesce("assured_pers", F.lit("")).alias("assured_name"),
        F.coalesce("insured_pers", F.lit("")).alias("insured_name"),
        F.col("claim_number").alias("claim_no"), F.col("policy_number").alias("policy_no"),
        F.col("UW_Year").alias("uw_year"), F.col("date_inception").alias("policy_fm_date"),
        F.col("date_maturity").alias("policy_to_date"), F.col("LOSS_DESCRIPTION").alias("loss_description"),
        F.col("annual_premium").alias("gross_premium"), F.col("PAYMENT_AMOUNT").alias("premium_received"),
        F.col("first_premium_date").alias("date_prem_recvd_first"),
        F.col("last_premium_date").alias("date_prem_recvd_last"),
        na.alias("date_dv_signed"), F.col("corresp_receive_date").alias("date_dv_recvd"),
        F.col("corresp_create_date").alias("date_dv_created"),
        F.col("amount_paid_extadj").alias("adjuster_fee"), F.col("ext_payee").alias("adjusters_name"),
        ind.alias("claim_estimate_indemnity"), ext.alias("claim_estimate_extcost"),
        "amount_paid_indemnity", "amount_paid_extcost",
        F.col("PAYOUT_AMOUNT").alias("payout_amount_total"),
        _dom(F.when(F.col("amount_paid_extadj").isNull(), F.lit(0))
             .otherwise(F.col("amount_paid_extadj") * rate1)).alias("adjuster_fee_ngn"),
        _dom(F.when(F.col("amount_paid_indemnity").isNull(), F.lit(0))
             .otherwise(rate1 * F.col("amount_paid_indemnity"))).alias("amount_paid_indemnity_dom_curr"),
        _dom(F.when(F.col("amount_paid_extcost").isNotNull(), rate1 * F.col("amount_paid_extcost"))
             .otherwise(F.lit(0))).alias("amount_paid_extcost_dom_curr"),
        currency_of_amount(ind, "PAYOUT_CURRENCY", "currency_code").alias("currency_indemnity"),
        _dom(F.when(ind.isNull(), F.lit(0)).otherwise(rate1 * ind)).alias("claim_estimate_indemnity_dom_curr"),
        F.when(ext.isNotNull(), pay_ccy).alias("currency_extcost"),
        _dom(F.when(ext.isNotNull(), rate1 * ext).otherwise(F.lit(0))).alias("claim_estimate_extcost_dom_curr"),
        F.col("PAYOUT_COINS_AMOUNT").alias("COINSURANCE_RECOVABLE"),
        F.col("r1_recoverable").alias("FAC_RECOVERABLE"), F.col("r2_recoverable").alias("TREATY_RECOVERABLE"),
        typed_null(MONEY).alias("NET_CLAIM_AMOUNT"),
        F.col("settlement_date").alias("settled_date"), na.alias("date_rcvd_by_insured"),
        day_diff(F.coalesce(F.col("settlement_date"), now),
                 F.coalesce("corresp_receive_date", "registration_date")).alias("process_period"),
        F.col("orgunit_name").alias("uw_location"), typed_null(STR).alias("reason_of_outstanding"),
        F.col("note").alias("remarks"), F.col("insured_sum").alias("sum_insured"),
        na.alias("acknow_receipt_date"), F.col("claim_status"),
        F.col("currency_code").alias("policy_currency"), F.col("claim_id").alias("CLAIM_ID"),
        F.col("registration_date"), F.col("sysowner"), "group_pol_no", "group_pol_prod_code",
        "group_pol_prod_name", F.lit(p.branch).cast(STR).alias("BranchCode"),
        F.col("orgunit_book_code").alias("DepartmentCode"), class_of("product_code").alias("ClassCode"),
        F.col("product_code").alias("ProductCode"), F.col("product_name"),
        ts_lit(p.as_at).alias("AsAtDate"), F.col("acc_orgunit_name").alias("acc_ou_code"),
        F.col("acc_orgunit_description").alias("acc_ou_description"),
        F.col("legal_person_name").alias("Claim_Officer_Legal_P"),
        F.col("phys_person_firstname").alias("Phy_P_Firstname"),
        F.col("phys_person_surname").alias("Phy_P_Surname"),
        F.col("agent").alias("Agent_name"), F.col("agent_number").alias("Agent_code"),
        F.col("surname_name").alias("Beneficiary_Surname"),
        F.col("name_abbr").alias("Beneficiary_name_abbr"),
        F.col("middle_name").alias("Beneficiary_middle_name"), F.col("Voucher_No"))


# -------------------------------------------------------------------- R-03
def payment_due_dates(t: Tables, heads: DataFrame | None = None) -> DataFrame:
    """P-08: head transaction -> due date of the related transaction (valid relation
    of type PR/PL).  ``heads``: one-column frame of the head transactions the
    caller looks up; other relations are dropped before the transactions are met."""
    tv = current(t.pay_t_trans_vztahy, "platny")
    if heads is not None:
        tv = semi(tv, heads, F.col("transa_transa_hlav_id") == F.col(heads.columns[0]))
    typ = t.dims({"due_relation": lambda: t.pay_t_cis_typ_vztahu
                  .where(F.col("kod") == DUE_DATE_RELATION).select("typvzt_id")})["due_relation"]
    tx = t.pay_t_transakcia.select(F.col("transa_id").alias("t2_id"), "datum_splatnost")
    return (tv.join(typ, tv.typvzt_typvzt_id == typ.typvzt_id, "inner")
            .join(tx, F.col("transa_transa_vedl_id") == F.col("t2_id"), "inner")
            .select(F.col("transa_transa_hlav_id").alias("due_head_id"),
                    F.col("datum_splatnost").alias("ACCOUNT_DEBITED_DATE")))


def payout_detail(t: Tables, p: ClaimsSettledParams, claims: DataFrame | None = None) -> DataFrame:
    """P-07: settled payouts with payee, inspector and adjuster names, the paying
    transaction (created in the period), currency, method and due date.

    The payee is the claim partner reached from the payout's addressee *or* from
    its valid expense row -- an OR join rewritten as an exploded equi join.
    ``claims``: distinct ids of the claims the caller shows, one column; payouts of
    others are dropped first."""
    v = current(t.ina_t_vyplaty, "platny")
    dims = claim_dims(t, p.culture_id, settled=True)
    vst, pm = dims["payout_status"], dims[f"payment_form:{p.culture_id}"]
    tx = t.pay_t_transakcia.select(
        *[c for c in ("created_month",) if c in t.pay_t_transakcia.columns],
        F.col("transa_id"), F.col("id_riad_zdroj"), F.col("cmenak_cmenak_id"),
        F.col("datum_vytvorenia").alias("approval_date"), F.col("suma").alias("trans_suma"),
        F.col("sum_home_currency").alias("payout_amount_hc"))
    tx = tx.where(half_open_days("approval_date", p.date_from, p.date_to, p.fix_open_end))
    tx = prune_months(tx, "pay_t_transakcia", p.date_from,
                      None if p.date_to is None else p.date_to + _dt.timedelta(days=1))
    cc = t.ina_t_pln_adresati.select(F.col("plnadr_id"), F.col("pupar_pupar_id").alias("cc_pupar"))
    pun = current(t.ina_t_pu_naklady, "platny").select(
        F.col("punakl_id"), F.col("pupar_pupar_id").alias("pun_pupar"))
    cp = current(t.ina_t_pudalost_partneri, "platny").select("pupar_id", "partner_partner_id")
    partners = t.par_dx_partners

    def names(alias: str) -> DataFrame:
        return partners.select(F.col("partner_id").alias(f"{alias}_id"),
                               person_name("firstname_abbrev", "middle_name", "surname_name")
                               .alias(f"{alias}_name"))

    cm = dims["currency_codes"]
    # the code list cuts the payouts to the settled ones before these are shuffled to the
    # claims, if few are shown, and to the window's transactions, which cut them before they
    # meet anything else
    j = v.join(vst, v.cvypst_cvypst_id == vst.cvypst_id, "inner")
    if claims is not None:
        # ids are distinct; a semi join would be pushed below the code list
        j = j.join(claims, F.col("pudal_koren_id") == F.col(claims.columns[0]), "inner")
    j = j.join(tx, F.col("id_riad_zdroj") == F.col("vypla_id"), "inner")
    # a payout has an addressee or an expense, so many rows have no key
    j = left_join_present(j, cc, [("plnadr_plnadr_id", "plnadr_id")], ["transa_id"])
    j = left_join_present(j, pun, [("punakl_punakl_id", "punakl_id")], ["transa_id"])
    j = or_equi_join(j, cp, ["cc_pupar", "pun_pupar"], "pupar_id", "inner")
    j = j.join(names("para"), F.col("partner_partner_id") == F.col("para_id"), "inner")
    for alias, key in (("parr", "revident"), ("parl", "likvidator")):
        j = left_join_present(j, names(alias), [(key, f"{alias}_id")], ["transa_id"])
    j = (j.join(pm, F.col("plafor_plafor_id") == F.col("plafor_id"), "inner")
         .join(cm, F.col("cmenak_cmenak_id") == F.col("cmenak_id"), "left")
         .join(payment_due_dates(t, tx.select(F.col("transa_id").alias("window_tx"))),
               F.col("transa_id") == F.col("due_head_id"), "left"))
    # The lookups of transaction types and states have no output column and are not
    # planned.  That rests on at most one type with the code PREVYP (the reference's
    # join has no other condition) and one state per key: ``Tables.check_keys`` checks both.
    return j.select(
        F.col("pudal_koren_id").alias("claim_root_id"), F.col("vypla_id").alias("payout_id"),
        F.col("por_cislo").alias("payout_order"), "approval_date",
        F.col("parr_name").alias("inspector_name"), F.col("parl_name").alias("adjuster_name"),
        F.col("para_name").alias("addressee"),
        F.when(F.col("punakl_punakl_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("is_expense"),
        "trans_suma", F.col("vypl_ciastka").alias("payout_amount"), F.col("dan").alias("WHT_tax"),
        F.col("tax_included").alias("VAT_tax"), F.col("suma").alias("full_amount"),
        F.col("currency_code").alias("pod_currency"),
        "payout_amount_hc", "ACCOUNT_DEBITED_DATE", "payout_method_code", "payout_method_descr",
        "confirm_date")


def _window_payments(t: Tables, p: ClaimsSettledParams) -> DataFrame:
    """The transactions created in the report's period, from its month partitions."""
    tx = t.pay_t_transakcia.where(half_open_days("datum_vytvorenia", p.date_from, p.date_to, p.fix_open_end))
    return prune_months(tx, "pay_t_transakcia", p.date_from,
                        None if p.date_to is None else p.date_to + _dt.timedelta(days=1))


def paid_claims(t: Tables, p: ClaimsSettledParams) -> DataFrame:
    """Ids of the claims with a payout paid in the period: a narrow superset of the
    report's claims, by which their details are cut before anything is aggregated."""
    paid = _window_payments(t, p).select(F.col("id_riad_zdroj").alias("paid_id"))
    v = current(t.ina_t_vyplaty, "platny").select("vypla_id", "pudal_koren_id")
    return semi(v, paid, F.col("vypla_id") == F.col("paid_id")).select(
        F.col("pudal_koren_id").alias("paid_claim_id")).distinct()


def branch_claims(t: Tables, p: ClaimsSettledParams) -> DataFrame:
    """Distinct ids of the claims that are accounted in the report's branch."""
    units = org_units(t, p.culture_id).where(optional_eq("u_abbrev", p.branch, p.string_compare == CASE_INSENSITIVE))
    clm = current(t.clm_d_claim).select("claim_id", "orgunit_accounting_id")
    return (semi(clm, units, F.col("orgunit_accounting_id") == F.col("u_id"))
            .select(F.col("claim_id").alias("branch_claim_id")).distinct())


def _claim_sets(t: Tables, c: int, claims: DataFrame) -> DataFrame:
    """Everything R-03 shows of a claim's details, one row per claim: the details are
    stacked, cut to ``claims`` (distinct ids) and aggregated once, each to its distinct values."""
    details = {
        "payind": (localised(t.clm_dx_payout_ind, c), "claim_id", ["surname_name", "name_abbr", "middle_name"]),
        "cipd": (localised(t.clm_dx_ind_payout_details, c), "claim_root_id", ["payout_method_descr"]),
        "ri": (localised(t.clm_dx_reserve, c).where("indemnity = 1"), "claim_id", ["indemnity_reserve_balance"]),
        "re": (localised(t.clm_dx_reserve, c).where("indemnity = 0"), "claim_id", ["extcost_reserve_balance"]),
        "coins": (t.clm_dx_pay_coinsurer, "claim_id", ["payout_coins_amount", "payout_coins_currency"]),
        "ext": (localised(t.clm_dx_ext_cost_by_role, c).where(F.col("role_code") == EXTERNAL_ADJUSTER_ROLE),
                "claim_id", ["amount_paid_extadj", "ext_payee"]),
        "notes": (localised(t.clm_dx_note, c), "claim_id", ["note"]),
        "r1": (t.rei_dx_clm_brdr_sum_recoverable.where(like("contr_type_code", FAC_PREFIX)), "claim_id", ["recoverable"]),
        "r2": (t.rei_dx_clm_brdr_sum_recoverable.where(like("contr_type_code", TREATY_PREFIX)), "claim_id", ["recoverable"]),
    }
    letters = localised(t.clm_dx_correspondence, c).select(
        F.col("claim_id").alias("set_claim_id"), F.lit("letters").alias("kind"),
        F.struct("corresp_receive_date", "corresp_create_date").alias("letters"))
    stack = letters
    for kind, (df, key, columns) in details.items():
        rows = df.select(F.col(key).alias("set_claim_id"), F.lit(kind).alias("kind"), F.struct(*columns).alias(kind))
        stack = stack.unionByName(rows, allowMissingColumns=True)
    # ``claims`` are distinct; an inner join, since a semi join is pushed into every part of the stack
    stack = stack.join(claims, F.col("set_claim_id") == F.col(claims.columns[0]), "inner")
    return stack.groupBy("set_claim_id").agg(
        *[F.collect_set(kind).alias(kind) for kind in details],
        # the letter received last, of several the one created last (P-05)
        F.max("letters").alias("letter"))


def claims_settled(t: Tables, p: ClaimsSettledParams) -> DataFrame:
    """R-03: claims settled statement, one row per distinct payout line.

    DISTINCT is taken where rows can repeat, not over the 93 columns of the report: of the
    payouts the values it shows, of every detail of a claim or policy its sets of
    shown values (``aggregates.value_sets``).  The report shows the claim, so rows that
    differ in one of those differ.  That rests on one valid row per claim and loss
    notification and one row per policy and culture (``schemas.UNIQUE_KEYS``)."""
    claim_dims(t, p.culture_id, settled=True)
    c = p.culture_id
    # claims of one branch are few: they cut payouts and details before these are shuffled on
    in_branch = None if p.branch is None else branch_claims(t, p)
    shown = ["claim_root_id", "approval_date", "inspector_name", "adjuster_name", "addressee", "is_expense",
             "payout_amount", "WHT_tax", "VAT_tax", "full_amount", "pod_currency", "payout_amount_hc",
             "ACCOUNT_DEBITED_DATE", "payout_method_descr", "confirm_date"]
    # the expense flag shows only in where amount, currency and method are printed
    no_trace = F.coalesce(*[F.col(x).cast(STR) for x in ("payout_amount", "pod_currency", "payout_amount_hc",
                                                        "payout_method_descr")]).isNull()
    pod = (payout_detail(t, p, in_branch).withColumn("is_expense", F.when(no_trace, F.lit(0)).otherwise(F.col("is_expense")))
           .select(*shown).distinct())
    scope = paid_claims(t, p) if in_branch is None else in_branch
    clm = current(t.clm_d_claim).select(
        "claim_id", "policy_policy_id", "cclmst_cclmst_id", "orgunit_accounting_id", "losntf_losntf_id",
        "notification_date", "occurence_date", "settlement_date", "registration_date",
        F.col("clmno"), "payment_identifier")
    cst = claim_dims(t, c)[f"claim_status:{c}"].withColumnRenamed("claim_status_code", "cst_code")
    ci = p.string_compare == CASE_INSENSITIVE
    units = where_all(org_units(t, c), optional_eq("u_abbrev", p.branch, ci))
    if p.branch is not None:
        clm = semi(clm, units, F.col("orgunit_accounting_id") == F.col("u_id"))
    losn = current(t.clm_d_loss_notification).select(
        "losntf_id", "address_street", "address_house_number1", "address_house_number2",
        "address_city", "postal_code", "occurence_place_description", "loss_description")
    # The history is shown as every pair of distinct signatures of the policy: kept once
    # per policy as a set, and opened twice.
    hist = value_sets(t.inc_v_policy_history.withColumnRenamed("policy_id", "h_policy_id"), "h_policy_id",
                      {"signatures": (["entry_user_desc", "appr_user_desc"], None)})

    j = (pod.join(clm, pod.claim_root_id == clm.claim_id, "inner")
         .join(_claim_sets(t, c, scope), F.col("claim_id") == F.col("set_claim_id"), "inner")
         .join(cst, F.col("cclmst_cclmst_id") == F.col("cclmst_id"), "inner")
         .join(units, F.col("orgunit_accounting_id") == F.col("u_id"), "inner")
         .join(losn, F.col("losntf_losntf_id") == F.col("losntf_id"), "left"))
    # one policy-level row (policy, premium, partners, paid premium: each its distinct
    # values, and the history), joined to the payout rows once
    by_policy = F.col("pol_policy_id")
    prow = (policies(t, c, p.product, ci)
            .select(F.col("policy_id").alias("pol_policy_id"), "policy_number",
                    F.col("uw_year").alias("UW_Year"), "date_inception", "date_maturity", "orgunit_name",
                    "product_code", "product_name", "product_brand_code", "currency_code", "sysowner",
                    "acc_orgunit_name", "acc_orgunit_description")
            .join(hist, by_policy == F.col("h_policy_id"), "inner"))
    people = t.clm_dx_policy_partner.select(
        F.col("policy_id").alias("ap_policy_id"), F.coalesce("assured_pers", F.lit("")).alias("assured_pers"),
        F.coalesce("insured_pers", F.lit("")).alias("insured_pers"), "agent", "agent_number")
    prem = t.clm_dx_premium.withColumnRenamed("policy_policy_id", "pr_policy_id")
    received = localised(t.clm_dx_pay_premium, c).withColumnRenamed("policy_id", "pp_policy_id")
    for df, name, columns in ((prem, "pr", ["annual_premium", "insured_sum"]),
                              (people, "ap", ["assured_pers", "insured_pers", "agent", "agent_number"]),
                              (received, "pp", ["payment_amount", "first_premium_date", "last_premium_date"])):
        prow = prow.join(value_sets(df, f"{name}_policy_id", {name: (columns, None)}),
                         by_policy == F.col(f"{name}_policy_id"), "left")
    j = j.join(prow, F.col("policy_policy_id") == by_policy, "inner")
    j = with_latest_rate(t, j, "currency_code", ci, distinct=True)
    # a line without beneficiary or method of payment is not shown; the other sets may be empty
    j = j.withColumn("gr_signatures", F.col("signatures"))
    for name in ("payind", "cipd", "signatures", "gr_signatures"):
        j = j.withColumn(name, F.explode(name))
    for name in ("ri", "re", "coins", "ext", "notes", "r1", "r2", "pr", "ap", "pp"):
        j = j.withColumn(name, F.explode_outer(name))

    exp = "is_expense"
    na = F.lit(p.placeholder)
    out = j.select(
        F.col("u_abbrev").alias("branch_code"), F.col("u_name").alias("branch_name"),
        F.col("notification_date").alias("NOTIFICATION_DATE"),
        F.year("occurence_date").alias("Year_of_loss"), F.col("occurence_date").alias("LOSS_DATE"),
        F.coalesce("ap.insured_pers", F.lit("")).alias("insured_name"),
        F.coalesce("ap.assured_pers", F.lit("")).alias("assured_name"),
        F.col("clmno").alias("claim_no"), F.col("policy_number").alias("policy_no"),
        F.col("UW_Year").alias("uw_year"), F.col("date_inception").alias("policy_fm_date"),
        F.col("date_maturity").alias("policy_to_date"), F.col("loss_description"),
        F.col("pr.annual_premium").alias("gross_premium"), F.col("pp.payment_amount").alias("premium_received"),
        F.col("pp.first_premium_date").alias("date_prem_recvd_first"),
        F.col("pp.last_premium_date").alias("date_prem_recvd_last"),
        F.col("confirm_date").alias("date_dv_signed"),
        F.col("letter.corresp_receive_date").alias("date_dv_recvd"),
        F.col("letter.corresp_create_date").alias("date_dv_created"),
        F.col("ext.amount_paid_extadj").alias("adjuster_fee"), F.col("ext.ext_payee").alias("adjusters_name"),
        F.col("ri.indemnity_reserve_balance").alias("claim_estimate_indemnity"),
        when_flag(exp, typed_null(MONEY), F.col("payout_amount")).alias("amount_paid_indemnity"),
        when_flag(exp, typed_null(STR), F.col("pod_currency")).alias("currency_indemnity"),
        when_flag(exp, typed_null(MONEY), F.col("payout_amount_hc")).alias("amount_paid_indemnity_dom_curr"),
        F.col("re.extcost_reserve_balance").alias("claim_estimate_extcost"),
        when_flag(exp, F.col("payout_amount"), typed_null(MONEY)).alias("amount_paid_extcost"),
        when_flag(exp, F.col("pod_currency"), typed_null(STR)).alias("currency_extcost"),
        when_flag(exp, F.col("payout_amount_hc"), typed_null(MONEY)).alias("amount_paid_extcost_dom_curr"),
        F.lit(0).alias("payout_amount_total"),
        F.col("coins.payout_coins_amount").alias("coinsurance_recovable"),
        F.col("r1.recoverable").alias("FAC_RECOVERABLE"), F.col("r2.recoverable").alias("TREATY_RECOVERABLE"),
        F.lit(NET_CLAIMS_PLACEHOLDER).alias("net_claims_amount"),
        F.col("approval_date").alias("settled_date"), na.alias("date_rcvd_by_insured"),
        day_diff("registration_date", F.coalesce("letter.corresp_receive_date", "settlement_date"))
        .alias("process_period"),
        F.col("orgunit_name").alias("uw_location"), F.col("notes.note").alias("remarks"),
        F.col("pr.insured_sum").alias("insured_sum"), na.alias("acknow_receipt_date"),
        F.col("ACCOUNT_DEBITED_DATE").alias("date_account_debited"), F.col("addressee").alias("payee"),
        when_flag(exp, typed_null(STR), F.col("payout_method_descr")).alias("settle_mode_indemnity"),
        when_flag(exp, F.col("payout_method_descr"), typed_null(STR)).alias("settle_mode_extcost"),
        F.col("product_code"), F.col("product_name"), F.col("product_brand_code"),
        F.col("currency_code").alias("policy_currency"),
        F.col("pod_currency").alias("payout_currency"),
        F.col("coins.payout_coins_currency").alias("PAYOUT_COINS_CURRENCY"), F.col("claim_status"), F.col("claim_id").alias("CLAIM_ID"),
        F.col("registration_date"), F.col("sysowner"),
        F.col("policy_number").alias("group_pol_no"), F.col("product_code").alias("group_pol_prod_code"),
        F.col("product_name").alias("group_pol_prod_name"),
        F.lit(p.branch).cast(STR).alias("BranchCode"), typed_null(STR).alias("DepartmentCode"),
        F.col("product_brand_code").alias("Class_code"), F.lit(p.class_code).cast(STR).alias("ClassCode"),
        F.lit(p.product).cast(STR).alias("ProductCode"), ts_lit(p.date_from).alias("SettledDateFrom"),
        ts_lit(p.date_to).alias("SettledDateTo"), F.col("acc_orgunit_name").alias("acc_ou_code"),
        F.col("acc_orgunit_description").alias("acc_ou_description"),
        F.col("signatures.entry_user_desc").alias("policy_initiator"),
        F.col("signatures.appr_user_desc").alias("policy_approval"),
        F.col("gr_signatures.entry_user_desc").alias("gr_policy_initiator"),
        F.col("gr_signatures.appr_user_desc").alias("gr_policy_approval"),
        F.col("adjuster_name").alias("claim_initiator"), F.col("inspector_name").alias("claim_approval"),
        "VAT_tax", "full_amount", "WHT_tax",
        F.when((F.col("cst_code") != F.lit(SETTLED_STATUS)) & F.col(exp).isNull(), F.lit("PARTIAL PAYOUTS"))
        .otherwise(F.lit("")).alias("remark"),
        F.col("address_street").alias("loss_street"), F.col("address_house_number1").alias("loss_house_number1"),
        F.col("address_house_number2").alias("loss_house_number2"), F.col("address_city").alias("loss_city"),
        F.col("postal_code").alias("loss_postal_code"), F.col("occurence_place_description").alias("loss_place"),
        F.col("ap.agent").alias("Agent_name"), F.col("ap.agent_number").alias("Agent_code"),
        F.col("payind.surname_name").alias("Beneficiary_Surname"), F.col("payind.name_abbr").alias("Beneficiary_name_abbr"),
        F.col("payind.middle_name").alias("Beneficiary_middle_name"),
        F.col("payment_identifier").alias("Voucher_No"), F.col("cipd.payout_method_descr").alias("Mode_of_payment"),
        F.col("xRate").alias("Rate"),
        _dom(F.col("full_amount") * F.col("xRate")).alias("Amount_Paid_GHS"))
    return out
