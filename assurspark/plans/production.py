"""R-04 daily production report and its stages (P-09 ... P-16).

Plan shape: premium movements (transactions x splits, enriched with contract
versions and commission) are reduced by two grouped aggregates -- both with
map-side partial aggregation, so a group policy holding a large share of the
rows is combined before the shuffle -- and only the reduced rows meet the
policy-version interval join and the dimension lookups.  Exchange rates are
joined on (currency, month) plus a range residual, and broadcast while the rate
list is under the byte threshold.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import (
    LOW_DATE, class_of, code_eq, contains_pattern, current, date_only, date_part_between, in_period_flag, like,
    localised, optional_nonempty_eq, ts_lit, where_all, year_month,
)
from ..operators.aggregates import max_when, sum_when_null, sums_nulls_as_zero
from ..operators.currency import GHS_CCY_ID, HOME_CCY_ID, RateTable, converted, latest_rates
from ..operators.joins import interval_join, left_join_present, null_aware_anti, salted_join, semi, single_value
from ..sources.catalog import Tables
from ..sources.layout import prune_months
from .params import CASE_INSENSITIVE, DailyProductionParams

# fixed values: codes the production report tests
GROUP_RELATION = "RZML"
CONTRACT_OBJECT_TYPE = "Zmluva"
FIXED_CULTURE = 3                      # code lists the reference always reads in culture 3
POLICY_TYPES = ("Ind", "SOS", "Ram")
RENEWAL_CHANGES = ("MProl", "MProlN", "RenewPrem")
NEW_POLICY_CHANGES = ("CRE", "AKCEP")
CERTIFICATE_CODES = {                  # output column -> parameter code pattern (LIKE)
    "ECOWAS_Sticker_Serial_Number": "ECOWStickNo10",
    "NIC_Sticker_Serial_Number": "NICStickNo10",
    "Fire_Certificate_Number": "FireCertNum",
    "Certificate_number": "CerNo_Veh",
    "Type_of_Industry": "IndustType",
}

_HIGH = _dt.date(9999, 12, 31)
D4 = T.DecimalType(38, 4)
D6 = T.DecimalType(38, 6)
STR = T.StringType()
TS = T.TimestampNTZType()


# ------------------------------------------------------------------ stages
def _code_lists(t: Tables, c: int) -> dict:
    """Builders of every code list of the production report."""
    def sel(df: DataFrame, cols: dict[str, str]) -> DataFrame:
        return df.select(*[F.col(k).alias(v) for k, v in cols.items()])
    return {
        "rzml_relation": lambda: localised(current(t.par_d_cl_relation), FIXED_CULTURE)
        .where(F.col("code") == GROUP_RELATION).select("crel_id"),
        "rzml_link": lambda: current(t.par_t_cis_vztah, "platny")
        .where(F.col("vztah_kod") == GROUP_RELATION).select("vztah_id"),
        "contract_object_type": lambda: t.com_t_cis_object_type
        .where(F.col("code") == CONTRACT_OBJECT_TYPE).select("objtyp_id"),
        "paying_agent_types": lambda: t.cms_t_cis_spolupracovnik_typ
        .where(F.col("create_pay_out") == 1).select("cspolty_id"),
        "certificate_status": lambda: localised(t.prd_d_cl_policy_status, FIXED_CULTURE).select("polst_id"),
        f"policy_type:{c}": lambda: sel(localised(t.pol_d_cl_policy_type, c).where(F.col("code").isin(*POLICY_TYPES)),
                                       {"polty_id": "pt_id", "description": "policy_type"}),
        f"policy_status:{c}": lambda: sel(localised(t.prd_d_cl_policy_status, c),
                                         {"polst_id": "ps_id", "code": "ps_code", "name": "ps_name",
                                          "description": "ps_desc"}),
        f"book_unit:{c}": lambda: sel(localised(t.par_d_cl_org_unit, c),
                                     {"orgunit_id": "ou_id", "code": "ou_code", "abbrev": "ou_abbrev",
                                      "name": "ou_name"}),
        "product": lambda: sel(t.prd_d_product, {"prod_id": "pr_id", "code": "pr_code", "name": "pr_name",
                                                 "brand_brand_id": "pr_brand", "sysown_sysown_id": "pr_sysown"}),
        f"brand:{c}": lambda: sel(localised(t.prd_d_cl_brand, c),
                                 {"brand_id": "br_id", "brand_code": "brand_class_code",
                                  "brand_name": "brand_class_name"}),
        f"currency:{c}": lambda: sel(localised(t.pay_d_cl_currency, c),
                                    {"ccurr_id": "curr_id", "code": "policy_currency"}),
        "rate_by_id": lambda: sel(latest_rates(t.pay_d_exchange, t.pay_t_cis_mena),
                                  {"ccurr_ccurr_id": "xr_ccy", "xRate": "Exchange_Rate"}),
        f"payment_method:{c}": lambda: sel(localised(t.pay_d_cl_payment_method, c),
                                          {"cpaymeth_id": "pmt_id", "description": "payment_method"}),
        "change_link": lambda: sel(t.pol_d_changetype, {"chty_id": "cht_id", "chngty_chngty_id": "cht_type"}),
        f"change_type:{c}": lambda: sel(localised(t.pol_d_cl_change_type, c),
                                       {"chngty_id": "ccht_id", "code": "ccht_code", "name": "ccht_name",
                                        "description": "ccht_desc"}),
        f"coinsurance_type:{c}": lambda: sel(localised(t.prd_d_cl_coinsurance_type, c),
                                            {"coinsty_id": "ct_id", "code": "ct_code"}),
        "version_change_link": lambda: sel(t.inc_t_zmena_typy, {"zme_id": "zt2_id", "czmet_czmet_id": "zt2_czmet"}),
        "version_change_type": lambda: sel(localised(t.inc_v_cis_zmena_typ, FIXED_CULTURE),
                                           {"czmet_id": "c2_id", "popis": "c2_popis", "skratka": "c2_skratka"}),
        f"sales_channel:{c}": lambda: sel(localised(t.par_d_cl_sale_channel, c),
                                         {"schann_id": "sal_id", "code": "sales_channel_code",
                                          "name": "sales_channel_name", "description": "sales_channel_desc"}),
    }


def _dim(t: Tables, key: str, c: int = FIXED_CULTURE) -> DataFrame:
    return t.dims({key: _code_lists(t, c)[key]})[key]


def _rzml_relation(t: Tables) -> Column:
    """The one relation type that makes a policy a member of a group."""
    return single_value(_dim(t, "rzml_relation"), "crel_id")


def _rzml_link(t: Tables) -> Column:
    """The one link type between a contract and its group."""
    return single_value(_dim(t, "rzml_link"), "vztah_id")


def member_policies(t: Tables) -> DataFrame:
    """Valid member -> group relations of the type RZML."""
    return current(t.pol_d_policy_policy).where(F.col("crel_crel_id") == _rzml_relation(t))


def group_links(t: Tables) -> DataFrame:
    """Contract -> group links of the type RZML, valid or not."""
    return t.inc_t_zml_vazby.where(F.col("vztah_vztah_id") == _rzml_link(t))


_COVER_SUMS = ("sum_insured", "premium_annual", "premium_modal", "rate_annual_tariff",
               "premium_annual_discount", "premium_annual_loading")


def cover_rows(t: Tables) -> DataFrame:
    """Cover premiums keyed by the policy they count under: a member's group
    policy (valid member relation of type RZML), else the policy itself."""
    pp = member_policies(t)
    ppr = t.inc_v_policy_premium
    j = ppr.join(pp.select("policy_policy_id", "policy_policy2_id"),
                 ppr.policy_id == pp.policy_policy_id, "left")
    return j.select(F.coalesce("policy_policy2_id", "policy_id").alias("cov_policy_id"), *_COVER_SUMS)


def covers(t: Tables) -> DataFrame:
    """P-09: cover totals per policy, six sums with NULL -> 0."""
    s = sums_nulls_as_zero(cover_rows(t), ["cov_policy_id"], list(_COVER_SUMS))
    return s.select("cov_policy_id", *[F.col(c).cast(D4).alias("cov_" + c) for c in s.columns[1:]])


def paying_rewards(t: Tables) -> DataFrame:
    """F-30: valid non-zero rewards of agents whose type creates pay-outs."""
    agents = semi(t.cms_t_spolupracovnik, _dim(t, "paying_agent_types"),
                  F.col("cspolty_cspolty_id") == F.col("cspolty_id")).select("spoluprac_id")
    rewards = current(t.cms_t_odmena, "platny").where(F.col("suma_netto") != 0)
    return semi(rewards, agents, F.col("spolupracovnik") == F.col("spoluprac_id"))


def known_transactions(t: Tables, tx: DataFrame) -> DataFrame:
    """J-10: transactions whose creating and changing transaction both exist."""
    com = t.com_t_transaction.select("trans_id")
    tx = semi(tx, com, F.col("vznik_id") == F.col("trans_id"))
    return semi(tx, com, F.col("zmena_id") == F.col("trans_id"))


def underwriting_year(renewal: str, inception: str) -> Column:
    """E-01: year of the renewal, else of the inception."""
    return F.year(F.coalesce(renewal, inception))


def commission_by_split(t: Tables, rates: RateTable, needed: DataFrame | None = None) -> DataFrame:
    """P-13: per premium split, the net commission of agents whose type creates
    pay-outs -- in original currency and converted to the agent's currency at the
    case date (NULL -> 0 per reward; a case without rewards gives 0).

    ``needed``: one-column frame of the split ids the caller will look up
    (the splits of the report's window); other cases are dropped first, so a
    one-month report does not aggregate the commission history."""
    rewards = paying_rewards(t)
    cases = current(t.cms_t_proviz_pripad, "platny")
    if needed is not None:
        cases = semi(cases, needed.select(F.col(needed.columns[0]).alias("_need")),
                     F.col("podklad_id") == F.col("_need"))
    j = cases.join(rewards, rewards.prprip_narok_id == cases.prprip_id, "left")
    j = rates.with_rate(j, "origin_currency_id", "date_from", "_r_orig")
    j = rates.with_rate(j, "agent_currency_id", "date_from", "_r_agent")
    conv = converted("suma_netto_origin_currency", "origin_currency_id", "agent_currency_id",
                     "_r_orig", "_r_agent")
    return (j.groupBy("podklad_id")
            .agg(F.sum(F.coalesce(conv, F.lit(0).cast(D6))).cast(D6).alias("broker_commission_home"),
                 F.sum(F.coalesce(F.col("suma_netto_origin_currency"), F.lit(0))).cast(D4)
                 .alias("broker_commission")))


def window_transactions(t: Tables, p: DailyProductionParams) -> DataFrame:
    """Valid prescribed transactions of the scanned window, read from the
    window's month partitions."""
    extra = 0 if p.fix_period_end else 1
    tx = current(t.pay_t_transakcia, "platny").where(F.col("predpis") == 1)
    tx = tx.where(date_part_between("datum_vytvorenia", p.date_from, p.date_to, extra_days=extra))
    return prune_months(tx, "pay_t_transakcia", p.date_from,
                        None if p.date_to is None else p.date_to + _dt.timedelta(days=extra))


def window_policies(t: Tables, p: DailyProductionParams, shown: DataFrame | None = None) -> DataFrame:
    """Superset of the policies a production report can show: the (group or own)
    contracts of the accounts that have a transaction in the scanned window, and of
    those the ones in ``shown``.  Built from narrow columns early in the plan, so the
    per-policy totals keyed on it run concurrently with the premium pipeline."""
    tx = window_transactions(t, p)
    acc = current(t.pay_t_ucet, "platny").select("ucet_id", "id_riad_obj")
    links = current(group_links(t), "platny").select("zml_zml_id", "ku_zmluve_id")
    j = semi(acc, tx.select(F.col("id_riad_ciel").alias("_acct")), F.col("ucet_id") == F.col("_acct"))
    j = j.join(links, F.col("id_riad_obj") == F.col("zml_zml_id"), "left")
    return _of_policies(j.select(F.coalesce("ku_zmluve_id", "id_riad_obj").alias("window_policy_id")),
                        "window_policy_id", shown)


def _of_policies(rows: DataFrame, policy: str | Column, shown: DataFrame | None) -> DataFrame:
    """Rows of the policies in ``shown`` (one column; None: of all)."""
    if shown is None:
        return rows
    key = F.col(policy) if isinstance(policy, str) else policy
    return semi(rows, shown.select(F.col(shown.columns[0]).alias("_shown")), key == F.col("_shown"))


def premium_movements(t: Tables, p: DailyProductionParams, rates: RateTable,
                      shown: DataFrame | None = None) -> DataFrame:
    """P-10: one row per valid prescribed transaction split, with signed amounts,
    versions, commission, periods and in-period flags.

    ``shown``: one-column frame of the policies the caller shows; the accounts of
    others are dropped before their transactions meet anything else."""
    window = window_transactions(t, p)
    accounts = window.select(F.col("id_riad_ciel").alias("_acct"))   # narrow: the window's account keys
    acc = current(t.pay_t_ucet, "platny")
    otype = _dim(t, "contract_object_type")
    acc = semi(acc, otype, F.col("id_tab_obj") == F.col("objtyp_id"))
    contracts = current(t.inc_t_zmluvy, "platny")
    contracts = null_aware_anti(contracts, "zml_id", group_links(t), "ku_zmluve_id",
                                null_safe=p.fix_group_exclusion)
    z = contracts.select("zml_id", F.col("renewal_date").alias("z_renewal"),
                         F.col("datum_zaciatku").alias("z_start"),
                         F.col("aktualny_koniec").alias("z_cur_end"), F.col("datum_konca").alias("z_end"),
                         F.col("datum_uzatvorenia").alias("z_concl"),
                         F.col("date_acceptance").alias("z_accept"))
    zv = current(group_links(t), "platny").select("zml_zml_id", "ku_zmluve_id")
    # one row per account: the account, its contract and the contract's group link
    # (all one-to-one), joined to the window's transactions once; an account with a
    # large share of them is split by salting, counted on the window's keys
    account = (acc.select("ucet_id", "id_riad_obj")
               .join(z, F.col("id_riad_obj") == F.col("zml_id"), "inner")
               .join(zv, F.col("zml_zml_id") == F.col("zml_id"), "left"))
    account = _of_policies(account, F.coalesce("ku_zmluve_id", "zml_id"), shown)
    shown_accounts = account.select("ucet_id")
    # a period's last choice is the contract's own, the others are a version's
    account = semi(account, accounts, F.col("ucet_id") == F.col("_acct")).select(
        "ucet_id", "zml_id", F.coalesce("ku_zmluve_id", "zml_id").alias("policy_id"),
        F.col("ku_zmluve_id").isNotNull().alias("in_group"), F.coalesce("z_renewal", "z_start").alias("z_from"),
        F.coalesce("z_cur_end", "z_end").alias("z_to"), F.coalesce("z_renewal", "z_concl").alias("z_concluded"),
        F.when(F.col("z_renewal").isNotNull(), F.col("z_accept")).otherwise(ts_lit(_HIGH)).alias("z_approval"))
    tx = semi(window, t.pay_t_cis_trans_stav.select("trastav_id"), F.col("trastav_trastav_id") == F.col("trastav_id"))
    tx = tx.select("transa_id", "id_riad_ciel", "vznik_id", "zmena_id", "datum_vytvorenia", "datum_splatnost",
                   (F.col("smer") * F.col("znak_vratka") * F.col("znak_storno")).alias("sign"))
    # the accounts cut the transactions before these are looked up
    j = salted_join(tx, account, "id_riad_ciel", "ucet_id", "inner", hot_source=accounts, hot_key="_acct")
    j = known_transactions(t, j)

    hist = t.inc_t_zmluvy_h
    zh = hist.select(F.col("zmlh_id"), F.col("zml_id").alias("zh_zml_id"),
                     F.col("zmena_id").alias("zh_zmena_id"),
                     F.coalesce("renewal_date", "datum_uzatvorenia").alias("zh_concluded"))
    j = left_join_present(j, zh, [("zml_id", "zh_zml_id"), ("vznik_id", "zh_zmena_id")], ["transa_id"])
    # the group's version, met before the transactions are multiplied by their splits
    gm = current(t.inc_t_group_change_member, "platny").select(
        "member_policy_id", "member_policyh_id", "group_policyh_id")
    j = left_join_present(j, gm, [("zh_zml_id", "member_policy_id"), ("zmlh_id", "member_policyh_id")], ["transa_id"])
    j = j.select("transa_id", "zml_id", "policy_id", "in_group", "zmlh_id", "group_policyh_id", "zh_concluded",
                 "z_from", "z_to", "z_concluded", "z_approval", "datum_vytvorenia", "datum_splatnost", "sign")
    zh2 = hist.where(F.col("ucinny") == 1).select(
        F.col("zmlh_id").alias("zh2_id"), F.col("zml_id").alias("zh2_zml_id"),
        F.col("datum_od").alias("zh2_since"), F.col("datum_do").alias("zh2_until"),
        F.coalesce("renewal_date", "datum_zaciatku").alias("zh2_from"),
        F.coalesce("aktualny_koniec", "datum_konca").alias("zh2_to"))
    # a contract's own versions: those of a month, and the long ones, are searched in the row
    j = interval_join(j, zh2, [("zml_id", "zh2_zml_id")], "datum_splatnost", "zh2_since", "zh2_until", "left")
    # The change-type lookups of both versions are left joins on code-list keys
    # whose columns are not used downstream, so they cannot change the rows.

    # what the report takes from a transaction, before its splits multiply it
    j = j.select(
        "transa_id", "policy_id",
        F.when(F.col("in_group"), F.col("group_policyh_id")).otherwise(F.col("zmlh_id")).alias("policyh_id"),
        F.coalesce("zmlh_id", "zh2_id").alias("policyh_id_orig"), "zmlh_id", "datum_vytvorenia", "sign",
        F.coalesce("zh2_from", "z_from").alias("period_from"), F.coalesce("zh2_to", "z_to").alias("period_to"),
        F.coalesce("zh_concluded", "z_concluded").alias("policy_conclusion"),
        F.when(F.col("zmlh_id").isNotNull(), F.col("datum_vytvorenia"))
        .otherwise(F.col("z_approval")).alias("policy_approval"))
    splits = current(t.pay_t_trans_rozpad, "platny").where(F.col("suma") != 0).select(
        "traroz_id", "transa_transa_id", F.col("suma").alias("tr_suma"),
        F.col("sum_home_currency").alias("tr_home"), "datum_od")
    j = j.join(splits, F.col("transa_transa_id") == F.col("transa_id"), "inner")
    # commission only for the splits of the window's transactions
    window_tx = window.select(F.col("transa_id").alias("_tx"), F.col("id_riad_ciel").alias("_tx_acct"))
    if shown is not None:
        window_tx = semi(window_tx, shown_accounts, F.col("_tx_acct") == F.col("ucet_id"))
    window_splits = semi(splits.select("traroz_id", "transa_transa_id"), window_tx.select("_tx"),
                         F.col("transa_transa_id") == F.col("_tx")).select("traroz_id")
    j = j.join(commission_by_split(t, rates, window_splits), F.col("podklad_id") == F.col("traroz_id"), "left")

    return j.select(
        "policy_id", "policyh_id", "policyh_id_orig", "zmlh_id",
        date_only("datum_vytvorenia").alias("creation_date"),
        date_only("datum_od").alias("to_date"),
        F.coalesce(F.col("tr_suma") * F.col("sign"), F.lit(0)).cast(D4).alias("premium_gross"),
        F.coalesce(F.col("tr_home") * F.col("sign"), F.lit(0)).cast(D4).alias("premium_gross_home"),
        F.col("transa_id"),
        *([F.coalesce("broker_commission_home", F.lit(0).cast(D6)).alias("broker_commission_home"),
           F.coalesce("broker_commission", F.lit(0).cast(D4)).alias("broker_commission")]
          if p.fix_commission_nulls else [F.col("broker_commission_home"), F.col("broker_commission")]),
        "period_from", "period_to", "policy_conclusion", "policy_approval",
        year_month("datum_vytvorenia").alias("creation_month"),
        F.col("datum_vytvorenia").alias("creation_datetime"),
        in_period_flag("datum_vytvorenia", p.date_from, p.date_to).alias("created_in_period"),
        in_period_flag("datum_od", p.date_from, p.date_to).alias("duedate_in_period"))


def _premium_aggs(first_level: bool) -> list[Column]:
    created = F.col("created_in_period") == 1
    low_d = F.lit(LOW_DATE)
    low_ts = ts_lit(LOW_DATE)
    aggs = [
        F.max("policyh_id").alias("policyh_id"),
        F.max("zmlh_id" if first_level else "policyh_trans_id").alias("policyh_trans_id"),
        F.max("to_date").alias("to_date_max"),
        F.max("period_from").alias("period_from_max"),
        F.max("period_to").alias("period_to_max"),
        F.max(F.when(created, F.col("creation_date")).otherwise(low_d)).alias("creation_date"),
        F.max(F.when(created, F.col("creation_datetime")).otherwise(low_ts)).alias("creation_datetime"),
        F.max("creation_month").alias("creation_month"),
        F.max("transa_id" if first_level else "max_transa_id").alias("max_transa_id"),
        F.max("created_in_period").alias("created_in_period"),
        F.max("duedate_in_period").alias("duedate_in_period"),
        F.min("policy_conclusion").alias("policy_conclusion"),
        F.min("policy_approval").alias("policy_approval"),
        F.sum("premium_gross").cast(D4).alias("premium_gross"),
        F.sum("premium_gross_home").cast(D4).alias("premium_gross_home"),
        F.sum("broker_commission").cast(D4).alias("broker_commission"),
        F.sum("broker_commission_home").cast(D6).alias("broker_commission_home"),
        F.sum(F.col("premium_gross") - F.col("broker_commission")).cast(D4).alias("premium_net"),
        (F.sum("premium_gross") - F.sum("broker_commission")).cast(D4).alias("premium_net1"),
        F.sum(F.col("premium_gross_home") - F.col("broker_commission_home")).cast(D6).alias("premium_net_home"),
    ]
    if not first_level:
        aggs.insert(1, F.max("policyh_orig_id").alias("policyh_orig_id"))
    return aggs


def _keep_nonzero(df: DataFrame) -> DataFrame:
    """F-26 / A-04: HAVING SUM(gross) <> 0 OR SUM(commission) <> 0 (NULL = unknown)."""
    return df.where((F.col("premium_gross") != 0) | (F.col("broker_commission") != 0))


def premium_level1(movements: DataFrame) -> DataFrame:
    """P-11: per policy and originating version."""
    g = movements.groupBy("policy_id", F.col("policyh_id_orig").alias("policyh_orig_id")).agg(*_premium_aggs(True))
    g = g.withColumnRenamed("to_date_max", "to_date").withColumnRenamed("period_from_max", "period_from") \
         .withColumnRenamed("period_to_max", "period_to")
    return _keep_nonzero(g)


def premium_level2(level1: DataFrame) -> DataFrame:
    """P-12: per policy, due date and period; measures re-aggregated from level 1."""
    g = level1.groupBy("policy_id", "to_date", "period_from", "period_to").agg(*_premium_aggs(False))
    return _keep_nonzero(g.drop("to_date_max", "period_from_max", "period_to_max"))


def coinsurance_rows(t: Tables) -> DataFrame:
    """Valid co-insurance ratios of a policy with the owner behind the partner, if any."""
    pc = current(t.pol_d_policy_coinsurance)
    owners = current(t.par_d_owner_is).select(F.col("partner_partner_id").alias("o_partner"), "owner_id")
    return pc.join(owners, F.col("partner_partner_id") == F.col("o_partner"), "left").select(
        F.col("policy_policy_id").alias("cs_policy_id"), "ratio", "owner_id")


def _coinsurance_aggs() -> list[Column]:
    return [sum_when_null(F.col("ratio"), F.col("owner_id"), True).cast(D4).alias("coins_coins_perc"),
            sum_when_null(F.col("ratio"), F.col("owner_id"), False).cast(D4).alias("owner_coins_perc")]


def coinsurance_shares(t: Tables) -> DataFrame:
    """P-14: per policy the co-insurers' share (partner not an owner) and the own share."""
    return coinsurance_rows(t).groupBy("cs_policy_id").agg(*_coinsurance_aggs())


def certificate_rows(t: Tables, policy_id: int | None) -> DataFrame:
    """Certificate / sticker parameters of valid covers: code and the shown text
    (option description preferred to the raw value)."""
    c = current(t.pol_d_cover)
    if policy_id is not None:
        c = c.where(F.col("policy_policy_id") == F.lit(policy_id))
    c = semi(c, _dim(t, "certificate_status"), F.col("polst_polst_id") == F.col("polst_id"))
    c = semi(c, t.prd_d_element.select("elm_id"), F.col("elm_elm_id") == F.col("elm_id"))
    pp = t.pol_d_cover_parameter.select("cover_cover_id", "elmprm_elmprm_id", F.col("value").alias("pp_value"))
    ep = t.prd_d_element_parameter.select("elmprm_id", "param_param_id")
    prm = t.prd_d_parameter.select("param_id", F.col("code").alias("p_code"))
    opt = current(t.prd_d_param_option_h).select(
        F.col("param_root_id"), F.col("value").alias("o_value"), F.col("description").alias("o_desc"))
    j = (c.join(pp, F.col("cover_cover_id") == F.col("cover_id"), "inner")
         .join(ep, F.col("elmprm_id") == F.col("elmprm_elmprm_id"), "inner")
         .join(prm, F.col("param_id") == F.col("param_param_id"), "inner")
         .join(opt, (F.col("param_root_id") == F.col("param_id")) & (F.col("o_value") == F.col("pp_value")),
               "left"))
    shown = F.when(F.col("o_value").isNotNull(), F.col("o_desc")).otherwise(F.col("pp_value"))
    return j.select(F.col("policy_policy_id").alias("elm_policy_id"), "p_code", shown.alias("shown"))


def _certificate_aggs() -> list[Column]:
    return [max_when("p_code", pat, F.col("shown"), F.lit("")).alias(name) for name, pat in CERTIFICATE_CODES.items()]


def certificates(t: Tables, policy_id: int | None) -> DataFrame:
    """P-15: certificate / sticker parameters pivoted to five columns per policy, '' when absent."""
    return certificate_rows(t, policy_id).groupBy("elm_policy_id").agg(*_certificate_aggs())


def policy_totals(t: Tables, certificate_policy_id: int | None, policies: DataFrame) -> DataFrame:
    """P-09, P-14 and P-15 of the given policies with one key filter and one
    aggregate: the three kinds of rows are stacked, so each column is NULL for a
    policy without rows of its kind, as after three left joins."""
    kinds = [(cover_rows(t), "cov_policy_id"), (coinsurance_rows(t), "cs_policy_id"),
             (certificate_rows(t, certificate_policy_id), "elm_policy_id")]
    stacked = None
    for kind, (rows, key) in enumerate(kinds):
        own = rows.withColumnRenamed(key, "tot_policy_id").withColumn("_kind", F.lit(kind))
        stacked = own if stacked is None else stacked.unionByName(own, allowMissingColumns=True)
    stacked = semi(stacked, policies.select(F.col(policies.columns[0]).alias("_need")),
                   F.col("tot_policy_id") == F.col("_need"))

    def of(kind: int, value: Column) -> Column:
        return F.when(F.col("_kind") == kind, value)

    cov = [F.sum(of(0, F.coalesce(F.col(c), F.lit(0)))).cast(D4).alias("cov_" + c) for c in _COVER_SUMS]
    sign = F.when(F.col("owner_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    coins = [F.sum(of(1, F.col("ratio") * sign)).cast(D4).alias("coins_coins_perc")]
    cert = [F.max(of(2, F.when(F.col("p_code").like(pat), F.col("shown")).otherwise(F.lit("")))).alias(name)
            for name, pat in CERTIFICATE_CODES.items()]
    return stacked.groupBy("tot_policy_id").agg(*cov, *coins, *cert)


# ------------------------------------------------------------- named rules
def endorsement_type(status: Column, change: Column, to_date: Column, renewal: Column, inception: Column) -> Column:
    """E-19: class of a version change, from its status, change type and dates."""
    return (F.when(status.like("S%"), F.lit("CANCELLATION"))
            .when(status.like("Z%") & (to_date.cast(TS) == renewal) & change.isin(*RENEWAL_CHANGES), F.lit("RENEWAL"))
            .when(status.like("Z%") & (to_date == F.to_date(inception)) & change.isin(*NEW_POLICY_CHANGES),
                  F.lit("NEW POLICY"))
            .otherwise(F.lit("ENDORSEMENT")))


def transaction_type(coinsurance_code: Column) -> Column:
    """E-20: direct, co-insured or facultative inward business."""
    return (F.when(coinsurance_code.isNull(), F.lit("Direct business"))
            .when(coinsurance_code.like("LEAD%"), F.lit("Direct with Co. Insurance"))
            .when(coinsurance_code == "FOLW", F.lit("Co. Insurance"))
            .when(coinsurance_code == "FACIN", F.lit("FAC Inward")))


def approval_status(status_code: Column) -> Column:
    """E-21: the policy status in words."""
    return (F.when(status_code.like("Z%"), F.lit("Approved")).when(status_code.like("Sns"), F.lit("Refused"))
            .when(status_code.like("C%"), F.lit("Proposal")).otherwise(F.lit("Approved")))


# ------------------------------------------------------------------- R-04
def daily_production(t: Tables, p: DailyProductionParams) -> DataFrame:
    """R-04: one row per policy version change with gross/net premium, commission,
    co-insurance share, endorsement classification and certificate numbers."""
    c = p.culture_id
    dims = t.dims(_code_lists(t, c))
    rates = RateTable(t.pay_d_exchange, owner=p.sysown_id)
    pt, ps, ou = dims[f"policy_type:{c}"], dims[f"policy_status:{c}"], dims[f"book_unit:{c}"]
    pr, br, curr = dims["product"], dims[f"brand:{c}"], dims[f"currency:{c}"]
    xr, pm, cht = dims["rate_by_id"], dims[f"payment_method:{c}"], dims["change_link"]
    ccht, ct = dims[f"change_type:{c}"], dims[f"coinsurance_type:{c}"]
    zt2, c2 = dims["version_change_link"], dims["version_change_type"]
    sal = dims[f"sales_channel:{c}"]
    col = F.col

    # filter on the basis date
    lo = ts_lit(p.date_from if p.date_from is not None else LOW_DATE)
    hi = ts_lit(p.date_to if p.date_to is not None else _HIGH)

    def in_basis(*dates: str) -> Column:
        d = F.to_date(F.coalesce(*dates)).cast(TS)
        return (lo <= d) & (hi >= d)

    # the versions the parameters allow, and the policies that have one: everything
    # else is cut to these policies before it is shuffled or added up
    ci = p.string_compare == CASE_INSENSITIVE
    of_branch = optional_nonempty_eq("ou_code", p.branch, ci)
    of_product = [x for x in (None if p.sysown_id is None else col("pr_sysown") == F.lit(p.sysown_id),
                              None if not p.class_code else code_eq(class_of("pr_code"), p.class_code, ci),
                              optional_nonempty_eq("pr_code", p.product, ci)) if x is not None]
    pol = semi(current(t.pol_d_policy_h).where(col("effective") == 1), pt, col("polty_polty_id") == col("pt_id"))
    if of_branch is not None:
        ou = ou.where(of_branch)
        pol = semi(pol, ou, col("orgunit_orgunit_book_id") == col("ou_id"))
    if of_product:
        pr = where_all(pr, *of_product)
        pol = semi(pol, pr, col("prod_prod_id") == col("pr_id"))
    if p.basic_date == "C":
        pol = pol.where(in_basis("date_renewal", "date_conclusion"))
    shown = pol.select("policy_id").distinct()

    prem = premium_level2(premium_level1(premium_movements(t, p, rates, shown)))
    prem = prem.where(F.col("created_in_period") == 1)     # the sums are filtered by level 2 itself
    prem = prem.select(*[F.col(x).alias("pm_" + x) for x in prem.columns])
    pol = pol.select("policyh_id", "policy_id", "polty_polty_id", "polst_polst_id", "orgunit_orgunit_book_id",
                     "prod_prod_id", "ccurr_ccurr_id", "cpaymet_cpaymet_id", "chty_chty_id", "coinsty_coinsty_id",
                     "policy_number", "acquisition_commission_pct", "date_version_from", "date_version_to",
                     "date_inception", "date_renewal", "date_conclusion")
    j = interval_join(prem, pol, [("pm_policy_id", "policy_id")],
                      F.col("pm_to_date").cast(TS), "date_version_from", "date_version_to", "inner")

    # policy-keyed lookups, on the key the rows are dealt by already
    hist = t.inc_v_policy_history.select(*[F.col(x).alias("h_" + x) for x in t.inc_v_policy_history.columns])
    # per-policy totals only for the policies of the window's accounts (a key set
    # built early from narrow columns, so these aggregates run concurrently with
    # the premium pipeline instead of over the whole policy history)
    totals = policy_totals(t, p.certificate_policy_id, window_policies(t, p, shown))
    j = (j.join(hist, col("pm_policy_id") == col("h_policy_id"), "left")
         .join(totals, col("pm_policy_id") == col("tot_policy_id"), "left"))
    # originating version's change type
    orig_change = t.inc_t_zmluvy_h.select(F.col("zmlh_id").alias("oc_id"), F.col("zme_zme_id").alias("oc_zme"))
    j = j.join(orig_change, col("pm_policyh_orig_id") == col("oc_id"), "left")
    # endorsement lookups (table functions of the reference, as keyed left joins)
    endors = localised(t.inc_v_policy_endorsements, c)
    endors = endors.select(*[F.col(x).alias("e_" + x) for x in endors.columns])
    ifn = localised(t.inc_v_policy_endorsements1, c).select(
        F.col("policy_id").alias("f_policy_id"), F.col("endors_date").alias("f_date"),
        F.col("time_stamp").alias("time_stamp"), F.col("date_version_from").alias("f_date_version_from"))
    j = (j.join(endors, (col("e_policyh_id") == col("pm_policyh_orig_id"))
                & (col("e_endors_date") == col("pm_creation_date")), "left")
         .join(ifn, (col("f_policy_id") == col("pm_policy_id")) & (col("f_date") == col("pm_creation_date")),
               "left"))
    if p.basic_date == "I":
        j = j.where(in_basis("e_date_version_from", "f_date_version_from", "h_top_version_date_version_from"))
    elif p.basic_date not in ("A", "C"):
        j = j.where(F.lit(False))
    j = j.withColumn("_ver_policy", F.coalesce("e_policy_id", "policy_id")) \
         .withColumn("_ver_id", F.coalesce("e_policyh_id", "policyh_id"))
    par = t.pol_policy_histver_partners
    par = par.select(*[F.col(x).alias("par_" + x) for x in par.columns])
    par = where_all(par, contains_pattern("par_ma_code", p.marketer, ci))
    premh = t.inc_v_policy_premium_h.select(F.col("policyh_id").alias("ph_id"),
                                            F.col("sum_insured").alias("ph_sum_insured"))
    j = (j.join(par, (col("par_policy_id") == col("_ver_policy")) & (col("par_policyh_id") == col("_ver_id")),
                "left" if p.marketer is None else "inner")
         .join(premh, col("ph_id") == col("_ver_id"), "left"))
    # code lists last: their texts are not carried through the shuffles
    j = (j.join(pt, col("polty_polty_id") == col("pt_id"), "inner")
         .join(ps, col("polst_polst_id") == col("ps_id"), "inner")
         .join(ou, col("orgunit_orgunit_book_id") == col("ou_id"), "inner")
         .join(pr, col("prod_prod_id") == col("pr_id"), "inner")
         .join(br, col("pr_brand") == col("br_id"), "left")
         .join(curr, col("ccurr_ccurr_id") == col("curr_id"), "inner")
         .join(xr, col("curr_id") == col("xr_ccy"), "left")
         .join(pm, col("cpaymet_cpaymet_id") == col("pmt_id"), "left")
         .join(cht, col("chty_chty_id") == col("cht_id"), "inner")
         .join(ccht, col("cht_type") == col("ccht_id"), "inner")
         .join(zt2, col("oc_zme") == col("zt2_id"), "left")
         .join(c2, col("zt2_czmet") == col("c2_id"), "left")
         .join(ct, col("coinsty_coinsty_id") == col("ct_id"), "left")
         .join(sal, col("e_sales_channel_id") == col("sal_id"), "left"))

    # currency conversions at the premium's due date
    j = j.withColumn("_at", col("pm_to_date").cast(TS))
    j = rates.with_rate(j, "curr_id", "_at", "_r_pol")
    j = rates.with_rate(j, GHS_CCY_ID, "_at", "_r_ghs")

    def to_home(amount: Column) -> Column:
        return converted(amount, "curr_id", F.lit(HOME_CCY_ID).cast("bigint"), "_r_pol", F.lit(1))

    def to_ghs(amount: Column) -> Column:
        return converted(amount, "curr_id", F.lit(GHS_CCY_ID).cast("bigint"), "_r_pol", "_r_ghs")

    status = F.coalesce("e_policy_status_code", "ps_code")
    change = F.coalesce("e_change_type_code", "ccht_code")
    gross_home = F.coalesce("pm_premium_gross_home", "cov_premium_modal")
    net_home = F.coalesce("pm_premium_net_home", "cov_premium_modal")
    coins = F.coalesce(col("coins_coins_perc").cast("double") / 100, F.lit(0.0))

    def pct(x: Column) -> Column:
        return (x.cast("double") * coins).cast(D6)

    return j.select(
        col("policyh_id"), col("policy_id"), col("policy_number").alias("policy_no"), col("policy_type"),
        col("pm_policyh_orig_id").alias("policyh_orig_id"), col("pm_policyh_trans_id").alias("policyh_trans_id"),
        class_of("pr_code").alias("class_code"), col("pr_code").alias("product_code"),
        col("pr_name").alias("product_name"), col("ou_code").alias("branch_code"),
        col("ou_abbrev").alias("branch_abbrev"), col("ou_name").alias("branch_name"),
        col("par_ph_partner_id").alias("assured_partner_id"), col("par_ph_customer_id").alias("customer_id"),
        col("par_ph_firstname").alias("assured_partner_firstname"),
        col("par_ph_middlename").alias("assured_partner_middlename"),
        col("par_ph_surname").alias("assured_partner_surname"),
        underwriting_year("date_renewal", "date_inception").alias("UW_Year"),
        col("h_appr_user_desc").alias("policy_issuance"), col("pm_policy_conclusion").alias("policy_conclusion"),
        F.when(col("pm_policy_approval") == ts_lit(_HIGH), col("h_appr_timestamp"))
        .otherwise(col("pm_policy_approval")).alias("policy_approval"),
        col("pm_period_from").alias("period_from"), col("pm_period_to").alias("period_to"),
        col("par_br_partner_id").alias("broker_partner_id"), col("par_br_code").alias("broker_code"),
        col("par_br_firstname").alias("broker_partner_firstname"),
        col("par_br_middlename").alias("broker_partner_middlename"),
        col("par_br_surname").alias("broker_partner_surname"),
        "sales_channel_code", "sales_channel_name", "sales_channel_desc",
        col("pm_max_transa_id").alias("invoice_number"), col("pm_to_date").alias("trans_date"),
        col("pm_creation_date").alias("creation_date"), col("pm_creation_datetime").alias("creation_datetime"),
        F.when(col("e_policy_id").isNotNull(), col("e_endors_order"))
        .otherwise(col("h_top_version_endors_order")).alias("endorsement_no"),
        F.coalesce("e_change_type_id", "ccht_id").alias("change_type_id"),
        F.coalesce("e_change_type_name", "c2_skratka", "ccht_name").alias("change_type_code"),
        F.coalesce("e_change_type_desc", "c2_popis", "ccht_desc").alias("change_type_desc"),
        gross_home.alias("gross_premium"),
        F.coalesce("e_change_type_desc", "ccht_desc").alias("change_type_name"),
        endorsement_type(status, change, col("pm_to_date"), col("date_renewal"), col("date_inception")).alias("endorsement_type"),
        F.coalesce("ph_sum_insured", "cov_sum_insured").cast(D4).alias("sum_insured_orig"),
        col("cov_premium_annual").alias("annual_gross_premium_orig"), col("policy_currency"),
        to_home(F.coalesce("ph_sum_insured", "cov_sum_insured")).alias("sum_insured"),
        to_home(col("cov_premium_annual")).alias("annual_gross_premium"),
        to_ghs(col("cov_sum_insured")).alias("sum_insured_GHS"),
        to_ghs(col("cov_premium_annual")).alias("annual_gross_premium_GHS"),
        to_ghs(col("pm_broker_commission")).alias("broker_commission_GHS"),
        to_ghs(col("cov_premium_modal")).alias("Net_Premium_GHS"),
        F.coalesce("pm_premium_gross", "cov_premium_modal").alias("gross_premium_orig"),
        col("pm_broker_commission").alias("broker_commission_orig"),
        F.coalesce("pm_premium_net", "cov_premium_modal").alias("net_premium_orig"),
        col("pm_broker_commission_home").alias("broker_commission"),
        net_home.cast(D6).alias("net_premium"),
        F.coalesce(col("acquisition_commission_pct").cast("double") / 100, F.lit(0.0)).cast(D6)
        .alias("broker_commision_perc"),
        F.coalesce(col("coins_coins_perc"), F.lit(0).cast(D4)).alias("coins_perc"),
        pct(gross_home).alias("coins_share_gross_premium"), pct(net_home).alias("coins_share_net_premium"),
        transaction_type(col("ct_code")).alias("trans_type"),
        col("par_ma_partner_id").alias("marketer_partner_id"), col("par_ma_code").alias("marketer_code"),
        col("par_ma_firstname").alias("marketer_firstname"), col("par_ma_middlename").alias("marketer_middlename"),
        col("par_ma_surname").alias("marketer_surname"), approval_status(col("ps_code")).alias("approval_status"),
        status.alias("policy_status_code"),
        F.coalesce("e_policy_status_name", "ps_name").alias("policy_status_name"),
        F.coalesce("e_policy_status_desc", "ps_desc").alias("policy_status_desc"),
        F.coalesce("h_entry_user_login", "e_user_login").alias("policy_initiator_user_login"),
        F.coalesce("h_entry_user_desc", "e_user_desc").alias("policy_initiator_user_name"),
        F.coalesce("e_maker_time_stamp", "h_entry_timestamp").alias("maker_timestamp"),
        F.coalesce("e_maker_user_id", "h_entry_user_id").alias("maker_user_id"),
        F.coalesce("e_maker_user_login", "h_entry_user_login").alias("maker_user_login"),
        F.coalesce("e_maker_user_desc", "h_entry_user_desc").alias("maker_user_desc"),
        F.coalesce("e_user_id", "h_top_version_user_id").alias("checker_user_id"),
        F.coalesce("e_user_login", "h_top_version_user_login").alias("checker_user_login"),
        F.coalesce("e_user_desc", "h_top_version_user_desc").alias("checker_user_desc"),
        F.coalesce("e_checker_time_stamp", "h_top_version_timestamp").alias("checker_time_stamp"),
        col("h_top_version_timestamp").alias("checker_top_ver_time_stamp"),
        *[F.col(n) for n in CERTIFICATE_CODES],
        "payment_method", "Exchange_Rate", "brand_class_code", "brand_class_name",
        F.lit(p.basic_date).cast(STR).alias("BasicDate"), ts_lit(p.date_from).alias("date_from"),
        ts_lit(p.date_to).alias("date_to"), col("e_checker_time_stamp").alias("endors_checker_time_stamp"),
        col("h_top_version_timestamp").alias("top_version_timestamp"), col("time_stamp"),
        col("e_policyh_id").alias("endors_policyh_id"), col("policyh_id").alias("pol_policyh_id"))
