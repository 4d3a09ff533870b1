"""Logical insurance tables derived from the driver's TPC-H-like parquet data.

The reports read ~75 insurance tables (claims, policies, payments, code lists).
The test data only has TPC-H-like tables, so each logical table is derived here
from them with integer rules (FIXTURES.md section 3).  Every derivation is one
SQL statement written once and rendered for two engines:

* Spark: ``spark.sql(text, orders=df, ...)`` -- the ``{orders}`` placeholders are
  bound to DataFrames, so nothing global is registered;
* DuckDB: the same text with ``{orders}`` replaced by the driver view name; the
  oracle SQL of ``__spark_entry__`` embeds these as CTEs.

Every derivation is a projection, a grouped aggregate or a window partitioned
by a business key over all driver rows: optional detail is expressed by
validity flags, NULL keys and keys without a parent, not by dropping rows.  Money is
DECIMAL(19,4), rates DECIMAL(19,8); amounts are cast to decimal *before* any
sum so that both engines produce exactly the same values.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

MONEY = "DECIMAL(19,4)"
RATE = "DECIMAL(19,8)"


@dataclass(frozen=True)
class Dialect:
    name: str
    text: str

    def ts(self, s: str) -> str:
        kw = "TIMESTAMP_NTZ" if self.name == "spark" else "TIMESTAMP"
        return f"{kw} '{s} 00:00:00'"

    def add_days(self, e: str, n: str) -> str:
        if self.name == "spark":
            return f"timestampadd(DAY, {n}, {e})"
        return f"({e} + to_days(CAST({n} AS INTEGER)))"

    def add_hours(self, e: str, n: str) -> str:
        if self.name == "spark":
            return f"timestampadd(HOUR, {n}, {e})"
        return f"({e} + to_hours(CAST({n} AS BIGINT)))"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def s(self, e: str) -> str:
        return f"CAST({e} AS {self.text})"


SPARK = Dialect("spark", "STRING")
DUCKDB = Dialect("duckdb", "VARCHAR")

# Culture ids used by localised code lists and views: every localised row
# exists once per culture, so a missing culture filter doubles rows.
CULTURES = (3, 1)


def _values(cols: list[tuple[str, str]], rows: list[tuple]) -> str:
    """Inline code list; ``cols`` = [(name, sql type)]."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(c for c, _ in cols)
    proj = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in cols)
    return f"SELECT {proj} FROM (VALUES {body}) AS v({names})"


def _localise(sql: str) -> str:
    arms = [f"SELECT s.*, CAST({c} AS BIGINT) AS culture_id FROM ({sql}) AS s"
            for c in CULTURES]
    return " UNION ALL ".join(arms)


def _ccy_code(expr: str) -> str:
    return (f"CASE {expr} % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GHS' "
            f"WHEN 3 THEN 'GBP' ELSE 'NGN' END")


def _ccy_id(expr: str) -> str:
    return (f"CAST(CASE {expr} % 5 WHEN 0 THEN 41 WHEN 1 THEN 42 WHEN 2 THEN 49 "
            f"WHEN 3 THEN 44 ELSE 45 END AS BIGINT)")


def _m(e: str) -> str:
    return f"CAST({e} AS {MONEY})"


def _known(rule: str, key: str) -> str:
    """``key`` where the rule holds, otherwise a key that no parent row has:
    every driver row is kept, and the left joins still meet misses."""
    return f"CASE WHEN {rule} THEN {key} ELSE -({key}) END"


def _split_id(alias: str = "") -> str:
    p = alias + "." if alias else ""
    return (f"({p}l_orderkey * 100000 + {p}l_linenumber * 10000 + {p}l_partkey % 10000)")


def definitions(d: Dialect) -> dict[str, str]:
    """Logical table name -> SQL over ``{driver}`` placeholders."""
    T = d.ts
    s = d.s
    defs: dict[str, str] = {}

    # ---------------------------------------------------------------- claims
    defs["clm_d_claim"] = f"""
SELECT o_orderkey AS claim_id,
       o_custkey AS policy_policy_id,
       CAST(CASE WHEN o_orderkey % 5 = 0 THEN 100 + {d.idiv('o_orderkey', '5')} % 5
                 ELSE o_orderkey % 25 END AS BIGINT) AS orgunit_admin_id,
       CAST({d.idiv('o_orderkey', '3')} % 25 AS BIGINT) AS orgunit_accounting_id,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 4 WHEN o_orderkey % 11 = 0 THEN 5
                 WHEN o_orderkey % 13 = 0 THEN 6 WHEN o_orderstatus = 'F' THEN 1
                 WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS BIGINT) AS cclmst_cclmst_id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey END AS losntf_losntf_id,
       o_orderkey % 120 AS adjuster,
       'CL' || {s('o_orderkey')} AS clmno,
       'V' || {s('o_orderkey')} AS payment_identifier,
       {d.add_hours(d.add_days('o_orderdate', 'o_orderkey % 30'), 'o_orderkey % 24')} AS notification_date,
       o_orderdate AS occurence_date,
       CASE WHEN o_orderstatus = 'F' THEN {d.add_days('o_orderdate', '60 + o_orderkey % 90')} END AS settlement_date,
       {d.add_days('o_orderdate', 'o_orderkey % 30 + 2')} AS registration_date,
       CAST(CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE 1 END AS INT) AS valid
FROM {{orders}}"""

    defs["clm_d_cl_claim_st"] = _localise(_values(
        [("cclmst_id", "BIGINT"), ("code", d.text), ("description", d.text)],
        [(1, "U", "Settled"), (2, "R", "Registered"), (3, "SP", "In settlement"),
         (4, "ZO", "Reopened"), (5, "B", "Rejected"), (6, "Z", "Closed")]))

    defs["clm_d_loss_notification"] = f"""
SELECT o_orderkey AS losntf_id,
       'Street ' || {s('o_custkey % 97')} AS address_street,
       {s('o_orderkey % 200')} AS address_house_number1,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {s('o_orderkey % 7')} END AS address_house_number2,
       'City ' || {s('o_custkey % 13')} AS address_city,
       lpad({s('o_custkey % 1000')}, 5, '0') AS postal_code,
       o_orderpriority AS occurence_place_description,
       'Loss on order ' || {s('o_orderkey')} AS loss_description,
       CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 1 END AS INT) AS valid
FROM {{orders}}"""

    defs["par_d_cl_org_unit"] = _localise(f"""
SELECT CAST(100 + r_regionkey AS BIGINT) AS orgunit_id, CAST(NULL AS BIGINT) AS orgunit_orgunit_id,
       CAST(1 AS BIGINT) AS orglvl_orglvl_id, 'BR' || {s('r_regionkey')} AS code,
       'R' || {s('r_regionkey')} AS abbrev, r_name AS name
FROM {{region}}
UNION ALL
SELECT CAST(n_nationkey AS BIGINT), CAST(100 + n_regionkey AS BIGINT), CAST(2 AS BIGINT),
       'DP' || {s('n_nationkey')}, 'N' || {s('n_nationkey')}, n_name
FROM {{nation}}""")

    defs["par_d_cl_org_level"] = _localise(_values(
        [("orglvl_id", "BIGINT"), ("level_no", "INT"), ("name", d.text)],
        [(1, 1, "Branch"), (2, 2, "Department")]))

    defs["par_d_partner"] = f"""
SELECT s_suppkey AS partner_id, CAST(CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END AS INT) AS valid
FROM {{supplier}}"""
    defs["par_d_physical_person"] = f"""
SELECT {_known('s_suppkey % 2 = 0', 's_suppkey')} AS partner_root_id, 'First' || {s('s_suppkey')} AS first_name, s_name AS surname,
       CAST(CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE 1 END AS INT) AS valid
FROM {{supplier}}"""
    defs["par_d_legal_person"] = f"""
SELECT {_known('s_suppkey % 2 = 1 OR s_suppkey % 6 = 0', 's_suppkey')} AS partner_root_id, s_name || ' Ltd' AS name, CAST(1 AS INT) AS valid
FROM {{supplier}}"""

    # --------------------------------------------------------------- policies
    defs["clm_dx_policy"] = _localise(f"""
SELECT c_custkey AS policy_id, 'P' || {s('c_custkey')} AS policy_number,
       substr(c_mktsegment, 1, 2) || lpad({s('c_nationkey % 4')}, 2, '0') AS product_code,
       c_mktsegment AS product_name, substr(c_mktsegment, 1, 2) AS product_brand_code,
       {_ccy_code('c_custkey')} AS currency_code,
       CASE WHEN c_custkey % 10 = 0 THEN 'Life' ELSE 'General' END AS sysowner,
       CASE WHEN c_custkey % 10 = 0 THEN 'LIFE' ELSE 'NONLIFE' END AS sysowner_code,
       'Office ' || {s('c_nationkey')} AS orgunit_name,
       'N' || {s('c_nationkey % 25')} AS acc_orgunit_name,
       'Accounting ' || {s('c_nationkey')} AS acc_orgunit_description,
       CAST(1995 + c_custkey % 7 AS INT) AS uw_year,
       {d.add_days(T('1995-01-01'), 'c_custkey % 365')} AS date_inception,
       {d.add_days(T('1995-01-01'), 'c_custkey % 365 + 365')} AS date_maturity
FROM {{customer}}""")

    defs["pol_dx_policy_booking"] = f"""
SELECT {_known('c_custkey % 23 <> 0', 'c_custkey')} AS policy_id, 'BK' || {s('c_nationkey % 5')} AS orgunit_book_code
FROM {{customer}}"""
    defs["clm_dx_premium"] = f"""
SELECT {_known('c_custkey % 7 <> 3', 'c_custkey')} AS policy_policy_id, {_m('c_acctbal')} AS annual_premium,
       {_m('c_custkey * 1000')} AS insured_sum
FROM {{customer}}"""
    defs["clm_dx_policy_partner"] = f"""
SELECT c_custkey AS policy_id,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS assured_pers,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Insured ' || {s('c_custkey')} END AS insured_pers,
       'Agent ' || {s('c_custkey % 40')} AS agent, 'AG' || {s('c_custkey % 40')} AS agent_number
FROM {{customer}}"""

    # ------------------------------------------------------- claim detail views
    flag = "CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END"
    defs["clm_dx_reserve"] = _localise(f"""
SELECT l_orderkey AS claim_id, CAST({flag} AS INT) AS indemnity,
       {_m(f"sum(CASE WHEN l_returnflag <> 'R' THEN {_m('l_extendedprice')} END)")} AS indemnity_reserve_balance,
       {_m(f"sum(CASE WHEN l_returnflag = 'R' THEN {_m('l_extendedprice')} END)")} AS extcost_reserve_balance,
       max(l_shipdate) AS indemnity_reserve_change_date
FROM {{lineitem}} GROUP BY l_orderkey, {flag}""")
    defs["clm_dx_payout"] = _localise(f"""
SELECT CASE WHEN l_linestatus = 'F' THEN l_orderkey END AS claim_id,
       {_m(f"sum(CASE WHEN l_returnflag <> 'A' THEN {_m('l_extendedprice')} END)")} AS amount_paid_indemnity,
       {_m(f"sum(CASE WHEN l_returnflag = 'A' THEN {_m('l_extendedprice')} END)")} AS amount_paid_extcost,
       'Payee ' || {s('l_orderkey % 31')} AS payee,
       'Bank transfer' AS paymethod_indemnity, 'Cheque' AS paymethod_extcost
FROM {{lineitem}} GROUP BY l_orderkey, l_linestatus""")
    defs["clm_dx_payout_ind"] = _localise(f"""
SELECT {_known('o_orderkey % 4 <> 1', 'o_orderkey')} AS claim_id, 'Surname' || {s('o_custkey')} AS surname_name,
       'N' || {s('o_orderkey % 10')} AS name_abbr,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Mid' || {s('o_orderkey % 9')} END AS middle_name
FROM {{orders}}""")
    defs["clm_dx_ind_payout_details"] = _localise(f"""
SELECT {_known('o_orderkey % 5 <> 2', 'o_orderkey')} AS claim_root_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'Bank transfer' WHEN 1 THEN 'Cash' ELSE 'Cheque' END AS payout_method_descr
FROM {{orders}}""")
    defs["clm_dx_correspondence"] = _localise(f"""
SELECT l_orderkey AS claim_id,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS corresp_receive_date,
       {d.add_days('l_shipdate', '-l_linenumber')} AS corresp_create_date
FROM {{lineitem}}""")
    defs["clm_dx_pay_payout"] = _localise(f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS claim_id, {_m('o_totalprice')} AS payout_amount,
       {_ccy_code('o_orderkey')} AS payout_currency
FROM {{orders}}""")
    defs["clm_dx_pay_coinsurer"] = f"""
SELECT {_known('o_orderkey % 8 = 0', 'o_orderkey')} AS claim_id, {_m(_m('o_totalprice') + ' * 0.1')} AS payout_coins_amount,
       {_ccy_code('o_custkey')} AS payout_coins_currency
FROM {{orders}}"""
    defs["clm_dx_pay_premium"] = _localise(f"""
SELECT {_known('c_custkey % 3 <> 2', 'c_custkey')} AS policy_id, {_m('abs(c_acctbal)')} AS payment_amount,
       {d.add_days(T('1995-01-01'), 'c_custkey % 100')} AS first_premium_date,
       {d.add_days(T('1995-01-01'), 'c_custkey % 100 + 300')} AS last_premium_date
FROM {{customer}}""")
    defs["clm_dx_ext_cost_by_role"] = _localise(f"""
SELECT {_known('l_linenumber = 1', 'l_orderkey')} AS claim_id,
       CASE WHEN l_suppkey % 3 = 0 THEN 'EXTADJ' ELSE 'LAWYER' END AS role_code,
       'Supplier ' || {s('l_suppkey')} AS ext_payee,
       {_m(_m('l_extendedprice') + ' * ' + _m('l_discount'))} AS amount_paid_extadj
FROM {{lineitem}}""")
    defs["clm_dx_note"] = _localise(f"""
SELECT CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey END AS claim_id, 'Note ' || o_orderpriority AS note
FROM {{orders}}""")
    defs["clm_dx_policy_group"] = _localise(f"""
SELECT {_known('c_custkey % 3 = 0 AND c_custkey % 12 <> 0', 'c_custkey')} AS policy_id, 'P' || {s('c_custkey - c_custkey % 12')} AS group_pol_no,
       substr(c_mktsegment, 1, 2) || '00' AS group_pol_prod_code,
       'Group ' || c_mktsegment AS group_pol_prod_name
FROM {{customer}}""")
    ctype = "CASE WHEN l_linestatus = 'F' THEN 'FAC' ELSE 'OQS' END"
    defs["rei_dx_clm_brdr_sum_recoverable"] = f"""
SELECT l_orderkey AS claim_id, {ctype} AS contr_type_code,
       {_m(f"sum({_m('l_extendedprice')} * {_m('l_tax')})")} AS recoverable
FROM {{lineitem}} GROUP BY l_orderkey, {ctype}"""

    # ----------------------------------------------------------------- money
    defs["pay_t_cis_mena"] = _values(
        [("cmenak_id", "BIGINT"), ("kod", d.text)],
        [(41, "USD"), (42, "EUR"), (43, "GHC"), (44, "GBP"), (45, "NGN"), (49, "GHS")])
    defs["pay_d_cl_currency"] = _localise(_values(
        [("ccurr_id", "BIGINT"), ("code", d.text)],
        [(41, "USD"), (42, "EUR"), (43, "GHC"), (44, "GBP"), (45, "NGN"), (49, "GHS")]))
    ev_ccy = ("CAST(CASE event_type WHEN 'view' THEN 41 WHEN 'click' THEN 42 "
              "WHEN 'purchase' THEN 44 WHEN 'signup' THEN 45 ELSE 49 END AS BIGINT)")
    eff = d.add_days(T('1995-01-01'), '80 * (day(ts) - 1)')
    defs["pay_d_exchange"] = f"""
SELECT {ev_ccy} AS ccurr_ccurr_id, {eff} AS effective_date,
       CAST(max(value) AS {RATE}) AS foreign_exchange_middle
FROM {{events}} GROUP BY {ev_ccy}, {eff}"""

    # ------------------------------------------------------ settled payouts
    vid = _split_id()
    defs["ina_t_vyplaty"] = f"""
SELECT {vid} AS vypla_id, l_orderkey AS pudal_koren_id, l_linenumber AS por_cislo,
       CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS cvypst_cvypst_id,
       CAST(l_linenumber % 3 + 1 AS BIGINT) AS plafor_plafor_id,
       CASE WHEN l_returnflag <> 'A' THEN l_orderkey % 100 END AS plnadr_plnadr_id,
       CASE WHEN l_returnflag = 'A' THEN {vid} END AS punakl_punakl_id,
       l_partkey AS pln_pln_id, l_suppkey AS revident, (l_suppkey + 7) % 110 AS likvidator,
       {_m('l_extendedprice')} AS vypl_ciastka,
       {_m(_m('l_extendedprice') + ' * ' + _m('l_discount'))} AS dan,
       {_m(_m('l_extendedprice') + ' * ' + _m('l_tax'))} AS tax_included,
       {_m(_m('l_extendedprice') + ' * (1 + ' + _m('l_tax') + ')')} AS suma,
       {d.add_days('l_shipdate', '1')} AS confirm_date,
       CAST(CASE WHEN l_orderkey % 19 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{lineitem}}"""
    defs["ina_t_cis_vyplata_stavy"] = _values(
        [("cvypst_id", "BIGINT"), ("kod", d.text)], [(1, "S"), (2, "N")])
    defs["pay_v_cis_platba_forma"] = _localise(_values(
        [("plafor_id", "BIGINT"), ("kod", d.text), ("popis", d.text)],
        [(1, "BT", "Bank transfer"), (2, "CA", "Cash"), (3, "CH", "Cheque")]))
    defs["ina_t_pln_adresati"] = f"""
SELECT s_suppkey AS plnadr_id, s_suppkey % 50 AS pupar_pupar_id FROM {{supplier}}"""
    defs["ina_t_pu_naklady"] = f"""
SELECT DISTINCT {_known("l_returnflag = 'A'", vid)} AS punakl_id, (l_orderkey + l_linenumber) % 60 AS pupar_pupar_id,
       CAST(CASE WHEN l_linenumber = 3 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{lineitem}}"""
    defs["ina_t_pudalost_partneri"] = f"""
SELECT s_suppkey AS pupar_id, (s_suppkey * 7) % 100 AS partner_partner_id,
       CAST(CASE WHEN s_suppkey % 11 = 5 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{supplier}}"""
    defs["par_dx_partners"] = f"""
SELECT s_suppkey AS partner_id,
       CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 'F' || {s('s_suppkey')} END AS firstname_abbrev,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'M' END AS middle_name,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name END AS surname_name
FROM {{supplier}}"""
    defs["pay_t_cis_typ_trans"] = _values(
        [("typtra_id", "BIGINT"), ("kod", d.text)], [(1, "PREVYP"), (2, "PREDPIS")])
    defs["pay_t_cis_trans_stav"] = _values(
        [("trastav_id", "BIGINT"), ("akt_stav", "INT")], [(1, 1), (2, 0)])
    defs["pay_t_cis_typ_vztahu"] = _values(
        [("typvzt_id", "BIGINT"), ("kod", d.text)], [(1, "PR/PL"), (2, "ZAP")])

    # Transactions: premium transactions (one per order) and transactions of
    # line items (the early ones pay a payout) share the table.
    payout_tx = f"1000000000000000 + {vid}"
    defs["pay_t_transakcia"] = f"""
SELECT o_orderkey AS transa_id, CAST(NULL AS BIGINT) AS id_riad_zdroj, o_custkey AS id_riad_ciel,
       {_ccy_id('o_custkey')} AS cmenak_cmenak_id,
       CAST(CASE WHEN o_orderkey % 43 = 0 THEN 3 ELSE 1 END AS BIGINT) AS trastav_trastav_id,
       o_orderkey AS vznik_id, o_orderkey AS zmena_id,
       {_m('o_totalprice')} AS suma, {_m(_m('o_totalprice') + ' * 2')} AS sum_home_currency,
       CAST(CASE WHEN o_orderkey % 9 = 4 THEN -1 ELSE 1 END AS INT) AS smer,
       CAST(1 AS INT) AS znak_vratka,
       CAST(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END AS INT) AS znak_storno,
       CAST(CASE WHEN o_orderkey % 10 = 7 THEN 0 ELSE 1 END AS INT) AS predpis,
       {d.add_hours('o_orderdate', 'o_orderkey % 24')} AS datum_vytvorenia,
       {d.add_days('o_orderdate', 'o_orderkey % 20')} AS datum_splatnost,
       o_orderdate AS account_first_entry_date,
       CAST(CASE WHEN o_orderkey % 31 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{orders}}
UNION ALL
SELECT {payout_tx}, CASE WHEN l_linenumber <= 5 THEN {vid} END, CAST(NULL AS BIGINT), {_ccy_id('l_orderkey')},
       CAST(l_linenumber % 2 + 1 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
       {_m('l_extendedprice')}, {_m(_m('l_extendedprice') + ' * (l_orderkey % 5 + 1)')},
       CAST(1 AS INT), CAST(1 AS INT), CAST(1 AS INT), CAST(0 AS INT),
       {d.add_hours(d.add_days('l_shipdate', '1'), 'l_orderkey % 24')},
       {d.add_days('l_shipdate', '30')}, l_shipdate, CAST(1 AS INT)
FROM {{lineitem}}"""
    defs["pay_t_trans_vztahy"] = f"""
SELECT {_known('l_linenumber IN (1, 3, 5)', payout_tx)} AS transa_transa_hlav_id, l_orderkey AS transa_transa_vedl_id,
       CAST(CASE WHEN l_linenumber = 5 THEN 2 ELSE 1 END AS BIGINT) AS typvzt_typvzt_id,
       CAST(1 AS INT) AS platny
FROM {{lineitem}}"""

    # -------------------------------------------------- premium production
    sid = _split_id()
    defs["pay_t_trans_rozpad"] = f"""
SELECT {sid} AS traroz_id, l_orderkey AS transa_transa_id,
       {_m('l_quantity * 10 * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END')} AS suma,
       {_m('l_quantity * 20 * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END')} AS sum_home_currency,
       l_shipdate AS datum_od,
       CAST(CASE WHEN l_linenumber = 6 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{lineitem}}"""
    defs["com_t_transaction"] = f"SELECT {_known('o_orderkey % 29 <> 0', 'o_orderkey')} AS trans_id FROM {{orders}}"
    defs["pay_t_ucet"] = f"""
SELECT c_custkey AS ucet_id, CAST(1 AS BIGINT) AS id_tab_obj, c_custkey AS id_riad_obj,
       CAST(CASE WHEN c_custkey % 37 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{customer}}"""
    defs["com_t_cis_object_type"] = _values(
        [("objtyp_id", "BIGINT"), ("code", d.text)], [(1, "Zmluva"), (2, "Partner")])
    start = d.add_days(T('1995-01-01'), 'c_custkey % 365')
    defs["inc_t_zmluvy"] = f"""
SELECT c_custkey AS zml_id, 'P' || {s('c_custkey')} AS cpz,
       CASE WHEN c_custkey % 4 = 0 THEN {d.add_days(T('1996-01-01'), 'c_custkey % 200')} END AS renewal_date,
       {start} AS datum_zaciatku,
       CASE WHEN c_custkey % 3 = 0 THEN {d.add_days(start, '300')} END AS aktualny_koniec,
       {d.add_days(start, '365')} AS datum_konca,
       {d.add_days(start, '-10')} AS datum_uzatvorenia,
       {d.add_days(start, '-5')} AS date_acceptance,
       CAST(CASE WHEN c_custkey % 41 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{customer}}"""
    nxt = "lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
    defs["inc_t_zmluvy_h"] = f"""
SELECT o_orderkey AS zmlh_id, o_custkey AS zml_id,
       CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE o_orderkey END AS zmena_id,
       o_orderkey % 8 AS zme_zme_id,
       CAST(CASE WHEN o_orderkey % 10 = 3 THEN 0 ELSE 1 END AS INT) AS ucinny,
       o_orderdate AS datum_od,
       coalesce({nxt}, {T('9999-12-31')}) AS datum_do,
       CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate END AS renewal_date,
       o_orderdate AS datum_zaciatku,
       CASE WHEN o_orderkey % 2 = 0 THEN {d.add_days('o_orderdate', '200')} END AS aktualny_koniec,
       {d.add_days('o_orderdate', '365')} AS datum_konca,
       {d.add_days('o_orderdate', '-3')} AS datum_uzatvorenia
FROM {{orders}}"""
    defs["inc_t_zmena_typy"] = _values(
        [("zme_id", "BIGINT"), ("czmet_czmet_id", "BIGINT")],
        [(0, 1), (1, 2), (2, 3), (3, 4), (4, 1), (5, 2), (6, 3), (7, 5)])
    defs["inc_v_cis_zmena_typ"] = _localise(_values(
        [("czmet_id", "BIGINT"), ("popis", d.text), ("skratka", d.text)],
        [(1, "New business", "NEW"), (2, "Renewal", "REN"), (3, "Technical change", "TCH"),
         (4, "Cancellation", "CAN")]))
    early = "l_linenumber <= 4"
    defs["cms_t_proviz_pripad"] = f"""
SELECT {sid} AS prprip_id, {_known(early, sid)} AS podklad_id, CAST(2 AS BIGINT) AS sysown_sysown_id,
       l_shipdate AS date_from,
       CAST(CASE WHEN l_linenumber = 4 AND l_orderkey % 2 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{lineitem}}"""
    defs["cms_t_odmena"] = f"""
SELECT {_known(early, sid)} AS prprip_narok_id, l_suppkey AS spolupracovnik,
       CAST(CASE l_suppkey % 3 WHEN 0 THEN 41 WHEN 1 THEN 49 ELSE 43 END AS BIGINT) AS origin_currency_id,
       CAST(CASE l_partkey % 2 WHEN 0 THEN 43 ELSE 49 END AS BIGINT) AS agent_currency_id,
       {_m(_m('l_extendedprice') + ' * ' + _m('l_discount'))} AS suma_netto,
       {_m(_m('l_extendedprice') + ' * ' + _m('l_discount'))} AS suma_netto_origin_currency,
       CAST(CASE WHEN l_linenumber = 3 AND l_suppkey % 2 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{lineitem}}"""
    defs["cms_t_spolupracovnik"] = f"""
SELECT s_suppkey AS spoluprac_id,
       CAST(CASE WHEN s_suppkey % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS cspolty_cspolty_id
FROM {{supplier}}"""
    defs["cms_t_cis_spolupracovnik_typ"] = _values(
        [("cspolty_id", "BIGINT"), ("create_pay_out", "INT")], [(1, 1), (2, 0)])
    member = "c_custkey % 3 = 0 AND c_custkey % 12 <> 0"
    defs["inc_t_zml_vazby"] = f"""
SELECT c_custkey AS zml_zml_id, c_custkey - c_custkey % 12 AS ku_zmluve_id,
       CAST(CASE WHEN {member} THEN 1 ELSE 2 END AS BIGINT) AS vztah_vztah_id,
       CAST(CASE WHEN c_custkey % 27 = 0 THEN 0 ELSE 1 END AS INT) AS platny
FROM {{customer}}"""
    defs["par_t_cis_vztah"] = _values(
        [("vztah_id", "BIGINT"), ("vztah_kod", d.text), ("platny", "INT")],
        [(1, "RZML", 1), (2, "POIS", 1)])
    defs["inc_t_group_change_member"] = f"""
SELECT o_custkey AS member_policy_id, o_orderkey AS member_policyh_id,
       o_orderkey + 5000000000 AS group_policyh_id,
       CAST(CASE WHEN o_custkey % 3 = 0 AND o_custkey % 12 <> 0 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS platny
FROM {{orders}}"""

    # ---------------------------------------------------- policy versions
    defs["pol_d_policy_h"] = f"""
SELECT o_orderkey AS policyh_id, o_custkey AS policy_id,
       CAST(o_custkey % 4 + 1 AS BIGINT) AS polty_polty_id,
       CAST(CASE WHEN o_orderkey % 13 = 0 THEN 4 WHEN o_orderstatus = 'F' THEN 1
                 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS BIGINT) AS polst_polst_id,
       CAST(o_custkey % 25 AS BIGINT) AS orgunit_orgunit_book_id,
       CAST(o_custkey % 25 AS BIGINT) AS prod_prod_id,
       CASE WHEN o_custkey % 7 = 0 THEN CAST(43 AS BIGINT) ELSE {_ccy_id('o_custkey')} END AS ccurr_ccurr_id,
       CAST(o_orderkey % 3 + 1 AS BIGINT) AS cpaymet_cpaymet_id,
       CAST(o_orderkey % 6 AS BIGINT) AS chty_chty_id,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS BIGINT) END AS coinsty_coinsty_id,
       'P' || {s('o_custkey')} AS policy_number,
       CAST(CASE WHEN o_orderkey % 10 = 3 THEN 0 ELSE 1 END AS INT) AS effective,
       CAST(CASE WHEN o_orderkey % 23 = 0 THEN 0 ELSE 1 END AS INT) AS valid,
       {_m('o_custkey % 15')} AS acquisition_commission_pct,
       o_orderdate AS date_version_from,
       coalesce({nxt}, {T('9999-12-31')}) AS date_version_to,
       {d.add_days(T('1995-01-01'), 'o_custkey % 365')} AS date_inception,
       CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate END AS date_renewal,
       {d.add_days('o_orderdate', '-3')} AS date_conclusion
FROM {{orders}}"""
    defs["pol_d_cl_policy_type"] = _localise(_values(
        [("polty_id", "BIGINT"), ("code", d.text), ("description", d.text)],
        [(1, "Ind", "Individual"), (2, "SOS", "Scheme"), (3, "Ram", "Framework"),
         (4, "Grp", "Group")]))
    defs["prd_d_cl_policy_status"] = _localise(_values(
        [("polst_id", "BIGINT"), ("code", d.text), ("name", d.text), ("description", d.text)],
        [(1, "ZA", "Active", "Approved contract"), (2, "SC", "Cancelled", "Cancelled contract"),
         (3, "CP", "Proposal", "Proposal"), (4, "Sns", "Refused", "Refused proposal")]))
    defs["prd_d_product"] = f"""
SELECT CAST(n_nationkey AS BIGINT) AS prod_id, CAST(n_nationkey % 5 AS BIGINT) AS brand_brand_id,
       CAST(CASE WHEN n_nationkey % 6 = 0 THEN 1 ELSE 2 END AS BIGINT) AS sysown_sysown_id,
       CASE n_nationkey % 3 WHEN 0 THEN 'MO' WHEN 1 THEN 'FI' ELSE 'MA' END
         || lpad({s('n_nationkey')}, 2, '0') AS code,
       'Product ' || n_name AS name
FROM {{nation}}"""
    defs["prd_d_cl_brand"] = _localise(f"""
SELECT CAST(CASE WHEN r_regionkey < 4 THEN r_regionkey ELSE -r_regionkey END AS BIGINT) AS brand_id, 'B' || {s('r_regionkey')} AS brand_code, r_name AS brand_name
FROM {{region}}""")
    defs["pay_d_cl_payment_method"] = _localise(_values(
        [("cpaymeth_id", "BIGINT"), ("description", d.text)], [(1, "Annual"), (2, "Monthly")]))
    defs["pol_d_changetype"] = _values(
        [("chty_id", "BIGINT"), ("chngty_chngty_id", "BIGINT")],
        [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6)])
    defs["pol_d_cl_change_type"] = _localise(_values(
        [("chngty_id", "BIGINT"), ("code", d.text), ("name", d.text), ("description", d.text)],
        [(1, "CRE", "New", "New policy"), (2, "MProl", "Renewal", "Policy renewal"),
         (3, "AKCEP", "Acceptance", "Acceptance"), (4, "TECH", "Technical", "Technical change"),
         (5, "RenewPrem", "Renewal premium", "Renewal premium"), (6, "CANC", "Cancel", "Cancellation")]))
    defs["prd_d_cl_coinsurance_type"] = _localise(_values(
        [("coinsty_id", "BIGINT"), ("code", d.text)],
        [(1, "LEAD1"), (2, "FOLW"), (3, "FACIN"), (4, "OTHER")]))
    defs["par_d_cl_sale_channel"] = _localise(_values(
        [("schann_id", "BIGINT"), ("code", d.text), ("name", d.text), ("description", d.text)],
        [(1, "DIR", "Direct", "Direct sales"), (2, "BRK", "Broker", "Broker channel"),
         (3, "BNK", "Bank", "Bancassurance")]))

    # co-insurance shares and owners
    defs["pol_d_policy_coinsurance"] = f"""
SELECT o.o_custkey AS policy_policy_id, l.l_suppkey AS partner_partner_id,
       {_m('l.l_tax * 100')} AS ratio,
       CAST(CASE WHEN l.l_linenumber = 1 AND l.l_suppkey % 13 <> 0 THEN 1 ELSE 0 END AS INT) AS valid
FROM {{lineitem}} l JOIN {{orders}} o ON o.o_orderkey = l.l_orderkey"""
    defs["par_d_owner_is"] = f"""
SELECT s_suppkey AS owner_id, s_suppkey AS partner_partner_id,
       CAST(CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS INT) AS valid
FROM {{supplier}}"""

    # covers and member -> group relation
    defs["inc_v_policy_premium"] = f"""
SELECT o_custkey AS policy_id, {_m('o_totalprice')} AS sum_insured,
       {_m(_m('o_totalprice') + ' * 0.05')} AS premium_annual,
       {_m(_m('o_totalprice') + ' * 0.04')} AS premium_modal,
       {_m('o_orderkey % 7')} AS rate_annual_tariff,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {_m('o_orderkey % 11')} END AS premium_annual_discount,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_m('o_orderkey % 13')} END AS premium_annual_loading
FROM {{orders}}"""
    defs["pol_d_policy_policy"] = f"""
SELECT c_custkey AS policy_policy_id, c_custkey - c_custkey % 12 AS policy_policy2_id,
       CAST(1 AS BIGINT) AS crel_crel_id, CAST(CASE WHEN {member} THEN 1 ELSE 0 END AS INT) AS valid
FROM {{customer}}"""
    defs["par_d_cl_relation"] = _localise(_values(
        [("crel_id", "BIGINT"), ("code", d.text), ("valid", "INT")],
        [(1, "RZML", 1), (2, "POIS", 1)]))

    # certificates (entity-attribute-value parameters on covers)
    ev_param = ("CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 "
                "WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT)")
    defs["pol_d_cover"] = f"""
SELECT event_id AS cover_id, user_id AS policy_policy_id, CAST(1 AS BIGINT) AS polst_polst_id,
       event_id % 3 AS elm_elm_id,
       CAST(CASE WHEN event_id % 17 = 0 THEN 0 ELSE 1 END AS INT) AS valid
FROM {{events}}"""
    defs["prd_d_element"] = _values([("elm_id", "BIGINT")], [(0,), (1,)])
    defs["pol_d_cover_parameter"] = f"""
SELECT event_id AS cover_cover_id, {ev_param} AS elmprm_elmprm_id,
       {s('CAST(floor(value) AS BIGINT) % 10')} AS value
FROM {{events}}"""
    defs["prd_d_element_parameter"] = _values(
        [("elmprm_id", "BIGINT"), ("param_param_id", "BIGINT")],
        [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)])
    # fixed values: parameter codes the certificate pivot looks for; the fourth
    # holds a character where the report's pattern has the '_' wildcard
    defs["prd_d_parameter"] = _values(
        [("param_id", "BIGINT"), ("code", d.text)],
        [(1, "ECOWStickNo10"), (2, "NICStickNo10"), (3, "FireCertNum"), (4, "CerNoXVeh"),
         (5, "IndustType")])
    defs["prd_d_param_option_h"] = _values(
        [("param_root_id", "BIGINT"), ("value", d.text), ("description", d.text), ("valid", "INT")],
        [(5, "1", "Manufacturing", 1), (5, "2", "Trading", 1), (5, "3", "Services", 0),
         (4, "7", "Private car", 1)])

    # table-valued lookups of the production report, materialised as tables
    defs["inc_v_policy_history"] = f"""
SELECT {_known('c_custkey % 19 <> 0', 'c_custkey')} AS policy_id, 'Entry user ' || {s('c_custkey % 7')} AS entry_user_desc,
       'Approver ' || {s('c_custkey % 5')} AS appr_user_desc,
       {d.add_days(T('1995-02-01'), 'c_custkey % 300')} AS appr_timestamp,
       CAST(c_custkey % 9 AS INT) AS top_version_endors_order,
       {d.add_days(T('1995-01-01'), 'c_custkey % 400')} AS top_version_date_version_from,
       'u' || {s('c_custkey % 7')} AS entry_user_login,
       {d.add_days(T('1995-01-15'), 'c_custkey % 200')} AS entry_timestamp,
       c_custkey % 7 AS entry_user_id,
       c_custkey % 11 AS top_version_user_id, 'top' || {s('c_custkey % 11')} AS top_version_user_login,
       'Top user ' || {s('c_custkey % 11')} AS top_version_user_desc,
       {d.add_days(T('1995-03-01'), 'c_custkey % 500')} AS top_version_timestamp
FROM {{customer}}
UNION ALL
SELECT {_known('c_custkey % 50 = 1', 'c_custkey')}, 'Entry user X', 'Approver X', {T('1996-01-01')}, CAST(0 AS INT),
       {T('1996-01-01')}, 'ux', {T('1996-01-01')}, CAST(99 AS BIGINT), CAST(99 AS BIGINT), 'topx',
       'Top user X', {T('1996-01-01')}
FROM {{customer}}"""
    defs["inc_v_policy_endorsements"] = _localise(f"""
SELECT {_known('o_orderkey % 4 <> 0', 'o_orderkey')} AS policyh_id, CAST(o_orderdate AS DATE) AS endors_date,
       o_custkey AS policy_id, CAST(o_orderkey % 12 AS INT) AS endors_order,
       CASE WHEN o_orderkey % 8 = 1 THEN NULL ELSE CAST(o_orderkey % 6 + 1 AS BIGINT) END AS change_type_id,
       CASE WHEN o_orderkey % 8 = 1 THEN NULL ELSE 'Endorsement ' || {s('o_orderkey % 6')} END AS change_type_name,
       CASE WHEN o_orderkey % 8 = 1 THEN NULL ELSE 'Endorsement text ' || {s('o_orderkey % 6')} END AS change_type_desc,
       CASE o_orderkey % 6 WHEN 0 THEN 'CRE' WHEN 1 THEN 'MProl' WHEN 2 THEN 'AKCEP'
            WHEN 3 THEN 'TECH' WHEN 4 THEN 'RenewPrem' ELSE 'CANC' END AS change_type_code,
       CASE WHEN o_orderkey % 7 = 2 THEN NULL WHEN o_orderstatus = 'O' THEN 'SC' ELSE 'ZA' END AS policy_status_code,
       CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE 'Status ' || o_orderstatus END AS policy_status_name,
       CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE 'Status text ' || o_orderstatus END AS policy_status_desc,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE {d.add_days('o_orderdate', '-1')} END AS date_version_from,
       o_orderkey % 13 AS user_id, 'e' || {s('o_orderkey % 13')} AS user_login,
       'Endorser ' || {s('o_orderkey % 13')} AS user_desc,
       {d.add_hours('o_orderdate', '9')} AS maker_time_stamp, o_orderkey % 17 AS maker_user_id,
       'm' || {s('o_orderkey % 17')} AS maker_user_login, 'Maker ' || {s('o_orderkey % 17')} AS maker_user_desc,
       {d.add_hours('o_orderdate', '15')} AS checker_time_stamp,
       CAST(o_orderkey % 4 AS BIGINT) AS sales_channel_id
FROM {{orders}}""")
    defs["inc_v_policy_endorsements1"] = _localise(f"""
SELECT {_known('o_orderkey % 3 = 1', 'o_custkey')} AS policy_id, CAST(o_orderdate AS DATE) AS endors_date,
       {d.add_hours('o_orderdate', '16')} AS time_stamp,
       {d.add_days('o_orderdate', '-2')} AS date_version_from
FROM {{orders}}""")
    defs["pol_policy_histver_partners"] = f"""
SELECT o_custkey AS policy_id, {_known('o_orderkey % 11 <> 4', 'o_orderkey')} AS policyh_id,
       o_custkey AS ph_partner_id, 'C' || {s('o_custkey')} AS ph_customer_id,
       'Holder' || {s('o_custkey % 50')} AS ph_firstname,
       CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE 'Q' END AS ph_middlename,
       'Surname' || {s('o_custkey')} AS ph_surname,
       o_orderkey % 100 AS br_partner_id, 'BRK' || {s('o_orderkey % 10')} AS br_code,
       'Broker' || {s('o_orderkey % 10')} AS br_firstname, CAST(NULL AS {d.text}) AS br_middlename,
       'Brokerage ' || {s('o_orderkey % 10')} AS br_surname,
       o_orderkey % 50 AS ma_partner_id, 'MK' || lpad({s('o_orderkey % 30')}, 3, '0') AS ma_code,
       'Marketer' || {s('o_orderkey % 30')} AS ma_firstname, CAST(NULL AS {d.text}) AS ma_middlename,
       'Sales ' || {s('o_orderkey % 30')} AS ma_surname
FROM {{orders}}"""
    defs["inc_v_policy_premium_h"] = f"""
SELECT {_known('o_orderkey % 3 <> 0', 'o_orderkey')} AS policyh_id, {_m(_m('o_totalprice') + ' * 3')} AS sum_insured
FROM {{orders}}"""
    return defs


_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def referenced_driver_tables(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)) & set(DRIVER_TABLES))


def duckdb_ctes(names: list[str] | None = None) -> str:
    """``WITH``-clause body (without ``WITH``) defining the logical tables for DuckDB."""
    defs = definitions(DUCKDB)
    chosen = names if names is not None else list(defs)
    parts = []
    for n in chosen:
        body = _PLACEHOLDER.sub(lambda m: m.group(1), defs[n])
        parts.append(f"{n} AS ({body.strip()})")
    return ",\n".join(parts)


def logical_names() -> list[str]:
    return list(definitions(SPARK))
