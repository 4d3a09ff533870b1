"""The input contract of the reports as fixed values: columns and types of every
logical table, keys that must identify one row, and codes that must occur once.

The plans rest on the keys: an existence test is a semi join, and a left join whose
columns are never read is not planned, which is exact only where the joined key
identifies one row.
"""

from __future__ import annotations

# table -> its columns (a DDL list); extra columns of a table are ignored
COLUMNS = {
    "clm_d_claim": (
        "claim_id bigint, policy_policy_id bigint, orgunit_admin_id bigint, orgunit_accounting_id bigint, "
        "cclmst_cclmst_id bigint, losntf_losntf_id bigint, adjuster bigint, clmno string, payment_identifier string, "
        "notification_date timestamp_ntz, occurence_date timestamp_ntz, settlement_date timestamp_ntz, registration_date "
        "timestamp_ntz, valid int"),
    "clm_d_cl_claim_st": (
        "cclmst_id bigint, code string, description string, culture_id bigint"),
    "clm_d_loss_notification": (
        "losntf_id bigint, address_street string, address_house_number1 string, address_house_number2 string, "
        "address_city string, postal_code string, occurence_place_description string, loss_description string, valid int"),
    "par_d_cl_org_unit": (
        "orgunit_id bigint, orgunit_orgunit_id bigint, orglvl_orglvl_id bigint, code string, abbrev string, name string, "
        "culture_id bigint"),
    "par_d_cl_org_level": (
        "orglvl_id bigint, level_no int, name string, culture_id bigint"),
    "par_d_partner": (
        "partner_id bigint, valid int"),
    "par_d_physical_person": (
        "partner_root_id bigint, first_name string, surname string, valid int"),
    "par_d_legal_person": (
        "partner_root_id bigint, name string, valid int"),
    "clm_dx_policy": (
        "policy_id bigint, policy_number string, product_code string, product_name string, product_brand_code string, "
        "currency_code string, sysowner string, sysowner_code string, orgunit_name string, acc_orgunit_name string, "
        "acc_orgunit_description string, uw_year int, date_inception timestamp_ntz, date_maturity timestamp_ntz, "
        "culture_id bigint"),
    "pol_dx_policy_booking": (
        "policy_id bigint, orgunit_book_code string"),
    "clm_dx_premium": (
        "policy_policy_id bigint, annual_premium decimal(19,4), insured_sum decimal(19,4)"),
    "clm_dx_policy_partner": (
        "policy_id bigint, assured_pers string, insured_pers string, agent string, agent_number string"),
    "clm_dx_reserve": (
        "claim_id bigint, indemnity int, indemnity_reserve_balance decimal(19,4), extcost_reserve_balance decimal(19,4), "
        "indemnity_reserve_change_date timestamp_ntz, culture_id bigint"),
    "clm_dx_payout": (
        "claim_id bigint, amount_paid_indemnity decimal(19,4), amount_paid_extcost decimal(19,4), payee string, "
        "paymethod_indemnity string, paymethod_extcost string, culture_id bigint"),
    "clm_dx_payout_ind": (
        "claim_id bigint, surname_name string, name_abbr string, middle_name string, culture_id bigint"),
    "clm_dx_ind_payout_details": (
        "claim_root_id bigint, payout_method_descr string, culture_id bigint"),
    "clm_dx_correspondence": (
        "claim_id bigint, corresp_receive_date timestamp_ntz, corresp_create_date timestamp_ntz, culture_id bigint"),
    "clm_dx_pay_payout": (
        "claim_id bigint, payout_amount decimal(19,4), payout_currency string, culture_id bigint"),
    "clm_dx_pay_coinsurer": (
        "claim_id bigint, payout_coins_amount decimal(19,4), payout_coins_currency string"),
    "clm_dx_pay_premium": (
        "policy_id bigint, payment_amount decimal(19,4), first_premium_date timestamp_ntz, last_premium_date "
        "timestamp_ntz, culture_id bigint"),
    "clm_dx_ext_cost_by_role": (
        "claim_id bigint, role_code string, ext_payee string, amount_paid_extadj decimal(19,4), culture_id bigint"),
    "clm_dx_note": (
        "claim_id bigint, note string, culture_id bigint"),
    "clm_dx_policy_group": (
        "policy_id bigint, group_pol_no string, group_pol_prod_code string, group_pol_prod_name string, culture_id bigint"),
    "rei_dx_clm_brdr_sum_recoverable": (
        "claim_id bigint, contr_type_code string, recoverable decimal(19,4)"),
    "pay_t_cis_mena": (
        "cmenak_id bigint, kod string"),
    "pay_d_cl_currency": (
        "ccurr_id bigint, code string, culture_id bigint"),
    "pay_d_exchange": (
        "ccurr_ccurr_id bigint, effective_date timestamp_ntz, foreign_exchange_middle decimal(19,8)"),
    "ina_t_vyplaty": (
        "vypla_id bigint, pudal_koren_id bigint, por_cislo int, cvypst_cvypst_id bigint, plafor_plafor_id bigint, "
        "plnadr_plnadr_id bigint, punakl_punakl_id bigint, pln_pln_id bigint, revident bigint, likvidator bigint, "
        "vypl_ciastka decimal(19,4), dan decimal(19,4), tax_included decimal(19,4), suma decimal(19,4), confirm_date "
        "timestamp_ntz, platny int"),
    "ina_t_cis_vyplata_stavy": (
        "cvypst_id bigint, kod string"),
    "pay_v_cis_platba_forma": (
        "plafor_id bigint, kod string, popis string, culture_id bigint"),
    "ina_t_pln_adresati": (
        "plnadr_id bigint, pupar_pupar_id bigint"),
    "ina_t_pu_naklady": (
        "punakl_id bigint, pupar_pupar_id bigint, platny int"),
    "ina_t_pudalost_partneri": (
        "pupar_id bigint, partner_partner_id bigint, platny int"),
    "par_dx_partners": (
        "partner_id bigint, firstname_abbrev string, middle_name string, surname_name string"),
    "pay_t_cis_typ_trans": (
        "typtra_id bigint, kod string"),
    "pay_t_cis_trans_stav": (
        "trastav_id bigint, akt_stav int"),
    "pay_t_cis_typ_vztahu": (
        "typvzt_id bigint, kod string"),
    "pay_t_transakcia": (
        "transa_id bigint, id_riad_zdroj bigint, id_riad_ciel bigint, cmenak_cmenak_id bigint, trastav_trastav_id bigint, "
        "vznik_id bigint, zmena_id bigint, suma decimal(19,4), sum_home_currency decimal(19,4), smer int, znak_vratka "
        "int, znak_storno int, predpis int, datum_vytvorenia timestamp_ntz, datum_splatnost timestamp_ntz, "
        "account_first_entry_date timestamp_ntz, platny int"),
    "pay_t_trans_vztahy": (
        "transa_transa_hlav_id bigint, transa_transa_vedl_id bigint, typvzt_typvzt_id bigint, platny int"),
    "pay_t_trans_rozpad": (
        "traroz_id bigint, transa_transa_id bigint, suma decimal(19,4), sum_home_currency decimal(19,4), datum_od "
        "timestamp_ntz, platny int"),
    "com_t_transaction": (
        "trans_id bigint"),
    "pay_t_ucet": (
        "ucet_id bigint, id_tab_obj bigint, id_riad_obj bigint, platny int"),
    "com_t_cis_object_type": (
        "objtyp_id bigint, code string"),
    "inc_t_zmluvy": (
        "zml_id bigint, cpz string, renewal_date timestamp_ntz, datum_zaciatku timestamp_ntz, aktualny_koniec "
        "timestamp_ntz, datum_konca timestamp_ntz, datum_uzatvorenia timestamp_ntz, date_acceptance timestamp_ntz, platny "
        "int"),
    "inc_t_zmluvy_h": (
        "zmlh_id bigint, zml_id bigint, zmena_id bigint, zme_zme_id bigint, ucinny int, datum_od timestamp_ntz, datum_do "
        "timestamp_ntz, renewal_date timestamp_ntz, datum_zaciatku timestamp_ntz, aktualny_koniec timestamp_ntz, "
        "datum_konca timestamp_ntz, datum_uzatvorenia timestamp_ntz"),
    "inc_t_zmena_typy": (
        "zme_id bigint, czmet_czmet_id bigint"),
    "inc_v_cis_zmena_typ": (
        "czmet_id bigint, popis string, skratka string, culture_id bigint"),
    "cms_t_proviz_pripad": (
        "prprip_id bigint, podklad_id bigint, sysown_sysown_id bigint, date_from timestamp_ntz, platny int"),
    "cms_t_odmena": (
        "prprip_narok_id bigint, spolupracovnik bigint, origin_currency_id bigint, agent_currency_id bigint, suma_netto "
        "decimal(19,4), suma_netto_origin_currency decimal(19,4), platny int"),
    "cms_t_spolupracovnik": (
        "spoluprac_id bigint, cspolty_cspolty_id bigint"),
    "cms_t_cis_spolupracovnik_typ": (
        "cspolty_id bigint, create_pay_out int"),
    "inc_t_zml_vazby": (
        "zml_zml_id bigint, ku_zmluve_id bigint, vztah_vztah_id bigint, platny int"),
    "par_t_cis_vztah": (
        "vztah_id bigint, vztah_kod string, platny int"),
    "inc_t_group_change_member": (
        "member_policy_id bigint, member_policyh_id bigint, group_policyh_id bigint, platny int"),
    "pol_d_policy_h": (
        "policyh_id bigint, policy_id bigint, polty_polty_id bigint, polst_polst_id bigint, orgunit_orgunit_book_id "
        "bigint, prod_prod_id bigint, ccurr_ccurr_id bigint, cpaymet_cpaymet_id bigint, chty_chty_id bigint, "
        "coinsty_coinsty_id bigint, policy_number string, effective int, valid int, acquisition_commission_pct "
        "decimal(19,4), date_version_from timestamp_ntz, date_version_to timestamp_ntz, date_inception timestamp_ntz, "
        "date_renewal timestamp_ntz, date_conclusion timestamp_ntz"),
    "pol_d_cl_policy_type": (
        "polty_id bigint, code string, description string, culture_id bigint"),
    "prd_d_cl_policy_status": (
        "polst_id bigint, code string, name string, description string, culture_id bigint"),
    "prd_d_product": (
        "prod_id bigint, brand_brand_id bigint, sysown_sysown_id bigint, code string, name string"),
    "prd_d_cl_brand": (
        "brand_id bigint, brand_code string, brand_name string, culture_id bigint"),
    "pay_d_cl_payment_method": (
        "cpaymeth_id bigint, description string, culture_id bigint"),
    "pol_d_changetype": (
        "chty_id bigint, chngty_chngty_id bigint"),
    "pol_d_cl_change_type": (
        "chngty_id bigint, code string, name string, description string, culture_id bigint"),
    "prd_d_cl_coinsurance_type": (
        "coinsty_id bigint, code string, culture_id bigint"),
    "par_d_cl_sale_channel": (
        "schann_id bigint, code string, name string, description string, culture_id bigint"),
    "pol_d_policy_coinsurance": (
        "policy_policy_id bigint, partner_partner_id bigint, ratio decimal(19,4), valid int"),
    "par_d_owner_is": (
        "owner_id bigint, partner_partner_id bigint, valid int"),
    "inc_v_policy_premium": (
        "policy_id bigint, sum_insured decimal(19,4), premium_annual decimal(19,4), premium_modal decimal(19,4), "
        "rate_annual_tariff decimal(19,4), premium_annual_discount decimal(19,4), premium_annual_loading decimal(19,4)"),
    "pol_d_policy_policy": (
        "policy_policy_id bigint, policy_policy2_id bigint, crel_crel_id bigint, valid int"),
    "par_d_cl_relation": (
        "crel_id bigint, code string, valid int, culture_id bigint"),
    "pol_d_cover": (
        "cover_id bigint, policy_policy_id bigint, polst_polst_id bigint, elm_elm_id bigint, valid int"),
    "prd_d_element": (
        "elm_id bigint"),
    "pol_d_cover_parameter": (
        "cover_cover_id bigint, elmprm_elmprm_id bigint, value string"),
    "prd_d_element_parameter": (
        "elmprm_id bigint, param_param_id bigint"),
    "prd_d_parameter": (
        "param_id bigint, code string"),
    "prd_d_param_option_h": (
        "param_root_id bigint, value string, description string, valid int"),
    "inc_v_policy_history": (
        "policy_id bigint, entry_user_desc string, appr_user_desc string, appr_timestamp timestamp_ntz, "
        "top_version_endors_order int, top_version_date_version_from timestamp_ntz, entry_user_login string, "
        "entry_timestamp timestamp_ntz, entry_user_id bigint, top_version_user_id bigint, top_version_user_login string, "
        "top_version_user_desc string, top_version_timestamp timestamp_ntz"),
    "inc_v_policy_endorsements": (
        "policyh_id bigint, endors_date date, policy_id bigint, endors_order int, change_type_id bigint, change_type_name "
        "string, change_type_desc string, change_type_code string, policy_status_code string, policy_status_name string, "
        "policy_status_desc string, date_version_from timestamp_ntz, user_id bigint, user_login string, user_desc string, "
        "maker_time_stamp timestamp_ntz, maker_user_id bigint, maker_user_login string, maker_user_desc string, "
        "checker_time_stamp timestamp_ntz, sales_channel_id bigint, culture_id bigint"),
    "inc_v_policy_endorsements1": (
        "policy_id bigint, endors_date date, time_stamp timestamp_ntz, date_version_from timestamp_ntz, culture_id bigint"),
    "pol_policy_histver_partners": (
        "policy_id bigint, policyh_id bigint, ph_partner_id bigint, ph_customer_id string, ph_firstname string, "
        "ph_middlename string, ph_surname string, br_partner_id bigint, br_code string, br_firstname string, "
        "br_middlename string, br_surname string, ma_partner_id bigint, ma_code string, ma_firstname string, "
        "ma_middlename string, ma_surname string"),
    "inc_v_policy_premium_h": (
        "policyh_id bigint, sum_insured decimal(19,4)"),
}

# table -> columns that identify one row (rows with a NULL among them match nothing and are not counted)
UNIQUE_KEYS = {
    "com_t_transaction": ("trans_id",),
    "pay_t_cis_trans_stav": ("trastav_id",),
    "com_t_cis_object_type": ("objtyp_id",),
    "inc_t_zmena_typy": ("zme_id",),
    "inc_v_cis_zmena_typ": ("czmet_id", "culture_id"),
    "prd_d_element": ("elm_id",),
    "prd_d_cl_policy_status": ("polst_id", "culture_id"),
    "cms_t_spolupracovnik": ("spoluprac_id",),
    "inc_t_zmluvy_h": ("zmlh_id",),
    "clm_d_claim": ("claim_id",),
    "clm_d_loss_notification": ("losntf_id",),
    "clm_d_cl_claim_st": ("cclmst_id", "culture_id"),
    "clm_dx_policy": ("policy_id", "culture_id"),
    "par_d_cl_org_unit": ("orgunit_id", "culture_id"),
    "par_d_cl_org_level": ("orglvl_id", "culture_id"),
}

# table -> the rows its key identifies, where not all (other rows are older versions)
UNIQUE_AMONG = {
    "clm_d_claim": "valid = 1",
    "clm_d_loss_notification": "valid = 1",
}

# table -> condition that at most one row meets: codes that the reports look up as one value
SINGLE_ROWS = {
    "pay_t_cis_typ_trans": "kod = 'PREVYP'",
    "com_t_cis_object_type": "code = 'Zmluva'",
    "par_d_cl_relation": "code = 'RZML' AND valid = 1 AND culture_id = 3",
    "par_t_cis_vztah": "vztah_kod = 'RZML' AND platny = 1",
}
