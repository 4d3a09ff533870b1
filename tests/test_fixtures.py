"""The logical tables derived from the driver data are identical in Spark and DuckDB."""
import pytest
from pyspark.sql import functions as F

from assurspark.sources import driver_fixtures
from helpers import canonical


@pytest.mark.parametrize("name", driver_fixtures.logical_names())
def test_fixture_same_in_both_engines(spark, duck, tables, name):
    df = tables[name]
    cur = duck.execute(f"WITH {driver_fixtures.duckdb_ctes([name])} SELECT * FROM {name}")
    drows = cur.fetchall()
    assert df.columns == [d[0] for d in cur.description]
    assert canonical(df.collect(), df.columns) == canonical(drows, df.columns)


def test_localised_tables_have_both_cultures(tables):
    cultures = {r[0] for r in tables.clm_d_cl_claim_st.select("culture_id").distinct().collect()}
    assert cultures == set(driver_fixtures.CULTURES)


def test_derived_tables_keep_the_declared_keys(spark):
    from assurspark.sources.catalog import Tables

    for folder in ("sf0.001", "sf0.01"):
        Tables.from_driver_data(spark, f"/root/testdata/{folder}").check_keys()


def test_broken_keys_are_named(spark, tables):
    from assurspark.sources.contract import ContractError

    twice = tables.with_overrides({
        "inc_t_zmluvy_h": tables.inc_t_zmluvy_h.union(tables.inc_t_zmluvy_h.where("zmlh_id IS NOT NULL").orderBy("zmlh_id").limit(1)),
        "par_t_cis_vztah": tables.par_t_cis_vztah.union(tables.par_t_cis_vztah),
        "prd_d_cl_policy_status": tables.prd_d_cl_policy_status.where("culture_id = 3").withColumn("polst_id", F.lit(None).cast("bigint"))})
    with pytest.raises(ContractError) as e:
        twice.check_keys()
    said = str(e.value)
    assert "inc_t_zmluvy_h: 1 values of (zmlh_id)" in said and "on 2" in said
    assert "par_t_cis_vztah: 2 rows where vztah_kod = 'RZML'" in said
    assert "prd_d_cl_policy_status" not in said                 # rows without a key match nothing
    twice.check_keys(["com_t_transaction", "clm_d_claim"])      # asked for others only


def test_one_type_may_have_the_code_of_prepaid_payouts(spark, tables):
    from assurspark.sources import contract

    types = spark.createDataFrame([(1, "PREVYP"), (2, "PREVYP"), (3, "X")], "typtra_id bigint, kod string")
    assert contract.key_violations("pay_t_cis_typ_trans", types) == [
        "table pay_t_cis_typ_trans: 2 rows where kod = 'PREVYP', at most one is expected"]
    assert contract.key_violations("pay_t_cis_typ_trans", types.where("typtra_id > 1")) == []


def test_contract_is_declared_apart_from_the_test_data():
    import inspect

    from assurspark.sources import contract, schemas
    assert "driver_fixtures" not in inspect.getsource(contract) + inspect.getsource(schemas)
    assert set(schemas.COLUMNS) == set(driver_fixtures.logical_names())
    assert {*schemas.UNIQUE_KEYS, *schemas.SINGLE_ROWS} <= set(schemas.COLUMNS)


@pytest.mark.parametrize("name", driver_fixtures.logical_names())
def test_derived_tables_have_the_declared_schema(tables, name):
    from assurspark.sources import contract

    assert [(f.name, f.dataType) for f in contract.schema_of(name).fields] == [(f.name, f.dataType) for f in tables[name].schema.fields]


def test_contract_matches_derived_tables_and_checks_loads(spark, tables, tmp_path):
    from assurspark.sources import contract
    from assurspark.sources.catalog import Tables
    tables.clm_d_cl_claim_st.withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "clm_d_cl_claim_st"))
    tables.clm_d_claim.drop("adjuster").write.parquet(str(tmp_path / "clm_d_claim"))
    t = Tables.from_parquet_dir(spark, str(tmp_path))
    assert "extra" in t.clm_d_cl_claim_st.columns          # extra columns are fine
    with pytest.raises(contract.ContractError, match="missing adjuster"):
        t.clm_d_claim
