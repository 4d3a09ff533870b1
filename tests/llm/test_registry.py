"""Registered queries of the training-data operators."""

import duckdb

import __spark_entry__ as entry
from assurspark.llm import registry

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= names


def test_sql_gives_the_queries_rows(spark):
    for name, sql in registry.ORACLES.items():
        got = registry.QUERIES[name](spark, FOLDER)
        con = duckdb.connect()
        for table in ("documents", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        want = con.execute(sql)
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(got.columns)
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.fetchall()))
