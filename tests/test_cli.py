"""The batch entry point runs a report from parameters and writes it."""
from assurspark import cli
from assurspark.sources import driver_fixtures, layout


def test_cli_writes_reports(spark, tables, tmp_path):
    root = tmp_path / "tables"
    layout.store(tables, driver_fixtures.logical_names(), str(root))
    out = tmp_path / "out"
    cli.main(["claims_outstanding", "--tables", str(root), "--as-at", "1998-07-01",
              "--run-ts", "2002-01-01", "--out", str(out / "r02")], spark=spark)
    cli.main(["daily_production", "--tables", str(root), "--basic-date", "A", "--date-from", "1995-01-01",
              "--date-to", "2002-01-01", "--all-certificates", "--out", str(out / "r04")], spark=spark)
    r02 = spark.read.parquet(str(out / "r02"))
    r04 = spark.read.parquet(str(out / "r04"))
    assert len(r02.columns) == 79 and r02.count() > 0
    assert len(r04.columns) == 98 and r04.count() > 0


def test_cli_explain(spark, tables, tmp_path, capsys):
    root = tmp_path / "tables"
    layout.store(tables, driver_fixtures.logical_names(), str(root))
    cli.main(["claims_settled", "--tables", str(root), "--date-from", "1997-01-01", "--date-to", "1997-12-31",
              "--explain"], spark=spark)
    out = capsys.readouterr().out
    assert "Physical Plan" in out and "PartitionFilters" in out
