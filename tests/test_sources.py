"""Readers and writers."""

from datetime import date

from pyspark.sql import functions as F

from seriesloom.sources import files, sinks


def test_extract_skips_head_rows_and_extra_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Title\nSubtitle\n10,D,January,FY24,5,extra\n11,D,March,FY24,x,extra\n")
    (tmp_path / "b.csv").write_text("Title\nSubtitle\n12,D,May,FY23,7,extra\n")
    rows = files.read_extract(spark, str(tmp_path), "sheet", skip_rows=2).collect()
    assert sorted(r["raw_product"] for r in rows) == ["10", "11", "12"]
    assert {r["value"] for r in rows} == {"5", "x", "7"} and rows[0]["source_sheet"] == "sheet"


def test_snapshot_files_carry_their_name(spark, tmp_path):
    (tmp_path / "s1.csv").write_text("Month,Quantity\n2024-01,1\n")
    (tmp_path / "s2.csv").write_text("Month,Quantity\n2024-02,2\n")
    got = {r["_source_file"]: r["Month"] for r in files.read_snapshots(spark, str(tmp_path)).collect()}
    assert got == {"s1.csv": "2024-01", "s2.csv": "2024-02"}


def test_missing_inputs_give_empty_tables(spark, tmp_path):
    assert files.read_aliases(spark, [str(tmp_path / "none")]).count() == 0
    assert files.read_holdout(spark, str(tmp_path / "none")).count() == 0


def test_library_round_trip_keeps_other_runs(spark, tmp_path):
    root = str(tmp_path / "lib")
    for m in (1, 2):
        df = spark.createDataFrame([("p", date(2024, m, 1), float(m)), ("p", date(2024, m + 1, 1), float(m))],
                                   "product_id string, forecast_month date, forecast_value double")
        sinks.write_library(df, root)
        sinks.write_library(df, root)  # a rerun replaces its own run only
    lib = files.read_library(spark, root)
    assert lib.count() == 4
    newest = files.latest_run(lib)
    assert newest.count() == 2 and newest.select(F.min("forecast_month")).first()[0] == date(2024, 2, 1)


def test_report(spark, tmp_path):
    sinks.write_report({"a": spark.range(3), "b": spark.range(2)}, str(tmp_path / "r"), csv=("b",))
    assert spark.read.parquet(str(tmp_path / "r/a")).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "r/b")).count() == 2
