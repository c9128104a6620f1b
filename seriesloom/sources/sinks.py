"""Writers: one directory per table, overwritten as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=()) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(tables: dict[str, DataFrame], root: str, fmt: str = "parquet", csv=()) -> None:
    """A report is a set of tables; names in `csv` are written as CSV."""
    for name, df in tables.items():
        write_table(df, f"{root}/{name}", "csv" if name in csv else fmt)


def write_library(forecasts: DataFrame, root: str) -> None:
    """Forecast library, one partition per run.

    A run is named by its first forecast month. Only the partition of this run is replaced.
    """
    first = forecasts.agg(F.min("forecast_month")).scalar()
    run = forecasts.withColumn("run_month", F.date_format(first, "yyyy-MM"))
    (
        run.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_month")
        .parquet(root)
    )
