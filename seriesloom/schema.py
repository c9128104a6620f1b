"""Canonical column sets and schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ["Product", "Division"]
MODEL_KEY = [*SERIES, "Model"]

RAW_EXTRACT = T.StructType(
    [
        T.StructField("raw_product", T.StringType()),
        T.StructField("Division", T.StringType()),
        T.StructField("raw_month", T.StringType()),
        T.StructField("raw_fy", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("group_key", T.StringType()),
        T.StructField("business_unit_code", T.StringType()),
        T.StructField("sku_list", T.StringType()),
        T.StructField("salesforce_feature_mode", T.StringType()),
    ]
)

ALIASES = T.StructType(
    [
        T.StructField("business_unit_code", T.StringType()),
        T.StructField("group_key", T.StringType()),
        T.StructField("salesforce_product_name", T.StringType()),
    ]
)

HOLDOUT = T.StructType(
    [
        T.StructField("Product", T.StringType()),
        T.StructField("Division", T.StringType()),
        T.StructField("Model", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Actual", T.DoubleType()),
        T.StructField("Forecast", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, columns, name: str = "table") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{name} is missing columns: {', '.join(missing)}")
    return df


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def null_keys_out(df: DataFrame, keys=SERIES) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def by_month(*more: str, order: str = "Month"):
    """Window of one series in month order. Its size is the number of months."""
    return Window.partitionBy(*SERIES, *more).orderBy(order)


def of_series(*more: str):
    return Window.partitionBy(*SERIES, *more)


def any_of(cond: Column) -> Column:
    return F.coalesce(F.max(cond.cast("int")), F.lit(0)) == 1
