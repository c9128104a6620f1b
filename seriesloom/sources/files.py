"""Readers. Column pruning and filters reach the scan; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom import schema
from seriesloom.functions import codes, dates, numeric


def read_extract(spark: SparkSession, path: str, sheet: str, skip_rows: int = 0) -> DataFrame:
    """Raw text extract without header; only its first five columns are kept.

    Rows above the data are skipped per file by position in the file
    (`_metadata.file_block_start` is 0 for the block that holds the head).
    """
    wide = T.StructType(schema.RAW_EXTRACT.fields)
    rows = spark.read.schema(wide).option("enforceSchema", True).csv(path)
    if skip_rows:
        rows = _skip_head(spark, path, wide, skip_rows)
    return rows.select(*schema.RAW_EXTRACT.names, F.lit(sheet).alias("source_sheet"))


def _skip_head(spark, path, wide, skip_rows) -> DataFrame:
    """Drop the first lines of every file: title rows never carry a month and a year."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.file_block_start").alias("at"),
                                         F.monotonically_increasing_id().alias("id"))
    head = (
        lines.filter("at = 0")
        .groupBy("f")
        .agg(F.min("id").alias("first_id"))
    )
    kept = lines.join(head, "f").filter((F.col("at") > 0) | (F.col("id") >= F.col("first_id") + skip_rows))
    parsed = F.from_csv("value", wide.simpleString()[len("struct<"):-1].replace(":", " "))
    return kept.select(parsed.alias("r")).select("r.*")


def read_extracts(spark, extracts) -> DataFrame:
    """Union of several extracts given as (path, sheet, skip_rows)."""
    frames = [read_extract(spark, *e) for e in extracts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_fact(spark, path: str, fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).option("header", True).load(path)
    schema.require_columns(df, [*schema.SERIES, "Month", "Actuals"], "monthly fact")
    keys = {"Product", "Division", "Month"}
    return df.select(
        "Product",
        "Division",
        dates.month_start(F.to_date("Month")).alias("Month"),
        *[numeric.to_number(c).alias(c) for c in df.columns if c not in keys],
    )


def read_snapshots(spark, path: str, fmt: str = "csv") -> DataFrame:
    """All snapshot files under a path, each row tagged with its file name."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path).withColumn("_source_file", F.col("_metadata.file_name"))


def read_aliases(spark, paths, fmt: str = "csv") -> DataFrame:
    """Alias reference from the first path that exists, else an empty table."""
    path = first_existing(spark, paths)
    if path is None:
        return schema.empty(spark, schema.ALIASES)
    df = spark.read.format(fmt).option("header", True).load(path)
    return clean_aliases(df)


def clean_aliases(df: DataFrame) -> DataFrame:
    schema.require_columns(df, schema.ALIASES.names, "alias reference")
    return df.select(
        F.col("business_unit_code").cast("string").alias("business_unit_code"),
        codes.normalize_code("group_key").alias("group_key"),
        codes.normalize_code("salesforce_product_name").alias("salesforce_product_name"),
    ).filter("group_key <> ''")


def read_summary(spark, paths, fmt: str = "csv") -> DataFrame:
    path = first_existing(spark, paths)
    if path is None:
        raise FileNotFoundError("no signal summary found")
    return clean_summary(spark.read.format(fmt).option("header", True).load(path))


def clean_summary(df: DataFrame) -> DataFrame:
    schema.require_columns(df, ["group_key", "BU", "Month"], "signal summary")
    keys = {"group_key", "BU", "Month"}
    return df.select(
        codes.normalize_code("group_key").alias("group_key"),
        codes.normalize_code("BU").alias("BU"),
        dates.month_start(F.to_date("Month")).alias("Month"),
        *[numeric.to_number(c).alias(c) for c in df.columns if c not in keys],
    )


def read_catalog(spark, path: str, fmt: str = "csv") -> DataFrame:
    df = spark.read.format(fmt).option("header", True).load(path)
    return clean_catalog(df)


def clean_catalog(df: DataFrame) -> DataFrame:
    schema.require_columns(df, ["group_key", "business_unit_code", "sku_list"], "catalog")
    return df.withColumn("group_key_norm", codes.normalize_code("group_key")).withColumn(
        "business_unit_norm", codes.normalize_code("business_unit_code")
    )


def read_holdout(spark, path: str) -> DataFrame:
    if first_existing(spark, [path]) is None:
        return schema.empty(spark, schema.HOLDOUT)
    return spark.read.schema(schema.HOLDOUT).option("header", True).csv(path)


def read_library(spark, path: str) -> DataFrame:
    """Forecast library, all runs: `run_month` is the partition column."""
    df = schema.require_columns(spark.read.parquet(path), ["forecast_month", "run_month"], "library")
    return df.withColumn("forecast_month", dates.month_start(F.to_date("forecast_month")))


def latest_run(library: DataFrame) -> DataFrame:
    """Rows of the newest run. The newest month is a scalar subquery over the partition column."""
    newest = library.agg(F.max("run_month")).scalar()
    return library.filter(F.col("run_month") == newest)


def first_existing(spark, paths) -> str | None:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            return path
    return None
