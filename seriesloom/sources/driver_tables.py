"""Canonical tables derived from the star-schema parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.functions.dates import month_start
from seriesloom.functions.lineage import stored
from seriesloom.schema import SERIES, by_month

AS_OF = "2001-09-15"
SKUS_PER_CATALOG_ROW = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def regions(spark, sf_dir) -> DataFrame:
    """Supplier to division. `nation` has 25 rows whatever the data size, so it is broadcast."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.concat(F.lit("R"), "n_regionkey").alias("Division"))
    )


def shipments(spark, sf_dir) -> DataFrame:
    """One row per line: Product, Division, Month, Actuals. Not yet collapsed."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("Product"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(regions(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            *SERIES,
            month_start("l_shipdate").alias("Month"),
            F.col("l_quantity").alias("Actuals"),
        )
    )


def series_lines(spark, sf_dir) -> DataFrame:
    """Lines with the series they belong to. Months are taken before anything moves."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("Product"))
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("ship_month", month_start("l_shipdate"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(regions(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    )


def stored_series_lines(spark, sf_dir) -> DataFrame:
    """What the fact and the order lines take of the lines, met with their series once and stored."""
    return stored(series_lines(spark, sf_dir).select(
        *SERIES, "l_orderkey", "ship_month", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    ))


def order_lines(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    """Lines with their order: the base of bookings, signals and snapshot rows."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", month_start("o_orderdate").alias("order_month")
    )
    lines = series_lines(spark, sf_dir) if lines is None else lines
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def monthly_fact(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    """Dense monthly fact: brand x region, Actuals only. Lines without an order count too."""
    if lines is not None:
        return lines.groupBy(*SERIES, F.col("ship_month").alias("Month")).agg(F.sum("l_quantity").alias("Actuals"))
    return shipments(spark, sf_dir).groupBy(*SERIES, "Month").agg(F.sum("Actuals").alias("Actuals"))


def order_cells(spark, sf_dir) -> DataFrame:
    """Order lines collapsed to (series, order month, ship month): few rows, whatever the number of lines."""
    return (
        order_lines(spark, sf_dir)
        .groupBy(*SERIES, "order_month", "ship_month")
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.sum(F.floor("l_extendedprice")).alias("price"),
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
        )
    )


def full_fact(spark, sf_dir, cells: DataFrame | None = None) -> DataFrame:
    """Monthly fact with bookings and pipeline signals.

    Lines are read once and collapsed to (series, order month, ship month) cells;
    both sides of the full join come from those few cells.
    """
    cells = order_cells(spark, sf_dir) if cells is None else cells
    sides = cells.select(
        *SERIES,
        F.explode(
            F.array(
                F.struct(
                    F.col("ship_month").alias("Month"),
                    F.col("qty").alias("Actuals"),
                    F.lit(None).cast("double").alias("Bookings"),
                    F.lit(None).cast("double").alias("New_Opportunities"),
                    F.lit(None).cast("double").alias("Open_Opportunities"),
                ),
                F.struct(
                    F.col("order_month").alias("Month"),
                    F.lit(None).cast("double").alias("Actuals"),
                    F.col("qty").alias("Bookings"),
                    F.col("n_lines").cast("double").alias("New_Opportunities"),
                    F.col("n_open").cast("double").alias("Open_Opportunities"),
                ),
            )
        ).alias("side"),
    ).select(*SERIES, "side.*")
    return sides.groupBy(*SERIES, "Month").agg(
        *[
            F.sum(c).alias(c)
            for c in ("Actuals", "Bookings", "New_Opportunities", "Open_Opportunities")
        ]
    )


def part_fact(spark, sf_dir) -> DataFrame:
    """Intermittent fact: one series per part, only months that have shipments."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").cast("string").alias("Product"),
            F.lit("ALL").alias("Division"),
            month_start("l_shipdate").alias("Month"),
        )
        .agg(F.sum("l_quantity").alias("Actuals"))
    )


def calendar_bounds(spark, sf_dir) -> DataFrame:
    """First and last ship month, one row."""
    return table(spark, sf_dir, "lineitem").agg(
        F.min(month_start("l_shipdate")).alias("first_month"),
        F.max(month_start("l_shipdate")).alias("last_month"),
    )


def catalog(spark, sf_dir) -> DataFrame:
    """Product catalog. A row lists at most SKUS_PER_CATALOG_ROW codes, whatever the data size."""
    part = table(spark, sf_dir, "part")
    return (
        part.groupBy(
            F.col("p_brand").alias("group_key"),
            F.concat(F.lit("R"), F.col("p_size") % 5).alias("business_unit_code"),
            F.floor(F.col("p_partkey") / SKUS_PER_CATALOG_ROW).alias("catalog_row"),
        )
        .agg(F.concat_ws("|", F.array_sort(F.collect_list(F.col("p_partkey").cast("string")))).alias("sku_list"))
        .withColumn(
            "salesforce_feature_mode",
            F.when(F.regexp_extract("group_key", r"(\d+)$", 1).cast("int") % 2 == 0, "quantity").otherwise("Dollars"),
        )
    )


def raw_extract(spark, sf_dir) -> DataFrame:
    """Text extract with the code spellings the merge has to undo."""
    sku = F.col("l_partkey").cast("string")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    code = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("PROD_"), sku))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), sku, F.lit(".0")))
        .when(F.col("l_linenumber") == 3, F.lower("p_brand"))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit("item-"), sku))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit("X"), sku))
        .otherwise(sku)
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(regions(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            code.alias("raw_product"),
            "Division",
            F.date_format("l_shipdate", "MMMM").alias("raw_month"),
            F.concat(F.lit("FY"), F.date_format("l_shipdate", "yy")).alias("raw_fy_short"),
            F.year("l_shipdate").alias("fy"),
            F.col("l_quantity").cast("string").alias("value"),
            F.col("l_linestatus").alias("source_sheet"),
        )
        .withColumn(
            "raw_fy",
            F.when(F.col("fy") >= 2000, F.col("raw_fy_short")).otherwise(F.col("fy").cast("string")),
        )
        .drop("raw_fy_short", "fy")
    )


def stored_order_lines(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    """What snapshot lines and signals take of the order lines, joined once, their months written as text once, and stored."""
    return stored(_with_month_texts(order_lines(spark, sf_dir, lines)).select(
        *SERIES, "order_month", *MONTH_TEXTS, "o_custkey", "o_orderstatus", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    ))


MONTH_TEXTS = ["Month", "Close Date"]


def _with_month_texts(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"Month": F.date_format("order_month", "yyyy-MM"), "Close Date": F.date_format("ship_month", "MM/dd/yyyy")})


def snapshot_lines(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    """Pipeline snapshot lines: one per order line, two source files by order status."""
    probability = F.lit(100.0) * (F.lit(1.0) - F.col("l_discount"))
    return (_with_month_texts(order_lines(spark, sf_dir)) if lines is None else lines).select(
        *MONTH_TEXTS,
        F.col("Division").alias("Business Unit"),
        F.when(F.col("l_returnflag") != "A", F.col("Product")).alias("Product Code"),
        F.concat(F.lit("Name "), F.col("Product")).alias("Current OSC Product Name"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("Account Name"),
        F.col("Product").alias("Opportunity Name"),
        F.when(F.col("o_orderstatus") != "P", F.col("l_quantity")).alias("Quantity"),
        F.col("l_quantity").alias("Quantity W/ Decimal"),
        probability.alias("Probability"),
        F.col("l_extendedprice").alias("Total Price"),
        F.floor(F.col("l_quantity") / 2).cast("double").alias("Factored Quantity"),
        F.floor(F.col("l_extendedprice") / 2).cast("double").alias("Factored Revenue"),
        F.concat(F.lit("snap_"), F.col("o_orderstatus")).alias("_source_file"),
    )


def aliases(spark, sf_dir) -> DataFrame:
    """Alias names of the products, known for three of the divisions."""
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("group_key")).distinct()
    units = F.explode(F.array(*[F.lit(u) for u in ("R0", "R2", "R4")]))
    return brands.select(
        units.alias("business_unit_code"), "group_key",
        F.concat(F.lit("Name "), F.col("group_key")).alias("salesforce_product_name"),
    )


def series_modes(spark, sf_dir, series: DataFrame) -> DataFrame:
    """Feature mode of each series of the fact, from the catalog."""
    from seriesloom.functions.codes import normalize_code
    from seriesloom.operators.prepare import feature_modes

    modes = feature_modes(catalog(spark, sf_dir)).withColumnRenamed("Product", "code")
    keyed = series.withColumn("code", normalize_code("Product"))
    return keyed.join(modes, ["code", "Division"]).select(*SERIES, "mode")


def signal_summary(spark, sf_dir, lines: DataFrame | None = None) -> DataFrame:
    """Monthly signal summary by (group_key, BU) from order months."""
    return (
        (order_lines(spark, sf_dir) if lines is None else lines)
        .groupBy(
            F.col("Product").alias("group_key"),
            F.col("Division").alias("BU"),
            F.col("order_month").alias("Month"),
        )
        .agg(
            F.sum(F.floor("l_extendedprice")).cast("double").alias("Sum_Total_Price"),
            F.sum("l_quantity").alias("Sum_Quantity"),
            F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("Open_Opportunities"),
            F.count(F.lit(1)).cast("double").alias("New_Opportunities"),
        )
    )


def cell_summary(cells: DataFrame) -> DataFrame:
    """The signal summary from order cells."""
    return cells.groupBy(F.col("Product").alias("group_key"), F.col("Division").alias("BU"), F.col("order_month").alias("Month")).agg(
        F.sum("price").cast("double").alias("Sum_Total_Price"),
        F.sum("qty").alias("Sum_Quantity"),
        F.sum("n_open").cast("double").alias("Open_Opportunities"),
        F.sum("n_lines").cast("double").alias("New_Opportunities"),
    )


# Holdout of simple reference forecasts, one per blend family.
def _means(n: int):
    return F.avg("y").over(by_month().rowsBetween(-n, -1))


def simple_forecasts(fact: DataFrame, horizon: int = 12) -> DataFrame:
    """Simple forecasts of the last `horizon` months from the months before them.

    Columns Date, Actual plus one column per model; every series keeps its own last month.
    """
    from seriesloom.operators.forecasters.sba import prefix_forecasts

    ordered = fact.filter(F.col("Actuals").isNotNull()).select(*SERIES, "Month", F.col("Actuals").alias("y"))
    w = by_month()
    back = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("Month").desc()))
    rows = (
        ordered.withColumn("rn", F.row_number().over(w))
        .withColumn("back", back)
        .withColumn("naive", F.lag("y", 12).over(w))
        .withColumn("naive2", F.lag("y", 24).over(w))
        .withColumn("ma3", _means(3))
        .withColumn("ma6", _means(6))
        .withColumn("ma12", _means(12))
    )
    sba = prefix_forecasts(ordered).select(*SERIES, "Month", F.col("forecast").alias("sba"))
    return rows.join(sba, [*SERIES, "Month"]).select(
        *SERIES, "Month", "y", "rn", "back", "naive", "naive2", "ma3", "ma6", "ma12", "sba"
    )


SIMPLE_MODELS = {
    "SARIMA_baseline": "naive",
    "SARIMAX_Bookings_l1": "(naive + naive2) / 2",
    "ETS_baseline": "ma6",
    "PROPHET": "ma12",
    "SBA": "sba",
    "ML_GBR": "ma3",
}


def simple_holdout(fact: DataFrame, horizon: int = 12) -> DataFrame:
    """Holdout table of the simple forecasts: level models stay flat from the cut."""
    rows = simple_forecasts(fact, horizon)
    level = {c: F.max(F.when(F.col("back") == horizon, F.col(c))).over(Window.partitionBy(*SERIES))
             for c in ("ma3", "ma6", "ma12", "sba")}
    rows = rows.withColumns(level).filter(F.col("back") <= horizon)
    models = F.array(
        *[F.struct(F.lit(m).alias("Model"), F.expr(e).alias("Forecast")) for m, e in SIMPLE_MODELS.items()]
    )
    return rows.select(*SERIES, F.col("Month").alias("Date"), F.col("y").alias("Actual"),
                       F.explode(models).alias("m")).select(
        *SERIES, "m.Model", "Date", "Actual", "m.Forecast"
    )


def simple_metrics(fact: DataFrame, min_train: int = 24) -> DataFrame:
    """Test_MAE, Test_RMSE on the holdout and one-step ROCV_MAE of the simple forecasts."""
    from seriesloom.operators.metrics import error_metrics

    rows = simple_forecasts(fact).filter(F.col("rn") > min_train)
    rocv = rows.groupBy(*SERIES).agg(
        *[F.avg(F.abs(F.col("y") - F.expr(e))).alias(m) for m, e in SIMPLE_MODELS.items()]
    )
    rocv = rocv.unpivot(SERIES, list(SIMPLE_MODELS), "Model", "ROCV_MAE")
    return error_metrics(simple_holdout(fact)).join(rocv, [*SERIES, "Model"], "left")


# Monthly runs of simple forecasts, one per month of the year up to the current run.
FIRST_RUN, CURRENT_RUN = "2001-01-01", "2001-09-01"
RUN_MODELS = {"baseline_sarima": "naive", "baseline_ets": "roll_mean_3", "sba": "roll_mean_6", "prophet": "roll_mean_12"}


def run_forecasts(fact: DataFrame, horizon: int = 12) -> DataFrame:
    """Forecast rows of every run: a run starts in its own month and uses the months before it."""
    from seriesloom.operators.lags import month_lags

    starts = month_lags(fact).filter(F.col("Month").between(FIRST_RUN, CURRENT_RUN)).select(
        *SERIES, F.col("Month").alias("run_month"), "roll_mean_3", "roll_mean_6", "roll_mean_12"
    )
    steps = starts.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    steps = steps.withColumn("forecast_month", F.add_months("run_month", F.col("h") - 1))
    year_ago = fact.select(*SERIES, F.add_months("Month", 12).alias("forecast_month"), F.col("Actuals").alias("naive"))
    models = F.array(*[F.struct(F.lit(g).alias("model_group"), F.col(c).alias("forecast_value")) for g, c in RUN_MODELS.items()])
    return steps.join(year_ago, [*SERIES, "forecast_month"], "left").select(
        F.col("Product").alias("product_id"), F.col("Division").alias("bu_id"), "run_month", "forecast_month",
        F.col("h").alias("horizon_months_ahead"), F.explode(models).alias("m"),
    ).select("product_id", "bu_id", "run_month", "forecast_month", "horizon_months_ahead", "m.*")
