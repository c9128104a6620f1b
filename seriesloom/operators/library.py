"""Forecast library: variants, status, flags, layout and closed-month compile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions import codes, labels, numeric
from seriesloom.schema import require_columns

KEY = ["product_id", "bu_id"]
COMPILE_KEY = [*KEY, "forecast_month", "model_type"]

LIBRARY = [
    "product_id", "bu_id", "forecast_month", "forecast_value", "lower_ci", "upper_ci", "model_group",
    "model_type", "model_label", "regressor_names", "regressor_lag", "model_status", "model_status_reason",
    "run_id", "training_start", "training_end", "horizon_months_ahead",
]

TYPE_BY_GROUP = {
    "baseline_sarima": "SARIMA", "with_regressor": "SARIMAX", "baseline_ets": "ETS", "sba": "SBA",
    "ml_gbr": "ML", "ml_gbr_pipeline": "ML", "prophet": "PROPHET", cfg.BLEND_MODEL: "BLEND",
}


def library_rows(forecasts: DataFrame, run_id: str) -> DataFrame:
    """Forecasts (product_id, bu_id, model_group, forecast_month, h, value, ...) in the library schema.

    A value that is missing makes the row 'failed'; known values and lower bounds are floored at 0.
    """
    has = set(forecasts.columns)

    def opt(name, kind):
        return F.col(name) if name in has else F.lit(None).cast(kind)

    ok = numeric.finite("forecast_value").isNotNull()
    label = labels.model_label(F.col("model_group"), opt("regressor_names", "string"), opt("regressor_lag", "int"))
    return forecasts.select(
        *KEY,
        "forecast_month",
        numeric.floor_zero(numeric.finite("forecast_value")).alias("forecast_value"),
        numeric.floor_zero(opt("lower_ci", "double")).alias("lower_ci"),
        opt("upper_ci", "double").alias("upper_ci"),
        "model_group",
        numeric.one_of(TYPE_BY_GROUP, F.col("model_group")).alias("model_type"),
        label.alias("model_label"),
        opt("regressor_names", "string").alias("regressor_names"),
        opt("regressor_lag", "int").alias("regressor_lag"),
        F.when(ok, "ok").otherwise("failed").alias("model_status"),
        F.when(~ok | F.col("forecast_value").isNull(), "FAILED: no finite forecast.").alias("model_status_reason"),
        F.lit(run_id).alias("run_id"),
        opt("training_start", "date").alias("training_start"),
        opt("training_end", "date").alias("training_end"),
        "horizon_months_ahead",
    )


def na_rows(future: DataFrame, skipped: DataFrame, run_id: str) -> DataFrame:
    """Twelve null rows with the reason for every (series, group) that was not run.

    `future`: product_id, bu_id, forecast_month, horizon_months_ahead; `skipped`: series, model_group, reason.
    """
    rows = future.join(skipped, KEY)
    null = F.lit(None)
    return rows.select(
        *KEY, "forecast_month", null.cast("double").alias("forecast_value"), null.cast("double").alias("lower_ci"),
        null.cast("double").alias("upper_ci"), "model_group",
        numeric.one_of(TYPE_BY_GROUP, F.col("model_group")).alias("model_type"),
        labels.model_label(F.col("model_group"), null.cast("string"), null.cast("int")).alias("model_label"),
        null.cast("string").alias("regressor_names"), null.cast("int").alias("regressor_lag"),
        F.lit("N/A").alias("model_status"), F.col("reason").alias("model_status_reason"),
        F.lit(run_id).alias("run_id"), null.cast("date").alias("training_start"), null.cast("date").alias("training_end"),
        "horizon_months_ahead",
    )


def flag_recommended(library: DataFrame, choices: DataFrame) -> DataFrame:
    """Adds recommended_model: the preferred group if it has ok rows, else the fixed priority, else the first ok group."""
    preferred = choices.select(
        F.col("Product").alias("product_id"), F.col("Division").alias("bu_id"),
        labels.model_group(F.col("model")).alias("preferred"),
    )
    group, ok = F.col("model_group"), F.col("model_status") == "ok"
    rank = F.when(group == F.col("preferred"), 0)
    for i, g in enumerate(cfg.GROUP_PRIORITY, start=1):
        rank = rank.when(group == g, i)
    rank = rank.otherwise(len(cfg.GROUP_PRIORITY) + 1)
    w = Window.partitionBy(*KEY)
    chosen = F.min(F.when(ok, F.struct(rank.alias("r"), group.alias("g")))).over(w)
    return (
        library.join(preferred, KEY, "left")
        .withColumn("chosen", chosen)
        .withColumn("recommended_model", F.coalesce(ok & (group == F.col("chosen.g")), F.lit(False)))
        .drop("chosen", "preferred")
    )


def winners_and_blend(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("recommended_model") | (F.col("model_group") == cfg.BLEND_MODEL))


def export_layout(rows: DataFrame) -> DataFrame:
    """Key first, description last, working columns dropped, month as MM/DD/YYYY."""
    top = F.col("blend_top_families") if "blend_top_families" in rows.columns else F.array().cast("array<string>")
    out = rows.withColumn("forecast_description", labels.forecast_text(F.col("model_group"), top)).withColumn(
        "product_bu_forecast_month_model_type",
        codes.business_key(F.col("product_id"), F.col("bu_id"), F.col("forecast_month"), F.col("model_type")),
    )
    out = out.withColumn("forecast_month", F.date_format("forecast_month", "MM/dd/yyyy"))
    dropped = {"lower_ci", "upper_ci", "model_group", "model_label", "blend_top_families", "weight_source"}
    ends = {"forecast_description", "product_bu_forecast_month_model_type"}
    middle = [c for c in out.columns if c not in dropped | ends]
    return out.select("product_bu_forecast_month_model_type", *middle, "forecast_description")


def union_variants(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def status_reasons(gates: DataFrame, choices: DataFrame, coverage: DataFrame | None = None) -> DataFrame:
    """(series, model_group, reason) of every variant that may not run."""
    from seriesloom.schema import SERIES

    j = gates.join(choices.select(*SERIES, "reg_name"), SERIES, "left")
    with_reg = F.when(F.col("sarimax_reason").isNotNull(), F.col("sarimax_reason")).when(
        F.col("reg_name").isNull(), "N/A: no regressor selected or exog unavailable."
    )
    entries = [
        F.struct(F.lit("baseline_sarima").alias("model_group"), F.col("sarima_reason").alias("reason")),
        F.struct(F.lit("with_regressor").alias("model_group"), with_reg.alias("reason")),
    ]
    if coverage is not None:
        j = j.join(coverage.select(*SERIES, F.col("Reason").alias("cover")), SERIES, "left")
        entries.append(F.struct(F.lit("ml_gbr_pipeline").alias("model_group"), F.col("cover").alias("reason")))
        entries.append(
            F.struct(F.lit("ml_gbr").alias("model_group"),
                     F.when(F.col("cover").isNull(), "N/A: replaced by the pipeline model.").alias("reason"))
        )
    return (
        j.select(F.col("Product").alias("product_id"), F.col("Division").alias("bu_id"), F.explode(F.array(*entries)).alias("e"))
        .select(*KEY, "e.*").filter("reason is not null")
    )


# ---- compile -------------------------------------------------------------
def align(df: DataFrame, columns) -> DataFrame:
    """Columns of the current run, in order: missing ones null, extra ones dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])


def closed_months(current: DataFrame) -> DataFrame:
    """January up to the month before the first forecast month (no rows when that is January)."""
    first = current.agg(F.min("forecast_month").alias("first"))
    jan = F.trunc("first", "YEAR")
    months = F.when(F.month("first") > 1, F.sequence(jan, F.add_months("first", -1), F.expr("interval 1 month")))
    return first.select(F.explode(months).alias("forecast_month"))


def compile_closed(current: DataFrame, archive: DataFrame, use_regressor: bool = False) -> DataFrame:
    """Current run plus, for each closed month, the rows its own archived run held for that month.

    `archive` carries `run_month` (first month of the run). A row counts only if its forecast month
    is its run month, and only if the current run has no row of the same key.
    """
    key = [*COMPILE_KEY, "regressor_names"] if use_regressor and "regressor_names" in current.columns else COMPILE_KEY
    require_columns(current, key, "current run")
    own_month = archive.filter(F.col("forecast_month") == F.col("run_month"))
    closed = own_month.join(F.broadcast(closed_months(current)), "forecast_month", "left_semi")  # at most 11 rows
    aligned = align(closed, current.columns)
    same = [aligned[c].eqNullSafe(current[c]) for c in key]
    return current.unionByName(aligned.join(current, same, "left_anti"))
