"""Softmax blend of model families, on the holdout and on forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.labels import blend_family
from seriesloom.functions.numeric import finite, floor_zero, one_of
from seriesloom.operators.metrics import wape
from seriesloom.schema import SERIES

FAMILY = [*SERIES, "Model_Family", "Model"]


def with_horizon(holdout: DataFrame) -> DataFrame:
    """Horizon = dense rank of Date over all models of the series."""
    w = Window.partitionBy(*SERIES).orderBy("Date")
    return holdout.filter(F.col("Date").isNotNull()).withColumn("Horizon", F.dense_rank().over(w))


def family_rows(holdout: DataFrame) -> DataFrame:
    return (
        with_horizon(holdout)
        .withColumn("Model_Family", blend_family(F.col("Model")))
        .filter("Model_Family is not null")
        .withColumn("Actual", finite("Actual"))
        .withColumn("Forecast", finite("Forecast"))
    )


def best_per_family(rows: DataFrame) -> DataFrame:
    """Model of each family with the lowest WAPE over the whole holdout."""
    overall = rows.groupBy(*FAMILY).agg(wape(F.col("Actual"), F.col("Forecast")).alias("WAPE"))
    best = overall.filter("WAPE is not null").groupBy(*SERIES, "Model_Family").agg(
        F.min_by(F.struct("Model", "WAPE"), F.struct(F.round("WAPE", 9), "Model")).alias("m")
    )
    return best.select(*SERIES, "Model_Family", "m.Model", "m.WAPE")


def softmax(scores: DataFrame, by, config: cfg.BlendConfig = cfg.BlendConfig()) -> DataFrame:
    """Adds Weight: exp of the relative WAPE gap to the best, normalised within `by`."""
    w = Window.partitionBy(*by)
    best = F.min("WAPE").over(w)
    gap = (F.col("WAPE") - best) / F.greatest(best, F.lit(config.eps))
    raw = scores.filter("WAPE is not null").withColumn("raw", F.exp(-gap / max(config.tau, config.eps)))
    return raw.withColumn("Weight", F.col("raw") / F.sum("raw").over(w)).drop("raw")


def _chosen_rows(rows: DataFrame, best: DataFrame) -> DataFrame:
    return rows.join(best.select(*FAMILY), FAMILY)


def holdout_weights(holdout: DataFrame, config: cfg.BlendConfig = cfg.BlendConfig()) -> DataFrame:
    """Weights of the best model per family: one set per horizon and one overall (Horizon null)."""
    rows = family_rows(holdout)
    best = best_per_family(rows)
    per_horizon = _chosen_rows(rows, best).groupBy(*FAMILY, "Horizon").agg(
        wape(F.col("Actual"), F.col("Forecast")).alias("WAPE")
    )
    horizon = softmax(per_horizon, [*SERIES, "Horizon"], config).withColumn("Weight_Source", F.lit("holdout_horizon"))
    overall = softmax(best.withColumn("Horizon", F.lit(None).cast("int")), SERIES, config).withColumn(
        "Weight_Source", F.lit("holdout_overall")
    )
    return horizon.unionByName(overall).select(
        *SERIES, "Horizon", "Model_Family", "Model", "WAPE", "Weight", F.lit(config.tau).alias("Tau"), "Weight_Source"
    )


def blend_holdout(holdout: DataFrame, config: cfg.BlendConfig = cfg.BlendConfig()) -> DataFrame:
    """Blended rows of the holdout: weights of the horizon, else the overall ones,
    renormalised over the forecasts that exist."""
    rows = family_rows(holdout)
    weights = holdout_weights(holdout, config)
    cells = _chosen_rows(rows, best_per_family(rows)).groupBy(*FAMILY, "Date", "Horizon").agg(
        F.avg("Forecast").alias("Forecast"), F.sum("Actual").alias("asum"), F.count("Actual").alias("an")
    )
    per_h = weights.filter("Weight_Source = 'holdout_horizon'").select(*FAMILY, "Horizon", F.col("Weight").alias("wh"))
    overall = weights.filter("Weight_Source = 'holdout_overall'").select(*FAMILY, F.col("Weight").alias("wo"))
    joined = cells.join(per_h, [*FAMILY, "Horizon"], "left").join(overall, FAMILY, "left")
    step = [*SERIES, "Date", "Horizon"]
    has_h = F.max(F.col("wh").isNotNull()).over(Window.partitionBy(*step))
    w = F.when(has_h, F.col("wh")).otherwise(F.col("wo"))
    joined = joined.withColumn("w", F.when(F.col("Forecast").isNotNull(), w))
    total = F.sum("w")
    return (
        joined.groupBy(*step)
        .agg(
            F.try_divide(F.sum("asum"), F.sum("an")).alias("Actual"),
            F.when(total > config.eps, F.sum(F.col("w") * F.col("Forecast")) / total).alias("Forecast"),
        )
        .filter("Forecast is not null")
        .select(*SERIES, F.lit(cfg.BLEND_MODEL).alias("Model"), "Date", "Actual", "Forecast")
    )


def blend_rocv(holdout: DataFrame, metrics: DataFrame, config: cfg.BlendConfig = cfg.BlendConfig()) -> DataFrame:
    """ROCV of the blend: overall weights over the families that have one."""
    overall = holdout_weights(holdout, config).filter("Weight_Source = 'holdout_overall'")
    j = overall.join(metrics.select(*SERIES, "Model", finite("ROCV_MAE").alias("r")), [*SERIES, "Model"], "left")
    w = F.when(F.col("r").isNotNull(), F.col("Weight"))
    return j.groupBy(*SERIES).agg(
        F.when(F.sum(w) > config.eps, F.sum(w * F.col("r")) / F.sum(w)).alias("ROCV_MAE")
    ).withColumn("Model", F.lit(cfg.BLEND_MODEL))


def with_blend(metrics: DataFrame, holdout: DataFrame, config: cfg.BlendConfig = cfg.BlendConfig()):
    """Metrics and holdout tables with the blend as one more model."""
    from seriesloom.operators.metrics import error_metrics

    rows = blend_holdout(holdout, config)
    own = error_metrics(rows).join(blend_rocv(holdout, metrics, config), [*SERIES, "Model"], "left")
    keep = [*SERIES, "Model", "Test_MAE", "Test_RMSE", "ROCV_MAE"]
    return metrics.select(*keep).unionByName(own.select(*keep)), holdout.select(*rows.columns).unionByName(rows)


def blend_forecast(library: DataFrame, weights: DataFrame, config: cfg.BlendConfig = cfg.BlendConfig()) -> DataFrame:
    """Blended forecast per series and horizon.

    Weights come from the horizon, else overall, else equal over the families present.
    A series with no weights at all gets no blend. Each family counts with its first ok row by model group.
    """
    keys = ["product_id", "bu_id"]
    ok = (
        library.filter("model_status = 'ok'")
        .withColumn("family", one_of(cfg.FAMILY_BY_GROUP, F.col("model_group")))
        .filter("family is not null")
        .withColumnRenamed("horizon_months_ahead", "Horizon")
    )
    first = F.struct("model_group", "forecast_value", "forecast_month", "run_id", "training_start", "training_end")
    cells = ok.groupBy(*keys, "family", "Horizon").agg(F.min(first).alias("r")).select(
        *keys, "family", "Horizon", "r.forecast_value", "r.forecast_month", "r.run_id", "r.training_start", "r.training_end"
    )
    named = weights.select(
        F.col("Product").alias("product_id"), F.col("Division").alias("bu_id"),
        F.col("Model_Family").alias("family"), "Horizon", "Weight", "Weight_Source",
    )
    per_h = named.filter("Weight_Source = 'holdout_horizon'").select(*keys, "family", "Horizon", F.col("Weight").alias("wh"))
    overall = named.filter("Weight_Source = 'holdout_overall'").select(*keys, "family", F.col("Weight").alias("wo"))
    known = named.select(*keys).distinct()
    step = Window.partitionBy(*keys, "Horizon")
    # A family may carry weight without a forecast: it takes part in the top-2 text, not in the sum.
    grid = cells.select(*keys, "Horizon").distinct().join(overall, keys).select(*keys, "Horizon", "family")
    grid = grid.unionByName(cells.select(*keys, "Horizon", "family")).unionByName(per_h.select(*keys, "Horizon", "family").join(
        cells.select(*keys, "Horizon").distinct(), [*keys, "Horizon"], "left_semi")).distinct()
    j = (
        grid.join(known, keys, "left_semi")
        .join(cells, [*keys, "Horizon", "family"], "left")
        .join(per_h, [*keys, "Horizon", "family"], "left")
        .join(overall, [*keys, "family"], "left")
    )
    j = j.withColumn("has_h", F.max(F.col("wh").isNotNull()).over(step)).withColumn(
        "has_o", F.max(F.col("wo").isNotNull()).over(step)
    )
    n_families = F.count("forecast_value").over(step)
    j = j.withColumn(
        "Weight",
        F.when(F.col("has_h"), F.col("wh")).when(F.col("has_o"), F.col("wo"))
        .when(F.col("forecast_value").isNotNull(), F.try_divide(F.lit(1.0), n_families)),
    ).withColumn(
        "Weight_Source",
        F.when(F.col("has_h"), "holdout_horizon").when(F.col("has_o"), "holdout_overall").otherwise("equal_fallback"),
    )
    j = j.filter("Weight is not null")
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.round("Weight", 9)).alias("o"), "family"))), 1, 2)
    usable = F.when(finite("forecast_value").isNotNull(), F.col("Weight"))
    return (
        j.groupBy(*keys, "Horizon")
        .agg(
            floor_zero(F.try_divide(F.sum(usable * F.col("forecast_value")), F.sum(usable))).alias("forecast_value"),
            F.sum(usable).alias("wsum"),
            F.max("forecast_month").alias("forecast_month"),
            F.max("run_id").alias("run_id"),
            F.min("training_start").alias("training_start"),
            F.max("training_end").alias("training_end"),
            F.transform(top, lambda t: t["family"]).alias("blend_top_families"),
            F.first("Weight_Source").alias("weight_source"),
        )
        .filter(F.col("wsum") > config.eps)
        .select(
            *keys, "forecast_month", "forecast_value", F.lit(cfg.BLEND_MODEL).alias("model_group"),
            F.lit("BLEND").alias("model_type"), F.lit("ok").alias("model_status"),
            F.col("Horizon").alias("horizon_months_ahead"), "run_id", "training_start", "training_end",
            "blend_top_families", "weight_source",
        )
    )
