"""Queries: the model jobs. Their fits have no SQL twin; tests hold their invariants.

Trees, folds and holdouts are those of the configuration; what a job decides without a fit has a twin (boosted_folds).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions.labels import model_group
from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators import blend as B
from seriesloom.operators import lags as L
from seriesloom.operators import library as Y
from seriesloom.operators import metrics as M
from seriesloom.operators import prepare as P
from seriesloom.operators import selection as S
from seriesloom.operators.forecasters import arima, boosting, ets, sba, spike, trend
from seriesloom.plans.evaluation import fact_of
from seriesloom.plans import ctes as C
from seriesloom.plans.registry import query, with_ctes
from seriesloom.plans.snapshots import Inputs, _asof
from seriesloom.schema import SERIES
from seriesloom.sources import driver_tables as D


def orders_of(fact):
    """A fixed order for every series; a searched order table has the same columns."""
    return fact.select(*SERIES).distinct().withColumns({"p": F.lit(1), "q": F.lit(1), "sp": F.lit(0), "sq": F.lit(1)})


def regressors_of(spark, sf):
    return cut_lineage(L.regressor_lags(D.full_fact(spark, sf).filter("Actuals is not null")))


def per_series(fact, holdout, rocv, model):
    """One row per series of the fact; without a holdout or a rolling origin its metrics are null and Status says so."""
    key = [*SERIES, "Model"]
    status = F.when(F.col("Test_MAE").isNull(), "NOT_SCORED").when(F.col("ROCV_MAE").isNull(), "NO_ROLLING_ORIGIN").otherwise("OK")
    every = fact.select(*SERIES).distinct().withColumn("Model", F.lit(model))
    return every.join(M.error_metrics(holdout), key, "left").join(rocv, key, "left").withColumn("Status", status)


@query("arima_search")
def arima_search(spark, sf):
    return arima.search_orders(fact_of(spark, sf))


@query("sarima_forecast")
def sarima_forecast(spark, sf):
    fact = fact_of(spark, sf)
    return arima.forecast(fact, orders_of(fact))


@query("sarimax_forecast")
def sarimax_forecast(spark, sf):
    fact = regressors_of(spark, sf)
    return arima.forecast(fact, orders_of(fact), x="Bookings_l1", model="SARIMAX_Bookings_l1")


@query("sarimax_candidates")
def sarimax_candidates(spark, sf):
    """Every usable (regressor, lag) of every series back-tested at once: the candidate is part of the series key."""
    fact = D.full_fact(spark, sf).filter("Actuals is not null")
    return sarimax_backtest(cut_lineage(fact))[1]


def sarimax_backtest(fact):
    """(holdout, ROCV) of all usable regressor candidates, as models SARIMAX_<name>_l<lag>."""
    long = cut_lineage(L.regressor_long(fact))
    usable = L.regressor_quality(long).filter("usable").select(*SERIES, "Regressor", "Lag")
    rows = long.join(usable, [*SERIES, "Regressor", "Lag"], "left_semi").withColumn(
        "Model", F.concat(F.lit("SARIMAX_"), "Regressor", F.lit("_l"), "Lag")
    )
    # The candidate rides in the product key, so one job fits all candidates of all series.
    keyed = rows.withColumn("Product", F.concat_ws("\u0001", "Product", "Model")).select(*SERIES, "Month", "Actuals", "x")
    holdout, rocv = arima.backtest(keyed, orders_of(keyed), x="x", model="SARIMAX")

    def split(df):
        parts = F.split("Product", "\u0001")
        return df.withColumn("Model", parts[1]).withColumn("Product", parts[0])

    return split(holdout), split(rocv)


@query("sarima_backtest")
def sarima_backtest(spark, sf):
    fact = fact_of(spark, sf)
    return per_series(fact, *arima.backtest(fact, orders_of(fact)), "SARIMA_baseline")


@query("ets_forecast")
def ets_forecast(spark, sf):
    return ets.forecast(fact_of(spark, sf))


@query("ets_backtest")
def ets_backtest(spark, sf):
    fact = fact_of(spark, sf)
    return per_series(fact, *ets.backtest(fact), "ETS_baseline")


@query("trend_forecast")
def trend_forecast(spark, sf):
    return trend.forecast(fact_of(spark, sf))


@query("trend_backtest")
def trend_backtest(spark, sf):
    fact = fact_of(spark, sf)
    return per_series(fact, *trend.backtest(fact), "PROPHET")


def ml_fact(spark, sf):
    """Actuals with the signals that lag models may use."""
    return D.full_fact(spark, sf).filter("Actuals is not null").select(*SERIES, "Month", "Actuals", "Bookings", "Open_Opportunities")


@query("boosted_backtest")
def boosted_backtest(spark, sf):
    fact = ml_fact(spark, sf)
    return per_series(fact, *boosting.backtest(fact), "ML_GBR")


# What the job decides without a fit: usable rows, training rows, origins, the holdout's months and actuals, the reason.
BOOSTED_FOLDS = """ml AS (SELECT Product, Division, Month, Actuals, Bookings, Open_Opportunities FROM full_fact WHERE Actuals IS NOT NULL),
ml1 AS (SELECT *, lag(Actuals, 1) OVER o AS l1, lag(Actuals, 2) OVER o AS l2, lag(Actuals, 3) OVER o AS l3, lag(Actuals, 12) OVER o AS l12, lag(Bookings, 1) OVER o AS b1,
  count(*) OVER (PARTITION BY Product, Division) AS n FROM ml WINDOW o AS (PARTITION BY Product, Division ORDER BY Month)),
ml2 AS (SELECT *, row_number() OVER (PARTITION BY Product, Division ORDER BY Month DESC) AS back, count(*) OVER (PARTITION BY Product, Division) AS m FROM ml1
  WHERE l1 IS NOT NULL AND l2 IS NOT NULL AND l3 IS NOT NULL AND (n < 24 OR l12 IS NOT NULL) AND Bookings IS NOT NULL AND b1 IS NOT NULL AND Open_Opportunities IS NOT NULL),
ml3 AS (SELECT Product, Division, max(m) AS m, min(CASE WHEN back <= 12 THEN Month END) AS first_month, sum(CASE WHEN back <= 12 THEN Actuals END) AS actuals FROM ml2 GROUP BY ALL)"""


@query("boosted_folds", with_ctes(C.FULL, BOOSTED_FOLDS, body="""
  SELECT s.Product, s.Division, CASE WHEN m > 17 THEN m - 12 ELSE 0 END AS n_train, CASE WHEN m > 24 THEN m - 24 ELSE 0 END AS n_origins,
    CASE WHEN m > 17 THEN 12 ELSE 0 END AS n_holdout, CASE WHEN m > 17 THEN first_month END AS first_month, CASE WHEN m > 17 THEN actuals END AS holdout_actuals,
    CASE WHEN m IS NULL OR m <= 17 THEN 'Insufficient ML rows after dropping NaNs.' WHEN m <= 24 THEN 'Insufficient rows for ROCV.' ELSE '' END AS skip_reason
  FROM (SELECT DISTINCT Product, Division FROM ml) s LEFT JOIN ml3 ON s.Product = ml3.Product AND s.Division = ml3.Division"""), "holdout_actuals")
def boosted_folds(spark, sf):
    """The rows, folds and reasons of the fitted job, read from its own results."""
    holdout, rocv = boosting.backtest(ml_fact(spark, sf))
    tests = holdout.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_holdout"), F.min("Date").alias("first_month"), F.sum("Actual").alias("holdout_actuals"))
    return rocv.join(tests, SERIES, "left").select(
        *SERIES, "n_train", "n_origins", F.coalesce("n_holdout", F.lit(0)).alias("n_holdout"), "first_month", "holdout_actuals", F.col("Skip_Reason").alias("skip_reason"))


@query("boosted_forecast")
def boosted_forecast(spark, sf):
    return boosting.forecast(ml_fact(spark, sf))


@query("snapshot_baseline")
def snapshot_baseline(spark, sf):
    fact = fact_of(spark, sf)
    months = fact.select(*SERIES, F.col("Month").alias("snapshot_month"))
    return boosting.snapshot_baseline(fact, months)


def residual_run(spark, sf):
    i = Inputs(spark, sf)
    return boosting.snapshot_model_run(i.fact, i.history(), i.modes, i.summary())


@query("residual_model")
def residual_model(spark, sf):
    return residual_run(spark, sf)["per_series"]


@query("residual_forecast")
def residual_forecast(spark, sf):
    return residual_run(spark, sf)["forecast"]


@query("residual_tables")
def residual_tables(spark, sf):
    """The other tables of the run in one column set: holdout, overall, importance, skipped."""
    tables = residual_run(spark, sf)
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    holdout = tables["holdout"].select(F.lit("holdout").alias("table"), *SERIES, F.col("Date").cast("string").alias("item"), F.col("Actual").alias("first"), F.col("Forecast").alias("second"))
    overall = tables["overall"].select(F.lit("overall").alias("table"), text.alias("Product"), text.alias("Division"), F.expr(
        "stack(4, 'MAE', mean_MAE, 'RMSE', mean_RMSE, 'WAPE', mean_WAPE, 'ROCV_MAE', mean_ROCV_MAE) as (item, first)"), number.alias("second"))
    importance = tables["importance"].select(F.lit("importance").alias("table"), *SERIES, F.col("feature").alias("item"), F.col("importance").alias("first"), number.alias("second"))
    skipped = tables["skipped"].select(F.lit("skipped").alias("table"), *SERIES, F.col("Reason").alias("item"), F.col("history_rows").cast("double").alias("first"), F.col("summary_rows").cast("double").alias("second"))
    return holdout.unionByName(overall).unionByName(importance).unionByName(skipped)


@query("spike_model")
def spike_model(spark, sf):
    return spike.predictions(spike.evaluate(cut_lineage(_asof(spark, sf)[1]), 1.5))


@query("spike_importance")
def spike_importance(spark, sf):
    return spike.importance(spike.evaluate(cut_lineage(_asof(spark, sf)[1]), 1.5))


@query("spike_tuning")
def spike_tuning(spark, sf):
    return spike.tuned(spike.tune(cut_lineage(_asof(spark, sf)[1])))


def full_backtest(fact_with_signals):
    """Metrics and holdout of all per-series forecasters and the blend."""
    fact = fact_with_signals.select(*SERIES, "Month", "Actuals")
    parts = [
        arima.backtest(fact, orders_of(fact)),
        sarimax_backtest(fact_with_signals),
        ets.backtest(fact),
        trend.backtest(fact),
        sba.sba_backtest(fact),
        boosting.backtest(fact_with_signals),
    ]
    columns = [*SERIES, "Model", "Date", "Actual", "Forecast"]
    holdout = rocv = None
    for h, r in parts:
        # Each forecaster's plan is wide; planned together they would take minutes before the first task.
        h, r = cut_lineage(h.select(*columns)), cut_lineage(r.select(*SERIES, "Model", "ROCV_MAE"))
        holdout = h if holdout is None else holdout.unionByName(h)
        rocv = r if rocv is None else rocv.unionByName(r)
    holdout = cut_lineage(holdout)
    metrics = M.error_metrics(holdout).join(rocv, [*SERIES, "Model"], "left")
    return B.with_blend(cut_lineage(metrics), holdout)


@query("full_backtest")
def full_backtest_selection(spark, sf):
    """All forecasters back-tested, blended and ranked by the selection rule; orders are fixed and gates not applied."""
    fact = cut_lineage(D.full_fact(spark, sf).filter("Actuals is not null"))
    metrics, holdout = full_backtest(fact)
    return S.select_model(cut_lineage(metrics), cut_lineage(holdout)).select(
        *SERIES, "Recommended_Model", "Reason", "baseline_model", "baseline_mae", "recommended_mae", "used_bias_override")


@query("forecast_variants")
def forecast_variants(spark, sf):
    """Library rows of the real forecasters with status, reasons, blend and recommended flag."""
    with_signals = regressors_of(spark, sf)
    fact = with_signals.select(*SERIES, "Month", "Actuals")
    orders = orders_of(fact)
    gates = P.series_gates(P.series_profile(fact))
    ok = gates.filter("allow_sarima").select(*SERIES)
    okx = gates.filter("allow_sarimax").select(*SERIES)
    level = sba.sba_forecast(fact).join(
        fact.groupBy(*SERIES).agg(F.max("Month").alias("last")), SERIES
    ).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(12)))).select(
        *SERIES, F.lit("SBA").alias("Model"), F.add_months("last", F.col("h")).alias("Month"), "h", F.col("forecast").alias("Forecast"))
    x = arima.forecast(with_signals, orders.join(okx, SERIES), x="Bookings_l1", model="SARIMAX_Bookings_l1")
    frames = [arima.forecast(fact, orders.join(ok, SERIES)), x, ets.forecast(fact), trend.forecast(fact), level]
    spans = fact.groupBy(*SERIES).agg(F.min("Month").alias("training_start"), F.max("Month").alias("training_end"))
    rows = None
    for f in frames:
        f = f.withColumns({c: F.lit(None).cast("double") for c in ("lower_ci", "upper_ci") if c not in f.columns})
        f = f.select(*SERIES, "Model", "Month", "h", "Forecast", "lower_ci", "upper_ci")
        rows = f if rows is None else rows.unionByName(f)
    rows = rows.join(spans, SERIES).select(
        F.col("Product").alias("product_id"), F.col("Division").alias("bu_id"), model_group(F.col("Model")).alias("model_group"),
        F.col("Month").alias("forecast_month"), F.col("h").alias("horizon_months_ahead"), F.col("Forecast").alias("forecast_value"),
        "lower_ci", "upper_ci", "training_start", "training_end",
        F.when(F.col("Model").startswith("SARIMAX"), "Bookings").alias("regressor_names"),
        F.when(F.col("Model").startswith("SARIMAX"), 1).alias("regressor_lag"),
    )
    library = cut_lineage(Y.library_rows(rows, "run"))
    holdout = cut_lineage(D.simple_holdout(fact))
    blend = B.blend_forecast(library, B.holdout_weights(holdout))
    choices = fact.select(*SERIES).distinct().withColumn("model", F.lit("ETS_baseline"))
    return Y.flag_recommended(Y.union_variants(library, blend), choices).select(
        "product_id", "bu_id", "model_group", "model_type", "forecast_month", "horizon_months_ahead", "forecast_value",
        "lower_ci", "upper_ci", "model_status", "recommended_model")
