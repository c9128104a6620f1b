"""Queries: forecast library, flags, blended forecast, export and closed-month compile."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators import backtest as K
from seriesloom.operators import blend as B
from seriesloom.operators import library as Y
from seriesloom.operators import prepare as P
from seriesloom.operators import selection as S
from seriesloom.plans import ctes as C
from seriesloom.plans.evaluation import BLEND, both_of, fact_of
from seriesloom.plans.registry import query, with_ctes
from seriesloom.schema import SERIES
from seriesloom.sources import driver_tables as D

RUNS = """
lagm AS (SELECT *, avg(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS r3,
    avg(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS r6,
    avg(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS r12 FROM (SELECT *, year(Month) * 12 + month(Month) AS m FROM fact)),
runs AS (SELECT s.*, f.Actuals AS naive FROM (SELECT Product, Division, Month AS run_month, r3, r6, r12, h, (Month + to_months((h - 1)::INT))::DATE AS forecast_month
    FROM lagm, (SELECT unnest(range(1, 13)) AS h) WHERE Month BETWEEN DATE '2001-01-01' AND DATE '2001-09-01') s
  LEFT JOIN fact f ON f.Product = s.Product AND f.Division = s.Division AND f.Month + INTERVAL 12 MONTH = s.forecast_month),
lib0 AS (SELECT Product AS product_id, Division AS bu_id, run_month, forecast_month, h AS horizon_months_ahead, 'baseline_sarima' AS model_group, 'SARIMA' AS model_type, 'Seasonal Baseline' AS model_label, naive AS v FROM runs
  UNION ALL SELECT Product, Division, run_month, forecast_month, h, 'baseline_ets', 'ETS', 'ETS Baseline', r3 FROM runs
  UNION ALL SELECT Product, Division, run_month, forecast_month, h, 'sba', 'SBA', 'SBA', r6 FROM runs
  UNION ALL SELECT Product, Division, run_month, forecast_month, h, 'prophet', 'PROPHET', 'PROPHET', r12 FROM runs),
lib AS (SELECT product_id, bu_id, run_month, forecast_month, horizon_months_ahead, model_group, model_type, model_label, CASE WHEN v IS NOT NULL THEN greatest(v, 0) END AS forecast_value,
    CASE WHEN v IS NULL THEN 'failed' ELSE 'ok' END AS model_status FROM lib0)
"""
LIB_COLUMNS = ["product_id", "bu_id", "run_month", "forecast_month", "horizon_months_ahead", "model_group", "model_type", "model_label", "forecast_value", "model_status"]


def runs_of(fact):
    """All runs in the library schema, with their run month."""
    rows = D.run_forecasts(fact)
    out = Y.library_rows(rows, run_id="run")
    return out.withColumn("run_month", F.add_months("forecast_month", 1 - F.col("horizon_months_ahead")))


def current_of(fact):
    return runs_of(fact).filter(F.col("run_month") == F.lit(D.CURRENT_RUN).cast("date"))


def choices_of(spark, sf):
    m, h = both_of(spark, sf)
    rec = cut_lineage(S.select_model(m, h))
    return S.model_choices(S.model_summary(m, rec), rec), h


@query("forecast_library", with_ctes(C.FACT, RUNS, body="SELECT * FROM lib"), "forecast_value")
def forecast_library(spark, sf):
    return runs_of(fact_of(spark, sf)).select(*LIB_COLUMNS)


GATED = C.PART_FACT + """,
prof AS (SELECT Product, Division, count(Actuals) AS n, datediff('month', min(CASE WHEN Actuals <> 0 THEN Month END), max(Month)) AS s, max(Month) AS lm FROM pf GROUP BY ALL),
skipped AS (SELECT Product, Division, lm, 'baseline_sarima' AS model_group, 'N/A: history <12 months or first non-zero actual is <12 months ago.' AS reason FROM prof WHERE NOT (n >= 12 AND s >= 11)
  UNION ALL SELECT Product, Division, lm, 'with_regressor', CASE WHEN n < 36 THEN 'N/A: history <36 months; SARIMAX disabled.' WHEN NOT (n >= 12 AND s >= 11) THEN 'N/A: SARIMA prerequisites not met.' ELSE 'N/A: no regressor selected or exog unavailable.' END FROM prof)
"""


@query("na_rows", with_ctes(GATED, body="""SELECT Product AS product_id, Division AS bu_id, (lm + to_months(h::INT))::DATE AS forecast_month, h AS horizon_months_ahead, model_group,
  CASE WHEN model_group = 'with_regressor' THEN 'SARIMAX' ELSE 'SARIMA' END AS model_type, 'N/A' AS model_status, reason AS model_status_reason FROM skipped, (SELECT unnest(range(1, 13)) AS h)"""))
def na_rows(spark, sf):
    fact = cut_lineage(D.part_fact(spark, sf))
    gates = P.series_gates(P.series_profile(fact))
    choices = fact.select(*SERIES).distinct().withColumn("reg_name", F.lit(None).cast("string"))
    future = K.future_months(fact).select(F.col("Product").alias("product_id"), F.col("Division").alias("bu_id"),
                                          F.col("Month").alias("forecast_month"), F.col("horizon").alias("horizon_months_ahead"))
    return Y.na_rows(future, Y.status_reasons(gates, choices), "run").select(
        "product_id", "bu_id", "forecast_month", "horizon_months_ahead", "model_group", "model_type", "model_status", "model_status_reason")


FLAGGED = C.SCORED + "," + RUNS + """,
cur AS (SELECT * FROM lib WHERE run_month = DATE '2001-09-01'),
pref AS (SELECT Product, Division, CASE Recommended_Model WHEN 'SARIMA_baseline' THEN 'baseline_sarima' WHEN 'SARIMAX_Bookings_l1' THEN 'with_regressor' WHEN 'ETS_baseline' THEN 'baseline_ets' WHEN 'SBA' THEN 'sba' WHEN 'ML_GBR' THEN 'ml_gbr' WHEN 'PROPHET' THEN 'prophet' END AS preferred FROM selected),
ranked AS (SELECT c.*, CASE WHEN model_status = 'ok' THEN CASE WHEN model_group = preferred THEN 0 ELSE CASE model_group WHEN 'baseline_sarima' THEN 1 WHEN 'baseline_ets' THEN 3 WHEN 'sba' THEN 4 WHEN 'prophet' THEN 7 END END END AS rk
  FROM cur c LEFT JOIN pref p ON p.Product = c.product_id AND p.Division = c.bu_id),
flagged AS (SELECT * EXCLUDE (rk), coalesce(rk = min(rk) OVER (PARTITION BY product_id, bu_id), false) AS recommended_model FROM ranked)
"""


@query("recommended_flags", with_ctes(FLAGGED, body="SELECT product_id, bu_id, forecast_month, model_group, forecast_value, model_status, recommended_model FROM flagged"), "forecast_value")
def recommended_flags(spark, sf):
    choices, _ = choices_of(spark, sf)
    return Y.flag_recommended(current_of(fact_of(spark, sf)), choices).select(
        "product_id", "bu_id", "forecast_month", "model_group", "forecast_value", "model_status", "recommended_model")


BLENDED = """
bc AS (SELECT product_id, bu_id, horizon_months_ahead AS Horizon, forecast_month, forecast_value, CASE model_group WHEN 'baseline_sarima' THEN 'SARIMA' WHEN 'baseline_ets' THEN 'ETS' WHEN 'sba' THEN 'SBA' ELSE 'PROPHET' END AS family
  FROM lib WHERE run_month = DATE '2001-09-01' AND model_status = 'ok'),
hz AS (SELECT product_id, bu_id, Horizon, any_value(forecast_month) AS forecast_month FROM bc GROUP BY product_id, bu_id, Horizon),
bw AS (SELECT z.product_id, z.bu_id, z.Horizon, z.forecast_month, w.Model_Family AS family, w.Weight, c.forecast_value FROM hz z
  JOIN weights w ON w.Product = z.product_id AND w.Division = z.bu_id AND w.Horizon = z.Horizon
  LEFT JOIN bc c ON c.product_id = z.product_id AND c.bu_id = z.bu_id AND c.Horizon = z.Horizon AND c.family = w.Model_Family),
bf AS (SELECT product_id, bu_id, Horizon AS horizon_months_ahead, any_value(forecast_month) AS forecast_month,
    greatest(sum(Weight * forecast_value) / sum(CASE WHEN forecast_value IS NOT NULL THEN Weight END), 0) AS forecast_value,
    list(family ORDER BY round(Weight, 9) DESC, family)[1:2] AS fams, 'holdout_horizon' AS weight_source
  FROM bw GROUP BY product_id, bu_id, Horizon HAVING sum(CASE WHEN forecast_value IS NOT NULL THEN Weight END) > 1e-9)
"""


@query("blend_forecast", with_ctes(BLEND, RUNS, BLENDED, body="SELECT product_id, bu_id, horizon_months_ahead, forecast_month, forecast_value, array_to_string(fams, ',') AS blend_top_families, weight_source FROM bf"), "forecast_value")
def blend_forecast(spark, sf):
    fact = fact_of(spark, sf)
    weights = B.holdout_weights(cut_lineage(D.simple_holdout(fact)))
    return B.blend_forecast(current_of(fact), weights).select(
        "product_id", "bu_id", "horizon_months_ahead", "forecast_month", "forecast_value", "blend_top_families", "weight_source")


def _case(column: str, values: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


EXPORT = FLAGGED + "," + BLEND.replace(C.SIMPLE + ",", "") + "," + BLENDED + f""",
winners AS (SELECT product_id, bu_id, forecast_month, model_type, horizon_months_ahead, forecast_value, true AS recommended_model, {_case('model_group', cfg.MODEL_DESCRIPTIONS)} AS forecast_description FROM flagged WHERE recommended_model
  UNION ALL SELECT product_id, bu_id, forecast_month, 'BLEND', horizon_months_ahead, forecast_value, false,
    'Weighted blend leaning toward ' || fams[1] || ' and ' || fams[2] || '; balances ' || {_case('fams[1]', cfg.FAMILY_SNIPPETS)} || ' and ' || {_case('fams[2]', cfg.FAMILY_SNIPPETS)} || ' based on recent accuracy.' FROM bf)
"""


@query("forecast_export", with_ctes(EXPORT, body="""SELECT product_id || '|' || bu_id || '|' || strftime(forecast_month, '%b %y') || '|' || model_type AS product_bu_forecast_month_model_type, product_id, bu_id,
  strftime(forecast_month, '%m/%d/%Y') AS forecast_month, model_type, horizon_months_ahead, forecast_value, recommended_model, forecast_description FROM winners"""), "forecast_value")
def forecast_export(spark, sf):
    choices, holdout = choices_of(spark, sf)
    current = cut_lineage(current_of(fact_of(spark, sf)))
    blend = B.blend_forecast(current, B.holdout_weights(holdout))
    flagged = Y.flag_recommended(Y.union_variants(current, blend), choices)
    return Y.export_layout(Y.winners_and_blend(flagged)).select(
        "product_bu_forecast_month_model_type", "product_id", "bu_id", "forecast_month", "model_type", "horizon_months_ahead",
        "forecast_value", "recommended_model", "forecast_description")


@query("closed_months", with_ctes(C.FACT, RUNS, body="""SELECT unnest(generate_series(date_trunc('year', f), f - INTERVAL 1 MONTH, INTERVAL 1 MONTH))::DATE AS forecast_month
  FROM (SELECT min(forecast_month)::TIMESTAMP AS f FROM lib WHERE run_month = DATE '2001-09-01')"""))
def closed_months(spark, sf):
    return Y.closed_months(current_of(fact_of(spark, sf)))


@query("compile_closed_months", with_ctes(C.FACT, RUNS, body="""SELECT product_id, bu_id, forecast_month, model_type, forecast_value FROM lib WHERE run_month = DATE '2001-09-01'
  UNION ALL SELECT product_id, bu_id, forecast_month, model_type, forecast_value FROM lib a WHERE run_month = forecast_month AND forecast_month < DATE '2001-09-01' AND year(forecast_month) = 2001
    AND NOT EXISTS (SELECT 1 FROM lib c WHERE c.run_month = DATE '2001-09-01' AND c.product_id = a.product_id AND c.bu_id = a.bu_id AND c.forecast_month = a.forecast_month AND c.model_type = a.model_type)"""), "forecast_value")
def compile_closed_months(spark, sf):
    runs = cut_lineage(runs_of(fact_of(spark, sf)))
    here = runs["run_month"] == F.lit(D.CURRENT_RUN).cast("date")
    current = runs.filter(here).drop("run_month")
    archive = runs.filter(~here).withColumn("extra_column", F.lit("x")).drop("upper_ci")
    return Y.compile_closed(current, archive).select("product_id", "bu_id", "forecast_month", "model_type", "forecast_value")


@query("latest_run", with_ctes(C.FACT, RUNS, body="SELECT product_id, bu_id, run_month, forecast_month, model_type, forecast_value FROM lib WHERE run_month = (SELECT max(run_month) FROM lib)"), "forecast_value")
def latest_run(spark, sf):
    from seriesloom.sources.files import latest_run as newest

    return newest(cut_lineage(runs_of(fact_of(spark, sf)))).select("product_id", "bu_id", "run_month", "forecast_month", "model_type", "forecast_value")
