"""Queries: back-test, metrics, selection rules and blending on the simple-forecast holdout."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions import labels, numeric
from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators import backtest as K
from seriesloom.operators import blend as B
from seriesloom.operators import metrics as M
from seriesloom.operators import prepare as P
from seriesloom.operators import selection as S
from seriesloom.operators.forecasters import sba
from seriesloom.plans import ctes as C
from seriesloom.plans.registry import query, with_ctes
from seriesloom.schema import SERIES
from seriesloom.sources import driver_tables as D

SBA_SPINE = C.SPINE + "," + C.sba("spine")


def fact_of(spark, sf):
    return cut_lineage(D.monthly_fact(spark, sf))


def holdout_of(spark, sf):
    return cut_lineage(D.simple_holdout(fact_of(spark, sf)))


def both_of(spark, sf):
    """(metrics, holdout), each materialised once."""
    fact = fact_of(spark, sf)
    return cut_lineage(D.simple_metrics(fact)), cut_lineage(D.simple_holdout(fact))


# ---- SBA and origins -------------------------------------------------------
@query("sba_forecast", with_ctes(SBA_SPINE, body="""SELECT s.Product, s.Division, s.n, b.f AS forecast FROM seq s JOIN sba b ON b.Product = s.Product AND b.Division = s.Division AND b.rn = s.rn WHERE back = 1"""), "forecast")
def sba_forecast(spark, sf):
    from seriesloom.plans.preparation import spine

    return sba.sba_forecast(spine(spark, sf))


@query("sba_holdout", with_ctes(SBA_SPINE, body="""SELECT s.Product, s.Division, 'SBA' AS Model, s.Month AS Date, y AS Actual, b.f AS Forecast FROM seq s
  JOIN sba b ON b.Product = s.Product AND b.Division = s.Division AND b.rn = s.n - 12 WHERE back <= 12"""), "Actual Forecast")
def sba_holdout(spark, sf):
    from seriesloom.plans.preparation import spine

    return sba.sba_backtest(spine(spark, sf))[0]


@query("sba_rocv", with_ctes(SBA_SPINE, body="""SELECT s.Product, s.Division, 'SBA' AS Model, avg(abs(y - b.f)) AS ROCV_MAE, count(*) AS n_origins FROM seq s
  JOIN sba b ON b.Product = s.Product AND b.Division = s.Division AND b.rn = s.rn - 1 WHERE s.rn > 24 GROUP BY ALL"""), "ROCV_MAE")
def sba_rocv(spark, sf):
    from seriesloom.plans.preparation import spine

    return sba.sba_backtest(spine(spark, sf))[1]


PROF = C.PART_FACT + """,
cnt AS (SELECT Product, Division, count(*) AS n FROM pf GROUP BY ALL)
"""


def _origins(spark, sf, scheme):
    return K.rolling_origins(P.series_profile(D.part_fact(spark, sf)), scheme)


@query("rolling_origins_one_step", with_ctes(PROF, body="""SELECT Product, Division, i AS train_end, i + 1 AS test_end FROM (SELECT *, unnest(range(24, n)) AS i FROM cnt WHERE n > 24)"""))
def rolling_origins_one_step(spark, sf):
    return _origins(spark, sf, cfg.ONE_STEP)


@query("rolling_origins_six_by_three", with_ctes(PROF, body="""SELECT Product, Division, te - 6 AS train_end, te AS test_end FROM (
    SELECT *, n - (k - i - 1) * 6 AS te FROM (SELECT *, unnest(range(0, k)) AS i FROM (SELECT *, CASE WHEN n >= 24 THEN 3 ELSE greatest(1, n // 6 - 1) END AS k FROM cnt))) WHERE te - 6 > 6"""))
def rolling_origins_six_by_three(spark, sf):
    return _origins(spark, sf, cfg.SIX_BY_THREE)


@query("rolling_origins_last_twelve", with_ctes(PROF, body="""SELECT Product, Division, i AS train_end, i + 12 AS test_end FROM (
    SELECT *, unnest(range(greatest(12, n - 12 - 11), n - 12 + 1)) AS i FROM cnt WHERE n - 12 > 12)"""))
def rolling_origins_last_twelve(spark, sf):
    return _origins(spark, sf, cfg.LAST_TWELVE)


@query("holdout_split", with_ctes(C.PART_FACT, body="""SELECT *, row_number() OVER (PARTITION BY Product, Division ORDER BY Month) AS row_no,
  row_number() OVER (PARTITION BY Product, Division ORDER BY Month DESC) <= 12 AS is_test FROM pf"""), "Actuals")
def holdout_split(spark, sf):
    return K.holdout_split(D.part_fact(spark, sf))


@query("future_months", with_ctes(C.PART_FACT, body="""SELECT Product, Division, (lm + to_months(h::INT))::DATE AS Month, h AS horizon
  FROM (SELECT Product, Division, max(Month) AS lm FROM pf GROUP BY ALL), (SELECT unnest(range(1, 13)) AS h)"""))
def future_months(spark, sf):
    return K.future_months(D.part_fact(spark, sf))


@query("test_window", with_ctes(PROF, body="SELECT Product, Division, n, CASE WHEN n < 24 THEN least(12, greatest(6, n // 4)) ELSE 12 END AS test_rows FROM cnt"))
def test_window(spark, sf):
    prof = P.series_profile(D.part_fact(spark, sf))
    return prof.select(*SERIES, F.col("history_months").alias("n"), numeric.test_window(F.col("history_months")).alias("test_rows"))


# ---- metrics ---------------------------------------------------------------
@query("holdout_table", with_ctes(C.SIMPLE, body="SELECT * FROM holdout"), "Actual Forecast")
def holdout_table(spark, sf):
    return D.simple_holdout(fact_of(spark, sf))


@query("pivot_holdout", with_ctes(C.SIMPLE, body="""SELECT Product, Division, Date, """ + ", ".join(
    f"avg(Forecast) FILTER (WHERE Model = '{m}') AS {m}" for m in D.SIMPLE_MODELS) + " FROM holdout GROUP BY ALL"), " ".join(D.SIMPLE_MODELS))
def pivot_holdout(spark, sf):
    return K.long_to_wide(D.simple_holdout(fact_of(spark, sf)), D.SIMPLE_MODELS)


@query("error_metrics", with_ctes(C.METRICS, body="SELECT * FROM metrics"), "Test_MAE Test_RMSE WAPE ROCV_MAE")
def error_metrics(spark, sf):
    return D.simple_metrics(fact_of(spark, sf))


@query("directional_accuracy", with_ctes(C.SIMPLE, C.MONTHLY, C.DA, body="SELECT * FROM da"), "DA")
def directional_accuracy(spark, sf):
    return M.directional_accuracy(holdout_of(spark, sf))


@query("bias_metrics", with_ctes(C.SIMPLE, C.MONTHLY, body="""SELECT Product, Division, Model, bias, abs(bias) AS abs_bias, bias / den AS bias_pct, abs(bias / den) AS abs_bias_pct FROM (
  SELECT Product, Division, Model, sum(Forecast - Actual) AS bias, CASE WHEN abs(sum(Actual)) > 1e-9 THEN sum(Actual) ELSE 1e-9 END AS den FROM mon GROUP BY ALL)"""), "bias abs_bias bias_pct abs_bias_pct")
def bias_metrics(spark, sf):
    return M.bias_metrics(holdout_of(spark, sf))


@query("weighted_metrics", with_ctes(C.SIMPLE, C.MONTHLY, C.WEIGHTED, body="SELECT * FROM weighted"), "Weighted_MAE Weighted_RMSE bias abs_bias bias_pct abs_bias_pct")
def weighted_metrics(spark, sf):
    return M.weighted_metrics(holdout_of(spark, sf))


@query("position_weighted_mae", with_ctes(C.SIMPLE, body="""SELECT Product, Division, Model, CASE WHEN sum(CASE WHEN err IS NOT NULL THEN w END) > 0 THEN sum(err * w) / sum(CASE WHEN err IS NOT NULL THEN w END) END AS Test_WMAE FROM (
  SELECT *, abs(Actual - Forecast) AS err, CASE WHEN step <= 3 THEN 0.5::DOUBLE / least(3, n) WHEN step <= 6 THEN 0.3::DOUBLE / (least(6, n) - 3) ELSE 0.2::DOUBLE / (least(12, n) - 6) END AS w FROM (
    SELECT *, row_number() OVER (PARTITION BY Product, Division, Model ORDER BY Date) AS step, count(*) OVER (PARTITION BY Product, Division, Model) AS n FROM holdout)) GROUP BY ALL"""), "Test_WMAE")
def position_weighted_mae(spark, sf):
    return M.position_weighted_mae(holdout_of(spark, sf))


# ---- selection -------------------------------------------------------------
@query("select_model", with_ctes(C.SCORED, body="SELECT * FROM selected"), "baseline_mae baseline_rocv baseline_DA baseline_abs_bias_pct")
def select_model(spark, sf):
    return S.select_model(*both_of(spark, sf)).select(
        *SERIES, "Recommended_Model", "Reason", "baseline_model", "baseline_mae", "baseline_rocv", "baseline_DA", "baseline_abs_bias_pct", "used_bias_override")


@query("model_flags", with_ctes(C.SCORED, body="""SELECT Product, Division, Model, mae AS Test_MAE, rmse AS Test_RMSE, rocv AS ROCV_MAE, DA, abs_bias_pct, is_baseline, mae_cutoff, rmse_cutoff, rocv_hard_max,
  passes_accuracy, passes_rocv_sanity, candidate, q_da AS qualifies_da, q_mae AS qualifies_mae_close, q_bias AS qualifies_bias FROM fl4"""), "Test_MAE Test_RMSE ROCV_MAE DA abs_bias_pct mae_cutoff rmse_cutoff rocv_hard_max")
def model_flags(spark, sf):
    return S.score_models(S.enrich(*both_of(spark, sf))).select(
        *SERIES, "Model", "Test_MAE", "Test_RMSE", "ROCV_MAE", "DA", "abs_bias_pct", "is_baseline", "mae_cutoff", "rmse_cutoff", "rocv_hard_max",
        "passes_accuracy", "passes_rocv_sanity", "candidate", "qualifies_da", "qualifies_mae_close", "qualifies_bias")


@query("select_legacy", with_ctes(C.LEGACY, body="SELECT * FROM legacy"))
def select_legacy(spark, sf):
    return S.select_legacy(D.simple_metrics(fact_of(spark, sf)))


ARCHIVED = C.METRICS + """,
ab AS (SELECT Product, Division, Model AS bm, Test_MAE AS b_mae, ROCV_MAE AS b_rocv FROM metrics WHERE Model IN ('SARIMA_baseline', 'ETS_baseline')
  QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY round(Test_MAE, 9) NULLS LAST, round(Test_RMSE, 9) NULLS LAST, Model) = 1),
acc AS (SELECT m.* FROM metrics m JOIN ab b USING (Product, Division) WHERE Model NOT IN ('SARIMA_baseline', 'ETS_baseline') AND Test_MAE <= b_mae * (1 - 0.02::DOUBLE)
  AND (b_rocv IS NULL OR ROCV_MAE <= b_rocv * (1 + 0.05::DOUBLE)) QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY round(Test_MAE, 9), round(Test_RMSE, 9), Model) = 1)
"""


@query("select_archived", with_ctes(ARCHIVED, body="""SELECT b.Product, b.Division, coalesce(a.Model, b.bm) AS Chosen_Model, b.bm AS baseline_model, a.Model IS NOT NULL AS Accepted_by_rules
  FROM ab b LEFT JOIN acc a USING (Product, Division)"""))
def select_archived(spark, sf):
    return S.select_archived(D.simple_metrics(fact_of(spark, sf)))


@query("accept_groups", with_ctes(C.METRICS, body="""SELECT Product, Division, coalesce(arg_min(Model, (round(Test_MAE, 9), Model)) FILTER (WHERE ok), any_value(bm)) AS Recommended_Model, count(*) FILTER (WHERE ok) AS n_accepted FROM (
  SELECT m.*, bm, Model <> bm AND (b_mae - Test_MAE) >= greatest(10.0, b_mae * 0.05::DOUBLE) AND (b_rocv IS NULL OR coalesce(ROCV_MAE <= b_rocv * (1 + 0.1::DOUBLE), false))
    AND (ROCV_MAE IS NULL OR abs(ROCV_MAE - Test_MAE) <= 0.1::DOUBLE * greatest(Test_MAE, 1e-9)) AS ok
  FROM metrics m JOIN (SELECT Product, Division, Model AS bm, Test_MAE AS b_mae, ROCV_MAE AS b_rocv FROM metrics WHERE Model = 'SARIMA_baseline') USING (Product, Division)) GROUP BY ALL"""))
def accept_groups(spark, sf):
    return S.accept_groups(D.simple_metrics(fact_of(spark, sf)))


COMPARED = C.SCORED + "," + C.LEGACY.replace(C.METRICS + ",", "") + """,
cmp AS (SELECT *, new_mae - old_mae AS mae_delta, new_rmse - old_rmse AS rmse_delta, new_abs_bias - old_abs_bias AS abs_bias_delta, old_model IS DISTINCT FROM new_model AS winner_changed FROM (
    SELECT o.Product, o.Division, o.Recommended_Model AS old_model, s.Recommended_Model AS new_model, a.Weighted_MAE AS old_mae, b.Weighted_MAE AS new_mae, a.Weighted_RMSE AS old_rmse, b.Weighted_RMSE AS new_rmse,
      a.abs_bias AS old_abs_bias, b.abs_bias AS new_abs_bias
    FROM legacy o FULL JOIN selected s ON s.Product = o.Product AND s.Division = o.Division
    LEFT JOIN weighted a ON a.Product = o.Product AND a.Division = o.Division AND a.Model = o.Recommended_Model
    LEFT JOIN weighted b ON b.Product = s.Product AND b.Division = s.Division AND b.Model = s.Recommended_Model))
"""
CMP_COLUMNS = "old_mae new_mae old_rmse new_rmse old_abs_bias new_abs_bias mae_delta rmse_delta abs_bias_delta"


def _compared(spark, sf):
    m, h = both_of(spark, sf)
    return S.compare_selections(S.select_legacy(m), S.select_model(m, h), h)


@query("selection_compare", with_ctes(COMPARED, body="SELECT * FROM cmp"), CMP_COLUMNS)
def selection_compare(spark, sf):
    return _compared(spark, sf).drop("old_bias", "new_bias", "old_abs_bias_pct", "new_abs_bias_pct", "abs_bias_pct_delta")


@query("selection_stats", with_ctes(COMPARED, body="""SELECT count(*) AS total_skus, count(*) FILTER (WHERE winner_changed) AS winner_changed_count, avg(winner_changed::INT) AS winner_changed_pct,
  avg(mae_delta) AS mae_delta_mean, median(mae_delta) AS mae_delta_median, avg(abs_bias_delta) AS abs_bias_delta_mean, median(abs_bias_delta) AS abs_bias_delta_median FROM cmp"""),
  "winner_changed_pct mae_delta_mean mae_delta_median abs_bias_delta_mean abs_bias_delta_median")
def selection_stats(spark, sf):
    return S.comparison_stats(cut_lineage(_compared(spark, sf)))


@query("top_bias_improved", with_ctes(COMPARED, body="""SELECT Product, Division, old_model, new_model, abs_bias_delta FROM (SELECT *, round(abs_bias_delta, 6) AS k FROM cmp WHERE winner_changed)
  ORDER BY k NULLS LAST, Product, Division LIMIT 20"""), "abs_bias_delta")
def top_bias_improved(spark, sf):
    c = _compared(spark, sf).withColumn("abs_bias_delta", F.round("abs_bias_delta", 6))
    return S.top_flips(c, "abs_bias_delta", True).select(*SERIES, "old_model", "new_model", "abs_bias_delta")


@query("top_mae_worsened", with_ctes(COMPARED, body="""SELECT Product, Division, old_model, new_model, mae_delta FROM (SELECT *, round(mae_delta, 6) AS k FROM cmp WHERE winner_changed)
  ORDER BY k DESC NULLS LAST, Product, Division LIMIT 20"""), "mae_delta")
def top_mae_worsened(spark, sf):
    c = _compared(spark, sf).withColumn("mae_delta", F.round("mae_delta", 6))
    return S.top_flips(c, "mae_delta", False).select(*SERIES, "old_model", "new_model", "mae_delta")


@query("rank_models", with_ctes(C.METRICS, body="""SELECT Product, Division, Model, Test_MAE, CASE WHEN Test_MAE IS NOT NULL THEN row_number() OVER (PARTITION BY Product, Division, Test_MAE IS NULL ORDER BY round(Test_MAE, 9), Model) END AS Rank FROM metrics"""), "Test_MAE")
def rank_models(spark, sf):
    return S.rank_models(D.simple_metrics(fact_of(spark, sf))).select(*SERIES, "Model", "Test_MAE", "Rank")


@query("best_regressor", with_ctes(C.METRICS, body="""SELECT Product, Division, Model, Test_MAE, Test_RMSE, ROCV_MAE, 'Bookings' AS Regressor_Name, 1 AS Regressor_Lag FROM metrics WHERE Model = 'SARIMAX_Bookings_l1' AND Test_MAE IS NOT NULL"""), "Test_MAE Test_RMSE ROCV_MAE")
def best_regressor(spark, sf):
    return S.best_regressor(D.simple_metrics(fact_of(spark, sf)))


SUMMARY = C.SCORED + """,
summary AS (SELECT s.Product, s.Division, s.Recommended_Model AS Chosen_Model, x.Model AS Best_NonBaseline_Model, b.Test_MAE AS Baseline_MAE, c.Test_MAE AS Chosen_MAE, c.Test_RMSE AS Chosen_RMSE, c.ROCV_MAE AS Chosen_ROCV_MAE,
    CASE WHEN abs(b.Test_MAE) > 1e-9 THEN (b.Test_MAE - c.Test_MAE) / b.Test_MAE END AS MAE_Improvement_Pct,
    CASE WHEN s.Recommended_Model LIKE 'SARIMAX%' THEN 'Bookings' END AS Regressor_Name, CASE WHEN s.Recommended_Model LIKE 'SARIMAX%' THEN 1 END AS Regressor_Lag, s.Recommended_Model <> s.baseline_model AS Accepted_by_rules
  FROM selected s LEFT JOIN metrics b ON b.Product = s.Product AND b.Division = s.Division AND b.Model = s.baseline_model
  LEFT JOIN metrics c ON c.Product = s.Product AND c.Division = s.Division AND c.Model = s.Recommended_Model
  LEFT JOIN metrics x ON x.Product = s.Product AND x.Division = s.Division AND x.Model = 'SARIMAX_Bookings_l1' AND x.Test_MAE IS NOT NULL)
"""


@query("model_summary", with_ctes(SUMMARY, body="SELECT * FROM summary"), "Baseline_MAE Chosen_MAE Chosen_RMSE Chosen_ROCV_MAE MAE_Improvement_Pct")
def model_summary(spark, sf):
    m, h = both_of(spark, sf)
    return S.model_summary(m, S.select_model(m, h)).drop("Best_NonBaseline_Regressor_Name", "Best_NonBaseline_Regressor_Lag", "Baseline_ROCV_MAE")


@query("model_choices", with_ctes(SUMMARY, body="""SELECT Product, Division, Chosen_Model AS model, CASE WHEN Chosen_Model LIKE 'SARIMAX%' OR Best_NonBaseline_Model IS NOT NULL THEN 'Bookings' END AS reg_name,
  CASE WHEN Chosen_Model LIKE 'SARIMAX%' OR Best_NonBaseline_Model IS NOT NULL THEN 1 END AS reg_lag FROM summary"""))
def model_choices(spark, sf):
    m, h = both_of(spark, sf)
    rec = cut_lineage(S.select_model(m, h))
    return S.model_choices(S.model_summary(m, rec), rec)


@query("distinct_metrics", with_ctes(C.METRICS, body="""SELECT Product, Division, Model, Test_MAE FROM metrics"""), "Test_MAE")
def distinct_metrics(spark, sf):
    m = D.simple_metrics(fact_of(spark, sf)).select(*SERIES, "Model", "Test_MAE")
    twice = m.withColumn("row_id", F.lit(1)).unionByName(m.withColumn("Test_MAE", F.lit(-1.0)).withColumn("row_id", F.lit(2)))
    return S.distinct_metrics(twice, "row_id").drop("row_id")


@query("model_labels", with_ctes(C.METRICS, body="""SELECT DISTINCT Model, CASE Model WHEN 'SARIMA_baseline' THEN 'SARIMA' WHEN 'SARIMAX_Bookings_l1' THEN 'SARIMAX' WHEN 'ETS_baseline' THEN 'ETS' WHEN 'ML_GBR' THEN 'ML' ELSE Model END AS family,
  CASE Model WHEN 'SARIMA_baseline' THEN 'SARIMA' WHEN 'SARIMAX_Bookings_l1' THEN 'SARIMAX' WHEN 'ETS_baseline' THEN 'ETS' WHEN 'ML_GBR' THEN 'ML' ELSE Model END AS model_type,
  CASE Model WHEN 'SARIMA_baseline' THEN 'baseline_sarima' WHEN 'SARIMAX_Bookings_l1' THEN 'with_regressor' WHEN 'ETS_baseline' THEN 'baseline_ets' WHEN 'ML_GBR' THEN 'ml_gbr' ELSE lower(Model) END AS model_group,
  CASE WHEN Model LIKE 'SARIMAX%' THEN 'Bookings' END AS reg_name, CASE WHEN Model LIKE 'SARIMAX%' THEN 1 END AS reg_lag,
  CASE Model WHEN 'SARIMA_baseline' THEN 'Seasonal Baseline' WHEN 'SARIMAX_Bookings_l1' THEN 'Bookings Lag1 Regressor' WHEN 'ETS_baseline' THEN 'ETS Baseline' WHEN 'ML_GBR' THEN 'ML GBR' ELSE Model END AS label FROM metrics"""))
def model_labels(spark, sf):
    models = D.simple_holdout(fact_of(spark, sf)).select("Model").distinct()
    name, lag = labels.regressor_of(F.col("Model"))
    group = labels.model_group(F.col("Model"))
    return models.select("Model", labels.blend_family(F.col("Model")).alias("family"), labels.model_type(F.col("Model")).alias("model_type"),
                         group.alias("model_group"), name.alias("reg_name"), lag.alias("reg_lag"), labels.model_label(group, name, lag).alias("label"))


# ---- blending --------------------------------------------------------------
BLEND = C.SIMPLE + """,
fam AS (SELECT *, CASE WHEN Model = 'SARIMA_baseline' THEN 'SARIMA' WHEN Model LIKE 'SARIMAX%' THEN 'SARIMAX' WHEN Model = 'ETS_baseline' THEN 'ETS' WHEN Model = 'ML_GBR' THEN 'ML' ELSE Model END AS Model_Family,
    dense_rank() OVER (PARTITION BY Product, Division ORDER BY Date) AS Horizon FROM holdout),
ow AS (SELECT Product, Division, Model_Family, Model, CASE WHEN sum(CASE WHEN Forecast IS NOT NULL THEN abs(Actual) END) > 1e-9 THEN sum(abs(Actual - Forecast)) / sum(CASE WHEN Forecast IS NOT NULL THEN abs(Actual) END) END AS WAPE FROM fam GROUP BY ALL),
ow2 AS (SELECT * FROM ow WHERE WAPE IS NOT NULL QUALIFY row_number() OVER (PARTITION BY Product, Division, Model_Family ORDER BY round(WAPE, 9), Model) = 1),
hwp AS (SELECT f.Product, f.Division, f.Model_Family, f.Model, f.Horizon, CASE WHEN sum(CASE WHEN Forecast IS NOT NULL THEN abs(Actual) END) > 1e-9 THEN sum(abs(Actual - Forecast)) / sum(CASE WHEN Forecast IS NOT NULL THEN abs(Actual) END) END AS WAPE
  FROM fam f JOIN ow2 o ON o.Product = f.Product AND o.Division = f.Division AND o.Model = f.Model GROUP BY ALL),
hraw AS (SELECT *, exp(-((WAPE - min(WAPE) OVER w) / greatest(min(WAPE) OVER w, 1e-9)) / 0.1::DOUBLE) AS raw FROM hwp WHERE WAPE IS NOT NULL WINDOW w AS (PARTITION BY Product, Division, Horizon)),
oraw AS (SELECT *, exp(-((WAPE - min(WAPE) OVER w) / greatest(min(WAPE) OVER w, 1e-9)) / 0.1::DOUBLE) AS raw FROM ow2 WINDOW w AS (PARTITION BY Product, Division)),
weights AS (SELECT Product, Division, Horizon, Model_Family, Model, WAPE, raw / sum(raw) OVER (PARTITION BY Product, Division, Horizon) AS Weight, 0.1::DOUBLE AS Tau, 'holdout_horizon' AS Weight_Source FROM hraw
  UNION ALL SELECT Product, Division, NULL, Model_Family, Model, WAPE, raw / sum(raw) OVER (PARTITION BY Product, Division), 0.1::DOUBLE, 'holdout_overall' FROM oraw),
bcell AS (SELECT f.Product, f.Division, f.Date, f.Horizon, f.Actual, f.Forecast, h.Weight AS wh, o.Weight AS wo, max((h.Weight IS NOT NULL)::INT) OVER (PARTITION BY f.Product, f.Division, f.Date) AS has_h
  FROM fam f JOIN (SELECT * FROM weights WHERE Horizon IS NULL) o ON o.Product = f.Product AND o.Division = f.Division AND o.Model = f.Model
  LEFT JOIN (SELECT * FROM weights WHERE Horizon IS NOT NULL) h ON h.Product = f.Product AND h.Division = f.Division AND h.Model = f.Model AND h.Horizon = f.Horizon),
blended AS (SELECT * FROM (SELECT Product, Division, 'BLENDED_SOFTMAX' AS Model, Date, avg(Actual) AS Actual,
    sum(CASE WHEN Forecast IS NOT NULL THEN (CASE WHEN has_h = 1 THEN wh ELSE wo END) * Forecast END) / nullif(sum(CASE WHEN Forecast IS NOT NULL THEN (CASE WHEN has_h = 1 THEN wh ELSE wo END) END), 0) AS Forecast
  FROM bcell GROUP BY ALL) WHERE Forecast IS NOT NULL)
"""


@query("blend_weights", with_ctes(BLEND, body="SELECT * FROM weights"), "WAPE Weight")
def blend_weights(spark, sf):
    return B.holdout_weights(holdout_of(spark, sf))


@query("blend_best_per_family", with_ctes(BLEND, body="SELECT * FROM ow2"), "WAPE")
def blend_best_per_family(spark, sf):
    return B.best_per_family(B.family_rows(holdout_of(spark, sf)))


@query("blend_holdout", with_ctes(BLEND, body="SELECT * FROM blended"), "Actual Forecast")
def blend_holdout(spark, sf):
    return B.blend_holdout(holdout_of(spark, sf))


@query("blend_metrics", with_ctes(BLEND, C.METRICS.replace(C.SIMPLE + ",", ""), body="""SELECT Product, Division, Model, avg(abs(Actual - Forecast)) AS Test_MAE, sqrt(avg((Actual - Forecast) * (Actual - Forecast))) AS Test_RMSE, any_value(r.ROCV_MAE) AS ROCV_MAE FROM blended b
  LEFT JOIN (SELECT w.Product, w.Division, sum(CASE WHEN m.ROCV_MAE IS NOT NULL THEN w.Weight * m.ROCV_MAE END) / sum(CASE WHEN m.ROCV_MAE IS NOT NULL THEN w.Weight END) AS ROCV_MAE
    FROM weights w LEFT JOIN metrics m ON m.Product = w.Product AND m.Division = w.Division AND m.Model = w.Model WHERE w.Horizon IS NULL GROUP BY ALL) r USING (Product, Division) GROUP BY ALL"""), "Test_MAE Test_RMSE ROCV_MAE")
def blend_metrics(spark, sf):
    m, h = both_of(spark, sf)
    return B.with_blend(m, h)[0].filter(F.col("Model") == cfg.BLEND_MODEL)
