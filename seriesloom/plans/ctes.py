"""Shared SQL building blocks of the twins."""

SHIP = """
ship AS (SELECT p_brand AS Product, 'R' || n_regionkey AS Division, date_trunc('month', l_shipdate)::DATE AS Month, l_quantity AS Actuals
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
"""
FACT = SHIP + """,
fact AS (SELECT Product, Division, Month, sum(Actuals) AS Actuals FROM ship GROUP BY ALL)
"""
OL = """
ol AS (SELECT lineitem.*, o_custkey, o_orderstatus, p_brand AS Product, 'R' || n_regionkey AS Division,
    date_trunc('month', o_orderdate)::DATE AS order_month, date_trunc('month', l_shipdate)::DATE AS ship_month
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
"""
FULL = OL + """,
full_fact AS (SELECT coalesce(a.Product, b.Product) AS Product, coalesce(a.Division, b.Division) AS Division,
    coalesce(a.Month, b.Month) AS Month, Actuals, Bookings, New_Opportunities, Open_Opportunities
  FROM (SELECT Product, Division, ship_month AS Month, sum(l_quantity) AS Actuals FROM ol GROUP BY ALL) a
  FULL JOIN (SELECT Product, Division, order_month AS Month, sum(l_quantity) AS Bookings, count(*)::DOUBLE AS New_Opportunities,
      count(*) FILTER (WHERE o_orderstatus = 'O')::DOUBLE AS Open_Opportunities FROM ol GROUP BY ALL) b
  ON a.Product = b.Product AND a.Division = b.Division AND a.Month = b.Month)
"""
SIGNALS = OL + """,
signals AS (SELECT upper(trim(Product)) AS group_key, Division AS BU, order_month AS Month, sum(floor(l_extendedprice)) AS Sum_Total_Price,
    sum(l_quantity) AS Sum_Quantity, count(*) FILTER (WHERE o_orderstatus = 'O')::DOUBLE AS Open_Opportunities,
    count(*)::DOUBLE AS New_Opportunities FROM ol GROUP BY ALL)
"""
PART_FACT = """
pf AS (SELECT l_partkey::VARCHAR AS Product, 'ALL' AS Division, date_trunc('month', l_shipdate)::DATE AS Month, sum(l_quantity) AS Actuals
  FROM lineitem GROUP BY ALL)
"""
SPINE = PART_FACT + """,
bounds AS (SELECT min(Month) AS lo, max(Month) AS hi FROM pf),
spine AS (SELECT s.Product, s.Division, s.Month, coalesce(pf.Actuals, 0) AS Actuals
  FROM (SELECT Product, Division, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS Month
        FROM (SELECT DISTINCT Product, Division FROM pf), bounds) s
  LEFT JOIN pf ON pf.Product = s.Product AND pf.Division = s.Division AND pf.Month = s.Month)
"""


def sba(source: str) -> str:
    """State of the intermittent-demand recursion after every known row of `source`."""
    return f"""
seq AS (SELECT Product, Division, Month, Actuals::DOUBLE AS y,
    row_number() OVER (PARTITION BY Product, Division ORDER BY Month) AS rn,
    row_number() OVER (PARTITION BY Product, Division ORDER BY Month DESC) AS back,
    count(*) OVER (PARTITION BY Product, Division) AS n FROM {source} WHERE Actuals IS NOT NULL),
st AS (SELECT Product, Division, rn, CASE WHEN y > 0 THEN y END AS z, CASE WHEN y > 0 THEN 1.0::DOUBLE END AS p,
    CASE WHEN y > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS q FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.Product, s.Division, s.rn,
    CASE WHEN s.y > 0 THEN CASE WHEN t.z IS NULL THEN s.y ELSE t.z + 0.1::DOUBLE * (s.y - t.z) END ELSE t.z END,
    CASE WHEN s.y > 0 THEN CASE WHEN t.p IS NULL THEN t.q + 1 ELSE t.p + 0.1::DOUBLE * (t.q + 1 - t.p) END ELSE t.p END,
    CASE WHEN s.y > 0 THEN 0.0::DOUBLE ELSE t.q + 1 END
  FROM st t JOIN seq s ON s.Product = t.Product AND s.Division = t.Division AND s.rn = t.rn + 1),
sba AS (SELECT Product, Division, rn, CASE WHEN p > 0 THEN 0.95::DOUBLE * z / p ELSE 0.0::DOUBLE END AS f FROM st)
"""


SIMPLE = FACT + "," + sba("fact") + """,
rows0 AS (SELECT *, lag(y, 12) OVER w AS naive, lag(y, 24) OVER w AS naive2,
    avg(y) OVER (PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS ma3,
    avg(y) OVER (PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS ma6,
    avg(y) OVER (PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS ma12
  FROM seq WINDOW w AS (PARTITION BY Product, Division ORDER BY Month)),
rows1 AS (SELECT r.*, s.f AS sba FROM rows0 r LEFT JOIN sba s ON s.Product = r.Product AND s.Division = r.Division AND s.rn = r.rn - 1),
cut AS (SELECT Product, Division, ma3, ma6, ma12, sba FROM rows1 WHERE back = 12),
hw AS (SELECT r.Product, r.Division, r.Month AS Date, r.y AS Actual, r.naive, r.naive2, c.ma3, c.ma6, c.ma12, c.sba
  FROM rows1 r LEFT JOIN cut c ON c.Product = r.Product AND c.Division = r.Division WHERE r.back <= 12),
holdout AS (
  SELECT Product, Division, 'SARIMA_baseline' AS Model, Date, Actual, naive AS Forecast FROM hw
  UNION ALL SELECT Product, Division, 'SARIMAX_Bookings_l1', Date, Actual, (naive + naive2) / 2 FROM hw
  UNION ALL SELECT Product, Division, 'ETS_baseline', Date, Actual, ma6 FROM hw
  UNION ALL SELECT Product, Division, 'PROPHET', Date, Actual, ma12 FROM hw
  UNION ALL SELECT Product, Division, 'SBA', Date, Actual, sba FROM hw
  UNION ALL SELECT Product, Division, 'ML_GBR', Date, Actual, ma3 FROM hw)
"""
METRICS = SIMPLE + """,
rocv AS (
  SELECT Product, Division, 'SARIMA_baseline' AS Model, avg(abs(y - naive)) AS ROCV_MAE FROM rows1 WHERE rn > 24 GROUP BY ALL
  UNION ALL SELECT Product, Division, 'SARIMAX_Bookings_l1', avg(abs(y - (naive + naive2) / 2)) FROM rows1 WHERE rn > 24 GROUP BY ALL
  UNION ALL SELECT Product, Division, 'ETS_baseline', avg(abs(y - ma6)) FROM rows1 WHERE rn > 24 GROUP BY ALL
  UNION ALL SELECT Product, Division, 'PROPHET', avg(abs(y - ma12)) FROM rows1 WHERE rn > 24 GROUP BY ALL
  UNION ALL SELECT Product, Division, 'SBA', avg(abs(y - sba)) FROM rows1 WHERE rn > 24 GROUP BY ALL
  UNION ALL SELECT Product, Division, 'ML_GBR', avg(abs(y - ma3)) FROM rows1 WHERE rn > 24 GROUP BY ALL),
metrics AS (SELECT h.Product, h.Division, h.Model, avg(abs(Actual - Forecast)) AS Test_MAE, sqrt(avg((Actual - Forecast) * (Actual - Forecast))) AS Test_RMSE,
    CASE WHEN sum(CASE WHEN Forecast IS NOT NULL THEN abs(Actual) END) > 1e-9
         THEN sum(abs(Actual - Forecast)) / sum(CASE WHEN Forecast IS NOT NULL THEN abs(Actual) END) END AS WAPE, any_value(r.ROCV_MAE) AS ROCV_MAE
  FROM holdout h LEFT JOIN rocv r ON r.Product = h.Product AND r.Division = h.Division AND r.Model = h.Model GROUP BY ALL)
"""
MONTHLY = """
mon AS (SELECT Product, Division, Model, date_trunc('month', Date)::DATE AS Date, avg(Actual) AS Actual, avg(Forecast) AS Forecast
  FROM holdout WHERE Actual IS NOT NULL AND Forecast IS NOT NULL GROUP BY ALL)
"""
DA = """
da AS (SELECT Product, Division, Model, CASE WHEN count(hit) >= 6 THEN avg(hit) END AS DA, count(hit) AS DA_Valid_Periods FROM (
    SELECT *, CASE WHEN pa IS NULL THEN NULL WHEN sign(Actual - pa) = sign(Forecast - pf) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit FROM (
      SELECT *, lag(Actual) OVER w AS pa, lag(Forecast) OVER w AS pf FROM mon WINDOW w AS (PARTITION BY Product, Division, Model ORDER BY Date)))
  GROUP BY ALL)
"""
WEIGHTED = """
wrows AS (SELECT *, base / present / cnt AS weight FROM (
    SELECT *, CASE b WHEN 0 THEN 0.55::DOUBLE WHEN 1 THEN 0.30::DOUBLE ELSE 0.15::DOUBLE END AS base, count(*) OVER (PARTITION BY Product, Division, Model, b) AS cnt,
      (CASE WHEN count(*) FILTER (WHERE b = 0) OVER m > 0 THEN 0.55::DOUBLE ELSE 0 END) + (CASE WHEN count(*) FILTER (WHERE b = 1) OVER m > 0 THEN 0.30::DOUBLE ELSE 0 END)
      + (CASE WHEN count(*) FILTER (WHERE b = 2) OVER m > 0 THEN 0.15::DOUBLE ELSE 0 END) AS present FROM (
        SELECT *, CASE WHEN mb <= 2 THEN 0 WHEN mb <= 5 THEN 1 ELSE 2 END AS b FROM (
          SELECT *, datediff('month', Date, max(Date) OVER (PARTITION BY Product, Division, Model)) AS mb FROM mon))
    WINDOW m AS (PARTITION BY Product, Division, Model))),
weighted AS (SELECT Product, Division, Model, wmae AS Weighted_MAE, wrmse AS Weighted_RMSE, bias, abs(bias) AS abs_bias, bias / den AS bias_pct, abs(bias / den) AS abs_bias_pct FROM (
    SELECT Product, Division, Model, sum(weight * abs(Forecast - Actual)) AS wmae, sqrt(sum(weight * (Forecast - Actual) * (Forecast - Actual))) AS wrmse,
      sum(weight * (Forecast - Actual)) AS bias, CASE WHEN abs(sum(weight * Actual)) > 1e-9 THEN sum(weight * Actual) ELSE 1e-9 END AS den
    FROM wrows GROUP BY ALL))
"""
ENRICHED = METRICS + "," + MONTHLY + "," + DA + "," + WEIGHTED + """,
en AS (SELECT m.Product, m.Division, m.Model, w.Weighted_MAE AS mae, w.Weighted_RMSE AS rmse, m.ROCV_MAE AS rocv, d.DA AS DA, w.bias, w.abs_bias, w.bias_pct, w.abs_bias_pct
  FROM metrics m LEFT JOIN da d USING (Product, Division, Model) LEFT JOIN weighted w USING (Product, Division, Model))
"""
SCORED = ENRICHED + """,
basem AS (SELECT Product, Division, Model AS bm, mae AS b_mae, rmse AS b_rmse, rocv AS b_rocv, DA AS b_da, abs_bias AS b_ab, abs_bias_pct AS b_abp FROM en
  WHERE mae IS NOT NULL QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY round(mae, 9), round(rmse, 9), Model) = 1),
fl AS (SELECT en.*, b.* EXCLUDE (Product, Division), coalesce(en.Model = b.bm, false) AS is_baseline, b_mae * 1.2 AS mae_cutoff, b_rmse * 1.2 AS rmse_cutoff,
    CASE WHEN b_rocv > 0 THEN b_rocv * 1.5 END AS rocv_hard_max FROM en LEFT JOIN basem b ON b.Product = en.Product AND b.Division = en.Division),
fl2 AS (SELECT *, is_baseline OR coalesce(mae <= mae_cutoff AND rmse <= rmse_cutoff, false) AS passes_accuracy,
    is_baseline OR (mae IS NOT NULL AND (rocv_hard_max IS NULL OR coalesce(rocv <= rocv_hard_max, false))) AS passes_rocv_sanity FROM fl),
fl3 AS (SELECT *, passes_accuracy AND passes_rocv_sanity AS candidate, passes_accuracy AND passes_rocv_sanity AND NOT is_baseline AS chal FROM fl2),
fl4 AS (SELECT *, chal AND coalesce(DA >= b_da + 0.10::DOUBLE AND mae <= b_mae * 1.05::DOUBLE, false) AS q_da, chal AND coalesce(mae <= b_mae * 1.10::DOUBLE, false) AS q_mae,
    chal AND coalesce(b_abp > 0 AND abs_bias_pct <= b_abp * 0.70::DOUBLE, false) AS q_bias FROM fl3),
dap AS (SELECT * FROM fl4 WHERE q_da QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY round(DA, 9) DESC, round(mae, 9), round(rmse, 9), Model) = 1),
bip AS (SELECT * FROM fl4 WHERE q_mae AND q_bias QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY round(abs_bias_pct, 9), round(mae, 9), round(rmse, 9), Model) = 1),
ser AS (SELECT Product, Division, bool_or(chal) AS had, bool_or(q_mae) AS any_mae, bool_or(q_bias) AS any_bias FROM fl4 GROUP BY ALL),
selected AS (SELECT s.Product, s.Division, coalesce(bp.Model, dp.Model, b.bm) AS Recommended_Model,
    CASE WHEN b.bm IS NULL THEN 'No valid model metrics available.'
      WHEN bp.Model IS NOT NULL THEN 'Bias override: |bias| improved by ' || printf('%.1f', (1 - bp.abs_bias_pct / b.b_abp) * 100) || '% vs baseline while MAE within +10% and passing accuracy+ROCV sanity.'
      ELSE (CASE WHEN dp.Model IS NOT NULL THEN 'Override: challenger improved directional accuracy by ' || printf('%.1f', (dp.DA - b.b_da) * 100) || 'pp (DA_challenger vs DA_baseline) while within MAE+5% and passing accuracy+ROCV sanity.'
        ELSE 'Baseline wins: best MAE; no challenger improved DA by >=10pp within MAE+5%.' END)
        || (CASE WHEN had AND NOT any_mae THEN ' Bias override not applied: no challenger within MAE +10%.'
             WHEN had AND NOT any_bias THEN ' Bias override not applied: no challenger met bias-improvement threshold.' ELSE '' END) END AS Reason,
    b.bm AS baseline_model, b.b_mae AS baseline_mae, b.b_rocv AS baseline_rocv, b.b_da AS baseline_DA, b.b_abp AS baseline_abs_bias_pct,
    bp.Model IS NOT NULL AS used_bias_override
  FROM ser s LEFT JOIN basem b USING (Product, Division) LEFT JOIN dap dp USING (Product, Division) LEFT JOIN bip bp USING (Product, Division))
"""
LEGACY = METRICS + """,
lb AS (SELECT Product, Division, Model AS bm, Test_MAE AS b_mae, Test_RMSE AS b_rmse, ROCV_MAE AS b_rocv FROM metrics WHERE Test_MAE IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY round(Test_MAE, 9), round(Test_RMSE, 9), Model) = 1),
lc AS (SELECT m.*, b.* EXCLUDE (Product, Division), Model = bm OR coalesce(Test_MAE <= b_mae * 1.2 AND Test_RMSE <= b_rmse * 1.2 AND ROCV_MAE <= b_rocv * 1.5, false) AS ok,
    ROCV_MAE BETWEEN b_rocv * 0.85::DOUBLE AND b_rocv * 1.15::DOUBLE AS band FROM metrics m JOIN lb b USING (Product, Division)),
lp AS (SELECT * FROM lc WHERE ok AND b_rocv > 0 QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY coalesce(band, false) DESC, round(Test_MAE, 9), round(Test_RMSE, 9), Model) = 1),
legacy AS (SELECT b.Product, b.Division,
    CASE WHEN b.b_rocv IS NULL OR b.b_rocv <= 0 THEN b.bm WHEN p.Model <> b.bm AND (p.ROCV_MAE < b.b_rocv * 0.70::DOUBLE OR p.ROCV_MAE > b.b_rocv * 1.5) THEN b.bm ELSE p.Model END AS Recommended_Model,
    CASE WHEN b.b_rocv IS NULL OR b.b_rocv <= 0 THEN 'Baseline ROCV unavailable or zero; selected lowest-MAE baseline.'
      WHEN p.Model <> b.bm AND p.ROCV_MAE < b.b_rocv * 0.70::DOUBLE THEN 'Selected model ROCV was too smooth relative to baseline; reverted to lowest-MAE baseline.'
      WHEN p.Model <> b.bm AND p.ROCV_MAE > b.b_rocv * 1.5 THEN 'Selected model ROCV was too noisy relative to baseline; reverted to lowest-MAE baseline.'
      WHEN p.band THEN 'Selected among accurate models with variability aligned to the baseline forecast.'
      ELSE 'Selected most accurate model among those passing variability sanity checks.' END AS Reason, b.bm AS baseline_model
  FROM lb b LEFT JOIN lp p USING (Product, Division))
"""
