"""Queries: snapshot history, snapshot features, as-of features and spikes."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators import backtest as K
from seriesloom.operators import metrics as M
from seriesloom.operators import snapshots as S
from seriesloom.operators.forecasters import spike as X
from seriesloom.plans import ctes as C
from seriesloom.plans.registry import query, with_ctes
from seriesloom.schema import SERIES
from seriesloom.sources import driver_tables as D
from seriesloom.sources import files

KEY = "Product, Division"

LINES = C.OL + """,
lines AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN l_quantity END AS q1, l_quantity AS q2, 100.0 * (1.0 - l_discount) / 100.0 AS prob,
    floor(l_quantity / 2) AS fq, floor(l_extendedprice / 2) AS fr, 'C' || o_custkey || '||' || Product AS opp_key FROM ol),
ml AS (SELECT * FROM lines WHERE l_returnflag <> 'A' OR Division IN ('R0', 'R2', 'R4'))
"""
HIST = LINES + """,
shifts AS (SELECT *, datediff('month', lag(ship_month) OVER (PARTITION BY Product, Division, opp_key ORDER BY order_month, ship_month), ship_month) AS slip FROM ml),
slips AS (SELECT Product, Division, order_month AS snapshot_month, median(slip) AS slippage_months, count(slip) AS n_shifts FROM shifts WHERE slip IS NOT NULL GROUP BY ALL),
per_file AS (SELECT Product, Division, o_orderstatus, order_month, ship_month, count(q1) AS n1, count(q2) AS n2, sum(q1) AS s1, sum(q2) AS s2, sum(q1 * prob) AS w1, sum(q2 * prob) AS w2,
    sum(fq) AS fq, sum(fr) AS fr, sum(l_extendedprice * prob) AS swr FROM ml GROUP BY ALL),
picked AS (SELECT *, max(n1) OVER (PARTITION BY Product, Division, o_orderstatus) > 0 OR max(n2) OVER (PARTITION BY Product, Division, o_orderstatus) = 0 AS use1 FROM per_file),
hist AS (SELECT p.Product, p.Division, order_month AS snapshot_month, ship_month AS target_month, coalesce(sum(CASE WHEN use1 THEN s1 ELSE s2 END), 0) AS pipeline_qty,
    coalesce(sum(fq), 0) AS pipeline_factored_qty, coalesce(sum(fr), 0) AS pipeline_factored_revenue, coalesce(sum(CASE WHEN use1 THEN w1 ELSE w2 END), 0) AS pipeline_stage_weighted_qty,
    coalesce(sum(swr), 0) AS pipeline_stage_weighted_revenue, any_value(slippage_months) AS slippage_months
  FROM picked p LEFT JOIN slips s ON s.Product = p.Product AND s.Division = p.Division AND s.snapshot_month = p.order_month GROUP BY ALL)
"""
MODES = """
modes AS (SELECT DISTINCT p_brand AS Product, 'R' || (p_size % 5) AS Division,
  CASE WHEN regexp_extract(p_brand, '([0-9]+)$', 1)::INT % 2 = 0 THEN 'quantity' ELSE 'revenue' END AS mode FROM part)
"""
PRIM = HIST + "," + MODES + "," + C.FACT + """,
series AS (SELECT DISTINCT Product, Division FROM fact),
prim AS (SELECT h.*, mode, CASE WHEN mode = 'quantity' THEN pipeline_factored_qty ELSE pipeline_factored_revenue END AS pipeline_primary,
    CASE WHEN mode = 'quantity' THEN pipeline_stage_weighted_qty ELSE pipeline_stage_weighted_revenue END AS pipeline_stage_weighted_primary
  FROM hist h JOIN series USING (Product, Division) JOIN modes m USING (Product, Division)),
ahead AS (SELECT *, datediff('month', snapshot_month, target_month) AS ah, coalesce(round_even(slippage_months, 0)::INT, 0) AS slip FROM prim),
due AS (SELECT Product, Division, snapshot_month, max(slip)::BIGINT AS slippage_months, %(due)s FROM ahead WHERE target_month >= snapshot_month GROUP BY ALL),
due_all AS (SELECT Product, Division, snapshot_month, max(slip)::BIGINT AS slippage_months, %(due)s FROM ahead GROUP BY ALL),
adj AS (SELECT Product, Division, snapshot_month, (target_month + to_months(slip))::DATE AS target_month, sum(pipeline_primary) AS pipeline_slip_adjusted_primary
  FROM ahead WHERE target_month >= snapshot_month GROUP BY ALL),
adj_all AS (SELECT Product, Division, snapshot_month, (target_month + to_months(slip))::DATE AS target_month, sum(pipeline_primary) AS pipeline_slip_adjusted_primary FROM ahead GROUP BY ALL)
""" % {"due": ", ".join(
    f"sum(CASE WHEN ah <= {k} THEN pipeline_primary ELSE 0 END) AS pipeline_due_{k}m, sum(CASE WHEN ah <= {k} THEN pipeline_stage_weighted_primary ELSE 0 END) AS pipeline_stage_weighted_due_{k}m, "
    f"sum(CASE WHEN ah + slip <= {k} THEN pipeline_primary ELSE 0 END) AS pipeline_slip_adjusted_due_{k}m" for k in (1, 2, 3))}
DUE = [f"pipeline_{kind}due_{k}m" for k in (1, 2, 3) for kind in ("", "stage_weighted_", "slip_adjusted_")]
CELL = " ".join(cfg.CELL_MEASURES)


def _frame_sql(pairs: str, suffix: str) -> str:
    """Feature columns for `pairs` (Product, Division, mode, snapshot_month, target_month, anchor)."""
    return C.SIGNALS.replace(C.OL + ",", "") + f""",
prs AS ({pairs}),
anchors AS (SELECT DISTINCT Product, Division, anchor FROM prs),
lagged AS (SELECT a.Product, a.Division, a.anchor,
    max(CASE WHEN d = 1 THEN Actuals END) AS lag_1, max(CASE WHEN d = 2 THEN Actuals END) AS lag_2, max(CASE WHEN d = 3 THEN Actuals END) AS lag_3,
    avg(CASE WHEN d BETWEEN 1 AND 3 THEN Actuals END) AS roll_mean_3, avg(CASE WHEN d BETWEEN 1 AND 6 THEN Actuals END) AS roll_mean_6,
    avg(CASE WHEN d BETWEEN 1 AND 12 THEN Actuals END) AS roll_mean_12, datediff('month', min(Month), any_value(anchor)) - 1 AS trend_idx
  FROM (SELECT a.*, f.Month, f.Actuals, datediff('month', f.Month, a.anchor) AS d FROM anchors a JOIN fact f ON f.Product = a.Product AND f.Division = a.Division) a GROUP BY a.Product, a.Division, a.anchor),
base AS (SELECT p.* EXCLUDE (anchor), coalesce(h.pipeline_qty, 0) AS pipeline_qty, coalesce(h.pipeline_factored_qty, 0) AS pipeline_factored_qty,
    coalesce(h.pipeline_factored_revenue, 0) AS pipeline_factored_revenue, coalesce(h.pipeline_stage_weighted_qty, 0) AS pipeline_stage_weighted_qty,
    coalesce(h.pipeline_stage_weighted_revenue, 0) AS pipeline_stage_weighted_revenue, coalesce(h.pipeline_primary, 0) AS pipeline_primary,
    coalesce(h.pipeline_stage_weighted_primary, 0) AS pipeline_stage_weighted_primary, coalesce(b.pipeline_primary, 0) AS prior_pipeline_primary,
    coalesce(a.pipeline_slip_adjusted_primary, 0) AS pipeline_slip_adjusted_primary, d.* EXCLUDE (Product, Division, snapshot_month),
    l.* EXCLUDE (Product, Division, anchor), datediff('month', p.snapshot_month, p.target_month) AS months_ahead, month(p.target_month) AS target_month_num,
    s.Sum_Total_Price AS summary_Sum_Total_Price, s.Sum_Quantity AS summary_Sum_Quantity, s.Open_Opportunities AS summary_Open_Opportunities, s.New_Opportunities AS summary_New_Opportunities
  FROM prs p
  LEFT JOIN prim h ON h.Product = p.Product AND h.Division = p.Division AND h.snapshot_month = p.snapshot_month AND h.target_month = p.target_month
  LEFT JOIN prim b ON b.Product = p.Product AND b.Division = p.Division AND b.snapshot_month + INTERVAL 1 MONTH = p.snapshot_month AND b.target_month = p.target_month
  LEFT JOIN adj{suffix} a ON a.Product = p.Product AND a.Division = p.Division AND a.snapshot_month = p.snapshot_month AND a.target_month = p.target_month
  LEFT JOIN due{suffix} d ON d.Product = p.Product AND d.Division = p.Division AND d.snapshot_month = p.snapshot_month
  LEFT JOIN lagged l ON l.Product = p.Product AND l.Division = p.Division AND l.anchor = p.anchor
  LEFT JOIN signals s ON s.group_key = upper(p.Product) AND s.BU = p.Division AND s.Month = p.snapshot_month),
frame AS (SELECT *, pipeline_primary - prior_pipeline_primary AS delta_pipeline,
    CASE WHEN prior_pipeline_primary <> 0 THEN (pipeline_primary - prior_pipeline_primary) / prior_pipeline_primary END AS pct_delta_pipeline,
    CASE WHEN roll_mean_12 <> 0 THEN pipeline_primary / roll_mean_12 END AS pipeline_coverage,
    CASE WHEN mode = 'quantity' THEN summary_Sum_Quantity ELSE summary_Sum_Total_Price END AS summary_primary,
    CASE WHEN roll_mean_12 <> 0 THEN (CASE WHEN mode = 'quantity' THEN summary_Sum_Quantity ELSE summary_Sum_Total_Price END) / roll_mean_12 END AS summary_primary_coverage FROM base)
"""


FRAME_DOUBLES = " ".join([
    CELL, "pipeline_primary pipeline_stage_weighted_primary prior_pipeline_primary pipeline_slip_adjusted_primary delta_pipeline pct_delta_pipeline pipeline_coverage",
    " ".join(DUE), "lag_1 lag_2 lag_3 roll_mean_3 roll_mean_6 roll_mean_12 summary_primary summary_primary_coverage summary_Sum_Total_Price summary_Sum_Quantity",
    "summary_Open_Opportunities summary_New_Opportunities"])
TRAIN_PAIRS = """SELECT s.Product, s.Division, s.mode, s.snapshot_month, s.target_month, f.Actuals AS actuals, s.snapshot_month AS anchor
  FROM (SELECT Product, Division, mode, snapshot_month, (snapshot_month + to_months(h::INT))::DATE AS target_month
        FROM (SELECT DISTINCT Product, Division, mode, snapshot_month FROM prim), (SELECT unnest(range(0, 13)) AS h)) s
  JOIN fact f ON f.Product = s.Product AND f.Division = s.Division AND f.Month = s.target_month"""
FUTURE_PAIRS = """SELECT n.Product, n.Division, n.mode, n.snapshot_month, (lm + to_months(h::INT))::DATE AS target_month, least(n.snapshot_month, (lm + INTERVAL 1 MONTH)::DATE) AS anchor
  FROM (SELECT Product, Division, mode, max(snapshot_month) AS snapshot_month FROM prim GROUP BY ALL) n
  JOIN (SELECT Product, Division, max(Month) AS lm FROM fact GROUP BY ALL) l USING (Product, Division), (SELECT unnest(range(1, 13)) AS h)"""


class Inputs:
    """The tables the snapshot queries share, each materialised once."""

    def __init__(self, spark, sf):
        self.series_lines = D.stored_series_lines(spark, sf)
        self.fact = cut_lineage(D.monthly_fact(spark, sf, self.series_lines))
        self.series = self.fact.select(*SERIES).distinct()
        self.modes = D.series_modes(spark, sf, self.series)
        self.aliases = files.clean_aliases(D.aliases(spark, sf))
        self.spark, self.sf = spark, sf

    @cached_property
    def order_lines(self):
        return D.stored_order_lines(self.spark, self.sf, self.series_lines)

    def lines(self):
        return D.snapshot_lines(self.spark, self.sf, self.order_lines)

    def matches(self):
        cleaned = S.clean_lines(self.lines())
        return S.match_lines(cleaned, S.series_aliases(self.series, self.aliases))

    def history(self):
        return cut_lineage(S.load_history(self.lines(), self.series, self.aliases))

    def summary(self):
        return files.clean_summary(D.signal_summary(self.spark, self.sf, self.order_lines))


@query("snapshot_cells", with_ctes(LINES, body="""SELECT 'snap_' || o_orderstatus AS source_file, order_month AS snapshot_month, ship_month AS target_month, count(*) AS n_lines, count(q1) AS n_qty,
  sum(q2) AS qty, sum(fq) AS fq, sum(fr) AS fr, sum(l_extendedprice * prob) AS swr, count(DISTINCT opp_key) AS n_opps FROM lines GROUP BY ALL"""), "qty fq fr swr")
def snapshot_cells(spark, sf):
    return S.clean_lines(D.snapshot_lines(spark, sf)).groupBy("source_file", "snapshot_month", "target_month").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("q1").alias("n_qty"), F.sum("q2").alias("qty"), F.sum("fq").alias("fq"),
        F.sum("fr").alias("fr"), F.sum("swr").alias("swr"), F.count_distinct("opp_key").alias("n_opps"))


@query("line_matches", with_ctes(LINES, body="""SELECT DISTINCT CASE WHEN l_returnflag <> 'A' THEN Product END AS code_raw, 'Name ' || Product AS name_raw, Division AS bu, Product, Division FROM ml"""))
def line_matches(spark, sf):
    return Inputs(spark, sf).matches()


@query("snapshot_history", with_ctes(HIST, body="SELECT * FROM hist"), CELL + " slippage_months")
def snapshot_history(spark, sf):
    i = Inputs(spark, sf)
    return S.load_history(i.lines(), i.series, i.aliases)


@query("slippage", with_ctes(HIST, body="SELECT * FROM slips"), "slippage_months")
def slippage(spark, sf):
    i = Inputs(spark, sf)
    return S.cells_and_slippage(i.lines(), i.series, i.aliases)[1]


@query("due_windows", with_ctes(PRIM, body="SELECT * FROM due"), " ".join(DUE))
def due_windows(spark, sf):
    i = Inputs(spark, sf)
    return S.snapshot_metrics(S.with_primary(i.history(), i.modes))


@query("slip_adjusted", with_ctes(PRIM, body="SELECT * FROM adj"), "pipeline_slip_adjusted_primary")
def slip_adjusted(spark, sf):
    i = Inputs(spark, sf)
    return S.slip_adjusted(S.with_primary(i.history(), i.modes))


@query("latest_snapshot_rows", with_ctes(HIST, body="SELECT * FROM hist QUALIFY snapshot_month = max(snapshot_month) OVER (PARTITION BY Product, Division)"), CELL + " slippage_months")
def latest_snapshot_rows(spark, sf):
    return S.latest_snapshots(Inputs(spark, sf).history())


@query("snapshot_features", with_ctes(PRIM, _frame_sql(TRAIN_PAIRS, ""), body="SELECT * FROM frame"), FRAME_DOUBLES + " actuals")
def snapshot_features(spark, sf):
    i = Inputs(spark, sf)
    return S.feature_frame(i.fact, i.history(), i.modes, i.summary())


@query("future_features", with_ctes(PRIM, _frame_sql(FUTURE_PAIRS, "_all"), body="SELECT * FROM frame"), FRAME_DOUBLES)
def future_features(spark, sf):
    i = Inputs(spark, sf)
    return S.future_frame(i.fact, i.history(), i.modes, i.summary())


@query("snapshot_coverage", with_ctes(HIST, C.FACT, C.SIGNALS.replace(C.OL + ",", ""), body="""
  SELECT Product, Division, coalesce(hr, 0) AS history_rows, coalesce(ns, 0) AS n_snapshots, coalesce(sr, 0) AS summary_rows,
    CASE WHEN coalesce(sr, 0) = 0 THEN 'No summary data for product/BU.' WHEN coalesce(hr, 0) = 0 THEN 'No pipeline history rows.' END AS Reason
  FROM (SELECT DISTINCT Product, Division FROM fact) LEFT JOIN (SELECT Product, Division, count(*) AS hr, count(DISTINCT snapshot_month) AS ns FROM hist GROUP BY ALL) USING (Product, Division)
  LEFT JOIN (SELECT group_key, BU, count(*) AS sr FROM signals GROUP BY ALL) ON group_key = upper(Product) AND BU = Division"""))
def snapshot_coverage(spark, sf):
    i = Inputs(spark, sf)
    return S.snapshot_coverage(i.series, S.history_without_slippage(i.lines(), i.series, i.aliases), i.summary())


ASOF = PRIM + """,
asks AS (SELECT f.Product, f.Division, f.Month AS target_month, lag FROM fact f JOIN modes USING (Product, Division), (SELECT unnest(range(1, 4)) AS lag)),
found AS (SELECT a.Product, a.Division, a.target_month, a.lag, max(s.snapshot_month) AS snapshot_month FROM asks a
  LEFT JOIN (SELECT DISTINCT Product, Division, snapshot_month FROM prim) s ON s.Product = a.Product AND s.Division = a.Division
    AND s.snapshot_month <= (a.target_month - to_months(a.lag::INT))::DATE GROUP BY ALL)
"""


@query("asof_snapshot", with_ctes(ASOF, body="SELECT *, datediff('month', snapshot_month, target_month) AS snapshot_age FROM found"))
def asof_snapshot(spark, sf):
    i = Inputs(spark, sf)
    return S.asof_snapshot(i.fact.join(i.modes, SERIES, "left_semi"), S.with_primary(i.history(), i.modes))


ASOF_VALUES = [*S.ASOF_MEASURES, *S.ASOF_DUE, "snapshot_age"]
ASOF_WIDE = ASOF + """,
vals AS (SELECT f.*, datediff('month', f.snapshot_month, f.target_month) AS snapshot_age, p.* EXCLUDE (Product, Division, snapshot_month, target_month, slippage_months, mode), d.* EXCLUDE (Product, Division, snapshot_month, slippage_months)
  FROM found f LEFT JOIN prim p ON p.Product = f.Product AND p.Division = f.Division AND p.snapshot_month = f.snapshot_month AND p.target_month = f.target_month
  LEFT JOIN due_all d ON d.Product = f.Product AND d.Division = f.Division AND d.snapshot_month = f.snapshot_month WHERE f.snapshot_month IS NOT NULL),
wide AS (SELECT Product, Division, target_month AS Month, """ + ", ".join(
    f"max(CASE WHEN lag = {k} THEN {c} END) AS {c}_lag{k}" for k in (1, 2, 3) for c in ASOF_VALUES) + """ FROM vals GROUP BY ALL),
tl AS (SELECT Product, Division, Month, Actuals, lag(Actuals, 1) OVER w AS y_lag1, lag(Actuals, 2) OVER w AS y_lag2, lag(Actuals, 3) OVER w AS y_lag3,
    CASE WHEN count(Actuals) OVER (PARTITION BY Product, Division) >= 24 THEN lag(Actuals, 12) OVER w END AS y_lag12, month(Month) AS month_of_year, quarter(Month) AS quarter, row_number() OVER w - 1 AS trend_index
  FROM fact WINDOW w AS (PARTITION BY Product, Division ORDER BY Month)),
af AS (SELECT t.*, w.* EXCLUDE (Product, Division, Month), (coalesce(""" + ", ".join(
    f"{c}_lag{k}::DOUBLE" for k in (1, 2, 3) for c in ASOF_VALUES) + """) IS NULL)::BIGINT AS pipeline_missing_flag
  FROM tl t LEFT JOIN wide w ON w.Product = t.Product AND w.Division = t.Division AND w.Month = t.Month)
"""
ASOF_DOUBLES = " ".join(f"{c}_lag{k}" for k in (1, 2, 3) for c in ASOF_VALUES if c != "snapshot_age")


def _asof(spark, sf):
    i = Inputs(spark, sf)
    return i, S.asof_features(i.fact, i.history(), i.modes)


@query("asof_features", with_ctes(ASOF_WIDE, body="SELECT * FROM af"), ASOF_DOUBLES)
def asof_features(spark, sf):
    return _asof(spark, sf)[1]


def _labels_sql(method: str, source: str = "fact", floor: int = 100, param: str = "1.5") -> str:
    """Spike labels of `source` as CTE `lab`."""
    back = "PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING"
    here = "PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW"
    limit = {
        "hybrid": f"greatest({param} * coalesce(CASE WHEN count(residual) OVER ({here}) >= 6 THEN quantile_cont(abs(residual), 0.5) OVER ({here}) END, quantile_cont(abs(residual), 0.5) OVER (PARTITION BY Product, Division)), {floor}.0::DOUBLE)",
        "quantile": f"coalesce(CASE WHEN count(Actuals) OVER ({back}) >= 6 THEN quantile_cont(Actuals, {param}) OVER ({back}) END, quantile_cont(prev, {param}) OVER (PARTITION BY Product, Division))",
    }[method]
    hit = "residual > spike_limit" if method == "hybrid" else "Actuals > spike_limit"
    return f"""
sb0 AS (SELECT *, count(Actuals) OVER (PARTITION BY Product, Division, month(Month)) AS pm, lag(Actuals) OVER (PARTITION BY Product, Division ORDER BY Month) AS prev FROM {source}),
sb1 AS (SELECT *, min(pm) OVER (PARTITION BY Product, Division) >= 3 AS seasonal,
    quantile_cont(Actuals, 0.5) OVER (PARTITION BY Product, Division, month(Month) ORDER BY Month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sm,
    CASE WHEN count(Actuals) OVER ({back}) >= 6 THEN quantile_cont(Actuals, 0.5) OVER ({back}) END AS rm FROM sb0),
sb2 AS (SELECT * EXCLUDE (pm, seasonal, sm, rm), CASE WHEN seasonal THEN sm ELSE rm END AS spike_baseline, Actuals - (CASE WHEN seasonal THEN sm ELSE rm END) AS residual FROM sb1),
sb3 AS (SELECT *, {limit} AS spike_limit FROM sb2),
lab AS (SELECT * EXCLUDE (prev), coalesce({hit}, false)::BIGINT AS spike_label, CASE WHEN residual IS NOT NULL THEN greatest(residual, 0) END AS spike_magnitude FROM sb3)
"""


LABEL_DOUBLES = "Actuals spike_baseline residual spike_limit spike_magnitude"


# greatest() over a null median must stay null: both engines skip nulls, so the twin guards it.
_HYBRID = _labels_sql("hybrid").replace(
    "sb3 AS (SELECT *,", "sb3 AS (SELECT * REPLACE (CASE WHEN mad_known THEN spike_limit END AS spike_limit) EXCLUDE (mad_known) FROM (SELECT *, count(residual) OVER (PARTITION BY Product, Division) > 0 AS mad_known,"
).replace("AS spike_limit FROM sb2)", "AS spike_limit FROM sb2))").replace("EXCLUDE (mad_known) FROM", "FROM", 1).replace("lab AS (SELECT * EXCLUDE (prev)", "lab AS (SELECT * EXCLUDE (prev, mad_known)")


@query("spike_labels_hybrid", with_ctes(C.FACT, _HYBRID, body="SELECT * FROM lab"), LABEL_DOUBLES)
def spike_labels_hybrid(spark, sf):
    return X.spike_labels(D.monthly_fact(spark, sf), "hybrid", 1.5)


@query("spike_labels_quantile", with_ctes(C.FACT, _labels_sql("quantile", param="0.8"), body="SELECT * FROM lab"), LABEL_DOUBLES)
def spike_labels_quantile(spark, sf):
    return X.spike_labels(D.monthly_fact(spark, sf), "quantile", 0.8)


def _impute_sql(cols) -> str:
    return ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"quantile_cont({c}, 0.5) OVER (PARTITION BY Product, Division, month_of_year), quantile_cont({c}, 0.5) OVER (PARTITION BY Product, Division))::DOUBLE AS {c}" for c in cols)


IMPUTED = ["pipeline_primary_lag1", "pipeline_primary_lag2", "pipeline_due_1m_lag1", "snapshot_age_lag3"]


@query("spike_impute", with_ctes(ASOF_WIDE, body=f"SELECT Product, Division, Month, {_impute_sql(IMPUTED)} FROM af"), " ".join(IMPUTED))
def spike_impute(spark, sf):
    return X.impute(_asof(spark, sf)[1], IMPUTED).select(*SERIES, "Month", *IMPUTED)


BANDS = with_ctes(ASOF_WIDE, body="""
  SELECT Product, Division, Month, y_lag12, rs AS risk_scale, CASE WHEN y_lag12 IS NOT NULL THEN greatest(y_lag12 - (bm + rs * sm), 0) END AS risk_lower, y_lag12 + bm + rs * sm AS risk_upper FROM (
    SELECT *, least(greatest(coalesce((pipeline_primary_lag1 - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1 END), 0), 0), 1)::DOUBLE AS rs FROM (
      SELECT *, min(pipeline_primary_lag1) OVER w AS lo, max(pipeline_primary_lag1) OVER w AS hi, avg(abs(Actuals - y_lag1)) OVER w AS bm, avg(abs(Actuals - y_lag12)) OVER w AS sm
      FROM af WINDOW w AS (PARTITION BY Product, Division)))""")


@query("risk_bands", BANDS, "y_lag12 risk_scale risk_lower risk_upper")
def risk_bands(spark, sf):
    from seriesloom.schema import of_series

    rows = _asof(spark, sf)[1]
    rows = rows.withColumn("base_mae", F.avg(F.abs(F.col("Actuals") - F.col("y_lag1"))).over(of_series())).withColumn(
        "spike_mae", F.avg(F.abs(F.col("Actuals") - F.col("y_lag12"))).over(of_series()))
    return X.risk_bands(rows, "pipeline_primary_lag1", "y_lag12", "base_mae", "spike_mae").select(
        *SERIES, "Month", "y_lag12", "risk_scale", "risk_lower", "risk_upper")


SCORES = C.FACT + "," + _labels_sql("quantile", param="0.8") + """,
scored AS (SELECT Product, Division, spike_label AS label, coalesce(spike_baseline, 0) AS score FROM lab)
"""
_AUC = """SELECT {keys} CASE WHEN max(pt) > 0 AND max(pt) < max(nt) THEN sum(prec * pos / nullif(pt, 0)) END AS pr_auc, max(pt)::BIGINT AS positives, max(nt)::BIGINT AS n_rows FROM (
  SELECT {keys} pos, sum(pos) OVER (c RANGE UNBOUNDED PRECEDING) / sum(n) OVER (c RANGE UNBOUNDED PRECEDING) AS prec, sum(pos) OVER ({part}) AS pt, sum(n) OVER ({part}) AS nt
  FROM (SELECT {keys} score, count(*) AS n, sum(label) AS pos FROM scored GROUP BY ALL) WINDOW c AS ({part} ORDER BY score DESC)) {group}"""


def _scores(spark, sf):
    lab = X.spike_labels(D.monthly_fact(spark, sf), "quantile", 0.8)
    return lab.select(*SERIES, F.col("spike_label").alias("label"), F.coalesce("spike_baseline", F.lit(0.0)).alias("score"))


@query("pr_auc_series", with_ctes(SCORES, body=_AUC.format(keys="Product, Division,", part="PARTITION BY Product, Division", group="GROUP BY ALL")), "pr_auc")
def pr_auc_series(spark, sf):
    return M.pr_auc(_scores(spark, sf), SERIES)


@query("pr_auc_pooled", with_ctes(SCORES, body=_AUC.format(keys="", part="", group="")), "pr_auc")
def pr_auc_pooled(spark, sf):
    return M.pr_auc_pooled(cut_lineage(_scores(spark, sf)))


@query("cv_fold_spikes", with_ctes(C.FACT, _labels_sql("quantile", param="0.8"), body="""
  SELECT Product, Division, n_folds, test_fold, count(*) AS n_rows, sum(spike_label)::BIGINT AS spikes FROM (
    SELECT *, CASE WHEN back // 6 < n_folds THEN n_folds - back // 6 END AS test_fold FROM (
      SELECT *, greatest(least(5, count(*) OVER (PARTITION BY Product, Division) // 6 - 1), 0)::BIGINT AS n_folds, row_number() OVER (PARTITION BY Product, Division ORDER BY Month DESC) - 1 AS back FROM lab)) GROUP BY ALL"""))
def cv_fold_spikes(spark, sf):
    folds = K.cv_folds(X.spike_labels(D.monthly_fact(spark, sf), "quantile", 0.8))
    return folds.groupBy(*SERIES, "n_folds", "test_fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("spike_label").alias("spikes"))
