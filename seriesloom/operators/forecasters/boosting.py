"""Boosted-tree forecasters: every series has models of its own, fitted side by side in one group.

A series' group holds its months (or snapshots times months ahead), so it is small whatever the number of series; all of
its cuts are fitted by one call of the tree engine, which takes the cut as the model's key. No training row is ever
later than the cut it is used for. Every series leaves a row with the reason where something could not be fitted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.dates import month_idx
from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators import lags as L
from seriesloom.operators.forecasters import trees
from seriesloom.operators.forecasters.linear import dot, solver, with_prefix_gram
from seriesloom.schema import SERIES

LAG_FEATURES = ["y_lag1", "y_lag2", "y_lag3", "y_lag12"]
FEATURES = [*LAG_FEATURES, "month_of_year", "trend_index"]
MODEL = "ML_GBR"
# Reasons of the method.
R_ROWS = "Insufficient ML rows after dropping NaNs."
R_ROLLING = "Insufficient rows for ROCV."
R_HISTORY = "ML forecast failed: Insufficient history for recursive ML forecast."
#: Signals that a lag model may use, with their lags.
EXOG = {"New_Quotes": (0, 1), "Open_Opportunities": (0,), "Bookings": (0, 1)}

LAG_ROWS = ("Product string, Division string, kind string, Month date, h int, Actual double, Forecast double, ROCV_MAE double, "
            "n_origins int, n_train int, Forecast_valid boolean, Skip_Reason string")


# ---- lag model -----------------------------------------------------------
def lag_features(fact: DataFrame) -> tuple[DataFrame, list[str]]:
    """Row lags, calendar and trend of the target, and the lags of the signals that the fact has."""
    found = {f"{c}_l{k}": F.lag(F.col(c).cast("double"), k).over(L.by_month()) if k else F.col(c).cast("double")
             for c, lags in EXOG.items() if c in fact.columns for k in lags}
    rows = L.target_lags(fact.select(*SERIES, "Month", F.col("Actuals").cast("double").alias("Actuals"), *[c for c in EXOG if c in fact.columns]))
    return rows.withColumns(found).select(*SERIES, "Month", "Actuals", *FEATURES, *found), list(found)


def _recursive(forest: trees.Forest, model: int, history: list[float], last: pd.Timestamp, columns: list[str], horizon: int) -> list[tuple]:
    """Forecasts of the months after `last`; each becomes a lag of the next."""
    past, out = list(history), []
    for h in range(1, horizon + 1):
        month = last + pd.DateOffset(months=h)
        row = {"y_lag1": past[-1], "y_lag2": past[-2], "y_lag3": past[-3], "y_lag12": past[-12] if len(past) >= 12 else np.nan,
               "month_of_year": month.month, "trend_index": len(past)}
        y = float(forest.predict(np.array([[row[c] for c in columns]], dtype=float), np.array([model]))[0])
        out.append((month.date(), h, y))
        past.append(y)
    return out


def _lag_models(exog: list[str], horizon: int, least: int, config: cfg.BoostConfig):
    """applyInPandas function: holdout, rolling origins, forecast and a summary row of one series."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("Month")
        own = [c for c in FEATURES if c != "y_lag12" or rows["y_lag12"].notna().any()]
        y = rows["Actuals"].to_numpy(dtype=float)
        x = rows[own].to_numpy(dtype=float)
        every = rows[[*own, *exog]].to_numpy(dtype=float)
        months = pd.to_datetime(rows["Month"])
        usable = np.flatnonzero(~np.isnan(every).any(axis=1) & ~np.isnan(y))
        out, summary = [], {"kind": "summary", "Forecast_valid": False, "Skip_Reason": "", "n_origins": 0, "n_train": 0}
        if len(usable) <= horizon + 5:
            summary["Skip_Reason"] = R_ROWS
        else:
            train = usable[: len(usable) - horizon]
            summary["n_train"] = len(train)
            # Signals of the future are not known, so holdout and forecast go by lags and calendar. Model 1 knows all rows.
            fitted = trees.fit(x[np.concatenate((train, usable))], y[np.concatenate((train, usable))], np.repeat([0, 1], [len(train), len(usable)]), 2, config)
            test = usable[len(train) :]
            for i, f in zip(test, fitted.predict(x[test], np.zeros(len(test), dtype=int)), strict=True):
                out.append({"kind": "holdout", "Month": months.iloc[i].date(), "Actual": y[i], "Forecast": f})
            origins = np.arange(least, len(usable))
            if len(origins):
                model = np.repeat(np.arange(len(origins)), origins)
                part = np.concatenate([usable[:o] for o in origins])
                ahead = trees.fit(every[part], y[part], model, len(origins), config).predict(every[usable[origins]], np.arange(len(origins)))
                summary |= {"ROCV_MAE": float(np.abs(ahead - y[usable[origins]]).mean()), "n_origins": len(origins)}
            else:
                summary["Skip_Reason"] = R_ROLLING
            history = y[~np.isnan(y)].tolist()
            if len(history) < (12 if "y_lag12" in own else 3):
                summary["Skip_Reason"] = summary["Skip_Reason"] or R_HISTORY
            else:
                ahead = _recursive(fitted, 1, history, months[~np.isnan(y)].max(), own, horizon)
                summary["Forecast_valid"] = len(ahead) == horizon and bool(np.isfinite([f for _, _, f in ahead]).all())
                out += [{"kind": "forecast", "Month": m, "h": h, "Forecast": f} for m, h, f in ahead]
        return trees.result([pd.DataFrame([*out, summary])], LAG_ROWS, rows[SERIES].iloc[0].tolist())

    return run


def lag_models(fact: DataFrame, horizon: int = 12, least: int = 24, config: cfg.BoostConfig = cfg.LAG_TREES) -> DataFrame:
    """Rows of kind holdout, forecast and summary for every series; written once, since several readers follow."""
    rows, exog = lag_features(fact)
    return cut_lineage(trees.by_series(rows).applyInPandas(_lag_models(exog, horizon, least, config), LAG_ROWS))


def backtest(fact: DataFrame, horizon: int = 12, least: int = 24, config: cfg.BoostConfig = cfg.LAG_TREES):
    """(holdout rows, one row per series with the rolling MAE or the reason why there is none)."""
    done = lag_models(fact, horizon, least, config)
    holdout = done.filter("kind = 'holdout'").select(*SERIES, F.lit(MODEL).alias("Model"), F.col("Month").alias("Date"), "Actual", "Forecast")
    rocv = done.filter("kind = 'summary'").select(*SERIES, F.lit(MODEL).alias("Model"), "ROCV_MAE", "n_origins", "n_train", "Forecast_valid", "Skip_Reason")
    return holdout, rocv


def forecast(fact: DataFrame, horizon: int = 12, config: cfg.BoostConfig = cfg.LAG_TREES) -> DataFrame:
    """Recursive forecast of every series, and a row without a month and with the reason for the others."""
    done = lag_models(fact, horizon, config=config)
    return done.filter("kind = 'forecast' or (kind = 'summary' and not Forecast_valid)").select(
        *SERIES, F.lit(MODEL).alias("Model"), "Month", "h", "Forecast", F.when(F.col("kind") == "summary", F.col("Skip_Reason")).alias("Skip_Reason"))


# ---- baseline per snapshot -----------------------------------------------
BASE_X = ["one", "y_lag1", "y_lag2", "y_lag3", "y_lag12", "trend"]


def snapshot_baseline(fact: DataFrame, snapshots: DataFrame, horizon: int = 12) -> DataFrame:
    """Recursive baseline from every snapshot, using months before the snapshot only.

    A lag regression on running sums gives the coefficients at every snapshot in one pass.
    Targets run from the snapshot month to `horizon` months later.
    """
    known = L.target_lags(
        fact.filter("Actuals is not null").select(*SERIES, "Month", F.col("Actuals").cast("double").alias("Actuals"))
    ).select(
        *SERIES, "Month", F.col("Actuals").alias("y"), F.lit(1.0).alias("one"), "y_lag1", "y_lag2", "y_lag3",
        F.coalesce("y_lag12", F.lit(0.0)).alias("y_lag12"), (F.col("trend_index") / 60.0).alias("trend"),
        F.lit(False).alias("is_anchor"),
    )
    anchors = snapshots.select(*SERIES, F.col("snapshot_month").alias("Month"), F.lit(True).alias("is_anchor")).distinct()
    both = known.unionByName(anchors, allowMissingColumns=True).withColumn(
        "at", month_idx("Month") * 2 + F.when(F.col("is_anchor"), 0).otherwise(1)
    )
    both = with_prefix_gram(both, BASE_X, "y", order="at")
    before = Window.partitionBy(*SERIES).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    at = both.withColumn("past", F.collect_list("y").over(before)).filter("is_anchor").withColumn("n_before", F.size("past"))
    at = at.filter("n_before > 5").withColumn("fit", solver(len(BASE_X), 1e-3)(F.col("gram"), F.array(
        *[F.lit(1.0)] * 4, (F.col("n_before") >= 24).cast("double"), F.lit(1.0))))
    at = at.withColumn("hist", F.slice(F.concat(F.reverse("past"), F.array_repeat(F.lit(0.0), 12)), 1, 12))
    beta = F.col("fit.beta")

    def step(s, h):
        x = F.array(F.lit(1.0), s["h"][0], s["h"][1], s["h"][2], s["h"][11], (F.col("n_before") + h - 1) / 60.0)
        return F.struct(x.alias("x"), s.alias("s"))

    def push(t):
        v = F.array(dot(t["x"], beta))
        return F.struct(F.concat(v, F.slice(t["s"]["h"], 1, 11)).alias("h"), F.concat(t["s"]["out"], v).alias("out"))

    start = F.struct(F.col("hist").alias("h"), F.array().cast("array<double>").alias("out"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon + 1)), start,
                       lambda s, h: F.transform(F.array(step(s, h)), push)[0], lambda s: s["out"])
    return at.filter("fit.beta is not null").select(*SERIES, F.col("Month").alias("snapshot_month"), F.posexplode(path).alias("i", "baseline_pred")).select(
        *SERIES, "snapshot_month", F.add_months("snapshot_month", F.col("i")).alias("target_month"), "baseline_pred"
    )


# ---- residual model on snapshot features ---------------------------------
AMOUNTS = [
    "pipeline_primary", "pipeline_stage_weighted_primary", "delta_pipeline", "pipeline_slip_adjusted_primary",
    *[f"pipeline_{k}due_{m}m" for m in (1, 2, 3) for k in ("", "stage_weighted_", "slip_adjusted_")],
    "baseline_pred", "summary_primary",
]
PLAIN = ["months_ahead", "target_month_num", "pct_delta_pipeline", "pipeline_coverage", "slippage_months", "summary_primary_coverage"]


def residual_frame(features: DataFrame, baseline: DataFrame) -> DataFrame:
    """Features with their baseline as x_ columns; `residual` where the actual is known."""
    rows = features.join(baseline, [*SERIES, "snapshot_month", "target_month"])
    x = [c for c in rows.columns if c in AMOUNTS or c in PLAIN or c.startswith("summary_")]
    rows = rows.withColumns({f"x_{c}": F.col(c).cast("double") for c in x})
    known = F.col("actuals") - F.col("baseline_pred") if "actuals" in rows.columns else F.lit(None)
    return rows.withColumn("residual", known.cast("double"))


RESIDUAL_ROWS = ("Product string, Division string, kind string, snapshot_month date, target_month date, actuals double, baseline_pred double, "
                 "adjustment_pred double, final_pred double, fold_mae double, feature string, importance double, reason string")
R_FOLDS = "Fewer target months than holdout months."
R_TRAINING = "No training rows with actuals and a baseline."


def _residual_models(columns: list[str], folds: int, config: cfg.BoostConfig):
    """applyInPandas function: cross-validated rows, future rows, fold errors and importances of one series."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[columns].to_numpy(dtype=float)
        residual, base = rows["residual"].to_numpy(dtype=float), rows["baseline_pred"].to_numpy(dtype=float)
        month = pd.to_datetime(rows["target_month"]).to_numpy()
        known = np.flatnonzero(~np.isnan(residual))
        cuts = np.unique(month[known])[-folds:] if len(np.unique(month[known])) >= folds else month[:0]
        jobs = [("cv", known[month[known] < c], known[month[known] == c]) for c in cuts]
        jobs = [j for j in jobs if len(j[1])]
        if len(known):
            jobs.append(("future", known, np.flatnonzero(rows["is_future"].to_numpy(dtype=bool))))
        parts = []
        for kind, train, test in jobs:
            held = ~np.isnan(x[train]).all(axis=0)
            names = [c for c, h in zip(columns, held, strict=True) if h]
            median = np.nanmedian(x[train][:, held], axis=0) if held.any() else np.zeros(0)
            mine, new = (np.where(np.isnan(v), median, v) for v in (x[train][:, held], x[test][:, held]))
            one = np.zeros(len(train), dtype=np.int64)
            forest = trees.fit(mine, residual[train], one, 1, config)
            adjust = forest.predict(new, np.zeros(len(test), dtype=np.int64))
            done = rows.iloc[test][["snapshot_month", "target_month", "actuals", "baseline_pred"]].copy()
            done["kind"], done["adjustment_pred"], done["final_pred"] = kind, adjust, np.maximum(base[test] + adjust, 0.0)
            parts.append(done)
            if kind == "cv":
                parts.append(pd.DataFrame([{"kind": "fold", "target_month": done["target_month"].iloc[0], "fold_mae": float((done["final_pred"] - done["actuals"]).abs().mean())}]))
            else:
                gain = forest.gain[0]
                parts.append(pd.DataFrame({"kind": "importance", "feature": names, "importance": gain / gain.sum() if gain.sum() > 0 else gain}))
        reason = R_TRAINING if not len(known) else R_FOLDS if not len(cuts) else None
        parts.append(pd.DataFrame([{"kind": "summary", "reason": reason}]))
        return trees.result(parts, RESIDUAL_ROWS, rows[SERIES].iloc[0].tolist())

    return run


def residual_models(rows: DataFrame, future: DataFrame, folds: int = 12, config: cfg.BoostConfig = cfg.BoostConfig()) -> DataFrame:
    """Median imputation and boosted trees on the residual of the baseline, for every series.

    Kinds: cv (the last `folds` target months, each by a model of strictly earlier targets), fold (their errors), future
    (rows of `future` by the model of all rows), importance, summary (one per series, with a reason if folds are missing).
    """
    columns = [c for c in rows.columns if c.startswith("x_")]
    keep = [*SERIES, "snapshot_month", "target_month", "actuals", "baseline_pred", "residual", *columns]
    both = rows.select(*keep, F.lit(False).alias("is_future")).unionByName(future.select(*[c for c in keep if c in future.columns], F.lit(True).alias("is_future")), allowMissingColumns=True)
    both = both.withColumns({c: F.col(c).cast("double") for c in ("actuals", "baseline_pred")})
    return cut_lineage(trees.by_series(both).applyInPandas(_residual_models(columns, folds, config), RESIDUAL_ROWS))


def snapshot_model_run(fact, history, modes, summary=None, horizon: int = 12, holdout_months: int = 12,
                       config: cfg.BoostConfig = cfg.BoostConfig()) -> dict[str, DataFrame]:
    """Stand-alone run for all series: future forecast, cross-validated holdout, per-series means and overall means."""
    from seriesloom.operators import metrics as M
    from seriesloom.operators import snapshots as S

    history = cut_lineage(history)
    series = fact.select(*SERIES).distinct()
    features = S.feature_frame(fact, history, modes, summary, horizon)
    snaps = history.filter("snapshot_month is not null").select(*SERIES, "snapshot_month").distinct()
    rows = residual_frame(features, snapshot_baseline(fact, snaps, horizon))
    ahead = S.future_frame(fact, history, modes, summary, horizon)
    # The future baseline starts after the last known month, so it reaches every future target.
    last = fact.filter("Actuals is not null").groupBy(*SERIES).agg(F.add_months(F.max("Month"), 1).alias("snapshot_month"))
    base = snapshot_baseline(fact, last, horizon).drop("snapshot_month")
    keyed = ahead.join(base, [*SERIES, "target_month"]).select(*SERIES, "snapshot_month", "target_month", "baseline_pred")
    done = residual_models(rows, residual_frame(ahead, keyed), holdout_months, config)
    holdout = done.filter("kind = 'cv'").select(
        *SERIES, F.lit(cfg.SNAPSHOT_ML_MODEL).alias("Model"), F.col("target_month").alias("Date"), F.col("actuals").alias("Actual"), F.col("final_pred").alias("Forecast"))
    folds = done.filter("kind = 'fold'").groupBy(*SERIES).agg(F.avg("fold_mae").alias("ROCV_MAE"), F.count("fold_mae").alias("n_folds"))
    reasons = done.filter("kind = 'summary'").select(*SERIES, "reason")
    per_series = series.join(M.error_metrics(holdout), SERIES, "left").join(folds, SERIES, "left").join(reasons, SERIES, "left").withColumn(
        "Model", F.lit(cfg.SNAPSHOT_ML_MODEL)).withColumn(
        "Status", F.when(F.col("Test_MAE").isNotNull(), "OK").otherwise(F.coalesce("reason", F.lit("No feature rows.")))).drop("reason")
    overall = per_series.agg(
        F.count("Test_MAE").alias("n_series"), F.avg("Test_MAE").alias("mean_MAE"), F.avg("Test_RMSE").alias("mean_RMSE"),
        F.avg("WAPE").alias("mean_WAPE"), F.avg("ROCV_MAE").alias("mean_ROCV_MAE"),
    )
    future = done.filter("kind = 'future'").select(*SERIES, "snapshot_month", "target_month", "baseline_pred", "adjustment_pred", "final_pred")
    tables = {"forecast": future, "holdout": holdout, "per_series": per_series, "overall": overall,
              "importance": done.filter("kind = 'importance'").select(*SERIES, "feature", "importance")}
    if summary is not None:
        tables["skipped"] = S.snapshot_coverage(series, history, summary).filter("Reason is not null")
    return tables
