"""Spike (burst) model: labels, features, a classifier and a magnitude model per series, risk bands.

Labels and imputed features are column expressions; every (fold, parameter) is a model of its series' group, and all of
them are fitted by one call of the tree engine. Missing values that imputation leaves go to the trees as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.lineage import cut_lineage
from seriesloom.functions.numeric import floor_zero
from seriesloom.operators.forecasters import trees
from seriesloom.operators.forecasters.boosting import FEATURES
from seriesloom.schema import SERIES, by_month, of_series


def _rolling(c: str, q: float, first: int, last: int, least: int) -> Column:
    w = by_month().rowsBetween(first, last)
    return F.when(F.count(c).over(w) >= least, F.percentile(c, q).over(w))


def spike_baseline(fact: DataFrame, y: str = "Actuals") -> DataFrame:
    """Median of earlier years in the same calendar month where every calendar month has three
    values; otherwise the median of the twelve rows before. Never uses the row itself."""
    moy = F.month("Month")
    per_month = F.count(y).over(Window.partitionBy(*SERIES, moy))
    df = fact.withColumn("_per_month", per_month)
    earlier = Window.partitionBy(*SERIES, moy).orderBy("Month").rowsBetween(Window.unboundedPreceding, -1)
    seasonal = F.min("_per_month").over(of_series()) >= 3
    return df.withColumn(
        "spike_baseline",
        F.when(seasonal, F.percentile(y, 0.5).over(earlier)).otherwise(_rolling(y, 0.5, -12, -1, 6)),
    ).withColumn("residual", F.col(y) - F.col("spike_baseline")).drop("_per_month")


def spike_labels(fact: DataFrame, method: str = "hybrid", param: float = 1.5, floor: float = 100.0, y: str = "Actuals") -> DataFrame:
    """Adds spike_label (0/1) and spike_magnitude = max(residual, 0)."""
    df = spike_baseline(fact, y)
    if method == "quantile":
        before = F.lag(y, 1).over(by_month())
        df = df.withColumn("_before", before)
        limit = F.coalesce(_rolling(y, param, -12, -1, 6), F.percentile("_before", param).over(of_series()))
        df = df.withColumn("spike_limit", limit).drop("_before")
        hit = F.col(y) > F.col("spike_limit")
    elif method == "hybrid":
        df = df.withColumn("_abs", F.abs("residual"))
        mad = F.coalesce(_rolling("_abs", 0.5, -11, 0, 6), F.percentile("_abs", 0.5).over(of_series()))
        df = df.withColumn("_mad", mad)
        limit = F.when(F.col("_mad").isNotNull(), F.greatest(param * F.col("_mad"), F.lit(float(floor))))
        df = df.withColumn("spike_limit", limit).drop("_abs", "_mad")
        hit = F.col("residual") > F.col("spike_limit")
    else:
        raise ValueError(f"unknown spike label method: {method}")
    return df.withColumn("spike_label", F.coalesce(hit, F.lit(False)).cast("int")).withColumn(
        "spike_magnitude", floor_zero(F.col("residual"))
    )


def impute(df: DataFrame, columns, reference: Column | None = None) -> DataFrame:
    """Forward fill, then the calendar-month median, then the overall median of the reference rows.

    `reference` marks the rows medians may use (default: all); rows after it never leak back.
    """
    ref = F.lit(True) if reference is None else reference
    past = by_month().rowsBetween(Window.unboundedPreceding, 0)
    same_month = Window.partitionBy(*SERIES, "month_of_year")
    df = df.withColumns({f"_r_{c}": F.when(ref, F.col(c).cast("double")) for c in columns})
    filled = {
        c: F.coalesce(
            F.last(F.col(c).cast("double"), True).over(past),
            F.percentile(f"_r_{c}", 0.5).over(same_month),
            F.percentile(f"_r_{c}", 0.5).over(of_series()),
        )
        for c in columns
    }
    return df.withColumns(filled).drop(*[f"_r_{c}" for c in columns])


def spike_feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "pipeline_" in c or c.startswith("snapshot_") or c in ("month_of_year", "quarter")]


R_BASE = "Insufficient history after baseline feature creation."
SPIKE_ROWS = ("Product string, Division string, kind string, fold int, param double, Month date, Actuals double, baseline_pred double, spike_prob double, "
              "spike_mag_pred double, final_forecast double, test_label int, train_spikes int, test_spikes int, spike_mae double, feature string, "
              "classifier_importance double, regressor_importance double, reason string")


def holdout_flag(df: DataFrame, rows: int) -> DataFrame:
    back = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("Month").desc()))
    return df.withColumn("is_train", back > rows)


def labelled_folds(rows: DataFrame, params, spike: cfg.SpikeConfig) -> DataFrame:
    """Imputed features and, for each parameter, labels label_0, label_1 ... of every (series, fold).

    `rows` has fold and in_train. The fold rides in the product key, so that medians and limits see their fold alone.
    """
    columns = [c for c in spike_feature_columns(rows) if c not in ("month_of_year", "quarter", "pipeline_missing_flag")]
    keyed = rows.withColumn("Product", F.concat_ws("\u0001", F.col("fold").cast("string"), "Product"))
    imputed = cut_lineage(impute(keyed, columns, F.col("in_train")))
    out = imputed
    for i, param in enumerate(params):
        labelled = spike_labels(out, spike.method, param, spike.abs_floor)
        out = labelled.withColumnRenamed("spike_label", f"label_{i}").drop("spike_limit", "spike_baseline", "residual")
        if i + 1 < len(params):
            out = out.drop("spike_magnitude")
    return out.withColumn("Product", F.substring_index("Product", "\u0001", -1))


def _average_precision(label: np.ndarray, score: np.ndarray) -> float:
    """Area under the precision-recall steps; rows of equal score count together; NaN with one class only."""
    if len(np.unique(label)) < 2:
        return np.nan
    order = np.argsort(-score, kind="stable")
    label, score = label[order], score[order]
    hits, ends = np.cumsum(label), np.flatnonzero(np.append(score[1:] != score[:-1], True))
    recall = hits[ends] / hits[-1]
    return float((np.diff(recall, prepend=0.0) * hits[ends] / (ends + 1)).sum())


def _spike_models(columns: list[str], params: tuple, base_config: cfg.BoostConfig, config: cfg.BoostConfig):
    """applyInPandas function: scored test rows, fold scores and importances of one series."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        series, rows = rows[SERIES].iloc[0].tolist(), rows.sort_values(["fold", "Month"])
        own = [c for c in FEATURES if c != "y_lag12" or rows["y_lag12"].notna().any()]
        rows = rows[rows[own].notna().all(axis=1) & rows["Actuals"].notna()]
        parts = []
        if len(rows):
            y, fold, train = rows["Actuals"].to_numpy(dtype=float), rows["fold"].to_numpy(dtype=np.int64), rows["in_train"].to_numpy(dtype=bool)
            x, base = rows[columns].to_numpy(dtype=float), rows[own].to_numpy(dtype=float)
            varied = np.array([len(np.unique(x[~np.isnan(x[:, j]), j])) + np.isnan(x[:, j]).any() > 1 for j in range(x.shape[1])])
            names, x = [c for c, v in zip(columns, varied, strict=True) if v], x[:, varied]
            folds = int(fold.max()) + 1
            lag = trees.fit(base[train], y[train], fold[train], folds, base_config).predict(base, fold)
            magnitude = rows["spike_magnitude"].to_numpy(dtype=float)
            label = np.stack([rows[f"label_{i}"].to_numpy(dtype=float) for i in range(len(params))], axis=1)
            # A model for each (fold, parameter).
            t = np.flatnonzero(train)
            model = (fold[t][:, None] * len(params) + np.arange(len(params))).ravel()
            many, hit = np.repeat(t, len(params)), label[t].ravel()
            positive = np.bincount(model, weights=hit, minlength=folds * len(params))
            size = np.bincount(model, minlength=folds * len(params))
            weight = np.where(hit == 1, ((size - positive) / np.maximum(positive, 1))[model], 1.0)
            classifier = trees.fit(x[many], hit, model, folds * len(params), config, weight, classify=True)
            spikes = (hit == 1) & np.isfinite(magnitude[many])
            sizes = trees.fit(x[many][spikes], magnitude[many][spikes], model[spikes], folds * len(params), config)
            one_class = (positive == 0) | (positive == size)
            test = np.flatnonzero(~train)
            for i, param in enumerate(params):
                of_all = fold * len(params) + i
                prob = np.where(one_class[of_all], (positive > 0)[of_all].astype(float), trees.probability(classifier.predict(x, of_all)))
                extra = np.maximum(sizes.predict(x, of_all), 0.0)
                scored = rows.iloc[test][["fold", "Month", "Actuals"]].copy()
                scored["kind"], scored["param"], scored["baseline_pred"] = "test", param, lag[test]
                scored["spike_prob"], scored["spike_mag_pred"] = prob[test], extra[test]
                scored["final_forecast"], scored["test_label"] = lag[test] + prob[test] * extra[test], label[test, i].astype(int)
                parts.append(scored)
                for f in np.unique(fold).tolist():
                    of, own_train = fold == f, (fold == f) & train & (label[:, i] == 1) & np.isfinite(magnitude)
                    parts.append(pd.DataFrame([{"kind": "fold", "fold": f, "param": param, "train_spikes": int(label[of & train, i].sum()), "test_spikes": int(label[of & ~train, i].sum()),
                                                "final_forecast": float(np.abs(lag + prob * extra - y)[of & ~train].mean()) if (of & ~train).any() else np.nan,
                                                "spike_prob": _average_precision(label[of & ~train, i], prob[of & ~train]) if (of & ~train).any() else np.nan,
                                                "spike_mae": float(np.abs(extra - magnitude)[own_train].mean()) if own_train.any() else np.nan}]))
                    m = f * len(params) + i
                    shares = [g / g.sum() if g.sum() > 0 else g for g in (classifier.gain[m], sizes.gain[m])]
                    parts.append(pd.DataFrame({"kind": "importance", "fold": f, "param": param, "feature": names, "classifier_importance": shares[0], "regressor_importance": shares[1]}))
        known = set(rows["fold"].tolist()) if len(rows) else set()
        parts.append(pd.DataFrame([{"kind": "summary", "reason": None if known else R_BASE}]))
        return trees.result(parts, SPIKE_ROWS, series)

    return run


def spike_models(rows: DataFrame, params, spike: cfg.SpikeConfig = cfg.SpikeConfig(), base_config: cfg.BoostConfig = cfg.LAG_TREES, config: cfg.BoostConfig = cfg.SPIKE_TREES) -> DataFrame:
    """Lag trees, spike classifier and magnitude trees of every (series, fold, parameter); `rows` has fold and in_train."""
    columns = spike_feature_columns(rows)
    frame = labelled_folds(rows, params, spike)
    keep = [*SERIES, "Month", "Actuals", "fold", "in_train", "spike_magnitude", *dict.fromkeys([*FEATURES, *columns]), *[f"label_{i}" for i in range(len(params))]]
    return cut_lineage(trees.by_series(frame.select(*keep)).applyInPandas(_spike_models(columns, tuple(float(p) for p in params), base_config, config), SPIKE_ROWS))


def evaluate(features: DataFrame, param: float, spike: cfg.SpikeConfig = cfg.SpikeConfig(), base_config: cfg.BoostConfig = cfg.LAG_TREES, config: cfg.BoostConfig = cfg.SPIKE_TREES) -> DataFrame:
    """Models of all rows but the last of every series, which are scored; kinds as in spike_models()."""
    flagged = holdout_flag(features.filter("Actuals is not null"), spike.holdout)
    return spike_models(flagged.withColumn("fold", F.lit(0)).withColumnRenamed("is_train", "in_train"), [param], spike, base_config, config)


def predictions(done: DataFrame) -> DataFrame:
    """Scored rows; a series without any has one row with the reason."""
    return done.filter("kind = 'test' or (kind = 'summary' and reason is not null)").select(
        *SERIES, "Month", "Actuals", "baseline_pred", "spike_prob", "spike_mag_pred", "final_forecast", "reason")


def importance(done: DataFrame) -> DataFrame:
    """Share of each feature in the gain of each series' two models."""
    return done.filter("kind = 'importance'").select(*SERIES, "feature", "classifier_importance", "regressor_importance")


def tune(features: DataFrame, spike: cfg.SpikeConfig = cfg.SpikeConfig(), base_config: cfg.BoostConfig = cfg.LAG_TREES, config: cfg.BoostConfig = cfg.SPIKE_TREES, params=None) -> DataFrame:
    """Scores per (series, param, fold): MAE, PR-AUC, error of the magnitude on training spikes, spike counts.

    Folds are row blocks counted back from the holdout; a fold trains on all earlier rows of the series.
    """
    from seriesloom.operators.backtest import cv_folds

    params = params or (spike.k_values if spike.method == "hybrid" else spike.quantiles)
    train = holdout_flag(features.filter("Actuals is not null"), spike.holdout).filter("is_train").drop("is_train")
    folded = cv_folds(train, spike.fold_rows, spike.folds)
    tested = F.coalesce(F.col("test_fold"), F.lit(0))
    each = folded.withColumn("fold", F.explode(F.sequence(F.lit(1), F.greatest("n_folds", F.lit(1))))).filter((F.col("n_folds") >= F.col("fold")) & (tested <= F.col("fold")))
    rows = each.withColumn("in_train", tested < F.col("fold")).drop("test_fold", "n_folds")
    done = spike_models(rows, params, spike, base_config, config)
    return done.filter("kind = 'fold'").select(
        *SERIES, "param", "fold", F.col("final_forecast").alias("fold_mae"), F.col("spike_prob").alias("pr_auc"), F.col("spike_mae").alias("fold_spike_mae"),
        F.col("train_spikes").alias("train_spike_count"), F.col("test_spikes").alias("test_spike_count"))


def tuned(scores: DataFrame) -> DataFrame:
    """Mean scores per series and param; the least error is chosen, ties by the smaller param."""
    known = F.when(~F.isnan("pr_auc"), F.col("pr_auc"))
    means = scores.groupBy(*SERIES, "param").agg(
        F.avg("fold_mae").alias("cv_mae"), F.avg(known).alias("cv_pr_auc"), F.avg(F.when(~F.isnan("fold_spike_mae"), F.col("fold_spike_mae"))).alias("cv_spike_mae"),
        F.sum("train_spike_count").alias("train_spikes"), F.sum("test_spike_count").alias("test_spikes"), F.count("fold_mae").alias("n_folds"))
    return means.withColumn("chosen", F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.round("cv_mae", 9), "param")) == 1)


def risk_bands(rows: DataFrame, risk: str, forecast: str, base_mae: str, spike_mae: str) -> DataFrame:
    """Band of base MAE plus the min-max scaled pipeline level times spike MAE; lower bound floored at 0."""
    w = of_series()
    low, high = F.min(risk).over(w), F.max(risk).over(w)
    span = F.when(high > low, high - low).otherwise(1.0)
    scale = F.least(F.greatest(F.coalesce((F.col(risk) - low) / span, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    width = F.col(base_mae) + scale * F.coalesce(spike_mae, base_mae)
    return rows.withColumn("risk_scale", scale).withColumn(
        "risk_lower", floor_zero(F.col(forecast) - width)
    ).withColumn("risk_upper", F.col(forecast) + width)
