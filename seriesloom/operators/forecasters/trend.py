"""Piecewise-linear trend plus yearly seasonality by ridge regression.

The changepoints of a fit lie evenly over the first 80 % of its own training rows, whatever their number, so each
rolling origin has its own design. A group is one series, which holds as many rows as there are months; all cuts of it
are solved together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators.forecasters.arima import extended
from seriesloom.schema import SERIES

#: Changepoints of a fit (fewer where its training rows are few) and the share of the rows they lie in.
KNOTS, KNOT_SHARE = 10, 0.8
FOURIER = 3
SCALE = 60.0
LEVEL_RIDGE, KNOT_RIDGE, WAVE_RIDGE = 1e-8, 4.0, 1e-4
Z80 = 1.2816
MIN_ROWS = 24


def changepoints(n: int, knots: int = KNOTS) -> np.ndarray:
    """Rows at which the trend of n training rows may bend."""
    return np.linspace(0, KNOT_SHARE * n, min(knots, max(int(KNOT_SHARE * n) - 1, 0)) + 1)[1:]


def design(row: np.ndarray, month: np.ndarray, n: int, knots: int = KNOTS) -> np.ndarray:
    """Level, slope, hinges and waves of rows (numbered from 1) for a fit on the first n of them."""
    bends = np.maximum(row[:, None] - changepoints(n, knots)[None, :], 0.0) / SCALE
    angle = 2 * np.pi * month[:, None] / 12 * np.arange(1, FOURIER + 1)[None, :]
    return np.column_stack((np.ones(len(row)), row / SCALE, bends, np.sin(angle), np.cos(angle)))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """(coefficients, sum of squared errors)."""
    ridge = np.full(x.shape[1], KNOT_RIDGE)
    ridge[:2], ridge[x.shape[1] - 2 * FOURIER :] = LEVEL_RIDGE, WAVE_RIDGE
    beta = np.linalg.solve(x.T @ x + np.diag(ridge), x.T @ y)
    return beta, float(((y - x @ beta) ** 2).sum())


def _months(fact: DataFrame, horizon: int) -> DataFrame:
    return extended(fact, horizon).select(*SERIES, "Month", F.month("Month").alias("month_no"), "y", "row_no", "n_rows")


def _schema(fact: DataFrame, rest: str) -> str:
    return ", ".join([*(f"{c} {fact.schema[c].dataType.simpleString()}" for c in SERIES), rest])


def forecast(fact: DataFrame, horizon: int = 12, knots: int = KNOTS) -> DataFrame:
    """Future forecasts with 80 % bounds, floored at nothing here; the library floors them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_no")
        n = int(rows["n_rows"].iloc[0])
        x = design(rows["row_no"].to_numpy(float), rows["month_no"].to_numpy(float), n, knots)
        beta, sse = fit(x[:n], rows["y"].to_numpy(float)[:n])
        value, spread = x[n:] @ beta, Z80 * np.sqrt(sse / (n - 2))
        return rows.iloc[n:][[*SERIES, "Month"]].assign(
            Model="PROPHET", h=np.arange(1, len(rows) - n + 1), Forecast=value, lower_ci=value - spread, upper_ci=value + spread)

    result = _schema(fact, "Model string, Month date, h int, Forecast double, lower_ci double, upper_ci double")
    return _months(fact, horizon).filter(F.col("n_rows") >= MIN_ROWS).groupBy(*SERIES).applyInPandas(run, result)


def backtest(fact: DataFrame, horizon: int = 12, min_train: int = 24, knots: int = KNOTS):
    """(holdout rows, one-step rolling-origin MAE)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_no")
        row, month, y = (rows[c].to_numpy(float) for c in ("row_no", "month_no", "y"))
        cut = len(rows) - horizon
        x = design(row, month, cut, knots)
        ahead = np.where(row > cut, x @ fit(x[:cut], y[:cut])[0], np.nan)
        one = np.full(len(rows), np.nan)
        for n in range(min_train, len(rows)):
            x = design(row[: n + 1], month[: n + 1], n, knots)
            one[n] = x[n] @ fit(x[:n], y[:n])[0]
        return rows[[*SERIES, "Month", "y"]].assign(ahead=ahead, one=one)

    long = (F.col("n_rows") >= MIN_ROWS) & (F.col("n_rows") > horizon + 5) & (F.col("row_no") <= F.col("n_rows"))
    scored = _months(fact, horizon).filter(long).groupBy(*SERIES).applyInPandas(run, _schema(fact, "Month date, y double, ahead double, one double"))
    scored = cut_lineage(scored.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("ahead", "one")}))
    holdout = scored.filter("ahead is not null").select(
        *SERIES, F.lit("PROPHET").alias("Model"), F.col("Month").alias("Date"), F.col("y").alias("Actual"), F.col("ahead").alias("Forecast"))
    rocv = scored.groupBy(*SERIES).agg(
        F.avg(F.abs(F.col("y") - F.col("one"))).alias("ROCV_MAE"), F.count("one").alias("n_origins")
    ).withColumn("Model", F.lit("PROPHET"))
    return holdout, rocv
