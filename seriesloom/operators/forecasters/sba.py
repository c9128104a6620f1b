"""Intermittent demand (Syntetos-Boylan approximation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.schema import SERIES


def _init() -> Column:
    none = F.lit(None).cast("double")
    return F.struct(none.alias("z"), none.alias("p"), F.lit(0.0).alias("q"), F.lit(0).alias("n"))


def _step(s: Column, y: Column, alpha: float) -> Column:
    q = s["q"] + 1.0
    hit = y > 0
    z = F.when(~hit, s["z"]).when(s["z"].isNull(), y).otherwise(s["z"] + alpha * (y - s["z"]))
    p = F.when(~hit, s["p"]).when(s["p"].isNull(), q).otherwise(s["p"] + alpha * (q - s["p"]))
    return F.struct(z.alias("z"), p.alias("p"), F.when(hit, F.lit(0.0)).otherwise(q).alias("q"), (s["n"] + 1).alias("n"))


def _level(s: Column, alpha: float) -> Column:
    return F.when(s["n"] == 0, None).when(s["p"] > 0, (1 - alpha / 2) * s["z"] / s["p"]).otherwise(0.0)


def sba_level(values: Column, alpha: float = 0.1) -> Column:
    """Forecast level after a whole array: 0 without demand, null when empty."""
    known = F.filter(values, lambda v: v.isNotNull())
    return F.aggregate(known, _init(), lambda s, y: _step(s, y, alpha), lambda s: _level(s, alpha))


def _history(fact: DataFrame, y: str) -> DataFrame:
    rows = fact.filter(F.col(y).isNotNull())
    return rows.groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("Month", F.col(y).cast("double").alias("y")))).alias("h")
    )


def sba_forecast(fact: DataFrame, y: str = "Actuals", alpha: float = 0.1) -> DataFrame:
    """Constant forecast per series from its known months."""
    return _history(fact, y).select(
        *SERIES, F.size("h").alias("n"), sba_level(F.col("h.y"), alpha).alias("forecast")
    )


def prefix_forecasts(fact: DataFrame, y: str = "y", alpha: float = 0.1) -> DataFrame:
    """Every one-step-ahead forecast of a series from one fold: row i uses rows before i only."""
    none = F.lit(None).cast("double")
    start = F.struct(_init().alias("s"), F.array(none).alias("out"))

    def step(acc, point):
        s = _step(acc["s"], point["y"], alpha)
        return F.struct(s.alias("s"), F.concat(acc["out"], F.array(_level(s, alpha))).alias("out"))

    folded = _history(fact, y).withColumn("f", F.aggregate("h", start, step, lambda acc: acc["out"]))
    return folded.select(*SERIES, F.posexplode(F.arrays_zip("h", "f")).alias("pos", "r")).filter(
        F.col("r.h").isNotNull()
    ).select(*SERIES, F.col("r.h.Month").alias("Month"), F.col("r.h.y").alias("y"),
             F.col("pos").alias("n_before"), F.col("r.f").alias("forecast"))


def sba_holdout(fact: DataFrame, y: str = "Actuals", horizon: int = 12, alpha: float = 0.1) -> DataFrame:
    """The last `horizon` known months of each longer series, with the level after the months before them.

    One fold to that cut gives the level: the forecasts before it are not needed, nor rows for them.
    """
    n = F.size("h")
    # The level is a column before the months are listed: beside the generator it would be folded anew for each of them.
    cut = _history(fact, y).filter(n > horizon).select(
        *SERIES, sba_level(F.expr(f"slice(h.y, 1, size(h) - {int(horizon)})"), alpha).alias("level"), F.slice("h", n - horizon + 1, horizon).alias("last")
    )
    rows = cut.select(*SERIES, "level", F.inline("last"))
    return rows.select(*SERIES, F.lit("SBA").alias("Model"), F.col("Month").alias("Date"), F.col("y").alias("Actual"), F.col("level").alias("Forecast"))


def sba_backtest(fact: DataFrame, y: str = "Actuals", horizon: int = 12, min_train: int = 24, alpha: float = 0.1):
    """(holdout rows, rolling-origin MAE) of SBA."""
    rocv = prefix_forecasts(fact, y, alpha).filter(F.col("n_before") >= min_train).groupBy(*SERIES).agg(
        F.avg(F.abs(F.col("y") - F.col("forecast"))).alias("ROCV_MAE"), F.count(F.lit(1)).alias("n_origins")
    )
    return sba_holdout(fact, y, horizon, alpha), rocv.withColumn("Model", F.lit("SBA"))
