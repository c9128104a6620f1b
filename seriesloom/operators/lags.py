"""Lag features by row and by calendar month, and regressor candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.dates import month_idx
from seriesloom.schema import SERIES, by_month, of_series


def regressor_lags(fact: DataFrame) -> DataFrame:
    """Row lags of every signal present; absent signals give no columns."""
    w = by_month()
    cols = {
        f"{name}_l{k}": F.lag(name, k).over(w)
        for name, lags in cfg.REGRESSOR_LAGS
        if name in fact.columns
        for k in lags
    }
    return fact.withColumns(cols)


def regressor_long(fact: DataFrame) -> DataFrame:
    """Long form (series, Month, Regressor, Lag, x): one row per candidate and month."""
    wide = regressor_lags(fact)
    entries = [
        F.struct(F.lit(i).alias("candidate"), F.lit(name).alias("Regressor"), F.lit(k).alias("Lag"),
                 F.col(f"{name}_l{k}").cast("double").alias("x"))
        for i, (name, k) in enumerate(
            (name, k) for name, lags in cfg.REGRESSOR_LAGS for k in lags
        )
        if f"{name}_l{k}" in wide.columns
    ]
    return wide.select(*SERIES, "Month", "Actuals", F.explode(F.array(*entries)).alias("e")).select(
        *SERIES, "Month", "Actuals", "e.*"
    )


def regressor_quality(long: DataFrame) -> DataFrame:
    """Usable candidates: some value present and more than one distinct value."""
    return long.groupBy(*SERIES, "candidate", "Regressor", "Lag").agg(
        F.count("x").alias("n"), F.count_distinct("x").alias("n_distinct")
    ).withColumn("usable", (F.col("n") > 0) & (F.col("n_distinct") > 1))


def default_regressor(fact: DataFrame) -> DataFrame:
    """Usable candidate with the most history per series; the earlier candidate wins ties."""
    q = regressor_quality(regressor_long(fact)).filter("usable")
    best = q.groupBy(*SERIES).agg(F.min(F.struct((-F.col("n")).alias("o"), "candidate", "Regressor", "Lag", "n")).alias("b"))
    return best.select(*SERIES, "b.Regressor", "b.Lag", F.col("b.n").alias("n"))


def fill_both_ways(df: DataFrame, column: str) -> DataFrame:
    """Forward fill, then back fill, inside the series."""
    w = by_month()
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(
        f"{column}_filled",
        F.coalesce(F.last(column, True).over(past), F.first(column, True).over(ahead)),
    )


def target_lags(fact: DataFrame, y: str = "Actuals") -> DataFrame:
    """Row lags 1, 2, 3 and 12 of the target with calendar and trend columns.

    Lag 12 needs at least 24 known values in the series.
    """
    w = by_month()
    known = F.count(y).over(of_series())
    return fact.withColumns(
        {
            "y_lag1": F.lag(y, 1).over(w),
            "y_lag2": F.lag(y, 2).over(w),
            "y_lag3": F.lag(y, 3).over(w),
            "y_lag12": F.when(known >= 24, F.lag(y, 12).over(w)),
            "month_of_year": F.month("Month"),
            "quarter": F.quarter("Month"),
            "trend_index": F.row_number().over(w) - 1,
        }
    )


def exog_lags(fact: DataFrame, exog: str) -> DataFrame:
    w = by_month()
    return fact.withColumn(f"{exog}_l0", F.col(exog)).withColumn(f"{exog}_l1", F.lag(exog, 1).over(w))


def month_lags(fact: DataFrame, y: str = "Actuals") -> DataFrame:
    """Calendar lags 1-3 and null-skipping means of the last 3, 6, 12 calendar months.

    RANGE frames on the month number: a missing month is missing, not replaced by an older row.
    """
    w = Window.partitionBy(*SERIES).orderBy("m")
    df = fact.withColumn("m", month_idx("Month"))
    cols = {f"lag_{k}": F.max(y).over(w.rangeBetween(-k, -k)) for k in (1, 2, 3)}
    cols |= {f"roll_mean_{k}": F.avg(y).over(w.rangeBetween(-k, -1)) for k in (3, 6, 12)}
    return df.withColumns(cols).drop("m")


def regressor_for_choice(fact: DataFrame, choices: DataFrame) -> DataFrame:
    """Regressor of the chosen (name, lag) per series and month.

    Lags outside the candidate list are taken from the base column, so any lag can be asked for.
    """
    signals = [name for name, _ in cfg.REGRESSOR_LAGS if name in fact.columns]
    chosen = fact.join(choices.filter("reg_name is not null").select(*SERIES, "reg_name", "reg_lag"), SERIES)
    base = F.coalesce(*[F.when(F.col("reg_name") == s, F.col(s)) for s in signals])
    rows = chosen.select(*SERIES, "Month", "Actuals", "reg_name", "reg_lag", base.alias("base")).withColumn(
        "rn", F.row_number().over(by_month())
    )
    shifted = rows.select(*SERIES, (F.col("rn") + F.col("reg_lag")).alias("rn"), F.col("base").alias("x"))
    return rows.join(shifted, [*SERIES, "rn"], "left").select(
        *SERIES, "Month", "Actuals", "reg_name", "reg_lag", "x"
    )


def future_regressor(chosen: DataFrame, horizon: int = 12) -> DataFrame:
    """Future values of a chosen regressor: the last known value, held."""
    last = chosen.groupBy(*SERIES).agg(
        F.max("Month").alias("last_month"),
        F.max_by("x", F.when(F.col("x").isNotNull(), F.col("Month"))).alias("x"),
    )
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return last.select(*SERIES, "last_month", "x", F.explode(steps).alias("h")).select(
        *SERIES, F.add_months("last_month", F.col("h")).alias("Month"), "h", "x"
    )
