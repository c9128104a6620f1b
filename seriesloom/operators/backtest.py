"""Holdout split, rolling origins, future index and candidate grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.schema import SERIES, by_month


def holdout_split(fact: DataFrame, horizon: int = 12, known_only: bool = True) -> DataFrame:
    """Adds row number and `is_test` for the last `horizon` rows of the series."""
    df = fact.filter(F.col("Actuals").isNotNull()) if known_only else fact
    back = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("Month").desc()))
    return df.withColumn("row_no", F.row_number().over(by_month())).withColumn("is_test", back <= horizon)


def six_by_three(n: Column, steps: int = 6, splits: int = 3) -> Column:
    """Array of (train_end, test_end) splits; fewer when the series is short."""
    enough = n >= steps * splits + steps
    k = F.when(enough, F.lit(splits)).otherwise(F.greatest(F.lit(1), F.floor(n / steps).cast("int") - 1))
    all_splits = F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda i: F.struct(
            (n - (k - i - 1) * steps - steps).alias("train_end"), (n - (k - i - 1) * steps).alias("test_end")
        ),
    )
    return F.filter(all_splits, lambda s: s["train_end"] > steps)


def one_step(n: Column, min_train: int = 24) -> Column:
    return F.when(n > min_train, F.transform(
        F.sequence(F.lit(min_train), F.greatest(n - 1, F.lit(min_train))),
        lambda i: F.struct(i.alias("train_end"), (i + 1).alias("test_end")),
    ))


def last_origins(n: Column, steps: int = 12, keep: int = 12, min_train: int = 12) -> Column:
    last = n - steps
    first = F.greatest(F.lit(min_train), last - keep + 1)
    return F.when(last > min_train, F.transform(
        F.sequence(first, F.greatest(last, first)),
        lambda i: F.struct(i.alias("train_end"), (i + steps).alias("test_end")),
    ))


def rolling_origins(profile: DataFrame, scheme: cfg.OriginScheme, n: str = "history_months") -> DataFrame:
    """One row per series and origin under a rolling-origin scheme."""
    count = F.col(n).cast("int")
    if scheme == cfg.SIX_BY_THREE:
        splits = six_by_three(count, scheme.steps, scheme.splits)
    elif scheme == cfg.ONE_STEP:
        splits = one_step(count, scheme.min_train)
    else:
        splits = last_origins(count, scheme.steps, scheme.splits, scheme.min_train)
    return profile.select(*SERIES, F.explode(splits).alias("s")).select(*SERIES, "s.*")


def future_months(fact: DataFrame, horizon: int = 12) -> DataFrame:
    """The `horizon` months after the last known month of each series."""
    last = fact.groupBy(*SERIES).agg(F.max(F.when(F.col("Actuals").isNotNull(), F.col("Month"))).alias("last_month"))
    return last.select(
        *SERIES, F.posexplode(F.sequence(F.add_months("last_month", 1), F.add_months("last_month", horizon),
                                         F.expr("interval 1 month"))).alias("i", "Month")
    ).select(*SERIES, "Month", (F.col("i") + 1).alias("horizon"))


def order_grid(series: DataFrame, max_p=2, max_q=2, max_sp=1, max_sq=1) -> DataFrame:
    """36 candidate orders per series, by exploding the four ranges (d = D = 1, s = 12)."""
    def up_to(k):
        return F.explode(F.sequence(F.lit(0), F.lit(k)))

    grid = series.select(*SERIES)
    for name, k in (("p", max_p), ("q", max_q), ("sp", max_sp), ("sq", max_sq)):
        grid = grid.withColumn(name, up_to(k))
    return grid.withColumns({"d": F.lit(1), "sd": F.lit(1), "s": F.lit(12)})


def ets_grid(profile: DataFrame) -> DataFrame:
    """ETS specifications per series: multiplicative parts need non-negative data,
    seasonal parts at least 24 months."""
    some = F.col("nonnegative")
    seasonal_ok = F.col("history_months") >= 24
    error = F.when(some, F.array(F.lit("add"), F.lit("mul"))).otherwise(F.array(F.lit("add")))
    seasonal = (
        F.when(seasonal_ok & some, F.array(F.lit("none"), F.lit("add"), F.lit("mul")))
        .when(seasonal_ok, F.array(F.lit("none"), F.lit("add")))
        .otherwise(F.array(F.lit("none")))
    )
    trend = F.array(F.lit("none"), F.lit("add"), F.lit("damped"))
    return (
        profile.select(*SERIES, error.alias("errors"), seasonal.alias("seasonals"))
        .withColumn("error", F.explode("errors"))
        .withColumn("trend", F.explode(trend))
        .withColumn("seasonal", F.explode("seasonals"))
        .drop("errors", "seasonals")
    )


def cv_folds(df: DataFrame, rows: int = 6, folds: int = 5) -> DataFrame:
    """Time-series folds counted back from the end: fold k tests `rows` rows, trains on all before.

    Adds `test_fold` (null for rows that are never tested) and `n_folds`.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*SERIES))
    back = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("Month").desc())) - 1
    use = F.least(F.lit(folds), F.floor(n / rows).cast("int") - 1)
    out = df.withColumn("n_folds", F.greatest(use, F.lit(0))).withColumn("back", back)
    k = F.floor(F.col("back") / rows).cast("int")
    return out.withColumn("test_fold", F.when(k < F.col("n_folds"), F.col("n_folds") - k)).drop("back")


def long_to_wide(holdout: DataFrame, models) -> DataFrame:
    """Holdout pivot for reading: one column per model, mean forecast."""
    return holdout.groupBy(*SERIES, "Date").pivot("Model", list(models)).agg(F.avg("Forecast"))
