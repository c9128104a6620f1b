"""Forecast error metrics over the long holdout table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.dates import month_diff, month_start
from seriesloom.functions.numeric import finite
from seriesloom.schema import MODEL_KEY, SERIES


def mae(a, f) -> Column:
    return F.avg(F.abs(a - f))


def rmse(a, f) -> Column:
    return F.sqrt(F.avg(F.pow(a - f, F.lit(2.0))))


def wape(a, f, eps: float = 1e-9) -> Column:
    """Sum of absolute errors over sum of absolute actuals, null when the latter is ~0."""
    both = a.isNotNull() & f.isNotNull()
    denom = F.sum(F.when(both, F.abs(a)))
    return F.when(denom > eps, F.sum(F.abs(a - f)) / denom)


def _pairs(holdout: DataFrame) -> DataFrame:
    return holdout.select(
        *MODEL_KEY,
        month_start("Date").alias("Date"),
        finite("Actual").alias("Actual"),
        finite("Forecast").alias("Forecast"),
    )


def monthly_pairs(holdout: DataFrame) -> DataFrame:
    """One row per model and month: models with several rows a month are averaged."""
    complete = _pairs(holdout).dropna(how="any", subset=["Date", "Actual", "Forecast"])
    return complete.groupBy(*MODEL_KEY, "Date").agg(
        F.avg("Actual").alias("Actual"), F.avg("Forecast").alias("Forecast")
    )


def error_metrics(holdout: DataFrame) -> DataFrame:
    a, f = F.col("Actual"), F.col("Forecast")
    return _pairs(holdout).groupBy(*MODEL_KEY).agg(
        mae(a, f).alias("Test_MAE"), rmse(a, f).alias("Test_RMSE"), wape(a, f).alias("WAPE")
    )


def directional_accuracy(holdout: DataFrame, min_periods: int = 6) -> DataFrame:
    """Share of month-on-month moves whose sign the forecast shares, and the move count."""
    w = Window.partitionBy(*MODEL_KEY).orderBy("Date")
    da = F.signum(F.col("Actual") - F.lag("Actual").over(w))
    df = F.signum(F.col("Forecast") - F.lag("Forecast").over(w))
    moves = monthly_pairs(holdout).withColumn("hit", (da == df).cast("double"))
    n = F.count("hit")
    return moves.groupBy(*MODEL_KEY).agg(
        F.when(n >= min_periods, F.avg("hit")).alias("DA"), n.alias("DA_Valid_Periods")
    )


def _bias_columns(bias: Column, denom: Column, eps: float) -> list[Column]:
    safe = F.when(F.abs(denom) > eps, denom).otherwise(F.lit(eps))
    return [
        bias.alias("bias"),
        F.abs(bias).alias("abs_bias"),
        (bias / safe).alias("bias_pct"),
        F.abs(bias / safe).alias("abs_bias_pct"),
    ]


def bias_metrics(holdout: DataFrame, eps: float = 1e-9) -> DataFrame:
    """Unweighted bias on monthly means."""
    bias = F.sum(F.col("Forecast") - F.col("Actual"))
    return monthly_pairs(holdout).groupBy(*MODEL_KEY).agg(*_bias_columns(bias, F.sum("Actual"), eps))


def recency_weights(monthly: DataFrame) -> DataFrame:
    """Adds `weight`: bucket share by months back from the model's last date.

    Shares of absent buckets are spread over the present ones; inside a bucket rows are equal.
    """
    model = Window.partitionBy(*MODEL_KEY)
    back = month_diff(F.max("Date").over(model), F.col("Date"))
    bucket = F.when(back <= 2, "recent").when(back <= 5, "mid").otherwise("old")
    rows = monthly.withColumn("bucket", bucket)
    share = F.when(F.col("bucket") == "recent", cfg.RECENCY_WEIGHTS["recent"]).when(
        F.col("bucket") == "mid", cfg.RECENCY_WEIGHTS["mid"]
    ).otherwise(cfg.RECENCY_WEIGHTS["old"])
    counts = {b: F.count_if(F.col("bucket") == b).over(model) for b in cfg.RECENCY_WEIGHTS}
    present = sum(
        (F.when(counts[b] > 0, v).otherwise(0.0) for b, v in cfg.RECENCY_WEIGHTS.items()), F.lit(0.0)
    )
    own = F.when(F.col("bucket") == "recent", counts["recent"]).when(
        F.col("bucket") == "mid", counts["mid"]
    ).otherwise(counts["old"])
    return rows.withColumn("weight", share / present / own)


def weighted_metrics(holdout: DataFrame, eps: float = 1e-9) -> DataFrame:
    """Recency-weighted MAE, RMSE and bias."""
    rows = recency_weights(monthly_pairs(holdout))
    w, err = F.col("weight"), F.col("Forecast") - F.col("Actual")
    bias = F.sum(w * err)
    return rows.groupBy(*MODEL_KEY).agg(
        F.sum(w * F.abs(err)).alias("Weighted_MAE"),
        F.sqrt(F.sum(w * err * err)).alias("Weighted_RMSE"),
        *_bias_columns(bias, F.sum(w * F.col("Actual")), eps),
    )


def position_weighted_mae(holdout: DataFrame) -> DataFrame:
    """MAE weighted by step: 1-3, 4-6, 7-12, renormalised over the valid points."""
    model = Window.partitionBy(*MODEL_KEY)
    rows = _pairs(holdout).withColumn("step", F.row_number().over(model.orderBy("Date"))).withColumn(
        "n", F.count(F.lit(1)).over(model)
    )
    weight = F.lit(0.0)
    for start, end, share in cfg.POSITION_BUCKETS:
        inside = F.col("step").between(start, end)
        weight = F.when(inside, share / (F.least(F.lit(end), F.col("n")) - start + 1)).otherwise(weight)
    err = F.abs(F.col("Actual") - F.col("Forecast"))
    valid = F.sum(F.when(err.isNotNull(), weight))
    return rows.groupBy(*MODEL_KEY).agg(
        F.when(valid > 0, F.sum(err * weight) / valid).alias("Test_WMAE")
    )


def rolling_origin_mae(origin_errors: DataFrame, by=MODEL_KEY) -> DataFrame:
    """Mean over origins of each origin's MAE. Input: one row per (key, origin, test row) with abs_err."""
    per_origin = origin_errors.groupBy(*by, "origin").agg(F.avg("abs_err").alias("origin_mae"))
    return per_origin.groupBy(*by).agg(
        F.avg("origin_mae").alias("ROCV_MAE"), F.count("origin_mae").alias("n_origins")
    )


def pr_auc(scored: DataFrame, keys, label: str = "label", score: str = "score") -> DataFrame:
    """Average precision per key, null when only one class is present.

    Rows are first reduced to distinct scores with their counts, so ties form one step and the
    cumulative sum runs over distinct scores of one key.
    """
    keys = list(keys)
    steps = scored.groupBy(*keys, score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos")
    )
    down = Window.partitionBy(*keys).orderBy(F.col(score).desc())
    upto = down.rowsBetween(Window.unboundedPreceding, 0)
    all_rows = Window.partitionBy(*keys)
    curve = steps.select(
        *keys,
        "pos",
        (F.sum("pos").over(upto) / F.sum("n").over(upto)).alias("precision"),
        F.sum("pos").over(all_rows).alias("P"),
        F.sum("n").over(all_rows).alias("N"),
    )
    return curve.groupBy(*keys).agg(
        F.when((F.max("P") > 0) & (F.max("P") < F.max("N")),
               F.sum(F.col("precision") * F.col("pos") / F.when(F.col("P") > 0, F.col("P")))).alias("pr_auc"),
        F.max("P").alias("positives"),
        F.max("N").alias("n_rows"),
    )


def pr_auc_pooled(scored: DataFrame, label: str = "label", score: str = "score", buckets: int = 256) -> DataFrame:
    """Average precision over all rows at once, as one row, without a one-task sort.

    Distinct scores are split into ranges at approximate quantiles; ranges are summed, and each
    range starts from the totals of the ranges above it. The split only decides where work runs:
    the result is exact.
    """
    steps = scored.groupBy(F.col(score).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    cuts = steps.agg(
        F.percentile_approx("s", [i / buckets for i in range(1, buckets)], 10000)
    ).scalar()
    placed = steps.withColumn("cuts", cuts).withColumn("bucket", F.size(F.filter("cuts", lambda c: c > F.col("s")))).drop("cuts")
    totals = placed.groupBy("bucket").agg(F.sum("n").alias("bn"), F.sum("pos").alias("bp"))
    above = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = totals.select(  # at most `buckets` rows
        "bucket",
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("p0"),
        F.sum("bp").over(everything).alias("all_pos"),
        F.sum("bn").over(everything).alias("all_n"),
    )
    run = Window.partitionBy("bucket").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    curve = placed.join(F.broadcast(offsets), "bucket").select(
        "pos", "all_pos", "all_n",
        ((F.col("p0") + F.sum("pos").over(run)) / (F.col("n0") + F.sum("n").over(run))).alias("precision"),
    )
    return curve.agg(
        F.when((F.max("all_pos") > 0) & (F.max("all_pos") < F.max("all_n")),
               F.sum(F.col("precision") * F.col("pos") / F.when(F.col("all_pos") > 0, F.col("all_pos")))).alias("pr_auc"),
        F.max("all_pos").alias("positives"),
        F.max("all_n").alias("n_rows"),
    )


def exact_median(df: DataFrame, value: str, buckets: int = 256) -> DataFrame:
    """Exact median of a column over the whole table, as one row, without a one-task sort.

    Values are reduced to (value, count), placed into ranges at approximate quantiles, and only
    the ranges that hold the middle ranks are ordered.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cuts = counts.agg(F.percentile_approx("v", [i / buckets for i in range(1, buckets)], 10000)).scalar()
    placed = counts.withColumn("cuts", cuts).withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
    totals = placed.groupBy("bucket").agg(F.sum("n").alias("bn"))
    before = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = totals.select(  # at most `buckets` rows
        "bucket",
        "bn",
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"),
        F.sum("bn").over(everything).alias("all_n"),
    ).withColumn("lo", F.floor((F.col("all_n") - 1) / 2)).withColumn("hi", F.floor(F.col("all_n") / 2))
    middle = offsets.filter(
        ((F.col("lo") >= F.col("n0")) & (F.col("lo") < F.col("n0") + F.col("bn")))
        | ((F.col("hi") >= F.col("n0")) & (F.col("hi") < F.col("n0") + F.col("bn")))
    )
    run = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(F.broadcast(middle), "bucket").withColumn("end", F.col("n0") + F.sum("n").over(run))
    lo = F.min(F.when(F.col("end") > F.col("lo"), F.col("v")))
    hi = F.min(F.when(F.col("end") > F.col("hi"), F.col("v")))
    return ranked.agg(((lo + hi) / 2).alias("median"))
