"""Exponential smoothing: up to 18 specifications per series by AICc.

A fold over the months carries level, trend, season and the error sums. The state path of a
specification does not depend on its error type (only the criterion does), so each
(trend, season, smoothing parameters) is folded once. The fold keeps the criterion after every
month, so each rolling origin takes the parameters that were best before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.lineage import cut_lineage
from seriesloom.schema import SERIES

TINY = 1e-9


def histories(fact: DataFrame, cut: int = 0) -> DataFrame:
    """One row per series: months and values in order, the last `cut` known months split off."""
    h = fact.filter("Actuals is not null").groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("Month", F.col("Actuals").cast("double").alias("y")))).alias("h")
    )
    n = F.size("h")
    return h.select(
        *SERIES, n.alias("n"), F.slice("h", F.lit(1), F.greatest(n - cut, F.lit(0))).alias("train"),
        F.slice("h", F.greatest(n - cut, F.lit(0)) + 1, F.lit(max(cut, 1))).alias("test"),
    )


def candidates(hist: DataFrame, config: cfg.EtsConfig = cfg.EtsConfig()) -> DataFrame:
    """(series, trend, season, parameters): specifications times the smoothing grid.

    Multiplicative season needs non-negative values, any season two full years.
    """
    y = F.col("train.y")
    nonneg = F.forall(y, lambda v: v >= 0)
    long = F.size("train") >= 2 * config.season

    def arr(values):
        return F.array(*[F.lit(float(v)) for v in values])

    trend = F.array(*[F.lit(t) for t in ("none", "add", "damped")])
    season = F.when(long & nonneg, F.array(F.lit("none"), F.lit("add"), F.lit("mul"))).when(
        long, F.array(F.lit("none"), F.lit("add"))
    ).otherwise(F.array(F.lit("none")))
    df = hist.filter(F.size("train") >= 1).withColumn("nonneg", nonneg)
    df = df.withColumn("trend", F.explode(trend)).withColumn("seasonal", F.explode(season))
    df = df.withColumn("alpha", F.explode(arr(config.alphas)))
    df = df.withColumn("beta", F.explode(F.when(F.col("trend") == "none", arr([0.0])).otherwise(arr(config.betas))))
    df = df.withColumn("gamma", F.explode(F.when(F.col("seasonal") == "none", arr([0.0])).otherwise(arr(config.gammas))))
    return df.withColumn("phi", F.explode(
        F.when(F.col("trend") == "damped", arr(config.phis)).when(F.col("trend") == "add", arr([1.0])).otherwise(arr([0.0]))
    ))


def _folder(season: int, steps: int, trace: bool):
    """Arrow-batched fold: all rows of a batch advance month by month together.

    Rows are (values, trend, seasonal, alpha, beta, gamma, phi). `trace` also returns the fitted
    value and the error sums as they stood before each month.
    """
    def fold(y, trend, seasonal, alpha, beta, gamma, phi):
        import numpy as np
        import pandas as pd

        rows, lens = len(y), np.array([len(v) for v in y])
        width = int(lens.max()) if rows else 0
        v = np.full((rows, width), np.nan)
        for i, values in enumerate(y):
            v[i, : lens[i]] = values
        has_trend, add, mul = (trend != "none").to_numpy(), (seasonal == "add").to_numpy(), (seasonal == "mul").to_numpy()
        al, be, ga, ph = (c.to_numpy(dtype=float) for c in (alpha, beta, gamma, phi))
        first, second = v[:, :season], v[:, season : 2 * season]
        level = np.nanmean(first, axis=1)
        full = lens >= 2 * season
        later = np.where(full, np.nan_to_num(second).sum(axis=1) / season, 0.0)
        slope = np.where(has_trend & full, (later - level) / season, 0.0)
        s = np.zeros((rows, season))
        safe = np.where(np.abs(level) > TINY, level, 1.0)
        padded = np.zeros((rows, season))
        padded[:, : first.shape[1]] = np.nan_to_num(first)
        s = np.where(add[:, None], padded - level[:, None], s)
        s = np.where(mul[:, None], np.maximum(padded / safe[:, None], 0.01), s)
        sse, ssr, logmu = np.zeros(rows), np.zeros(rows), np.zeros(rows)
        low, high = np.full(rows, np.inf), np.full(rows, -np.inf)
        seen = []

        def nonzero(x):
            return np.where(np.abs(x) > TINY, x, TINY)

        with np.errstate(all="ignore"):
            for t in range(width):
                live = t < lens
                at = t % season
                base, s0 = level + ph * slope, s[:, at]
                mu = np.where(mul, base * s0, np.where(add, base + s0, base))
                if trace:
                    seen.append((mu, sse.copy(), ssr.copy(), logmu.copy()))
                e = np.where(live, v[:, t] - mu, 0.0)
                scaled = np.where(mul, e / nonzero(s0), e)
                per_season = np.where(mul, e / nonzero(base), e)
                size = np.maximum(np.abs(mu), TINY)
                low, high = np.where(live, np.minimum(low, mu), low), np.where(live, np.maximum(high, mu), high)
                sse, ssr = sse + e * e, ssr + (e / size) ** 2
                logmu = logmu + np.where(live, np.log(size), 0.0)
                slope = np.where(live, ph * slope + be * scaled, slope)
                level = np.where(live, base + al * scaled, level)
                s[:, at] = np.where(live, s0 + ga * per_season, s0)
            ahead, damp = np.zeros((rows, steps)), np.zeros(rows)
            for h in range(1, steps + 1):
                damp = damp + ph**h
                base, s0 = level + damp * slope, s[np.arange(rows), (lens + h - 1) % season]
                ahead[:, h - 1] = np.where(mul, base * s0, np.where(add, base + s0, base))
        out = {"path": list(ahead), "sse": sse, "ssr": ssr, "logmu": logmu, "low": low, "high": high}
        if trace:
            for name, j in (("f", 0), ("sses", 1), ("ssrs", 2), ("logmus", 3)):
                full_trace = np.stack([step[j] for step in seen], axis=1) if seen else np.zeros((rows, 0))
                out[name] = [full_trace[i, : lens[i]] for i in range(rows)]
        return pd.DataFrame(out)

    kind = "struct<path:array<double>,sse:double,ssr:double,logmu:double,low:double,high:double"
    kind += ",f:array<double>,sses:array<double>,ssrs:array<double>,logmus:array<double>>" if trace else ">"
    import pandas as pd

    names = ("y", "trend", "seasonal", "alpha", "beta", "gamma", "phi")
    fold.__annotations__ = {**{n: pd.Series for n in names}, "return": pd.DataFrame}
    return F.pandas_udf(fold, kind)


def _state(config: cfg.EtsConfig, steps: int, trace: bool = False) -> Column:
    return _folder(config.season, steps, trace)(
        F.col("train.y"), F.col("trend"), F.col("seasonal"), F.col("alpha"), F.col("beta"), F.col("gamma"), F.col("phi")
    )


def _n_params(season: int) -> Column:
    return (
        F.lit(2.0)
        + F.when(F.col("trend") == "add", 2.0).when(F.col("trend") == "damped", 3.0).otherwise(0.0)
        + F.when(F.col("seasonal") == "none", 0.0).otherwise(season + 1.0)
    )


def _criterion(error: Column, n: Column, sse: Column, ssr: Column, logmu: Column, k: Column) -> Column:
    """AICc of the error type; AIC when AICc is undefined."""
    fit = F.when(error == "mul", n * F.log(F.greatest(ssr / n, F.lit(1e-300))) + 2 * logmu).otherwise(
        n * F.log(F.greatest(sse / n, F.lit(1e-300)))
    )
    return fit + 2 * k + F.when(n > k + 1, 2 * k * (k + 1) / (n - k - 1)).otherwise(0.0)


def median_of(a: Column) -> Column:
    s = F.array_sort(a)
    n = F.size(s)
    return F.when(n > 0, (F.element_at(s, F.floor((n + 1) / 2).cast("int")) + F.element_at(s, F.floor(n / 2).cast("int") + 1)) / 2)


def reference_scale(y: Column) -> Column:
    """Median size of the last 12 values; of all values; their maximum; 1: the first that is positive."""
    size = F.transform(y, F.abs)
    n = F.size(size)
    recent = F.slice(size, F.greatest(n - 11, F.lit(1)), F.lit(12))
    tries = [median_of(recent), median_of(size), F.array_max(size)]
    return F.coalesce(*[F.when(t > 0, t) for t in tries], F.lit(1.0))


def is_stable(config: cfg.EtsConfig) -> Column:
    """Finite, non-negative for non-negative data, and within 20 times the usual size; fitted values too."""
    top = F.greatest(F.col("scale") * config.max_scale, F.lit(1.0))
    low = F.when(F.col("nonneg"), -config.eps).otherwise(-top)
    ahead = F.forall("state.path", lambda v: v.isNotNull() & ~F.isnan(v))
    return (
        ahead
        & (F.array_min("state.path") >= low) & (F.array_max("state.path") <= top)
        & (F.col("state.low") >= low) & (F.col("state.high") <= top)
    )


def fit(hist: DataFrame, steps: int, config: cfg.EtsConfig = cfg.EtsConfig()) -> DataFrame:
    """Every candidate with its state, criterion and forecasts; unstable ones are dropped."""
    df = candidates(hist.withColumn("scale", reference_scale(F.col("train.y"))), config).withColumn("state", _state(config, steps))
    errors = F.when(F.col("nonneg"), F.array(F.lit("add"), F.lit("mul"))).otherwise(F.array(F.lit("add")))
    df = df.filter(is_stable(config)).withColumn("error", F.explode(errors)).withColumn("k", _n_params(config.season))
    n = F.size("train").cast("double")
    crit = _criterion(F.col("error"), n, F.col("state.sse"), F.col("state.ssr"), F.col("state.logmu"), F.col("k"))
    return df.withColumn("AICc", crit)


SPEC = ["error", "trend", "seasonal"]
PARAMS = ["alpha", "beta", "gamma", "phi"]


def best_spec(fits: DataFrame) -> DataFrame:
    """Best candidate per series by (AICc, specification, parameters)."""
    order = F.struct("AICc", *SPEC, *PARAMS)
    keep = F.struct(*SPEC, *PARAMS, "AICc", "k", F.col("state.path").alias("path"), F.col("state.sse").alias("sse"))
    return fits.groupBy(*SERIES).agg(F.min_by(keep, order).alias("b")).select(*SERIES, "b.*")


def forecast(fact: DataFrame, horizon: int = 12, config: cfg.EtsConfig = cfg.EtsConfig()) -> DataFrame:
    """Future forecasts of the best stable specification, with a 95 % band of its one-step error."""
    hist = histories(fact)
    best = best_spec(fit(hist, horizon, config)).join(
        hist.select(*SERIES, "n", F.element_at("train", -1)["Month"].alias("last")), SERIES
    )
    sigma = F.sqrt(F.col("sse") / F.col("n"))
    grow = F.sqrt(1 + F.col("i") * F.pow("alpha", F.lit(2)))
    return best.select("*", F.posexplode("path").alias("i", "Forecast")).select(
        *SERIES, F.lit("ETS_baseline").alias("Model"), F.add_months("last", F.col("i") + 1).alias("Month"),
        (F.col("i") + 1).alias("h"), "Forecast",
        (F.col("Forecast") - 1.96 * sigma * grow).alias("lower_ci"), (F.col("Forecast") + 1.96 * sigma * grow).alias("upper_ci"),
        *SPEC, *PARAMS, "AICc",
    )


def backtest(fact: DataFrame, horizon: int = 12, min_train: int = 24, config: cfg.EtsConfig = cfg.EtsConfig()):
    """(holdout rows, one-step rolling-origin MAE at the specification chosen before the holdout)."""
    hist = histories(fact, horizon).filter(F.col("n") > horizon)
    best = cut_lineage(best_spec(fit(hist, horizon, config)))
    test = hist.select(*SERIES, F.posexplode("test").alias("i", "p"))
    holdout = best.select(*SERIES, F.posexplode("path").alias("i", "Forecast")).join(test, [*SERIES, "i"]).select(
        *SERIES, F.lit("ETS_baseline").alias("Model"), F.col("p.Month").alias("Date"), F.col("p.y").alias("Actual"), "Forecast"
    )
    whole = candidates(histories(fact), config).join(best.select(*SERIES, "error", "trend", "seasonal"), [*SERIES, "trend", "seasonal"])
    folded = whole.withColumn("state", _state(config, 1, trace=True)).withColumn("k", _n_params(config.season))
    trace = F.arrays_zip("train.y", "state.f", "state.sses", "state.ssrs", "state.logmus")
    steps = folded.select(*SERIES, *PARAMS, "error", "k", F.posexplode(trace).alias("i", "o")).filter(F.col("i") >= min_train)
    crit = _criterion(F.col("error"), F.col("i").cast("double"), F.col("o.sses"), F.col("o.ssrs"), F.col("o.logmus"), F.col("k"))
    one = steps.groupBy(*SERIES, "i").agg(
        F.min_by(F.struct(F.col("o.f").alias("f"), F.col("o.y").alias("y")), F.struct(crit, *PARAMS)).alias("r")
    )
    rocv = one.groupBy(*SERIES).agg(
        F.avg(F.abs(F.col("r.y") - F.col("r.f"))).alias("ROCV_MAE"), F.count(F.lit(1)).alias("n_origins")
    ).withColumn("Model", F.lit("ETS_baseline"))
    return holdout, rocv
