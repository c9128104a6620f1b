"""Seasonal ARIMA with d = D = 1 by the Hannan-Rissanen two-stage regression.

Stage one regresses the differenced series on its own lags and keeps one-step innovations; stage
two regresses it on lags of itself and of the innovations. Both stages use running sums, so the fit
of every order at every cut comes from one pass and never sees a later month. The lag products of
the multiplicative model are free coefficients. A series too short to solve gives nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.lineage import cut_lineage
from seriesloom.functions.numeric import finite
from seriesloom.operators.forecasters.linear import dot, normal_p_value, solver, with_prefix_gram
from seriesloom.schema import SERIES

AR_LONG = (1, 2, 3, 12, 13)
LAGS = (1, 2, 12, 13, 14)
DEPTH = 14
RIDGE = 0.05
SEASON = 12


def _rows() -> Window:
    return Window.partitionBy(*SERIES).orderBy("Month")


def seasonal_difference(c: str, w) -> Column:
    return F.col(c) - F.lag(c, 1).over(w) - F.lag(c, SEASON).over(w) + F.lag(c, SEASON + 1).over(w)


def extended(fact: DataFrame, horizon: int, x: str | None = None) -> DataFrame:
    """Known rows of each series plus `horizon` future rows; a regressor is held at its last value."""
    known = fact.filter("Actuals is not null").select(
        *SERIES, "Month", F.col("Actuals").cast("double").alias("y"),
        (F.col(x).cast("double") if x else F.lit(0.0)).alias("x"),
    )
    if x:
        known = known.filter("x is not null")
    last = known.groupBy(*SERIES).agg(F.max("Month").alias("last"), F.max_by("x", "Month").alias("x"))
    future = last.select(*SERIES, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"), "last", "x").select(
        *SERIES, F.add_months("last", F.col("h")).alias("Month"), F.lit(None).cast("double").alias("y"), "x"
    )
    rows = known.unionByName(future)
    w = Window.partitionBy(*SERIES)
    return rows.withColumn("row_no", F.row_number().over(_rows())).withColumn("n_rows", F.count("y").over(w))


def design(fact: DataFrame, horizon: int = 12, x: str | None = None) -> DataFrame:
    """One row per series and month with the regressors of that month, the running sums of all
    earlier months and the recent history a forecast from there needs."""
    w = _rows()
    df = extended(fact, horizon, x).withColumn("w", seasonal_difference("y", w)).withColumn(
        "dx", F.coalesce(seasonal_difference("x", w), F.lit(0.0))
    )
    df = df.withColumns({f"a{k}": F.coalesce(F.lag("w", k).over(w), F.lit(0.0)) for k in AR_LONG})
    ar = [f"a{k}" for k in AR_LONG]
    df = with_prefix_gram(df, ar, "w", "ar_gram")
    fit = solver(len(ar), 1e-3)(F.col("ar_gram"), F.array(*[F.lit(1.0)] * len(ar)))
    df = df.withColumn("ar_fit", fit).withColumn(
        "e", F.col("w") - F.coalesce(dot(F.array(*ar), F.col("ar_fit.beta")), F.lit(0.0))
    ).drop("ar_gram", "ar_fit", *ar)
    cols = {f"w{k}": F.coalesce(F.lag("w", k).over(w), F.lit(0.0)) for k in LAGS}
    cols |= {f"e{k}": F.coalesce(F.lag("e", k).over(w), F.lit(0.0)) for k in LAGS}
    df = df.withColumns(cols)
    xs = [f"w{k}" for k in LAGS] + [f"e{k}" for k in LAGS] + ["dx"]
    df = with_prefix_gram(df, xs, "w", "gram")
    recent = w.rowsBetween(-DEPTH, -1)
    return df.select(
        *SERIES, "Month", "y", "w", "row_no", "n_rows", "gram",
        F.array(*xs).alias("design"),
        F.array(*[F.lag("y", k).over(w) for k in (1, SEASON, SEASON + 1)]).alias("y_back"),
        F.reverse(F.collect_list(F.coalesce("w", F.lit(0.0))).over(recent)).alias("w_hist"),
        F.reverse(F.collect_list(F.coalesce("e", F.lit(0.0))).over(recent)).alias("e_hist"),
        F.reverse(F.collect_list("y").over(recent)).alias("y_hist"),
        F.collect_list("dx").over(w.rowsBetween(0, horizon - 1)).alias("dx_next"),
    )


def order_mask(p: Column, q: Column, sp: Column, sq: Column, with_x: bool) -> Column:
    """Which columns of the maximal design an order uses."""
    def half(a, b):
        return [a >= 1, a >= 2, b >= 1, (a >= 1) & (b >= 1), (a >= 2) & (b >= 1)]

    flags = [f.cast("double") for f in half(p, sp) + half(q, sq)]
    return F.array(*flags, F.lit(1.0 if with_x else 0.0))


def fit_orders(rows: DataFrame, with_x: bool = False) -> DataFrame:
    """Adds `fit` to rows that carry gram, p, q, sp, sq."""
    mask = order_mask(F.col("p"), F.col("q"), F.col("sp"), F.col("sq"), with_x)
    return rows.withColumn("fit", solver(2 * len(LAGS) + 1, RIDGE)(F.col("gram"), mask))


def _pad(history: Column, n: int) -> Column:
    return F.slice(F.concat(history, F.array_repeat(F.lit(0.0), n)), 1, n)


def _run(beta: Column, w0: Column, e0: Column, y0: Column, dx: Column, steps: int) -> Column:
    """Recursive forecast path: each step feeds the next; future innovations are 0."""
    at = [k - 1 for k in LAGS]
    start = F.struct(w0.alias("w"), e0.alias("e"), y0.alias("y"), F.array().cast("array<double>").alias("out"))

    def step(s, h):
        wv = F.get(dx, h - 1) * beta[2 * len(LAGS)]
        for i, k in enumerate(at):
            wv = wv + beta[i] * s["w"][k] + beta[len(LAGS) + i] * s["e"][k]
        return F.struct(wv.alias("v"), s.alias("s"))

    def advance(s, h):
        t = step(s, h)
        return F.transform(F.array(t), lambda r: _next(r["s"], r["v"]))[0]

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, advance, lambda s: s["out"])


def _next(s: Column, wv: Column) -> Column:
    yv = wv + s["y"][0] + s["y"][SEASON - 1] - s["y"][SEASON]
    return F.struct(
        F.concat(F.array(wv), F.slice(s["w"], 1, DEPTH - 1)).alias("w"),
        F.concat(F.array(F.lit(0.0)), F.slice(s["e"], 1, DEPTH - 1)).alias("e"),
        F.concat(F.array(yv), F.slice(s["y"], 1, SEASON)).alias("y"),
        F.concat(s["out"], F.array(yv)).alias("out"),
    )


def forecast_path(steps: int) -> Column:
    """Forecasts 1..steps from the row's own cut; null when it could not be fitted."""
    path = _run(F.col("fit.beta"), _pad(F.col("w_hist"), DEPTH), _pad(F.col("e_hist"), DEPTH),
                F.slice(F.col("y_hist"), 1, SEASON + 1), F.col("dx_next"), steps)
    return F.when(F.col("fit.beta").isNotNull() & (F.size("y_hist") > SEASON), path)


def psi_path(steps: int) -> Column:
    """Response of the level to one unit innovation, psi_0 .. psi_(steps-1)."""
    unit = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), DEPTH - 1))
    zero = F.array_repeat(F.lit(0.0), steps)
    after = _run(F.col("fit.beta"), unit, unit, F.slice(unit, 1, SEASON + 1), zero, steps)
    return F.concat(F.array(F.lit(1.0)), F.slice(after, 1, steps - 1))


def criteria(fit: str = "fit") -> list[Column]:
    n, sse, k = F.col(f"{fit}.n"), F.col(f"{fit}.sse"), F.col(f"{fit}.used") + 1
    base = F.when((sse > 0) & (n > 0), n * F.log(sse / n))
    return [(base + 2 * k).alias("AIC"), (base + k * F.log(n)).alias("BIC")]


# ---- jobs ----------------------------------------------------------------
def forecast(fact: DataFrame, orders: DataFrame, horizon: int = 12, x: str | None = None, model: str = "SARIMA_baseline") -> DataFrame:
    """Future forecasts with 95 % bounds, information criteria and the regressor coefficient.

    `orders`: series, p, q, sp, sq.
    """
    at_end = design(fact, horizon, x).filter(F.col("row_no") == F.col("n_rows") + 1)
    rows = fit_orders(at_end.join(orders, SERIES), x is not None)
    sigma2 = F.col("fit.sse") / (F.col("fit.n") - F.col("fit.used"))
    rows = rows.withColumn("path", forecast_path(horizon)).withColumn("psi", psi_path(horizon)).withColumn("sigma2", sigma2)
    j = 2 * len(LAGS)
    coef, se = F.col("fit.beta")[j], F.col("fit.se")[j]
    base = rows.select(
        *SERIES, F.lit(model).alias("Model"), F.col("Month").alias("first_month"), "path", "psi", "sigma2", "p", "q", "sp", "sq",
        *criteria(), (coef if x else F.lit(None).cast("double")).alias("Regressor_Coef"),
        (normal_p_value(F.try_divide(coef, se)) if x else F.lit(None).cast("double")).alias("Regressor_pvalue"),
    ).filter("path is not null")
    steps = base.select("*", F.posexplode("path").alias("i", "Forecast"))
    spread = 1.96 * F.sqrt(F.col("sigma2") * F.aggregate(
        F.slice("psi", F.lit(1), F.col("i") + 1), F.lit(0.0), lambda s, v: s + v * v))
    return steps.select(
        *SERIES, "Model", F.add_months("first_month", F.col("i")).alias("Month"), (F.col("i") + 1).alias("h"), "Forecast",
        (F.col("Forecast") - spread).alias("lower_ci"), (F.col("Forecast") + spread).alias("upper_ci"),
        "p", "q", "sp", "sq", "AIC", "BIC", "Regressor_Coef", "Regressor_pvalue",
    )


def _test_rows(rows: DataFrame, fact_rows: DataFrame, steps: int) -> DataFrame:
    """Forecast paths laid against the rows that follow their cut. `rows`: ..., row_no, path."""
    path = rows.select("*", F.posexplode("path").alias("i", "Forecast")).withColumn(
        "test_row", F.col("row_no") + F.col("i")
    )
    actual = fact_rows.select(*SERIES, F.col("row_no").alias("test_row"), F.col("Month").alias("Date"), F.col("y").alias("Actual"))
    return path.drop("path", "Month", "y").join(actual, [*SERIES, "test_row"]).filter("Actual is not null")


def backtest(fact: DataFrame, orders: DataFrame, horizon: int = 12, min_train: int = 24, x: str | None = None,
             model: str = "SARIMA_baseline"):
    """(holdout rows, one-step rolling-origin MAE) for one order per series."""
    # The shortest training span is a rule of the rolling origins; the holdout takes any series that can be fitted.
    used = (F.col("row_no") > min_train) | (F.col("row_no") > F.col("n_rows") - horizon)
    d = design(fact, horizon, x).filter(used & (F.col("row_no") <= F.col("n_rows")))
    fitted = cut_lineage(fit_orders(d.join(orders.select(*SERIES, "p", "q", "sp", "sq"), SERIES), x is not None))
    cut = fitted.filter(F.col("row_no") == F.col("n_rows") - horizon + 1).withColumn("path", forecast_path(horizon))
    holdout = _test_rows(cut.filter("path is not null").select(*SERIES, "row_no", "path"), fitted, horizon)
    holdout = holdout.select(*SERIES, F.lit(model).alias("Model"), "Date", "Actual", "Forecast")
    back = F.col("y_back")
    one = dot(F.col("design"), F.col("fit.beta")) + back[0] + back[1] - back[2]
    rocv = fitted.filter(F.col("row_no") > min_train).withColumn("one", one).groupBy(*SERIES).agg(
        F.avg(F.abs(F.col("y") - F.col("one"))).alias("ROCV_MAE"), F.count("one").alias("n_origins")
    ).withColumn("Model", F.lit(model))
    return holdout, rocv


def search_orders(fact: DataFrame, horizon: int = 12, top: int = 5, min_rows: int = 30, min_train_holdout: int = 24) -> DataFrame:
    """Best order per series: 36 orders scored on three 6-step cuts and in sample, the best five
    on a 12-step holdout. One row per series, with a status for series that are too short."""
    from seriesloom.operators.backtest import order_grid, six_by_three

    d = cut_lineage(design(fact, horizon))
    n = F.col("n_rows")
    series = d.filter("row_no = 1").select(*SERIES, n.cast("int").alias("n_rows"))
    usable = series.filter(n >= min_rows)
    grid = order_grid(usable).drop("d", "sd", "s")
    rows = d.select(*SERIES, "Month", "y", "row_no")

    cuts = usable.select(*SERIES, F.explode(six_by_three(n)).alias("c")).select(*SERIES, (F.col("c.train_end") + 1).alias("row_no"))
    full = usable.select(*SERIES, (n + 1).alias("row_no"))
    at = d.drop("n_rows").join(cuts.unionByName(full), [*SERIES, "row_no"])
    fits = cut_lineage(fit_orders(at.join(grid, SERIES)).join(usable, SERIES))
    key = [*SERIES, "p", "q", "sp", "sq"]

    cv = fits.filter(F.col("row_no") <= n).withColumn("path", forecast_path(6)).filter("path is not null")
    cv = _test_rows(cv.select(*key, "row_no", "path"), rows, 6).groupBy(*key, "row_no").agg(
        F.avg(F.abs(F.col("Actual") - F.col("Forecast"))).alias("m")
    ).groupBy(*key).agg(F.avg("m").alias("rocv_MAE"))

    end = fits.filter(F.col("row_no") == n + 1).select(*key, "fit", *criteria())
    in_sample = (
        d.filter("w is not null").select(*SERIES, "w", "design").join(end.select(*key, F.col("fit.beta").alias("beta")), SERIES)
        .groupBy(*key).agg(F.avg(F.abs(F.col("w") - dot(F.col("design"), F.col("beta")))).alias("in_sample_MAE"))
    )
    scored = end.filter("fit.beta is not null").select(*key, "AIC", "BIC").join(in_sample, key).join(cv, key, "left")
    rank = Window.partitionBy(*SERIES).orderBy(F.col("rocv_MAE").asc_nulls_last(), "in_sample_MAE", "p", "q", "sp", "sq")
    best = scored.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top)

    hold_cut = d.filter((F.col("n_rows") > horizon + min_train_holdout) & (F.col("row_no") == F.col("n_rows") - horizon + 1))
    hold = fit_orders(hold_cut.drop("n_rows").join(best.select(*key), SERIES)).withColumn("path", forecast_path(horizon))
    hold = _test_rows(hold.filter("path is not null").select(*key, "row_no", "path"), rows, horizon).groupBy(*key).agg(
        F.avg(F.abs(F.col("Actual") - F.col("Forecast"))).alias("holdout_MAE")
    )
    pick = F.struct(F.coalesce(finite("holdout_MAE"), F.lit(float("inf"))).alias("o"), "rank")
    one = best.join(hold, key, "left").groupBy(*SERIES).agg(
        F.min_by(F.struct("p", "q", "sp", "sq", "rocv_MAE", "in_sample_MAE", "holdout_MAE", "AIC", "BIC"), pick).alias("b")
    )
    status = F.when(F.col("n_rows") < min_rows, "SKIPPED_TOO_SHORT").when(F.col("b").isNull(), "NO_CONVERGED_MODEL").otherwise("OK")
    return series.join(one, SERIES, "left").select(
        *SERIES, status.alias("Status"), "b.p", "b.q", "b.sp", "b.sq",
        F.when(F.col("b").isNotNull(), F.format_string("(%d, 1, %d)", "b.p", "b.q")).alias("Chosen_Order"),
        F.when(F.col("b").isNotNull(), F.format_string("(%d, 1, %d, 12)", "b.sp", "b.sq")).alias("Chosen_Seasonal_Order"),
        "b.rocv_MAE", "b.in_sample_MAE", "b.holdout_MAE", "b.AIC", "b.BIC",
    )
