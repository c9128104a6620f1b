"""Model selection rules. Every rule is columns over the models of one series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.labels import drop_lag_zero, regressor_of
from seriesloom.functions.numeric import INF, finite, improvement
from seriesloom.operators import metrics as M
from seriesloom.schema import MODEL_KEY, SERIES, any_of, of_series

R_BASELINE = "Baseline wins: best MAE; no challenger improved DA by >=10pp within MAE+5%."
R_TENTATIVE = "Selected best MAE among accuracy-qualified models passing ROCV sanity."
R_NONE = "No valid model metrics available."


TIE_DIGITS = 9


def tie(c: str) -> Column:
    """Ordering value: sums of doubles depend on row order in their last bits, so equal to nine
    decimals is a tie. Missing sorts last."""
    return F.coalesce(F.round(c, TIE_DIGITS), F.lit(INF))


def tie_key(mae: str = "Test_MAE", error: str = "Test_RMSE") -> Column:
    """Ordering of models: MAE, RMSE, then name."""
    return F.struct(
        tie(mae).alias("k_mae"),
        tie(error).alias("k_rmse"),
        F.col("Model").alias("k_model"),
    )


def pct1(c: Column) -> Column:
    return F.format_string("%.1f", F.bround(c, 1))


def enrich(metrics: DataFrame, holdout: DataFrame, config=cfg.SelectionConfig()) -> DataFrame:
    """Metrics with directional accuracy and recency-weighted errors joined on the model key.

    The weighted MAE and RMSE take the place of the raw ones, which stay as Raw_*.
    """
    return (
        metrics.select(
            *MODEL_KEY,
            finite("Test_MAE").alias("Raw_MAE"),
            finite("Test_RMSE").alias("Raw_RMSE"),
            finite("ROCV_MAE").alias("ROCV_MAE"),
        )
        .join(M.directional_accuracy(holdout, config.da_min_periods), MODEL_KEY, "left")
        .join(M.weighted_metrics(holdout), MODEL_KEY, "left")
        .withColumnsRenamed({"Weighted_MAE": "Test_MAE", "Weighted_RMSE": "Test_RMSE"})
    )


def score_models(enriched: DataFrame, config: cfg.SelectionConfig = cfg.SelectionConfig()) -> DataFrame:
    """Per-model flags and per-series decision columns. One shuffle by series serves all windows."""
    c, w = config, of_series()
    valid = F.col("Test_MAE").isNotNull()
    carried = ["Model", "Test_MAE", "Test_RMSE", "ROCV_MAE", "DA", "abs_bias", "abs_bias_pct"]
    df = enriched.withColumn(
        "b",
        F.min_by(F.struct(*carried), F.when(valid, tie_key())).over(w),
    )
    is_base = F.col("Model") == F.col("b.Model")
    rocv_on = F.col("b.ROCV_MAE") > 0
    mae, rmse_, rocv = F.col("Test_MAE"), F.col("Test_RMSE"), F.col("ROCV_MAE")

    def yes(cond):
        return F.coalesce(cond, F.lit(False))

    df = (
        df.withColumn("is_baseline", yes(is_base))
        .withColumn("mae_cutoff", F.col("b.Test_MAE") * (1 + c.mae_tolerance))
        .withColumn("rmse_cutoff", F.col("b.Test_RMSE") * (1 + c.rmse_tolerance))
        .withColumn("rocv_hard_max", F.when(rocv_on, F.col("b.ROCV_MAE") * c.rocv_hard_multiplier))
        .withColumn(
            "passes_accuracy",
            F.col("is_baseline") | yes((mae <= F.col("mae_cutoff")) & (rmse_ <= F.col("rmse_cutoff"))),
        )
        .withColumn(
            "passes_rocv_sanity",
            F.col("is_baseline")
            | (valid & (F.col("rocv_hard_max").isNull() | yes(rocv <= F.col("rocv_hard_max")))),
        )
        .withColumn("candidate", F.col("passes_accuracy") & F.col("passes_rocv_sanity"))
    )
    challenger = F.col("candidate") & ~F.col("is_baseline")
    bias_on = config.bias_improvement_ratio is not None
    base_bias = F.col("b.abs_bias_pct")
    bias_ok = yes((base_bias > 0) & (F.col("abs_bias_pct") <= base_bias * c.bias_improvement_ratio)) if bias_on else F.lit(False)
    if bias_on and c.bias_improvement_abs_pp is not None:
        bias_ok = bias_ok & yes(base_bias - F.col("abs_bias_pct") >= c.bias_improvement_abs_pp)
    rmse_close = (
        F.lit(True)
        if c.bias_close_rmse_tol is None
        else yes(rmse_ <= F.col("b.Test_RMSE") * (1 + c.bias_close_rmse_tol))
    )
    df = (
        df.withColumn(
            "qualifies_da",
            challenger & yes((F.col("DA") >= F.col("b.DA") + c.da_improvement)
                             & (mae <= F.col("b.Test_MAE") * (1 + c.da_close_mae_tol))),
        )
        .withColumn("qualifies_mae_close", challenger & yes(mae <= F.col("b.Test_MAE") * (1 + c.bias_close_mae_tol)))
        .withColumn("qualifies_rmse_close", challenger & rmse_close)
        .withColumn("qualifies_bias", challenger & bias_ok)
    )
    qualifies = F.col("qualifies_mae_close") & F.col("qualifies_rmse_close") & F.col("qualifies_bias")
    picked = F.struct("Model", "Test_MAE", "Test_RMSE", "ROCV_MAE", "DA", "bias", "abs_bias", "bias_pct", "abs_bias_pct")
    df = df.withColumns(
        {
            "tentative": F.min_by(picked, F.when(F.col("candidate"), tie_key())).over(w),
            "da_pick": F.min_by(picked, F.when(F.col("qualifies_da"), F.struct(-F.round("DA", TIE_DIGITS), tie_key()))).over(w),
            "bias_pick": F.min_by(picked, F.when(qualifies, F.struct(tie("abs_bias_pct"), tie_key()))).over(w),
            "had_challengers": F.max(challenger).over(w),
            "any_mae_close": F.max(F.col("qualifies_mae_close")).over(w),
            "any_bias_ok": F.max(
                challenger & (yes((base_bias > 0) & (F.col("abs_bias_pct") <= base_bias * c.bias_improvement_ratio)) if bias_on else F.lit(False))
            ).over(w),
        }
    )
    da_gain = (F.col("da_pick.DA") - F.col("b.DA")) * 100
    bias_cut = (1 - F.col("bias_pick.abs_bias_pct") / base_bias) * 100
    before_bias = (
        F.when(
            F.col("da_pick").isNotNull(),
            F.concat(
                F.lit("Override: challenger improved directional accuracy by "), pct1(da_gain),
                F.lit("pp (DA_challenger vs DA_baseline) while within MAE+5% and passing accuracy+ROCV sanity."),
            ),
        )
        .when(F.col("tentative.Model") == F.col("b.Model"), R_BASELINE)
        .otherwise(R_TENTATIVE)
    )
    bias_text = F.concat(
        F.lit("Bias override: |bias| improved by "), pct1(bias_cut),
        F.lit("% vs baseline while MAE within +10% and passing accuracy+ROCV sanity"),
        F.lit(f" (>= {c.bias_improvement_abs_pp:.2%} abs bias pct improvement)." if c.bias_improvement_abs_pp is not None else "."),
    )
    suffix = F.lit("")
    if bias_on:
        suffix = (
            F.when(F.col("had_challengers") & ~F.col("any_mae_close"),
                   " Bias override not applied: no challenger within MAE +10%.")
            .when(F.col("had_challengers") & ~F.col("any_bias_ok"),
                  " Bias override not applied: no challenger met bias-improvement threshold.")
            .otherwise("")
        )
    return (
        df.withColumn("rec", F.coalesce("bias_pick", "da_pick", "tentative"))
        .withColumn("used_bias_override", F.col("bias_pick").isNotNull())
        .withColumn(
            "Reason",
            F.when(F.col("b").isNull(), R_NONE)
            .when(F.col("used_bias_override"), bias_text)
            .otherwise(F.concat(before_bias, suffix)),
        )
        .withColumn("Recommended", yes(F.col("Model") == F.col("rec.Model")))
    )


def select_model(metrics: DataFrame, holdout: DataFrame, config=cfg.SelectionConfig()) -> DataFrame:
    """Recommended model per series with its reason and the numbers behind it."""
    return summarise(score_models(enrich(metrics, holdout, config), config))


def summarise(scored: DataFrame) -> DataFrame:
    one = scored.groupBy(*SERIES).agg(
        *[F.first(c).alias(c) for c in ("b", "rec", "Reason", "used_bias_override", "mae_cutoff", "rmse_cutoff", "rocv_hard_max")]
    )
    return one.select(
        *SERIES,
        F.col("rec.Model").alias("Recommended_Model"),
        "Reason",
        F.col("b.Model").alias("baseline_model"),
        F.col("b.Test_MAE").alias("baseline_mae"),
        F.col("b.Test_RMSE").alias("baseline_rmse"),
        F.col("b.ROCV_MAE").alias("baseline_rocv"),
        F.col("b.DA").alias("baseline_DA"),
        F.col("b.abs_bias").alias("baseline_abs_bias"),
        F.col("b.abs_bias_pct").alias("baseline_abs_bias_pct"),
        "mae_cutoff",
        "rmse_cutoff",
        "rocv_hard_max",
        F.col("rec.Test_MAE").alias("recommended_mae"),
        F.col("rec.Test_RMSE").alias("recommended_rmse"),
        F.col("rec.DA").alias("recommended_DA"),
        F.col("rec.bias").alias("recommended_bias"),
        F.col("rec.abs_bias").alias("recommended_abs_bias"),
        F.col("rec.bias_pct").alias("recommended_bias_pct"),
        F.col("rec.abs_bias_pct").alias("recommended_abs_bias_pct"),
        "used_bias_override",
        (
            (F.col("rec.Model") != F.col("b.Model")) & F.col("Reason").startswith("Override:")
        ).alias("recommended_by_override"),
    )


def select_legacy(metrics: DataFrame, config: cfg.SelectionConfig = cfg.SelectionConfig()) -> DataFrame:
    """Earlier rule: accuracy and ROCV gates, then the preferred ROCV band, then a revert test."""
    c, w = config, of_series()
    df = metrics.select(*MODEL_KEY, *[finite(x).alias(x) for x in ("Test_MAE", "Test_RMSE", "ROCV_MAE")])
    picked = F.struct("Model", "Test_MAE", "Test_RMSE", "ROCV_MAE")
    valid = F.col("Test_MAE").isNotNull()
    df = df.withColumn("b", F.min_by(picked, F.when(valid, tie_key())).over(w))
    is_base = F.col("Model") == F.col("b.Model")
    base = F.when(F.col("b.ROCV_MAE") > 0, F.col("b.ROCV_MAE"))
    ok = is_base | (
        (F.col("Test_MAE") <= F.col("b.Test_MAE") * (1 + c.mae_tolerance))
        & (F.col("Test_RMSE") <= F.col("b.Test_RMSE") * (1 + c.rmse_tolerance))
        & (F.col("ROCV_MAE") <= base * c.rocv_hard_multiplier)
    )
    band = F.col("ROCV_MAE").between(base * c.rocv_preferred_lower, base * c.rocv_preferred_upper)
    one = df.groupBy(*SERIES).agg(
        F.first("b").alias("b"),
        F.min_by(picked, F.when(ok & band, tie_key())).alias("preferred"),
        F.min_by(picked, F.when(ok, tie_key())).alias("accurate"),
    )
    pick = F.coalesce("preferred", "accurate")
    off = F.col("pick.Model") != F.col("b.Model")
    smooth = off & (F.col("pick.ROCV_MAE") < F.col("b.ROCV_MAE") * c.rocv_too_smooth)
    noisy = off & (F.col("pick.ROCV_MAE") > F.col("b.ROCV_MAE") * c.rocv_too_noisy)
    no_rocv = F.col("b.ROCV_MAE").isNull() | (F.col("b.ROCV_MAE") <= 0)
    one = one.withColumn("pick", pick)
    reason = (
        F.when(F.col("b").isNull(), "No model metrics available.")
        .when(no_rocv, "Baseline ROCV unavailable or zero; selected lowest-MAE baseline.")
        .when(smooth, "Selected model ROCV was too smooth relative to baseline; reverted to lowest-MAE baseline.")
        .when(noisy, "Selected model ROCV was too noisy relative to baseline; reverted to lowest-MAE baseline.")
        .when(F.col("preferred").isNotNull(), "Selected among accurate models with variability aligned to the baseline forecast.")
        .otherwise("Selected most accurate model among those passing variability sanity checks.")
    )
    reverted = F.coalesce(no_rocv | smooth | noisy, F.lit(False))
    return one.select(
        *SERIES,
        F.when(reverted, F.col("b.Model")).otherwise(F.col("pick.Model")).alias("Recommended_Model"),
        reason.alias("Reason"),
        F.col("b.Model").alias("baseline_model"),
    )


def select_archived(metrics: DataFrame, config: cfg.SelectionConfig = cfg.SelectionConfig()) -> DataFrame:
    """Archived rule: a challenger needs 2 % lower MAE and ROCV within 5 % of the better of
    SARIMA and ETS; the lowest weighted MAE among those accepted wins, else the baseline.

    Optional columns Test_WMAE, Requires_Future_Exog and Forecast_valid are used when present.
    """
    c = config
    has = set(metrics.columns)
    df = metrics.select(
        *MODEL_KEY,
        *[finite(x).alias(x) for x in ("Test_MAE", "Test_RMSE", "ROCV_MAE")],
        (F.coalesce(finite("Test_WMAE"), finite("Test_MAE")) if "Test_WMAE" in has else finite("Test_MAE")).alias("wmae"),
        (F.coalesce("Requires_Future_Exog", F.lit(False)) if "Requires_Future_Exog" in has else F.lit(False)).alias("needs"),
        (F.coalesce("Forecast_valid", F.lit(True)) if "Forecast_valid" in has else F.lit(True)).alias("sound"),
    )
    is_base = F.col("Model").isin("SARIMA_baseline", "ETS_baseline")
    key, picked = tie_key("wmae"), F.struct("Model", "Test_MAE", "ROCV_MAE", "wmae")
    w = of_series()
    df = df.withColumn("b", F.min_by(picked, F.when(is_base, key)).over(w))
    rocv_ok = F.col("b.ROCV_MAE").isNull() | (F.col("ROCV_MAE") <= F.col("b.ROCV_MAE") * (1 + c.archived_delta))
    accepted = (
        ~is_base & ~F.col("needs") & F.col("sound")
        & (F.col("Test_MAE") <= F.col("b.Test_MAE") * (1 - c.archived_epsilon))
        & F.coalesce(rocv_ok, F.lit(False))
    )
    one = df.groupBy(*SERIES).agg(
        F.first("b").alias("b"),
        F.min_by("Model", F.when(accepted, key)).alias("accepted"),
        F.min_by("Model", F.when(F.col("wmae").isNotNull(), key)).alias("lowest"),
    )
    return one.select(
        *SERIES,
        F.when(F.col("b.Test_MAE").isNull(), F.col("lowest"))
        .otherwise(F.coalesce("accepted", "b.Model")).alias("Chosen_Model"),
        F.col("b.Model").alias("baseline_model"),
        (F.col("b.Test_MAE").isNotNull() & F.col("accepted").isNotNull()).alias("Accepted_by_rules"),
    )


def accept_groups(metrics: DataFrame, config: cfg.SelectionConfig = cfg.SelectionConfig()) -> DataFrame:
    """Absolute and relative acceptance against SARIMA (ETS where it is absent)."""
    c, w = config, of_series()
    df = metrics.select(*MODEL_KEY, *[finite(x).alias(x) for x in ("Test_MAE", "Test_RMSE", "ROCV_MAE")])
    order = F.when(F.col("Model") == "SARIMA_baseline", 0).when(F.col("Model") == "ETS_baseline", 1)
    df = df.withColumn("b", F.min_by(F.struct("Model", "Test_MAE", "ROCV_MAE"), order).over(w))
    mae, rocv, b_mae, b_rocv = F.col("Test_MAE"), F.col("ROCV_MAE"), F.col("b.Test_MAE"), F.col("b.ROCV_MAE")
    gain = (b_mae - mae) >= F.greatest(F.lit(c.accept_abs), b_mae * c.accept_rel)
    rocv_ok = b_rocv.isNull() | F.coalesce(rocv <= b_rocv * (1 + c.accept_rocv), F.lit(False))
    steady = rocv.isNull() | (F.abs(rocv - mae) <= c.accept_rocv * F.greatest(mae, F.lit(1e-9)))
    accepted = (F.col("Model") != F.col("b.Model")) & gain & rocv_ok & steady
    one = df.groupBy(*SERIES).agg(
        F.first("b").alias("b"), F.min_by("Model", F.when(accepted, F.struct(tie("Test_MAE"), "Model"))).alias("best"),
        F.count_if(accepted).alias("n_accepted"),
    )
    return one.select(*SERIES, F.coalesce("best", "b.Model").alias("Recommended_Model"), "n_accepted")


# ---- comparison ----------------------------------------------------------
def compare_selections(old: DataFrame, new: DataFrame, holdout: DataFrame) -> DataFrame:
    """Old and new winner per series with their metrics and deltas."""
    lookup = M.weighted_metrics(holdout).select(
        *MODEL_KEY, "Weighted_MAE", "Weighted_RMSE", "bias", "abs_bias", "abs_bias_pct"
    )

    def side(prefix):
        names = {"Model": f"{prefix}_model", "Weighted_MAE": f"{prefix}_mae", "Weighted_RMSE": f"{prefix}_rmse",
                 "bias": f"{prefix}_bias", "abs_bias": f"{prefix}_abs_bias", "abs_bias_pct": f"{prefix}_abs_bias_pct"}
        return lookup.withColumnsRenamed(names)

    both = old.select(*SERIES, F.col("Recommended_Model").alias("old_model")).join(
        new.select(*SERIES, F.col("Recommended_Model").alias("new_model")), SERIES, "full"
    )
    out = both.join(side("old"), [*SERIES, "old_model"], "left").join(side("new"), [*SERIES, "new_model"], "left")
    return out.select(
        *SERIES, "old_model", "new_model", "old_mae", "new_mae", "old_rmse", "new_rmse", "old_bias", "new_bias",
        "old_abs_bias", "new_abs_bias", "old_abs_bias_pct", "new_abs_bias_pct",
        (F.col("new_mae") - F.col("old_mae")).alias("mae_delta"),
        (F.col("new_rmse") - F.col("old_rmse")).alias("rmse_delta"),
        (F.col("new_abs_bias") - F.col("old_abs_bias")).alias("abs_bias_delta"),
        (F.col("new_abs_bias_pct") - F.col("old_abs_bias_pct")).alias("abs_bias_pct_delta"),
        (~F.col("old_model").eqNullSafe(F.col("new_model"))).alias("winner_changed"),
    )


def top_flips(comparison: DataFrame, column: str, ascending: bool, n: int = 20) -> DataFrame:
    order = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    return comparison.filter("winner_changed").orderBy(order, *SERIES).limit(n)


def comparison_stats(comparison: DataFrame) -> DataFrame:
    counts = comparison.agg(
        F.count(F.lit(1)).alias("total_skus"),
        F.count_if("winner_changed").alias("winner_changed_count"),
        F.avg(F.col("winner_changed").cast("double")).alias("winner_changed_pct"),
        F.avg("mae_delta").alias("mae_delta_mean"),
        F.avg("abs_bias_delta").alias("abs_bias_delta_mean"),
    )
    return counts.select(
        "*",
        M.exact_median(comparison, "mae_delta").scalar().alias("mae_delta_median"),
        M.exact_median(comparison, "abs_bias_delta").scalar().alias("abs_bias_delta_median"),
    )


# ---- reports -------------------------------------------------------------
def distinct_metrics(metrics: DataFrame, order: str) -> DataFrame:
    """First row per model key in the order of `order`."""
    others = [c for c in metrics.columns if c not in MODEL_KEY]
    return metrics.groupBy(*MODEL_KEY).agg(F.min_by(F.struct(*others), order).alias("r")).select(*MODEL_KEY, "r.*")


def rank_models(metrics: DataFrame) -> DataFrame:
    """Rank by MAE inside the series; models without a MAE stay unranked."""
    from pyspark.sql import Window

    w = Window.partitionBy(*SERIES, F.col("Test_MAE").isNull()).orderBy(tie("Test_MAE"), "Model")
    return metrics.withColumn("Rank", F.when(F.col("Test_MAE").isNotNull(), F.row_number().over(w)))


def best_regressor(metrics: DataFrame) -> DataFrame:
    """Best SARIMAX candidate of a series by (MAE, RMSE, name), with regressor and lag."""
    hits = metrics.filter(
        F.col("Model").startswith("SARIMAX") & F.col("Test_MAE").isNotNull() & (F.col("Test_MAE") < cfg.FAILED_FIT)
    )
    best = hits.groupBy(*SERIES).agg(F.min_by(F.struct("Model", "Test_MAE", "Test_RMSE", "ROCV_MAE"), tie_key()).alias("r"))
    best = best.select(*SERIES, "r.*")
    name, lag = regressor_of(F.col("Model"))
    return best.select(*SERIES, "Model", "Test_MAE", "Test_RMSE", "ROCV_MAE",
                       name.alias("Regressor_Name"), lag.alias("Regressor_Lag"))


def model_summary(metrics: DataFrame, recommended: DataFrame) -> DataFrame:
    """One row per series in the fixed report layout; raw metrics are reported."""
    raw = metrics.select(*MODEL_KEY, "Test_MAE", "Test_RMSE", "ROCV_MAE")

    def named(prefix):
        return raw.withColumnsRenamed({"Model": f"{prefix}_Model", "Test_MAE": f"{prefix}_MAE",
                                       "Test_RMSE": f"{prefix}_RMSE", "ROCV_MAE": f"{prefix}_ROCV_MAE"})

    best = best_regressor(metrics).select(
        *SERIES, F.col("Model").alias("Best_NonBaseline_Model"),
        F.col("Regressor_Name").alias("Best_NonBaseline_Regressor_Name"),
        F.col("Regressor_Lag").alias("Best_NonBaseline_Regressor_Lag"),
    )
    name, lag = regressor_of(F.col("Chosen_Model"))
    return (
        recommended.select(*SERIES, F.col("Recommended_Model").alias("Chosen_Model"),
                           F.col("baseline_model").alias("Baseline_Model"), "Reason")
        .join(named("Baseline"), [*SERIES, "Baseline_Model"], "left")
        .join(named("Chosen"), [*SERIES, "Chosen_Model"], "left")
        .join(best, SERIES, "left")
        .select(
            *SERIES,
            F.coalesce("Chosen_Model", F.lit("FAILED")).alias("Chosen_Model"),
            "Best_NonBaseline_Model", "Best_NonBaseline_Regressor_Name", "Best_NonBaseline_Regressor_Lag",
            "Baseline_MAE", "Baseline_ROCV_MAE", "Chosen_MAE", "Chosen_RMSE", "Chosen_ROCV_MAE",
            improvement(F.col("Baseline_MAE"), F.col("Chosen_MAE")).alias("MAE_Improvement_Pct"),
            name.alias("Regressor_Name"), lag.alias("Regressor_Lag"),
            (F.col("Chosen_Model") != F.col("Baseline_Model")).alias("Accepted_by_rules"),
        )
    )


def model_choices(summary: DataFrame, recommended: DataFrame) -> DataFrame:
    """Model to forecast per series: the recommendation replaces the summary's choice.

    The regressor comes from the chosen SARIMAX model, else from the best SARIMAX candidate;
    a lag-0 regressor is dropped.
    """
    df = summary.join(
        recommended.select(*SERIES, F.col("Recommended_Model").alias("rec_model")), SERIES, "left"
    ).withColumn("model", F.coalesce("rec_model", "Chosen_Model"))
    own_name, own_lag = regressor_of(F.col("model"))
    other = ~F.col("model").startswith("SARIMAX") & F.col("Best_NonBaseline_Model").startswith("SARIMAX")
    name = F.when(other, F.col("Best_NonBaseline_Regressor_Name")).otherwise(own_name)
    lag = F.when(other, F.col("Best_NonBaseline_Regressor_Lag")).otherwise(own_lag)
    name, lag = drop_lag_zero(name, lag)
    return df.select(*SERIES, "model", name.alias("reg_name"), lag.alias("reg_lag"))
