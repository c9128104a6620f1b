"""Parameters of the engine. Every default is a fixed value of the method."""

from __future__ import annotations

from dataclasses import dataclass, field

# Model names and their display texts.
BLEND_MODEL = "BLENDED_SOFTMAX"
SNAPSHOT_ML_MODEL = "ML_GBR_PIPELINE"

MODEL_LABELS = {
    "baseline_sarima": "Seasonal Baseline",
    "baseline_ets": "ETS Baseline",
    "sba": "SBA",
    "ml_gbr": "ML GBR",
    "ml_gbr_pipeline": "ML GBR Pipeline",
    "prophet": "PROPHET",
    BLEND_MODEL: "Blended (Softmax)",
}

MODEL_DESCRIPTIONS = {
    "baseline_sarima": "Repeats stable seasonal patterns from history; best when seasonality holds.",
    "baseline_ets": "Smooths recent level and trend; best for steady demand with gradual change.",
    "sba": "Designed for intermittent demand with long gaps between orders.",
    "with_regressor": "Uses an external driver to adjust the seasonal forecast; shines when the driver leads demand.",
    "ml_gbr": "Learns patterns from recent history; useful when demand shifts in non-linear ways.",
    "ml_gbr_pipeline": "Learns patterns from history and pipeline signals; best when pipeline leads demand.",
    "prophet": "Captures trend shifts and seasonality; useful when growth or decline changes over time.",
}

FAMILY_SNIPPETS = {
    "SARIMA": "seasonal baselines",
    "SARIMAX": "seasonality plus drivers",
    "ETS": "smooth trends",
    "SBA": "intermittent demand",
    "ML": "pattern learning",
    "PROPHET": "trend shifts",
}

REGRESSOR_LABELS = {
    "New_Opportunities": "Salesforce",
    "Open_Opportunities": "Salesforce",
    "Bookings": "Bookings",
    "Median_Months_Since_Last_Activity": "Median Months Since Last Activity",
    "Open_Not_Modified_90_Days": "Open Not Modified 90 Days",
    "Pct_Open_Not_Modified_90_Days": "Pct Open Not Modified 90 Days",
    "Early_to_Late_Ratio": "Early to Late Ratio",
}

GROUP_BY_MODEL = {
    "SARIMA_baseline": "baseline_sarima",
    "ETS_baseline": "baseline_ets",
    "SBA": "sba",
    "ML_GBR": "ml_gbr",
    SNAPSHOT_ML_MODEL: "ml_gbr_pipeline",
    "PROPHET": "prophet",
    BLEND_MODEL: BLEND_MODEL,
}

FAMILY_BY_GROUP = {
    "baseline_sarima": "SARIMA",
    "with_regressor": "SARIMAX",
    "baseline_ets": "ETS",
    "sba": "SBA",
    "prophet": "PROPHET",
    "ml_gbr": "ML",
    "ml_gbr_pipeline": "ML",
}

GROUP_PRIORITY = [
    "baseline_sarima",
    "with_regressor",
    "baseline_ets",
    "sba",
    "ml_gbr_pipeline",
    "ml_gbr",
    "prophet",
]

# Regressor candidates (signal, lags), in tie-break order.
REGRESSOR_LAGS = [
    ("New_Opportunities", (1, 2, 3)),
    ("Open_Opportunities", (1, 2, 3)),
    ("Bookings", (1, 2)),
    ("Median_Months_Since_Last_Activity", (1, 2)),
    ("Open_Not_Modified_90_Days", (1,)),
    ("Pct_Open_Not_Modified_90_Days", (1, 2)),
    ("Early_to_Late_Ratio", (1, 2)),
]

# Measures of the monthly signal summary.
SUMMARY_MEASURES = [
    "Sum_Total_Price",
    "Sum_Quantity",
    "Open_Opportunities",
    "New_Opportunities",
    "Median_Months_Since_Last_Activity",
    "Open_Not_Modified_90_Days",
    "Early_Open_Opportunities",
    "Late_Open_Opportunities",
    "Open_Expected_Close_0_1_Months",
    "Open_Expected_Close_2_3_Months",
    "Open_Expected_Close_4_6_Months",
    "Open_Expected_Close_7_12_Months",
    "Open_Expected_Close_13_Plus_Months",
    "Open_Top_Decile_Count",
    "Open_Top_Decile_Close_0_3_Months",
    "Pct_Open_Not_Modified_90_Days",
    "Early_to_Late_Ratio",
    "Closed_Won_Count_24m",
    "Closed_Lost_Count_24m",
    "Median_Days_To_Close_Won_24m",
    "Mean_Days_To_Close_Won_24m",
    "Won_Close_0_3_Count_24m",
    "Won_Close_4_6_Count_24m",
    "Won_Close_7_12_Count_24m",
    "Won_Close_13_Plus_Count_24m",
    "Closed_Win_Rate_24m",
    "Pct_Won_Close_0_3_24m",
    "Pct_Won_Close_4_6_24m",
    "Pct_Won_Close_7_12_24m",
    "Pct_Won_Close_13_Plus_24m",
]

# The five summed measures of one (snapshot, target) cell.
CELL_MEASURES = [
    "pipeline_qty",
    "pipeline_factored_qty",
    "pipeline_factored_revenue",
    "pipeline_stage_weighted_qty",
    "pipeline_stage_weighted_revenue",
]


@dataclass(frozen=True)
class BacktestConfig:
    horizon: int = 12
    min_rows: int = 30
    min_history: int = 12
    min_months_since_first: int = 11
    min_history_regressor: int = 36
    rolling_min_train: int = 24
    season: int = 12
    sba_alpha: float = 0.1


@dataclass(frozen=True)
class OriginScheme:
    """One rolling-origin scheme: test length, number of splits, least training rows."""

    steps: int
    splits: int | None
    min_train: int


ONE_STEP = OriginScheme(steps=1, splits=None, min_train=24)
SIX_BY_THREE = OriginScheme(steps=6, splits=3, min_train=7)
LAST_TWELVE = OriginScheme(steps=12, splits=12, min_train=12)


@dataclass(frozen=True)
class SelectionConfig:
    mae_tolerance: float = 0.20
    rmse_tolerance: float = 0.20
    rocv_hard_multiplier: float = 1.50
    rocv_preferred_lower: float = 0.85
    rocv_preferred_upper: float = 1.15
    rocv_too_smooth: float = 0.70
    rocv_too_noisy: float = 1.50
    da_min_periods: int = 6
    da_improvement: float = 0.10
    da_close_mae_tol: float = 0.05
    bias_improvement_ratio: float | None = 0.70
    bias_close_mae_tol: float = 0.10
    bias_close_rmse_tol: float | None = None
    bias_improvement_abs_pp: float | None = None
    # archived acceptance
    archived_epsilon: float = 0.02
    archived_delta: float = 0.05
    # absolute/relative acceptance
    accept_abs: float = 10.0
    accept_rel: float = 0.05
    accept_rocv: float = 0.10


@dataclass(frozen=True)
class BlendConfig:
    tau: float = 0.10
    eps: float = 1e-9


@dataclass(frozen=True)
class EtsConfig:
    season: int = 12
    alphas: tuple = (0.05, 0.2, 0.5, 0.8)
    betas: tuple = (0.01, 0.1, 0.3)
    gammas: tuple = (0.05, 0.2)
    phis: tuple = (0.9, 0.98)
    max_scale: float = 20.0
    eps: float = 1e-6


@dataclass(frozen=True)
class BoostConfig:
    """Boosted trees of the pipeline residual model; the other two models have their own below."""

    trees: int = 250
    step: float = 0.05
    depth: int = 3
    seed: int = 42
    l2: float = 0.0
    least_weight: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0


LAG_TREES = BoostConfig(trees=100, step=0.1)
SPIKE_TREES = BoostConfig(trees=300, depth=4, l2=1.0, least_weight=1.0, row_share=0.9, column_share=0.9)


@dataclass(frozen=True)
class SpikeConfig:
    method: str = "hybrid"
    holdout: int = 12
    quantiles: tuple = (0.8, 0.75)
    k_values: tuple = (1.25, 1.5, 1.75)
    abs_floor: float = 100.0
    lags: tuple = (1, 2, 3)
    folds: int = 5
    fold_rows: int = 6


RECENCY_WEIGHTS = {"recent": 0.55, "mid": 0.30, "old": 0.15}
POSITION_BUCKETS = [(1, 3, 0.50), (4, 6, 0.30), (7, 12, 0.20)]
ZERO_EPS = 1e-9
FAILED_FIT = 1e9
