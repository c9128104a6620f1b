"""Model names to families, types, groups, regressors and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions.numeric import one_of

_IS_ML = ("ML_GBR", cfg.SNAPSHOT_ML_MODEL)


def blend_family(model: Column) -> Column:
    return (
        F.when(model == "SARIMA_baseline", "SARIMA")
        .when(model.startswith("SARIMAX"), "SARIMAX")
        .when(model == "ETS_baseline", "ETS")
        .when(model.isin("SBA", "PROPHET"), model)
        .when(model.isin(*_IS_ML), "ML")
    )


def model_type(model: Column) -> Column:
    return F.coalesce(
        blend_family(model), F.when(model == cfg.BLEND_MODEL, "BLEND"), F.lit("Other")
    )


def model_group(model: Column) -> Column:
    m = F.trim(model)
    return F.when(m.startswith("SARIMAX"), "with_regressor").otherwise(one_of(cfg.GROUP_BY_MODEL, m))


def regressor_of(model: Column) -> tuple[Column, Column]:
    """Regressor name and lag of 'SARIMAX_<name>_l<lag>', nulls for other models."""
    pattern = r"^SARIMAX_(.*)_l(\d+)$"
    hit = model.rlike(pattern)
    name = F.when(hit, F.regexp_extract(model, pattern, 1))
    lag = F.when(hit, F.regexp_extract(model, pattern, 2).cast("int"))
    return name, lag


def drop_lag_zero(name: Column, lag: Column) -> tuple[Column, Column]:
    return F.when(lag > 0, name), F.when(lag > 0, lag)


def regressor_label(name: Column) -> Column:
    text = one_of(cfg.REGRESSOR_LABELS, name, F.replace(name, F.lit("_"), F.lit(" ")))
    return F.coalesce(text, F.lit("Regressor"))


def model_label(group: Column, regressor: Column, lag: Column) -> Column:
    with_regressor = F.concat_ws(
        " ", regressor_label(regressor), F.concat(F.lit("Lag"), lag.cast("string")), F.lit("Regressor")
    )
    return F.when(group == "with_regressor", with_regressor).otherwise(
        one_of(cfg.MODEL_LABELS, group, group)
    )


def blend_text(top_families: Column) -> Column:
    """Sentence about a blend; `top_families` is an array of at most two names."""
    first, second = F.get(top_families, F.lit(0)), F.get(top_families, F.lit(1))

    def snippet(family):
        return F.coalesce(one_of(cfg.FAMILY_SNIPPETS, family), F.lit("their strengths"))

    return (
        F.when(
            second.isNotNull(),
            F.format_string(
                "Weighted blend leaning toward %s and %s; balances %s and %s based on recent accuracy.",
                first, second, snippet(first), snippet(second),
            ),
        )
        .when(
            first.isNotNull(),
            F.format_string(
                "Weighted blend leaning toward %s; balances %s based on recent accuracy.",
                first, snippet(first),
            ),
        )
        .otherwise("Weighted blend of the best-performing models based on recent accuracy.")
    )


def forecast_text(group: Column, top_families: Column) -> Column:
    return F.when(group == cfg.BLEND_MODEL, blend_text(top_families)).otherwise(
        one_of(cfg.MODEL_DESCRIPTIONS, group, F.lit(""))
    )
