"""Null-safe numeric expressions. NULL is the only missing value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def finite(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(INF)), c)


def to_number(c) -> Column:
    """Bad text, NaN and infinities become NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return finite(c.try_cast("double"))


def floor_zero(c: Column) -> Column:
    """max(c, 0) that keeps NULL (greatest() alone would turn NULL into 0)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def ratio(num: Column, den: Column) -> Column:
    """NULL when the denominator is 0 or NULL."""
    return F.when(den != 0, num / den)


def improvement(baseline: Column, chosen: Column, eps: float = 1e-9) -> Column:
    return F.when(F.abs(baseline) > eps, (baseline - chosen) / baseline)


def info_criterion(sse: Column, n: Column, k: Column) -> Column:
    """AICc of a Gaussian fit, AIC when AICc is undefined, else +inf."""
    aic = n * F.log(sse / n) + 2 * k
    aicc = aic + 2 * k * (k + 1) / (n - k - 1)
    ok = (sse > 0) & (n > 0)
    return F.when(ok & (n > k + 1), aicc).when(ok, aic).otherwise(F.lit(INF))


def test_window(n: Column, full: int = 12, short_below: int = 24) -> Column:
    """Holdout length: 12, or min(12, max(6, n div 4)) for a short history."""
    short = F.least(F.lit(full), F.greatest(F.lit(6), F.floor(n / 4).cast("int")))
    return F.when(n < short_below, short).otherwise(F.lit(full))


def one_of(values: dict[str, str], key: Column, default: Column | None = None) -> Column:
    """Constant lookup as a CASE expression."""
    chain = None
    for k, v in values.items():
        chain = F.when(key == k, v) if chain is None else chain.when(key == k, v)
    return chain if default is None else chain.otherwise(default)
