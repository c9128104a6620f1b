"""Least squares on running sums.

Normal-equation terms are summed by a window over the months of a series, so every cut of every
series is available from one pass; only the small dense solve is Python, batched over Arrow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.schema import SERIES


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def with_prefix_gram(df: DataFrame, x: Sequence[str], y: str, out: str = "gram", order: str = "Month") -> DataFrame:
    """Adds the running normal-equation sums of the rows strictly before each row.

    The sums are the upper triangle of x x', then x y, y y and the row count. Rows with a null
    count as 0; they are zeroed once, before the products.
    """
    known = F.col(y).isNotNull()
    for c in x:
        known = known & F.col(c).isNotNull()
    zeroed = {f"_{c}": F.when(F.col("_known"), F.col(c)).otherwise(0.0) for c in [*x, y]}
    df = df.withColumn("_known", known).withColumns(zeroed).withColumn("_n", F.col("_known").cast("double"))
    v, t = [F.col(f"_{c}") for c in x], F.col(f"_{y}")
    k = len(v)
    terms = [v[i] * v[j] for i in range(k) for j in range(i, k)] + [c * t for c in v] + [t * t, F.col("_n")]
    df = df.withColumns({f"_g{i}": term for i, term in enumerate(terms)})
    w = Window.partitionBy(*SERIES).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"_s{i}": F.sum(f"_g{i}").over(w) for i in range(len(terms))}
    df = df.withColumns(sums)
    packed = F.array(*[F.coalesce(f"_s{i}", F.lit(0.0)) for i in range(len(terms))])
    helpers = ["_known", "_n", *zeroed, *sums, *[f"_g{i}" for i in range(len(terms))]]
    return df.withColumn(out, packed).drop(*helpers)


def solver(k: int, ridge: Sequence[float] | float = 1e-6, relative: bool = True):
    """Arrow-batched solve of the k normal equations.

    solve(gram, mask) -> struct(beta, se, sse, n, used); columns with mask 0 get coefficient 0.
    `ridge` is added to the diagonal, relative to its mean if `relative`. Fewer rows than
    coefficients, or an empty Gram matrix, give nulls.
    """
    ridges = [float(ridge)] * k if isinstance(ridge, (int, float)) else [float(r) for r in ridge]

    def solve_batch(gram, mask):
        import numpy as np
        import pandas as pd

        rows = len(gram)
        cols = {"beta": [None] * rows, "se": [None] * rows, "sse": [None] * rows, "n": [None] * rows, "used": [None] * rows}
        keep = [i for i in range(rows) if gram.iloc[i] is not None and mask.iloc[i] is not None]
        if keep:
            g = np.stack([np.asarray(gram.iloc[i], dtype=float) for i in keep])
            m = np.stack([np.asarray(mask.iloc[i], dtype=float) for i in keep])
            iu = np.triu_indices(k)
            a = np.zeros((len(keep), k, k))
            a[:, iu[0], iu[1]] = g[:, : len(iu[0])]
            a = np.maximum(a, 0) + np.minimum(a, 0)
            a = a + np.transpose(np.triu(a, 1), (0, 2, 1))
            b = g[:, len(iu[0]) : len(iu[0]) + k] * m
            yy, n = g[:, -2], g[:, -1]
            a = a * m[:, :, None] * m[:, None, :]
            used = m.sum(axis=1)
            diag = np.einsum("nii->ni", a)
            scale = diag.sum(axis=1) / np.maximum(used, 1.0) if relative else np.ones(len(keep))
            lam = np.asarray(ridges)[None, :] * scale[:, None] * m + (1.0 - m) + 1e-12
            reg = a + lam[:, :, None] * np.eye(k)[None, :, :]
            inv = np.linalg.inv(reg)
            beta = np.einsum("nij,nj->ni", inv, b)
            sse = yy - 2 * (beta * b).sum(axis=1) + np.einsum("ni,nij,nj->n", beta, a, beta)
            sse = np.maximum(sse, 0.0)
            dof = n - used
            var = np.where(dof > 0, sse / np.maximum(dof, 1.0), np.nan)
            se = np.sqrt(np.maximum(np.einsum("nii->ni", inv), 0.0) * var[:, None])
            for at, i in enumerate(keep):
                if n[at] > used[at] and np.isfinite(beta[at]).all():
                    cols["beta"][i] = beta[at].tolist()
                    cols["se"][i] = [None if not np.isfinite(v) else float(v) for v in se[at]]
                    cols["sse"][i] = float(sse[at])
                    cols["n"][i] = float(n[at])
                    cols["used"][i] = float(used[at])
        return pd.DataFrame(cols)

    return F.pandas_udf(
        _annotated(solve_batch), "struct<beta:array<double>,se:array<double>,sse:double,n:double,used:double>"
    )


def _annotated(fn):
    import pandas as pd

    fn.__annotations__ = {"gram": pd.Series, "mask": pd.Series, "return": pd.DataFrame}
    return fn


def normal_p_value(z: Column) -> Column:
    """Two-sided p-value of a normal statistic (Abramowitz-Stegun 7.1.26, error below 1.5e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * x)
    # Coefficients of the published approximation of erfc.
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    poly = t * (a[0] + t * (a[1] + t * (a[2] + t * (a[3] + t * a[4]))))
    return poly * F.exp(-x * x)
