"""The selection cases: all series of one table, one run per parameter set."""

from datetime import date

import pytest

from seriesloom import config as cfg
from seriesloom.operators import metrics as M
from seriesloom.operators import selection as S

R1 = S.R_BASELINE


def alt(x, y, n=12):
    return [x if i % 2 == 0 else y for i in range(n)]


# case: (models with raw MAE/RMSE/ROCV, actuals, forecasts per model)
CASES = {
    "A": ({"BASE": (10, 12, 5), "ML": (10.4, 12.5, 6)}, alt(100, 90), {"BASE": [100] * 12, "ML": alt(94.4, 84.4)}),
    "B": ({"BASE": (10, 12, 5), "ML": (11, 12.5, 6)}, alt(100, 90), {"BASE": [100] * 12, "ML": alt(90, 80)}),
    "C": ({"BASE": (9, 10, 4), "ML": (9.2, 10.1, 4.5)}, [5, 6, 7, 8, 9, 10], {"BASE": [5, 6, 7, 8, 9, 10], "ML": [5, 6, 7, 8, 9, 10]}),
    "D": ({"BASE": (8, 9, 4), "ML": (8.5, 9.2, None)}, [2, 3, 4, 3, 4, 3, 4, 3], {"BASE": [2, 3, 4, 3, 4, 3, 4, 3], "ML": [2, 3, 4, 3, 4, 3, 4, 3]}),
    "E": ({"BASE": (10, 12, 5), "ALT": (10.5, 12.4, 5.5)}, [10] * 12, {"BASE": [12] * 12, "ALT": alt(13.2, 9.0)}),
    "F": ({"BASE": (10, 12, 5), "ALT": (12.5, 13, 5.5)}, [10] * 12, {"BASE": [12] * 12, "ALT": alt(13, 8)}),
    "G": ({"BASE": (10, 12, 5), "ALT": (10.5, 12.4, 5.5)}, [10] * 12, {"BASE": [12] * 12, "ALT": alt(12.2, 11.9)}),
    "H": ({"BASE": (10, 12, 5), "ALT": (10.5, 12.4, 5.5)}, [10] * 12, {"BASE": [12] * 12, "ALT": [None] * 12}),
}


@pytest.fixture(scope="module")
def tables(spark):
    metrics, holdout = [], []
    for case, (models, actual, forecasts) in CASES.items():
        for m, (a, b, c) in models.items():
            metrics.append((case, "D1", m, float(a), float(b), None if c is None else float(c)))
            for i, y in enumerate(actual):
                f = forecasts[m][i]
                holdout.append((case, "D1", m, date(2024, 1 + i, 1), float(y), None if f is None else float(f)))
    return (
        spark.createDataFrame(metrics, "Product string, Division string, Model string, Test_MAE double, Test_RMSE double, ROCV_MAE double").cache(),
        spark.createDataFrame(holdout, "Product string, Division string, Model string, Date date, Actual double, Forecast double").cache(),
    )


def pick(rows):
    return {r["Product"]: r for r in rows}


def test_da_cases(tables):
    got = pick(S.select_model(*tables, cfg.SelectionConfig(bias_improvement_ratio=None)).collect())
    assert got["A"]["Recommended_Model"] == "ML" and got["A"]["Reason"].startswith("Override:")
    assert got["A"]["recommended_by_override"]
    assert got["B"]["Recommended_Model"] == "BASE" and got["B"]["Reason"] == R1
    assert got["C"]["Recommended_Model"] == "BASE" and got["C"]["Reason"] == R1
    assert got["D"]["Recommended_Model"] == "BASE"


def test_bias_cases(tables):
    got = pick(S.select_model(*tables, cfg.SelectionConfig(bias_improvement_ratio=0.70)).collect())
    assert got["E"]["Recommended_Model"] == "ALT" and got["E"]["Reason"].startswith("Bias override:")
    assert got["E"]["used_bias_override"] and not got["E"]["recommended_by_override"]
    for case in "FGH":
        assert got[case]["Recommended_Model"] == "BASE"


def test_expected_metrics(tables):
    w = {(r["Product"], r["Model"]): r for r in M.weighted_metrics(tables[1]).collect()}
    expected = {
        ("A", "BASE"): (5.416667, 7.359801, 5.416667, 0.057269), ("A", "ML"): (5.6, 5.6, -5.6, 0.059207),
        ("B", "ML"): (10.0, 10.0, -10.0, 0.105727), ("C", "ML"): (0, 0, 0, 0), ("E", "BASE"): (2.0, 2.0, 2.0, 0.2),
        ("E", "ALT"): (2.008333, 2.288012, 0.925, 0.0925), ("F", "ALT"): (2.458333, 2.508319, 0.291667, 0.029167),
        ("G", "ALT"): (2.0375, 2.042976, 2.0375, 0.20375),
    }
    for key, values in expected.items():
        r = w[key]
        assert [r["Weighted_MAE"], r["Weighted_RMSE"], r["bias"], r["abs_bias_pct"]] == pytest.approx(values, abs=1e-6)
    assert ("H", "ALT") not in w
    da = {(r["Product"], r["Model"]): (r["DA"], r["DA_Valid_Periods"]) for r in M.directional_accuracy(tables[1]).collect()}
    assert da[("A", "BASE")] == (0.0, 11) and da[("A", "ML")] == (1.0, 11)
    assert da[("C", "ML")] == (None, 5) and da[("D", "ML")] == (1.0, 7)
    err = {(r["Product"], r["Model"]): r["WAPE"] for r in M.error_metrics(tables[1]).collect()}
    assert err[("A", "BASE")] == pytest.approx(0.052632, abs=1e-6) and err[("F", "ALT")] == pytest.approx(0.25)


def test_missing_baseline_rocv_switches_the_check_off(spark, tables):
    from pyspark.sql import functions as F

    metrics = tables[0].withColumn("ROCV_MAE", F.when(F.col("Model") != "BASE", 100.0))
    flags = S.score_models(S.enrich(metrics, tables[1])).filter("Product = 'A' and Model = 'ML'").first()
    assert flags["rocv_hard_max"] is None and flags["passes_rocv_sanity"]


def test_no_valid_metrics(spark, tables):
    metrics = tables[0].filter("Product = 'A'")
    got = S.select_model(metrics, tables[1].filter("Product = 'none'")).first()
    assert got["Recommended_Model"] is None and got["Reason"] == S.R_NONE


def test_ties_go_to_the_model_name(spark):
    rows = [("P", "D", m, 1.0, 2.0, 3.0) for m in ("ETS_baseline", "SBA", "PROPHET")]
    m = spark.createDataFrame(rows, "Product string, Division string, Model string, Test_MAE double, Test_RMSE double, ROCV_MAE double")
    assert S.select_legacy(m).first()["Recommended_Model"] == "ETS_baseline"
    assert [r["Model"] for r in S.rank_models(m).orderBy("Rank").collect()] == ["ETS_baseline", "PROPHET", "SBA"]
