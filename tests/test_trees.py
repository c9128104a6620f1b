"""The tree engine against plain recursion, and the jobs that use it."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.operators.forecasters import boosting, spike, trees


def plain_boosting(x, y, config):
    """Exact boosting by trying every threshold of every feature, one row set at a time."""

    def grow(rows, residual, depth):
        mean = residual[rows].mean()
        if depth == 0 or len(rows) < 2:
            return mean
        best, found = 1e-9, None
        for j in range(x.shape[1]):
            for low, high in zip(np.unique(x[rows, j]), np.unique(x[rows, j])[1:]):
                left = rows[x[rows, j] <= low]
                right = rows[x[rows, j] > low]
                gain = residual[left].sum() ** 2 / len(left) + residual[right].sum() ** 2 / len(right) - residual[rows].sum() ** 2 / len(rows)
                if gain > best + 1e-9:
                    best, found = gain, (j, (low + high) / 2, left, right)
        if found is None:
            return mean
        j, limit, left, right = found
        return j, limit, grow(left, residual, depth - 1), grow(right, residual, depth - 1)

    def value(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    score, grown = np.full(len(y), y.mean()), []
    for _ in range(config.trees):
        grown.append(grow(np.arange(len(y)), y - score, config.depth))
        score = score + config.step * np.array([value(grown[-1], r) for r in x])
    return lambda new: np.array([y.mean() + config.step * sum(value(t, r) for t in grown) for r in new])


@pytest.mark.parametrize("large", [False, True])
def test_boosting_equals_plain_recursion(large, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, size=(60, 3)).astype(float)
    y = x[:, 0] * 2 + np.sin(x[:, 1]) * 9 + rng.normal(size=60)
    config = cfg.BoostConfig(trees=12, step=0.1)
    if large:
        monkeypatch.setattr(trees, "LARGE", 10)
    got = trees.fit(x, y, np.zeros(60, dtype=int), 1, config)
    new = rng.integers(-5, 50, size=(40, 3)).astype(float)
    assert np.allclose(got.predict(new, np.zeros(40, dtype=int)), plain_boosting(x, y, config)(new))


def test_a_model_does_not_depend_on_the_models_beside_it():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(50, 4)), rng.normal(size=50)
    many = trees.fit(np.concatenate([x[:20], x[:35], x]), np.concatenate([y[:20], y[:35], y]), np.repeat([0, 1, 2], [20, 35, 50]), 4, cfg.LAG_TREES)
    for m, n in enumerate([20, 35, 50]):
        alone = trees.fit(x[:n], y[:n], np.zeros(n, dtype=int), 1, cfg.LAG_TREES)
        assert np.allclose(many.predict(x, np.full(50, m)), alone.predict(x, np.zeros(50, dtype=int)))
    assert (many.predict(x, np.full(50, 3)) == 0).all()  # a model without rows


@pytest.mark.parametrize("large", [False, True])
def test_missing_values_have_a_side_of_their_own(large, monkeypatch):
    if large:
        monkeypatch.setattr(trees, "LARGE", 10)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    x[:80, 1] = np.nan
    x[:, 2] = np.nan  # a column without any value
    y = np.where(np.isnan(x[:, 1]), 10.0, x[:, 0])
    got = trees.fit(x, y, np.zeros(200, dtype=int), 1, cfg.BoostConfig(trees=150))
    assert np.abs(got.predict(x, np.zeros(200, dtype=int)) - y).mean() < 0.1
    assert got.gain[0, 2] == 0 and got.gain[0].argmax() == 1


def test_classifier_learns_a_rule_and_one_class_stays_constant():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 4))
    hit = (x[:, 2] > 0.5).astype(float)
    p = trees.probability(trees.fit(x, hit, np.zeros(120, dtype=int), 1, cfg.SPIKE_TREES, np.ones(120), classify=True).predict(x, np.zeros(120, dtype=int)))
    assert ((p > 0.5) == (hit == 1)).mean() > 0.97
    none = trees.fit(x, np.zeros(120), np.zeros(120, dtype=int), 1, cfg.SPIKE_TREES, np.ones(120), classify=True)
    assert trees.probability(none.predict(x, np.zeros(120, dtype=int))).max() < 0.01


def test_splits_of_more_rows_and_values_are_exact_too():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(trees.LARGE + 44, 2))
    y = np.where(x[:, 0] > np.sort(x[:, 0])[-4], 50.0, x[:, 1])
    config = cfg.BoostConfig(trees=4, step=0.3)
    got = trees.fit(x, y, np.zeros(len(x), dtype=int), 1, config)
    assert np.allclose(got.predict(x, np.zeros(len(x), dtype=int)), plain_boosting(x, y, config)(x))


@pytest.mark.parametrize("config", [
    cfg.BoostConfig(trees=30),
    cfg.BoostConfig(trees=30, depth=4, l2=1.0, least_weight=1.0, row_share=0.9, column_share=0.7),
])
@pytest.mark.parametrize("classify", [False, True])
def test_trees_do_not_depend_on_the_number_of_rows_beside_which_they_are_fitted(config, classify, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 4))
    x[:, 1] = np.round(x[:, 1], 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0]) + rng.normal(size=500)
    y = (y > 1).astype(float) if classify else y
    model = rng.integers(0, 3, size=500)
    weight = rng.uniform(0.5, 2.0, size=500) if classify else None
    forests = []
    for large in (10, 10**9):
        monkeypatch.setattr(trees, "LARGE", large)
        forests.append(trees.fit(x, y, model, 3, config, weight, classify))
    one, other = forests
    assert (one.feature == other.feature).all() and (one.limit == other.limit).all() and (one.missing_left == other.missing_left).all()
    assert np.allclose(one.leaf, other.leaf) and np.allclose(one.gain, other.gain)


def months(n, start=dt.date(2018, 1, 1)):
    return [dt.date(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1) for i in range(n)]


def test_lag_models_leave_a_reason_for_every_series(spark):
    rows = [("long", "D", m, float(50 + 10 * (i % 12) + i), float(i)) for i, m in enumerate(months(60))]
    rows += [("middle", "D", m, float(i % 7 + 1), float(i)) for i, m in enumerate(months(35))]
    rows += [("short", "D", m, float(i + 1), float(i)) for i, m in enumerate(months(10))]
    rows += [("unknown", "D", m, None, None) for m in months(20)]
    fact = spark.createDataFrame(rows, "Product string, Division string, Month date, Actuals double, Bookings double")
    config = cfg.BoostConfig(trees=20, step=0.2)
    holdout, rocv = boosting.backtest(fact, config=config)
    found = {r["Product"]: r for r in rocv.collect()}
    assert len(found) == 4 and found["long"]["n_origins"] == 60 - 12 - 24 and found["long"]["Forecast_valid"]
    assert found["middle"]["Skip_Reason"] == boosting.R_ROLLING and found["middle"]["ROCV_MAE"] is None
    assert found["short"]["Skip_Reason"] == found["unknown"]["Skip_Reason"] == boosting.R_ROWS
    tested = holdout.groupBy("Product").count().collect()
    assert {r["Product"]: r["count"] for r in tested} == {"long": 12, "middle": 12}
    ahead = boosting.forecast(fact, config=config).collect()
    assert {r["Product"]: r["Skip_Reason"] for r in ahead if r["Month"] is None} == {"short": boosting.R_ROWS, "unknown": boosting.R_ROWS}
    assert min(r["Month"] for r in ahead if r["Product"] == "long") == dt.date(2023, 1, 1)


def test_later_rows_do_not_reach_a_holdout_fit(spark):
    rows = [("a", "D", m, float(20 + (i * 7) % 11)) for i, m in enumerate(months(50))]
    other = [(p, d, m, y * 1000 if i >= 38 else y) for i, (p, d, m, y) in enumerate(rows)]
    schema = "Product string, Division string, Month date, Actuals double"
    first = [boosting.backtest(spark.createDataFrame(r, schema), config=cfg.BoostConfig(trees=30))[0].orderBy("Date").first() for r in (rows, other)]
    assert first[0]["Forecast"] == first[1]["Forecast"]


def test_residual_models_cover_cuts_and_future_of_every_series(spark):
    known = [("a", "D", s, t, 100.0 + 5 * i, 100.0, float(i), None) for i, t in enumerate(months(20)) for s in months(2)]
    known += [("b", "D", s, t, 1.0, 1.0, 0.0, None) for t in months(3) for s in months(1)]
    schema = "Product string, Division string, snapshot_month date, target_month date, actuals double, baseline_pred double, x_i double, x_none double"
    rows = spark.createDataFrame(known, schema).withColumn("residual", F.col("actuals") - F.col("baseline_pred"))
    future = spark.createDataFrame([("a", "D", months(1)[0], months(30)[29], None, 100.0, 19.0, None), ("c", "D", months(1)[0], months(1)[0], None, 1.0, 1.0, 1.0)], schema).withColumn("residual", F.lit(None).cast("double"))
    got = boosting.residual_models(rows, future, 6, cfg.BoostConfig(trees=80, step=0.2)).collect()
    cv = [r for r in got if r["kind"] == "cv"]
    assert len({r["target_month"] for r in cv}) == 6 and {r["Product"] for r in cv} == {"a"}
    (ahead,) = [r for r in got if r["kind"] == "future"]
    assert abs(ahead["final_pred"] - 195.0) < 6 and all(r["final_pred"] >= 0 for r in cv)
    assert {r["Product"]: r["reason"] for r in got if r["kind"] == "summary"} == {"a": None, "b": boosting.R_FOLDS, "c": boosting.R_TRAINING}


def test_residual_models_of_many_rows_split_between_any_two_values(spark):
    n = 2 * trees.LARGE  # rows of 32 months ahead by 16 snapshots; the last three alone have a residual
    known = [("a", "D", s, t, 150.0 if 16 * i + j >= n - 3 else 100.0, 100.0, float(16 * i + j)) for i, t in enumerate(months(32)) for j, s in enumerate(months(16))]
    schema = "Product string, Division string, snapshot_month date, target_month date, actuals double, baseline_pred double, x_i double"
    rows = spark.createDataFrame(known, schema).withColumn("residual", F.col("actuals") - F.col("baseline_pred"))
    future = [("a", "D", months(1)[0], t, None, 100.0, float(x)) for t, x in zip(months(36)[32:], (n - 4, n - 3, n - 1, n))]
    future = spark.createDataFrame(future, schema).withColumn("residual", F.lit(None).cast("double"))
    got = boosting.residual_models(rows, future, 2).filter("kind = 'future'").orderBy("target_month").collect()
    assert np.allclose([r["final_pred"] for r in got], [100.0, 150.0, 150.0, 150.0], atol=0.01)


def asof_like(spark, n=60):
    rows = []
    for p, missing in (("a", False), ("b", True)):
        for i, m in enumerate(months(n)):
            burst = 900.0 if i % 9 == 4 else 0.0
            rows.append((p, "D", m, 100.0 + burst + i % 5, None if missing else burst, i % 12 + 1, (i % 12) // 3 + 1))
    df = spark.createDataFrame(rows, "Product string, Division string, Month date, Actuals double, pipeline_primary_lag1 double, month_of_year int, quarter int")
    from seriesloom.operators.lags import target_lags

    return target_lags(df.drop("month_of_year", "quarter")).withColumn("pipeline_missing_flag", F.col("pipeline_primary_lag1").isNull().cast("int"))


def test_spike_model_scores_every_series_with_a_column_that_is_null_in_one(spark):
    small = cfg.BoostConfig(trees=40, step=0.2, depth=3, l2=1.0, least_weight=0.1)
    done = spike.evaluate(asof_like(spark), 1.5, base_config=cfg.BoostConfig(trees=40, step=0.1), config=small)
    scored = spike.predictions(done).collect()
    assert {p: sum(r["Product"] == p for r in scored) for p in "ab"} == {"a": 12, "b": 12}
    bursts = [r["spike_prob"] for r in scored if r["Product"] == "a" and r["Actuals"] > 500]
    calm = [r["spike_prob"] for r in scored if r["Product"] == "a" and r["Actuals"] < 500]
    assert min(bursts) > max(calm)
    assert {r["Product"] for r in spike.importance(done).collect()} == {"a", "b"}


def test_spike_tuning_has_every_fold_of_every_series(spark):
    tiny = cfg.BoostConfig(trees=3, depth=2, least_weight=0.1)
    scores = spike.tune(asof_like(spark), base_config=tiny, config=tiny)
    assert scores.groupBy("Product", "param").agg(F.count(F.lit(1)).alias("n")).where("n <> 5").count() == 0
    tuned = spike.tuned(scores).collect()
    assert len(tuned) == 6 and sum(r["chosen"] for r in tuned) == 2


@pytest.mark.parametrize("label, score, want", [([1, 0, 1, 0], [4, 3, 2, 1], 0.5 + 0.5 * 2 / 3), ([1, 1, 0], [1, 1, 1], 2 / 3), ([0, 0], [1, 2], None)])
def test_average_precision(label, score, want):
    got = spike._average_precision(np.array(label), np.array(score, dtype=float))
    assert np.isnan(got) if want is None else abs(got - want) < 1e-12
