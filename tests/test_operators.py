"""Fixed values, edge cases and brute-force checks on small fixtures."""

import inspect
import math
import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions import codes, dates, labels, numeric
from seriesloom.operators import backtest as K
from seriesloom.operators import blend as B
from seriesloom.operators import library as Y
from seriesloom.operators import metrics as M
from seriesloom.operators import prepare as P
from seriesloom.operators import snapshots as S
from seriesloom.operators.forecasters import sba, spike
from seriesloom.plans import load

FACT = "Product string, Division string, Month date, Actuals double"


def month(i, start=2018):
    return date(start + i // 12, i % 12 + 1, 1)


def series(spark, values, product="P", division="D"):
    return spark.createDataFrame([(product, division, month(i), v) for i, v in enumerate(values)], FACT)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("values, expected", [
    ([0, 0, 5, 0, 3], 1.572413793), ([0, 0, 0], 0.0), ([10] * 12, 9.5), ([0, 4, 0, 0, 6, 0, 2], 1.809090909), ([], None)])
def test_sba_values(spark, values, expected):
    got = one(spark, sba.sba_level(F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")))
    assert got == (pytest.approx(expected, abs=1e-9) if expected is not None else None)


def test_sba_prefix_matches_refit(spark):
    rng = random.Random(1)
    y = [float(rng.choice([0, 0, 3, 7])) for _ in range(40)]

    def level(v):
        z = p = None
        q = 0
        for d in v:
            q += 1
            if d > 0:
                z, p = (d, q) if z is None else (z + 0.1 * (d - z), p + 0.1 * (q - p))
                q = 0
        return 0.0 if z is None else 0.95 * z / p

    rows = sba.prefix_forecasts(series(spark, y), "Actuals").orderBy("Month").collect()
    for i, r in enumerate(rows):
        assert r["forecast"] == (pytest.approx(level(y[:i])) if i else None)
    rocv = sba.sba_backtest(series(spark, y))[1].first()
    assert rocv["n_origins"] == 16
    assert rocv["ROCV_MAE"] == pytest.approx(sum(abs(y[i] - level(y[:i])) for i in range(24, 40)) / 16)


def test_codes(spark):
    n = lambda v: one(spark, codes.normalize_code(F.lit(v)))
    assert [n(" ab1 "), n("123.0"), n(None), n("1.5.0")] == ["AB1", "123", "", "1.5.0"]
    s = lambda v: one(spark, codes.strip_prefix(F.lit(v)))
    assert [s("ITEM_55"), s("prod-7"), s("X1")] == ["55", "7", "X1"]
    fy = lambda v: one(spark, codes.parse_fiscal_year(F.lit(v)))
    assert [fy("FY24"), fy("2023"), fy("n/a")] == [2024, 2023, None]
    my = lambda m, y: one(spark, codes.parse_month_year(F.lit(m), F.lit(y)))
    assert my("January", "FY24") == date(2024, 1, 1) and my("Foo", "FY24") is None
    cell = lambda v: one(spark, codes.parse_order_cell(F.lit(v), 3))
    assert [cell("(2, 1, 0)"), cell("(2,1)"), cell("")] == [[2, 1, 0], None, None]
    assert one(spark, dates.last_completed_month("2024-03-15")) == date(2024, 2, 1)
    assert one(spark, dates.parse_close_month(F.lit("3/15/2024"))) == date(2024, 3, 1)
    assert one(spark, dates.parse_snapshot_month(F.lit("bad"))) is None
    assert one(spark, numeric.floor_zero(F.lit(None).cast("double"))) is None
    assert one(spark, numeric.to_number(F.lit("NaN"))) is None


def test_regressor_name_is_exact(spark):
    name, lag = labels.regressor_of(F.lit("SARIMAX_Pct_Open_Not_Modified_90_Days_l2"))
    assert one(spark, name) == "Pct_Open_Not_Modified_90_Days" and one(spark, lag) == 2


def test_prelaunch_and_collapse(spark):
    df = spark.createDataFrame(
        [("P", "D", month(0), None, "x", 2), ("P", "D", month(0), 0.0, None, 1), ("P", "D", month(1), 5.0, "b", 4),
         ("P", "D", month(1), 2.0, "a", 3), ("Z", "D", month(0), 0.0, None, 5)],
        "Product string, Division string, Month date, Actuals double, note string, rid int")
    got = {(r["Product"], r["Month"]): r for r in P.collapse_months(df, ("Actuals",), "rid").collect()}
    assert got[("P", month(1))]["Actuals"] == 7.0 and got[("P", month(1))]["note"] == "a"
    assert got[("P", month(0))]["note"] == "x" and got[("P", month(0))]["Actuals"] == 0.0
    marked = P.mark_prelaunch(series(spark, [0.0, 0.0, 5.0, 0.0, 3.0])).orderBy("Month").collect()
    assert [r["Actuals"] for r in marked] == [None, None, 5.0, 0.0, 3.0]
    assert all(r["Actuals"] is None for r in P.mark_prelaunch(series(spark, [0.0, 0.0])).collect())


def test_catalog_duplicates(spark):
    cat = spark.createDataFrame([("G1", "B", "10|11", 0), ("G2", "B", "10", 1)],
                                "group_key string, business_unit_code string, sku_list string, catalog_row int")
    raw = spark.createDataFrame([("10", "B"), ("10", "other"), ("PROD_11", "B"), ("g2", "B"), ("nope", "B")], "raw_product string, Division string")
    got = {(r[0], r[1]): r[2] for r in P.map_codes(raw, cat).collect()}
    assert got == {("10", "B"): "G2", ("10", "other"): "G1", ("PROD_11", "B"): "G1", ("g2", "B"): "G2", ("nope", "B"): None}


def test_origins(spark):
    s = one(spark, K.six_by_three(F.lit(30)))
    assert [(r["train_end"], r["test_end"]) for r in s] == [(12, 18), (18, 24), (24, 30)]
    assert len(one(spark, K.one_step(F.lit(30)))) == 6
    assert one(spark, K.one_step(F.lit(24))) is None
    assert len(one(spark, K.last_origins(F.lit(60)))) == 12


def test_exact_median_and_pooled_auc(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.random(), 0.25, None]) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = statistics.median(v for v in values if v is not None)
    assert M.exact_median(df, "v").first()[0] == pytest.approx(want)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(2000)]
    scored = spark.createDataFrame(rows, "label int, score double")
    tp = n = 0
    area = 0.0
    pos = sum(r[0] for r in rows)
    for s in sorted({r[1] for r in rows}, reverse=True):
        here = [r[0] for r in rows if r[1] == s]
        tp, n = tp + sum(here), n + len(here)
        area += tp / n * sum(here) / pos
    assert M.pr_auc_pooled(scored, buckets=16).first()["pr_auc"] == pytest.approx(area)
    assert M.pr_auc(scored.withColumn("k", F.lit(1)), ["k"]).first()["pr_auc"] == pytest.approx(area)


def test_softmax(spark):
    df = spark.createDataFrame([("a", 0.20), ("b", 0.22), ("c", 0.30), ("d", None)], "f string, WAPE double").withColumn("k", F.lit(1))
    got = {r["f"]: r["Weight"] for r in B.softmax(df, ["k"]).collect()}
    assert [got["a"], got["b"], got["c"]] == pytest.approx([0.727475, 0.267623, 0.004902], abs=1e-6) and "d" not in got


def _lines(spark, rows):
    names = ["Month", "Close Date", "Business Unit", "Product Code", "Current OSC Product Name", "Account Name", "Opportunity Name",
             "Quantity", "Quantity W/ Decimal", "Probability", "Total Price", "Factored Quantity", "Factored Revenue", "_source_file"]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


def test_history_matching_slippage_and_quantity_choice(spark):
    row = lambda m, c, code, name, q1, q2, f: (m, c, "D", code, name, "Acme", "Deal", q1, q2, "50", "10", "1", "2", f)
    lines = _lines(spark, [
        row("2024-01", "03/10/2024", "0042.0", None, "4", "9", "f1"),   # matches by number
        row("2024-02", "05/10/2024", "42", None, None, "3", "f2"),      # matches by code; f2 has no Quantity
        row("2024-02", "05/20/2024", None, "widget", None, "2", "f2"),  # matches by alias name
        row("2024-02", "05/20/2024", "99", "other", "8", "8", "f2"),    # no series
        row("2024-02", "", "42", None, "8", "8", "f2"),                 # no target month
    ])
    fact = series(spark, [1.0], "42")
    aliases = spark.createDataFrame([("D", "42", "Widget")], "business_unit_code string, group_key string, salesforce_product_name string")
    got = {r["snapshot_month"]: r for r in S.load_history(lines, fact, aliases).collect()}
    jan, feb = got[date(2024, 1, 1)], got[date(2024, 2, 1)]
    assert (jan["pipeline_qty"], jan["pipeline_stage_weighted_qty"], jan["pipeline_stage_weighted_revenue"]) == (4.0, 2.0, 5.0)
    assert feb["pipeline_qty"] == 5.0 and feb["target_month"] == date(2024, 5, 1)
    assert jan["slippage_months"] is None and feb["slippage_months"] == 1.0  # shifts 2 and 0


def test_compile_closed_months(spark):
    def rows(run, months):
        return [("p", "b", m, t, float(run.month)) for m in months for t in ("SBA", "ETS")]

    schema = "product_id string, bu_id string, forecast_month date, model_type string, forecast_value double"
    current = spark.createDataFrame(rows(date(2024, 4, 1), [date(2024, 4, 1), date(2024, 5, 1)]), schema)
    archive = None
    for m in (1, 2, 3):
        run = date(2024, m, 1)
        df = spark.createDataFrame(rows(run, [run, date(2024, m + 1, 1)]), schema).withColumn("run_month", F.lit(run)).withColumn("extra", F.lit(1))
        archive = df if archive is None else archive.unionByName(df)
    got = Y.compile_closed(current, archive)
    assert got.columns == current.columns
    closed = {(r["forecast_month"].month, r["model_type"]): r["forecast_value"] for r in got.filter("forecast_month < '2024-04-01'").collect()}
    assert closed == {(m, t): float(m) for m in (1, 2, 3) for t in ("SBA", "ETS")}
    assert got.count() == 10
    january = spark.createDataFrame(rows(date(2024, 1, 1), [date(2024, 1, 1)]), schema)
    assert Y.closed_months(january).count() == 0


def test_spike_impute_does_not_read_test_rows(spark):
    df = series(spark, [1.0] * 30).withColumn("month_of_year", F.month("Month")).withColumn("x", F.when(F.col("Month") >= "2020-01-01", 50.0))
    got = spike.impute(df, ["x"], F.col("Month") < "2020-01-01")
    assert got.filter("Month < '2020-01-01' and x is not null").count() == 0
    with pytest.raises(ValueError):
        spike.spike_labels(series(spark, [1.0]), "unknown")


def test_model_jobs_invariants(spark):
    from seriesloom.operators.forecasters import arima, ets, trend

    y = [100 + 10 * math.sin(i * math.pi / 6) + i for i in range(72)]
    fact = series(spark, y).unionByName(series(spark, [5.0] * 20, "short"))
    orders = fact.select("Product", "Division").distinct().withColumns({"p": F.lit(1), "q": F.lit(0), "sp": F.lit(0), "sq": F.lit(0)})
    path = arima.forecast(fact, orders).filter("Product = 'P'").orderBy("h").collect()
    assert [r["h"] for r in path] == list(range(1, 13)) and path[0]["Month"] == month(72)
    truth = [100 + 10 * math.sin(i * math.pi / 6) + i for i in range(72, 84)]
    assert max(abs(r["Forecast"] - t) for r, t in zip(path, truth)) < 2.0
    assert all(r["lower_ci"] <= r["Forecast"] <= r["upper_ci"] for r in path)
    for job in (ets.backtest, trend.backtest):
        holdout, rocv = job(fact)
        h = holdout.filter("Product = 'P'").collect()
        assert len(h) == 12 and max(abs(r["Actual"] - r["Forecast"]) for r in h) < 15
        assert rocv.filter("Product = 'P'").first()["n_origins"] == 48
    searched = {r["Product"]: r for r in arima.search_orders(fact).collect()}
    assert searched["P"]["Status"] == "OK" and searched["short"]["Status"] == "SKIPPED_TOO_SHORT"


def test_rolling_fit_never_sees_later_rows(spark):
    from seriesloom.operators.forecasters import arima

    rng = random.Random(5)
    y = [100 + rng.random() * 20 for _ in range(60)]
    orders = series(spark, y).select("Product", "Division").distinct().withColumns({"p": F.lit(1), "q": F.lit(1), "sp": F.lit(1), "sq": F.lit(0)})

    def path(values):
        h, _ = arima.backtest(series(spark, values), orders)
        return [r["Forecast"] for r in h.orderBy("Date").collect()]

    changed = y[:48] + [v * 3 for v in y[48:]]
    assert path(y) == pytest.approx(path(changed))


def test_every_series_has_a_row(spark):
    """Short and early-ended series stay in the back-test tables, with a status."""
    from seriesloom.operators.forecasters import arima, ets, trend
    from seriesloom.plans.models import orders_of, per_series

    rng = random.Random(3)
    sizes = {"long": 60, "ended early": 40, "22 months": 22, "14 months": 14, "one month": 1}
    fact = None
    for name, n in sizes.items():
        part = series(spark, [50 + rng.random() * 10 for _ in range(n)], name)
        fact = part if fact is None else fact.unionByName(part)
    jobs = {"SARIMA_baseline": arima.backtest(fact, orders_of(fact)), "ETS_baseline": ets.backtest(fact), "PROPHET": trend.backtest(fact)}
    for model, parts in jobs.items():
        rows = {r["Product"]: r for r in per_series(fact, *parts, model).collect()}
        assert set(rows) == set(sizes), model
        assert rows["long"]["Status"] == rows["ended early"]["Status"] == "OK", model
        assert rows["one month"]["Status"] == "NOT_SCORED" and rows["one month"]["Test_MAE"] is None
    ets_rows = {r["Product"]: r["Status"] for r in per_series(fact, *jobs["ETS_baseline"], "ETS_baseline").collect()}
    assert ets_rows["22 months"] == ets_rows["14 months"] == "NO_ROLLING_ORIGIN"


def test_changepoints_follow_the_training_rows(spark):
    from seriesloom.operators.forecasters import trend

    for n in (24, 80, 400):
        at = trend.changepoints(n)
        assert len(at) == trend.KNOTS and at[0] > 0 and at[-1] == pytest.approx(0.8 * n)
    assert len(trend.changepoints(1)) == 0
    bent = [10.0] * 100 + [10.0 + 2 * i for i in range(80)]  # the bend lies after row 80
    holdout, _ = trend.backtest(series(spark, bent))
    assert max(abs(r["Actual"] - r["Forecast"]) for r in holdout.collect()) < 15


def test_tree_models_have_the_configured_size():
    from seriesloom.operators.forecasters import boosting

    assert (cfg.LAG_TREES.trees, cfg.LAG_TREES.step, cfg.LAG_TREES.depth) == (100, 0.1, 3)
    assert (cfg.BoostConfig().trees, cfg.BoostConfig().step, cfg.BoostConfig().depth) == (250, 0.05, 3)
    assert (cfg.SPIKE_TREES.trees, cfg.SPIKE_TREES.step, cfg.SPIKE_TREES.depth) == (300, 0.05, 4)
    for function, name, want in ((boosting.backtest, "config", cfg.LAG_TREES), (boosting.snapshot_model_run, "config", cfg.BoostConfig()), (boosting.snapshot_model_run, "holdout_months", 12),
                                 (spike.evaluate, "config", cfg.SPIKE_TREES), (spike.tune, "config", cfg.SPIKE_TREES), (spike.tune, "spike", cfg.SpikeConfig())):
        assert inspect.signature(function).parameters[name].default == want


def test_sba_holdout_folds_once_to_its_cut(spark):
    y = [0.0, 3.0, None, 0.0, 5.0, 2.0, 0.0, 0.0, 4.0, 1.0, 0.0, 6.0, 2.0, 0.0, 7.0, 0.0]
    fact = series(spark, y)
    known = [v for v in y if v is not None]
    z = p = None
    q = 0.0
    for v in known[:-12]:
        q += 1
        if v > 0:
            z, p, q = (v, q, 0.0) if z is None else (z + 0.1 * (v - z), p + 0.1 * (q - p), 0.0)
    got = sba.sba_backtest(fact)[0].orderBy("Date")
    rows = got.collect()
    assert [r.Actual for r in rows] == known[-12:] and {round(r.Forecast, 9) for r in rows} == {round(0.95 * z / p, 9)}
    assert sba.sba_backtest(series(spark, [1.0] * 12))[0].count() == 0
    plan = sba.sba_backtest(fact)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "posexplode" not in plan
    # The fold is in the projection that the generator reads, so it runs once for a series, not once for each month.
    above, below = plan.split("Generate inline", 1)
    assert "aggregate(" not in above and "aggregate(" in below
