"""What jobs move and store must not grow with the lines where the result does not."""

import random
import statistics
from datetime import date

from pyspark.sql import functions as F

from seriesloom.operators import snapshots as S

LINE = ["Month", "Close Date", "Business Unit", "Product Code", "Current OSC Product Name", "Account Name", "Opportunity Name", "Quantity", "_source_file"]


def _lines(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in LINE))


def _month(text):
    m, _, y = text.split("/")
    return int(y) * 12 + int(m)


def test_history_stores_cells_not_opportunities(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        deal = "hot" if i % 3 == 0 else f"deal {i % 100}"
        unit = rng.choice(["D", " d ", "D"])
        rows.append((f"2024-0{rng.randint(1, 6)}", f"{rng.randint(7, 12):02d}/{rng.randint(1, 28):02d}/2024", unit, "42", "n", "A", deal, "1", rng.choice(["f1", "f2"])))
    rows += [(None, "09/01/2024", "D", "42", "n", "A", "hot", "1", "f1"), ("2024-01", "no date", "D", "42", "n", "A", "hot", "1", "f1")]
    lines = _lines(spark, rows)
    series = spark.createDataFrame([("42", "D")], "Product string, Division string")
    aliases = spark.createDataFrame([], "business_unit_code string, group_key string, salesforce_product_name string")
    many = lines.unionByName(lines.withColumn("Opportunity Name", F.concat("Opportunity Name", F.lit(" again"))))
    assert S.line_cells(many).count() == S.line_cells(lines).count()  # rows stored: no opportunity in them
    got = {r["snapshot_month"]: (r["slippage_months"], r["n_shifts"]) for r in S.cells_and_slippage(lines, series, aliases)[1].collect()}
    shifts = {}
    for deal in {r[6] for r in rows}:
        own = sorted((r[0], _month(r[1])) for r in rows if r[6] == deal and r[0] is not None and r[1] != "no date")
        for before, now in zip(own, own[1:]):
            shifts.setdefault(now[0], []).append(now[1] - before[1])
    assert got == {date(2024, int(m[-2:]), 1): (statistics.median(v), len(v)) for m, v in shifts.items()}
    history = S.load_history(lines, series, aliases).agg(F.sum("pipeline_qty")).first()[0]
    assert history == len(rows) - 1


def test_order_lines_are_joined_once(spark):
    from seriesloom.plans.snapshots import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    for table in (i.lines(), i.summary()):
        assert "SortMergeJoin" not in table._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_lines_meet_their_series_once(spark, tmp_path, monkeypatch):
    from seriesloom.plans.snapshots import Inputs
    from seriesloom.sources import driver_tables as D

    sf = str(tmp_path)
    for t in ("nation", "supplier", "part", "orders", "lineitem"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        if t == "orders":  # lines without an order and an order given twice: the fact knows no orders
            rows = rows.where("o_orderkey % 3 <> 0").union(rows.where("o_orderkey % 100 = 1"))
        rows.write.parquet(f"{sf}/{t}.parquet")
    want = {tuple(r) for r in D.monthly_fact(spark, sf).collect()}
    signals = {tuple(r) for r in D.signal_summary(spark, sf).collect()}
    read, table = [], D.table
    monkeypatch.setattr(D, "table", lambda *a: read.append(a[2]) or table(*a))
    i = Inputs(spark, sf)
    assert {tuple(r) for r in i.fact.collect()} == want
    assert {tuple(r) for r in D.signal_summary(spark, sf, i.order_lines).collect()} == signals
    assert read.count("lineitem") == read.count("supplier") == read.count("orders") == 1


def test_fact_and_signals_come_from_one_pass_over_the_lines(spark):
    from seriesloom.plans.preparation import joined_signals

    plan = joined_signals(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "parquet" not in plan


def test_codes_are_mapped_in_one_join_without_exploding_rows(spark):
    from seriesloom.operators import prepare as P

    cat = spark.createDataFrame([("G1", "B", "10|ITEM_7|PROD_ITEM_9", 0), ("G2", "C", "10|7", 1), ("PROD-X", "B", "5.0", 2)],
                                "group_key string, business_unit_code string, sku_list string, catalog_row int")
    want = {("10", "B"): "G1", ("10", "C"): "G2", ("10", None): "G1", ("prod_item_7", "B"): "G1", ("item_7", "B"): "G1", ("ITEM-7", "C"): "G2", ("PROD_7", "B"): "G2",
            ("ITEM_9", "B"): None, ("PROD_ITEM_9", "B"): "G1", ("prod-x", "B"): "PROD-X", ("x", "B"): None, ("item_PROD-x", "B"): "PROD-X", (" 5.0", "Z"): "PROD-X", (None, "B"): None}
    raw = spark.createDataFrame(list(want), "raw_product string, Division string")
    mapped = P.map_codes(raw, cat)
    assert {(r[0], r[1]): r[2] for r in mapped.collect()} == want
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "rank" not in plan
