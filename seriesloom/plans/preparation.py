"""Queries: raw merge, preparation, gates, lags and signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions import codes, dates
from seriesloom.functions.lineage import cut_lineage
from seriesloom.operators import backtest as K
from seriesloom.operators import lags as L
from seriesloom.operators import prepare as P
from seriesloom.plans import ctes as C
from seriesloom.plans.registry import query, with_ctes
from seriesloom.schema import SERIES
from seriesloom.sources import driver_tables as D
from seriesloom.sources import files

RAW = r"""
raw AS (SELECT CASE l_linenumber WHEN 1 THEN 'PROD_' || l_partkey WHEN 2 THEN ' ' || l_partkey || '.0' WHEN 3 THEN lower(p_brand)
    WHEN 4 THEN 'item-' || l_partkey WHEN 5 THEN 'X' || l_partkey ELSE l_partkey::VARCHAR END AS raw_product, 'R' || n_regionkey AS Division,
    strftime(l_shipdate, '%B') AS raw_month, CASE WHEN year(l_shipdate) >= 2000 THEN 'FY' || strftime(l_shipdate, '%y') ELSE year(l_shipdate)::VARCHAR END AS raw_fy,
    l_quantity AS value, l_linestatus AS source_sheet, date_trunc('month', l_shipdate)::DATE AS Month
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
coded AS (SELECT *, upper(regexp_replace(trim(raw_product), '^(\d*)\.0$', '\1')) AS code FROM raw),
bare AS (SELECT *, regexp_replace(code, '^(PROD|ITEM)[_-]?', '', 'i') AS stripped FROM coded),
brands AS (SELECT DISTINCT upper(p_brand) AS g FROM part),
resolved AS (SELECT b.*, coalesce(upper(p1.p_brand), g1.g, upper(p2.p_brand), g2.g) AS Product FROM bare b
  LEFT JOIN part p1 ON p1.p_partkey::VARCHAR = code LEFT JOIN brands g1 ON g1.g = code
  LEFT JOIN part p2 ON p2.p_partkey::VARCHAR = stripped LEFT JOIN brands g2 ON g2.g = stripped)
"""
ORDER_CELLS = """
cells AS (SELECT Product, Division, CASE WHEN Division = 'R4' THEN '(2,1)' ELSE '(' || count(*) % 3 || ', 1, ' || sum(Actuals)::BIGINT % 3 || ')' END AS Chosen_Order,
    '(' || count(*) % 2 || ', 1, ' || sum(Actuals)::BIGINT % 2 || ', 12)' AS Chosen_Seasonal_Order FROM fact GROUP BY Product, Division)
"""


def order_cells(fact):
    """Order table as text, one row per series; the cells of one division have the wrong arity."""
    n, total = F.count(F.lit(1)), F.sum("Actuals").cast("long")
    return fact.groupBy(*SERIES).agg(
        F.when(F.col("Division") == "R4", "(2,1)").otherwise(F.format_string("(%d, 1, %d)", n % 3, total % 3)).alias("Chosen_Order"),
        F.format_string("(%d, 1, %d, 12)", n % 2, total % 2).alias("Chosen_Seasonal_Order"),
    )


@query("monthly_fact", with_ctes(C.FACT, body="SELECT * FROM fact"), "Actuals")
def monthly_fact(spark, sf):
    return P.collapse_months(D.shipments(spark, sf), ("Actuals",))


@query("actuals_bookings_full_join", with_ctes(C.FULL, body="SELECT Product, Division, Month, Actuals, Bookings FROM full_fact"), "Actuals Bookings")
def actuals_bookings_full_join(spark, sf):
    lines = D.order_lines(spark, sf)
    bookings = lines.select(*SERIES, F.col("order_month").alias("Month"), F.col("l_quantity").alias("Bookings"))
    return P.merge_actuals_bookings(D.shipments(spark, sf), bookings)


@query("full_fact", with_ctes(C.FULL, body="SELECT * FROM full_fact"), "Actuals Bookings New_Opportunities Open_Opportunities")
def full_fact(spark, sf):
    return D.full_fact(spark, sf)


def spine(spark, sf):
    lines = D.calendar_bounds(spark, sf)
    return P.month_spine(D.part_fact(spark, sf), lines.select("first_month").scalar(), lines.select("last_month").scalar())


@query("dense_spine", with_ctes(C.SPINE, body="SELECT Product, Division, Month, Actuals FROM spine"), "Actuals")
def dense_spine(spark, sf):
    return spine(spark, sf)


@query("completed_months", with_ctes(C.FACT, body="SELECT * FROM fact WHERE Month <= DATE '2001-08-01'"), "Actuals")
def completed_months(spark, sf):
    return P.completed_months(D.monthly_fact(spark, sf), D.AS_OF)


PRELAUNCH = C.SPINE + """,
marked AS (SELECT Product, Division, Month, CASE WHEN f IS NULL OR (Month < f AND Actuals = 0) THEN NULL ELSE Actuals END AS Actuals
  FROM (SELECT *, min(CASE WHEN Actuals > 0 THEN Month END) OVER (PARTITION BY Product, Division) AS f FROM spine))
"""


@query("prelaunch_marked", with_ctes(PRELAUNCH, body="SELECT * FROM marked"), "Actuals")
def prelaunch_marked(spark, sf):
    return P.mark_prelaunch(spine(spark, sf))


PROFILE = PRELAUNCH + """,
profile AS (SELECT Product, Division, count(*) AS n_rows, count(Actuals) AS history_months, min(CASE WHEN Actuals <> 0 THEN Month END) AS first_nonzero,
    max(CASE WHEN Actuals IS NOT NULL THEN Month END) AS last_actual, count(DISTINCT Actuals) AS distinct_values, coalesce(min(Actuals) >= 0, false) AS nonnegative FROM marked GROUP BY ALL)
"""


@query("series_profile", with_ctes(PROFILE, body="SELECT *, coalesce(datediff('month', first_nonzero, last_actual), -1)::BIGINT AS months_since_first FROM profile"))
def series_profile(spark, sf):
    return P.series_profile(P.mark_prelaunch(spine(spark, sf)))


@query("series_gates", with_ctes(PROFILE, body="""
  SELECT Product, Division, history_months, s AS months_since_first, n_rows >= 30 AS enough_rows, sar AS allow_sarima, sar AND history_months >= 36 AS allow_sarimax,
    history_months >= 24 AS allow_ets_seasonal, nonnegative AS allow_multiplicative,
    CASE WHEN NOT sar THEN 'N/A: history <12 months or first non-zero actual is <12 months ago.' END AS sarima_reason,
    CASE WHEN history_months < 36 THEN 'N/A: history <36 months; SARIMAX disabled.' WHEN NOT sar THEN 'N/A: SARIMA prerequisites not met.' END AS sarimax_reason
  FROM (SELECT *, history_months >= 12 AND s >= 11 AS sar FROM (SELECT *, coalesce(datediff('month', first_nonzero, last_actual), -1)::BIGINT AS s FROM profile))"""))
def series_gates(spark, sf):
    return P.series_gates(P.series_profile(P.mark_prelaunch(spine(spark, sf))))


@query("code_normalise", with_ctes(RAW, body="SELECT DISTINCT raw_product, code, stripped FROM bare"))
def code_normalise(spark, sf):
    raw = D.raw_extract(spark, sf).select("raw_product").distinct()
    code = codes.normalize_code("raw_product")
    return raw.select("raw_product", code.alias("code"), codes.strip_prefix(code).alias("stripped"))


@query("fiscal_month_parse", with_ctes(RAW, body="SELECT DISTINCT raw_month, raw_fy, year(Month) AS fiscal_year, Month FROM raw"))
def fiscal_month_parse(spark, sf):
    raw = D.raw_extract(spark, sf).select("raw_month", "raw_fy").distinct()
    return raw.select("raw_month", "raw_fy", codes.parse_fiscal_year(F.col("raw_fy")).alias("fiscal_year"),
                      codes.parse_month_year(F.col("raw_month"), F.col("raw_fy")).alias("Month"))


@query("code_to_group", with_ctes(RAW, body="""SELECT Product, Division, Month, source_sheet, sum(value) AS Actuals, count(*) AS n_lines
  FROM resolved WHERE Product IS NOT NULL GROUP BY ALL"""), "Actuals")
def code_to_group(spark, sf):
    rows = P.mapped_rows(P.resolve_extract(D.raw_extract(spark, sf), D.catalog(spark, sf)), "Actuals")
    return rows.groupBy(*SERIES, "Month", "source_sheet").agg(F.sum("Actuals").alias("Actuals"), F.count(F.lit(1)).alias("n_lines"))


@query("unmapped_rows", with_ctes(RAW, body="""SELECT raw_product, Division, raw_month, raw_fy, source_sheet, Month, value, 'unmapped product' AS Reason
  FROM resolved WHERE Product IS NULL"""), "value")
def unmapped_rows(spark, sf):
    return P.rejected_rows(P.resolve_extract(D.raw_extract(spark, sf), D.catalog(spark, sf))).drop("Product")


@query("duplicate_key_count", with_ctes(RAW, body="""SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_duplicates
  FROM (SELECT Product, Division, Month, count(*) AS n FROM resolved WHERE Product IS NOT NULL GROUP BY ALL)"""))
def duplicate_key_count(spark, sf):
    return P.duplicate_keys(P.mapped_rows(P.resolve_extract(D.raw_extract(spark, sf), D.catalog(spark, sf)), "Actuals"))


@query("order_cell_parse", with_ctes(C.FACT, ORDER_CELLS, body=r"""
  SELECT Product, Division, CASE WHEN len(o) = 3 THEN array_to_string(o, ',') END AS "order", CASE WHEN len(s) = 4 THEN array_to_string(s, ',') END AS seasonal
  FROM (SELECT *, regexp_extract_all(Chosen_Order, '-?\d+') AS o, regexp_extract_all(Chosen_Seasonal_Order, '-?\d+') AS s FROM cells)"""))
def order_cell_parse(spark, sf):
    cells = order_cells(D.monthly_fact(spark, sf))
    text = lambda c, n: F.array_join(codes.parse_order_cell(F.col(c), n).cast("array<string>"), ",")
    return cells.select(*SERIES, text("Chosen_Order", 3).alias("order"), text("Chosen_Seasonal_Order", 4).alias("seasonal"))


@query("order_overrides", with_ctes(C.FACT, ORDER_CELLS, body=r"""
  SELECT coalesce(b.Product, o.Product) AS Product, coalesce(b.Division, o.Division) AS Division, coalesce(o.o, b.o) AS "order", coalesce(o.s, b.s) AS seasonal, o.o IS NOT NULL AS overridden
  FROM (SELECT upper(Product) AS Product, Division, array_to_string(regexp_extract_all(Chosen_Order, '-?\d+'), ',') AS o, array_to_string(regexp_extract_all(Chosen_Seasonal_Order, '-?\d+'), ',') AS s
        FROM cells WHERE Division <> 'R4') b
  FULL JOIN (SELECT DISTINCT upper(Product) AS Product, Division, '1,1,1' AS o, '0,1,1,12' AS s FROM fact WHERE Division IN ('R1', 'R4')) o
  ON o.Product = b.Product AND o.Division = b.Division"""))
def order_overrides(spark, sf):
    fact = cut_lineage(D.monthly_fact(spark, sf))
    manual = fact.filter(F.col("Division").isin("R1", "R4")).select(F.col("Product").alias("group_key"), F.col("Division").alias("BU")).distinct()
    manual = manual.withColumn("Chosen_Order", F.lit("(1, 1, 1)")).withColumn("Chosen_Seasonal_Order", F.lit("(0, 1, 1, 12)"))
    out = P.resolve_orders(order_cells(fact), manual)
    return out.withColumn("order", F.array_join(F.col("order").cast("array<string>"), ",")).withColumn(
        "seasonal", F.array_join(F.col("seasonal").cast("array<string>"), ","))


@query("series_list", "SELECT DISTINCT upper(p_brand) AS Product, 'R' || (p_size % 5) AS Division FROM part")
def series_list(spark, sf):
    return P.series_list(D.catalog(spark, sf))


@query("feature_modes", """SELECT DISTINCT upper(p_brand) AS Product, 'R' || (p_size % 5) AS Division,
  CASE WHEN regexp_extract(p_brand, '(\\d+)$', 1)::INT % 2 = 0 THEN 'quantity' ELSE 'revenue' END AS mode FROM part""".replace("\\\\", "\\"))
def feature_modes(spark, sf):
    return P.feature_modes(D.catalog(spark, sf))


JOINED = C.FULL + "," + C.SIGNALS.replace(C.OL + ",", "") + """,
joined AS (SELECT f.Product, f.Division, f.Month, f.Actuals, f.Bookings, s.Sum_Total_Price, s.Sum_Quantity, s.Open_Opportunities, s.New_Opportunities
  FROM full_fact f LEFT JOIN signals s ON s.group_key = upper(f.Product) AND s.BU = f.Division AND s.Month = f.Month)
"""


def joined_signals(spark, sf):
    """Fact and signals from one pass over the lines."""
    cells = cut_lineage(D.order_cells(spark, sf))
    return P.join_signals(D.full_fact(spark, sf, cells), files.clean_summary(D.cell_summary(cells)))


@query("join_signals", with_ctes(JOINED, body="SELECT * FROM joined"), "Actuals Bookings Sum_Total_Price Sum_Quantity Open_Opportunities New_Opportunities", 4)
def join_signals(spark, sf):
    return joined_signals(spark, sf)


@query("exog_coverage", with_ctes(JOINED, body="""SELECT *, coverage < 0.7 AS low_coverage FROM (
    SELECT Product, Division, 'Bookings' AS Regressor, avg((Bookings IS NOT NULL)::INT) AS coverage FROM joined GROUP BY ALL
    UNION ALL SELECT Product, Division, 'Open_Opportunities', avg((Open_Opportunities IS NOT NULL)::INT) FROM joined GROUP BY ALL)"""), "coverage")
def exog_coverage(spark, sf):
    return P.exog_coverage(joined_signals(spark, sf), ["Bookings", "Open_Opportunities"])


@query("regressor_lags", with_ctes(C.FULL, body="""SELECT *, lag(New_Opportunities, 1) OVER w AS New_Opportunities_l1, lag(New_Opportunities, 2) OVER w AS New_Opportunities_l2,
    lag(New_Opportunities, 3) OVER w AS New_Opportunities_l3, lag(Open_Opportunities, 1) OVER w AS Open_Opportunities_l1, lag(Open_Opportunities, 2) OVER w AS Open_Opportunities_l2,
    lag(Open_Opportunities, 3) OVER w AS Open_Opportunities_l3, lag(Bookings, 1) OVER w AS Bookings_l1, lag(Bookings, 2) OVER w AS Bookings_l2
  FROM full_fact WINDOW w AS (PARTITION BY Product, Division ORDER BY Month)"""))
def regressor_lags(spark, sf):
    return L.regressor_lags(D.full_fact(spark, sf))


@query("target_lags", with_ctes(C.FACT, body="""SELECT Product, Division, Month, Actuals, lag(Actuals, 1) OVER w AS y_lag1, lag(Actuals, 2) OVER w AS y_lag2, lag(Actuals, 3) OVER w AS y_lag3,
    CASE WHEN count(Actuals) OVER (PARTITION BY Product, Division) >= 24 THEN lag(Actuals, 12) OVER w END AS y_lag12, month(Month) AS month_of_year, quarter(Month) AS quarter, row_number() OVER w - 1 AS trend_index
  FROM fact WINDOW w AS (PARTITION BY Product, Division ORDER BY Month)"""))
def target_lags(spark, sf):
    return L.target_lags(D.monthly_fact(spark, sf))


@query("exog_lags", with_ctes(C.FULL, body="""SELECT *, Bookings AS Bookings_l0, lag(Bookings, 1) OVER (PARTITION BY Product, Division ORDER BY Month) AS Bookings_l1 FROM full_fact"""))
def exog_lags(spark, sf):
    return L.exog_lags(D.full_fact(spark, sf), "Bookings")


@query("ffill_bfill", with_ctes(C.FULL, body="""SELECT Product, Division, Month, Bookings,
    coalesce(last_value(Bookings IGNORE NULLS) OVER (PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             first_value(Bookings IGNORE NULLS) OVER (PARTITION BY Product, Division ORDER BY Month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS Bookings_filled FROM full_fact"""))
def ffill_bfill(spark, sf):
    return L.fill_both_ways(D.full_fact(spark, sf).select(*SERIES, "Month", "Bookings"), "Bookings")


LONG = C.FULL + "," + "lg AS (" + " UNION ALL ".join(
    f"SELECT Product, Division, Month, {i} AS candidate, '{name}' AS Regressor, {k} AS Lag, lag({name}, {k}) OVER (PARTITION BY Product, Division ORDER BY Month) AS x FROM full_fact"
    for i, (name, k) in enumerate((n, k) for n, ks in cfg.REGRESSOR_LAGS for k in ks) if name in ("New_Opportunities", "Open_Opportunities", "Bookings")
) + ")"


@query("regressor_quality", with_ctes(LONG, body="""SELECT *, n > 0 AND n_distinct > 1 AS usable FROM (
    SELECT Product, Division, candidate::BIGINT AS candidate, Regressor, Lag::BIGINT AS Lag, count(x) AS n, count(DISTINCT x) AS n_distinct FROM lg GROUP BY ALL)"""))
def regressor_quality(spark, sf):
    return L.regressor_quality(L.regressor_long(D.full_fact(spark, sf)))


@query("default_regressor", with_ctes(LONG, body="""SELECT Product, Division, Regressor, Lag::BIGINT AS Lag, n FROM (
    SELECT Product, Division, candidate, Regressor, Lag, count(x) AS n, count(DISTINCT x) AS nd FROM lg GROUP BY ALL) WHERE n > 0 AND nd > 1
  QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY n DESC, candidate) = 1"""))
def default_regressor(spark, sf):
    return L.default_regressor(D.full_fact(spark, sf))


@query("calendar_lags", with_ctes(C.PART_FACT, body="""SELECT Product, Division, Month, Actuals,
    max(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS lag_1,
    max(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 2 PRECEDING AND 2 PRECEDING) AS lag_2,
    max(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 3 PRECEDING AND 3 PRECEDING) AS lag_3,
    avg(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll_mean_3,
    avg(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS roll_mean_6,
    avg(Actuals) OVER (PARTITION BY Product, Division ORDER BY m RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS roll_mean_12
  FROM (SELECT *, year(Month) * 12 + month(Month) AS m FROM pf)"""), "roll_mean_3 roll_mean_6 roll_mean_12")
def calendar_lags(spark, sf):
    return L.month_lags(D.part_fact(spark, sf))


@query("chosen_regressor", with_ctes(LONG, body="""
  SELECT f.Product, f.Division, f.Month, f.Actuals, c.Regressor AS reg_name, c.Lag::BIGINT AS reg_lag, l.x FROM full_fact f
  JOIN (SELECT Product, Division, Regressor, Lag, candidate FROM (SELECT Product, Division, candidate, Regressor, Lag, count(x) AS n, count(DISTINCT x) AS nd FROM lg GROUP BY ALL)
    WHERE n > 0 AND nd > 1 QUALIFY row_number() OVER (PARTITION BY Product, Division ORDER BY n DESC, candidate) = 1) c ON c.Product = f.Product AND c.Division = f.Division
  JOIN lg l ON l.Product = f.Product AND l.Division = f.Division AND l.Month = f.Month AND l.candidate = c.candidate"""))
def chosen_regressor(spark, sf):
    fact = cut_lineage(D.full_fact(spark, sf))
    choice = L.default_regressor(fact).select(*SERIES, F.col("Regressor").alias("reg_name"), F.col("Lag").alias("reg_lag"))
    return L.regressor_for_choice(fact, choice)


@query("future_regressor", with_ctes(C.FULL, body="""SELECT Product, Division, (lm + to_months(h::INT))::DATE AS Month, h AS h, x FROM (
    SELECT Product, Division, max(Month) AS lm, arg_max(lb, Month) FILTER (WHERE lb IS NOT NULL) AS x FROM (
      SELECT Product, Division, Month, lag(Bookings, 1) OVER (PARTITION BY Product, Division ORDER BY Month) AS lb FROM full_fact) GROUP BY ALL),
  (SELECT unnest(range(1, 13)) AS h)"""))
def future_regressor(spark, sf):
    fact = cut_lineage(D.full_fact(spark, sf))
    choice = fact.select(*SERIES).distinct().withColumn("reg_name", F.lit("Bookings")).withColumn("reg_lag", F.lit(1))
    return L.future_regressor(L.regressor_for_choice(fact, choice)).select(*SERIES, "Month", "h", "x")


@query("skip_reasons", with_ctes(C.METRICS, ORDER_CELLS, body="""SELECT Product, Division, 'ALL' AS Model, Reason FROM (
    SELECT f.Product, f.Division, CASE WHEN any_value(c.Product) IS NULL THEN 'NO_ORDER_IN_FILE' WHEN count(DISTINCT f.Month) < 80 THEN 'INSUFFICIENT_HISTORY'
      WHEN count(m.Test_MAE) = 0 THEN 'FAILED' END AS Reason
    FROM fact f LEFT JOIN (SELECT * FROM cells WHERE Division <> 'R4') c ON c.Product = f.Product AND c.Division = f.Division
    LEFT JOIN metrics m ON m.Product = f.Product AND m.Division = f.Division GROUP BY f.Product, f.Division) WHERE Reason IS NOT NULL"""))
def skip_reasons(spark, sf):
    fact = cut_lineage(D.monthly_fact(spark, sf))
    orders = order_cells(fact).filter(codes.parse_order_cell(F.col("Chosen_Order"), 3).isNotNull())
    return P.skip_reasons(P.series_profile(fact), orders, D.simple_metrics(fact), cfg.BacktestConfig(min_rows=80))


@query("order_grid", with_ctes(C.FACT, body="""SELECT Product, Division, p, q, sp, sq, 1::BIGINT AS d, 1::BIGINT AS sd, 12::BIGINT AS s FROM (SELECT DISTINCT Product, Division FROM fact),
  (SELECT unnest(range(0, 3)) AS p), (SELECT unnest(range(0, 3)) AS q), (SELECT unnest(range(0, 2)) AS sp), (SELECT unnest(range(0, 2)) AS sq)"""))
def order_grid(spark, sf):
    return K.order_grid(D.monthly_fact(spark, sf).select(*SERIES).distinct())


@query("ets_grid", with_ctes(PROFILE, body="""SELECT Product, Division, error, trend, seasonal FROM profile,
  (SELECT unnest(['add', 'mul']) AS error), (SELECT unnest(['none', 'add', 'damped']) AS trend), (SELECT unnest(['none', 'add', 'mul']) AS seasonal)
  WHERE (nonnegative OR (error = 'add' AND seasonal <> 'mul')) AND (history_months >= 24 OR seasonal = 'none')"""))
def ets_grid(spark, sf):
    return K.ets_grid(P.series_profile(P.mark_prelaunch(spine(spark, sf))))


@query("month_parsing", """
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS snapshot_text, strftime(l_shipdate, '%m/%d/%Y') AS close_text, date_trunc('month', o_orderdate)::DATE AS snapshot_month,
    date_trunc('month', l_shipdate)::DATE AS target_month, last_day(l_shipdate::DATE) AS month_end,
    datediff('month', date_trunc('month', o_orderdate), date_trunc('month', l_shipdate)) AS months_between
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def month_parsing(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("snapshot_text"))
    rows = D.table(spark, sf, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "MM/dd/yyyy").alias("close_text")).join(
        o, F.col("l_orderkey") == F.col("o_orderkey")).select("snapshot_text", "close_text").distinct()
    snap, close = dates.parse_snapshot_month(F.col("snapshot_text")), dates.parse_close_month(F.col("close_text"))
    return rows.select("snapshot_text", "close_text", snap.alias("snapshot_month"), close.alias("target_month"),
                       dates.end_of_month(close).alias("month_end"), dates.month_diff(close, snap).alias("months_between"))
