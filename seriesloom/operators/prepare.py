"""Raw merge and preparation of the monthly fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions import codes, dates, numeric
from seriesloom.schema import SERIES, by_month, of_series

RAW_KEYS = ["raw_product", "Division", "raw_month", "raw_fy"]


# ---- code to group -------------------------------------------------------
def catalog_lookup(catalog: DataFrame) -> DataFrame:
    """Catalog as one lookup table (kind, code, bu) -> group.

    kind 'sku_bu' keeps the last catalog row of a pair, kind 'sku' the first row of a code.
    `catalog_row` gives the row order.
    """
    rows = catalog.select(
        codes.normalize_code("business_unit_code").alias("bu"),
        codes.normalize_code("group_key").alias("grp"),
        "catalog_row",
        F.posexplode(F.split(F.coalesce("sku_list", F.lit("")), r"\|")).alias("pos", "sku"),
    ).withColumn("sku", codes.normalize_code("sku")).filter("grp <> ''")
    at = F.struct("catalog_row", "pos", "grp")
    keyed = rows.filter("sku <> ''")
    sku_bu = (
        keyed.filter("bu <> ''").groupBy(F.col("sku").alias("code"), "bu")
        .agg(F.max(at).alias("hit")).select(F.lit("sku_bu").alias("kind"), "code", "bu", "hit.grp")
    )
    sku = (
        keyed.groupBy(F.col("sku").alias("code")).agg(F.min(at).alias("hit"))
        .select(F.lit("sku").alias("kind"), "code", F.lit("").alias("bu"), "hit.grp")
    )
    group = rows.select(
        F.lit("group").alias("kind"), F.col("grp").alias("code"), F.lit("").alias("bu"), "grp"
    ).distinct()
    return sku_bu.unionByName(sku).unionByName(group)


def _stem(code: Column) -> Column:
    """Code without any of its prefixes: equal for a code, for the code without its prefix, and for what either matches."""
    return F.regexp_replace(code, r"(?i)^((PROD|ITEM)[_-]?)+", "")


def map_codes(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of `raw` with their group as Product, null where none is found, by six lookups in priority order.

    All catalog entries that a code can meet have its stem, so the lookups are one equi-join on the stem, to a list of the
    entries with that stem (spellings and units of one code). Rows move once and are neither made distinct nor exploded.
    """
    entry = F.struct("kind", "code", "bu", "grp")
    entries = catalog_lookup(catalog).withColumn("_stem", _stem(F.col("code"))).groupBy("_stem").agg(F.collect_list(entry).alias("_entries"))
    rows = raw.withColumn("_code", codes.normalize_code("raw_product")).withColumn("_stem", _stem(F.col("_code")))
    bu, bare = codes.normalize_code("Division"), codes.strip_prefix(F.col("_code"))

    def found(kind: str, code: Column, unit: Column) -> Column:
        return F.get(F.filter("_entries", lambda e: (e["kind"] == kind) & (e["code"] == code) & (e["bu"] == unit)), F.lit(0))["grp"]

    tries = [found(kind, code, unit) for code in (F.col("_code"), bare) for kind, unit in (("sku_bu", bu), ("sku", F.lit("")), ("group", F.lit("")))]
    return rows.join(entries, "_stem", "left").withColumn("Product", F.coalesce(*tries)).select(*raw.columns, "Product")


def resolve_extract(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows with complete keys, their group (null if unmapped), month and numeric value."""
    complete = raw.dropna(how="any", subset=RAW_KEYS).select(
        *RAW_KEYS, "source_sheet",
        codes.parse_month_year(F.col("raw_month"), F.col("raw_fy")).alias("Month"),
        numeric.to_number("value").alias("value"),
    )
    return map_codes(complete, catalog).select(*RAW_KEYS, "source_sheet", "Product", "Month", "value")


def mapped_rows(resolved: DataFrame, value_name: str) -> DataFrame:
    return resolved.dropna(how="any", subset=["Product", "Month"]).select(
        *SERIES, "Month", "source_sheet", F.col("value").alias(value_name)
    )


def rejected_rows(resolved: DataFrame) -> DataFrame:
    """Unmapped products and unreadable months, with the reason."""
    reason = F.when(F.col("Product").isNull(), "unmapped product").when(
        F.col("Month").isNull(), "bad month"
    )
    return resolved.withColumn("Reason", reason).filter("Reason is not null")


def merge_actuals_bookings(actuals: DataFrame, bookings: DataFrame, null_sum: str = "zero") -> DataFrame:
    """Full join of the two monthly sums. A month missing on one side stays null there.

    `null_sum`: what a month whose values are all null sums to ('zero' or 'null').
    """
    def total(df, c):
        s = F.sum(c)
        s = F.coalesce(s, F.lit(0.0)) if null_sum == "zero" else s
        return df.groupBy(*SERIES, "Month").agg(s.alias(c))

    merged = total(actuals, "Actuals").join(total(bookings, "Bookings"), [*SERIES, "Month"], "full")
    return merged.dropna(how="any", subset=[*SERIES, "Month"])


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Number of rows beyond the first of their (series, month)."""
    per_key = df.groupBy(*SERIES, "Month").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.col("n") - 1).alias("n_duplicates"),
    )


# ---- monthly fact --------------------------------------------------------
def collapse_months(df: DataFrame, sum_cols=("Actuals", "Bookings"), row_id: str | None = None) -> DataFrame:
    """One row per series and month: additive columns summed, others first non-null.

    'First' follows `row_id`; without one, the smallest value wins so that a rerun or a
    lost executor cannot change the answer.
    """
    keys = [*SERIES, "Month"]
    aggs = []
    for c in df.columns:
        if c in keys or c == row_id:
            continue
        if c in sum_cols:
            aggs.append(F.coalesce(F.sum(c), F.lit(0.0)).alias(c))
        elif row_id:
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(row_id))).alias(c))
        else:
            aggs.append(F.min(c).alias(c))
    return df.groupBy(*keys).agg(*aggs)


def completed_months(df: DataFrame, as_of) -> DataFrame:
    return df.filter(F.col("Month") <= dates.last_completed_month(as_of))


def mark_prelaunch(df: DataFrame) -> DataFrame:
    """Zeros before the first positive month become null; a series without one is all null."""
    first = F.min(F.when(F.col("Actuals") > 0, F.col("Month"))).over(of_series())
    return (
        df.withColumn("first_active", first)
        .withColumn(
            "Actuals",
            F.when(F.col("first_active").isNull(), None)
            .when((F.col("Month") < F.col("first_active")) & (F.col("Actuals") == 0), None)
            .otherwise(F.col("Actuals")),
        )
        .drop("first_active")
    )


def month_spine(df: DataFrame, first_month, last_month, fill: float = 0.0) -> DataFrame:
    """Every month between the bounds for every series; missing months get `fill`.

    Series are exploded over the calendar and joined back on their key, so nothing is crossed.
    """
    months = F.sequence(first_month, last_month, F.expr("interval 1 month"))
    spine = df.select(*SERIES).distinct().select(*SERIES, F.explode(months).alias("Month"))
    return spine.join(df, [*SERIES, "Month"], "left").withColumn(
        "Actuals", F.coalesce("Actuals", F.lit(fill))
    )


def prepare_fact(df: DataFrame, as_of, sum_cols=("Actuals", "Bookings")) -> DataFrame:
    return mark_prelaunch(completed_months(collapse_months(df, sum_cols), as_of))


# ---- gates ---------------------------------------------------------------
def series_profile(fact: DataFrame) -> DataFrame:
    """One row per series with the counts every gate needs."""
    y = F.col("Actuals")
    first_nonzero = F.min(F.when(y != 0, F.col("Month")))
    last = F.max(F.when(y.isNotNull(), F.col("Month")))
    return fact.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(y).alias("history_months"),
        first_nonzero.alias("first_nonzero"),
        last.alias("last_actual"),
        F.coalesce(dates.month_diff(last, first_nonzero), F.lit(-1)).alias("months_since_first"),
        F.count_distinct(y).alias("distinct_values"),
        F.coalesce(F.min(y) >= 0, F.lit(False)).alias("nonnegative"),
    )


def series_gates(profile: DataFrame, config: cfg.BacktestConfig = cfg.BacktestConfig()) -> DataFrame:
    """Which model families a series may use, and why not."""
    history, since = F.col("history_months"), F.col("months_since_first")
    sarima = (history >= config.min_history) & (since >= config.min_months_since_first)
    sarimax = sarima & (history >= config.min_history_regressor)
    return profile.select(
        *SERIES,
        "history_months",
        "months_since_first",
        (F.col("n_rows") >= config.min_rows).alias("enough_rows"),
        sarima.alias("allow_sarima"),
        sarimax.alias("allow_sarimax"),
        (history >= 24).alias("allow_ets_seasonal"),
        F.col("nonnegative").alias("allow_multiplicative"),
        F.when(~sarima, "N/A: history <12 months or first non-zero actual is <12 months ago.").alias("sarima_reason"),
        F.when(~sarimax & (history < config.min_history_regressor), "N/A: history <36 months; SARIMAX disabled.")
        .when(~sarimax, "N/A: SARIMA prerequisites not met.")
        .alias("sarimax_reason"),
    )


def skip_reasons(profile: DataFrame, orders: DataFrame, metrics: DataFrame,
                 config: cfg.BacktestConfig = cfg.BacktestConfig()) -> DataFrame:
    """Skipped series: no order, too short, or no model with a valid metric."""
    has_order = orders.select(*SERIES, F.lit(True).alias("has_order")).distinct()
    valid = metrics.groupBy(*SERIES).agg(F.count(numeric.finite("Test_MAE")).alias("n_valid"))
    reason = (
        F.when(F.col("has_order").isNull(), "NO_ORDER_IN_FILE")
        .when(F.col("n_rows") < config.min_rows, "INSUFFICIENT_HISTORY")
        .when(F.coalesce("n_valid", F.lit(0)) == 0, "FAILED")
    )
    return (
        profile.join(has_order, SERIES, "left").join(valid, SERIES, "left")
        .withColumn("Reason", reason).filter("Reason is not null")
        .select(*SERIES, F.lit("ALL").alias("Model"), "Reason")
    )


# ---- signals -------------------------------------------------------------
def join_signals(fact: DataFrame, summary: DataFrame) -> DataFrame:
    """Monthly signals onto the fact; a signal column replaces a fact column of the same name."""
    measures = [c for c in summary.columns if c not in ("group_key", "BU", "Month")]
    right = summary.select(
        codes.normalize_code("group_key").alias("_p"),
        codes.normalize_code("BU").alias("_d"),
        "Month",
        *measures,
    )
    left = fact.drop(*measures).withColumn("_p", codes.normalize_code("Product")).withColumn(
        "_d", codes.normalize_code("Division")
    )
    return left.join(right, ["_p", "_d", "Month"], "left").drop("_p", "_d")


def exog_coverage(fact: DataFrame, columns) -> DataFrame:
    """Share of months in which each regressor is present; below 0.7 it is flagged."""
    shares = fact.groupBy(*SERIES).agg(
        *[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns]
    )
    return shares.unpivot(SERIES, list(columns), "Regressor", "coverage").withColumn(
        "low_coverage", F.col("coverage") < 0.7
    )


def resolve_orders(base: DataFrame, overrides: DataFrame) -> DataFrame:
    """Order table with manual overrides replacing whole rows; keys are normalised."""
    def parsed(df):
        product = F.col("Product") if "Product" in df.columns else F.col("group_key")
        division = F.col("Division") if "Division" in df.columns else F.col("BU")
        return df.select(
            codes.normalize_code(product).alias("Product"),
            codes.normalize_code(division).alias("Division"),
            codes.parse_order_cell(F.col("Chosen_Order"), 3).alias("order"),
            codes.parse_order_cell(F.col("Chosen_Seasonal_Order"), 4).alias("seasonal"),
        ).filter("order is not null and seasonal is not null")

    o = parsed(overrides).withColumnsRenamed({"order": "o_order", "seasonal": "o_seasonal"})
    return parsed(base).join(o, SERIES, "full").select(
        *SERIES,
        F.coalesce("o_order", "order").alias("order"),
        F.coalesce("o_seasonal", "seasonal").alias("seasonal"),
        F.col("o_order").isNotNull().alias("overridden"),
    )


def series_list(catalog: DataFrame, division: str | None = None) -> DataFrame:
    """Distinct non-blank (product, division) pairs to process."""
    pairs = catalog.select(
        codes.normalize_code("group_key").alias("Product"),
        codes.normalize_code("business_unit_code").alias("Division"),
    ).filter("Product <> '' and Division <> ''")
    if division is not None:
        pairs = pairs.filter(F.col("Division") == division)
    return pairs.distinct()


def feature_modes(catalog: DataFrame) -> DataFrame:
    """Feature mode per series: the first catalog row decides; bad modes are kept as null."""
    return (
        catalog.select(
            codes.normalize_code("group_key").alias("Product"),
            codes.normalize_code("business_unit_code").alias("Division"),
            "catalog_row",
            codes.feature_mode(F.col("salesforce_feature_mode")).alias("mode"),
        )
        .groupBy(*SERIES)
        .agg(F.min_by("mode", "catalog_row").alias("mode"))
    )
