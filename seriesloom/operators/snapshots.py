"""Pipeline snapshots: history cells, slippage, snapshot features and as-of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import config as cfg
from seriesloom.functions import codes, dates, numeric
from seriesloom.functions.lineage import cut_lineage, stored
from seriesloom.schema import SERIES

LINE_KEY = ["code_raw", "name_raw", "bu"]
CELL = [*SERIES, "snapshot_month", "target_month"]


RAW_KEY = ["Product Code", "Current OSC Product Name", "Business Unit", "Month", "Close Date", "_source_file"]
TEXTS = ["Business Unit", "Month", "Close Date"]
MEASURED = ["n1", "n2", "s1", "s2", "w1", "w2", "fq", "fr", "swr"]


def _text(lines: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").cast("string") if name in lines.columns else F.lit(None).cast("string")


def _line_key(lines: DataFrame) -> list[Column]:
    return [
        _text(lines, "Product Code").alias("code_raw"),
        _text(lines, "Current OSC Product Name").alias("name_raw"),
        codes.normalize_code(_text(lines, "Business Unit")).alias("bu"),
        dates.parse_snapshot_month(_text(lines, "Month")).alias("snapshot_month"),
        dates.parse_close_month(_text(lines, "Close Date")).alias("target_month"),
    ]


def _numbers(lines: DataFrame) -> list[Column]:
    has = set(lines.columns)

    def num(name) -> Column:
        return numeric.to_number(F.col(f"`{name}`")) if name in has else F.lit(None).cast("double")

    prob = num("Probability") / 100.0
    if "Probability" not in has:
        revenue = F.lit(None).cast("double")
    elif "Total Price" in has:
        revenue = num("Total Price") * prob
    else:
        revenue = num("Factored Revenue")
    return [
        num("Quantity").alias("q1"),
        num("Quantity W/ Decimal").alias("q2"),
        prob.alias("prob"),
        num("Factored Quantity").alias("fq"),
        num("Factored Revenue").alias("fr"),
        revenue.alias("swr"),
    ]


def clean_lines(lines: DataFrame) -> DataFrame:
    """One pass over the snapshot lines: months, numbers and match keys. Optional columns may be absent."""
    return lines.select(
        *_line_key(lines), *_numbers(lines),
        codes.opportunity_key(_text(lines, "Account Name"), _text(lines, "Opportunity Name")).alias("opp_key"),
        _text(lines, "_source_file").alias("source_file"),
    ).filter("target_month is not null")


def line_cells(lines: DataFrame) -> DataFrame:
    """Counts and sums per line key, file, snapshot and target, each as its text and as it reads.

    Lines are summed by their texts as they are; the few texts that are left are parsed then, not every line.
    """
    raw = lines.select(*[_text(lines, c).alias(c) for c in RAW_KEY], *_numbers(lines)).groupBy(*[f"`{c}`" for c in RAW_KEY]).agg(
        F.count("q1").alias("n1"), F.count("q2").alias("n2"), F.sum("q1").alias("s1"), F.sum("q2").alias("s2"),
        F.sum(F.col("q1") * F.col("prob")).alias("w1"), F.sum(F.col("q2") * F.col("prob")).alias("w2"),
        F.sum("fq").alias("fq"), F.sum("fr").alias("fr"), F.sum("swr").alias("swr"),
    )
    texts = [F.col(c).alias(f"{c} text") for c in TEXTS]
    return raw.select(*_line_key(raw), F.col("_source_file").alias("source_file"), *texts, *MEASURED).filter("target_month is not null")


def series_aliases(series: DataFrame, aliases: DataFrame) -> DataFrame:
    """Codes a series answers to: its own and the alias names of its (group, unit)."""
    own = series.select(*SERIES, codes.normalize_code("Product").alias("alias"))
    named = aliases.select(
        codes.normalize_code("group_key").alias("Product_n"),
        codes.normalize_code("business_unit_code").alias("Division_n"),
        codes.normalize_code("salesforce_product_name").alias("alias"),
    )
    extra = series.withColumn("Product_n", codes.normalize_code("Product")).withColumn(
        "Division_n", codes.normalize_code("Division")
    ).join(named, ["Product_n", "Division_n"]).select(*SERIES, "alias")
    return own.unionByName(extra).filter("alias <> ''").distinct()


def _number_token(c: Column) -> Column:
    n = numeric.to_number(c)
    return F.when(n.isNotNull(), F.concat(F.lit("N:"), n.cast("string")))


def match_lines(cleaned: DataFrame, alias_rows: DataFrame) -> DataFrame:
    """(line key -> series). A line matches by numeric code, code text or product name.

    Only the distinct line keys are matched, by one equi-join on match tokens; an OR condition
    would be a nested loop over the lines.
    """
    keys = cleaned.select(*LINE_KEY).distinct()
    code, name = codes.normalize_code("code_raw"), codes.normalize_code("name_raw")
    tokens = F.array_compact(F.array_distinct(F.array(
        F.concat(F.lit("C:"), code), _number_token(F.col("code_raw")), F.concat(F.lit("C:"), name)
    )))
    alias_tokens = F.array_compact(F.array(F.concat(F.lit("C:"), F.col("alias")), F.when(
        F.col("alias").rlike(r"^\d+\.?\d*$|^\.\d+$"), _number_token(F.col("alias")))))
    right = alias_rows.select(
        *SERIES, codes.normalize_code("Division").alias("bu"), F.explode(alias_tokens).alias("token")
    )
    left = keys.select(*LINE_KEY, F.explode(tokens).alias("token"))
    return left.join(right, ["bu", "token"]).select(*LINE_KEY, *SERIES).distinct()


def _null_safe(on):
    return [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on]


def _attach_series(cells: DataFrame, matches: DataFrame) -> DataFrame:
    out = cells.alias("l").join(matches.alias("r"), _null_safe(LINE_KEY))
    keep = [F.col(f"l.{c}") for c in cells.columns if c not in LINE_KEY]
    return out.select(*[F.col(f"r.{c}") for c in SERIES], *keep)


def opportunity_counts(lines: DataFrame, cells: DataFrame, matches: DataFrame) -> DataFrame:
    """Lines per (series, opportunity, snapshot, target): all that slippage reads of them.

    `cells` holds each text of a unit or month with what it reads as, so that a line looks its texts up.
    """
    keys = [F.col(c).alias(f"k_{c}") for c in ("code_raw", "name_raw", "Business Unit text")]
    of_key = stored(_attach_series(cells.select(*LINE_KEY, *keys).distinct(), matches))
    snapshots = stored(cells.filter("snapshot_month is not null").select(F.col("Month text").alias("s_text"), "snapshot_month").distinct())
    targets = stored(cells.select(F.col("Close Date text").alias("t_text"), "target_month").distinct())
    named = ("Product Code", "Current OSC Product Name", "Business Unit", "Month", "Close Date")
    rows = lines.select(*[_text(lines, c).alias(c) for c in named], codes.opportunity_key(
        _text(lines, "Account Name"), _text(lines, "Opportunity Name")).alias("opp_key"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in zip(named, ("k_code_raw", "k_name_raw", "`k_Business Unit text`"), strict=False)]
    rows = rows.join(of_key, same).join(snapshots, F.col("Month") == F.col("s_text")).join(targets, F.col("`Close Date`") == F.col("t_text"))
    return rows.groupBy(*SERIES, "opp_key", "snapshot_month", "target_month").agg(F.count(F.lit(1)).alias("n"))


def history_cells(rows: DataFrame) -> DataFrame:
    """Five summed measures per (series, snapshot, target).

    The quantity column is chosen per file and series: the first one with any value. Sums come first, so that what is
    moved to one place for a series has at most a row for each of its files, snapshots and targets.
    """
    per_file = rows.groupBy(*SERIES, "source_file", "snapshot_month", "target_month").agg(
        *[F.sum(c).alias(c) for c in MEASURED]
    ).repartition(*SERIES)
    file_w = Window.partitionBy(*SERIES, "source_file")
    use1 = (F.max("n1").over(file_w) > 0) | (F.max("n2").over(file_w) == 0)
    zero = F.lit(0.0)
    picked = per_file.withColumn("use1", use1).select(
        *CELL,
        F.when(F.col("use1"), F.col("s1")).otherwise(F.col("s2")).alias("pipeline_qty"),
        F.col("fq").alias("pipeline_factored_qty"),
        F.col("fr").alias("pipeline_factored_revenue"),
        F.when(F.col("use1"), F.col("w1")).otherwise(F.col("w2")).alias("pipeline_stage_weighted_qty"),
        F.col("swr").alias("pipeline_stage_weighted_revenue"),
    )
    return picked.groupBy(*CELL).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in cfg.CELL_MEASURES])


def slippage(counts: DataFrame) -> DataFrame:
    """Median month shift of the target of the same opportunity, per (series, snapshot).

    Lines of an opportunity are ordered by snapshot, then target. An opportunity with any share of all lines is a short
    run of (snapshot, target, count): one line of a count shifts from the target before it, its other lines by 0. Shifts
    are counted before the median is taken, so that a group of it holds a row for each different shift. A hash of the
    opportunity stands first, so that most comparisons of the sort are of one number; the keys themselves decide.
    """
    counts = counts.withColumn("opp_hash", F.xxhash64(*SERIES, "opp_key"))
    in_order = Window.partitionBy("opp_hash", *SERIES, "opp_key").orderBy("snapshot_month", "target_month")
    moved = dates.month_diff("target_month", F.lag("target_month").over(in_order))
    shifts = F.array(F.struct(F.col("moved").alias("slip"), F.lit(1).cast("long").alias("k")),
                     F.struct(F.lit(0).alias("slip"), (F.col("n") - 1).alias("k")))
    each = counts.select(*SERIES, "snapshot_month", "n", moved.alias("moved")).filter("moved is not null or n > 1").select(
        *SERIES, "snapshot_month", F.inline(shifts))
    return each.filter("slip is not null and k > 0").groupBy(*SERIES, "snapshot_month", "slip").agg(F.sum("k").alias("k")).groupBy(
        *SERIES, "snapshot_month").agg(F.percentile("slip", 0.5, F.col("k")).alias("slippage_months"), F.sum("k").alias("n_shifts"))


def history_without_slippage(lines: DataFrame, series: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows and measures of the snapshot history, for readers that need no slippage: opportunities are not counted."""
    cells = cut_lineage(line_cells(lines))
    return history_cells(_attach_series(cells, cut_lineage(match_lines(cells, series_aliases(series, aliases)))))


def cells_and_slippage(lines: DataFrame, series: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells with the series they belong to (a cell may belong to several), and the slippage of the lines.

    The lines are read twice, both times narrow: one pass sums measures, one counts opportunities.
    """
    cells = cut_lineage(line_cells(lines))
    matches = cut_lineage(match_lines(cells, series_aliases(series, aliases)))
    return _attach_series(cells, matches), slippage(opportunity_counts(lines, cells, matches))


def load_history(lines: DataFrame, series: DataFrame, aliases: DataFrame) -> DataFrame:
    """Snapshot history of all series."""
    rows, slips = cells_and_slippage(lines, series, aliases)
    return history_cells(rows).join(slips.drop("n_shifts"), [*SERIES, "snapshot_month"], "left")


# ---- snapshot features ---------------------------------------------------
def with_primary(history: DataFrame, modes: DataFrame) -> DataFrame:
    """Primary measures by feature mode; series without a valid mode are left out."""
    qty = F.col("mode") == "quantity"
    return history.join(modes.filter("mode is not null"), SERIES).withColumns(
        {
            "pipeline_primary": F.when(qty, F.col("pipeline_factored_qty")).otherwise(F.col("pipeline_factored_revenue")),
            "pipeline_stage_weighted_primary": F.when(qty, F.col("pipeline_stage_weighted_qty")).otherwise(
                F.col("pipeline_stage_weighted_revenue")
            ),
        }
    )


def snapshot_metrics(primary: DataFrame, from_snapshot: bool = True) -> DataFrame:
    """Per (series, snapshot): sums due within 1-3 months, plain, stage-weighted and slip-adjusted."""
    rows = primary.filter("snapshot_month is not null")
    if from_snapshot:
        rows = rows.filter("target_month >= snapshot_month")
    rows = rows.withColumn("slip", F.coalesce(F.bround("slippage_months").cast("int"), F.lit(0)))
    ahead = dates.month_diff("target_month", "snapshot_month")
    p, sw = F.col("pipeline_primary"), F.col("pipeline_stage_weighted_primary")
    aggs = [F.max("slip").alias("slippage_months")]
    for k in (1, 2, 3):
        aggs += [
            F.sum(F.when(ahead <= k, p).otherwise(0.0)).alias(f"pipeline_due_{k}m"),
            F.sum(F.when(ahead <= k, sw).otherwise(0.0)).alias(f"pipeline_stage_weighted_due_{k}m"),
            F.sum(F.when(ahead + F.col("slip") <= k, p).otherwise(0.0)).alias(f"pipeline_slip_adjusted_due_{k}m"),
        ]
    return rows.groupBy(*SERIES, "snapshot_month").agg(*aggs)


def slip_adjusted(primary: DataFrame, from_snapshot: bool = True) -> DataFrame:
    """Primary measure at the target month shifted by the snapshot's slippage."""
    rows = primary.filter("snapshot_month is not null")
    if from_snapshot:
        rows = rows.filter("target_month >= snapshot_month")
    slip = F.coalesce(F.bround("slippage_months").cast("int"), F.lit(0))
    return rows.groupBy(
        *SERIES, "snapshot_month", F.add_months("target_month", slip).alias("target_month")
    ).agg(F.sum("pipeline_primary").alias("pipeline_slip_adjusted_primary"))


def anchor_lags(fact: DataFrame, anchors: DataFrame) -> DataFrame:
    """Calendar lags and means before each anchor month; the anchor need not be a month of the fact.

    Anchors join the months of their series as rows without a value, and RANGE frames that end one
    month earlier read them.
    """
    rows = fact.select(*SERIES, "Month", F.col("Actuals").alias("y"), F.lit(False).alias("is_anchor")).unionByName(
        anchors.select(*SERIES, F.col("anchor").alias("Month"), F.lit(None).cast("double").alias("y"),
                       F.lit(True).alias("is_anchor")).distinct()
    ).withColumn("m", dates.month_idx("Month"))
    w = Window.partitionBy(*SERIES).orderBy("m")
    cols = {f"lag_{k}": F.max("y").over(w.rangeBetween(-k, -k)) for k in (1, 2, 3)}
    cols |= {f"roll_mean_{k}": F.avg("y").over(w.rangeBetween(-k, -1)) for k in (3, 6, 12)}
    first = F.min(F.when(~F.col("is_anchor"), F.col("m"))).over(Window.partitionBy(*SERIES))
    cols["trend_idx"] = F.col("m") - 1 - first
    return rows.withColumns(cols).filter("is_anchor").select(*SERIES, F.col("Month").alias("anchor"), *cols)


def asked_cells(rows: DataFrame, asked: Column, from_snapshot: bool) -> DataFrame:
    """Values of the (snapshot, target) cells that `asked`, an array of months, names for each snapshot of a series.

    All rows of a series are in one place, at most one for each snapshot and target. Sums per snapshot are windows there.
    Every row then gives its values to its own cell, to the same target one snapshot later and to the target shifted by
    the slippage; the first row of a snapshot also gives its sums to the cells asked for. One grouping of these parts, in
    the same place, takes the part of three joins.
    """
    snap = Window.partitionBy(*SERIES, "snapshot_month")
    measures = [*cfg.CELL_MEASURES, "pipeline_primary", "pipeline_stage_weighted_primary"]
    eligible = F.col("target_month") >= F.col("snapshot_month") if from_snapshot else F.lit(True)
    ahead = dates.month_diff("target_month", "snapshot_month")
    p, sw, slip = F.col("pipeline_primary"), F.col("pipeline_stage_weighted_primary"), F.col("slip")
    sums = {"slippage_months": F.max(F.when(eligible, slip)).over(snap), "first_target": F.min("target_month").over(snap)}
    for k in (1, 2, 3):
        for name, value, months in (("", p, ahead), ("stage_weighted_", sw, ahead), ("slip_adjusted_", p, ahead + slip)):
            due = F.sum(F.when(eligible, F.when(months <= k, value).otherwise(0.0)))
            sums[f"pipeline_{name}due_{k}m"] = due.over(snap)
    rows = rows.withColumn("slip", F.coalesce(F.bround("slippage_months").cast("int"), F.lit(0))).withColumns(sums)
    per_snapshot = [x for x in sums if x != "first_target"]

    def part(snapshot: Column, target: Column, given: dict[str, Column]) -> Column:
        kinds = {x: "double" for x in [*measures, "prior_pipeline_primary", "pipeline_slip_adjusted_primary", *per_snapshot]}
        kinds |= {"slippage_months": "int", "is_asked": "boolean"}
        values = [given.get(x, F.lit(None)).cast(kind).alias(x) for x, kind in kinds.items()]
        return F.struct(snapshot.alias("snapshot_month"), target.alias("target_month"), *values)

    at, target = F.col("snapshot_month"), F.col("target_month")
    here = part(at, target, {x: F.col(x) for x in measures})
    later = part(F.add_months(at, 1), target, {"prior_pipeline_primary": p})
    shifted = part(at, F.add_months(target, slip), {"pipeline_slip_adjusted_primary": F.when(eligible, p)})
    seen = {"is_asked": F.lit(True)} | {x: F.col(x) for x in per_snapshot}
    wanted = F.when(target == F.col("first_target"), F.transform(asked, lambda month: part(at, month, seen)))
    parts = F.concat(F.array(here, later, shifted), F.coalesce(wanted, F.array()))
    each = rows.select(*SERIES, "mode", F.explode(parts).alias("e")).select(*SERIES, "mode", "e.*")
    zero = F.lit(0.0)
    return each.groupBy(*SERIES, "mode", "snapshot_month", "target_month").agg(
        *[F.coalesce(F.max(x), zero).alias(x) for x in [*measures, "prior_pipeline_primary"]],
        F.coalesce(F.sum("pipeline_slip_adjusted_primary"), zero).alias("pipeline_slip_adjusted_primary"),
        *[F.max(x).alias(x) for x in per_snapshot], F.max("is_asked").alias("is_asked"),
    ).filter("is_asked").drop("is_asked")


def _by_series(primary: DataFrame) -> DataFrame:
    return primary.filter("snapshot_month is not null").repartition(*SERIES)


def _features(cells: DataFrame, summary) -> DataFrame:
    """Feature columns derived from the values of asked cells and the lags at their anchors."""
    delta = F.col("pipeline_primary") - F.col("prior_pipeline_primary")
    out = cells.withColumns(
        {
            "months_ahead": dates.month_diff("target_month", "snapshot_month"),
            "target_month_num": F.month("target_month"),
            "delta_pipeline": delta,
            "pct_delta_pipeline": numeric.ratio(delta, F.col("prior_pipeline_primary")),
            "pipeline_coverage": numeric.ratio(F.col("pipeline_primary"), F.col("roll_mean_12")),
        }
    )
    if summary is not None:
        present = [c for c in cfg.SUMMARY_MEASURES if c in summary.columns]
        right = summary.select(
            F.col("group_key").alias("Product_n"), F.col("BU").alias("Division_n"),
            F.col("Month").alias("snapshot_month"), *[F.col(c).alias(f"summary_{c}") for c in present],
        )
        out = (
            out.withColumn("Product_n", codes.normalize_code("Product"))
            .withColumn("Division_n", codes.normalize_code("Division"))
            .join(right, ["Product_n", "Division_n", "snapshot_month"], "left")
            .drop("Product_n", "Division_n")
        )
        null = F.lit(None).cast("double")
        by_qty = F.col("summary_Sum_Quantity") if "Sum_Quantity" in present else null
        by_price = F.col("summary_Sum_Total_Price") if "Sum_Total_Price" in present else null
        main = F.when(F.col("mode") == "quantity", by_qty).otherwise(by_price)
        out = out.withColumn("summary_primary", main).withColumn(
            "summary_primary_coverage", numeric.ratio(F.col("summary_primary"), F.col("roll_mean_12"))
        )
    return out


def feature_frame(fact, history, modes, summary=None, horizon: int = 12, from_snapshot: bool = True) -> DataFrame:
    """Training features per (series, snapshot, target): targets 0..horizon months ahead with a known actual.

    The targets of a snapshot are listed and met with the fact by an equi-join on the month, not by a range join.
    """
    primary = with_primary(history, modes)
    targets = F.transform(F.sequence(F.lit(0), F.lit(horizon)), lambda h: F.add_months("snapshot_month", h))
    known = fact.filter("Actuals is not null").select(
        *SERIES, F.col("Month").alias("target_month"), F.col("Actuals").alias("actuals")
    )
    anchors = history.filter("snapshot_month is not null").select(*SERIES, F.col("snapshot_month").alias("anchor"))
    lags = anchor_lags(fact, anchors).withColumnRenamed("anchor", "snapshot_month")
    cells = (
        asked_cells(_by_series(primary), targets, from_snapshot)
        .join(known, [*SERIES, "target_month"])
        .join(lags, [*SERIES, "snapshot_month"], "left")
    )
    return _features(cells, summary)


def latest_snapshots(history: DataFrame) -> DataFrame:
    """Rows of the newest snapshot of each series."""
    newest = F.max("snapshot_month").over(Window.partitionBy(*SERIES))
    return history.withColumn("newest", newest).filter("snapshot_month = newest").drop("newest")


def future_frame(fact, history, modes, summary=None, horizon: int = 12) -> DataFrame:
    """Features of the next `horizon` months seen from the newest snapshot of each series.

    Lags are anchored at the earlier of snapshot - 1 and the last known month; targets before the
    snapshot are kept.
    """
    last = fact.filter("Actuals is not null").groupBy(*SERIES).agg(F.max("Month").alias("last_month"))
    anchor = F.least(F.col("snapshot_month"), F.add_months("last_month", 1))
    rows = _by_series(with_primary(history, modes)).join(last, SERIES)
    rows = rows.withColumn("newest", F.max("snapshot_month").over(Window.partitionBy(*SERIES)))
    months = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: F.add_months("last_month", h))
    asked = F.when(F.col("snapshot_month") == F.col("newest"), months)
    newest = history.groupBy(*SERIES).agg(F.max("snapshot_month").alias("snapshot_month")).join(last, SERIES)
    anchors = newest.filter("snapshot_month is not null").select(*SERIES, anchor.alias("anchor"))
    cells = asked_cells(rows, asked, from_snapshot=False)
    # A series has one newest snapshot, hence one anchor.
    return _features(cells.join(anchor_lags(fact, anchors).drop("anchor"), SERIES, "left"), summary)


def snapshot_coverage(series: DataFrame, history: DataFrame, summary: DataFrame) -> DataFrame:
    """Snapshot and signal rows available per series, with the reason a series is skipped."""
    h = history.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("history_rows"),
                                     F.count_distinct("snapshot_month").alias("n_snapshots"))
    s = summary.groupBy(F.col("group_key").alias("p"), F.col("BU").alias("d")).agg(F.count(F.lit(1)).alias("summary_rows"))
    out = (
        series.join(h, SERIES, "left")
        .join(s, (codes.normalize_code(series["Product"]) == s["p"]) & (codes.normalize_code(series["Division"]) == s["d"]), "left")
        .drop("p", "d")
        .na.fill(0, ["history_rows", "n_snapshots", "summary_rows"])
    )
    reason = F.when(F.col("summary_rows") == 0, "No summary data for product/BU.").when(
        F.col("history_rows") == 0, "No pipeline history rows."
    )
    return out.withColumn("Reason", reason)


# ---- as-of features ------------------------------------------------------
def asof_snapshot(fact: DataFrame, history: DataFrame, lags=(1, 2, 3)) -> DataFrame:
    """Newest snapshot no later than (target - lag) per (series, target, lag).

    Snapshots and questions are ordered together on the month; the last snapshot seen so far is
    the answer, so nothing is joined on an inequality.
    """
    asks = fact.select(*SERIES, F.col("Month").alias("target_month"), F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag"))
    asks = asks.select(*SERIES, "target_month", "lag", F.lit(None).cast("date").alias("snapshot_month"),
                       (dates.month_idx("target_month") - F.col("lag")).alias("m"), F.lit(1).alias("kind"))
    snaps = history.filter("snapshot_month is not null").select(*SERIES, "snapshot_month").distinct()
    snaps = snaps.select(*SERIES, F.lit(None).cast("date").alias("target_month"), F.lit(None).cast("int").alias("lag"),
                         "snapshot_month", dates.month_idx("snapshot_month").alias("m"), F.lit(0).alias("kind"))
    w = Window.partitionBy(*SERIES).orderBy("m", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return (
        asks.unionByName(snaps)
        .withColumn("snap", F.last("snapshot_month", True).over(w))
        .filter("kind = 1")
        .select(*SERIES, "target_month", "lag", F.col("snap").alias("snapshot_month"),
                dates.month_diff("target_month", "snap").alias("snapshot_age"))
    )


ASOF_MEASURES = ["pipeline_primary", "pipeline_stage_weighted_primary", *cfg.CELL_MEASURES]
ASOF_DUE = [f"pipeline_{kind}due_{k}m" for k in (1, 2, 3) for kind in ("", "stage_weighted_")]


def asof_features(fact: DataFrame, history: DataFrame, modes: DataFrame, lags=(1, 2, 3)) -> DataFrame:
    """Target lags, calendar and as-of pipeline columns per (series, month)."""
    from seriesloom.operators.lags import target_lags

    primary = with_primary(history, modes)
    due = snapshot_metrics(primary, from_snapshot=False).select(*SERIES, "snapshot_month", *ASOF_DUE)
    found = (
        asof_snapshot(fact, primary, lags).filter("snapshot_month is not null")
        .join(primary.select(*CELL, *ASOF_MEASURES), CELL, "left")
        .join(due, [*SERIES, "snapshot_month"], "left")
    )
    values = [*ASOF_MEASURES, *ASOF_DUE, "snapshot_age"]
    wide = found.groupBy(*SERIES, F.col("target_month").alias("Month")).agg(
        *[F.max(F.when(F.col("lag") == k, F.col(c))).alias(f"{c}_lag{k}") for k in lags for c in values]
    )
    out = target_lags(fact.select(*SERIES, "Month", "Actuals")).join(wide, [*SERIES, "Month"], "left")
    seen = F.coalesce(*[F.col(f"{c}_lag{k}").cast("double") for k in lags for c in values])
    return out.withColumn("pipeline_missing_flag", seen.isNull().cast("int"))
