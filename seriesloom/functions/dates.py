"""Month arithmetic and date parsing with fallback."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c) -> Column:
    return F.trunc(c, "MM")


def month_idx(c) -> Column:
    return F.year(c) * 12 + F.month(c)


def month_diff(later, earlier) -> Column:
    return month_idx(later) - month_idx(earlier)


def month_of_idx(idx: Column) -> Column:
    """Inverse of month_idx."""
    return F.make_date(
        F.floor((idx - 1) / 12).cast("int"), ((idx - 1) % 12 + 1).cast("int"), F.lit(1)
    )


def end_of_month(c) -> Column:
    return F.last_day(c)


def _parsed(c: Column, fmt: str) -> Column:
    first = F.try_to_timestamp(c, F.lit(fmt))
    return F.coalesce(first, F.try_to_timestamp(c)).cast("date")


def parse_snapshot_month(c: Column) -> Column:
    return month_start(_parsed(c, "yyyy-MM"))


def parse_close_month(c: Column) -> Column:
    return month_start(_parsed(c, "M/d/yyyy"))


def last_completed_month(as_of: date | str) -> Column:
    """Month before the one `as_of` falls in; the clock is never read."""
    return F.add_months(F.trunc(F.lit(as_of).cast("date"), "MM"), -1)


def run_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MMM")


def parse_run_label(label: Column) -> Column:
    return F.to_date(F.try_to_timestamp(label, F.lit("yyyy-MMM")))
