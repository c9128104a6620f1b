"""Column expressions on product codes, order cells and business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations in calendar order.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def normalize_code(c) -> Column:
    """Null to '', trimmed, numeric codes without a trailing '.0', upper case."""
    text = strip(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string"))
    return F.upper(F.regexp_replace(text, r"^(\d*)\.0$", "$1"))


def strip_prefix(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)^(PROD|ITEM)[_-]?", "")


def parse_fiscal_year(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\D", "")
    year = digits.try_cast("int")
    return F.when(year < 100, year + 2000).otherwise(year)


def parse_month_year(month: Column, fiscal_year: Column) -> Column:
    """First day of the month named by three letters and a fiscal-year text."""
    head = F.substring(normalize_code(month), 1, 3)
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), head)
    year = parse_fiscal_year(fiscal_year)
    return F.when(
        (number > 0) & year.between(1, 9999), F.make_date(year, number.cast("int"), F.lit(1))
    )


def parse_order_cell(c: Column, arity: int) -> Column:
    """'(2, 1, 0)' to an array of `arity` ints, null when the count differs."""
    found = F.regexp_extract_all(c, F.lit(r"(-?\d+)"), 1)
    return F.when(F.size(found) == arity, F.transform(found, lambda x: x.cast("int")))


def opportunity_key(account: Column, name: Column) -> Column:
    return F.concat_ws(
        "||", strip(F.coalesce(account, F.lit(""))), strip(F.coalesce(name, F.lit("")))
    )


def business_key(product: Column, bu: Column, month: Column, model_type: Column) -> Column:
    return F.concat_ws("|", product, bu, F.date_format(month, "MMM yy"), model_type)


def feature_mode(c: Column) -> Column:
    """'quantity' or 'revenue' ('dollars' means revenue); anything else is null."""
    mode = F.lower(strip(c))
    return F.when(mode == "dollars", "revenue").when(mode.isin("quantity", "revenue"), mode)
