"""Cleaning of report text, all as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportloom.schemas import SALES_NUMBERS, SALES_WIDTH


def _without(c: Column, mark: str) -> Column:
    return F.replace(c, F.lit(mark), F.lit(""))


def clean_metric(c: Column) -> Column:
    """A number as the report prints it, without thousands commas and percent signs."""
    return _without(_without(c, ","), "%")


def clean_text(c: Column) -> Column:
    """Text without the percent sign, which the cooked files use as quote."""
    return _without(c, "%")


def blank_to_null(c: Column) -> Column:
    """NULL for empty or whitespace-only text; other text stays untrimmed."""
    return F.when(c.rlike(r"\S"), c)


def to_metric(c: Column, type_name: str) -> Column:
    return blank_to_null(clean_metric(c)).cast(type_name)


def strip_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]+", "")


def strip_tabs(c: Column) -> Column:
    return _without(c, "\t")


def surrogate_key(order_number: Column, financial_status: Column) -> Column:
    """md5 of the dash-free order number and the status; missing text counts as empty."""
    number = F.coalesce(_without(order_number, "-"), F.lit(""))
    return F.md5(F.concat(number, F.coalesce(financial_status, F.lit(""))))


def cap_width(names: Sequence[str], width: int = SALES_WIDTH) -> list[str]:
    """The leading columns that a sales load uses."""
    return list(names[:width])


def clean_sales_column(position: int, c: Column) -> Column:
    """Cleaned text of the sales column at ``position``."""
    return clean_metric(c) if position in SALES_NUMBERS else clean_text(c)
