"""Row filters of the report loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_repeated_headers(lines: DataFrame) -> DataFrame:
    """Keep line 0 of each text and drop every later line that holds ``Date,``."""
    return lines.filter((F.col("line_no") == 0) | ~F.contains("line", F.lit("Date,")))


def drop_header_lines(lines: DataFrame) -> DataFrame:
    """Drop every line that holds ``Date,``: for lines read below the header of their file."""
    return lines.filter(~F.contains("line", F.lit("Date,")))


def _unless_restricted(
    tenant: Column, restricted: Mapping[str, str], keep
) -> Column:
    condition = F.lit(True)
    for label, product in restricted.items():
        condition = condition & ((tenant != label) | keep(product))
    return condition


def keep_product(
    df: DataFrame, restricted: Mapping[str, str], product: str, tenant: str = "tenant"
) -> DataFrame:
    """Rows of restricted accounts only when their product id is the allowed one."""
    c = F.coalesce(F.col(product), F.lit(""))
    return df.filter(
        _unless_restricted(F.col(tenant), restricted, lambda app: c == app)
    )


def keep_product_mention(
    df: DataFrame,
    restricted: Mapping[str, str],
    columns: Sequence[str],
    tenant: str = "tenant",
) -> DataFrame:
    """Rows of restricted accounts only when some field mentions the allowed id."""
    line = F.lower(F.concat_ws(",", *columns))
    return df.filter(
        _unless_restricted(
            F.col(tenant), restricted, lambda app: F.contains(line, F.lit(app.lower()))
        )
    )


def in_text_month(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text date fits a month pattern such as ``Feb%2021``."""
    return df.filter(F.col(column).like(pattern))
