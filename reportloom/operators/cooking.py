"""From raw report rows to typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.functions.clean import (
    blank_to_null,
    clean_metric,
    clean_text,
    surrogate_key,
)
from reportloom.functions.dates import (
    parse_auto_date,
    required_date,
    required_time,
    strict_report_date,
)
from reportloom.schemas import (
    EARNINGS_AMOUNT_TYPE,
    EARNINGS_AMOUNTS,
    EARNINGS_COLUMNS,
    EARNINGS_DAY,
    SALES_COLUMNS,
    SALES_DATE,
    SALES_NUMBERS,
    FeedSpec,
)


def _bare(c: Column) -> Column:
    """A date or time as it is written: no spaces around it, blanks as NULL."""
    return blank_to_null(F.trim(c))


def typed(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Cleaned and typed columns of text ones; ``columns`` gives (kind, type) by name.

    Two steps, so that a cleaned value is computed once although the second step
    looks at it twice. Other columns of ``df`` stay. A ``date`` has to be an ISO one in
    every row; an ``any_date`` and a ``time`` are in any accepted spelling or blank.
    """
    clean = {"metric": clean_metric, "text": clean_text, "date": lambda c: c}
    parse = {"any_date": required_date, "time": required_time}

    def value(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        kind, type_name = columns[name]
        if kind == "date":
            return strict_report_date(F.col(name))
        if kind in parse:
            return parse[kind](F.col(name))
        return blank_to_null(F.col(name)).cast(type_name)

    cleaned = df.select(
        *(clean.get(columns[c][0], _bare)(F.col(c)).alias(c) if c in columns else c for c in df.columns)
    )
    return cleaned.select(*(value(c).alias(c) for c in df.columns))


def cook_feeds(raw: DataFrame, specs: Sequence[FeedSpec]) -> DataFrame:
    """Typed rows of all ``specs`` in one pass over ``raw`` (feed, tenant, c0, c1, …).

    Feeds may keep a column at different positions; a column that a feed does
    not have is NULL for its rows. A row that has more fields than its feed fails.
    """
    for spec in specs:
        surplus = [F.col(c) for c in raw.columns if c[:1] == "c" and c[1:].isdigit() and int(c[1:]) >= spec.width]
        if surplus:
            # An empty field in quotes is a field too.
            wide = (F.col("feed") == spec.name) & F.coalesce(*surplus).isNotNull()
            told = F.raise_error(F.lit(f"more than {spec.width} columns in feed {spec.name}")).cast("boolean")
            raw = raw.filter(F.when(wide, told).otherwise(True))
    columns: dict[str, tuple[str, str]] = {}
    places: dict[str, dict[int, list[str]]] = {}
    for spec in specs:
        for column in spec.columns:
            if columns.setdefault(column.name, (column.kind, column.type)) != (
                column.kind, column.type,
            ):
                raise ValueError(f"feeds disagree on what {column.name!r} holds")
            places.setdefault(column.name, {}).setdefault(column.source, []).append(spec.name)

    def pick(by_place: dict[int, list[str]]) -> Column:
        if [len(specs)] == [len(feeds) for feeds in by_place.values()]:
            return F.col(f"c{next(iter(by_place))}")
        return F.coalesce(
            *(F.when(F.col("feed").isin(f), F.col(f"c{i}")) for i, f in by_place.items())
        )

    named = raw.select(
        *(pick(by_place).alias(name) for name, by_place in places.items()), "tenant", "feed"
    )
    return typed(named, columns)


def cook_sales(raw: DataFrame, names: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Keyed, cleaned and typed sales rows from raw ones (tenant, c0 … c16).

    ``names`` are the table's names for the report's columns, in their order.
    """
    columns = {
        name: ("metric" if i in SALES_NUMBERS else "text", SALES_NUMBERS.get(i, "string"))
        for i, name in enumerate(names)
    }
    columns[names[SALES_DATE]] = ("date", "date")
    key = surrogate_key(F.col("c0"), F.col("c3")).alias("sale_key")
    named = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    return typed(raw.select(key, *named, "tenant"), columns)


def cook_earnings(raw: DataFrame) -> DataFrame:
    """Earnings rows with blanks as NULL and typed amounts; text dates are kept, the day
    that they name is added."""

    def value(name: str) -> Column:
        c = blank_to_null(F.col(name))
        return c.cast(EARNINGS_AMOUNT_TYPE) if name in EARNINGS_AMOUNTS else c

    day = parse_auto_date(F.col("transaction_date")).alias(EARNINGS_DAY)
    return raw.select(*(value(n).alias(n) for n in EARNINGS_COLUMNS), day, "tenant")


def cook_devices(raw: DataFrame) -> DataFrame:
    """Device rows with blanks as NULL."""
    return raw.select(*(blank_to_null(F.col(n)).alias(n) for n in raw.columns))
