"""The same load for several warehouse endpoints."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.config import Target
from reportloom.sinks.tables import Day, Layout, replace_all, replace_by_date
from reportloom.workspace import run_together


def planned_loads(targets: Sequence[Target], feeds: Sequence[str]) -> list[tuple[str, str, str]]:
    """(endpoint, feed, table) of every load; skips and table names are per endpoint."""
    return [
        (t.endpoint, feed, table)
        for t in targets
        for feed in feeds
        if (table := t.table_for(feed)) is not None
    ]


def load_feeds(
    staged: DataFrame, root: str, targets: Sequence[Target], feeds: Sequence[str],
    layout: Layout, keep: Mapping[str, Collection[Day]] | None = None,
) -> list[tuple[str, str, str]]:
    """Replace by date, at each endpoint, the tables of ``feeds``.

    ``staged`` is read once per load and only where its feed lies. It was written
    clustered as the tables are, so no load shuffles. ``keep`` has by path the days that
    stay, where they are known (see ``replace_by_date``).
    """
    loads = planned_loads(targets, feeds)
    layout = replace(layout, leading=())

    def load(endpoint: str, feed: str, table: str) -> None:
        rows = staged.filter(F.col("feed") == feed).drop("feed")
        path = f"{root}/{endpoint}/{table}"
        replace_by_date(rows, path, layout, clustered=True, keep=(keep or {}).get(path))

    run_together(staged.sparkSession, [partial(load, *each) for each in loads])
    return loads


def load_dimension(
    df: DataFrame, root: str, targets: Sequence[Target], name: str
) -> list[tuple[str, str, str]]:
    """Replace a dimension in full at each endpoint."""
    loads = planned_loads(targets, [name])
    run_together(
        df.sparkSession,
        [partial(replace_all, df, f"{root}/{e}/{table}") for e, _, table in loads],
    )
    return loads


def read_loads(
    spark: SparkSession, root: str, loads: Sequence[tuple[str, str, str]]
) -> list[tuple[str, str, str, DataFrame]]:
    """The tables that the loads filled."""
    return [(e, f, t, spark.read.parquet(f"{root}/{e}/{t}")) for e, f, t in loads]
