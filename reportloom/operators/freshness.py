"""Which (feed, day, account) parts exist, and which feeds have new complete days."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["feed", "report_date", "tenant"]


def file_catalog(df: DataFrame) -> DataFrame:
    """The (feed, day, account) parts that ``df`` has rows for."""
    return df.select(*KEYS).distinct()


def feed_dates(df: DataFrame) -> DataFrame:
    """The days that each feed has rows for."""
    return df.select("feed", "report_date").distinct()


def published_parts(catalog: DataFrame, published: DataFrame) -> DataFrame:
    """The parts of ``catalog`` that are already published."""
    return catalog.join(published.select(*KEYS), KEYS, "left_semi")


def _all_of(tenants: Collection[str], condition: Column) -> Column:
    """Whether every account has a row of the group that meets the condition."""
    everyone = F.lit(True)
    for t in tenants:
        hit = F.coalesce(condition & (F.col("tenant") == t), F.lit(False))
        everyone = everyone & F.bool_or(hit)
    return everyone


def _local_days(
    parts: DataFrame,
    published: DataFrame,
    tenants: Sequence[str],
    required: Collection[str],
) -> DataFrame:
    """Per feed and local day: is it published, is it local, for all accounts.

    One aggregation, of which a task sends one row per feed and day, however many
    rows ``parts`` has for them.
    """
    both = parts.select(*KEYS, F.lit(True).alias("local")).unionByName(
        published.select(*KEYS, F.lit(False).alias("local"))
    )
    days = both.groupBy("feed", "report_date").agg(
        F.bool_or("local").alias("is_local"),
        _all_of(tenants, ~F.col("local")).alias("published"),
        _all_of(required, F.col("local")).alias("present"),
    )
    return days.filter("is_local")


def latest_complete_date(
    parts: DataFrame, published: DataFrame, tenants: Sequence[str]
) -> DataFrame:
    """Newest local day of each feed that is published for every account.

    The day counts when it is local for any account; only what is published has
    to be complete.
    """
    days = _local_days(parts, published, tenants, ())
    return (
        days.filter("published").groupBy("feed").agg(F.max("report_date").alias("latest_date"))
    )


def next_date_present(
    parts: DataFrame,
    published: DataFrame,
    tenants: Sequence[str],
    optional: Collection[str] = (),
) -> DataFrame:
    """Per feed: the day expected next, and whether all required accounts have it.

    The expected day follows the latest complete one; without one it is the
    oldest local day. Accounts in ``optional`` count for completeness only.
    """
    required = [t for t in tenants if t not in optional]
    # A feed's days are a calendar at most, so one task can walk them.
    by_day = Window.partitionBy("feed").orderBy("report_date")
    day = F.col("report_date")
    follows = F.lead(day).over(by_day) == F.date_add(day, 1)
    days = _local_days(parts, published, tenants, required).select(
        "feed",
        "report_date",
        "present",
        F.when(F.col("published"), day).alias("complete_day"),
        F.coalesce(follows & F.lead("present").over(by_day), F.lit(False)).alias("next_present"),
    )
    latest = F.max("complete_day")
    return days.groupBy("feed").agg(
        latest.alias("latest_date"),
        F.coalesce(F.date_add(latest, 1), F.min(day)).alias("next_date"),
        F.coalesce(
            F.max_by("next_present", "complete_day"), F.min_by("present", "report_date")
        ).alias("is_new"),
    )


def feeds_with_new_data(presence: DataFrame) -> DataFrame:
    """Feeds to load. A run over an explicit month range does not ask; it loads all."""
    return presence.filter("is_new").select("feed")


# What the note of a run that failed begins with.
ERROR = "Error"


def status_note(feeds: Sequence[str]) -> str:
    """The status note for these new feeds."""
    return str(sorted(feeds)) if feeds else "No New Data"


def status_text(feeds: DataFrame) -> DataFrame:
    """One row: the status note for the feeds of a frame."""
    names = F.array_sort(F.collect_set("feed"))
    listed = F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
    return feeds.agg(
        F.when(F.size(names) > 0, listed).otherwise("No New Data").alias("status")
    )


def sales_status_code(has_sales: Column, has_installs: Column, load: Column) -> Column:
    """1 for both, 2 for sales, 3 for installs, 0 for nothing new."""
    sales = has_sales & load.isin("both", "sales")
    installs = has_installs & load.isin("both", "installs")
    return F.when(sales & installs, 1).when(sales, 2).when(installs, 3).otherwise(0)


def route_feed(status: Column, feed: Column) -> Column:
    """The branch a feed takes for a status note: new, no_new or error."""
    listed = F.contains(status, F.concat(F.lit("'"), feed, F.lit("'")))
    return (
        F.when(F.startswith(status, F.lit(ERROR)), "error")
        .when(listed, F.concat(F.lit("new_"), feed, F.lit("_crashes")))
        .otherwise(F.concat(F.lit("no_new_"), feed, F.lit("_crashes")))
    )


def all_tenants_present(
    files: DataFrame, group: str, pattern: Column, tenants: Sequence[str]
) -> DataFrame:
    """Per group: whether each account has a file (column ``name``) of the pattern."""
    return files.groupBy(group).agg(
        _all_of(tenants, F.rlike("name", pattern)).alias("file_found")
    )
