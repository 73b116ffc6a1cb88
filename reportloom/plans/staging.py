"""The part that the date-replacing loads share."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reportloom.config import LoadConfig
from reportloom.functions.dates import iso_date
from reportloom.operators.freshness import (
    ERROR,
    feeds_with_new_data,
    file_catalog,
    next_date_present,
    status_note,
)
from reportloom.sinks.control import (
    build_manifest,
    date_list,
    publish_date_lists,
    publish_manifests,
    publish_parts,
    publish_status,
    read_parts,
)
from reportloom.sinks.exports import export_cooked, export_folder
from reportloom.sinks.statistics import note_statistics
from reportloom.sinks.tables import (
    Day,
    Layout,
    ReconciliationError,
    compare_counts,
    counts_by,
    days_of,
    existing_table,
    in_partitions,
    read_table,
    replace_by_date,
    uncovered_days,
    write_checked,
)
from reportloom.sinks.targets import load_feeds, planned_loads
from reportloom.sinks.raw_objects import keep_objects
from reportloom.sources import ledger
from reportloom.sources.archives import scan_objects
from reportloom.sources.reports import union_objects
from reportloom.workspace import run_together


NEW_DATA = "New Data"
# Jobs whose note says only that there is new data; others list the feeds.
STORE_JOBS = ("sales", "installs")


@dataclass(frozen=True)
class LoadResult:
    """What a run found and where its table is."""

    status: str
    feeds: tuple[str, ...]
    table: DataFrame | None


def stage(cooked: DataFrame, path: str, layout: Layout) -> DataFrame:
    """Write cooked rows once, clustered as their table will be, and read them back.

    Everything after it (what is new, N tables) reads this copy instead of the
    reports, a lost executor does not bring the reports back, and this is the
    only shuffle of the rows in a load.
    """
    placed = layout.place(cooked)
    write_checked(placed, path, layout.leading, layout.partition_by)
    return layout.rows(read_table(cooked.sparkSession, path, placed.schema))


def read_published(spark: SparkSession, output_root: str, job: str) -> DataFrame:
    """The (feed, day, account) parts that earlier runs of a job published."""
    return read_parts(spark, f"{output_root}/control/{job}/published")


def processed_root(output_root: str, job: str) -> str:
    """Where a job puts the processed files that its manifests list."""
    return f"{output_root}/processed/{job}"


def processed_columns(rows: DataFrame) -> list[str]:
    """Fields of a processed file, in order: the rows without what its folder says."""
    return [c for c in rows.columns if c not in ("feed", "tenant")]


def note_status(spark: SparkSession, config: LoadConfig, job: str, status: str) -> None:
    note = spark.createDataFrame([(status,)], "status string")
    publish_status(note, f"{config.output_root}/control/{job}/status", job, config.run_date)


@contextmanager
def errors_noted(spark: SparkSession, config: LoadConfig, job: str) -> Iterator[None]:
    """Publish the status ``Error: <kind>`` of a job that fails, which ``route_feed`` sends to
    the branch ``error``; the error itself goes on."""
    try:
        yield
    except Exception as error:
        note_status(spark, config, job, f"{ERROR}: {type(error).__name__}")
        raise


def feeds_to_read(
    spark: SparkSession, config: LoadConfig, job: str, feeds: Sequence[str],
    folder: str, feed: Column, name: str,
) -> tuple[list[str], DataFrame | None]:
    """The feeds that have changed objects since they were loaded, and the listing that
    says so; all of them, and none, for a run that reads whatever there is.

    A feed is read whole or not at all, for all accounts and months of the run: a new
    day of one account needs the other accounts' rows of it, and what comes next is told
    by the days that are there. A feed that was read but not loaded is read again.
    """
    if not config.changed_only or config.date_format == "Range":
        return list(feeds), None
    # Kept before the reports are read: what changes in between is read again next time.
    path = f"{config.output_root}/control/{job}/listing"
    listing = ledger.list_objects(spark, config.tenants, folder, feed, name)
    listing.write.mode("overwrite").parquet(path)
    listed = read_table(spark, path, listing.schema)
    known = ledger.read_ledger(spark, f"{config.output_root}/control/{job}/objects")
    # At most one row per feed.
    changed = {r.feed for r in ledger.changed_feeds(listed, known).collect()}
    return [f for f in feeds if f in changed], listed


def note_loaded(config: LoadConfig, job: str, listed: DataFrame | None, feeds: Collection[str]) -> None:
    """Note the objects of the feeds that a run loaded, after all its writes."""
    if listed is not None and feeds:
        own = listed.filter(F.col("feed").isin(list(feeds)))
        ledger.note_objects(own, f"{config.output_root}/control/{job}/objects")


def nothing_new(spark: SparkSession, config: LoadConfig, job: str) -> LoadResult:
    """The end of a run that has nothing to load."""
    status = status_note(())
    note_status(spark, config, job, status)
    return LoadResult(status, (), None)


def keep_delivered(spark: SparkSession, config: LoadConfig, job: str, folder: str, name: str) -> None:
    """Keep the objects of a run as they were delivered, before anything is read from them."""
    if not config.keep_objects:
        return
    found = [
        scan_objects(spark, f"{root}/{folder}", F.col("_metadata.file_path").rlike(name))
        for root in dict.fromkeys(config.tenants.values())
    ]
    keep_objects(union_objects(found), objects_root(config, job), config.run_date, config.label())


def objects_root(config: LoadConfig, job: str) -> str:
    """Where a job keeps the objects as delivered."""
    return f"{config.output_root}/raw_objects/{job}"


def check_loaded(
    source: DataFrame, tables: Sequence[tuple[str, str | None, DataFrame]], feeds: Sequence[str], layout: Layout
) -> None:
    """Compare rows per feed and day of the source and of every table that it went to.

    ``tables`` are (path, feed, rows); no feed says that a table holds all ``feeds``. The
    source is counted once. Days that only a table has are of earlier runs.
    """
    spark = source.sparkSession
    day = layout.date_column
    counts = counts_by(source, ["feed", day])
    # One row per table and feed.
    places = [(path, f) for path, feed, _ in tables for f in ([feed] if feed else feeds)]
    goes_to = spark.createDataFrame(places, "path string, feed string")
    expected = counts.join(goes_to, "feed").select("path", "feed", day, "n")
    written = union_objects([
        rows.select(F.lit(path).alias("path"), (F.lit(feed) if feed else F.col("feed")).alias("feed"), day)
        for path, feed, rows in tables
    ])
    keys = ["path", "feed", day]
    counted = compare_counts(expected, counts_by(written, keys), keys)
    wrong = counted.filter((F.col("source_rows") > 0) & ~F.col("ok")).limit(5).collect()
    if wrong:
        raise ReconciliationError(f"{[tuple(r) for r in wrong]}")


def days_to_keep(
    spark: SparkSession, days: Collection[Day], layout: Layout, schema: StructType,
    table_path: str, endpoint_paths: Mapping[str, str],
) -> dict[str, set[Day]]:
    """By path the days that the tables of a run keep of the months it touches.

    ``days`` are (feed, day); ``endpoint_paths`` gives the feed of each table of one.
    """
    if layout.grain != "month":
        return {}
    single = replace(layout, leading=())
    one_feed = StructType([f for f in schema.fields if f.name != "feed"])
    olds = {}
    if (old := existing_table(spark, table_path, schema)) is not None:
        olds[table_path] = (old, layout, days)
    for path, feed in endpoint_paths.items():
        if (old := existing_table(spark, path, one_feed)) is not None:
            olds[path] = (old, single, {(day,) for name, day in days if name == feed})
    return uncovered_days(olds)


def touched_tables(
    spark: SparkSession, days: Collection[Day], layout: Layout, schema: StructType,
    table_path: str, endpoint_paths: Mapping[str, str],
) -> list[tuple[str, str | None, DataFrame]]:
    """(path, feed, rows) of every table of a run: the partitions of ``days`` only."""
    single = replace(layout, leading=())
    one_feed = StructType([f for f in schema.fields if f.name != "feed"])
    found = [(table_path, None, in_partitions(read_table(spark, table_path, schema), layout, days))]
    for path, feed in endpoint_paths.items():
        own = {(day,) for name, day in days if name == feed}
        found.append((path, feed, in_partitions(read_table(spark, path, one_feed), single, own)))
    return found


def load_new_feeds(
    spark: SparkSession,
    staged: DataFrame,
    published: DataFrame,
    config: LoadConfig,
    job: str,
    feeds: Sequence[str],
    layout: Layout,
    table_path: str,
) -> LoadResult:
    """Find which of ``feeds`` have new days, publish control data, replace the dates.

    The processed files of the new feeds are written and manifests list them, unless
    the run is told not to, as one may be that fills the table itself. The
    table at ``table_path`` holds all feeds. Each endpoint of the run gets tables of
    its own, one per feed, below ``tables`` of the output root. Every table is
    reconciled with the staged rows, and its statistics are noted.
    """
    control = f"{config.output_root}/control/{job}"
    catalog = file_catalog(staged.withColumnRenamed(layout.date_column, "report_date"))
    # One row per feed, day and account: small, used several times below.
    catalog.write.mode("overwrite").parquet(f"{control}/catalog")
    catalog = read_table(spark, f"{control}/catalog", catalog.schema)

    if config.date_format == "Range":
        names = tuple(sorted(feeds))
    else:
        presence = next_date_present(
            catalog, published, list(config.tenants), config.optional_tenants
        )
        # At most one row per feed that the load asks for.
        names = tuple(sorted(r.feed for r in feeds_with_new_data(presence).collect()))
    if not names:
        return nothing_new(spark, config, job)
    status = NEW_DATA if job in STORE_JOBS else status_note(names)

    new_feeds = spark.createDataFrame([(f,) for f in names], "feed string")
    new_parts = catalog.filter(F.col("feed").isin(list(names)))

    def note_manifests() -> None:
        url = export_folder(
            processed, F.col("feed"), iso_date(F.col("report_date")), F.col("tenant")
        )
        manifests = build_manifest(new_parts, url)
        publish_manifests(manifests, new_feeds, f"{control}/manifests", config.run_date)

    def note_dates() -> None:
        publish_date_lists(date_list(new_parts), f"{control}/dates", config.run_date)

    new_rows = staged.filter(F.col("feed").isin(list(names)))
    processed = processed_root(config.output_root, job)
    schema = layout.place(staged).schema
    tables = f"{config.output_root}/tables"
    endpoint_paths = {f"{tables}/{e}/{name}": feed for e, feed, name in planned_loads(config.targets, names)}
    days = days_of(new_parts.withColumnRenamed("report_date", layout.date_column), layout)
    keep = days_to_keep(spark, days, layout, schema, table_path, endpoint_paths)

    def export() -> None:
        fields = processed_columns(new_rows)
        text = new_rows.select(*(F.col(c).cast("string").alias(c) for c in fields), "feed", "tenant")
        export_cooked(text, processed, fields, layout.date_column, clustered=layout.grain == "day")

    def load() -> None:
        replace_by_date(new_rows, table_path, layout, clustered=True, keep=keep.get(table_path))

    def load_endpoints() -> None:
        load_feeds(new_rows, tables, config.targets, names, layout, keep)

    run_together(spark, [load, load_endpoints, *([export] if config.processed else [])])
    placed = read_table(spark, table_path, schema)
    table = layout.rows(placed)

    def check() -> None:
        check_loaded(new_rows, touched_tables(spark, days, layout, schema, table_path, endpoint_paths), names, layout)

    def measure() -> None:
        note_statistics(spark, placed, layout, days, processed_columns(table), f"{control}/statistics")

    run_together(spark, [check, measure])
    # What a run says is there is said once all of it is written and checked.
    run_together(spark, [note_dates, *([note_manifests] if config.processed else [])])
    note_status(spark, config, job, status)
    # Published last: a run that fails before it is simply run again.
    publish_parts(new_parts, f"{control}/published", config.run_date)
    return LoadResult(status, names, table)
