"""Control data of a run: manifests, date lists, status."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportloom.workspace import child_paths, remove_path

# Notes of what was published that may lie beside each other before they are folded.
MOST_NOTES = 32
PARTS = "feed string, report_date date, tenant string"
_RUNS = "feed string, tenant string, first_day date, last_day date"


def date_list(dates: DataFrame) -> DataFrame:
    """Per feed the days to replace: as array and as the text of an SQL IN list.

    A list is as long as the calendar, not as the data: equal days are merged
    before they are shuffled.
    """
    days = F.array_sort(F.collect_set(F.date_format("report_date", "yyyy-MM-dd")))
    quoted = F.concat(F.lit("('"), F.array_join("days", "','"), F.lit("')"))
    return (
        dates.filter(F.col("report_date").isNotNull())
        .groupBy("feed")
        .agg(days.alias("days"))
        .withColumn("date_list", quoted)
    )


def build_manifest(catalog: DataFrame, url: Column, mandatory: bool = True) -> DataFrame:
    """(feed, manifest) with one JSON entry per part of the catalog, in url order.

    ``catalog`` holds one row per (feed, day, account): a manifest grows with
    days × accounts only.
    """
    entry = [url.alias("url")]
    if mandatory:
        entry.append(F.lit(True).alias("mandatory"))
    entries = F.array_sort(F.collect_list(F.struct(*entry)))
    return catalog.groupBy("feed").agg(
        F.to_json(F.struct(entries.alias("entries"))).alias("manifest")
    )


def publish_manifests(
    manifests: DataFrame, feeds: DataFrame, path: str, run_date: date
) -> None:
    """Put in place the manifests of the feeds that have new data, and no others."""
    (
        manifests.join(feeds.select("feed"), "feed", "left_semi")
        .withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "feed")
        .text(path)
    )


def publish_date_lists(lists: DataFrame, path: str, run_date: date) -> None:
    """Put in place the date lists of a run."""
    (
        lists.select("feed", "days", "date_list")
        .withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "feed")
        .parquet(path)
    )


def publish_status(status: DataFrame, path: str, job: str, run_date: date) -> None:
    """Put in place the status note of one job and run."""
    (
        status.select("status")
        .withColumn("run_date", F.lit(run_date))
        .withColumn("job", F.lit(job))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "job")
        .parquet(path)
    )


def publish_parts(catalog: DataFrame, path: str, run_date: date) -> None:
    """Note which (feed, day, account) parts a run published.

    What an earlier run published stays published, also one of the same date. A run
    adds one file; ``fold_parts`` makes day runs of many. Readers take each part once.
    """
    noted = catalog.withColumn("run_date", F.lit(run_date)).coalesce(1)
    noted.write.mode("append").partitionBy("run_date").parquet(path)
    fold_parts(catalog.sparkSession, path)


def day_runs(parts: DataFrame) -> DataFrame:
    """Per feed and account the stretches of days without a gap: first and last day.

    A part without a day is a stretch without days.
    """
    # Distinct days of one feed and account: a calendar at most.
    by_day = Window.partitionBy("feed", "tenant").orderBy("report_date")
    numbered = parts.select("feed", "report_date", "tenant").distinct().withColumn("place", F.row_number().over(by_day))
    began = F.date_sub(F.col("report_date"), F.col("place"))
    return numbered.groupBy("feed", "tenant", began.alias("began")).agg(
        F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day")
    ).drop("began")


def run_days(runs: DataFrame) -> DataFrame:
    """The parts that day runs stand for."""
    day = F.explode_outer(F.sequence("first_day", "last_day", F.expr("interval 1 day")))
    return runs.select("feed", day.alias("report_date"), "tenant")


def _folded(path: str) -> str:
    return f"{path}_runs"


def _whole_folds(spark: SparkSession, path: str) -> list[str]:
    """The folds whose writing ended; each is a folder of its own."""
    folds = child_paths(spark, _folded(path))
    return [f for f in folds if f"{f}/_SUCCESS" in child_paths(spark, f)]


def _note_files(spark: SparkSession, path: str) -> list[str]:
    days = [d for d in child_paths(spark, path) if "/run_date=" in d]
    return [f for d in days for f in child_paths(spark, d) if f.endswith(".parquet")]


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The (feed, day, account) parts that runs have published, each once."""
    folds, notes = _whole_folds(spark, path), _note_files(spark, path)
    parts = spark.createDataFrame([], PARTS)
    if folds:
        parts = parts.unionByName(run_days(spark.read.schema(_RUNS).parquet(*folds)))
    if notes:
        parts = parts.unionByName(spark.read.schema(PARTS).parquet(*notes))
    return parts.distinct()


def fold_parts(spark: SparkSession, path: str, most: int = MOST_NOTES) -> None:
    """Fold more than ``most`` notes of what was published into one set of day runs.

    The new fold holds all that the notes and folds it was made of say, and only
    these are removed, after it is whole. So a run that ends in between, or another
    that folds or notes at the same time, leaves repeated parts but loses none.
    """
    notes = _note_files(spark, path)
    if len(notes) <= most:
        return
    folds = _whole_folds(spark, path)
    parts = spark.read.schema(PARTS).parquet(*notes)
    if folds:
        parts = parts.unionByName(run_days(spark.read.schema(_RUNS).parquet(*folds)))
    day_runs(parts).coalesce(1).write.parquet(f"{_folded(path)}/{uuid4().hex}")
    for old in [*notes, *folds]:
        remove_path(spark, old)
    for day in {n.rpartition("/")[0] for n in notes}:
        if not _visible(child_paths(spark, day)):
            remove_path(spark, day)


def _visible(paths: list[str]) -> list[str]:
    """Files of data; checksums and marks are hidden."""
    return [p for p in paths if p.rpartition("/")[2][0] not in "._"]


def read_status(spark: SparkSession, path: str, job: str, run_date: date) -> DataFrame:
    """The status note of one job and run."""
    notes = spark.read.schema("status string, run_date date, job string").parquet(path)
    wanted = (F.col("job") == job) & (F.col("run_date") == F.lit(run_date))
    return notes.filter(wanted).select("status")


def read_dates(spark: SparkSession, path: str, run_date: date) -> DataFrame:
    """(feed, report_date) of the date lists of one run."""
    schema = "days array<string>, date_list string, run_date date, feed string"
    lists = spark.read.schema(schema).parquet(path)
    days = lists.filter(F.col("run_date") == F.lit(run_date)).select(
        "feed", F.explode("days").alias("day")
    )
    return days.select("feed", F.col("day").cast("date").alias("report_date"))
