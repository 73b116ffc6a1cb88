"""Which objects an earlier run has already loaded, told by path, length and time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.sinks.tables import existing_table
from reportloom.sources.reports import union_objects
from reportloom.workspace import path_exists

OBJECT = ["path", "length", "modified"]
_LISTING = "path string, length long, modified timestamp"
_LEDGER = f"{_LISTING}, feed string"


def list_objects(spark: SparkSession, roots: Mapping[str, str], folder: str, feed: Column, name: str) -> DataFrame:
    """(path, length, modified, feed) of the objects below ``folder`` of every account
    whose path fits ``name``. No object is opened; an account without the folder has none."""
    found = [f"{r}/{folder}" for r in dict.fromkeys(roots.values()) if path_exists(spark, f"{r}/{folder}")]
    if not found:
        return spark.createDataFrame([], _LEDGER)
    listed = [
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .filter(F.col("_metadata.file_path").rlike(name))
        .select("path", "length", F.col("modificationTime").alias("modified"))
        for root in found
    ]
    return union_objects(listed).withColumn("feed", feed)


def changed_feeds(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Feeds of the listing that have an object which the ledger lacks, or holds with
    another length or time. Objects that are gone change nothing."""
    return listing.join(ledger.select("feed", *OBJECT), ["feed", *OBJECT], "left_anti").select("feed").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The objects that were loaded; none where nothing was noted yet."""
    noted = existing_table(spark, path, _LEDGER)
    return spark.createDataFrame([], _LEDGER) if noted is None else noted


def note_objects(listing: DataFrame, path: str) -> None:
    """Put these objects in place of what the ledger holds of their feeds.

    A feed's entries are those of its last load, so the ledger does not grow with runs.
    """
    (
        listing.select(*OBJECT, "feed")
        .repartition("feed")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("feed")
        .parquet(path)
    )
