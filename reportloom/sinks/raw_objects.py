"""Raw zone of whole objects: every content is kept once, under its SHA-256."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.sinks.tables import existing_table, read_table

_CONTENTS = "sha256 string, length long, content binary, shelf string"
_DELIVERIES = "path string, sha256 string, length long, run_date date, load string"


def keep_objects(objects: DataFrame, root: str, run_date: date, load: str = "daily") -> None:
    """Keep (path, content) byte by byte as delivered; a content that is there adds nothing.

    First the deliveries of the run are noted: path, checksum and length. Then the
    contents that the zone lacks are added, one of each checksum. Contents are only joined
    with the paths to add, so they are moved just where that list is too long to
    broadcast. A run that was cut short between the two steps is run again; one that
    runs twice notes the same deliveries. A row without content is left out. An object
    is held whole by one task; Spark refuses those of over 2 GB.
    """
    spark = objects.sparkSession
    held = objects.filter(F.col("content").isNotNull())
    keyed = held.select(
        "path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("length"),
        F.lit(run_date).alias("run_date"), F.lit(load).alias("load"),
    )
    deliveries = f"{root}/deliveries"
    (
        keyed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "load")
        .parquet(deliveries)
    )
    own = (F.col("run_date") == F.lit(run_date)) & (F.col("load") == load)
    new = read_table(spark, deliveries, _DELIVERIES).filter(own).groupBy("sha256").agg(F.min("path").alias("path"))
    contents = existing_table(spark, f"{root}/contents", _CONTENTS)
    if contents is not None:
        new = new.join(contents.select("sha256"), "sha256", "left_anti")
    # A path that is listed twice with one content adds it twice; readers take it once.
    added = (
        held.withColumn("sha256", F.sha2("content", 256))
        .join(new, ["path", "sha256"], "left_semi")
        .select("sha256", F.length("content").cast("long").alias("length"), "content")
        .withColumn("shelf", F.left("sha256", F.lit(2)))
    )
    added.write.mode("append").partitionBy("shelf").parquet(f"{root}/contents")


def read_objects(spark: SparkSession, root: str, run_date: date, load: str = "daily") -> DataFrame:
    """(path, length, sha256, content) as they were delivered to one run."""
    own = (F.col("run_date") == F.lit(run_date)) & (F.col("load") == load)
    delivered = read_table(spark, f"{root}/deliveries", _DELIVERIES).filter(own).select("path", "sha256", "length")
    contents = read_table(spark, f"{root}/contents", _CONTENTS).select("sha256", "content")
    return delivered.dropDuplicates(["path", "sha256"]).join(contents.dropDuplicates(["sha256"]), "sha256").select(
        "path", "length", "sha256", "content"
    )
