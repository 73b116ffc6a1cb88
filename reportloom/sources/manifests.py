"""Loads that read exactly the files a manifest lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.schemas import MANIFEST_SCHEMA
from reportloom.workspace import path_exists


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(url, mandatory) of a manifest; an entry without the flag is optional."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", MANIFEST_SCHEMA).alias("m"))
    return parsed.select(F.inline("m.entries")).select(
        "url", F.coalesce("mandatory", F.lit(False)).alias("mandatory")
    )


def manifest_paths(spark: SparkSession, path: str) -> list[str]:
    """Paths to load: every mandatory one, and the optional ones that exist.

    A manifest is one small document, a list of paths that the reader has to be
    given, so it is collected. A missing mandatory path fails in the reader.
    """
    entries = read_manifest(spark, path).collect()
    return [e.url for e in entries if e.mandatory or path_exists(spark, e.url)]


def load_from_manifest(
    spark: SparkSession, path: str, reader: Callable[[list[str]], DataFrame]
) -> DataFrame | None:
    """What ``reader`` makes of the listed files; None when nothing is to be read."""
    paths = manifest_paths(spark, path)
    return reader(paths) if paths else None
