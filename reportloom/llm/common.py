"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportloom.workspace import new_folder

# White space between words, as the word patterns of the operators have it.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Rows between two marks of a running sum.
ROWS_BETWEEN_MARKS = 20_000
# Parts that a group's values are cut into to spread them evenly.
QUANTILES = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Hand this package to the executors, whose Python may not have it on its path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        # Spark itself brings the file to each executor.
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow``, with this package at hand in the workers."""
    _ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a short lineage that
    survives lost executors, and a size that Spark knows when it plans joins."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column) -> Column:
    """Words of ``text`` between ASCII white space; a null or blank text has none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARACTERS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text in joins and groupings; null is a text of its own."""
    return F.struct(
        F.xxhash64(text, F.lit(0)).alias("a"), F.xxhash64(F.lit(1), text).alias("b")
    )


def even_number(*parts: Column) -> Column:
    """A number in (0, 1) that depends on ``parts`` alone: 52 bits of an MD5 digest."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def even_spread(df: DataFrame, group: str, column: str, out: str) -> DataFrame:
    """Add ``out``: a number from 0 to 1 that rises with ``column`` and is about even within
    each group (compared null-safe), whatever the distribution.

    Each group's quantiles, one row of ``QUANTILES`` + 1 numbers, are gathered from partial
    ones; between two of them values count as even. ``df`` should be cheap to read twice.
    """
    steps = [i / QUANTILES for i in range(QUANTILES + 1)]
    marks = df.groupBy(F.col(group).alias("__g")).agg(
        F.percentile_approx(column, F.array(*map(F.lit, steps)), F.lit(20 * QUANTILES)).alias("__marks")
    )
    # Written, so that Spark knows how small it is and need not move the rows to it.
    marks = settle(marks, "quantiles")
    value = F.col(column)
    passed = F.size(F.filter("__marks", lambda m: m <= value))
    held = df.join(marks, F.col(group).eqNullSafe(F.col("__g")), "left")
    held = held.withColumn("__bin", F.least(F.greatest(passed, F.lit(1)), F.lit(QUANTILES)))
    low, high = F.get("__marks", F.col("__bin") - 1), F.get("__marks", F.col("__bin"))
    part = F.when(high > low, F.least(F.greatest((value - low) / (high - low), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return held.withColumn(out, (F.col("__bin") - 1 + part) / QUANTILES).drop("__marks", "__bin", "__g")


def running_sum(
    df: DataFrame, group: Sequence[str], order: Sequence[str], spread: str, value: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group that come earlier.

    Rows are ordered by ``order``, whose first column must rise with ``spread``, a
    number from 0 to 1 that is spread about evenly. A group is cut into marked
    stretches of ``spread`` of some ``ROWS_BETWEEN_MARKS`` rows; sums up to each
    mark come from one row per stretch, so no task sorts a whole group, however
    large. Groups compare null-safe. ``df`` should be cheap to read twice.
    """
    names = [F.col(g) for g in group]
    counts = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows"))
    counts = counts.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.ceil(F.col("__rows") / ROWS_BETWEEN_MARKS).cast("long").alias("__marks"),
    )
    # Written, so that Spark knows how small it is and need not move the rows to it.
    counts = settle(counts, "group-marks")
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    marked = df.join(counts, _all(same), "left").withColumn(
        "__stretch",
        F.least(F.floor(F.col(spread) * F.col("__marks")), F.col("__marks") - 1).cast("long"),
    )
    marked = marked.drop("__marks", *[f"__g{i}" for i in range(len(group))])
    sums = marked.groupBy(*names, "__stretch").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*names).orderBy("__stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sums.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col("__stretch").alias("__s"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"),
    )
    sums = settle(sums, "stretch-sums")
    same = [*same, F.col("__stretch") == F.col("__s")]
    within = Window.partitionBy(*names, "__stretch").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    inner = marked.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (
        inner.join(sums, _all(same), "left")
        .withColumn(out, F.col("__before") + F.col("__within"))
        .drop("__stretch", "__s", "__before", "__within", *[f"__g{i}" for i in range(len(group))])
    )


def _all(conditions: Sequence[Column]) -> Column:
    met = F.lit(True)
    for condition in conditions:
        met = met & condition
    return met
