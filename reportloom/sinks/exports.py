"""Text files that other systems load: cooked CSV, raw copies."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from reportloom.sinks.tables import read_table, spread

EXPORT_KEYS = ("p_feed", "p_date", "p_tenant")
EARNINGS_KEYS = ("p_tenant", "p_month")


def export_cooked(
    df: DataFrame, path: str, columns, date_column: str = "c0", clustered: bool = False
) -> None:
    """Cooked text rows, one folder per (feed, day, account).

    Folders that ``df`` has rows for are replaced, all others stay. UTF-8, comma, ``%`` as quote and only where needed. The folders are named
    after copies of the keys, so the date stays the first field of the file.
    """
    keyed = df.select(
        *columns,
        F.col("feed").alias("p_feed"),
        F.col(date_column).alias("p_date"),
        F.col("tenant").alias("p_tenant"),
    )
    out = keyed if clustered else spread(keyed, *EXPORT_KEYS)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*EXPORT_KEYS)
        .option("quote", "%")
        .option("escape", "%")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_folder(root: str, feed: Column, iso_day: Column, tenant: Column) -> Column:
    """The folder in which ``export_cooked`` puts one (feed, day, account)."""
    return F.concat(
        F.lit(f"{root}/p_feed="), feed, F.lit("/p_date="), iso_day,
        F.lit("/p_tenant="), tenant,
    )


def _report_writer(df: DataFrame) -> DataFrameWriter:
    """Overwrites CSV as the reports have it: a header, quotes doubled."""
    return (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def export_earnings(df: DataFrame, path: str, columns: Sequence[str], month: str) -> None:
    """Unzipped earnings rows of one month, one folder per account and month.

    Folders that ``df`` has rows for are replaced, all others stay.
    """
    keyed = df.select(*columns, F.col("tenant").alias("p_tenant"), F.lit(month).alias("p_month"))
    writer = _report_writer(spread(keyed, *EARNINGS_KEYS)).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*EARNINGS_KEYS).csv(path)


def earnings_folder(root: str, tenant: Column, month: str) -> Column:
    """The folder in which ``export_earnings`` puts one account and month."""
    return F.concat(F.lit(f"{root}/p_tenant="), tenant, F.lit(f"/p_month={month}"))


def export_dimension(df: DataFrame, path: str) -> None:
    """The whole of a dimension, in place of what the folder held."""
    _report_writer(df).csv(path)


def keep_raw(raw: DataFrame, path: str, run_date: date, load: str = "daily") -> DataFrame:
    """Keep raw rows as they came, under date and label of the run; read them back.

    A rerun of one load on the same date replaces what it kept before; other loads
    of that date, say of older months, keep theirs.
    """
    kept = raw.withColumn("run_date", F.lit(run_date)).withColumn("load", F.lit(load))
    (
        kept.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "load")
        .parquet(path)
    )
    rows = read_table(raw.sparkSession, path, kept.schema)
    own = (F.col("run_date") == F.lit(run_date)) & (F.col("load") == load)
    return rows.filter(own).drop("run_date", "load")
