"""Column statistics that are kept by partition and put together when asked for."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.sinks.tables import Day, Layout, existing_table, in_partitions, replace_partitions

# Sketches of 2^14 registers: distinct counts within about 1 %.
SKETCH_BITS = 14


def _text(c: Column) -> Column:
    """``c`` as sketches take it: text that differs where values do."""
    return c.cast("string")


def partition_stats(rows: DataFrame, columns: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """One row per partition: ``n_rows``, and by column a struct of ``nulls``, ``least`` and
    ``most`` in its own type, and a ``sketch`` of its values. Only these are moved."""
    return rows.groupBy(*(F.col(p).alias(f"p_{p}") for p in partition_by)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(
            F.struct(
                F.count_if(F.col(c).isNull()).alias("nulls"), F.min(c).alias("least"), F.max(c).alias("most"),
                F.hll_sketch_agg(_text(F.col(c)), F.lit(SKETCH_BITS)).alias("sketch"),
            ).alias(c)
            for c in columns
        ),
    )


def merge_stats(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, NULLs, distinct values (from the united sketches), smallest and
    largest as text, over all partitions of ``parts``."""
    whole = parts.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *(
            F.struct(
                F.coalesce(F.sum(f"{c}.nulls"), F.lit(0)).alias("nulls"),
                F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}.sketch")), F.lit(0)).alias("distinct"),
                F.min(f"{c}.least").cast("string").alias("least"), F.max(f"{c}.most").cast("string").alias("most"),
            ).alias(c)
            for c in columns
        ),
    )
    laid_out = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"), F.col("n_rows").alias("row_count"), F.col(f"{c}.nulls").alias("null_count"),
                F.col(f"{c}.distinct").alias("distinct_count"), F.col(f"{c}.least").alias("min_value"),
                F.col(f"{c}.most").alias("max_value"),
            )
            for c in columns
        )
    )
    return whole.select(F.inline(laid_out))


def note_statistics(
    spark: SparkSession, table: DataFrame, layout: Layout, days: Collection[Day], columns: Sequence[str], path: str
) -> None:
    """Bring the statistics at ``path`` up to date after a run that replaced ``days``.

    Only partitions of these days are read, save where nothing is noted yet. ``table`` has
    its partition columns. Below ``path`` the folder ``partitions`` has a row for each
    partition of the table, ``columns`` what they come to together.
    """
    parts_path = f"{path}/partitions"
    keys = [f"p_{p}" for p in layout.partition_by]
    made = partition_stats(table, columns, layout.partition_by)
    if existing_table(spark, parts_path, made.schema) is not None:
        touched = in_partitions(table, layout, days)
        made = partition_stats(touched, columns, layout.partition_by)
    # A partition is a row: few files are enough.
    replace_partitions(made, parts_path, keys)
    parts = existing_table(spark, parts_path, made.schema)
    merge_stats(parts, columns).write.mode("overwrite").parquet(f"{path}/columns")


def exact_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, NULLs, distinct values counted in full, smallest and largest as text.

    One grouping per column, which reads that column alone and moves each of its values
    once per task; no row is multiplied.
    """

    def of(c: str) -> DataFrame:
        values = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        return values.agg(
            F.lit(c).alias("column_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("v").alias("distinct_count"),
            F.min("v").cast("string").alias("min_value"),
            F.max("v").cast("string").alias("max_value"),
        )

    return reduce(DataFrame.unionByName, map(of, columns))
