"""Partitioned Parquet tables: replace by date, by month or in full, and checks."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reportloom.functions.dates import text_month
from reportloom.workspace import new_folder, path_exists, remove_folder, remove_partition

TEXT_MONTH = "transaction_month"
# Leading columns and date of a day, as text.
Day = tuple[str, ...]
# The month whose load brought a row; its text date may say another.
LOAD_MONTH = "load_month"


@dataclass(frozen=True)
class Layout:
    """How a table that is replaced by date is partitioned.

    ``day``: one partition per day; a replace reads no old rows. Right when a day
    holds hundreds of megabytes. ``month``: one per month, 30 times fewer folders
    and commits; a replace carries over the days of a touched month that the
    batch does not have, and reads no old rows when it has them all, as reports
    that come by the month do.
    """

    date_column: str
    leading: tuple[str, ...] = ("feed",)
    grain: str = "month"

    def __post_init__(self) -> None:
        if self.grain not in ("day", "month"):
            raise ValueError(f"unknown grain {self.grain!r}, expected 'day' or 'month'")

    @property
    def month_column(self) -> str:
        return f"{self.date_column}_month"

    @property
    def keys(self) -> list[str]:
        """What one replaced day is known by."""
        return [*self.leading, self.date_column]

    @property
    def partition_by(self) -> list[str]:
        if self.grain == "day":
            return self.keys
        return [*self.leading, self.month_column]

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` with the column that partitions it."""
        if self.grain == "day":
            return df
        month = F.date_format(self.date_column, "yyyy-MM")
        return df.withColumn(self.month_column, month)

    def rows(self, df: DataFrame) -> DataFrame:
        """``df`` without the column that only partitions it."""
        return df.drop(self.month_column)


class ReconciliationError(RuntimeError):
    """Rows written and rows read back differ."""


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of a key together before a partitioned write.

    A rebalance, not a plain repartition: Spark merges small keys into one task
    and splits a key that holds much of the data over many.
    """
    return df.hint("rebalance", *(F.col(k) for k in keys))


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table under its own schema, so that partition values keep their types."""
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """A whole table, in place of what the path held."""
    out = spread(df, *partition_by) if partition_by else df
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], clustered: bool = False
) -> None:
    """Replace the partitions that ``df`` has rows for and leave all others.

    One commit removes the old rows of these partitions and adds the new ones,
    so ``df`` has to hold the rows of every account. An empty ``df`` changes
    nothing. ``clustered`` says that equal keys already lie together.
    """
    out = df if clustered else spread(df, *partition_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def existing_table(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, None when there is none yet."""
    return read_table(spark, path, schema) if path_exists(spark, path) else None


def days_of(df: DataFrame, layout: Layout) -> set[Day]:
    """The (feed, day) keys of ``df`` as text: at most feeds × calendar, for the driver."""
    keys = [F.col(k).cast("string") for k in layout.keys]
    return {tuple(r) for r in df.select(*keys).distinct().collect()}


def _among(days: Collection[Day], layout: Layout, column: str, part: Callable[[str], object]) -> Column:
    """Whether a row's leading columns and ``column`` are those of one of ``days``."""
    wanted: dict[Day, set] = {}
    for *leading, day in days:
        if None not in (*leading, day):
            wanted.setdefault(tuple(leading), set()).add(part(day))
    found = F.lit(False)
    for leading, values in sorted(wanted.items()):
        same = F.col(column).isin(sorted(values))
        for name, value in zip(layout.leading, leading, strict=True):
            same = same & (F.col(name) == value)
        found = found | same
    return found


def in_partitions(df: DataFrame, layout: Layout, days: Collection[Day]) -> DataFrame:
    """Rows of the partitions that ``days`` lie in; the others are not read. ``df`` has the
    columns that partition it."""
    if layout.grain == "month":
        return df.filter(_among(days, layout, layout.month_column, lambda day: day[:7]))
    return df.filter(_among(days, layout, layout.date_column, date.fromisoformat))


def uncovered_days(
    olds: Mapping[str, tuple[DataFrame, Layout, Collection[Day]]],
) -> dict[str, set[Day]]:
    """For each table the days that a batch leaves in the months it touches.

    ``olds`` has, by any name, the table as it is, its layout and the days of the batch.
    One query looks at the key columns of the touched partitions of all tables.
    """
    keep: dict[str, set[Day]] = {name: set() for name in olds}
    found = [
        old.filter(_among(days, layout, layout.month_column, lambda day: day[:7]))
        .select(F.lit(name).alias("name"), F.array(*(F.col(k).cast("string") for k in layout.keys)).alias("day"))
        for name, (old, layout, days) in olds.items()
    ]
    if found:
        for row in reduce(DataFrame.unionByName, found).distinct().collect():
            day = tuple(row.day)
            if day not in olds[row.name][2]:
                keep[row.name].add(day)
    return keep


def replace_by_date(
    batch: DataFrame, path: str, layout: Layout, clustered: bool = False,
    keep: Collection[Day] | None = None,
) -> None:
    """Delete the days that ``batch`` has, of every account, then add its rows.

    ``clustered`` says that the rows of a partition already lie together. ``keep`` are
    the days that stay of the touched months, as ``uncovered_days`` finds them; without
    it they are looked up.
    """
    spark = batch.sparkSession
    placed = layout.place(batch)
    old = None
    if layout.grain == "month":
        old = existing_table(spark, path, placed.schema)
    kept = None if old is None else _days_to_keep(placed, old, layout, keep)
    if kept is None:
        replace_partitions(placed, path, layout.partition_by, clustered)
        return
    copy = new_folder(spark, "kept-days")
    # Copied first: the commit removes the files that hold them.
    kept.select(*placed.columns).write.parquet(copy)
    rows = placed.unionByName(read_table(spark, copy, placed.schema))
    replace_partitions(rows, path, layout.partition_by, clustered)
    # Needed until the commit only.
    remove_folder(spark, copy)


def _days_to_keep(
    placed: DataFrame, old: DataFrame, layout: Layout, keep: Collection[Day] | None = None
) -> DataFrame | None:
    """Old rows of the touched months whose days are not replaced, None without any."""
    if keep is None:
        keep = uncovered_days({"": (old, layout, days_of(placed, layout))})[""]
    if not keep:
        return None
    months = _among(keep, layout, layout.month_column, lambda day: day[:7])
    return old.filter(months & _among(keep, layout, layout.date_column, date.fromisoformat))


def replace_rows_by_date(
    target: DataFrame, batch: DataFrame, dates: DataFrame, date_column: str
) -> DataFrame:
    """Content of an unpartitioned target after its listed dates were replaced.

    ``dates`` is best read from the published date list: it is then a file whose
    size Spark knows, and Spark alone decides whether to broadcast it.
    """
    kept = target.join(dates.select(date_column), date_column, "left_anti")
    return kept.select(target.columns).unionByName(batch)


def replace_all(df: DataFrame, path: str) -> None:
    """The whole content of a small dimension."""
    df.write.mode("overwrite").parquet(path)


def write_earnings(df: DataFrame, path: str) -> None:
    """A whole earnings table, one partition per month as its text dates say."""
    keyed = df.withColumn(TEXT_MONTH, text_month(F.col("transaction_date")))
    write_table(keyed.withColumn(LOAD_MONTH, F.col(TEXT_MONTH)), path, [TEXT_MONTH])
    # No row lies outside the month of its load.
    _note_strays(df.sparkSession, path, None, ())


def _strays_path(path: str) -> str:
    """The index of load month to text months; readers of the table skip the name."""
    return f"{path}/_strays"


def _note_strays(spark: SparkSession, path: str, month: str | None, text_months: Collection[str | None]) -> None:
    """Put in place which other months hold rows that the load of ``month`` brought."""
    # A row that says nothing keeps the entry of a load without strays.
    rows = [(month, name, True) for name in text_months] or [(month, None, False)]
    noted = spark.createDataFrame(rows, f"{LOAD_MONTH} string, {TEXT_MONTH} string, strays boolean")
    replace_partitions(noted.coalesce(1), _strays_path(path), [LOAD_MONTH], clustered=True)


def _strayed_to(spark: SparkSession, path: str, old: DataFrame, month: str) -> set[str | None]:
    """Other months that hold rows of the load of ``month``: from the index, or from the
    two month columns of a table that has none yet. A calendar at most."""
    schema = f"{TEXT_MONTH} string, strays boolean, {LOAD_MONTH} string"
    noted = existing_table(spark, _strays_path(path), schema)
    if noted is not None:
        found = noted.filter((F.col(LOAD_MONTH) == month) & F.col("strays"))
    else:
        outside = F.coalesce(F.col(TEXT_MONTH) != month, F.lit(True))
        found = old.filter((F.col(LOAD_MONTH) == month) & outside)
    return {r[0] for r in found.select(TEXT_MONTH).distinct().collect()}


def _in_months(months: Collection[str | None]) -> Column:
    there = F.col(TEXT_MONTH).isin([m for m in months if m is not None])
    return there | F.col(TEXT_MONTH).isNull() if None in months else there


def replace_by_month(df: DataFrame, path: str, month: str) -> None:
    """Replace one month (``2021-Feb``) of an earnings table by ``df``.

    That month is deleted. Rows of ``df`` that carry a date of another month are added
    to what that month holds, in place of all that earlier loads of ``month`` added to
    any month: loading one batch again changes nothing, and what a corrected batch no
    longer has is gone. An index beside the table says where the rows of a load went,
    so no other month is read. All is one commit, but for a month that loses its last
    row, whose folder is removed after it. A ``df`` without rows changes nothing.
    """
    spark = df.sparkSession
    keyed = df.withColumn(TEXT_MONTH, text_month(F.col("transaction_date"))).withColumn(LOAD_MONTH, F.lit(month))
    old = existing_table(spark, path, keyed.schema)
    months = {r[0] for r in keyed.select(TEXT_MONTH).distinct().collect()}
    if not months:
        return
    strays = months - {month}
    if old is None:
        _note_strays(spark, path, month, strays)
        replace_partitions(keyed, path, [TEXT_MONTH])
        return
    before = _strayed_to(spark, path, old, month)
    # Until the commit either set may be the true one.
    _note_strays(spark, path, month, strays | before)
    emptied: set[str | None] = set()
    if touched := strays | before:
        others = old.filter(_in_months(touched) & ~F.col(LOAD_MONTH).eqNullSafe(F.lit(month)))
        copy = new_folder(spark, "other-months")
        # Copied first: the commit removes the files that hold them.
        others.write.parquet(copy)
        kept = read_table(spark, copy, keyed.schema)
        if gone := before - strays:
            emptied = gone - {r[0] for r in kept.filter(_in_months(gone)).select(TEXT_MONTH).distinct().collect()}
        replace_partitions(keyed.unionByName(kept), path, [TEXT_MONTH])
        remove_folder(spark, copy)
    else:
        replace_partitions(keyed, path, [TEXT_MONTH])
    for name in emptied:
        remove_partition(spark, path, TEXT_MONTH, name)
    if before - strays:
        _note_strays(spark, path, month, strays)


def counts_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def reconcile_counts(
    source: DataFrame, written: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows per key in the source and in the table, and whether they agree."""
    return compare_counts(counts_by(source, keys), counts_by(written, keys), keys)


def compare_counts(source: DataFrame, written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts (``n``) per key of the source and of the table, and whether they agree."""
    both = source.withColumnRenamed("n", "source_rows").join(
        written.withColumnRenamed("n", "written_rows"), list(keys), "full"
    )
    rows = [
        F.coalesce(n, F.lit(0)).cast("bigint").alias(n)
        for n in ("source_rows", "written_rows")
    ]
    return both.select(*keys, *rows).withColumn(
        "ok", F.col("source_rows") == F.col("written_rows")
    )


def write_checked(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> int:
    """Write a new table, count rows on the way, compare with what can be read back.

    Rows are counted after the shuffle, in the tasks that write, where Spark takes
    the count of each finished task once. Reading back needs file footers only.
    """
    keys = tuple(cluster_by) or tuple(partition_by)
    out = spread(df, *keys) if keys else df
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path).count()
    check_counts(seen.get["rows"], found, path)
    return found


def check_counts(expected: int, found: int, what: str) -> None:
    if expected != found:
        raise ReconciliationError(f"{what}: wrote {expected} rows, read back {found}")


_STATS = "column_name string, row_count long, null_count long, distinct_count long, min_value string, max_value string"


def stats_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All measures of all columns in one row: one aggregate in the columns' own types
    (numbers compare as numbers), of which partial results alone are moved."""
    wanted = [
        value.alias(f"{name}_{i}")
        for i, c in enumerate(columns)
        for name, value in (
            ("nulls", F.count_if(F.col(c).isNull())), ("distinct", F.approx_count_distinct(F.col(c))),
            ("least", F.min(c).cast("string")), ("most", F.max(c).cast("string")),
        )
    ]
    return df.agg(F.count(F.lit(1)).alias("n"), *wanted)


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, NULLs, distinct values, smallest and largest as text.

    Distinct counts are approximate as in ``ANALYZE TABLE``; ``statistics.exact_stats``
    counts them in full. The measures, a single row, go to the driver and are laid out there.
    """
    found = stats_row(df, columns).first()
    rows = [
        (c, found["n"], *(found[f"{name}_{i}"] for name in ("nulls", "distinct", "least", "most")))
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, _STATS)


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, different keys, and keys that several rows share. Nothing enforces
    that a key is unique; rows without one are not counted among the keys."""
    shared = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    there = F.col(key).isNotNull()
    return shared.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count_if(there).alias("n_keys"),
        F.count_if(there & (F.col("n") > 1)).alias("n_shared_keys"),
    )


def analyze(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Store column statistics of a catalog table for the optimizer."""
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {names}")
