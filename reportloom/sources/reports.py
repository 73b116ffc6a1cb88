"""Readers of report files: UTF-16 feeds, sales, earnings, devices, cooked CSV."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions.clean import strip_non_ascii, strip_tabs
from reportloom.functions.names import (
    base_name,
    classify_feed,
    classify_tenant,
    required,
)
from reportloom.schemas import (
    CRASH_FEED_NAMES,
    DEVICE_COLUMNS,
    EARNINGS_COLUMNS,
    positional,
    text_schema,
)
from reportloom.workspace import path_exists

# Where Spark puts the text of a record whose fields are not as many as the columns.
_RECORD = "uneven_record"


@dataclass(frozen=True)
class Dialect:
    """How a kind of report file is written."""

    encoding: str = "UTF-8"
    quote: str = '"'
    header: bool = True


UTF16_REPORT = Dialect(encoding="UTF-16LE")
PLAIN_REPORT = Dialect()
COOKED = Dialect(quote="%", header=False)


def _file_path() -> Column:
    return F.col("_metadata.file_path")


# For ``split``: files whose lines are all records are split, the others go whole.
WHERE_LINES_ARE_RECORDS = "where lines are records"


class SplitError(ValueError):
    """A file was to be split at its line breaks but has lines that are no records."""


def read_report_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    dialect: Dialect,
    file_filter: Column | None = None,
    split: bool | str = False,
    strict: bool = False,
) -> DataFrame:
    """CSV report files, every column as text, and the file each row is from.

    Files are read whole, many per job, since a quoted field may hold a line
    break. With ``split`` they are cut at line breaks and shared among tasks; a
    pass over the lines makes sure first that each is one record, and
    ``SplitError`` is raised if one is not. With ``WHERE_LINES_ARE_RECORDS`` the
    files that have such a line are read whole, whatever their size, and all others
    are split. Rows of more fields than ``columns``
    end there, or fail the read with ``strict``, also where all that is beyond is
    empty; shorter rows are filled with NULL. ``file_filter`` is a condition on
    ``_metadata`` and prunes files before they are read. Bytes that are no text
    in the encoding are dropped; of a UTF-16 high surrogate that lacks its
    partner the JVM drops the character after it too.
    """
    chosen = F.lit(True) if file_filter is None else file_filter
    if split == WHERE_LINES_ARE_RECORDS:
        # Names of files only, of which Spark's own listing holds all on the driver.
        if broken := files_with_broken_lines(spark, paths, dialect, chosen, most=None):
            whole = _file_path().isin(broken)
            return union_objects([
                _read_csv(spark, paths, columns, dialect, chosen & ~whole, True, strict),
                _read_csv(spark, paths, columns, dialect, chosen & whole, False, strict),
            ])
    elif split and (broken := files_with_broken_lines(spark, paths, dialect, chosen)):
        raise SplitError(f"lines that are no records in {len(broken)} files, first {broken[0]}")
    return _read_csv(spark, paths, columns, dialect, chosen, bool(split), strict)


def _read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    dialect: Dialect,
    chosen: Column,
    split: bool,
    strict: bool,
) -> DataFrame:
    frame = spark.read.csv(
        paths,
        schema=text_schema([*columns, _RECORD] if strict else columns),
        header=dialect.header,
        enforceSchema=True,
        encoding=dialect.encoding,
        quote=dialect.quote,
        # Report writers double a quote inside quotes.
        escape=dialect.quote,
        recursiveFileLookup=True,
        columnNameOfCorruptRecord=_RECORD,
        **({"lineSep": "\n"} if split else {"multiLine": True}),
    ).filter(chosen)
    if strict:
        # A count reads no column of its own, and Spark wants one beside the record.
        begins = F.coalesce(F.col(columns[0]), F.lit(""))
        told = F.concat(F.lit(f"more than {len(columns)} columns in "), _file_path(), F.lit(", row "), begins)
        wide = _field_count(F.col(_RECORD), dialect.quote) > len(columns)
        frame = frame.filter(F.when(wide, F.raise_error(told).cast("boolean")).otherwise(True))
    rows = frame.select(
        *(F.replace(F.col(c), F.lit("\ufffd"), F.lit("")).alias(c) for c in columns),
        _file_path().alias("source_file"),
    )
    if not split:
        return rows
    return rows.select(*(_without_line_end(F.col(c)).alias(c) for c in columns), "source_file")


def _field_count(record: Column, quote: str) -> Column:
    """Fields of a CSV record: the commas outside its quoted fields, and one. NULL for NULL."""
    # Unrolled, so that a long field takes no stack.
    quoted = f"(^|,){quote}[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+{quote}"
    bare = F.regexp_replace(record, quoted, "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _without_line_end(c: Column) -> Column:
    """What is left of a line's last field when lines end in CR LF; no other field of a
    file that may be split holds a CR."""
    return F.when(F.endswith(c, F.lit("\r")), F.left(c, F.length(c) - 1)).otherwise(c)


def files_with_broken_lines(
    spark: SparkSession, paths: str | Sequence[str], dialect: Dialect, condition: Column,
    most: int | None = 20,
) -> list[str]:
    """Files in which some line is not plainly a record of its own.

    A record is made of fields without quotes and fields in quotes, quotes inside
    them doubled; a CR stands only at its end. The first line of a record that goes on in the next one does not fit this. A break
    that was found between the halves of two characters leaves half a character,
    which cannot be decoded. Only the names of such files go to the driver, the
    first ``most`` of them.
    """
    # One field per line: no quotes, and a separator that is no character.
    lines = (
        spark.read.csv(
            paths, schema="line string, more string", sep="\uffff", quote="",
            encoding=dialect.encoding, lineSep="\n", recursiveFileLookup=True,
        )
        .filter(condition)
        .select("line", "more", _file_path().alias("file"))
    )
    q = dialect.quote
    bare, quoted = rf"[^,{q}\r]*+", rf"{q}(?:[^{q}\r]|{q}{q})*+{q}"
    record = rf"^(?:(?:{quoted}|{bare}),)*+(?:{quoted}|{bare})\r?\z"
    broken = (
        ~F.col("line").rlike(record) | F.contains("line", F.lit("\ufffd")) | F.col("more").isNotNull()
    )
    files = lines.filter(broken).select("file").distinct()
    return [r.file for r in (files if most is None else files.limit(most)).collect()]


def read_report_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: Dialect = UTF16_REPORT,
    file_filter: Column | None = None,
) -> DataFrame:
    """(line, source_file) of every line below the first one of each file.

    Files are split at line breaks; none is held whole, however long. A line ends in
    LF or CR LF. Lines without a character are left out, also before the header.
    """
    # One field per line: no quotes, and a separator that is no character. A line that
    # has one all the same is told apart, and is taken as it stands.
    lines = spark.read.csv(
        paths, schema=text_schema(["line", _RECORD]), sep="\uffff", quote="", header=True, enforceSchema=True,
        encoding=dialect.encoding, lineSep="\n", recursiveFileLookup=True, columnNameOfCorruptRecord=_RECORD,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if file_filter is not None:
        lines = lines.filter(file_filter)
    line = F.coalesce(F.col(_RECORD), F.col("line"))
    found = lines.select(_without_line_end(line).alias("line"), _file_path().alias("source_file"))
    return found.filter(F.length("line") > 0)


def read_utf16_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    file_filter: Column | None = None,
    split: bool | str = False,
    strict: bool = False,
) -> DataFrame:
    """UTF-16LE reports with a header per file, with or without byte order mark."""
    return read_report_csv(spark, paths, columns, UTF16_REPORT, file_filter, split, strict)


def report_name(report: str, months: Sequence[str], feeds: Sequence[str]) -> str:
    """Pattern of a report's objects; its groups are package, month and feed."""
    return rf"stats/{report}/{report}_(.*)_({'|'.join(months)})_({'|'.join(feeds)})\.csv"


def scan_feed(
    spark: SparkSession,
    roots: Mapping[str, str],
    report: str,
    feeds: Sequence[str],
    months: Sequence[str],
    width: int,
    split: bool | str = False,
) -> DataFrame:
    """Rows of all objects of a report for accounts × months × feeds.

    ``roots`` maps an account label to the folder of its reports. Adds tenant,
    feed, month and package, all taken from the object name. A row of more than
    ``width`` fields fails the scan.
    """
    name = report_name(report, months, feeds)
    found = F.col("source_file")

    def scan_tenant(tenant: str, root: str) -> DataFrame:
        raw = read_utf16_csv(
            spark,
            f"{root}/stats/{report}",
            positional(width),
            _file_path().rlike(name),
            split,
            strict=True,
        )
        return raw.select(
            F.lit(tenant).alias("tenant"),
            F.regexp_extract(found, name, 3).alias("feed"),
            F.regexp_extract(found, name, 2).alias("month"),
            F.regexp_extract(found, name, 1).alias("package"),
            *positional(width),
            "source_file",
        )

    # An account without any report of the kind has no folder for it.
    found_roots = {
        t: r for t, r in roots.items() if path_exists(spark, f"{r}/stats/{report}")
    }
    if not found_roots:
        names = ("tenant", "feed", "month", "package", *positional(width), "source_file")
        return spark.createDataFrame([], text_schema(names))
    return union_objects([scan_tenant(t, r) for t, r in found_roots.items()])


def scan_named_feed(
    spark: SparkSession,
    paths: str | Sequence[str],
    labels: Sequence[str],
    width: int,
    feeds: Sequence[str] = CRASH_FEED_NAMES,
    split: bool | str = False,
    object_name: Callable[[Column], Column] = base_name,
) -> DataFrame:
    """Rows of reports of several accounts that lie together: (tenant, feed, c0 …, source_file).

    Account and feed are what the object's name says, which ``object_name`` takes from the
    path. An object that has rows and whose name lacks one of them fails the scan, and so
    does a row of more than ``width`` fields.
    """
    raw = read_utf16_csv(spark, paths, positional(width), split=split, strict=True)
    found = object_name(F.col("source_file"))
    return raw.select(
        required(classify_tenant(found, labels), found).alias("tenant"),
        required(classify_feed(found, feeds), found).alias("feed"),
        *positional(width),
        "source_file",
    )


def union_objects(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_sales_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    split: bool = False,
) -> DataFrame:
    """Sales CSV: header, quoted line breaks, characters outside ASCII dropped."""
    raw = read_report_csv(spark, paths, columns, PLAIN_REPORT, None, split)
    return raw.select(*(strip_non_ascii(F.col(c)).alias(c) for c in columns))


def read_supported_devices(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] = DEVICE_COLUMNS,
) -> DataFrame:
    """Device list: header, tabs removed from every field."""
    raw = read_report_csv(spark, paths, columns, PLAIN_REPORT, strict=True)
    return raw.select(*(strip_tabs(F.col(c)).alias(c) for c in columns))


def read_cooked_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    split: bool = False,
) -> DataFrame:
    """Published cooked files: comma, ``%`` as quote, no header."""
    return read_report_csv(spark, paths, columns, COOKED, None, split, strict=True)


def read_earnings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Earnings CSV: one header line, the 19 columns as text."""
    raw = read_report_csv(spark, paths, EARNINGS_COLUMNS, PLAIN_REPORT, strict=True)
    return raw.select(*EARNINGS_COLUMNS)
