"""Sources: rows written as report files and read back, archives, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom import frames
from reportloom.functions.clean import blank_to_null, clean_metric, clean_text
from reportloom.functions.dates import iso_date
from reportloom.operators.cooking import cook_devices
from reportloom.operators.freshness import file_catalog
from reportloom.queries import frames_sql as sql
from reportloom.queries.registry import query
from reportloom.schemas import (
    CRASH_FEED_NAMES,
    DEVICE_COLUMNS,
    EARNINGS_COLUMNS,
    positional,
)
from reportloom.sinks.control import build_manifest
from reportloom.sinks import exports
from reportloom.sources import archives
from reportloom.sources.archives import archive_rows
from reportloom.sources.manifests import load_from_manifest as read_listed
from reportloom.sources.reports import (
    read_cooked_csv,
    read_earnings,
    read_sales_csv,
    read_supported_devices,
    read_utf16_csv,
    scan_feed,
    union_objects,
)
from reportloom.sources.reports import scan_named_feed as read_named
from reportloom.workspace import new_folder

CRASH_FIELDS = positional(5)

_EARNINGS_NULLED = ", ".join(
    f"CASE WHEN regexp_matches({c}, '^\\s*$') THEN NULL ELSE {c} END AS {c}"
    for c in EARNINGS_COLUMNS
)
_COOKED_SQL = (
    sql.CRASH_RAW
    + """, cooked AS (
  SELECT c0, c1, replace(c2, '%', '') AS c2, replace(replace(c3, ',', ''), '%', '') AS c3,
    replace(replace(c4, ',', ''), '%', '') AS c4, feed, tenant FROM crash_raw)"""
)


def _write_crash_objects(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    raw = frames.crash_raw(spark, sf_dir)
    name = F.concat(
        F.lit("crashes_com.example."), F.col("event_type"), F.lit("_"),
        F.date_format(F.col("c0").cast("date"), "yyyyMM"), F.lit("_"), F.col("feed"), F.lit(".csv"),
    )
    root = new_folder(spark, "crash-objects")
    return frames.write_objects(raw.withColumn("object", name), root, "crashes", 5)


def _cooked_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash rows as cooked text: what the published files hold."""
    return frames.crash_raw(spark, sf_dir).select(
        "c0", "c1",
        clean_text(F.col("c2")).alias("c2"),
        clean_metric(F.col("c3")).alias("c3"),
        clean_metric(F.col("c4")).alias("c4"),
        "feed", "tenant",
    )


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        """SELECT tenant, feed, replace(substr(c0, 1, 7), '-', '') AS month, c1 AS package,
  c0, c1, c2, c3, c4 FROM crash_raw""",
    )
)
def scan_feed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = _write_crash_objects(spark, sf_dir)
    rows = scan_feed(spark, roots, "crashes", CRASH_FEED_NAMES, ["202312", "202401"], 5)
    return rows.drop("source_file")


@query(sql.with_frames(sql.CRASH_RAW, "SELECT tenant, feed, c0, c1, c2, c3, c4 FROM crash_raw"))
def scan_named_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of all accounts read together; account and feed are told by the objects' names."""
    raw = frames.crash_raw(spark, sf_dir)
    name = F.concat(F.lit("crashes_"), F.col("tenant"), F.lit("_202401_"), F.col("feed"), F.lit(".csv"))
    roots = frames.write_objects(raw.withColumn("object", name), new_folder(spark, "named"), "crashes", 5)
    paths = [f"{root}/stats/crashes" for root in roots.values()]

    def folder(path: Column) -> Column:
        return F.element_at(F.split(path, "/"), -2)

    rows = read_named(spark, paths, frames.TENANTS, 5, object_name=folder)
    return rows.drop("source_file")


@query("SELECT doc_id, lang, source, text FROM documents")
def scan_utf16_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "utf16")
    columns = ["doc_id", "lang", "source", "text"]
    (
        frames.table(spark, sf_dir, "documents")
        .select(*columns)
        .write.option("encoding", "UTF-16LE")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    rows = read_utf16_csv(spark, path, columns)
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).drop("source_file")


@query(
    """SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text,
  length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS n_ascii FROM documents"""
)
def scan_sales_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "sales-csv")
    (
        frames.table(spark, sf_dir, "documents")
        .select("doc_id", "text")
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    rows = read_sales_csv(spark, path, ["doc_id", "text"])
    return rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.length("text").cast("bigint").alias("n_ascii"),
    )


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS path, text, length(text) AS n_chars
FROM documents"""
)
def transcode_utf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.unhex(F.lit("FFFE"))
    files = frames.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("path"),
        F.concat(mark, F.encode("text", "UTF-16LE")).alias("content"),
    )
    return archives.transcode_utf16(files).withColumn("n_chars", F.length("text").cast("bigint"))


@query(
    sql.with_frames(
        sql.EARNINGS_RAW,
        f""", numbered AS (SELECT *, o_orderkey // {frames.KEYS_PER_ARCHIVE} AS part FROM earnings_raw)
SELECT tenant, 'earnings/earnings_' || month || '_77-' || CAST(part AS VARCHAR) || '.zip' AS path,
  'PlayApps_' || month || '_' || CAST(part AS VARCHAR) || '.csv' AS numbered_member,
  row_number() OVER (PARTITION BY tenant, month, part ORDER BY o_orderkey) AS row_no,
  description, transaction_date, product_title, tax_type, amount_merchant_currency
FROM numbered""",
    )
)
def expand_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archives.expand_archives(frames.earnings_archives(spark, sf_dir), carry=["tenant"])
    rows = archive_rows(
        records.withColumn("record", F.col("row_no")), EARNINGS_COLUMNS
    )
    return rows.select(
        "tenant", "path", "numbered_member", F.col("record").alias("row_no"),
        "description", "transaction_date", "product_title", "tax_type",
        "amount_merchant_currency",
    )


@query(sql.with_frames(sql.DEVICES, "SELECT * FROM devices"))
def scan_device_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "devices-csv")
    frames.write_devices(frames.devices_raw(spark, sf_dir), path)
    return cook_devices(read_supported_devices(spark, path, DEVICE_COLUMNS))


@query(sql.with_frames(_COOKED_SQL, "SELECT c0, c1, c2, c3, c4 FROM cooked"))
def scan_cooked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "cooked")
    exports.export_cooked(_cooked_text(spark, sf_dir), path, CRASH_FIELDS)
    return read_cooked_csv(spark, path, CRASH_FIELDS).drop("source_file")


@query(
    sql.with_frames(
        _COOKED_SQL,
        "SELECT c0, c1, c2, c3, c4, feed AS p_feed, c0 AS p_date, tenant AS p_tenant FROM cooked",
    )
)
def export_cooked(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "cooked")
    exports.export_cooked(_cooked_text(spark, sf_dir), path, CRASH_FIELDS)
    rows = read_cooked_csv(spark, path, CRASH_FIELDS)
    return rows.select(
        *CRASH_FIELDS,
        F.regexp_extract("source_file", "p_feed=([^/]*)/", 1).alias("p_feed"),
        F.regexp_extract("source_file", "p_date=([^/]*)/", 1).alias("p_date"),
        F.regexp_extract("source_file", "p_tenant=([^/]*)/", 1).alias("p_tenant"),
    )


@query(sql.with_frames(_COOKED_SQL, "SELECT feed, c0, c1, c2, c3, c4 FROM cooked"))
def load_from_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "published")
    cooked = _cooked_text(spark, sf_dir)
    exports.export_cooked(cooked, root, CRASH_FIELDS)
    catalog = file_catalog(cooked.withColumn("report_date", F.col("c0").cast("date")))
    url = exports.export_folder(root, F.col("feed"), iso_date(F.col("report_date")), F.col("tenant"))
    manifests = new_folder(spark, "manifests")
    build_manifest(catalog, url).write.partitionBy("feed").text(manifests)

    def load(feed: str) -> DataFrame:
        rows = read_listed(
            spark, f"{manifests}/feed={feed}", lambda p: read_cooked_csv(spark, p, CRASH_FIELDS)
        )
        return rows.select(F.lit(feed).alias("feed"), *CRASH_FIELDS)

    return union_objects([load(f) for f in CRASH_FEED_NAMES])


@query(sql.with_frames(sql.EARNINGS_RAW, f"SELECT {_EARNINGS_NULLED} FROM earnings_raw"))
def scan_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "earnings-csv")
    (
        frames.earnings_raw(spark, sf_dir)
        .select(*EARNINGS_COLUMNS)
        .write.option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    rows = read_earnings(spark, path)
    return rows.select(*(blank_to_null(F.col(c)).alias(c) for c in EARNINGS_COLUMNS))
