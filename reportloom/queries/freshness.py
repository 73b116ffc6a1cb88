"""Catalogs, published days and run status over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom import frames
from reportloom.functions.dates import iso_date
from reportloom.operators import freshness as ops
from reportloom.queries import frames_sql as sql
from reportloom.queries.registry import query
from reportloom.schemas import CRASH_FEED_NAMES
from reportloom.sinks import control
from reportloom.sinks.exports import export_folder
from reportloom.sources.reports import union_objects
from reportloom.workspace import new_folder

SALES_UNTIL = date(2000, 12, 31)
RUN_DATE = date(2024, 2, 1)

_PRESENCE = """complete AS (
  SELECT feed, max(report_date) AS latest_date FROM (
    SELECT p.feed, p.report_date FROM (SELECT DISTINCT feed, report_date, tenant FROM {published}) p
    WHERE EXISTS (SELECT 1 FROM {keys} k WHERE k.feed = p.feed AND k.report_date = p.report_date)
    GROUP BY p.feed, p.report_date HAVING count(*) = 2) GROUP BY feed),
expected AS (
  SELECT o.feed, latest_date,
    coalesce(CAST(latest_date + INTERVAL 1 DAY AS DATE), oldest) AS next_date
  FROM (SELECT feed, min(report_date) AS oldest FROM {keys} GROUP BY feed) o
  LEFT JOIN complete c ON o.feed = c.feed),
presence AS (
  SELECT feed, latest_date, next_date, (
    SELECT count(DISTINCT tenant) FROM {keys} k
    WHERE k.feed = e.feed AND k.report_date = e.next_date AND k.tenant IN ({required})
  ) = {n_required} AS is_new
  FROM expected e)"""
_CRASH_PRESENCE = sql.PUBLISHED + ", " + _PRESENCE.format(
    published="published", keys="crash_keys", required="'tenant_a', 'tenant_b'", n_required=2
)
_STORE_KEYS = """store_keys AS (
  SELECT DISTINCT 'sales' AS feed, CAST(o_orderdate AS DATE) AS report_date,
    CASE WHEN o_orderkey % 2 = 0 THEN 'tenant_a' ELSE 'tenant_b' END AS tenant FROM orders
  UNION ALL
  SELECT DISTINCT 'installs_country', CAST(ts AS DATE),
    CASE WHEN user_id % 2 = 0 THEN 'tenant_a' ELSE 'tenant_b' END FROM events),
store_published AS (
  SELECT * FROM store_keys WHERE feed = 'sales' AND report_date <= DATE '2000-12-31')"""
_STORE_PRESENCE = _STORE_KEYS + ", " + _PRESENCE.format(
    published="store_published", keys="store_keys", required="'tenant_a'", n_required=1
)


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    keys = frames.crash_keys(spark, sf_dir)
    return keys, frames.published(keys)


def _crash_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.next_date_present(*_parts(spark, sf_dir), frames.TENANTS)


def _store_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = frames.table(spark, sf_dir, "orders").select(
        F.lit("sales").alias("feed"),
        F.col("o_orderdate").cast("date").alias("report_date"),
        frames.tenant_of(F.col("o_orderkey")).alias("tenant"),
    )
    installs = frames.table(spark, sf_dir, "events").select(
        F.lit("installs_country").alias("feed"),
        F.col("ts").cast("date").alias("report_date"),
        frames.tenant_of(F.col("user_id")).alias("tenant"),
    )
    published = ops.file_catalog(sales).filter(F.col("report_date") <= F.lit(SALES_UNTIL))
    return ops.next_date_present(
        union_objects([sales, installs]), published, frames.TENANTS, optional=["tenant_b"]
    )


@query(sql.with_frames(sql.CRASH_KEYS, "SELECT * FROM crash_keys"))
def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.file_catalog(frames.crash_keys(spark, sf_dir))


@query(sql.with_frames(sql.CRASH_KEYS, "SELECT DISTINCT feed, report_date FROM crash_keys"))
def feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.feed_dates(frames.crash_keys(spark, sf_dir))


@query(
    sql.with_frames(
        sql.PUBLISHED,
        """SELECT * FROM crash_keys k WHERE EXISTS (SELECT 1 FROM published p
  WHERE p.feed = k.feed AND p.report_date = k.report_date AND p.tenant = k.tenant)""",
    )
)
def published_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, published = _parts(spark, sf_dir)
    return ops.published_parts(ops.file_catalog(keys), published)


@query(
    sql.with_frames(
        _CRASH_PRESENCE,
        "SELECT feed, latest_date FROM presence WHERE latest_date IS NOT NULL",
    )
)
def latest_complete_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.latest_complete_date(*_parts(spark, sf_dir), frames.TENANTS)


@query(
    sql.with_frames(
        _CRASH_PRESENCE, "SELECT feed, latest_date, next_date, is_new FROM presence"
    )
)
def next_date_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crash_presence(spark, sf_dir)


@query(
    sql.with_frames(
        _STORE_PRESENCE, "SELECT feed, latest_date, next_date, is_new FROM presence"
    )
)
def next_date_present_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store_presence(spark, sf_dir)


@query(
    sql.with_frames(
        _CRASH_PRESENCE,
        """SELECT coalesce('[''' || string_agg(feed, ''', ''' ORDER BY feed) || ''']', 'No New Data') AS status
FROM presence WHERE is_new""",
    )
)
def derive_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.status_text(ops.feeds_with_new_data(_crash_presence(spark, sf_dir)))


@query(
    sql.with_frames(
        _STORE_PRESENCE,
        """, flags AS (SELECT
  coalesce(bool_or(is_new) FILTER (feed = 'sales'), false) AS s,
  coalesce(bool_or(is_new) FILTER (feed = 'installs_country'), false) AS i FROM presence)
SELECT l.load, CAST(CASE
  WHEN s AND i AND l.load = 'both' THEN 1
  WHEN s AND l.load IN ('both', 'sales') THEN 2
  WHEN i AND l.load IN ('both', 'installs') THEN 3 ELSE 0 END AS INTEGER) AS code
FROM flags, (VALUES ('both'), ('sales'), ('installs')) AS l(load)""",
    )
)
def derive_status_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    def new(feed: str):
        hit = F.col("is_new") & (F.col("feed") == feed)
        return F.coalesce(F.bool_or(hit), F.lit(False))

    flags = _store_presence(spark, sf_dir).agg(
        new("sales").alias("s"), new("installs_country").alias("i")
    )
    loads = F.explode(F.array(*map(F.lit, ("both", "sales", "installs"))))
    return flags.select("s", "i", loads.alias("load")).select(
        "load",
        ops.sales_status_code(F.col("s"), F.col("i"), F.col("load")).alias("code"),
    )


@query(
    sql.with_frames(
        _CRASH_PRESENCE,
        """SELECT feed, CASE WHEN is_new THEN 'new_' ELSE 'no_new_' END || feed || '_crashes' AS branch
FROM presence""",
    )
)
def route_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = derive_status(spark, sf_dir)
    feeds = F.explode(F.array(*map(F.lit, CRASH_FEED_NAMES))).alias("feed")
    return status.select("status", feeds).select(
        "feed", ops.route_feed(F.col("status"), F.col("feed")).alias("branch")
    )


@query(
    """SELECT strftime(o_orderdate, '%Y%m') AS month,
  count(DISTINCT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 2 END) = 2 AS file_found
FROM orders GROUP BY strftime(o_orderdate, '%Y%m')"""
)
def all_tenants_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    month = F.date_format("o_orderdate", "yyyyMM")
    # Every fifth order lies in a file of another kind.
    kind = F.when(key % 5 == 0, "Other_").otherwise("PlayApps_")
    files = frames.table(spark, sf_dir, "orders").select(
        month.alias("month"),
        frames.tenant_of(key).alias("tenant"),
        F.concat(kind, month, F.lit("_"), key.cast("string"), F.lit(".csv")).alias("name"),
    )
    pattern = F.concat(F.lit("^PlayApps_"), F.col("month"), F.lit(r"_.*\.csv$"))
    return ops.all_tenants_present(files, "month", pattern, frames.TENANTS)


_LISTS = """SELECT feed, '(''' || string_agg(d, ''',''' ORDER BY d) || ''')' AS date_list
FROM (SELECT DISTINCT feed, strftime(report_date, '%Y-%m-%d') AS d FROM crash_keys) GROUP BY feed"""


@query(sql.with_frames(sql.CRASH_KEYS, _LISTS))
def date_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = ops.feed_dates(frames.crash_keys(spark, sf_dir))
    return control.date_list(dates).select("feed", "date_list")


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = export_folder(
        "s3://reports/root/crashes", F.col("feed"), iso_date(F.col("report_date")), F.col("tenant")
    )
    return control.build_manifest(ops.file_catalog(frames.crash_keys(spark, sf_dir)), url)


_MANIFEST_SQL = """manifests AS (
  SELECT feed, '{"entries":[' || string_agg('{"url":"' || url || '","mandatory":true}', ',' ORDER BY url)
    || ']}' AS manifest
  FROM (SELECT feed, 's3://reports/root/crashes/p_feed=' || feed
      || '/p_date=' || strftime(report_date, '%Y-%m-%d') || '/p_tenant=' || tenant AS url FROM crash_keys)
  GROUP BY feed)"""


@query(
    sql.with_frames(
        sql.CRASH_KEYS + ", " + _MANIFEST_SQL, "SELECT feed, manifest FROM manifests"
    )
)
def build_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifests(spark, sf_dir)


@query(
    sql.with_frames(
        _CRASH_PRESENCE + ", " + _MANIFEST_SQL,
        """SELECT CAST(DATE '2024-02-01' AS DATE) AS run_date, feed, manifest FROM manifests
WHERE feed IN (SELECT feed FROM presence WHERE is_new)""",
    )
)
def publish_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "manifests")
    new = ops.feeds_with_new_data(_crash_presence(spark, sf_dir))
    control.publish_manifests(_manifests(spark, sf_dir), new, path, RUN_DATE)
    schema = "value string, run_date date, feed string"
    return spark.read.schema(schema).text(path).withColumnRenamed("value", "manifest")


@query(
    sql.with_frames(
        _CRASH_PRESENCE,
        """SELECT DATE '2024-02-01' AS run_date, 'crashes' AS job,
  coalesce('[''' || string_agg(feed, ''', ''' ORDER BY feed) || ''']', 'No New Data') AS status
FROM presence WHERE is_new""",
    )
)
def publish_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "status")
    control.publish_status(derive_status(spark, sf_dir), path, "crashes", RUN_DATE)
    return spark.read.schema("status string, run_date date, job string").parquet(path)


@query(
    sql.with_frames(
        _CRASH_PRESENCE,
        """SELECT k.feed, k.report_date, s.status
FROM (SELECT DISTINCT feed, report_date FROM crash_keys) k CROSS JOIN (
  SELECT coalesce('[''' || string_agg(feed, ''', ''' ORDER BY feed) || ''']', 'No New Data') AS status
  FROM presence WHERE is_new) s""",
    )
)
def control_file_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date lists and status of a run, published beside those of another, and read back."""
    root = new_folder(spark, "control")
    lists = control.date_list(ops.feed_dates(frames.crash_keys(spark, sf_dir)))
    for run, day in enumerate((date(2024, 1, 31), RUN_DATE)):
        control.publish_date_lists(lists if run else lists.limit(1), f"{root}/dates", day)
        status = derive_status(spark, sf_dir) if run else spark.createDataFrame([("Error: x",)], "status string")
        control.publish_status(status, f"{root}/status", "crashes", day)
    note = control.read_status(spark, f"{root}/status", "crashes", RUN_DATE).first().status
    return control.read_dates(spark, f"{root}/dates", RUN_DATE).withColumn("status", F.lit(note))


@query(
    sql.with_frames(
        sql.CRASH_KEYS,
        """SELECT feed, tenant, min(report_date) AS first_day, max(report_date) AS last_day
FROM (SELECT *, report_date - CAST(row_number() OVER (PARTITION BY feed, tenant ORDER BY report_date) AS INTEGER) AS began
  FROM (SELECT DISTINCT feed, tenant, report_date FROM crash_keys WHERE day(report_date) % 10 <> 0))
GROUP BY feed, tenant, began""",
    )
)
def published_day_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts published by two runs, folded into day runs, with a gap every tenth day."""
    path = f"{new_folder(spark, 'published')}/published"
    keys = frames.crash_keys(spark, sf_dir).filter(F.dayofmonth("report_date") % 10 != 0)
    catalog = ops.file_catalog(keys)
    control.publish_parts(catalog.filter(F.dayofmonth("report_date") < 15), path, date(2024, 1, 31))
    control.fold_parts(spark, path, most=0)
    control.publish_parts(catalog, path, RUN_DATE)
    return control.day_runs(control.read_parts(spark, path))
