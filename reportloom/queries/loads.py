"""Tables filled, replaced and checked; the ready-made loads."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom import frames
from reportloom.config import LoadConfig, Target
from reportloom.functions.dates import month_like_pattern
from reportloom.operators.cooking import (
    cook_devices,
    cook_earnings,
    cook_feeds,
    cook_sales,
)
from reportloom.operators.filters import in_text_month
from reportloom.operators.freshness import feed_dates, route_feed
from reportloom.plans import loads as plans
from reportloom.plans.staging import processed_columns, read_published, stage
from reportloom.queries import frames_sql as sql
from reportloom.queries.registry import query
from reportloom.schemas import (
    CRASH_FEED_NAMES,
    CRASH_FEEDS,
    EARNINGS_DAY,
    INSTALLS_FEED,
    FeedColumn,
)
from reportloom.sinks import exports, statistics, tables, targets
from reportloom.sinks.control import read_status
from reportloom.sinks.raw_objects import keep_objects, read_objects
from reportloom.sources.manifests import load_from_manifest
from reportloom.sources.reports import (
    read_cooked_csv,
    read_earnings,
    read_supported_devices,
    union_objects,
)
from reportloom.workspace import new_folder

BY_DAY = tables.Layout("crash_date", grain="day")
BY_MONTH = tables.Layout("crash_date")
RUN_DATE = date(2024, 2, 1)
REPLACED_FROM = date(2024, 1, 20)
TARGETS = (
    Target("first"),
    Target("second", skip=frozenset(CRASH_FEED_NAMES), tables={"supported_devices": "other_devices"}),
    Target("third", tables={"overview": "crash_overview"}),
)
EARNINGS_RESULT = ["description", "transaction_date", "tax_type", "tenant", "amount_merchant_currency"]


def _crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cook_feeds(frames.crash_raw(spark, sf_dir), CRASH_FEEDS)


def _crash_batch(crashes: DataFrame) -> DataFrame:
    """A later delivery: the last days, one account only, changed numbers."""
    late = (F.col("crash_date") >= F.lit(REPLACED_FROM)) & (F.col("tenant") == "tenant_a")
    return crashes.filter(late).withColumn("daily_crashes", F.col("daily_crashes") + 1)


def _replaced(spark: SparkSession, sf_dir: str, layout: tables.Layout) -> DataFrame:
    path = new_folder(spark, "crash-table")
    crashes = _crashes(spark, sf_dir)
    placed = layout.place(crashes)
    tables.write_table(placed, path, layout.partition_by)
    tables.replace_by_date(_crash_batch(crashes), path, layout)
    return layout.rows(tables.read_table(spark, path, placed.schema))


_REPLACED_SQL = sql.with_frames(
    sql.CRASH_COOKED,
    """SELECT crash_date, package_name, dimension,
  daily_crashes + CASE WHEN crash_date >= DATE '2024-01-20' THEN 1 ELSE 0 END AS daily_crashes,
  daily_anrs, tenant, feed
FROM crash_cooked c
WHERE crash_date < DATE '2024-01-20' OR tenant = 'tenant_a' OR NOT EXISTS (
  SELECT 1 FROM crash_cooked b WHERE b.tenant = 'tenant_a' AND b.feed = c.feed
    AND b.crash_date = c.crash_date)""",
)


@query(_REPLACED_SQL)
def replace_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, BY_DAY)


@query(_REPLACED_SQL)
def replace_by_date_in_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, BY_MONTH)


@query(
    sql.with_frames(
        sql.CRASH_COOKED,
        """SELECT crash_date, package_name, dimension,
  daily_crashes + CASE WHEN crash_date >= DATE '2024-01-20' THEN 1 ELSE 0 END AS daily_crashes,
  daily_anrs, tenant, feed
FROM crash_cooked c
WHERE crash_date < DATE '2024-01-20' OR tenant = 'tenant_a' OR NOT EXISTS (
  SELECT 1 FROM crash_cooked b WHERE b.tenant = 'tenant_a' AND b.crash_date = c.crash_date)""",
    )
)
def replace_rows_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    crashes = _crashes(spark, sf_dir)
    batch = _crash_batch(crashes)
    path = new_folder(spark, "dates")
    feed_dates(batch.withColumnRenamed("crash_date", "report_date")).select(
        F.col("report_date").alias("crash_date")
    ).distinct().write.parquet(path)
    return tables.replace_rows_by_date(
        crashes, batch, spark.read.parquet(path), "crash_date"
    )


@query(
    sql.with_frames(sql.DEVICES, "SELECT * FROM devices"),
)
def replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "devices")
    devices = cook_devices(
        frames.devices_raw(spark, sf_dir).withColumn(
            "marketing_name", F.translate("marketing_name", "\t", "")
        )
    )
    tables.replace_all(devices.withColumn("model", F.lit("old")), path)
    tables.replace_all(devices, path)
    return spark.read.parquet(path)


_MONTH_SQL = sql.with_frames(
    sql.EARNINGS_RAW,
    """, last AS (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 DAY AS d FROM orders),
pattern AS (SELECT strftime(d, '%b') || '%' || strftime(d, '%Y') AS p FROM last)
SELECT description, transaction_date, tenant,
  CASE WHEN regexp_matches(tax_type, '^\\s*$') THEN NULL ELSE tax_type END AS tax_type,
  CASE WHEN transaction_date LIKE p THEN CAST(amount_merchant_currency AS DECIMAL(18,6))
    ELSE CAST(0 AS DECIMAL(18,6)) END AS amount_merchant_currency
FROM earnings_raw, pattern""",
)


def _last_order_day(spark: SparkSession, sf_dir: str) -> date:
    orders = frames.table(spark, sf_dir, "orders")
    return orders.agg(F.max(F.col("o_orderdate").cast("date"))).first()[0]


def _old_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    earnings = cook_earnings(frames.earnings_raw(spark, sf_dir))
    zero = F.lit(0).cast("decimal(18,6)")
    return earnings.withColumn("amount_merchant_currency", zero)


def _earnings_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    schema = like.withColumn(tables.TEXT_MONTH, F.lit("")).schema
    return tables.read_table(spark, path, schema).select(*EARNINGS_RESULT)


@query(_MONTH_SQL)
def replace_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "earnings-table")
    old = _old_earnings(spark, sf_dir)
    tables.write_earnings(old, path)
    config = LoadConfig({}, _last_order_day(spark, sf_dir), path)
    month = config.earnings_month()
    pattern = month_like_pattern(F.lit(config.run_date))
    raw = in_text_month(
        frames.earnings_raw(spark, sf_dir),
        "transaction_date",
        spark.range(1).select(pattern).first()[0],
    )
    tables.replace_by_month(cook_earnings(raw), path, plans.text_month_of(month))
    return _earnings_table(spark, path, old)


@query(
    sql.with_frames(
        sql.EARNINGS_RAW,
        """, last AS (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 DAY AS d FROM orders),
marks AS (SELECT strftime(d, '%b') || '%' || strftime(d, '%Y') AS p,
  strftime(d - INTERVAL 45 DAY, '%b') || '%' || strftime(d - INTERVAL 45 DAY, '%Y') AS before FROM last)
SELECT description, transaction_date, tenant,
  CASE WHEN regexp_matches(tax_type, '^\\s*$') THEN NULL ELSE tax_type END AS tax_type,
  CASE WHEN transaction_date LIKE p THEN CAST(amount_merchant_currency AS DECIMAL(18,6))
    ELSE CAST(0 AS DECIMAL(18,6)) END AS amount_merchant_currency
FROM earnings_raw, marks
UNION ALL
SELECT description, transaction_date, tenant,
  CASE WHEN regexp_matches(tax_type, '^\\s*$') THEN NULL ELSE tax_type END,
  CAST(amount_merchant_currency AS DECIMAL(18,6))
FROM earnings_raw, marks WHERE transaction_date LIKE before AND tenant = 'tenant_a'""",
    )
)
def replace_by_month_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month whose batch holds rows of two other months, one of them new to the table,
    then of one, at last one account's rows of it: each correction takes back the last."""
    path = new_folder(spark, "earnings-corrected")
    old = _old_earnings(spark, sf_dir)
    tables.write_earnings(old, path)
    day = _last_order_day(spark, sf_dir)
    month = LoadConfig({}, day, path).earnings_month()
    earnings = cook_earnings(frames.earnings_raw(spark, sf_dir))
    text = F.col("transaction_date")
    of = earnings.filter(text.like(f"{month:%b}%{month:%Y}"))
    last_day = day.replace(day=1) - timedelta(days=1)
    before = last_day - timedelta(days=45)
    stray = earnings.filter(text.like(f"{before:%b}%{before:%Y}"))
    beyond = of.withColumn("transaction_date", F.lit("Jan 1, 2031"))
    label = plans.text_month_of(month)
    for batch in (union_objects([of, stray, beyond]), of.unionByName(stray), of.unionByName(stray.filter("tenant = 'tenant_a'"))):
        tables.replace_by_month(batch, path, label)
    return _earnings_table(spark, path, old)


@query(
    sql.with_frames(
        sql.CRASH_COOKED + ", " + sql.DEVICES,
        """, loads AS (
  SELECT * FROM (VALUES ('first', 'app_version', 'app_version'), ('first', 'device', 'device'),
    ('first', 'os_version', 'os_version'), ('first', 'overview', 'overview'),
    ('third', 'app_version', 'app_version'), ('third', 'device', 'device'),
    ('third', 'os_version', 'os_version'), ('third', 'overview', 'crash_overview')) v(endpoint, feed, table_name)),
dims AS (
  SELECT * FROM (VALUES ('first', 'supported_devices'), ('second', 'other_devices'),
    ('third', 'supported_devices')) v(endpoint, table_name))
SELECT endpoint, table_name, crash_date AS day, count(*) AS n_rows,
  CAST(sum(daily_crashes) AS BIGINT) AS total
FROM crash_cooked JOIN loads USING (feed) GROUP BY endpoint, table_name, crash_date
UNION ALL
SELECT endpoint, table_name, NULL, (SELECT count(*) FROM devices),
  (SELECT CAST(sum(CAST(model AS BIGINT)) AS BIGINT) FROM devices) FROM dims""",
    )
)
def load_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "targets")
    staged = stage(_crashes(spark, sf_dir), f"{root}/staged", BY_MONTH)
    feeds = targets.load_feeds(staged, root, TARGETS, CRASH_FEED_NAMES, BY_MONTH)
    devices = frames.devices_raw(spark, sf_dir)
    dimension = targets.load_dimension(
        cook_devices(devices), root, TARGETS, "supported_devices"
    )

    def summary(path: str, day, number) -> DataFrame:
        rows = spark.read.parquet(path).select(day.alias("day"), number.alias("v"))
        return rows.groupBy("day").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("v").alias("total")
        )

    crash = [
        summary(f"{root}/{e}/{t}", F.col("crash_date"), F.col("daily_crashes")).select(
            F.lit(e).alias("endpoint"), F.lit(t).alias("table_name"), "*"
        )
        for e, _, t in feeds
    ]
    dims = [
        summary(f"{root}/{e}/{t}", F.lit(None).cast("date"), F.col("model").cast("bigint")).select(
            F.lit(e).alias("endpoint"), F.lit(t).alias("table_name"), "*"
        )
        for e, _, t in dimension
    ]
    return union_objects([*crash, *dims])


@query(
    sql.with_frames(
        sql.CRASH_COOKED,
        """SELECT feed, crash_date, count(*) AS source_rows, count(*) AS written_rows, true AS ok
FROM crash_cooked GROUP BY feed, crash_date""",
    )
)
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "crash-table")
    crashes = _crashes(spark, sf_dir)
    placed = BY_MONTH.place(crashes)
    tables.write_checked(placed, path, BY_MONTH.partition_by)
    written = tables.read_table(spark, path, placed.schema)
    return tables.reconcile_counts(crashes, written, BY_MONTH.keys)


_STATS_COLUMNS = (
    "order_date", "tenant", "product_id", "product_type", "financial_status", "order_timestamp", "item_price",
)


def _stats_sql(measures: str) -> str:
    return sql.with_frames(
        sql.SALES_COOKED,
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, {measures.format(c=c)}
  CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM sales_cooked"""
            for c in _STATS_COLUMNS
        ),
    )


@query(_stats_sql("count(DISTINCT {c}) AS distinct_count,"))
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = cook_sales(frames.sales_raw(spark, sf_dir))
    return statistics.exact_stats(sales, _STATS_COLUMNS)


@query(_stats_sql(""))
def column_stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table filled in two runs; the second one reads the partitions that it replaced."""
    root = new_folder(spark, "statistics")
    sales = cook_sales(frames.sales_raw(spark, sf_dir)).withColumn("feed", F.lit("sales"))
    layout = tables.Layout("order_date")
    placed = layout.place(sales)
    late = F.col("order_date") >= F.lit(date(1997, 1, 1))
    for batch in (placed.withColumn("product_id", F.when(late, "zzz").otherwise(F.col("product_id"))), placed.filter(late)):
        tables.replace_partitions(batch, f"{root}/table", layout.partition_by)
        table = tables.read_table(spark, f"{root}/table", placed.schema)
        days = tables.days_of(batch, layout)
        statistics.note_statistics(spark, table, layout, days, _STATS_COLUMNS, f"{root}/statistics")
    return spark.read.parquet(f"{root}/statistics/columns").drop("distinct_count")


@query(_stats_sql(""))
def column_stats_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All but the approximate counts of distinct values."""
    sales = cook_sales(frames.sales_raw(spark, sf_dir))
    return tables.column_stats(sales, _STATS_COLUMNS).drop("distinct_count")


@query(
    sql.with_frames(
        sql.SALES_COOKED,
        """, shared AS (SELECT sale_key, count(*) AS n FROM sales_cooked GROUP BY sale_key)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(sale_key) AS n_keys,
  count(sale_key) FILTER (n > 1) AS n_shared_keys FROM shared""",
    )
)
def sale_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.key_uniqueness(cook_sales(frames.sales_raw(spark, sf_dir)), "sale_key")


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        "SELECT c0, c1, c2, c3, c4, feed, tenant, DATE '2024-02-01' AS run_date FROM crash_raw",
    )
)
def raw_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "raw-zone")
    raw = frames.crash_raw(spark, sf_dir).drop("event_id", "event_type")
    kept = exports.keep_raw(raw, path, RUN_DATE)
    return kept.withColumn("run_date", F.lit(RUN_DATE))


# The feeds of the crash load that have new days, as in the freshness queries:
# the day after the latest complete one is there for all four.
def _crash_config(
    spark: SparkSession, sf_dir: str, root: str, raw: DataFrame | None = None, width: int = 5
) -> LoadConfig:
    """Crash reports written as objects below ``root``, and a run over them."""
    raw = frames.crash_raw(spark, sf_dir) if raw is None else raw
    name = F.concat(
        F.lit("crashes_com.example."), F.col("event_type"), F.lit("_202401_"),
        F.col("feed"), F.lit(".csv"),
    )
    roots = frames.write_objects(raw.withColumn("object", name), root, "crashes", width)
    return LoadConfig(roots, RUN_DATE, f"{root}/out", load="crashes", backfill=2)


@query(sql.with_frames(sql.CRASH_COOKED, "SELECT * FROM crash_cooked"))
def crashes_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "crashes-load")
    config = _crash_config(spark, sf_dir, root)
    published = frames.published(frames.crash_keys(spark, sf_dir))
    return plans.load_crashes(spark, config, published, f"{root}/table").table


_SEEN_SQL = """SELECT CAST(c0 AS DATE) AS crash_date, c1 AS package_name,
  CASE WHEN feed <> 'overview' THEN replace(dimension, '%', '') END AS dimension,
  CAST(replace(crashes, ',', '') AS BIGINT) AS daily_crashes, CAST(replace(anrs, '%', '') AS DECIMAL(18,2)) AS daily_anrs,
  CASE WHEN event_id % 4 < 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen_at,
  CAST(c0 AS DATE) + 1 AS due_on, tenant, feed FROM crash_events JOIN events USING (event_id)"""


@query(sql.with_frames(sql.CRASH_RAW, _SEEN_SQL))
def crashes_load_with_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of feeds that have a time and a second date, each in several spellings."""
    root = new_folder(spark, "crashes-times")
    raw = frames.crash_raw(spark, sf_dir).join(frames.table(spark, sf_dir, "events").select("event_id", "ts"), "event_id")
    seen, due = F.lit(" "), F.date_add(F.col("c0").cast("date"), 1)
    for i, pattern in enumerate(["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MMM d, yyyy h:mm:ss a"]):
        seen = F.when(F.col("event_id") % 4 == i, F.date_format("ts", pattern)).otherwise(seen)
    due = F.when(F.col("event_id") % 2 == 0, F.date_format(due, "MMM d, yyyy")).otherwise(F.date_format(due, "M/d/yyyy"))
    config = _crash_config(spark, sf_dir, root, raw.withColumns({"c5": seen, "c6": due}), 7)
    specs = tuple(
        replace(spec, columns=(
            *spec.columns, FeedColumn("seen_at", 5, "time", "timestamp"), FeedColumn("due_on", 6, "any_date", "date")
        ))
        for spec in CRASH_FEEDS
    )
    published = frames.published(frames.crash_keys(spark, sf_dir))
    table = plans.load_crashes(spark, replace(config, crash_feeds=specs), published, f"{root}/table").table
    return table.withColumn("seen_at", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss"))


def _from_manifests(spark: SparkSession, config: LoadConfig, job: str, table: DataFrame) -> DataFrame:
    """The rows of a load as its published manifests list them, in the table's types."""
    fields = processed_columns(table)
    manifests = f"{config.output_root}/control/{job}/manifests"
    feeds = [r.feed for r in spark.read.text(manifests).select("feed").distinct().collect()]

    def read(feed: str) -> DataFrame:
        rows = load_from_manifest(
            spark, f"{manifests}/run_date={config.run_date}/feed={feed}",
            lambda paths: read_cooked_csv(spark, paths, fields),
        )
        tenant = F.regexp_extract("source_file", "p_tenant=([^/]*)/", 1).alias("tenant")
        return rows.select(*fields, tenant, F.lit(feed).alias("feed"))

    rows = union_objects([read(f) for f in feeds])
    types = dict(table.dtypes)
    return rows.select(*(F.col(c).cast(types[c]).alias(c) for c in table.columns))


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        """SELECT feed, max(CASE WHEN tenant = 'tenant_a' THEN 1 ELSE 0 END) AS in_report, 'error' AS branch
FROM crash_raw GROUP BY feed""",
    )
)
def route_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each feed goes after a run that a row of surplus fields ended."""
    root = new_folder(spark, "failed-load")
    raw = frames.crash_raw(spark, sf_dir)
    name = F.concat(F.lit("crashes_com.example."), F.col("event_type"), F.lit("_202401_"), F.col("feed"), F.lit(".csv"))
    wide = raw.withColumn("object", name).withColumn("c5", F.lit("")).withColumn("c6", F.lit("beyond"))
    config = LoadConfig(frames.write_objects(wide, root, "crashes", 7), RUN_DATE, f"{root}/out", load="crashes", backfill=2)
    nothing = frames.published(frames.crash_keys(spark, sf_dir)).filter(F.lit(False))
    try:
        plans.load_crashes(spark, config, nothing, f"{root}/table")
    except Exception as error:  # the run's error, which its note tells the branch
        if "more than 5 columns" not in str(error):
            raise
    note = read_status(spark, f"{config.output_root}/control/crashes/status", "crashes", RUN_DATE).first().status
    feeds = raw.groupBy("feed").agg(F.max((F.col("tenant") == "tenant_a").cast("int")).alias("in_report"))
    branch = F.regexp_replace(route_feed(F.lit(note), F.col("feed")), "^(new_|no_new_).*", "$1")
    return feeds.select("feed", "in_report", branch.alias("branch"))


@query(sql.with_frames(sql.CRASH_COOKED, "SELECT * FROM crash_cooked"))
def crashes_load_from_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "crashes-manifest")
    config = _crash_config(spark, sf_dir, root)
    published = frames.published(frames.crash_keys(spark, sf_dir))
    result = plans.load_crashes(spark, config, published, f"{root}/table")
    return _from_manifests(spark, config, "crashes", result.table)


@query(
    sql.with_frames(
        sql.CRASH_COOKED,
        """SELECT c.*, r.run, r.status FROM crash_cooked c CROSS JOIN (VALUES
  (1, '[''app_version'', ''device'', ''os_version'', ''overview'']'),
  (2, 'No New Data'),
  (3, '[''app_version'', ''device'', ''os_version'', ''overview'']'),
  (4, 'No New Data')) r(run, status)""",
    )
)
def crashes_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs on one date: the daily one, again, a reload of the months, the daily one."""
    root = new_folder(spark, "crashes-twice")
    config = replace(_crash_config(spark, sf_dir, root), targets=TARGETS)
    reload = replace(config, date_format="Range", start_date="2024-01", end_date="2024-02")
    seeded = frames.published(frames.crash_keys(spark, sf_dir))
    states = []
    for run, settings in enumerate((config, config, reload, config), 1):
        published = read_published(spark, config.output_root, "crashes")
        found = plans.load_crashes(spark, settings, seeded if run == 1 else published, f"{root}/table")
        table = f"{root}/state-{run}"
        rows = spark.read.parquet(f"{root}/table").drop(BY_MONTH.month_column)
        rows.withColumn("run", F.lit(run)).withColumn("status", F.lit(found.status)).write.parquet(table)
        states.append(spark.read.parquet(table))
    return union_objects(states)


@query(
    sql.with_frames(
        sql.CRASH_COOKED,
        """SELECT crash_date,
  package_name || CASE WHEN crash_date >= DATE '2024-01-20' THEN '.late' ELSE '' END AS package_name,
  dimension, daily_crashes, daily_anrs, tenant, feed, place
FROM crash_cooked CROSS JOIN (VALUES ('table'), ('first'), ('third')) v(place)""",
    )
)
def crashes_load_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all reports, then one over a later delivery of the last days only."""
    root = new_folder(spark, "crashes-second")
    raw = frames.crash_raw(spark, sf_dir)
    late = raw.filter(F.col("c0") >= f"{REPLACED_FROM}").withColumn("c1", F.concat("c1", F.lit(".late")))
    settings = {"date_format": "Range", "start_date": "2024-01", "end_date": "2024-02", "targets": TARGETS}
    nothing = frames.published(frames.crash_keys(spark, sf_dir)).filter(F.lit(False))
    for number, rows in enumerate((raw, late)):
        config = _crash_config(spark, sf_dir, f"{root}/in-{number}", rows)
        config = replace(config, output_root=f"{root}/out", **settings)
        table = plans.load_crashes(spark, config, nothing, f"{root}/table").table
    places = [table.withColumn("place", F.lit("table"))]
    for endpoint, feed, name in targets.planned_loads(TARGETS, config.feeds()):
        rows = spark.read.parquet(f"{root}/out/tables/{endpoint}/{name}")
        places.append(rows.select(*(c for c in table.columns if c != "feed"), F.lit(feed).alias("feed"), F.lit(endpoint).alias("place")))
    return union_objects(places)


@query(
    sql.with_frames(
        sql.INSTALLS_RAW,
        """SELECT CAST(c0 AS DATE) AS install_date, c1 AS package_name, c2 AS country,
  CAST(replace(c3, ',', '') AS BIGINT) AS daily_installs, CAST(c4 AS BIGINT) AS daily_uninstalls,
  tenant, 'installs_country' AS feed
FROM installs_raw WHERE tenant <> 'tenant_b' OR lower(c1) = 'com.example.keep'""",
    )
)
def installs_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "installs-load")
    raw = frames.installs_raw(spark, sf_dir)
    name = F.concat(F.lit("installs_com.example."), F.col("event_type"), F.lit("_202401_country.csv"))
    width = INSTALLS_FEED.width
    roots = frames.write_objects(raw.withColumn("object", name), root, "installs", width)
    config = LoadConfig(
        roots, RUN_DATE, f"{root}/out", load="installs", backfill=2,
        restricted=frames.RESTRICTED, optional_tenants=frozenset({"tenant_b"}),
    )
    nothing = frames.published(frames.crash_keys(spark, sf_dir)).filter(F.lit(False))
    return plans.load_installs(spark, config, nothing, f"{root}/table").table


@query(
    sql.with_frames(
        sql.CRASH_COOKED,
        """SELECT c.*, r.run, r.status FROM crash_cooked c CROSS JOIN (VALUES
  (1, '[''app_version'', ''device'', ''os_version'', ''overview'']'), (2, 'No New Data')) r(run, status)""",
    )
)
def crashes_load_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that read changed objects only; files whose lines are records are split."""
    root = new_folder(spark, "crashes-changed")
    config = replace(_crash_config(spark, sf_dir, root), changed_only=True, split_reports=True, processed=False)
    published = frames.published(frames.crash_keys(spark, sf_dir))
    states = []
    for run in (1, 2):
        # The same state of what is published: only the objects say that there is nothing.
        found = plans.load_crashes(spark, config, published, f"{root}/table")
        rows = spark.read.parquet(f"{root}/table").drop(BY_MONTH.month_column)
        states.append(rows.withColumn("run", F.lit(run)).withColumn("status", F.lit(found.status)))
    return union_objects(states)


@query(
    """SELECT 'documents/' || CAST(doc_id AS VARCHAR) AS path, CAST(strlen(text) AS BIGINT) AS length,
  sha256(text) AS sha256, text, CAST(1 AS BIGINT) AS copies FROM documents WHERE text IS NOT NULL"""
)
def raw_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of two deliveries, of which the second has all of the first: each content is kept once."""
    root = new_folder(spark, "raw-objects")
    objects = frames.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    for day, part in ((RUN_DATE, objects.filter(F.col("path").endswith("1"))), (RUN_DATE + timedelta(1), objects)):
        keep_objects(part, root, day)
    kept = read_objects(spark, root, RUN_DATE + timedelta(1))
    copies = spark.read.parquet(f"{root}/contents").groupBy("sha256").agg(F.count("*").alias("copies"))
    return kept.join(copies, "sha256").select(
        "path", "length", "sha256", F.decode("content", "UTF-8").alias("text"), "copies"
    )


def _sales_load(
    spark: SparkSession, sf_dir: str, root: str, processed: bool
) -> tuple[LoadConfig, DataFrame]:
    config = LoadConfig(
        dict.fromkeys(frames.TENANTS, root), RUN_DATE, f"{root}/out", load="sales",
        date_format="Range", start_date="1990-01", end_date="2030-12",
        restricted=frames.RESTRICTED, processed=processed,
    )
    raw = frames.sales_raw(spark, sf_dir)
    nothing = frames.published(frames.crash_keys(spark, sf_dir)).filter(F.lit(False))
    return config, plans.load_sales(spark, config, raw, nothing, f"{root}/table").table


_SALES_LOAD_SQL = sql.with_frames(
    sql.SALES_COOKED,
    """SELECT *, 'sales' AS feed FROM sales_cooked
WHERE tenant <> 'tenant_b' OR product_id = 'com.example.keep'""",
)


@query(_SALES_LOAD_SQL)
def sales_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_load(spark, sf_dir, new_folder(spark, "sales-load"), processed=False)[1]


@query(_SALES_LOAD_SQL)
def sales_load_from_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    config, table = _sales_load(spark, sf_dir, new_folder(spark, "sales-manifest"), processed=True)
    return _from_manifests(spark, config, "sales", table)


@query(_SALES_LOAD_SQL)
def sales_load_from_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zipped reports of all months, scanned, loaded, with processed files and a raw zone."""
    root = new_folder(spark, "sales-zips")
    config = LoadConfig(
        frames.write_sales_zips(spark, sf_dir, root), RUN_DATE, f"{root}/out", load="sales", date_format="Range",
        start_date="1990-01", end_date="2030-12", restricted=frames.RESTRICTED, keep_raw=True,
    )
    plans.load_store(spark, config, f"{root}/table")
    table = spark.read.parquet(f"{root}/table/sales").drop("order_date_month")
    return table.withColumn("feed", F.lit("sales"))


@query(_MONTH_SQL)
def earnings_load_from_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zips of the month found below the accounts' roots, and read member by member."""
    root = new_folder(spark, "earnings-zips")
    old = _old_earnings(spark, sf_dir)
    tables.write_earnings(old, f"{root}/table")
    config = LoadConfig(frames.write_earnings_zips(frames.earnings_archives(spark, sf_dir), root), _last_order_day(spark, sf_dir), f"{root}/out")
    archives = plans.scan_earnings_archives(spark, config, f"{config.earnings_month():%Y%m}")
    plans.load_earnings(config, archives, f"{root}/table")
    return _earnings_table(spark, f"{root}/table", old)


@query(_MONTH_SQL)
def earnings_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _earnings_load(spark, sf_dir, new_folder(spark, "earnings-load"), runs=1)


@query(_MONTH_SQL)
def earnings_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _earnings_load(spark, sf_dir, new_folder(spark, "earnings-twice"), runs=2)


@query(
    sql.with_frames(
        sql.EARNINGS_RAW,
        """, last AS (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 DAY AS d FROM orders)
SELECT description, transaction_date, CAST(strptime(transaction_date, '%b %-d, %Y') AS DATE) AS transaction_day,
  tenant, product_title, CAST(amount_merchant_currency AS DECIMAL(18,6)) AS amount_merchant_currency
FROM earnings_raw, last
WHERE transaction_date LIKE strftime(d, '%b') || '%' || strftime(d, '%Y')""",
    )
)
def earnings_load_from_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unzipped files of the loaded month as the manifests of the accounts list them."""
    root = new_folder(spark, "earnings-manifest")
    _earnings_load(spark, sf_dir, root, runs=2)
    config = LoadConfig({}, _last_order_day(spark, sf_dir), f"{root}/out")
    manifests = f"{config.output_root}/control/earnings/manifests/{config.earnings_month():%Y%m}"

    def read(tenant: str) -> DataFrame | None:
        path = f"{manifests}/run_date={config.run_date}/feed={tenant}"
        rows = load_from_manifest(spark, path, lambda paths: read_earnings(spark, paths))
        return rows if rows is None else cook_earnings(rows.withColumn("tenant", F.lit(tenant)))

    found = [rows for rows in map(read, frames.TENANTS) if rows is not None]
    return union_objects(found).select(
        "description", "transaction_date", EARNINGS_DAY, "tenant", "product_title", "amount_merchant_currency"
    )


def _earnings_load(spark: SparkSession, sf_dir: str, root: str, runs: int) -> DataFrame:
    old = _old_earnings(spark, sf_dir)
    tables.write_earnings(old, f"{root}/table")
    config = LoadConfig(
        dict.fromkeys(frames.TENANTS, root), _last_order_day(spark, sf_dir), f"{root}/out"
    )
    month = f"{config.earnings_month():%Y%m}"
    archives = frames.earnings_archives(spark, sf_dir, month)
    for _ in range(runs):
        plans.load_earnings(config, archives, f"{root}/table")
    return _earnings_table(spark, f"{root}/table", old)


@query(
    sql.with_frames(
        sql.DEVICES,
        """SELECT v.endpoint, v.table_name, d.* FROM devices d CROSS JOIN (VALUES
  ('first', 'supported_devices'), ('second', 'other_devices'), ('third', 'supported_devices')
) v(endpoint, table_name)""",
    )
)
def devices_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "devices-load")
    frames.write_devices(frames.devices_raw(spark, sf_dir), f"{root}/csv")
    config = LoadConfig({}, RUN_DATE, root, targets=TARGETS)
    done = plans.load_devices(spark, f"{root}/csv", config)
    return union_objects(
        [
            rows.select(F.lit(e).alias("endpoint"), F.lit(t).alias("table_name"), "*")
            for e, _, t, rows in targets.read_loads(spark, f"{root}/tables", done)
        ]
    )


@query(sql.with_frames(sql.DEVICES, "SELECT * FROM devices"))
def devices_load_from_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "devices-manifest")
    frames.write_devices(frames.devices_raw(spark, sf_dir), f"{root}/csv")
    config = LoadConfig({}, RUN_DATE, f"{root}/out", targets=TARGETS)
    plans.load_devices(spark, f"{root}/csv", config)
    path = f"{config.output_root}/control/devices/manifests/run_date={RUN_DATE}/feed={plans.DEVICES}"
    return cook_devices(load_from_manifest(spark, path, lambda paths: read_supported_devices(spark, paths)))
