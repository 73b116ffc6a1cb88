"""Column functions and row filters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom import frames
from reportloom.functions import clean, dates, names
from reportloom.operators import filters
from reportloom.operators.cooking import cook_feeds
from reportloom.queries import frames_sql as sql
from reportloom.queries.registry import query
from reportloom.schemas import (
    CRASH_FEEDS,
    SALES_COLUMNS,
    SALES_NUMBERS,
    SALES_WIDTH,
    positional,
)
from reportloom.sources.archives import split_lines
from reportloom.sources.reports import PLAIN_REPORT, read_report_lines
from reportloom.sources.reports import union_objects as union_frames
from reportloom.workspace import new_folder

CRASH_FIELDS = positional(5)
KEEP_CLICK = {"tenant_b": "com.example.click"}


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        """SELECT event_id,
  CAST(replace(replace(c3, ',', ''), '%', '') AS BIGINT) AS metric_3,
  CAST(replace(replace(c4, ',', ''), '%', '') AS DECIMAL(18,2)) AS metric_4
FROM crash_raw""",
    )
)
def clean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.crash_raw(spark, sf_dir).select(
        "event_id",
        clean.to_metric(F.col("c3"), "bigint").alias("metric_3"),
        clean.to_metric(F.col("c4"), "decimal(18,2)").alias("metric_4"),
    )


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        "SELECT event_id, replace(c1, '%', '') AS text_1, replace(c2, '%', '') AS text_2 FROM crash_raw",
    )
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.crash_raw(spark, sf_dir).select(
        "event_id",
        clean.clean_text(F.col("c1")).alias("text_1"),
        clean.clean_text(F.col("c2")).alias("text_2"),
    )


@query(sql.with_frames(sql.CRASH_COOKED, "SELECT * FROM crash_cooked"))
def cook_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cook_feeds(frames.crash_raw(spark, sf_dir), CRASH_FEEDS)


@query(
    sql.with_frames(
        sql.SALES_RAW,
        "SELECT o_orderkey, "
        + ", ".join(
            f"replace(replace(c{i}, ',', ''), '%', '') AS {c}"
            if i in SALES_NUMBERS
            else f"replace(c{i}, '%', '') AS {c}"
            for i, c in enumerate(SALES_COLUMNS)
        )
        + " FROM sales_raw",
    )
)
def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = [
        clean.clean_sales_column(i, F.col(f"c{i}")).alias(c)
        for i, c in enumerate(SALES_COLUMNS)
    ]
    return frames.sales_raw(spark, sf_dir).select("o_orderkey", *cleaned)


@query(
    sql.with_frames(
        sql.SALES_RAW,
        f"SELECT {', '.join(positional(SALES_WIDTH))} FROM sales_raw",
    )
)
def cap_sales_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frames.sales_raw(spark, sf_dir)
    return raw.select(*clean.cap_width([c for c in raw.columns if c.startswith("c")]))


@query(
    sql.with_frames(
        sql.SALES_RAW,
        "SELECT o_orderkey, md5(replace(c0, '-', '') || c3) AS sale_key FROM sales_raw",
    )
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.sales_raw(spark, sf_dir).select(
        "o_orderkey", clean.surrogate_key(F.col("c0"), F.col("c3")).alias("sale_key")
    )


@query(
    sql.with_frames(
        sql.SALES_RAW,
        """SELECT o_orderkey, c7 AS before,
  CASE WHEN regexp_matches(c7, '^\\s*$') THEN NULL ELSE c7 END AS after
FROM sales_raw""",
    )
)
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.sales_raw(spark, sf_dir).select(
        "o_orderkey",
        F.col("c7").alias("before"),
        clean.blank_to_null(F.col("c7")).alias("after"),
    )


@query(
    sql.with_frames(
        sql.LOCAL_NAMES,
        """, base AS (SELECT event_id, regexp_extract(name, '[^/]*$') AS b FROM local_names)
SELECT event_id, CASE WHEN contains(b, 'app_version') THEN 'app_version'
  WHEN contains(b, 'device') THEN 'device' WHEN contains(b, 'os_version') THEN 'os_version'
  WHEN contains(b, 'overview') THEN 'overview' END AS feed FROM base""",
    )
)
def classify_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.local_names(spark, sf_dir).select(
        "event_id", names.classify_feed(F.col("name")).alias("feed")
    )


@query(
    sql.with_frames(
        sql.LOCAL_NAMES,
        """SELECT event_id, CASE WHEN contains(name, 'tenant_b') THEN 'tenant_b'
  WHEN contains(name, 'tenant_a') THEN 'tenant_a' END AS tenant FROM local_names""",
    )
)
def classify_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.local_names(spark, sf_dir).select(
        "event_id", names.classify_tenant(F.col("name"), frames.TENANTS).alias("tenant")
    )


@query(
    sql.with_frames(
        sql.OBJECT_NAMES,
        """, reports AS (SELECT event_id, name, CASE
    WHEN regexp_matches(name, '^earnings/earnings_(202312|202401)_.*\\.zip') THEN 'earnings'
    WHEN regexp_matches(name, '^sales/salesreport_(202312|202401)\\.zip') THEN 'sales'
    WHEN regexp_matches(name, '^stats/installs/installs_.*_(202312|202401)_country.csv') THEN 'stats_installs_country'
    WHEN regexp_matches(name, '^stats/installs/installs_.*_(202312|202401)_device.csv') THEN 'stats_installs_device'
  END AS report FROM object_names)
SELECT event_id, name, report, CASE WHEN report IN ('earnings', 'sales') THEN report
  WHEN report IS NOT NULL THEN 'stats/installs' END AS sub_folder FROM reports""",
    )
)
def match_report_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = names.match_report(F.col("name"), ["202312", "202401"])
    return (
        frames.object_names(spark, sf_dir)
        .select("event_id", "name", report.alias("report"))
        .withColumn("sub_folder", names.sub_folder(F.col("report")))
    )


@query(
    sql.with_frames(
        sql.OBJECT_NAMES,
        """, parts AS (SELECT event_id, string_split(name, '/')[-1] AS base_name FROM object_names),
ext AS (SELECT *, string_split(base_name, '.')[-1] AS extension FROM parts)
SELECT event_id, base_name, extension, replace(base_name, '.' || extension, '') AS stem,
  string_split(replace(base_name, '.zip', ''), '-')[-1] AS archive_number FROM ext""",
    )
)
def object_name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    base = names.base_name(name)
    return frames.object_names(spark, sf_dir).select(
        "event_id",
        base.alias("base_name"),
        names.extension(base).alias("extension"),
        names.stem(base).alias("stem"),
        names.archive_number(name).alias("archive_number"),
    )


@query(
    """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed
FROM orders"""
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    spellings = ["yyyy-MM-dd", "yyyy-M-d", "MMM d, yyyy", "M/d/yyyy", "d MMM yyyy", "yyyyMMdd"]
    written = F.lit("not a date")
    for i, pattern in enumerate(spellings):
        written = F.when(key % 7 == i, F.date_format(day, pattern)).otherwise(written)
    texts = frames.table(spark, sf_dir, "orders").select("o_orderkey", written.alias("written"))
    return texts.select(
        "o_orderkey", dates.parse_auto_date(F.col("written")).alias("parsed")
    )


@query(
    """SELECT event_id,
  CASE WHEN event_id % 4 = 3 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
FROM events"""
)
def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    time, key = F.col("ts"), F.col("event_id")
    written = F.lit("not a time")
    for i, pattern in enumerate(["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MMM d, yyyy h:mm:ss a"]):
        written = F.when(key % 4 == i, F.date_format(time, pattern)).otherwise(written)
    texts = frames.table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    parsed = dates.parse_auto_time(F.col("written"))
    return texts.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date FROM orders")
def strict_report_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frames.sales_raw(spark, sf_dir)
    return raw.select(
        "o_orderkey", dates.strict_report_date(F.col("c1")).alias("report_date")
    )


@query(
    sql.with_frames(
        sql.SALES_RAW,
        """SELECT o_orderkey, tenant, c6 FROM sales_raw
WHERE tenant <> 'tenant_b' OR c6 = 'com.example.keep'""",
    )
)
def filter_product_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.keep_product(frames.sales_raw(spark, sf_dir), frames.RESTRICTED, "c6")
    return kept.select("o_orderkey", "tenant", "c6")


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        """SELECT event_id, tenant, c1 FROM crash_raw
WHERE tenant <> 'tenant_b' OR contains(lower(concat_ws(',', c0, c1, c2, c3, c4)), 'com.example.click')""",
    )
)
def filter_product_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frames.crash_raw(spark, sf_dir).withColumn("c1", F.upper("c1"))
    kept = filters.keep_product_mention(raw, KEEP_CLICK, CRASH_FIELDS)
    return kept.select("event_id", "tenant", F.lower("c1").alias("c1"))


@query(
    sql.with_frames(
        sql.EARNINGS_RAW,
        """, as_of AS (SELECT max(o_orderdate) AS d FROM orders),
pattern AS (SELECT strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%b') || '%'
  || strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%Y') AS p FROM as_of)
SELECT o_orderkey, tenant, transaction_date FROM earnings_raw, pattern
WHERE transaction_date LIKE p""",
    )
)
def filter_month_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = frames.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("d"))
    pattern = as_of.select(dates.month_like_pattern(F.col("d"))).first()[0]
    found = filters.in_text_month(
        frames.earnings_raw(spark, sf_dir), "transaction_date", pattern
    )
    return found.select("o_orderkey", "tenant", "transaction_date")


_LINE = "c0 || ',' || c1 || ',' || c2 || ',' || c3"


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        f"""SELECT 'Date,Package,Dimension,Value' AS line, CAST(0 AS INTEGER) AS line_no,
  CAST(event_id // 64 AS BIGINT) AS blob FROM crash_raw GROUP BY event_id // 64
UNION ALL
SELECT {_LINE}, CAST(event_id % 64 + 1 + CASE WHEN event_id % 64 >= 32 THEN 1 ELSE 0 END AS INTEGER),
  CAST(event_id // 64 AS BIGINT) FROM crash_raw""",
    )
)
def drop_repeated_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _repeated_downloads(spark, sf_dir)
    return filters.drop_repeated_headers(split_lines(texts, "blob", "text"))


@query(sql.with_frames(sql.CRASH_RAW, f"SELECT {_LINE} AS line FROM crash_raw"))
def drop_repeated_headers_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many downloads in a row, read by the line."""
    path = new_folder(spark, "downloads")
    _repeated_downloads(spark, sf_dir).select("text").write.text(path)
    return filters.drop_header_lines(read_report_lines(spark, path, PLAIN_REPORT)).select("line")


def _repeated_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(blob, text): a text is what two downloads in a row give, 64 events at most, two headers."""
    event = F.col("event_id")
    header = "Date,Package,Dimension,Value\n"
    line = F.struct(event, F.concat_ws(",", "c0", "c1", "c2", "c3").alias("line"))
    first = event % 64 < 32
    return (
        frames.crash_raw(spark, sf_dir)
        .groupBy(F.floor(event / 64).alias("blob"))
        .agg(
            F.array_sort(F.collect_list(F.when(first, line))).alias("a"),
            F.array_sort(F.collect_list(F.when(~first, line))).alias("b"),
        )
        .select(
            "blob",
            F.concat(
                F.lit(header), F.array_join("a.line", "\n"),
                F.when(F.size("b") > 0, F.concat(F.lit("\n" + header), F.array_join("b.line", "\n")))
                .otherwise(""),
            ).alias("text"),
        )
    )


@query(
    """SELECT o_orderkey,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y%m') AS back_1,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH, '%Y%m') AS back_2,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 13 MONTH, '%Y%m') AS back_13
FROM orders"""
)
def month_back_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *(
            dates.month_back_label(F.col("o_orderdate"), k).alias(f"back_{k}")
            for k in (1, 2, 13)
        ),
    )


@query(
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of, strftime(m, '%Y%m') AS month
FROM orders, unnest(generate_series(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH,
  date_trunc('month', o_orderdate), INTERVAL 1 MONTH)) AS t(m)"""
)
def month_window_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = frames.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("as_of")
    )
    return days.distinct().select(
        "as_of", F.explode(dates.past_months(F.col("as_of"), 3)).alias("month")
    )


@query(
    """SELECT o_custkey, strftime(m, '%Y%m') AS month
FROM (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY o_custkey),
  unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS t(m)"""
)
def month_window_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = frames.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    )
    return bounds.select(
        "o_custkey", F.explode(dates.range_months(F.col("a"), F.col("b"))).alias("month")
    )


@query(
    """SELECT o_orderkey, day(o_orderdate) BETWEEN 1 AND 20 AS open FROM orders"""
)
def day_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.day_gate(F.col("o_orderdate")).alias("open")
    )


@query(
    sql.with_frames(
        sql.CRASH_RAW,
        "SELECT tenant, feed, c0, c1, c2, c3, c4 FROM crash_raw",
    )
)
def union_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frames.crash_raw(spark, sf_dir).select("tenant", "feed", *CRASH_FIELDS)
    overview = F.col("feed") == "overview"
    return union_frames([raw.filter(~overview), raw.filter(overview).drop("c4")])

