"""Report-shaped frames made from the test tables.

The tables hold no app reports. These frames bring their rows into the shapes
that the report files have, so that every operator can run over whole tables.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from datetime import date
from functools import partial
from itertools import groupby
from operator import itemgetter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions.dates import iso_date, month_label
from reportloom.schemas import CRASH_FEED_NAMES, DEVICE_COLUMNS, EARNINGS_COLUMNS, PRODUCT_HEADER, positional
from reportloom.workspace import run_together

TENANTS = ("tenant_a", "tenant_b")
RESTRICTED = {"tenant_b": "com.example.keep"}
PUBLISHED_UNTIL = date(2024, 1, 20)
# Rows per archive are bounded by the range of keys that it covers.
KEYS_PER_ARCHIVE = 65536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: Column) -> Column:
    return c.cast("string")


def pick(number: Column, *values: str) -> Column:
    """One of ``values`` by the remainder of ``number``."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def tenant_of(number: Column) -> Column:
    return pick(number, *TENANTS)


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as 19 text columns of a sales report."""
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    fields = [
        F.concat(F.lit("GPA."), F.lpad(text(key), 12, "0"), F.lit("-"), text(key % 10)),
        iso_date(F.col("o_orderdate")),
        F.format_number(key * 1000 + 7, 0),
        F.col("o_orderstatus"),
        F.concat(F.lit("Item, "), F.col("o_orderpriority")),
        F.concat(text(key % 100), F.lit("% off")),
        pick(key, "com.example.keep", "com.example.other", "com.example.other"),
        pick(key, "", "  ", "x "),
        F.concat(F.lit("sku-"), text(F.col("o_custkey"))),
        F.lit("USD"),
        F.format_number(cents, 0),
        F.lit("1,234.50"),
        F.concat(text(key % 20), F.lit("%")),
        F.concat(F.lit("City, "), text(key % 7)),
        F.lit("ST%"),
        F.lpad(text(F.col("o_custkey")), 5, "0"),
        F.lit("50% Land, North"),
        F.lit("beyond"),
        F.lit("the width"),
    ]
    return table(spark, sf_dir, "orders").select(
        *(f.alias(f"c{i}") for i, f in enumerate(fields)),
        tenant_of(key).alias("tenant"),
        key.alias("o_orderkey"),
    )


def crash_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the four crash reports; the overview has no dimension."""
    event, user = F.col("event_id"), F.col("user_id")
    feed = pick(event, *CRASH_FEED_NAMES)
    dimension = F.concat(F.lit("Model, "), text(user % 20), F.lit("%"))
    crashes = F.format_number(event * 1000 + user, 0)
    anrs = F.concat(text(event % 100), F.lit("%"))
    overview = feed == "overview"
    return table(spark, sf_dir, "events").select(
        iso_date(F.col("ts")).alias("c0"),
        F.concat(F.lit("com.example."), F.col("event_type")).alias("c1"),
        F.when(overview, crashes).otherwise(dimension).alias("c2"),
        F.when(overview, anrs).otherwise(crashes).alias("c3"),
        F.when(~overview, anrs).alias("c4"),
        feed.alias("feed"),
        tenant_of(user).alias("tenant"),
        F.col("event_id"),
        F.col("event_type"),
    )


def installs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the installs-by-country report."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        iso_date(F.col("ts")).alias("c0"),
        pick(event, "com.example.KEEP", "com.example.other").alias("c1"),
        F.concat(F.lit("Land, "), text(user % 30)).alias("c2"),
        F.format_number(event * 10, 0).alias("c3"),
        text(user).alias("c4"),
        tenant_of(user).alias("tenant"),
        F.col("event_type"),
    )


def crash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feed, report_date, tenant) of every crash row, read from three columns."""
    return table(spark, sf_dir, "events").select(
        pick(F.col("event_id"), *CRASH_FEED_NAMES).alias("feed"),
        F.col("ts").cast("date").alias("report_date"),
        tenant_of(F.col("user_id")).alias("tenant"),
    )


def published(keys: DataFrame) -> DataFrame:
    """Parts published so far: all up to a day, one account's last device day missing."""
    missing = (
        (F.col("feed") == "device")
        & (F.col("report_date") == F.lit(PUBLISHED_UNTIL))
        & (F.col("tenant") == "tenant_b")
    )
    return keys.filter((F.col("report_date") <= F.lit(PUBLISHED_UNTIL)) & ~missing).distinct()


def earnings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the 19 columns of an earnings report."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate")
    amount = text(F.col("o_totalprice").cast("decimal(18,2)"))
    values = {
        "description": F.concat(F.lit("GPA."), text(key)),
        "transaction_date": F.date_format(day, "MMM d, yyyy"),
        "transaction_time": F.lit("1:02:03 AM PST"),
        "tax_type": pick(key, "", "  ", "VAT"),
        "transaction_type": F.when(F.col("o_orderstatus") == "F", "Charge").otherwise(
            "Charge refund"
        ),
        "refund_type": F.lit(""),
        "product_title": F.concat(F.lit('The "best", '), F.col("o_orderpriority")),
        "product_id": pick(key, "com.example.keep", "com.example.other", "com.example.other"),
        "product_type": F.lit("inapp"),
        "sku_id": F.concat(F.lit("sku-"), text(F.col("o_custkey"))),
        "hardware": F.lit("pixel"),
        "buyer_country": F.lit("US"),
        "buyer_state": F.lit("CA"),
        "buyer_postal_code": F.lpad(text(F.col("o_custkey")), 5, "0"),
        "buyer_currency": F.lit("USD"),
        "amount_buyer_currency": amount,
        "currency_conversion_rate": F.lit("1.250000"),
        "merchant_currency": F.lit("EUR"),
        "amount_merchant_currency": amount,
    }
    return table(spark, sf_dir, "orders").select(
        *(values[c].alias(c) for c in EARNINGS_COLUMNS),
        tenant_of(key).alias("tenant"),
        key.alias("o_orderkey"),
        month_label(day).alias("month"),
    )


def devices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as device rows, with a stray tab."""
    name = F.col("p_name")
    values = (
        F.col("p_brand"),
        F.concat(name, F.lit("\t, "), F.col("p_type")),
        F.concat(F.lit('"'), F.col("p_type"), F.lit('"')),
        text(F.col("p_partkey")),
    )
    return table(spark, sf_dir, "part").select(
        *(v.alias(c) for v, c in zip(values, DEVICE_COLUMNS))
    )


def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object name per event, over all report kinds and some strangers."""
    event = F.col("event_id")
    month = month_label(F.col("ts"))
    package = F.concat(F.lit("com.example."), F.col("event_type"))
    feed = pick(F.floor(event / 7), *CRASH_FEED_NAMES)
    name = F.element_at(
        F.array(
            F.concat(F.lit("stats/crashes/crashes_"), package, F.lit("_"), month, F.lit("_"), feed, F.lit(".csv")),
            F.concat(F.lit("stats/installs/installs_"), package, F.lit("_"), month, F.lit("_country.csv")),
            F.concat(F.lit("stats/installs/installs_"), package, F.lit("_"), month, F.lit("_device.csv")),
            F.concat(F.lit("sales/salesreport_"), month, F.lit(".zip")),
            F.concat(F.lit("earnings/earnings_"), month, F.lit("_"), text(F.col("user_id")), F.lit("-"), text(event), F.lit(".zip")),
            F.concat(F.lit("old/earnings/earnings_"), month, F.lit("_1-2.zip")),
            F.concat(F.lit("sales/salesreport_190001.zip")),
        ),
        (event % 7 + 1).cast("int"),
    )
    return table(spark, sf_dir, "events").select(event, name.alias("name"))


def local_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One local report file name per event, some with two account labels or none."""
    event = F.col("event_id")
    label = pick(event, "tenant_a", "tenant_b", "tenant_b_tenant_a", "nobody", "tenant_a")
    kind = pick(
        F.floor(event / 5), "app_version", "device", "os_version", "overview", "os_version_device", "other"
    )
    name = F.concat(
        F.lit("/device/work/crashes_"), kind, F.lit("_"), label, F.lit("_"),
        month_label(F.col("ts")), F.lit("_"), iso_date(F.col("ts")), F.lit(".csv"),
    )
    return table(spark, sf_dir, "events").select(event, name.alias("name"))


def name_by_value(spark: SparkSession, path: str) -> None:
    """Call the folders of a partitioned write by their values alone, as objects are."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = jvm_path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.listStatus(folder):
        _, keyed, value = status.getPath().getName().partition("=")
        if keyed and not system.rename(status.getPath(), jvm_path(folder, value)):
            raise OSError(f"cannot rename {status.getPath()}")


def write_objects(rows: DataFrame, root: str, report: str, width: int) -> dict[str, str]:
    """Write rows (tenant, object, c0 …) as UTF-16LE report objects; account roots.

    An object is a folder of that name, so that a large one has several files.
    """

    def write(tenant: str) -> None:
        own = rows.filter(F.col("tenant") == tenant).select(*positional(width), "object")
        (
            own.hint("rebalance", F.col("object"))
            .write.partitionBy("object")
            .option("encoding", "UTF-16LE")
            .option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{root}/{tenant}/stats/{report}")
        )
        name_by_value(rows.sparkSession, f"{root}/{tenant}/stats/{report}")

    run_together(rows.sparkSession, [partial(write, t) for t in TENANTS])
    return {t: f"{root}/{t}" for t in TENANTS}


def write_devices(devices: DataFrame, path: str) -> None:
    """Write device rows as the public CSV has them."""
    devices.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def csv_line(columns) -> Column:
    """A CSV record: every field quoted, quotes doubled."""
    quoted = [
        F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in columns
    ]
    return F.concat_ws(",", *quoted)


def zip_lines(lines: DataFrame, keys: Sequence[str], order: Sequence[str], header: str) -> DataFrame:
    """(…keys, content) of lines (…keys, member, line): a zip of one member per ``keys``.

    A zip is packed by one task, line by line in ``order`` below the header. The task
    holds a batch of lines and one packed zip, however many lines that has.
    """
    placed = lines.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, "member", "line")
    schema = placed.select(*keys, F.lit(None).cast("binary").alias("content")).schema
    return placed.mapInArrow(partial(_pack, header), schema)


def _pack(header: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zips with the values of all columns before ``member`` and ``line``, from sorted lines."""
    key = held = archive = body = fields = None

    def packed() -> pa.RecordBatch:
        body.close()
        archive.close()
        values = [pa.array([v], f.type) for v, f in zip(key, fields, strict=True)]
        names = [*(f.name for f in fields), "content"]
        return pa.RecordBatch.from_arrays([*values, pa.array([held.getbuffer()], pa.binary())], names)

    for batch in batches:
        fields = list(batch.schema)[:-2]
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for (*of, member), same in groupby(rows, itemgetter(slice(-1))):
            if of != key:
                if key:
                    yield packed()
                key, held = of, io.BytesIO()
                archive = zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED)
                body = archive.open(member, "w", force_zip64=True)
                body.write(f"{header}\n".encode())
            body.write("".join(f"{row[-1]}\n" for row in same).encode())
    if key:
        yield packed()


def earnings_archives(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """Zipped earnings (tenant, month, path, content), of one month or of all: one archive
    per account, month and key range."""
    raw = earnings_raw(spark, sf_dir)
    if month is not None:
        raw = raw.filter(F.col("month") == month)
    lines = raw.select(
        "tenant", "month", F.floor(F.col("o_orderkey") / KEYS_PER_ARCHIVE).alias("part"), "o_orderkey",
        F.concat(F.lit("PlayApps_"), F.col("month"), F.lit(".csv")).alias("member"),
        csv_line(EARNINGS_COLUMNS).alias("line"),
    )
    zips = zip_lines(lines, ["tenant", "month", "part"], ["o_orderkey", "line"], ",".join(EARNINGS_COLUMNS))
    path = F.concat(
        F.lit("earnings/earnings_"), F.col("month"), F.lit("_77-"), text(F.col("part")), F.lit(".zip")
    )
    return zips.select("tenant", "month", path.alias("path"), "content")


def write_zips(rows: DataFrame, order: str) -> list[str]:
    """Write lines (path, member, line) as zips of CSV members; the paths.

    A zip is written by one task, line by line in ``order`` within its members.
    """

    def write(batches):
        held = path = archive = name = member = None
        for batch in batches:
            for at, of, line in zip(*(batch.column(c).to_pylist() for c in ("path", "member", "line")), strict=True):
                if (at, of) != (path, name):
                    if member:
                        member.close()
                    if at != path:
                        if archive:
                            archive.close()
                            held.close()
                            yield _paths(path)
                        Path(at).parent.mkdir(parents=True, exist_ok=True)
                        held = open(at, "wb")  # noqa: SIM115
                        archive = zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED)
                    path, name = at, of
                    member = archive.open(of, "w", force_zip64=True)
                member.write(f"{line}\n".encode())
        if archive:
            member.close()
            archive.close()
            held.close()
            yield _paths(path)

    placed = rows.repartition("path").sortWithinPartitions("path", "member", order)
    return [r.path for r in placed.mapInArrow(write, "path string").collect()]


def _paths(path: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path])], ["path"])


def write_sales_zips(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """The sales as zipped reports, one per account and month, of several members; roots."""
    raw = sales_raw(spark, sf_dir)
    key = F.col("o_orderkey")
    names = [*(f"h{i}" for i in range(6)), PRODUCT_HEADER, *(f"h{i}" for i in range(7, 19))]
    path = F.concat_ws("/", F.lit(root), "tenant", F.lit("sales"), F.concat(F.lit("salesreport_"), month_label(F.col("c1").cast("date")), F.lit(".zip")))
    placed = raw.select(path.alias("path"), F.concat(F.lit("part-"), text(key % 3), F.lit(".csv")).alias("member"), key, csv_line(positional(19)).alias("line"))
    header = F.lit(",".join(names)).alias("line")
    headers = placed.select("path", "member", F.lit(-1).cast("long").alias("o_orderkey"), header).distinct()
    write_zips(placed.unionByName(headers), "o_orderkey")
    return {t: f"{root}/{t}" for t in TENANTS}


def write_earnings_zips(archives: DataFrame, root: str) -> dict[str, str]:
    """Write archives (tenant, path, content) as objects below the roots of their accounts."""

    def write(batches):
        for batch in batches:
            for tenant, name, content in zip(*(batch.column(c) for c in ("tenant", "path", "content")), strict=True):
                at = Path(root) / tenant.as_py() / name.as_py()
                at.parent.mkdir(parents=True, exist_ok=True)
                at.write_bytes(content.as_buffer())
                yield _paths(str(at))

    archives.select("tenant", "path", "content").mapInArrow(write, "path string").collect()
    return {t: f"{root}/{t}" for t in TENANTS}
