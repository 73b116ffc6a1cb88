"""Ready-made loads: crashes, sales, installs, earnings, devices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.config import LoadConfig
from reportloom.functions.dates import text_month, text_month_of
from reportloom.functions.names import base_name
from reportloom.operators.cooking import (
    cook_devices,
    cook_earnings,
    cook_feeds,
    cook_sales,
)
from reportloom.operators.filters import keep_product, keep_product_mention
from reportloom.operators.freshness import all_tenants_present, status_note
from reportloom.plans.staging import (
    NEW_DATA,
    LoadResult,
    errors_noted,
    feeds_to_read,
    keep_delivered,
    load_new_feeds,
    note_loaded,
    note_status,
    nothing_new,
    processed_root,
    read_published,
    stage,
)
from reportloom.schemas import (
    EARNINGS_COLUMNS,
    PRODUCT_HEADER,
    SALES_DATE,
    SALES_WIDTH,
    positional,
)
from reportloom.sinks.control import build_manifest, publish_manifests
from reportloom.sinks.exports import (
    earnings_folder,
    export_dimension,
    export_earnings,
    keep_raw,
)
from reportloom.sinks.tables import (
    LOAD_MONTH,
    Layout,
    ReconciliationError,
    check_counts,
    column_stats,
    read_table,
    reconcile_counts,
    replace_by_month,
    write_checked,
)
from reportloom.sinks.targets import load_dimension, planned_loads
from reportloom.sources.archives import archive_rows, expand_archives, scan_objects
from reportloom.sources.reports import (
    WHERE_LINES_ARE_RECORDS,
    read_supported_devices,
    report_name,
    scan_feed,
    union_objects,
)
from reportloom.workspace import run_together

DEVICES = "supported_devices"


def _kept(raw: DataFrame, config: LoadConfig, job: str) -> DataFrame:
    """``raw``, from the raw zone when the run keeps one: reports are parsed once."""
    if not config.keep_raw:
        return raw
    return keep_raw(raw, f"{config.output_root}/raw/{job}", config.run_date, config.label())


def _splitting(config: LoadConfig) -> bool | str:
    return WHERE_LINES_ARE_RECORDS if config.split_reports else False


def load_crashes(
    spark: SparkSession, config: LoadConfig, published: DataFrame, table_path: str
) -> LoadResult:
    """Crash reports of the configured months into one table per feed."""
    specs = config.crash_feeds
    feeds = [f.name for f in specs]
    layout = Layout(specs[0].date_column, grain=config.table_grain)
    with errors_noted(spark, config, "crashes"):
        name = report_name("crashes", config.months(), feeds)
        told = F.regexp_extract("path", name, 3)
        feeds, listed = feeds_to_read(spark, config, "crashes", feeds, "stats/crashes", told, name)
        if not feeds:
            return nothing_new(spark, config, "crashes")
        keep_delivered(spark, config, "crashes", "stats/crashes", report_name("crashes", config.months(), feeds))
        width = max(f.width for f in specs)
        raw = scan_feed(
            spark, config.tenants, "crashes", feeds, config.months(), width, _splitting(config)
        )
        cooked = cook_feeds(_kept(raw, config, "crashes"), specs)
        staged = stage(cooked, f"{config.output_root}/staged/crashes", layout)
        result = load_new_feeds(
            spark, staged, published, config, "crashes", feeds, layout, table_path
        )
        note_loaded(config, "crashes", listed, result.feeds)
        return result


def load_installs(
    spark: SparkSession, config: LoadConfig, published: DataFrame, table_path: str
) -> LoadResult:
    """Installs by country; restricted accounts keep only rows of their product."""
    spec = config.installs_feed
    layout = Layout(spec.date_column, grain=config.table_grain)
    with errors_noted(spark, config, "installs"):
        name = report_name("installs", config.months(), ["country"])
        feeds, listed = feeds_to_read(
            spark, config, "installs", [spec.name], "stats/installs", F.lit(spec.name), name
        )
        if not feeds:
            return nothing_new(spark, config, "installs")
        keep_delivered(spark, config, "installs", "stats/installs", name)
        raw = scan_feed(
            spark, config.tenants, "installs", ["country"], config.months(), spec.width, _splitting(config)
        )
        raw = _kept(raw, config, "installs")
        # The scan refuses wider rows, so these fields are the whole line.
        kept = keep_product_mention(raw, config.restricted, positional(spec.width))
        cooked = cook_feeds(kept.withColumn("feed", F.lit(spec.name)), [spec])
        staged = stage(cooked, f"{config.output_root}/staged/installs", layout)
        result = load_new_feeds(
            spark, staged, published, config, "installs", feeds, layout, table_path
        )
        note_loaded(config, "installs", listed, result.feeds)
        return result


def sales_name(config: LoadConfig) -> str:
    """Pattern of the zipped sales reports of the configured months."""
    return rf"sales/salesreport_({'|'.join(config.months())})\.zip$"


def scan_sales(spark: SparkSession, config: LoadConfig) -> DataFrame:
    """Raw sales rows from the zipped reports of the configured months."""
    name = sales_name(config)
    frames = []
    for tenant, root in config.tenants.items():
        archives = scan_objects(
            spark, f"{root}/sales", F.col("_metadata.file_path").rlike(name)
        ).select("path")
        # Restricted accounts are told by the column's name, wherever it stands.
        product = PRODUCT_HEADER if tenant in config.restricted else None
        records = expand_archives(archives, encoding="ascii", errors="ignore", named=product)
        rows = archive_rows(records, positional(SALES_WIDTH))
        frames.append(rows.withColumn("tenant", F.lit(tenant)))
    return union_objects(frames)


def load_sales(
    spark: SparkSession,
    config: LoadConfig,
    raw: DataFrame,
    published: DataFrame,
    table_path: str,
) -> LoadResult:
    """Sales rows; restricted accounts keep only rows of their product."""
    layout = Layout(config.sales_columns[SALES_DATE], grain=config.table_grain)
    with errors_noted(spark, config, "sales"):
        raw = _kept(raw, config, "sales")
        product = "named" if "named" in raw.columns else "c6"
        kept = keep_product(raw, config.restricted, product)
        cooked = cook_sales(kept, config.sales_columns).withColumn("feed", F.lit("sales"))
        staged = stage(cooked, f"{config.output_root}/staged/sales", layout)
        return load_new_feeds(
            spark, staged, published, config, "sales", ["sales"], layout, table_path
        )


def load_store(spark: SparkSession, config: LoadConfig, table_root: str) -> int:
    """The sales and installs loads that the run asks for; the status code of both.

    1: both had new data, 2: sales only, 3: installs only, 0: neither.
    """
    new = {"sales": False, "installs": False}
    if config.load in ("both", "sales"):
        published = read_published(spark, config.output_root, "sales")
        name = sales_name(config)
        feeds, listed = feeds_to_read(spark, config, "sales", ["sales"], "sales", F.lit("sales"), name)
        if feeds:
            keep_delivered(spark, config, "sales", "sales", name)
            raw = scan_sales(spark, config)
            result = load_sales(spark, config, raw, published, f"{table_root}/sales")
            note_loaded(config, "sales", listed, result.feeds)
        else:
            result = nothing_new(spark, config, "sales")
        new["sales"] = bool(result.feeds)
    if config.load in ("both", "installs"):
        published = read_published(spark, config.output_root, "installs")
        result = load_installs(spark, config, published, f"{table_root}/installs")
        new["installs"] = bool(result.feeds)
    if all(new.values()):
        return 1
    return 2 if new["sales"] else 3 if new["installs"] else 0


def scan_earnings_archives(
    spark: SparkSession, config: LoadConfig, month: str
) -> DataFrame:
    """Zipped earnings of one month: (tenant, path); the zips are read where they are.

    A run that keeps its objects as delivered keeps them here, before they are read.
    """
    name = rf"earnings/earnings_{month}_[^/]*\.zip$"
    keep_delivered(spark, config, "earnings", "earnings", name)
    frames = []
    for tenant, root in config.tenants.items():
        archives = scan_objects(
            spark, f"{root}/earnings", F.col("_metadata.file_path").rlike(name)
        ).select("path")
        frames.append(archives.withColumn("tenant", F.lit(tenant)))
    return union_objects(frames)


def load_earnings(config: LoadConfig, archives: DataFrame, table_path: str) -> bool:
    """Replace the configured month by the earnings of all accounts.

    ``archives`` is (tenant, path), or has the content too. Runs only on the days of the gate, and
    only when every account has files of the month. Returns whether it loaded.

    The unzipped files are kept by account and month, and each account has a manifest
    of them, unless the run is told not to.
    """
    first, last = config.gate_days
    if not first <= config.run_date.day <= last:
        return False
    spark = archives.sparkSession
    with errors_noted(spark, config, "earnings"):
        loaded = _load_earnings(spark, config, archives, table_path)
        note_status(spark, config, "earnings", NEW_DATA if loaded else status_note(()))
    return loaded


def _load_earnings(
    spark: SparkSession, config: LoadConfig, archives: DataFrame, table_path: str
) -> bool:
    month = config.earnings_month()
    records = expand_archives(archives, carry=["tenant"])
    # Unzipped once: the gate and the load both read the records.
    staged_path = f"{config.output_root}/staged/earnings"
    records.write.mode("overwrite").parquet(staged_path)
    staged = read_table(spark, staged_path, records.schema)

    name = base_name(F.col("numbered_member"))
    pattern = rf"^PlayApps_{month:%Y%m}_.*\.csv$"
    members = staged.select(
        F.lit(f"{month:%Y%m}").alias("month"), "tenant", name.alias("name")
    )
    found = all_tenants_present(members, "month", F.lit(pattern), list(config.tenants))
    if found.filter("file_found").isEmpty():
        return False
    rows = archive_rows(staged.filter(name.rlike(pattern)), EARNINGS_COLUMNS, strict=True)
    cooked, label = cook_earnings(rows), text_month_of(month)

    def load() -> None:
        replace_by_month(cooked, table_path, label)

    def export() -> None:
        export_earnings(rows, processed_root(config.output_root, "earnings"), EARNINGS_COLUMNS, f"{month:%Y%m}")

    run_together(spark, [load, export] if config.processed else [load])
    check_earnings(cooked, table_path, label)
    if config.processed:
        publish_earnings_manifests(spark, config, f"{month:%Y%m}")
    return True


def check_earnings(cooked: DataFrame, table_path: str, month: str) -> None:
    """Compare rows per account and month of the text dates with what the table got."""
    if cooked.isEmpty():
        return
    of = F.coalesce(text_month(F.col("transaction_date")), F.lit("none")).alias("of_month")
    table = cooked.sparkSession.read.parquet(table_path).filter(F.col(LOAD_MONTH) == month)
    counted = reconcile_counts(
        cooked.select("tenant", of), table.select("tenant", of), ["tenant", "of_month"]
    )
    # At most one row per account and month; months that only the table has are of earlier loads.
    if wrong := counted.filter((F.col("source_rows") > 0) & ~F.col("ok")).collect():
        raise ReconciliationError(f"{table_path}: {[tuple(r) for r in wrong]}")


def publish_earnings_manifests(spark: SparkSession, config: LoadConfig, month: str) -> None:
    """One manifest per account, of the files of one month, none of them mandatory."""
    accounts = spark.createDataFrame([(t,) for t in config.tenants], "feed string")
    url = earnings_folder(processed_root(config.output_root, "earnings"), F.col("feed"), month)
    manifests = build_manifest(accounts, url, mandatory=False)
    path = f"{config.output_root}/control/earnings/manifests/{month}"
    publish_manifests(manifests, accounts, path, config.run_date)


def load_devices(
    spark: SparkSession, csv_path: str, config: LoadConfig
) -> list[tuple[str, str, str]]:
    """Replace the device dimension at every endpoint; there has to be one.

    The list is parsed once. A cleaned copy and its manifest are kept, unless the run
    is told not to.
    """
    if not config.targets:
        raise ValueError("no targets to load the devices to")
    with errors_noted(spark, config, "devices"):
        devices = cook_devices(read_supported_devices(spark, csv_path, config.device_columns))
        staged_path = f"{config.output_root}/staged/{DEVICES}"
        write_checked(devices, staged_path)
        staged = read_table(spark, staged_path, devices.schema)
        root, processed = f"{config.output_root}/tables", processed_root(config.output_root, "devices")
        control = f"{config.output_root}/control/devices"

        def load() -> None:
            load_dimension(staged, root, config.targets, DEVICES)

        def export() -> None:
            export_dimension(staged, f"{processed}/{DEVICES}")

        def note_manifest() -> None:
            listed = spark.createDataFrame([(DEVICES,)], "feed string")
            manifest = build_manifest(listed, F.lit(f"{processed}/{DEVICES}"), mandatory=False)
            publish_manifests(manifest, listed, f"{control}/manifests", config.run_date)

        run_together(spark, [load, export] if config.processed else [load])
        done = planned_loads(config.targets, [DEVICES])
        expected = staged.count()
        for endpoint, _, table in done:
            path = f"{root}/{endpoint}/{table}"
            check_counts(expected, spark.read.parquet(path).count(), path)
        if config.processed:
            note_manifest()
        column_stats(staged, staged.columns).write.mode("overwrite").parquet(f"{control}/statistics")
        note_status(spark, config, "devices", NEW_DATA)
    return done
