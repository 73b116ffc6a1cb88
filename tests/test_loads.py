"""The ready-made loads from files to tables, several runs in a row."""

import datetime as dt
import glob
import json
import zipfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from reportloom.config import LoadConfig, Target
from reportloom.operators.filters import keep_product, keep_product_mention
from reportloom.plans import loads
from reportloom.plans.staging import read_published
from reportloom.schemas import EARNINGS_COLUMNS
from reportloom.sinks import tables
from reportloom.sinks.control import read_dates, read_status
from reportloom.sinks.exports import export_cooked
from reportloom.sources import manifests, reports
from reportloom.sources.manifests import load_from_manifest
from reportloom.sources.reports import read_cooked_csv

CRASH_HEADER = "Date,Package,Dimension,Crashes,ANRs\r\n"
OVERVIEW_HEADER = "Date,Package,Crashes,ANRs\r\n"


def put(path, text, encoding="utf-16le"):
    path.parent.mkdir(parents=True, exist_ok=True)
    mark = b"\xff\xfe" if encoding == "utf-16le" else b""
    path.write_bytes(mark + text.encode(encoding))


def put_crashes(root, tenant, days, crashes="1,234"):
    for feed in ("app_version", "device", "os_version", "overview"):
        header = OVERVIEW_HEADER if feed == "overview" else CRASH_HEADER
        middle = "" if feed == "overview" else '"Pixel 4, XL 50%",'
        lines = [f'2021-01-{d:02d},com.x,{middle}"{crashes}",5.5%\r\n' for d in days]
        put(root / tenant / "stats/crashes" / f"crashes_com.x_202101_{feed}.csv", header + "".join(lines))


@pytest.fixture
def config(tmp_path):
    roots = {t: str(tmp_path / "in" / t) for t in ("ta", "tb")}
    return LoadConfig(roots, dt.date(2021, 1, 20), str(tmp_path / "out"))


def run_crashes(spark, config):
    published = read_published(spark, config.output_root, "crashes")
    return loads.load_crashes(spark, config, published, f"{config.output_root}/table")


@pytest.mark.parametrize("grain", ["day", "month"])
def test_crash_runs(spark, tmp_path, config, grain):
    config = replace(config, table_grain=grain)
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4, 5])
    result = run_crashes(spark, config)
    assert result.feeds == ("app_version", "device", "os_version", "overview")
    row = result.table.filter("feed = 'device' and tenant = 'ta'").orderBy("crash_date").first()
    assert (row.crash_date, row.dimension, row.daily_crashes, str(row.daily_anrs)) == (
        dt.date(2021, 1, 4), "Pixel 4, XL 50", 1234, "5.50",
    )
    assert result.table.filter("feed = 'overview'").first().dimension is None
    assert result.table.count() == 16

    again = replace(config, run_date=dt.date(2021, 1, 21))
    assert run_crashes(spark, again).status == "No New Data"

    # Day 6 comes for one account only, then for both with corrected numbers.
    put_crashes(tmp_path / "in", "ta", [4, 5, 6])
    assert run_crashes(spark, again).table is None
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [5, 6], crashes="7")
    last = run_crashes(spark, replace(config, run_date=dt.date(2021, 1, 22)))
    counts = {
        (r.crash_date.day, r.daily_crashes): r["count"]
        for r in last.table.groupBy("crash_date", "daily_crashes").count().collect()
    }
    assert counts == {(4, 1234): 8, (5, 7): 8, (6, 7): 8}


def test_control_data_of_a_crash_run(spark, tmp_path, config):
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    result = run_crashes(spark, config)
    control = f"{config.output_root}/control/crashes"
    status = spark.read.parquet(f"{control}/status").first()
    assert (status.status, status.job) == (result.status, "crashes")
    assert read_status(spark, f"{control}/status", "crashes", config.run_date).first().status == result.status
    dates = read_dates(spark, f"{control}/dates", config.run_date).collect()
    assert sorted(map(tuple, dates)) == [(f, dt.date(2021, 1, 4)) for f in result.feeds]
    lists = {r.feed: r.date_list for r in spark.read.parquet(f"{control}/dates").collect()}
    assert lists == dict.fromkeys(result.feeds, "('2021-01-04')")
    manifests = {r.feed: json.loads(r.value) for r in spark.read.text(f"{control}/manifests").collect()}
    folder = f"{config.output_root}/processed/crashes/p_feed=device/p_date=2021-01-04"
    assert manifests["device"]["entries"] == [
        {"url": f"{folder}/p_tenant={t}", "mandatory": True} for t in ("ta", "tb")
    ]
    listed = load_from_manifest(
        spark, f"{control}/manifests/run_date={config.run_date}/feed=device",
        lambda paths: read_cooked_csv(spark, paths, ["d", "p", "m", "c", "a"]),
    )
    assert sorted(tuple(r)[:5] for r in listed.collect()) == [("2021-01-04", "com.x", "Pixel 4, XL 50", "1234", "5.50")] * 2
    stats = {r.column_name: r for r in spark.read.parquet(f"{control}/statistics/columns").collect()}
    assert (stats["daily_crashes"].row_count, stats["dimension"].null_count) == (8, 2)
    assert read_published(spark, config.output_root, "crashes").count() == 8


def test_raw_zone_keeps_rows_as_they_came(spark, tmp_path, config):
    config = replace(config, keep_raw=True)
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    for _ in range(2):
        run_crashes(spark, config)
        raw = spark.read.parquet(f"{config.output_root}/raw/crashes")
        assert raw.count() == 8
    ranged = replace(config, date_format="Range", start_date="2020-12", end_date="2020-12")
    run_crashes(spark, ranged)  # of another month: leaves what the daily run kept
    raw = spark.read.parquet(f"{config.output_root}/raw/crashes")
    assert raw.count() == 8
    row = raw.filter("feed = 'device'").first()
    assert (row.c2, row.c3, row.run_date) == ("Pixel 4, XL 50%", "1,234", config.run_date)


def test_crash_run_fills_endpoints(spark, tmp_path, config):
    chosen = (Target("one"), Target("two", skip=frozenset({"device"}), tables={"overview": "other"}))
    config = replace(config, targets=chosen)
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    run_crashes(spark, config)
    made = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "out" / "tables").glob("*/*")}
    assert made == {
        "one/app_version", "one/device", "one/os_version", "one/overview",
        "two/app_version", "two/os_version", "two/other",
    }
    assert spark.read.parquet(f"{config.output_root}/tables/two/other").count() == 2


def test_range_run_loads_without_asking(spark, tmp_path, config):
    config = replace(config, date_format="Range", start_date="2021-01", end_date="2021-01")
    put_crashes(tmp_path / "in", "ta", [4])
    put_crashes(tmp_path / "in", "tb", [9])
    for _ in range(2):
        assert run_crashes(spark, config).table.count() == 8


def test_bad_report_date_stops_the_run(spark, tmp_path, config):
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4, 41])
    with pytest.raises(Exception, match="bad report date"):
        run_crashes(spark, config)
    note = read_status(spark, f"{config.output_root}/control/crashes/status", "crashes", config.run_date)
    assert note.first().status.startswith("Error: ")


def test_wider_reports_stop_the_run(spark, tmp_path, config):
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    path = tmp_path / "in/ta/stats/crashes/crashes_com.x_202101_overview.csv"
    put(path, "Date,Package,Crashes,ANRs,More\r\n2021-01-04,com.x,1,2,3\r\n")
    with pytest.raises(Exception, match="more than 4 columns"):
        run_crashes(spark, config)
    put(path, "Date,Package,Crashes,ANRs,More,Most\r\n2021-01-04,com.x,1,2,3,4\r\n")
    with pytest.raises(Exception, match="more than 5 columns"):
        run_crashes(spark, config)


def test_what_was_published_stays_published(spark, tmp_path, config):
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    assert len(run_crashes(spark, config).feeds) == 4
    for tenant in config.tenants:
        put(
            tmp_path / "in" / tenant / "stats/crashes/crashes_com.x_202101_device.csv",
            CRASH_HEADER + "2021-01-04,com.x,P,1,2\r\n2021-01-05,com.x,P,1,2\r\n",
        )
    assert run_crashes(spark, config).feeds == ("device",)
    ranged = replace(config, date_format="Range", start_date="2021-01", end_date="2021-01")
    assert len(run_crashes(spark, ranged).feeds) == 4
    assert run_crashes(spark, config).status == "No New Data"
    days = tmp_path / "out/processed/crashes/p_feed=device"
    assert sorted(p.name for p in days.glob("p_date=*")) == ["p_date=2021-01-04", "p_date=2021-01-05"]


def test_an_export_leaves_other_days(spark, tmp_path):
    for day in ("2021-01-04", "2021-01-05"):
        rows = spark.createDataFrame([(day, "x", "device", "ta")], "c0 string, c1 string, feed string, tenant string")
        export_cooked(rows, str(tmp_path / "e"), ["c0", "c1"])
    found = read_cooked_csv(spark, str(tmp_path / "e"), ["c0", "c1"])
    assert sorted(r.c0 for r in found.collect()) == ["2021-01-04", "2021-01-05"]


def put_installs(root, tenant, app, days):
    header = "Date,Package,Country,Installs,Uninstalls\r\n"
    lines = [f"2021-01-{d:02d},{app},DE,\"1,000\",3\r\n" for d in days]
    put(root / tenant / "stats/installs" / f"installs_{app}_202101_country.csv", header + "".join(lines))


def test_restricted_account_loses_no_row_of_its_product(spark, tmp_path, config):
    config = replace(config, load="installs", restricted={"tb": "com.keep"}, optional_tenants=frozenset({"tb"}))
    put_installs(tmp_path / "in", "ta", "com.any", [4, 5])
    put_installs(tmp_path / "in", "tb", "COM.Keep", [4, 5])
    put_installs(tmp_path / "in", "tb", "com.other", [4, 5])
    published = read_published(spark, config.output_root, "installs")
    table = loads.load_installs(spark, config, published, f"{config.output_root}/t").table
    got = sorted((r.tenant, r.package_name, r.install_date.day, r.daily_installs) for r in table.collect())
    assert got == [
        ("ta", "com.any", 4, 1000), ("ta", "com.any", 5, 1000),
        ("tb", "COM.Keep", 4, 1000), ("tb", "COM.Keep", 5, 1000),
    ]


def test_product_filters(spark):
    df = spark.createDataFrame(
        [("r", "app"), ("r", "APP"), ("r", "other"), ("r", None), ("free", "other")], "tenant string, p string"
    )
    kept = keep_product(df, {"r": "app"}, "p").collect()
    assert sorted(map(tuple, kept)) == [("free", "other"), ("r", "app")]
    mentioned = keep_product_mention(df, {"r": "aPP"}, ["p"]).collect()
    assert sorted(map(tuple, mentioned)) == [("free", "other"), ("r", "APP"), ("r", "app")]


SALES_HEADER = ",".join("Product ID" if i == 6 else f"h{i}" for i in range(19))


def put_sales(root, tenant, orders):
    lines = [SALES_HEADER]
    for number, day, app in orders:
        fields = [number, f"2021-01-{day:02d}", '"1,000"', "Charged", '"Ünit, A"', "10% off", app]
        fields += ["", "sku", "USD", '"1,234.50"', "0", "5%", "X", "Y", "007", "DE%", "cut", "cut"]
        lines.append(",".join(fields))
    lines.append("GPA.9-9,2021-01-04")  # a row that ends early
    folder = root / tenant / "sales"
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / "salesreport_202101.zip", "w") as z:
        z.writestr("salesreport_202101.csv", "\n".join(lines) + "\n")


def test_sales_from_zip_to_table(spark, tmp_path, config):
    config = replace(config, load="sales", restricted={"tb": "com.keep"}, optional_tenants=frozenset({"tb"}))
    for tenant in config.tenants:
        put_sales(tmp_path / "in", tenant, [("GPA.1-2", 4, "com.keep"), ("GPA.1-3", 5, "com.other")])
    raw = loads.scan_sales(spark, config)
    published = read_published(spark, config.output_root, "sales")
    result = loads.load_sales(spark, config, raw, published, f"{config.output_root}/t")
    got = sorted((r.tenant, r.order_number) for r in result.table.collect())
    assert got == [("ta", "GPA.1-2"), ("ta", "GPA.1-3"), ("ta", "GPA.9-9"), ("tb", "GPA.1-2")]
    row = result.table.filter("order_number = 'GPA.1-2' and tenant = 'ta'").first()
    assert (row.device_model, row.product_title, row.order_timestamp) == ("nit, A", "10 off", 1000)
    assert (str(row.item_price), str(row.charged_amount), row.buyer_postal_code) == ("1234.50", "5.00", "007")
    assert (row.product_type, row.buyer_country) == (None, "DE")
    short = result.table.filter("order_number = 'GPA.9-9'").first()
    assert short.financial_status is None and len(short.sale_key) == 32


def test_the_product_column_is_found_by_name(spark, tmp_path, config):
    config = replace(config, load="sales", restricted={"tb": "com.keep"})
    for tenant in config.tenants:
        put_sales(tmp_path / "in", tenant, [("com.keep", 4, "other"), ("no", 4, "com.keep")])
    with zipfile.ZipFile(tmp_path / "in/tb/sales/salesreport_202101.zip") as z:
        text = z.read("salesreport_202101.csv").decode()
    moved = text.replace("Product ID", "h6").replace("h0", "Product ID", 1)
    for content, kept in ((moved, {"com.keep"}), (text.replace("Product ID", "App"), None)):
        with zipfile.ZipFile(tmp_path / "in/tb/sales/salesreport_202101.zip", "w") as z:
            z.writestr("salesreport_202101.csv", content)
        raw = loads.scan_sales(spark, config)
        if kept is None:
            with pytest.raises(Exception, match="no column 'Product ID'"):
                raw.collect()
            continue
        rows = keep_product(raw, config.restricted, "named").filter("tenant = 'tb'").collect()
        assert {r.c0 for r in rows} == kept


def test_store_codes(spark, tmp_path, config):
    config = replace(config, load="both")
    root = f"{config.output_root}/store"
    assert loads.load_store(spark, config, root) == 0  # no account has a folder yet
    for tenant in config.tenants:
        put_sales(tmp_path / "in", tenant, [("GPA.1-2", 4, "com.x")])
    assert loads.load_store(spark, config, root) == 2
    for tenant in config.tenants:
        put_installs(tmp_path / "in", tenant, "com.x", [4, 5])
    assert loads.load_store(spark, replace(config, load="installs"), root) == 3
    assert loads.load_store(spark, config, root) == 0
    ranged = replace(config, date_format="Range", start_date="2021-01", end_date="2021-01")
    assert loads.load_store(spark, ranged, root) == 1
    assert spark.read.parquet(f"{root}/installs").count() == 4
    status = read_status(spark, f"{config.output_root}/control/sales/status", "sales", config.run_date)
    assert status.first().status == "New Data"


def test_tables_take_their_column_names_from_the_run(spark, tmp_path, config):
    names = tuple(f"n{i}" for i in range(17))
    config = replace(config, load="sales", sales_columns=names)
    for tenant in config.tenants:
        put_sales(tmp_path / "in", tenant, [("GPA.1-2", 4, "com.x")])
    published = read_published(spark, config.output_root, "sales")
    raw = loads.scan_sales(spark, config)
    table = loads.load_sales(spark, config, raw, published, f"{config.output_root}/t").table
    assert table.columns[:4] == ["sale_key", "n0", "n1", "n2"]
    assert table.filter("n0 = 'GPA.1-2'").first().n1 == dt.date(2021, 1, 4)


def put_earnings(root, tenant, number, rows, month="202101"):
    lines = [",".join(EARNINGS_COLUMNS)]
    for day, amount in rows:
        values = dict.fromkeys(EARNINGS_COLUMNS, "") | {
            "description": f"GPA.{number}", "transaction_date": f'"{day}"',
            "hardware": '"two\nlines"', "amount_merchant_currency": amount,
        }
        lines.append(",".join(values[c] for c in EARNINGS_COLUMNS))
    folder = root / tenant / "earnings"
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / f"earnings_{month}_7-{number}.zip", "w") as z:
        z.writestr(f"PlayApps_{month}.csv", "\n".join(lines) + "\n")


def run_earnings(spark, config, path):
    archives = loads.scan_earnings_archives(spark, config, f"{config.earnings_month():%Y%m}")
    return loads.load_earnings(config, archives, path)


def glob_one(pattern):
    (found,) = glob.glob(pattern)
    return found


def earnings_amounts(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((r.transaction_date, r.tenant, int(r.amount_merchant_currency)) for r in rows)


def test_earnings_runs(spark, tmp_path, config):
    config = replace(config, run_date=dt.date(2021, 2, 20))
    path = f"{config.output_root}/earnings"
    put_earnings(tmp_path / "in", "ta", 1, [("Jan 4, 2021", "1")])
    (tmp_path / "in" / "tb" / "earnings").mkdir(parents=True)
    assert run_earnings(spark, config, path) is False  # one account has no file
    put_earnings(tmp_path / "in", "ta", 2, [("Jan 5, 2021", "2")])
    put_earnings(tmp_path / "in", "tb", 1, [("Jan 6, 2021", "3")])
    put_earnings(tmp_path / "in", "tb", 1, [("Dec 1, 2020", "9")], month="202012")
    late = replace(config, run_date=dt.date(2021, 2, 21))
    assert run_earnings(spark, late, path) is False  # past the days of the gate
    for _ in range(2):
        assert run_earnings(spark, config, path) is True
        assert earnings_amounts(spark, path) == [
            ("Jan 4, 2021", "ta", 1), ("Jan 5, 2021", "ta", 2), ("Jan 6, 2021", "tb", 3),
        ]
    december = replace(config, run_date=dt.date(2021, 1, 5))
    put_earnings(tmp_path / "in", "ta", 1, [("Dec 2, 2020", "8")], month="202012")
    assert run_earnings(spark, december, path) is True
    assert len(earnings_amounts(spark, path)) == 5
    row = spark.read.parquet(path).first()
    assert row.hardware == "two\nlines" and row.tax_type is None
    assert row.transaction_day is not None
    # Files of both months stay; the manifests list them by account, none mandatory.
    for month, expected in (("202012", 2), ("202101", 3)):
        listed = [
            e for t in ("ta", "tb") for e in manifests.read_manifest(
                spark, glob_one(f"{config.output_root}/control/earnings/manifests/{month}/run_date=*/feed={t}")
            ).collect()
        ]
        assert [e.mandatory for e in listed] == [False, False]
        assert reports.read_earnings(spark, [e.url for e in listed]).count() == expected


def test_a_file_without_rows_still_counts_for_the_gate(spark, tmp_path, config):
    config = replace(config, run_date=dt.date(2021, 2, 1))
    put_earnings(tmp_path / "in", "ta", 1, [("Jan 4, 2021", "1")])
    put_earnings(tmp_path / "in", "tb", 1, [])
    path = f"{config.output_root}/earnings"
    assert run_earnings(spark, config, path) is True
    assert earnings_amounts(spark, path) == [("Jan 4, 2021", "ta", 1)]


def test_devices_need_a_target(spark, tmp_path):
    put(tmp_path / "d.csv", "a,b,c,d\nX,Y,Z,w\n", "utf-8")
    with pytest.raises(ValueError, match="no targets"):
        loads.load_devices(spark, str(tmp_path / "d.csv"), LoadConfig({}, dt.date(2021, 1, 1), str(tmp_path)))


def test_devices(spark, tmp_path):
    put(tmp_path / "d.csv", 'a,b,c,d\nX\t,"Y, Z", ,w\n', "utf-8")
    chosen = (Target("one"), Target("two", tables={"supported_devices": "other"}))
    config = LoadConfig({}, dt.date(2021, 1, 1), str(tmp_path / "out"), targets=chosen)
    done = loads.load_devices(spark, str(tmp_path / "d.csv"), config)
    assert done == [("one", "supported_devices", "supported_devices"), ("two", "supported_devices", "other")]
    for name in ("one/supported_devices", "two/other"):
        assert tuple(spark.read.parquet(str(tmp_path / "out" / "tables" / name)).first()) == ("X", "Y, Z", None, "w")
    (entry,) = manifests.read_manifest(
        spark, str(tmp_path / "out/control/devices/manifests/run_date=2021-01-01/feed=supported_devices")
    ).collect()
    assert not entry.mandatory
    assert reports.read_supported_devices(spark, entry.url).count() == 1


def test_union_takes_columns_that_some_frames_lack(spark):
    a = spark.createDataFrame([("1", "2")], "c0 string, c1 string")
    assert [tuple(r) for r in loads.union_objects([a, a.drop("c1")]).collect()] == [("1", "2"), ("1", None)]


def test_text_month_partition_is_what_like_deletes(spark):
    rows = ["Feb 1, 2021", "Feb 28, 2021", "Mar 1, 2021", "Feb 1, 2020", "Feb2021", "x"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    label = tables.text_month(F.col("t")) == "2021-Feb"
    assert df.filter(F.coalesce(label, F.lit(False)) != F.col("t").like("Feb%2021")).isEmpty()


def test_lost_earnings_are_noticed(spark, tmp_path):
    raw = spark.createDataFrame(
        [tuple("Jan 4, 2021" if c == "transaction_date" else "1" for c in (*EARNINGS_COLUMNS, "tenant"))] * 2
        + [tuple("no date" if c == "transaction_date" else "1" for c in (*EARNINGS_COLUMNS, "tenant"))],
        [*EARNINGS_COLUMNS, "tenant"],
    )
    cooked = loads.cook_earnings(raw)
    path = str(tmp_path / "t")
    tables.replace_by_month(cooked, path, "2021-Jan")
    loads.check_earnings(cooked, path, "2021-Jan")
    with pytest.raises(tables.ReconciliationError):
        loads.check_earnings(cooked.unionByName(cooked), path, "2021-Jan")


def test_a_load_that_fails_publishes_nothing(spark, tmp_path, config):
    config = replace(config, targets=(Target("first"),))
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    # The endpoint cannot be written: there is a file in its place.
    put(tmp_path / "out/tables/first", "no folder", "utf-8")
    with pytest.raises(Exception):
        run_crashes(spark, config)
    control = f"{config.output_root}/control/crashes"
    for kind in ("manifests", "dates", "published"):
        assert not glob.glob(f"{control}/{kind}/**/part-*", recursive=True)
    assert read_status(spark, f"{control}/status", "crashes", config.run_date).first().status.startswith("Error")
    (tmp_path / "out/tables/first").unlink()
    assert run_crashes(spark, config).feeds == ("app_version", "device", "os_version", "overview")
    assert glob.glob(f"{control}/manifests/**/part-*", recursive=True)
