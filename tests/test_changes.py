"""Changed objects only, raw objects, folded notes, split reports."""

import datetime as dt
import hashlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from reportloom.operators.filters import drop_header_lines
from reportloom.plans import loads
from reportloom.plans.staging import objects_root, read_published
from reportloom.sinks import control
from reportloom.sinks.raw_objects import keep_objects, read_objects
from reportloom.sources import reports
from test_loads import config, put, put_crashes, run_crashes  # noqa: F401

PARTS = "feed string, report_date date, tenant string"


def forbid_reports(monkeypatch):
    def scan(*_args, **_kwargs):
        raise AssertionError("a report was read")

    monkeypatch.setattr(loads, "scan_feed", scan)
    monkeypatch.setattr(loads, "scan_sales", scan)


def test_a_run_over_unchanged_objects_reads_no_report(spark, tmp_path, config, monkeypatch):  # noqa: F811
    config = replace(config, changed_only=True)
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4, 5])
    assert len(run_crashes(spark, config).feeds) == 4
    with monkeypatch.context() as patch:
        forbid_reports(patch)
        assert run_crashes(spark, replace(config, run_date=dt.date(2021, 1, 21))).status == "No New Data"
    # Whoever asks for a range gets all that is there.
    ranged = replace(config, date_format="Range", start_date="2021-01", end_date="2021-01")
    assert len(run_crashes(spark, ranged).feeds) == 4


def test_a_changed_feed_is_read_for_all_accounts(spark, tmp_path, config, monkeypatch):  # noqa: F811
    config = replace(config, changed_only=True)
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4, 5])
    run_crashes(spark, config)
    read = []
    scan = loads.scan_feed
    monkeypatch.setattr(loads, "scan_feed", lambda s, roots, report, feeds, *a: read.append(list(feeds)) or scan(s, roots, report, feeds, *a))
    # Day 6 comes for one account only: read, not loaded, and so read again with the other's.
    for tenant in ("ta", "tb"):
        name = tmp_path / "in" / tenant / "stats/crashes" / "crashes_com.x_202101_device.csv"
        put(name, "Date,Package,Dimension,Crashes,ANRs\r\n2021-01-05,com.x,P,1,1\r\n2021-01-06,com.x,P,9,1\r\n")
        found = run_crashes(spark, replace(config, run_date=dt.date(2021, 1, 22)))
        assert found.feeds == (("device",) if tenant == "tb" else ())
    assert read == [["device"], ["device"]]
    rows = found.table.filter("feed = 'device' and daily_crashes = 9").collect()
    assert sorted(r.tenant for r in rows) == ["ta", "tb"]


def test_nothing_listed_is_nothing_new(spark, config):  # noqa: F811
    assert run_crashes(spark, replace(config, changed_only=True)).status == "No New Data"


def test_sales_and_installs_read_changes_only(spark, tmp_path, config, monkeypatch):  # noqa: F811
    config = replace(config, changed_only=True, load="installs")
    for tenant in config.tenants:
        put(tmp_path / "in" / tenant / "stats/installs" / "installs_com.x_202101_country.csv",
            "Date,Package,Country,a,b\r\n2021-01-04,com.x,US,1,2\r\n")
    assert loads.load_store(spark, config, str(tmp_path / "tables")) == 3
    forbid_reports(monkeypatch)
    assert loads.load_store(spark, config, str(tmp_path / "tables")) == 0
    assert loads.load_store(spark, replace(config, load="sales"), str(tmp_path / "tables")) == 0


def test_objects_are_kept_byte_by_byte(spark, tmp_path, config):  # noqa: F811
    config = replace(config, keep_objects=True)
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4])
    for _ in range(2):
        run_crashes(spark, config)
    root = objects_root(config, "crashes")
    kept = {r.path: bytes(r.content) for r in read_objects(spark, root, config.run_date, config.label()).collect()}
    files = list((tmp_path / "in").rglob("*.csv"))
    assert len(kept) == len(files) == 8
    assert {p.removeprefix("file:") for p in kept} == {str(f) for f in files}
    for file in files:
        assert kept[f"file:{file}"] == file.read_bytes()
    # Both accounts deliver the same bytes; three feeds differ in nothing but their names.
    contents = [r.sha256 for r in spark.read.parquet(f"{root}/contents").collect()]
    assert sorted(set(contents)) == sorted({hashlib.sha256(f.read_bytes()).hexdigest() for f in files})
    before = len(contents)
    run_crashes(spark, replace(config, run_date=dt.date(2021, 1, 21)))
    assert spark.read.parquet(f"{root}/contents").count() == before


def test_raw_objects_of_odd_rows(spark, tmp_path):
    root = str(tmp_path / "zone")
    schema = "path string, content binary, length string"
    odd = spark.createDataFrame(
        [("a", bytearray(b"x"), "?"), ("a", bytearray(b"x"), "?"), ("b", bytearray(b""), None), ("c", None, None), ("a", bytearray(b"y"), "")],
        schema,
    )
    keep_objects(odd.limit(0), root, dt.date(2021, 1, 1))
    assert read_objects(spark, root, dt.date(2021, 1, 1)).count() == 0
    keep_objects(odd, root, dt.date(2021, 1, 2))
    kept = read_objects(spark, root, dt.date(2021, 1, 2)).collect()
    assert sorted((r.path, bytes(r.content), r.length) for r in kept) == [("a", b"x", 1), ("a", b"y", 1), ("b", b"", 0)]


def test_many_notes_leave_few_files(spark, tmp_path):
    path = f"{tmp_path}/published"
    first, expected = dt.date(2021, 1, 1), set()
    for run in range(40):
        rows = [(f, first + dt.timedelta(d), t) for f in ("x", "y") for t in ("ta", None) for d in (run, run + 2, 400)]
        rows.append(("x", None, "ta"))
        expected |= set(rows)
        control.publish_parts(spark.createDataFrame(rows, PARTS), path, first + dt.timedelta(run))
    files = [p for root in ("published", "published_runs") for p in (tmp_path / root).rglob("*.parquet")]
    assert len(files) <= control.MOST_NOTES + 1
    assert len(list((tmp_path / "published").glob("run_date=*"))) <= control.MOST_NOTES
    assert set(map(tuple, control.read_parts(spark, path).collect())) == expected
    assert control.read_parts(spark, path).count() == len(expected)


def test_a_fold_that_did_not_end_is_not_read(spark, tmp_path):
    path = f"{tmp_path}/published"
    parts = spark.createDataFrame([("x", dt.date(2021, 1, 1), "ta")], PARTS)
    assert control.read_parts(spark, path).count() == 0
    control.publish_parts(parts, path, dt.date(2021, 1, 1))
    other = spark.createDataFrame([("z", dt.date(2021, 1, 1), "ta")], PARTS)
    control.day_runs(other).write.parquet(f"{path}_runs/broken")
    (tmp_path / "published_runs" / "broken" / "_SUCCESS").unlink()
    control.fold_parts(spark, path, most=0)
    assert [r.feed for r in control.read_parts(spark, path).collect()] == ["x"]
    # Folding what is folded, and notes that a fold already holds, change nothing.
    control.publish_parts(parts, path, dt.date(2021, 1, 1))
    control.fold_parts(spark, path, most=0)
    assert [tuple(r) for r in control.read_parts(spark, path).collect()] == [("x", dt.date(2021, 1, 1), "ta")]


def test_published_state_survives_folding(spark, tmp_path, config):  # noqa: F811
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4, 5])
    run_crashes(spark, config)
    before = read_published(spark, config.output_root, "crashes").collect()
    control.fold_parts(spark, f"{config.output_root}/control/crashes/published", most=0)
    assert sorted(before) == sorted(read_published(spark, config.output_root, "crashes").collect())
    assert run_crashes(spark, replace(config, run_date=dt.date(2021, 1, 21))).status == "No New Data"


LINES = "Date,a,b\r\n" + "".join(f'{i},"x, ""{i}""",é\r\n' for i in range(400))
BROKEN = 'Date,a,b\n1,"two\nlines",z\n2,p,"q\n'  # the last quote is never closed


@pytest.mark.parametrize("texts", [[LINES], [LINES, BROKEN], [BROKEN], [LINES, "Date,a,b\r\n", BROKEN, LINES.replace("x", "w")]])
def test_files_are_split_where_their_lines_are_records(spark, tmp_path, texts):
    for i, text in enumerate(texts):
        put(tmp_path / f"f {i}.csv", text)
    def read(split):
        return reports.read_utf16_csv(spark, str(tmp_path), ["d", "a", "b"], split=split)

    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        whole, split = read(False), read(reports.WHERE_LINES_ARE_RECORDS)
        assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        if LINES in texts:
            assert split.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_split_load_gives_the_same_table(spark, tmp_path, config):  # noqa: F811
    for tenant in config.tenants:
        put_crashes(tmp_path / "in", tenant, [4, 5])
        put(tmp_path / "in" / tenant / "stats/crashes" / "crashes_com.y_202101_device.csv",
            'Date,Package,Dimension,Crashes,ANRs\r\n2021-01-04,com.y,"two\nlines",1,1\r\n')
    whole = run_crashes(spark, config).table.collect()
    split = replace(config, split_reports=True, output_root=f"{config.output_root}-split")
    assert sorted(map(str, run_crashes(spark, split).table.collect())) == sorted(map(str, whole))


def test_lines_below_the_headers(spark, tmp_path):
    put(tmp_path / "a.csv", 'Date,a\r\n1,"x\r\n\r\nDate,a\r\n2, y \r\n')
    put(tmp_path / "b.csv", "Date,a\n3,∀\nz Date, here\n4,")
    put(tmp_path / "c.csv", "Date,a\n")
    got = drop_header_lines(reports.read_report_lines(spark, str(tmp_path)))
    assert sorted(r.line for r in got.collect()) == ['1,"x', "2, y ", "3,∀", "4,"]
    put(tmp_path / "d.csv", "Date,a\n5,\uffff\n6\uffff7\uffff8\r\n")
    own = F.col("_metadata.file_path").endswith("d.csv")
    got = reports.read_report_lines(spark, str(tmp_path), file_filter=own).collect()
    assert [r.line for r in got] == ["5,\uffff", "6\uffff7\uffff8"]
