"""Readers on files written byte by byte."""

import csv
import io
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reportloom.operators.filters import drop_repeated_headers
from reportloom.sinks.exports import export_cooked
from reportloom.sources import archives, manifests, reports

COLUMNS = ["d", "a", "b"]


def write_utf16(path, text, mark=True):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((b"\xff\xfe" if mark else b"") + text.encode("utf-16le"))


def python_rows(text):
    rows = list(csv.reader(io.StringIO(text, newline="")))[1:]
    padded = [(r + [""] * len(COLUMNS))[: len(COLUMNS)] for r in rows if r]
    return sorted(tuple(v or None for v in r) for r in padded)


EDGE_TEXTS = {
    "crlf": 'Date,a,b\r\n2021-01-04,"x, ""y""","z,1"\r\n2021-01-05,é,plain\r\n2021-01-06,"q\nnl",last',
    "lf": 'Date,a,b\n2021-01-04,"x, y",z\n2021-01-05,,\n2021-01-06,short\n2021-01-07,l,m,long\n',
    "straddle": "Date,a,b\n2021-01-08,ਅĀ,g\n2021-01-09,k,l\n",
    "quote bytes": 'Date,a,b\n2021-01-08,"−\n",g\n2021-01-09,∀ ∃ Ģ,l\n',
    "header only": "Date,a,b\r\n",
    "quoted ends": 'Date,a,b\r\n2021-01-04,x,"z,1"\r\n2021-01-05,y,"w"\r\n',
}


SPLITS = {
    "lone cr": "Date,a,b\r2021-01-04,x,y\r2021-01-05,z,w\r",
    "even quotes": 'Date,a,b\n1,5" s,"l1\nl2",7" k\n',
    "cr in quotes": 'Date,a,b\n1,"x\r",y\n',
    "plain crlf": "Date,a,b\r\n1,x,y\r\n2,z,w\r\n",
}


@pytest.mark.parametrize("name", [*EDGE_TEXTS, *SPLITS])
def test_a_split_gives_the_same_rows_or_an_error(spark, tmp_path, name):
    (tmp_path / "f.csv").write_bytes((EDGE_TEXTS | SPLITS)[name].encode())

    def read(split):
        rows = reports.read_report_csv(spark, str(tmp_path), COLUMNS, reports.PLAIN_REPORT, split=split)
        return sorted(map(tuple, rows.collect()), key=str)

    try:
        assert read(split=True) == read(split=False)
    except reports.SplitError:
        assert name in ("lone cr", "even quotes", "cr in quotes", "crlf", "quote bytes", "quoted ends")


SURPLUS = ["2,x,y,z", "2,x,,,z", "2,x,y,,z", '2,x,y,"",z', "2,x,y,", '2,x,y,""', '2,"a,b","c""d\ne",z', '2,x 5",y,z,"']


@pytest.mark.parametrize("row", SURPLUS)
def test_surplus_columns_fail_every_strict_read(spark, tmp_path, row):
    text = f"Date,a,b\n1,x,y\n{row}\n"
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "f.csv").write_text(text)
    write_utf16(tmp_path / "t" / "stats" / "crashes" / "crashes_app_202101_device.csv", text)
    plain = str(tmp_path / "plain")
    cut = reports.read_report_csv(spark, plain, COLUMNS, reports.PLAIN_REPORT)
    assert [tuple(r)[0] for r in cut.sort("d").collect()] == ["1", "2"]
    reads = [
        lambda: reports.read_report_csv(spark, plain, COLUMNS, reports.PLAIN_REPORT, strict=True),
        lambda: reports.scan_feed(spark, {"t": str(tmp_path / "t")}, "crashes", ["device"], ["202101"], 3),
        lambda: reports.read_supported_devices(spark, plain, COLUMNS),
    ]
    if "\n" not in row and '5"' not in row:
        reads.append(lambda: reports.read_report_csv(spark, plain, COLUMNS, reports.PLAIN_REPORT, split=True, strict=True))
    for read in reads:
        with pytest.raises(Exception, match="more than 3 columns"):
            read().collect()


def test_surplus_columns_of_cooked_files_fail(spark, tmp_path):
    for number, row in enumerate(["1,2,,x", "1,2,%%,x", "1,%a,b%,x", "1,2,x"]):
        (tmp_path / f"{number}.csv").write_text(f"1,2\n{row}\n")
        with pytest.raises(Exception, match="more than 2 columns"):
            reports.read_cooked_csv(spark, str(tmp_path / f"{number}.csv"), ["a", "b"]).collect()


def test_short_rows_and_long_fields_load_strictly(spark, tmp_path):
    field = 'q""' * 30_000 + "a,b\n" * 10_000
    (tmp_path / "f.csv").write_text(f'Date,a,b\n1\n2,x\n3,"{field}"\n4,x 5",y\n5,"a,b"\n6,"a,b","c,d"\n')
    got = reports.read_report_csv(spark, str(tmp_path), COLUMNS, reports.PLAIN_REPORT, strict=True)
    rows = [tuple(r)[:3] for r in got.sort("d").collect()]
    assert rows == [
        ("1", None, None), ("2", "x", None), ("3", field.replace('""', '"'), None), ("4", 'x 5"', "y"),
        ("5", "a,b", None), ("6", "a,b", "c,d"),
    ]


@pytest.mark.parametrize("beyond", [("x",), (None, "x"), ("", "x"), ("",)])
def test_cooking_fails_on_fields_beyond_a_feed(spark, beyond):
    from reportloom.operators.cooking import cook_feeds
    from reportloom.schemas import FeedColumn, FeedSpec

    spec = FeedSpec("f", "day", (FeedColumn("day", 0, "date"), FeedColumn("name", 1, "text")))
    names = ", ".join(f"c{i} string" for i in range(2 + len(beyond)))
    raw = spark.createDataFrame([("f", "t", "2021-01-04", "n", *beyond)], f"feed string, tenant string, {names}")
    with pytest.raises(Exception, match="more than 2 columns in feed f"):
        cook_feeds(raw, [spec]).collect()
    short = spark.createDataFrame([("f", "t", "2021-01-04", None, *[None] * len(beyond))], raw.schema)
    assert cook_feeds(short, [spec]).count() == 1


@pytest.mark.parametrize("name", list(EDGE_TEXTS))
def test_utf16_scan_reads_what_python_reads(spark, tmp_path, name):
    write_utf16(tmp_path / "f.csv", EDGE_TEXTS[name])
    got = reports.read_utf16_csv(spark, str(tmp_path), COLUMNS)
    assert sorted(tuple(r)[:3] for r in got.collect()) == python_rows(EDGE_TEXTS[name])


@pytest.mark.parametrize("name", list(EDGE_TEXTS))
def test_utf8_scan_reads_what_python_reads(spark, tmp_path, name):
    (tmp_path / "f.csv").write_bytes(EDGE_TEXTS[name].encode())
    got = reports.read_report_csv(spark, str(tmp_path), COLUMNS, reports.PLAIN_REPORT)
    assert sorted(tuple(r)[:3] for r in got.collect()) == python_rows(EDGE_TEXTS[name])


def test_cooked_files_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,%one, two%,y\n1,2,3\n")
    (tmp_path / "b.csv").write_text("x,%one\ntwo%,y\n")
    got = reports.read_cooked_csv(spark, str(tmp_path), COLUMNS)
    with pytest.raises(reports.SplitError):
        reports.read_cooked_csv(spark, str(tmp_path), COLUMNS, split=True)
    rows = sorted((r.d, r.a, r.b) for r in got.collect())
    assert rows == [("1", "2", "3"), ("x", "one\ntwo", "y"), ("x", "one, two", "y")]


def test_broken_lines_are_found(spark, tmp_path):
    for name, text in EDGE_TEXTS.items():
        write_utf16(tmp_path / f"{name}.csv", text)
    broken = reports.files_with_broken_lines(
        spark, str(tmp_path), reports.UTF16_REPORT, F.lit(True)
    )
    assert sorted(b.rsplit("/", 1)[1].replace("%20", " ") for b in broken) == [
        "crlf.csv", "quote bytes.csv", "straddle.csv"
    ]


def test_large_files_are_split_without_loss(spark, tmp_path):
    lines = [f'2021-01-{i % 28 + 1:02d},"name, {i}",{i}' for i in range(60000)]
    write_utf16(tmp_path / "big.csv", "Date,a,b\r\n" + "\r\n".join(lines) + "\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 256 * 1024)
    try:
        got = reports.read_utf16_csv(spark, str(tmp_path), COLUMNS, split=True)
        assert got.rdd.getNumPartitions() > 4
        assert got.count() == 60000
        assert got.agg(F.sum(F.col("b").cast("bigint"))).first()[0] == sum(range(60000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bytes_that_are_no_utf16_are_dropped(spark, tmp_path):
    lone_low = b"\x00\xdc"
    head = b"\xff\xfe" + "Date,a,b\n2021-01-04,x".encode("utf-16le")
    (tmp_path / "f.csv").write_bytes(head + lone_low + "y,z".encode("utf-16le") + b"\x41")
    row = reports.read_utf16_csv(spark, str(tmp_path), COLUMNS).first()
    assert tuple(row)[:3] == ("2021-01-04", "xy", "z")


def test_lone_high_surrogate_takes_its_neighbour_along(spark, tmp_path):
    # The JVM decoder reports a high surrogate without its partner together with
    # the character after it; Python would keep that character ("xy").
    lone_high = b"\x00\xd8"
    head = b"\xff\xfe" + "Date,a,b\n2021-01-04,x".encode("utf-16le")
    (tmp_path / "f.csv").write_bytes(head + lone_high + "y,z\n".encode("utf-16le"))
    row = reports.read_utf16_csv(spark, str(tmp_path), COLUMNS).first()
    assert tuple(row)[:3] == ("2021-01-04", "x", "z")


def test_feed_scan_picks_objects_by_name(spark, tmp_path):
    header = "Date,a,b\n"
    for tenant in ("t1", "t2"):
        folder = tmp_path / tenant / "stats" / "crashes"
        for month in ("202101", "202102"):
            for feed in ("device", "overview"):
                text = header + f"2021-01-04,{tenant},{month}{feed}\n"
                write_utf16(folder / f"crashes_com.my_app_{month}_{feed}.csv", text)
        write_utf16(folder / "other_com.my_app_202101_device.csv", header + "2021-01-04,no,no\n")
    roots = {t: str(tmp_path / t) for t in ("t1", "t2")}
    got = reports.scan_feed(spark, roots, "crashes", ["device", "os_version"], ["202101"], 3)
    rows = sorted(tuple(r) for r in got.drop("source_file").collect())
    assert rows == [
        (t, "device", "202101", "com.my_app", "2021-01-04", t, "202101device") for t in ("t1", "t2")
    ]
    none = reports.scan_feed(spark, roots, "crashes", ["device"], ["199901"], 3)
    assert none.count() == 0


def test_sales_scan(spark, tmp_path):
    text = 'a,b\n"1\n2",é-x\n"q""q",007\n'
    (tmp_path / "s.csv").write_text(text, encoding="utf-8")
    got = reports.read_sales_csv(spark, str(tmp_path), ["a", "b"]).collect()
    assert sorted(map(tuple, got)) == [("1\n2", "-x"), ('q"q', "007")]


def test_device_scan_drops_tabs(spark, tmp_path):
    (tmp_path / "d.csv").write_text('a,b,c,d\nx\t,"y,\t z",w,v\n', encoding="utf-8")
    assert tuple(reports.read_supported_devices(spark, str(tmp_path)).first()) == ("x", "y, z", "w", "v")


def test_cooked_file_is_as_worked_by_hand(spark, tmp_path):
    df = spark.createDataFrame(
        [("2021-01-04", "com.x", "Pixel 4, XL 50", "1234", "5.5", "device", "a")],
        "c0 string, c1 string, c2 string, c3 string, c4 string, feed string, tenant string",
    )
    columns = [f"c{i}" for i in range(5)]
    path = str(tmp_path / "out")
    export_cooked(df, path, columns)
    (file,) = (tmp_path / "out").glob("p_feed=device/p_date=2021-01-04/p_tenant=a/*.csv")
    assert file.read_text() == "2021-01-04,com.x,%Pixel 4, XL 50%,1234,5.5\n"
    assert tuple(reports.read_cooked_csv(spark, path, columns).first())[2] == "Pixel 4, XL 50"


def make_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)


def test_archives_of_a_month_do_not_clash(spark, tmp_path):
    for n in (1, 2):
        body = f'h1,h2\n"a\n{n}",é\nshort\n\n'
        make_zip(tmp_path / f"earnings_202101_7-{n}.zip", {"PlayApps_202101.csv": body, "sub/": ""})
    (tmp_path / "other.txt").write_text("no zip")
    files = archives.scan_objects(spark, str(tmp_path), F.col("_metadata.file_path").rlike(r"\.zip$"))
    records = archives.expand_archives(files)
    rows = archives.archive_rows(records, ["x", "y"]).select("numbered_member", "x", "y")
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("PlayApps_202101_1.csv", "a\n1", "é"),
        ("PlayApps_202101_1.csv", "short", None),
        ("PlayApps_202101_2.csv", "a\n2", "é"),
        ("PlayApps_202101_2.csv", "short", None),
    ]


def test_archive_in_ascii_ignores_other_characters(spark, tmp_path):
    make_zip(tmp_path / "salesreport_202101.zip", {"salesreport_202101.csv": "h\né1\n"})
    records = archives.expand_archives(
        archives.scan_objects(spark, str(tmp_path)), encoding="ascii", errors="ignore"
    )
    assert [r.fields for r in records.orderBy("row_no").collect()] == [["h"], ["1"]]


def test_archive_larger_than_a_batch(spark, tmp_path):
    body = "h\n" + "".join(f"{i}\n" for i in range(10000))
    make_zip(tmp_path / "a-1.zip", {"m.csv": body, "n.csv": body})
    records = archives.expand_archives(archives.scan_objects(spark, str(tmp_path)))
    assert records.count() == 20002
    assert records.select("member", "row_no").distinct().count() == 20002


def test_transcode_consumes_the_mark(spark):
    text = "a,é,日\r\n"
    df = spark.createDataFrame(
        [("le", bytearray(b"\xff\xfe" + text.encode("utf-16le"))), ("be", bytearray(b"\xfe\xff" + text.encode("utf-16be")))],
        "path string, content binary",
    )
    assert [r.text for r in archives.transcode_utf16(df).collect()] == [text, text]


def test_repeated_headers(spark):
    texts = spark.createDataFrame([("f", "Date,a\nr1\nDate,a\nr2")], "k string, t string")
    lines = drop_repeated_headers(archives.split_lines(texts, "k", "t"))
    assert [r.line for r in lines.orderBy("line_no").collect()] == ["Date,a", "r1", "r2"]


def write_manifest(path, entries):
    import json

    path.write_text(json.dumps({"entries": entries}))
    return str(path)


def read_two(spark):
    return lambda paths: reports.read_cooked_csv(spark, paths, ["a", "b"])


def test_manifest_reads_listed_files_only(spark, tmp_path):
    for n in "xyz":
        (tmp_path / f"{n}.csv").write_text(f"{n},%q, {n}%\n")
    path = write_manifest(
        tmp_path / "m.txt",
        [
            {"url": str(tmp_path / "x.csv"), "mandatory": True},
            {"url": str(tmp_path / "z.csv")},
            {"url": str(tmp_path / "gone.csv")},
        ],
    )
    got = manifests.load_from_manifest(spark, path, read_two(spark))
    assert sorted((r.a, r.b) for r in got.collect()) == [("x", "q, x"), ("z", "q, z")]


def test_missing_mandatory_file_fails(spark, tmp_path):
    path = write_manifest(tmp_path / "m.txt", [{"url": str(tmp_path / "gone.csv"), "mandatory": True}])
    with pytest.raises(AnalysisException):
        manifests.load_from_manifest(spark, path, read_two(spark))


def test_manifest_with_nothing_to_read(spark, tmp_path):
    path = write_manifest(tmp_path / "m.txt", [{"url": str(tmp_path / "gone.csv")}])
    assert manifests.load_from_manifest(spark, path, read_two(spark)) is None


def test_reports_that_lie_together_are_told_by_their_names(spark, tmp_path):
    for tenant, feed in (("ta", "device"), ("tb", "os_version")):
        write_utf16(tmp_path / "in" / f"crashes_{tenant}_202101_{feed}.csv", EDGE_TEXTS["crlf"])
    rows = reports.scan_named_feed(spark, str(tmp_path / "in"), ["ta", "tb"], 3)
    assert {(r.tenant, r.feed, r.n) for r in rows.groupBy("tenant", "feed").agg(F.count("*").alias("n")).collect()} == {
        ("ta", "device", 3), ("tb", "os_version", 3)
    }
    # An object without rows may have any name.
    write_utf16(tmp_path / "in" / "notes.csv", EDGE_TEXTS["header only"])
    assert rows.count() == 6
    write_utf16(tmp_path / "in" / "crashes_tc_202101_device.csv", EDGE_TEXTS["crlf"])
    found = reports.scan_named_feed(spark, str(tmp_path / "in"), ["ta", "tb"], 3)
    with pytest.raises(Exception, match="no class in the name: crashes_tc_202101_device.csv"):
        found.collect()
