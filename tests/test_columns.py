"""Column functions on rows worked out by hand."""

import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from reportloom.config import LoadConfig, Target, month_span, shift_month
from reportloom.functions import clean, dates, names
from reportloom.operators.cooking import cook_feeds
from reportloom.schemas import FeedColumn, FeedSpec


def values(spark, rows, column):
    """``column`` over one text column ``c``."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def day(text):
    return F.lit(text).cast("date")


def test_metrics_lose_commas_and_percent_signs(spark):
    got = values(spark, ["1,234", "5.5%", "12.5%", "", None], clean.clean_metric(F.col("c")))
    assert got == ["1234", "5.5", "12.5", "", None]


def test_metric_type(spark):
    assert values(spark, ["1,234", " ", None], clean.to_metric(F.col("c"), "bigint")) == [1234, None, None]


def test_text_keeps_commas(spark):
    assert values(spark, ["Pixel 4, XL 50%"], clean.clean_text(F.col("c"))) == ["Pixel 4, XL 50"]


def test_blank_to_null(spark):
    got = values(spark, ["", "   ", " x ", "\t\n", None], clean.blank_to_null(F.col("c")))
    assert got == [None, None, " x ", None, None]


def test_non_ascii_is_dropped(spark):
    assert values(spark, ["é1ü", "日本", "ok"], clean.strip_non_ascii(F.col("c"))) == ["1", "", "ok"]


def test_sales_positions(spark):
    number = clean.clean_sales_column(10, F.col("c"))
    text = clean.clean_sales_column(16, F.col("c"))
    assert values(spark, ["1,2%"], number) == ["12"]
    # The percent sign goes from the last column too, comma or not.
    assert values(spark, ["5%", "1,2%"], text) == ["5", "1,2"]


def test_width_cap():
    assert clean.cap_width([f"c{i}" for i in range(19)]) == [f"c{i}" for i in range(17)]


@settings(max_examples=20, deadline=None)
@given(st.text("0123456789", min_size=1, max_size=8), st.integers(0, 7), st.sampled_from(["Charged", "", None]))
def test_key_does_not_depend_on_dashes(spark, digits, at, status):
    dashed = digits[:at] + "-" + digits[at:]
    key = clean.surrogate_key(F.lit(dashed), F.lit(status))
    assert one(spark, key) == hashlib.md5((digits + (status or "")).encode()).hexdigest()


def test_key_of_a_sale(spark):
    key = clean.surrogate_key(F.lit("GPA.1-2-3"), F.lit("Charged"))
    assert one(spark, key) == hashlib.md5(b"GPA.123Charged").hexdigest()


def test_strict_date(spark):
    got = values(spark, ["2021-01-04", "2021-1-4"], dates.strict_report_date(F.col("c")))
    assert got == [dt.date(2021, 1, 4)] * 2


@pytest.mark.parametrize("bad", ["2021-02-30", "04/01/2021", "2021-01-04x", "", None])
def test_bad_report_date_fails(spark, bad):
    with pytest.raises(SparkRuntimeException):
        values(spark, [bad], dates.strict_report_date(F.col("c")))


def test_auto_dates(spark):
    rows = ["2021-02-24", "Feb 24, 2021", "2/24/2021", "24 Feb 2021", "20210224", "soon", "Feb 30, 2021", None]
    got = values(spark, rows, dates.parse_auto_date(F.col("c")))
    assert got == [dt.date(2021, 2, 24)] * 5 + [None] * 3


def test_auto_times(spark):
    rows = ["2021-02-24 13:00:01", "2021-02-24T13:00:01", "Feb 24, 2021 1:00:01 PM", "x"]
    got = values(spark, rows, dates.parse_auto_time(F.col("c")))
    assert got == [dt.datetime(2021, 2, 24, 13, 0, 1)] * 3 + [None]


def test_past_months(spark):
    as_of = day("2021-02-10")
    assert one(spark, dates.past_months(as_of, 3)) == ["202012", "202101", "202102"]
    assert one(spark, dates.past_months(as_of, 0)) == []
    assert len(set(one(spark, dates.past_months(as_of, 30)))) == 30


def test_range_months(spark):
    a, b = day("2020-11-05"), day("2021-01-01")
    assert one(spark, dates.range_months(a, b)) == ["202011", "202012", "202101"]
    assert one(spark, dates.range_months(b, a)) == []


def test_month_back_and_pattern(spark):
    assert one(spark, dates.month_back_label(day("2021-03-31"), 1)) == "202102"
    assert one(spark, dates.month_like_pattern(day("2021-03-31"))) == "Feb%2021"


def test_day_gate(spark):
    assert one(spark, dates.day_gate(day("2021-03-20"))) is True
    assert one(spark, dates.day_gate(day("2021-03-21"))) is False


@settings(max_examples=30, deadline=None)
@given(st.text("Feb 2021,JanX4", max_size=14))
def test_text_month_agrees_with_like(spark, text):
    c = F.lit(text)
    both = F.struct(
        c.like("Feb%2021").alias("like"),
        F.coalesce(dates.text_month(c) == "2021-Feb", F.lit(False)).alias("label"),
    )
    got = one(spark, both)
    assert got.like == got.label


def test_feed_of_a_name(spark):
    got = values(
        spark,
        ["crashes_device_tenant_a_202101.csv", "x_os_version_device.csv", "/device/x_overview.csv", "x.csv"],
        names.classify_feed(F.col("c")),
    )
    assert got == ["device", "device", "overview", None]


def test_last_label_wins(spark):
    got = values(
        spark, ["a_one_two", "a_two_one", "a_one", "/one/zero"], names.classify_tenant(F.col("c"), ["one", "two"])
    )
    assert got == ["two", "two", "one", None]


def test_numbered_member(spark):
    path = F.lit("bucket/earnings/earnings_202101_7-3.zip")
    got = values(spark, ["PlayApps_202101.csv", "noext"], names.numbered_member(F.col("c"), path))
    assert got == ["PlayApps_202101_3.csv", "noext_3.noext"]


def test_report_patterns(spark):
    rows = [
        "earnings/earnings_202101_7-3.zip",
        "old/earnings/earnings_202101_7-3.zip",
        "sales/salesreport_202101.zip",
        "sales/salesreport_202102.zip",
        "stats/installs/installs_com.x_202101_country.csv",
        "stats/installs/installs_com.x_202101_device.csv",
        "stats/installs/installs_com.x_202101_language.csv",
    ]
    got = values(spark, rows, names.match_report(F.col("c"), ["202101"]))
    assert got == ["earnings", None, "sales", None, "stats_installs_country", "stats_installs_device", None]
    folders = values(spark, got, names.sub_folder(F.col("c")))
    assert folders == ["earnings", None, "sales", None, "stats/installs", "stats/installs", None]


def test_config_months():
    base = dict(tenants={}, output_root="/x")
    assert LoadConfig(run_date=dt.date(2021, 2, 10), backfill=3, **base).months() == ["202012", "202101", "202102"]
    assert LoadConfig(run_date=dt.date(2021, 2, 10), backfill=0, **base).months() == []
    ranged = LoadConfig(
        run_date=dt.date(2021, 2, 10), date_format="Range", start_date="2020-11", end_date="2021-01", **base
    )
    assert ranged.months() == ["202011", "202012", "202101"]
    assert LoadConfig(run_date=dt.date(2021, 1, 5), month_back=1, **base).earnings_month() == dt.date(2020, 12, 1)


def test_config_is_checked():
    with pytest.raises(ValueError):
        LoadConfig({}, dt.date(2021, 1, 1), "/x", date_format="Someday")
    with pytest.raises(ValueError):
        LoadConfig({}, dt.date(2021, 1, 1), "/x", load="everything")
    with pytest.raises(ValueError):
        LoadConfig({}, dt.date(2021, 1, 1), "/x", date_format="Range")


def test_config_from_dict():
    config = LoadConfig.from_dict(
        {
            "tenants": {"a": "/a"}, "output_root": "/x", "load": "both",
            "targets": [{"endpoint": "w", "skip": ["device"], "tables": {"overview": "t"}}],
        },
        dt.date(2021, 1, 1),
    )
    assert config.feeds() == ["sales", "installs_country"]
    assert config.targets == (Target("w", frozenset({"device"}), {"overview": "t"}),)


def test_misspelt_settings_are_errors():
    with pytest.raises(ValueError, match="restrictd"):
        LoadConfig.from_dict({"tenants": {}, "output_root": "/x", "restrictd": {}}, dt.date(2021, 1, 1))


def test_feeds_from_plain_settings():
    feed = {
        "name": "overview", "date_column": "day",
        "columns": [
            {"name": "day", "source": 0, "kind": "date"},
            {"name": "crashes", "source": 2, "kind": "metric", "type": "bigint"},
        ],
    }
    config = LoadConfig.from_dict(
        {"tenants": {}, "output_root": "/x", "crash_feeds": [feed]}, dt.date(2021, 1, 1)
    )
    assert config.feeds() == ["overview"] and config.crash_feeds[0].width == 3


@given(st.integers(-500, 500))
def test_month_arithmetic(n):
    start = dt.date(2000, 6, 15)
    other = shift_month(start, n)
    span = month_span(min(start, other), max(start, other))
    assert len(set(span)) == len(span) == abs(n) + 1


def test_a_name_of_no_class_fails_where_one_is_required(spark):
    df = spark.createDataFrame([("crashes_device_x",), ("crashes_other",)], "c string")
    feed = names.required(names.classify_feed(F.col("c")), F.col("c"))
    assert df.limit(1).select(feed).first()[0] == "device"
    with pytest.raises(Exception, match="no class in the name: crashes_other"):
        df.select(feed).collect()


@pytest.mark.parametrize(
    "kind, good, parsed, bad",
    [
        ("time", [" 2021-02-03T04:05:06 ", "Feb 3, 2021 4:05:06 PM", " ", None],
         [dt.datetime(2021, 2, 3, 4, 5, 6), dt.datetime(2021, 2, 3, 16, 5, 6), None, None], "2021-02-30 00:00:00"),
        ("any_date", ["20210203", "2/3/2021", "", None], [dt.date(2021, 2, 3), dt.date(2021, 2, 3), None, None], "soon"),
    ],
)
def test_dates_and_times_of_any_spelling_in_a_feed(spark, kind, good, parsed, bad):
    spec = FeedSpec("f", "at", (FeedColumn("at", 0, kind, "string"),))

    def cooked(values):
        rows = spark.createDataFrame([(v, "t", "f") for v in values], "c0 string, tenant string, feed string")
        return [r["at"] for r in cook_feeds(rows.coalesce(1), [spec]).collect()]

    assert cooked(good) == parsed
    with pytest.raises(Exception, match=f"bad report .*: {bad}"):
        cooked([*good, bad])


def test_a_column_of_no_known_kind_is_refused():
    with pytest.raises(ValueError, match="unknown kind 'when'"):
        FeedColumn("at", 0, "when")
