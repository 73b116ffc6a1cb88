"""Which feeds have new days, on the cases worked out by hand."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportloom.operators import freshness as ops

SCHEMA = "feed string, report_date date, tenant string"
AB = ["A", "B"]


def day(n):
    return dt.date(2021, 1, n)


def parts(spark, entries, feed="device"):
    return spark.createDataFrame([(feed, day(d), t) for d, t in entries], SCHEMA)


def presence(spark, local, published, **options):
    rows = ops.next_date_present(parts(spark, local), parts(spark, published), AB, **options).collect()
    return [(r.latest_date, r.next_date, r.is_new) for r in rows]


BOTH = lambda *days: [(d, t) for d in days for t in AB]


def test_next_day_is_there(spark):
    published = [*BOTH(4), (5, "A")]
    assert presence(spark, BOTH(4, 5, 6), published) == [(day(4), day(5), True)]


def test_hole_means_not_new(spark):
    assert presence(spark, BOTH(4, 6), BOTH(4)) == [(day(4), day(5), False)]


def test_one_account_missing_means_not_new(spark):
    assert presence(spark, [*BOTH(4), (5, "A")], BOTH(4)) == [(day(4), day(5), False)]
    assert presence(spark, [*BOTH(4), (5, "A")], BOTH(4), optional=["B"]) == [(day(4), day(5), True)]


def test_optional_account_still_counts_for_completeness(spark):
    local = [*BOTH(4), (5, "A"), (6, "A")]
    published = [*BOTH(4), (5, "A")]
    assert presence(spark, local, published, optional=["B"]) == [(day(4), day(5), True)]


def test_nothing_published_starts_at_the_oldest_day(spark):
    assert presence(spark, BOTH(2, 3, 4), []) == [(None, day(2), True)]
    assert presence(spark, [(2, "A"), *BOTH(3)], []) == [(None, day(2), False)]


def test_published_days_that_are_not_local_do_not_count(spark):
    assert presence(spark, BOTH(4, 5), BOTH(3, 9)) == [(None, day(4), True)]


def test_nothing_local_gives_no_feed(spark):
    assert presence(spark, [], BOTH(3)) == []


some = st.lists(st.tuples(st.integers(1, 8), st.sampled_from(AB)), max_size=10)


@settings(max_examples=15, deadline=None)
@given(some, some)
def test_presence_as_a_walk_over_days(spark, local, published):
    """The same by walking days from the newest down, as a person would."""
    days = sorted({d for d, _ in local}, reverse=True)
    latest = next((d for d in days if all((d, t) in published for t in AB)), None)
    expected = []
    if days:
        expect = days[-1] if latest is None else latest + 1
        new = all((expect, t) in local for t in AB)
        expected = [(day(latest) if latest else None, day(expect), new)]
    assert presence(spark, local, published) == expected


def test_status(spark):
    assert ops.status_note([]) == "No New Data"
    for feeds in ([], ["overview", "device"]):
        frame = spark.createDataFrame([(f,) for f in feeds], "feed string")
        assert ops.status_text(frame).first().status == ops.status_note(feeds)
    assert ops.status_note(["overview", "device"]) == "['device', 'overview']"


@pytest.mark.parametrize(
    "sales, installs, load, code",
    [
        (True, True, "both", 1), (True, False, "both", 2), (False, True, "both", 3),
        (True, True, "sales", 2), (True, True, "installs", 3),
        (False, True, "sales", 0), (True, False, "installs", 0), (False, False, "both", 0),
    ],
)
def test_status_code(spark, sales, installs, load, code):
    got = spark.range(1).select(
        ops.sales_status_code(F.lit(sales), F.lit(installs), F.lit(load)).alias("c")
    )
    assert got.first().c == code


def test_routes(spark):
    rows = [("['device', 'overview']",), ("No New Data",), ("Error: x",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.b for r in df.select(ops.route_feed(F.col("s"), F.lit("device")).alias("b")).collect()]
    assert got == ["new_device_crashes", "no_new_device_crashes", "error"]


def test_gate_needs_a_file_of_every_account(spark):
    files = spark.createDataFrame(
        [("g", "A", "PlayApps_202101_1.csv"), ("g", "B", "Other_202101_1.csv"),
         ("h", "A", "PlayApps_202101_1.csv"), ("h", "B", "PlayApps_202101_2.csv"), ("h", "C", "x")],
        "g string, tenant string, name string",
    )
    got = ops.all_tenants_present(files, "g", F.lit(r"^PlayApps_202101_.*\.csv$"), AB)
    assert {r.g: r.file_found for r in got.collect()} == {"g": False, "h": True}


def test_published_parts(spark):
    got = ops.published_parts(parts(spark, BOTH(1, 2)), parts(spark, [(1, "A"), (9, "B")]))
    assert [tuple(r) for r in got.collect()] == [("device", day(1), "A")]
