"""Replacing, checking and fanning out tables."""

import datetime as dt
import json
import shutil

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportloom.config import Target
from reportloom.plans import staging
from reportloom.sinks import control, statistics, tables, targets
from reportloom.workspace import new_folder, shared_root

SCHEMA = "crash_date date, n int, tenant string, feed string"
LAYOUTS = [tables.Layout("crash_date", grain=g) for g in ("day", "month")]


def rows_of(spark, path, layout):
    schema = layout.place(spark.createDataFrame([], SCHEMA)).schema
    table = layout.rows(tables.read_table(spark, path, schema))
    return sorted(tuple(r) for r in table.select("crash_date", "n", "tenant", "feed").collect())


def frame(spark, rows):
    return spark.createDataFrame([(dt.date(2021, 1, 1) + dt.timedelta(d), n, t, f) for d, n, t, f in rows], SCHEMA)


def dated(rows):
    return sorted((dt.date(2021, 1, 1) + dt.timedelta(d), n, t, f) for d, n, t, f in rows)


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda x: x.grain)
def test_replace_by_date_takes_all_accounts(spark, tmp_path, layout):
    path = str(tmp_path / "t")
    old = [(d, 1, t, "device") for d in (0, 1, 2) for t in "AB"]
    new = [(d, 2, "A", "device") for d in (1, 2)]
    tables.replace_by_date(frame(spark, old), path, layout)
    assert rows_of(spark, path, layout) == dated(old)
    for _ in range(2):  # a second run changes nothing
        tables.replace_by_date(frame(spark, new), path, layout)
        assert rows_of(spark, path, layout) == dated([r for r in old if r[0] == 0] + new)


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda x: x.grain)
def test_empty_batch_deletes_nothing(spark, tmp_path, layout):
    path = str(tmp_path / "t")
    old = [(0, 1, "A", "device")]
    tables.replace_by_date(frame(spark, old), path, layout)
    tables.replace_by_date(frame(spark, []), path, layout)
    assert rows_of(spark, path, layout) == dated(old)


entries = st.lists(
    st.tuples(st.integers(0, 70), st.integers(0, 9), st.sampled_from("AB"), st.sampled_from(["device", "overview"])),
    max_size=12,
)


@settings(max_examples=6, deadline=None)
@given(entries, entries)
def test_day_and_month_layouts_agree(spark, old, new):
    touched = {(d, f) for d, _, _, f in new}
    expected = dated([r for r in old if (r[0], r[3]) not in touched] + new)
    for layout in LAYOUTS:
        path = new_folder(spark, "prop")
        tables.write_table(layout.place(frame(spark, old)), path, layout.partition_by)
        tables.replace_by_date(frame(spark, new), path, layout)
        assert rows_of(spark, path, layout) == expected


def test_month_layout_reads_no_old_rows_when_the_batch_has_all_days(spark, tmp_path):
    layout = tables.Layout("crash_date")
    path = str(tmp_path / "t")
    old = frame(spark, [(0, 1, "A", "device"), (40, 1, "A", "device")])
    tables.replace_by_date(old, path, layout)
    stored = tables.read_table(spark, path, layout.place(old).schema)
    covered = layout.place(frame(spark, [(0, 5, "A", "device"), (1, 5, "A", "device")]))
    assert tables._days_to_keep(covered, stored, layout) is None
    partly = layout.place(frame(spark, [(1, 5, "A", "device")]))
    kept = tables._days_to_keep(partly, stored, layout)
    assert [r.crash_date for r in kept.collect()] == [dt.date(2021, 1, 1)]


def test_days_that_stay_are_found_for_many_tables_at_once(spark, tmp_path):
    both, one = tables.Layout("crash_date"), tables.Layout("crash_date", leading=())
    rows = frame(spark, [(0, 1, "A", "device"), (1, 1, "A", "device"), (40, 1, "A", "device"), (0, 1, "A", "overview")])
    paths = {"all": (rows, both), "device": (rows.filter("feed = 'device'").drop("feed"), one)}
    for name, (df, layout) in paths.items():
        tables.replace_by_date(df, str(tmp_path / name), layout)
    batch = frame(spark, [(1, 5, "A", "device")])
    days = tables.days_of(batch, both)
    assert days == {("device", "2021-01-02")}
    found = tables.uncovered_days({
        "all": (tables.read_table(spark, str(tmp_path / "all"), both.place(rows).schema), both, days),
        "device": (spark.read.parquet(str(tmp_path / "device")), one, {("2021-01-02",)}),
    })
    # Neither the other feed nor the other month is touched.
    assert found == {"all": {("device", "2021-01-01")}, "device": {("2021-01-01",)}}
    assert tables.uncovered_days({}) == {}


def test_rows_lost_in_any_table_are_noticed(spark):
    layout = tables.Layout("crash_date")
    rows = frame(spark, [(0, 1, "A", "device"), (1, 1, "A", "device"), (0, 1, "A", "overview")])
    device = rows.filter("feed = 'device'").drop("feed")
    feeds = ["device", "overview"]
    older = rows.unionByName(frame(spark, [(-9, 1, "A", "device")]))
    staging.check_loaded(rows, [("all", None, older), ("one", "device", device)], feeds, layout)
    with pytest.raises(tables.ReconciliationError, match="one"):
        staging.check_loaded(rows, [("all", None, rows), ("one", "device", device.limit(1))], feeds, layout)
    with pytest.raises(tables.ReconciliationError, match="all"):
        staging.check_loaded(rows, [("all", None, rows.filter("feed = 'device'"))], feeds, layout)


def test_unknown_grain():
    with pytest.raises(ValueError):
        tables.Layout("d", grain="hour")


def test_replace_in_an_unpartitioned_table(spark):
    target = frame(spark, [(d, 1, t, "device") for d in (0, 1) for t in "AB"])
    batch = frame(spark, [(1, 2, "A", "device")])
    got = tables.replace_rows_by_date(target, batch, batch.select("crash_date").distinct(), "crash_date")
    assert sorted(map(tuple, got.collect())) == dated([(0, 1, "A", "device"), (0, 1, "B", "device"), (1, 2, "A", "device")])


def earnings(spark, rows):
    return spark.createDataFrame(rows, "transaction_date string, amount int, tenant string")


def test_replace_by_month_adds_rows_of_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [("Jan 31, 2021", 1, "A"), ("Feb 1, 2021", 1, "A"), ("Feb 2, 2021", 1, "B"), ("?", 1, "A")]
    new = [("Feb 5, 2021", 2, "A"), ("Jan 31, 2021", 2, "A"), (None, 2, "B")]
    tables.write_earnings(earnings(spark, old), path)
    for _ in range(2):  # loading a batch again changes nothing
        tables.replace_by_month(earnings(spark, new), path, "2021-Feb")
    schema = "transaction_date string, amount int, tenant string, transaction_month string"
    got = tables.read_table(spark, path, schema).drop("transaction_month").collect()
    assert sorted(map(tuple, got), key=str) == sorted([old[0], old[3], *new], key=str)


def test_checked_write(spark, tmp_path):
    df = frame(spark, [(d, d, "A", "device") for d in range(10)])
    assert tables.write_checked(df, str(tmp_path / "t"), ["feed", "crash_date"]) == 10
    with pytest.raises(tables.ReconciliationError):
        tables.check_counts(10, 9, "t")


def test_reconcile_shows_the_difference(spark):
    a = frame(spark, [(0, 1, "A", "device"), (1, 1, "A", "device")])
    b = frame(spark, [(0, 1, "A", "device"), (2, 1, "A", "device")])
    got = {r.crash_date.day: (r.source_rows, r.written_rows, r.ok) for r in tables.reconcile_counts(a, b, ["crash_date"]).collect()}
    assert got == {1: (1, 1, True), 2: (1, 0, False), 3: (0, 1, False)}


def test_column_stats(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 1)], "x string, y int")
    for stats in (tables.column_stats, statistics.exact_stats):
        got = {r.column_name: tuple(r)[1:] for r in stats(df, ["x", "y"]).collect()}
        assert got == {"x": (3, 1, 2, "a", "b"), "y": (3, 1, 1, "1", "1")}
    numbers = spark.createDataFrame([(9,), (10,)], "n int")
    assert tuple(tables.column_stats(numbers, ["n"]).first())[4:] == ("9", "10")


def test_exact_statistics_multiply_no_rows(spark):
    stats = statistics.exact_stats(spark.range(9).selectExpr("id % 4 AS a", "IF(id > 2, id, null) AS b"), ["a", "b"])
    assert "Expand" not in stats._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in stats.collect()] == [("a", 9, 0, 4, "0", "3"), ("b", 9, 3, 6, "3", "8")]
    empty = statistics.exact_stats(spark.range(0), ["id"])
    assert [tuple(r) for r in empty.collect()] == [("id", 0, 0, 0, None, None)]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_statistics_of_touched_partitions_equal_those_of_the_table(spark, tmp_path, grain):
    layout, path, stats = tables.Layout("crash_date", grain=grain), str(tmp_path / "t"), str(tmp_path / "s")
    columns = ["crash_date", "n", "tenant"]
    first = [(d, d % 7, "A", "device") for d in range(0, 90, 3)] + [(5, 10, None, "overview")]
    second = [(d, 100 + d, "B", "device") for d in range(60, 75)]
    for rows in (first, second, second[:1]):
        batch = frame(spark, rows)
        tables.replace_by_date(batch, path, layout)
        table = tables.read_table(spark, path, layout.place(batch).schema)
        days = tables.days_of(batch, layout)
        statistics.note_statistics(spark, table, layout, days, columns, stats)
        got = {tuple(r) for r in spark.read.parquet(f"{stats}/columns").collect()}
        assert got == {tuple(r) for r in statistics.exact_stats(layout.rows(table), columns).collect()}
    touched = tables.in_partitions(table, layout, days)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and touched.count() < table.count()


def test_a_corrected_month_takes_back_what_it_brought(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_earnings(earnings(spark, [("Jan 31, 2021", 1, "A"), ("Feb 1, 2021", 1, "A")]), path)

    def load(*rows):
        tables.replace_by_month(earnings(spark, list(rows)), path, "2021-Feb")
        schema = "transaction_date string, amount int, tenant string, transaction_month string"
        read = tables.read_table(spark, path, schema).drop("transaction_month")
        return sorted((tuple(r) for r in read.collect()), key=str)

    jan, feb, mar = ("Jan 31, 2021", 1, "A"), ("Feb 2, 2021", 2, "A"), ("Mar 1, 2021", 2, "A")
    nobody, late = (None, 2, "B"), ("Jan 30, 2021", 2, "B")
    assert load(feb, mar, late, nobody) == sorted([jan, feb, mar, late, nobody], key=str)
    # March and the rows without a month had no others, January has.
    assert load(feb, late) == sorted([jan, feb, late], key=str)
    assert load(feb, mar) == sorted([jan, feb, mar], key=str)
    assert load(feb) == [feb, jan]
    assert load() == [feb, jan]


def test_a_table_without_an_index_of_strays_is_asked_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_earnings(earnings(spark, [("Jan 31, 2021", 1, "A")]), path)
    tables.replace_by_month(earnings(spark, [("Feb 1, 2021", 1, "A"), ("Mar 1, 2021", 1, "A")]), path, "2021-Feb")
    shutil.rmtree(f"{path}/_strays")
    tables.replace_by_month(earnings(spark, [("Feb 1, 2021", 2, "A")]), path, "2021-Feb")
    got = spark.read.parquet(path).select("transaction_date", "amount").collect()
    assert sorted(map(tuple, got)) == [("Feb 1, 2021", 2), ("Jan 31, 2021", 1)]


def test_analyze_stores_statistics(spark):
    spark.range(10).withColumnRenamed("id", "k").write.mode("overwrite").saveAsTable("stats_probe")
    tables.analyze(spark, "stats_probe", ["k"])
    info = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED stats_probe k").collect()}
    assert info["distinct_count"] == "10" and info["max"] == "9"
    spark.sql("DROP TABLE stats_probe")


def test_targets_skip_and_rename(spark, tmp_path):
    chosen = [
        Target("one"),
        Target("two", skip=frozenset({"device"}), tables={"overview": "renamed"}),
        Target("three"),
    ]
    plan = targets.planned_loads(chosen, ["device", "overview"])
    assert plan == [
        ("one", "device", "device"), ("one", "overview", "overview"),
        ("two", "overview", "renamed"),
        ("three", "device", "device"), ("three", "overview", "overview"),
    ]
    staged = frame(spark, [(0, 1, "A", "device"), (0, 2, "A", "overview")])
    loads = targets.load_feeds(staged, str(tmp_path), chosen, ["device", "overview"], tables.Layout("crash_date"))
    got = {(e, t): [r.n for r in df.collect()] for e, _, t, df in targets.read_loads(spark, str(tmp_path), loads)}
    assert got == {
        ("one", "device"): [1], ("one", "overview"): [2], ("two", "renamed"): [2],
        ("three", "device"): [1], ("three", "overview"): [2],
    }


def test_manifests_of_both_kinds(spark):
    catalog = spark.createDataFrame([("device", "u2"), ("device", "u1"), ("overview", "u3")], "feed string, u string")
    for mandatory in (True, False):
        got = {r.feed: json.loads(r.manifest) for r in control.build_manifest(catalog, F.col("u"), mandatory).collect()}
        flag = {"mandatory": True} if mandatory else {}
        assert got == {
            "device": {"entries": [{"url": "u1", **flag}, {"url": "u2", **flag}]},
            "overview": {"entries": [{"url": "u3", **flag}]},
        }


def test_date_list_has_no_entry_without_dates(spark):
    dates = spark.createDataFrame(
        [("a", dt.date(2021, 1, 5)), ("a", dt.date(2021, 1, 4)), ("b", None)], "feed string, report_date date"
    )
    got = control.date_list(dates).collect()
    assert [(r.feed, r.date_list, r.days) for r in got] == [
        ("a", "('2021-01-04','2021-01-05')", ["2021-01-04", "2021-01-05"])
    ]


def test_published_control_data_is_replaced_by_a_rerun(spark, tmp_path):
    day = dt.date(2021, 1, 4)
    for text in ("first", "second"):
        status = spark.createDataFrame([(text,)], "status string")
        control.publish_status(status, str(tmp_path / "s"), "crashes", day)
        lists = spark.createDataFrame([("device", [text], text)], "feed string, days array<string>, date_list string")
        control.publish_date_lists(lists, str(tmp_path / "d"), day)
        manifests = spark.createDataFrame([("device", text), ("overview", text)], "feed string, manifest string")
        new = spark.createDataFrame([("device",)], "feed string")
        control.publish_manifests(manifests, new, str(tmp_path / "m"), day)
    assert [r.status for r in spark.read.parquet(str(tmp_path / "s")).collect()] == ["second"]
    assert [r.date_list for r in spark.read.parquet(str(tmp_path / "d")).collect()] == ["second"]
    assert [(r.value, r.feed) for r in spark.read.text(str(tmp_path / "m")).collect()] == [("second", "device")]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_key_uniqueness(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert tuple(tables.key_uniqueness(df, "k").first()) == (5, 2, 1)
    assert tuple(tables.key_uniqueness(df.limit(0), "k").first()) == (0, 0, 0)
