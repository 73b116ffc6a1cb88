"""Plans that have to hold on a cluster: pruning, skew, no Python, no cross joins."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import SMALL
from reportloom import frames
from reportloom.operators import freshness
from reportloom.operators.cooking import cook_feeds, cook_sales
from reportloom.schemas import CRASH_FEEDS
from reportloom.sinks import statistics, tables
from reportloom.sources import reports

IN_PYTHON = {"expand_archives"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The corpus queries have tests of their own.
REPORT_QUERIES = [n for n, run in entry_module.queries().items() if run.__module__.startswith("reportloom.queries")]


@pytest.mark.parametrize("name", REPORT_QUERIES)
def test_results_come_without_cross_joins_or_python(spark, name):
    plan = plan_of(entry_module.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in IN_PYTHON:
        assert "Python" not in plan and "Arrow" not in plan


def plans_of_all_jobs(spark, run):
    """The plans of all that ``run`` executes, its writes included, from the event log."""

    def logged():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        folder = spark.sparkContext.getConf().get("spark.eventLog.dir").removeprefix("file://")
        events = [json.loads(x) for f in sorted(Path(folder).rglob("events_*")) for x in f.read_text().splitlines()]
        return [e["physicalPlanDescription"] for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart")]

    before = len(logged())
    run()
    return logged()[before:]


@pytest.mark.parametrize(
    "name", ["crashes_load_second_run", "installs_load", "sales_load", "earnings_load_from_manifest", "devices_load_from_manifest"]
)
def test_no_job_of_a_load_has_a_cross_join_or_row_python(spark, name):
    plans = plans_of_all_jobs(spark, lambda: entry_module.queries()[name](spark, SMALL).collect())
    assert sum("InsertIntoHadoopFsRelationCommand" in plan for plan in plans) > 3
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        # Zips are opened by Arrow batches; only the test's own zips are made in Python.
        if not name.startswith("earnings"):
            assert not any(x in plan for x in ("EvalPython", "MapInArrow", "MapInPandas", "InPandas"))


def test_a_second_run_reads_touched_partitions_only(spark):
    plans = plans_of_all_jobs(spark, lambda: entry_module.queries()["crashes_load_second_run"](spark, SMALL))
    scans = [
        part for plan in plans for part in plan.split("\n\n")
        if "Scan parquet" in part and "crashes-second" in part and ("/table]" in part or "/out/tables/" in part)
    ]
    assert len(scans) > 10
    # The statistics of a table that has none yet are those of all its partitions.
    unpruned = [scan for scan in scans if "PartitionFilters: [" not in scan or "PartitionFilters: []" in scan]
    assert len(unpruned) <= 1, unpruned


def test_column_operators_stay_in_one_stage(spark):
    for df in (
        cook_feeds(frames.crash_raw(spark, SMALL), CRASH_FEEDS),
        cook_sales(frames.sales_raw(spark, SMALL)),
    ):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Project" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(freshness.file_catalog(frames.crash_keys(spark, SMALL)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_freshness_shuffles_parts_once_and_days_once(spark):
    keys = frames.crash_keys(spark, SMALL)
    published = spark.createDataFrame([("device", dt.date(2024, 1, 1), "tenant_a")], keys.schema)
    plan = plan_of(freshness.next_date_present(keys, published, frames.TENANTS))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_max" in plan


def test_files_are_pruned_by_name_before_they_are_read(spark, tmp_path):
    folder = tmp_path / "t" / "stats" / "crashes"
    folder.mkdir(parents=True)
    for month in range(1, 10):
        text = "Date,a\n2021-01-04,x\n"
        (folder / f"crashes_p_20210{month}_device.csv").write_bytes(text.encode("utf-16le"))
    got = reports.scan_feed(spark, {"t": str(tmp_path / "t")}, "crashes", ["device"], ["202103"], 2)
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan()
    got.collect()
    assert plan.collectLeaves().apply(0).metrics().apply("numFiles").value() == 1


def test_a_hot_key_is_written_by_many_tasks(spark, tmp_path):
    # 90 of 100 rows share one key; the rebalance splits them, none get lost.
    rows = 400000
    df = spark.range(rows).select(
        F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("feed"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    )
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tables.write_table(df, str(tmp_path / "t"), ["feed"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "t" / "feed=hot").glob("*.parquet"))) > 3
    assert len(list((tmp_path / "t" / "feed=k1").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == rows


def test_statistics_are_one_aggregate(spark):
    df = spark.range(1000).select("id", F.lit("hot").alias("x"))
    plan = plan_of(tables.stats_row(df, ["x", "id"]))
    assert "Generate" not in plan and "Sort " not in plan and "Expand" not in plan
    # A hot value is one row per task before it is moved.
    exact = plan_of(statistics.exact_stats(df, ["x"]))
    moved = exact[exact.rindex("Exchange hashpartitioning") :]
    assert "Aggregate(key" in moved.replace("SortAggregate", "Aggregate").replace("HashAggregate", "Aggregate")


def test_staged_rows_are_loaded_without_another_shuffle(spark, tmp_path):
    layout = tables.Layout("crash_date")
    staged = cook_feeds(frames.crash_raw(spark, SMALL), CRASH_FEEDS)
    assert "Exchange" not in plan_of(layout.place(staged))
    tables.replace_by_date(staged, str(tmp_path / "t"), layout, clustered=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == staged.count()
