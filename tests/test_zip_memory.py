"""Zips are packed line by line and read in place, whatever they hold."""

import csv
import datetime as dt
import io
import itertools
import tracemalloc
import zipfile

import pyarrow as pa
import pytest

from reportloom import frames
from reportloom.schemas import EARNINGS_COLUMNS
from reportloom.sources import archives

MB = 1024 * 1024


@pytest.fixture
def orders(spark, tmp_path):
    """2,000 orders of one account, month and key range, some twice; one without key, one of another month."""
    keys = [2 * (i % 1_900) for i in range(2_000)]
    rows = [(k, k % 7, "F", k / 4, dt.datetime(2021, 1, 1 + k % 28), "1-URGENT") for k in keys]
    rows += [(None, 1, "O", 2.0, dt.datetime(2021, 1, 5), "5-LOW"), (8, 1, "O", None, dt.datetime(2021, 2, 5), None)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def member_rows(content):
    with zipfile.ZipFile(io.BytesIO(content)) as held:
        (name,) = held.namelist()
        return name, list(csv.reader(io.StringIO(held.read(name).decode(), newline="")))


def test_an_archive_is_never_one_row_of_text(spark, orders):
    plan = frames.earnings_archives(spark, orders)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ArrowEvalPython" not in plan and "MapInArrow" in plan


@pytest.mark.parametrize("most", ["7", "10000"])
def test_archives_of_many_batches_are_whole(spark, orders, most):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    try:
        found = frames.earnings_archives(spark, orders).collect()
        one = frames.earnings_archives(spark, orders, "202102").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    path = "earnings/earnings_{}_77-0.zip"
    got = {r.path: member_rows(r.content) for r in found}
    assert len(found) == 3 and set(got) == {None, path.format(202101), path.format(202102)}
    assert got[path.format(202102)] == member_rows(one[0].content) and len(one) == 1
    name, rows = got[path.format(202101)]
    assert name == "PlayApps_202101.csv" and tuple(rows[0]) == EARNINGS_COLUMNS
    # In the order of the keys, repeated ones as often as they come.
    assert [r[0] for r in rows[1:]] == [f"GPA.{k}" for k in sorted(2 * (i % 1_900) for i in range(2_000))]
    assert rows[1][EARNINGS_COLUMNS.index("product_title")] == 'The "best", 1-URGENT'
    assert [r[0] for r in got[None][1][1:]] == [""]


def most_held(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_packing_holds_a_batch_of_lines(spark, orders):
    line = "x" * 1_000
    batch = pa.table({"month": ["202101"] * 1_000, "member": ["m.csv"] * 1_000, "line": [line] * 1_000}).to_batches()[0]
    made = []
    assert most_held(lambda: made.extend(frames._pack("h", itertools.repeat(batch, 40)))) < 10 * MB
    assert len(made) == 1
    assert member_rows(made[0].column("content")[0].as_py()) == ("m.csv", [["h"], *[[line]] * 40_000])


def test_a_given_zip_is_read_in_place():
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.csv", "h\n" + f"{'x' * 1_000}\n" * 20_000)
    batch = pa.RecordBatch.from_arrays([pa.array(["a.zip"]), pa.array([held.getvalue()], pa.binary())], ["path", "content"])
    del held
    expand = archives._from_contents(archives._Records("utf-8", "strict", [], None), ["path"])
    rows = []
    # The zip has 20 MB, a batch of records 4 MB.
    assert most_held(lambda: rows.extend(b.num_rows for b in expand(iter([batch])))) < 15 * MB
    assert sum(rows) == 20_001
