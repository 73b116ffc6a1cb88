"""The registered queries on the small tables, and the pipeline against its stages."""

import re
from collections import Counter
from html import unescape

import pytest

import corpus_pipeline
from compare import connect, duck_rows, spark_rows
from reportloom.llm import decontaminate, queries, simhash
from reportloom.llm.common import table

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_its_sql(spark, con, name):
    assert spark_rows(queries.QUERIES[name](spark, DIR)) == duck_rows(con, queries.CHECKS[name])


def test_every_operator_is_registered(spark):
    import __spark_entry__ as entry

    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_joins_and_native_where_promised(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name in ("op2_license_scan", "op3_quality_rules", "op5_mixing", "op7_sharding"):
        assert "Python" not in plan and "Arrow" not in plan


def test_near_duplicates_of_the_tables(spark):
    rows = queries.op4_simhash(spark, DIR).collect()
    prints = {}
    for r in rows:
        bits = int(r["fingerprint"], 16)
        prints[bits] = min(prints.get(bits, r["doc_id"]), r["doc_id"])
    root = dict(prints)
    changed = True
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    while changed:
        changed = False
        for a, b in near:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    assert all(root[int(r["fingerprint"], 16)] == r["component_id"] for r in rows)


def test_shards_of_the_tables(spark):
    rows = queries.op7_sharding(spark, DIR).collect()
    assert len(rows) == table(spark, DIR, "documents").count() and {r["law"] for r in rows} == {"bytes"}
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    largest = sorted((r["size"] for r in rows), reverse=True)
    assert len(loads) == 24 and max(loads.values()) - min(loads.values()) <= largest[0]


def test_held_out_quality(spark):
    labels = table(spark, DIR, "labels").withColumnRenamed("doc_id", "id")
    found = queries.op8_quality(spark, DIR)
    rows = found.join(labels, found["doc_id"] == labels["id"]).where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95


def test_held_out_languages(spark):
    found = queries.op9_language_id(spark, DIR)
    docs = table(spark, DIR, "documents").selectExpr("doc_id as id", "lang")
    rows = found.join(docs, found["doc_id"] == docs["id"]).where("held_out and lang is not null").collect()
    assert len(rows) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.98


def test_articles_of_the_pages(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, DIR, "pages").collect()}
    for r in queries.op10_html_extraction(spark, DIR).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)[1]
        blocks = (re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inner))
        blocks = (re.sub(r"\s+", " ", unescape(b)).strip() for b in blocks)
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_the_pipeline_and_its_stages(spark):
    docs = table(spark, DIR, "documents")
    kept = corpus_pipeline.quality(spark, docs, DIR)
    scored = queries.op8_quality(spark, DIR)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    single = corpus_pipeline.near_duplicates(spark, kept, DIR)
    groups = Counter(r["root"]["doc"] for r in simhash.near_duplicates(kept).collect())
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(groups)
    clean = corpus_pipeline.decontamination(spark, single, DIR)
    hits = decontaminate.benchmark_hits(single, table(spark, DIR, "benchmark")).where("n_hit = 0")
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r["doc"] for r in hits.collect())
    for stage in (kept, single, clean):
        assert stage.columns == docs.columns
    done = corpus_pipeline.run(spark, DIR).collect()
    mixed = corpus_pipeline.mix(spark, clean, DIR)
    assert Counter(r["doc_id"] for r in done) == Counter(r["doc_id"] for r in mixed.collect())
    assert all(r["size"] == len((r["text"] or "").encode()) + 8 for r in done)
    places = Counter((r["shard"], r["slot"]) for r in done)
    assert max(places.values()) == 1
