"""The corpus operators against plain versions, on rows with every oddity."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from compare import duck_rows, spark_rows
from reportloom.llm import (
    components,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    mixing,
    quality_model,
    quality_rules,
    queries,
    sharding,
    simhash,
)
from reportloom.llm.common import even_number, even_spread, running_sum

from .conftest import LONG_LINE, digest, odd_rows, prose

ITEMS = [
    (1, " ".join(prose(6, 80).split()[5:30])), (2, "One!"), (3, None), (4, " ?! "), (None, prose(7, 40)),
    (5, prose(99, 12)), (5, " ".join(prose(8, 40).split()[:10])), (1, " ".join(prose(6, 80).split()[5:30])),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="module")
def con(odd, items):
    con = duckdb.connect()
    tables = {"documents": odd.toPandas(), "benchmark": items.toPandas()}
    for name, rows in tables.items():
        for column in ("doc_id", "item_id"):
            if column in rows:
                rows[column] = rows[column].astype("Int64")
        con.register(f"{name}_rows", rows)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    return con


def _same(df, con, sql):
    assert spark_rows(df) == duck_rows(con, sql)


def _use(monkeypatch, odd, items=None):
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: {"documents": odd, "benchmark": items}[name])


@pytest.mark.parametrize("number", [1, 2, 3, 5, 6])
def test_query_and_sql_agree_on_odd_rows(spark, odd, items, con, monkeypatch, number):
    _use(monkeypatch, odd, items)
    name = next(n for n in queries.QUERIES if n.startswith(f"op{number}_"))
    _same(queries.QUERIES[name](spark, ""), con, queries.CHECKS[name])


@pytest.mark.parametrize("number", [1, 2, 3, 4, 5, 6, 7, 8, 9])
def test_empty_documents_give_no_rows(spark, empty, items, monkeypatch, number):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(
        queries, "table", lambda s, d, name: {"documents": empty, "benchmark": items, "labels": labels}[name]
    )
    name = next(n for n in queries.QUERIES if n.startswith(f"op{number}_"))
    assert queries.QUERIES[name](spark, "").count() == 0


# Decontamination


def test_spans_point_into_the_original(odd, items):
    texts = defaultdict(list)
    for row in odd_rows():
        texts[row[0]].append(row[1])
    found = decontaminate.benchmark_hits(odd, items).collect()
    assert len(found) == odd.count()
    cut = [text[s["start"] : s["stop"]] for r in found for text in texts[r["doc"]] if text for s in r["spans"] if r["doc"] in (6, 10)]
    assert " ".join(prose(6, 80).split()[5:30]).rstrip(".") in {c.rstrip(".") for c in cut}
    assert "one" in cut


def test_blocks_of_a_large_benchmark_give_the_same(odd, items):
    whole = spark_rows(decontaminate.benchmark_hits(odd, items))
    assert spark_rows(decontaminate.benchmark_hits(odd, items, block_bytes=60)) == whole


def test_an_empty_benchmark_finds_nothing(spark, odd, items):
    none = decontaminate.benchmark_hits(odd, items.limit(0))
    assert none.where("n_hit > 0").count() == 0 and none.count() == odd.count()
    assert decontaminate.without_benchmark(odd, items.limit(0)).count() == odd.count()


def test_an_automaton_of_a_block_is_small():
    rnd = random.Random(2)
    known = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(5_000)]
    texts = tuple(" ".join(rnd.choice(known) for _ in range(400)) for _ in range(100))
    made = decontaminate._automaton(texts, 10)
    stats = made.tree.get_stats()
    # Bytes of the tree for a byte of text.
    assert stats["total_size"] < 200 * sum(map(len, texts))
    words, runs, owners = decontaminate.scan("un known " + texts[7] + " wo", made)
    assert (words, runs, owners) == (403, [(2, 402)], {7})
    assert decontaminate.scan(" ".join(reversed(texts[7].split())), made)[1] == []


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_contaminated_rows_go_whole(odd, items, block_bytes):
    kept = decontaminate.without_benchmark(odd, items, block_bytes=block_bytes)
    assert kept.columns == odd.columns
    hit = Counter(r["doc"] for r in decontaminate.benchmark_hits(odd, items).where("n_hit > 0").collect())
    every = Counter(r["doc_id"] for r in odd.collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == every - hit


# Licences


def test_best_template_of_similar_ones(spark, frame):
    docs = frame([
        (1, "Text before.\nThis work is licensed under the GNU General Public License, version 2.\nAfter.", None, None),
        (2, "licensed UNDER CC-BY-NC 4.0", None, None),
        (3, "Licensed under nothing at all, it is only prose.", None, None),
        (4, licenses.TEMPLATES["mit-permission"].replace(" to ", "\nto ") + "\n\n" + licenses.TEMPLATES["mit-warranty"], None, None),
    ])
    found = {r["doc"]: r["licenses"] for r in licenses.license_scan(docs, licenses.template_frame(spark)).collect()}
    assert found == {1: "gpl-2.0", 2: "cc-by-nc-4.0", 3: "", 4: "mit-permission,mit-warranty"}


def test_a_library_that_is_too_large_is_refused(spark, odd):
    large = spark.createDataFrame([("x", "word other " * 15_000)], "template_id string, text string")
    with pytest.raises(ValueError, match="template words"):
        licenses.license_scan(odd, large)
    assert licenses.license_scan(odd, large.limit(0)).where("n_compared > 0").count() == 0


# Quality rules


@pytest.mark.parametrize("line, bad", [
    ("A clean line of prose, as it should be.", False), ("", False), ("  \t ", False),
    ("Home", True), ("one | two | three | four | five", True), ("SHOUTING ALL THE TIME, REALLY.", True),
    ("Word!! word!! word!!", True), ("a### b$$$ c%%%", True), ("We use it: this site uses cookies.", True),
    ("x " * 40, True), ("NASA and ESA met.", False),
])
def test_line_rules(spark, line, bad):
    assert spark.range(1).select(quality_rules.bad_line(F.lit(line)).alias("b")).first()["b"] is bad


def test_text_loses_its_bad_lines(frame):
    row = quality_rules.judge(frame([(1, f"{prose(1, 30)}\nHome\n\n{prose(2, 30)}", None, None)])).first()
    assert row["cleaned"] == f"{prose(1, 30)}\n\n{prose(2, 30)}" and row["kept"] and row["lost_chars"] == 4


# SimHash


def _fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(numbers, near):
    root = list(range(len(numbers)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(numbers):
            for j, b in enumerate(numbers):
                if near(a, b) and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def test_fingerprints_by_their_definition():
    for _, text, *_ in odd_rows():
        assert simhash.fingerprint(text if text is None else text[:4000]) == _fingerprint(text if text is None else text[:4000])


@pytest.mark.parametrize("pairwise", [1, 48])
@pytest.mark.parametrize("most_bits", [2, 4])
def test_links_connect_what_brute_force_connects(spark, pairwise, most_bits):
    rnd = np.random.default_rng(5)
    numbers = {0, (1 << 64) - 1}
    for _ in range(12):
        at = int(rnd.integers(0, 1 << 63))
        for _ in range(12):
            for bit in rnd.integers(0, 64, int(rnd.integers(0, 4))):
                at ^= 1 << int(bit)
            numbers.add(at)
    numbers = sorted(n - (1 << 64) if n >> 63 else n for n in numbers)
    pairs = simhash.links(spark.createDataFrame([(n,) for n in numbers], "bits long"), most_bits, pairwise)
    found = {r["node"]: r["root"] for r in components.components(pairs).collect()}
    root = _roots(numbers, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= most_bits)
    assert [found.get(n, n) for n in numbers] == [numbers[r] for r in root]


def test_near_duplicate_components(odd):
    rows = odd_rows()
    found = Counter((r["doc"], r["bits"] & (1 << 64) - 1, r["root"]["doc"]) for r in simhash.near_duplicates(odd).collect())
    prints = [_fingerprint(text) if text is None or len(text) < 5000 else simhash.fingerprint(text) for _, text, *_ in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    root = _roots([prints[i] for i in order], lambda a, b: (a ^ b).bit_count() <= 4)
    assert found == Counter((rows[i][0], prints[i], rows[order[root[k]]][0]) for k, i in enumerate(order))


def test_one_row_of_each_component_stays(odd):
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    roots = {(r["root"]["doc"], r["root"]["a"], r["root"]["b"]) for r in simhash.near_duplicates(odd).collect()}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in roots)


def test_components_of_a_long_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(300)}, 5000: 5000}


# Mixing


def test_running_sum_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr("reportloom.llm.common.ROWS_BETWEEN_MARKS", 10)
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("g"), (F.pmod(F.hash("id"), F.lit(1000)) / 1000).alias("x"), F.lit(2).alias("w"))
    got = {r["id"]: r["s"] for r in running_sum(rows, ["g"], ["x", "id"], "x", "w", "s").collect()}
    ordered = sorted(rows.collect(), key=lambda r: (r["x"], r["id"]))
    seen = Counter()
    for r in ordered:
        assert got[r["id"]] == seen[r["g"]]
        seen[r["g"]] += 2


def test_targets_fill_up_to_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 0, None: 50}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    weight = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    want, left, free = {}, float(sum(sizes.values())), set(sizes)
    while True:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
        free -= over
    assert got == pytest.approx(want)


@pytest.mark.parametrize("quality", ["1.0", "0.1", "IF(id % 3 = 0, 0.1, 0.9)", "0.1 + 0.9 * (id % 97) / 97"])
def test_stretches_are_even_whatever_the_quality(spark, quality):
    rows = spark.range(60_000).selectExpr("id", "IF(id % 3 = 0, null, 'hot') AS source", f"{quality} AS quality")
    keyed = rows.withColumn("key", -F.log(even_number(F.lit("s"), F.col("id"))) / F.col("quality"))
    spread = even_spread(keyed, "source", "key", "spread")
    counts = spread.groupBy("source", F.least(F.floor(F.col("spread") * 40), F.lit(39)).alias("cut")).count().collect()
    for r in counts:
        mean = (20_000 if r["source"] is None else 40_000) / 40
        assert 0.6 * mean < r["count"] < 1.5 * mean
    assert len(counts) == 80
    ordered = [r["spread"] for r in spread.where("source is null").orderBy("key").collect()]
    assert ordered == sorted(ordered) and 0 <= ordered[0] and ordered[-1] <= 1


def test_equal_values_and_lone_rows_spread(spark):
    rows = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 2.0), (None, 0.5), (None, 0.7)], "g string, x double")
    assert all(0 <= r["s"] <= 1 for r in even_spread(rows, "g", "x", "s").collect())


def test_mixed_rows_come_as_often_as_taken(odd):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    want = Counter()
    for r in mixing.mix(odd).collect():
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        want[r["doc"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == want
    assert spark_rows(mixed) == spark_rows(mixing.mixed_documents(odd.repartition(7)))


# Line dedup


def test_runs_are_compacted_and_tell_fresh_lines(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for batch in range(5):
        runs.add(spark.createDataFrame([(batch, b"same"), (batch, b"own%d" % batch)], "doc long, h binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(bytes(r["h"]), r["docs"], r["last"]) for r in runs.seen(2).collect()} == {(b"same", 5, 4)}
    # The line of all batches became part of the first run only; later ones add to it.
    held = Counter(bytes(r["h"]) for level in runs.levels for run in level for r in run.collect())
    assert held == Counter([b"same", *(b"own%d" % batch for batch in range(5))])
    assert [(bytes(r["h"]), r["docs"], r["last"]) for rows in runs.again for r in rows.collect()] == [
        (b"same", 1, batch) for batch in range(1, 5)
    ]
    lines = spark.createDataFrame([(9, b"own3"), (9, b"new")], "doc long, h binary")
    assert [bytes(r["h"]) for r in runs.fresh(lines).collect()] == [b"new"]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 4), (9, 2), (line_dedup.BATCHES, line_dedup.FANOUT)])
def test_line_dedup_equals_brute_force_in_any_batches(frame, batches, fanout):
    lines = [f"{i} {prose(i, 12)}" for i in range(30)] + ["short line", "", "\t" + "x" * 39]
    rows = [
        (None if n % 17 == 0 else n % 60, "\n".join(lines[(n * k * k + 3 * k) % len(lines)] for k in range(n % 9)), None, None)
        for n in range(90)
    ] + [(None, lines[1], None, None), (70, None, None, None)]
    texts = [(-(1 << 63) if doc is None else doc, (text or "").split("\n")) for doc, text, *_ in rows]
    holders = defaultdict(set)
    for doc, own in texts:
        for line in own:
            if len(line.strip()) >= 40:
                holders[line.strip()].add(doc)
    last = {line: max(docs) for line, docs in holders.items() if len(docs) >= 5}
    expected = Counter()
    for doc, own in texts:
        stay = [x for x in own if last.get(x.strip(), doc) == doc]
        expected[None if doc < 0 else doc, len(own), len(own) - len(stay), "\n".join(stay)] += 1
    found = line_dedup.drop_shared_lines(frame(rows), batches=batches, fanout=fanout).collect()
    assert Counter((r["doc"], r["n_lines"], r["n_dropped"], r["kept"]) for r in found) == expected
    assert any(r["n_dropped"] for r in found if r["doc"] is None)


def test_line_dedup_of_rows_without_id_agrees_with_its_sql(frame):
    shared = [f"{i} {prose(i, 14)}" for i in range(3)]
    rows = [(d, f"{shared[0]}\nown {d}", None, None) for d in (1, 2, 3, 4, None, None)]
    rows += [(d, f"{shared[1]}\n{shared[2]}", None, None) for d in (5, 6, 7, None)]
    documents = frame(rows)
    own = duckdb.connect()
    own.register("documents", documents.toArrow())
    expected = Counter(own.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({queries.OP6_SQL})").fetchall())
    found = line_dedup.drop_shared_lines(documents).collect()
    assert Counter((r["doc"], r["n_lines"], r["n_dropped"], digest(r["kept"])) for r in found) == expected
    assert sum(r["n_dropped"] for r in found) == 5


def test_shared_line_stays_in_the_last_document(odd):
    rows = {r["doc"]: r for r in line_dedup.drop_shared_lines(odd).where("doc between 11 and 39").collect()}
    assert all(r["n_dropped"] == (1 if d < 39 else 0) for d, r in rows.items())
    assert LONG_LINE.upper() in rows[39]["kept"] and LONG_LINE.upper() not in rows[38]["kept"]
    assert digest(rows[38]["kept"]) == digest(f"{prose(38, 50)}\n{prose(138, 20)}\n")


# Sharding


def test_every_row_has_one_place(odd):
    rows = sharding.shard_documents(odd, shards=4).collect()
    assert len(rows) == odd.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) and 0 <= shard < 4 for shard, s in slots.items())
    carried = sharding.shard_documents(odd, shards=4, carry=True)
    assert Counter(r["doc_id"] for r in carried.collect()) == Counter(r["doc"] for r in rows)


def test_shards_are_even_and_keep_copies_together(frame):
    rows = [(i, prose(i % 300, 20 + i % 50), None, None) for i in range(900)]
    found = sharding.shard_documents(frame(rows), shards=6).collect()
    loads, homes, sizes = Counter(), defaultdict(set), []
    for r in found:
        loads[r["shard"]] += r["size"]
        homes[r["doc"] % 300].add(r["shard"])
        sizes.append(r["size"])
    assert max(loads.values()) - min(loads.values()) <= 2 * max(sizes)
    # By chance a group of three lies in 2.5 of 6 shards.
    assert sum(map(len, homes.values())) < 1.8 * len(homes)


def test_one_large_group_is_split_evenly(frame):
    found = sharding.shard_documents(frame([(i, "the same text", None, None) for i in range(400)]), shards=8).collect()
    counts = Counter(r["shard"] for r in found)
    assert len(counts) == 8 and max(counts.values()) - min(counts.values()) <= 2


# Quality classifier


def test_classifier_learns_tables_and_pairs():
    rnd = np.random.default_rng(1)
    values = rnd.random((4000, len(quality_model.FEATURES)))
    # Only the two features together tell the label.
    labels = ((values[:, 2] > 0.5) ^ (values[:, 5] > 0.5)).astype(float)
    model = quality_model.fit(values[:3000], labels[:3000])
    assert (2, 5) in model.pairs
    assert ((model.score(values[3000:]) > 0.5) == labels[3000:]).mean() > 0.9


def test_classifier_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)] + [(None, 1), (3, None), (4, 0)], "doc_id long, quality int")
    model = quality_model.learn(odd, labels, sample=30)
    scores = [r["score"] for r in quality_model.score(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    kept = quality_model.accepted(odd, model, 0.5)
    assert kept.columns == odd.columns and kept.count() == sum(s >= 0.5 for s in scores)


def test_classifier_without_labels(spark, odd):
    model = quality_model.learn(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality_model.score(odd, model).collect()} == {0.5}


# Language models


def test_probabilities_of_a_context_sum_to_one():
    texts = {"x": "abab abc abd", "y": "bcd bce éa"}
    counts = {k: np.unique(language_id.ngrams(language_id.symbols(t)), return_counts=True) for k, t in texts.items()}
    model = language_id.Model(counts)
    every = np.unique(np.concatenate([k & np.uint64(0xFFFF) for k, _ in counts.values()]))
    for context in ("  a", "bab", "zzz"):
        base = np.uint64(0)
        for c in context:
            base = (base << np.uint64(16)) | np.uint64(ord(c))
        total = np.exp(-model.costs_of((base << np.uint64(16)) | every)).sum(axis=0)
        assert np.all(total <= 1 + 1e-6) and np.all(total >= 1 - 1.01 * model.uniform)


def test_language_by_hand_for_a_tiny_model():
    # One text, "aa": of the order-1 continuations a follows two symbols, the blank one.
    counts = {"x": np.unique(language_id.ngrams(language_id.symbols("aa")), return_counts=True)}
    level = language_id.Model(counts).levels[0][0]
    assert level.grams.tolist() == [0x20, ord("a")]
    assert math.isclose(level.shares.sum() + level.weights[0], 1.0)
