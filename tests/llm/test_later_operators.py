"""Periodic runs, nearest vectors and spelling groups against brute force and on odd rows."""

import random
from collections import Counter

import numpy as np
import pytest
from llm.conftest import prose
from pyspark.sql import functions as F

from reportloom.llm import nearest, periodic_runs, spelling


def brute_runs(w, least_length, exponent):
    found = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_length, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize(("least_length", "exponent"), [(6, 4), (2, 2), (4, 2), (6, 3), (9, 3)])
def test_runs_equal_brute_force(least_length, exponent):
    rnd = random.Random(least_length * 10 + exponent)
    for _ in range(1500):
        w = [rnd.randrange(rnd.randint(1, 4)) for _ in range(rnd.randint(0, 60))]
        if w and rnd.random() < 0.6:
            a, p = rnd.randrange(len(w)), rnd.randint(1, 8)
            w[a:] = [w[a + (i - a) % p] if a + (i - a) % p < len(w) else 0 for i in range(a, len(w))]
            if rnd.random() < 0.5:
                w[rnd.randrange(len(w))] = 9
        assert periodic_runs.runs_of(np.array(w, np.int64), least_length, exponent) == brute_runs(w, least_length, exponent)


def test_runs_of_long_texts_take_linear_room():
    assert periodic_runs.runs_of(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    line = [i for k in range(3_000) for i in (1000 + k, *range(20))]
    assert periodic_runs.runs_of(np.array(line)) == []


def test_strongest_is_exact():
    assert periodic_runs.strongest([]) is None
    assert periodic_runs.strongest([(0, 8, 2), (9, 6, 1), (20, 12, 2)]) == (9, 6, 1)
    assert periodic_runs.strongest([(0, 3 * 10**17 + 1, 10**17), (5, 3 * 10**17, 10**17)])[0] == 0


def test_runs_of_odd_rows(odd, empty):
    rows = periodic_runs.periodic_runs(odd).collect()
    assert Counter(r["doc"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    for r in rows:
        assert r["strongest"] is None and r["runs"] == []
        assert (r["n_words"] == 0) == (r["collapsed"] == "")
    assert periodic_runs.periodic_runs(empty).count() == 0


def test_collapsed_text_drops_all_but_the_first_period(frame):
    text = "x " + "la le " * 5 + "end " + "no " * 7
    row = periodic_runs.periodic_runs(frame([(1, text, None, None), (2, "ha ha ha", "", "")])).orderBy("doc").collect()
    assert row[0]["collapsed"] == "x la le end no"
    assert [tuple(r) for r in row[0]["runs"]] == [(1, 10, 2), (12, 7, 1)]
    assert tuple(row[0]["strongest"]) == (12, 7, 1)
    assert row[1]["collapsed"] == "ha ha ha"


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts):
    form, near = {}, {}
    for w, n in counts.items():
        around = [(-counts[v], v) for v in counts if is_near(w, v)]
        near[w] = len(around)
        form[w] = min(around)[1] if around and -min(around)[0] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, near[w], counts.get(form[w])))
    return Counter(out)


def test_spelling_groups_equal_brute_force(spark):
    rnd = random.Random(8)
    counts = {}
    for _ in range(900):
        counts["".join(rnd.choice("aabé") for _ in range(rnd.randint(0, 7)))] = rnd.choice([1, 2, 3, 4, 8, 16, 40])
    # Beyond 16 bits, ties, a hot stem, letters repeated in a row.
    counts |= {"x\U0001f600yzz": 5, "x\U0001f601yzz": 11, "xyzz": 30, "tie": 1, "tia": 9, "tib": 9, "aaaaaaaa": 2}
    counts |= {f"stem{chr(0x4E00 + i)}": 1 + i for i in range(80)}
    rows = [(w, n, "x", 1) for w, n in counts.items()]
    frame = spark.createDataFrame(rows, "word string, n long, root string, id long").repartition(3)
    assert Counter(tuple(r) for r in spelling.spelling_groups(frame).collect()) == brute_groups(counts)


def test_chains_of_forms_are_followed_to_the_end(spark):
    words = ["abcdefgh" + "x" * i for i in range(12)]
    frame = spark.createDataFrame([(w, 2**i) for i, w in enumerate(words)], "word string, n long")
    rows = {r["word"]: r for r in spelling.spelling_groups(frame).collect()}
    assert {r["root"] for r in rows.values()} == {words[-1]}
    assert rows[words[0]]["form"] == words[1] and rows[words[-1]]["form"] is None


def test_spelling_of_odd_rows(spark, odd, empty):
    schema = "word string, n long"
    rows = spelling.spelling_groups(spark.createDataFrame([("", None), (None, 4), ("a", 1), ("a", 2), ("b", 0)], schema))
    assert {(r["word"], r["form"], r["n"], r["n_near"]) for r in rows.collect()} == {
        ("", "a", 0, 2), ("a", None, 3, 2), ("b", "a", 0, 2)
    }
    assert spelling.spelling_groups(spark.createDataFrame([], schema)).count() == 0
    text = odd.select(F.explode(F.split("text", " ")).alias("word"))
    counted = {r["word"]: r["n"] for r in spelling.count_words(text).collect()}
    want = Counter(w for r in odd.collect() if r["text"] for w in r["text"].split(" ") if len(w) >= 5)
    assert counted == {w: n for w, n in want.items() if n >= 3}
    assert spelling.count_words(empty.select(F.col("text").alias("word"))).count() == 0


def searched(df):
    out = {}
    for r in nearest.nearest(df, F.col("vec_id") % 20 == 0).collect():
        out.setdefault(r["query"], []).append((r["rank"], r["id"], r["score"]))
    return {q: [x[1:] for x in sorted(found, key=lambda x: x[0])] for q, found in out.items()}


def test_nearest_of_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, -0.0]), (80, [1.0, None]), (100, [float("nan"), 1.0]),
        (120, [float("inf"), 1.0]), (None, [1.0, 2.0]), (140, [1.0, 2.0, 0.0]), (140, [1.0, 2.0, 0.0]), (3, [1.0, 2.0]),
        (160, [-1.0, 0.5, 3.0]), (7, [5e3, 1.0]), (9, [1e-6, 1e-6]),
    ]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<double>, score string, node int, band int")
    found = searched(frame.repartition(2))
    assert set(found) == {0, 140, 160}
    assert [i for i, _ in found[0]] == [7, 3, 140, 140, None, 9, 160]
    assert found[0][1] == (3, 5.0) and found[0][0] == (7, 5002.0)
    assert len(found[140]) == 2 * 7 and len(found[160]) == 7
    assert searched(frame.where("vec_id < 0")) == {}
    assert searched(frame.where("vec_id = 0")) == {}


def test_many_copies_of_a_vector_are_found_by_id(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.5, 0.25, 0.0]) for i in range(1000, 1300)]
    rows += [(i, [float(x) for x in rng.normal(size=4) * 0.1]) for i in range(500)]
    found = searched(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    for query in (1000, 1020, 1280):
        assert [i for i, _ in found[query]] == [i for i in range(1000, 1022) if i != query][:20]
    assert len(found) == 15 + 25


def test_blocks_and_ties(spark, monkeypatch):
    """Orthogonal vectors tie all over; blocks and parts of small bounds give the same rows."""
    rows = [(i, [float(j == i % 8) for j in range(8)]) for i in range(240)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = searched(frame)
    assert [i for i, _ in whole[20]][:29] == [i for i in range(4, 240, 8) if i != 20][:20]
    rng = np.random.default_rng(2)
    q, r = rng.integers(0, 2, (2, 30, 5)).astype(float)
    first = nearest._best(q, r, 7)
    monkeypatch.setattr(nearest, "_PAIRS", 3)
    again = nearest._best(q, r, 7)
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
    for i in range(30):
        want = sorted(range(30), key=lambda j: (-(q[i] * r[j]).sum(), j))[:7]
        assert first[1][first[0] == i].tolist() == want


def test_hash_tables_and_probes():
    hash_ = nearest.Hash(8, 2, 4, tables=2)
    vectors = np.random.default_rng(3).normal(size=(50, 7))
    for table in range(2):
        probes = hash_.probes(vectors, table, hash_.buckets)
        # The first probe is the vector's own bucket, and every bucket comes once.
        assert (probes[:, 0] == hash_.bucket(vectors, table)).all()
        assert (np.sort(probes, axis=1) == np.arange(hash_.buckets)).all()
        assert (hash_.probes(vectors, table, 9) == probes[:, :9]).all()
    turned = nearest.hadamard(np.eye(8))
    assert np.allclose(turned @ turned.T, np.eye(8))


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_on_the_tables(spark, sf):
    df = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    found = searched(df)
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for query, near in found.items():
        scores = vectors @ vectors[ids == query][0]
        scores[ids == query] = -np.inf
        true = ids[np.lexsort((ids, -scores))[:20]]
        hits += len(set(true.tolist()) & {i for i, _ in near})
        assert np.allclose([s for _, s in near], [scores[ids == i][0] for i, _ in near], atol=1e-12, rtol=0)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
    assert hits >= 0.9 * 20 * len(found)


def test_larger_buckets_where_probes_do_not_reach(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BUCKET_ROWS", 1)
    monkeypatch.setattr(nearest, "MOST_PROBES", 8)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(400)]
    found = searched(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    vectors = np.array([v for _, v in rows])
    hits = 0
    for query, near in found.items():
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {i for i, _ in near})
    assert hits >= 0.9 * 20 * len(found)


def test_prose_has_no_runs():
    words = prose(1, 5_000).split()
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    assert periodic_runs.runs_of(np.array([number[w] for w in words])) == []
