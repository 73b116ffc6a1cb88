"""Sharding against the same rules in plain Python, and what its rounds and sizes come to."""

from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from reportloom.llm import sharding

from .conftest import prose

SHARDS = 5


def _graph():
    """Rows (row, size, u, v, shard) and links: pairs, groups, one large hub, rows in two hubs."""
    rows, links = [], []
    for i in range(120):
        u = (i * 0.381966 + 0.05) % 1
        hub = i // 3 if i < 60 else 100 if i < 90 else None
        v = (hub * 0.754877) % 1 if hub is not None and hub < 20 else u
        rows.append((i, 10 + i * 7 % 23, u, v, int(u * SHARDS)))
        if hub is not None:
            links.append((i, hub))
    # Some rows are linked to another group too.
    links += [(i, (i // 3 + 1) % 20) for i in range(0, 60, 9)]
    return rows, links


def _propagated(rows, links, ties):
    """The rounds of ``propagate`` with dicts."""
    size, v = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    shard, turn, waited, most = {r[0]: r[4] for r in rows}, 0, 0, -1
    kept = dict(shard)
    while True:
        loads = [sum(size[r] for r in size if shard[r] == s) for s in range(SHARDS)]
        mean = sum(loads) / SHARDS
        room = {s: max(0.0, mean - loads[s]) for s in range(SHARDS)}
        held = defaultdict(Counter)
        for row, hub in links:
            held[hub][shard[row]] += 1
        held = {hub: c for hub, c in held.items() if sum(c.values()) > 1}
        together = sum(max(c.values()) for c in held.values())
        waited = 0 if together >= most + max(1, sharding.LEAST_GAIN * len(links)) else waited + 1
        if together > most:
            most, kept = together, dict(shard)
        if waited >= sharding.PATIENCE or together == len(links):
            return kept
        aims = {
            hub: max((n * (0.1 + min(1.0, room[s] / mean)), ties[hub, s], s) for s, n in c.items()) for hub, c in held.items()
        }
        wish = {}
        for row, hub in links:
            if hub in aims:
                wish[row] = max(wish.get(row, (-1, -1)), (aims[hub][0], aims[hub][2]))
        flows = Counter()
        for row, (_, aim) in wish.items():
            if aim != shard[row]:
                flows[shard[row], aim] += size[row]
        chance = sharding._chances(room, flows)
        for row, (_, aim) in wish.items():
            if (v[row] * (1 << 20) + turn * 0.6180339887) % 1.0 < chance[aim]:
                shard[row] = aim
        turn += 1


def _cut(shard, links):
    rows = defaultdict(list)
    for row, hub in links:
        rows[hub].append(row)
    return sum(shard[a] != shard[b] for own in rows.values() for a, b in combinations(own, 2))


def test_rounds_are_those_of_plain_python_and_cut_fewer_links(spark):
    rows, links = _graph()
    frame = spark.createDataFrame(rows, "row long, size long, u double, v double, shard int")
    linked = spark.createDataFrame(links, "row long, hub long")
    pairs = spark.range(101).crossJoin(spark.range(SHARDS).select(F.col("id").cast("int").alias("s")))
    ties = {(r["id"], r["s"]): r["t"] for r in pairs.select("id", "s", F.xxhash64("id", "s").alias("t")).collect()}
    found = {r["row"]: r["shard"] for r in sharding.propagate(frame, linked, SHARDS).collect()}
    assert found == _propagated(rows, links, ties)
    start = {r[0]: r[4] for r in rows}
    # The hub of 30 rows is larger than a shard, which bounds what can be gained there.
    small = [link for link in links if link[1] < 20]
    assert _cut(found, small) < 0.5 * _cut(start, small)
    assert _cut(found, links) < 0.75 * _cut(start, links)
    assert all(found[r[0]] == r[4] for r in rows if r[0] >= 90)


def test_groups_of_copies_lie_together_within_even_shards(frame):
    rows = [(i, prose(i % 300, 20 + i % 50), None, None) for i in range(900)]
    # One text of many bytes: three copies of it are more than a tenth of a shard.
    rows += [(900 + i, "a large text " * 900, None, None) for i in range(3)]
    found = sharding.shard_documents(frame(rows), shards=6).collect()
    loads, homes = Counter(), defaultdict(Counter)
    for r in found:
        loads[r["shard"]] += r["size"]
        homes[r["text_crc32"]][r["shard"]] += 1
    cut = sum(a * b for c in homes.values() for a, b in combinations(c.values(), 2))
    # By chance five sixths of some 900 pairs are cut.
    assert cut < 90
    mean = sum(loads.values()) / 6
    assert max(abs(x - mean) for x in loads.values()) < 0.01 * mean


@pytest.mark.parametrize("shards", [1, 3])
def test_columns_that_are_called_like_the_results_are_kept(spark, shards):
    docs = spark.createDataFrame([(1, "a", "x", "y", 5), (2, "b", "z", "w", 6)], "doc_id long, text string, Size string, given_size string, slot long")
    found = sharding.shard_documents(docs, shards=shards, carry=True)
    assert found.columns == [
        "doc_id", "text", "given_given_Size", "given_size", "given_slot", "size", "text_crc32", "shard", "slot"
    ]
    assert sorted((r["doc_id"], r["given_given_Size"], r["given_size"], r["given_slot"]) for r in found.collect()) == [
        (1, "x", "y", 5), (2, "z", "w", 6)
    ]


def test_no_rows_have_no_shards(empty):
    assert sharding.shard_documents(empty).collect() == []
