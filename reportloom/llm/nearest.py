"""Nearest vectors by cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportloom.llm.common import even_number, map_batches, settle

NEIGHBOURS = 20
TABLES = 4
# Rows that a bucket is to hold on average.
BUCKET_ROWS = 512
# Vectors of queries that the number of probes is fitted on, and the share of their
# true neighbours that it must find.
SAMPLE = 200
WANTED_RECALL = 0.96
# Most probes of one table; where more were needed, buckets become larger instead.
MOST_PROBES = 256
# A bucket's rows and queries are dealt to tasks in blocks of about this many.
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 2_048
# Norms within one band differ by less than this factor.
BAND = 2.0**0.25

_ROUNDS = 3
# Combinations of axes, and pairs of vectors, that a task looks at together.
_TOGETHER = 1 << 21
_PAIRS = 200_000
_FOUND = "query: bigint, node: bigint, first: bigint, score: double"
# Found pairs that a task holds before it keeps only the best of each query.
_HELD = 200_000


@dataclass(frozen=True)
class Hash:
    """Cross-polytope hash functions: ``tables`` of them, each a product of pseudo-rotations.

    Of the last rotation ``last`` coordinates count, of the others all ``width``.
    """

    width: int
    rotations: int
    last: int
    tables: int = TABLES
    seed: int = 42

    @property
    def buckets(self) -> int:
        return (2 * self.width) ** (self.rotations - 1) * 2 * self.last

    def turned(self, vectors: np.ndarray, table: int, rotation: int) -> np.ndarray:
        """Unit vectors after one pseudo-rotation: thrice random signs and a Hadamard transform."""
        signs = np.random.default_rng((self.seed, table, rotation)).choice([-1.0, 1.0], (_ROUNDS, self.width))
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        out = np.zeros((len(vectors), self.width))
        out[:, : vectors.shape[1]] = vectors / np.where(norms > 0, norms, 1.0)
        for sign in signs:
            out = hadamard(out * sign)
        return out if rotation < self.rotations - 1 else out[:, : self.last]

    def bucket(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each vector: in each rotation the nearest signed axis."""
        number = np.zeros(len(vectors), np.int64)
        for rotation in range(self.rotations):
            turned = self.turned(vectors, table, rotation)
            axis = np.abs(turned).argmax(axis=1)
            below = turned[np.arange(len(turned)), axis] < 0
            number = number * (2 * turned.shape[1]) + 2 * axis + below
        return number

    def probes(self, vectors: np.ndarray, table: int, count: int) -> np.ndarray:
        """The ``count`` buckets of the table that most likely hold near vectors, best first.

        A bucket is the worse the further the coordinates of its axes lie below the
        largest ones, in squares summed over the rotations.
        """
        together = max(1, _TOGETHER // (2 * self.width * count))
        if len(vectors) > together:
            parts = [self.probes(vectors[a : a + together], table, count) for a in range(0, len(vectors), together)]
            return np.concatenate(parts)
        rows = np.arange(len(vectors))[:, None]
        number = np.zeros((len(vectors), 1), np.int64)
        loss = np.zeros((len(vectors), 1))
        for rotation in range(self.rotations):
            turned = self.turned(vectors, table, rotation)
            signed = np.stack((turned, -turned), axis=2).reshape(len(turned), -1)
            axes = np.argsort(-signed, axis=1, kind="stable")[:, :count]
            values = signed[rows, axes]
            lost = (values[:, :1] - values) ** 2
            # The best of all combinations are among those of the best so far.
            both = (loss[:, :, None] + lost[:, None, :]).reshape(len(vectors), -1)
            names = (number[:, :, None] * signed.shape[1] + axes[:, None, :]).reshape(len(vectors), -1)
            order = np.argsort(both, axis=1, kind="stable")[:, :count]
            loss, number = both[rows, order], names[rows, order]
        return number


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; their length is a power of two."""
    count, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(count, width // (2 * half), 2, half)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        half *= 2
    return rows.reshape(count, width) / np.sqrt(width)


def _hash_for(width: int, rows: int) -> Hash:
    """Hash functions with about one bucket for every ``BUCKET_ROWS`` rows."""
    wanted = max(1.0, rows / BUCKET_ROWS)
    rotations = 1
    while (2 * width) ** rotations < wanted:
        rotations += 1
    last = 1
    while last < width and (2 * width) ** (rotations - 1) * 2 * last < wanted:
        last *= 2
    return Hash(width, rotations, last)


def _coarser(hash_: Hash) -> Hash | None:
    """The same with half the buckets; None where there is one axis left."""
    if hash_.last > 1:
        return Hash(hash_.width, hash_.rotations, hash_.last // 2)
    if hash_.rotations > 1:
        return Hash(hash_.width, hash_.rotations - 1, hash_.width)
    return None


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a batch as rows of a matrix, short ones filled with zeros."""
    lengths = pc.list_value_length(column).to_numpy()
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _wide(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] == width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed the same way wherever the rows are."""
    return np.einsum("ij,ij->i", left, right)


def _best(queries: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (query, row) and products of at least the ``count`` nearest rows of each query.

    Rows of equal products come in the order given. A blocked product picks rows with
    a margin for its rounding; what is returned is computed pair by pair.
    """
    scores = queries @ rows.T
    if scores.shape[1] > count:
        least = np.partition(scores, scores.shape[1] - count, axis=1)[:, -count][:, None]
        kept = scores >= least - 1e-9 * np.abs(scores).max(axis=1, keepdims=True)
    else:
        kept = np.ones(scores.shape, bool)
    # Where products are equal, many rows are kept for now: a part of the queries at a time.
    part = np.cumsum(kept.sum(axis=1)) // _PAIRS
    found = []
    for at in np.unique(part):
        asked = np.flatnonzero(part == at)
        q, r = np.nonzero(kept[asked])
        q = asked[q]
        exact = _products(queries[q], rows[r])
        order = np.lexsort((r, -exact, q))
        order = order[_ranks(q[order]) < count]
        found.append((q[order], r[order], exact[order]))
    q, r, exact = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    return q, r, exact.astype(float)


def _ranks(groups: np.ndarray) -> np.ndarray:
    """The place of each entry within its group; equal entries are adjacent."""
    starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    return np.arange(len(groups)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(groups)]))))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, all components finite, not all zero."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def _nodes(rows: DataFrame, neighbours: int) -> DataFrame:
    """Distinct vectors, numbered, with their first rows.

    Of equal vectors only the ``neighbours`` + 1 rows of smallest id can be among
    anyone's nearest, the query's own row left out; Spark drops the rest before rows move.
    """
    first = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last(), "row")
    kept = rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= neighbours + 1)
    held = F.transform(
        F.array_sort(F.collect_list(F.struct("at", "id", "row"))), lambda x: F.struct(x["id"].alias("id"), x["row"].alias("row"))
    )
    grouped = kept.groupBy("vector").agg(held.alias("members"))
    # ``first`` orders nodes of equal products; a null id comes last.
    return grouped.select(
        F.monotonically_increasing_id().alias("node"), "vector", "members",
        F.coalesce(F.col("members")[0]["id"], F.lit(np.iinfo(np.int64).max)).alias("first"),
    )


def _band(vector: Column) -> Column:
    """The band of a vector's norm; scaled first, so that no square overflows."""
    most = F.array_max(F.transform(vector, lambda x: F.abs(x).cast("double")))

    def band(most: Column) -> Column:
        square = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (x / most) * (x / most))
        return F.floor((F.log(most) + F.log(square) / 2) / float(np.log(BAND)) + 0.5).cast("int")

    # An array of one, so that the largest component is found once and not for each.
    return F.transform(F.array(most), band)[0]


def _sample_truth(nodes: DataFrame, sample: np.ndarray, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes of each sampled vector, by comparison with all: numbers in
    ``sample``, and beside them the vectors found."""
    count = neighbours + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                column = batch.column("vector").slice(at, BLOCK_ROWS)
                q, r, score = _best(sample, _wide(_matrix(column), sample.shape[1]), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), column.take(pa.array(r)), pa.array(score)], ["query", "vector", "score"]
                )

    kind = nodes.schema["vector"].dataType.simpleString()
    near = map_batches(nodes.select("vector"), run, f"query long, vector {kind}, score double")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vector")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
    rows = near.collect()
    vectors = np.zeros((len(rows), sample.shape[1]))
    for i, r in enumerate(rows):
        vectors[i, : len(r["vector"])] = r["vector"]
    return np.array([r["query"] for r in rows], np.int64), vectors


def _found_after(hash_: Hash, sample: np.ndarray, owner: np.ndarray, near: np.ndarray, probes: int) -> np.ndarray:
    """For each true neighbour of the sample the least number of probes a table that finds it."""
    after = np.full(len(owner), np.iinfo(np.int64).max)
    for table in range(hash_.tables):
        hit = hash_.probes(sample, table, probes)[owner] == hash_.bucket(near, table)[:, None]
        after = np.where(hit.any(axis=1), np.minimum(after, hit.argmax(axis=1) + 1), after)
    return after


def fit(nodes: DataFrame, sample: np.ndarray, rows: int, neighbours: int = NEIGHBOURS) -> tuple[Hash, int]:
    """Hash functions and probes a table that find ``WANTED_RECALL`` of the sample's neighbours.

    Buckets start at ``BUCKET_ROWS`` rows. If ``MOST_PROBES`` of them are too few, they
    are made larger, in the end so large that two probes a table read all rows.
    """
    hash_ = _hash_for(sample.shape[1], rows)
    owner, near = _sample_truth(nodes, sample, neighbours)
    while True:
        most = min(MOST_PROBES, hash_.buckets)
        after = np.sort(_found_after(hash_, sample, owner, near, most))
        needed = int(after[max(0, int(np.ceil(WANTED_RECALL * len(after))) - 1)]) if len(after) else 1
        if needed <= most:
            return hash_, needed
        smaller = _coarser(hash_)
        if smaller is None:
            return hash_, hash_.buckets
        hash_ = smaller


def _addresses(nodes: DataFrame, hash_: Hash, probes: int, carried: list[str], bands: list[int]) -> DataFrame:
    """Columns ``band``, ``key`` (table and bucket in one number) and ``carried``: a row for
    each table, or with ``probes`` for each probed bucket of each table and every band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = _matrix(part.column("vector"))
                for table in range(hash_.tables):
                    if probes:
                        bucket = hash_.probes(vectors, table, probes)
                    else:
                        bucket = hash_.bucket(vectors, table)[:, None]
                    rows = pa.array(np.repeat(np.arange(part.num_rows), bucket.shape[1]))
                    key = pa.array(table * hash_.buckets + bucket.reshape(-1))
                    yield pa.RecordBatch.from_arrays(
                        [key, *[part.column(c).take(rows) for c in ("band", *carried)]], ["key", "band", *carried]
                    )

    needed = ["band", *dict.fromkeys([*carried, "vector"])]
    types = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    schema = ", ".join(["key long", *[f"{c} {types[c]}" for c in ("band", *carried)]])
    found = map_batches(nodes.select(*needed), run, schema)
    if probes:
        found = found.withColumn("band", F.explode(F.array(*[F.lit(b) for b in bands])))
    return found


def _blocks(nodes: DataFrame, marked: DataFrame, hash_: Hash, probes: int, bands: list[int]) -> DataFrame:
    """Rows and queries of one band and bucket side by side, in blocks of bounded size.

    A bucket of many rows is dealt to several blocks, each of which gets all its queries;
    many queries likewise. So no bucket is capped, and none is one task. Buckets are
    worked out twice, which costs less than to write vectors once for every table.
    """
    place = ["band", "key"]
    carried = ["node", "first", "vector"]
    sizes = _addresses(nodes, hash_, 0, [], bands).groupBy(*place).agg(F.count(F.lit(1)).alias("n_rows")).join(
        _addresses(marked, hash_, probes, [], bands).groupBy(*place).agg(F.count(F.lit(1)).alias("n_queries")), place
    )
    sizes = settle(
        sizes.select(
            *place,
            F.ceil(F.col("n_rows") / BLOCK_ROWS).cast("int").alias("row_parts"),
            F.ceil(F.col("n_queries") / BLOCK_QUERIES).cast("int").alias("query_parts"),
        ),
        "bucket-sizes",
    )
    own = F.pmod(F.xxhash64("node"), F.lit(1 << 31).cast("long"))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    rows = _addresses(nodes, hash_, 0, carried, bands).join(sizes, place).select(
        *place, (own % F.col("row_parts")).cast("int").alias("row_part"), every("query_parts").alias("query_part"),
        F.lit(False).alias("asks"), *carried,
    )
    queries = _addresses(marked, hash_, probes, carried, bands).join(sizes, place).select(
        *place, every("row_parts").alias("row_part"), (own % F.col("query_parts")).cast("int").alias("query_part"),
        F.lit(True).alias("asks"), *carried,
    )
    block = [*place, "row_part", "query_part"]
    return rows.unionByName(queries).repartition(*block).sortWithinPartitions(*block, "asks", "first", "node")


def _candidates(blocks: DataFrame, neighbours: int) -> DataFrame:
    """The nearest rows of every query within its blocks: columns query, node, first, score."""
    count = neighbours + 1
    names = ("band", "key", "row_part", "query_part")

    def compare(parts: list[pa.RecordBatch]) -> pa.Table | None:
        block = pa.Table.from_batches(parts).combine_chunks()
        asks = block.column("asks").to_numpy()
        if asks.all() or not asks.any():
            return None
        vectors = _matrix(pa.concat_arrays(block.column("vector").chunks))
        node, first = block.column("node").to_numpy(), block.column("first").to_numpy()
        q, r, score = _best(vectors[asks], vectors[~asks], count)
        return pa.table({"query": node[asks][q], "node": node[~asks][r], "first": first[~asks][r], "score": score})

    def fewer(found: list[pa.Table]) -> pa.Table:
        """Each pair once, and the best pairs of each query."""
        joined = pa.concat_tables(found)
        query, node, first, score = (joined.column(c).to_numpy() for c in ("query", "node", "first", "score"))
        order = np.lexsort((node, first, -score, query))
        query, node = query[order], node[order]
        fresh = np.concatenate(([True], (query[1:] != query[:-1]) | (node[1:] != node[:-1])))
        order, query = order[fresh], query[fresh]
        return joined.take(pa.array(order[_ranks(query) < count]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        found: list[pa.Table] = []
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if current is not None and current != tuple(keys[a]):
                    found.append(compare(held))
                    held = []
                    waiting += found[-1].num_rows if found[-1] is not None else 0
                current = tuple(keys[a])
                held.append(batch.slice(a, b - a))
            if waiting > _HELD:
                kept = fewer([f for f in found if f is not None])
                found, waiting = [kept], kept.num_rows
                if waiting > _HELD // 2:
                    yield from kept.to_batches()
                    found, waiting = [], 0
        if held:
            found.append(compare(held))
        rest = [f for f in found if f is not None and f.num_rows]
        if rest:
            yield from fewer(rest).to_batches()

    return map_batches(blocks, run, _FOUND)


def _sampled(nodes: DataFrame, width: int) -> np.ndarray:
    """At most ``SAMPLE`` vectors that are queries, chosen by number."""
    chosen = nodes.orderBy(even_number(F.col("first"))).select("vector").limit(SAMPLE)
    out = np.zeros((0, width))
    for r in chosen.collect():
        row = np.zeros((1, width))
        row[0, : len(r["vector"])] = r["vector"]
        out = np.concatenate((out, row))
    return out


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """Columns ``query``, ``rank`` (from 1), ``id`` and ``score``: the nearest rows found for
    each row that meets ``is_query``, all other rows being candidates.

    Nearness is the inner product in double precision of the vectors as they are; ties go
    to the smaller id. Rows whose vector is null, all zero or holds null or non-finite
    components take no part; a shorter vector counts as filled with zeros. Rows with one
    id, repeated ones too, are rows of their own: each asks and each is found. A row
    without id can be found, after those with one, and asks only if ``is_query`` says
    so. With fewer candidates all that are found come; an empty table gives no rows;
    other columns, whatever their names, are only seen by ``is_query``.

    Unit vectors are hashed to the nearest signed axis after pseudo-rotations, by norm in
    bands, so that in a band the nearest by angle are about those of the largest product.
    Every row is in ``TABLES`` tables. The probes of a table are fitted on ``SAMPLE``
    query vectors, compared with all rows; about ``WANTED_RECALL`` of the true neighbours
    are found. Equal vectors are one entry. Buckets of any size are compared whole, in
    blocks of bounded size.
    """
    spark: SparkSession = vectors.sparkSession
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(usable(F.col("vector")))
    # Minus zero is zero, and zeros at the end say nothing: one form for equal vectors.
    plain = F.transform("vector", lambda x: x + F.lit(0.0).cast(kind))
    last = F.array_max(F.transform("vector", lambda x, i: F.when(x != 0, i + 1)))
    rows = rows.select("id", "asks", F.slice(plain, F.lit(1), last).alias("vector"))
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    nodes = _nodes(rows, neighbours).withColumn("band", _band(F.col("vector")))
    nodes = settle(nodes, "vector-nodes")
    asking = rows.where("asks").select("id", "row", "vector")
    asked = settle(
        asking.join(nodes.select("node", "vector"), "vector").select("id", "row", "node"), "vector-queries"
    )
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query long, rank int, id long, score double")
    marked = settle(nodes.join(asked.select("node").distinct(), "node", "left_semi"), "vector-asking")
    width = 1 << max(0, int(size["width"]) - 1).bit_length()
    hash_, probes = fit(nodes, _sampled(marked, width), size["n"], neighbours)
    # All doubles together have a few thousand bands; each query asks in those there are.
    bands = sorted(r["band"] for r in nodes.select("band").distinct().collect())
    found = _candidates(_blocks(nodes, marked, hash_, probes, bands), neighbours)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "first", "node")
    near = found.groupBy("query", "node").agg(F.min("first").alias("first"), F.max("score").alias("score"))
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= neighbours + 1)
    members = near.join(nodes.select("node", "members"), "node").select(
        F.col("query").alias("node"), "score", F.explode("members").alias("member")
    )
    pairs = asked.join(members, "node").where(F.col("row") != F.col("member.row"))
    place = Window.partitionBy("row").orderBy(
        F.col("score").desc(), F.col("member.id").asc_nulls_last(), "member.row"
    )
    ranked = pairs.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= neighbours)
    return ranked.select(F.col("id").alias("query"), "rank", F.col("member.id").alias("id"), "score")
