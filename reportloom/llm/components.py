"""Connected components of a graph given as pairs, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import settle

# A path of 2^40 nodes needs fewer rounds.
MOST_ROUNDS = 80


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """One star operation on pairs (u, v), u > v.

    Every node looks at its neighbours (small star: at smaller ones only) and ties
    them and itself to the least of them (large star: it ties the larger ones).
    """
    turned = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = pairs if small else pairs.unionByName(turned)
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    if small:
        tied = pairs.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return least.select("u", F.col("m").alias("v")).unionByName(tied).where("u > v").distinct()
    least = least.select("u", F.least("u", "m").alias("m"))
    tied = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.where("u > v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` for every node of ``pairs`` (columns ``u`` and ``v``,
    of one type that has an order); ``root`` is the least node that can be reached.

    Large and small stars take turns until nothing changes, some log(n) rounds for a
    path of n nodes. A node of many neighbours costs partial minima, no list. Pairs of
    a node with itself keep it in the result.
    """
    alone = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    now = settle(
        pairs.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "pairs",
    )
    mark = None
    for _ in range(MOST_ROUNDS):
        now = settle(_star(_star(now, small=False), small=True), "pairs")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return alone.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
