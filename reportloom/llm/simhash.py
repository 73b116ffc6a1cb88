"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.llm.common import map_batches, settle, text_key
from reportloom.llm.components import components

SHINGLE = 4
MOST_BITS = 4
SEED = 42
# Fingerprints that share a segment key up to here are compared pair by pair; the
# members of fuller keys are linked through whole-fingerprint balls instead.
PAIRWISE = 48


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits of a text, each the majority of that bit over its shingles' XXH64.

    Words lie between ASCII white space, A-Z in lower case; fewer words than a
    shingle are one shingle, no word at all gives 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    raw = b"".join([digest(joined[a:b], SEED) for a, b in spans])
    count = len(words) - shingle + 1
    totals = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        part = np.frombuffer(raw, np.uint8)[at * 8 : (at + (1 << 16)) * 8]
        totals += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(totals * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Columns ``doc``, ``text`` (128 bits that stand for the text) and ``bits`` (signed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(3)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(made.view(np.int64))], ["doc", "a", "b", "bits"]
            )

    key = text_key(F.col(text_col))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc"), key["a"].alias("a"), key["b"].alias("b"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.transform(map_batches, run, "doc long, a long, b long, bits long")


def _halves(prints: DataFrame) -> DataFrame:
    """Table of segment keys: for both halves of 32 bits the half and all that differ from
    it in one bit; the second half's keys have bit 32 set."""
    flips = prints.select("bits", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("i"))
    half = f"IF(i < 33, {_LOW.format('bits')}, {_HIGH.format('bits')} | shiftleft(1L, 32))"
    return flips.select("bits", F.expr(f"{half} ^ IF(i % 33 = 32, 0L, shiftleft(1L, i % 33))").alias("key"))


_LOW = "({} & 4294967295L)"
_HIGH = "shiftrightunsigned({}, 32)"


def _linked_pairs(most_bits: int) -> str:
    """SQL for the pairs of the list ``held`` under one ``key`` that link: complete
    distances verified, and each pair only under the least key where its halves meet."""
    of_key = f"IF(key < shiftleft(1L, 32), {_LOW}, {_HIGH})"
    differ, half = of_key.format("(u ^ v)", "(u ^ v)"), of_key.format("u", "u")
    # Halves that differ in bits a < b meet at u ^ a and u ^ b; in one bit, at u and v.
    least = f"least({half} ^ ({differ} & -{differ}), {half} ^ {differ} ^ ({differ} & -{differ}))"
    linked = f"u < v AND bit_count(u ^ v) <= {most_bits} AND (key & 4294967295L) = {least}"
    return f"flatten(transform(held, u -> transform(filter(held, v -> {linked}), v -> named_struct('u', u, 'v', v))))"


def links(prints: DataFrame, most_bits: int = MOST_BITS, pairwise: int = PAIRWISE) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints (column ``bits``) that connect all those
    at ``most_bits`` (2 or 4) or fewer differing bits: two that link are linked here,
    directly or through others that link.

    Of two halves of 32 bits one differs in at most two places. Both fingerprints
    enumerate the small ball of one bit around each half, so they meet in a key of
    the table; complete distances are then verified.

    A key held by more than ``pairwise`` fingerprints would give too many pairs. Its
    members enumerate the ball of half of ``most_bits`` around the whole fingerprint
    instead: any two that share a point of these balls link, and any two that link
    share one. Tying each point's members to the least of them loses and adds
    nothing, at a cost linear in the members; a point has no more members than its
    ball has points.
    """
    if most_bits not in (2, 4):
        raise ValueError("most_bits must be 2 or 4")
    keys = _halves(prints)
    held = settle(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "segment-keys"
    )
    # The same plan at every size: fingerprints by their key are as many rows anyway.
    matched = keys.join(held.hint("merge"), "key")
    few = (
        matched.where(F.col("n") <= pairwise)
        .groupBy("key").agg(F.collect_list("bits").alias("held"))
        .select(F.explode(F.expr(_linked_pairs(most_bits))).alias("pair"))
        .select("pair.u", "pair.v").distinct()
    )
    crowd = settle(matched.where(F.col("n") > pairwise).select("bits").distinct(), "crowd")
    # Dealt out evenly, for every member becomes as many rows.
    dealt = crowd.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    points = dealt.select("bits", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
    if most_bits == 4:
        points = points.select("bits", "i", F.explode(F.expr("sequence(least(i + 1, 64), 64)")).alias("j"))
    else:
        points = points.withColumn("j", F.lit(64))
    flip = "IF({0} = 64, 0L, shiftleft(1L, {0}))"
    points = points.select("bits", F.expr(f"bits ^ {flip.format('i')} ^ {flip.format('j')}").alias("point"))
    stars = points.withColumn("v", F.min("bits").over(Window.partitionBy("point")))
    return few.unionByName(stars.where("bits != v").select(F.col("bits").alias("u"), "v").distinct()).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, most_bits: int = MOST_BITS, pairwise: int = PAIRWISE,
) -> DataFrame:
    """Columns ``doc``, ``a``, ``b`` (the text's key), ``bits`` and ``root``, one row per
    row of ``docs``; ``root`` is the least (document, text key) of the component.

    Equal fingerprints are one node, so copies are never compared. Null and blank
    texts have fingerprint 0 and link like any other; a null id comes after all
    others; repeated rows stay; an empty table gives no rows; other columns,
    whatever their names, are not looked at.
    """
    rows = settle(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    name = F.struct(F.isnull("doc").alias("void"), "doc", "a", "b")
    nodes = settle(rows.groupBy("bits").agg(F.min(name).alias("name")), "fingerprint-nodes")
    pairs = settle(links(nodes.select("bits"), most_bits, pairwise), "fingerprint-links")
    named = nodes.select(F.col("bits").alias("u"), F.col("name"))
    # Components run on small numbers; the least name of each is found afterwards.
    joined = components(pairs).select(F.col("node").alias("bits"), F.col("root"))
    grouped = nodes.join(joined, "bits", "left").select(
        "bits", "name", F.coalesce("root", "bits").alias("group")
    )
    first = grouped.groupBy("group").agg(F.min("name").alias("root"))
    roots = settle(grouped.join(first, "group").select("bits", "root"), "fingerprint-roots")
    return rows.join(roots, "bits")


def hex_digits(bits: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, most_bits: int = MOST_BITS,
) -> DataFrame:
    """``docs``, all columns, with one row of every component: that of the smallest id
    (for equal ids the smallest text key; of repeated rows one stays)."""
    found = near_duplicates(docs, id_col, text_col, shingle, most_bits)
    stay = found.select("root.doc", "root.a", "root.b").distinct()
    key = text_key(F.col(text_col))
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("doc"), key["a"].alias("a"), key["b"].alias("b"),
    )
    same = [marked[c].eqNullSafe(stay[c]) for c in ("doc", "a", "b")]
    kept = marked.join(stay, same[0] & same[1] & same[2], "left_semi")
    return kept.dropDuplicates(["doc", "a", "b"]).select("row.*")
