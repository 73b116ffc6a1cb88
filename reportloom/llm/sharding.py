"""Shards of even size that keep linked documents together: balanced label propagation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import even_number, running_sum, settle, text_key

SHARDS = 24
# Rounds end when so many in a row bring no more than this share of the linked rows
# to the fullest shard of their group.
PATIENCE = 2
LEAST_GAIN = 0.005
# Levelling ends when no shard is above the mean by more than this share, or when a pass
# takes less than a tenth of the largest surplus away.
EVEN = 0.0005
# Bytes that a row has besides its text.
ROW_BYTES = 8
# Share of a shard's mean bytes up to which a group moves as one.
TOGETHER = 0.1
# Moves may fill a shard to this share of the mean before the sizes are levelled.
FULL = 1.0


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``row`` (a number of its own), ``doc``, ``size``, ``text_crc32``, ``hub`` (equal
    texts have one) and ``u`` (a fixed number in (0, 1) from id and text)."""
    text = F.col(text_col).cast("string")
    key = text_key(text)
    return settle(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), key.alias("hub"),
            even_number(F.col(id_col), key["a"], F.lit("shard")).alias("u"),
        ),
        "shard-rows",
    )


def _loads(rows: DataFrame, shards: int) -> dict[int, int]:
    """Bytes per shard; one number per shard goes to the driver."""
    found = {r["shard"]: r["load"] for r in rows.groupBy("shard").agg(F.sum("size").alias("load")).collect()}
    return {s: found.get(s, 0) for s in range(shards)}


def _numbers(values: dict[int, float], column: str):
    """The value for the shard in ``column``: one literal per shard."""
    return F.element_at(F.array(*[F.lit(float(values[s])) for s in sorted(values)]), F.col(column) + 1)


def _chances(room: dict[int, float], flows: dict[tuple[int, int], int]) -> dict[int, float]:
    """Share of those who wish to enter each shard that it can take: its free room and
    what leaves it, which in turn depends on the shares of the other shards."""
    chance = dict.fromkeys(room, 1.0)
    wanted = dict.fromkeys(room, 0)
    for (_, aim), size in flows.items():
        wanted[aim] += size
    for _ in range(100):
        leaving = dict.fromkeys(room, 0.0)
        for (shard, aim), size in flows.items():
            leaving[shard] += size * chance[aim]
        chance = {s: min(1.0, (room[s] + leaving[s]) / wanted[s]) if wanted[s] else 0.0 for s in room}
    return chance


def propagate(rows: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (``row``, ``size``, ``u``, ``v``, ``shard``) with documents moved towards the shards
    of those they are linked to.

    ``links`` has ``row`` and ``hub``: rows of one hub are neighbours, so a group of any
    size costs one link per row. In a round each hub counts its rows per shard, and
    each row wishes to be where most of its neighbours are, full shards counting
    less. Of those who wish to enter a shard so many go, by a fixed number per group
    (``v``) and round, as its free room and what leaves it take in the mean.

    Rounds go on while they bring rows to the fullest shard of their group: the best
    state counts, and ends them when ``PATIENCE`` rounds have not bettered it by
    ``LEAST_GAIN`` of the links. As each that does betters it by as much, they end.
    """
    number = links.count()
    turn, waited, most, kept = 0, 0, -1, rows
    while number:
        loads = _loads(rows, shards)
        mean = max(1.0, sum(loads.values()) / shards)
        room = {s: max(0.0, FULL * mean - load) for s, load in loads.items()}
        linked = rows.join(links, "row")
        near = linked.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        worth = F.col("n") * (F.lit(0.1) + _numbers({s: min(1.0, r / mean) for s, r in room.items()}, "shard"))
        best = near.groupBy("hub").agg(
            F.max(F.struct(worth.alias("worth"), F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("best"),
            F.sum("n").alias("all"), F.max("n").alias("most"),
        )
        best = settle(
            best.where("all > 1").select("hub", F.col("best.shard").alias("aim"), F.col("best.worth").alias("worth"), "most"),
            "shard-hubs",
        )
        together = best.agg(F.sum("most")).first()[0] or 0
        waited = 0 if together >= most + max(1, LEAST_GAIN * number) else waited + 1
        if together > most:
            most, kept = together, rows
        if waited >= PATIENCE or together == number:
            break
        wishes = linked.join(best.drop("most"), "hub").groupBy("row").agg(F.max(F.struct("worth", "aim")).alias("w"))
        wishes = settle(
            rows.join(wishes.select("row", "w.aim"), "row").where("aim != shard").select("row", "size", "v", "shard", "aim"),
            "shard-wishes",
        )
        # At most one number per pair of shards goes to the driver.
        flows = wishes.groupBy("shard", "aim").agg(F.sum("size").alias("n")).collect()
        chance = _chances(room, {(r["shard"], r["aim"]): r["n"] for r in flows})
        if not any(chance.values()):
            break
        moves = wishes.where(_shuffled("v", turn) < _numbers(chance, "aim")).select("row", "aim")
        rows = settle(
            rows.join(moves, "row", "left").withColumn("shard", F.coalesce("aim", "shard")).drop("aim"), "shard-round"
        )
        turn += 1
    return kept


def _shuffled(column: str, turn: int):
    """Another number in (0, 1) for each one in ``column``."""
    return F.pmod(F.col(column) * (1 << 20) + turn * 0.6180339887, F.lit(1.0))


def level(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (``row``, ``size``, ``v``, ``loose``, ``shard``) with sizes made even.

    Shards above the mean give up rows that are no larger than their surplus, those
    without links first, those of a group together; the shards below are filled with
    them in turn. What is left
    uneven is due to the sizes of single rows and shrinks from one pass to the next.
    """
    least, turn = float("inf"), 0
    while True:
        loads = _loads(rows, shards)
        mean = sum(loads.values()) / shards
        over = {s: max(0.0, load - mean) for s, load in loads.items()}
        surplus = max(over.values(), default=0)
        if surplus <= max(ROW_BYTES, EVEN * mean) or surplus > 0.9 * least:
            break
        least = surplus
        # Unlinked rows come first; small rows in later passes, when little is left.
        eligible = rows.where(F.col("size") <= _numbers(over, "shard")).withColumn(
            "order", (_shuffled("v", turn) + F.when(F.col("loose"), 0).otherwise(1)) / 2
        )
        given = running_sum(eligible, ["shard"], ["order", "row"], "order", "size", "before")
        given = settle(
            given.where(F.col("before") + F.col("size") <= _numbers(over, "shard")).select("row", "size", "order", F.lit(0).alias("all")),
            "shard-given",
        )
        laid = running_sum(given, ["all"], ["order", "row"], "order", "size", "at")
        # Gaps of the shards below the mean, laid one behind the other, largest first.
        gaps = sorted(((mean - load, s) for s, load in loads.items() if load < mean), reverse=True)
        moved = given.agg(F.sum("size")).first()[0] or 0
        if not moved:
            break
        scale = moved / sum(g for g, _ in gaps)
        aim, start = F.lit(gaps[0][1]), 0.0
        middle = F.col("at") + F.col("size") / 2
        for gap, s in gaps:
            aim = F.when(middle >= start, F.lit(s)).otherwise(aim)
            start += gap * min(1.0, scale)
        rows = settle(
            rows.join(laid.select("row", aim.alias("aim")), "row", "left")
            .withColumn("shard", F.coalesce("aim", "shard")).drop("aim"),
            "shard-level",
        )
        turn += 1
    return rows


def _free_names(columns: Sequence[str], taken: Sequence[str]) -> list[str]:
    """``columns`` with ``given_`` before those that are called like one of ``taken``, in any case."""
    present = {c.lower() for c in columns}
    names = []
    for column in columns:
        name = column
        while name.lower() in taken or (name != column and name.lower() in present):
            name = f"given_{name}"
        names.append(name)
    return names


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, carry: bool = False,
) -> DataFrame:
    """Columns ``doc``, ``size``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (from 0, without
    gaps in each shard), one row per row of ``docs``; with ``carry`` the columns of
    ``docs`` instead of ``doc``, and the four others.

    Equal texts are linked. Documents start in a shard by a fixed number from id and
    text; label propagation brings linked ones together, levelling evens the bytes.
    A group of up to ``TOGETHER`` of a shard's bytes moves as one, a larger one, which may
    need several shards, row by row. Null and empty texts count as a row
    without text and are two groups; repeated rows are rows of their own; an empty
    table gives no rows. With ``carry``, columns of ``docs`` that are called
    like the four others get ``given_`` before their names, as often as it takes.
    """
    if carry:
        numbered = settle(docs.select(
            F.monotonically_increasing_id().alias("__row"), *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(docs.columns)]
        ), "shard-docs")
        found = shard_documents(
            numbered.select("__row", F.col(f"__c{docs.columns.index(text_col)}").alias("text")), "__row", "text",
            shards,
        )
        own = ("size", "text_crc32", "shard", "slot")
        names = _free_names(docs.columns, own)
        return numbered.join(found.withColumnRenamed("doc", "__row").hint("merge"), "__row").select(
            *[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)], *own
        )
    rows = sized(docs, id_col, text_col)
    groups = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).where("n > 1")
    # Small groups move as one; of large ones, which may need several shards, each row.
    fits = TOGETHER * (rows.agg(F.sum("size")).first()[0] or 0) / shards
    together = F.when(F.col("bytes") <= fits, even_number(F.col("hub.a"), F.col("hub.b")))
    links = settle(rows.join(groups, "hub").select("row", "hub", together.alias("v")), "shard-links")
    start = rows.join(links.select("row", "v", F.lit(False).alias("loose")), "row", "left").select(
        "row", "size", "u", F.coalesce("v", "u").alias("v"), F.coalesce("loose", F.lit(True)).alias("loose"),
        F.floor(F.col("u") * shards).cast("int").alias("shard"),
    )
    placed = propagate(settle(start, "shard-start"), links.select("row", "hub"), shards)
    even = level(placed, shards)
    ones = even.select("row", _shuffled("u", 0).alias("x"), "shard", F.lit(1).cast("long").alias("one"))
    slots = running_sum(ones, ["shard"], ["x", "row"], "x", "one", "slot").select("row", "shard", "slot")
    return rows.join(slots, "row").select("doc", "size", "text_crc32", "shard", "slot")
