"""Removal of lines that many documents share, over levelled sorted runs of line hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm.common import SPACE_CHARACTERS, map_batches, settle

LEAST_CHARACTERS = 40
LEAST_DOCUMENTS = 5
FANOUT = 4
# More than are merged at once, so that there are levels.
BATCHES = 6


def line_hash(line: str, least: int = LEAST_CHARACTERS) -> bytes | None:
    """128 bits of a line's key (no white space at its ends, A-Z in lower case); none
    if the key has fewer than ``least`` code points."""
    key = line.strip(SPACE_CHARACTERS)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= least else None


def line_hashes(docs: DataFrame, least: int = LEAST_CHARACTERS) -> DataFrame:
    """Columns ``doc`` and ``h``: every long line of ``docs`` (columns ``doc`` and ``text``),
    once per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list[int] = []
            hashes: list[bytes] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = {line_hash(line, least) for line in (text.as_py() or "").split("\n")} - {None}
                ids.extend([doc] * len(found))
                hashes.extend(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.binary())], ["doc", "h"]
            )

    return docs.select("doc", "text").transform(map_batches, run, "doc long, h binary")


@dataclass
class LineRuns:
    """Line hashes seen so far: per level a few sorted runs of (h, docs, last).

    ``docs`` counts documents, ``last`` is the greatest id; a document belongs to one
    batch. ``add`` merges a batch with the runs: the hashes that no run has become a
    run of level 0, those that one has are kept apart, in ``again``, as what the batch
    adds to them. So a hash lies in one run only. ``fanout`` runs of one level are
    merged into one of the next, so each hash is rewritten once per level only.
    Runs are Parquet tables in the shared folder, sorted by hash within each file.
    """

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[DataFrame]] = field(default_factory=list)
    again: list[DataFrame] = field(default_factory=list)

    def add(self, lines: DataFrame) -> None:
        """Add a batch: ``lines`` has ``doc`` and ``h``, each pair once."""
        batch = lines.groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))
        if not (runs := self._runs()):
            self._put(0, self._sorted(batch))
            return
        held = self._union(runs).select("h", F.lit(True).alias("held"))
        # Both sides have a hash once. One pass tells the new hashes from the others.
        told = self._sorted(batch.join(held.hint("merge"), "h", "left"))
        self._put(0, told.where(F.col("held").isNull()).drop("held"))
        self.again.append(told.where("held").drop("held"))

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _sorted(self, run: DataFrame) -> DataFrame:
        return settle(run.sortWithinPartitions("h"), "line-run")

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._sorted(self._merge(self.levels[level]))
            self.levels[level] = []
            self._put(level + 1, merged)

    @staticmethod
    def _union(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows

    @classmethod
    def _merge(cls, runs: list[DataFrame]) -> DataFrame:
        return cls._union(runs).groupBy("h").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def seen(self, least: int = 1) -> DataFrame:
        """Hashes (h, docs, last) that at least ``least`` documents hold."""
        runs = [*self._runs(), *self.again]
        rows = runs[0] if len(runs) == 1 else self._merge(runs)
        return rows.where(F.col("docs") >= least)

    def fresh(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` whose hash no run has yet: a merge anti-join with each."""
        for run in self._runs():
            lines = lines.join(run.select("h"), "h", "left_anti")
        return lines

    def repeated(self, lines: DataFrame, least: int) -> DataFrame:
        """The rows of ``lines`` that go: the hash is in ``least`` documents or more, and
        this document is not the last of them."""
        often = settle(self.seen(least), "line-repeats").select("h", "last")
        return lines.join(often, "h").where(F.col("doc") != F.col("last")).drop("last")


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_characters: int = LEAST_CHARACTERS, least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES, fanout: int = FANOUT,
) -> DataFrame:
    """Columns ``doc``, ``n_lines``, ``n_dropped`` and ``kept`` (the lines that stay, joined),
    one row per row of ``docs``.

    Lines whose key has ``least_characters`` code points or more and is found in
    ``least_documents`` or more documents go, except in the document of the greatest
    id that holds it. Rows of one id are one document; rows without id together are
    one document that comes before all others. Repeats within a document count once. Null and
    empty texts are one empty line. An empty table gives no rows; other columns are
    not looked at.
    """
    least_id = F.lit(-(1 << 63))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), least_id).alias("doc"),
        F.col(text_col).cast("string").alias("text"),
    )
    found = settle(line_hashes(rows, least_characters).distinct(), "lines")
    runs = LineRuns(docs.sparkSession, fanout)
    for n in range(batches):
        runs.add(found.where(F.pmod(F.xxhash64("doc"), F.lit(batches)) == n))
    gone = runs.repeated(found, least_documents)
    gone = settle(gone.groupBy("doc").agg(F.collect_list("h").alias("gone")), "lines-gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text, hashes in zip(batch.column(1), batch.column(2), strict=True):
                lines = (text.as_py() or "").split("\n")
                dropped = set(hashes.as_py() or ())
                stay = [x for x in lines if line_hash(x, least_characters) not in dropped] if dropped else lines
                for column, value in zip(out, (len(lines), len(lines) - len(stay), "\n".join(stay)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                ["doc", "n_lines", "n_dropped", "kept"],
            )

    # The same plan at every size: the texts are moved once.
    done = rows.join(gone.hint("merge"), "doc", "left").select("doc", "text", "gone")
    done = done.transform(map_batches, run, "doc long, n_lines long, n_dropped long, kept string")
    return done.withColumn("doc", F.when(F.col("doc") != least_id, F.col("doc")))
