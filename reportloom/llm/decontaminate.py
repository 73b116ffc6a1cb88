"""Benchmark decontamination with one Aho-Corasick automaton."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import map_batches, settle

WINDOW = 10
# Benchmark text that one automaton holds, some 150 MB of it for a megabyte; larger
# benchmarks are scanned in blocks.
BLOCK_BYTES = 2 * 1024 * 1024
# Words are two symbols each, so that no node has more branches than this.
_FAN = 1024

# Words are runs of ASCII letters, digits and all bytes of other characters.
_WORD = np.array([chr(b).isalnum() or b >= 128 for b in range(128)] + [True] * 128)
_FOLD = bytes(
    (b + 32 if 65 <= b <= 90 else b) if _WORD[b] else 32 for b in range(256)
)


def normalise(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return (text or "").encode().translate(_FOLD).split()


def windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    """Runs of ``size`` words; fewer words are one window, none give none."""
    words = normalise(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


class _Automaton:
    """The Aho-Corasick automaton over all windows of ``texts``, whose symbols are words.

    A word of the benchmark is two characters, one of each of two alphabets, so words
    match whole; all others are a character that no window has. The tree is far
    smaller than one over the letters of the windows, which overlap.
    """

    def __init__(self, texts: tuple[str, ...], size: int) -> None:
        self.codes: dict[bytes, str] = {}
        found: dict[str, list[int]] = {}
        for index, text in enumerate(texts):
            for window in windows(text, size):
                coded = "".join(self._code(w) for w in window.split(b" "))
                found.setdefault(coded, []).append(index)
        self.tree = ahocorasick.Automaton()
        for coded, owners in found.items():
            self.tree.add_word(coded, (len(coded) // 2, tuple(owners)))
        self.tree.make_automaton()

    def _code(self, word: bytes) -> str:
        number = len(self.codes)
        if number >= _FAN * _FAN:
            raise ValueError("a block of the benchmark has too many words")
        return self.codes.setdefault(word, chr(1 + number // _FAN) + chr(1 + _FAN + number % _FAN))

    def matches(self, words: list[bytes]) -> list[tuple[int, tuple[int, tuple[int, ...]]]]:
        """(number of the last word, (words, texts)) of each window found."""
        other = chr(2 + 2 * _FAN) * 2
        text = "".join([self.codes.get(w, other) for w in words])
        return [(at // 2, match) for at, match in self.tree.iter(text)]


@lru_cache(maxsize=2)
def _automaton(texts: tuple[str, ...], size: int) -> _Automaton | None:
    """The automaton of ``texts``, None if they have no words."""
    return _Automaton(texts, size) if any(map(normalise, texts)) else None


def scan(text: str | None, automaton: _Automaton | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, runs of words hit (first, behind the last; apart and in
    order) and the texts found, in one pass over the normalised text."""
    words = normalise(text)
    owners: set[int] = set()
    if not words or automaton is None:
        return len(words), [], owners
    reach: dict[int, int] = {}
    for word, (length, found) in automaton.matches(words):
        owners.update(found)
        first = word - length + 1
        reach[first] = max(reach.get(first, 0), word + 1)
    runs: list[tuple[int, int]] = []
    for first, behind in sorted(reach.items()):
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], behind))
        else:
            runs.append((first, behind))
    return len(words), runs, owners


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as offsets (code points) in the original text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    word = np.concatenate(([False], _WORD[raw], [False]))
    starts = np.flatnonzero(word[1:-1] & ~word[:-2])
    behind = np.flatnonzero(word[1:-1] & ~word[2:]) + 1
    # Code points before each byte: all bytes but those that continue a character.
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(points[starts[a]]), int(points[behind[b - 1]])) for a, b in runs]


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[int, Iterator[list]]:
    """The benchmark as (id, text) pairs, in parts of about ``block_bytes``: how many, and
    the parts, of which the driver holds one at a time."""
    items = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    if count > 1:
        items = settle(items, "benchmark")
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    parts = (
        sorted(map(tuple, items.where(block == n).collect()), key=lambda x: (x[0] or "", x[1]))
        for n in range(count)
    )
    return count, parts


def _scanned(docs: DataFrame, id_col: str, text_col: str, pairs: list, size: int, carry: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(tuple(text for _, text in shared.value), size)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column(1):
                text = text.as_py()
                words, runs, owners = scan(text, automaton)
                ids = {shared.value[i][0] for i in owners} - {None}
                spans = original_spans(text, runs) if runs and carry else []
                for column, value in zip(
                    out,
                    (words, [{"first": a, "behind": b} for a, b in runs], sorted(ids),
                     [{"start": a, "stop": b} for a, b in spans]),
                    strict=True,
                ):
                    column.append(value)
            kinds = [
                pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())])),
                pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, k) for v, k in zip(out, kinds, strict=True)]],
                ["doc", "n_words", "runs", "items", "spans"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    ).transform(
        map_batches, run,
        "doc long, n_words long, runs array<struct<first: long, behind: long>>, "
        "items array<string>, spans array<struct<start: long, stop: long>>",
    )


def benchmark_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, spans: bool = True,
) -> DataFrame:
    """Columns ``doc``, ``n_words``, ``n_hit``, ``items`` (sorted ids) and ``spans`` (hit
    passages as offsets into the original text, apart and in order; empty if
    ``spans`` is false), one row per row of ``docs``.

    The benchmark goes to the executors only up to ``block_bytes``; a larger one is
    scanned in blocks, whose runs are united per row. Null or wordless texts have no
    hits and null or wordless items none either; an item without id marks words but
    is not listed; repeated items count once, repeated documents each have a row; an
    empty benchmark finds nothing; other columns are not looked at.
    """
    count, blocks = _blocks(items, item_id, item_text, block_bytes)
    if count == 1:
        found = _scanned(docs, id_col, text_col, next(blocks), size, spans)
    else:
        rows = settle(
            docs.select(
                F.monotonically_increasing_id().alias("__row"), F.col(id_col).cast("long").alias("__doc"),
                F.col(text_col).cast("string").alias("__text"),
            ),
            "decontaminate",
        )
        parts = None
        for pairs in blocks:
            part = _scanned(rows, "__row", "__text", pairs, size, spans)
            parts = part if parts is None else parts.unionByName(part)
        # Runs of different blocks may overlap; they are united in order of their start.
        flat = parts.groupBy("doc").agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        )
        flat = flat.select(
            F.col("doc").alias("__row"), "n_words", "items",
            _united("runs", "first", "behind").alias("runs"), _united("spans", "start", "stop").alias("spans"),
        )
        found = flat.join(rows.select("__row", F.col("__doc").alias("doc")), "__row")
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["behind"] - r["first"])
    return found.select("doc", "n_words", hit.alias("n_hit"), "items", "spans")


def _united(column: str, start: str, stop: str):
    """Overlapping or touching pieces of a sorted list as one."""
    empty = F.array().cast(f"array<struct<{start}: bigint, {stop}: bigint>>")

    def add(done, piece):
        last = F.element_at(done, -1)
        grown = F.struct(last[start].alias(start), F.greatest(last[stop], piece[stop]).alias(stop))
        return F.when(
            (F.size(done) > 0) & (piece[start] <= F.try_element_at(done, F.lit(-1))[stop]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown)),
        ).otherwise(F.concat(done, F.array(piece)))

    return F.aggregate(column, empty, add)


def digest(items: list[str]) -> str:
    """SHA-256 of the sorted ids, joined by commas."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def without_benchmark(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text",
    size: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs``, all columns, without the rows that hold a window of the benchmark.

    Rows are left as they are, so null and blank texts stay. Blocks of a large
    benchmark are scanned one after the other, each on what the last one kept.
    """
    for pairs in _blocks(items, item_text, item_text, block_bytes)[1]:
        shared = docs.sparkSession.sparkContext.broadcast(pairs)
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(tuple(text for _, text in shared.value), size)
            for batch in batches:
                clean = [not scan(t.as_py(), automaton)[1] for t in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.transform(map_batches, run, docs.schema)
    return docs
