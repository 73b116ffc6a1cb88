"""Quality classifier: an additive model of lookup tables with pairwise interactions."""

from __future__ import annotations

import itertools
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import map_batches

# Labelled rows at most that a model is fitted on, chosen by a hash of their id.
SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.15
# Added to the curvature of each leaf.
SMOOTHING = 1.0
THRESHOLD = 0.3

FEATURES = (
    "words", "word_length", "capitals", "symbols", "exclamations", "digits", "marks", "other", "distinct_words",
    "echoes", "top_word", "repeated_lines", "ended_lines", "line_words", "distinct_triples",
)
_LOWER, _UPPER, _DIGIT, _SPACE, _SYMBOL, _EXCLAMATION, _MARK, _OTHER = range(8)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        if category in ("Lu", "Lt"):
            kinds[point] = _UPPER
        elif category[0] in "LM":
            kinds[point] = _LOWER
        elif category[0] == "N":
            kinds[point] = _DIGIT
        elif category[0] == "P":
            kinds[point] = _MARK
    for character in " \t\n\x0b\x0c\r":
        kinds[ord(character)] = _SPACE
    for character in "#*$%&|<>":
        kinds[ord(character)] = _SYMBOL
    kinds[ord("!")] = _EXCLAMATION
    return kinds


def features(text: str | None) -> list[float]:
    """Numbers that describe a text; all 0 for a null or blank one."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(_kinds()[points], minlength=8).tolist()
    solid = max(1, len(points) - counts[_SPACE])
    letters = max(1, counts[_LOWER] + counts[_UPPER])
    number = len(words)
    bag = Counter(words)
    lines = [line for line in map(str.strip, text.split("\n")) if line]
    triples = max(1, number - 2)
    return [
        float(np.log1p(number)),
        solid / number,
        counts[_UPPER] / letters,
        counts[_SYMBOL] / solid,
        counts[_EXCLAMATION] / solid,
        counts[_DIGIT] / solid,
        counts[_MARK] / number,
        counts[_OTHER] / solid,
        len(bag) / number,
        sum(map(eq, words, words[1:])) / number,
        max(bag.values()) / number,
        1 - len(set(lines)) / len(lines),
        sum(line[-1] in ".?!:;\"”»)" for line in lines) / len(lines),
        float(np.log1p(number / len(lines))),
        len(set(zip(words, words[1:], words[2:], strict=False))) / triples,
    ]


@dataclass
class Model:
    """``start`` and, for each feature and pair of features, a table of what its bin adds to
    the log odds of label 1."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, values: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each row of feature values: bins looked up and added."""
        total = np.full(len(values), self.start)
        for column, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, values[:, column], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[
                np.searchsorted(self.pair_edges[a], values[:, a], "right"),
                np.searchsorted(self.pair_edges[b], values[:, b], "right"),
            ]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner borders of about equally full bins."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + SMOOTHING)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of three leaves over bins in order: the value of each bin."""
    borders = [0, len(g)]
    for _ in range(2):
        best = (1e-9, 0)
        for low, high in itertools.pairwise(sorted(borders)):
            if high - low < 2:
                continue
            gs, hs = np.cumsum(g[low:high])[:-1], np.cumsum(h[low:high])[:-1]
            sum_g, sum_h = g[low:high].sum(), h[low:high].sum()
            gains = _gain(gs, hs) + _gain(sum_g - gs, sum_h - hs) - _gain(sum_g, sum_h)
            at = int(gains.argmax())
            best = max(best, (float(gains[at]), low + at + 1))
        if not best[1]:
            break
        borders.append(best[1])
    out = np.empty(len(g))
    for low, high in itertools.pairwise(sorted(borders)):
        out[low:high] = g[low:high].sum() / (h[low:high].sum() + SMOOTHING)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both axes once: its gain, and the value of each cell."""
    def corners(x: np.ndarray) -> tuple[np.ndarray, ...]:
        sums = x.cumsum(0).cumsum(1)
        a = sums[:-1, :-1]
        top, left, every = sums[:-1, -1:], sums[-1:, :-1], sums[-1, -1]
        return a, top - a, left - a, every - top - left + a

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    parts = list(zip(corners(g), corners(h), strict=True))
    gains = sum(_gain(x, y) for x, y in parts)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.empty(g.shape)
    for (x, y), rows, columns in zip(
        parts, (slice(i + 1), slice(i + 1), slice(i + 1, None), slice(i + 1, None)),
        (slice(j + 1), slice(j + 1, None), slice(j + 1), slice(j + 1, None)), strict=True,
    ):
        out[rows, columns] = x[i, j] / (y[i, j] + SMOOTHING)
    return float(gains[i, j]), out


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """Cyclic boosting: in each round every feature in turn adds a small step of a shallow
    tree to its table; then the pairs that explain most of what is left do."""
    model = Model()
    if not len(labels):
        return model
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    model.start = float(np.log(share / (1 - share)))
    model.edges = [_cuts(values[:, c], BINS) for c in range(values.shape[1])]
    model.pair_edges = [_cuts(values[:, c], PAIR_BINS) for c in range(values.shape[1])]
    bins = [np.searchsorted(e, values[:, c], "right") for c, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, values[:, c], "right") for c, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(labels), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1.0 / (1.0 + np.exp(-total))
        return labels - chance, chance * (1 - chance)

    for _ in range(ROUNDS):
        for table, own in zip(model.tables, bins, strict=True):
            g, h = slopes()
            step = RATE * _tree(np.bincount(own, g, len(table)), np.bincount(own, h, len(table)))
            table += step
            total += step[own]

    def histograms(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        cell = coarse[a] * shape[1] + coarse[b]
        return tuple(np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    g, h = slopes()
    gains = [(_quarters(*histograms(a, b, g, h))[0], a, b) for a, b in itertools.combinations(range(values.shape[1]), 2)]
    model.pairs = [(a, b) for _, a, b in sorted(gains, key=lambda x: (-x[0], x[1:]))[:PAIRS]]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * _quarters(*histograms(a, b, *slopes()))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of the labelled documents (``labels``: ``doc_id``, ``quality``), at most
    ``sample`` of them; only their features go to the driver.

    Labels that are null or without id are left out; of several labels of one document
    the smallest counts; without any label the score is 0.5.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("label_doc"), F.col("quality").cast("int").alias("label"))
        .where("label_doc is not null and label is not null")
        .groupBy("label_doc").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("label_doc", F.lit(8)), "label_doc").limit(sample)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("label_doc"), F.col(text_col).cast("string").alias("text"))
    # At most ``sample`` pairs of numbers.
    rows = rows.join(F.broadcast(chosen), "label_doc").select("label_doc", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))], ["doc", "label", "values"]
            )

    # Repeated rows of one document count once, so that the sample stays bounded.
    found = rows.transform(map_batches, run, "doc long, label int, values array<double>")
    found = found.groupBy("doc").agg(F.min("label").alias("label"), F.min("values").alias("values")).orderBy("doc").collect()
    values = np.array([r["values"] for r in found], float).reshape(len(found), len(FEATURES))
    return fit(values, np.array([r["label"] for r in found], float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc`` and ``score`` (chance of label 1), one row per row of ``docs``.

    Null and empty texts have features of 0 and a score like any other; texts are
    read whole; an empty table gives no rows; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_values(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc", "score"])

    return docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    ).transform(map_batches, run, "doc long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that score below ``threshold``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(_values(batch.column(at))) >= threshold))

    return docs.transform(map_batches, run, docs.schema)


def _values(texts: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in texts], float).reshape(len(texts), len(FEATURES))
