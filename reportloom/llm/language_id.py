"""Language of texts by interpolated Kneser-Ney character models."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import map_batches, settle

ORDER = 4
UNKNOWN = "und"
# N-grams, of all languages together, that a block of a model holds; a task holds one at a time.
MOST_NGRAMS = 3_000_000
# Numbers in the table of its costs, one per n-gram and language.
MOST_COSTS = 24_000_000
# Share of the learned rows that rejection lets pass.
ACCEPTED = 0.999
# Characters at most whose evidence the score counts as independent.
EVIDENCE = 50
# Positions worked on at a time, and those of a model in several blocks, so that each is
# loaded seldom.
PIECE = 1 << 20
LONG_PIECE = 1 << 23

BLANK, OTHER = 0x20, 0xFFFF


@lru_cache(maxsize=1)
def _folded() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its symbol (lower case; a blank for what is no letter or
    mark; one symbol for all beyond 16 bits) and whether it is a letter."""
    symbol = np.full(0x110000, BLANK, np.uint16)
    letter = np.zeros(0x110000, bool)
    for point in range(0x110000):
        character = chr(point)
        kind = unicodedata.category(character)[0]
        if kind == "L" or kind == "M":
            symbol[point] = min(ord(character.lower()[0]), OTHER)
            letter[point] = kind == "L"
    return symbol, letter


def symbols(text: str | None) -> np.ndarray | None:
    """Symbols of a text, one blank between words, ``ORDER - 1`` before the first and one
    behind the last; None without a letter."""
    if not text:
        return None
    symbol, letter = _folded()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not letter[points].any():
        return None
    found = symbol[points]
    blank = found == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    found = found[keep]
    start = 1 if found[0] == BLANK else 0
    end = len(found) - (1 if found[-1] == BLANK else 0)
    return np.concatenate((np.full(ORDER - 1, BLANK, np.uint16), found[start:end], np.array([BLANK], np.uint16)))


def ngrams(found: np.ndarray) -> np.ndarray:
    """Four symbols as one number, for each place behind the leading blanks."""
    wide = found.astype(np.uint64)
    keys = wide[: len(wide) - ORDER + 1].copy()
    for k in range(1, ORDER):
        keys <<= np.uint64(16)
        keys |= wide[k : len(wide) - ORDER + 1 + k]
    return keys


def _totals(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their values."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, values, len(distinct))


@dataclass
class Level:
    """One order of one language in sorted arrays: n-grams with discounted shares, and
    contexts with the weight of the next lower order."""

    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _level(keys: np.ndarray, counts: np.ndarray, discount: float | None = None) -> Level:
    if discount is None:
        discount = _discount(np.count_nonzero(counts == 1), np.count_nonzero(counts == 2))
    contexts, place = np.unique(keys >> np.uint64(16), return_inverse=True)
    total = np.bincount(place, counts, len(contexts))
    kinds = np.bincount(place, minlength=len(contexts))
    return Level(keys, np.maximum(counts - discount, 0) / total[place], contexts, discount * kinds / total)


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
    return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)


class Model:
    """Interpolated Kneser-Ney models of several languages.

    The highest order counts n-grams, each lower order in how many different ways its
    n-grams are continued to the left; every order gives a discount to the next
    lower one, the lowest to all symbols alike.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """counts: sorted n-grams and their counts for each language."""
        self.languages = sorted(counts)
        self.levels: list[list[Level]] = []
        self.limits = np.full(len(counts), np.inf)
        every = [np.unique(k & np.uint64(0xFFFF)) for k, _ in counts.values()]
        self.uniform = 1.0 / (len(np.unique(np.concatenate(every))) + 1) if every else 1.0
        for language in self.languages:
            keys, number = counts[language]
            levels = []
            for order in range(ORDER, 0, -1):
                levels.append(_level(keys, number.astype(np.float64)))
                if order > 1:
                    shorter = keys & np.uint64((1 << 16 * (order - 1)) - 1)
                    keys, number = _totals(shorter, np.ones(len(shorter)))
            self.levels.append(levels[::-1])
        self.table = np.unique(np.concatenate([k for k, _ in counts.values()])) if counts else np.empty(0, np.uint64)
        # For every n-gram of any language its cost in each of them, one row per n-gram.
        self.costs = self._costs(self.table).astype(np.float32)

    def _costs(self, keys: np.ndarray) -> np.ndarray:
        out = np.empty((len(keys), len(self.languages)))
        for column, levels in enumerate(self.levels):
            chance = np.full(len(keys), self.uniform)
            for order, level in enumerate(levels, 1):
                if not len(level.grams):
                    continue
                part = keys & np.uint64((1 << 16 * order) - 1) if order < ORDER else keys
                at, known = _found(level.contexts, part >> np.uint64(16))
                chance *= np.where(known, level.weights[at], 1.0)
                at, known = _found(level.grams, part)
                chance += np.where(known, level.shares[at], 0.0)
            out[:, column] = -np.log(chance)
        return out

    def costs_of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.table):
            return self._costs(keys)
        at, known = _found(self.table, keys)
        out = self.costs[at]
        if not known.all():
            distinct, place = np.unique(keys[~known], return_inverse=True)
            out[~known] = self._costs(distinct)[place]
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean cost per symbol in each language (rows: texts), and numbers of symbols."""
        total = np.zeros((len(texts), len(self.languages)))
        lengths = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        owners: list[int] = []
        held = 0

        def flush() -> None:
            if parts:
                starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
                sums = np.add.reduceat(self.costs_of(np.concatenate(parts)), starts, axis=0, dtype=np.float64)
                np.add.at(total, owners, sums)
            parts.clear()
            owners.clear()

        for index, text in enumerate(texts):
            found = symbols(text)
            if found is None:
                continue
            keys = ngrams(found)
            lengths[index] = len(keys)
            for at in range(0, len(keys), PIECE):
                parts.append(keys[at : at + PIECE])
                owners.append(index)
                held += len(parts[-1])
                if held >= PIECE:
                    flush()
                    held = 0
        flush()
        return total / np.maximum(lengths, 1)[:, None], lengths

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected: its entropy is above the limit of
        its language (short texts, whose means vary more, get room)."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropies, lengths = self.entropies(texts)
        best = entropies.argmin(axis=1)
        least = entropies[np.arange(len(texts)), best]
        evidence = np.minimum(lengths, EVIDENCE)[:, None]
        score = 1.0 / np.exp(-(entropies - least[:, None]) * evidence).sum(axis=1)
        rejected = least > self.limits[best] + 2.0 / np.sqrt(np.maximum(lengths, 1))
        named = [self.languages[b] if n else UNKNOWN for b, n in zip(best, lengths, strict=True)]
        return named, np.where(lengths > 0, score, 0.0), rejected | (lengths == 0)


class Block(Model):
    """What a model knows of the n-grams whose middle lies in one range (see ``_middle``)."""

    def __init__(self, languages: list[str], levels: list[list[Level]], uniform: float):
        self.languages, self.levels, self.uniform = languages, levels, uniform
        self.limits = np.full(len(languages), np.inf)
        self.table = np.unique(np.concatenate([own[-1].grams for own in levels]))
        self.costs = self._costs(self.table).astype(np.float32)


class BlockModel(Model):
    """A whole model in blocks, each a broadcast value of which a task holds one at a time.

    ``bounds`` are the least middles of all blocks but the first. It is small itself,
    and goes to the executors in the closure of a function, not as a broadcast value.
    """

    def __init__(self, languages: list[str], bounds: np.ndarray, blocks: list):
        self.languages, self.bounds, self.blocks = languages, bounds, blocks
        self.limits = np.full(len(languages), np.inf)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros((len(texts), len(self.languages)))
        lengths = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        owners: list[int] = []
        most = PIECE if len(self.blocks) == 1 else LONG_PIECE
        held = 0
        for index, text in enumerate(texts):
            found = symbols(text)
            if found is None:
                continue
            keys = ngrams(found)
            lengths[index] = len(keys)
            for at in range(0, len(keys), PIECE):
                parts.append(keys[at : at + PIECE])
                owners.append(index)
                held += len(parts[-1])
                if held >= most:
                    self._add(total, parts, owners)
                    parts, owners, held = [], [], 0
        if parts:
            self._add(total, parts, owners)
        return total / np.maximum(lengths, 1)[:, None], lengths

    def _add(self, total: np.ndarray, parts: list[np.ndarray], owners: list[int]) -> None:
        keys = np.concatenate(parts)
        owner = np.repeat(owners, [len(p) for p in parts])
        which = np.searchsorted(self.bounds, _middle(keys), side="right") if len(self.blocks) > 1 else None
        for number, shared in enumerate(self.blocks):
            own = np.arange(len(keys)) if which is None else np.flatnonzero(which == number)
            for at in range(0, len(own), PIECE):
                place = own[at : at + PIECE]
                # Places are in order, so those of one text lie together.
                rows, starts = np.unique(owner[place], return_index=True)
                total[rows] += np.add.reduceat(shared.value.costs_of(keys[place]), starts, axis=0, dtype=np.float64)
            if which is not None and getattr(shared, "_path", None) is not None:
                # The next ``value`` reads it from its file again.
                shared.__dict__.pop("_value", None)


def _middle(keys: np.ndarray) -> np.ndarray:
    """The third symbol and, below it, the second. N-grams of one middle have in common
    what their contexts and next lower order are counted over; those of one third symbol
    also the order below that."""
    low = np.uint64(0xFFFF)
    return ((keys >> np.uint64(16)) & low) << np.uint64(16) | ((keys >> np.uint64(32)) & low)


def ngram_counts(learn: DataFrame) -> DataFrame:
    """Columns ``lang``, ``gram`` and ``n`` over all rows of ``learn`` (``lang`` and ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            size = 0
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = symbols(text.as_py())
                if found is not None:
                    held.setdefault(language, []).append(ngrams(found))
                    size += len(found)
                if size > 4 * PIECE:
                    yield from _counted(held)
                    held, size = {}, 0
            yield from _counted(held)

    part = learn.select("lang", "text").transform(map_batches, run, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for language, parts in held.items():
        keys, number = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(number.astype(np.int64))],
            ["lang", "gram", "n"],
        )


def _by_language(found: pa.Table, languages: list[str], column: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted numbers of ``column`` and their counts ``n`` for each language."""
    names = found.column("lang").combine_chunks().dictionary_encode()
    index = {name: i for i, name in enumerate(names.dictionary.to_pylist())}
    name = names.indices.to_numpy(zero_copy_only=False)
    keys, number = found.column(column).to_numpy().view(np.uint64), found.column("n").to_numpy()
    out = []
    for language in languages:
        own = np.flatnonzero(name == index.get(language, -1))
        own = own[np.argsort(keys[own])]
        out.append((keys[own], number[own].astype(np.float64)))
    return out


def learn_whole(rows: DataFrame, most_ngrams: int = MOST_NGRAMS, most_costs: int = MOST_COSTS) -> BlockModel:
    """A model of all n-grams of all rows of ``rows`` (``lang`` and ``text``) whose ``lang``
    is not null.

    Discounts and continuation counts are those of all n-grams. The model is cut into
    blocks of some ``most_ngrams`` n-grams and ``most_costs`` costs; the driver makes one
    at a time. Rejection is calibrated on all rows, whose entropies stay on the executors.
    """
    rows = rows.where("lang is not null").select("lang", "text")
    counts = settle(ngram_counts(rows), "ngrams")
    # Of each lower order in how many ways its n-grams are continued to the left.
    orders = [counts]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << 16 * order) - 1).alias("gram")
        orders.append(settle(orders[-1].groupBy("lang", shorter).agg(F.count(F.lit(1)).alias("n")), f"ngrams-{order}"))
    discounts = []
    for every in orders[::-1]:
        seen = every.groupBy("lang").agg(
            F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"), F.count(F.lit(1)).alias("all")
        )
        discounts.append({r["lang"]: (_discount(r["once"], r["twice"]), r["all"]) for r in seen.collect()})
    languages = sorted(discounts[-1])
    if not languages:
        return BlockModel([], np.empty(0, np.uint64), [])
    number = sum(n for _, n in discounts[-1].values())
    third = F.shiftright("gram", 16).bitwiseAND(0xFFFF)
    middle = third * 65536 + F.shiftright("gram", 32).bitwiseAND(0xFFFF)
    blocks = max(-(-number // most_ngrams), -(-number * len(languages) // most_costs))
    bounds: list[int] = []
    if blocks > 1:
        shares = [i / blocks for i in range(1, blocks)]
        bounds = sorted(set(counts.select(F.percentile_approx(middle, shares, max(10_000, 10 * blocks))).first()[0]))
    lowest = _by_language(orders[ORDER - 1].toArrow(), languages, "gram")
    uniform = 1.0 / (len(np.unique(np.concatenate([k for k, _ in lowest]))) + 1)
    context = rows.sparkSession.sparkContext
    parts = []
    for low, high in zip([0, *bounds], [*bounds, 1 << 32], strict=True):
        held = _by_language(counts.where((middle >= low) & (middle < high)).toArrow(), languages, "gram")
        # All pairs whose first symbol is the third of an n-gram in the block.
        first = F.shiftright("gram", 16)
        pairs = orders[ORDER - 2].where((first >= low >> 16) & (first <= high - 1 >> 16))
        pairs = _by_language(pairs.toArrow(), languages, "gram")
        levels = []
        for i, language in enumerate(languages):
            triples = _totals(held[i][0] & np.uint64((1 << 48) - 1), np.ones(len(held[i][0])))
            every = (lowest[i], pairs[i], triples, held[i])
            levels.append([_level(*own, discount=discounts[k][language][0]) for k, own in enumerate(every)])
        parts.append(context.broadcast(Block(languages, levels, uniform)))
    model = BlockModel(languages, np.array(bounds, np.uint64), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = {language: i for i, language in enumerate(model.languages)}
        for batch in batches:
            names = batch.column(0).to_pylist()
            entropies, lengths = model.entropies(batch.column(1).to_pylist())
            own = [(name, e[column[name]]) for name, e, n in zip(names, entropies, lengths, strict=True) if n >= 20]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in own], pa.string()), pa.array([o[1] for o in own], pa.float64())], ["lang", "entropy"]
            )

    found = rows.transform(map_batches, run, "lang string, entropy double")
    limits = found.groupBy("lang").agg(F.percentile_approx("entropy", ACCEPTED, 100_000).alias("limit"))
    for r in limits.collect():
        model.limits[languages.index(r["lang"])] = r["limit"]
    return model


def identify(docs: DataFrame, model: BlockModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc``, ``lang_pred``, ``score`` (0 to 1) and ``rejected``, one row per row.

    A text that is null or has no letter is ``und`` with score 0; so is any text if
    nothing was learned. Texts of any length are read whole; equal entropies go to the
    first language by name; an empty table gives no rows; other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, score, rejected = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc", "lang_pred", "score", "rejected"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    ).transform(map_batches, run, "doc long, lang_pred string, score double, rejected boolean")
