"""Periodic stretches of words, found as maximal pairs on the tree of LCP intervals."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import map_batches

# A run has at least so many words, and holds its period at least so many times.
LEAST_LENGTH = 6
LEAST_EXPONENT = 4

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.iinfo(np.int64).max

Run = tuple[int, int, int]


def _least_match(least_length: int, exponent: int) -> int:
    """Words that the two halves of a run's maximal pair share at least, whatever its period."""
    return min(max(least_length - q, (exponent - 1) * q) for q in range(1, least_length + 1))


def _segments(ids: np.ndarray, match: int, exponent: int) -> list[tuple[int, int]]:
    """Stretches of the text outside of which no maximal pair is long enough.

    A run of period q repeats each of its first ``length - q`` words q places on, so
    each of these places starts a gram of ``match`` words that occurs again within q
    places. Only stretches of such places matter, and a short stretch only with
    near repeats. Grams are told apart by a hash: equal ones never get apart, so
    nothing is lost.
    """
    n = len(ids) - match + 1
    words = ids.astype(np.uint64)
    gram = np.zeros(n, np.uint64)
    for k in range(match):
        gram = (gram + words[k : k + n]) * _MIX
        gram ^= gram >> np.uint64(29)
    order = np.argsort(gram, kind="stable")
    ordered = gram[order]
    again = ordered[1:] == ordered[:-1]
    if not again.any():
        return []
    gap = np.full(n, _FAR)
    gap[order[:-1][again]] = np.diff(order)[again]
    alive = gap < _FAR
    # Every round only leaves out places that no run can start from.
    for _ in range(4):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], alive.astype(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        widest = (ends - starts + match - 1) // (exponent - 1)
        near = gap[alive] <= np.repeat(widest, ends - starts)
        if near.all():
            break
        alive[np.flatnonzero(alive)[~near]] = False
    if not len(starts):
        return []
    ends = np.minimum(ends + widest + match, len(ids))
    merged: list[tuple[int, int]] = []
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order, by doubling the sorted length."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        place = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank[order] = place
        if place[-1] == n - 1:
            return order
        step = min(2 * step, n)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix in order the words that it shares with the one before it."""
    n = len(text)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    word, place, sorted_at, out = memoryview(text), memoryview(rank), memoryview(order), memoryview(lcp)
    shared = 0
    for i in range(n):
        at = place[i]
        if at == 0:
            shared = 0
            continue
        j = sorted_at[at - 1]
        while i + shared < n and j + shared < n and word[i + shared] == word[j + shared]:
            shared += 1
        out[at] = shared
        shared -= shared > 0
    return lcp


def _pairs(
    places: list[int], lcp: list[int], left: dict[int, int], match: int, least_length: int, exponent: int
) -> set[Run]:
    """Runs from the tree of LCP intervals, walked from its leaves up.

    ``places`` are the text positions of the sorted suffixes, ``left`` the class of each:
    the word before it. An interval holds its positions in text order; when children
    merge, the shorter lists go into the longest. Two positions from different children
    share exactly the words of the interval; of different classes they are a maximal pair.

    Of these only neighbours in text order need a look. In a run of smallest period q the
    pair (start, start + q) has no occurrence between: one would give the run a smaller
    period. And a pair of neighbours near enough for a run has the smallest period as
    its distance, else that period's repeat would stand between them. So pairs whose
    distance fits are the runs, none twice and none to be extended.
    """
    runs: set[Run] = set()

    def add(depth: int, held: list[int], p: int) -> list[int]:
        """A single position joins an interval: its neighbours are of another child."""
        at = bisect_left(held, p)
        for r in held[max(0, at - 1) : at + 1]:
            period = abs(r - p)
            if depth >= (exponent - 1) * period and depth + period >= least_length and left[p] != left[r]:
                runs.add((min(p, r), depth + period, period))
        held.insert(at, p)
        return held

    def merge(depth: int, children: list[list[int]]) -> list[int]:
        if len(children) == 2:
            one, two = children
            if len(two) == 1:
                return add(depth, one, two[0])
            if len(one) == 1:
                return add(depth, two, one[0])
        longest = max(range(len(children)), key=lambda c: len(children[c]))
        held = children[longest]
        owner = {p: c for c, child in enumerate(children) if c != longest for p in child}
        if len(owner) * 8 < len(held):
            for p in owner:
                insort(held, p)
        else:
            held = sorted([*held, *owner])
        for p, child in owner.items():
            at = bisect_left(held, p)
            for other in (at - 1, at + 1):
                if not 0 <= other < len(held):
                    continue
                r = held[other]
                period = abs(r - p)
                if (
                    depth >= (exponent - 1) * period
                    and depth + period >= least_length
                    and owner.get(r, longest) != child
                    and left[p] != left[r]
                ):
                    runs.add((min(p, r), depth + period, period))
        return held

    opened: list[tuple[int, list[list[int]]]] = []
    last: list[int] = []
    for at in range(len(places) + 1):
        depth = lcp[at] if at < len(places) else 0
        while opened and opened[-1][0] > depth:
            inner, children = opened.pop()
            children.append(last)
            last = merge(inner, children)
        if depth >= match:
            if opened and opened[-1][0] == depth:
                opened[-1][1].append(last)
            else:
                opened.append((depth, [last]))
        if at < len(places):
            last = [places[at]]
    return runs


def runs_of(ids: np.ndarray, least_length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> list[Run]:
    """(start, length, smallest period) of every run of the word numbers ``ids``, in order."""
    match = _least_match(least_length, exponent)
    if len(ids) < least_length:
        return []
    segments = _segments(ids, match, exponent)
    if not segments:
        return []
    # One text of all segments, each closed by a number of its own.
    top = int(ids.max()) + 1
    text = np.concatenate([part for k, (a, b) in enumerate(segments) for part in (ids[a:b], [top + k])])
    where = np.concatenate([np.arange(a, b + 1) for a, b in segments])
    order = suffix_order(text)
    lcp = common_prefixes(text, order)
    # Only suffixes that share enough with one beside them are in an interval of interest.
    inside = lcp >= match
    inside[:-1] |= inside[1:]
    places = where[order[inside]]
    before = np.concatenate(([-1], ids))[places]
    left = dict(zip(places.tolist(), before.tolist(), strict=True))
    return sorted(_pairs(places.tolist(), lcp[inside].tolist(), left, match, least_length, exponent))


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, exactly; ties: smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    covered = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        covered[start + period] += 1
        covered[start + length] -= 1
    stay = np.cumsum(covered[:-1]) == 0
    return b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FIELDS = "start: bigint, length: bigint, period: bigint"
_COLUMNS = ["doc", "n_words", "runs", "strongest", "collapsed"]


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """Columns ``doc``, ``n_words``, ``runs`` (structs of start, length, period, in order),
    ``strongest`` (one of them or null) and ``collapsed``, one row per row of ``docs``.

    Words lie between ASCII white space and are numbered from 0. A run is a stretch of
    smallest period q that neither neighbour extends, of ``least_length`` words and
    ``exponent`` periods at least; runs may overlap. ``collapsed`` lacks the words that
    some run holds after its first period.

    Each text is worked on alone and whole, so texts of one key need no common task. A
    null, empty or blank text has no words, no runs and an empty collapsed text; a null
    id stays null; repeated rows give repeated rows, an empty table none; other columns,
    whatever their names, are not looked at. A text of m words inside repeats takes
    some m log m steps and memory in proportion to m.
    """
    if least_length < 2 or exponent < 2:
        raise ValueError("a run has two words and two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, best, texts = [], [], [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode().split()
                number = {w: i for i, w in enumerate(set(words))}
                ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                found = runs_of(ids, least_length, exponent)
                counts.append(len(words))
                runs.append([dict(zip(_RUN.names, r, strict=True)) for r in found])
                top = strongest(found)
                best.append(top and dict(zip(_RUN.names, top, strict=True)))
                texts.append(collapsed(words, found).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(_RUN)),
                    pa.array(best, _RUN), pa.array(texts, pa.string()),
                ],
                _COLUMNS,
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = (
        f"doc long, n_words long, runs array<struct<{_FIELDS}>>, strongest struct<{_FIELDS}>, collapsed string"
    )
    return map_batches(rows, run, schema)
