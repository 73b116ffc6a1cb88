"""Words that differ by one code point, found through pairs of trie nodes, and their usual forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.llm.common import settle

LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form is at least so many times as frequent as the word that it stands for.
TIMES = 2

# Nodes up to this depth are numbered by their code points, 21 bits each, below zero;
# deeper ones from the dictionary. So the few first nodes that many words pass through
# need no look-up.
_PACKED = 3


def count_words(
    runs: DataFrame, word_col: str = "word", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """Columns ``word`` and ``n``: the distinct words of at least ``least_length`` code
    points that ``runs`` holds at least ``least_count`` times. Null words do not count."""
    words = runs.select(F.col(word_col).cast("string").alias("word"))
    long_enough = words.where(F.char_length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _packed(part: Column) -> Column:
    """A number below zero for a string of at most three code points, one for each."""
    codes = [
        F.when(F.char_length(part) > k, F.shiftleft(_code(F.substring(part, k + 1, 1)), 21 * k)).otherwise(F.lit(0))
        for k in range(_PACKED)
    ]
    return -F.lit(1).cast("long") - (codes[0] + codes[1] + codes[2])


def _code(letter: Column) -> Column:
    """The code point of ``letter``, from its UTF-32 bytes."""
    return F.conv(F.hex(F.encode(letter, "UTF-32")), 16, 10).cast("long")


def _numbered(parts: DataFrame, name: str) -> DataFrame:
    """Columns ``part`` and ``number``: the trie nodes that ``parts`` reaches, numbered once.

    The numbers are in a written table, so tasks that run again read the same ones.
    """
    nodes = parts.where(F.char_length("part") > _PACKED).select("part").distinct()
    return settle(nodes.withColumn("number", F.monotonically_increasing_id()), name)


def _nodes(words: DataFrame, part: Column, name: str) -> DataFrame:
    """Columns ``id`` and ``nodes``: for each word the numbers of its nodes by cut, 0 to its length."""
    cuts = words.select("id", "word", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("cut"))
    parts = cuts.select("id", "cut", part.alias("part"))
    numbers = _numbered(parts, name)
    known = parts.join(numbers, "part", "left")
    number = F.when(F.char_length("part") > _PACKED, F.col("number")).otherwise(_packed(F.col("part")))
    at = F.struct("cut", number.alias("node"))
    # One entry per cut of one word.
    return known.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(at)), lambda x: x["node"]).alias(name))


def node_pairs(words: DataFrame) -> DataFrame:
    """The pair dictionary: columns ``head`` and ``tail`` (numbers of a node of the forward
    and one of the reversed trie), ``skips``, ``first``, and ``word`` and ``n`` of the word.

    A word enters each pair (prefix, suffix) of a cut, and with ``skips`` each pair that
    leaves out one of its code points. Equal pairs are equal remaining strings cut at the
    same place. ``first`` marks a skipped code point that differs from the one before,
    so of a letter repeated in a row one skip counts.
    """
    head = F.expr("substring(word, 1, cut)")
    tail = F.expr("substring(word, cut + 1)")
    nodes = _nodes(words, head, "heads").join(_nodes(words, tail, "tails"), "id").join(words, "id")
    cut = nodes.select("word", "n", "heads", "tails", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("cut"))
    kinds = cut.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("skips")).where(
        ~F.col("skips") | (F.col("cut") < F.char_length("word"))
    )
    after = F.col("cut") + F.col("skips").cast("int")
    repeated = F.expr("cut > 0 AND substring(word, cut, 1) = substring(word, cut + 1, 1)")
    return kinds.select(
        F.get("heads", F.col("cut")).alias("head"), F.get("tails", after).alias("tail"), "skips",
        (F.col("skips") & ~repeated).alias("first"), "word", "n",
    )


def neighbours(words: DataFrame) -> DataFrame:
    """Columns ``word``, ``n``, ``n_near`` and ``best`` (struct of ``n`` below zero and ``word``)
    for the words that have near words.

    All words that skip at one pair differ there in one code point only, so they are near
    each other; the one word cut at the pair without a skip is near those that skip. A
    pair's members are at most as many as there are code points, and no two of them are
    put together: counts and the two best of a pair say all that each member needs.
    """
    rows = node_pairs(words).withColumn("as_best", F.struct((-F.col("n")).alias("n"), F.col("word").alias("word")))
    pair = Window.partitionBy("head", "tail")
    ordered = pair.orderBy(F.col("skips").desc(), "as_best").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    met = rows.select(
        "*",
        F.sum(F.col("skips").cast("long")).over(ordered).alias("n_skips"),
        F.sum(F.col("first").cast("long")).over(ordered).alias("n_first"),
        F.first("as_best").over(ordered).alias("one"),
        F.nth_value("as_best", 2).over(ordered).alias("two"),
        F.min(F.when(F.col("first"), F.col("as_best"))).over(ordered).alias("longer"),
        F.min(F.when(~F.col("skips"), F.col("as_best"))).over(ordered).alias("shorter"),
    )
    shorter = F.when(F.col("first"), F.col("shorter"))
    replaced = F.when(
        F.col("n_skips") > 1, F.when(F.col("one.word") == F.col("word"), F.col("two")).otherwise(F.col("one"))
    )
    found = met.select(
        "word", "n",
        F.when(F.col("skips"), F.col("n_skips") - 1 + shorter.isNotNull().cast("long"))
        .otherwise(F.col("n_first")).alias("near"),
        F.when(F.col("skips"), F.least(replaced, shorter)).otherwise(F.col("longer")).alias("best"),
    ).where("near > 0")
    return found.groupBy("word").agg(
        F.first("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """Columns ``word`` and ``root`` of the words that have a form, by doubling the steps
    taken. Counts double along a chain, so chains are short."""
    reached = settle(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not reached.join(after, "root", "left_semi").take(1):
            return reached
        joined = reached.join(after, "root", "left")
        reached = settle(joined.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def spelling_groups(words: DataFrame, word_col: str = "word", count_col: str = "n", times: int = TIMES) -> DataFrame:
    """Columns ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``, one row per word.

    Two words are near if they differ by exactly one inserted, deleted or replaced code
    point. A word's form is its near word of largest count (ties: the smallest in
    code-point order) if that is at least ``times`` the word's own count, else null;
    ``root`` is where the forms lead, the word itself if it has none. ``times`` is 2 at
    least, so that forms cannot lead in a circle.

    Counts of a repeated word are summed, a null count is 0 and a count below 1 takes a form
    of ``times`` at least; null words are left out and
    an empty word is near those of one code point; an empty table gives no rows; other
    columns, whatever their names, are not looked at. A word of m code points has some
    2 m rows in the dictionary, however many words share its parts.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    given = words.select(
        F.col(word_col).cast("string").alias("word"), F.coalesce(F.col(count_col).cast("long"), F.lit(0)).alias("n")
    ).where(F.col("word").isNotNull())
    counted = given.groupBy("word").agg(F.sum("n").alias("n"))
    counted = settle(counted.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    near = settle(neighbours(counted), "spelling-near")
    form = F.when(-F.col("best.n") >= times * F.greatest("n", F.lit(1)), F.col("best"))
    formed = near.select("word", "n_near", form["word"].alias("form"), (-form["n"]).alias("form_n"))
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return (
        counted.join(formed, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n",
        )
    )
