"""Mixing of sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.llm.common import even_number, even_spread, running_sum, settle, split_words

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"


def quality_weight(text: Column) -> Column:
    """From 0.1 to 1: the share of letters among the characters that are no white space."""
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.when(solid > 0, 0.1 + 0.9 * letters / solid).otherwise(F.lit(1.0))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source with its ``source_size``.

    Sources in order of their names' code points (null last) have ``weights`` in turn
    and share the sum of all sizes by them. A target ends at ``most_epochs`` times the
    source's size; the excess is shared anew until none is above. That is the level
    at which the sources that fill up first, by size over weight, are full.
    """
    by_name = Window.orderBy(F.isnull("source"), F.col("source").cast("binary"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1)
    cap = F.col("source_size") * most_epochs
    ranked = sources.withColumn("__w", weight).withColumn("__cap", cap)
    # Caps and weights of the sources that are full before this one, and of the others.
    full = Window.orderBy(F.col("__cap") / F.col("__w"), F.isnull("source"), F.col("source").cast("binary"))
    earlier, rest = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = ranked.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(earlier), F.lit(0))).alias("__left"),
        F.sum("__w").over(rest).alias("__share"),
    )
    # The first source that its share does not fill sets the level for all behind it.
    fits = F.when(F.col("__left") * F.col("__w") <= F.col("__cap") * F.col("__share"), F.struct(
        (F.col("__cap") / F.col("__w")).alias("at"), F.isnull("source").alias("void"), F.col("source").alias("name"),
        F.col("__left").alias("left"), F.col("__share").alias("share"),
    ))
    ranked = ranked.withColumn("__fit", F.min(fits).over(everything))
    level = F.col("__fit.left") * F.col("__w") / F.col("__fit.share")
    target = F.when(F.isnull("__fit"), F.col("__cap").cast("double")).otherwise(
        F.least(level, F.col("__cap").cast("double"))
    )
    return ranked.withColumn("target", target).drop("__w", "__cap", "__left", "__share", "__fit")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    row_col: str | None = None, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """Columns ``doc``, ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken``
    (``copies`` times ``size``), one row per row of ``docs``; also ``row``, the column
    ``row_col``, if that is named.

    A source whose target is k sizes and a rest gives every document k times. The
    rest is filled by documents in rising order of -ln(u) / quality, u being a fixed
    number in (0, 1) from the id and the ``seed``, as long as they lie nearer to the
    target than without them: a whole document is taken or none of it. Reruns agree.
    Equal keys (repeated rows) are ordered by id and text. Null and wordless texts
    have size 0 and come once per full epoch; a null source is a source; no document
    comes more than ``most_epochs`` times; an empty table gives no rows; other
    columns are not looked at.
    """
    text = F.col(text_col).cast("string")
    narrow = docs.select(
        *([F.col(row_col).alias("row")] if row_col else []),
        F.col(id_col).cast("long").alias("doc"),
        F.col(source_col).cast("string").alias("source"),
        F.size(split_words(text)).cast("long").alias("size"),
        quality_weight(F.coalesce(text, F.lit(""))).alias("quality"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("tie"),
    )
    key = -F.log(even_number(F.lit(seed), F.col("doc"))) / F.col("quality")
    rows = settle(narrow.withColumn("key", key), "mix")
    sized = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = settle(targets(sized, weights, most_epochs), "mix-targets")
    plans = aims.select(
        F.col("source").alias("__source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).alias("epochs"),
    )
    # Keys follow the qualities of their source, so its own quantiles cut it evenly.
    rows = even_spread(rows, "source", "key", "spread")
    ordered = running_sum(rows, ["source"], ["key", "doc", "tie"], "spread", "size", "before")
    ordered = ordered.join(plans, F.col("source").eqNullSafe(F.col("__source")))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= rest) & (F.col("epochs") < most_epochs)
    copies = F.col("epochs") + extra.cast("long")
    return ordered.select(
        *(["row"] if row_col else []), "doc", "size", "source_size", "target",
        copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes it (see ``mix``)."""
    columns = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(docs.columns)]
    rows = settle(docs.select(F.monotonically_increasing_id().alias("__row"), *columns), "mix-rows")
    name = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    taken = mix(rows, name[id_col], name[text_col], name[source_col], "__row", weights, most_epochs, seed)
    taken = taken.where("copies > 0").select(F.col("row").alias("__row"), "copies")
    repeated = rows.join(taken.hint("merge"), "__row").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
