"""One query per operator over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import (
    decontaminate,
    html_extract,
    language_id,
    later_queries,
    licenses,
    line_dedup,
    mixing,
    quality_model,
    quality_rules,
    sharding,
    simhash,
)
from reportloom.llm.common import LOWER, UPPER, table

Query = Callable[[SparkSession, str], DataFrame]

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["stop"]))
    return hits.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.array_join(spans, ",").cast("binary"), 256).alias("spans_sha256"),
    )


_BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, '[^{_BETWEEN}]+')"
OP1_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_ITEM_WORDS} AS w,
    regexp_extract_all({_LOWERED}, '[{_BETWEEN}]*[^{_BETWEEN}]+') AS parts FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS g
  FROM i, unnest(generate_series(1, greatest(1, len(w) - 9))) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT rid, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM d CROSS JOIN sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(p)),
hits AS (SELECT rid, p, n, item FROM dw JOIN iw USING (n, g)),
hit AS (SELECT DISTINCT rid, q FROM (SELECT DISTINCT rid, p, n FROM hits) AS h, unnest(generate_series(p, p + n - 1)) AS t(q)),
words AS (SELECT rid, count(*) AS n_hit FROM hit GROUP BY rid),
island AS (SELECT rid, q, q - row_number() OVER (PARTITION BY rid ORDER BY q) AS k FROM hit),
ends AS (
  SELECT rid, q, sum(length(parts[q])) OVER (PARTITION BY rid ORDER BY q) AS stop, length(w[q]) AS n
  FROM d SEMI JOIN hit USING (rid), unnest(generate_series(1, len(w))) AS t(q)),
span AS (SELECT rid, min(stop - n) AS start, max(stop) AS stop FROM island JOIN ends USING (rid, q) GROUP BY rid, k),
spans AS (
  SELECT rid, count(*) AS n_spans, string_agg(start || '-' || CAST(stop AS BIGINT), ',' ORDER BY start) AS list
  FROM (SELECT rid, CAST(start AS BIGINT) AS start, stop FROM span) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_spans, 0) AS n_spans, sha256(coalesce(list, '')) AS spans_sha256
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid) LEFT JOIN spans USING (rid)
"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents"), licenses.template_frame(spark))
    return found.withColumnRenamed("doc", "doc_id")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PLAIN = r"regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\n]+', ' ', 'g')"
_UNIT_WORDS = "list_filter(regexp_split_to_array(unit, '[ \\n]+'), lambda w: w <> '')"
OP2_SQL = rf"""
WITH templates(template_id, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(licenses.TEMPLATES.items()))}),
tw AS (SELECT template_id, list_filter(string_split(replace({_PLAIN}, chr(10), ' '), ' '), lambda w: w <> '') AS w FROM templates),
tg AS (SELECT template_id, len(w) - 1 AS n, w[p] || ' ' || w[p + 1] AS g
  FROM tw, unnest(generate_series(1, len(w) - 1)) AS t(p)),
tk AS (SELECT template_id, n, g, row_number() OVER (PARTITION BY template_id, g) AS k FROM tg),
sizes AS (SELECT DISTINCT template_id, n FROM tk),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_PLAIN} AS plain FROM documents),
parts AS (SELECT rid, plain, string_split(plain, chr(10)) AS lines, regexp_split_to_array(plain, '\n *\n') AS blocks FROM d),
units AS (
  SELECT rid, unnest(list_concat(lines,
    CASE WHEN contains(plain, chr(10)) THEN blocks ELSE [] END,
    CASE WHEN len(blocks) > 1 THEN [plain] ELSE [] END)) AS unit FROM parts),
uw AS (SELECT row_number() OVER () AS uid, rid, {_UNIT_WORDS} AS w FROM units),
compared AS (SELECT uid, rid, w, len(w) - 1 AS n FROM uw WHERE EXISTS (
  SELECT 1 FROM sizes AS s WHERE s.n > 0 AND len(uw.w) > 1 AND 2 * least(s.n, len(uw.w) - 1) >= 0.8 * (s.n + len(uw.w) - 1))),
ug AS (SELECT uid, n, w[p] || ' ' || w[p + 1] AS g FROM compared, unnest(generate_series(1, len(w) - 1)) AS t(p)),
uk AS (SELECT uid, n, g, row_number() OVER (PARTITION BY uid, g) AS k FROM ug),
dice AS (
  SELECT u.uid, t.template_id, CAST(2.0 AS DOUBLE) * count(*) / (any_value(u.n) + any_value(t.n)) AS dice
  FROM uk AS u JOIN tk AS t ON u.g = t.g AND u.k = t.k GROUP BY u.uid, t.template_id),
best AS (
  SELECT uid, template_id, dice FROM dice WHERE dice >= 0.8
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY dice DESC, template_id) = 1),
found AS (
  SELECT rid, count(*) AS n_matches, string_agg(DISTINCT template_id, ',' ORDER BY template_id) AS licenses,
    first(template_id ORDER BY dice DESC, template_id) AS best_license, max(dice) AS best_dice
  FROM best JOIN compared USING (uid) GROUP BY rid),
counted AS (SELECT rid, count(*) AS n_compared FROM compared GROUP BY rid)
SELECT doc_id, coalesce(n_compared, 0) AS n_compared, coalesce(n_matches, 0) AS n_matches,
  coalesce(licenses, '') AS licenses, best_license, best_dice
FROM d LEFT JOIN counted USING (rid) LEFT JOIN found USING (rid)
"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("doc").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_chars",
    )


_SOLID = r"length(regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g'))"
_BAD = rf"""({_SOLID.format("line")} > 0 AND (
  length(regexp_replace(line, '{quality_rules.SYMBOLS}', '', 'g')) * 100 > {_SOLID.format("line")} * {quality_rules.MOST_SYMBOLS}
  OR length(regexp_replace(line, '[^!]+', '', 'g')) * 100 > {_SOLID.format("line")} * {quality_rules.MOST_EXCLAIMED}
  OR (length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) >= {quality_rules.CAPITAL_LETTERS}
    AND length(regexp_replace(line, '[^\p{{Lu}}]+', '', 'g')) * 100
      > length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) * {quality_rules.MOST_CAPITALS})
  OR regexp_matches(line, '{quality_rules.SEPARATED}') OR regexp_matches(line, '{quality_rules.NAVIGATION}')
  OR regexp_matches(line, '{quality_rules.BOILERPLATE}')
  OR (NOT regexp_matches(line, '[.,;:!?…]') AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {quality_rules.BARE_WORDS})))"""
OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
grams AS (SELECT rid, p, array_to_string(w[p : p + 4], ' ') AS g FROM d, unnest(generate_series(1, len(w) - 4)) AS t(p)),
twice AS (SELECT rid, p FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeats AS (SELECT rid, count(DISTINCT q) AS n_repeat_words FROM twice, unnest(generate_series(p, p + 4)) AS t(q) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
judged AS (SELECT rid, line, {_SOLID.format("line")} AS chars, {_BAD} AS bad FROM lines),
per AS (
  SELECT rid, count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines,
    coalesce(sum(chars) FILTER (bad), 0) AS lost_chars FROM judged GROUP BY rid),
counted AS (
  SELECT d.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, {_SOLID.format("text")} AS word_chars,
    length(regexp_replace(text, '{quality_rules.SYMBOLS}', '', 'g')) AS n_symbols,
    n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(lost_chars AS BIGINT) AS lost_chars
  FROM d JOIN per USING (rid) LEFT JOIN repeats USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= {quality_rules.MOST_LOST_PERCENT} * word_chars AS kept,
  lost_chars
FROM counted
"""


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), simhash.hex_digits(F.col("bits")).alias("fingerprint"),
        F.col("root.doc").alias("component_id"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")


OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size, md5(coalesce(text, '')) AS tie,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS solid,
    length(regexp_replace(coalesce(text, ''), '[^\p{{L}}]+', '', 'g')) AS letters,
    (CAST('0x' || substr(md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE))
      / 4503599627370496 AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size, tie,
    -ln(u) / (CASE WHEN solid > 0 THEN CAST(0.1 AS DOUBLE) + CAST(0.9 AS DOUBLE) * letters / solid ELSE 1.0 END) AS key FROM d),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
turns AS (
  SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS w,
    3 * source_size AS cap FROM sized),
ranked AS (
  SELECT *, row_number() OVER full_first AS place,
    sum(source_size) OVER () - coalesce(sum(cap) OVER (full_first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (full_first ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM turns WINDOW full_first AS (ORDER BY CAST(cap AS DOUBLE) / w, source IS NULL, encode(source))),
level AS (SELECT rest, share FROM ranked WHERE rest * w <= cap * share ORDER BY place LIMIT 1),
aims AS (
  SELECT r.source, r.source_size, least(CAST(l.rest * r.w AS DOUBLE) / CAST(l.share AS DOUBLE), CAST(r.cap AS DOUBLE)) AS target
  FROM ranked AS r, level AS l),
laid AS (
  SELECT k.*, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 1 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed AS k JOIN aims AS a ON k.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
  CAST((epochs + CASE WHEN size > 0 AND before + CAST(size AS DOUBLE) / 2 <= target - epochs * source_size AND epochs < 3 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM laid
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("doc").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


_STRIPPED = "trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"
OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, -9223372036854775807 - 1) AS doc,
  string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, doc, p, lines[p] AS line FROM d, unnest(generate_series(1, len(lines))) AS t(p)),
k AS (SELECT rid, doc_id, doc, p, line, translate({_STRIPPED}, '{UPPER}', '{LOWER}') AS key FROM l),
shared AS (SELECT key, max(doc) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc) >= 5),
marked AS (SELECT k.*, s.key IS NOT NULL AND doc <> s.last AS gone FROM k LEFT JOIN shared AS s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""


def _shard_columns(shards: DataFrame) -> DataFrame:
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = _shard_columns(sharding.shard_documents(table(spark, sf_dir, "documents")))
    return shards.select(
        F.col("doc").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def _fold(doc: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")) % folds


def quality_of(docs: DataFrame, labels: DataFrame) -> quality_model.Model:
    """The classifier that query and pipeline use: it learns from four folds of five."""
    return quality_model.learn(docs, labels.where(_fold(F.col("doc_id"), 5) != 0))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_model.score(docs, quality_of(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("doc").alias("doc_id"), (_fold(F.col("doc"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.where(_fold(F.col("doc_id"), 4) != 2).select(F.col("doc_id").alias("id"), "lang", "text")
    found = language_id.identify(docs, language_id.learn_whole(rows))
    return found.select(
        F.col("doc").alias("doc_id"), (_fold(F.col("doc"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumnRenamed("page", "page_id")


QUERIES: dict[str, Query] = {
    run.__name__: run
    for run in (
        op1_decontamination, op2_license_scan, op3_quality_rules, op4_simhash, op5_mixing, op6_line_dedup,
        op7_sharding, op8_quality, op9_language_id, op10_html_extraction,
    )
} | later_queries.QUERIES
CHECKS = {
    "op1_decontamination": OP1_SQL,
    "op2_license_scan": OP2_SQL,
    "op3_quality_rules": OP3_SQL,
    "op5_mixing": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
} | later_queries.CHECKS
