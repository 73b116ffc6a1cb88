"""Queries of the operators 11 to 13, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import nearest, periodic_runs, spelling
from reportloom.llm.common import LOWER, UPPER, ascii_lower, split_words, table

# The IEEE polynomial of CRC-32, lowest bit first: a fixed value.
_POLYNOMIAL = 0xEDB88320


def _crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of the UTF-8 bytes of ``text``, a column of ASCII
    and two-byte letters, bit by bit."""
    byte = f"list_transform(generate_series(1, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS INT), 2) AS BIGINT))"
    step = f"CASE WHEN x % 2 = 1 THEN xor(x // 2, {_POLYNOMIAL}) ELSE x // 2 END"
    shift = f"list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: {step})"
    return f"xor(list_reduce(list_concat([4294967295], {byte}), lambda c, b: {shift}), 4294967295)"


def _decimal(doc: Column) -> Column:
    return F.coalesce(doc.cast("long").cast("string"), F.lit(""))


def _with_cycles(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where the words of a tenth of the texts repeat from some place on."""
    h = F.crc32(_decimal(F.col("doc_id")).cast("binary"))
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, split_words(F.col("text"))).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    cut = split.select("doc_id", "text", "w", n.alias("n"), g.alias("g"), F.when(n > 0, g % n).cast("int").alias("a"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    head = F.slice("w", F.lit(1), F.col("a"))
    cycle = F.slice("w", F.col("a") + 1, period)
    # The cycle fits 3 to 11 times into the rest.
    tail = F.slice(F.flatten(F.array_repeat(cycle, 11)), F.lit(1), F.col("n") - F.col("a"))
    made = F.array_join(F.concat(head, tail), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_cycles(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        F.col("doc").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP11_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS name,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o FROM documents),
h AS (SELECT rid, doc_id, o, len(o) AS n, {_crc32_sql("name")} AS h FROM d),
g AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
w AS (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(generate_series(0, n - 1), lambda i: CASE WHEN i >= a THEN o[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE o[i + 1] END)
    ELSE o END AS w FROM g),
grams AS (
  SELECT rid, n, p, array_to_string(w[p + 1 : p + 5], ' ') AS gram FROM w, unnest(generate_series(0, n - 5)) AS t(p) WHERE n >= 6),
met AS (
  SELECT x.rid, x.p, y.p - x.p AS q FROM grams AS x JOIN grams AS y ON x.rid = y.rid AND x.gram = y.gram AND y.p > x.p
    AND 4 * (y.p - x.p) <= x.n),
island AS (SELECT *, p - row_number() OVER (PARTITION BY rid, q ORDER BY p) AS k FROM met),
stretch AS (SELECT rid, q, min(p) AS s, CAST(count(*) + 4 + q AS BIGINT) AS len FROM island GROUP BY rid, q, k),
runs AS (SELECT rid, s, len, min(q) AS q FROM stretch WHERE len >= greatest(6, 4 * q) GROUP BY rid, s, len),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY CAST(len AS DOUBLE) / q DESC, s, q) = 1),
listed AS (
  SELECT rid, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, p FROM runs, unnest(generate_series(s + q, s + len - 1)) AS t(p)),
words AS (SELECT rid, p, w[p + 1] AS word FROM w, unnest(generate_series(0, n - 1)) AS t(p) WHERE n > 0),
left_over AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS rest FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period, 1000 * len // q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM w LEFT JOIN best USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN left_over USING (rid)
"""


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


_LETTERS = "[a-zA-ZÀ-ÿ]+"


def _with_slips(docs: DataFrame) -> DataFrame:
    """Column ``word``: the runs of letters, of which one in 97 lacks a letter."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(_LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", _decimal(F.col("doc_id")), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.count_words(_with_slips(table(spark, sf_dir, "documents"))))


OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_LETTERS}')) AS run FROM documents),
runs AS (SELECT name || ':' || run AS name, run, count(*) AS n FROM d GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32_sql("name")} AS h FROM runs),
slips AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slips WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM words, unnest(generate_series(1, length(word))) AS t(p)),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cuts AS x JOIN cuts AS y ON x.rest = y.rest AND x.p = y.p AND x.word <> y.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cuts AS c JOIN words AS w ON c.rest = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts AS c JOIN words AS w ON c.rest = w.word),
best AS (
  SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word, n),
formed AS (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form,
    CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
steps(word, here) AS (
  SELECT word, word FROM formed UNION ALL SELECT steps.word, form FROM steps JOIN formed ON formed.word = here WHERE form IS NOT NULL),
roots AS (SELECT steps.word, here AS root FROM steps JOIN formed ON formed.word = here WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

QUERIES = {run.__name__: run for run in (op11_periodic_runs, op12_nearest, op13_spelling)}
CHECKS = {"op11_periodic_runs": OP11_SQL, "op13_spelling": OP13_SQL}
