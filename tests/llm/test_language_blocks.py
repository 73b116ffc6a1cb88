"""The language model in blocks against the model in one piece and against plain counts."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from reportloom.llm import language_id

from .conftest import prose

SCHEMA = "id long, lang string, text string"


def _rows():
    rows = [(i, "x", prose(i, 60)) for i in range(60)]
    # Few rows beside a hot language, each n-gram of them rare.
    return [*rows, (100, "y", "zwölf boxkämpfer jagen viktor quer über den großen sylter deich"), (101, None, "no language"), (102, "x", None)]


def _whole():
    counts = {}
    for name in ("x", "y"):
        keys = [language_id.ngrams(language_id.symbols(t)) for _, lang, t in _rows() if lang == name and t]
        counts[name] = np.unique(np.concatenate(keys), return_counts=True)
    return language_id.Model(counts)


def test_blocks_cost_what_one_piece_costs(spark):
    rows = spark.createDataFrame(_rows(), SCHEMA).repartition(3)
    whole = _whole()
    texts = [prose(500, 40), "viktor jagen", "чужой текст", "", None, "qqq zzz"]
    for most in (3_000_000, 900):
        model = language_id.learn_whole(rows, most_ngrams=most)
        assert (len(model.blocks) > 5) == (most == 900)
        for found, known in zip(model.entropies(texts), whole.entropies(texts), strict=True):
            assert np.allclose(found, known, rtol=1e-5)
        named = {r["doc"]: r for r in language_id.identify(rows, model, id_col="id").collect()}
        assert named[100]["lang_pred"] == "y" and named[5]["lang_pred"] == "x" and named[102]["lang_pred"] == "und"


def test_a_language_with_little_text_is_kept(spark):
    rows = spark.createDataFrame(_rows(), SCHEMA)
    model = language_id.learn_whole(rows, most_ngrams=500)
    assert model.languages == ["x", "y"]
    assert sum(len(b.value.table) for b in model.blocks) == len(_whole().table)


def test_nothing_learned(spark):
    rows = spark.createDataFrame([(1, None, "a text"), (2, "x", "12")], SCHEMA)
    found = language_id.identify(rows, language_id.learn_whole(rows), id_col="id").collect()
    assert {r["lang_pred"] for r in found} == {"und"}


def _plain_costs(texts, symbols):
    """Interpolated Kneser-Ney by its formula, with dicts: a cost for (context, symbol)."""
    grams = Counter()
    for text in texts:
        word = "   " + text + " "
        grams.update(word[i : i + 4] for i in range(len(word) - 3))
    counts = {4: grams}
    for order in (3, 2, 1):
        # In how many ways an n-gram is continued to the left.
        counts[order] = Counter(gram[1:] for gram in counts[order + 1])

    def chance(context, symbol):
        p = 1.0 / (len(symbols) + 1)
        for order in (1, 2, 3, 4):
            own, before = counts[order], context[len(context) - order + 1 :]
            once = sum(n == 1 for n in own.values())
            twice = sum(n == 2 for n in own.values())
            discount = language_id._discount(once, twice)
            follow = {gram: n for gram, n in own.items() if gram[:-1] == before}
            if follow:
                total = sum(follow.values())
                p = max(follow.get(before + symbol, 0) - discount, 0.0) / total + discount * len(follow) / total * p
        return p

    return lambda context, symbol: -math.log(chance(context, symbol))


def test_costs_are_those_of_the_formula(spark):
    texts = {"x": ["abab abc abd", "cab bad", "abab abc abd"], "y": ["bcd bce", "ebb ada bcd"]}
    rows = spark.createDataFrame([(i, k, t) for k, ts in texts.items() for i, t in enumerate(ts)], SCHEMA)
    symbols = {c for ts in texts.values() for t in ts for c in t}
    wanted = ["abba cad", "bcd", "zz top a", "e"]
    for most in (3_000_000, 12):
        model = language_id.learn_whole(rows, most_ngrams=most)
        found, lengths = model.entropies(wanted)
        for column, language in enumerate(model.languages):
            cost = _plain_costs(texts[language], symbols)
            for i, text in enumerate(wanted):
                word = "   " + text + " "
                each = [cost(word[p : p + 3], word[p + 3]) for p in range(len(word) - 3)]
                assert lengths[i] == len(each)
                assert math.isclose(found[i][column], sum(each) / len(each), rel_tol=1e-5)


def test_languages_of_odd_rows(odd):
    model = language_id.learn_whole(odd.select(F.col("doc_id").alias("id"), "lang", "text"))
    found = language_id.identify(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert {r["lang_pred"] for r in found if r["doc"] in (1, 2, 3)} == {"und"}
    assert {r["lang_pred"] for r in found if r["doc"] not in (None, 1, 2, 3)} <= {"en", "de"}


def test_no_rows_have_no_language(empty):
    model = language_id.learn_whole(empty.select("lang", "text"))
    assert model.languages == [] and language_id.identify(empty, model).collect() == []


def test_a_foreign_text_is_rejected(spark):
    rows = spark.createDataFrame([(i, "x", prose(i, 30)) for i in range(50)], SCHEMA)
    model = language_id.learn_whole(rows)
    _, _, rejected = model.predict([prose(7, 30), "Совсем другой язык, которого модель не знает совсем"])
    assert rejected.tolist() == [False, True]
