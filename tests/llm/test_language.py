"""Language identification: held-out accuracy on the given documents, letters, tables in chunks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import language


def test_held_out_accuracy(spark):
    got = language.op6_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    judged = got.join(truth, "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    right, every = judged.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert every > 100 and right >= 0.97 * every


@pytest.mark.parametrize("text,words", [
    ("½ ² Ⅷ 12", []), ("x²y", ["x", "y"]), ("Été à 3½ Uhr", ["été", "à", "uhr"]), ("日本 ٣ _a_", ["日本", "a"]), (None, []),
])
def test_only_letters_make_words(text, words):
    assert language.words_of(text) == words


def test_texts_without_letters_are_unknown(spark):
    docs = spark.createDataFrame([(i, "kata lobu mine" if i % 2 else "grosch pfluck", "x" if i % 2 else "y") for i in range(40)], "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "١٢٣ _"), (3, None), (4, "")], "doc_id long, text string")
    assert {(r["lang_pred"], r["score"]) for r in language.identify(odd, language.train(docs)).collect()} == {("und", 0.0)}


def test_chunks_make_no_difference(monkeypatch):
    words = ["alpha", "beta", "a", "gamma", "alpha", "zeta"]
    lang, times = np.array([0, 0, 0, 1, 1, 1]), np.array([3.0, 1.0, 2.0, 5.0, 1.0, 4.0])
    whole = language.Model(["x", "y"], words, lang, times)
    monkeypatch.setattr(language, "CHUNK", 2)
    parts = language.Model(["x", "y"], words, lang, times)
    for a, b in zip(whole.grams, parts.grams):
        assert a.at == b.at and (a.scores == b.scores).all()
    # By hand: the frequency of "al" among the two-letter pieces of the first language.
    pieces = {0: 3 * 6 + 5 + 2 * 2, 1: 6 + 6 + 5 * 4 - 20 + 5 * 6 - 6 + 4 * 5 - 6}
    table = whole.grams[1]
    assert np.isclose(np.exp(table.scores[table.at["al"], 0]), (3 + 0.5) / (pieces[0] + 0.5 * (len(table.at) + 1)))
