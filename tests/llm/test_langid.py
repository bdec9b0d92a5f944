"""Language ID: held-out accuracy, codewords, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollgate.llm import langid, queries


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op4_language_id_ecoc"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    r = got.join(docs, "doc_id").filter("held_out and lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    assert r[1] > 100 and r[0] > 0.98 and 0 <= r[2] <= r[3] <= 1


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords_differ_and_no_column_is_constant(n):
    code = langid.codewords(n)
    assert code.shape[0] == n and len({tuple(r) for r in code}) == n
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_edges(make_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 8)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !?", "de"), (103, "der hund", None), (None, "the dog", "en"),
             (104, "the " * 40_000, None), (104, "the " * 40_000, None)]
    docs = make_docs(rows)
    model = langid.learn(docs, F.lit(True))
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0 and got[101].ambiguous
    assert (got[103].lang_pred, got[None].lang_pred, got[104].lang_pred) == ("de", "en", "en")
    assert all(0 <= r.score <= 1 for r in got.values())
    one = langid.learn(docs.filter("lang = 'en'"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.predict(docs.filter("doc_id = 103"), one, ["doc_id"]).collect()} == {("en", 1.0)}
    none = langid.learn(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, none, ["doc_id"]).collect()} == {"und"}


def test_predictions_do_not_depend_on_language_or_source(make_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 8)]
    model = langid.learn(make_docs(rows), F.lit(True))
    a = langid.predict(make_docs(rows), model, ["doc_id"]).orderBy("doc_id").collect()
    b = langid.predict(make_docs([(i, t, "xx", "yy") for i, t, _ in rows]), model, ["doc_id"]).orderBy("doc_id").collect()
    assert a == b


def test_und_means_no_letter(make_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 8)]
    model = langid.learn(make_docs(rows), F.lit(True))
    odd = ["² ½ Ⅷ", "٣٤", "_-_", "٪", "́", "½ x", "ª", "ʰ", "好"]
    got = {r.doc_id: r.lang_pred for r in langid.predict(make_docs(odd), model, ["doc_id"]).collect()}
    assert [got[i] == "und" for i in range(len(odd))] == [True] * 5 + [False] * 4


def test_decoding_by_brute_force(make_docs):
    """Bits, losses and scores computed again from the counts, code and calibration that were learned."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"),
                                                        ("le chat et le chien", "fr")] * 6)]
    model = langid.learn(make_docs(rows), F.lit(True))
    assert model.languages == ["de", "en", "fr"] and model.code.shape[0] == 3
    for text in ("the dog and", "die katze", "chien", "xyz", "der chat the"):
        grams = langid.trigrams(text)
        margin = [sum(float(model.odds[g][b]) for g in grams) / len(grams) for b in range(model.code.shape[1])]
        loss = [sum(float(model.weight[b]) * float(np.logaddexp(0, -model.code[k][b] * (model.slope[b] * margin[b] + model.offset[b])))
                    for b in range(len(margin))) for k in range(3)]
        lang, score, ambiguous = langid.decide(model, text)
        assert lang == model.languages[int(np.argmin(loss))]
        assert score == pytest.approx(1 / sum(np.exp(min(loss) - x) for x in loss), rel=1e-4) and ambiguous == (score < langid.SURE)


def test_empty_table_and_clashing_columns(spark, make_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 8)]
    model = langid.learn(make_docs(rows), F.lit(True))
    assert langid.predict(make_docs([]), model, ["doc_id"]).count() == 0
    odd = make_docs(rows).selectExpr("*", "'x' AS score", "1 AS lang_pred", "2 AS ambiguous")
    a, b = (sorted(map(tuple, langid.predict(d, model, ["doc_id"]).collect())) for d in (odd, make_docs(rows)))
    assert a == b
