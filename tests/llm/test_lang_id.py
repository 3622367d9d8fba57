import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.llm import lang_id

SYLLABLES = {"en": "th er on an re he in nd".split(), "de": "en er ch sch ung ge ß keit".split(), "fr": "le ou é eau tion qu ent é".split()}


def text(lang, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(5, 40)))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text(lang, k), lang) for k in range(240) for lang in [list(SYLLABLES)[k % 3]]]
    return spark.createDataFrame([*rows, (900, None, "en"), (901, "", "de"), (902, "12 !! 34", "fr"), (903, text("en", 5), None), (None, text("fr", 9), "fr")], "doc_id long, text string, lang string")


def test_held_out(docs):
    flags = {r.doc_id: r.h for r in docs.where("doc_id is not null").select("doc_id", lang_id.held_out().alias("h")).collect()}
    assert flags == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in flags}


def test_accuracy_and_oddities(docs):
    names, matrix = lang_id.fit(docs.where(~F.coalesce(lang_id.held_out(), F.lit(False))))
    assert names == sorted(SYLLABLES) and np.allclose(np.exp(matrix[:-2]).sum(axis=0), 1, atol=1e-3)
    got = {r.doc_id: r for r in lang_id.predict(docs.withColumn("score", F.lit("clash")), names, matrix).collect()}
    assert all(got[k].lang_pred == list(SYLLABLES)[k % 3] and 0.5 < got[k].score <= 1 for k in range(240))
    assert all((got[k].lang_pred, got[k].score) == ("und", 0.0) for k in (900, 901, 902))
    assert got[903].lang_pred == "en" and got[None].lang_pred == "fr"


def test_counted_model(docs):
    """The matrix against plain counts of all labelled texts, which the sample takes whole here."""
    rows = [r for r in docs.collect() if r.lang and r.text is not None]
    names, matrix = lang_id.fit(docs)
    for k, name in enumerate(names):
        counts = np.full(1 << lang_id.BITS, lang_id.ALPHA)
        for r in rows:
            if r.lang == name:
                for column in lang_id.features(r.text):
                    counts[column] += 1
        share = counts / counts.sum()
        assert np.allclose(matrix[:-2, k], np.log(share), atol=1e-4) and np.isclose(matrix[-1, k], (share * np.log(share)).sum(), atol=1e-4)
        assert np.isclose(matrix[-2, k], np.log(sum(r.lang == name for r in rows) / len(rows)), atol=1e-5)


def test_scores_are_the_naive_sum(docs, monkeypatch):
    names, matrix = lang_id.fit(docs)
    texts = [text("de", 77), None, "a", "", "né", text("fr", 78) * 5, "12", "über 12 x" * 40]
    for span in (1 << 18, 50, 7):  # whole, and in spans that cut texts
        monkeypatch.setattr(lang_id, "SPAN", span)
        scores, grams = lang_id.score_texts(texts, matrix)
        for some, score, n in zip(texts, scores, grams, strict=True):
            if some is None or not lang_id._LETTER.search(some):
                assert np.isnan(score).all() and n == 0
            else:
                columns = lang_id.features(some)
                assert np.allclose(score, matrix[-2] + matrix[columns].astype(float).sum(axis=0), atol=1e-6 * len(columns)) and n == len(columns)


def test_fit_tells_languages_not_learnt(docs, spark):
    names, matrix = lang_id.fit(docs)
    alien = ["Это русский текст о погоде и природе.", "これは日本語の文章です。", "zqxj kvwp qqzx jxkz wvqp zzxq"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(alien)], "doc_id long, text string")
    assert all(r.fit < 0.5 < r.score for r in lang_id.predict(rows, names, matrix).collect())
    assert all(r.fit > 0.7 for r in lang_id.predict(docs.where("doc_id < 240"), names, matrix).collect())


def test_too_many_languages(docs, monkeypatch):
    monkeypatch.setattr(lang_id, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError):
        lang_id.fit(docs)


def test_nothing_learnt(docs, none):
    names, matrix = lang_id.fit(docs.where("lang is null"))
    assert names == []
    assert {r.lang_pred for r in lang_id.predict(docs, names, matrix).collect()} == {"und"}
    assert lang_id.predict(none, *lang_id.fit(docs)).count() == 0
