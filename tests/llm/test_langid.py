import random

import numpy as np
import pytest

from panelcast.llm import langid
from panelcast.llm.words import utf8

DOCS = "doc_id long, text string, lang string, score int, used string"
SYLLABLES = {"aa": ["th", "er", "on", "an"], "bb": ["é", "eau", "oi", "que"], "cc": ["sch", "ung", "ü", "ei"]}


def texts(seed, n, languages="aa bb cc"):
    rng = random.Random(seed)
    for i in range(n):
        lang = rng.choice(languages.split())
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 40))]
        yield i, " ".join(words).title(), lang, 1, "x"


def predicted(spark, rows, model):
    return {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOCS), model).collect()}


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.createDataFrame([*texts(1, 200), (900, "x", None, 1, "x"), (901, None, "aa", 1, "x")], DOCS))


def test_unseen_texts(spark, model):
    rows = list(texts(2, 200))
    got = predicted(spark, rows, model)
    assert sum(got[i].lang_pred == lang for i, _, lang, *_ in rows) >= 195
    assert all(0 <= r.score <= 1 for r in got.values())


def test_texts_without_letters_and_mixed_ones(spark, model):
    mixed = " ".join(a[1] + " " + b[1] for a, b in zip(texts(3, 30, "aa"), texts(4, 30, "bb")))
    rows = [(1, None), (2, ""), (3, "12 ### ¿—"), (4, "7é"), (5, "x"), (None, "the"), (6, mixed), (6, mixed)]
    got = langid.identify(spark.createDataFrame([(i, t, None, 1, "x") for i, t in rows], DOCS), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and [by[i].score for i in (1, 2, 3)] == [0] * 3
    assert {by[i].lang_pred for i in (4, 5, None, 6)} <= set(model.languages)


def test_too_few_languages(spark):
    none = langid.fit(spark.createDataFrame([], DOCS))
    assert predicted(spark, [(1, "words", "aa", 1, "x")], none)[1].lang_pred == "und"
    one = langid.fit(spark.createDataFrame(list(texts(1, 9, "aa")), DOCS))
    assert predicted(spark, [(1, "words", None, 1, "x")], one)[1][1:3] == ("aa", 1.0)
    assert langid.identify(spark.createDataFrame([], DOCS), one).collect() == []


def test_counts_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    column = pa.array([t[1] for t in texts(5, 40)] + ["", None, "É" * 50])
    whole = langid.ngram_counts(*utf8(column))
    monkeypatch.setattr(langid, "_PIECE", 7)
    assert (langid.ngram_counts(*utf8(column)) == whole).all()
    each = np.concatenate([x for _, x in langid.pieces(column)])
    monkeypatch.undo()
    assert np.allclose(each, np.concatenate([x for _, x in langid.pieces(column)]))


def test_codewords_can_correct_errors():
    for n, apart in ((2, 1), (4, 4), (6, 16), (30, 10)):
        code = langid.codewords(n)
        assert len(code) == n
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= apart


def test_one_wrong_bit_is_corrected(spark, model):
    x = np.zeros((1, langid.FEATURES))
    for k, word in enumerate(model.code):
        for wrong in range(len(word)):
            margin = 3 * word.copy()
            margin[wrong] *= -0.5
            bent = langid.LanguageCode(model.languages, model.code, np.zeros_like(model.weights), margin, model.trust, model.params)
            assert langid.decoded(bent, x).argmax() == k
