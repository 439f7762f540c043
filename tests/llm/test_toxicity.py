import random
import re

import numpy as np
import pytest

from panelcast.llm import toxicity
from panelcast.llm.toxicity import SubwordParams
from panelcast.llm.words import word_hashes

DOCS = "doc_id long, text string, toxic int, score double, n string"
SMALL = SubwordParams(buckets=1 << 14)
BAD = ["grumbleface", "snotworth", "Blockhead!"]


def rows(seed, n, bad=BAD):
    rng = random.Random(seed)
    for i in range(n):
        words = ["".join(rng.choices(["la", "mi", "to", "ren", "du"], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        yield seed * 1000 + i, " ".join(words), int(i % 3 == 0), 0.5, "x"


@pytest.fixture(scope="module")
def model(spark):
    noise = [(1, None, 1, 0.5, "x"), (2, "la", None, 0.5, "x"), (None, "mi", 1, 0.5, "x"), (3, "to", 7, 0.5, "x")]
    return fitted(spark, [*rows(1, 900), *noise])


def fitted(spark, data):
    docs = spark.createDataFrame(data, DOCS)
    return toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic", "text"), SMALL)


def scored(spark, data, model):
    return {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(data, DOCS), model).collect()}


@pytest.mark.parametrize("bad, least", [(BAD, 135), (["grumbelface,", "sn0tworth", "blokhead"], 125)])
def test_unseen_texts_and_unseen_misspellings(spark, model, bad, least):
    data = list(rows(2, 150, bad))
    got = scored(spark, data, model)
    right = [(got[i] >= 0.5) == bool(y) for i, _, y, *_ in data]
    assert sum(right) >= least


def test_odd_texts(spark, model):
    data = [(1, None, 1, 0.5, "x"), (2, "", 0, 0.5, "x"), (3, "!!! \n ---", 0, 0.5, "x"), (4, "la " * 200_000, 0, 0.5, "x"), (4, "mi", 0, 0.5, "x"), (None, "Blockhead", 1, 0.5, "x")]
    out = toxicity.score(spark.createDataFrame(data, DOCS), model).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1] == by[2] and by[None] > 0.5
    assert toxicity.score(spark.createDataFrame([], DOCS), model).collect() == []


def test_scores_equal_the_definition(spark, model):
    """Mean over words of the mean over the word itself and its 3- to 5-grams, with marks at its ends."""
    data = [(i, t, 0, 0.5, "x") for i, t in enumerate(["Ab", "x", "Great-Aunt's; naïve!!", "a b  c\n\td", "### idiot%%% ,", "é", "  lead", "###"])]
    got = scored(spark, data, model)
    for i, text, *_ in data:
        words = [w for w in re.sub(r"(?<![a-z0-9\x80-\uffff])[!-/:-@\[-`{-~]|[!-/:-@\[-`{-~](?![a-z0-9\x80-\uffff])", " ", text.lower()).split()]
        means = []
        for w in words:
            b = np.frombuffer(b" " + w.encode() + b" ", np.uint8)
            own = word_hashes(b, np.array([1]), np.array([len(b) - 1]))
            buckets = [toxicity.word_buckets(own, SMALL), *(toxicity.gram_buckets(b, n, SMALL) for n in (3, 4, 5))]
            means.append(model.value[np.concatenate(buckets)].mean())
        odds = sum(means) / max(len(words), 1) + model.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-odds)), rel=1e-4), text


def test_one_class_or_none(spark):
    for labels, score in ((set(), 0.5), ({0}, 0.0), ({1}, 1.0)):
        data = [r for r in rows(3, 30) if r[2] in labels]
        model = fitted(spark, data)
        assert scored(spark, [(1, "x", 0, 0.5, "x")], model)[1] == pytest.approx(score)


def test_texts_of_all_lengths_train_within_the_bound(spark, monkeypatch):
    """Long texts are drawn like others; with a bound on characters the same share of every length is."""
    drawn = []
    monkeypatch.setattr(toxicity, "train", lambda texts, marks, params: drawn.append((texts.to_pylist(), marks.tolist())))
    rows = [(i, "long " * 6000 if i % 4 == 0 else "short") for i in range(800)] + [(None, "x"), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 4 % 2) for i in range(800)] + [(900, 1)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    toxicity.fit(docs, labels, toxicity.SubwordParams(chars_per_class=1_500_000))
    (every, marks), (some, _) = drawn
    assert len(every) == 800 and sum(marks) == 400 and sum(len(t) > 20_000 for t in every) == 200
    assert 320 < len(some) < 480 and 0.15 < sum(len(t) > 20_000 for t in some) / len(some) < 0.35
