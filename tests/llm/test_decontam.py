import random
import re

import numpy as np
import pyarrow as pa
import pytest

from panelcast.llm import decontam as d
from panelcast.llm.decontam import LatentParams

DOCS = "doc_id long, text string, item_id int, hash string, cosine int"
ITEMS = "item_id long, text string, doc_id int, first string"
rng = random.Random(4)
COMMON = ["the", "of", "to", "and", "er", "in", "on", "it"]


def words(n):
    return [rng.choice(COMMON) if rng.random() < 0.5 else "".join(rng.choices("bcdfgaeiou", k=6)) for _ in range(n)]


def dressed(ws):
    return "".join(w.upper() + "!!\n" if i % 3 else w.title() + "### " for i, w in enumerate(ws))


@pytest.fixture(scope="module")
def corpus():
    items = {i: words(n) for i, n in enumerate([9, 15, 20, 33, 34, 47, 60, 75, 120, 31])}
    rows, want = [], set()
    for doc in range(120):
        text = words(rng.randint(0, 150))
        item = doc % 12
        if item in items:
            leak = list(items[item])
            if doc % 2:  # a paraphrase: every ninth word is another one
                leak[4::9] = words(len(leak[4::9]))
            at = rng.randint(0, len(text))
            text[at:at] = leak
            want.add((doc, item))
        rows.append((doc, dressed(text) if doc % 5 == 0 else " ".join(text)))
    return items, rows, want


def found(spark, rows, items, params=LatentParams()):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    return docs, d.leaks(docs, bench, params)


@pytest.mark.parametrize("params", [LatentParams(), LatentParams(block=3, rounds=2), LatentParams(rank=24)])
def test_copies_and_paraphrases_are_found_and_clean_documents_are_not(spark, corpus, params):
    items, rows, want = corpus
    _, out = found(spark, rows, [(i, " ".join(w)) for i, w in items.items()], params)
    out = out.collect()
    assert {(r.doc_id, r.item_id) for r in out} == want and len(out) == len(want)
    assert all(r.overlap >= 0.99 for r in out if r.doc_id % 2 == 0)


def test_odd_rows(spark, corpus):
    items, _, _ = corpus
    leak = " ".join(items[5])
    rows = [(1, None), (2, ""), (3, "### \n"), (None, leak), (4, leak), (4, leak), (4, "other"), (5, "b " * 300_000 + leak)]
    bench = [(5, leak), (None, leak), (6, None), (7, ""), (8, "too short an item"), (9, leak)]
    docs, out = found(spark, rows, bench)
    got = sorted((str(r.doc_id), str(r.item_id)) for r in out.collect())
    assert got == sorted([(i, k) for i in ("None", "4", "4", "5") for k in ("5", "9", "None")])
    kept = d.without_leaks(docs, out).collect()
    assert sorted(str(r.text)[:5] for r in kept) == sorted(["None", "", "### \n", "other"])
    assert kept[0].__fields__ == docs.columns


@pytest.mark.parametrize("params", [LatentParams(), LatentParams(exact_block=4, rounds=2)])
def test_items_of_a_few_words_are_found_whole(spark, params):
    few = random.Random(9)
    draw = lambda n: " ".join(few.choices("abcde", k=n))
    bench = [(None if i % 9 == 0 else i // 2, draw(1 + i % 7)) for i in range(60)] + [(1, "a"), (1, "a"), (70, "A, b! c? d")]
    rows = [(i, draw(few.randint(0, 30))) for i in range(80)] + [(90, "c d"), (91, "e"), (92, "x a. B--c D y"), (93, "ab cd")]
    _, out = found(spark, rows, bench, params)
    fold = lambda t: f" {' '.join(re.findall('[a-z]+', t.lower()))} "
    want = sorted((i, str(k)) for i, t in rows for k, item in set(bench) if fold(item) in fold(t))
    assert sorted((r.doc_id, str(r.item_id)) for r in out.collect()) == want and len(want) > 500


def test_texts_under_one_id_are_items_each_and_a_long_item_is_found(spark):
    a, b, giant = words(20), words(40), words(2000)
    bench = [(7, " ".join(a)), (7, " ".join(b)), (8, " ".join(giant))]
    rows = [(1, " ".join(words(30) + a + words(30))), (2, " ".join(b)), (3, " ".join(words(90))), (4, " ".join(words(9) + giant))]
    _, out = found(spark, rows, bench)
    assert sorted((r.doc_id, r.item_id) for r in out.collect()) == [(1, 7), (2, 7), (4, 8)]


def test_empty_tables(spark, corpus):
    assert found(spark, [], [(1, " ".join(corpus[0][5]))])[1].collect() == []
    assert found(spark, [(1, "some text")], [])[1].collect() == []


def test_candidates_equal_all_cosines(spark, corpus):
    """The bound on the norm drops no window that the latent cosine would keep."""
    items, rows, _ = corpus
    bench = spark.createDataFrame([(i, " ".join(w), 1, "x") for i, w in items.items()], ITEMS)
    idf = np.full(1 << 16, 2.0, np.float32)
    params = LatentParams(windows=(8, 8), short=0, rank=12)
    (block,) = d.collected(d.latent_blocks(bench, idf, params))
    block["best"] = d.best_parts(block, params)
    assert block["best"].size
    hashes, before = d.hashed(*d.folded(pa.array([t for _, t in rows])))
    want = set()
    for text in range(len(rows)):
        ws = hashes[before[text] : before[text + 1]]
        for s in range(0, max(len(ws) - 8, 0) + 2, 2) if len(ws) else ():
            if s and s >= len(ws) - 8 + 2:
                continue
            part = ws[s : s + 8]
            at, w = d.weighted(part, idf, block["vocabulary"])
            norm = np.sqrt(len(part) * 4.0)
            cosine = (w @ block["v"][at]) @ block["latent"].T / norm if len(at) else np.zeros(len(block["item"]))
            want |= {(text, int(before[text]) + s, int(p)) for p in np.flatnonzero(cosine >= params.cosine * block["own"] + 1e-4)}
    got = {(t, b, p) for t, b, p, _ in d.candidates(hashes, before, idf, block, params)}
    assert want <= got and len(got) <= len(want) * 1.02 + 2 and len(want) > 100


def test_document_frequencies(spark):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in [(1, "a b a"), (2, "A. c"), (3, None), (4, "")]], DOCS).repartition(3)
    total, frequency = d.document_frequencies(docs, 1 << 16)
    bucket = lambda w: int(d.hashed(*d.folded(pa.array([w])))[0][0] % np.uint64(1 << 16))
    assert total == 4 and [frequency[bucket(w)] for w in "abcd"] == [2, 1, 1, 0] and frequency.sum() == 4


def test_common_subsequence():
    def table(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 80))] for _ in range(2))
        assert d.common_subsequence(a, b) == table(a, b)


def test_randomised_svd_spans_the_leading_space():
    g = np.random.default_rng(1)
    a = (g.normal(size=(60, 6)) @ g.normal(size=(6, 90)) + 0.01 * g.normal(size=(60, 90))).astype(np.float32)
    v = d.randomised_svd(a, 6, 3)
    assert np.linalg.norm(a - a @ v @ v.T) <= 1.01 * np.sqrt((np.linalg.svd(a)[1][6:] ** 2).sum()) + 1e-3
