import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcast.llm import lexical

DOCS, ITEMS = "doc_id long, text string, lang string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(i, terms(t)) for i, t, *_ in docs]
    n_docs, total = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    out = []
    for item, text, *_ in items:
        scored = []
        for doc, own in held:
            score = 0
            for t in set(terms(text)) & set(own):
                df, tf = sum(t in x for _, x in held), own.count(t)
                m = 100 - 50 + (50 * len(own) * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score:
                scored.append((-score, math.inf if doc is None else doc))
        out += [(item, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **kw):
    out = lexical.ranked_search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), lexical.RankParams(**kw))
    return sorted(map(tuple, out.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(120)] + ["É", "été", "NASA", "x1", "naïve-ish", "don't", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40, 200]))) for _ in range(n)]
    docs = [(i * 7 % 1009, t, "en") for i, t in enumerate(texts)] + [(2000 + i, texts[5], "en") for i in range(9)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 12])))) for i in range(8)]
    return docs, items


@pytest.mark.parametrize("seed,kw", [
    (1, {"k": 5}),
    (2, {"k": 3, "spread": 1, "hashes": 1, "group": 2, "slice_bytes": 300, "step_cells": 100}),
    (3, {"k": 4, "block_terms": 3, "broadcast_rows": 0}),
])
def test_results_equal_brute_force(spark, seed, kw):
    docs, items = corpus(seed, 70)
    assert found(spark, docs, items, **kw) == brute(docs, items, kw["k"])


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "common " * 40_000 + "rare"
    docs = [(3, "Rare word", "x"), (1, "rare WORD", "x"), (None, "word rare", "x"), (1, "rare word", "x"), (4, None, "x"), (5, "", "x"),
            (6, " ,;\x7f", "x"), (7, long, "x"), (8, "common", "x")] + [(20 + i, f"other text {i}", "x") for i in range(20)]
    items = [(1, "rare, word!"), (1, "common"), (None, "RARE"), (2, None), (3, ""), (4, "nowhere"), (5, "rare rare rare " + long), (1, "common")]
    assert found(spark, docs, items, k=5) == brute(docs, items, 5)


def test_empty_tables_and_clashing_names(spark):
    docs, items = spark.createDataFrame([(1, "a b", "x")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert lexical.ranked_search(docs.where("false"), items).collect() == []
    assert lexical.ranked_search(docs, items.where("false")).collect() == []
    assert lexical.ranked_search(docs, spark.createDataFrame([(1, "z")], ITEMS)).collect() == []
    names = ["row", "n", "sketch", "terms", "holders", "kind", "query", "term", "score", "rank"]
    wide = [df.withColumns({c: F.lit(c) for c in names}) for df in (docs.union(docs.withColumn("text", F.lit("c"))), items)]
    assert [r[:3] for r in lexical.ranked_search(*wide).collect()] == [(1, 1, 1)]


def test_bounds_hold_and_are_exact_without_collisions():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    texts = pa.array([" ".join(words[:n]) for n in (1, 9, 60, 400)] + ["", "w1 " * 1000 + "w7 w7"])
    runs, before = lexical.terms_of(texts)
    numbers, known = lexical.encoded(runs)
    indptr, indices, counts = lexical.compressed_rows(numbers, before, len(known))
    rows = lexical.pd.DataFrame({"query": [0, 0, 1], "term": ["w1", "w7", "absent"], "df": [3, 2, 1]})
    block = lexical.Block(rows, 6, int(before[-1]), 4)
    n = np.diff(before)
    exact = block.scores(texts, n)
    for spread in (1, 4, 1 << 16):
        held, begins = lexical.sketched(lexical.coordinates(known, 4), indptr, indices, counts, spread)
        sketches = pa.array([held[a:b].tobytes() for a, b in zip(begins, begins[1:])], pa.binary())
        bound = block.bounds(sketches, n)
        assert (bound >= exact).all()
    assert (bound[:5] == exact[:5]).all() and bound[5, 0] > exact[5, 0] > 0
