import random

import pytest

from panelcast.llm.substring import Repeats, without_repeats

DOCS = "doc_id long, text string, start int, words string, mini long, hash string"


def brute(rows, window):
    """Every window as a tuple of words and the smallest document it starts in."""
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k : k + window])] = min(first.get(tuple(w[k : k + window]), i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                keep[k : k + window] = [False] * window
        out.append((str(i), b" ".join(x for x, y in zip(w, keep) if y).decode(), len(w), keep.count(False)))
    return sorted(out)


def run(spark, rows, how):
    df = spark.createDataFrame([(i, t, 1, "x", 2, "y") for i, t in rows], DOCS).repartition(3)
    return sorted((str(r.doc_id), r.kept, r.n_words, r.n_removed) for r in without_repeats(df, how).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "The"]
    passages = [rng.choices(vocabulary, k=rng.randint(5, 40)) for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices(vocabulary, k=rng.randint(0, 30)) + rng.choice(passages + [[]])
        rows.append((rng.randint(0, 10**6), rng.choice([" ", "\n\t", "\r \x0b"]).join(words)))
    return rows + rng.sample(rows, 5) + [(7, rows[0][1]), (7, rows[1][1]), (9, None), (10, ""), (None, rows[2][1]), (None, None)]


@pytest.mark.parametrize("how", [Repeats(8, 3), Repeats(8, 3, bucket_rows=2), Repeats(5, 5, sort_words=1), Repeats(13, 1, 50, 100)])
def test_equals_brute_force(spark, how):
    rows = corpus(how.window + how.bucket_rows, 80)
    got = run(spark, rows, how)
    assert got == brute(rows, how.window)
    assert sum(r[3] for r in got) > 100


def test_a_word_that_never_changes_and_a_long_text(spark):
    rows = [(1, "a " * 700), (2, "a " * 300), (3, "b " + "a " * 49 + "b"), (0, "c " * 49), (4, "c " * 49)]
    assert run(spark, rows, Repeats()) == brute(rows, 50)
    rng = random.Random(1)
    long = [str(rng.randint(0, 10**9)) for _ in range(400_000)]
    rows = [(5, " ".join(long)), (6, " ".join(long[200_000:200_120]))]
    assert [r[3] for r in run(spark, rows, Repeats())] == [0, 120]


def test_empty_table(spark):
    assert run(spark, [], Repeats()) == []
