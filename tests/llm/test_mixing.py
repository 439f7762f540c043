import pytest
from pyspark.sql import functions as F

from panelcast.llm.mixing import Mix, mixed, water_filled

DOCS = "doc_id long, text string, source string, size string, bin int, target double, s int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2.0, 3) for i, t, s in rows], DOCS)


def shares(sizes, mix):
    """Redistribution round by round, as the definition reads."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(order)}
    cap = {s: mix.max_epochs * sizes[s] for s in sizes}
    left, target, free = mix.budget * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while left > 1e-9 and free:
        total, over = sum(weight[s] for s in free), 0.0
        for s in list(free):
            target[s] += left * weight[s] / total
            if target[s] >= cap[s]:
                over += target[s] - cap[s]
                target[s] = cap[s]
                free.discard(s)
        left = over
    return target


@pytest.mark.parametrize("bits", [1, 10])
def test_targets_and_taken_words(spark, bits):
    rows = [(i, "w " * (i * 37 % 90), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(400)]
    rows += [(i, None if i % 2 else "", "hot") for i in range(400, 410)] + [(i, "a\x0bb\tc", None) for i in range(410, 430)]
    rows += [(3, "w " * 5, "hot"), (3, "w " * 5, "hot"), (None, "one two", "s1"), (500, "é é", "Z"), (501, None, "empty")]
    mix = Mix(bin_bits=bits)
    out = [r.asDict() for r in mixed(docs(spark, rows), mix).collect()]
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = shares(sizes, mix)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["repeats"] <= 2
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 45
    again = [r.asDict() for r in mixed(docs(spark, rows).repartition(5), mix).collect()]
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(out, key=key) == sorted(again, key=key)


def test_seed_changes_which_documents_are_repeated(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(60)]
    picks = [{r.doc_id for r in mixed(docs(spark, rows), Mix(budget=0.5, seed=s)).where("taken > 0").collect()} for s in "xy"]
    assert picks[0] != picks[1] and abs(len(picks[0]) - 30) <= 1


def test_empty_tables(spark):
    assert mixed(docs(spark, [])).collect() == []
    assert [r.taken for r in mixed(docs(spark, [(1, None, None), (2, "", "x")])).collect()] == [0, 0]


def test_every_source_can_be_clamped(spark):
    table = spark.createDataFrame([("a", 10), ("b", 20)], "source string, source_size long")
    out = water_filled(table, Mix(budget=9.0)).orderBy("source").select(F.col("target")).collect()
    assert [r.target for r in out] == [20.0, 40.0]
