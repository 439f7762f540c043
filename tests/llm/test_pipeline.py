import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm.simhash import one_of_each, near_duplicates, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, row int, score double, map map<string,int>"
EN = "the of and to in is that for it with as was on be by this have from or had not are but what all were when we there can an your which their".split()
FR = "le la les des une dans pour qui sur pas plus par avec tout faire mais nous comme ou si leur bien sans entre aussi cette ces deux votre".split()
ITEM = "which ancient river crossed seven silent valleys before reaching the copper harbour where merchants weighed amber against winter salt every second market morning"


def prose(words, n, salt):
    return " ".join(words[(salt * 7919 + i * i * (salt % 13 + 3) + i * 31) % len(words)] for i in range(n))


def rows():
    out = [(i, prose(EN if i % 3 else FR, 60, i), "fr" if i % 3 == 0 else "en", "hot" if i % 3 else "small") for i in range(120)]
    copy = prose(EN, 200, 500)
    out += [(200, copy, "en", "hot"), (201, copy, "en", "hot"), (201, copy, "en", "hot"), (None, copy, "en", None)]
    out += [(202, None, "en", "hot"), (203, "", "fr", "hot"), (204, "12 34 -- 56", None, "small"), (None, None, None, None)]
    out += [(300, prose(EN, 50, 7) + " " + ITEM + " " + prose(EN, 50, 9), "en", "hot")]
    out += [(301, prose(EN, 80, 11) + ' password = "q7Zt3xLm9Pw2Rb6K" ' + prose(EN, 40, 12), "en", None)]
    out += [(302, prose(FR, 80, 21) + " www.some-place.example.org " + prose(FR, 40, 22), "fr", None)]
    out += [(400 + i, prose(EN, 60, 600 + i) + f" token: aB{i}dE5fG7hJ9kL{i}mN end", "en", "small") for i in range(8)]
    return [(*r, None if r[1] is None else len(r[1]), "h", 1, 0.5, {"a": 1}) for r in out]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows(), DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (None, ITEM), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_works_on_what_the_one_before_kept(spark, folder):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == [f.split()[0] for f in DOCS.split(", ")]
        kept[name] = docs.collect()
    source = rows()
    # language: exactly the texts without letters go
    lettered = [r for r in source if any(map(str.isalpha, r[1] or ""))]
    assert sorted(map(str, (r.text for r in kept["language_id"]))) == sorted(r[1] for r in lettered)
    # near duplicates: components of all pairs within 4 bits
    prints = [simhash((r.text.encode().lower()).split(), 4) for r in kept["language_id"]]
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = collections.defaultdict(list)
    for g, r in zip(group, kept["language_id"]):
        want[g].append((r.doc_id is None, r.doc_id))
    assert sorted(map(str, (r.doc_id for r in kept["near_duplicates"]))) == sorted(str(min(v)[1]) for v in want.values())
    # decontamination: the one with the passage goes
    gone = {r.doc_id for r in kept["near_duplicates"]} - {r.doc_id for r in kept["decontamination"]}
    assert gone == {300}
    # secrets: every row stays, only texts with a secret change
    before = {r.doc_id: r for r in kept["decontamination"]}
    assert len(kept["secrets"]) == len(before)
    changed = {r.doc_id for r in kept["secrets"] if r.text != before[r.doc_id].text}
    assert 301 in changed and changed <= {301, *range(400, 408)}
    assert all("q7Zt3xLm9Pw2Rb6K" not in r.text and r.n_chars == len(r.text) for r in kept["secrets"])


def test_run_mixes_all_that_is_kept(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, out)) == sorted(map(str, corpus_pipeline.run(spark, folder).collect()))
    by = collections.defaultdict(list)
    for r in out:
        assert r.size == len(r.text.split()) and r.taken == r.repeats * r.size and 0 <= r.repeats <= 2
        by[r.source].append(r)
    for held in by.values():
        assert held[0].source_size == sum(r.size for r in held)
        assert abs(sum(r.taken for r in held) - held[0].target) <= max(r.size for r in held)
    assert {300, 201, 202, 203, 204}.isdisjoint({r.doc_id for r in out})


def test_empty_table(spark, folder, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_of_each_with_repeated_ids(spark):
    a, b = prose(EN, 90, 3), prose(FR, 90, 4)
    held = [(5, a), (5, b), (5, b), (2, a), (None, None), (None, ""), (7, b), (None, "x")]
    docs = spark.createDataFrame([(i, t, {"m": 1}) for i, t in held], "doc_id long, text string, k map<string,int>")
    out = one_of_each(docs, near_duplicates(docs)).where(F.col("k").isNotNull())
    found = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert found[2, a] == 1 and found[5, b] == 1 and found[None, "x"] == 1 and sum(found.values()) == 4
