import random
import re
from itertools import permutations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelcast.llm import filter_audit as audit

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for i, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        first = [j for j, t, *_ in rows if (t or "") == text and j is not None]
        fails.append((i, lang or "", {
            f for f, bad in {
                "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                "E": any(i is None or j < i for j in first),
            }.items() if bad
        }))
    out = {}
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        removed_at = {}
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [i for i, s in left if f in s]
                rest = [(i, s) for i, s in left if f not in s]
                row = [len(rest), len(gone), sum(f in s for _, s in own) - len(gone), sum(s == {f} for _, s in own),
                       sum(i in good for i in gone), sum(i in toxic for i in gone)]
                out[part, "".join(order), step] = row
                removed_at[f] = removed_at.get(f, 0) + len(gone)
                left = rest
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_at[order[step - 1]])
    return out


def got(spark, rows, labels, **kw):
    found = audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), audit.AuditParams(**kw))
    return {tuple(r)[:3]: list(r)[3:] for r in found.collect()}


def documents(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "été", "A", "NASA", "ab cd", "x|y", "#tag"]
    out = []
    for i in range(n):
        size = rng.choice([0, 3, 199, 200, 260, 900])
        words = rng.choices(vocabulary if rng.random() < 0.5 else vocabulary[:300], k=size)
        if rng.random() < 0.3:
            words = [w.upper() for w in words[:120]] + words[:150]
        out.append((i * 3 % 101, rng.choice([" ", "\n", "\t \x0b"]).join(words), rng.choice(["en", "de", "", None])))
    return out + [(500 + i, out[0][1], "en") for i in range(5)]


@pytest.mark.parametrize("seed,shard_bytes", [(1, 4 << 20), (2, 700)])
def test_report_equals_brute_force(spark, seed, shard_bytes):
    rows = documents(seed, 60)
    rows += [(None, rows[3][1], "en"), (None, "only here", None), (7, None, "de"), (900, "", "de"), (7, "twice", "en"), (7, "twice", "en")]
    labels = [(r[0], i % 2, i % 3 % 2) for i, r in enumerate(rows) if i % 4] + [(None, 1, 1), (9, None, None), (4242, 1, 1)]
    seen = {}
    for i, q, t in labels:  # several rows of a document count once
        old = seen.get(i, (0, 0))
        seen[i] = (max(old[0], q or 0), max(old[1], t or 0))
    want = brute(rows, [(i, *m) for i, m in seen.items() if i is not None])
    assert got(spark, rows, labels, shard_bytes=shard_bytes, bucket_words=shard_bytes) == want


def test_matrix_has_one_number_per_word_and_exact_cells(spark):
    rows = [(1, "a b a", "x"), (2, None, "x"), (3, "b c  c\nc é", "x"), (4, " ", "x"), (5, "word " * 30_000 + "a", "x")]
    shards, known = audit.document_terms(spark.createDataFrame(rows, DOCS).repartition(2), audit.AuditParams(shard_bytes=8, bucket_words=2))
    words = {r.id: r.word for r in known.collect()}
    assert sorted(words) == list(range(len(words))) and len(set(words.values())) == len(words) == 5
    cells = {}
    for s in shards.collect():
        for i, row in enumerate(s.rows):
            span = range(s.indptr[i], s.indptr[i + 1])
            cells[row.doc_id] = {words[s.indices[j]]: s.counts[j] for j in span}
    assert cells == {1: {"a": 2, "b": 1}, 2: {}, 3: {"b": 1, "c": 3, "é": 1}, 4: {}, 5: {"word": 30_000, "a": 1}}


def test_empty_tables_and_other_columns(spark):
    labels = spark.createDataFrame([], LABELS)
    assert audit.audit(spark.createDataFrame([], DOCS), labels).collect() == []
    schema = DOCS + ", part string, digest int, shard long, rows int, words string, n long, first int, bits int"
    rows = [(1, "one", None, "x", 1, 2, 3, "w", 4, 5, 6)]
    found = audit.audit(spark.createDataFrame(rows, schema), labels).collect()
    assert len(found) == 600 and {r.part for r in found} == {""}
    assert sum(r.shapley for r in found if r.filter_order == "ABCDE") == 120


def test_stored_shards_are_read_one_at_a_time(spark, monkeypatch):
    """A task that reads a stage holds a row group, so a row group must not hold many shards."""
    stored, cut = [], audit.cut_lineage

    def kept(df, *args, **named):
        stored.append(cut(df, *args, **named))
        return stored[-1]

    monkeypatch.setattr(audit, "cut_lineage", kept)
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(2000)), lambda i: F.md5(F.concat_ws("-", i, "id"))))
    docs = spark.range(60).coalesce(1).select(text.alias("text"), F.col("id").alias("doc_id"))
    shards, words = audit.document_terms(docs, audit.AuditParams(shard_bytes=1 << 16))
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in stored[0].inputFiles()]
    rows = [m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)]
    assert sum(rows) == 60 and max(rows) <= 3
    assert shards.count() == 60 and words.count() == 60 * 2001
