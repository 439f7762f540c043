"""Registered queries op1 to op13 and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import (
    ann,
    decontam,
    filter_audit,
    kd_search,
    langid,
    lexical,
    mixing,
    preference,
    secret_scan,
    simhash,
    substring,
    toxicity,
    warc,
)
from panelcast.runtime import cut_lineage, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(parts: int, held: int):
    """Whether a document is kept out of training; one without id is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == held, F.lit(True))


@_query
def op2_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~_held_out(4, 2)))
    return langid.identify(docs, model).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


@_query
def op8_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(_table(spark, sf_dir, "documents"), mixing.Mix())
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op8_water_filling"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END)::DOUBLE AS w,
    (2 * source_size)::DOUBLE AS cap
  FROM sources
), filled AS (
  SELECT *, 1.5 * sum(source_size) OVER ()::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM weighed
), level AS (
  SELECT max(left_over / rest) AS share FROM filled WHERE left_over / rest * w < cap
), targets AS (
  SELECT source, source_size, CASE WHEN share IS NULL OR cap <= share * w THEN cap ELSE share * w END AS target
  FROM weighed CROSS JOIN level
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets
), placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS extra,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.doc_id IS NULL,
      ('0x' || substr(md5('mix:' || s.doc_id), 1, 15))::BIGINT, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN extra > 0 AND 2 * past + size <= 2 * extra THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    records = warc.first_of_equal(_table(spark, sf_dir, "pages"), min_bytes=0)
    archives = cut_lineage(warc.write_warc(records, folder))
    read = warc.read_warc(archives, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op10_warc"] = """
WITH own AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
first AS (SELECT hex, min(page_id) AS first FROM own GROUP BY hex)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(own.hex, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM own JOIN first ON own.hex = first.hex
"""


@_query
def op6_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.without_repeats(_table(spark, sf_dir, "documents"), substring.Repeats())
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op6_super_kmers"] = r"""
WITH split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM split
), windows AS (
  SELECT doc_id, i, n, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS w
  FROM placed
), whole AS (
  SELECT doc_id, i, w FROM windows WHERE i + 50 <= n
), first AS (
  SELECT w, min(doc_id) AS first FROM whole GROUP BY w
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM whole JOIN first USING (w) WHERE doc_id > first
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept
  FROM placed ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT s.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""


@_query
def op4_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs.where(~_held_out(5, 0)), _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", _held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query
def op9_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"), secret_scan.ForestParams())
    return found.select("doc_id", "start", F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


@_query
def op5_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "overlap", "answer")


@_query
def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)[0]


@_query
def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with an earlier answer as the last one."""
    held = preference.turns_of(_table(spark, sf_dir, "conversations"))
    pairs = held.select("conv_id", F.col("turns").alias("chosen"), preference.rejected_turns(F.col("turns")).alias("rejected"))
    spans = {
        c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))))
        for c in ("chosen_spans", "rejected_spans")
    }
    return preference.preferences(pairs).withColumns(spans).withColumn("prompt_turns", F.col("prompt_turns").cast("long"))


ORACLES["op1_preferences"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), answers AS (
  SELECT conv_id, i AS last, lag(text) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
    row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS r
  FROM turns WHERE role = 'assistant'
), pairs AS (
  SELECT t.*, last, CASE WHEN i = last THEN coalesce(earlier, '') ELSE text END AS other, last IS NULL OR i <= last AS has_other
  FROM turns t LEFT JOIN (FROM answers WHERE r = 1) a USING (conv_id)
), prefix AS (
  SELECT conv_id, coalesce(min(i) FILTER (NOT has_other OR text <> other), count(*) + 1) - 1 AS prompt_turns
  FROM pairs GROUP BY conv_id
), sides AS (
  SELECT conv_id, i, i <= prompt_turns AS shared, true AS chosen, role, text FROM pairs JOIN prefix USING (conv_id)
  UNION ALL
  SELECT conv_id, i, false, false, role, other FROM pairs JOIN prefix USING (conv_id) WHERE has_other AND i > prompt_turns
), placed AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
    sum(length(role) + length(text) + 13) OVER (PARTITION BY conv_id, shared, chosen ORDER BY i) AS stop
  FROM sides
), merged AS (
  SELECT conv_id,
    string_agg(rendered, '' ORDER BY i) FILTER (shared) AS prompt,
    string_agg(rendered, '' ORDER BY i) FILTER (chosen AND NOT shared) AS chosen,
    string_agg(rendered, '' ORDER BY i) FILTER (NOT chosen) AS rejected,
    string_agg((stop - length(text) - 8)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY i)
      FILTER (chosen AND NOT shared AND role = 'assistant') AS chosen_spans,
    string_agg((stop - length(text) - 8)::BIGINT || '-' || stop::BIGINT, ',' ORDER BY i)
      FILTER (NOT chosen AND role = 'assistant') AS rejected_spans
  FROM placed GROUP BY conv_id
)
SELECT conv_id, prompt_turns::BIGINT AS prompt_turns, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen,
  coalesce(chosen_spans, '') AS chosen_spans, coalesce(rejected, '') AS rejected, coalesce(rejected_spans, '') AS rejected_spans,
  chosen IS NOT NULL OR rejected IS NOT NULL AS differ
FROM merged JOIN prefix USING (conv_id)
"""


@_query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_ORDERS = ", ".join(f"('{o}', {i}, {own}, {before})" for o, i, own, before in filter_audit.orders())

ORACLES["op12_filter_audit"] = rf"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), failed AS (
  SELECT doc_id, part, (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS fails
  FROM words
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), sets AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), orders (filter_order, step, own, before) AS (VALUES {_ORDERS})
SELECT part, filter_order, step::INT AS step,
  coalesce(sum(n) FILTER (fails & own = 0 AND fails & before = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (fails & own <> 0 AND fails & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (fails & own <> 0 AND fails & before <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (fails & own <> 0 AND fails & before = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (fails & own <> 0 AND fails & before = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(120 * n // greatest(bit_count(fails::INT), 1)) FILTER (fails & own <> 0), 0)::BIGINT AS shapley
FROM sets CROSS JOIN orders GROUP BY part, filter_order, step
"""


@_query
def op13_kd_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op13_kd_products"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20
"""


@_query
def op11_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

ORACLES["op11_max_sketches"] = f"""
WITH counted AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY ALL
), sizes AS (
  SELECT doc_id, sum(tf)::BIGINT AS n_terms FROM counted GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS n_docs, sum(n_terms)::BIGINT AS all_terms FROM sizes
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term) CROSS JOIN corpus
), asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} FROM benchmark)
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n_terms * n_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) CROSS JOIN corpus
  GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
