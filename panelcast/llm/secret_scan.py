"""Secret scan: wide patterns find candidates, a random forest removes the false ones.

DataFrame operations and Spark ML only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import GAP
from panelcast.runtime import cut_lineage

# a long run of key characters with a digit in it or an issuer's mark, or whatever is assigned to a telling name
RUN = r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{16,}+={0,2}"
NAMED = r"((?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[ \t]*[:=][ \t]*[\"']?)([A-Za-z0-9+/_.~!@#$%^&*=-]{8,})"
NAME_BEFORE = r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|bearer|credential)"
ISSUED = "^(?:AKIA|ASIA|gh[pousr]_|xox[abp]-|AIza)"
MASK = "[SECRET]"
CUT, NOT_CUT = "\x01", "\x02"  # no value holds either

FEATURES = (
    "length", "digits", "uppers", "lowers", "letter_digit", "case_changes", "marks", "distinct", "hex",
    "coverage", "slashes", "dots", "in_path", "assigned", "quoted", "named", "sentence",
)


@dataclass(frozen=True)
class ForestParams:
    trees: int = 40
    depth: int = 8
    sample_rows: int = 20_000  # about as many labelled findings train the forest
    dictionary_count: int = 10  # a word that occurs so often is in the dictionary
    threshold: float = 0.5
    seed: int = 5


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text (rows are told apart by both) and the text, of rows with a text."""
    return docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), "text")


def places(text: Column, pattern: str, replacement: str) -> Column:
    """(value, start) of every match, in order, from texts without CUT; start counts from 1.

    ``replacement`` puts CUT around a value, so that every other part of the text is one. A fold adds
    up the parts' lengths.
    """
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(replacement)), CUT, -1)
    none = F.expr("cast(array() as array<struct<value:string,start:bigint>>)")
    empty = F.struct(F.lit(1).cast("long").alias("at"), F.lit(False).alias("is_value"), none.alias("found"))

    def step(acc: Column, part: Column) -> Column:
        value = F.array(F.struct(part.alias("value"), acc["at"].alias("start")))
        found = F.when(acc["is_value"], F.concat(acc["found"], value)).otherwise(acc["found"])
        return F.struct((acc["at"] + F.length(part)).alias("at"), (~acc["is_value"]).alias("is_value"), found.alias("found"))

    return F.aggregate(parts, empty, step, lambda acc: acc["found"])


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, value, start, before, after): the candidates of each ``keyed`` row, one per place.

    ``start`` counts from 1; ``before`` and ``after`` are 48 characters around the value. A value that
    stands in several places is a candidate in each; what both patterns find in one place is one.
    """
    text = F.col("text")
    bare = F.replace(text, F.lit(CUT), F.lit(NOT_CUT))
    runs = F.filter(places(bare, RUN, f"{CUT}$0{CUT}"), lambda f: f["value"].rlike(f"[0-9]|{ISSUED}"))
    named = places(bare, NAMED, f"$1{CUT}$2{CUT}")

    def around(f: Column) -> Column:
        begin = F.greatest(f["start"] - 48, F.lit(1)).cast("int")
        at, size = f["start"].cast("int"), F.length(f["value"])
        return F.struct(
            f["value"].alias("value"),
            f["start"].alias("start"),
            F.substr(text, begin, at - begin).alias("before"),
            F.substr(text, at + size, F.lit(48)).alias("after"),
        )

    found = F.transform(F.array_distinct(F.concat(runs, named)), around)
    # outer, so that no filter repeats the patterns ahead of it
    return docs.select("doc_id", "hash", F.explode_outer(found).alias("f")).where("f IS NOT NULL").select("doc_id", "hash", "f.*")


def dictionary(docs: DataFrame, least: int) -> DataFrame:
    """(piece): lower-case ASCII words that occur at least ``least`` times in all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), GAP)).alias("w"))
    bare = F.regexp_extract("w", r"^[^a-z0-9]*([a-z]{3,20})[^a-z0-9]*$", 1)
    counted = words.groupBy("w").agg(F.count("*").alias("n")).select(bare.alias("piece"), "n").where("piece <> ''")
    return counted.groupBy("piece").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("piece")


def coverage(values: DataFrame, words: DataFrame) -> DataFrame:
    """(value, coverage): the share of a value's letters in runs that are dictionary words."""
    pieces = F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0)))
    split = values.select("value").distinct().select("value", pieces.alias("piece"))
    held = split.join(words.withColumn("known", F.lit(1)), "piece", "left")
    known = F.sum(F.when(F.col("known") == 1, F.length("piece")).otherwise(0))
    return held.groupBy("value").agg((known / F.sum(F.length("piece"))).alias("coverage"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``candidates`` with the columns FEATURES, all doubles."""
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    size = F.length(v)

    def share(pattern: str) -> Column:
        return F.regexp_count(v, F.lit(pattern)) / size

    made = {
        "length": size,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "letter_digit": share("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"),
        "case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "marks": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / size,
        "hex": v.rlike("^[0-9a-fA-F]+$"),
        "slashes": F.regexp_count(v, F.lit("/")),
        "dots": F.regexp_count(v, F.lit("[.]")),
        "in_path": before.rlike(r"(?:[/@\\]|://|www[.])$") | v.rlike(r"^[./~]"),
        "assigned": before.rlike(r"[:=][ \t]*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "named": before.rlike(NAME_BEFORE),
        "sentence": before.rlike(r"[a-z]{2,}[.,]?[ \n]+$"),
    }
    out = found.withColumns({k: c.cast("double") for k, c in made.items()})
    return out.join(coverage(found, words), "value", "left").fillna({"coverage": 0.0})


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` with ``label`` where a strict rule is sure, else null.

    1: a cloud access key id, a token of a known issuer, a signed token's start, or mixed letters and digits assigned to a telling name. 0: host and file names, plain numbers, and
    values that the text calls an example.
    """
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    issued = v.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abp]-|^eyJ[A-Za-z0-9_-]+[.]eyJ|^AIza[0-9A-Za-z_-]{35}$")
    given = before.rlike(NAME_BEFORE + r"[\"']?[ \t]*[:=][ \t]*[\"']?$") & v.rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]") & ~v.rlike("[.][A-Za-z]{2,}$")
    plain = v.rlike(r"^[0-9.+/_-]+$|^[.]{0,2}/") | v.rlike(r"^[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)*[.][A-Za-z]{2,6}[.]?$") | before.rlike(r"(?:://|@|www[.])[^ ]*$")
    example = (F.concat(before, after)).rlike(r"(?i)\b(?:placeholder|dummy|changeme)\b")
    label = F.when(plain | example, 0.0).when(issued | given, 1.0)
    return found.withColumn("label", label)


class Forest:
    """A fitted forest, or the one class there was."""

    def __init__(self, model=None, constant: float = 0.0):
        self.model, self.constant = model, constant

    def probability(self, found: DataFrame) -> DataFrame:
        if self.model is None:
            return found.withColumn("probability", F.lit(self.constant))
        held = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
        scored = self.model.transform(held).withColumn("probability", vector_to_array("probability")[1])
        return scored.select(*found.columns, "probability")


def fit(labelled: DataFrame, params: ForestParams = ForestParams()) -> Forest:
    """Train on about ``sample_rows`` rows (doc_id, value, start, FEATURES, label) with a label, half of each class.

    Rows are chosen by a hash of value, doc_id and start. With one class only, that class is the answer for
    all; with no labels at all, nothing is a secret.
    """
    rows = labelled.where("label IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Forest(constant=max(sizes, default=0.0))
    each = params.sample_rows / 2
    share = F.when(F.col("label") == 1, min(1.0, each / sizes[1.0])).otherwise(min(1.0, each / sizes[0.0]))
    sample = rows.where(F.pmod(F.xxhash64("value", "doc_id", "start", F.lit(params.seed)), F.lit(1 << 30)) < share * (1 << 30))
    held = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample.select(*FEATURES, "label"))
    # one partition: a bounded sample, and rows in a fixed order give the same trees again
    held = held.repartitionByRange(1, *FEATURES, "label").sortWithinPartitions(*FEATURES, "label").select("features", "label")
    forest = RandomForestClassifier(numTrees=params.trees, maxDepth=params.depth, seed=params.seed, cacheNodeIds=False)
    return Forest(forest.fit(held))


def scan(docs: DataFrame, params: ForestParams = ForestParams(), labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, hash, value, start, probability, is_secret): one row for each place of a candidate.

    ``labelled``: rows (doc_id, value, label) of reviewed findings; where none are given, the sure
    ones of ``weak_labels`` train the forest. A value is judged in each of its places; a reviewed
    finding holds for all places of its value in the document. Null and empty texts have no candidates. Rows with the same doc_id and text, or without
    doc_id and with the same text, give the same rows each.
    """
    own = keyed(docs)
    found = cut_lineage(features(candidates(own), dictionary(own, params.dictionary_count)))
    if labelled is None:
        train = weak_labels(found)
    else:
        marks = labelled.groupBy("doc_id", "value").agg(F.max(F.col("label").cast("double")).alias("label"))
        train = found.join(marks, ["doc_id", "value"])
    scored = fit(train, params).probability(found)
    secret = F.col("probability") >= params.threshold
    return scored.select("doc_id", "hash", "value", "start", "probability", secret.cast("int").alias("is_secret"))


def redacted(docs: DataFrame, findings: DataFrame) -> DataFrame:
    """``docs`` with every occurrence of its secrets masked; other rows and columns stay.

    A value is masked throughout a document if it is judged a secret in any of its places.

    ``n_chars``, if there is one, is counted anew where something was masked.
    """
    # stored: with its size known, Spark broadcasts it if small and does not shuffle the documents
    secrets = cut_lineage(
        findings.where("is_secret = 1")
        .groupBy(F.col("doc_id").alias("held_id"), F.col("hash").alias("held_hash"))
        .agg(F.sort_array(F.collect_set(F.struct((-F.length("value")).alias("k"), "value"))).alias("held"))
    )
    # whole rows travel as one struct, so no column of theirs can clash
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    same = F.col("doc").eqNullSafe(F.col("held_id")) & (F.col("hash") == F.col("held_hash"))
    masked = F.aggregate("held", F.col("row")["text"], lambda t, s: F.replace(t, s["value"], F.lit(MASK)))
    rows = own.join(secrets, same, "left").select("row", "held", F.when(F.col("held").isNull(), F.col("row")["text"]).otherwise(masked).alias("clean"))

    def column(name: str) -> Column:
        old = F.col("row").getField(name)
        if name.lower() == "text":
            return F.col("clean").alias(name)
        if name.lower() == "n_chars":
            counted = F.when(F.col("held").isNull(), old).otherwise(F.length("clean"))
            return counted.cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return rows.select(*[column(c) for c in docs.columns])
