"""Toxicity by subword bags: words are means of character n-gram vectors, texts are means of words.

Vectors and the linear softmax on top are trained together. A misspelling that training never saw
shares most n-grams with the word it stands for, and so most of its vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import mix, slices, utf8, word_bounds, word_hashes

# A-Z are lower-cased; punctuation counts inside words only; other bytes stay
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[:33] = _FOLD[127] = 32
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class SubwordParams:
    rows_per_class: int = 2500  # about as many labelled rows of each class train the model
    chars_per_class: int = 8_000_000  # and about as many characters, in texts of any length
    least_texts: int = 2  # words of fewer training texts get no gradient
    buckets: int = 1 << 16
    shortest: int = 3
    longest: int = 5
    dims: int = 8
    steps: int = 80
    rate: float = 0.05
    decay: float = 1e-4
    scale: float = 100.0  # of a text's mean vector: one word in many must be able to decide
    seed: int = 11


@dataclass
class Subwords:
    value: np.ndarray  # per bucket: what it adds to the second class's log odds
    bias: float
    params: SubwordParams


def stream(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with a space before each text and at the end, and where each text begins."""
    out = np.full(len(data) + len(at), 32, np.uint8)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out[np.arange(len(data)) + text + 1] = _FOLD[data]
    mark, gap = _MARK[out], out == 32
    edge = mark.copy()
    edge[1:-1] &= gap[:-2] | gap[2:] | mark[:-2] | mark[2:]
    out[edge] = 32
    return out, at + np.arange(1, len(at) + 1)


def gram_buckets(text: np.ndarray, n: int, params: SubwordParams) -> np.ndarray:
    """The bucket of the n bytes at each place of a stream."""
    h = np.full(max(len(text) - n + 1, 0), n, np.uint64)
    for k in range(n):
        h = h * _STEP + text[k : k + len(h)]
    return (mix(h) % np.uint64(params.buckets)).astype(np.int32)


def word_buckets(hashes: np.ndarray, params: SubwordParams) -> np.ndarray:
    return (mix(hashes ^ _STEP) % np.uint64(params.buckets)).astype(np.int32)


def train(column: pa.Array, labels: np.ndarray, params: SubwordParams = SubwordParams()) -> Subwords:
    """Fit n-gram vectors and softmax by Adam on all texts at a time."""
    text_bytes, at = stream(*utf8(column))
    starts, ends, before = word_bounds(text_bytes, at)
    hashes = word_hashes(text_bytes, starts, ends)
    text = np.repeat(np.arange(len(at) - 1), np.diff(before))
    words, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    cell, amount = np.unique(text * len(words) + word, return_counts=True)
    frequent = np.bincount(cell % len(words), minlength=len(words)) >= params.least_texts
    number = np.cumsum(frequent) - 1
    share = (amount / np.maximum(np.diff(before), 1)[cell // len(words)])[frequent[cell % len(words)]]
    cell = cell[frequent[cell % len(words)]]
    text, word = cell // len(words), number[cell % len(words)]
    starts, ends, words = starts[first[frequent]], ends[first[frequent]], words[frequent]
    n_words, n_texts = len(words), len(at) - 1
    gram, of_word = [word_buckets(words, params)], [np.arange(n_words)]
    for n in range(params.shortest, params.longest + 1):
        count = np.maximum(ends - starts + 3 - n, 0)
        of = np.repeat(np.arange(n_words), count)
        place = np.repeat(starts - 1 - (np.cumsum(count) - count), count) + np.arange(len(of))
        gram.append(gram_buckets(text_bytes, n, params)[place])
        of_word.append(of)
    gram, of_word = np.concatenate(gram), np.concatenate(of_word)
    per_word = np.bincount(of_word, minlength=n_words).astype(np.float32)[:, None]
    share = share.astype(np.float32)[:, None]
    rng = np.random.default_rng(params.seed)
    vectors = rng.normal(0, 0.1, (params.buckets, params.dims)).astype(np.float32)
    top = rng.normal(0, 0.1, (params.dims, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    weight = (0.5 / np.maximum(np.bincount(labels, minlength=2), 1))[labels].astype(np.float32)[:, None]

    def summed(rows, at, n):
        return np.stack([np.bincount(at, rows[:, d], n) for d in range(rows.shape[1])], axis=1).astype(np.float32)

    state = [np.zeros_like(v) for v in (vectors, vectors, top, top, bias, bias)]
    for t in range(1, params.steps + 1):
        of = summed(vectors[gram], of_word, n_words) / np.maximum(per_word, 1)
        mean = summed(of[word] * share, text, n_texts) * np.float32(params.scale)
        logits = mean @ top + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        slope = (odds / odds.sum(axis=1, keepdims=True) - target) * weight
        back = (slope @ top.T) * np.float32(params.scale)
        back = summed(back[text] * share, word, n_words) / np.maximum(per_word, 1)
        gradients = (summed(back[of_word], gram, params.buckets), mean.T @ slope, slope.sum(axis=0))
        for k, (v, g) in enumerate(zip((vectors, top, bias), gradients)):
            g = g + params.decay * v
            state[2 * k] += 0.1 * (g - state[2 * k])
            state[2 * k + 1] += 0.001 * (g**2 - state[2 * k + 1])
            v -= params.rate * (state[2 * k] / (1 - 0.9**t)) / (np.sqrt(state[2 * k + 1] / (1 - 0.999**t)) + 1e-8)
    value = vectors @ (top[:, 1] - top[:, 0]) * params.scale
    return Subwords(value.astype(np.float32), float(bias[1] - bias[0]), params)


def fit(docs: DataFrame, labels: DataFrame, params: SubwordParams = SubwordParams()) -> Subwords:
    """Train on a bounded sample of ``docs`` (doc_id, text, …) with ``labels`` (doc_id, toxic, …).

    About ``rows_per_class`` rows of each class, or fewer if these would have more characters than
    ``chars_per_class``, are chosen by a hash of doc_id, whatever their lengths; only their ids meet
    the texts. Rows without text, label or doc_id do not count, nor do labels other than 0 and 1, and
    an id labelled twice counts as toxic. Without rows of both classes every score is the share of
    class 1, or 0.5 if there are none at all.
    """
    own = docs.where("text IS NOT NULL AND doc_id IS NOT NULL")
    marks = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    lengths = own.groupBy("doc_id").agg(F.sum(F.length("text")).alias("chars"))
    marked = marks.join(lengths, "doc_id")
    counts = marked.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()
    if len(counts) < 2:
        bias = {(): 0.0, (0,): -30.0, (1,): 30.0}[tuple(r["toxic"] for r in counts)]
        return Subwords(np.zeros(params.buckets, np.float32), bias, params)
    shares = {r["toxic"]: min(1.0, params.rows_per_class / r["n"], params.chars_per_class / max(r["chars"], 1)) for r in counts}
    share = F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(params.seed)), F.lit(1 << 30)) < share * (1 << 30)
    # at most some thousand ids, whatever the input
    sample = own.select("doc_id", "text").join(F.broadcast(marked.where(drawn).select("doc_id", "toxic")), "doc_id").toArrow()
    sample = sample.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return train(sample["text"].combine_chunks(), sample["toxic"].to_numpy().astype(int), params)


def logits(data: np.ndarray, at: np.ndarray, model: Subwords) -> np.ndarray:
    """Log odds of each text: the mean over its words of the mean over their n-grams."""
    text, at = stream(data, at)
    starts, ends, before = word_bounds(text, at)
    total = model.value[word_buckets(word_hashes(text, starts, ends), model.params)].astype(float)
    count = np.ones(len(starts))
    for n in range(model.params.shortest, model.params.longest + 1):
        sums = np.concatenate([[0.0], np.cumsum(model.value[gram_buckets(text, n, model.params)], dtype=float)])
        grams = np.maximum(ends - starts + 3 - n, 0)
        total += sums[np.minimum(starts - 1 + grams, len(sums) - 1)] - sums[np.minimum(starts - 1, len(sums) - 1)]
        count += grams
    sums = np.concatenate([[0.0], np.cumsum(total / count)])
    return (sums[before[1:]] - sums[before[:-1]]) / np.maximum(np.diff(before), 1) + model.bias


def score(docs: DataFrame, model: Subwords) -> DataFrame:
    """(doc_id, score) of each row of ``docs`` (doc_id, text, …): the softmax's share of class 1.

    Null texts and texts without words get the score of the bias alone.
    """

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column(1))
            odds = [logits(data[at[a] : at[b]], at[a : b + 1] - at[a], model) for a, b in slices(at, 1 << 20)]
            shares = 1 / (1 + np.exp(-np.clip(np.concatenate(odds or [np.zeros(0)]), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shares)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
