"""Language identification by error-correcting output codes over hashed byte n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.llm.words import mix, slices, utf8

PAIRS, TRIPLES = 1024, 3072  # hashed byte pairs and triples
FEATURES = PAIRS + TRIPLES
_PIECE = 1 << 20  # bytes of text counted at a time
_ROWS = 128  # texts counted at a time

# what is no letter separates; A-Z are lower-cased; bytes of other characters stay
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_GAP = np.full(1, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class CodeParams:
    sample_rows: int = 3000  # about as many labelled rows train the classifiers, shared by the languages
    least_per_language: int = 20
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-5
    sharpness: float = 4.0
    ambiguous_margin: float = 0.25  # between the two best scores
    seed: int = 7


@dataclass
class LanguageCode:
    languages: list[str]
    code: np.ndarray  # languages × bits, -1 or 1
    weights: np.ndarray  # features × bits
    bias: np.ndarray
    trust: np.ndarray  # languages × bits: how far a bit is right about a language; rows sum to 1
    params: CodeParams


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A codeword per language: every split of few languages, else the widest of random codes."""
    if n == 0:
        return np.zeros((0, 0))
    if n <= 6:
        columns = [c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, float).T.reshape(n, len(columns))
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    tries = [rng.choice([-1.0, 1.0], (n, bits)) for _ in range(50)]
    return max(tries, key=lambda c: (bits - (c @ c.T - 2 * bits * np.eye(n)).max()) / 2)


def ngram_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed byte pairs and triples around each letter, one row for each text."""
    n = len(at) - 1
    counts = np.zeros(n * FEATURES)
    for first in range(0, len(data), _PIECE):
        last = min(first + _PIECE, len(data))
        # the piece with what stands around it, so that its ends count as inside
        around = [_GAP, _GAP, data[max(first - 2, 0) : last + 1], _GAP]
        piece = np.concatenate(around)
        capital = (piece[1:] >= 0x80) & (piece[1:] <= 0x9E) & (piece[1:] != 0x97) & (piece[:-1] == 0xC3)
        text = _FOLD[piece].astype(np.uint32)
        text[1:][capital] += 0x20
        text = text[1 + min(first, 2) :][: last - first + 2]
        left, mid, right = text[:-2], text[1:-1], text[2:]
        where = np.arange(first, last)
        row = np.searchsorted(at, where, side="right") - 1
        left, right = np.where(where == at[row], 32, left), np.where(where + 1 == at[row + 1], 32, right)
        letter = mid != 32
        base = row[letter] * FEATURES
        left, mid, right = (x[letter].astype(np.uint64) for x in (left, mid, right))
        pairs = mix(left << np.uint64(8) | mid) % np.uint64(PAIRS)
        triples = mix(left << np.uint64(16) | mid << np.uint64(8) | right) % np.uint64(TRIPLES) + np.uint64(PAIRS)
        for found in (pairs, triples):
            counts += np.bincount(base + found.astype(np.int64), minlength=len(counts))
    return counts.reshape(n, FEATURES)


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Root of each n-gram's share: unit vectors, or zero without letters."""
    counts = ngram_counts(data, at)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def pieces(column: pa.Array):
    """(first row, features) of a few texts at a time."""
    data, at = utf8(column)
    for low, high in slices(at, _PIECE):
        for a in range(low, high, _ROWS):
            b = min(a + _ROWS, high)
            yield a, features(data[at[a] : at[b]], at[a : b + 1] - at[a])


def fit(labelled: DataFrame, params: CodeParams = CodeParams()) -> LanguageCode:
    """Train on a bounded sample of (doc_id, text, lang); rows without lang or text do not count.

    Each language gives about ``sample_rows`` / languages rows, but all if it has fewer; rows are
    chosen by a hash of doc_id. Counts of all rows reach the driver, one number per language.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    code = codewords(len(languages), params.seed)
    bits = code.shape[1] if languages else 0
    if len(languages) < 2:
        empty = np.zeros((FEATURES, bits))
        return LanguageCode(languages, code, empty, np.zeros(bits), np.ones((len(languages), max(bits, 1))), params)
    each = max(params.least_per_language, params.sample_rows // len(languages))
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, each / sizes[k]))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(params.seed)), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)

    def run(batches):
        for batch in batches:
            for first, found in pieces(batch.column(1)):
                at, used = np.nonzero(found)
                split = np.searchsorted(at, np.arange(1, len(found)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(found)),
                        pa.array(np.split(used.astype(np.int16), split), pa.list_(pa.int16())),
                        pa.array(np.split(found[at, used], split), pa.list_(pa.float32())),
                        batch.column(2).slice(first, len(found)),
                    ],
                    ["doc_id", "used", "share", "lang"],
                )

    sample = rows.where(drawn).select(F.col("doc_id").cast("long"), "text", "lang")
    table = sample.mapInArrow(run, "doc_id long, used array<short>, share array<float>, lang string").toArrow()
    table = table.sort_by("doc_id")
    x = np.zeros((table.num_rows, FEATURES), np.float32)
    for i, (used, found) in enumerate(zip(table["used"], table["share"])):
        x[i, used.values.to_numpy()] = found.values.to_numpy()
    label = np.array([languages.index(v) for v in table["lang"].to_pylist()], int)
    return _trained(x, label, languages, code, params)


def _trained(x, label, languages, code, params) -> LanguageCode:
    """One logistic classifier per bit, all together, by Adam on the whole sample."""
    y = code[label].astype(np.float32)
    weight = (1 / np.bincount(label, minlength=len(languages))[label]).astype(np.float32)[:, None] / len(languages)
    w, b = np.zeros((FEATURES, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    state = [np.zeros_like(v) for v in (w, w, b, b)]
    for t in range(1, params.steps + 1):
        slope = -y * weight / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        for k, (value, grad) in enumerate(((w, x.T @ slope + params.decay * w), (b, slope.sum(axis=0)))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            value -= params.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    right = (np.sign(x @ w + b) == y).astype(float)
    trust = np.stack([right[label == k].mean(axis=0) if (label == k).any() else np.ones(y.shape[1]) for k in range(len(languages))])
    trust /= np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return LanguageCode(languages, code, w, b, trust, params)


def decoded(model: LanguageCode, x: np.ndarray) -> np.ndarray:
    """A share per language: nearer codewords, by trust-weighted logistic loss, weigh more."""
    margin = np.clip(x @ model.weights + model.bias, -30, 30)
    loss = np.stack([np.log1p(np.exp(-margin * c)) @ t for c, t in zip(model.code, model.trust)], axis=1)
    share = np.exp(-model.params.sharpness * (loss - loss.min(axis=1, keepdims=True)))
    return share / share.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def identify(docs: DataFrame, model: LanguageCode, rows: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of each row of ``docs`` (doc_id, text, …).

    Texts that are null or have no letter, and all texts if no language was learned, are ``und`` with
    score 0, not ambiguous. Equal scores go to the language first in order. ``ambiguous``: the best
    score leads by less than ``ambiguous_margin``. A learned single language gets score 1.
    With ``rows``, the column ``row`` holds the whole row as it came.
    """

    def run(batches):
        for batch in batches:
            for first, x in pieces(batch.column(1)):
                texts = batch.column(1).slice(first, len(x))
                und = ~pc.match_substring_regex(texts, "[A-Za-z]").fill_null(False).to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(und):
                    und[i] = not has_letter(texts[int(i)].as_py())
                n = len(model.languages)
                if n == 0:
                    und[:] = True
                share = decoded(model, x) if n > 1 else np.ones((len(x), 1))
                best, ranked = share.argmax(axis=1), np.sort(share, axis=1)
                lead = ranked[:, -1] - ranked[:, -2] if n > 1 else np.ones(len(x))
                names = np.array([*model.languages, "und"], object)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(x)),
                        pa.array(names[np.where(und, n, best)], pa.string()),
                        pa.array(np.where(und, 0.0, ranked[:, -1])),
                        pa.array((lead < model.params.ambiguous_margin) & ~und),
                        *(c.slice(first, len(x)) for c in batch.columns[2:]),
                    ],
                    ["doc_id", "lang_pred", "score", "ambiguous", *batch.schema.names[2:]],
                )

    own = docs.select(F.col("doc_id").cast("long"), "text", *([F.struct("*").alias("row")] if rows else []))
    made = "doc_id long, lang_pred string, score double, ambiguous boolean"
    schema = StructType([*StructType.fromDDL(made), *own.schema[2:]])
    return own.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: LanguageCode) -> DataFrame:
    """The rows of ``docs`` in a learned language that is beyond doubt; texts and columns stay.

    Rejected are texts that are null or have no letter, and ambiguous ones.
    """
    return identify(docs, model, rows=True).where("lang_pred <> 'und' AND NOT ambiguous").select("row.*")

