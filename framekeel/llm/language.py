"""Language identification by averaged subword embeddings and a linear softmax.

Every run of 2 to 4 bytes inside a word, its edges included, is hashed to one of ``BUCKETS`` embeddings. A text is
the mean of its embeddings, and a linear layer with a softmax gives the languages' probabilities. Both are trained
together by stochastic gradient descent in numpy on the driver, on about ``SAMPLE_PER_LANGUAGE`` distinct labelled
texts of each language, or an even share of ``SAMPLE`` if there are many languages, whole texts, of which the tasks
send counts per bucket. A fifth of them is kept aside to fit
the softmax's temperature, so the score is a probability that can be relied on, and to find the score from which
on predictions are ``ACCURACY`` right; those below it are marked as not ``accepted``. Fewer than ten rows are too few
to keep any aside: then the temperature is 1 and every prediction is accepted.

Prediction adds up one small table of the embeddings' products with the layer, in pieces of whole texts.

A null text, or one without letters, is ``und`` with score 0, as is every text if no labelled row was there to learn
from. Repeated rows and null ids are predicted like others; a null language is not learned from. The language,
source and id are no inputs of a prediction, and other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texthash
from .sampling import evenly, fold, letters, per_class

UNKNOWN = "und"
BITS = 14
BUCKETS = 1 << BITS
ORDERS = (2, 3, 4)
DIMENSIONS = 16
SAMPLE_PER_LANGUAGE = 500
#: Rows that are kept of all languages, dealt evenly; one of each language at least.
SAMPLE = 4000
EPOCHS = 12
RATE = 0.2
ACCURACY = 0.99
PIECE = 1 << 18
_SPACE = 0x20


def gram_buckets(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bucket of the run at every place and whether the run lies inside a word with its edges."""
    wide = raw.astype(np.uint32)
    space = raw == _SPACE
    for order in ORDERS:
        n = len(raw) - order + 1
        if n <= 0:
            continue
        value = wide[:n].copy()
        inside = ~(space[:n] & space[order - 1 :][:n]) if order == 2 else np.ones(n, dtype=bool)
        for k in range(1, order):
            value |= wide[k : k + n] << np.uint32(8 * k)
            if k < order - 1:
                inside &= ~space[k : k + n]
        value = (value ^ np.uint32(order * 0x01000193)) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        yield (value * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), inside


def _pieces(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Overlapping pieces that together hold every run once."""
    over = max(ORDERS) - 1
    for start in range(0, max(1, len(raw) - over), PIECE):
        yield raw[start : start + PIECE + over]


def counts(raw: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in one text."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for k, piece in enumerate(_pieces(raw)):
        last = (k + 1) * PIECE >= len(raw) - max(ORDERS) + 1
        for buckets, inside in gram_buckets(piece):
            own = slice(None) if last else slice(0, PIECE)
            total += np.bincount(buckets[own][inside[own]], minlength=BUCKETS)
    return total


@dataclass(frozen=True)
class Model:
    """``table`` holds a bucket's part in each language's logit; ``threshold`` is the least score to accept."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, raw: np.ndarray) -> np.ndarray:
        seen = counts(raw)
        return self.of_counts(seen[None, :])[0]

    def of_counts(self, seen: np.ndarray) -> np.ndarray:
        mean = seen @ self.table / np.maximum(seen.sum(axis=1, keepdims=True), 1)
        return softmax((mean + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 7) -> Model:
    """Train on rows of buckets, their counts and a language; every fifth row calibrates."""
    languages = sorted({r[2] for r in rows})
    number = {name: k for k, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1, (BUCKETS, DIMENSIONS))
    layer = np.zeros((DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    # Steps shrink with each parameter's own past gradients.
    past = [np.full(p.shape, 1e-8) for p in (vectors, layer, bias)]
    learn = [k for k in range(len(rows)) if k % 5 or len(rows) < 10]
    # A language of which all rows are kept aside would never be learned.
    taught = {rows[k][2] for k in learn}
    learn += [k for k in range(len(rows)) if rows[k][2] not in taught]
    for _ in range(EPOCHS):
        for k in rng.permutation(learn):
            at, n, name = rows[k]
            weight = n / n.sum()
            mean = weight @ vectors[at]
            slope = softmax(mean @ layer + bias)
            slope[number[name]] -= 1
            inner = layer @ slope
            outer = np.outer(mean, slope)
            past[1] += outer**2
            layer -= RATE * outer / np.sqrt(past[1])
            past[2] += slope**2
            bias -= RATE * slope / np.sqrt(past[2])
            change = weight[:, None] * inner
            past[0][at] += change**2
            vectors[at] -= 0.1 * RATE * change / np.sqrt(past[0][at])
    model = Model(languages, (vectors @ layer).astype(np.float32), bias, 1.0, 0.0)
    kept = [k for k in range(len(rows)) if not k % 5 and rows[k][2] in taught] if len(rows) >= 10 else []
    return _calibrated(model, [rows[k] for k in kept], number)


def _calibrated(model: Model, rows: list, number: dict[str, int]) -> Model:
    """The temperature of least loss on ``rows``, and the least score above which ``ACCURACY`` of them are right."""
    if not rows:
        return model
    logits = np.array([(n / n.sum()) @ model.table[at] + model.bias for at, n, _ in rows])
    truth = np.array([number[r[2]] for r in rows])
    own = np.arange(len(rows))

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / t)[own, truth], 1e-12)).mean()

    temperature = float(min(np.geomspace(0.05, 20, 80), key=loss))
    found = softmax(logits / temperature)
    score, right = found.max(axis=1), found.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) >= ACCURACY * np.arange(1, len(rows) + 1))
    threshold = float(score[order[good[-1]]]) if len(good) else 1.0
    return Model(model.languages, model.table, model.bias, temperature, threshold)


def train(docs: DataFrame, learnable) -> Model | None:
    """A model of the rows of ``docs`` with a language and letters for which ``learnable`` holds."""
    known = docs.where(learnable & F.col("lang").isNotNull())
    known = known.select(F.col("lang").cast("string").alias("lang"), letters(F.col("text")).alias("text"))
    sample = per_class(known.where(F.length("text") > 2), "lang", F.col("text"), SAMPLE_PER_LANGUAGE)
    sample = evenly(sample, "lang", SAMPLE).select("lang", "_cell", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, numbers = [], []
            for raw in texthash.raw_texts(batch.column("text")):
                seen = counts(raw)
                at = np.flatnonzero(seen)
                places.append(at.astype("<u2").tobytes())
                numbers.append(seen[at].astype("<f4").tobytes())
            columns = [batch.column("lang"), batch.column("_cell")]
            columns += [pa.array(x, pa.binary()) for x in (places, numbers)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "cell", "buckets", "counts"])

    # At most SAMPLE rows, or one a language, of six bytes a bucket.
    found = sample.mapInArrow(counted, "lang string, cell bigint, buckets binary, counts binary").collect()
    found.sort(key=lambda r: (r.cell, r.lang, bytes(r.buckets)))
    rows = [(np.frombuffer(r.buckets, "<u2").astype(np.int64), np.frombuffer(r.counts, "<f4"), r.lang) for r in found]
    return fit(rows) if rows else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``accepted`` of every row."""
    rows = docs.select("doc_id", fold(F.col("doc_id")).alias("held_out"), letters(F.col("text")).alias("text"))
    if model is None:
        unknown = F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted")
        return rows.select("doc_id", "held_out", *unknown)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            names, scores, accepted = [], [], []
            for raw in texthash.raw_texts(batch.column("text")):
                name, score = UNKNOWN, 0.0
                if len(raw) > 2:
                    found = own.probabilities(raw)
                    best = int(found.argmax())
                    name, score = own.languages[best], float(found[best])
                names.append(name)
                scores.append(score)
                accepted.append(name != UNKNOWN and score >= own.threshold)
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            columns = [batch.column("doc_id"), batch.column("held_out"), *columns]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean"
    )


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and predict all."""
    return predict(docs, train(docs, ~fold(F.col("doc_id"))))
