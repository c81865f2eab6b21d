"""Quality by a vote of the nearest labelled documents in a latent-semantic space.

A text is a row of weights in three groups of columns, each group of length one: logarithmic counts of its byte runs
of one to three bytes, hashed to ``BUCKETS`` and weighted by rarity; roots of the shares of its runs of three
character classes (letter cases, digits, signs, spaces); and the share of distinct words among its words, between
two of ``STEPS`` marks. A truncated singular value decomposition of the labelled rows, worked out in numpy by subspace
iteration, gives the ``DIMENSIONS`` directions of the latent space. The labelled vectors there, about ``SAMPLE`` distinct
texts of each label at most, are broadcast with the directions.

Every document is taken to the space and its cosines with all labelled vectors are worked out exactly, a block of
documents at a time. The ``NEIGHBOURS`` nearest ones, with all that tie with the last, vote with a power of their cosine, and
votes of a label count as much as the label occurs, so that an evenly drawn sample does not move the score. The
score is the share of the votes for 1.

A null text counts as empty. A text without bytes, or without a neighbour at a cosine above 0, scores the share of
label 1. Without labelled texts all scores are 0. Of several labels of a document the highest counts; copies are one
labelled vector a label. Repeated rows and null ids are scored like others, other columns are not read. Texts are
read whole, in pieces. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texthash
from .common import scratch, text_of
from .sampling import fold, labelled_texts, texts_of_each_label

#: Labelled texts to vote, of each label, at most; a hash of the text chooses them.
SAMPLE = 1500
BITS = 13
BUCKETS = 1 << BITS
STEPS = 17
DIMENSIONS = 64
NEIGHBOURS = 15
#: Power of the cosine by which a neighbour votes, so that the nearest ones count most.
SHARPNESS = 8
ROUNDS = 6
#: Documents in a block, and bytes of a text that are looked at together.
BLOCK = 128
PIECE = 1 << 18
THRESHOLD = 0.3

#: Classes of bytes: other control, white space, capital, small, digit, full stop and comma, other sign, above ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[0x21:0x7F] = 6
_CLASS[[0x20, *range(0x09, 0x0E)]] = 1
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A] = 2, 3, 4
_CLASS[[0x2C, 0x2E]] = 5
_CLASS[0x80:] = 7
COLUMNS = BUCKETS + 512 + STEPS


def counts(raw: np.ndarray) -> np.ndarray:
    """Counts of byte runs and class runs, and where the share of distinct words lies."""
    found = np.zeros(COLUMNS)
    for at in range(0, len(raw), PIECE):
        # Runs that begin in the piece.
        wide = raw[at : at + PIECE + 2].astype(np.uint32)
        kinds = _CLASS[raw[at : at + PIECE + 2]]
        for order in (1, 2, 3):
            n = min(len(wide) - order + 1, PIECE)
            if n <= 0:
                continue
            value = np.full(n, order, dtype=np.uint32)
            for k in range(order):
                value = value << np.uint32(8) | wide[k : k + n]
            bucket = (value * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            found[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
        n = min(len(wide) - 2, PIECE)
        if n > 0:
            runs = kinds[:n] * 64 + kinds[1 : n + 1] * 8 + kinds[2 : n + 2]
            found[BUCKETS : BUCKETS + 512] += np.bincount(runs, minlength=512)
    words = texthash.word_hashes(raw)
    if len(words):
        place = len(np.unique(words)) / len(words) * (STEPS - 1)
        low = min(int(place), STEPS - 2)
        found[BUCKETS + 512 + low : BUCKETS + 514 + low] = 1 - (place - low), place - low
    return found


def weighted(found: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Rows of counts as rows of weights, each of the three groups of length one unless it is empty."""
    parts = np.split(found, [BUCKETS, BUCKETS + 512], axis=1)
    parts = [np.log1p(parts[0]) * rarity, np.sqrt(parts[1]), parts[2]]
    return np.hstack([_normal(p) for p in parts]).astype(np.float32)


def _normal(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return rows / np.where(size > 0, size, 1)


@dataclass(frozen=True)
class Model:
    """``directions`` of the latent space, labelled unit ``vectors`` in it, and each one's ``vote`` and ``label``."""

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    label: np.ndarray
    vote: np.ndarray
    base: float

    def placed(self, found: np.ndarray) -> np.ndarray:
        return _normal(weighted(found, self.rarity) @ self.directions)

    def scores(self, found: np.ndarray) -> np.ndarray:
        """The score of each row of counts."""
        near = self.placed(found) @ self.vectors.T
        # Cosines that differ by rounding alone tie.
        near = np.round(near.astype(np.float64), 6)
        last = max(near.shape[1] - NEIGHBOURS, 0)
        least = np.partition(near, last, axis=1)[:, last : last + 1]
        votes = np.where(near >= least, np.maximum(near, 0) ** SHARPNESS, 0) * self.vote
        cast = votes.sum(axis=1)
        return np.where(cast > 0, (votes * self.label).sum(axis=1) / np.where(cast > 0, cast, 1), self.base)


def latent_directions(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """The right singular vectors of the greatest singular values of ``rows``, as columns, by subspace iteration."""
    wide = min(dimensions + 16, *rows.shape)
    start = np.random.default_rng(0).standard_normal((rows.shape[1], wide)).astype(np.float32)
    base = np.linalg.qr(rows @ start)[0]
    for _ in range(ROUNDS):
        base = np.linalg.qr(rows @ (rows.T @ base))[0]
    _, _, right = np.linalg.svd(base.T @ rows, full_matrices=False)
    return np.ascontiguousarray(right[:dimensions].T)


def fit(found: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, share: float) -> Model:
    """A model of labelled rows, given as the places and numbers of their counts; ``share`` is how often label 1 occurs."""
    held = np.zeros(COLUMNS)
    for places, _ in found:
        held[places] += 1
    rarity = (np.log((1 + len(found)) / (1 + held[:BUCKETS])) + 1).astype(np.float32)
    # One table of the sample's size, filled a block at a time.
    rows = np.empty((len(found), COLUMNS), dtype=np.float32)
    for at in range(0, len(found), BLOCK):
        block = found[at : at + BLOCK]
        wide = np.zeros((len(block), COLUMNS), dtype=np.float32)
        for own, (places, numbers) in zip(wide, block):
            own[places] = numbers
        rows[at : at + BLOCK] = weighted(wide, rarity)
    directions = latent_directions(rows, DIMENSIONS)
    real, drawn = np.array([1 - share, share]), np.bincount(label, minlength=2) / len(label)
    vote = (real / np.where(drawn > 0, drawn, 1))[label]
    vectors = _normal(rows @ directions).astype(np.float32)
    return Model(rarity, directions, vectors, label, vote, share)


def train(docs: DataFrame, labels: DataFrame, learnable) -> Model | None:
    """A model of the rows of ``labels`` for which ``learnable`` holds; none without any."""
    with scratch(docs.sparkSession):
        labelled = labelled_texts(docs, labels.where(learnable), "quality")
        sizes = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
        if not sizes:
            return None
        sample = texts_of_each_label(docs, labelled, SAMPLE)

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places, numbers = [], []
                for raw in texthash.raw_texts(batch.column("text")):
                    own = counts(raw)
                    at = np.flatnonzero(own)
                    places.append(at.astype("<u2").tobytes())
                    numbers.append(own[at].astype("<f4").tobytes())
                columns = [batch.column("label"), batch.column("text_hash")]
                columns += [pa.array(x, pa.binary()) for x in (places, numbers)]
                yield pa.RecordBatch.from_arrays(columns, ["label", "text_hash", "places", "numbers"])

        # About 2 * SAMPLE rows of six bytes a column that is not 0.
        rows = sample.mapInArrow(counted, "label int, text_hash bigint, places binary, numbers binary").collect()
    rows.sort(key=lambda r: (r.label, r.text_hash))
    found = [(np.frombuffer(r.places, "<u2"), np.frombuffer(r.numbers, "<f4")) for r in rows]
    label = np.array([r.label for r in rows])
    return fit(found, label, sizes.get(1, 0) / sum(sizes.values()))


def score(rows: DataFrame, model: Model | None, *columns: str) -> DataFrame:
    """``columns`` of ``rows`` with ``score`` and ``predicted``."""
    if model is None:
        return rows.select(*columns, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    given = rows.select(*columns, text_of().alias("_text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                block = batch.slice(at, BLOCK)
                found = np.stack([counts(raw) for raw in texthash.raw_texts(block.column("_text"))])
                own = shared.value.scores(found)
                arrays = [block.column(c) for c in columns]
                arrays += [pa.array(own, pa.float64()), pa.array((own >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "score", "predicted"])

    schema = given.select(*columns).schema.add("score", "double").add("predicted", "integer")
    return given.mapInArrow(scored, schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; every fifth id by a hash is held out."""
    rows = docs.select("doc_id", "text", fold(F.col("doc_id"), 5, 0).alias("held_out"))
    return score(rows, train(docs, labels, ~fold(F.col("doc_id"), 5, 0)), "doc_id", "held_out")
