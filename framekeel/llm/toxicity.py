"""Toxicity by a linear classifier that counterfactual pairs keep from judging the group that a text names.

A text's features are its words and the first bytes of longer words, each once however often it occurs, so that a
long text is not diluted. Of the features in a bounded sample of labelled texts, those are kept that come with toxic
labels far more often than chance allows over all features tried (a Chernoff bound on the binomial tail, with a
Bonferroni correction), and all features of identity terms. Copies would make any of their words look significant,
so labelled texts that agree in a min-hash of their word shingles count once, for each of ``SKETCHES`` hashes. That
is sorted out by ids and hashes alone before the sample is drawn, so neither copies nor labels without a text take a
place in it.

A logistic regression on these features is fitted in numpy. In each sentence of the sample that names a group, the
term is swapped for every other one of its list and for a neutral word, and the squared change of the sentence's
logit is penalised; sentences of a text in which a swap changes the same features count once. So the weights of identity terms shrink towards each other and towards a neutral word's, while
what is said about a group keeps its weight. The sample has more toxic texts than the corpus; the intercept takes
that back, so the score is a probability.

A null text counts as empty; texts without a kept feature score the base rate of such texts. Of several labels of a
document the highest counts; null labels and labels without a document are not learned from. Without toxic labels
all scores are 0. Repeated rows and null ids are scored like others; other columns may have any name and type. Very long
texts are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import texthash
from .common import columns_of, scratch, staged
from .sampling import fold, letters

#: Labelled texts to learn from, of each class, at most.
TOXIC, CLEAN = 4000, 6000
PREFIXES = (4, 5, 6, 7)
SKETCHES = 2
#: How surely none of all tried features is kept by chance.
CHANCE = 0.01
#: Weight of the penalty on score changes, and of the one on the weights' squares.
COUNTERFACTUAL, RIDGE = 10.0, 0.02
STEPS = 1500
#: Features that are counted together in a task.
TOGETHER = 1 << 20
THRESHOLD = 0.3
# Words for groups of people that swap with each other, and a neutral word.
IDENTITY_TERMS = [
    "women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists", "atheists",
    "blacks", "whites", "asians", "latinos", "africans", "europeans", "arabs", "immigrants", "refugees", "foreigners",
    "gays", "lesbians", "transgender", "straight", "disabled", "elderly", "teenagers", "muslim", "christian", "jewish",
    "black", "white", "asian", "latino", "african", "gay", "lesbian", "woman", "man",
    "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge",
    "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés",
    "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados",
]
NEUTRAL = "people"
_SENTENCES = re.compile(r"(?<=[.!?\n])\s+")
_TERMS = re.compile(r"\b(?:" + "|".join(IDENTITY_TERMS) + r")\b")


def features(text: str | np.ndarray) -> np.ndarray:
    """The distinct feature hashes of a text of letters and spaces."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8) if isinstance(text, str) else text
    return texthash.word_and_prefix_hashes(raw, PREFIXES)


def _plain(sentence: str) -> str:
    return re.sub(r"[\W\d_]+", " ", sentence)


def counterfactuals(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features that a swap of one identity term takes from a sentence, and those it brings."""
    lower = text.lower()
    if not _TERMS.search(lower):
        return
    # What a swap changes depends on the two words alone once the sentence's other features are set aside.
    swaps = {}
    for sentence in _SENTENCES.split(lower):
        for term in set(_TERMS.findall(sentence)):
            rest = re.sub(rf"\b{term}\b", " ", sentence)
            lost = np.setdiff1d(features(term), features(_plain(rest)))
            swaps[term, lost.tobytes()] = lost
    for (term, _), lost in sorted(swaps.items(), key=lambda s: s[0]):
        for other in (*IDENTITY_TERMS, NEUTRAL):
            if other != term:
                yield lost, features(other)


def _sketch(raw: np.ndarray) -> list[int]:
    """One hash per sketch that similar texts are likely to share."""
    shingles = texthash.shingle_set(texthash.word_hashes(raw), 5)
    if not len(shingles):
        return [0] * SKETCHES
    salts = [np.uint64(0xA0761D6478BD642F * (k + 1) & (1 << 64) - 1) for k in range(SKETCHES)]
    return [int(texthash.mix(shingles ^ salt).min().astype(np.int64)) for salt in salts]


@dataclass(frozen=True)
class Model:
    """``hashes`` are the features in ascending order, with ``weights``."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        if not len(self.hashes):
            return 0.0
        at = np.searchsorted(self.hashes, found)
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == found
        logit = self.bias + self.weights[at[hit]].sum()
        return float(1 / (1 + np.exp(-np.clip(logit, -700, 700))))


NEVER = Model(np.empty(0, dtype=np.uint64), np.empty(0), 0.0)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``label``, ``text`` as it is and ``plain`` of a bounded number of labelled texts, one of each set of copies."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~fold(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")).where("label IN (0, 1)")
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), letters(F.col("text")).alias("plain")
    )

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([_sketch(raw) for raw in texthash.raw_texts(batch.column("plain"))], dtype=np.int64)
            marks = marks.reshape(-1, SKETCHES)
            names = ["doc_id", "text_hash", *(f"mark{k}" for k in range(SKETCHES))]
            columns = [batch.column("doc_id"), batch.column("text_hash")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(marks[:, k]) for k in range(SKETCHES))], names)

    schema = rows.select("doc_id", "text_hash").schema
    for k in range(SKETCHES):
        schema = schema.add(f"mark{k}", "long")
    # From here to the sample, rows are an id and some numbers.
    turn = F.xxhash64("doc_id", F.lit("toxic")).alias("turn")
    kept = staged(rows.mapInArrow(sketched, schema).join(known, "doc_id").select("*", turn), "sketches")
    for k in range(SKETCHES):
        first = kept.groupBy("label", f"mark{k}").agg(F.min("turn").alias("turn"))
        kept = kept.join(first.select("label", "turn"), ["label", "turn"], "left_semi")
    chosen = kept.where("label = 1").orderBy("turn", "text_hash").limit(TOXIC)
    chosen = chosen.unionByName(kept.where("label = 0").orderBy("turn", "text_hash").limit(CLEAN))
    # At most TOXIC + CLEAN rows of four numbers.
    ids = chosen.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text"), "label", "turn").distinct()
    ids = F.broadcast(staged(ids, "sampled-ids"))
    same = (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_text"))
    found = docs.select("doc_id", "text").join(ids, same).dropDuplicates(["label", "turn", "_text"])
    return staged(found.select("label", "turn", "text", letters(F.col("text")).alias("plain")), "sample")


def _significant(sample: DataFrame, toxic: int, clean: int) -> np.ndarray:
    """The hashes of the features that go with toxic texts; each of them is in many texts of the sample."""

    def summed(sets: list[np.ndarray], marks: list[int]) -> pa.RecordBatch:
        own = np.concatenate([np.empty(0, dtype=np.uint64), *sets])
        found, at = np.unique(own, return_inverse=True)
        weights = np.repeat(np.array(marks, dtype=np.int64), [len(x) for x in sets])
        toxic_of = np.bincount(at, weights=weights, minlength=len(found)).astype(np.int64)
        columns = [found.astype(np.int64), toxic_of, np.bincount(at, minlength=len(found)).astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "toxic", "seen"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, marks, held = [], [], 0
        for batch in batches:
            for raw, label in zip(texthash.raw_texts(batch.column("plain")), batch.column("label").to_pylist()):
                sets.append(features(raw))
                marks.append(label)
                held += len(sets[-1])
                if held > TOGETHER:
                    yield summed(sets, marks)
                    sets, marks, held = [], [], 0
        yield summed(sets, marks)

    counts = sample.select("label", "plain").mapInArrow(counted, "feature bigint, toxic bigint, seen bigint")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("seen").alias("seen"))
    counts = staged(counts, "feature-counts")
    tried = counts.count()
    share = F.col("toxic") / F.col("seen")
    base = toxic / (toxic + clean)

    def part(p: Column, q: float) -> Column:
        return F.when(p > 0, p * F.log(p / q)).otherwise(0.0)

    # By the Chernoff bound, chance gives so many toxic texts with a probability of at most exp(-surely).
    surely = F.col("seen") * (part(share, base) + part(1 - share, 1 - base))
    kept = counts.where(share > base).withColumn("surely", surely)
    kept = kept.where(F.col("surely") >= float(np.log(max(tried, 1) / CHANCE)))
    return np.array([r.feature for r in kept.select("feature").collect()], dtype=np.int64).astype(np.uint64)


def _rows(sample: DataFrame, hashes: np.ndarray) -> list:
    """Per text of the sample: label, kept features, and the kept features that each swap takes and brings."""

    def kept(found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(hashes, found)
        at[at == len(hashes)] = 0
        return at[hashes[at] == found].astype(np.int32)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lost, brought = [], [], []
            for raw, text in zip(texthash.raw_texts(batch.column("plain")), batch.column("text")):
                own.append(kept(features(raw)))
                pairs = [(kept(a), kept(b)) for a, b in counterfactuals(text.as_py())]
                lost.append([a for a, _ in pairs])
                brought.append([b for _, b in pairs])
            columns = [batch.column("label"), pa.array(own, pa.list_(pa.int32()))]
            columns += [pa.array(x, pa.list_(pa.list_(pa.int32()))) for x in (lost, brought)]
            yield pa.RecordBatch.from_arrays(columns, ["label", "own", "lost", "brought"])

    # At most TOXIC + CLEAN rows of kept features.
    schema = "label int, own array<int>, lost array<array<int>>, brought array<array<int>>"
    return sample.select("label", "text", "plain").orderBy("turn").mapInArrow(matched, schema).collect()


def fit(rows: list, n_features: int, prior_shift: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of least loss: logistic, ridge, and squared logit changes of the swaps."""
    label = np.array([r[0] for r in rows], dtype=float)
    own = [np.asarray(r[1], dtype=np.int64) for r in rows]
    at, text = np.concatenate(own), np.repeat(np.arange(len(rows)), [len(x) for x in own])
    swaps = [pair for r in rows for pair in zip(r[2], r[3]) if pair[0] or pair[1]]
    swap_at = np.array([i for lost, brought in swaps for i in (*lost, *brought)], dtype=np.int64)
    swap_sign = np.array([s for lost, brought in swaps for s in (*(-1.0 for _ in lost), *(1.0 for _ in brought))])
    swap_row = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    # A step of one over this bound, feature by feature, cannot overshoot: each text or swap counts for a feature
    # with the number of features it holds.
    held = np.array([len(x) + 1 for x in own])
    curve = np.bincount(at, weights=held[text] / 4 / len(rows), minlength=n_features) + RIDGE / len(rows)
    if swaps:
        moved = np.bincount(swap_row, minlength=len(swaps))
        curve += np.bincount(swap_at, weights=2 * COUNTERFACTUAL * moved[swap_row] / len(swaps), minlength=n_features)
    bias_curve = held.sum() / 4 / len(rows)
    weights = ahead = np.zeros(n_features)
    bias = bias_ahead = 0.0
    for step in range(STEPS):
        logit = bias_ahead + np.bincount(text, weights=ahead[at], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(logit, -700, 700))) - label) / len(rows)
        slope = np.bincount(at, weights=error[text], minlength=n_features) + RIDGE * ahead / len(rows)
        if swaps:
            change = np.bincount(swap_row, weights=swap_sign * ahead[swap_at], minlength=len(swaps))
            push = 2 * COUNTERFACTUAL * change / len(swaps)
            slope += np.bincount(swap_at, weights=swap_sign * push[swap_row], minlength=n_features)
        before, bias_before = weights, bias
        weights, bias = ahead - slope / curve, bias_ahead - error.sum() / bias_curve
        # Nesterov's look ahead.
        reach = step / (step + 3)
        ahead, bias_ahead = weights + reach * (weights - before), bias + reach * (bias - bias_before)
    return weights, bias + prior_shift


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labelled rows that are not held out."""
    with scratch(docs.sparkSession):
        known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~fold(F.col("doc_id")))
        everywhere = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
        sample = _sample(docs, labels)
        sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
        if not sizes.get(1):
            return NEVER
        terms = np.concatenate([features(t) for t in (*IDENTITY_TERMS, NEUTRAL)])
        hashes = np.union1d(_significant(sample, sizes[1], sizes.get(0, 0)), terms)
        rows = _rows(sample, hashes)
        real = np.log(everywhere[1] / max(everywhere.get(0, 0), 0.5))
        drawn = np.log(sizes[1] / max(sizes.get(0, 0), 0.5))
        weights, bias = fit(rows, len(hashes), real - drawn)
        return Model(hashes, weights, float(bias))


def score(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(*columns, letters(F.col("text")).alias("_plain"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(features(raw)) for raw in texthash.raw_texts(batch.column("_plain"))]
            toxic = [int(s >= THRESHOLD) for s in found]
            kept = [batch.column(c) for c in columns]
            arrays = [*kept, pa.array(found, pa.float64()), pa.array(toxic, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "score", "predicted"])

    return plain.mapInArrow(scored, plain.select(*columns).schema.add("score", "double").add("predicted", "integer"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    rows = docs.select("doc_id", "text", fold(F.col("doc_id")).alias("held_out"))
    return score(rows, train(docs, labels), "doc_id", "held_out")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texthash.raw_texts(batch.column(batch.num_columns - 1))
            keep = [shared.value.score(features(raw)) < THRESHOLD for raw in texts]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))

    # By number, as columns may have any names.
    names = [f"_{k}" for k in range(len(docs.columns))]
    plain = docs.select(*columns_of(docs), letters(F.col("text"))).toDF(*names, "plain")
    return plain.mapInArrow(passing, plain.select(*names).schema).toDF(*docs.columns)
