"""Join of documents whose sets of word n-grams have at least a given Jaccard similarity.

Texts with the same set form a class, and classes are joined through one member. The n-grams of a set are put in
order, rare ones first. Two sets can only be similar if they share an n-gram of their prefixes, so classes meet on
prefix n-grams, and pairs pass a length filter, a positional filter on the place of the shared n-gram, and a suffix
filter: sets are split by hash into ``PARTS`` parts, and the differences of their parts' sizes add up to no more
than the differences of the sets. Pairs that pass are verified once on their whole sets.

The rare-first order comes from a table of counters that every n-gram of every document is counted into. The table
is at most ``MAX_COUNTERS`` bytes, so it can be broadcast; n-grams that share a counter only make the order less
sharp, never the result wrong, since any order that all tasks share is right.

``similar_classes`` wants components, so pairs inside one need no check. First each prefix n-gram's classes are compared
with one of them, the hub, the class that shares most prefix n-grams: a family of copies of one original falls
together there, in as many pairs as it has members. Then only n-grams whose classes are still in several components
are taken up again, all their pairs across components, in blocks of about ``BLOCK`` classes against each other.
No partner is capped, and no block holds more than two times ``BLOCK`` classes to speak of.

``linked_documents`` is the join itself: how many classes and rows each row is linked with. Linked classes share a
component and a prefix n-gram and are of like size, so a component's classes are dealt into blocks of about ``MEMBERS``
classes and ``MEMBER_GRAMS`` n-grams, by size and by their most frequent prefix n-gram, and two blocks meet only if they
share a prefix n-gram and their sizes allow a link. A meeting joins its classes on prefix n-grams, applies the three
filters and verifies the candidates that are left; a pair has one meeting, so it is verified once. Pairs that the
components were found by are not verified again: their links are added up as they are. No other pair is written.

A document with fewer words than an n-gram is one n-gram of all its words; one without words, or with a null text,
has none and is linked with nothing. Repeated rows are of one class. A null ``doc_id`` is no component's least unless
all are null. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import per_key
from . import texthash
from .common import as_often, keyed, row_key, scratch, staged, text_of
from .components import components

WIDTH = 5
PERCENT = 80
PARTS = 256
BLOCK = 512
#: Classes, and n-grams of them, in a block of a component whose links are counted; candidates that are filtered at a
#: time; n-grams in a product of matrices, and how many times cheaper a cell of it is than a pair on its own.
MEMBERS, MEMBER_GRAMS, MEETINGS, PRODUCT, CHEAPER = 1024, 1 << 18, 1 << 20, 4096, 32
#: Code points of text for each counter, and the bounds of the table's size.
CHARS_PER_COUNTER = 64
MIN_COUNTERS, MAX_COUNTERS = 1 << 16, 1 << 26
SLICE = 1 << 16


def least_overlap(total, percent: int):
    """The least intersection that sets with ``total`` members together must have."""
    return -(-percent * total // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n + percent * -n // 100 + 1


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, Iterator[np.ndarray]]]:
    for batch in batches:
        words = texthash.texts_word_hashes(batch.column("text"))
        yield batch, (texthash.shingle_set(w, width) for w in words)


# --- rare-first order ----------------------------------------------------------------------------


def _counters(docs: DataFrame, width: int) -> bytes:
    """One byte per counter: four times the binary logarithm of the n-grams counted there."""
    chars = docs.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    size = 1 << max(0, math.ceil(math.log2(max(1, chars / CHARS_PER_COUNTER))))
    size = min(max(size, MIN_COUNTERS), MAX_COUNTERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.uint8)

        def add(hashes: list[np.ndarray]) -> None:
            at, n = np.unique(np.concatenate(hashes) & np.uint64(size - 1), return_counts=True)
            counts[at] = np.minimum(counts[at] + n, 255)

        for _, sets in _sets(batches, width):
            waiting, held = [], 0
            for hashes in sets:
                waiting.append(hashes)
                held += len(hashes)
                if held > SLICE * 8:
                    add(waiting)
                    waiting, held = [], 0
            if waiting:
                add(waiting)
        parts = counts.reshape(-1, SLICE)
        used = [k for k in range(len(parts)) if parts[k].any()]
        blobs = [zlib.compress(parts[k].tobytes(), 1) for k in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], ["slice", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(zlib.decompress(blob.as_py()), dtype=np.uint8)
                sums[k] = counts.astype(np.int64) if k not in sums else sums[k] + counts
        codes = [zlib.compress((4 * np.log2(s + 1.0)).astype(np.uint8).tobytes(), 1) for s in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(codes, pa.binary())], ["slice", "counts"]
        )

    schema = "slice int, counts binary"
    counted = docs.select("text").mapInArrow(count, schema)
    # The number of partitions bounds how many slices a task sums up.
    summed = counted.repartition(max(1, size // SLICE // 16), "slice").mapInArrow(total, schema)
    table = np.zeros(size, dtype=np.uint8)
    for k, blob in summed.collect():  # at most MAX_COUNTERS bytes
        table[k * SLICE : (k + 1) * SLICE] = np.frombuffer(zlib.decompress(blob), dtype=np.uint8)
    return table.tobytes()


# --- sets, classes and prefixes ------------------------------------------------------------------


def _identity(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the whole set."""
    one, two = texthash.mix(hashes), texthash.mix(hashes ^ np.uint64(0xD1B54A32D192ED03))
    return tuple(int(np.add.reduce(x).astype(np.int64)) for x in (one, two))


def _signature(hashes: np.ndarray) -> bytes:
    sizes = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % PARTS, minlength=PARTS)
    return np.minimum(sizes, 255).astype(np.uint8).tobytes()


def _features(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: the set's size, identity and signature, and its prefix, rare n-grams first."""
    order = docs.sparkSession.sparkContext.broadcast(_counters(docs, width))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(order.value, dtype=np.uint8)
        mask = np.uint64(len(counts) - 1)
        for batch, sets in _sets(batches, width):
            sizes, one, two, signatures, prefixes = [], [], [], [], []
            for hashes in sets:
                n = len(hashes)
                sizes.append(n)
                a, b = _identity(hashes)
                one.append(a)
                two.append(b)
                signatures.append(_signature(hashes))
                rare_first = np.argsort(counts[hashes & mask], kind="stable")  # hashes ascend: ties go by hash
                prefixes.append(hashes[rare_first[: prefix_size(n, percent) if n else 0]].astype(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            values = pa.array(np.concatenate(prefixes) if prefixes else np.empty(0, dtype=np.int64))
            columns = [*(batch.column(c) for c in ("row_id", "key", "doc_id")), *(pa.array(x, pa.int64()) for x in (sizes, one, two))]
            columns += [pa.array(signatures, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), values)]
            names = ["row_id", "key", "doc_id", "n", "id1", "id2", "signature", "prefix"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "row_id bigint, key string, doc_id bigint, n bigint, id1 bigint, id2 bigint"
    columns = docs.select("row_id", "key", "doc_id", "text")
    return columns.mapInArrow(featured, schema + ", signature binary, prefix array<bigint>")


SAME = ["n", "id1", "id2"]


def _shingles(docs: DataFrame, wanted: DataFrame, width: int, *also: str) -> DataFrame:
    """``node``, its columns ``also`` and its whole set as bytes, of the ``wanted`` classes, from their members' texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, hashes_of in _sets(batches, width):
            for k, hashes in enumerate(hashes_of):
                own = [len(hashes), *_identity(hashes)]
                columns = [batch.column("doc_id").slice(k, 1), *(pa.array([x], pa.int64()) for x in own)]
                columns.append(pa.array([hashes.tobytes()], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["_doc", *SAME, "shingles"])

    ids = wanted.select(F.col("doc_id").alias("_doc")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi").select("doc_id", "text")
    found = texts.mapInArrow(sets, "_doc bigint, n bigint, id1 bigint, id2 bigint, shingles binary")
    return found.join(wanted.select("node", *also, *SAME), SAME).select("node", *also, "shingles")


# --- candidate pairs -----------------------------------------------------------------------------


def _linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: the suffix filter on signatures, then the sets of those that are left."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            near = _near(_signatures(batch.column("s_a")), _signatures(batch.column("s_b")), total, percent)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(s.as_py(), dtype=np.uint64) for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def of(side: str) -> DataFrame:
        return nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}"))

    passed = staged(pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(possible, "a bigint, b bigint"), "possible")
    involved = passed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = staged(nodes.select("node", "doc_id", *SAME).join(involved, "node", "left_semi"), "wanted")
    sets = staged(_shingles(texts, wanted, width), "sets")
    whole = passed.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    whole = whole.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return whole.mapInArrow(similar, "a bigint, b bigint").distinct()


def _signatures(column: pa.Array | list[bytes]) -> np.ndarray:
    parts = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, PARTS).astype(np.int16)


def _near(a: np.ndarray, b: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether the parts' sizes differ by no more than sets of ``total`` members that are similar can."""
    return np.abs(a - b).sum(axis=1) <= total - 2 * least_overlap(total, percent)


def _hub_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Of each prefix n-gram, the pairs of its classes with the one of them that shares most prefix n-grams."""
    degrees = per_key(shared, ["node"], F.count(F.lit(1)).alias("degree"))
    ranked = shared.join(degrees, "node")
    best = F.max(F.struct("degree", (-F.col("node")).alias("first"), "n", "pos")).alias("hub")
    hubs = per_key(ranked, ["token"], best)
    hub = {c: F.col(f"hub.{c}") for c in ("n", "pos")}
    node = -F.col("hub.first")
    total = F.col("n") + hub["n"]
    overlap = F.ceil(F.lit(percent) * total / F.lit(100 + percent) - 1e-9)
    met = shared.join(hubs, "token").where(F.col("node") != node)
    met = met.where(100 * F.least("n", hub["n"]) >= percent * F.greatest("n", hub["n"]))
    met = met.where(F.least(F.col("n") - F.col("pos"), hub["n"] - hub["pos"]) >= overlap)
    return met.select(F.least("node", node).alias("a"), F.greatest("node", node).alias("b")).distinct()


def _cross_pairs(shared: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes in different components that share a prefix n-gram and pass all filters."""
    rows = shared.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    tokens = per_key(
        rows, ["token"], F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("all")
    )
    open_tokens = tokens.where("low < high").select("token", F.ceil(F.col("all") / BLOCK).alias("blocks"))
    rows = rows.join(open_tokens, "token").join(nodes.select("node", "signature"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    member = F.struct("node", "component", "n", "pos", "signature")
    blocks = staged(rows.groupBy("token", "block").agg(F.collect_list(member).alias("members")), "blocks")
    right = blocks.select("token", F.col("block").alias("other"), F.col("members").alias("others"))
    met = blocks.join(right, "token").where("block <= other")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column("same").to_pylist()
            for k, (left, right) in enumerate(zip(batch.column("members"), batch.column("others"))):
                x, y = (_Members(side.values) for side in (left, right))
                i, j = np.triu_indices(len(x.node), 1) if same[k] else np.indices((len(x.node), len(y.node))).reshape(2, -1)
                i, j = _filtered(x, y, i, j, percent)
                a, b = np.minimum(x.node[i], y.node[j]), np.maximum(x.node[i], y.node[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    met = met.select("members", "others", (F.col("block") == F.col("other")).alias("same"))
    return met.mapInArrow(across, "a bigint, b bigint").distinct()


class _Members:
    """The columns of a block of classes."""

    def __init__(self, rows: pa.StructArray):
        self.node, self.component, self.n, self.pos = (
            rows.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", "component", "n", "pos")
        )
        self.signature = _signatures(rows.field("signature"))


def _filtered(x: _Members, y: _Members, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    keep = x.component[i] != y.component[j]
    i, j = i[keep], j[keep]
    n, m = x.n[i], y.n[j]
    keep = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    keep &= np.minimum(n - x.pos[i], m - y.pos[j]) >= least_overlap(n + m, percent)
    i, j = i[keep], j[keep]
    near = [
        _near(x.signature[i[k : k + 8192]], y.signature[j[k : k + 8192]], x.n[i[k : k + 8192]] + y.n[j[k : k + 8192]], percent)
        for k in range(0, len(i), 8192)
    ]
    keep = np.concatenate(near) if near else np.zeros(0, dtype=bool)
    return i[keep], j[keep]


# --- the join ------------------------------------------------------------------------------------


class _Joined(NamedTuple):
    """The numbered texts, their features, the classes and what the join of these has found."""

    texts: DataFrame
    features: DataFrame
    nodes: DataFrame
    #: Prefix n-grams of several classes: ``node``, ``n``, ``pos``, ``token``.
    shared: DataFrame
    #: Pairs (a, b) that were looked at, and those of them that are linked.
    decided: DataFrame
    links: DataFrame
    #: The classes with their ``component`` and least ``doc_id``.
    labelled: DataFrame


def _classified(docs: DataFrame, key: Column | None, width: int, percent: int, hold: bool = False) -> _Joined:
    """The join up to components; links are written if they are to ``hold``, for those who read them again."""
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    texts = keyed(docs, doc_id, text_of().alias("text"), key=key)
    features = staged(_features(texts, width, percent), "features")
    least = F.min("doc_id").alias("least")
    classes = staged(per_key(features.where("n > 0"), SAME, F.min("row_id").alias("node"), least), "classes")
    own = features.select("row_id", "doc_id", "signature", "prefix")
    nodes = staged(classes.join(own, F.col("node") == F.col("row_id")).drop("row_id", "least"), "nodes")
    postings = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    several = per_key(postings, ["token"], F.count(F.lit(1)).alias("all")).where(F.col("all") > 1)
    shared = staged(postings.join(several.select("token"), "token", "left_semi"), "shared")
    pairs = staged(_hub_pairs(shared, percent), "hub-pairs")
    links = staged(_linked(pairs, nodes, texts, width, percent), "hub-links")
    rest = _cross_pairs(shared, components(links), nodes, percent).join(pairs, ["a", "b"], "left_anti")
    rest = staged(rest, "cross-pairs")
    across = _linked(rest, nodes, texts, width, percent)
    links = links.unionByName(staged(across, "cross-links") if hold else across)
    labels = components(links)
    labelled = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return _Joined(texts, features, nodes, shared, pairs.unionByName(rest), links, labelled)


def _named(features: DataFrame, labelled: DataFrame, *also: str) -> DataFrame:
    """Every row with what is known of its class; ids of components and classes are their least ``doc_id``."""
    lows = per_key(labelled, ["component"], F.min("least").alias("component_id"))
    named = labelled.join(lows, "component").select(*SAME, "component", "component_id", *also)
    rows = features.select("row_id", "key", "doc_id", *SAME).join(staged(named, "named"), SAME, "left")
    own_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.withColumn("component_id", own_id).withColumnRenamed("n", "n_shingles")


def similar_classes(docs: DataFrame, key: Column | None = None, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``row_id``, ``key``, ``doc_id``, ``n_shingles``, ``component`` and its least ``component_id``.

    ``component`` is a number that the rows of a component share; it is null for a row without words.
    """
    found = _classified(docs, key, width, percent)
    return _named(found.features, found.labelled).select("row_id", "key", "doc_id", "n_shingles", "component", "component_id")


# --- all links -----------------------------------------------------------------------------------


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of each set of ``left`` with each of ``right``."""
    sides = left, right
    values = [np.concatenate(sets) for sets in sides]
    rows = [np.repeat(np.arange(len(sets)), [len(x) for x in sets]) for sets in sides]
    common = np.intersect1d(*values)
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    places = []
    for value, row in zip(values, rows):
        at = np.searchsorted(common, value)
        met = np.flatnonzero(at < len(common))
        met = met[common[at[met]] == value[met]]
        met = met[np.argsort(at[met], kind="stable")]
        places.append((at[met], row[met]))
    for first in range(0, len(common), PRODUCT):
        parts = []
        for sets, (at, row) in zip(sides, places):
            low, high = np.searchsorted(at, (first, first + PRODUCT))
            part = np.zeros((len(sets), min(PRODUCT, len(common) - first)), dtype=np.float32)
            part[row[low:high], at[low:high] - first] = 1
            parts.append(part)
        total += (parts[0] @ parts[1].T).astype(np.int64)
    return total


class _Side:
    """The classes of a block, in a meeting: (node, rows, prefix, set) each."""

    def __init__(self, classes: list[tuple]):
        self.node = np.array([c[0] for c in classes], dtype=np.int64)
        self.rows = np.array([c[1] for c in classes], dtype=np.int64)
        self.sets = [c[3] for c in classes]
        self.n = np.array([len(x) for x in self.sets], dtype=np.int64)
        self.signature = _signatures([_signature(x) for x in self.sets])
        sizes = [len(c[2]) for c in classes]
        #: Prefix n-grams with the class and the place each is at, in the order of n-grams.
        tokens = np.concatenate([c[2] for c in classes])
        order = np.argsort(tokens, kind="stable")
        self.token = tokens[order]
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.pos = np.concatenate([np.arange(x) for x in sizes])[order]


def _candidates(x: _Side, y: _Side, alone: bool, known: list[tuple[int, int]], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a meeting that share a prefix n-gram and pass the filters, without those ``known`` already."""
    low = np.searchsorted(y.token, x.token, "left")
    met = np.searchsorted(y.token, x.token, "right") - low
    candidate = np.zeros((len(x.node), len(y.node)), dtype=bool)
    ends = np.cumsum(met)
    first = 0
    while first < len(met):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - met[first] + MEETINGS, "right")))
        own = np.repeat(np.arange(first, last), met[first:last])
        starts = np.repeat(ends[first:last] - met[first:last], met[first:last])
        other = low[own] + np.arange(len(own)) + (ends[first] - met[first]) - starts
        i, j = x.owner[own], y.owner[other]
        n, m = x.n[i], y.n[j]
        keep = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        keep &= np.minimum(n - x.pos[own], m - y.pos[other]) >= least_overlap(n + m, percent)
        candidate[i[keep], j[keep]] = True
        first = last
    if alone:
        candidate = np.triu(candidate, 1)
    if known:
        at, there = ({node: k for k, node in enumerate(side.node.tolist())} for side in (x, y))
        for a, b in known:
            if a in at and b in there:
                candidate[at[a], there[b]] = False
            if b in at and a in there:
                candidate[at[b], there[a]] = False
    i, j = np.nonzero(candidate)
    near = [
        _near(x.signature[i[k : k + 8192]], y.signature[j[k : k + 8192]], x.n[i[k : k + 8192]] + y.n[j[k : k + 8192]], percent)
        for k in range(0, len(i), 8192)
    ]
    keep = np.concatenate(near) if near else np.zeros(0, dtype=bool)
    return i[keep], j[keep]


def _verified(x: _Side, y: _Side, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs whose whole sets are similar, counted one by one or, if there are many, in products."""
    left, right = np.unique(i), np.unique(j)
    if len(i) * CHEAPER < len(left) * len(right) or len(i) < CHEAPER:
        shared = np.array([len(np.intersect1d(x.sets[a], y.sets[b], assume_unique=True)) for a, b in zip(i, j)], dtype=np.int64)
    else:
        cells = _overlaps([x.sets[a] for a in left], [y.sets[b] for b in right])
        shared = cells[np.searchsorted(left, i), np.searchsorted(right, j)]
    keep = 100 * shared >= percent * (x.n[i] + y.n[j] - shared)
    return i[keep], j[keep]


def _links_of(
    sides: tuple[list[tuple], list[tuple]], known: list[tuple[int, int]], alone: bool, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``node``, linked classes and their rows, of the classes of a meeting; a block ``alone`` meets itself."""
    if not sides[0] or not (alone or sides[1]):
        return (np.zeros(0, dtype=np.int64),) * 3
    x = _Side(sides[0])
    y = x if alone else _Side(sides[1])
    i, j = _verified(x, y, *_candidates(x, y, alone, known, percent), percent)
    node = np.concatenate([x.node[i], y.node[j]])
    nodes, at = np.unique(node, return_inverse=True)
    classes = np.bincount(at, minlength=len(nodes))
    rows = np.zeros(len(nodes), dtype=np.int64)
    np.add.at(rows, at, np.concatenate([y.rows[j], x.rows[i]]))
    return nodes, classes, rows


def _dealt(joined: _Joined, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The classes of components of several with their ``block``, and the pairs of blocks (low, high) that meet.

    Classes whose sizes allow a link are of the same or of neighbouring size buckets. Inside a bucket, classes of one
    most frequent prefix n-gram stay together; a group too big for a block is split by hash, smaller ones share blocks.
    """
    several = per_key(classes, ["component"], F.count(F.lit(1)).alias("all")).where(F.col("all") > 1)
    several = classes.join(several.select("component"), "component", "left_semi")
    met = joined.shared.join(several.select("node", "component"), "node")
    met = staged(met, "component-tokens")
    counts = per_key(met, ["component", "token"], F.count(F.lit(1)).alias("count"))
    open_tokens = staged(counts.where(F.col("count") > 1), "open-tokens")
    met = met.join(open_tokens, ["component", "token"])
    family = per_key(met, ["node"], F.max(F.struct("count", "token")).alias("best"))
    family = family.select("node", F.col("best.token").alias("family"))
    bucket = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent) + 1e-3)).alias("bucket")
    rows = several.join(family, "node").withColumn("bucket", bucket)
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / MEMBERS, F.sum("n") / MEMBER_GRAMS)).cast("int")
    of_bucket, of_family = ["component", "bucket"], ["component", "bucket", "family"]
    rows = rows.join(per_key(rows, of_bucket, parts.alias("bins")), of_bucket)
    rows = rows.join(per_key(rows, of_family, parts.alias("parts")), of_family)
    shares = F.xxhash64("component", "bucket", F.lit(0), F.pmod(F.xxhash64("family"), F.col("bins")))
    split = F.xxhash64("component", "bucket", F.lit(1), "family", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = staged(rows.withColumn("block", F.when(F.col("parts") > 1, split).otherwise(shares)), "dealt")

    sizes = F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.count(F.lit(1)).alias("count")
    held = met.select("component", "token", "node").join(dealt.select("node", "n", "block"), "node")
    held = staged(held.groupBy("component", "token", "block").agg(*sizes), "block-tokens")
    others = held.select("component", "token", *(F.col(c).alias(f"other_{c}") for c in ("block", "least_n", "most_n")))
    meeting = held.join(others, ["component", "token"]).where("block < other_block OR (block = other_block AND count > 1)")
    meeting = meeting.where(100 * F.col("most_n") >= percent * F.col("other_least_n"))
    meeting = meeting.where(100 * F.col("other_most_n") >= percent * F.col("least_n"))
    return dealt, staged(meeting.select(F.col("block").alias("low"), F.col("other_block").alias("high")).distinct(), "meetings")


def _link_counts(joined: _Joined, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """``node``, ``linked_classes`` and ``others``, the rows of these, of every class that has a link."""
    dealt, meetings = _dealt(joined, classes, percent)
    # Texts are found by any id of the class: all its rows have the same set.
    wanted = dealt.select("node", F.col("least").alias("doc_id"), "block", "rows", *SAME)
    sets = _shingles(joined.texts, wanted, width, "block", "rows", *SAME).dropDuplicates(SAME).drop(*SAME)
    sets = sets.join(joined.nodes.select("node", "prefix"), "node")
    low, high = F.col("low"), F.col("high")
    # A block that meets itself comes once, as the lower side.
    sides = F.when(low == high, F.array(F.struct(low.alias("block"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(low.alias("block"), F.lit(0).alias("side")), F.struct(high.alias("block"), F.lit(1).alias("side")))
    )
    wanted_at = meetings.select("low", "high", F.inline(sides))
    columns = ["low", "high", "side", "node", "rows", "prefix", "shingles"]
    present = sets.join(wanted_at, "block").select(*columns)

    def placed(side: str) -> DataFrame:
        return dealt.select(F.col("node").alias(side), F.col("block").alias(f"block_{side}"))

    known = joined.decided.join(placed("a"), "a").join(placed("b"), "b")
    known = known.withColumn("low", F.least("block_a", "block_b")).withColumn("high", F.greatest("block_a", "block_b"))
    known = known.join(meetings, ["low", "high"], "left_semi")
    none = (F.lit(None).cast(t).alias(c) for c, t in (("prefix", "array<bigint>"), ("shingles", "binary")))
    known = known.select("low", "high", F.lit(2).alias("side"), F.col("a").alias("node"), F.col("b").alias("rows"), *none)
    met = present.unionByName(known).repartition("low", "high").sortWithinPartitions("low", "high")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, known = None, ([], []), []

        def batch_of() -> pa.RecordBatch:
            found = _links_of(sides, known, now[0] == now[1], percent)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["node", "classes", "rows"])

        for batch in batches:
            keys = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())
            rest = zip(*(batch.column(c).to_pylist() for c in ("side", "node", "rows")))
            for k, (key, (side, node, rows)) in enumerate(zip(keys, rest)):
                if key != now:
                    if now is not None:
                        yield batch_of()
                    now, sides, known = key, ([], []), []
                if side == 2:
                    known.append((node, rows))
                else:
                    prefix = batch.column("prefix")[k].values.to_numpy(zero_copy_only=False)
                    raw = batch.column("shingles")[k].as_py()
                    sides[side].append((node, rows, prefix.copy(), np.frombuffer(raw, dtype=np.uint64)))
        if now is not None:
            yield batch_of()

    found = met.mapInArrow(counted, "node bigint, classes bigint, rows bigint")
    size = classes.select(F.col("node").alias("b"), "rows")
    both = joined.links.select("a", "b").unionByName(joined.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    before = both.distinct().join(size, "b").select(F.col("a").alias("node"), F.lit(1).alias("classes"), "rows")
    totals = F.sum("classes").alias("linked_classes"), F.sum("rows").alias("others")
    return per_key(found.unionByName(before), ["node"], *totals)


def linked_documents(docs: DataFrame, key: Column | None = None, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The columns of ``similar_classes``, ``class_id``, and the numbers of ``linked_classes`` and ``linked_documents``.

    ``class_id`` is the least ``doc_id`` of the rows with the same set. The other rows of a class are linked documents,
    too; a row without words has no links.
    """
    joined = _classified(docs, key, width, percent, hold=True)
    sizes = per_key(joined.features.where("n > 0"), SAME, F.count(F.lit(1)).alias("rows"))
    labelled = staged(joined.labelled.join(sizes, SAME), "labelled")
    counts = _link_counts(joined, labelled, width, percent)
    counted = labelled.join(counts, "node", "left").withColumn("linked_classes", F.coalesce("linked_classes", F.lit(0)))
    counted = counted.withColumn("linked_documents", F.col("rows") - 1 + F.coalesce("others", F.lit(0)))
    rows = _named(joined.features, counted, "least", "linked_classes", "linked_documents")
    own_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id")
    numbers = (F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("linked_classes", "linked_documents"))
    return rows.select("row_id", "key", "doc_id", "n_shingles", "component", "component_id", own_id, *numbers)


def representative_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those whose component has a row of lower ``doc_id``, null last."""
    with scratch(docs.sparkSession):
        found = staged(similar_classes(docs, row_key(docs), width, percent), "similar")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first")
        best = per_key(found.where("component IS NOT NULL"), ["component"], first)
        best = best.select("component", F.col("first.row_id").alias("best"))
        stays = F.col("component").isNull() | (F.col("best") == F.col("row_id"))
        decided = found.join(best, "component", "left").select("key", stays.cast("int").alias("times"))
        return as_often(docs, decided)
