"""What each filter of a chain removes, in every order of the chain, read off one decision diagram a part.

A document's failures are a mask, one bit a filter. Spark counts the masks of each part of the corpus, so a part is
at most two to the number of filters counts, whatever its size, and they make one diagram: a level a filter, the low
branch for documents that pass it and the high branch for those that fail. Nodes with the same branches are one node,
and each node has the counts of the documents below it. The path of low branches from the root is the chain in
the order of the levels: what hangs on the high branch at a level is what that step removes, and what hangs on the
low one is kept. The next order is one swap of two adjacent levels away, which rebuilds these two levels and leaves
all others as they are; plain changes (each order once, by adjacent swaps) pass through all of them.

``corpus_failures`` has five filters: too few words, too few distinct words, too many capitals, odd characters, and a
text that a smaller ``doc_id`` has, too. A null text is empty: it has too few words, and all empty texts are equal.
A null part is the empty string. A null ``doc_id`` is neither smaller nor greater than another, so it makes no copy
and is none; rows that agree in id and text are no copies of each other. Of several labels of a document the highest
counts, null labels count as 0, and labels without a document are not read. Texts are whole, however long; those
with the same SHA-256 are the same. Other columns are not read, so their names do not matter. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import per_key
from .common import WORD, scratch, staged, text_of

LEAST_WORDS = 200
#: Distinct words and capitals in a hundred words and characters.
DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 3
ODD = "[#$%&*|]"
#: The filters of ``corpus_failures`` by the letters that name them in an order.
CORPUS_FILTERS = "ABCDE"


class _Node:
    """Branches for pass and fail, none below the last level, and the counts of all documents below."""

    __slots__ = ("counts", "high", "low")

    def __init__(self, counts: tuple[int, ...], low: _Node | None = None, high: _Node | None = None):
        self.counts, self.low, self.high = counts, low, high


class Diagram:
    """A decision diagram of failure masks; ``counts`` has those of each mask that occurs, bit *k* for filter *k*."""

    def __init__(self, counts: Mapping[int, Sequence[int]], filters: int, width: int):
        self.order = list(range(filters))
        none, ends = (0,) * width, {}
        for values in ({tuple(v) for v in counts.values()}) | {none}:
            ends[values] = _Node(values)
        # Masks in the order of a tree whose root asks for filter 0.
        row = [
            ends[tuple(counts.get(sum(1 << k for k in range(filters) if leaf >> (filters - 1 - k) & 1), none))]
            for leaf in range(1 << filters)
        ]
        self.levels: list[list[_Node]] = []
        for _ in range(filters):
            made: dict[tuple[int, int], _Node] = {}
            row = [self._node(made, row[i], row[i + 1]) for i in range(0, len(row), 2)]
            self.levels.insert(0, list(made.values()))
        self.root = row[0]

    @staticmethod
    def _node(made: dict[tuple[int, int], _Node], low: _Node, high: _Node) -> _Node:
        key = (id(low), id(high))
        if key not in made:
            made[key] = _Node(tuple(a + b for a, b in zip(low.counts, high.counts)), low, high)
        return made[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below; nodes of ``level`` stay, so those above stay right."""
        below: dict[tuple[int, int], _Node] = {}
        for node in self.levels[level]:
            low, high = node.low, node.high
            node.low = self._node(below, low.low, high.low)
            node.high = self._node(below, low.high, high.high)
        self.levels[level + 1] = list(below.values())
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path of documents that pass all: filter, counts removed, counts kept."""
        node = self.root
        for own in self.order:
            yield own, node.high.counts, node.low.counts
            node = node.low


def plain_changes(n: int) -> Iterator[int]:
    """Upper places of the adjacent swaps that lead through all orders of ``n`` things, each once."""
    if n < 2:
        return
    inner, down = plain_changes(n - 1), True
    while True:
        # The last thing walks through an order of the others, from one end to the other.
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down


def order_effects(counts: Mapping[int, Sequence[int]], names: str, width: int) -> Iterator[tuple]:
    """Per order and step: order, step, documents kept, removed, redundant, unique_fails, further counts removed, shapley."""
    n = len(names)
    diagram = Diagram(counts, n, width)
    paths = []
    for place in (None, *plain_changes(n)):
        if place is not None:
            diagram.swap(place)
        paths.append(list(diagram.steps()))
    fails, alone, total = [0] * n, [0] * n, [0] * n
    for path in paths:
        # The first step meets all documents, the last one those that pass all other filters.
        fails[path[0][0]] = path[0][1][0]
        alone[path[-1][0]] = path[-1][1][0]
        for own, removed, _ in path:
            total[own] += removed[0]
    assert len(paths) == math.factorial(n)
    for path in paths:
        order = "".join(names[own] for own, _, _ in path)
        for step, (own, removed, kept) in enumerate(path, 1):
            redundant = fails[own] - removed[0]
            yield order, step, kept[0], removed[0], redundant, alone[own], *removed[1:], total[own]


def audit(rows: DataFrame, names: str, marks: Sequence[str] = ()) -> DataFrame:
    """All orders of the filters ``names`` over ``rows`` (part, mask and 0/1 columns ``marks``), per part.

    ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``, what each mark loses
    (``lost_`` and its name) and ``shapley``, the sum over all orders of what the step's filter removes.
    """
    sums = [F.sum(F.col(m).cast("bigint")).alias(m) for m in marks]
    cells = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)
    # A part has at most two to the number of filters cells.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", F.array("n", *marks).alias("counts"))).alias("cells"))
    columns = ["kept", "removed", "redundant", "unique_fails", *(f"lost_{m}" for m in marks), "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in columns)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["part", "filter_order", "step", *columns]
        kinds = [pa.string(), pa.string(), pa.int32(), *(pa.int64() for _ in columns)]
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                effects = order_effects({c["mask"]: c["counts"] for c in cells}, names, 1 + len(marks))
                out = list(zip(*((part, *row) for row in effects)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], fields)

    return parts.mapInArrow(told, schema)


def masked(conditions: Mapping[str, Column], names: str) -> Column:
    """The mask of failed filters, bit *k* for the filter with the *k*-th of ``names``; null is no failure."""
    bits = (F.when(conditions[name], 1 << names.index(name)).otherwise(0) for name in conditions)
    return sum(bits, F.lit(0))


def text_failures() -> dict[str, Column]:
    """The filters that look at a text alone, over the columns ``text``, ``words`` (an array) and ``n_chars``."""
    words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.regexp_count("text", F.lit("[A-Z]"))
    return {
        "A": words < LEAST_WORDS,
        "B": 100 * distinct.cast("bigint") < DISTINCT_PERCENT * words.cast("bigint"),
        "C": 100 * capitals.cast("bigint") > CAPITAL_PERCENT * F.length("text").cast("bigint"),
        "D": F.col("text").rlike(ODD),
    }


def corpus_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``part`` (its language), ``mask`` of ``CORPUS_FILTERS``, ``good`` and ``toxic``."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text_of().alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    mask = masked(text_failures(), CORPUS_FILTERS).alias("mask")
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    # Texts are read once; from here on a row is an id, a mask and 32 bytes.
    rows = staged(rows.select("doc_id", "part", mask, digest), "masks")
    first = per_key(rows, ["digest"], F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    first = first.where("rows > 1").select("digest", "first")
    rows = rows.join(first, "digest", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << CORPUS_FILTERS.index("E")).otherwise(0)
    rows = rows.select("doc_id", "part", (F.col("mask") + copy).alias("mask"))

    def mark(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0))

    known = labels.where("doc_id IS NOT NULL")
    known = per_key(known, ["doc_id"], mark("quality").alias("good"), mark("toxic").alias("toxic"))
    none = F.lit(0)
    return rows.join(known, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")
    )


def corpus_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters of ``corpus_failures``, with good and toxic documents lost."""
    with scratch(docs.sparkSession):
        return staged(audit(corpus_failures(docs, labels), CORPUS_FILTERS, ["good", "toxic"]), "audit", kept=True)
