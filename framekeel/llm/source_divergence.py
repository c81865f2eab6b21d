"""How the sources of a language differ in their words, from stripes that tasks fold whole documents into.

A task folds its documents into a hash stripe a term and language: in how many documents the term occurs, and how
often in each source. When the stripes hold ``HELD`` counts they are spilled, so a task's memory is bounded. Spilled
stripes meet by language and term, where their counts add up source by source; a hot term sends a stripe a spill,
not a row an occurrence. Terms in at least ``LEAST_DOCUMENTS`` documents of a language are kept. The merged stripes
of a language are dealt by a hash to blocks of about ``BLOCK`` counts, each with the totals of the language's
sources, and a block emits what its terms add to the divergence of each pair of sources, and its best terms of each
source. Only sums of pairs and the best terms are left to gather.

A source gives a term the share ``p = 1 + floor(10^9 (count + 1) / (N + V))``, ``N`` being its count of all kept
terms and ``V`` their number; the language as a whole likewise. ``(p - q)^2 // q`` measures a difference. Part
``pair`` sums it over all kept terms for each ordered pair of sources, 0 without kept terms; part ``term`` has it
for the terms that a source has more often than its language, the ``TOP`` largest. All of it is integer arithmetic,
exact up to 2^47 occurrences in a language.

A null text, language or source counts as the empty string, which is a language or source like others; texts
without terms make their source known. Ties are ranked by the bytes of the item. Rows count as documents, repeated
ones too; ids and other columns are not read, so null ids and clashing names do not matter. A text is folded in pieces,
however long. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, staged, text_of

LEAST_DOCUMENTS = 3
TOP = 200
#: Counts that a task holds before it spills its stripes, and bytes of a text that it splits at a time.
HELD = 1 << 19
PIECE = 1 << 20
#: Counts in a block of merged stripes, about, and pairs of sources that a block works on at a time.
BLOCK = 1 << 15
PAIRS = 1 << 20
#: Shares are counted in units of one over this; its square fits into 64 bits.
UNIT = 10**9
# UNIT in two factors, so that a share needs no product above 64 bits.
_STEPS = 31_250, 32_000

#: Bytes of terms are letters, in lower case, and all bytes of other characters than ASCII; the rest is a space.
_TERM = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))

_STRIPES = "lang string, term string, documents bigint, sources array<string>, counts array<bigint>"


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a piece at a time."""
    parts: list[bytes] = []
    for start in range(0, len(raw), PIECE):
        piece = raw[start : start + PIECE].translate(_TERM)
        # What follows the last space may be a part of a term; it waits for the next piece.
        cut = piece.rfind(b" ") + 1
        if cut:
            yield b"".join([*parts, piece[:cut]]).split()
            parts = []
        parts.append(piece[cut:])
    yield b"".join(parts).split()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of the documents of a task, spilled whenever they hold ``HELD`` counts."""
    # Per language and term the counts by source, and the number of documents under None.
    stripes: dict[str, dict[bytes, dict[str | None, int]]] = {}
    held = 0

    def spilled() -> pa.RecordBatch:
        found = [(lang, own) for lang, own in stripes.items() if own]
        every = [stripe for _, own in found for stripe in own.values()]
        ends = np.cumsum([0, *(len(stripe) - 1 for stripe in every)], dtype=np.int32)
        sources = pa.array([s for stripe in every for s in stripe if s is not None], pa.string())
        counts = pa.array([n for stripe in every for s, n in stripe.items() if s is not None], pa.int64())
        columns = [
            pa.array([lang for lang, own in found for _ in own], pa.string()),
            pa.array([term for _, own in found for term in own], pa.binary()).cast(pa.string()),
            pa.array([stripe[None] for stripe in every], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends), sources),
            pa.ListArray.from_arrays(pa.array(ends), counts),
        ]
        stripes.clear()
        return pa.RecordBatch.from_arrays(columns, ["lang", "term", "documents", "sources", "counts"])

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text")):
            found: Counter = Counter()
            for piece in terms(text.as_buffer().to_pybytes()):
                found.update(piece)
            own = stripes.setdefault(lang, {})
            for term, n in found.items():
                stripe = own.get(term)
                if stripe is None:
                    own[term] = {None: 1, source: n}
                    held += 1
                    continue
                stripe[None] += 1
                if source in stripe:
                    stripe[source] += n
                else:
                    stripe[source] = n
                    held += 1
            if held >= HELD:
                yield spilled()
                held = 0
    yield spilled()


def stripes(docs: DataFrame) -> DataFrame:
    """The merged stripe of each language and kept term: ``lang``, ``term``, ``documents``, ``cells`` (source, n)."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), text_of().alias("text"))
    folded = rows.mapInArrow(_fold, _STRIPES)
    # The number of documents goes with the first count of a stripe.
    zipped = F.transform(
        F.arrays_zip("sources", "counts"),
        lambda x, i: F.struct(
            x["sources"].alias("source"),
            x["counts"].alias("n"),
            F.when(i == 0, F.col("documents")).otherwise(0).alias("documents"),
        ),
    )
    cells = folded.select("lang", "term", F.inline(zipped))
    sums = cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    merged = sums.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("cells")
    )
    return merged.where(F.col("documents") >= LEAST_DOCUMENTS)


def totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Per source of a language: ``lang``, ``source``, ``n`` of its kept terms, the language's ``terms`` and ``blocks``,
    and the ``slab`` of sources it is in, of ``slabs``."""
    names = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    groups = docs.select(*names).distinct()
    cells = kept.select("lang", F.inline("cells"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells"))
    rows = groups.join(sizes, ["lang", "source"], "left").na.fill(0, ["n", "cells"])
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    own = rows.groupBy("lang").agg(F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("sources"))
    own = own.join(vocabulary, "lang", "left").na.fill(0, ["terms"])
    own = own.select(
        "lang",
        "terms",
        (F.floor(F.col("cells") / BLOCK) + 1).alias("blocks"),
        (F.floor(F.col("sources") * F.col("sources") / PAIRS) + 1).alias("slabs"),
    )
    number = F.pmod(F.xxhash64("source"), F.col("slabs")).alias("slab")
    return rows.join(own, "lang").select("lang", "source", "n", "terms", "blocks", "slabs", number)


def shares(counts: np.ndarray, n: np.ndarray | int, vocabulary: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + 1) / (n + vocabulary))``, without overflow."""
    whole = np.asarray(n, dtype=np.int64) + vocabulary
    first, rest = np.divmod((counts + 1) * _STEPS[0], whole)
    return 1 + first * _STEPS[1] + rest * _STEPS[1] // whole


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


_EMITTED = pa.schema(
    [("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]
)


def _emit(key: tuple, block: pa.Table, sources: pa.Table) -> pa.Table:
    """What the terms of a block add to the pairs of the slab's sources with all others, and its best terms."""
    lang, slab = key[0].as_py(), key[2].as_py()
    out: list[tuple[str, list[str], list[str], np.ndarray]] = []
    if not sources.num_rows:
        return _EMITTED.empty_table()
    sources = sources.sort_by("source")
    names = sources.column("source").to_pylist()
    mine = np.flatnonzero(sources.column("own_slab").to_numpy() == slab)
    n = sources.column("n").to_numpy()
    vocabulary = sources.column("terms")[0].as_py()
    pairs = np.zeros((len(mine), len(names)), dtype=np.int64)
    if block.num_rows:
        # The count of each term of the block in each source that has it.
        cells = block.column("cells").combine_chunks()
        term = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy())
        flat = cells.flatten()
        own = pc.index_in(flat.field("source"), value_set=sources.column("source").combine_chunks()).to_numpy()
        count = flat.field("n").to_numpy()
        share = shares(count, n[own], vocabulary)
        zero = shares(np.zeros(len(n), dtype=np.int64), n, vocabulary)
        pairs += len(cells) * difference(zero[mine][:, None], zero[None, :])
        place = np.full(len(names), -1)
        place[mine] = np.arange(len(mine))
        # Rows of all sources' shares, for as many terms as make about PAIRS numbers.
        step = max(PAIRS // len(names), 1)
        for first in range(0, len(cells), step):
            a, b = np.searchsorted(term, [first, first + step])
            rows = np.tile(zero, (min(step, len(cells) - first), 1))
            rows[term[a:b] - first, own[a:b]] = share[a:b]
            seen = np.zeros(rows.shape, dtype=bool)
            seen[term[a:b] - first, own[a:b]] = True
            for source in np.unique(own[a:b]):
                has = rows[seen[:, source]]
                if place[source] >= 0:
                    # Terms that the source has, against all others, in place of two shares of none.
                    change = difference(has[:, source][:, None], has).sum(axis=0)
                    pairs[place[source]] += change - len(has) * difference(zero[source], zero)
                # Terms that the source has and one of the slab has not.
                lacking = ~seen[seen[:, source]][:, mine]
                change = difference(zero[mine][None, :], has[:, source][:, None])
                change -= difference(zero[mine], zero[source])[None, :]
                pairs[:, source] += np.where(lacking, change, 0).sum(axis=0)
        whole = np.zeros(len(cells), dtype=np.int64)
        np.add.at(whole, term, count)
        everywhere = shares(whole, int(n.sum()), vocabulary)
        above = share > everywhere[term]
        value = difference(share, everywhere[term])
        words = block.column("term").combine_chunks()
        for at in mine:
            chosen = np.flatnonzero(above & (own == at))
            if len(chosen) > TOP:
                # All that tie with the last one; the ranks decide among them.
                least = np.partition(value[chosen], len(chosen) - TOP)[len(chosen) - TOP]
                chosen = chosen[value[chosen] >= least]
            out.append(("term", [names[at]] * len(chosen), words.take(pa.array(term[chosen])).to_pylist(), value[chosen]))
    for row, at in enumerate(mine):
        others = [k for k in range(len(names)) if k != at]
        out.append(("pair", [names[at]] * len(others), [names[k] for k in others], pairs[row][others]))
    size = sum(len(o[1]) for o in out)
    if not size:
        return _EMITTED.empty_table()
    columns = [
        pa.array([lang] * size, pa.string()),
        pa.array([o[0] for o in out for _ in o[1]], pa.string()),
        pa.array([s for o in out for s in o[1]], pa.string()),
        pa.array([i for o in out for i in o[2]], pa.string()),
        pa.array(np.concatenate([o[3] for o in out]), pa.int64()),
    ]
    return pa.Table.from_arrays(columns, schema=_EMITTED)


def divergences(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of all pairs of sources and of the best terms."""
    with scratch(docs.sparkSession):
        kept = staged(stripes(docs), "stripes")
        sources = staged(totals(docs, kept), "source-totals")
        # Written, so that Spark knows its size and broadcasts it while it is small.
        langs = staged(sources.select("lang", "blocks", "slabs").distinct(), "language-blocks")
        numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slabs") - 1)).alias("slab")
        dealt = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
        dealt = dealt.select("lang", "block", numbers, "term", "cells")
        blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")
        known = sources.select("lang", blocks, "source", "n", "terms", "slabs", F.col("slab").alias("own_slab"))
        known = known.select("lang", "block", numbers, "source", "n", "terms", "own_slab")
        keys = ["lang", "block", "slab"]
        emitted = dealt.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(
            _emit, "lang string, part string, source string, item string, value bigint"
        )
        emitted = staged(emitted, "divergences")
        by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        columns = ["lang", "source", "part", "item", "value", F.row_number().over(by_value).alias("rank")]
        pairs = emitted.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
        best = emitted.where("part = 'term'").select(*columns).where(F.col("rank") <= TOP)
        return staged(pairs.select(*columns).unionByName(best), "source-divergence", kept=True)
