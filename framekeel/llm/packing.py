"""Packing of tokenised documents into sequences of fixed length, best fit first and improved by local search.

Each document becomes its token ids and an end id. A document longer than a sequence is cut into whole sequences,
with what is left over as its first piece; nothing else is cut. Whole pieces are sequences by themselves. The
others are dealt to groups of about ``GROUP`` by a hash of their row, and each group is packed on its own from
lengths alone: longest first, each into the fullest sequence it fits. Then sequences that are not full trade
pieces, one for one, two of any other sequence for one, or one moved, whenever that raises the sum of squared fills,
which drains the emptier sequences until they are gone. The sum rises with each trade, so the search ends by itself,
when no trade is left. A group that is packed again gives the same sequences.

Tokenising is a map over Arrow batches and keeps no more than one; only piece numbers and lengths are shuffled.

A null text counts as empty, and an empty text is a piece of its end id alone. Very long texts are tokenised whole, in
the task that reads them. Repeated rows and null ids are documents of their own; an id may have any type; other columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, staged, text_of

LENGTH = 2048
END_ID = 0
#: Pieces packed together, on average.
GROUP = 8192
#: Numbers of sequences that are one whole piece start here.
WHOLE = 1 << 62
#: How byte-level BPE splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file, run by ``tiktoken``: the same ids, several times faster.

    As there, the string of a special token inside a text is that token.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    # Vocabularies write a byte as itself if it is printable, the others in turn as letters from U+0100 on.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}
    special = {token["content"]: token["id"] for token in model["added_tokens"]}
    vocabulary = model["model"]["vocab"].items()
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in vocabulary if token not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(path: str, text: str) -> np.ndarray:
    """The ids of a document, the end id last."""
    ids = encoder(path).encode_to_numpy(text, allowed_special="all")
    return np.append(ids, np.uint32(END_ID)).astype("<u4")


def pieces_of(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``number``, ``row_id``, ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids``.

    ``ids`` are the piece's ids as little-endian 32-bit numbers, null unless ``with_ids``.
    """
    rows = numbered(docs.select("doc_id", text_of().alias("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = []
            for row, text in enumerate(batch.column("text")):
                ids = token_ids(path, text.as_py())
                first = len(ids) % length or length
                bounds = [0, *range(first, len(ids) + 1, length)]
                for piece, (start, end) in enumerate(zip(bounds, bounds[1:])):
                    raw = ids[start:end].tobytes()
                    cuts.append((row, piece, start, end - start, zlib.crc32(raw), raw if with_ids else None))
            row, piece, start, size, checksum, kept = zip(*cuts) if cuts else [()] * 6
            own = pa.array(row, pa.int64())
            columns = [batch.column(c).take(own) for c in ("row_id", "doc_id")]
            columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, checksum))]
            names = ["row_id", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())], names)

    schema = rows.select("row_id", "doc_id").schema.add("piece", "integer")
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, "long")
    schema = schema.add("ids", "binary")
    pieces = rows.select("row_id", "doc_id", "text").mapInArrow(cut, schema)
    return pieces.withColumn("number", F.monotonically_increasing_id())


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indexes by bin: longest first, each into the bin with the least space that is enough."""
    spaces: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    open_spaces = 0  # bit k is set if some bin has space k
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = open_spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = spaces[space].pop()
            if not spaces[space]:
                open_spaces ^= 1 << space
        else:
            space, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        spaces[space - size].append(chosen)
        open_spaces |= 1 << (space - size)
    return bins


def trade(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Move or swap items between bins that are not full while that raises the sum of squared fills.

    Each bin in turn, the fullest first, asks for an item, or two, that fill its space or replace one of its items
    by more; a bin with less in it gives them and takes the replaced item. A bin that has nothing left is gone.
    The sum rises with each trade and is bounded, so a round without any comes.
    """
    size = lengths.tolist()
    fill = [sum(size[i] for i in items) for items in bins]
    while True:
        loose = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: (-fill[b], b))
        by_size: list[set[int]] = [set() for _ in range(capacity + 1)]
        home = {}
        for b in loose:
            for i in bins[b]:
                by_size[size[i]].add(i)
                home[i] = b
        sizes = sum(1 << s for s in range(capacity + 1) if by_size[s])
        gained = False

        def give(item: int, to: int) -> None:
            source = home[item]
            bins[source].remove(item)
            bins[to].append(item)
            fill[source] -= size[item]
            fill[to] += size[item]
            home[item] = to

        def wanted(most: int, least: int, b: int, without: int = -1) -> int | None:
            """An item of at most ``most`` and more than ``least``, of a bin with less in it than ``b``."""
            left = sizes & ((1 << (most + 1)) - 1)
            while left and (s := left.bit_length() - 1) > least:
                for i in by_size[s]:
                    if i != without and home[i] != b and fill[home[i]] < fill[b]:
                        return i
                left ^= 1 << s
            return None

        for b in loose:
            if not bins[b]:
                continue
            space = capacity - fill[b]
            if space and (item := wanted(space, 0, b)) is not None:
                give(item, b)
                gained = True
                space = capacity - fill[b]
            for own in sorted(bins[b], key=lambda i: (size[i], i)):
                if not space:
                    break
                most = size[own] + space
                item = wanted(min(most, capacity), size[own], b)
                if item is None:
                    continue
                # A second item of the same bin may come along with it.
                source = home[item]
                rest = most - size[item]
                second = max(
                    (i for i in bins[source] if i != item and size[i] <= rest), key=lambda i: (size[i], -i), default=None
                )
                give(item, b)
                give(own, source)
                if second is not None:
                    give(second, b)
                gained = True
                space = capacity - fill[b]
        # Two for one is looked for when nothing simpler is left.
        if not gained:
            gained = _two_for_one(size, bins, fill, [b for b in loose if bins[b]], capacity, give)
        if not gained:
            return [items for items in bins if items]


def _two_for_one(
    size: list[int], bins: list[list[int]], fill: list[int], loose: list[int], capacity: int, give: Callable[[int, int], None]
) -> bool:
    """Swap one item of a bin for two of another that fill more of it, wherever that raises the squares.

    ``loose`` are the bins, the fullest first. The pairs of all of them are found by size; a bin trades once.
    """
    by_size: dict[int, list[tuple[int, int, int]]] = {}
    for b in loose:
        # Of a bin's pairs of one size any will do.
        own = {size[one] + size[two]: (b, one, two) for one, two in combinations(bins[b], 2)}
        for pair, found in own.items():
            by_size.setdefault(pair, []).append(found)
    sizes = sum(1 << s for s in by_size)
    traded: set[int] = set()
    for b in loose:
        best = None
        for own in bins[b] if b not in traded else ():
            most, least = size[own] + capacity - fill[b], size[own] + (best[0] if best else 0)
            left = sizes & ((1 << (most + 1)) - 1)
            while left and (s := left.bit_length() - 1) > least:
                # The emptiest bin comes last.
                givers = (p for p in reversed(by_size[s]) if p[0] != b and p[0] not in traded)
                pair = next(givers, None)
                if pair and fill[pair[0]] < fill[b] + s - size[own]:
                    best = (s - size[own], own, *pair)
                    break
                left ^= 1 << s
        if best:
            _, own, source, one, two = best
            give(one, b)
            give(two, b)
            give(own, source)
            traded |= {b, source}
    return bool(traded)


def pack(pieces: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``pieces``, without ``ids``, with ``sequence_id`` and the ``offset`` in that sequence; write ``pieces`` before."""
    meta = pieces.drop("ids")
    parts = meta.where(F.col("length") < length)
    groups = max(1, -(-parts.count() // group))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number", ignore_index=True)
        lengths = rows["length"].to_numpy()
        sequence, offset = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
        for k, items in enumerate(trade(lengths, best_fit(lengths, length), length)):
            sequence[items] = k
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        return rows.assign(sequence_id=rows["pack_group"] * (1 << 32) + sequence, offset=offset)

    dealt = parts.withColumn("pack_group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    schema = dealt.schema.simpleString()[len("struct<") : -1] + ",sequence_id:bigint,offset:bigint"
    done = dealt.groupBy("pack_group").applyInPandas(packed, schema).drop("pack_group")
    whole = meta.where(F.col("length") == length).withColumn("sequence_id", F.col("number") + WHOLE)
    return done.unionByName(whole.withColumn("offset", F.lit(0).cast("bigint")))


def packed_documents(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` in their sequences, with their ids if ``with_ids``."""
    pieces = pieces_of(docs, path, length, with_ids=with_ids)
    pieces = staged(pieces if with_ids else pieces.drop("ids"), "pieces")
    places = pack(pieces, length)
    return places.join(pieces.select("number", "ids"), "number") if with_ids else places
