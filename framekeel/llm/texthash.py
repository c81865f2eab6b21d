"""Hashes of the words and shingles of texts, worked out over whole byte buffers with numpy.

A word is a run of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``; A-Z count as a-z, other bytes as they are.
Hashes have 64 bits and depend on the word alone, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time.
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def _piece_hashes(raw: np.ndarray) -> np.ndarray:
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers_up_to(len(raw))
    parts = _VALUES[raw] * up[: len(raw)]
    parts[~solid] = 0
    return mix(np.add.reduceat(parts, starts) * down[starts])


def _cuts(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of pieces: words and white space of at most ``PIECE_BYTES``, or one longer word."""
    start, n = 0, len(raw)
    while n - start > PIECE_BYTES:
        found = np.flatnonzero(_SPACE[raw[start : start + PIECE_BYTES]])
        if len(found):
            end = start + int(found[-1]) + 1
        else:
            end = start + PIECE_BYTES
            while end < n and not len(found := np.flatnonzero(_SPACE[raw[end : end + PIECE_BYTES]])):
                end += PIECE_BYTES
            end = end + int(found[0]) if end < n else n
        yield start, end
        start = end
    yield start, n


def _long_word_hash(raw: np.ndarray) -> np.ndarray:
    """The hash of a word that is longer than a piece."""
    up, _ = _powers_up_to(PIECE_BYTES)
    total = 0
    for at in range(0, len(raw), PIECE_BYTES):
        part = _VALUES[raw[at : at + PIECE_BYTES]]
        total += int(np.add.reduce(part * up[: len(part)])) * pow(_BASE, at, 1 << 64)
    return mix(np.array([total & _MASK], dtype=np.uint64))


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """The hash of each word of one text, given as UTF-8 bytes."""
    pieces = [(_piece_hashes if b - a <= PIECE_BYTES else _long_word_hash)(raw[a:b]) for a, b in _cuts(raw)]
    return pieces[0] if len(pieces) == 1 else np.concatenate(pieces)


def _packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; nulls count as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, offsets


def texts_word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text of a column; short texts are hashed together."""
    if not len(column):
        return
    raw, offsets = _packed(column)
    row = 0
    while row < len(column):
        # Rows that together are at most one piece, or one row that is longer.
        last = max(int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, side="right")) - 1, row + 1)
        if last == row + 1:
            yield word_hashes(raw[offsets[row] : offsets[last]])
        else:
            sizes = np.diff(offsets[row : last + 1])
            # A space between texts keeps their words apart.
            joined = np.insert(raw[offsets[row] : offsets[last]], np.cumsum(sizes)[:-1], 0x20)
            hashes = _piece_hashes(joined)
            solid = ~_SPACE[joined]
            solid[1:] &= _SPACE[joined[:-1]]
            begins = np.concatenate([[0], np.cumsum(sizes[:-1]) + np.arange(1, len(sizes)), [len(joined)]])
            ends = np.searchsorted(np.flatnonzero(solid), begins)
            for k in range(len(sizes)):
                yield hashes[ends[k] : ends[k + 1]]
        row = last


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct hashes of runs of ``width`` words in ascending order; fewer words make one run."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    rows = n - width + 1
    hashes = words[:rows] + np.uint64(width)
    for k in range(1, width):
        hashes = mix(hashes) + words[k : k + rows]
    return np.unique(mix(hashes))


def word_and_prefix_hashes(raw: np.ndarray, prefixes: tuple[int, ...]) -> np.ndarray:
    """The distinct hashes of a text's words and of the first bytes of longer words, ``prefixes`` of them."""
    found = []
    for a, b in _cuts(raw):
        if b - a > PIECE_BYTES:
            found.append(_long_word_hash(raw[a:b]))
            own = word_hashes(raw[a : a + max(prefixes) + 1])
            begin = word_and_prefix_hashes(raw[a : a + max(prefixes) + 1], prefixes)
            found.append(np.setdiff1d(begin, own))
            continue
        piece = raw[a:b]
        solid = ~_SPACE[piece]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            continue
        up, down = _powers_up_to(len(piece))
        parts = _VALUES[piece] * up[: len(piece)]
        parts[~solid] = 0
        found.append(mix(np.add.reduceat(parts, starts) * down[starts]))
        longest = max(prefixes, default=0)
        long = starts[ends - starts > min(prefixes, default=0)]
        size = (ends - starts)[ends - starts > min(prefixes, default=0)]
        total = np.zeros(len(long), dtype=np.uint64)
        for k in range(longest):
            at = np.minimum(long + k, len(piece) - 1)
            total += np.where(k < size, parts[at], np.uint64(0))
            if k + 1 in prefixes:
                longer = size > k + 1
                found.append(mix(total[longer] * down[long[longer]] ^ np.uint64((k + 1) << 56)))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.uint64)


def raw_texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of a column."""
    raw, offsets = _packed(column)
    for a, b in zip(offsets, offsets[1:]):
        yield raw[a:b]
