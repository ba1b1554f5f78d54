"""Words and shingles of many texts at once, as arrays over the bytes of an Arrow column.

A word is a run of bytes other than space and 0x09 to 0x0D; A to Z count as a to z. Words are
known by a 64-bit hash, so a column of texts becomes a few integer arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once, and of the slices of an Arrow batch where its texts take much
#: more room while they are worked on; a longer text is a piece or a slice of its own.
PIECE_BYTES, SLICE_BYTES = 1 << 21, 1 << 19

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_STEPS = tuple(_U(c) for c in (
    0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
    0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = max(1 << n.bit_length(), SLICE_BYTES) + 1
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _STEPS[0]
    h ^= h >> _U(27)
    h *= _STEPS[1]
    h ^= h >> _U(31)
    return h


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of batches with a ``text`` in slices of at most ``size`` bytes of it, or of one row.

    A batch may hold thousands of long texts; what is made of them is held for one slice only.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        first = 0
        while first < len(lengths):
            last = max(int(np.searchsorted(at, at[first] + size, side="right")) - 1, first + 1)
            yield batch.slice(first, last - first)
            first = last


def lowered(column: pa.Array) -> pa.Array:
    """The texts in lower case, letters beyond ASCII too (null stays null)."""
    return pc.utf8_lower(column.cast(pa.large_string()))


@dataclass
class Words:
    """Words of the texts ``first`` to ``last`` of a column, in order."""

    first: int
    last: int
    data: np.ndarray  #: folded bytes of the texts, one after the other
    text_at: np.ndarray  #: where each text begins in ``data``, and the end
    start: np.ndarray  #: first byte of each word in ``data``
    end: np.ndarray  #: byte after each word
    hash: np.ndarray  #: 64-bit hash of each word
    word_at: np.ndarray  #: index of each text's first word, and the number of words


def pieces(column: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts of a column (null: empty) in pieces: first, last, bytes, offsets."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + piece_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def words(
    column: pa.Array, breaks: str = "", piece_bytes: int = PIECE_BYTES, spelled: bool = False,
    fold: bool = True,
) -> Iterator[Words]:
    """Words of every text of the column, piece by piece.

    ``breaks`` are further ASCII characters that end a word and belong to none. With ``spelled``,
    single characters with one space between them make one word. Without ``fold``, A to Z stay.
    """
    space = _SPACE.copy()
    for c in breaks:
        space[ord(c)] = True
    for first, last, raw, text_at in pieces(column, piece_bytes):
        data = _FOLD[raw] if fold else raw
        inside = ~space[data]
        if spelled:
            inside |= _between_single(inside, text_at)
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        starts_text = text_at[:-1][text_at[:-1] < len(data)]
        before[starts_text] = False
        start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends_text = text_at[1:][text_at[1:] > 0] - 1
        after[ends_text] = False
        end = np.flatnonzero(inside & ~after) + 1
        yield Words(first, last, data, text_at, start, end,
                    span_hash(data, start, end), np.searchsorted(start, text_at))


def _between_single(inside: np.ndarray, text_at: np.ndarray) -> np.ndarray:
    """Which single gaps have a word of one byte on either side, in one text."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[text_at] = True
    gap = ~inside
    single = inside.copy()
    single[1:] &= gap[:-1] | edge[1:-1]
    single[:-1] &= gap[1:] | edge[1:-1]
    found = np.zeros(len(inside), dtype=bool)
    found[1:-1] = gap[1:-1] & single[:-2] & single[2:] & ~edge[1:-2] & ~edge[2:-1]
    return found


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives 64-bit hashes of byte spans of ``data``."""
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)], out=total[1:])

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (total[end] - total[start]) * down[start]
        return mixed(h ^ ((end - start).astype(np.uint64) * _STEPS[2]))

    return hashes


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hasher(data)(start, end)


def word_hash(word: str) -> int:
    """The hash ``words`` gives one word."""
    data = _FOLD[np.frombuffer(word.encode(), dtype=np.uint8)]
    return int(span_hash(data, np.array([0]), np.array([len(data)]))[0])


def shingle_sets(found: Words, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    h, at = found.hash, found.word_at
    rolled = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
    for i in range(size):
        rolled += (h[i:len(rolled) + i] ^ _STEPS[i % 5]) * (_STEPS[(i + 1) % 5] + _U(2 * (i // 5)))
        rolled = rolled * _STEPS[0] ^ (rolled >> _U(29))
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            whole = np.full(1, b - a, dtype=np.uint64)
            for x in h[a:b]:
                whole = mixed((whole ^ x) * _STEPS[3])
            sets.append(whole)
        else:
            sets.append(h[:0])
    return sets
