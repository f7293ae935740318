"""Words of a whole Arrow batch as numpy arrays: hashes, owners and byte ranges, with no Python loop over words.

A text is taken in pieces of a batch (``pieces``), so the arrays stay small whatever the batch size; one text is never cut.
Null texts count as empty. Bytes are UTF-8; since every delimiter is ASCII, no character is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE = 1 << 20
_STEP = U64(0x9E3779B97F4A7C15)  # odd, so its powers can be inverted


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


_VALUES = mix((np.arange(256, dtype=U64) + U64(1)) * _STEP)[_lowered()]

#: Anything but blank and 0x09 to 0x0D.
SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII letters and digits, and all bytes of other characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        inverse = U64(pow(int(_STEP), -1, 1 << 64))
        up, down = np.full(size, _STEP, dtype=U64), np.full(size, inverse, dtype=U64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more for the end)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    got = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return got[at[0] : at[-1]], at - at[0]


def pieces(texts: pa.Array | pa.ChunkedArray, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows with about ``limit`` bytes, never fewer than one row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # nothing to combine
        texts = pa.array([], type=pa.large_string())
    data, at = raw(texts)
    first = 0
    while first < len(at) - 1:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(at) - 1)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


@dataclass
class Words:
    """Per word: hash, text it belongs to, byte range. ``counts``: words of each text."""

    hashes: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray


def words(data: np.ndarray, at: np.ndarray, solid: np.ndarray = SOLID) -> Words:
    """Maximal runs of solid bytes within each text, hashed with A-Z lowered."""
    n = len(data)
    texts = len(at) - 1
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(U64), none, none, none, np.zeros(texts, dtype=np.int64))
    inside = solid[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = at[:-1][at[:-1] < n]
    before[edges] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = at[1:][at[1:] > 0] - 1
    after[ends] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    up, down = power_tables(n + 1)
    total = np.empty(n + 1, dtype=U64)
    total[0] = 0
    np.cumsum(_VALUES[data] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    counts = np.diff(np.searchsorted(start, at))
    return Words(hashes, np.repeat(np.arange(texts), counts), start, end, counts)


def _factor(place: int) -> np.uint64:
    """An odd multiplier for each place of a tuple, so that order counts."""
    return U64((int(_STEP) * (2 * place + 1) ** 3 + 4 * place) & 0xFFFFFFFFFFFFFFFF | 1)


def grams(hashes: np.ndarray, owner: np.ndarray, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of word tuples at the given distances, none across two texts."""
    reach = offsets[-1]
    n = len(hashes) - reach
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    got = np.zeros(n, dtype=U64)
    for k, d in enumerate(offsets):
        got += hashes[d : d + n] * _factor(k)
    at = np.flatnonzero(owner[:n] == owner[reach : reach + n])
    return at, mix(got[at])


def shingle_sets(w: Words, width: int = 5) -> list[np.ndarray]:
    """Distinct hashes of ``width`` consecutive words of each text, sorted; a text with fewer words is one shingle."""
    at, hashes = grams(w.hashes, w.owner, tuple(range(width)))
    bounds = np.searchsorted(w.owner[at], np.arange(len(w.counts) + 1))
    firsts = np.concatenate([[0], np.cumsum(w.counts)])
    sets = []
    for i, count in enumerate(w.counts):
        if count >= width:
            sets.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
        elif count:
            own = w.hashes[firsts[i] : firsts[i] + count]
            factor = np.array([_factor(k + width) for k in range(count)], dtype=U64)
            sets.append(mix((own * factor).sum(dtype=U64, keepdims=True)))
        else:
            sets.append(np.zeros(0, dtype=U64))
    return sets
