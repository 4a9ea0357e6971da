"""Vectorised words and shingles of Arrow text columns.

A word is a run of a-z, 0-9 and non-ASCII characters after lower-casing A-Z; other characters
separate.  Both rules act on single bytes of UTF-8, so whole column buffers are handled at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BASE, _STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
_BLOCK = 1 << 20  # bytes handled at once; small enough for the processor's cache


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, U)
    p[0] = 1
    return np.cumprod(p, dtype=U)


_POWERS = _powers(256)


def _words_of(data: np.ndarray, starts: np.ndarray,
              prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``data``; texts begin at ``starts``.

    With ``prefixes``, further rows hold the hashes of the words' first bytes, as many each.
    """
    low = _LOWER[data]
    is_word = _IS_WORD[low]
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    at = starts[starts < len(data)]
    opens[at] = is_word[at]
    here = np.flatnonzero(is_word)
    if not len(here):
        return np.empty((1 + len(prefixes), 0) if prefixes else 0, U), here
    first = np.flatnonzero(opens[here])
    lengths = np.diff(np.append(first, len(here)))
    within = np.arange(len(here)) - np.repeat(first, lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    terms = (low[here].astype(U) + U(1)) * powers[within]
    if not prefixes:
        return mix(np.add.reduceat(terms, first)), here[first]
    parts = [np.add.reduceat(np.where(within < n, terms, U(0)), first) for n in prefixes]
    return mix(np.stack([np.add.reduceat(terms, first), *parts])), here[first]


def _pieces(data: np.ndarray) -> list[tuple[int, int]]:
    """Cuts of one long text between words, about a block each."""
    cuts, at = [], 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        while end < len(data):
            gap = np.flatnonzero(~_IS_WORD[_LOWER[data[end:end + 4096]]])
            end = min(end + (gap[0] if len(gap) else 4096), len(data))
            if len(gap):
                break
        cuts.append((at, end))
        at = end
    return cuts


def column_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, limit: int = 4 << 20) -> list[tuple[int, int]]:
    """Row ranges of a text column of about ``limit`` bytes each, so that what is derived from a batch
    stays small; a longer text is a range of its own."""
    _, offsets = column_buffers(column)
    cuts, row, n = [], 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        cuts.append((row, end))
        row = end
    return cuts


def words(column: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and the bounds of each text among them.

    With ``prefixes``, the hashes have a first row for the words and one for each prefix length.
    """
    data, offsets = column_buffers(column)
    n = len(offsets) - 1
    hashes, counts = [], np.zeros(n, np.int64)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _BLOCK, "right")) - 1)
        lo, hi = offsets[row], offsets[end]
        if end == row + 1 and hi - lo > _BLOCK:
            body = data[lo:hi]
            for a, b in _pieces(body):
                h, _ = _words_of(body[a:b], np.zeros(1, np.int64), prefixes)
                hashes.append(h)
                counts[row] += h.shape[-1]
        else:
            starts = offsets[row:end + 1] - lo
            h, first = _words_of(data[lo:hi], starts[:-1], prefixes)
            hashes.append(h)
            counts[row:end] = np.diff(np.searchsorted(first, starts))
        row = end
    bounds = np.concatenate([[0], np.cumsum(counts)])
    none = np.empty((1 + len(prefixes), 0) if prefixes else 0, U)
    return np.concatenate([none, *hashes], axis=-1), bounds


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each text, in order, and bounds by text.

    A text of fewer words has one shingle of all of them; a text without words has none.
    """
    h, bounds = words(column)
    n = np.diff(bounds)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(out[-1]) + np.repeat(bounds[:-1] - out[:-1], counts)
    total = np.zeros(len(at), U)
    scale = U(1)
    last = np.repeat(bounds[1:], counts)
    padded = np.concatenate([h, np.zeros(k, U)])
    with np.errstate(over="ignore"):
        for j in range(k):
            total += np.where(at + j < last, padded[at + j], U(0)) * scale
            scale = scale * _STEP
    return mix(total), out


def unique_counts(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text in ascending order, their counts, and bounds by text."""
    values, counts, sizes = [], [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        v, c = np.unique(h[a:b], return_counts=True)
        values.append(v)
        counts.append(c)
        sizes.append(len(v))
    if not values:
        return np.empty(0, U), np.empty(0, np.int64), np.zeros(1, np.int64)
    return (np.concatenate(values), np.concatenate(counts),
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
