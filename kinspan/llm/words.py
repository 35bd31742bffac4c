"""Arrow string columns as byte arrays: byte-balanced slices, word bounds and word hashes.

All of it is vectorised over a slice of documents. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# Words are runs of anything but these bytes (fixed values): tab, LF, VT, FF, CR and space.
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
# Odd multipliers of the hash functions.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_M3 = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """-> the UTF-8 bytes of all texts and, one more than texts, where each starts."""
    if pa.types.is_large_string(column.type) or pa.types.is_string(column.type):
        column = column.fill_null("")
    else:
        column = column.cast(pa.string()).fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def row_slices(at: np.ndarray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [first, last) of about `max_bytes`; a longer text gets a run of its own."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def is_break(data: np.ndarray) -> np.ndarray:
    return _BREAK[data]


def word_bounds(
    data: np.ndarray, at: np.ndarray, breaks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """-> starts and ends of all words, and, one more than texts, the first word of each text."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    inside = ~(_BREAK[data] if breaks is None else breaks)
    opens = np.empty(len(data), bool)
    opens[0] = True
    np.logical_not(inside[:-1], out=opens[1:])
    opens[at[:-1][at[:-1] < len(data)]] = True
    opens &= inside
    closes = np.empty(len(data), bool)
    closes[-1] = True
    np.logical_not(inside[1:], out=closes[:-1])
    closes[at[1:][at[1:] > 0] - 1] = True
    closes &= inside
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: equal ranges, and but for chance only those, hash alike."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    left = ends - starts
    hashes = left.astype(np.uint64) * _M3
    todo, here = None, starts
    while True:
        got = eights[here] & _MASKS[np.minimum(left, 8)]
        if todo is None:
            hashes = mix(hashes ^ got)
        else:
            hashes[todo] = mix(hashes[todo] * _M3 ^ got)
        more = left > 8
        if not more.any():
            return hashes
        todo = np.flatnonzero(more) if todo is None else todo[more]
        here, left = here[more] + 8, left[more] - 8


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of `n` consecutive words, across texts too."""
    grams = len(words) - n + 1
    if grams <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(grams, np.uint64)
    factor = 0x9E3779B97F4A7C15 ^ (2 * seed)
    for i in range(n):
        total += words[i : i + grams] * np.uint64(factor)
        factor = factor * 0x5851F42D4C957F2D % 2**64 | 1
    return mix(total)


def whole_grams(first: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which runs of `n` words, by their first word, lie within one text."""
    grams = words - n + 1
    if grams <= 0:
        return np.zeros(0, bool)
    whole = np.ones(grams, bool)
    for i in range(1, n):  # a run may not hold the last i words of a text as its first ones
        at = first[1:] - i
        whole[at[(at >= 0) & (at < grams) & (at >= first[:-1])]] = False
    return whole


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the ranges [start, start + length), one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    jumps = np.ones(total, np.int64)
    full = lengths > 0
    starts, lengths = starts[full], lengths[full]
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    jumps[heads] = starts - np.concatenate([[0], starts[:-1] + lengths[:-1] - 1])
    return np.cumsum(jumps)
