"""Runs of periodic words, found by Lyndon arrays under both orders.

Phase one of Baier's suffix sorter groups the suffixes of a word sequence by their longest Lyndon
prefix, from the highest group down, and so gives the Lyndon array directly, without sorting
suffixes. Every run has a root that is the longest Lyndon word at its place under one of two
opposite orders of words; each such root is extended to both sides as far as the text repeats (by
longest common extensions), and is a run if it covers two periods or more.

A run of a given least length repeats some run of half as many words. So only stretches of a text
that are covered by word n-grams occurring twice in it are sorted; no run reaches beyond one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinspan.llm.words import (
    gram_hashes,
    is_break,
    mix,
    ragged,
    row_slices,
    text_bytes,
    whole_grams,
    word_bounds,
    word_hashes,
)

LEAST = 12  # words of a run


def lyndon_array(ranks: list[int], letters: int) -> list[int]:
    """Length of the longest Lyndon word at each place of a sequence of ranks below `letters`.

    Groups of suffixes are taken from the highest down. The members of a group are unlinked; each
    points to the nearest suffix before it that is still linked, which is in a lower group. A
    suffix that `times` members point to is followed by as many copies of the group's word, so it moves to
    a new group right above its old one, whose word is longer by them.
    """
    n = len(ranks)
    group = list(ranks)
    members: list[list[int]] = [[] for _ in range(letters)]
    for i, rank in enumerate(ranks):
        members[rank].append(i)
    width = [1] * letters
    below, above = list(range(-1, letters - 1)), [*range(1, letters), -1]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    found = [0] * n
    at = letters - 1
    while at >= 0:
        size, hits, times, most = width[at], [], [], 0
        for i in members[at]:
            if group[i] != at:
                continue
            found[i] = size
            before, after = left[i], right[i]
            if after < n:
                left[after] = before
            if before < 0:
                continue
            right[before] = after
            if hits and hits[-1] == before:
                times[-1] += 1
            else:
                hits.append(before)
                times.append(1)
        # A suffix may be pointed to before another of its own group is unlinked: count only the linked.
        most = max(times, default=0)
        order = range(len(hits)) if most < 2 else sorted(range(len(hits)), key=times.__getitem__, reverse=True)
        made: dict[tuple[int, int], int] = {}
        for k in order:
            i, copies = hits[k], times[k]
            old = group[i]
            new = made.get((old, copies))
            if new is None:
                new = made[old, copies] = len(width)
                width.append(width[old] + copies * size)
                members.append([])
                top = above[old]
                below.append(old)
                above.append(top)
                above[old] = new
                if top >= 0:
                    below[top] = new
            group[i] = new
            members[new].append(i)
        at = below[at]
    return found


class _Extensions:
    """Longest common extensions by prefix hashes, for many places at once."""

    def __init__(self, ids: np.ndarray) -> None:
        base = np.uint64(0x9E3779B97F4A7C15)
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(ids), base)]))
        steps = mix(ids.astype(np.uint64) + np.uint64(1)) * self.powers[:-1]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(steps)])

    def _same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        first, second = self.sums[i + size] - self.sums[i], self.sums[j + size] - self.sums[j]
        return first * self.powers[j - i] == second

    def ahead(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many ids from `i` on equal those from `j` on, `most` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            same = self._same(i, j, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def behind(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many ids before `i` equal those before `j`, `most` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            same = self._same(i - half, j - half, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def find_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Runs (start, end, period) of sequences laid end to end, by start, then period.

    `bounds` are the places at which sequences begin, and the end of the last. Equal ids are equal words.
    """
    opposite, lengths = [], []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        _, ranks = np.unique(ids[low:high], return_inverse=True)
        letters = int(ranks.max()) + 1 if len(ranks) else 0
        lengths += lyndon_array(ranks.tolist(), letters)
        opposite += lyndon_array((letters - 1 - ranks).tolist(), letters)
    if not lengths:
        return np.zeros((0, 3), np.int64)
    begin = np.repeat(bounds[:-1], np.diff(bounds))
    end = np.repeat(bounds[1:], np.diff(bounds))
    places = np.arange(len(ids))
    roots = np.unique(
        np.concatenate(
            [np.stack([places, np.array(found, np.int64)], axis=1) for found in (lengths, opposite)]
        ),
        axis=0,
    )
    i, period = roots.T
    inside = i + period < end[i]
    i, period = i[inside], period[inside]
    repeats = ids[i] == ids[i + period]
    i, period = i[repeats], period[repeats]
    extend = _Extensions(ids)
    start = i - extend.behind(i, i + period, i - begin[i])
    stop = i + period + extend.ahead(i, i + period, end[i] - i - period)
    runs = np.stack([start, stop, period], axis=1)
    runs = np.unique(runs[stop - start >= np.maximum(least, 2 * period)], axis=0)
    checked = []
    for low, high, p in runs.tolist():
        if not np.array_equal(ids[low : high - p], ids[low + p : high]):
            raise RuntimeError("two word sequences have one 64-bit hash")
        checked.append((low, high, p))
    return np.array(sorted(checked, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def repeated_stretches(grams: np.ndarray, whole: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """-> starts and ends of the stretches of words that lie in word n-grams met twice in their text."""
    words = int(first[-1])
    at = np.flatnonzero(whole)
    none = np.zeros(0, np.int64)
    if len(at) == 0:
        return none, none
    text = np.searchsorted(first, at, side="right").astype(np.uint64)
    keys = mix(grams[at] ^ mix(text))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = at[twice]
    if len(at) == 0:
        return none, none
    cover = np.zeros(words + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    covered = np.cumsum(cover[:-1]) > 0
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    edges = first[:-1][first[:-1] < words]
    opens[edges] = covered[edges]
    closes = covered.copy()
    closes[:-1] &= ~covered[1:]
    ends = first[1:][first[1:] > 0] - 1
    closes[ends] = covered[ends]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def text_runs(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray]:
    """Texts as bytes and word bounds -> text number and (start, length, period) of every run."""
    none = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    n = max(1, least // 2)
    grams = gram_hashes(word_hashes(data, starts, ends), n)
    low, high = repeated_stretches(grams, whole_grams(first, n, len(starts)), first, n)
    if len(low) == 0:
        return none
    raw = data.tobytes()
    words = ragged(low, high - low)
    numbers: dict[bytes, int] = {}
    ids = np.array(
        [
            numbers.setdefault(raw[s:e], len(numbers))
            for s, e in zip(starts[words].tolist(), ends[words].tolist(), strict=True)
        ],
        np.int64,
    )
    bounds = np.concatenate([[0], np.cumsum(high - low)])
    runs = find_runs(ids, bounds, least)
    place = words[runs[:, 0]] if len(runs) else runs[:, 0]
    text = np.searchsorted(first, place, side="right") - 1
    spans = np.stack([place - first[text], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return text, spans


def _kept(first: np.ndarray, text: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run has after its first period."""
    change = np.zeros(int(first[-1]) + 1, np.int64)
    begin = first[text] + spans[:, 0]
    np.add.at(change, begin + spans[:, 2], 1)
    np.add.at(change, begin + spans[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _joined(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray
) -> pa.Array:
    """The kept words of each text, joined by single spaces."""
    texts = len(first) - 1
    at = np.flatnonzero(kept)
    if len(at) == 0:
        return pa.array([""] * texts, pa.string())
    text = np.searchsorted(first, at, side="right") - 1
    last = np.append(text[1:] != text[:-1], True)
    out, take = data.copy(), np.zeros(len(data), bool)
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts[at]] = 1
    mark[ends[at]] -= 1
    np.cumsum(mark, out=mark)
    take = mark[:-1] > 0
    gaps = ends[at[~last]]  # a word that another follows in its text has white space after it
    out[gaps] = 32
    take[gaps] = True
    sizes = ends[at] - starts[at] + ~last
    lengths = np.bincount(text, weights=sizes, minlength=texts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[take].tobytes())]
    return pa.Array.from_buffers(pa.string(), texts, buffers)


RUNS = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """-> doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    A row per row, whatever its id; other columns are not read. Words are runs of anything but
    ASCII white space, numbered from 0. A run is a stretch of at least `least` words and of two
    periods, with its smallest period, that no neighbouring word prolongs. `collapsed` has the
    words, joined by single spaces, but for those that some run contains after its first period.
    Null and empty texts have no words. No shuffle: a text is read by one task, in slices of whole texts,
    and needs some 100 bytes a word of memory while it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for low, high in row_slices(at):
                own, own_at = data[at[low] : at[high]], at[low : high + 1] - at[low]
                starts, ends, first = word_bounds(own, own_at, is_break(own) if len(own) else None)
                text, spans = text_runs(own, starts, ends, first, least)
                counts = np.bincount(text, minlength=high - low)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                fields = [pa.array(spans[:, k]) for k in range(3)]
                runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(item)))
                kept = _kept(first, text, spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.diff(first)),
                        runs,
                        _joined(own, starts, ends, first, kept),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    narrow = docs.select(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))
    return narrow.mapInArrow(run, RUNS)
