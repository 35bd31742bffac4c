"""Substring dedup: words of passages that occur elsewhere go, found by suffix automata.

A window of words can only repeat where its least run of RUN words, its anchor, repeats too; equal
windows have the same anchor at the same place. So each text is cut into segments: the windows in
a row that share an anchor. Segments with equal anchors make a shard of the reference, which is all
that a segment can have in common with the corpus. A segment that occurs twice is removed in full.
Different segments of a shard are streamed through the shard's suffix automaton, whose states know
how often they occur: the longest suffix that occurs twice, if as long as a window, is part of a
maximal span to remove. The automata go to the segments by a shuffle on the anchor; as the corpus
is its own reference they could not all be broadcast. Shards of more than SHARD segments, the ends
of very common passages, count their windows' hashes instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.llm.tables import bitmap, in_bitmap, sorted_groups, stored
from kinspan.llm.words import (
    gram_hashes,
    mix,
    ragged,
    row_slices,
    text_bytes,
    whole_grams,
    word_bounds,
    word_hashes,
)
from kinspan.operators.skew import skew_join

WINDOW = 35
RUN = 10
SHARD = 64
HOT_SEGMENTS = 25_000

_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


class _Ranges:
    """Hashes of any ranges of a sequence of word hashes."""

    def __init__(self, words: np.ndarray) -> None:
        summed = np.cumsum(words * _powers(_BASE, len(words)), dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), summed])
        self.back = _powers(_BASE_INVERSE, len(words) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        span = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(span + (ends - starts).astype(np.uint64))


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """Where the first of the least values of each `width` neighbours is."""
    at, reach = np.arange(len(grams)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(grams[right] < grams[left], right, left)
        reach += step
    return at


class _Slice:
    """A slice of texts: word hashes, first word per text, keys and segments."""

    def __init__(self, data: np.ndarray, at: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self.data = data
        self.starts, self.ends, self.first = word_bounds(data, at)
        self.words = word_hashes(data, self.starts, self.ends)
        self.ranges = _Ranges(self.words)
        whole = self.ranges(self.first[:-1], self.first[1:])
        salt = mix(ids.astype(np.uint64) + np.uint64(1))
        self.keys = mix(whole ^ np.where(null, np.uint64(0x5DEECE66D), salt))

    def segments(self, window: int, run: int) -> tuple[np.ndarray, ...]:
        """-> anchor, segment hash, text, first word, number of words of each segment."""
        windows = np.flatnonzero(whole_grams(self.first, window, len(self.words)))
        if len(windows) == 0:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none.astype(np.uint64), none, none, none
        grams = gram_hashes(self.words, run)
        place = _least(grams, window - run + 1)[windows]
        text = np.searchsorted(self.first, windows, side="right") - 1
        fresh = np.ones(len(windows), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(windows)) - 1
        low, high = windows[head], windows[tail] + window
        anchor = grams[place[head]]
        segment = mix(self.ranges(low, high) + (place[head] - low).astype(np.uint64))
        return anchor, segment, text[head], low, high - low


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, _Slice]]:
    """Batches of doc_id and text -> batch, first and last row, slice."""
    for batch in batches:
        data, at = text_bytes(batch.column(1))
        ids = batch.column(0).fill_null(0).to_numpy().astype(np.int64)
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        for low, high in row_slices(at):
            part = _Slice(
                data[at[low] : at[high]], at[low : high + 1] - at[low], ids[low:high], null[low:high]
            )
            yield batch, low, high, part


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def text_segments(docs: DataFrame, window: int, run: int) -> DataFrame:
    """-> text (key), anchor, segment, at, size: the segments of all texts."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, part in _sliced(batches):
            anchor, segment, text, at, size = part.segments(window, run)
            yield pa.RecordBatch.from_arrays(
                [
                    _long(part.keys[text]),
                    _long(anchor),
                    _long(segment),
                    pa.array(at - part.first[text]),
                    pa.array(size),
                ],
                names=["text", "anchor", "segment", "at", "size"],
            )

    schema = "text bigint, anchor bigint, segment bigint, at bigint, size bigint"
    return _narrow(docs).mapInArrow(segments, schema)


def repeated_segments(segments: DataFrame, hot_rows: int = HOT_SEGMENTS) -> DataFrame:
    """The segments whose anchor occurs twice.

    Anchors are counted map-side first; segments whose anchor has more than `hot_rows` are split.
    """
    counts = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("_rows"))
    often = stored(counts.filter("_rows > 1"), "anchors")
    return skew_join(
        segments, often.select("anchor"), "anchor", "left_semi", hot_rows, left_counts=often
    )


def segment_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """text, anchor, segment, n, at, size, segments -> the same with words: the segments' word hashes."""
    keys = wanted.select(F.col("text").alias("key")).distinct()
    passing = docs.sparkSession.sparkContext.broadcast(bitmap(keys))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, part in _sliced(batches):
            some = np.flatnonzero(in_bitmap(passing.value, part.keys))
            raw = part.words.astype("<u8").tobytes()
            first = part.first
            yield pa.RecordBatch.from_arrays(
                [
                    _long(part.keys[some]),
                    pa.array([raw[8 * first[i] : 8 * first[i + 1]] for i in some], pa.binary()),
                ],
                names=["text", "words"],
            )

    texts = _narrow(docs).mapInArrow(cut, "text bigint, words binary").dropDuplicates(["text"])
    place = F.substring("words", F.col("at") * 8 + 1, F.col("size") * 8)
    return wanted.join(texts, "text").withColumn("words", place)


class SuffixAutomaton:
    """All substrings of some sequences, with how often each occurs."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        self.last = 0

    def add(self, sequence: list, weight: int) -> None:
        """A sequence that occurs `weight` times."""
        self.last = 0
        for item in sequence:
            self._extend(item, weight)

    def _clone(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _extend(self, item: object, weight: int) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = self.last
        known = nexts[last].get(item)
        if known is not None and length[known] == length[last] + 1:
            self.last = known
            self.count[known] += weight
            return
        if known is None:
            new = len(nexts)
            nexts.append({})
            link.append(0)
            length.append(length[last] + 1)
            self.count.append(weight)
        state = last
        if known is None:
            while state >= 0 and item not in nexts[state]:
                nexts[state][item] = new
                state = link[state]
            if state < 0:
                self.last = new
                return
        target = nexts[state][item]
        if length[target] != length[state] + 1:
            copy = self._clone(target, length[state] + 1)
            while state >= 0 and nexts[state].get(item) == target:
                nexts[state][item] = copy
                state = link[state]
            link[target] = copy
            target = copy
        if known is None:
            link[new] = target
            self.last = new
        else:
            self.last = target
            self.count[target] += weight

    def finish(self) -> None:
        """Add each state's occurrences to those of its suffixes; nothing may be added after."""
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            self.count[self.link[state]] += self.count[state]

    def repeated_spans(self, sequence: list, least: int) -> list[tuple[int, int]]:
        """Maximal ranges of `sequence` covered by substrings of `least` items that occur twice."""
        spans: list[tuple[int, int]] = []
        state = matched = 0
        for end, item in enumerate(sequence, 1):
            while True:
                target = self.next[state].get(item)
                if target is not None and self.count[target] > 1:
                    state, matched = target, matched + 1
                    break
                if state == 0:
                    matched = 0
                    break
                state = self.link[state]
                matched = self.length[state]
            if matched >= least:
                if spans and spans[-1][1] >= end - least:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((end - least, end))
        return spans


SPANS = "anchor bigint, segment bigint, low bigint, high bigint"


def shard_spans(segments: DataFrame, window: int) -> DataFrame:
    """Segments by shard (anchor), with n and words -> anchor, segment, low, high: words to remove."""
    names = ["anchor", "segment", "n", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in sorted_groups(batches, names, ["anchor"]):
            distinct = dict(zip(shard["segment"], zip(shard["n"], shard["words"], strict=True), strict=True))
            sequences = {s: np.frombuffer(w, "<u8").tolist() for s, (_, w) in distinct.items()}
            automaton = SuffixAutomaton()
            for segment, sequence in sequences.items():
                automaton.add(sequence, distinct[segment][0])
            automaton.finish()
            rows = [
                (shard["anchor"][0], segment, low, high)
                for segment, sequence in sequences.items()
                for low, high in automaton.repeated_spans(sequence, window)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                    names=["anchor", "segment", "low", "high"],
                )

    dealt = segments.select(*names).repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, SPANS)


def window_spans(segments: DataFrame, window: int) -> DataFrame:
    """The same for shards of any size: windows with equal hashes are counted, map-side first."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(w, "<u8") for w in batch.column(3).to_pylist()]
            if not parts:
                continue
            hashes = [gram_hashes(p, window) for p in parts]
            sizes = np.array([len(h) for h in hashes])
            row = pa.array(np.repeat(np.arange(len(parts)), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i).take(row) for i in range(3)),
                    _long(np.concatenate(hashes)),
                    pa.array(ragged(np.zeros(len(parts), np.int64), sizes)),
                ],
                names=["anchor", "segment", "n", "hash", "low"],
            )

    schema = "anchor bigint, segment bigint, n bigint, hash bigint, low bigint"
    # Several rows may hold the same segment only where rows of a table repeat.
    windows = segments.select("anchor", "segment", "n", "words").mapInArrow(cut, schema)
    often = windows.groupBy("anchor", "hash").agg(F.sum("n").alias("all")).filter("all > 1")
    return windows.join(often, ["anchor", "hash"]).select(
        "anchor", "segment", "low", (F.col("low") + window).alias("high")
    )


def _covered(spans: list[int], words: int) -> np.ndarray:
    """Which words lie in any of the ranges, given as low, high, low, high and so on."""
    edges = np.zeros(words + 1, np.int64)
    np.add.at(edges, spans[::2], 1)
    np.add.at(edges, spans[1::2], -1)
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, run: int = RUN, shard: int = SHARD
) -> DataFrame:
    """-> doc_id, n_words, n_removed, kept_text: one row per row of `docs`, which has doc_id and text.

    Words are runs of anything but ASCII white space, unchanged. A word goes if it is in a run of
    `window` words of its text that also starts anywhere else, in this text or another; all is
    judged by the input. What stays is joined by single spaces. Null and empty texts have no words
    and an empty rest. Rows that repeat a text repeat its passages, so they lose them, whatever
    their ids; a null id is an id like others. Other columns are not read. Words are compared by
    64-bit hashes, windows by all their words or, in very large shards, by hashes of 64 bits.
    """
    segments = stored(text_segments(docs, window, run), "segments")
    found = stored(repeated_segments(segments).select(segments.columns), "repeated-segments")
    first = F.min(F.struct("text", "at", "size")).alias("first")
    kinds = found.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), first)
    shards = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments"), F.sum("n").alias("rows"))
    kinds = stored(
        kinds.join(shards.filter("rows > 1"), "anchor").select(
            "anchor", "segment", "n", "segments", "first.*"
        ),
        "kinds",
    )
    whole = kinds.filter("n > 1").select(
        "anchor", "segment", F.lit(0).cast("long").alias("low"), F.col("size").alias("high")
    )
    unlike = stored(segment_words(docs, kinds.filter("segments > 1")), "segment-words")
    spans = whole.unionByName(shard_spans(unlike.filter(F.col("segments") <= shard), window))
    spans = spans.unionByName(window_spans(unlike.filter(F.col("segments") > shard), window))
    spans = stored(spans, "spans")
    ranges = F.array(F.col("at") + F.col("low"), F.col("at") + F.col("high"))
    removed = stored(
        found.join(spans, ["anchor", "segment"])
        .select("text", ranges.alias("range"))
        .groupBy("text")
        .agg(F.flatten(F.collect_set("range")).alias("ranges")),
        "removed",
    )
    passing = docs.sparkSession.sparkContext.broadcast(
        bitmap(removed.select(F.col("text").alias("key")))
    )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, low, high, part in _sliced(batches):
            raw = part.data.tobytes()
            texts = []
            for i in range(high - low):
                at = range(part.first[i], part.first[i + 1])
                texts.append(b" ".join([raw[part.starts[w] : part.ends[w]] for w in at]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    _long(part.keys),
                    pa.array(in_bitmap(passing.value, part.keys)),
                    pa.array(np.diff(part.first)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "text", "touched", "n_words", "words"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept = [], []
            for n, words, ranges in zip(
                *(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True
            ):
                gone = _covered(ranges or [], n)
                counts.append(int(gone.sum()))
                left = [w for w, g in zip(words.split(" "), gone, strict=False) if not g]
                kept.append(" ".join(left) if counts[-1] else words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    schema = "doc_id bigint, text bigint, touched boolean, n_words bigint, words string"
    texts = _narrow(docs).mapInArrow(clean, schema)
    # Only texts that may lose words are shuffled.
    same = texts.filter(~F.col("touched")).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("words").alias("kept_text")
    )
    changed = (
        texts.filter("touched")
        .join(removed, "text", "left")
        .select("doc_id", "n_words", "words", "ranges")
        .mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
    )
    return same.unionByName(changed)
