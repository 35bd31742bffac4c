"""N-gram Jaccard join by chosen paths, and the near-duplicate classes it gives.

Documents with the same set of word n-grams are one set, so that copies meet no further work. Each
run sends a set down a path of shared tokens: the first token is the set's least n-gram under the
run's random order, and while a bucket is large its sets go on to the least n-grams under several
other orders. Two sets of similarity s take the same step with probability s, so `runs` first steps
lose a pair at the threshold with probability (1 - s) ** runs, about one in ten million for
10 runs at 0.8; `branches` next steps per split keep the loss at a split below 1 %, of which
every other run is independent. Small buckets are compared in full; so are those that a step leaves
more than half whole, as their sets are alike, in blocks of bounded size.

A pair that meets in several buckets counts in the one with the smallest id among those kept by
both, which each side knows, so links are counted without pairs being listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.llm.tables import bitmap, components, in_bitmap, sorted_groups, stored
from kinspan.llm.words import (
    gram_hashes,
    mix,
    row_slices,
    text_bytes,
    whole_grams,
    word_bounds,
    word_hashes,
)

WORDS = 5
SIMILARITY = 0.8
RUNS = 10
BRANCHES = 4
LEVELS = 4
ORDERS = 32  # at least 1 + (LEVELS - 1) * BRANCHES of them, so that a path repeats none
SMALL = 4096
BLOCK = 1024

_BITS = 52  # n-grams are this long, so that the row within a slice fits beside them in 64 bits
_GRAM = np.uint64((1 << _BITS) - 1)


def _odd(n: int) -> np.ndarray:
    """`n` odd multipliers, each of which puts the n-grams in another order."""
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def ngram_sets(
    data: np.ndarray, at: np.ndarray, words: int = WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """-> sorted distinct n-grams of every text, and where each text's begin (up to 4,096 texts).

    A text of fewer words than an n-gram has is one n-gram, of all of them; none has none.
    """
    starts, ends, first = word_bounds(data, at)
    hashes = word_hashes(data, starts, ends)
    rows = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(first))
    whole = np.flatnonzero(whole_grams(first, words, len(hashes)))
    grams, row = [gram_hashes(hashes, words)[whole]], [rows[whole]]
    for n in range(1, words):
        short = np.flatnonzero(np.diff(first) == n)
        if len(short):
            grams.append(gram_hashes(hashes, n, seed=n)[first[short]])
            row.append(short.astype(np.uint64))
    keys = np.concatenate(row) << np.uint64(_BITS) | np.concatenate(grams) >> np.uint64(64 - _BITS)
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    owner = (keys >> np.uint64(_BITS)).astype(np.int64)
    return keys & _GRAM, np.searchsorted(owner, np.arange(len(at)))


def _slices(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, at = text_bytes(column)
    for low, high in row_slices(at):
        for first in range(low, high, 4096):
            last = min(first + 4096, high)
            grams, begins = ngram_sets(
                data[at[first] : at[last]], at[first : last + 1] - at[first], words
            )
            yield first, last, grams, begins


def _set_ids(grams: np.ndarray, begins: np.ndarray) -> list[bytes]:
    """16 bytes that tell sets of n-grams apart, whatever order they come in."""
    sums = []
    for salt in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams + np.uint64(salt << 56)))])
        sums.append(mix(total[begins[1:]] - total[begins[:-1]]))
    packed = np.stack(sums, 1).astype(">u8").tobytes()
    return [packed[i : i + 16] for i in range(0, len(packed), 16)]


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text -> doc_id, size, sid (set of n-grams), mins (least n-gram in each order)."""
    odd = _odd(ORDERS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, grams, begins in _slices(batch.column(1), words):
                sizes = np.diff(begins)
                full = np.flatnonzero(sizes)
                least = np.zeros((len(sizes), len(odd)), np.uint64)
                for i in range(len(odd) if len(full) else 0):
                    least[full, i] = np.minimum.reduceat(grams * odd[i], begins[:-1][full])
                mins = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, least.size + 1, len(odd), dtype=np.int32)),
                    pa.array(least.ravel().view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(_set_ids(grams, begins), pa.binary()),
                        mins,
                    ],
                    names=["doc_id", "size", "sid", "mins"],
                )

    narrow = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    schema = "doc_id bigint, size bigint, sid binary, mins array<bigint>"
    return narrow.mapInArrow(sign, schema)


def _kept(members: DataFrame) -> DataFrame:
    """bucket, sid, ... -> bucket, n: buckets of several sets, one of those with equal members."""
    mark = F.xxhash64("sid")
    sizes = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("x"), F.sum(mark % (1 << 40)).alias("s")
    )
    return sizes.filter("n > 1").groupBy("n", "x", "s").agg(F.min("bucket").alias("bucket"))


def buckets(
    sets: DataFrame,
    runs: int = RUNS,
    small: int = SMALL,
    branches: int = BRANCHES,
    levels: int = LEVELS,
) -> DataFrame:
    """sid, mins -> bucket, sid, n: the leaves of all paths, each with its number of sets."""
    step = sets.select(F.posexplode(F.slice("mins", 1, runs)).alias("run", "token"), "sid", "mins")
    step = step.select(F.xxhash64("run", "token").alias("bucket"), "run", "sid", "mins")
    leaves = None
    for level in range(1, levels + 1):
        kept = _kept(step.select("bucket", "sid"))
        met = step.join(kept.select("bucket", "n"), "bucket")
        whole = F.col("n") <= small
        if level > 1:
            whole |= F.col("n") * 2 > F.col("parent_n")
        if level == levels:
            whole = F.lit(True)
        met = stored(met.withColumn("leaf", whole), "buckets")
        done = met.filter("leaf").select("bucket", "sid", "n")
        leaves = done if leaves is None else leaves.unionByName(done)
        large = met.filter(~F.col("leaf"))
        if level == levels or large.isEmpty():
            break
        first = 1 + (level - 1) * branches
        choices = F.explode(F.sequence(F.lit(first), F.lit(first + branches - 1))).alias("choice")
        order = F.pmod(F.col("run") + F.col("choice"), F.lit(ORDERS)) + 1
        step = large.select(
            "bucket", "run", "sid", "mins", F.col("n").alias("parent_n"), choices
        ).select(
            F.xxhash64("bucket", "choice", F.element_at("mins", order)).alias("bucket"),
            "run",
            "sid",
            "mins",
            "parent_n",
        )
    # Buckets of different levels may hold the same sets too.
    return leaves.join(_kept(leaves.select("bucket", "sid")).select("bucket"), "bucket", "left_semi")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """sid, rep (a doc_id) of `wanted` -> sid, grams: n-grams of the wanted sets, from their texts.

    A bitmap of the ids keeps most other texts from being split; the join drops the rest.
    """
    null = -1
    ids = wanted.select(F.coalesce("rep", F.lit(null)).alias("key"))
    passing = docs.sparkSession.sparkContext.broadcast(bitmap(ids))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(null).to_numpy()
            batch = batch.filter(pa.array(in_bitmap(passing.value, ids)))
            for _, _, grams, begins in _slices(batch.column(1), words):
                raw = grams.astype("<u8").tobytes()
                parts = [raw[8 * a : 8 * b] for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_ids(grams, begins), pa.binary()), pa.array(parts, pa.binary())],
                    names=["sid", "grams"],
                )

    narrow = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    found = narrow.mapInArrow(cut, "sid binary, grams binary")
    # Repeated rows may bring a set more than once.
    return found.join(wanted.select("sid"), "sid", "left_semi").dropDuplicates(["sid"])


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets, over bounded lots of shared n-grams at a time."""
    grams = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, count = np.unique(grams, return_inverse=True, return_counts=True)
    shared = count[number] > 1
    row, number = row[shared], number[shared]
    number = np.unique(number, return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    met = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        low, high = np.searchsorted(number, [first, first + columns])
        dense = np.zeros((len(sets), columns), np.float32)
        dense[row[low:high], number[low:high] - first] = 1
        met += dense @ dense.T
    return met


def _compare(unit: dict[str, list], similarity: float) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """-> sids of the sets that have a link here, links that count here, number of their first sid."""
    order = sorted(range(len(unit["sid"])), key=lambda i: unit["sid"][i])
    sids = [unit["sid"][i] for i in order]
    sets = [np.frombuffer(unit["grams"][i], "<u8") for i in order]
    size = np.array([len(s) for s in sets], np.float64)
    met = overlaps(sets)
    linked = met >= similarity * (size[:, None] + size[None, :] - met) - 1e-6
    np.fill_diagonal(linked, False)
    if unit["a"][0] != unit["b"][0]:
        side = np.array([unit["block"][i] for i in order])
        linked &= side[:, None] != side[None, :]
    if not linked.any():
        return [], np.zeros(0), np.zeros(0, np.int64)
    bucket = unit["bucket"][0]
    earlier = sorted({b for i in order for b in unit["kept"][i] if b < bucket})
    counted = linked
    if earlier:
        place = {b: k for k, b in enumerate(earlier)}
        inside = np.zeros((len(order), len(earlier)), np.float32)
        for k, i in enumerate(order):
            inside[k, [place[b] for b in unit["kept"][i] if b < bucket]] = 1
        counted = linked & (inside @ inside.T == 0)
    links = counted @ np.array([unit["copies"][i] for i in order], np.int64)
    label = np.arange(len(order))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(order)).min(1))
        low = low[low]
        if (low == label).all():
            break
        label = low
    some = np.flatnonzero(linked.any(1))
    return [sids[i] for i in some] + [sids[i] for i in label[some]], links[some], some


def compare(units: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Sets by unit (bucket, a, b) -> sid, links, label: links counted here, and the smallest linked
    set; a task holds one unit, at most two blocks, at a time."""
    names = units.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in sorted_groups(batches, names, ["bucket", "a", "b"]):
            both, links, some = _compare(unit, similarity)
            half = len(some)
            if half:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(both[:half], pa.binary()),
                        pa.array(links.astype(np.int64)),
                        pa.array(both[half:], pa.binary()),
                    ],
                    names=["sid", "links", "label"],
                )

    dealt = units.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
    return dealt.mapInArrow(run, "sid binary, links bigint, label binary")


def ngram_classes(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    runs: int = RUNS,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """-> doc_id, class_id, n_links, n_ngrams: one row per row of `docs`, which has doc_id and text.

    Words are runs of anything but ASCII white space, as they are. Two documents are linked if the
    Jaccard similarity of their sets of n-grams is `similarity` or more; n_links is the number of
    linked rows (copies and repeated rows count), class_id the smallest doc_id that links lead to.
    Texts without words, null ones too, have no links and are classes of their own. A row without
    doc_id counts as a document, but names a class only if no member has an id (then class_id is
    null). Other columns are not read.
    """
    signed = stored(signatures(docs, words), "signatures")
    sets = stored(
        signed.filter("size > 0")
        .groupBy("sid")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("mins").alias("mins")),
        "sets",
    )
    leaves = stored(buckets(sets.select("sid", "mins"), runs, small), "leaves")
    kept = leaves.groupBy("sid").agg(F.collect_set("bucket").alias("kept"))
    wanted = stored(kept.join(sets.select("sid", "rep", "copies"), "sid"), "wanted")
    grams = sets_of(docs, wanted.select("sid", "rep"), words)
    members = wanted.drop("rep").join(grams, "sid")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.when(F.col("n") <= block, 0).otherwise(F.pmod(F.xxhash64("sid"), blocks)).cast("int")
    units = (
        leaves.withColumns({"block": mine, "blocks": F.when(F.col("n") <= block, 1).otherwise(blocks)})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
            "block", "sid",
        )
        .join(members, "sid")
    )
    found = stored(compare(units, similarity), "links")
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("sid").alias("a"), F.col("label").alias("b")))
    rooted = sets.select("sid", "rep", "copies").join(
        roots.withColumnRenamed("node", "sid"), "sid", "left"
    )
    rooted = rooted.withColumn("label", F.coalesce("label", "sid"))
    named = rooted.groupBy("label").agg(F.min("rep").alias("class_id"))
    classes = stored(
        rooted.join(named, "label")
        .join(links, "sid", "left")
        .select("sid", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "classes",
    )
    return signed.join(classes, "sid", "left").select(
        "doc_id",
        F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.col("size").alias("n_ngrams"),
    )
