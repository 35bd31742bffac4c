"""Filter interaction audit: what each filter removes, alone and in every order of all of them.

A document is read once, into a mask with a bit per filter that it fails. Of each part of the
table 32 mask cells are left. A walk over all subsets of the filters in Gray-code order toggles one
filter at a time: it keeps a counter of active failures for each cell and the running survivors, and
stores them, 32 states in all. What a step of any order removes is the difference of two states.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.llm.exact_dedup import digest
from kinspan.llm.tables import stored
from kinspan.operators.skew import lookup_join

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the code points

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D over whole texts without nulls. Words are runs of anything but white space."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    sizes = F.struct(F.size(words).alias("all"), F.size(F.array_distinct(words)).alias("distinct"))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": sizes["all"] < LEAST_WORDS,
        "B": sizes["distinct"].cast("bigint") * 100 < sizes["all"].cast("bigint") * LEAST_DISTINCT,
        "C": capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * MOST_CAPITALS,
        "D": text.rlike(r"[#$%&*|]"),
    }


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> doc_id, part, digest, mask (bits of A to D), good, toxic: a narrow row per row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    texts = docs.select(
        docs["doc_id"],
        F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    fails = text_failures(F.col("text"))
    bits = [F.when(fails[f], 1 << i).otherwise(0) for i, f in enumerate("ABCD")]
    rows = texts.select(
        "doc_id", "part", digest("text").alias("digest"), sum(bits[1:], bits[0]).alias("mask")
    )
    judged = labels.groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    judged = judged.filter(F.col("doc_id").isNotNull())
    return lookup_join(stored(rows, "masks"), judged, "doc_id", "left").fillna(0, ["good", "toxic"])


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> part, mask (bits of A to E), n, good, toxic: the counts of every cell that has documents.

    E is failed by a text that a smaller id has as well. Rows are counted by text and id first; the
    smallest id of each text is then found by a maximum that combines on the map side, and joined by
    text and id, which no two groups share. So no task gets a text's copies, however many.
    """
    rows = marked(docs, labels)
    known = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(None))
    # Rows without an id come after all others: they are copies of any row that has one.
    place = F.struct(known.isNull().alias("none"), F.coalesce(known, F.lit(0)).alias("id"))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    keys = ["digest", "place", "part", "mask"]
    groups = stored(rows.withColumn("place", place).groupBy(*keys).agg(*sums), "copies")
    first = groups.groupBy("digest").agg(F.min("place").alias("place"), F.lit(True).alias("_first"))
    met = groups.join(first, ["digest", "place"], "left")
    mask = F.col("mask") + F.when(F.col("_first"), 0).otherwise(1 << 4)
    cells = met.groupBy("part", mask.alias("mask"))
    return cells.agg(*(F.sum(c).alias(c) for c in COUNTS))


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Counts by mask, (masks, kinds) -> survivors of every subset of filters, (subsets, kinds).

    Each step turns one filter on or off: the cells that fail it get one active failure more or
    less, and leave or rejoin the survivors when they have their first or lose their last.
    """
    masks = np.arange(len(cells))
    failures = np.zeros(len(cells), np.int64)
    alive = cells.sum(axis=0)
    states = np.zeros_like(cells)
    states[0] = alive
    active = 0
    for step in range(1, len(cells)):
        toggled = step & -step  # the filter in which two neighbouring Gray codes differ
        active ^= toggled
        hit = masks & toggled > 0
        if active & toggled:
            alive = alive - cells[hit & (failures == 0)].sum(axis=0)
            failures[hit] += 1
        else:
            failures[hit] -= 1
            alive = alive + cells[hit & (failures == 0)].sum(axis=0)
        states[active] = alive
    return states


AUDIT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint,"
    " unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit_rows(cells: np.ndarray, filters: str = FILTERS) -> list[tuple]:
    """The rows of one part, without its name, from the counts of its cells."""
    states, count = gray_walk(cells), len(filters)
    masks = np.arange(len(cells))
    fails = [int(cells[masks & (1 << f) > 0, 0].sum()) for f in range(count)]
    shares = []
    for f in range(count):
        share = 0
        for s in range(len(cells)):
            if not s >> f & 1:
                orders = factorial(s.bit_count()) * factorial(count - 1 - s.bit_count())
                share += orders * int(states[s, 0] - states[s | 1 << f, 0])
        shares.append(share)
    rows = []
    for order in permutations(range(count)):
        name, before = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            gone = states[before] - states[after]
            rows.append(
                (
                    name, step, int(states[after, 0]), int(gone[0]), fails[f] - int(gone[0]),
                    int(cells[1 << f, 0]), int(gone[1]), int(gone[2]), shares[f],
                )
            )
            before = after
    return rows


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """-> part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    doc_id, text, lang and doc_id, quality, toxic. A row for each part (value of lang, null as the
    empty string), order of the five filters and step; counts are documents of the part: kept after
    the step, removed in it, redundant (failing its filter but removed before), failing no other
    filter, removed in it though of good quality or being toxic. shapley is what the step's filter
    removes, summed over all orders. Null texts count as empty, and these have no words. Labels
    that repeat an id count together, missing ones as 0. Rows that repeat an id and its text fail E
    only if a smaller id has the text; a row without an id fails it if any row with one does. An
    empty table has no parts. A part is 32 cells when it is walked, however many documents it has.
    """
    cells = mask_cells(docs, labels)
    listed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    names = [c.split()[0] for c in AUDIT.split(",")]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        for batch in batches:
            for part, full in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.zeros((1 << len(FILTERS), len(COUNTS)), np.int64)
                for cell in full:
                    counts[cell["mask"]] = [cell[c] for c in COUNTS]
                columns = list(zip(*((part, *row) for row in audit_rows(counts)), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    return listed.mapInArrow(walk, AUDIT)
