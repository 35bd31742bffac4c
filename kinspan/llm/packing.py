"""Packing of token sequences: shortest-pack-first over the length histogram.

Only the histogram, at most one entry per length up to the capacity, comes to the driver. Lengths
are placed longest first, each into the sequences that are filled least; what is kept is how many
pieces of a length go to which block of equally filled sequences. Pieces find their place by their
rank among the pieces of the same length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspan.llm.tables import free_name, stored
from kinspan.llm.tokens import balanced_pieces, encoder
from kinspan.llm.words import ragged, text_bytes

CAPACITY = 4096
END_ID = 2


def tokenized_pieces(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """-> `keep`, start, length, ids (little-endian unsigned 32 bit), doc_tokens: a row per piece.

    A document is its tokens and `end_id`; after every `capacity` ids it is cut. Null and empty
    texts give one piece, the `end_id` alone. Repeated rows and null ids are documents like others.
    """
    columns = list(keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            data, at = text_bytes(batch.column(len(columns)))
            parts: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for rows, strings in balanced_pieces(data, at):
                sizes, starts, lengths = encode.encode(strings)
                ids = encode.token_ids(starts, lengths).astype("<u4")
                ends = np.cumsum(sizes)
                for row, first, last in zip(rows, ends - sizes, ends, strict=True):
                    parts[row].append(ids[first:last])
            tail = np.array([end_id], "<u4")
            flat = [np.concatenate([*p, tail]) for p in parts]
            tokens = np.array([len(f) for f in flat], np.int64)
            pieces = -(-tokens // capacity)
            row = np.repeat(np.arange(batch.num_rows), pieces)
            start = ragged(np.zeros(len(pieces), np.int64), pieces) * capacity
            length = np.minimum(tokens[row] - start, capacity)
            raw = np.concatenate(flat) if flat else np.zeros(0, "<u4")
            bounds = np.concatenate([[0], np.cumsum(length * 4)])
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]
            ).cast(pa.binary())
            kept = [batch.column(i).take(pa.array(row)) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(start), pa.array(length), ids, pa.array(tokens[row])],
                names=[*columns, "start", "length", "ids", "doc_tokens"],
            )

    schema = T.StructType(
        [docs.schema[c] for c in columns]
        + [
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
        ]
    )
    return docs.select(*columns, docs[text].cast("string")).mapInArrow(cut, schema)


def placements(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces of each length go, by rank: rows of (length, first rank, copies, sequence,
    offset), sorted by length and first rank.

    From the first rank on, every `copies` pieces share a sequence, at the offset and after it.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    # Blocks of equally filled sequences: (- free tokens, first sequence, number of sequences).
    blocks: list[tuple[int, int, int]] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            free = -blocks[0][0] if blocks else 0
            if free < length:  # not even the emptiest sequence has room: open as few as will do
                fit = capacity // length
                sequences = left // fit
                copies = fit
                if not sequences:
                    sequences, copies = 1, left
                heapq.heappush(blocks, (-capacity, opened, sequences))
                opened += sequences
                free = capacity
            else:
                copies = 1
            _, first, sequences = heapq.heappop(blocks)
            if copies == 1:
                following = -blocks[0][0] if blocks else 0
                copies = max(1, min((free - following) // length, left // sequences))
            used = min(sequences, left // copies)
            rows.append((length, rank, copies, first, capacity - free))
            rank, left = rank + used * copies, left - used * copies
            heapq.heappush(blocks, (length * copies - free, first, used))
            if used < sequences:
                heapq.heappush(blocks, (-free, first + used, sequences - used))
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with sequence_id and offset: pieces of 1 to `capacity` tokens in gapless sequences.

    All columns of `pieces` stay, and each row comes out once, repeated ones too. Ties, pieces of
    the same length, go by where the rows lie. A length that is null or out of range raises an
    error. The pieces are stored in the shared folder first, so that ranks hold over retries; hot
    lengths are ranked within the partitions that hold them.
    """
    part, row = free_name(pieces, "part"), free_name(pieces, "row")
    checked = pieces.withColumn(
        length,
        F.when(F.col(length).between(1, capacity), F.col(length).cast("long")).otherwise(
            F.raise_error(F.lit(f"pieces must have 1 to {capacity} tokens"))
        ),
    )
    table = stored(
        checked.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}),
        "pieces",
    )
    counts = stored(table.groupBy(length, part).agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {
        r[0]: r[1] for r in counts.groupBy(length).agg(F.sum("n")).collect()
    }  # at most `capacity` rows
    before = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    rank = free_name(pieces, "rank")
    firsts = counts.select(length, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(rank))
    local = F.row_number().over(Window.partitionBy(length, part).orderBy(row)) - 1
    ranked = (
        table.withColumn(row, local)
        .join(firsts.hint("merge"), [length, part])  # lies as the window left it: no shuffle, no broadcast
        .withColumn(rank, F.col(rank) + F.col(row))
        .select(*pieces.columns, rank)
    )
    rows = placements(histogram, capacity)
    width = pieces.columns.index(length)
    names = [*pieces.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            sizes = batch.column(width).to_numpy()
            ranks = batch.column(batch.num_columns - 1).to_numpy()
            at = rows[np.searchsorted(keys, sizes << 48 | ranks, side="right") - 1]
            nth = ranks - at[:, 1]
            sequence = at[:, 3] + nth // at[:, 2]
            offset = at[:, 4] + nth % at[:, 2] * sizes
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=names,
            )

    schema = T.StructType(
        [*table.select(*pieces.columns).schema]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(place, schema)
