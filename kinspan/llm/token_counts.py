"""Token counts: lengths of batch encodings, without the ids leaving the Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kinspan.llm.tokens import balanced_pieces, encoder
from kinspan.llm.words import SLICE_BYTES, text_bytes


def token_counts(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    tokenizer: str | None = None,
    limit: int = 2048,
    max_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """-> `keep`, n_bytes, n_tokens, over_limit (more than `limit` tokens): one row per input row.

    `tokenizer` is the file of a vocabulary for the `tokenizers` library. Texts are encoded in
    slices of about `max_bytes`; longer texts are cut at white space and their parts' counts added.
    Null and empty texts have 0 bytes and tokens. Repeated rows stay, null ids too; other columns
    are not read. Nothing is shuffled.
    """
    columns = list(keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            data, at = text_bytes(batch.column(len(columns)))
            tokens = np.zeros(batch.num_rows, np.int64)
            for rows, strings in balanced_pieces(data, at, max_bytes):
                sizes, _, _ = encode(strings)
                np.add.at(tokens, rows, sizes)
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(at)), pa.array(tokens), pa.array(tokens > limit)],
                names=[*columns, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = T.StructType(
        [docs.schema[c] for c in columns]
        + [
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return docs.select(*columns, docs[text].cast("string")).mapInArrow(count, schema)
