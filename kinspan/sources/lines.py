"""Relation lines as fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.functions.text import RELATION_SEP, split_all, trimmed_size

# Layout of a relation line (fixed values): two halves of 19 fields each.
HALF_FIELDS = 19
KEY1_INDEX, KEY2_INDEX, TIME_INDEX = 0, 19, 9

NOT_ENOUGH_FIELDS = "not enough fields"


def parse_relations(
    lines: DataFrame,
    key1_idx: int = KEY1_INDEX,
    key2_idx: int = KEY2_INDEX,
    time_idx: int = TIME_INDEX,
    sep: str = RELATION_SEP,
) -> DataFrame:
    """`value` lines -> raw, fields, field_count, key1, key2, time_text."""
    pieces = lines.select(
        F.col("value").alias("raw"), split_all(F.col("value"), sep).alias("fields")
    )
    return pieces.select(
        "*",
        trimmed_size(F.col("fields"), F.col("raw"), sep).alias("field_count"),
        F.get("fields", F.lit(key1_idx)).alias("key1"),
        F.get("fields", F.lit(key2_idx)).alias("key2"),
        F.get("fields", F.lit(time_idx)).alias("time_text"),
    )
