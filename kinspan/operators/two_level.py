"""The two-level layout, stored: summary edges, what is at each key, and detail rows.

Pair lookups go by the id of the summary edge to the detail rows; lookups of incident edges go from
a key to the ids of its edges and from these to the detail rows. All three tables are stored by
the key they are looked up by, see `kinspan.sinks.keyed`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.operators.graph import incidence, listed_keys, listed_pairs
from kinspan.operators.relations import edge_id, pair_events, summary_edges
from kinspan.sinks.keyed import KeyedTable, open_keyed, store_keyed


TABLES = ("summary", "ends", "events")


@dataclass(frozen=True)
class TwoLevel:
    """The tables of a layout; None for those that were not written."""

    label: str
    summary: KeyedTable | None = None
    ends: KeyedTable | None = None
    events: KeyedTable | None = None


def _ends(valid: DataFrame, label: str) -> DataFrame:
    """-> key, edge_id: both ends of every summary edge, told by keys alone."""
    low, high = F.least("key1", "key2").alias("src"), F.greatest("key1", "key2").alias("dst")
    # A filter on the keys would be pushed below the parser, which then splits each line once more.
    named = valid.select(low, high, edge_id(F.col("key1"), F.col("key2"), F.lit(label)).alias("edge_id"))
    return incidence(named.distinct()).select(F.col("v").alias("key"), "edge_id")


def store_two_level(
    valid: DataFrame,
    label: str,
    path: str,
    times: int = 100,
    buckets: int | None = None,
    hot_rows: int | None = None,
    tables: Sequence[str] = TABLES,
) -> TwoLevel:
    """Write the layout of valid records (key1, key2, time_ms, raw) below a new folder.

    `tables` are those that are wanted: pair lookups read the events, lookups of incident edges
    the ends too.
    """
    made = {
        "summary": (lambda: summary_edges(valid, label), "edge_id", ()),
        "ends": (lambda: _ends(valid, label), "key", ("edge_id",)),
        "events": (lambda: pair_events(valid, label, times), "edge_id", ("time",)),
    }
    stored = {}
    for name in tables:
        rows, key, sort = made[name]
        stored[name] = store_keyed(rows(), f"{path}/{name}", key, sort, buckets, hot_rows)
    return TwoLevel(label, **stored)


def open_two_level(spark: SparkSession, path: str, label: str) -> TwoLevel:
    return TwoLevel(label, *(open_keyed(spark, f"{path}/{name}") for name in TABLES))


def pair_lookup(pairs: DataFrame, stored: TwoLevel) -> DataFrame:
    """-> key1, key2, listed, edge_count: detail rows of each pair's summary edge, 0 without one.

    Detail rows are written for summary edges alone, so they tell which edges there are.
    """
    listed = listed_pairs(pairs).withColumn(
        "edge_id", edge_id(F.col("key1"), F.col("key2"), F.lit(stored.label))
    )
    ids = listed.select("edge_id").filter(F.col("edge_id").isNotNull()).distinct()
    counts = stored.events.counts(ids)
    return listed.join(counts, "edge_id", "left").select(
        "key1", "key2", "listed", F.coalesce("n", F.lit(0)).alias("edge_count")
    )


def incident_lookup(keys: DataFrame, stored: TwoLevel) -> DataFrame:
    """-> key, listed, time, value: detail rows of every summary edge at each listed key.

    An edge between two listed keys comes out for each of them, a loop twice, as its row has two ends.
    """
    at_key = stored.ends.matching(listed_keys(keys).filter(F.col("key").isNotNull()))
    # An edge has two ends, so its list has at most two entries.
    per_edge = at_key.groupBy("edge_id").agg(F.collect_list(F.struct("key", "listed")).alias("_ends"))
    found = stored.events.matching(per_edge, ["edge_id", "time", "value"])
    return found.select("time", "value", F.explode("_ends").alias("_end")).select(
        "_end.key", "_end.listed", "time", "value"
    )
