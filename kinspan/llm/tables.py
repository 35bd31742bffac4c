"""Given tables, and intermediate results as Parquet in the shared folder, which outlives lost executors."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.session import fresh_path


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers find this package as the driver does."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        joined = os.pathsep.join(filter(None, [ROOT, paths]))
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a new table in the shared folder, and read again: it is computed once."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores put in front until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bitmap(keys: DataFrame, name: str = "key", most_bits: int = 1 << 27) -> np.ndarray:
    """Bits set at the low bits of the 64-bit keys: a filter that passes every key of `keys`.

    About 32 bits a key, up to `most_bits`, so what comes to the driver has a fixed bound; with more
    keys than that the filter passes more rows, which a join has to drop in any case.
    """
    bits = 1 << 16
    rows = keys.count()
    while bits < 32 * rows and bits < most_bits:
        bits *= 2
    low = F.col(name).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftright(low, 6).alias("w"), low.bitwiseAND(F.lit(63)).alias("b"))
    found = (
        words.groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b as int))")).alias("v"))
        .toArrow()
    )
    full = np.zeros(bits // 64, np.int64)
    full[found["w"].to_numpy()] = found["v"].to_numpy()
    return full.view(np.uint64)


def in_bitmap(full: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each of `keys` passes a bitmap."""
    low = keys.astype(np.uint64) & np.uint64(64 * len(full) - 1)
    word = full[(low >> np.uint64(6)).astype(np.int64)]
    return (word >> (low & np.uint64(63))) & np.uint64(1) == 1


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Connected components of edges (a, b) -> node, label: the smallest node of its component.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds grows with the logarithm of a component's length. Every round is stored.
    """
    both = edges.filter("a <> b").select("a", "b").distinct()
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = stored(labels.select("node", F.least("node", "label").alias("label")), "labels")
    for _ in range(rounds):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        met = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        step = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        fresh = stored(
            met.join(step, "label").select("node", F.least("label", "jump").alias("label"), "old"),
            "labels",
        )
        labels = fresh.select("node", "label")
        if fresh.filter("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")


def sorted_groups(
    batches: Iterator[pa.RecordBatch], names: list[str], keys: list[str]
) -> Iterator[dict[str, list]]:
    """The rows of each key, as lists by column, from batches that are sorted by the keys."""
    key, group = None, {n: [] for n in names}
    for batch in batches:
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(names)}
        rows = list(zip(*(columns[k] for k in keys), strict=True))
        first = 0
        while first < len(rows):
            last = first
            while last < len(rows) and rows[last] == rows[first]:
                last += 1
            if rows[first] != key:
                if key is not None:
                    yield group
                key, group = rows[first], {n: [] for n in names}
            for n in names:
                group[n] += columns[n][first:last]
            first = last
    if key is not None:
        yield group
