"""Joins that hold when one key owns a large share of the rows.

A side is broadcast only after its rows and bytes were counted. Otherwise the join shuffles: the
rows per key are counted first, and if there are keys with more rows than one task should get,
these are spread over several salts. Salts come from the row's own content and its map partition,
never from `rand`, so that a task that runs again after an executor was lost sends each row to the
same place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.session import reliable

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
NULL_SALTS = 1024

_SPLIT, _COPY = "_split", "_copy"


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of `df`. One scan, partly summed per task."""
    width = reduce(
        add, (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns)
    )
    total = F.coalesce(F.sum(width.cast("bigint")), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), total).first()
    return rows, size


def fits_broadcast(
    df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None
) -> bool:
    """Whether `df`, counted in full, is small enough to broadcast."""
    rows, size = measured(df)
    return rows <= (BROADCAST_ROWS if max_rows is None else max_rows) and size <= (
        BROADCAST_BYTES if max_bytes is None else max_bytes
    )


def only_listed(facts: DataFrame, listed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """`facts` without the rows whose key is not in `listed`, if that list was measured small.

    Spares a shuffle of rows that a later join drops; a long list leaves them to that join.
    """
    on = [on] if isinstance(on, str) else list(on)
    keys = listed.select(*on)
    return facts.join(F.broadcast(keys), on, "left_semi") if fits_broadcast(keys) else facts


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))


def _hot_keys(counts: DataFrame, on: Sequence[str], hot_rows: int, name: str) -> DataFrame:
    """-> `on`, `name`: the number of salts of every hot key. Written out, as it is used repeatedly."""
    salts = (F.lit(1) + F.floor(F.col("_rows") / hot_rows)).cast("int")
    return reliable(counts.filter(F.col("_rows") > hot_rows).select(*on, salts.alias(name)))


def _with_salts(
    df: DataFrame, hot: DataFrame, on: Sequence[str], hot_rows: int, counts: DataFrame | None
) -> DataFrame:
    """`df` with the columns of `hot`, NULL for other keys.

    A list of hot keys too long to broadcast is joined by a shuffle, in which only keys of a
    hundred times as many rows are split; there are fewer of those, and in the end few enough.
    `counts` says how many rows of `df` a key has, None that it has one.
    """
    if fits_broadcast(hot):
        return df.join(F.broadcast(hot), on, "left")
    if counts is None:
        return df.join(hot, on, "left")
    apart = {c: f"_{c}" for c in hot.columns if c not in on}  # the inner join has salts of its own
    salted = skew_join(df, hot.withColumnsRenamed(apart), on, "left", hot_rows * 100, counts)
    return salted.withColumnsRenamed({new: old for old, new in apart.items()})


def _salt(df: DataFrame, on: Sequence[str], parts: Column) -> Column:
    """Which of `parts` a row goes to. Rows with a NULL key match nothing, so they go anywhere."""
    hashable = [F.col(c) for c, kind in df.dtypes if "map<" not in kind]
    spread = F.xxhash64(F.spark_partition_id(), *hashable)
    no_key = reduce(lambda x, y: x | y, (F.col(c).isNull() for c in on))
    return F.pmod(spread, F.when(no_key, F.lit(NULL_SALTS)).otherwise(parts)).cast("int")


def _copies(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    left_counts: DataFrame | None = None,
    left_rows: int | None = None,
    right_unique: bool = True,
) -> DataFrame:
    """Equi-join in which a hot key is shared out over many tasks.

    A hot key's left rows are split over salts and its right rows copied to each of them. With
    `right_unique=False` (inner joins only) hot right keys are split likewise, so that a task gets
    about `hot_rows` rows of a key from each side. `left_counts` (`on`, `_rows`) saves counting; the
    counts may be too high. So does `left_rows`, the number of left rows, where they are too few
    for any key to be hot.
    """
    on = [on] if isinstance(on, str) else list(on)
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if how.lower().replace("_", "").replace("outer", "") in ("right", "full"):
        raise ValueError("copies of right rows would come out once per salt")
    if not right_unique and how != "inner":
        raise ValueError("only inner joins can split both sides")
    hot = right_counts = None
    if left_rows is None or left_rows > hot_rows:
        left_counts = key_counts(left, on) if left_counts is None else left_counts
        hot = _hot_keys(left_counts, on, hot_rows, "_nl")
    split_right = False
    if not right_unique:
        right_counts = key_counts(right, on)
        hot_right = _hot_keys(right_counts, on, hot_rows, "_nr")
        split_right = not hot_right.isEmpty()
        if hot is None:
            hot = hot_right.withColumn("_nl", F.lit(1))
        elif split_right:
            hot = hot.join(hot_right, on, "full")
    if hot is None or hot.isEmpty():
        return left.join(right, on, how)
    n_left, n_right = F.coalesce("_nl", F.lit(1)), F.coalesce("_nr", F.lit(1))

    if left_counts is None:
        left_counts = key_counts(left, on)
    lefts = _with_salts(left, hot, on, hot_rows, left_counts)
    lefts = lefts.withColumn(_SPLIT, _salt(left, on, n_left))
    rights = _with_salts(right, hot, on, hot_rows, right_counts).withColumn(_SPLIT, _copies(n_left))
    salts = [_SPLIT]
    if split_right:
        lefts = lefts.withColumn(_COPY, _copies(n_right))
        rights = rights.withColumn(_COPY, _salt(right, on, n_right))
        salts.append(_COPY)
    return (
        lefts.select(*left.columns, *salts)
        .join(rights.select(*right.columns, *salts), [*on, *salts], how)
        .drop(*salts)
    )


def repartition_by(
    df: DataFrame,
    on: str,
    hot_rows: int | None = None,
    counts: DataFrame | None = None,
    at_least: int = 1,
) -> DataFrame:
    """`df` hash-partitioned by `on`, except that hot keys are split over several partitions.

    `counts` (`on`, `_rows`) gives the rows that a key will have once its rows have multiplied.
    The number of partitions is fixed, as the size now would mislead adaptive execution into few.
    It is the session's, or `at_least` if that is more.
    """
    partitions = max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = key_counts(df, [on]) if counts is None else counts
    hot = _hot_keys(counts, [on], hot_rows, "_n")
    if hot.isEmpty():
        return df.repartition(partitions, on)
    salted = _with_salts(df, hot, [on], hot_rows, counts).withColumn(
        _SPLIT, _salt(df, [on], F.coalesce("_n", F.lit(1)))
    )
    return salted.repartition(partitions, on, _SPLIT).select(*df.columns)


def arrays_by(df: DataFrame, on: str, value: str, most: int, counts: DataFrame) -> DataFrame:
    """-> `on`, `value`: the values of each key as arrays; a key of more than `most` rows has several.

    `counts` (`on`, `_rows`) may be too high.
    """
    hot = _hot_keys(counts, [on], most, "_n")
    by = [on]
    if not hot.isEmpty():
        split = _salt(df, [on], F.coalesce("_n", F.lit(1)))
        df = _with_salts(df, hot, [on], most, counts).withColumn(_SPLIT, split)
        by.append(_SPLIT)
    return df.groupBy(*by).agg(F.collect_list(value).alias(value)).select(on, value)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
    left_counts: DataFrame | None = None,
) -> DataFrame:
    """Join to a side with one row per key: broadcast if it was measured small, else salted."""
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dim):
        return facts.join(F.broadcast(dim), on, how)
    return skew_join(facts, dim, on, how, hot_rows, left_counts)
