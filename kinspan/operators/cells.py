"""Cell tables: row_key, family, qualifier, ts, value, a row per version of a cell."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinspan.functions.numbers import row_count
from kinspan.operators.skew import lookup_join, only_listed
from kinspan.session import reliable

CELL_KEY = ["row_key", "family", "qualifier"]


def _column(family: str, qualifier: str) -> Column:
    return (F.col("family") == family) & (F.col("qualifier") == qualifier)


def scan_column(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """-> row_key, value of one column."""
    return cells.filter(_column(family, qualifier)).select("row_key", "value")


def scan_range(
    cells: DataFrame, start: str, end: str, family: str, qualifier: str
) -> DataFrame:
    """-> row_key, value of one column for start <= row_key < end."""
    in_range = (F.col("row_key") >= start) & (F.col("row_key") < end)
    return scan_column(cells.filter(in_range), family, qualifier)


def scan_prefix(cells: DataFrame, prefix: str, family: str, qualifier: str) -> DataFrame:
    """-> row_key, value of one column for the row keys that start with `prefix`."""
    return scan_column(cells.filter(F.col("row_key").startswith(prefix)), family, qualifier)


def rows_with_columns(cells: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """All cells of the rows that have every one of the (family, qualifier) columns.

    The test folds to one flag per column before the shuffle, so a row of very many cells is small
    by the time it moves.
    """
    wanted = [_column(family, qualifier) for family, qualifier in columns]
    has = [F.bool_or(test).alias(f"_has{i}") for i, test in enumerate(wanted)]
    candidates = cells.filter(reduce(lambda x, y: x | y, wanted))
    has_all = reduce(lambda x, y: x & y, (F.col(f"_has{i}") for i in range(len(wanted))))
    rows = reliable(candidates.groupBy("row_key").agg(*has).filter(has_all).select("row_key"))
    return lookup_join(cells, rows, "row_key", "left_semi").select(*CELL_KEY, "value")


def scanned_rows(cells: DataFrame) -> DataFrame:
    """-> scanned: number of rows."""
    return cells.select("row_key").distinct().agg(row_count().alias("scanned"))


def delete_by_prefix(cells: DataFrame, row: str, family: str, prefix: str) -> DataFrame:
    """The cells left once a row's columns of one family that start with `prefix` are gone."""
    return cells.filter(~_doomed(row, family, prefix))


def deleted_by_prefix(cells: DataFrame, row: str, family: str, prefix: str) -> DataFrame:
    """-> deleted: number of cells that `delete_by_prefix` drops."""
    return cells.filter(_doomed(row, family, prefix)).agg(row_count().alias("deleted"))


def _doomed(row: str, family: str, prefix: str) -> Column:
    return (
        (F.col("row_key") == row)
        & (F.col("family") == family)
        & F.col("qualifier").startswith(prefix)
    )


def latest_cells(cells: DataFrame) -> DataFrame:
    """The latest version of every cell; of several with one ts the greatest value."""
    return (
        cells.groupBy(*CELL_KEY)
        .agg(F.max(F.struct("ts", "value")).alias("_last"))
        .select(*CELL_KEY, "_last.ts", "_last.value")
    )


def cell_versions(cells: DataFrame, versions: int) -> DataFrame:
    """Up to `versions` latest versions of every cell.

    The rank filter lets Spark drop surplus versions in each task before they are shuffled.
    """
    newest = Window.partitionBy(*CELL_KEY).orderBy(F.col("ts").desc(), F.col("value").desc())
    ranked = cells.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= versions).drop("_rank")


def get_cell(
    cells: DataFrame, row: str, family: str, qualifier: str, versions: int = 1
) -> DataFrame:
    """-> row_key, family, qualifier, ts, value: one cell's latest `versions` versions."""
    found = cells.filter((F.col("row_key") == row) & _column(family, qualifier))
    kept = latest_cells(found) if versions == 1 else cell_versions(found, versions)
    return kept.select(*CELL_KEY, "ts", "value")


def get_row(cells: DataFrame, row: str) -> DataFrame:
    """The latest version of each cell in a row."""
    return latest_cells(cells.filter(F.col("row_key") == row))


def row_keys(cells: DataFrame) -> DataFrame:
    """-> row_key, each once."""
    return cells.select("row_key").distinct()


def put_cells(cells: DataFrame, incoming: DataFrame) -> DataFrame:
    """Latest cells once `incoming` is written over `cells`; at one ts the incoming value wins."""
    columns = [*CELL_KEY, "ts", "value"]
    both = (
        cells.select(*columns)
        .withColumn("_seq", F.lit(0))
        .unionByName(incoming.select(*columns).withColumn("_seq", F.lit(1)))
    )
    return (
        both.groupBy(*CELL_KEY)
        .agg(F.max(F.struct("ts", "_seq", "value")).alias("_last"))
        .select(*CELL_KEY, "_last.ts", "_last.value")
    )


def apply_increments(base: DataFrame, increments: DataFrame) -> DataFrame:
    """-> row_key, qualifier, value: counters with every increment (`inc`) added, none lost."""
    both = base.select("row_key", "qualifier", "value").unionByName(
        increments.select("row_key", "qualifier", F.col("inc").alias("value"))
    )
    return both.groupBy("row_key", "qualifier").agg(F.sum("value").alias("value"))


def batch_get(keys: DataFrame, cells: DataFrame, batch: int) -> DataFrame:
    """-> batch_id, requested, found for a key list (seq, key) fetched `batch` keys at a time.

    The last batch may be short and is kept.
    """
    stored = cells.select(F.col("row_key").alias("key"))
    present = only_listed(stored, keys, "key").distinct().withColumn("_found", F.lit(True))
    numbered = keys.select(F.floor(F.col("seq") / batch).cast("bigint").alias("batch_id"), "key")
    return (
        lookup_join(numbered, reliable(present), "key", "left")
        .groupBy("batch_id")
        .agg(row_count().alias("requested"), F.count("_found").alias("found"))
    )


def range_counts(ids: DataFrame, cells: DataFrame) -> DataFrame:
    """-> id, row_count: rows with id <= row_key < id || '0', for each distinct trimmed id.

    Such a row key is the id itself or goes on with a character below '0'; an empty id is the start
    of every row key. So each row offers the
    prefixes that end before such a character, and itself, as ids: the range join becomes an
    equality on counts that are already summed up.
    """
    distinct_ids = ids.select(F.trim("id").alias("id")).distinct()
    key = F.col("row_key")

    def next_is_low(end: Column) -> Column:
        return (end == F.length(key)) | (F.substr(key, end + 1, F.lit(1)) < "0")

    ends = F.filter(F.sequence(F.lit(0), F.length(key)), next_is_low)
    prefixes = F.transform(ends, lambda end: F.substr(key, F.lit(1), end))
    offered = row_keys(cells).select(F.explode(prefixes).alias("id"))
    counts = (
        only_listed(offered, distinct_ids, "id").groupBy("id").agg(row_count().alias("row_count"))
    )
    return distinct_ids.join(counts, "id", "left").select(
        "id", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )
