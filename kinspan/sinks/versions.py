"""Tables in versions: an upsert writes the files it touches anew and shares all others.

A table is a folder. `data/` holds Parquet files, each written once and never changed. A version
is a manifest, a folder `versions/<number>` with the names of its files, put in place by one rename
of a finished folder; the highest number is the current version. So a reader sees a whole version
or none, and a writer that a rival was faster than fails instead of losing the rival's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.operators.skew import fits_broadcast
from kinspan.operators.tables import same_key, upsert
from kinspan.sinks.files import publish
from kinspan.sources.files import list_files

# The last two parts of a file's address: its folder below `data` and its name.
_NAME = r"([^/]+/[^/]+)$"


def _root(root: str) -> str:
    return root.rstrip("/")


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, ascending; none for a table that does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{_root(root)}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _current(spark: SparkSession, root: str) -> int:
    numbers = versions(spark, root)
    if not numbers:
        raise FileNotFoundError(f"no version of a table at {root}")
    return numbers[-1]


def version_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """-> file, length of a version, the current one if not given. Files are named below `data/`."""
    number = _current(spark, root) if version is None else version
    return spark.read.schema("file string, length bigint").parquet(f"{_root(root)}/versions/{number}")


def read_table_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the current one if not given.

    The names of its files pass the driver, which plans their scan in any case.
    """
    names = [row.file for row in version_files(spark, root, version).select("file").collect()]
    return spark.read.parquet(*(f"{_root(root)}/data/{name}" for name in names))


def _write_files(
    df: DataFrame, root: str, keys: Sequence[str], files: int | None = None
) -> DataFrame:
    """Write rows in ranges of their keys -> file, length of the new files."""
    spark, folder = df.sparkSession, uuid4().hex
    path = f"{_root(root)}/data/{folder}"
    ranged = df.repartitionByRange(*keys) if files is None else df.repartitionByRange(files, *keys)
    ranged.sortWithinPartitions(*keys).write.parquet(path)
    listed = list_files(spark, path).filter(F.col("path").endswith(".parquet"))
    return listed.select(F.regexp_extract("path", _NAME, 1).alias("file"), "length")


def _publish(files: DataFrame, root: str, version: int) -> int:
    spark = files.sparkSession
    staging = f"{_root(root)}/staging/{uuid4().hex}"
    files.select("file", "length").write.parquet(staging)
    publish(spark, staging, f"{_root(root)}/versions/{version}")
    return version


def create_table(
    df: DataFrame, root: str, keys: Sequence[str], files: int | None = None
) -> int:
    """Write `df` as version 1, clustered by its keys; Spark sizes the files unless told how many.

    An error if the table exists.
    """
    if versions(df.sparkSession, root):
        raise FileExistsError(root)
    return _publish(_write_files(df, root, keys, files), root, 1)


def _file_of() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), _NAME, 1)


def upsert_table(
    spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str], order_col: str
) -> int:
    """Write the last update of each key over the current version -> the number of the new one.

    Only files that hold a key of an update are read in full and written anew; the keys alone
    say which. All other files belong to both versions. A null key is a key like others. Without
    updates the new version has the files of the old one. The number of the version read is that
    which the new one follows, so of two writers at a time the second fails with FileExistsError.
    """
    number = _current(spark, root)
    files = version_files(spark, root, number)
    current = read_table_version(spark, root, number)
    wanted = updates.select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)))
    small = fits_broadcast(wanted)
    wanted = F.broadcast(wanted) if small else wanted.distinct()
    held = current.select(*keys, _file_of().alias("file"))
    met = held.join(wanted, same_key((k, f"_{i}") for i, k in enumerate(keys)), "left_semi")
    touched = [row.file for row in met.select("file").distinct().collect()]
    if touched:
        base = spark.read.parquet(*(f"{_root(root)}/data/{name}" for name in touched))
    else:
        base = current.limit(0)
    fresh = _write_files(upsert(base, updates, keys, order_col), root, keys)
    kept = files.filter(~F.col("file").isin(touched)) if touched else files
    return _publish(kept.unionByName(fresh), root, number + 1)


def append_table(spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str]) -> int:
    """Add rows to the current version -> the number of the new one; no file is read or rewritten.

    Cells are put this way: their latest versions are found when they are read.
    """
    number = _current(spark, root)
    files = version_files(spark, root, number)
    return _publish(files.unionByName(_write_files(rows, root, keys)), root, number + 1)
