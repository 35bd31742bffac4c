"""Columnar files, versions of a table and file listings."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.sources.inventory import OPENED, file_inventory, hadoop_inventory

INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def read_orc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.orc(path)


def orc_long_values(df: DataFrame, row: str | None = None) -> DataFrame:
    """-> row, col, value for every integral column; `row` names the column that identifies a row.

    Only the integral columns are read from the file. Without `row` rows get unique numbers.
    A table without integral columns has no values, so no rows.
    """
    names = [c for c, kind in df.dtypes if kind in INTEGRAL and c != row]
    identity = F.monotonically_increasing_id() if row is None else F.col(row)
    if not names:
        none = F.lit(None)
        return df.limit(0).select(
            identity.alias("row"), none.cast("string").alias("col"), none.cast("bigint").alias("value")
        )
    longs = df.select(identity.alias("row"), *(F.col(c).cast("bigint").alias(c) for c in names))
    return longs.unpivot("row", names, "col", "value")


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """-> path, kind, length, modified of every file, empty ones too; contents are not read.

    Folders are listed on the executors (`file_inventory`), or by Hadoop through the driver where
    the path has a scheme that executors cannot open by themselves.
    """
    if urlsplit(path).scheme in OPENED:
        return file_inventory(spark, path, recursive)
    return hadoop_inventory(spark, path, recursive)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version}"


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Freeze `df` as a version of a table; a version is never written twice."""
    path = version_path(root, version)
    df.write.mode("errorifexists").parquet(path)
    return path


def read_version(
    spark: SparkSession, root: str, version: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """A frozen version; only the given columns are read."""
    frozen = spark.read.parquet(version_path(root, version))
    return frozen.select(*columns) if columns else frozen
