"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table_if_absent(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None
) -> bool:
    """Create an empty table unless it exists; says whether it was created."""
    if table_exists(spark, name):
        return False
    location = {} if path is None else {"path": path}
    spark.catalog.createTable(name, source="parquet", schema=schema, **location)
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
