"""Text, ORC and sorted bulk outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Codec names of the ORC sink (fixed values).
ORC_CODECS = ("NONE", "LZ4", "LZO", "SNAPPY", "ZLIB")


def write_text(df: DataFrame, path: str, sep: str = "\t", compression: str = "none") -> None:
    """One line per row, columns joined by `sep`; a NULL is an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.option(
        "compression", compression
    ).text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def export_by_range(df: DataFrame, key: str, path: str, n: int | None = None) -> DataFrame:
    """Write the distinct keys as text, one file per key range -> row_count of what was written."""
    spark = df.sparkSession
    keys = df.select(F.col(key).cast("string").alias("value")).distinct()
    ranged = keys.repartitionByRange("value") if n is None else keys.repartitionByRange(n, "value")
    written = Observation()
    ranged.observe(written, F.count(F.lit(1)).alias("row_count")).write.text(path)
    return spark.createDataFrame([(written.get["row_count"],)], "row_count bigint")


def bulk_load(
    df: DataFrame,
    sort_cols: Sequence[str],
    path: str,
    n_ranges: int | None = None,
    compression: str = "gzip",
) -> None:
    """Write rows in key ranges, sorted within each, so that key filters skip files and row groups.

    `sort_cols` should tell rows apart: a range cannot be cut inside a run of equal rows. Without
    `n_ranges` Spark sizes the ranges.
    """
    if n_ranges is None:
        ranged = df.repartitionByRange(*sort_cols)
    else:
        ranged = df.repartitionByRange(n_ranges, *sort_cols)
    ranged.sortWithinPartitions(*sort_cols).write.option("compression", compression).parquet(path)


def publish(spark: SparkSession, staging: str, target: str) -> None:
    """Rename a finished `staging` folder to `target`, which must not exist yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, destination = hadoop.Path(staging), hadoop.Path(target)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop.Path(source, "_SUCCESS")):
        raise FileNotFoundError(f"no finished write at {staging}")
    if fs.exists(destination):
        raise FileExistsError(target)
    parent = destination.getParent()
    if parent is not None:
        fs.mkdirs(parent)
    if not fs.rename(source, destination):
        raise OSError(f"could not rename {staging} to {target}")


def write_orc(df: DataFrame, path: str, codec: str = "ZLIB", stripe_size: int | None = None) -> None:
    if codec.upper() not in ORC_CODECS:
        raise ValueError(f"unknown codec {codec!r}, expected one of {ORC_CODECS}")
    writer = df.write.option("compression", codec.lower())
    if stripe_size is not None:
        writer = writer.option("orc.stripe.size", str(stripe_size))
    writer.orc(path)
