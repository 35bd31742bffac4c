"""Line-oriented inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspan.functions.select import select_where
from kinspan.functions.text import RELATION_SEP, null_if_literal, split_trimmed
from kinspan.sources.inventory import lines_of_files
from kinspan.sources.lines import (
    KEY1_INDEX,
    KEY2_INDEX,
    NOT_ENOUGH_FIELDS,
    TIME_INDEX,
    parse_relations,
)

# Vertex fields by position (fixed values).
VERTEX_FIELDS = (
    "bjdrybh", "xm", "wwxm", "xb_dm", "xb", "key", "fake1", "csrq", "gj_dm", "gj", "mz_dm", "mz",
    "jg_dm", "jg", "hjdqh", "hjdxz", "hjdpcsdm", "hjdpcs", "xzdqh", "xzdxz", "xzdpcsdm", "xzdpcs",
    "gxdwjgdm", "gxdwjg", "ladwjgdm", "ladwjg", "zjlasj", "nrbjzdryksj", "zdrylbbj_dm", "zdrylbbj",
    "zdryxl_dm", "zdryxl", "yxx_dm", "yxx",
)


def read_relations(
    spark: SparkSession,
    path: str | list[str],
    key1_idx: int = KEY1_INDEX,
    key2_idx: int = KEY2_INDEX,
    time_idx: int = TIME_INDEX,
    sep: str = RELATION_SEP,
) -> DataFrame:
    """-> raw, fields, field_count, key1, key2, time_text."""
    return parse_relations(spark.read.text(path), key1_idx, key2_idx, time_idx, sep)


def parse_vertices(
    lines: DataFrame, fields: Sequence[str] = VERTEX_FIELDS, sep: str = "\t"
) -> DataFrame:
    """`value` lines -> one column per field, `extra` (fieldN -> text) and `reject_reason`.

    The text NULL, in any case, and columns beyond the end of a line are NULL.
    """
    known = len(fields)
    cut = lines.select(split_trimmed(F.col("value"), sep).alias("_f"))
    overflow = F.slice("_f", known + 1, F.greatest(F.size("_f") - known, F.lit(0)))
    named = F.transform(
        overflow,
        lambda text, i: F.struct(
            F.concat(F.lit("field"), (i + known).cast("string")).alias("key"),
            null_if_literal(text).alias("value"),
        ),
    )
    extra = F.map_from_entries(F.filter(named, lambda e: e["value"].isNotNull()))
    columns = [null_if_literal(F.get("_f", F.lit(i))).alias(name) for i, name in enumerate(fields)]
    short = (F.size("_f") <= 1) | (F.size("_f") <= list(fields).index("key"))
    return cut.select(
        *columns, extra.alias("extra"), F.when(short, F.lit(NOT_ENOUGH_FIELDS)).alias("reject_reason")
    )


def read_vertices(
    spark: SparkSession,
    path: str | list[str],
    fields: Sequence[str] = VERTEX_FIELDS,
    sep: str = "\t",
) -> DataFrame:
    return parse_vertices(spark.read.text(path), fields, sep)


def parse_vertex_pairs(
    lines: DataFrame, key_idx: int, name_idx: int, sep: str = RELATION_SEP
) -> DataFrame:
    """`value` lines -> key, name; lines that end before either are dropped."""
    cut = lines.select(split_trimmed(F.col("value"), sep).alias("_f"))
    return select_where(
        cut,
        F.size("_f") > max(key_idx, name_idx),
        F.get("_f", F.lit(key_idx)).alias("key"),
        F.get("_f", F.lit(name_idx)).alias("name"),
    )


def read_vertex_pairs(
    spark: SparkSession, path: str | list[str], key_idx: int, name_idx: int, sep: str = RELATION_SEP
) -> DataFrame:
    return parse_vertex_pairs(spark.read.text(path), key_idx, name_idx, sep)


def read_manifest(
    spark: SparkSession, manifest: str, lines_per_split: int | None = None
) -> DataFrame:
    """-> value, file_path: the lines of every file the manifest names, a path per line.

    With `lines_per_split` the manifest's lines are dealt out by as many, and the task that
    gets them opens their files itself, one after the other: no path passes the driver, and no file
    is divided. It needs paths that executors open by themselves (local and mounted ones, s3, gs,
    hdfs). Without it Spark plans a scan of all the files, for which the driver collects their paths.
    Empty lines name nothing; a file that is not there is an error, one that is named twice is read twice.
    """
    if lines_per_split is not None:
        return _open_named(spark, manifest, lines_per_split)
    named = spark.read.text(manifest).select(F.trim("value").alias("path"))
    paths = [row.path for row in named.filter(F.col("path") != "").collect()]
    if not paths:
        return spark.createDataFrame([], "value string, file_path string")
    lines = spark.read.text(paths)
    return lines.select("value", F.col("_metadata.file_path").alias("file_path"))


def _open_named(spark: SparkSession, manifest: str, lines_per_split: int) -> DataFrame:
    if lines_per_split < 1:
        raise ValueError(f"a split needs a line: {lines_per_split}")
    named = read_keys(spark, manifest).select("seq", F.trim("key").alias("path"))
    named = named.filter(F.col("path") != "")
    # A split is a range of lines, so ranges are what is dealt out.
    last = named.agg(F.max("seq")).first()[0]
    splits = 0 if last is None else last // lines_per_split + 1
    if splits == 0:
        return spark.createDataFrame([], "value string, file_path string")
    split = F.floor(F.col("seq") / lines_per_split).cast("int")
    dealt = named.repartitionById(splits, split) if splits > 1 else named.coalesce(1)
    return dealt.select("path").mapInArrow(lines_of_files, "value string, file_path string")


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """-> seq, key: a key list with its line numbers from 0, in the order of the files' splits.

    Lines are counted per split first; the running total over splits, a row for each, is small.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("key"), F.monotonically_increasing_id().alias("_id")
    )
    # The upper bits of the id are the split, the lower 33 the line within it.
    split_of = F.shiftright("_id", 33)
    sizes = lines.groupBy(split_of.alias("_split")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    line_no = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        lines.withColumn("_split", split_of)
        .join(F.broadcast(starts), "_split")
        .select((F.col("_start") + line_no).alias("seq"), "key")
    )


def parse_pairs(lines: DataFrame, sep: str = RELATION_SEP) -> DataFrame:
    """`value` lines -> key1, key2."""
    return parse_vertex_pairs(lines, 0, 1, sep).toDF("key1", "key2")


def read_pairs(spark: SparkSession, path: str | list[str], sep: str = RELATION_SEP) -> DataFrame:
    return parse_pairs(spark.read.text(path), sep)


def parse_cells(lines: DataFrame, sep: str = ",") -> DataFrame:
    """`value` lines -> row_key, family, qualifier, value; lines without exactly 4 fields are dropped."""
    cut = lines.select(split_trimmed(F.col("value"), sep).alias("_f"))
    names = ["row_key", "family", "qualifier", "value"]
    columns = [F.get("_f", F.lit(i)).alias(name) for i, name in enumerate(names)]
    return select_where(cut, F.size("_f") == len(names), *columns)


def read_cells(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    return parse_cells(spark.read.text(path), sep)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    array_sep: str | None = None,
    columns: Sequence[str] | None = None,
    ignore_errors: bool = False,
) -> DataFrame:
    """Delimited rows with a schema; array columns hold their elements joined by `array_sep`.

    A malformed row fails the read, or is dropped with `ignore_errors`.
    """
    if not path or schema is None:
        raise ValueError("an input path and a schema are mandatory")
    if len(sep) != 1:
        raise ValueError(f"the delimiter has to be one character: {sep!r}")
    arrays = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.ArrayType)}
    if arrays and not array_sep:
        raise ValueError(f"array columns need an array delimiter: {sorted(arrays)}")
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in arrays else f.dataType) for f in schema]
    )
    rows = (
        spark.read.schema(flat)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
        .option("mode", "DROPMALFORMED" if ignore_errors else "FAILFAST")
        .csv(path)
    )
    # Always true, but it needs every column: the reader does not see errors in those it may skip.
    rows = rows.filter(F.pmod(F.xxhash64(*flat.names), F.lit(2)) >= 0)
    for name, kind in arrays.items():
        rows = rows.withColumn(name, F.split(name, f"\\Q{array_sep}\\E").cast(kind))
    return rows.select(*(columns or schema.names))


def read_event_log(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """A log of JSON events, one per line; a `type` field is read as `event_type`."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    events = reader.json(path)
    return events.withColumnRenamed("type", "event_type") if "type" in events.columns else events
