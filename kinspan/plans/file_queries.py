"""Readers and writers: each query writes a table to the shared folder and reads it back."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from kinspan.functions.text import RELATION_SEP
from kinspan.operators import cells as C
from kinspan.operators import relations as R
from kinspan.plans import inputs as I
from kinspan.plans.registry import query
from kinspan.session import fresh_path
from kinspan.sinks import files as K
from kinspan.sinks import tables as B
from kinspan.sources import files as P
from kinspan.sources import text as X
from kinspan.sources.schema import schema_from_json, violations


@query(
    """SELECT CASE WHEN short THEN CAST(c_custkey AS VARCHAR) ELSE 'v0' END AS bjdrybh,
    CASE WHEN NOT short AND c_acctbal >= 0 THEN c_name END AS xm,
    CASE WHEN NOT short THEN CAST(c_custkey AS VARCHAR) END AS key,
    CASE WHEN NOT short THEN 'v33' END AS yxx,
    CASE WHEN NOT short THEN c_mktsegment END AS field34,
    CASE WHEN NOT short THEN CAST(c_nationkey AS VARCHAR) END AS field36,
    CASE WHEN short THEN 0 ELSE 2 END AS extras,
    CASE WHEN short THEN 'not enough fields' END AS reject_reason
    FROM (SELECT *, c_mktsegment = 'BUILDING' AS short FROM customer)"""
)
def read_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "vertex_lines")
    I.vertex_lines(spark, sf_dir).write.text(path)
    return X.read_vertices(spark, path).select(
        "bjdrybh",
        "xm",
        "key",
        "yxx",
        F.try_element_at("extra", F.lit("field34")).alias("field34"),
        F.try_element_at("extra", F.lit("field36")).alias("field36"),
        F.size("extra").alias("extras"),
        "reject_reason",
    )


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name FROM part")
def read_vertex_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "vertex_pairs")
    named = I.table(spark, sf_dir, "part").select("p_brand", "p_name", "p_size", "p_partkey")
    K.write_text(named, path, RELATION_SEP)
    return X.read_vertex_pairs(spark, path, 3, 1)


@query("SELECT CAST(event_id AS VARCHAR) AS key1, CAST(user_id AS VARCHAR) AS key2 FROM events")
def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "pairs")
    K.write_text(I.pair_list(spark, sf_dir), path, RELATION_SEP)
    return X.read_pairs(spark, path)


@query(
    """SELECT i // 100 AS batch_id, count(*) AS lines, min(i) AS first_seq, max(i) AS last_seq
    FROM range(0, (SELECT count(*) FROM events)) r(i) GROUP BY i // 100"""
)
def read_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line numbers of a key list over several files, by batches of 100 lines."""
    path = fresh_path(spark, "keys")
    keys = I.table(spark, sf_dir, "events").select(I.text_of("user_id").alias("key"))
    keys.repartition(4, "key").write.text(path)
    return (
        X.read_keys(spark, path)
        .groupBy(F.floor(F.col("seq") / 100).alias("batch_id"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
        )
    )


@query(f"WITH {I.DOCUMENT_LINES_SQL} SELECT value, count(*) AS n FROM document_lines GROUP BY value")
def read_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as text files, read through a manifest that names them."""
    root = fresh_path(spark, "manifest")
    I.table(spark, sf_dir, "documents").select("text").write.text(f"{root}/data")
    names = P.list_files(spark, f"{root}/data").filter(F.col("path").endswith(".txt"))
    K.write_text(names.select("path"), f"{root}/manifest")
    lines = X.read_manifest(spark, f"{root}/manifest")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT o_orderstatus AS status, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high
    FROM orders GROUP BY o_orderstatus"""
)
def manifest_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as text files in folders, opened by the tasks that get their names, two at a time."""
    root = fresh_path(spark, "named")
    orders = I.table(spark, sf_dir, "orders")
    line = F.concat_ws("|", "o_orderkey", "o_orderstatus").alias("value")
    orders.select(line, "o_orderstatus").repartition(5, "o_orderkey").write.partitionBy("o_orderstatus").text(
        f"{root}/data"
    )
    names = P.file_inventory(spark, f"{root}/data").filter(F.col("path").endswith(".txt"))
    K.write_text(names.select("path"), f"{root}/manifest")
    lines = X.read_manifest(spark, f"{root}/manifest", lines_per_split=2)
    key = F.substring_index("value", "|", 1).cast("bigint")
    return lines.groupBy(F.substring_index("value", "|", -1).alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )


@query(
    """SELECT CAST(user_id AS VARCHAR) AS row_key, 'f' AS family, event_type AS qualifier,
    CAST(event_id AS VARCHAR) AS value FROM events WHERE event_type <> 'error'"""
)
def read_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events are written with a fifth field, so they are dropped."""
    path = fresh_path(spark, "cells")
    events = I.table(spark, sf_dir, "events")
    line = F.concat_ws(",", "user_id", F.lit("f"), "event_type", "event_id")
    five = F.concat(line, F.lit(",x"))
    events.select(F.when(F.col("event_type") == "error", five).otherwise(line).alias("value")).write.text(path)
    return X.read_cells(spark, path)


@query(
    """SELECT p_partkey, CAST(p_name AS VARCHAR) || '; "' || p_type || '"' AS p_name, p_retailprice,
    split_part(p_name, ' ', 1) AS first_word, len(string_split(p_name, ' ')) AS words
    FROM part WHERE p_brand <> 'Brand#13'"""
)
def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, escapes and an array column; lines with a size that is no number are dropped."""
    path = fresh_path(spark, "csv")
    part = I.table(spark, sf_dir, "part")
    size = F.when(F.col("p_brand") == "Brand#13", "large").otherwise(I.text_of("p_size"))
    name = F.concat("p_name", F.lit('; "'), "p_type", F.lit('"'))
    columns = [
        "p_partkey",
        name.alias("p_name"),
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("p_words"),
        size.alias("p_size"),
        "p_retailprice",
    ]
    part.select(*columns).write.option("sep", ";").csv(path)
    schema = S.StructType(
        [
            S.StructField("p_partkey", S.LongType()),
            S.StructField("p_name", S.StringType()),
            S.StructField("p_words", S.ArrayType(S.StringType())),
            S.StructField("p_size", S.IntegerType()),
            S.StructField("p_retailprice", S.DoubleType()),
        ]
    )
    kept = ["p_partkey", "p_name", "p_words", "p_retailprice"]
    rows = X.read_csv(spark, path, schema, ";", array_sep="|", columns=kept, ignore_errors=True)
    return rows.select(
        "p_partkey",
        "p_name",
        "p_retailprice",
        F.get("p_words", F.lit(0)).alias("first_word"),
        F.size("p_words").cast("bigint").alias("words"),
    )


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) || ':' || l_shipdate AS row, col, value FROM (
      UNPIVOT (SELECT l_orderkey, l_shipdate, CAST(l_partkey AS BIGINT) AS l_partkey,
                      CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
               FROM lineitem)
      ON l_partkey, l_suppkey, l_linenumber INTO NAME col VALUE value)"""
)
def orc_long_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as an ORC file; only its integral columns are read."""
    path = fresh_path(spark, "orc_lines")
    items = I.table(spark, sf_dir, "lineitem")
    when = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    row = F.concat_ws(":", "l_orderkey", when).alias("item")
    measures = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"]
    K.write_orc(items.select(row, *measures), path, "ZLIB")
    return P.orc_long_values(P.read_orc(spark, path), "item")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, 'file' AS kind, count(*) AS row_count FROM {name}" for name in TABLES
    )
)
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the given tables, by table, with the rows that are read from them."""

    def plain(path: str) -> Column:
        return F.regexp_replace(path, "^[a-z]+:/+", "/")

    counts = None
    for name in TABLES:
        read = I.table(spark, sf_dir, name).select(plain("_metadata.file_path").alias("path"))
        per_file = read.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
        counts = per_file if counts is None else counts.unionByName(per_file)
    files = P.list_files(spark, sf_dir, recursive=True)
    listed = files.select(
        plain("path").alias("path"), "kind", F.regexp_extract("path", r"/([^/]+)\.parquet", 1).alias("name")
    )
    return (
        listed.filter(F.col("name").isin(TABLES))
        .join(counts, "path", "left")
        .groupBy("name", "kind")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    )


@query(
    """SELECT CAST(r_regionkey AS VARCHAR) AS folder, count(c_custkey) AS row_count,
    CAST(coalesce(sum(strlen(c_name) + 1), 0) AS BIGINT) AS bytes, false AS has_empty
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
    GROUP BY r_regionkey HAVING count(c_custkey) > 0
    UNION ALL SELECT 'none', 0, 0, true"""
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in a folder per region, two levels down, and a folder of empty files beside them."""
    root = fresh_path(spark, "inventory")
    nations = I.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customers = I.table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_name").alias("value"))
    placed = customers.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    placed = placed.select("value", F.col("n_regionkey").alias("region"))
    placed.write.partitionBy("region").text(f"{root}/some/deep")
    placed.select("value").limit(0).write.text(f"{root}/none")

    def plain(path: str) -> Column:
        return F.regexp_replace(path, "^[a-z]+:/+", "/")

    files = P.file_inventory(spark, root).withColumn("path", plain("path"))
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    counts = lines.groupBy(plain("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    region = F.regexp_extract("path", r"region=([^/]+)/", 1)
    return (
        files.join(counts, "path", "left")
        .groupBy(F.when(region == "", "none").otherwise(region).alias("folder"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.sum("length").alias("bytes"),
            F.bool_or(F.col("length") == 0).alias("has_empty"),
        )
    )


@query(
    """WITH raw AS (
      SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN CAST(c_custkey - 2 AS VARCHAR)
               WHEN c_custkey % 50 = 2 THEN 'k' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey,
             c_mktsegment AS c_name, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal
      FROM customer),
    per_key AS (SELECT c_custkey, count(*) AS n FROM raw WHERE c_custkey IS NOT NULL GROUP BY c_custkey),
    per_name AS (SELECT c_name, count(*) AS n FROM raw GROUP BY c_name)
    SELECT 'c_custkey' AS field, 'missing key' AS violation, NULL AS value, count(*) AS n
      FROM raw WHERE c_custkey IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'c_custkey', 'repeated key', c_custkey, n FROM per_key WHERE n > 1
    UNION ALL SELECT 'c_custkey', 'not a LONG', c_custkey, count(*) FROM raw
      WHERE c_custkey LIKE 'k%' GROUP BY c_custkey
    UNION ALL SELECT 'c_acctbal', 'not a DOUBLE', c_acctbal, count(*) FROM raw
      WHERE c_acctbal = 'debt' GROUP BY c_acctbal
    UNION ALL SELECT 'c_name', 'repeated value', c_name, n FROM per_name WHERE n > 1"""
)
def descriptor_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer lines with missing, repeated and misspelt keys, and balances that are no numbers."""
    key, rest = F.col("c_custkey"), F.col("c_custkey") % 50
    raw = I.table(spark, sf_dir, "customer").select(
        F.when(rest == 0, F.lit(None))
        .when(rest == 1, (key - 2).cast("string"))
        .when(rest == 2, F.concat(F.lit("k"), key))
        .otherwise(key.cast("string"))
        .alias("c_custkey"),
        F.col("c_mktsegment").alias("c_name"),
        F.when(F.col("c_acctbal") < 0, "debt").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
    )
    fields = [
        {"offset": 0, "name": "c_custkey", "dataType": "LONG", "isPrimaryKey": True},
        {"offset": 1, "name": "c_name", "dataType": "STRING", "isUnique": True},
        {"offset": 2, "name": "c_acctbal", "dataType": "DOUBLE"},
    ]
    return violations(raw, schema_from_json(json.dumps(fields)))


@query("SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer")
def read_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as text, read by a schema whose descriptor lists the fields in another order."""
    names = {"c_nationkey": "INT", "c_acctbal": "DOUBLE", "c_name": "STRING", "c_custkey": "LONG"}
    fields = [
        {"name": name, "dataType": kind, "offset": 3 - i, "isPrimaryKey": name == "c_custkey"}
        for i, (name, kind) in enumerate(names.items())
    ]
    schema = schema_from_json(json.dumps(fields))
    path = fresh_path(spark, "described")
    K.write_text(I.table(spark, sf_dir, "customer").select(*schema.names), path, RELATION_SEP)
    return spark.read.schema(schema).csv(path, sep=RELATION_SEP).select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_acctbal", "c_nationkey"
    )


@query(
    """SELECT o_orderkey, o_totalprice, true AS created, false AS created_again, true AS found,
    false AS found_after FROM orders"""
)
def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is created once, filled, found, and dropped; its files stay where they were put."""
    orders = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = fresh_path(spark, "orders_table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    created = [B.create_table_if_absent(spark, name, orders.schema, path) for _ in range(2)]
    orders.write.insertInto(name)
    found = B.table_exists(spark, name)
    B.drop_table(spark, name)
    return spark.read.schema(orders.schema).parquet(path).select(
        "*",
        F.lit(created[0]).alias("created"),
        F.lit(created[1]).alias("created_again"),
        F.lit(found).alias("found"),
        F.lit(B.table_exists(spark, name)).alias("found_after"),
    )


@query("SELECT event_id, event_type FROM events")
def read_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "event_log")
    events = I.table(spark, sf_dir, "events").withColumnRenamed("event_type", "type")
    K.write_json_lines(events, path)
    log = X.read_event_log(spark, path, "event_id bigint, type string")
    return log.select("event_id", "event_type")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def read_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 stays as it was after version 2 is written."""
    root = fresh_path(spark, "orders")
    orders = I.table(spark, sf_dir, "orders")
    P.write_version(orders, root, 1)
    P.write_version(orders.withColumn("o_totalprice", F.lit(0.0)), root, 2)
    return P.read_version(spark, root, 1, ["o_orderkey", "o_totalprice"])


@query(
    f"""WITH {I.GRAPH_SQL} SELECT key || chr(9) || CAST(degree AS VARCHAR) AS value FROM degrees"""
)
def write_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees as `key<TAB>count` lines."""
    path = fresh_path(spark, "degrees")
    K.write_text(_degrees(spark, sf_dir), path)
    return spark.read.text(path)


@query(f"WITH {I.GRAPH_SQL} SELECT key, degree FROM degrees")
def write_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "degrees_json")
    K.write_json_lines(_degrees(spark, sf_dir), path)
    return spark.read.schema("key string, degree bigint").json(path)


def _degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.operators.graph import degrees

    return degrees(I.edges(spark, sf_dir))


@query(f"WITH {I.CELLS_SQL} SELECT count(DISTINCT row_key) AS row_count FROM event_cells")
def export_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "row_keys")
    return K.export_by_range(C.row_keys(I.event_cells(spark, sf_dir)), "row_key", path)


@query(
    f"""WITH {I.VALID_SQL} SELECT least(key1, key2) || ':' || greatest(key1, key2) || ':{I.LABEL}' AS edge_id,
    time_ms AS time, max(raw) AS value FROM valid GROUP BY ALL"""
)
def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows, sorted into ranges in a staging folder that is then published."""
    root = fresh_path(spark, "bulk")
    events = R.pair_events(I.valid(spark, sf_dir), I.LABEL, 1)
    K.bulk_load(events, ["edge_id", "time"], f"{root}/staging")
    K.publish(spark, f"{root}/staging", f"{root}/published")
    return spark.read.parquet(f"{root}/published")


@query(
    " UNION ALL ".join(
        f"SELECT '{codec}' AS codec, c_custkey, c_name, c_mktsegment FROM customer"
        for codec in K.ORC_CODECS
    )
)
def write_orc_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, written and read back with every codec."""
    customers = I.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    parts = []
    for codec in K.ORC_CODECS:
        path = fresh_path(spark, f"orc_{codec.lower()}")
        K.write_orc(customers, path, codec, stripe_size=1024 * 1024)
        parts.append(P.read_orc(spark, path).withColumn("codec", F.lit(codec)))
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


@query(
    """SELECT CAST(o_orderkey AS BIGINT) AS id,
    CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 1
      WHEN '4-NOT SPECIFIED' THEN 1 ELSE 2 END AS outer_size,
    CASE WHEN o_orderpriority = '5-LOW' THEN 2 END AS inner_size,
    CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_custkey AS INTEGER) END AS first_value,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN true END AS inner_null FROM orders"""
)
def write_orc_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of arrays with NULL and empty ones at every level, by the priority of an order."""
    path = fresh_path(spark, "orc_nested")
    nested = "array<array<int>>"
    customer = F.col("o_custkey").cast("int")
    full = F.array(F.array(customer, F.lit(None)), F.array(F.lit(2)))
    arrays = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast(nested))
        .when(F.col("o_orderpriority") == "2-HIGH", F.array().cast(nested))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.array(F.array()).cast(nested))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.array(F.lit(None)).cast(nested))
        .otherwise(full.cast(nested))
    )
    orders = I.table(spark, sf_dir, "orders")
    K.write_orc(orders.select(F.col("o_orderkey").alias("id"), arrays.alias("array_col")), path)
    read = P.read_orc(spark, path)
    outer, inner = F.col("array_col"), F.get("array_col", F.lit(0))
    return read.select(
        "id",
        F.when(outer.isNotNull(), F.size(outer)).alias("outer_size"),
        F.when(F.size(inner) == 2, 2).alias("inner_size"),
        F.get(inner, F.lit(0)).alias("first_value"),
        F.when((F.size(outer) == 1) & inner.isNull(), True).alias("inner_null"),
    )
