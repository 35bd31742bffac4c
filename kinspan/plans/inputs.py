"""Relation lines, graphs, key lists and cells derived from the given tables, and their SQL twins.

Each `*_SQL` constant is a list of common table expressions, to be put after WITH.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.functions.text import RELATION_SEP
from kinspan.operators.relations import accepted, parse_relations, validate_relations
from kinspan.sources.text import VERTEX_FIELDS

LABEL = "relation"
FIELDS = 38


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    return F.col(column).cast("string")


# Supply records: a part and a supplier share one key space; returns point the other way.


ITEM_COLUMNS = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_returnflag l_shipdate l_tax l_discount".split()
)


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> key1, key2, time_text, order, line, label, tax, discount, ms: one row per line item."""
    items = table(spark, sf_dir, "lineitem").select(*ITEM_COLUMNS)
    returned = F.col("l_returnflag") == "R"
    month = F.date_trunc("month", "l_shipdate")
    return items.select(
        F.when(returned, F.col("l_suppkey")).otherwise(F.col("l_partkey")).cast("string").alias("key1"),
        F.when(returned, F.col("l_partkey")).otherwise(F.col("l_suppkey")).cast("string").alias("key2"),
        F.concat(F.date_format(month, "yyyy-MM-dd HH:mm:ss"), F.lit(".0")).alias("time_text"),
        F.unix_millis(F.to_timestamp(month)).alias("ms"),
        text_of("l_orderkey").alias("order"),
        text_of("l_linenumber").alias("line"),
        F.when(returned, "return").otherwise("sale").alias("label"),
        F.col("l_tax").alias("tax"),
        F.col("l_discount").alias("discount"),
    )


SUPPLY_SQL = """
supply AS (
  SELECT CAST(CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS VARCHAR) AS key1,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE l_suppkey END AS VARCHAR) AS key2,
         strftime(date_trunc('month', l_shipdate), '%Y-%m-%d %H:%M:%S') || '.0' AS time_text,
         epoch_ms(CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)) AS ms,
         CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS line_no,
         CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'sale' END AS label,
         l_tax AS tax, l_discount AS discount
  FROM lineitem)"""


def relation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> value: a 38-field line per supply record.

    Lines taxed at 8 % break off after ten fields; those at 10 % discount have an unreadable time.
    """
    bad_time = F.when(F.col("discount") == 0.1, "bad").otherwise(F.col("time_text"))
    special = {0: F.col("key1"), 9: bad_time, 19: F.col("key2"), 28: F.col("time_text"), 37: F.col("order")}
    fields = [special.get(i, F.lit(f"f{i}")) for i in range(FIELDS)]
    whole = F.concat_ws(RELATION_SEP, *fields)
    short = F.concat_ws(RELATION_SEP, *fields[:10])
    records = supply(spark, sf_dir)
    return records.select(F.when(F.col("tax") == 0.08, short).otherwise(whole).alias("value"))


def _line_sql(count: int) -> str:
    special = {
        0: "key1",
        9: "CASE WHEN discount = 0.1 THEN 'bad' ELSE time_text END",
        19: "key2",
        28: "time_text",
        37: "order_no",
    }
    fields = ", ".join(special.get(i, f"'f{i}'") for i in range(count))
    return f"concat_ws(chr(1), {fields})"


LINES_SQL = f"""{SUPPLY_SQL},
lines AS (
  SELECT CASE WHEN tax = 0.08 THEN {_line_sql(10)} ELSE {_line_sql(FIELDS)} END AS raw FROM supply),
parsed AS (
  SELECT raw, f, CAST(len(f) AS INTEGER) AS field_count, f[1] AS key1, f[20] AS key2, f[10] AS time_text
  FROM (SELECT raw, string_split(raw, chr(1)) AS f FROM lines))"""


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_relations(relation_lines(spark, sf_dir))


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> key, name of the customers; part keys beyond theirs are unknown endpoints."""
    return table(spark, sf_dir, "customer").select(
        text_of("c_custkey").alias("key"), F.col("c_name").alias("name")
    )


def vertex_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> value: a tab-separated line per customer, with three columns beyond the known fields.

    Overdrawn customers lack a name; the lines of those in BUILDING are one column only.
    """
    fields = [F.lit(f"v{i}") for i in range(len(VERTEX_FIELDS))]
    fields[1] = F.when(F.col("c_acctbal") < 0, "null").otherwise(F.col("c_name"))
    fields[5] = text_of("c_custkey")
    fields += [F.col("c_mktsegment"), F.lit("NULL"), text_of("c_nationkey")]
    short = text_of("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", short)
        .otherwise(F.concat_ws("\t", *fields))
        .alias("value")
    )


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_relations(relations(spark, sf_dir), persons(spark, sf_dir), default_time=0)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(validated(spark, sf_dir))


VALID_SQL = f"""{LINES_SQL},
persons AS (SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer),
validated AS (
  SELECT key1, key2,
         coalesce(epoch_ms(try_strptime(split_part(time_text, '.', 1), '%Y-%m-%d %H:%M:%S')), 0) AS time_ms,
         raw,
         CASE WHEN field_count <= 19 THEN 'not enough fields'
              WHEN key1 NOT IN (SELECT key FROM persons) THEN 'key1 not found'
              WHEN key2 NOT IN (SELECT key FROM persons) THEN 'key2 not found' END AS reject_reason
  FROM parsed),
valid AS (SELECT key1, key2, time_ms, raw FROM validated WHERE reject_reason IS NULL)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> src, dst, label, time, value: the supply graph, suppliers being its hubs."""
    return supply(spark, sf_dir).select(
        F.col("key1").alias("src"),
        F.col("key2").alias("dst"),
        "label",
        F.col("ms").alias("time"),
        F.concat_ws(":", "order", "line").alias("value"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> key, name, brand, kind, size: the vertices of the supply graph."""
    return table(spark, sf_dir, "part").select(
        text_of("p_partkey").alias("key"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        text_of("p_size").alias("size"),
    )


GRAPH_SQL = f"""{SUPPLY_SQL},
edges AS (
  SELECT key1 AS src, key2 AS dst, label, ms AS time, order_no || ':' || line_no AS value FROM supply),
vertices AS (
  SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand AS brand, p_type AS kind,
         CAST(p_size AS VARCHAR) AS size FROM part),
incidence AS (
  SELECT src AS v, dst AS other, label, time, value FROM edges
  UNION ALL SELECT dst, src, label, time, value FROM edges),
degrees AS (SELECT v AS key, count(*) AS degree FROM incidence GROUP BY v),
neighbors AS (SELECT DISTINCT v, other FROM incidence)"""


def all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).select("key")


def supplier_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> key of every supplier: a short key list."""
    return table(spark, sf_dir, "supplier").select(text_of("s_suppkey").alias("key"))


def key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> key: the users of all events, so with repeats, and the nations' names, which are unknown."""
    users = table(spark, sf_dir, "events").select(text_of("user_id").alias("key"))
    return users.unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("key")))


KEY_LIST_SQL = """
key_list AS (
  SELECT CAST(user_id AS VARCHAR) AS key FROM events UNION ALL SELECT n_name FROM nation)"""


def pair_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> key1, key2: event and user numbers; some pairs are joined, most are not."""
    return table(spark, sf_dir, "events").select(
        text_of("event_id").alias("key1"), text_of("user_id").alias("key2")
    )


PAIR_LIST_SQL = """
pair_list AS (
  SELECT key1, key2, count(*) AS listed FROM (
    SELECT CAST(event_id AS VARCHAR) AS key1, CAST(user_id AS VARCHAR) AS key2 FROM events)
  GROUP BY key1, key2)"""


def _cells(spark: SparkSession, sf_dir: str, *row_key: Column) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat_ws(RELATION_SEP, *row_key).alias("row_key"),
        F.lit("f").alias("family"),
        F.col("event_type").alias("qualifier"),
        "ts",
        F.col("props").alias("value"),
    )


def user_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per user, a column per event type, a version per event."""
    return _cells(spark, sf_dir, text_of("user_id"))


def day_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per user and day."""
    return _cells(spark, sf_dir, text_of("user_id"), F.date_format("ts", "yyyy-MM-dd"))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per event, keyed by its user first."""
    return _cells(spark, sf_dir, text_of("user_id"), text_of("event_id"))


CELLS_SQL = """
user_cells AS (
  SELECT CAST(user_id AS VARCHAR) AS row_key, 'f' AS family, event_type AS qualifier, ts, props AS value
  FROM events),
day_cells AS (
  SELECT CAST(user_id AS VARCHAR) || chr(1) || strftime(ts, '%Y-%m-%d') AS row_key, 'f' AS family,
         event_type AS qualifier, ts, props AS value FROM events),
event_cells AS (
  SELECT CAST(user_id AS VARCHAR) || chr(1) || CAST(event_id AS VARCHAR) AS row_key, 'f' AS family,
         event_type AS qualifier, ts, props AS value FROM events)"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-> doc_id, line_no, value: every line of every document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    )


DOCUMENT_LINES_SQL = """
document_lines AS (
  SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS value
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""
