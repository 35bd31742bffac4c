"""Keyed tables, line bags, samples and column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.functions import text as X
from kinspan.operators import relations as R
from kinspan.operators import tables as T
from kinspan.operators.cells import row_keys
from kinspan.operators.rows import null_literals as rows_with_nulls
from kinspan.plans import inputs as I
from kinspan.plans.registry import query
from kinspan.session import fresh_path
from kinspan.sinks import versions as V

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query(f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderkey = 77")
def lookup_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.lookup_id(I.table(spark, sf_dir, "orders"), 77, "o_orderkey")


@query(f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def lookup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = I.table(spark, sf_dir, "events").select("user_id")
    return T.lookup_ids(I.table(spark, sf_dir, "orders"), users, "o_custkey")


@query(
    """WITH updates AS (
      SELECT l_partkey AS c_custkey, 'Update#' || l_orderkey AS c_name, l_linenumber AS c_nationkey,
             l_extendedprice AS c_acctbal, l_returnflag AS c_mktsegment, l_shipdate FROM lineitem),
    last AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY l_shipdate DESC,
        c_name DESC, c_nationkey DESC, c_acctbal DESC, c_mktsegment DESC) AS rn FROM updates)
      WHERE rn = 1)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM last
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM last)"""
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = I.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("c_custkey"),
        F.concat(F.lit("Update#"), F.col("l_orderkey")).alias("c_name"),
        F.col("l_linenumber").alias("c_nationkey"),
        F.col("l_extendedprice").alias("c_acctbal"),
        F.col("l_returnflag").alias("c_mktsegment"),
        "l_shipdate",
    )
    return T.upsert(I.table(spark, sf_dir, "customer"), updates, ["c_custkey"], "l_shipdate")


@query(
    """WITH updates AS (
      SELECT DISTINCT l_orderkey AS o_orderkey, true AS touched FROM lineitem WHERE l_orderkey <= 40),
    changed AS (
      SELECT o_orderkey, o_custkey, CASE WHEN touched THEN 'X' ELSE o_orderstatus END AS o_orderstatus
      FROM orders LEFT JOIN updates USING (o_orderkey)
      UNION ALL SELECT -1, -1, 'N' UNION ALL SELECT NULL, -2, 'N')
    SELECT 1 AS version, o_orderkey, o_custkey, o_orderstatus, true AS shares FROM orders
    UNION ALL SELECT 2, o_orderkey, o_custkey, o_orderstatus, true FROM changed
    UNION ALL SELECT 3, o_orderkey, o_custkey, o_orderstatus, true FROM changed
    UNION ALL SELECT 3, NULL, -3, 'A', true"""
)
def upsert_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as version 1, an upsert of few keys, a new and a null one as 2, an appended row as 3.

    Each later version shares files with the one before.
    """
    root = fresh_path(spark, "orders-table")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    orders = I.table(spark, sf_dir, "orders").select(*columns)
    V.create_table(orders, root, ["o_orderkey"], files=8)
    hit = I.table(spark, sf_dir, "lineitem").filter("l_orderkey <= 40")
    hit = hit.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    updates = orders.join(hit, "o_orderkey", "left_semi").withColumn("o_orderstatus", F.lit("X"))
    fresh = spark.createDataFrame([(-1, -1, "N"), (None, -2, "N"), (None, -2, "A")], orders.schema)
    updates = updates.unionByName(fresh)
    V.upsert_table(spark, root, updates, ["o_orderkey"], "o_orderstatus")
    V.append_table(spark, root, spark.createDataFrame([(None, -3, "A")], orders.schema), ["o_orderkey"])
    read = None
    for version in V.versions(spark, root):
        files = V.version_files(spark, root, version).select("file")
        before = V.version_files(spark, root, max(1, version - 1)).select("file")
        shares = not files.join(before, "file", "left_semi").isEmpty()
        rows = V.read_table_version(spark, root, version).select(
            F.lit(version).alias("version"), *columns, F.lit(shares).alias("shares")
        )
        read = rows if read is None else read.unionByName(rows)
    return read


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.event_type_counts(I.table(spark, sf_dir, "events"))


@query(f"WITH {I.DOCUMENT_LINES_SQL} SELECT value, count(*) AS n FROM document_lines GROUP BY value")
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.line_counts(I.document_lines(spark, sf_dir))


COUNTED = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _cardinalities_sql(columns: list[str]) -> str:
    per_column = (f"SELECT '{c}' AS col, count(DISTINCT {c}) AS ndv FROM lineitem" for c in columns)
    return "cards AS (" + " UNION ALL ".join(per_column) + ")"


@query(f"WITH {_cardinalities_sql(COUNTED)} SELECT col, ndv FROM cards")
def cardinalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.cardinalities(I.table(spark, sf_dir, "lineitem"), COUNTED)


@query(
    f"""WITH {_cardinalities_sql(COUNTED)},
    total AS (
      SELECT round(sum(log10(ndv)), 6) AS log10_product,
        list_reduce(list(CAST(ndv AS HUGEINT)), lambda a, b: a * b) AS p FROM cards),
    row_count AS (SELECT count(*) AS n FROM lineitem)
    SELECT log10_product, CASE WHEN p < 9223372036854775807 THEN CAST(p AS BIGINT) END AS product,
           CASE WHEN p < n THEN CAST(p AS BIGINT) ELSE n END AS capped_product
    FROM total, row_count"""
)
def cardinality_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = T.cardinality_product(I.table(spark, sf_dir, "lineitem"), COUNTED)
    return product.withColumn("log10_product", F.round("log10_product", 6))


SKETCHED = {"lineitem": "l_partkey", "orders": "o_custkey", "customer": "c_custkey"}


@query(
    f"""WITH {_cardinalities_sql(COUNTED)} SELECT col, ndv AS exact, true AS within FROM cards
    UNION ALL SELECT 'any key', count(DISTINCT k), true FROM (
      SELECT l_partkey AS k FROM lineitem UNION ALL SELECT o_custkey FROM orders
      UNION ALL SELECT c_custkey FROM customer)"""
)
def cardinality_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per file against exact counts: each column, and one key over three tables."""
    items = I.table(spark, sf_dir, "lineitem")
    estimates = T.united_cardinalities(T.file_sketches(items, COUNTED), COUNTED)
    exact = T.cardinalities(items, COUNTED).withColumnRenamed("ndv", "exact")
    parts = [I.table(spark, sf_dir, t).withColumnRenamed(c, "any key") for t, c in SKETCHED.items()]
    sketches, keys = None, None
    for part in parts:
        own = T.file_sketches(part, ["any key"])
        sketches = own if sketches is None else sketches.unionByName(own)
        key = part.select("any key")
        keys = key if keys is None else keys.unionByName(key)
    estimates = estimates.unionByName(T.united_cardinalities(sketches, ["any key"]))
    exact = exact.unionByName(T.cardinalities(keys, ["any key"]).withColumnRenamed("ndv", "exact"))
    off = F.abs(F.col("ndv") - F.col("exact")) <= F.ceil(F.col("exact") * F.col("error") * 3)
    return exact.join(estimates, "col").select("col", "exact", off.alias("within"))


@query(
    f"""WITH {I.DOCUMENT_LINES_SQL}, drawn AS (
      SELECT doc_id, line_no, value,
        md5(concat_ws(chr(1), '7', CAST(doc_id AS VARCHAR), CAST(line_no AS VARCHAR))) AS draw
      FROM document_lines)
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, value FROM drawn ORDER BY draw
    LIMIT (SELECT count(*) // 2 FROM document_lines)"""
)
def sample_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly half of all lines, in random order."""
    lines = I.document_lines(spark, sf_dir)
    return T.sample_lines(lines, lines.count() // 2, 7, ["doc_id", "line_no"])


@query(
    f"""WITH {I.DOCUMENT_LINES_SQL} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, value
    FROM document_lines
    ORDER BY md5(concat_ws(chr(1), '42', CAST(doc_id AS VARCHAR), CAST(line_no AS VARCHAR))) LIMIT 500"""
)
def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.sample_lines(I.document_lines(spark, sf_dir), 500, 42, ["doc_id", "line_no"])


@query(
    f"""SELECT o_orderkey AS id, array_to_string(list_transform(range(100), lambda i: substr(
      '{T.LETTERS}',
      CAST(('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR) || ':' || CAST(i AS VARCHAR)), 1, 8))
           AS BIGINT) % 52 + 1, 1)), '') AS word FROM orders"""
)
def random_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.random_letters(I.table(spark, sf_dir, "orders"), "o_orderkey", 100, 7)


@query(
    """SELECT doc_id, len(string_split(text, ',')) AS pieces, len(l2) AS pieces2, l2[len(l2)] AS rest2,
           len(string_split(rtrim(text, '.'), '.')) AS trimmed,
           len(string_split(text, chr(1))) AS single
    FROM (SELECT doc_id, text, CASE WHEN contains(text, ',')
            THEN [split_part(text, ',', 1), substr(text, strpos(text, ',') + 1)] ELSE [text] END AS l2
          FROM documents)"""
)
def split_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    two = X.split_limit(text, ",", 2)
    return I.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(X.split_all(text, ",")).cast("bigint").alias("pieces"),
        F.size(two).cast("bigint").alias("pieces2"),
        F.element_at(two, -1).alias("rest2"),
        F.size(X.split_trimmed(text, ".")).cast("bigint").alias("trimmed"),
        F.size(X.split_all(text, X.RELATION_SEP)).cast("bigint").alias("single"),
    )


@query(
    """SELECT 'Nr. ' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') || ' – Straße' AS padded,
    c_mktsegment || ' buys from ' || c_name || ', a ' || c_mktsegment || ' house' AS positional FROM customer"""
)
def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "customer").select(
        X.printf("Nr. %010d – Straße", F.col("c_custkey")).alias("padded"),
        X.printf("%2$s buys from %1$s, a %2$s house", F.col("c_name"), F.col("c_mktsegment")).alias("positional"),
    )


@query(
    """SELECT doc_id, length(text) AS chars, octet_length(encode(text)) AS bytes,
    substr(text, strpos(text, 'e') + 1) AS after_e, substr(text, 4) AS from_third,
    unicode(text) AS first_code FROM documents"""
)
def text_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return I.table(spark, sf_dir, "documents").select(
        "doc_id",
        X.char_count(text).cast("bigint").alias("chars"),
        X.byte_count(text).cast("bigint").alias("bytes"),
        X.after_first(text, "e").alias("after_e"),
        X.from_position(text, 3).alias("from_third"),
        X.code_point(text).alias("first_code"),
    )


@query(
    """SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
    upper(lower(p_brand)) AS brand FROM part"""
)
def cased_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "part").select(
        "p_partkey",
        X.upper_case(F.col("p_name")).alias("upper_name"),
        X.lower_case(F.col("p_type")).alias("lower_type"),
        X.upper_case(X.lower_case(F.col("p_brand"))).alias("brand"),
    )


@query(
    """SELECT doc_id, replace(upper(text), 'ẞ', 'SS') AS upper_text, lower(text) AS lower_text,
    replace(replace(upper(text), 'ẞ', 'SS'), 'Ç', 'SS') || 'SS' AS sharp FROM documents"""
)
def cased_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with accents. A sharp s, put in for c with cedilla, has two letters as its capital."""
    text = F.col("text")
    sharp = F.concat(F.replace(F.replace(text, F.lit("ç"), F.lit("ß")), F.lit("Ç"), F.lit("ß")), F.lit("ß"))
    return I.table(spark, sf_dir, "documents").select(
        "doc_id",
        X.upper_case(text).alias("upper_text"),
        X.lower_case(text).alias("lower_text"),
        X.upper_case(sharp).alias("sharp"),
    )


@query(
    """SELECT doc_id, CASE WHEN upper(lang) <> 'DE' THEN lang END AS lang,
    CASE WHEN upper(source) <> 'DE' THEN source END AS source FROM documents"""
)
def null_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = I.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return rows_with_nulls(documents, ["lang", "source"], "de")


@query(
    f"""WITH {I.VALID_SQL} SELECT least(key1, key2) || ':' || greatest(key1, key2) || ':{I.LABEL}' AS id,
    time_ms AS millis FROM valid GROUP BY ALL"""
)
def decoded_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = row_keys(R.row_keyed(R.pair_events(I.valid(spark, sf_dir), I.LABEL, 1)))
    return cells.select(
        X.id_of_row_key(F.col("row_key")).alias("id"), X.millis_of_row_key(F.col("row_key")).alias("millis")
    )


@query(f"WITH {I.LINES_SQL} SELECT replace(raw, chr(1), chr(9)) AS shown FROM lines")
def shown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = I.relation_lines(spark, sf_dir)
    return lines.select(X.swap_delimiter(F.col("value")).alias("shown"))
