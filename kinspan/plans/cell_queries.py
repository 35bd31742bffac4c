"""Cell tables of user events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.operators import cells as C
from kinspan.plans import inputs as I
from kinspan.plans.registry import query

LATEST_SQL = """
SELECT row_key, family, qualifier, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, value DESC) AS rn
  FROM {cells}) WHERE rn <= {versions}"""


@query(f"WITH {I.CELLS_SQL} SELECT row_key, value FROM event_cells WHERE family = 'f' AND qualifier = 'click'")
def scan_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.scan_column(I.event_cells(spark, sf_dir), "f", "click")


@query(
    f"""WITH {I.CELLS_SQL} SELECT row_key, value FROM event_cells
    WHERE family = 'f' AND qualifier = 'view' AND row_key >= '12' AND row_key < '3'"""
)
def scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.scan_range(I.event_cells(spark, sf_dir), "12", "3", "f", "view")


@query(
    f"""WITH {I.CELLS_SQL} SELECT row_key, value FROM event_cells
    WHERE family = 'f' AND qualifier = 'view' AND starts_with(row_key, '12')"""
)
def scan_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.scan_prefix(I.event_cells(spark, sf_dir), "12", "f", "view")


@query(
    f"""WITH {I.CELLS_SQL} SELECT row_key, family, qualifier, value FROM day_cells WHERE row_key IN (
      SELECT row_key FROM day_cells WHERE qualifier IN ('click', 'purchase') GROUP BY row_key
      HAVING count(DISTINCT qualifier) = 2)"""
)
def rows_with_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rows_with_columns(I.day_cells(spark, sf_dir), [("f", "click"), ("f", "purchase")])


@query(f"WITH {I.CELLS_SQL} SELECT count(DISTINCT row_key) AS scanned FROM day_cells")
def scanned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.scanned_rows(I.day_cells(spark, sf_dir))


@query(
    f"""WITH {I.CELLS_SQL} SELECT row_key, family, qualifier, ts, value FROM user_cells
    WHERE NOT (row_key = '7' AND family = 'f' AND starts_with(qualifier, 'p'))"""
)
def delete_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.delete_by_prefix(I.user_cells(spark, sf_dir), "7", "f", "p")


@query(
    f"""WITH {I.CELLS_SQL} SELECT count(*) AS deleted FROM user_cells
    WHERE row_key = '7' AND family = 'f' AND starts_with(qualifier, 'p')"""
)
def deleted_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.deleted_by_prefix(I.user_cells(spark, sf_dir), "7", "f", "p")


@query(f"WITH {I.CELLS_SQL} {LATEST_SQL.format(cells='user_cells', versions=1)}")
def latest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.latest_cells(I.user_cells(spark, sf_dir))


@query(f"WITH {I.CELLS_SQL} {LATEST_SQL.format(cells='user_cells', versions=3)}")
def cell_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cell_versions(I.user_cells(spark, sf_dir), 3)


@query(
    f"""WITH {I.CELLS_SQL} {LATEST_SQL.format(cells='user_cells', versions=1)}
    AND row_key = '7' AND family = 'f' AND qualifier = 'click'"""
)
def get_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.get_cell(I.user_cells(spark, sf_dir), "7", "f", "click")


@query(f"WITH {I.CELLS_SQL} {LATEST_SQL.format(cells='user_cells', versions=1)} AND row_key = '7'")
def get_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.get_row(I.user_cells(spark, sf_dir), "7")


@query(f"WITH {I.CELLS_SQL} SELECT DISTINCT row_key FROM day_cells")
def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.row_keys(I.day_cells(spark, sf_dir))


@query(
    f"""WITH {I.CELLS_SQL},
    incoming AS (
      SELECT CAST(o_custkey AS VARCHAR) AS row_key, 'f' AS family, 'purchase' AS qualifier,
             o_orderdate + INTERVAL 10000 DAY AS ts, CAST(o_orderkey AS VARCHAR) AS value FROM orders),
    both_cells AS (
      SELECT *, 0 AS seq FROM user_cells UNION ALL SELECT *, 1 FROM incoming)
    SELECT row_key, family, qualifier, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier
                                   ORDER BY ts DESC, seq DESC, value DESC) AS rn
      FROM both_cells) WHERE rn = 1"""
)
def put_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = I.table(spark, sf_dir, "orders").select(
        I.text_of("o_custkey").alias("row_key"),
        F.lit("f").alias("family"),
        F.lit("purchase").alias("qualifier"),
        (F.col("o_orderdate") + F.expr("INTERVAL 10000 DAYS")).alias("ts"),
        I.text_of("o_orderkey").alias("value"),
    )
    return C.put_cells(I.user_cells(spark, sf_dir), incoming)


@query(
    """WITH base AS (
      SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'click' AS qualifier,
             CAST(c_nationkey AS BIGINT) AS value FROM customer),
    increments AS (
      SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier, CAST(10 AS BIGINT) AS value
      FROM events)
    SELECT row_key, qualifier, CAST(sum(value) AS BIGINT) AS value
    FROM (SELECT * FROM base UNION ALL SELECT * FROM increments) GROUP BY row_key, qualifier"""
)
def apply_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = I.table(spark, sf_dir, "customer").select(
        I.text_of("c_custkey").alias("row_key"),
        F.lit("click").alias("qualifier"),
        F.col("c_nationkey").cast("bigint").alias("value"),
    )
    increments = I.table(spark, sf_dir, "events").select(
        I.text_of("user_id").alias("row_key"),
        F.col("event_type").alias("qualifier"),
        F.lit(10).cast("bigint").alias("inc"),
    )
    return C.apply_increments(base, increments)


@query(
    """SELECT event_id // 100 AS batch_id, count(*) AS requested,
    count(*) FILTER (user_id IN (SELECT s_suppkey FROM supplier)) AS found
    FROM events GROUP BY event_id // 100"""
)
def batch_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = I.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), I.text_of("user_id").alias("key")
    )
    suppliers = I.table(spark, sf_dir, "supplier").select(I.text_of("s_suppkey").alias("row_key"))
    return C.batch_get(keys, suppliers, 100)


@query(
    f"""WITH {I.CELLS_SQL},
    ids AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer),
    stored AS (SELECT DISTINCT row_key FROM event_cells)
    SELECT id, count(row_key) AS row_count
    FROM ids LEFT JOIN stored ON row_key >= id AND row_key < id || '0' GROUP BY id"""
)
def range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = I.table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), I.text_of("c_custkey"), F.lit(" ")).alias("id")
    )
    return C.range_counts(ids, I.event_cells(spark, sf_dir))
