"""Degrees, counts, lookups and traversals of the supply graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinspan.operators import graph as G
from kinspan.operators import relations as R
from kinspan.operators import skew
from kinspan.operators import traversal as T
from kinspan.operators import two_level as L
from kinspan.plans import inputs as I
from kinspan.plans.registry import query
from kinspan.session import fresh_path
from kinspan.sinks.keyed import KeyedTable


@query(f"WITH {I.GRAPH_SQL} SELECT key, degree FROM degrees")
def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.degrees(I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL} SELECT degree, count(*) AS vertex_count FROM degrees
    GROUP BY degree ORDER BY degree"""
)
def degree_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.degree_distribution(I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL}, counted AS (SELECT degree, count(*) AS n FROM degrees GROUP BY degree)
    SELECT CAST(row_number() OVER (ORDER BY CAST(degree AS VARCHAR)) - 1 AS BIGINT) AS place, degree,
           n AS vertex_count FROM counted"""
)
def degree_distribution_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places that degrees take when they are put in order as text."""
    ordered = G.degree_distribution(I.edges(spark, sf_dir), text_order=True)
    # A row per degree, so a window without partitions holds few.
    below = Window.orderBy(F.col("degree").cast("string"))
    place = (F.row_number().over(below) - 1).cast("bigint").alias("place")
    return ordered.select(place, "degree", "vertex_count")


@query(f"WITH {I.GRAPH_SQL} SELECT v, other, label, time, value FROM incidence")
def incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.incidence(I.edges(spark, sf_dir))


@query(f"WITH {I.GRAPH_SQL} SELECT v, other FROM neighbors")
def neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.neighbors(I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL} SELECT v, other, label, time, value FROM incidence
    WHERE v = '7' AND other = '154'"""
)
def edges_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edges_between(I.edges(spark, sf_dir), "7", "154")


@query(
    f"""WITH {I.GRAPH_SQL} SELECT (SELECT count(*) FROM vertices) AS vertex_count,
    (SELECT CAST(sum(degree) // 2 AS BIGINT) FROM degrees JOIN vertices USING (key)) AS edge_count"""
)
def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.graph_counts(I.parts(spark, sf_dir), I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL} SELECT (SELECT count(*) FROM vertices) AS vertex_count,
    (SELECT count(*) FROM incidence) AS edge_entries"""
)
def stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.stored_counts(I.parts(spark, sf_dir), I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL}, {I.KEY_LIST_SQL} SELECT count(*) AS vertex_count,
    CAST(coalesce(sum(degree), 0) // 2 AS BIGINT) AS edge_count
    FROM key_list JOIN vertices USING (key) LEFT JOIN degrees USING (key)"""
)
def key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.key_counts(I.key_list(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir))


def _named_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers as vertices; the suppliers' keys are taken twice."""
    suppliers = I.table(spark, sf_dir, "supplier").select(
        I.text_of("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return I.parts(spark, sf_dir).select("key", "name").unionByName(suppliers)


TWICE_SQL = """
twice AS (SELECT CAST(p_partkey AS VARCHAR) AS key FROM part
          UNION ALL SELECT CAST(s_suppkey AS VARCHAR) FROM supplier),
per_key AS (SELECT key, count(*) AS n FROM twice GROUP BY key)"""


@query(
    f"""WITH {I.GRAPH_SQL}, {I.KEY_LIST_SQL}, {TWICE_SQL}
    SELECT CAST(coalesce(sum(degree), 0) AS BIGINT) AS degree_sum,
           count(*) FILTER (n IS NULL) AS bad_keys, count(*) FILTER (n > 1) AS duplicate_keys
    FROM key_list LEFT JOIN per_key USING (key) LEFT JOIN degrees USING (key)"""
)
def key_degree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.key_degree_report(
        I.key_list(spark, sf_dir), _named_twice(spark, sf_dir), I.edges(spark, sf_dir)
    )


@query(f"WITH {TWICE_SQL} SELECT key, n FROM per_key WHERE n > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.duplicate_keys(_named_twice(spark, sf_dir))


PER_PAIR_SQL = "SELECT least(src, dst) AS a, greatest(src, dst) AS b, count(*) AS n FROM edges"
RAW_LOOKUP_SQL = f"""
per_pair AS ({PER_PAIR_SQL} GROUP BY least(src, dst), greatest(src, dst)),
raw_lookup AS (
  SELECT key1, key2, listed, coalesce(n, 0) AS edge_count
  FROM pair_list LEFT JOIN per_pair ON a = least(key1, key2) AND b = greatest(key1, key2))"""


@query(
    f"""WITH {I.GRAPH_SQL}, {I.PAIR_LIST_SQL}, {RAW_LOOKUP_SQL}
    SELECT key1, key2, listed, edge_count FROM raw_lookup"""
)
def pair_lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.pair_lookup_raw(I.pair_list(spark, sf_dir), I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL}, {I.PAIR_LIST_SQL}, {RAW_LOOKUP_SQL}
    SELECT CAST(coalesce(sum(listed * edge_count), 0) AS BIGINT) AS selected_edges FROM raw_lookup"""
)
def selected_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.selected_edges(pair_lookup_raw(spark, sf_dir))


SUMMARY_SQL = f"""{I.VALID_SQL},
summary AS (
  SELECT DISTINCT least(key1, key2) AS a, greatest(key1, key2) AS b FROM valid),
events2 AS (
  SELECT least(key1, key2) AS a, greatest(key1, key2) AS b, time_ms AS time, max(raw) AS value
  FROM valid GROUP BY ALL)"""


_STORED: dict[tuple[str, str, int, str], KeyedTable] = {}


def _two_level(spark: SparkSession, sf_dir: str, *tables: str) -> L.TwoLevel:
    """Tables of the layout, each written by the first query of a session that reads it."""
    found = {}
    for name in tables:
        known = spark.sparkContext.applicationId, sf_dir, skew.HOT_ROWS, name
        if known not in _STORED:
            path = fresh_path(spark, "two-level")
            stored = L.store_two_level(I.valid(spark, sf_dir), I.LABEL, path, 1, tables=[name])
            _STORED[known] = getattr(stored, name)
        found[name] = _STORED[known]
    return L.TwoLevel(I.LABEL, **found)


@query(
    f"""WITH {SUMMARY_SQL}, {I.PAIR_LIST_SQL},
    per_edge AS (SELECT a, b, count(*) AS n FROM events2 GROUP BY a, b)
    SELECT key1, key2, listed, coalesce(n, 0) AS edge_count
    FROM pair_list LEFT JOIN per_edge ON a = least(key1, key2) AND b = greatest(key1, key2)"""
)
def pair_lookup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.pair_lookup(I.pair_list(spark, sf_dir), _two_level(spark, sf_dir, "events"))


@query(
    f"""WITH {I.GRAPH_SQL}, {I.PAIR_LIST_SQL},
    joined AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges)
    SELECT key1, key2, a IS NOT NULL AS found
    FROM pair_list LEFT JOIN joined ON a = least(key1, key2) AND b = greatest(key1, key2)"""
)
def pair_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.pair_exists(I.pair_list(spark, sf_dir), I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL}, {I.PAIR_LIST_SQL}
    SELECT DISTINCT key FROM (SELECT key1 AS key FROM pair_list UNION ALL SELECT key2 FROM pair_list)
    WHERE key NOT IN (SELECT key FROM vertices)"""
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.missing_keys(I.pair_list(spark, sf_dir), I.parts(spark, sf_dir))


LISTED_SQL = f"""{I.KEY_LIST_SQL},
listed AS (SELECT key, count(*) AS listed FROM key_list GROUP BY key)"""


@query(
    f"""WITH {I.GRAPH_SQL}, {LISTED_SQL}
    SELECT key, listed, time, value FROM listed JOIN incidence ON v = key"""
)
def incident_edges_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.incident_edges_raw(I.key_list(spark, sf_dir), I.edges(spark, sf_dir))


@query(
    f"""WITH {SUMMARY_SQL}, {LISTED_SQL},
    ends AS (SELECT a AS key, time, value FROM events2 UNION ALL SELECT b, time, value FROM events2)
    SELECT key, listed, time, value FROM listed JOIN ends USING (key)"""
)
def incident_edges_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.incident_lookup(I.key_list(spark, sf_dir), _two_level(spark, sf_dir, "ends", "events"))


@query(
    f"""WITH {I.GRAPH_SQL}, {LISTED_SQL},
    per_key AS (SELECT key, any_value(listed) AS listed, count(*) AS n
                FROM listed JOIN incidence ON v = key GROUP BY key)
    SELECT CAST(sum(listed * n) AS BIGINT) AS total_edges, CAST(sum(listed) AS BIGINT) AS vertex_count,
           CAST(sum(listed * n) AS DOUBLE) / CAST(sum(listed) AS DOUBLE) AS edges_per_vertex FROM per_key"""
)
def lookup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.lookup_summary(incident_edges_raw(spark, sf_dir))


@query(
    f"""WITH {SUMMARY_SQL} SELECT a || ':' || b || ':{I.LABEL}' AS edge_id, time, value FROM events2"""
)
def decoded_row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.decode_row_keys(R.row_keyed(_two_level(spark, sf_dir, "events").events.rows(spark)))


@query(
    f"""WITH {SUMMARY_SQL} SELECT count(*) FILTER (a = '' OR time % 2 = 1) AS malformed FROM events2"""
)
def malformed_row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row keys, of which those of odd times are given a letter; none ends the job."""
    cells = R.row_keyed(_two_level(spark, sf_dir, "events").events.rows(spark))
    odd = F.pmod(F.substring_index("row_key", "_", -1).cast("bigint"), F.lit(2)) == 1
    return G.malformed_row_keys(
        cells.withColumn("row_key", F.when(odd, F.concat("row_key", F.lit("x"))).otherwise(F.col("row_key")))
    )


@query(
    f"""WITH {I.GRAPH_SQL} SELECT key, 5 - (name IS NULL)::BIGINT - (brand IS NULL)::BIGINT
      - (kind IS NULL)::BIGINT - (size IS NULL)::BIGINT AS property_count,
      coalesce(degree, 0) AS edge_count
    FROM vertices LEFT JOIN degrees USING (key)"""
)
def vertex_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.vertex_profile(I.parts(spark, sf_dir), I.edges(spark, sf_dir))


@query(
    f"""WITH {I.GRAPH_SQL},
    listed AS (SELECT CAST(s_suppkey AS VARCHAR) AS key FROM supplier),
    properties AS (UNPIVOT (SELECT key, key AS key_, name, brand, kind, size FROM vertices
                            WHERE key IN (SELECT key FROM listed))
                   ON key_, name, brand, kind, size INTO NAME name VALUE value)
    SELECT key, 'property' AS kind, CASE WHEN name = 'key_' THEN 'key' ELSE name END AS name, value
    FROM properties
    UNION ALL
    SELECT v, 'edge', label, other FROM incidence WHERE v IN (SELECT key FROM listed)"""
)
def vertex_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.vertex_entries(
        I.parts(spark, sf_dir), I.edges(spark, sf_dir), I.supplier_keys(spark, sf_dir)
    )


@query(
    f"""WITH {I.GRAPH_SQL},
    sale_ends AS (SELECT DISTINCT v, other FROM incidence WHERE label = 'sale'),
    seeds AS (SELECT CAST(s_suppkey AS VARCHAR) AS key FROM supplier)
    SELECT DISTINCT s.key AS seed, y.other AS v
    FROM seeds s JOIN sale_ends x ON x.v = s.key JOIN sale_ends y ON y.v = x.other"""
)
def k_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hops along sales from every supplier."""
    return T.k_hop(
        I.supplier_keys(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir), 2, "sale"
    )


def _hop_sizes_sql(hops: int) -> str:
    steps = " ".join(f"JOIN neighbors n{i} ON n{i}.v = n{i - 1}.other" for i in range(2, hops + 1))
    return f"""{I.GRAPH_SQL}, {I.KEY_LIST_SQL},
seeds AS (SELECT key, count(*) AS listed FROM key_list JOIN vertices USING (key) GROUP BY key),
reached AS (SELECT seed, count(*) AS n FROM (
  SELECT DISTINCT s.key AS seed, n{hops}.other AS v
  FROM seeds s JOIN neighbors n1 ON n1.v = s.key {steps}) GROUP BY seed),
sizes AS (SELECT key AS seed, listed, coalesce(n, 0) AS set_size
          FROM seeds LEFT JOIN reached ON seed = key)"""


@query(f"WITH {_hop_sizes_sql(2)} SELECT seed, listed, set_size FROM sizes")
def k_hop_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.k_hop_sizes(
        I.key_list(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir), 2
    )


@query(
    f"""WITH {_hop_sizes_sql(2)} SELECT CAST(sum(listed * set_size) AS DOUBLE)
    / CAST(sum(listed) AS DOUBLE) AS avg_set_size FROM sizes"""
)
def k_hop_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.k_hop_average(
        I.key_list(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir), 2
    )


def _clustering_sql(seeds: str, loops: bool) -> str:
    keep = "" if loops else "WHERE v <> other"
    return f"""{I.GRAPH_SQL}, {I.KEY_LIST_SQL},
seeds AS (SELECT key, count(*) AS listed FROM ({seeds}) GROUP BY key),
nb AS (SELECT v, other FROM neighbors {keep}),
sizes AS (SELECT key, listed, count(other) AS n FROM seeds LEFT JOIN nb ON v = key GROUP BY key, listed),
joined AS (
  SELECT s.key, count(*) AS adj
  FROM seeds s JOIN nb x ON x.v = s.key JOIN nb y ON y.v = x.other
  JOIN nb z ON z.v = s.key AND z.other = y.other GROUP BY s.key),
clustering AS (
  SELECT key AS seed, listed, n, coalesce(adj, 0) AS adj,
         CASE WHEN n > 1 THEN CAST(coalesce(adj, 0) AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)
              ELSE 0.0 END AS local_cc
  FROM sizes LEFT JOIN joined USING (key))"""


ALL_SEEDS = "SELECT key FROM vertices"
LISTED_SEEDS = "SELECT key FROM key_list JOIN vertices USING (key)"


@query(f"WITH {_clustering_sql(ALL_SEEDS, True)} SELECT seed, listed, n, adj, local_cc FROM clustering")
def local_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vertex as a seed."""
    return T.local_clustering(
        I.all_keys(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir)
    )


@query(f"WITH {_clustering_sql(ALL_SEEDS, False)} SELECT seed, listed, n, adj, local_cc FROM clustering")
def local_clustering_no_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.local_clustering(
        I.all_keys(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir), drop_loops=True
    )


@query(
    f"""WITH {_clustering_sql(LISTED_SEEDS, True)}
    SELECT round(sum(listed * local_cc) / CAST(sum(listed) AS DOUBLE), 9) AS avg_cc FROM clustering"""
)
def average_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a key list with repeats and unknown keys."""
    average = T.average_clustering(
        I.key_list(spark, sf_dir), I.parts(spark, sf_dir), I.edges(spark, sf_dir)
    )
    return average.select(F.round("avg_cc", 9).alias("avg_cc"))
