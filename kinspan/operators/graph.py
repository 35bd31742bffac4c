"""Property graph: incidence, degrees, counts and lookups by vertex or by pair.

Vertices have a `key`, edges `src`, `dst` and, where asked for, `label`, `time`, `value`. Several
edges may join one pair. A loop touches its vertex twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.functions.numbers import row_count
from kinspan.functions.text import id_of_row_key, millis_of_row_key
from kinspan.operators.relations import edge_id
from kinspan.operators.skew import lookup_join, only_listed
from kinspan.session import reliable


def incidence(edges: DataFrame) -> DataFrame:
    """Each edge seen from both ends -> v, other and the edge's further columns. One scan, no shuffle."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    out = F.struct(F.col("src").alias("v"), F.col("dst").alias("other"), *rest)
    back = F.struct(F.col("dst").alias("v"), F.col("src").alias("other"), *rest)
    return edges.select(F.inline(F.array(out, back)))


def _unordered(edges: DataFrame) -> DataFrame:
    """-> a, b: the ends of each edge, a <= b. An edge with a NULL end joins nothing and goes."""
    whole = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return whole.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))


def simple_pairs(edges: DataFrame) -> DataFrame:
    """-> a, b: each joined pair once, a <= b."""
    return _unordered(edges).distinct()


def neighbors(edges: DataFrame) -> DataFrame:
    """-> v, other: each neighbor once; a vertex with a loop is its own neighbor.

    Pairs are made distinct before they are mirrored, which halves the shuffle.
    """
    return mirrored(simple_pairs(edges))


def mirrored(pairs: DataFrame) -> DataFrame:
    """Pairs a, b -> v, other: each pair from both ends, a loop once."""
    out = F.struct(F.col("a").alias("v"), F.col("b").alias("other"))
    back = F.struct(F.col("b").alias("v"), F.col("a").alias("other"))
    return pairs.select(
        F.inline(F.when(F.col("a") == F.col("b"), F.array(out)).otherwise(F.array(out, back)))
    )


def edges_between(edges: DataFrame, key: str, other: str) -> DataFrame:
    """The edges of `key` that lead to or from `other`."""
    return incidence(edges).filter((F.col("v") == key) & (F.col("other") == other))


def edge_ends(edges: DataFrame) -> DataFrame:
    """-> key, once for each end of each edge."""
    return edges.select(F.explode(F.array("src", "dst")).alias("key"))


def degrees(edges: DataFrame) -> DataFrame:
    """-> key, degree: number of edge ends at each vertex that has any."""
    return edge_ends(edges).groupBy("key").agg(row_count().alias("degree"))


def degree_distribution(edges: DataFrame, text_order: bool = False) -> DataFrame:
    """-> degree, vertex_count, by degree, or by its digits as text: 1, 10, 2."""
    order = F.col("degree").cast("string") if text_order else F.col("degree")
    return degrees(edges).groupBy("degree").agg(row_count().alias("vertex_count")).orderBy(order)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def graph_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """-> vertex_count, edge_count: edges are half the sum of the degrees."""
    vertex_count = vertices.agg(row_count().alias("vertex_count"))
    ends = vertices.select("key").distinct().join(degrees(edges), "key")
    halved = ends.agg(_total("degree").alias("s")).select(F.expr("s div 2").alias("edge_count"))
    return _side_by_side(vertex_count, halved)


def stored_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """-> vertex_count, edge_entries: an edge is stored, and counted, at both of its ends."""
    return _side_by_side(
        vertices.agg(row_count().alias("vertex_count")),
        edges.agg((row_count() * 2).alias("edge_entries")),
    )


def listed_keys(keys: DataFrame) -> DataFrame:
    """-> key, listed: each listed key once, with the number of times it is listed."""
    return keys.groupBy("key").agg(row_count().alias("listed"))


def _listed_vertices(keys: DataFrame, vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """-> key, listed, n_vertices, degree; all sides have one row per key when they are joined."""
    listed = listed_keys(keys)
    per_key = only_listed(vertices.select("key"), listed, "key").groupBy("key")
    ends = only_listed(edge_ends(edges), listed, "key").groupBy("key")
    return (
        listed.join(per_key.agg(row_count().alias("n_vertices")), "key", "left")
        .join(ends.agg(row_count().alias("degree")), "key", "left")
        .fillna(0, ["n_vertices", "degree"])
    )


def key_counts(keys: DataFrame, vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """-> vertex_count, edge_count over a key list; a key counts each time it is listed.

    All vertices of a key count; the edges, which the first of them has, are half the degree sum.
    """
    listed = _listed_vertices(keys, vertices, edges).filter(F.col("n_vertices") > 0)
    sums = listed.agg(
        F.coalesce(F.sum(F.col("listed") * F.col("n_vertices")), F.lit(0)).alias("vertex_count"),
        F.coalesce(F.sum(F.col("listed") * F.col("degree")), F.lit(0)).alias("s"),
    )
    return sums.select("vertex_count", F.expr("s div 2").alias("edge_count"))


def key_degree_report(keys: DataFrame, vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """-> degree_sum (not halved), bad_keys, duplicate_keys over a key list."""
    n, listed = F.col("n_vertices"), F.col("listed")
    report = {
        "degree_sum": F.when(n > 0, listed * F.col("degree")),
        "bad_keys": F.when(n == 0, listed),
        "duplicate_keys": F.when(n > 1, listed),
    }
    return _listed_vertices(keys, vertices, edges).agg(
        *(F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in report.items())
    )


def duplicate_keys(vertices: DataFrame) -> DataFrame:
    """-> key, n for the keys of more than one vertex."""
    return vertices.groupBy("key").agg(row_count().alias("n")).filter(F.col("n") > 1)


def listed_pairs(pairs: DataFrame) -> DataFrame:
    """-> key1, key2, listed, a, b: each listed pair once; a and b are NULL if a key is."""
    both = F.col("key1").isNotNull() & F.col("key2").isNotNull()
    return (
        pairs.groupBy("key1", "key2")
        .agg(row_count().alias("listed"))
        .withColumn("a", F.when(both, F.least("key1", "key2")))
        .withColumn("b", F.when(both, F.greatest("key1", "key2")))
    )


def pair_lookup_raw(
    pairs: DataFrame,
    edges: DataFrame,
    label: str | None = None,
    vertices: DataFrame | None = None,
    on_missing: str = "zero",
) -> DataFrame:
    """-> key1, key2, listed, edge_count: edges between the keys, whichever way they point.

    Edges are counted per pair before the join, so a pair with very many edges is one row in it.
    A pair with an unknown key has none; with `on_missing="error"` it raises, given the vertices.
    """
    if on_missing not in ("zero", "error"):
        raise ValueError(f"on_missing is zero or error: {on_missing!r}")
    if on_missing == "error":
        if vertices is None:
            raise ValueError("vertices are needed to tell unknown keys")
        demand_known(pairs, vertices)
    wanted = edges if label is None else edges.filter(F.col("label") == label)
    listed = listed_pairs(pairs)
    per_pair = (
        only_listed(_unordered(wanted), listed, ["a", "b"])
        .groupBy("a", "b")
        .agg(row_count().alias("edge_count"))
    )
    return listed.join(per_pair, ["a", "b"], "left").select(
        "key1", "key2", "listed", F.coalesce("edge_count", F.lit(0)).alias("edge_count")
    )


def pair_lookup_summary(
    pairs: DataFrame, summary: DataFrame, events: DataFrame, label: str
) -> DataFrame:
    """-> key1, key2, listed, edge_count: detail rows of the pair's summary edge, 0 without one."""
    id_of_pair = edge_id(F.col("key1"), F.col("key2"), F.lit(label))
    listed = listed_pairs(pairs).withColumn("edge_id", id_of_pair)
    stored = summary.filter(F.col("label") == label).select("edge_id")
    per_edge = (
        only_listed(events.select("edge_id"), listed, "edge_id")
        .groupBy("edge_id")
        .agg(row_count().alias("edge_count"))
        .join(stored, "edge_id", "left_semi")
    )
    return listed.join(per_edge, "edge_id", "left").select(
        "key1", "key2", "listed", F.coalesce("edge_count", F.lit(0)).alias("edge_count")
    )


def selected_edges(lookups: DataFrame) -> DataFrame:
    """-> selected_edges: total of a pair lookup over the list, a pair counted each time it is listed."""
    return lookups.agg(
        F.coalesce(F.sum(F.col("listed") * F.col("edge_count")), F.lit(0)).alias("selected_edges")
    )


def pair_exists(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """-> key1, key2, found for each distinct pair of the list."""
    listed = listed_pairs(pairs)
    joined = only_listed(_unordered(edges), listed, ["a", "b"]).distinct()
    return listed.join(joined.withColumn("_found", F.lit(True)), ["a", "b"], "left").select(
        "key1", "key2", F.coalesce("_found", F.lit(False)).alias("found")
    )


def missing_keys(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """-> key: listed endpoints that are not the key of a vertex, for callers that stop on them."""
    listed = pairs.select(F.explode(F.array("key1", "key2")).alias("key")).distinct()
    known = only_listed(vertices.select("key"), listed, "key").distinct()
    return listed.join(known, "key", "left_anti")


def demand_known(pairs: DataFrame, vertices: DataFrame, shown: int = 10) -> None:
    """Raise if a listed endpoint is not the key of a vertex; the message has `shown` of them."""
    missing = missing_keys(pairs, vertices)
    first = [row.key for row in missing.orderBy("key").limit(shown + 1).collect()]
    if first:
        more = " and more" if len(first) > shown else ""
        raise KeyError(f"not the key of a vertex: {', '.join(map(str, first[:shown]))}{more}")


def incident_edges_raw(keys: DataFrame, edges: DataFrame) -> DataFrame:
    """-> key, listed, time, value: every edge at each listed key."""
    ends = incidence(edges.select("src", "dst", "time", "value")).withColumnRenamed("v", "key")
    return lookup_join(ends, listed_keys(keys), "key").select("key", "listed", "time", "value")


def incident_edges_summary(keys: DataFrame, summary: DataFrame, events: DataFrame) -> DataFrame:
    """-> key, listed, time, value: detail rows of every summary edge at each listed key."""
    ends = incidence(summary.select("src", "dst", "edge_id")).withColumnRenamed("v", "key")
    at_key = lookup_join(ends, listed_keys(keys), "key").select("edge_id", "key", "listed")
    # An edge has two ends, so its list has at most two entries.
    ends_of_edge = F.collect_list(F.struct("key", "listed")).alias("_ends")
    per_edge = reliable(at_key.groupBy("edge_id").agg(ends_of_edge))
    return (
        lookup_join(events, per_edge, "edge_id")
        .select("time", "value", F.explode("_ends").alias("_end"))
        .select("_end.key", "_end.listed", "time", "value")
    )


def decode_row_keys(cells: DataFrame) -> DataFrame:
    """Cells keyed `edgeId_time` -> edge_id, time, value; time is NULL for a key of another form."""
    return cells.select(
        id_of_row_key(F.col("row_key")).alias("edge_id"),
        millis_of_row_key(F.col("row_key")).alias("time"),
        "value",
    )


def malformed_row_keys(cells: DataFrame) -> DataFrame:
    """-> malformed: cells whose row key is not `edgeId_time`."""
    key = F.col("row_key")
    whole = F.coalesce((id_of_row_key(key) != "") & millis_of_row_key(key).isNotNull(), F.lit(False))
    return cells.agg(F.count_if(~whole).alias("malformed"))


def lookup_summary(incident: DataFrame) -> DataFrame:
    """-> total_edges, vertex_count, edges_per_vertex of an incident edge lookup."""
    per_key = incident.groupBy("key").agg(F.max("listed").alias("listed"), row_count().alias("edges"))
    totals = per_key.agg(
        F.coalesce(F.sum(F.col("listed") * F.col("edges")), F.lit(0)).alias("total_edges"),
        F.coalesce(F.sum("listed"), F.lit(0)).alias("vertex_count"),
    )
    return totals.withColumn(
        "edges_per_vertex", F.try_divide(F.col("total_edges"), F.col("vertex_count"))
    )


def _properties(vertices: DataFrame) -> DataFrame:
    """-> key, name, value for the properties a vertex has."""
    names = [c for c, kind in vertices.dtypes if c != "label" and not kind.startswith("map<")]
    maps = [c for c, kind in vertices.dtypes if kind.startswith("map<")]
    named = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in names]
    entries = F.array(*named)
    for c in maps:
        extra = F.transform(
            F.map_entries(c), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value"))
        )
        entries = F.concat(entries, F.coalesce(extra, F.slice(entries, 1, 0)))
    return vertices.select("key", F.inline(F.filter(entries, lambda e: e["value"].isNotNull())))


def vertex_profile(vertices: DataFrame, edges: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """-> key, property_count, edge_count for the listed vertices, or all."""
    ends = edge_ends(edges)
    if keys is not None:
        listed = keys.select("key").distinct()
        vertices = lookup_join(vertices, listed, "key", "left_semi")
        ends = only_listed(ends, listed, "key")
    counted = _properties(vertices).groupBy("key").agg(row_count().alias("property_count"))
    degree = ends.groupBy("key").agg(row_count().alias("degree"))
    return counted.join(degree, "key", "left").select(
        "key", "property_count", F.coalesce("degree", F.lit(0)).alias("edge_count")
    )


def vertex_entries(vertices: DataFrame, edges: DataFrame, keys: DataFrame) -> DataFrame:
    """-> key, kind, name, value: the properties and the incident edges of the listed vertices."""
    listed = keys.select("key").distinct()
    properties = _properties(lookup_join(vertices, listed, "key", "left_semi"))
    ends = incidence(edges.select("src", "dst", "label")).withColumnRenamed("v", "key")
    incident = lookup_join(ends, listed, "key", "left_semi")
    return properties.select("key", F.lit("property").alias("kind"), "name", "value").unionByName(
        incident.select(
            "key", F.lit("edge").alias("kind"), F.col("label").alias("name"), F.col("other").alias("value")
        )
    )
