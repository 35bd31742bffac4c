"""NULL ends, wide lines, separators within keys: defined results on either side of a switch."""

from __future__ import annotations

import pytest
from conftest import rows

from kinspan.functions.text import RELATION_SEP
from kinspan.operators import cells as C
from kinspan.operators import graph as G
from kinspan.operators import relations as R
from kinspan.operators import skew as S


def endpoints(spark):
    records = spark.createDataFrame(
        [("a", "b"), (None, "b"), ("a", None), ("x", "b"), (None, None)], "key1 string, key2 string"
    ).selectExpr("key1", "key2", "cast(null as string) reject_reason")
    vertices = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    return rows(R.mark_unknown_endpoints(records, vertices).select("key1", "key2", "reject_reason"))


WANTED = [
    ("a", "b", None),
    ("a", None, "key2 not found"),
    ("x", "b", "key1 not found"),
    (None, "b", "key1 not found"),
    (None, None, "key1 not found"),
]


def test_null_endpoints_are_unknown(spark):
    assert sorted(endpoints(spark), key=str) == sorted(WANTED, key=str)


@pytest.mark.parametrize("limit", [0, 1, 2])
def test_null_endpoints_are_unknown_beyond_the_broadcast_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "BROADCAST_ROWS", limit)
    assert sorted(endpoints(spark), key=str) == sorted(WANTED, key=str)


def test_a_null_line_is_short(spark):
    lines = spark.createDataFrame([(None,), ("a",)], "value string")
    marked = R.mark_short_lines(R.parse_relations(lines))
    assert [r.reject_reason for r in marked.collect()] == ["not enough fields"] * 2


def test_canonical_lines_and_rejects_are_all_lines(spark):
    widths = (10, 37, 38, 39, 45)
    lines = [RELATION_SEP.join(f"{'z' if i == 0 else 'f'}{i:02}" for i in range(n)) for n in widths]
    relations = R.parse_relations(spark.createDataFrame([(x,) for x in [*lines, None]], "value string"))
    kept = {r.raw for r in R.canonical_edges(relations).collect()}
    left = [r.raw for r in R.canonical_rejects(relations).collect()]
    assert sorted(left, key=str) == sorted([*lines[:2], None], key=str)
    swapped = [x.split(RELATION_SEP) for x in lines[2:]]
    assert kept == {RELATION_SEP.join(f[19:] + f[:19]) for f in swapped}


def test_pairs_with_separators_stay_apart(spark):
    valid = spark.createDataFrame(
        [("a:b", "c", 1, "r"), ("a", "b:c", 2, "s"), ("a\\", "b", 3, "t"), ("c", "a:b", 4, "u")],
        "key1 string, key2 string, time_ms bigint, raw string",
    )
    made = R.summary_edges(valid, "L").collect()
    assert sorted((r.src, r.dst) for r in made) == [("a", "b:c"), ("a:b", "c"), ("a\\", "b")]
    assert len({r.edge_id for r in made}) == 3


def test_null_ends_join_nothing(spark):
    edges = spark.createDataFrame([("x", "x"), ("x", None), ("x", "y")], "src string, dst string")
    pairs = spark.createDataFrame([(None, "x"), ("y", "x")], "key1 string, key2 string")
    found = {(r.key1, r.key2): r.edge_count for r in G.pair_lookup_raw(pairs, edges).collect()}
    assert found == {(None, "x"): 0, ("y", "x"): 1}
    assert {(r.key1, r.found) for r in G.pair_exists(pairs, edges).collect()} == {(None, False), ("y", True)}
    assert rows(G.neighbors(edges)) == [("x", "x"), ("x", "y"), ("y", "x")]


def test_an_empty_id_is_the_start_of_all_row_keys(spark):
    ids = spark.createDataFrame([("  ",), ("g",)], "id string")
    cells = spark.createDataFrame([("!a",), ("/z",), ("g1",), ("g",), ("",), (None,)], "row_key string")
    assert rows(C.range_counts(ids, cells)) == [("", 3), ("g", 1)]


@pytest.mark.parametrize("how", ["right", "full", "full_outer", "rightouter"])
def test_salted_joins_refuse_sides_they_would_multiply(spark, how):
    one = spark.createDataFrame([("a", 1)], "k string, x int")
    with pytest.raises(ValueError, match="per salt"):
        S.skew_join(one, one.withColumnRenamed("x", "y"), "k", how)
