"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from kinspan.operators import cells as C
from kinspan.operators import graph as G
from kinspan.operators import tables as T
from kinspan.plans import QUERIES
from kinspan.plans import inputs as I
from kinspan.sinks import files as K
from kinspan.sources import files as P


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_cells(spark, small_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "table")
    K.bulk_load(I.event_cells(spark, small_dir), ["row_key", "qualifier", "ts"], path)
    return spark.read.parquet(path)


def test_scans_push_their_filters(stored_cells):
    prefix = plan(C.scan_prefix(stored_cells, "12", "f", "view"))
    assert "StringStartsWith(row_key,12)" in prefix and "EqualTo(qualifier,view)" in prefix
    span = plan(C.scan_range(stored_cells, "1", "3", "f", "view"))
    assert "GreaterThanOrEqual(row_key,1)" in span and "LessThan(row_key,3)" in span
    point = plan(C.get_cell(stored_cells, "12", "f", "view"))
    assert "EqualTo(row_key,12)" in point


def test_scans_read_only_what_they_need(spark, stored_cells, tmp_path):
    keys = plan(C.row_keys(stored_cells))
    assert re.search(r"ReadSchema: struct<row_key:string>", keys)
    path = str(tmp_path / "orc")
    K.write_orc(spark.createDataFrame([(1, "a", 2.0)], "x long, s string, d double"), path)
    longs = plan(P.orc_long_values(P.read_orc(spark, path)))
    assert "ReadSchema: struct<x:bigint>" in longs


def test_short_key_lists_do_not_shuffle_facts(spark, small_dir):
    edges, keys = I.edges(spark, small_dir), I.supplier_keys(spark, small_dir)
    for df in (
        G.incident_edges_raw(keys, edges),
        T.lookup_ids(I.table(spark, small_dir, "orders"), keys, "o_custkey"),
    ):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        # The list itself may be shuffled, on its own side of the broadcast.
        facts_side = text.split("BroadcastExchange")[0]
        assert "Exchange hashpartitioning" not in facts_side


def test_version_limit_is_applied_before_the_shuffle(stored_cells):
    text = plan(C.cell_versions(stored_cells, 3))
    assert text.count("WindowGroupLimit") == 2


PAIRED = [
    "batch_get",
    "incident_edges_summary",
    "k_hop",
    "local_clustering",
    "pair_exists",
    "pair_lookup_raw",
    "pair_lookup_summary",
    "range_counts",
    "upsert",
    "validate_relations",
]


@pytest.mark.parametrize("name", PAIRED)
def test_no_join_compares_all_pairs_or_runs_python(spark, small_dir, no_broadcast, name):
    text = plan(QUERIES[name](spark, small_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in text
