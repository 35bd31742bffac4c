"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import open_tables, oracle_rows, spark_rows

import __spark_entry__ as contract
from kinspan.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(small_dir):
    return open_tables(small_dir)


def check(spark, tables, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    names, got = spark_rows(df)
    if name not in ORACLES:
        assert got
        return
    expected_names, expected = oracle_rows(tables, ORACLES[name])
    assert names == expected_names
    assert got == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tables, small_dir, name):
    check(spark, tables, small_dir, name)


SHUFFLED = [
    "batch_get",
    "incident_edges_raw",
    "incident_edges_summary",
    "k_hop",
    "k_hop_average",
    "k_hop_sizes",
    "key_counts",
    "key_degree_report",
    "load_vertices",
    "local_clustering",
    "local_clustering_no_loops",
    "average_clustering",
    "lookup_ids",
    "missing_keys",
    "pair_exists",
    "pair_lookup_raw",
    "pair_lookup_summary",
    "range_counts",
    "reject_counts",
    "rows_with_columns",
    "upsert",
    "validate_relations",
    "vertex_entries",
    "vertex_load_report",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_matches_sql_when_all_joins_are_salted(spark, tables, small_dir, no_broadcast, name):
    check(spark, tables, small_dir, name)


def test_contract(spark):
    assert contract.entry(spark).columns == ["degree", "vertex_count"]
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_sorted_output_is_in_order(spark, small_dir):
    keys = [tuple(row)[:3] for row in QUERIES["sort_edges"](spark, small_dir).collect()]
    assert keys == sorted(keys)
