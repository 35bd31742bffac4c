from __future__ import annotations

from datetime import datetime

from conftest import rows

from kinspan.operators import cells as C
from kinspan.operators import tables as T

CELL = "row_key string, family string, qualifier string, ts timestamp, value string"


def cells(spark, *records):
    return spark.createDataFrame(
        [(r, f, q, datetime(2020, 1, day), v) for r, f, q, day, v in records], CELL
    )


def table(spark):
    return cells(
        spark,
        ("r1", "f", "a", 1, "old"),
        ("r1", "f", "a", 2, "new"),
        ("r1", "f", "ab", 1, "x"),
        ("r1", "g", "a", 1, "y"),
        ("r2", "f", "a", 1, "z"),
    )


def test_gets_and_scans(spark):
    data = table(spark)
    assert [r.value for r in C.get_cell(data, "r1", "f", "a").collect()] == ["new"]
    assert {r.value for r in C.get_cell(data, "r1", "f", "a", 5).collect()} == {"new", "old"}
    assert C.get_row(data, "r1").count() == 3
    assert rows(C.scan_range(data, "r1", "r2", "f", "ab")) == [("r1", "x")]
    assert C.scan_prefix(data, "r", "f", "a").count() == 3
    assert rows(C.row_keys(data)) == [("r1",), ("r2",)]
    assert rows(C.scanned_rows(data)) == [(2,)]


def test_rows_need_all_columns(spark):
    found = C.rows_with_columns(table(spark), [("f", "a"), ("g", "a")])
    assert {r.row_key for r in found.collect()} == {"r1"} and found.count() == 4
    assert C.rows_with_columns(table(spark), [("f", "a"), ("f", "none")]).count() == 0


def test_delete_by_prefix(spark):
    data = table(spark)
    assert C.delete_by_prefix(data, "r1", "f", "ab").count() == 4
    assert rows(C.deleted_by_prefix(data, "r1", "f", "a")) == [(3,)]


def test_put_wins_at_the_same_time(spark):
    put = C.put_cells(table(spark), cells(spark, ("r2", "f", "a", 1, "a"), ("r3", "f", "a", 1, "n")))
    values = {(r.row_key, r.family, r.qualifier): r.value for r in put.collect()}
    assert values[("r2", "f", "a")] == "a" and values[("r3", "f", "a")] == "n" and len(values) == 5


def test_no_increment_is_lost(spark):
    base = spark.createDataFrame([("r", "age", 10)], "row_key string, qualifier string, value long")
    incs = spark.createDataFrame(
        [("r", "age", 10), ("r", "age", 10), ("s", "age", 1)], "row_key string, qualifier string, inc long"
    )
    assert rows(C.apply_increments(base, incs)) == [("r", "age", 30), ("s", "age", 1)]


def test_range_counts(spark):
    keys = ["g1", "g1/", "g10", "g1a", "g1/\u0001x", "g2\u0001a"]
    data = cells(spark, *((k, "f", "q", 1, "v") for k in keys + keys[:2]))
    ids = spark.createDataFrame([(" g1 ",), ("g2",), ("g3",), ("g1",)], "id string")
    assert rows(C.range_counts(ids, data)) == [("g1", 3), ("g2", 1), ("g3", 0)]


def test_batches_keep_the_short_last_one(spark):
    keys = spark.createDataFrame([(i, f"r{i}") for i in range(5)], "seq long, key string")
    assert rows(C.batch_get(keys, table(spark), 2)) == [(0, 2, 1), (1, 2, 1), (2, 1, 0)]


def test_upsert_is_case_sensitive(spark):
    schema = "SYMBOL string, COMPANY string"
    base = spark.createDataFrame([("CRV", "SalesForce.com")], schema)
    updates = spark.createDataFrame([("crv", "SalseForce.com", 1)], schema + ", n int")
    assert T.upsert(base, updates, ["SYMBOL"], "n").count() == 2
    again = spark.createDataFrame([("CRV", "first", 1), ("CRV", "last", 2)], schema + ", n int")
    assert rows(T.upsert(base, again, ["SYMBOL"], "n")) == [("CRV", "last")]


def test_sample_is_exact_and_repeatable(spark):
    lines = spark.range(1000).selectExpr("cast(id as string) as value").repartition(7)
    sample = [r.value for r in T.sample_lines(lines, 50, 1).collect()]
    assert len(set(sample)) == 50
    assert sample == [r.value for r in T.sample_lines(lines.coalesce(2), 50, 1).collect()]
    assert set(sample) != {r.value for r in T.sample_lines(lines, 50, 2).collect()}
    assert T.sample_lines(lines, 2000, 1).count() == 1000
    half = lines.limit(500).unionByName(lines.limit(500).selectExpr("'copy' as value"))
    for seed in range(4):
        drawn = [r.value for r in T.sample_lines(half, 100, seed).collect()]
        assert len(drawn) == 100 and 25 < drawn.count("copy") < 75


def test_cardinality_product_shows_overflow(spark):
    df = spark.range(100).selectExpr("id", *(f"id as c{i}" for i in range(10)), "null as none")
    ten = [f"c{i}" for i in range(10)]
    row = T.cardinality_product(df, ten).first()
    assert (round(row.log10_product, 6), row.product, row.capped_product) == (20.0, None, 100)
    assert rows(T.cardinality_product(df, ["id"]).select("product", "capped_product")) == [(100, 100)]
    assert rows(T.cardinalities(df.selectExpr("cast(none as int) none"), ["none"])) == [("none", 0)]


def test_random_words(spark):
    words = T.random_words(spark, 4_000_000, 4_000_050).collect()
    assert len({r.word for r in words}) == 50
    assert all(len(r.word) == 100 and r.word.isalpha() for r in words)
