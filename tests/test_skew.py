from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows

from kinspan.operators import skew as S


def tables(spark):
    left = [("hot", i % 4) for i in range(40)] + [("cold", 1), ("gone", 2)] + [(None, 5)] * 12
    right = [("hot", "h"), ("cold", "c"), ("more", "m"), (None, "n")]
    return (
        spark.createDataFrame(left, "k string, x int").repartition(4),
        spark.createDataFrame(right, "k string, y string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_lookups_equal_plain_joins(spark, how):
    left, right = tables(spark)
    got = S.skew_join(left, right, "k", how, hot_rows=5)
    assert got.columns == left.join(right, "k", how).columns
    assert rows(got) == rows(left.join(right, "k", how))


def test_salted_many_to_many_join_equals_plain_join(spark):
    left, right = tables(spark)
    many = right.unionByName(spark.createDataFrame([("hot", f"h{i}") for i in range(23)], right.schema))
    got = S.skew_join(left, many, "k", hot_rows=5, right_unique=False)
    assert rows(got) == rows(left.join(many, "k"))
    with pytest.raises(ValueError):
        S.skew_join(left, many, "k", "left", right_unique=False)


def test_many_hot_keys_are_all_split(spark, monkeypatch):
    """A list of hot keys too long to broadcast is joined by a shuffle, and still in full."""
    monkeypatch.setattr(S, "BROADCAST_ROWS", 1)
    left = spark.createDataFrame([(f"k{i % 7}", i) for i in range(210)], "k string, x int")
    one = spark.createDataFrame([(f"k{i}", i) for i in range(9)], "k string, y int")
    many = spark.createDataFrame([(f"k{i % 9}", i) for i in range(90)], "k string, y int")
    for how in ("inner", "left", "left_anti"):
        assert rows(S.skew_join(left, one, "k", how, hot_rows=5)) == rows(left.join(one, "k", how))
    both = S.skew_join(left, many, "k", hot_rows=5, right_unique=False)
    assert rows(both) == rows(left.join(many, "k"))
    right_only = S.skew_join(left, many, "k", hot_rows=5, left_rows=5, right_unique=False)
    assert rows(right_only) == rows(left.join(many, "k"))
    hot = S._hot_keys(S.key_counts(left, ["k"]), ["k"], 5, "n")
    assert {r.n for r in hot.collect()} == {7} and hot.count() == 7
    assert rows(S.repartition_by(left, "k", 5)) == rows(left)


def test_composite_keys(spark):
    left = spark.createDataFrame([("a", 1, i) for i in range(20)] + [("a", 2, 0)], "k string, j int, x int")
    right = spark.createDataFrame([("a", 1, "y"), ("b", 1, "z")], "k string, j int, y string")
    assert rows(S.skew_join(left, right, ["k", "j"], hot_rows=3)) == rows(left.join(right, ["k", "j"]))


def test_a_hot_key_is_spread_over_its_salts(spark):
    left, _ = tables(spark)
    counts = S._hot_keys(S.key_counts(left, ["k"]), ["k"], 5, "n")
    assert rows(counts) == rows(spark.createDataFrame([("hot", 9), (None, 3)], "k string, n int"))
    from pyspark.sql import functions as F

    wide = spark.range(0, 9000, 1, 8).select(F.lit("hot").alias("k"), "id")
    salted = wide.withColumn("s", S._salt(wide, ["k"], F.lit(9)))
    per_salt = Counter(r.s for r in salted.collect())
    assert len(per_salt) == 9 and max(per_salt.values()) < 1300


def test_copies_of_one_row_go_to_several_salts(spark):
    from pyspark.sql import functions as F

    copies = spark.range(0, 800, 1, 16).select(F.lit("hot").alias("k"))
    salts = copies.select(S._salt(copies, ["k"], F.lit(8)).alias("s")).distinct().count()
    assert salts > 2


def test_broadcast_is_measured(spark):
    df = spark.range(100).selectExpr("cast(id as string) as k")
    assert S.fits_broadcast(df)
    assert not S.fits_broadcast(df, max_rows=99)
    assert S.fits_broadcast(df, max_rows=100)
    assert not S.fits_broadcast(df, max_bytes=100)
