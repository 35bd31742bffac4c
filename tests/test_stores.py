"""Inventories, versions, keyed tables, samples and sketches."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kinspan.operators import graph as G
from kinspan.operators import relations as R
from kinspan.operators import tables as T
from kinspan.operators import traversal as W
from kinspan.operators import two_level as L
from kinspan.sinks import keyed as K
from kinspan.sinks import versions as V
from kinspan.sources import files as P
from kinspan.sources import inventory as I
from kinspan.sources import schema as S
from kinspan.sources import text as X


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tree(root):
    for name, text in {
        "a.txt": "12", "empty.txt": "", "x/b b%20.txt": "1", "x/y/none.bin": "", "x/y/z/c": "1234",
        "_SUCCESS": "", ".hidden/d": "1",
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (root / "x/void").mkdir()


@pytest.mark.parametrize("folders", [1, 2, 64])
def test_inventory_has_every_file(spark, tmp_path, monkeypatch, folders):
    monkeypatch.setattr(I, "FOLDERS", folders)
    tree(tmp_path)

    def listed(**options):
        found = P.file_inventory(spark, str(tmp_path), **options)
        return {(r.path.removeprefix(f"file://{tmp_path}/"), r.kind, r.length) for r in found.collect()}

    deep = {("a.txt", 2), ("empty.txt", 0), ("x/b b%20.txt", 1), ("x/y/none.bin", 0), ("x/y/z/c", 4)}
    assert listed() == {(p, "file", n) for p, n in deep}
    assert listed(recursive=False) == {("a.txt", "file", 2), ("empty.txt", "file", 0)}
    assert listed(directories=True) - listed() == {(p, "directory", 0) for p in ("x", "x/y", "x/y/z", "x/void")}
    assert {p for p, _, _ in listed(hidden=True) - listed()} == {"_SUCCESS", ".hidden/d"}
    # Each file once, although folders are shared out over tasks.
    assert P.file_inventory(spark, str(tmp_path)).count() == 5


def test_inventory_of_a_file_and_of_nothing(spark, tmp_path):
    tree(tmp_path)
    assert [r.length for r in P.file_inventory(spark, f"{tmp_path}/a.txt").collect()] == [2]
    assert P.file_inventory(spark, f"file://{tmp_path}/x/void").count() == 0
    with pytest.raises(Exception, match="not found|FileNotFound|nowhere"):
        P.file_inventory(spark, f"{tmp_path}/nowhere").collect()


def test_listing_through_hadoop_is_the_same(spark, tmp_path):
    tree(tmp_path)
    for recursive in (False, True):
        ours, other = P.list_files(spark, str(tmp_path), recursive), I.hadoop_inventory(spark, f"file://{tmp_path}", recursive)
        columns = [F.regexp_replace("path", "^file:/+", "/"), "kind", "length"]
        assert rows(ours.select(*columns)) == rows(other.select(*columns))


def test_manifest_lines_are_dealt_out(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"f {i}").write_bytes(b"" if i == 3 else f"{i}\r\nä{i}\n\nlast{i}".encode())
    names = [f"{tmp_path}/f {i}" for i in range(7)] + ["", f"{tmp_path}/f 0"]
    (tmp_path / "manifest").write_text("\n".join(names))
    for n in (1, 2, 100):
        lines = X.read_manifest(spark, f"{tmp_path}/manifest", lines_per_split=n)
        got = Counter((r.value, r.file_path.rsplit("/", 1)[1]) for r in lines.collect())
        wanted = Counter((v, f"f {i}") for i in [*range(7), 0] if i != 3 for v in (f"{i}", f"ä{i}", "", f"last{i}"))
        assert got == wanted
        assert lines.rdd.getNumPartitions() == (9 + n - 1) // n
    (tmp_path / "void").write_text("\n \n")
    assert X.read_manifest(spark, f"{tmp_path}/void", lines_per_split=1).count() == 0
    with pytest.raises(ValueError):
        X.read_manifest(spark, f"{tmp_path}/manifest", lines_per_split=0)
    (tmp_path / "lost").write_text(f"{tmp_path}/gone")
    with pytest.raises(Exception, match="gone"):
        X.read_manifest(spark, f"{tmp_path}/lost", lines_per_split=1).collect()


def files_of(spark, root, version):
    return {r.file for r in V.version_files(spark, root, version).collect()}


def test_upserts_share_untouched_files(spark, tmp_path):
    root = str(tmp_path / "a table")
    base = spark.range(1000).selectExpr("id AS k", "'old' AS v", "0 AS at").unionByName(
        spark.createDataFrame([(None, "old", 0)], "k bigint, v string, at int")
    )
    assert V.create_table(base, root, ["k"], files=10) == 1
    with pytest.raises(FileExistsError):
        V.create_table(base, root, ["k"])
    updates = spark.createDataFrame([(5, "b", 2), (5, "a", 1), (None, "n", 1), (5000, "new", 1)], base.schema)
    assert V.upsert_table(spark, root, updates, ["k"], "at") == 2
    first, second = files_of(spark, root, 1), files_of(spark, root, 2)
    assert len(first) == 10 and len(first & second) >= 8
    now = {r.k: r.v for r in V.read_table_version(spark, root).collect()}
    assert now == {**{i: "old" for i in range(1000)}, 5: "b", None: "n", 5000: "new"}
    assert V.read_table_version(spark, root).count() == 1002
    assert {r.v for r in V.read_table_version(spark, root, 1).collect()} == {"old"}
    assert V.upsert_table(spark, root, updates.limit(0), ["k"], "at") == 3
    assert files_of(spark, root, 2) <= files_of(spark, root, 3)
    assert V.append_table(spark, root, updates, ["k"]) == 4
    assert V.read_table_version(spark, root).count() == 1006
    assert V.versions(spark, root) == [1, 2, 3, 4]
    assert V.versions(spark, str(tmp_path / "none")) == []


def test_a_slower_writer_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    V.create_table(base, root, ["k"])
    V.append_table(spark, root, base, ["k"])
    monkeypatch.setattr(V, "_current", lambda spark, root: 1)  # what a writer knows that began before
    with pytest.raises(FileExistsError):
        V.append_table(spark, root, base, ["k"])
    assert V.read_table_version(spark, root, 2).count() == 2


def test_upsert_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "k int, v string")
    V.create_table(empty, str(tmp_path), ["k"])
    V.upsert_table(spark, str(tmp_path), spark.createDataFrame([(1, "a")], empty.schema), ["k"], "v")
    assert rows(V.read_table_version(spark, str(tmp_path))) == [(1, "a")]


def test_upsert_has_one_row_for_a_null_key(spark):
    base = spark.createDataFrame([(None, "a"), ("x", "a")], "k string, v string")
    updates = spark.createDataFrame([(None, "b"), (None, "c")], base.schema)
    assert rows(T.upsert(base, updates, ["k"], "v")) == [("x", "a"), (None, "c")]


def facts(spark):
    data = [("hot", i) for i in range(400)] + [(f"k{i % 90}", i) for i in range(300)] + [(None, -1), (None, -2)]
    return spark.createDataFrame(data, "k string, x int").repartition(3)


@pytest.fixture
def keyed(spark, tmp_path):
    return K.store_keyed(facts(spark), f"file://{tmp_path}/keyed", "k", ["x"], buckets=4, hot_rows=50)


@pytest.mark.parametrize("literals, broadcast_rows", [(500, 10**6), (0, 10**6), (0, 0)])
def test_keyed_lookups_equal_joins(spark, keyed, monkeypatch, literals, broadcast_rows):
    from kinspan.operators import skew

    monkeypatch.setattr(K, "LITERAL_KEYS", literals)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    listed = spark.createDataFrame([("hot", 1), ("k3", 2), ("gone", 3)], "k string, n int")
    for table in (keyed, K.open_keyed(spark, keyed.path)):
        assert rows(table.matching(listed)) == rows(facts(spark).join(listed, "k"))
        assert rows(table.counts(listed)) == rows(facts(spark).join(listed, "k").groupBy("k").count())
        assert rows(table.rows(spark)) == rows(facts(spark))


def test_a_short_list_opens_its_buckets_only(spark, keyed):
    text = plan(keyed.matching(spark.createDataFrame([("k3",)], "k string")))
    assert re.search(r"SelectedBucketsCount: 1 out of 4|Bucketed: false \(disabled by query planner\)", text)
    assert "EqualTo(k,k3)" in text or "In(k, [k3])" in text


def test_a_long_list_leaves_the_table_where_it_is(spark, keyed, monkeypatch):
    from kinspan.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(keyed.matching(facts(spark).select("k").distinct()))
        assert "Bucketed: true" in text
        # Between the join and the scan of the buckets nothing is dealt anew.
        scan = next(i for i, line in enumerate(text.splitlines()) if "Bucketed: true" in line)
        above = text.splitlines()[:scan]
        join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in above[join:])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_stored_apart(spark, keyed):
    assert {r.k for r in keyed._hot(spark).select("k").distinct().collect()} == {"hot", None}
    assert keyed._cold(spark).filter("k = 'hot' OR k IS NULL").count() == 0


def test_storing_runs_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def watched(x):
        seen.add(1)
        return x

    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), watched("id").alias("x"))
    table = K.store_keyed(df, f"{tmp_path}/once", "k", ["x"], buckets=2)
    assert table.rows(spark).count() == 1000
    assert seen.value == 1000


def test_a_lookup_writes_only_what_it_reads(spark, small_dir, tmp_path):
    from kinspan.plans import inputs

    valid = inputs.valid(spark, small_dir)
    stored = L.store_two_level(valid, "l", f"{tmp_path}/events", 1, 2, tables=["events"])
    assert stored.summary is None and stored.ends is None and stored.events.rows(spark).count() > 0
    assert "isnotnull(split(" not in plan(L._ends(valid, "l"))
    summary = R.summary_edges(valid, "l").select("src", "dst", "edge_id")
    ends = G.incidence(summary).select("v", "edge_id")
    assert rows(L._ends(valid, "l")) == rows(ends)


def test_an_empty_keyed_table(spark, tmp_path):
    K.store_keyed(facts(spark).limit(0), f"{tmp_path}/none", "k", buckets=2)
    table = K.open_keyed(spark, f"{tmp_path}/none")
    assert table.counts(spark.createDataFrame([("hot",)], "k string")).count() == 0


def test_stored_layout_agrees_with_the_lookups_over_records(spark, tmp_path):
    valid = spark.createDataFrame(
        [("a", "b", 1, "r1"), ("b", "a", 1, "r2"), ("b", "a", 5, "r3"), ("c", "c", 2, "r4"), ("a", "x:y", 3, "r5")],
        "key1 string, key2 string, time_ms bigint, raw string",
    )
    stored = L.store_two_level(valid, "l", str(tmp_path / "s"), times=3, buckets=2, hot_rows=2)
    summary, events = R.summary_edges(valid, "l"), R.pair_events(valid, "l", 3)
    pairs = spark.createDataFrame([("b", "a"), ("b", "a"), ("c", "c"), ("q", "a"), (None, "a")], "key1 string, key2 string")
    keys = spark.createDataFrame([("a",), ("a",), ("c",), ("x:y",), ("q",), (None,)], "key string")
    for layout in (stored, L.open_two_level(spark, str(tmp_path / "s"), "l")):
        assert rows(L.pair_lookup(pairs, layout)) == rows(G.pair_lookup_summary(pairs, summary, events, "l"))
        assert rows(L.incident_lookup(keys, layout)) == rows(G.incident_edges_summary(keys, summary, events))


@pytest.mark.parametrize("n", [0, 1, 499, 1000, 1999, 2000, 5000])
def test_samples_of_any_size(spark, n, monkeypatch):
    monkeypatch.setattr(T, "TIED_ROWS", 3)
    lines = spark.range(2000).selectExpr("id", "concat('v', id % 7) AS value")
    got = [r.id for r in T.sample_lines(lines, n, 5, ["id"]).collect()]
    draw = F.md5(F.concat_ws("\u0001", F.lit("5"), F.col("id").cast("string")))
    assert got == [r.id for r in lines.orderBy(draw).limit(n).collect()]
    copies = T.sample_lines(lines.select("value"), n, 5)
    assert copies.count() == min(n, 2000)


def test_samples_cut_rows_that_tie(spark, monkeypatch):
    monkeypatch.setattr(T, "TIED_ROWS", 3)
    lines = spark.range(200).selectExpr("id % 2 AS k", "id")
    got = T.sample_lines(lines, 130, 1, ["k"]).collect()
    assert len(got) == 130 and len({r.id for r in got}) == 130
    assert sorted(Counter(r.k for r in got).values()) == [30, 100]


def test_a_large_sample_is_no_heap(spark):
    lines = spark.range(2000).selectExpr("id", "id AS value")
    assert "TakeOrderedAndProject" not in plan(T.sample_lines(lines, 1000, 5, ["id"])).split("Union")[0]


def test_cardinalities_know_one_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,)], "x double")
    assert rows(T.cardinalities(df, ["x"])) == [("x", 2)]


def test_sketches_of_files_unite(spark, tmp_path):
    for part in range(3):
        spark.range(part * 3000, part * 3000 + 5000).selectExpr("id", "id / 2.0 AS x", "cast(null AS string) AS s").coalesce(
            1
        ).write.parquet(f"{tmp_path}/{part}")
    df = spark.read.parquet(*(f"{tmp_path}/{part}" for part in range(3)))
    sketches = T.file_sketches(df, ["id", "x", "s"])
    assert sketches.count() == 3 and {r.rows for r in sketches.collect()} == {5000}
    sketches.write.parquet(f"{tmp_path}/sketches")
    found = T.united_cardinalities(spark.read.parquet(f"{tmp_path}/sketches"), ["id", "x", "s"])
    for r in found.collect():
        exact = {"id": 11_000, "x": 11_000, "s": 0}[r.col]
        assert abs(r.ndv - exact) <= 3 * r.error * exact
    one = T.united_cardinalities(sketches.filter(F.col("file").contains("/0/")), ["id"]).first()
    assert abs(one.ndv - 5000) <= 3 * one.error * 5000


def test_descriptor_violations(spark):
    schema = S.schema_from_json(
        """[{"offset": 0, "name": "a", "dataType": "STRING", "isPrimaryKey": true},
            {"offset": 1, "name": "b", "dataType": "INT", "isPrimaryKey": true},
            {"offset": 2, "name": "u", "dataType": "STRING", "isUnique": true},
            {"offset": 3, "name": "t", "dataType": "BOOLEAN"}]"""
    )
    raw = spark.createDataFrame(
        [("x", "1", "p", "true"), ("x", "1", "q", "maybe"), ("x", "2", "p", None), (None, "z", None, "no"), (None, "z", None, "maybe")],
        "a string, b string, u string, t string",
    )
    assert rows(S.violations(raw, schema)) == sorted(
        [
            ("a", "missing key", None, 2), ("a,b", "repeated key", "x,1", 2), ("b", "not a INT", "z", 2),
            ("t", "not a BOOLEAN", "maybe", 2), ("u", "repeated value", "p", 2),
        ],
        key=lambda row: [(v is None, str(v)) for v in row],
    )
    assert S.violations(raw.limit(0), schema).count() == 0


def test_malformed_row_keys_do_not_end_the_job(spark):
    cells = spark.createDataFrame([("a:b:l_12", "v"), ("plain", "v"), ("a_b_7x", "w"), (None, "n")], "row_key string, value string")
    assert rows(G.decode_row_keys(cells).select("time", "value")) == [(12, "v"), (None, "n"), (None, "v"), (None, "w")]
    assert G.malformed_row_keys(cells).first().malformed == 3


def test_no_integral_columns_no_values(spark):
    assert P.orc_long_values(spark.createDataFrame([("a", 1.0)], "s string, d double")).count() == 0


def test_unknown_keys_raise_if_asked(spark):
    vertices = spark.createDataFrame([("a",), ("b",)], "key string")
    edges = spark.createDataFrame([("a", "b", "l")], "src string, dst string, label string")
    pairs = spark.createDataFrame([("a", "b"), ("a", "zz")], "key1 string, key2 string")
    assert G.pair_lookup_raw(pairs, edges).count() == 2
    with pytest.raises(KeyError, match="zz"):
        G.pair_lookup_raw(pairs, edges, vertices=vertices, on_missing="error")
    assert G.pair_lookup_raw(pairs.limit(1), edges, vertices=vertices, on_missing="error").count() == 1
    with pytest.raises(ValueError):
        G.pair_lookup_raw(pairs, edges, on_missing="error")


def test_degrees_in_text_order(spark):
    edges = spark.createDataFrame([("h", f"x{i}") for i in range(10)] + [("y", "z"), ("y", "w")], "src string, dst string")
    assert [r.degree for r in G.degree_distribution(edges, text_order=True).collect()] == [1, 10, 2]


@pytest.mark.parametrize("group_rows", [1, 2, 10_000])
def test_triangles_with_split_arrays(spark, group_rows):
    import itertools
    import random

    draw = random.Random(group_rows)
    pairs = sorted({tuple(sorted(draw.sample(range(14), 2))) for _ in range(50)})
    near = {v: {x for p in pairs if v in p for x in p} - {v} for v in range(14)}
    wanted = Counter(
        v for t in itertools.combinations(range(14), 3) if t[1] in near[t[0]] and t[2] in near[t[0]] & near[t[1]] for v in t
    )
    df = spark.createDataFrame([(f"v{a:02}", f"v{b:02}") for a, b in pairs], "a string, b string")
    got = {int(r.v[1:]): r.triangles for r in W.triangle_counts(df, group_rows).collect()}
    assert got == dict(wanted)


def test_hops_of_more_seeds_than_a_word_has_bits(spark):
    n = 150
    edges = spark.createDataFrame([(str(i), str((i + 1) % n), "l") for i in range(n)], "src string, dst string, label string")
    vertices = spark.createDataFrame([(str(i),) for i in range(n + 1)], "key string")
    found = {}
    for r in W.k_hop(vertices, vertices, edges, 2).collect():
        found.setdefault(int(r.seed), set()).add(int(r.v))
    assert found == {i: {i, (i + 2) % n, (i - 2) % n} for i in range(n)}
    sizes = {int(r.seed): r.set_size for r in W.k_hop_sizes(vertices, vertices, edges, 2).collect()}
    assert sizes == {**{i: 3 for i in range(n)}, n: 0}
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(W.k_hop(vertices, vertices, edges, 1)))


