from __future__ import annotations

import random
import time
from itertools import product

import pytest
from conftest import in_order, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinspan.operators import graph as G
from kinspan.operators import traversal as T

EDGE = "src string, dst string, label string, time long, value string"


def edges(spark, *pairs, label="l"):
    records = [(a, b, label, i, f"e{i}") for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(records, EDGE)


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def test_multigraph(spark):
    graph = edges(spark, ("v1", "v2"), ("v1", "v2"), ("v1", "v3"))
    vertices = keys(spark, "v1", "v2", "v3")
    assert rows(G.degrees(graph)) == [("v1", 3), ("v2", 2), ("v3", 1)]
    assert rows(G.degree_distribution(graph)) == [(1, 1), (2, 1), (3, 1)]
    pairs = spark.createDataFrame([("v2", "v1"), ("v2", "v3")], "key1 string, key2 string")
    assert rows(G.pair_lookup_raw(pairs, graph)) == [("v2", "v1", 1, 2), ("v2", "v3", 1, 0)]
    assert rows(G.pair_exists(pairs, graph)) == [("v2", "v1", True), ("v2", "v3", False)]
    assert rows(T.k_hop(keys(spark, "v1"), vertices, graph, 1)) == [("v1", "v2"), ("v1", "v3")]
    assert rows(T.k_hop(keys(spark, "v1"), vertices, graph, 2)) == [("v1", "v1")]
    assert rows(G.graph_counts(vertices, graph)) == [(3, 3)]
    assert rows(G.stored_counts(vertices, graph)) == [(3, 6)]
    assert G.edges_between(graph, "v2", "v1").count() == 2


def test_loops_count_twice(spark):
    graph = edges(spark, ("a", "a"), ("a", "b"))
    assert rows(G.degrees(graph)) == [("a", 3), ("b", 1)]
    assert rows(G.neighbors(graph)) == [("a", "a"), ("a", "b"), ("b", "a")]
    assert G.incident_edges_raw(keys(spark, "a"), graph).count() == 3


def test_key_list_reports(spark):
    graph = edges(spark, ("a", "b"), ("a", "c"))
    vertices = keys(spark, "a", "b", "c", "c")
    listed = keys(spark, "a", "a", "c", "x")
    assert rows(G.key_counts(listed, vertices, graph)) == [(4, 2)]
    assert rows(G.key_degree_report(listed, vertices, graph)) == [(5, 1, 1)]
    assert rows(G.duplicate_keys(vertices)) == [("c", 2)]
    nobody = keys(spark, "x")
    assert rows(G.key_counts(nobody, vertices, graph)) == [(0, 0)]
    assert rows(G.key_degree_report(nobody, vertices, graph)) == [(0, 1, 0)]


def test_profile_lists_properties_and_edges(spark):
    vertices = spark.createDataFrame(
        [("a", "n", None, {"field34": "x"}), ("b", None, None, None)],
        "key string, name string, other string, extra map<string,string>",
    )
    graph = edges(spark, ("a", "b"), ("a", "a"))
    assert rows(G.vertex_profile(vertices, graph)) == [("a", 3, 3), ("b", 1, 1)]
    entries = G.vertex_entries(vertices, graph, keys(spark, "a"))
    assert rows(entries.filter("kind = 'property'").select("name", "value")) == [
        ("field34", "x"),
        ("key", "a"),
        ("name", "n"),
    ]
    assert entries.filter("kind = 'edge'").count() == 3


def test_raw_and_two_level_lookups_agree(spark):
    from kinspan.operators import relations as R

    rng = random.Random(3)
    records = {(rng.choice("abcd"), rng.choice("abcd"), t) for t in range(40)}
    valid = spark.createDataFrame(
        [(a, b, t, f"{a}{b}{t}") for a, b, t in sorted(records)],
        "key1 string, key2 string, time_ms long, raw string",
    )
    raw = R.raw_edges(valid, "l", 1)
    summary, events = R.summary_edges(valid, "l"), R.pair_events(valid, "l", 1)
    pairs = spark.createDataFrame(list(product("abcdx", repeat=2)), "key1 string, key2 string")
    assert rows(G.pair_lookup_raw(pairs, raw, "l")) == rows(G.pair_lookup_summary(pairs, summary, events, "l"))
    listed = keys(spark, "a", "b", "b", "x")
    by_raw = rows(G.incident_edges_raw(listed, raw))
    assert by_raw == rows(G.incident_edges_summary(listed, summary, events))
    assert by_raw


def test_clustering_of_a_triangle_with_a_tail(spark):
    graph = edges(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"))
    vertices = keys(spark, *"abcde")
    got = {r.seed: r.local_cc for r in T.local_clustering(vertices, vertices, graph).collect()}
    assert got == pytest.approx({"a": 1, "b": 1, "c": 1 / 3, "d": 0, "e": 0})
    four = keys(spark, *"abcd", "x")
    assert T.average_clustering(four, vertices, graph).first().avg_cc == pytest.approx(7 / 12)


def neighbor_sets(pairs, drop_loops=False):
    near = {}
    for a, b in pairs:
        if a == b and drop_loops:
            continue
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return near


def clustering_by_hand(pairs, seeds, drop_loops):
    near = neighbor_sets(pairs, drop_loops)
    out = {}
    for s in seeds:
        own = near.get(s, set())
        adj = sum(1 for x in own for y in near[x] if y in own) if len(own) > 1 else None
        out[s] = (len(own), adj, adj / (len(own) * (len(own) - 1)) if len(own) > 1 else 0.0)
    return out


def test_ranks_have_no_gaps_and_fit_an_int(spark):
    names = [f"n{i:03}" for i in range(300)]
    pairs = spark.createDataFrame(
        [(names[i], names[j]) for i in range(300) for j in (i + 1, i + 7, 299) if i < j < 300], "a string, b string"
    )
    ranks = T._ranked(pairs.distinct().repartition(5))
    assert dict(ranks.dtypes)["id"] == "int"
    found = sorted((r.id, r.degree, r.key) for r in ranks.collect())
    assert [i for i, _, _ in found] == list(range(300))
    assert [(d, k) for _, d, k in found] == sorted((d, k) for _, d, k in found)


def random_graph(seed):
    """A dense core, a hub that joins everything, loops and parallel edges."""
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(24)]
    pairs = [(rng.choice(names[:12]), rng.choice(names)) for _ in range(90)]
    pairs += [("n0", n) for n in names[1:20]] * 2
    return names, pairs


@pytest.mark.parametrize("drop_loops", [False, True])
@pytest.mark.parametrize(("group_rows", "few"), [(10_000, 1), (3, 100)])
def test_clustering_against_brute_force(spark, monkeypatch, drop_loops, group_rows, few):
    monkeypatch.setattr(T, "FEW_SEEDS", few)
    names, pairs = random_graph(5)
    graph, vertices = edges(spark, *pairs), keys(spark, *names, "alone")
    for seeds in ([*names, "alone"], ["n0", "n3", "n3", "unknown"]):
        got = T.local_clustering(keys(spark, *seeds), vertices, graph, drop_loops, group_rows).collect()
        known = [s for s in dict.fromkeys(seeds) if s != "unknown"]
        expected = clustering_by_hand(pairs, known, drop_loops)
        assert {r.seed for r in got} == set(known)
        for r in got:
            n, adj, cc = expected[r.seed]
            assert r.n == n and r.local_cc == pytest.approx(cc)
            assert adj is None or r.adj == adj
            assert r.listed == seeds.count(r.seed)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 1])
def test_few_seeds_open_few_wedges(spark, monkeypatch, broadcast_rows):
    """One seed in twenty of a ring with chords: only what lies around the seeds is kept."""
    monkeypatch.setattr("kinspan.operators.skew.BROADCAST_ROWS", broadcast_rows)
    names = [f"r{i}" for i in range(200)]
    pairs = [(names[i], names[(i + d) % 200]) for i in range(200) for d in (1, 2)]
    graph, seeds = edges(spark, *pairs), names[::20]
    near = T._around(graph.select("src", "dst"), keys(spark, *seeds), len(names))
    assert near.count() == 10 * 7  # four steps of one and three of two in the five around each seed
    got = T.local_clustering(keys(spark, *seeds), keys(spark, *names), graph)
    expected = clustering_by_hand(pairs, seeds, False)
    assert {r.seed: r.n for r in got.collect()} == {s: expected[s][0] for s in seeds}
    assert {r.local_cc for r in got.collect()} == {0.5}


@pytest.mark.parametrize("group_rows", [10_000, 2])
def test_hops_against_brute_force(spark, group_rows):
    names, pairs = random_graph(9)
    near = neighbor_sets(pairs)
    graph, vertices = edges(spark, *pairs), keys(spark, *names, "alone")
    seeds = ["n1", "n1", "n22", "alone", "unknown"]
    for hops in (0, 1, 2, 4):
        expected = set()
        for s in ("n1", "n22", "alone"):
            frontier = {s}
            for _ in range(hops):
                frontier = {y for x in frontier for y in near.get(x, ())}
            expected |= {(s, v) for v in frontier}
        got = T.k_hop(keys(spark, *seeds), vertices, graph, hops, group_rows=group_rows)
        assert rows(got) == in_order(expected)
    sizes = {r.seed: (r.listed, r.set_size) for r in T.k_hop_sizes(keys(spark, *seeds), vertices, graph, 2).collect()}
    assert sizes["alone"] == (1, 0) and sizes["n1"][0] == 2
    average = T.k_hop_average(keys(spark, *seeds), vertices, graph, 2).first().avg_set_size
    assert average == pytest.approx(sum(n * size for n, size in sizes.values()) / 4)


def test_hops_name_seeds_without_moving_pairs(spark, no_broadcast):
    names, pairs = random_graph(9)
    df = T.k_hop(keys(spark, *names), keys(spark, *names), edges(spark, *pairs), 2)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in text and "Exchange" not in text.split("Generate")[0]


def test_near_seeds_share_words_and_sets_keep_all_bits(spark):
    known = keys(spark, *(str(i) for i in range(1000))).withColumn("listed", F.lit(1))
    placed = T._numbered_seeds(known.repartition(7)).collect()
    assert len({(r.word, r.bit) for r in placed}) == 1000
    by_word = {w: [int(r.key) for r in placed if r.word == w] for w in {r.word for r in placed}}
    assert all(max(near) - min(near) < 64 for near in by_word.values())
    words = [(v, w, b) for v in "ab" for w in (0, 5, 16383, 16384, 1 << 20) for b in (1, 1 << 62, -(1 << 63), -1)]
    reached = spark.createDataFrame(words, "v string, word bigint, bits bigint")
    whole = reached.groupBy("v", "word").agg(F.bit_or("bits").alias("bits"))
    for df in (reached.filter("bits <> -1").groupBy("v", "word").agg(F.bit_or("bits").alias("bits")), whole):
        sets = T._as_sets(df)
        assert sets.count() == 2 * 3
        back = T._as_words(sets).groupBy("v", "word").agg(F.bit_or("bits").alias("bits"))
        assert rows(back) == rows(df)


def test_hops_by_batches_of_seeds(spark, monkeypatch):
    draw = random.Random(4)
    names = [f"n{i}" for i in range(200)]
    pairs = [tuple(draw.choices(names, k=2)) for _ in range(500)] + [("n0", n) for n in names[:120]]
    near = neighbor_sets(pairs)
    graph, vertices = edges(spark, *pairs), keys(spark, *names, "alone")
    sent, batches = [], T._batches
    monkeypatch.setattr(T, "BATCH_ENTRIES", 15_000)
    monkeypatch.setattr(T, "GROUP_ROWS", 100)
    monkeypatch.setattr(T, "_batches", lambda *a: sent.append(batches(*a)) or sent[-1])
    for hops in (2, 3):
        expected = {}
        for s in [*names, "alone"]:
            frontier = {s}
            for _ in range(hops):
                frontier = {y for x in frontier for y in near.get(x, ())}
            expected[s] = frontier
        sent.clear()
        if hops == 2:
            got = T.k_hop(vertices, vertices, graph, hops)
            assert rows(got) == in_order({(s, v) for s, reached in expected.items() for v in reached})
        sizes = {r.seed: r.set_size for r in T.k_hop_sizes(vertices, vertices, graph, hops).collect()}
        assert sizes == {s: len(reached) for s, reached in expected.items()}
        assert max(map(len, sent)) > 1
        for found in (b for b in sent if len(b) > 1):
            assert found[0][0] == 0 and all(b[0] == a[1] + 1 for a, b in zip(found, found[1:], strict=False))


def test_average_of_hops_by_batches_of_seeds(spark, monkeypatch):
    pairs = [(str(i), str((i + 1) % 150)) for i in range(150)] + [("0", str(i)) for i in range(0, 150, 3)]
    near = neighbor_sets(pairs)
    seeds = [str(i) for i in range(150) for _ in range(1 + i % 2)]
    total = sum(len({y for x in near[s] for y in near[x]}) for s in seeds)
    graph, vertices = edges(spark, *pairs), keys(spark, *near)
    sent, batches = [], T._batches
    monkeypatch.setattr(T, "BATCH_ENTRIES", 2_000)
    monkeypatch.setattr(T, "_batches", lambda *a: sent.append(batches(*a)) or sent[-1])
    average = T.k_hop_average(keys(spark, *seeds), vertices, graph, 2).first().avg_set_size
    assert average == pytest.approx(total / len(seeds)) and max(map(len, sent)) > 1


def test_batches_leave_no_shuffle_files(spark, monkeypatch):
    names, pairs = random_graph(9)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    graph, vertices = edges(spark, *pairs), keys(spark, *names)
    shuffles = lambda: {f.split("_")[1] for f in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in f}
    runs, tidy = [], T.reliable_and_tidy

    def run(df):
        before, done = shuffles(), tidy(df)
        for _ in range(100):  # files go a little later
            if not (left := shuffles() - before):
                break
            time.sleep(0.1)
        runs.append(left)
        return done

    monkeypatch.setattr(T, "BATCH_ENTRIES", 50)
    monkeypatch.setattr(T, "reliable_and_tidy", run)
    T.k_hop_sizes(vertices, vertices, graph, 2)
    assert len(runs) > 5 and not any(runs)


def test_neighbors_are_numbered_once_in_arrays_of_some_length(spark, monkeypatch):
    monkeypatch.setattr(T, "GROUP_ROWS", 20)
    pairs = [("hub", f"x{i:03}") for i in range(200)] + [("x000", "hub"), ("x001", "x001"), (None, "x002")]
    numbers, near = T._neighbor_arrays(edges(spark, *pairs).select("src", "dst"))
    key = {r.id: r.key for r in numbers.collect()}
    assert sorted(key) == list(range(201)) and dict(near.dtypes) == {"v": "int", "far": "array<int>"}
    found = [(key[r.v], key[x], len(r.far)) for r in near.collect() for x in r.far]
    assert {f[:2] for f in found} == {e for a, b in pairs if a for e in ((a, b), (b, a))} and len(found) == 401
    assert max(f[2] for f in found) < 60


def test_hops_follow_one_label(spark):
    graph = edges(spark, ("a", "b")).unionByName(edges(spark, ("b", "c"), label="m"))
    vertices = keys(spark, *"abc")
    assert rows(T.k_hop(vertices, vertices, graph, 1, "m")) == [("b", "c"), ("c", "b")]


def co_purchases(spark, sf_dir, column):
    """Edges from each line of an order to the next one."""
    order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    key = F.col(column).cast("string")
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .select(
            key.alias("src"),
            F.lead(key).over(order).alias("dst"),
            F.lit("l").alias("label"),
            F.unix_millis(F.to_timestamp("l_shipdate")).alias("time"),
        )
        .filter(F.col("dst").isNotNull())
    )


def test_pinned_numbers_of_the_sparse_graph(spark, middle_dir):
    graph = co_purchases(spark, middle_dir, "l_partkey").cache()
    vertices = (
        spark.read.parquet(f"{middle_dir}/part.parquet")
        .select(F.col("p_partkey").cast("string").alias("key"))
        .cache()
    )
    assert graph.count() == 45_257
    assert graph.filter("src = dst").count() == 28
    assert G.simple_pairs(graph).count() == 44_707
    distribution = G.degree_distribution(graph).collect()
    assert (len(distribution), tuple(distribution[0]), tuple(distribution[-1])) == (55, (19, 1), (80, 1))
    assert sum(r.degree * r.vertex_count for r in distribution) == 90_514
    seeds = vertices.filter(F.col("key").cast("long") % 50 == 0).unionByName(keys(spark, "-1", "-2"))
    assert rows(G.key_degree_report(seeds, vertices, graph)) == [(1_817, 2, 0)]
    assert rows(G.key_counts(seeds, vertices, graph)) == [(40, 908)]
    for hops, size in ((1, 44.8), (2, 1_279.0), (3, 2_000.0)):
        average = T.k_hop_average(seeds, vertices, graph, hops).first().avg_set_size
        assert round(average, 1) == size
    assert T.average_clustering(seeds, vertices, graph).first().avg_cc == pytest.approx(0.0245398924, abs=1e-9)


def test_pinned_numbers_of_the_dense_graph(spark, middle_dir):
    from kinspan.operators import relations as R

    graph = co_purchases(spark, middle_dir, "l_suppkey").cache()
    assert graph.filter("src = dst").count() == 458
    assert G.simple_pairs(graph).count() == 5_048
    canonical = graph.select(
        F.least("src", "dst").alias("k1"),
        F.greatest("src", "dst").alias("k2"),
        "time",
        F.lit("").alias("raw"),
    )
    assert rows(R.sort_duplicates(canonical)) == [(60,)]
    assert R.unique_edges(canonical).count() == 45_197
    distribution = G.degree_distribution(graph).collect()
    assert (len(distribution), distribution[0].degree, distribution[-1].degree) == (70, 816, 1_047)
