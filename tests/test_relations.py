from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kinspan.operators import relations as R
from kinspan.sources import text as X

SEP = "\u0001"


def line(key1, key2, time="2016-01-02 03:04:05.0", **fields):
    values = [f"f{i}" for i in range(38)]
    values[0], values[19], values[9], values[28] = key1, key2, time, time
    for name, value in fields.items():
        values[int(name[1:])] = value
    return SEP.join(values)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def relations(spark, *texts):
    return R.parse_relations(lines(spark, *texts))


def vertices(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def test_trailing_empty_fields_do_not_count(spark):
    ends_empty = line("a", "b", **{f"f{i}": "" for i in range(30, 38)})
    parsed = relations(spark, line("a", "b"), ends_empty, SEP * 37).collect()
    assert [r.field_count for r in parsed] == [38, 30, 0]
    assert [len(r.fields) for r in parsed] == [38, 38, 38]


def test_other_indices_and_separator(spark):
    parsed = R.parse_relations(lines(spark, "x||y||z"), 2, 0, 1, "||").first()
    assert (parsed.key1, parsed.key2, parsed.time_text) == ("z", "x", "y")


def test_reject_reasons_and_times(spark, no_broadcast):
    _check_reject_reasons(spark)


def test_reject_reasons_and_times_by_broadcast(spark):
    _check_reject_reasons(spark)


def _check_reject_reasons(spark):
    texts = [
        line("a", "b"),
        line("x", "b"),
        line("a", "x"),
        line("x", "y"),
        SEP.join(["a"] * 19),
        line("a", "b", time="bad"),
        line("a", "b", time="2016-13-02 03:04:05"),
    ]
    checked = R.validate_relations(relations(spark, *texts), vertices(spark, "a", "b", "b"), 7)
    by_raw = {r.raw: r for r in checked.collect()}
    assert len(by_raw) == checked.count() == len(texts)
    assert [by_raw[t].reject_reason for t in texts] == [
        None,
        "key1 not found",
        "key2 not found",
        "key1 not found",
        "not enough fields",
        None,
        None,
    ]
    assert by_raw[texts[0]].time_ms == 1451703845000
    assert by_raw[texts[5]].time_ms == by_raw[texts[6]].time_ms == 7
    assert rows(R.load_report(checked, 100)) == [(4, 300)]
    assert R.accepted(checked).count() + R.rejected(checked).count() == len(texts)


def test_few_unknown_keys_are_broadcast(spark, monkeypatch):
    """A vertex list over the limit leaves a list of unknown endpoints under it."""
    from kinspan.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 2)
    checked = R.validate_relations(
        relations(spark, line("a", "b"), line("x", "b"), line("c", "y")), vertices(spark, "a", "b", "c"), 7
    )
    assert rows(checked.select("key1", "reject_reason")) == [
        ("a", None),
        ("c", "key2 not found"),
        ("x", "key1 not found"),
    ]


def test_default_time_is_now(spark):
    checked = R.validate_relations(relations(spark, line("a", "a", time="")), vertices(spark, "a"))
    assert checked.first().time_ms > 1_600_000_000_000


def test_canonical_form_swaps_halves(spark):
    canonical = R.canonical_edges(relations(spark, line("b", "a"), line("10", "9"))).collect()
    swapped = canonical[0].raw.split(SEP)
    assert (canonical[0].k1, canonical[0].k2, swapped[0], swapped[19], swapped[1]) == ("a", "b", "a", "b", "f20")
    assert (canonical[1].k1, canonical[1].k2, canonical[1].raw) == ("10", "9", line("10", "9"))


def test_sort_keeps_and_unique_drops_duplicates(spark):
    texts = [line("a", "b", time="t1"), line("b", "a", time="t1"), line("a", "b", time="t2")]
    canonical = R.canonical_edges(relations(spark, *texts, *texts[:1] * 2))
    assert R.sort_edges(canonical).count() == 5
    assert rows(R.sort_duplicates(canonical)) == [(3,)]
    unique = R.unique_edges(canonical)
    assert unique.count() == 2
    assert rows(R.unique_edges(unique)) == rows(unique)


def test_fan_out(spark):
    valid = spark.createDataFrame([("a", "b", 1000, "x")], "key1 string, key2 string, time_ms long, raw string")
    assert [r.time for r in R.raw_edges(valid, "l", 3).orderBy("time").collect()] == [1000, 2000, 3000]
    assert [r.time for r in R.pair_events(valid, "l", 3).orderBy("time").collect()] == [1000, 1001, 1002]


def test_overlapping_fan_outs_keep_the_greatest_value(spark):
    records = [("a", "b", t, f"v{t % 7}{i}") for i, t in enumerate([-5, 0, 1, 3, 4, 9, 10, 10, 22])]
    valid = spark.createDataFrame(records, "key1 string, key2 string, time_ms long, raw string")
    for times in (1, 2, 5, 8):
        expected = {}
        for _, _, start, value in records:
            for time in range(start, start + times):
                expected[time] = max(value, expected.get(time, ""))
        got = {r.time: r.value for r in R.pair_events(valid, "l", times).collect()}
        assert got == expected
        assert R.pair_events(valid, "l", times).count() == len(expected)


def test_summary_edge_takes_the_first_direction(spark):
    records = [("b", "a", 5, "y"), ("a", "b", 9, "x"), ("c", "c", 1, "z")]
    valid = spark.createDataFrame(records, "key1 string, key2 string, time_ms long, raw string")
    summary = R.summary_edges(valid, "l")
    assert rows(summary) == [("a:b:l", "b", "a", "l"), ("c:c:l", "c", "c", "l")]
    existing = spark.createDataFrame([("a:b:l", "a", "b", "l")], summary.schema)
    assert rows(R.summary_edges(valid, "l", existing)) == [("a:b:l", "a", "b", "l"), ("c:c:l", "c", "c", "l")]


def test_vertex_lines(spark):
    names = ["id", "key", "name"]
    parsed = X.parse_vertices(lines(spark, "1\tk\tNULL\tx\tnull\ty", "2\tk2", "3", ""), names)
    got = [(r.id, r.key, r.name, r.extra, r.reject_reason) for r in parsed.collect()]
    assert got == [
        ("1", "k", None, {"field3": "x", "field5": "y"}, None),
        ("2", "k2", None, {}, None),
        ("3", None, None, {}, "not enough fields"),
        ("", None, None, {}, "not enough fields"),
    ]


def test_vertices_are_loaded_once(spark):
    names = ["id", "key"]
    parsed = X.parse_vertices(lines(spark, "2\tk\tx", "1\tk", "3\told", "4\tnew", "5"), names)
    existing = spark.createDataFrame([("0", "old", "person")], "id string, key string, label string")
    good = parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    loaded = R.load_vertices(existing, good)
    assert rows(loaded.select("key", "id", "label")) == [
        ("k", "1", "person"),
        ("new", "4", "person"),
        ("old", "0", "person"),
    ]
    assert rows(R.vertex_load_report(parsed, existing)) == [(1, 2, 2)]


@pytest.mark.parametrize("times", [1, 3, 100])
def test_spans_count_what_the_fan_out_makes(spark, times):
    rng = random.Random(times)
    starts = [rng.randrange(-500, 500) for _ in range(60)] + [0, 99, 100, 199, 10**12, 10**12 + 1]
    records = [(rng.choice("ab"), rng.choice("bc"), t, f"r{i}") for i, t in enumerate(starts)]
    valid = spark.createDataFrame(records, "key1 string, key2 string, time_ms bigint, raw string")
    made = R.pair_events(valid, "l", times).groupBy("edge_id").agg(
        F.count(F.lit(1)), F.min("time"), F.max("time")
    )
    spans = R.event_spans(valid, "l", times)
    assert rows(spans) == rows(made)


def test_spans_make_no_detail_rows(spark, small_dir):
    from kinspan.plans import QUERIES

    text = QUERIES["pair_event_spans"](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in text and "max(raw" not in text
