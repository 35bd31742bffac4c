"""Relation lines: validation, canonical form, sorting, dedup and edge loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.functions.select import select_where
from kinspan.functions.text import RELATION_SEP
from kinspan.functions.times import parse_millis
from kinspan.operators.skew import fits_broadcast, key_counts, only_listed, skew_join
from kinspan.session import reliable
from kinspan.sources.lines import (  # noqa: F401 - parsing is part of this module's interface
    HALF_FIELDS,
    KEY1_INDEX,
    KEY2_INDEX,
    NOT_ENOUGH_FIELDS,
    TIME_INDEX,
    parse_relations,
)

KEY1_NOT_FOUND = "key1 not found"
KEY2_NOT_FOUND = "key2 not found"


def mark_short_lines(relations: DataFrame, last_index: int = KEY2_INDEX) -> DataFrame:
    """Add `reject_reason`: set for a line that ends before the field `last_index`, or is NULL."""
    short = F.coalesce(F.col("field_count") <= last_index, F.lit(True))
    return relations.withColumn("reject_reason", F.when(short, F.lit(NOT_ENOUGH_FIELDS)))


def mark_unknown_endpoints(records: DataFrame, vertices: DataFrame) -> DataFrame:
    """Set `reject_reason` where key1, else key2, is not the key of a vertex; NULL never is one.

    A vertex list too large to broadcast is first narrowed, by keys alone, to the endpoint keys it
    lacks. These are usually few, and a broadcast of them spares the shuffles of whole lines. The
    endpoints are written out for that, so lines are parsed twice, once for them and once for the
    result. The vertices are counted, and beyond the limit the endpoints read, when this is called.
    """
    known = vertices.select("key").filter(F.col("key").isNotNull())
    small = fits_broadcast(known)
    ends = records
    if small:
        marked, found = known.distinct(), True
    else:
        ends = reliable(records.select("key1", "key2", "reject_reason"))
        endpoints = (
            ends.filter(F.col("reject_reason").isNull())
            .select(F.explode(F.array("key1", "key2")).alias("key"))
            .distinct()
        )
        marked = reliable(endpoints.join(known.distinct(), "key", "left_anti"))
        found = False
        small = fits_broadcast(marked)
    columns = records.columns
    flagged = records
    for column, flag in (("key1", "_in1"), ("key2", "_in2")):
        side = marked.select(F.col("key").alias(column), F.lit(True).alias(flag))
        if small:
            flagged = flagged.join(F.broadcast(side), column, "left")
        else:
            # Counted before the joins, so that the second does not run the first twice.
            counts = key_counts(ends, [column])
            flagged = skew_join(flagged, side, column, "left", left_counts=counts)
    unknown1 = F.col("key1").isNull() | (F.coalesce("_in1", F.lit(False)) != found)
    unknown2 = F.col("key2").isNull() | (F.coalesce("_in2", F.lit(False)) != found)
    reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(unknown1, F.lit(KEY1_NOT_FOUND))
        .when(unknown2, F.lit(KEY2_NOT_FOUND))
    )
    return flagged.withColumn("reject_reason", reason).select(*columns)


def validate_relations(
    relations: DataFrame,
    vertices: DataFrame,
    default_time: Column | int | None = None,
    last_index: int = KEY2_INDEX,
) -> DataFrame:
    """-> key1, key2, time_ms, raw, reject_reason; the reason is NULL for a good record.

    A time that does not parse becomes `default_time` (epoch ms), the current time if not given.
    """
    if default_time is None:
        default_time = F.unix_millis(F.current_timestamp())
    elif not isinstance(default_time, Column):
        default_time = F.lit(default_time)
    records = mark_short_lines(relations, last_index).select(
        "key1",
        "key2",
        F.coalesce(parse_millis(F.col("time_text")), default_time.cast("bigint")).alias("time_ms"),
        "raw",
        "reject_reason",
    )
    return mark_unknown_endpoints(records, vertices)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull())


def load_report(validated: DataFrame, times: int = 100) -> DataFrame:
    """Counters of one load: bad_lines, committed_edges. One aggregate, so retries do not count twice."""
    bad = F.count_if(F.col("reject_reason").isNotNull())
    good = F.count_if(F.col("reject_reason").isNull())
    return validated.agg(bad.alias("bad_lines"), (good * times).alias("committed_edges"))


def reject_counts(validated: DataFrame) -> DataFrame:
    return rejected(validated).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def canonical_edges(relations: DataFrame, sep: str = RELATION_SEP, half: int = HALF_FIELDS) -> DataFrame:
    """-> k1, k2, time, raw with k1 <= k2; a line is rebuilt with its halves swapped unless key1 < key2.

    Lines of fewer than two whole halves are left to `canonical_rejects`. What a wider line has
    beyond them stays with its second half. `time` stays the time of the original line.
    """
    keep = F.col("key1") < F.col("key2")
    swapped = F.array_join(
        F.concat(
            F.slice("fields", F.lit(half + 1), F.greatest(F.size("fields"), F.lit(1))),
            F.slice("fields", 1, half),
        ),
        sep,
    )
    return select_where(
        relations,
        F.coalesce(F.size("fields") >= 2 * half, F.lit(False)),
        F.least("key1", "key2").alias("k1"),
        F.greatest("key1", "key2").alias("k2"),
        F.col("time_text").alias("time"),
        F.when(keep, F.col("raw")).otherwise(swapped).alias("raw"),
    )


def canonical_rejects(relations: DataFrame, half: int = HALF_FIELDS) -> DataFrame:
    """-> raw, reject_reason: the lines that `canonical_edges` leaves out, NULL lines too."""
    return select_where(
        relations,
        F.coalesce(F.size("fields") < 2 * half, F.lit(True)),
        "raw",
        F.lit(NOT_ENOUGH_FIELDS).alias("reject_reason"),
    )


def sort_edges(canonical: DataFrame) -> DataFrame:
    """All records in the order of (k1, k2, time), duplicates kept.

    The line and the map partition break ties, so that the ranges can also cut a run of records
    with one key, or of exact copies, which one task would otherwise have to sort alone.
    """
    columns = ["k1", "k2", "time", "raw"]
    placed = canonical.withColumn("_part", F.spark_partition_id())
    return placed.orderBy(*columns, "_part").select(*columns)


def sort_duplicates(canonical: DataFrame) -> DataFrame:
    """-> duplicated: records beyond the first of each (k1, k2, time)."""
    groups = canonical.groupBy("k1", "k2", "time").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicated"))


def unique_edges(canonical: DataFrame) -> DataFrame:
    """The smallest line of each (k1, k2, time). A min combines on the map side; a window would not."""
    return canonical.groupBy("k1", "k2", "time").agg(F.min("raw").alias("raw"))


def raw_edges(valid: DataFrame, label: str, times: int = 100) -> DataFrame:
    """-> src, dst, label, time, value: `times` edges per record, one second apart."""
    return valid.select(
        F.col("key1").alias("src"),
        F.col("key2").alias("dst"),
        F.lit(label).alias("label"),
        F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("_i"),
        "time_ms",
        F.col("raw").alias("value"),
    ).select("src", "dst", "label", (F.col("time_ms") + F.col("_i") * 1000).alias("time"), "value")


def edge_id(key1: Column, key2: Column, label: Column) -> Column:
    """The id of the summary edge between two keys, whichever comes first; NULL if an end is.

    A separator within a key is escaped, so that different pairs never share an id.
    """

    def escaped(key: Column) -> Column:
        return F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))

    both = key1.isNotNull() & key2.isNotNull()
    low, high = escaped(F.least(key1, key2)), escaped(F.greatest(key1, key2))
    return F.when(both, F.concat_ws(":", low, high, label))


def summary_edges(valid: DataFrame, label: str, existing: DataFrame | None = None) -> DataFrame:
    """-> edge_id, src, dst, label: one edge per unordered pair, directed as its first record.

    `existing` summary edges are kept; only pairs without one get a new edge.
    """
    first = F.min(F.struct("time_ms", "raw", "key1", "key2")).alias("_first")
    created = (
        valid.groupBy(edge_id(F.col("key1"), F.col("key2"), F.lit(label)).alias("edge_id"))
        .agg(first)
        .select(
            "edge_id",
            F.col("_first.key1").alias("src"),
            F.col("_first.key2").alias("dst"),
            F.lit(label).alias("label"),
        )
    )
    if existing is None:
        return created
    ids = existing.select("edge_id")
    return existing.select("edge_id", "src", "dst", "label").unionByName(
        created.join(ids, "edge_id", "left_anti")
    )


def pair_events(valid: DataFrame, label: str, times: int = 100) -> DataFrame:
    """-> edge_id, time, value: `times` detail rows per record, one millisecond apart.

    Records that hit the same (edge_id, time) leave one row, the greatest value. Records of one
    time are collapsed first; then each goes to the one or two windows of `times` ms that it
    reaches, and the fan-out happens inside a window, after the shuffle. So a record moves at most
    three times in all, not `times` times, and a window lists fewer than 2 * `times` records
    however hot the pair is.
    """
    base = (
        valid.select(
            edge_id(F.col("key1"), F.col("key2"), F.lit(label)).alias("edge_id"),
            F.col("time_ms").alias("start"),
            "raw",
        )
        .groupBy("edge_id", "start")
        .agg(F.max("raw").alias("value"))
    )
    if times == 1:
        return base.select("edge_id", F.col("start").alias("time"), "value")
    last = times - 1
    first_window = F.floor(F.col("start") / times)
    last_window = F.floor((F.col("start") + last) / times)
    windows = (
        base.withColumn("_window", F.explode(F.sequence(first_window, last_window)))
        .groupBy("edge_id", "_window")
        .agg(
            F.collect_list(F.struct("start", "value")).alias("_records"),
            F.min("start").alias("_min"),
            F.max("start").alias("_max"),
        )
    )
    window_start = F.col("_window") * times
    span = F.sequence(
        F.greatest(F.col("_min"), window_start), F.least(F.col("_max") + last, window_start + last)
    )

    def covers(record: Column) -> Column:
        return (F.col("time") - record["start"]).between(0, last)

    # A window of one record, the usual case, needs no comparison of records.
    alone = F.size("_records") == 1
    covering = F.transform(F.filter("_records", covers), lambda record: record["value"])
    return (
        windows.withColumn("time", F.explode(span))
        .filter(alone | F.exists("_records", covers))
        .select(
            "edge_id",
            "time",
            F.when(alone, F.get("_records", F.lit(0))["value"])
            .otherwise(F.array_max(covering))
            .alias("value"),
        )
    )


def event_spans(valid: DataFrame, label: str, times: int = 100) -> DataFrame:
    """-> edge_id, n, first_time, last_time: how many `pair_events` an edge has, their first and last.

    The rows of one record fill a window of `times` ms from its start to the window's end, and the next
    window up to some place. So the least start in a window and the greatest in the one before tell
    how many of its ms are taken, and neither values nor detail rows have to be made.
    """
    starts = valid.filter(F.col("time_ms").isNotNull()).select(
        edge_id(F.col("key1"), F.col("key2"), F.lit(label)).alias("edge_id"),
        F.col("time_ms").alias("start"),
    )
    begin = F.col("start") - F.pmod("start", F.lit(times))
    none = F.lit(None).cast("bigint")
    own = F.struct(begin.alias("begin"), F.col("start").alias("inside"), none.alias("before"))
    rest = F.struct((begin + times).alias("begin"), none.alias("inside"), F.col("start").alias("before"))
    reached = F.when(begin == F.col("start"), F.array(own)).otherwise(F.array(own, rest))
    windows = (
        starts.select("edge_id", F.inline(reached))
        .groupBy("edge_id", "begin")
        .agg(
            F.min("inside").alias("least"),
            F.max("inside").alias("greatest"),
            F.max("before").alias("before"),
        )
    )
    upper = F.coalesce(F.col("begin") + times - F.col("least"), F.lit(0))
    lower = F.coalesce(F.col("before") + times - F.col("begin"), F.lit(0))
    return windows.groupBy("edge_id").agg(
        F.sum(F.least(F.lit(times), upper + lower)).alias("n"),
        F.min("least").alias("first_time"),
        (F.max("greatest") + times - 1).alias("last_time"),
    )


def row_keyed(events: DataFrame) -> DataFrame:
    """Detail rows as cells: row_key `edgeId_time`, family `f`, qualifier `c`."""
    return events.select(
        F.concat_ws("_", "edge_id", "time").alias("row_key"),
        F.lit("f").alias("family"),
        F.lit("c").alias("qualifier"),
        "value",
    )


def load_vertices(
    existing: DataFrame, incoming: DataFrame, label: str = "person", order_cols: list[str] | None = None
) -> DataFrame:
    """Add the vertices whose key is new; of several with one key the first by `order_cols`.

    `order_cols` defaults to all columns, a map compared by its sorted entries.
    """
    columns = [c for c in incoming.columns if c != "label"]
    order = order_cols or [
        F.array_sort(F.map_entries(c)).alias(c) if kind.startswith("map<") else F.col(c)
        for c, kind in incoming.dtypes
        if c != "label"
    ]
    present = only_listed(existing.select("key"), incoming, "key").distinct()
    fresh = (
        incoming.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
        .select("_first.*")
        .join(present, "key", "left_anti")
        .withColumn("label", F.lit(label))
    )
    return existing.unionByName(fresh, allowMissingColumns=True)


def vertex_load_report(parsed: DataFrame, existing: DataFrame) -> DataFrame:
    """-> bad_lines, skipped_lines, loaded for parsed vertex lines (`key`, `reject_reason`)."""
    bad = F.count_if(F.col("reject_reason").isNotNull())
    good = F.count_if(F.col("reject_reason").isNull())
    per_key = parsed.groupBy("key").agg(bad.alias("bad"), good.alias("good"))
    present = only_listed(existing.select("key"), parsed, "key").distinct()
    known = present.withColumn("_known", F.lit(True))
    new = (F.col("good") > 0) & F.col("_known").isNull() & F.col("key").isNotNull()
    totals = per_key.join(known, "key", "left").agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_lines"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("_good"),
        F.count_if(new).alias("loaded"),
    )
    return totals.select("bad_lines", (F.col("_good") - F.col("loaded")).alias("skipped_lines"), "loaded")
