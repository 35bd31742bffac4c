"""Merkle fixity audit of WARC replicas.

Records are hashed, together with where they stand; the records of a range of offsets make a leaf
and FANOUT nodes a parent, up to one root per file. Replicas are compared root by root, and only
below nodes that differ is anything looked at, down to the records that are damaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinspan.llm.tables import stored

RANGE = 1 << 16
FANOUT = 16
FILE_PAGES = 1000


def warc_records(pages: DataFrame, file_pages: int = FILE_PAGES) -> DataFrame:
    """page_id, url, html -> file, page_id, record: pages as WARC response records.

    A file holds the pages of `file_pages` consecutive ids. Null urls and texts count as empty;
    pages without an id are dealt by their url to files with numbers below zero.
    """
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    url = F.coalesce(pages["url"].cast("string"), F.lit(""))
    page = pages["page_id"].cast("long")
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    )
    nameless = -1 - F.pmod(F.xxhash64(url), F.lit(1024))
    file = F.coalesce(F.floor(page / file_pages), nameless).cast("long")
    return pages.select(
        file.alias("file"), page.alias("page_id"), record.cast("binary").alias("record")
    )


def in_files(records: DataFrame) -> DataFrame:
    """file, page_id, record -> file, offset, length, page_id, sha256 of the record's bytes.

    Records stand in their file by page_id, then sha256, without gaps. They are hashed where they
    are read; only the hashes move.
    """
    hashed = records.select(
        "file",
        "page_id",
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("sha256"),
    )
    earlier = Window.partitionBy("file").orderBy("page_id", "sha256")
    before = F.sum("length").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(before, F.lit(0)).cast("long").alias("offset")
    return hashed.select("file", offset, "length", "page_id", "sha256")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Uncompressed WARC files -> path, offset, length, record (bytes); files are read whole.

    A record runs from its version line over its headers and Content-Length bytes to the blank
    lines that close it. Bytes that are no record, such as a damaged tail, are one record.
    """

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                rows, at = [], 0
                while at < len(content):
                    end = _record_end(content, at)
                    rows.append((name, at, end - at, content[at:end]))
                    at = end
                yield pd.DataFrame(rows, columns=["path", "offset", "length", "record"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(split, "path string, offset long, length long, record binary")


def _record_end(content: bytes, at: int) -> int:
    head = content.find(b"\r\n\r\n", at)
    if not content.startswith(b"WARC/", at) or head < 0:
        return len(content)
    for line in content[at:head].split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return min(len(content), head + 8 + int(value))
    return len(content)


def record_digests(placed: DataFrame) -> DataFrame:
    """file, offset, length, page_id, sha256 -> the same and digest.

    The digest is over offset, length and hash, so a record in another place is another one.
    """
    place = F.concat_ws(":", "offset", "length", "sha256")
    return placed.select("file", "offset", "length", "page_id", "sha256", F.sha2(place, 256).alias("digest"))


def merkle_tree(digests: DataFrame, height: int, span: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """-> file, level, node, digest: leaves are ranges of `span` bytes, level 0, `height` is the root's.

    A node hashes its children in order, with their numbers; no node gathers more than the records
    of a range or `fanout` children.
    """
    level = digests.withColumns({"node": F.floor(F.col("offset") / span), "child": F.col("offset")})
    levels = None
    for number in range(height + 1):
        parts = F.array_join(
            F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("child").cast("string"), 20, "0"), "digest"))),
            ",",
        )
        nodes = level.groupBy("file", "node").agg(F.sha2(parts, 256).alias("digest"))
        nodes = stored(nodes, "merkle")
        made = nodes.select("file", F.lit(number).alias("level"), "node", "digest")
        levels = made if levels is None else levels.unionByName(made)
        level = nodes.select(
            "file", F.floor(F.col("node") / fanout).alias("node"), F.col("node").alias("child"), "digest"
        )
    return levels


def tree_height(*replicas: DataFrame, span: int = RANGE, fanout: int = FANOUT) -> int:
    """The level at which the longest file of any replica has one node."""
    ends = [r.agg(F.max("offset")).first()[0] or 0 for r in replicas]
    nodes, height = max(ends) // span, 0
    while nodes:
        nodes, height = nodes // fanout, height + 1
    return height


def audit(first: DataFrame, second: DataFrame, span: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """Two replicas (as of record_digests) -> file, offset, length, page_id, status.

    A row per record in which the replicas differ: `changed` (another content of the same page),
    `missing` (only in the first) or `extra` (only in the second); offset and length are those of the
    first replica where it has the record. Files that one replica lacks are missing or extra in full.
    Records at the same place of the same file count as one, the one with the least digest.

    A record lost, put in or lengthened moves all later ones of its file, so within ranges that
    differ records are matched by their content first, wherever they stand in the file; what is left
    is matched by page, then by place. Of records alike in content, or of one page, the first meet
    the first. Records without a page id are matched like those of one page.
    """
    unique = []
    for replica in (first, second):
        least = F.min(F.struct("digest", "length", "page_id", "sha256")).alias("r")
        unique.append(stored(replica.groupBy("file", "offset").agg(least).select("file", "offset", "r.*"), "records"))
    height = tree_height(*unique, span=span, fanout=fanout)
    trees = [merkle_tree(r, height, span, fanout) for r in unique]
    differing = None
    for level in range(height, -1, -1):
        sides = []
        for tree, name in zip(trees, ("one", "two"), strict=True):
            side = tree.filter(F.col("level") == level).select("file", "node", F.col("digest").alias(name))
            if differing is not None:
                up = side.withColumn("parent", F.floor(F.col("node") / fanout))
                side = up.join(differing, ["file", "parent"], "left_semi").select("file", "node", name)
            sides.append(side)
        met = sides[0].join(sides[1], ["file", "node"], "full")
        unlike = met.filter(~F.col("one").eqNullSafe(F.col("two")))
        differing = stored(unlike.select("file", F.col("node").alias("parent")), "differing")
    left = [
        stored(
            replica.withColumn("parent", F.floor(F.col("offset") / span)).join(
                differing, ["file", "parent"], "left_semi"
            ).select("file", "offset", "length", "page_id", "sha256"),
            "suspects",
        )
        for replica in unique
    ]
    left = _unmatched(*left, [F.col("sha256")])
    paired, left = _matched(*left, [F.isnull("page_id"), F.coalesce("page_id", F.lit(0))])
    placed, left = _matched(*left, [F.col("offset")])
    columns = ["file", "offset", "length", "page_id"]
    found = paired.unionByName(placed).select(*columns, F.lit("changed").alias("status"))
    for rest, status in zip(left, ("missing", "extra"), strict=True):
        found = found.unionByName(rest.select(*columns, F.lit(status).alias("status")))
    return found


def _counted(records: DataFrame, by: list[Column]) -> DataFrame:
    """`records` with _by, what they are matched by, and _nth, their number among those of a file alike in it."""
    key = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(by)))
    keyed = records.withColumn("_by", key)
    return keyed.withColumn("_nth", F.row_number().over(Window.partitionBy("file", "_by").orderBy("offset")))


def _unmatched(one: DataFrame, two: DataFrame, by: list[Column]) -> list[DataFrame]:
    """What is left of two sides without the records that match."""
    sides, columns = [_counted(s, by) for s in (one, two)], one.columns
    on = ["file", "_by", "_nth"]
    pairs = [(sides[0], sides[1]), (sides[1], sides[0])]
    return [stored(a.join(b.select(*on), on, "left_anti").select(*columns), "unmatched") for a, b in pairs]


def _matched(one: DataFrame, two: DataFrame, by: list[Column]) -> tuple[DataFrame, list[DataFrame]]:
    """-> the first side of the records that match, and what is left of both sides."""
    sides, on = [_counted(s, by) for s in (one, two)], ["file", "_by", "_nth"]
    met = sides[0].join(sides[1].select(*on), on, "left_semi").select(*one.columns)
    return stored(met, "matched"), _unmatched(one, two, by)
