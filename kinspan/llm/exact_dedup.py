"""Exact dedup by minimal perfect hashing of the digests that history holds.

History's distinct SHA-256 digests are dealt into shards of bounded size. Each shard gets a minimal
perfect hash: a seed per bucket of digests, largest buckets first, so that every digest has a slot
of its own and no slot stays empty. A slot holds the full digest, the document that wins and the
number of documents. A look-up compares all 32 bytes at the one slot a digest can have; digests
that are not there group among themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.llm.tables import stored
from kinspan.llm.words import mix

SHARD_DIGESTS = 32_768
TRIES = 64

INDEX = "shard int, seeds binary, digests binary, winners array<bigint>, sizes array<bigint>"
GROUPS = "digest binary, keep_id bigint, group_size bigint, known boolean"


def digest(text: str = "text") -> Column:
    """SHA-256 of the whole text in UTF-8, 32 bytes; a null text counts as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return F.unhex(F.sha2(whole, 256))


def _parts(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit values of each digest: one for its bucket, one for its slot."""
    values = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
    return values[:, 1], values[:, 2]


def _slots(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    tried = mix(keys ^ mix(seeds.astype(np.uint64) + np.uint64(1)))
    return (tried % np.uint64(n)).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of a minimal perfect hash of n distinct digests (n x 32 bytes), and their slots.

    A seed from 0 on is tried by hashing; a negative one names the slot of a bucket's only digest.
    """
    n = len(digests)
    buckets = max(1, -(-n // 4))
    bucket_of, key = _parts(digests)
    bucket = (bucket_of % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(sizes)
    seeds, slots, free = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[ends[b] - sizes[b] : ends[b]]
        if len(members) < 2:
            break
        first = 0
        while True:
            tried = _slots(key[members][:, None], np.arange(first, first + TRIES)[None, :], n)
            good = free[tried].all(0)
            for seed in np.flatnonzero(good):
                if len(set(tried[:, seed].tolist())) == len(members):
                    break
            else:
                first += TRIES
                continue
            seeds[b], slots[members] = first + seed, tried[:, seed]
            free[tried[:, seed]] = False
            break
    single = np.flatnonzero(sizes == 1)
    slots[order[ends[single] - 1]] = left = np.flatnonzero(free)
    seeds[single] = -1 - left
    return seeds, slots


def slots_of(digests: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """The one slot of n at which each digest can be."""
    bucket_of, key = _parts(digests)
    seed = seeds[(bucket_of % np.uint64(len(seeds))).astype(np.int64)]
    return np.where(seed < 0, -1 - seed, _slots(key, np.maximum(seed, 0), n))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    digests = _matrix(rows["digest"])
    seeds, slots = perfect_hash(digests)
    order = np.argsort(slots)
    pick = pa.array(order)
    row = {
        "shard": pa.array([key[0].as_py()], pa.int32()),
        "seeds": pa.array([seeds.astype("<i8").tobytes()], pa.binary()),
        "digests": pa.array([digests[order].tobytes()], pa.binary()),
        "winners": pa.array([rows["keep_id"].take(pick).to_pylist()], pa.list_(pa.int64())),
        "sizes": pa.array([rows["group_size"].take(pick).to_pylist()], pa.list_(pa.int64())),
    }
    return pa.table(row)


def _look_up(rows: pa.Table, index: pa.Table) -> pa.Table:
    fresh = _matrix(rows["digest"])
    keep = np.array([-1 if k is None else k for k in rows["keep_id"].to_pylist()], np.int64)
    null = np.array([k is None for k in rows["keep_id"].to_pylist()], bool)
    size = rows["group_size"].to_numpy().astype(np.int64)
    known = np.zeros(len(fresh), bool)
    if index.num_rows:
        held = np.frombuffer(index["digests"][0].as_py(), np.uint8).reshape(-1, 32)
        seeds = np.frombuffer(index["seeds"][0].as_py(), "<i8")
        winners = index["winners"][0].as_py()
        old = np.array([-1 if k is None else k for k in winners], np.int64)
        old_null = np.array([k is None for k in winners], bool)
        old_size = np.array(index["sizes"][0].as_py(), np.int64)
        if len(fresh):
            slot = slots_of(fresh, seeds, len(held))
            known = (held[slot] == fresh).all(1)
            hit = slot[known]
            here, there = keep[known], old[hit]
            better = old_null[hit] | (~null[known] & (here > there))
            old[hit] = np.where(better, here, there)
            old_null[hit] &= null[known]
            old_size[hit] += size[known]
        fresh = np.concatenate([held, fresh[~known]])
        keep, null = np.concatenate([old, keep[~known]]), np.concatenate([old_null, null[~known]])
        size = np.concatenate([old_size, size[~known]])
        known = np.arange(len(fresh)) < len(held)
    return pa.table(
        {
            "digest": pa.array([d.tobytes() for d in fresh], pa.binary()),
            "keep_id": pa.array(keep, mask=null),
            "group_size": pa.array(size),
            "known": pa.array(known),
        }
    )


def digest_groups(digests: DataFrame) -> DataFrame:
    """digest, doc_id, n -> digest, keep_id (the largest doc_id), group_size: summed map-side."""
    return digests.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")
    )


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def history_index(groups: DataFrame, shards: int) -> DataFrame:
    """A row per shard with the seeds and slots of a minimal perfect hash of the groups' digests."""
    return groups.select("*", _shard(shards)).groupBy("shard").applyInArrow(_build, INDEX)


def merge_groups(groups: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Look `groups` up in `index` -> digest, keep_id, group_size over both, known: all digests."""
    fresh = groups.select("*", _shard(shards)).groupBy("shard")
    return fresh.cogroup(index.groupBy("shard")).applyInArrow(_look_up, GROUPS)


def text_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """-> digest, doc_id, n (rows with both alike): what dedup needs of the documents."""
    narrow = docs.select(digest(text).alias("digest"), docs[doc_id].cast("long").alias("doc_id"))
    return narrow.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def exact_groups(
    fresh: DataFrame, history: DataFrame, shard_digests: int = SHARD_DIGESTS
) -> DataFrame:
    """Groups over two lots of digest, doc_id, n: `fresh` is looked up in an index of `history`.

    -> digest, keep_id, group_size, known (whether history has the digest). The number of shards
    follows the larger lot, so that neither gets long ones. Stored in the shared folder.
    """
    new = stored(digest_groups(fresh), "fresh-digests")
    old = stored(digest_groups(history), "known-digests")
    shards = 1 + max(new.count(), old.count()) // shard_digests
    index = stored(history_index(old, shards), "digest-index")
    return stored(merge_groups(new, index, shards), "digest-groups")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """-> doc_id, keep_id, group_size, kept, text_sha256: one row per row of `docs`.

    Texts are equal when their bytes are, null texts and empty ones alike. The row with the largest
    doc_id stays; of rows that repeat it one does. A null id loses to any other and stays only
    where a group has no other (then keep_id is null). The lower half of the range of ids is taken
    as history and the rest as new arrivals; which half a document is in does not change the
    result. Other columns are not read.
    """
    digests = stored(text_digests(docs, text, doc_id), "digests")
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    arrived = F.col("doc_id") > F.lit(0 if low is None else (low + high) // 2)
    groups = exact_groups(
        digests.filter(arrived), digests.filter(~arrived | F.col("doc_id").isNull())
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")
    return (
        digests.join(groups, "digest")
        .select("doc_id", "keep_id", "group_size", "digest", copies)
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
