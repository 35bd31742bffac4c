"""Tables stored by a key, so that a lookup neither shuffles them nor reads all of them.

Rows are bucketed by the hash of their key and sorted within buckets. A short key list is put into
the scan as literals: Spark then opens only the buckets and row groups that can hold these keys. A
list that was counted small is broadcast; a longer one is shuffled to the buckets, and the table
stays where it is. Keys of very many rows would make one bucket too large for a task, so their
rows are stored apart, in ranges, and joined by a broadcast or a salted join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.operators import skew
from kinspan.operators.skew import fits_broadcast, key_counts, lookup_join, skew_join

LITERAL_KEYS = 500  # keys of a list that go into the scan as literals


@dataclass(frozen=True)
class KeyedTable:
    """A stored table: buckets of most rows, and the rows of hot keys."""

    path: str
    key: str
    sort: tuple[str, ...]
    buckets: int
    schema: str
    name: str

    def _cold(self, spark: SparkSession) -> DataFrame:
        if not spark.catalog.tableExists(self.name):
            by, order = f"`{self.key}`", ", ".join(f"`{c}`" for c in self.sort)
            spark.sql(
                f"CREATE TABLE {self.name} ({self.schema}) USING parquet"
                f" CLUSTERED BY ({by}) SORTED BY ({order}) INTO {self.buckets} BUCKETS"
                f" LOCATION '{self.path}/cold'"
            )
        return spark.table(self.name)

    def _hot(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/hot")

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows."""
        return self._cold(spark).unionByName(self._hot(spark))

    def matching(self, listed: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows whose key is listed, with the further columns of `listed`, which has a row per key.

        `columns` of the table are read and no others. The list is counted when this is called.
        """
        spark = listed.sparkSession
        columns = list(columns) if columns is not None else self._cold(spark).columns
        cold = self._cold(spark).select(self.key, *(c for c in columns if c != self.key))
        hot = self._hot(spark).select(*cold.columns)
        if fits_broadcast(listed):
            keys = [r[0] for r in listed.select(self.key).limit(LITERAL_KEYS + 1).collect()]
            if len(keys) <= LITERAL_KEYS:
                wanted = [k for k in keys if k is not None]
                cold, hot = (t.filter(F.col(self.key).isin(wanted)) for t in (cold, hot))
            found = cold.unionByName(hot)
            return found.join(F.broadcast(listed), self.key)
        # The list is dealt as the buckets are; with another number of tasks Spark would deal both anew.
        dealt = listed.repartition(self.buckets, self.key)
        return cold.join(dealt, self.key).unionByName(lookup_join(hot, listed, self.key))

    def counts(self, listed: DataFrame) -> DataFrame:
        """-> key, n: how many rows each listed key has, keys without any left out."""
        found = self.matching(listed.select(self.key), [self.key])
        return found.groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))


def store_keyed(
    df: DataFrame,
    path: str,
    key: str,
    sort: Sequence[str] = (),
    buckets: int | None = None,
    hot_rows: int | None = None,
) -> KeyedTable:
    """Write `df` as a keyed table to a new folder `path`, sorted by the key and then `sort`.

    Without `buckets` there are as many as the session has shuffle partitions. Keys of more than
    `hot_rows` rows (HOT_ROWS of the skew joins) are hot. Rows without a key are kept, though no list
    finds them. The layout is written beside the rows, so `open_keyed` finds it in another session.
    `df` is run once: its rows are written, counted and dealt from there, and stay beside the table.
    """
    spark = df.sparkSession
    hot_rows = skew.HOT_ROWS if hot_rows is None else hot_rows
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [key, *(c for c in sort if c != key)]
    df = _written(df, f"{path}/unsorted")
    counts = key_counts(df, [key]).filter((F.col("_rows") > hot_rows) | F.col(key).isNull())
    keys = _written(counts.select(key), f"{path}/hot_keys")
    known = keys.filter(F.col(key).isNotNull())
    hot, cold = df.filter(F.col(key).isNull()), df
    if keys.isEmpty():
        hot = spark.createDataFrame([], df.schema)
    elif known.isEmpty():
        cold = df.filter(F.col(key).isNotNull())
    else:
        flag = known.withColumn("_hot", F.lit(True))
        if fits_broadcast(flag):
            marked = df.join(F.broadcast(flag), key, "left")
        else:
            marked = skew_join(df, flag, key, "left", hot_rows)
        apart = F.coalesce("_hot", F.lit(False)) | F.col(key).isNull()
        hot = marked.filter(apart).select(*df.columns)
        cold = marked.filter(~apart).select(*df.columns)
    hot.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/hot")
    table = KeyedTable(path, key, tuple(order), buckets, _ddl(df), f"keyed_{uuid4().hex}")
    (
        cold.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(*order)
        .option("path", f"{path}/cold")
        .saveAsTable(table.name)
    )
    layout = [(table.key, list(table.sort), table.buckets, table.schema)]
    columns = "key string, sort array<string>, buckets int, schema string"
    spark.createDataFrame(layout, columns).coalesce(1).write.parquet(f"{path}/layout")
    return table


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_keyed(spark: SparkSession, path: str) -> KeyedTable:
    """A table that `store_keyed` wrote, in this session or another."""
    layout = spark.read.parquet(f"{path}/layout").first()
    name = f"keyed_{uuid4().hex}"
    return KeyedTable(path, layout.key, tuple(layout.sort), layout.buckets, layout.schema, name)
