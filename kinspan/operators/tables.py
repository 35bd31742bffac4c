"""Keyed tables, line bags and samples."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.functions.numbers import product_or_null, row_count
from kinspan.operators.skew import fits_broadcast, skew_join

# Alphabet of generated words (fixed value).
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


SKETCH_BITS = 14  # a sketch has 2 ** SKETCH_BITS registers
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
DIGITS = 3  # hexadecimal digits of a draw to a histogram
TIED_ROWS = 100_000  # rows that share the first digits of the last draw and are ordered in one task


def lookup_id(df: DataFrame, value: object, id_col: str = "id") -> DataFrame:
    """The rows with one id."""
    return df.filter(F.col(id_col) == value)


def lookup_ids(df: DataFrame, keys: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows whose id is in the key list, each once however often its id is listed."""
    wanted = keys.select(F.col(keys.columns[0]).alias(id_col))
    if fits_broadcast(wanted):
        return df.join(F.broadcast(wanted), id_col, "left_semi").select(*df.columns)
    return skew_join(df, wanted.distinct(), id_col, "left_semi").select(*df.columns)


def same_key(columns: Iterable[tuple[str, str]]) -> Column:
    """Whether each two columns are equal, null being equal to null."""
    return reduce(lambda x, y: x & y, (F.col(a).eqNullSafe(F.col(b)) for a, b in columns))


def upsert(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str
) -> DataFrame:
    """`base` (one row per key) with the last update of each key written over it or added.

    Of updates with one `order_col` the greatest row wins. A null key is a key like others, so it
    too comes out once. Base rows that no update touches are not shuffled when the updates are few.
    The updates' keys are counted when this is called.
    """
    keys, columns = list(keys), base.columns
    last = (
        updates.groupBy(*keys)
        .agg(F.max(F.struct(order_col, F.struct(*columns).alias("_row"))).alias("_last"))
        .select("_last._row.*")
    )
    touched = updates.select(*(F.col(k).alias(f"_touched{i}") for i, k in enumerate(keys)))
    touched = F.broadcast(touched) if fits_broadcast(touched) else touched.distinct()
    same = same_key((k, f"_touched{i}") for i, k in enumerate(keys))
    kept = base.join(touched, same, "left_anti")
    return kept.select(*columns).unionByName(last.select(*columns))


def event_type_counts(events: DataFrame) -> DataFrame:
    """-> event_type, n."""
    return events.groupBy("event_type").agg(row_count().alias("n"))


def line_counts(lines: DataFrame) -> DataFrame:
    """-> value, n: how often each whole line occurs."""
    return lines.groupBy("value").agg(row_count().alias("n"))


def _countable(df: DataFrame, column: str) -> Column:
    """A column with one value for each that DISTINCT tells apart: -0.0 is 0.0."""
    kind = dict(df.dtypes)[column]
    return F.col(column) + F.lit(0).cast(kind) if kind in ("float", "double") else F.col(column)


def cardinalities(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """-> col, ndv: exact number of distinct non-null values of each column.

    Values are typed until they are counted, so 0.0 and -0.0 are one; all NaN are one.
    """
    values = df.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("col"), _countable(df, c).cast("string").alias("value"))
                    for c in cols
                )
            )
        )
    )
    distinct = values.filter(F.col("value").isNotNull()).distinct()
    counted = distinct.groupBy("col").agg(row_count().alias("ndv"))
    named = df.sparkSession.createDataFrame([(c,) for c in cols], "col string")
    return named.join(counted, "col", "left").select("col", F.coalesce("ndv", F.lit(0)).alias("ndv"))


def file_sketches(df: DataFrame, cols: Sequence[str], log2_size: int = SKETCH_BITS) -> DataFrame:
    """-> file, rows and a sketch of the distinct values of each column, for every file of a scan.

    Sketches are HyperLogLog, some kilobytes each however many values there are, and combine on the
    map side. Stored beside a table they answer for any set of its files later on.
    """
    # The sketches take no doubles; their texts stand for them, as 0.0 and -0.0 are one value here.
    typed = {c: _countable(df, c) for c in cols}
    kinds = dict(df.dtypes)
    values = {
        c: v if kinds[c] in ("int", "bigint", "string", "binary") else v.cast("string")
        for c, v in typed.items()
    }
    placed = df.select(F.col("_metadata.file_path").alias("file"), *(v.alias(c) for c, v in values.items()))
    sketches = [F.hll_sketch_agg(c, F.lit(log2_size)).alias(c) for c in cols]
    return placed.groupBy("file").agg(row_count().alias("rows"), *sketches)


def united_cardinalities(sketches: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sketches of any files -> col, ndv (estimate), error: values in the union of the files.

    `error` is the relative error that two estimates in three stay within, and 99 in 100 within
    three times of it; it depends on the size of the sketches alone.
    """
    united = sketches.agg(
        *(F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in cols)
    )
    longs = united.unpivot([], list(cols), "col", "ndv")
    return longs.select("col", F.coalesce("ndv", F.lit(0)).alias("ndv"), F.lit(SKETCH_ERROR).alias("error"))


def cardinality_product(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """-> log10_product, product, capped_product of the columns' cardinalities.

    `product` is NULL where it passes 64 bits; `capped_product` never passes the row count.
    """
    per_column = cardinalities(df, cols).groupBy().pivot("col", list(cols)).agg(F.first("ndv"))
    ndvs = [F.col(f"`{c}`") for c in cols]
    product = reduce(product_or_null, ndvs)
    log10 = reduce(lambda x, y: x + y, (F.log10(n) for n in ndvs))
    both = per_column.select(log10.alias("log10_product"), product.alias("product")).unionByName(
        df.agg(row_count().alias("_row_count")), allowMissingColumns=True
    )
    return both.agg(*(F.max(c).alias(c) for c in both.columns)).select(
        "log10_product",
        "product",
        F.least(F.coalesce("product", "_row_count"), F.col("_row_count")).alias("capped_product"),
    )


def _nth_digits(draws: DataFrame, n: int) -> tuple[str, int, int]:
    """The digits with which the `n`-th smallest of the `_draw`s begins, found by histograms.

    Each round counts the draws by their next DIGITS hexadecimal digits, given those found before,
    until few enough share them. -> the digits, how many draws are below them, how many have them.
    """
    found, below, there = "", 0, 0
    while len(found) < 32:
        step = F.substring("_draw", len(found) + 1, DIGITS)
        counts = draws.filter(F.col("_draw").startswith(found)).groupBy(step.alias("d")).count()
        for digits, count in sorted(counts.collect()):  # 16 ** DIGITS rows at most
            if below + count >= n:
                found, there = found + digits, count
                break
            below += count
        else:
            return "g", below, 0  # fewer than n draws: all are below
        if there <= TIED_ROWS:
            break
    return found, below, there


def sample_lines(
    df: DataFrame, n: int, seed: int, id_cols: Sequence[str] | None = None
) -> DataFrame:
    """Exactly `n` rows (all, if there are fewer), drawn without replacement, in random order.

    The order is that of a hash of the seed and `id_cols`, so the draw repeats for a seed; rows that
    are equal in `id_cols` are drawn next to each other. Without `id_cols` equal rows are counted and
    numbered, so that each copy is drawn by itself; this shuffles the distinct rows.

    Where the draw ends is found by histograms when this is called, and what lies before it is
    ordered by ranges: no task gathers the rows, however large `n` is. Only rows that tie at the
    end, alike in the hash of `id_cols`, are cut by an order of their own.
    """
    columns = df.columns
    if id_cols is None:
        counted = df.groupBy(*columns).agg(row_count().alias("_copies"))
        df = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
        id_cols = [*columns, "_copy"]
    ids = [F.col(c).cast("string") for c in id_cols]
    draw = F.md5(F.concat_ws("\u0001", F.lit(str(seed)), *ids))
    drawn = df.withColumn("_draw", draw).select(*columns, "_draw")
    if n <= 0:
        return df.limit(0).select(*columns)
    end, below, there = _nth_digits(drawn.select("_draw"), n)
    whole = drawn.filter(F.col("_draw") < end)
    if below + there <= n:
        whole = drawn.filter((F.col("_draw") < end) | F.col("_draw").startswith(end))
    else:
        tied = drawn.filter(F.col("_draw").startswith(end)).orderBy("_draw", *columns)
        whole = whole.unionByName(tied.limit(n - below))
    return whole.orderBy("_draw", *columns).select(*columns)


def random_letters(df: DataFrame, id_col: str = "id", length: int = 100, seed: int = 0) -> DataFrame:
    """-> id, word: a word of random letters per id, the same for a seed wherever it is computed."""

    def letter(i: Column) -> Column:
        draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), i.cast("string")))
        number = F.conv(F.substring(draw, 1, 8), 16, 10).cast("bigint")
        return F.substr(F.lit(LETTERS), (number % len(LETTERS) + 1).cast("int"), F.lit(1))

    letters = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), letter)
    return df.select(F.col(id_col).alias("id"), F.array_join(letters, "").alias("word"))


def random_words(
    spark: SparkSession, start: int, end: int, length: int = 100, seed: int = 0
) -> DataFrame:
    """-> id, word for the ids from `start` up to, not including, `end`."""
    return random_letters(spark.range(start, end), "id", length, seed)
