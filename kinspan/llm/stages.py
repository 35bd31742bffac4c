"""Operators as filters of whole rows: which documents stay, with all their columns as they are.

A row is held as one struct while it is judged, so columns of any name come out untouched. A
null text counts as empty, texts are judged whole, however long, and of an empty table nothing
stays. Columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspan.llm.decontaminate import contaminated
from kinspan.llm.exact_dedup import digest, exact_dedup
from kinspan.llm.ngram_join import ngram_classes
from kinspan.llm.quality import score


def _field(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def held(docs: DataFrame, **keys: Column) -> DataFrame:
    """-> row, doc_id and `keys`: rows as structs, and what they are judged by."""
    row = F.struct(*(_field(c).alias(c) for c in docs.columns)).alias("row")
    return docs.select(row, docs["doc_id"].alias("doc_id"), *(k.alias(n) for n, k in keys.items()))


def keep_good(docs: DataFrame, model: np.ndarray, least: float = 0.5) -> DataFrame:
    """Rows whose text has a quality score of `least` or more.

    Each row is scored by itself: repeated rows and rows without an id stay or go alike. An empty
    text has the score of the model's bias.
    """
    rest = [c for c in docs.columns if c != "text"]
    parts = docs.select(F.struct(*(_field(c).alias(c) for c in rest)).alias("rest"), "text")
    kept = score(parts, model, "score").filter(F.col("score") >= least)
    columns = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return kept.select(*columns)


def keep_one_of_equal(docs: DataFrame) -> DataFrame:
    """Of equal texts the row with the largest id; of rows that repeat it, one, whichever.

    A row without an id stays only if its text is that of no row with one. Null and empty texts are
    equal to each other.
    """
    kept = exact_dedup(docs.select("doc_id", "text")).filter("kept")
    kept = kept.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    rows = held(docs, sha256=F.lower(F.hex(digest("text"))))
    same = (F.col("sha256") == F.col("sha")) & F.col("doc_id").eqNullSafe(F.col("id"))
    staying = rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "sha256"])
    return staying.select("row.*")


def _by_text(docs: DataFrame) -> DataFrame:
    """Rows with `key`, a hash of the text, as ids may be null or repeated, and the text."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return held(docs, key=F.xxhash64(text), text=text)


def keep_one_of_near(docs: DataFrame) -> DataFrame:
    """Of each class of linked documents the one with the smallest id.

    Rows without an id come last, and of rows that share an id the smallest hash of the text comes
    first. Rows alike in id and text stay or go together; texts without words stay.
    """
    keyed = _by_text(docs)
    classes = ngram_classes(keyed.select(F.col("key").alias("doc_id"), "text"))
    classes = classes.filter("n_ngrams > 0").groupBy(F.col("doc_id").alias("key"))
    classes = classes.agg(F.min("class_id").alias("class"))
    smallest = keyed.groupBy("key").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id")).alias("id"))
    first = classes.join(smallest, "key").groupBy("class")
    first = first.agg(F.min(F.struct("id", "key")).alias("first"))
    first = first.select(F.col("first.id.doc_id").alias("id"), F.col("first.key").alias("sign"))
    same = (F.col("key") == F.col("sign")) & F.col("doc_id").eqNullSafe(F.col("id"))
    worded = keyed.select("doc_id", "key", "text").filter(r"text rlike '[^\\t-\\r ]'")
    rest = worded.select("doc_id", "key").distinct().join(first, same, "left_anti")
    rest = rest.select(F.col("doc_id").alias("id"), F.col("key").alias("sign"))
    return keyed.join(rest, same, "left_anti").select("row.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows without a passage of the benchmark, judged by their text, whatever their id."""
    keyed = _by_text(docs)
    found = contaminated(keyed.select(F.col("key").alias("doc_id"), "text"), benchmark)
    found = found.select(F.col("doc_id").alias("key")).distinct()
    return keyed.join(found, "key", "left_anti").select("row.*")
