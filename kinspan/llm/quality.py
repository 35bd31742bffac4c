"""Quality classifier: vectors of hashed words and character n-grams, averaged per document.

A document is the mean of the learned vectors of its words, of the character n-grams within them
and of a mark for each pair of neighbouring words (alike or not); a softmax over two classes
follows. Vectors and output layer are trained by stochastic gradient descent in numpy on a sample
of bounded size. As the output is linear in the vectors, a trained model is one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspan.llm.words import mix, ragged, row_slices, text_bytes, word_bounds, word_hashes

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4)
EPOCHS = 6
LEAST_STEPS = 750  # small samples are gone over more often
RATE = 40.0
BATCH = 32
SAMPLE_ROWS = 4000  # labelled rows to learn from at most, half of them of each class

_ALIKE, _UNLIKE = 0, 1  # buckets of the marks for pairs; all others are hashed to


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS - 2)).astype(np.int64) + 2


def word_features(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """-> buckets of each word and of its character n-grams, word by word; how many each word has.

    N-grams are over code points, with a space before and after the word.
    """
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = ends - starts + 2
    at = ragged(starts - 1, lengths)
    padded = data[np.clip(at, 0, len(data) - 1)]
    last = np.cumsum(lengths) - 1
    padded[last] = padded[last - lengths + 1] = 32
    text = padded.tobytes().decode("utf-8", "replace")
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    word_of = (np.cumsum(codes == 32) - 1) // 2
    buckets, words = [_bucket(hashes)], [np.arange(len(starts))]
    for n in GRAMS:
        grams = max(0, len(codes) - n + 1)
        total = np.full(grams, n, np.uint64)
        for i in range(n):
            total = total * np.uint64(0x100000001B3) + codes[i : i + grams]
        inner = np.flatnonzero(word_of[:grams] == word_of[len(codes) - grams :])
        buckets.append(_bucket(mix(total[inner])))
        words.append(word_of[inner])
    word = np.concatenate(words)
    order = np.argsort(word, kind="stable")
    return np.concatenate(buckets)[order], np.bincount(word, minlength=len(starts))


def _words(data: np.ndarray, at: np.ndarray):
    """-> distinct words' bounds and hashes, number of each word, first word per text, pair marks."""
    starts, ends, first = word_bounds(data, at)
    hashes, one, number = np.unique(
        word_hashes(data, starts, ends), return_index=True, return_inverse=True
    )
    mark = np.full(len(starts), -1)  # for each word: is the next one of its text like it?
    if len(starts):
        mark[:-1] = np.where(number[1:] == number[:-1], _ALIKE, _UNLIKE)
        mark[first[1:][first[1:] > first[:-1]] - 1] = -1
    return starts[one], ends[one], hashes, number, first, mark


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of `values` over the ranges that begin at first[:-1] and end at first[1:]."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def document_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """-> bucket, weight (share of the document's features), first feature of each document."""
    data, at = text_bytes(column)
    buckets, weights, sizes = [], [], []
    for low, high in row_slices(at):
        part = _slice_features(data[at[low] : at[high]], at[low : high + 1] - at[low])
        for all_parts, one in zip((buckets, weights, sizes), part, strict=True):
            all_parts.append(one)
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return np.concatenate(buckets), np.concatenate(weights), first


def _slice_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, hashes, number, first, mark = _words(data, at)
    buckets, sizes = word_features(data, starts, ends, hashes)
    begins = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    per_word = sizes[number]
    flat = buckets[ragged(begins[number], per_word)]
    paired = mark >= 0
    keys = np.concatenate([np.repeat(row, per_word), row[paired]]) * BUCKETS
    keys += np.concatenate([flat, mark[paired]])
    found, counts = np.unique(keys, return_counts=True)
    row = found // BUCKETS
    total = np.bincount(row, counts, minlength=len(at) - 1)
    weights = (counts / total[row]).astype(np.float32)
    return (found % BUCKETS).astype(np.int32), weights, np.bincount(row, minlength=len(at) - 1)


def train(texts: pa.Array, labels: np.ndarray, seed: int = 1) -> np.ndarray:
    """Model of labelled texts: for each bucket what it adds to the logit, and last the bias.

    `labels` are 0 or 1. Gradient descent over batches with a falling rate; the same rows in the
    same order give the same model. Without rows of both classes every score is the rows' share
    of class 1 (one half if there are none).
    """
    labels = np.asarray(labels, np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        share = 0.5 if len(labels) == 0 else float(np.clip(labels[0], 0.01, 0.99))
        return np.append(np.zeros(BUCKETS), np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    out, bias = rng.uniform(-1, 1, (2, DIMENSIONS)) / DIMENSIONS, np.zeros(2)
    bucket, weight, first = document_features(texts)
    size = np.diff(first)
    batches = -(-len(labels) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    steps = epochs * batches
    step = 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(labels))
        for begin in range(0, len(labels), BATCH):
            docs = shuffled[begin : begin + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            at = ragged(first[docs], size[docs])
            doc = np.repeat(np.arange(len(docs)), size[docs])
            f, w = bucket[at], weight[at]
            hidden = np.zeros((len(docs), DIMENSIONS))
            np.add.at(hidden, doc, vectors[f] * w[:, None])
            logits = hidden @ out.T + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), labels[docs].astype(int)] -= 1
            p /= len(docs)
            back = p @ out
            out -= rate / 10 * p.T @ hidden
            bias -= rate / 100 * p.sum(0)
            np.add.at(vectors, f, -rate * w[:, None] * back[doc])
    return np.append(vectors @ (out[1] - out[0]), bias[1] - bias[0])


def scores(column: pa.Array, model: np.ndarray) -> np.ndarray:
    """Probability of class 1 for each text, empty and null ones too."""
    added = []
    data, at = text_bytes(column)
    for low, high in row_slices(at):
        part, bounds = data[at[low] : at[high]], at[low : high + 1] - at[low]
        starts, ends, hashes, number, first, mark = _words(part, bounds)
        buckets, sizes = word_features(part, starts, ends, hashes)
        per_word = np.add.reduceat(model[buckets], np.cumsum(sizes) - sizes) if len(sizes) else model[:0]
        paired = mark >= 0
        values = per_word[number] + np.where(paired, model[mark], 0.0)
        features = _sums(sizes[number] + paired, first)
        added.append(_sums(values, first) / np.maximum(features, 1))
    logit = np.concatenate(added) + model[-1] if added else np.zeros(0)
    return 1 / (1 + np.exp(-logit))


LEARNT = T.StructType([T.StructField("weights", T.BinaryType())])


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1):
    """Whether crc32 of the id as text, modulo `folds`, is `fold`; such rows are never learnt from."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(text), F.lit(folds)) == fold


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS
) -> DataFrame:
    """-> text, label: at most `rows` labelled documents that are not held out, half per class.

    Which ones is settled by a hash of the id. Labels that are null, not 0 or 1, without a
    document, or contradicted by another row for the same id are left out; of documents that share
    an id the one with the greatest text is taken.
    """
    clear = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .filter("label = other")
        .select("doc_id", "label", F.xxhash64("doc_id").alias("draw"))
    )
    picked = None
    for value in (0, 1):
        one = clear.filter(F.col("label") == value).orderBy("draw", "doc_id").limit(rows // 2)
        picked = one if picked is None else picked.unionByName(one)
    # At most `rows` short rows, so they may be broadcast.
    texts = docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return (
        texts.join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "label", "draw")
        .agg(F.max("text").alias("text"))
        .select("text", "label", "draw", "doc_id")
    )


def fit(sample: DataFrame) -> np.ndarray:
    """Train on a sample of bounded size, in one task; its model, one number per bucket, returns."""

    def learn(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        model = train(rows["text"].combine_chunks(), rows["label"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([model.astype("<f8").tobytes()])], ["weights"])

    ordered = sample.repartition(1).sortWithinPartitions("draw", "doc_id")
    found = ordered.select("text", "label").mapInArrow(_or_nothing(learn), LEARNT).collect()
    if not found:
        return train(pa.array([], pa.string()), np.zeros(0))
    return np.frombuffer(found[0][0], "<f8")


def _or_nothing(learn):
    """`learn` over the batches with rows, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = [b for b in batches if b.num_rows]
        if full:
            yield from learn(full)

    return run


def score(docs: DataFrame, model: np.ndarray, name: str = "score") -> DataFrame:
    """`docs` with a column `name`: the probability that its text is of class 1.

    Every row comes out, with all its columns. Null and empty texts have no features, so their
    score is that of the bias alone.
    """
    columns = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(np.asarray(model, "<f8"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rated = pa.array(scores(batch.column(len(columns)), sent.value))
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, rated], names=[*columns, name])

    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])
    return docs.select("*", docs["text"].cast("string").alias("_text_")).mapInArrow(rate, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """-> doc_id, held_out, score, predicted: one row per row of `docs`, learnt from `labels`.

    Learns from at most `rows` documents that are not held out. Repeated rows are scored each;
    a null id is a document like others. An empty `labels` gives every document a score of 0.5.
    """
    model = fit(labelled_sample(docs, labels, rows=rows))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
