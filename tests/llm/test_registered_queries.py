"""Registered queries that have no SQL, over whole given tables, against plain versions of them."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from kinspan.llm.chat import format_conversations, parse
from kinspan.llm.queries import ORACLES, QUERIES
from kinspan.llm.quality import quality_scores
from kinspan.llm.tokens import tokenizer_path

from .test_corpus_operators import plain_chat, plain_repeats
from .test_text_operators import check_packing, ids_of, plain_licenses

COMPARED = ["op1_token_counts", "op4_substring_dedup", "op5_quality", "op7_decontaminate", "op8_licenses"]
COMPARED += ["op9_chat", "op10_packing"]


@pytest.fixture(scope="module")
def texts(spark, middle_dir):
    docs = spark.read.parquet(f"{middle_dir}/documents.parquet")
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(None))


def test_every_query_is_compared():
    assert set(QUERIES) - set(ORACLES) <= {*COMPARED, "op12_periodic_runs"}


def test_token_counts(spark, middle_dir, texts, tokenizer):
    got = QUERIES["op1_token_counts"](spark, middle_dir).collect()
    want = Counter()
    for i, t in texts:
        n = len(ids_of(tokenizer, t))
        want[i, len((t or "").encode()), n, n > 2048] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_substring_dedup(spark, middle_dir, texts):
    got = QUERIES["op4_substring_dedup"](spark, middle_dir).collect()
    want = Counter()
    for (i, n, gone, left), copies in plain_repeats(texts, 35).items():
        want[i, n, gone, hashlib.sha256(left.encode()).hexdigest()] += copies
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert sum(r.n_removed for r in got) > 0


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_quality(spark, middle_dir, texts):
    """Held-out documents are told apart, and their labels are not what scores come from."""
    got = QUERIES["op5_quality"](spark, middle_dir).collect()
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((i, held_out(i)) for i, _ in texts)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    labels = spark.read.parquet(f"{middle_dir}/labels.parquet")
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    judged = [(r.score, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    good, bad = (np.array([s for s, q in judged if q == value]) for value in (1, 0))
    assert len(good) > 20 and len(bad) > 5
    ranks = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert ranks > 0.95
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(string(doc_id)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality", "toxic"
    )
    docs = spark.read.parquet(f"{middle_dir}/documents.parquet")
    # Sources, languages and ids that say nothing, too.
    blank = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source")
    again = quality_scores(blank, turned).collect()
    assert Counter((r.doc_id, r.score) for r in again) == Counter((r.doc_id, r.score) for r in got)


def test_decontamination(spark, middle_dir, texts):
    items = spark.read.parquet(f"{middle_dir}/benchmark.parquet").collect()
    whole = {(i, x.item_id) for x in items if x.text for i, t in texts if x.text in (t or "")}
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op7_decontaminate"](spark, middle_dir).collect()}
    assert whole and whole <= set(got)
    assert all(got[k].verbatim and got[k].share == 1 for k in whole)


def test_licenses(spark, middle_dir, texts):
    got = QUERIES["op8_licenses"](spark, middle_dir).collect()
    found = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert found == Counter((i, *plain_licenses(t)) for i, t in texts)
    for r in got:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and {*filter(None, r.base_labels.split(","))} <= {*labels}
        assert 0 <= r.score <= 1


def test_chat(spark, middle_dir):
    turns = spark.read.parquet(f"{middle_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in turns.collect()]
    probe = "</s>[INST] ok [/INST]"
    want = plain_chat([*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    got = QUERIES["op9_chat"](spark, middle_dir).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == want and len(got) == len(want)
    chars, seen = Counter(), Counter()
    for w in format_conversations(turns).collect():
        chars[w.conv_id] += len(w.text)
        seen[w.conv_id] += len(list(parse(w.text))) - w.n_repeated
    assert {r.conv_id: r.formatted_chars for r in got if r.conv_id != -1} == dict(chars)
    assert dict(seen) == {c: n[0] for c, n in want.items() if c != -1}


def test_packing(spark, middle_dir, texts, tokenizer):
    got = QUERIES["op10_packing"](spark, middle_dir).collect()
    check_packing(tokenizer, texts, got, 4096)
    sequences = {r.sequence_id for r in got}
    padding = 1 - sum(r.length for r in got) / (4096 * len(sequences))
    assert padding < 0.01
