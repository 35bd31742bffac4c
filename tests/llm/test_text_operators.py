"""Token counts, packing, quality, licenses and decontamination against plain versions of them."""

from __future__ import annotations

import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinspan.llm import decontaminate as D
from kinspan.llm import licenses as L
from kinspan.llm import packing as P
from kinspan.llm import quality as Q
from kinspan.llm.token_counts import token_counts
from kinspan.llm.tokens import PieceEncoder, balanced_pieces, tokenizer_path
from kinspan.llm.words import text_bytes

AWKWARD = (
    "a B é É 's 'S ' <|endoftext|> <|ENDOFTEXT|> <|startoftext|> <| |> *** ! . = 9 12 're re the"
    " don't!! x.y ñ Ñ Ö ø ÷ × ß ẞ İ ſ K 日本 한 € … 😀"
).split() + [" ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", " ", "​", "́", "̌", "̸", "J", "\0"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(None))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    draw = random.Random(7)
    texts = ["".join(draw.choices(AWKWARD, k=draw.randint(0, 14))) for _ in range(4000)]
    encode = PieceEncoder(cached=700)  # so small that it is cleared again and again
    for first in range(0, len(texts), 250):
        lot = texts[first : first + 250]
        sizes, starts, lengths = encode.encode(pa.array(lot))
        ids, at = encode.token_ids(starts, lengths), 0
        for text, size in zip(lot, sizes, strict=True):
            assert ids[at : at + size].tolist() == ids_of(tokenizer, text), text
            at += size


def test_long_texts_are_cut_at_white_space():
    texts = ["aa bb cc dd ee", "", "x" * 50, "ff gg"]
    data, at = text_bytes(pa.array(texts))
    parts = [(int(r), s) for rows, strings in balanced_pieces(data, at, 6) for r, s in zip(rows, strings.to_pylist(), strict=True)]
    assert {r for r, _ in parts} == {0, 1, 2, 3}
    assert ["".join(s for r, s in parts if r == i) for i in range(4)] == texts
    assert all(s.strip() in texts[r] and not re.search(r"\S$", s) or r != 0 or s.split()[-1] in texts[0].split() for r, s in parts if s)


def test_token_counts(spark, documents, tokenizer):
    long = "word, " * 3000 + "é" * 2000
    rows = [(1, "One two 3!"), (1, "One two 3!"), (2, None), (None, ""), (3, long), (4, " \n ")]
    got = token_counts(documents(rows), limit=2048, max_bytes=64).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == Counter(
        (i, len((t or "").encode()), len(ids_of(tokenizer, t)), len(ids_of(tokenizer, t)) > 2048)
        for i, t in rows
    )
    assert token_counts(documents([])).collect() == []


def check_packing(tokenizer, rows, got, capacity):
    ids = Counter()
    for i, t in rows:
        ids[i, tuple([*ids_of(tokenizer, t), 2])] += 1
    pieces = Counter(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got
    )
    want = Counter()
    for (i, all_ids), copies in ids.items():
        for start in range(0, len(all_ids), capacity):
            part = all_ids[start : start + capacity]
            crc = zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            want[i, start, len(part), crc, len(all_ids)] += copies
    assert pieces == want
    filled = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert all(n <= capacity for n in filled.values())


def packed(docs, capacity):
    pieces = P.tokenized_pieces(docs, capacity=capacity)
    return P.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=capacity)


def test_packing(spark, documents, tokenizer):
    draw = random.Random(3)
    rows = [(i, " ".join(["pack"] * draw.randint(0, 60))) for i in range(300)]
    rows += [(None, None), (5, None), (5, "same text"), (5, "same text"), (900, "far " * 500)]
    rows += [(2000 + i, "the hot length") for i in range(400)]
    check_packing(tokenizer, rows, packed(documents(rows), 64).collect(), 64)
    assert packed(documents([]), 64).collect() == []


def test_packing_wants_lengths_in_range(spark):
    with pytest.raises(Exception, match="1 to 8 tokens"):
        P.pack(spark.createDataFrame([(9,)], "length bigint"), capacity=8).collect()


@pytest.mark.parametrize("seed", range(5))
def test_placements_give_every_rank_a_place_of_its_own(seed):
    draw = np.random.default_rng(seed)
    histogram = {int(n): int(draw.integers(1, 40)) for n in draw.integers(1, 65, 30)}
    rows = P.placements(histogram, 64)
    used = Counter()
    places = set()
    for n, count in histogram.items():
        mine = rows[rows[:, 0] == n]
        assert mine[0, 1] == 0
        for rank in range(count):
            _, first, copies, sequence, offset = mine[np.searchsorted(mine[:, 1], rank, "right") - 1]
            nth = rank - first
            key = (sequence + nth // copies, offset + nth % copies * n)
            assert key not in places
            places.add(key)
            used[key[0]] += n
    assert max(used.values()) <= 64
    assert set(used) == set(range(len(used)))
    assert sum(used.values()) / 64 > 0.8 * len(used) - 1


def junk(draw):
    return " ".join(w.upper() + "!!" for w in draw.choices("the of and in to was is".split(), k=40))


def prose(draw):
    return " ".join(draw.choices("the of and in to was is there for under".split(), k=40))


def test_quality_on_held_out_documents(spark, documents):
    draw = random.Random(5)
    rows = [(i, junk(draw) if i % 3 == 0 else prose(draw)) for i in range(300)]
    rows += [(None, None), (301, ""), (1, "a second row with the id")]
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0), (7777, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    got = Q.quality_scores(documents(rows), labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300 and r.doc_id != 1]
    assert {r.doc_id for r in held} <= {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.predicted == int(r.doc_id % 3 != 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert Q.quality_scores(documents([]), labels).collect() == []
    none = Q.quality_scores(documents(rows[:3]), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 3


def test_quality_features_sum_to_one():
    bucket, weight, first = Q.document_features(pa.array(["a bb ccc ccc", None, "été " * 30]))
    sums = [float(weight[a:b].sum()) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert sums == pytest.approx([1, 0, 1], abs=1e-5)
    assert bucket.min() >= 0 and bucket.max() < Q.BUCKETS


def plain_licenses(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]
    places = [
        (i, label)
        for label, phrase in L.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    base = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), base


def test_license_scan(spark, documents):
    mit = next(grant[1] for grant in L.GRANTS if grant[0] == "mit")
    edited = mit.replace("free of charge", "entirely free of any charge").replace("copy", "copies")
    texts = [
        "Released under the MIT License. See the Apache\tLicense, and the MIT license",
        "general public general public license",
        "mit mit license license",
        "MİT License and Mit-License",
        mit,
        f"Before. {edited}. After.",
        "permission to use the software",
        "of the " * 500,
        "",
        None,
        "one",
        "...",
        "été GNU General\nPublic; License",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])]
    got = L.license_scan(documents(rows)).collect()
    found = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert found == Counter((i, *plain_licenses(t)) for i, t in rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].labels == by_id[5].labels == "mit"
    assert by_id[4].score == 1.0 and 0.6 <= by_id[5].score < 1
    assert by_id[6].labels == by_id[7].labels == by_id[9].labels == ""
    assert L.license_scan(documents([])).collect() == []


def test_licenses_are_told_from_their_neighbours(spark, documents):
    kinds = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]
    lines = {f"Licensed under CC {k} 4.0.": f"cc-{k.lower()}" for k in kinds}
    names = ["", "-ShareAlike", "-NoDerivatives", "-NonCommercial", "-NonCommercial-ShareAlike", "-NonCommercial-NoDerivatives"]
    for k, name in zip(kinds, names, strict=True):
        lines[f"This page is licensed under a Creative Commons Attribution{name} 4.0 International License."] = f"cc-{k.lower()}"
    lines["Licensed under CC BY-ND 4.0 only, whatever others say of it"] = "cc-by-nd"
    # Two licenses in one text, and words of a license that name none.
    lines["Licensed under CC BY 4.0. The pictures are licensed under CC BY-NC 4.0."] = "cc-by,cc-by-nc"
    lines["licensed under cc 4 0 by nc"] = ""
    for label, text, *_ in L.GRANTS:
        labels = {label}
        if "general public license" in text.replace("lesser ", ""):
            labels.add("gpl")  # the phrase stands in it
        if "apache license" in text:
            labels.add("apache")
        if label.startswith(("gpl-", "lgpl-")):
            labels |= {"gpl"}
        lines[f"In full: {text.upper()}. End."] = ",".join(sorted(labels))
    rows = list(enumerate(lines))
    got = {r.doc_id: (r.labels, r.score) for r in L.license_scan(documents(rows)).collect()}
    wrong = {lines[t]: (got[i], t[:90]) for i, t in rows if got[i][0] != lines[t]}
    assert not wrong
    assert all(got[i][1] == 1.0 for i, t in rows if lines[t])


QUESTION = (
    "When Anna finally drives away from home she makes 120 km in 2 hours and then rests while her brother Peter walks slowly along the"
    " river for 3 miles. How far did Anna travel before the long break at the old mill house?"
)


def test_decontamination(spark, documents):
    altered = (
        QUESTION.replace("Anna", "Maria").replace("120 km", "90 miles").replace("2 hours", "4 days")
        .replace("Peter", "Jonas").replace("3 miles", "7 km")
    )
    broken = QUESTION.replace("Anna travel", "Berta travel")
    other = "A clean text about 120 km of river and 2 hours of rest by the old mill house near here."
    rows = [
        (1, QUESTION),
        (2, f"Some words come first here. {altered} And others follow it."),
        (3, other),
        (4, None),
        (5, ""),
        (6, "THE!! OF!! " * 50),
        (1, QUESTION),
        (None, QUESTION),
        (7, " ".join(QUESTION.split()[:5])),
        (8, broken),
        (9, "x. " * 30000 + QUESTION),
    ]
    items = spark.createDataFrame(
        [(10, QUESTION, "a"), (10, QUESTION, "a"), (11, None, "b"), (12, "too short", "c"), (13, "", "d")],
        "item_id bigint, text string, window string",
    )
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(documents(rows), items).collect()}
    assert set(got) == {(1, 10), (2, 10), (None, 10), (9, 10)}
    assert got[1, 10].verbatim and got[1, 10].share == 1 and not got[2, 10].verbatim
    assert (got[9, 10].first_word, got[9, 10].last_word) == (30000, 30000 + len(QUESTION.split()) - 1)
    assert D.contaminated(documents([]), items).collect() == []
    assert D.contaminated(documents(rows), items.limit(0)).collect() == []


def test_decontamination_finds_the_passages_of_the_given_tables(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    texts = {r.item_id: r.text for r in items.collect()}
    want = {
        (r.doc_id, i) for r in docs.collect() for i, text in texts.items() if text in (r.text or "")
    }
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} == want


def found_in(spark, documents, rows, items):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in D.contaminated(documents(rows), benchmark).collect()}


def test_decontamination_reads_words_that_open_sentences_both_ways(spark, documents):
    story = (
        "Tom has 3 red apples here. Ann has 5 green pears there. Tom gives 2 of his apples away."
        " Ann eats 4 of her pears today."
    )
    fresh = dict(zip("Tom Ann 3 5 2 4".split(), "Sue Bob 7 9 6 8".split(), strict=True))
    other = re.sub("Tom|Ann|[3524]", lambda m: fresh[m[0]], story)
    words = (
        "The train leaves the old station in the north at noon. The bus waits for all of the guests of"
        " the old house."
    )
    short = "What is the capital of France"
    rows = [
        (1, other),
        (2, other.replace("Sue gives", "Kim gives").replace("Bob eats", "Lee eats")),
        (3, words.replace("The bus", "A bus")),
        *((i, f"{mark} {short}") for i, mark in enumerate(("1)", "-", "(a)", "so", '"'), 4)),
    ]
    got = found_in(spark, documents, rows, [(10, story), (11, words), (12, short)])
    assert set(got) == {(1, 10), (3, 11), *((i, 12) for i in range(4, 9))}
    assert got[1, 10].share == 1 and not got[1, 10].verbatim


def test_decontamination_finds_copies_with_few_plain_words(spark, documents):
    items = [
        "Compute 12 35 7 4 9",
        "7 12 35 40 51 66 70 82 93 104 115",
        "Tom Dick Harry Anna Maria Peter Paul Mary Jonas",
        "WHO WROTE THE BOOK OF THE DEAD IN EGYPT",
        "Define inertia briefly",
        "2 + 2",
    ]
    rows = [(i, f"so we say: {text} and more of it") for i, text in enumerate(items)]
    rows += [(10, items[1].replace("70", "71")), (11, "Compute 13 36 8 5 10"), (12, "Define inertia")]
    got = found_in(spark, documents, rows, list(enumerate(items)))
    assert set(got) == {(i, i) for i in range(len(items))}
    assert all(r.verbatim and r.share == 1 for r in got.values())


def test_decontamination_adds_up_diagonals_and_takes_long_runs(spark, documents):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(290)]
    short, middle, long = words[:20], words[20:60], words[40:]
    named = [*short[:10], "Tom", *short[11:]]
    unit = [*short[:9], "5", "km", *short[11:]]
    rows = [
        [*short[:10], "extra", *short[10:]],
        [*short[:10], *short[11:]],
        [*middle[:20], "extra", *middle[20:]],
        [*named[:10], "Mary", "Ann", *named[11:]],
        [*unit[:10], "square", "km", *unit[11:]],
        long[70:170],
        long[70:110],
        [*short[:10], *["far"] * 40, *short[10:]],
        [*long[:60], "Tom", *long[61:200]],
    ]
    items = [short, middle, long, named, unit]
    got = found_in(
        spark,
        documents,
        [(i, " ".join(r)) for i, r in enumerate(rows)],
        [(i, " ".join(r)) for i, r in enumerate(items)],
    )
    near = {(i, j) for i in (0, 1, 3, 4) for j in (0, 3, 4)}  # items 0, 3 and 4 differ in two words
    assert {(0, 0), (1, 0), (2, 1), (3, 3), (4, 4), (5, 2), (8, 2)} <= set(got)
    assert set(got) - near == {(2, 1), (5, 2), (8, 2)}


def test_decontamination_takes_names_of_several_words(spark, documents):
    story = (
        "Then Tom has 3 red apples at home. Later Tom gives 2 of the apples away. Today Tom eats"
        " another 4 green apples. How many apples has Tom left at the end?"
    )
    rows = [
        (1, story.replace("Tom", "Mary Ann")),
        (2, story.replace("Tom has", "Mary Ann has").replace("Tom gives", "Sue gives").replace("Tom eats", "Bob eats")),
    ]
    got = found_in(spark, documents, rows, [(10, story), (11, story.replace("Tom", "Paul James Lee"))])
    assert set(got) == {(1, 10), (1, 11)}
