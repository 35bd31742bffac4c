"""Fingerprints, periodic runs and the filter audit against plain versions of them."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinspan.llm import audit_queries as A
from kinspan.llm import filter_audit as W
from kinspan.llm import merkle as M
from kinspan.llm import periodic_runs as P

WORDS = r"[^\x20\x09-\x0D]+"


def plain_lyndon(s):
    found = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        found.append(j - i)
    return found


def plain_runs(s, least):
    found = {}
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p) and j > i:
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def sequences(draw, count, most):
    for _ in range(count):
        letters, n = draw.randint(1, 3), draw.randint(0, most)
        s = [draw.randrange(letters) for _ in range(n)]
        if n and draw.random() < 0.5:
            a = draw.randrange(n)
            p = 1 + draw.randrange(1 + (n - a) // 2)
            s = s[:a] + [s[a + (i - a) % p] for i in range(a, n)]
        yield s, letters


def test_grouping_gives_the_lyndon_array():
    for s, letters in sequences(random.Random(1), 1500, 40):
        assert P.lyndon_array(s, letters) == plain_lyndon(s)
    assert P.lyndon_array([0] * 100_000, 1) == [1] * 100_000
    rising = list(range(5000))
    assert P.lyndon_array(rising, 5000) == list(range(5000, 0, -1))


def test_all_runs_are_found():
    for s, _ in sequences(random.Random(2), 800, 40):
        for least in (1, 5, 12):
            got = P.find_runs(np.array(s, np.int64), np.array([0, len(s)]), least)
            assert sorted((a, b - a, p) for a, b, p in got.tolist()) == plain_runs(s, least)


def test_runs_end_with_their_text(spark, documents):
    draw = random.Random(3)
    rows = [(i, " ".join("abc"[x] for x in s)) for i, (s, _) in enumerate(sequences(draw, 300, 60))]
    rows += [(300, None), (300, ""), (None, "x " * 30), (None, "x " * 30), (301, " \t\n "), (302, "  " * 13)]
    rows.append((303, "q\u000bw  " * 40_000))  # a very long text, one run
    got = P.periodic_runs(documents(rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    wanted = Counter()
    for i, text in rows:
        words = re.findall(WORDS, text or "")
        runs = [(0, 80_000, 2)] if i == 303 else plain_runs(words, 12)
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        wanted[i, len(words), tuple(runs), " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == wanted
    assert P.periodic_runs(documents([])).count() == 0


def test_texts_side_by_side_share_no_run():
    texts = pa.array(["a b " * 4, "a b " * 4, "", "a b " * 6])
    data, at = P.text_bytes(texts)
    bounds = P.word_bounds(data, at)
    text, spans = P.text_runs(data, *bounds)
    assert text.tolist() == [3] and spans.tolist() == [[0, 12, 2]]


def test_planted_runs(spark, documents):
    rows = [(i, f"w{i} " + " ".join(f"x{k}" for k in range(i % 37))) for i in range(400)] + [(None, "a b"), (7, None)]
    import zlib

    got = {(r.doc_id, r.text) for r in A.with_planted_runs(documents(rows)).collect()}
    wanted = set()
    for i, text in rows:
        words = re.findall(WORDS, text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[:a] + [words[a + (k - a) % p] for k in range(a, n)])
        wanted.add((i, text))
    assert got == wanted


def digest(kind, text):
    return hashlib.sha256((kind + text).encode()).hexdigest()


def plain_tree(text):
    lines = text.split("\n")
    paragraphs = [digest("p", line) for line in lines]
    starts = [
        i
        for i, d in enumerate(paragraphs)
        if i == 0 or int(d[:4], 16) % 16 == 0 or lines[i].startswith("#") or not lines[i - 1].strip(" ")
    ]
    cuts = zip(starts, [*starts[1:], len(lines)], strict=True)
    sections = [digest("s", "".join(paragraphs[a:b])) for a, b in cuts]
    pieces = {}
    for m in re.finditer(M.PIECE, text):
        piece = m.group()
        pieces[int(hashlib.md5(piece.encode()).hexdigest()[:6], 16) * 256 + min(255, len(piece))] = None
    return digest("r", "".join(sections)), paragraphs, sections, list(pieces)


def plain_likeness(a, b):
    total = sum(x % 256 for x in a) + sum(x % 256 for x in b)
    return 2 * sum(x % 256 for x in set(a) & set(b)) / total if total else 1.0


def plain_printed(tree):
    return ":".join([tree[0], ",".join(s[:16] for s in tree[2]), ",".join(map(str, tree[3]))])


def plain_edit(a, b):
    if a == b:
        return None, None
    ahead = 0
    while ahead < min(len(a), len(b)) and a[ahead] == b[ahead]:
        ahead += 1
    behind = 0
    while behind < min(len(a), len(b)) - ahead and a[-1 - behind] == b[-1 - behind]:
        behind += 1
    return ahead + 1, len(a) - behind


@pytest.mark.parametrize("bucket_rows", [1, 3, 64])
def test_fingerprints_of_edited_texts(spark, documents, bucket_rows):
    draw = random.Random(4)
    words = ["über", "a", "b.", "c,", "\n", "#", "d", "\n\n", "😀", "x" * 200, "| ", "e\u000b"]
    rows = [(draw.randint(-900, 900), " ".join(draw.choices(words, k=draw.randint(0, 60)))) for _ in range(120)]
    rows += [(2**62, "far. away"), (-(2**63), "first"), (5000, None), (5001, ""), (5002, "same"), (5003, "same")]
    rows += [(6000, "t w"), (6000, "t w"), (6000, "t x"), (6001, "line\n" * 30_000)]
    nameless = [(None, "no id at all"), (None, None), (None, "no id at all")]
    got = Counter(map(tuple, M.compare_edits(documents(rows + nameless), bucket_rows).collect()))
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], r[1].encode()))
    pairs = list(zip(ordered, [t for _, t in ordered[1:] + ordered[:1]], strict=True))
    pairs += [((None, t or ""), None) for _, t in nameless]
    wanted = Counter()
    for (i, text), following in pairs:
        cut = len(text) // 4
        edited = text[: len(text) - cut] + (following or "")[:cut]
        tree, other, nxt = plain_tree(text), plain_tree(edited), plain_tree(following or "")
        wanted[
            i, len(text), edited, plain_printed(tree), plain_printed(other), plain_likeness(tree[3], other[3]),
            plain_likeness(tree[3], nxt[3]) if following is not None else plain_likeness(tree[3], []),
            len(set(tree[2]) - set(other[2])), *plain_edit(tree[1], other[1]),
        ] += 1
    assert got == wanted


def test_fingerprints_alone(spark, documents):
    assert M.compare_edits(documents([])).count() == 0
    alone = M.compare_edits(documents([(1, "abcd efgh")])).first()
    assert alone.edited == "abcd efab" and alone.near_next == 1.0
    made = M.fingerprints(documents([(1, "a\nb"), (2, "a\nb"), (None, None), (3, "")])).collect()
    prints = {(r.doc_id, r.fingerprint) for r in made}
    assert len(made) == 4 and len({f for _, f in prints}) == 2
    assert made[0].root == plain_tree("a\nb")[0]


def test_no_python_in_the_fingerprints(spark, documents):
    text = M.compare_edits(documents([(i, f"text {i}") for i in range(9)]), 2)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def plain_audit(rows, labels):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = {}
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(WORDS, text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": text in first and (i is None or i > first[text]),
        }
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, *labels.get(i, (0, 0))))
    found = {}
    for part, docs in parts.items():
        shares = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                redundant = sum(f in d[0] for d in docs) - len(gone)
                left = [d for d in left if f not in d[0]]
                shares[f] += len(gone)
                found[part, order, step] = [
                    len(left), len(gone), redundant, sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                ]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(shares[order[step - 1]])
    return {(*key, *row) for key, row in found.items()}


def test_filter_audit(spark):
    draw = random.Random(5)
    texts = [None, "", "A B C", "$ x", "same words " * 60]
    texts += [" ".join(f"w{draw.randrange(200)}" for _ in range(n)) for n in (90, 99, 100, 101, 300)]
    texts += ["LOUD " + texts[-1], texts[-1].upper() + " #", "wort wort " * 3]
    rows = [(i % 70, draw.choice(texts), draw.choice(["en", "de", None, ""])) for i in range(140)]
    rows += [rows[3], rows[3], (None, "", "en"), (None, "nowhere else", "en"), (None, "nowhere else", "de")]
    docs = spark.createDataFrame(
        [(i, t, g, "m", 1, 2) for i, t, g in rows],
        "doc_id bigint, text string, lang string, mask string, good int, n int",
    )
    marks = {i: (draw.randint(0, 1), draw.randint(0, 1)) for i in range(0, 70, 3)}
    listed = [(i, q, t) for i, (q, t) in marks.items()] + [(3, None, None), (None, 1, 1), (3, *marks[3])]
    labels = spark.createDataFrame(listed, "doc_id bigint, quality int, toxic int")
    got = W.filter_audit(docs, labels).collect()
    assert {tuple(r) for r in got} == plain_audit(rows, marks)
    assert len(got) == 3 * 600
    assert W.filter_audit(docs.limit(0), labels).count() == 0
    assert W.filter_audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_gray_walk_stores_every_subset():
    cells = np.random.default_rng(6).integers(0, 9, (32, 3))
    states = W.gray_walk(cells)
    for subset in range(32):
        assert (states[subset] == cells[[m for m in range(32) if not m & subset]].sum(axis=0)).all()
