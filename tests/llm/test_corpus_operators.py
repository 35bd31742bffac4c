"""Joins, dedup, fixity, chat and the pipeline against plain versions of them."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import open_tables, oracle_rows, spark_rows
from pyspark.sql import functions as F

import corpus_pipeline
from kinspan.llm import chat as C
from kinspan.llm import exact_dedup as E
from kinspan.llm import fixity as M
from kinspan.llm import ngram_join as J
from kinspan.llm import substring_dedup as S
from kinspan.llm.queries import ORACLES, QUERIES
from kinspan.llm.tables import bitmap, components, in_bitmap


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def words(draw, n, vocabulary=400):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies of any degree, shared passages, junk and empty ones."""
    draw = random.Random(11)
    rows, passage = [], " ".join(words(draw, 60))
    for i in range(60):
        base = words(draw, draw.randint(1, 150))
        rows.append((5 * i, " ".join(base)))
        for k in range(draw.randint(0, 3)):
            edited = [w if draw.random() > draw.choice([0, 0.01, 0.03, 0.1]) else "new" for w in base]
            rows.append((5 * i + 1 + k, " ".join(edited)))
    rows += [(1000 + i, f"start {i} {passage} end {i}") for i in range(12)]
    rows += [(1100 + i, "a b c d") for i in range(3)] + [(1200, "a b c"), (1201, "same " * 100)]
    rows += [(1202, "x y " * 60), (1203, None), (1204, ""), (1205, " \n"), (None, "a b c d")]
    rows += [(None, passage), (0, rows[0][1]), (1203, None)]
    return rows


def plain_classes(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        w = split(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    n, links, parent = len(rows), [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            met = len(sets[i] & sets[j])
            if met and met >= threshold * (len(sets[i]) + len(sets[j]) - met) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i in range(n):
        least[root(i)].append(rows[i][0])
    first = {r: min((x for x in ids if x is not None), default=None) for r, ids in least.items()}
    return Counter((rows[i][0], first[root(i)], links[i]) for i in range(n))


@pytest.mark.parametrize(("small", "block"), [(1024, 1024), (2, 3)])
def test_ngram_join(spark, documents, corpus, small, block):
    got = J.ngram_classes(documents(corpus), small=small, block=block).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == plain_classes(corpus)


def test_ngram_join_of_nothing(spark, documents):
    assert J.ngram_classes(documents([])).collect() == []
    got = J.ngram_classes(documents([(1, None), (2, "")])).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == [(1, 1, 0), (2, 2, 0)]


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want, kept = Counter(), set()
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        stays = i == keep and (t or "", i) not in kept
        if stays:
            kept.add((t or "", i))
        want[i, keep, len(ids), stays, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    return want


def test_exact_dedup(spark, documents, corpus):
    rows = [*corpus, (None, "only here"), (None, "only here"), (-5, "é"), (2**62, "é")]
    assert Counter(tuple(r) for r in E.exact_dedup(documents(rows)).collect()) == plain_exact(rows)
    assert E.exact_dedup(documents([])).collect() == []
    nameless = [(None, "a"), (None, "b"), (None, "a")]
    assert Counter(tuple(r) for r in E.exact_dedup(documents(nameless)).collect()) == plain_exact(nameless)


@pytest.mark.parametrize("n", [1, 2, 3, 50, 2000])
def test_perfect_hash_is_minimal(n):
    digests = np.stack([np.frombuffer(hashlib.sha256(str(i).encode()).digest(), np.uint8) for i in range(n)])
    seeds, slots = E.perfect_hash(digests)
    assert sorted(slots) == list(range(n))
    assert (E.slots_of(digests, seeds, n) == slots).all()


def test_index_tells_members_from_others(spark):
    known = [(hashlib.sha256(str(i).encode()).digest(), i, 1) for i in range(100)]
    fresh = [(hashlib.sha256(str(i).encode()).digest(), i + 1000, 2) for i in range(50, 150)]
    schema = "digest binary, doc_id bigint, n bigint"
    for shard_digests in (7, 1000):
        got = E.exact_groups(
            spark.createDataFrame(fresh, schema), spark.createDataFrame(known, schema), shard_digests
        )
        found = {bytes(r.digest): (r.keep_id, r.group_size, r.known) for r in got.collect()}
        for i in range(150):
            digest = hashlib.sha256(str(i).encode()).digest()
            old, new = i < 100, i >= 50
            assert found[digest] == (i + 1000 if new else i, old + 2 * new, old)


def plain_repeats(rows, window):
    seen = Counter()
    for _, text in rows:
        w = split(text)
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    want = Counter()
    for i, text in rows:
        w = split(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[i, len(w), sum(gone), left] += 1
    return want


@pytest.mark.parametrize(("window", "run", "shard"), [(35, 10, 64), (12, 4, 64), (12, 4, 1)])
def test_substring_dedup(spark, documents, corpus, window, run, shard):
    got = S.remove_repeats(documents(corpus), window, run, shard).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == plain_repeats(corpus, window)


def test_segments_of_hot_anchors_stay(spark):
    rows = [(t, 7, t % 3, 0, 35) for t in range(40)] + [(50, 8, 1, 0, 35), (51, 9, 1, 0, 35), (52, 9, 2, 0, 36)]
    schema = "text bigint, anchor bigint, segment bigint, at bigint, size bigint"
    segments = spark.createDataFrame(rows, schema)
    kept = S.repeated_segments(segments, hot_rows=4).select(segments.columns).collect()
    assert sorted(map(tuple, kept)) == sorted(r for r in rows if r[1] != 8)


def test_substring_dedup_of_nothing(spark, documents):
    assert S.remove_repeats(documents([])).collect() == []


def test_suffix_automaton_finds_what_occurs_twice():
    draw = random.Random(2)
    for _ in range(200):
        texts = [[draw.randrange(3) for _ in range(draw.randint(1, 12))] for _ in range(3)]
        weights = [draw.randint(1, 2) for _ in texts]
        automaton = S.SuffixAutomaton()
        for text, weight in zip(texts, weights, strict=True):
            automaton.add(text, weight)
        automaton.finish()
        seen = Counter()
        for text, weight in zip(texts, weights, strict=True):
            for k in range(len(text) - 3):
                seen[tuple(text[k : k + 4])] += weight
        for text in texts:
            covered = set()
            for k in range(len(text) - 3):
                if seen[tuple(text[k : k + 4])] > 1:
                    covered |= set(range(k, k + 4))
            spans = automaton.repeated_spans(text, 4)
            assert {i for a, b in spans for i in range(a, b)} == covered


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_bitmap_passes_all_keys(spark):
    keys = [0, 1, 63, 64, -1, 2**62, -(2**63)]
    full = bitmap(spark.createDataFrame([(k,) for k in keys], "key bigint"))
    assert in_bitmap(full, np.array(keys)).all()
    assert not in_bitmap(full, np.arange(100, 200)).any()


def test_fixity_audit(spark):
    pages = [(i, f"http://x/{i % 7}", "<html>" + "y" * (i * 37 % 500)) for i in range(300)]
    pages += [(None, "u", "<p>"), (None, None, None), (3000, None, None), (5, "http://x/5", "twice")]
    schema = "page_id bigint, url string, html string"
    clean = M.warc_records(spark.createDataFrame(pages, schema), file_pages=100)
    worse = [p for p in pages if p[0] not in (99, 3000)]
    worse = [(i, u, h.replace("<html>", "<htmX>") if i in (7, 150, 151) else h) for i, u, h in worse]
    worse.append((4000, "new", "file"))
    bad = M.warc_records(spark.createDataFrame(worse, schema), file_pages=100)
    one, two = (M.record_digests(M.in_files(r)) for r in (clean, bad))
    for span, fanout in ((64, 2), (1 << 16, 16)):
        got = M.audit(one, two, span, fanout).collect()
        assert Counter((r.page_id, r.status) for r in got) == Counter(
            {(7, "changed"): 1, (150, "changed"): 1, (151, "changed"): 1, (99, "missing"): 1,
             (3000, "missing"): 1, (4000, "extra"): 1}
        )
        assert M.audit(one, one, span, fanout).collect() == []
    empty = one.limit(0)
    assert M.audit(empty, empty).collect() == []
    assert {r.status for r in M.audit(empty, two).collect()} == {"extra"}


def test_lost_and_lengthened_records_shift_no_others(spark):
    pages = [(i, "http://x", f"<p>{i}" + "y" * (i * 37 % 90)) for i in range(100)]
    pages += [(200, "u", "same"), (200, "u", "same"), (200, "u", "same"), (None, "v", "q"), (None, "v", "r")]
    schema = "page_id bigint, url string, html string"

    def replica(rows):
        df = spark.createDataFrame([(*r, "x", "d", 1) for r in rows], f"{schema}, sha256 string, digest string, node int")
        return M.record_digests(M.in_files(M.warc_records(df, file_pages=1000)))

    one = replica(pages)
    offsets = {r.page_id: r.offset for r in one.filter("page_id < 100").collect()}

    def found(rows, **shape):
        return Counter((r.page_id, r.offset, r.status) for r in M.audit(one, replica(rows), **shape).collect())

    for shape in ({}, {"span": 64, "fanout": 2}):
        lost = [p for p in pages if p[0] != 50]
        assert found(lost, **shape) == Counter([(50, offsets[50], "missing")])
        longer = [(i, u, h + "zz" * (i in (10, 51))) for i, u, h in lost]
        assert found(longer, **shape) == Counter(
            [(50, offsets[50], "missing"), (10, offsets[10], "changed"), (51, offsets[51], "changed")]
        )
        more = found([*pages[:30], (29, "new", "between"), *pages[30:]], **shape)
        assert [(k[0], k[2], n) for k, n in more.items()] == [(29, "extra", 1)]
        fewer = found([*pages[:100], *pages[101:]], **shape)
        assert [(k[0], k[2], n) for k, n in fewer.items()] == [(200, "missing", 1)]
        assert [(k[0], k[2], n) for k, n in found([p for p in pages if p[2] != "r"], **shape).items()] == [
            (None, "missing", 1)
        ]


def test_warc_files_are_split_into_their_records(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>ü{i}\r\n\r\n</p>" * i) for i in range(5)]
    records = M.warc_records(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    made = [bytes(r.record) for r in records.orderBy("page_id").collect()]
    (tmp_path / "a.warc").write_bytes(b"".join(made) + b"torn")
    got = M.read_warc(spark, str(tmp_path)).orderBy("offset").collect()
    assert [bytes(r.record) for r in got] == [*made, b"torn"]
    assert [r.offset for r in got] == [sum(map(len, made[:i])) for i in range(6)]


ODD = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\s> [[SYS]]", "", None, "[TEXT]", "a [ROLE] b </s", "<s", "é" * 40]


def plain_chat(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        turns[c].append((t is not None, t, r is not None, r or "", x is not None, x or ""))
    want = {}
    for c, all_turns in turns.items():
        own = [(t[3], t[5]) for t in sorted(all_turns, key=lambda t: (t[0], t[1] or 0, *t[2:]))]
        said = "".join(x for r, x in own if r == "assistant")
        want[c] = (
            len(own),
            hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
        )
    return want


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (40, 15), (1, 0)])
def test_chat_windows_read_back(spark, budget, history):
    draw = random.Random(4)
    roles = ["user", "assistant", "system", "tool", None, "[TEXT]x", "</s>"]
    rows = []
    for c in [*range(30), None]:
        for t in range(draw.randint(1, 12)):
            role = "system" if t == 0 and draw.random() < 0.5 else draw.choice(roles)
            rows.append((c, t if draw.random() < 0.95 else None, role, draw.choice([*ODD, "some more words " * 5])))
    rows.append(rows[0])
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = C.format_conversations(turns, budget, history)
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(windows).collect()}
    assert got == plain_chat(rows)
    for w in windows.collect():
        # Over the budget is a turn alone, or with the system turn that stands in every window.
        alone = w.n_turns - w.n_repeated == 1 and w.n_repeated <= 1
        assert w.n_tokens <= budget or (alone and (not w.n_repeated or next(C.parse(w.text))[0] == "system"))
        assert w.n_repeated < w.n_turns
        assert len(list(C.parse(w.text))) == w.n_turns
    assert C.read_back(C.format_conversations(turns.limit(0))).collect() == []


def test_every_window_has_the_system_turn(spark):
    said = [("system", 600), ("user", 300), ("assistant", 500), ("user", 450), ("assistant", 1200), ("user", 3)]
    rows = [(c, t, role, f"{role} " + "word " * n) for c in (1, 2) for t, (role, n) in enumerate(said)]
    rows.append((2, 9, None, None))
    turns = spark.createDataFrame(
        [(*r, "x", "y") for r in rows],
        "conv_id bigint, turn bigint, role string, text string, tokens string, window string",
    )
    windows = C.format_conversations(turns).collect()
    assert len(windows) > 4
    for w in windows:
        roles = [role for role, _, _ in C.parse(w.text)]
        assert roles[0] == "system" and roles.count("system") == 1
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(C.format_conversations(turns)).collect()}
    assert got == plain_chat(rows)


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_escapes_are_reversible(text):
    assert C.unescape(C.escape(text)) == text
    assert not C._CONTROL.search(C.escape(text))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, small_dir, name):
    names, got = spark_rows(QUERIES[name](spark, small_dir))
    wanted_names, want = oracle_rows(open_tables(small_dir), ORACLES[name])
    assert names == wanted_names
    assert got == want


def test_pipeline(spark, small_dir):
    """Each stage on all its predecessor kept, against plain versions of the stages."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, kept[-1], small_dir)
        assert rows.columns == docs.columns
        kept.append(spark.createDataFrame(rows.collect(), docs.schema))
    texts = [[(r.doc_id, r.text) for r in k.collect()] for k in kept]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    left = {i for i, _ in texts[1]}
    judged = [(labels[i], i in left) for i, _ in texts[0] if i in labels]
    assert np.mean([q == stays for q, stays in judged]) > 0.95
    assert {i for i, _ in texts[2]} == {k[0] for k in plain_exact(texts[1]) if k[3]}
    assert {i for i, _ in texts[3]} == {i for i, first, _ in plain_classes(texts[2]) if i == first}
    items = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert {i for i, _ in texts[4]} == {i for i, t in texts[3] if not any(x in t for x in items)}
    final = corpus_pipeline.run(spark, small_dir)
    assert {r.doc_id for r in final.select("doc_id").distinct().collect()} == {i for i, _ in texts[4]}
    used = final.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in used) <= 4096


def test_stages_judge_rows_with_repeated_and_null_ids_one_by_one(spark, documents, small_dir):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(400)]
    first, second, third, fourth = (" ".join(words[i : i + 100]) for i in range(0, 400, 100))
    item = spark.read.parquet(f"{small_dir}/benchmark.parquet").first().text
    rows = [
        (1, first), (2, first + " end"), (2, second), (3, third), (3, third + " end"),
        (None, fourth), (None, fourth + " end"), (5, fourth + " fin"), (None, ""), (7, " "), (8, None),
    ]
    left = {(r.doc_id, r.text) for r in corpus_pipeline.near(spark, documents(rows), small_dir).collect()}
    kept = {x for x in left if x[0] == 3}
    assert len(kept) == 1 and kept <= {rows[3], rows[4]}
    assert left - kept == {rows[0], rows[2], *rows[7:]}
    rows = [(1, first), (1, f"{second} {item}"), (None, third), (None, f"{fourth} {item}"), (2, item)]
    found = corpus_pipeline.decontaminate(spark, documents(rows), small_dir)
    assert {(r.doc_id, r.text) for r in found.collect()} == {rows[0], rows[2]}
