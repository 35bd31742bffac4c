"""Registered queries of fingerprints, periodic runs and the filter audit, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.llm.filter_audit import FILTERS, filter_audit
from kinspan.llm.merkle import PIECE, SECTION, compare_edits
from kinspan.llm.periodic_runs import LEAST, periodic_runs
from kinspan.llm.tables import table


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = compare_edits(table(spark, sf_dir, "documents"))
    return met.withColumn("edited_sha256", sha256(F.col("edited"))).drop("edited")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) in which one text in ten, by its id, repeats some words to its end.

    With h the CRC-32 of the id and g = h div 10, words from number g mod n on are periodic; a null
    id has no such number and leaves its text alone.
    """
    # Words are runs of anything but white space.
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, a, p = F.col("_n"), F.col("_a"), F.col("_p")
    chosen = docs.select("doc_id", "text", hashed.alias("_h"))
    chosen = chosen.withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    chosen = chosen.withColumn("_n", F.size("_words")).withColumn("_g", F.floor(F.col("_h") / 10))
    chosen = chosen.withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
    chosen = chosen.withColumn("_p", (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int"))
    tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda k: F.element_at("_words", a + k % p + 1))
    made = F.array_join(F.concat(F.slice("_words", F.lit(1), a), tail), " ")
    return chosen.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    longest = F.array_max(ranked)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.withColumn("_best", longest)
    best = {
        "start": -F.col("_best.col2"),
        "length": F.col("_best.length"),
        "period": -F.col("_best.col3"),
    }
    exponent = F.floor(best["length"] * 1000 / best["period"])
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(c.cast("bigint").alias(name) for name, c in best.items()),
        exponent.cast("bigint").alias("exponent_milli"),
        sha256(lines).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op11_fingerprints, op12_periodic_runs, op13_filter_audit)}

_WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _same(a: str, b: str) -> str:
    """Position of the first place where two lists differ."""
    return (
        f"(SELECT min(i) FROM range(1, greatest(len({a}), len({b})) + 1) t(i)"
        f" WHERE {a}[i] IS DISTINCT FROM {b}[i])"
    )


ORACLES = {
    "op11_fingerprints": rf"""
        WITH texts AS (
          SELECT doc_id, coalesce(text, '') AS text,
            coalesce(lead(text) OVER (ORDER BY doc_id), CASE WHEN doc_id = max(doc_id) OVER () THEN
              first_value(text) OVER (ORDER BY doc_id) END, '') AS next_text
          FROM documents),
        edits AS (
          SELECT *, length(text) AS n_chars,
            text[:length(text) - length(text) // 4] || next_text[:length(text) // 4] AS edited FROM texts),
        trees AS (
          SELECT t AS whole, string_split(t, chr(10)) AS lines,
            list_transform(string_split(t, chr(10)), lambda x: sha256('p' || x)) AS ps,
            list_distinct(list_transform(regexp_extract_all(t, '{PIECE}'), lambda x:
              CAST('0x' || md5(x)[:6] AS BIGINT) * 256 + least(255, length(x)))) AS some_pieces,
            list_transform(regexp_extract_all(t, '{PIECE}'), lambda x:
              CAST('0x' || md5(x)[:6] AS BIGINT) * 256 + least(255, length(x))) AS all_pieces
          FROM (SELECT text AS t FROM edits UNION SELECT edited FROM edits UNION SELECT next_text FROM edits)),
        opened AS (
          SELECT whole, ps,
            list_filter(all_pieces, lambda x, i: list_position(all_pieces, x) = i) AS pieces,
            list_filter(range(1, len(ps) + 1), lambda i: i = 1
              OR CAST('0x' || ps[i][:4] AS BIGINT) % {SECTION} = 0 OR starts_with(lines[i], '#')
              OR trim(lines[i - 1], ' ') = '') AS starts
          FROM trees),
        sections AS (
          SELECT whole, ps, pieces, list_transform(starts, lambda s, k:
            sha256('s' || array_to_string(ps[s:coalesce(starts[k + 1], len(ps) + 1) - 1], ''))) AS sections
          FROM opened),
        made AS (
          SELECT *, sha256('r' || array_to_string(sections, '')) AS root,
            coalesce(list_sum(list_transform(pieces, lambda x: x % 256)), 0) AS weight FROM sections),
        printed AS (
          SELECT *, root || ':' || array_to_string(list_transform(sections, lambda s: s[:16]), ',') || ':'
            || array_to_string(pieces, ',') AS fingerprint FROM made),
        met AS (
          SELECT doc_id, n_chars, edited, t.fingerprint, e.fingerprint AS edited_fingerprint,
            CASE WHEN t.weight + e.weight = 0 THEN 1.0 ELSE CAST(2 * coalesce(list_sum(list_transform(
              list_intersect(t.pieces, e.pieces), lambda x: x % 256)), 0) AS DOUBLE)
              / CAST(t.weight + e.weight AS DOUBLE) END AS near_edited,
            CASE WHEN t.weight + n.weight = 0 THEN 1.0 ELSE CAST(2 * coalesce(list_sum(list_transform(
              list_intersect(t.pieces, n.pieces), lambda x: x % 256)), 0) AS DOUBLE)
              / CAST(t.weight + n.weight AS DOUBLE) END AS near_next,
            len(list_distinct(list_filter(t.sections, lambda s: NOT list_contains(e.sections, s)))) AS changed,
            t.root = e.root AS alike, t.ps AS ps, e.ps AS es
          FROM edits JOIN printed t ON t.whole = text JOIN printed e ON e.whole = edited
          JOIN printed n ON n.whole = next_text),
        placed AS (
          SELECT *, CASE WHEN NOT alike THEN {_same("ps", "es")} END AS ahead,
            CASE WHEN NOT alike THEN {_same("list_reverse(ps)", "list_reverse(es)")} - 1 END AS behind FROM met)
        SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint, near_edited,
          near_next, CAST(changed AS BIGINT) AS changed, ahead AS edit_first,
          len(ps) - least(behind, least(len(ps), len(es)) - ahead + 1) AS edit_last FROM placed""",
    "op12_periodic_runs": rf"""
        WITH RECURSIVE hashed AS (
          SELECT doc_id, {_WORDS_SQL} AS w,
            xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
              string_split(CAST(doc_id AS VARCHAR), ''),
              lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
                WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS h FROM documents),
        places AS (
          SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
            h // 10 AS g FROM hashed),
        planted AS (
          SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_concat(w[:a], list_transform(range(0, n - a),
            lambda k: w[a + k % (1 + (n - a) // (3 + g % 8)) + 1])) END AS w FROM places),
        grams AS (
          SELECT doc_id, unnest(range(1, len(w) - 4)) AS i,
            unnest(list_transform(range(1, len(w) - 4), lambda i: hash(w[i:i + 5]))) AS gram FROM planted),
        pairs AS (
          SELECT x.doc_id, x.i, y.i - x.i AS p FROM grams x JOIN grams y
          ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
        islands AS (
          SELECT doc_id, p, min(i) - 1 AS start, count(*) + 5 + p AS length
          FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM pairs)
          GROUP BY doc_id, p, k),
        runs AS (
          SELECT doc_id, start, length, min(p) AS period FROM islands
          WHERE length >= greatest({LEAST}, 2 * p) GROUP BY doc_id, start, length),
        gone AS (
          SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
        kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
          FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM planted) words
          ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
        listed AS (
          SELECT doc_id, count(*) AS n_runs,
            string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
            min({{'l': -length, 's': start, 'p': period}}) AS best FROM runs GROUP BY doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start,
          CAST(-best.l AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
          CAST(1000 * -best.l // best.p AS BIGINT) AS exponent_milli,
          sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256,
          CAST(len(w) AS BIGINT) AS n_words
        FROM planted LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_filter_audit": rf"""
        WITH judged AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS_SQL} AS w,
            min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id AS copy,
            coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic
          FROM documents LEFT JOIN labels USING (doc_id)),
        failing AS (
          SELECT part, good, toxic,
            CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
            || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
            || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
            || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
            || CASE WHEN copy THEN 'E' ELSE '' END AS fails
          FROM judged),
        cells AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM failing GROUP BY ALL),
        letters AS (SELECT unnest(string_split('{FILTERS}', '')) AS x),
        orders AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
          FROM letters a, letters b, letters c, letters d, letters e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
        counted AS (
          SELECT part, filter_order, step, filter_order[step] AS f,
            CAST(sum(n) FILTER (hit IS NULL OR hit > step) AS BIGINT) AS kept,
            CAST(sum(n) FILTER (hit = step) AS BIGINT) AS removed,
            CAST(sum(n) FILTER (hit < step AND contains(fails, filter_order[step])) AS BIGINT) AS redundant,
            CAST(sum(n) FILTER (fails = filter_order[step]) AS BIGINT) AS unique_fails,
            CAST(sum(good) FILTER (hit = step) AS BIGINT) AS good_lost,
            CAST(sum(toxic) FILTER (hit = step) AS BIGINT) AS toxic_lost
          FROM (SELECT *, (SELECT min(i) FROM range(1, 6) t(i) WHERE contains(fails, filter_order[i])) AS hit
                FROM cells, steps)
          GROUP BY ALL),
        whole AS (SELECT part, f, CAST(sum(removed) AS BIGINT) AS shapley FROM counted GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept,
          coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
          coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
          coalesce(toxic_lost, 0) AS toxic_lost, coalesce(shapley, 0) AS shapley
        FROM counted JOIN whole USING (part, f)""",
}
