"""The registered queries of this subpackage and their SQL, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspan.llm import audit_queries
from kinspan.llm.chat import format_conversations, read_back
from kinspan.llm.decontaminate import contaminated
from kinspan.llm.exact_dedup import exact_dedup
from kinspan.llm.fixity import FILE_PAGES, audit, in_files, record_digests, warc_records
from kinspan.llm.licenses import license_scan
from kinspan.llm.ngram_join import ngram_classes
from kinspan.llm.packing import pack, tokenized_pieces
from kinspan.llm.quality import quality_scores
from kinspan.llm.substring_dedup import remove_repeats
from kinspan.llm.tables import table
from kinspan.llm.token_counts import token_counts
from kinspan.operators.skew import lookup_join

def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_words", "n_removed", kept)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of `pages`: some pages lost, amid their files or at the end, others changed or longer."""
    file = F.floor(F.col("page_id") / FILE_PAGES)
    last = pages.select("page_id").groupBy(file.alias("file")).agg(F.max("page_id").alias("page_id"))
    lost = last.filter(F.pmod("file", F.lit(5)) == 0).select("page_id")
    full = F.length("html") > 0
    hit = (F.col("page_id") * 7919 % 97 == 5) & full
    changed = F.when(hit, F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    longer = F.when((F.col("page_id") % 53 == 11) & full, F.concat(changed, F.lit("xx"))).otherwise(changed)
    kept = pages.filter(F.coalesce(F.col("page_id") % 41 != 7, F.lit(True)))
    return lookup_join(kept, lost, "page_id", "left_anti").withColumn("html", longer)


def op6_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC files against a replica with known damage."""
    pages = table(spark, sf_dir, "pages")
    replicas = [record_digests(in_files(warc_records(p))) for p in (pages, damaged(pages))]
    return audit(*replicas)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], turns.schema)
    return read_back(format_conversations(turns.unionByName(probe)))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces by where they lie; the ids are summed up before anything is shuffled."""
    pieces = tokenized_pieces(table(spark, sf_dir, "documents"))
    summed = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(summed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_ngram_join,
        op3_exact_dedup,
        op4_substring_dedup,
        op5_quality,
        op6_fixity_audit,
        op7_decontaminate,
        op8_licenses,
        op9_chat,
        op10_packing,
    )
} | audit_queries.QUERIES

ORACLES: dict[str, str] = {
    "op2_ngram_join": r"""
        WITH RECURSIVE split AS (
          SELECT doc_id,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
          FROM documents),
        grams AS (
          SELECT doc_id, list_distinct(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
          FROM split),
        flat AS (SELECT doc_id, unnest(g) AS gram FROM grams),
        shared AS (SELECT gram FROM flat GROUP BY gram HAVING count(*) > 1),
        few AS (SELECT f.* FROM flat f JOIN shared USING (gram)),
        met AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
          FROM few a JOIN few b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
          SELECT a, b FROM met
          JOIN grams x ON x.doc_id = a JOIN grams y ON y.doc_id = b
          WHERE 10 * n >= 8 * (len(x.g) + len(y.g) - n)),
        reach(a, b) AS (
          SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        roots AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id,
          coalesce(n, 0) AS n_links, CAST(len(g) AS BIGINT) AS n_ngrams
        FROM grams LEFT JOIN roots ON roots.a = doc_id LEFT JOIN counts ON counts.a = doc_id""",
    "op6_fixity_audit": r"""
        WITH records AS (
          SELECT page_id, page_id // 1000 AS file, coalesce(html, '') AS html,
            'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
            || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
            || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
            || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10)
            || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
          FROM pages),
        placed AS (
          SELECT page_id, file, CAST(strlen(record) AS BIGINT) AS length,
            CAST(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id) - strlen(record) AS BIGINT)
              AS "offset",
            page_id % 41 = 7 OR (page_id = max(page_id) OVER (PARTITION BY file) AND file % 5 = 0) AS lost, html
          FROM records)
        SELECT file, "offset", length, page_id,
          CASE WHEN lost THEN 'missing' ELSE 'changed' END AS status
        FROM placed
        WHERE lost OR (page_id * 7919 % 97 = 5 AND html <> '' AND html[1] <> '#')
          OR (page_id % 53 = 11 AND html <> '')""",
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
} | audit_queries.ORACLES
