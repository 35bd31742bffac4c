"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

Lines are paragraphs. A section opens with the first one, after a blank line, at a heading, and at
a paragraph whose digest says so, about one in SECTION: so sections stay where they are when
paragraphs are put in or taken out elsewhere. Roots are equal if and only if texts are; to locate an
edit, sections are compared first and paragraphs only within the sections that differ. Below the
paragraphs lie pieces of a few words, whose hashes and sizes give the likeness of two texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION = 16  # paragraphs to a section, on average, where a text has neither headings nor blank lines
PIECE_WORDS = 8
BUCKET_ROWS = 64
FAN = 128  # buckets of neighbouring ids are found in two steps of at most FAN each
ORPHANS = 1024  # buckets of rows without an id

# What ends a piece: white space and punctuation. A line break always does.
_STOP = r"\x09-\x0D\x20.,;:!?|"
PIECE = (
    rf"(?:[^{_STOP}]{{1,64}}[\x09\x0B-\x0D\x20]*){{1,{PIECE_WORDS}}}[{_STOP}]*|[{_STOP}]+"
)


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def leaves(text: Column) -> Column:
    """The distinct pieces of a text, in order: 24 bits of their MD5 over 8 bits of their length."""

    def packed(piece: Column) -> Column:
        bits = F.conv(F.substring(F.md5(piece), 1, 6), 16, 10).cast("bigint")
        return bits * 256 + F.least(F.lit(255), F.length(piece))

    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), packed))


def _weight(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda total, piece: total + piece % 256)


def likeness(a: Column, b: Column) -> Column:
    """The share, 0 to 1, of the pieces of both texts, by their lengths, that both have.

    1 for two texts without any piece.
    """
    total = _weight(a) + _weight(b)
    shared = _weight(F.array_intersect(a, b)) * 2
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with the tree of a text column that has no nulls, in columns that begin with `name`.

    `_paragraphs`: digest of each paragraph. `_starts`: the number, from 1, of the first paragraph
    of each section. `_sections`: digest of each section. `_root`: the root.
    """
    paragraphs, starts, sections = f"{name}_paragraphs", f"{name}_starts", f"{name}_sections"
    lines = f"{name}_lines"
    df = df.withColumn(lines, F.split(F.col(text), "\n"))
    df = df.withColumn(
        paragraphs, F.transform(lines, lambda line: F.sha2(F.concat(F.lit("p"), line).cast("binary"), 256))
    )

    def opens(i: Column) -> Column:
        chosen = F.conv(F.substring(F.element_at(paragraphs, i), 1, 4), 16, 10).cast("int") % SECTION == 0
        heading = F.startswith(F.element_at(lines, i), F.lit("#"))
        after_blank = F.trim(F.element_at(lines, F.greatest(i - 1, F.lit(1)))) == ""
        return (i == 1) | chosen | heading | after_blank

    count = F.size(paragraphs)
    df = df.withColumn(starts, F.filter(F.sequence(F.lit(1), count), opens))

    def section(start: Column, number: Column) -> Column:
        end = F.coalesce(F.get(F.col(starts), number + 1), count + 1)
        joined = F.array_join(F.slice(paragraphs, start, end - start), "")
        return F.sha2(F.concat(F.lit("s"), joined).cast("binary"), 256)

    df = df.withColumn(sections, F.transform(starts, section))
    root = F.sha2(F.concat(F.lit("r"), F.array_join(sections, "")).cast("binary"), 256)
    return df.withColumn(f"{name}_root", root).drop(lines)


def fingerprint(root: Column, sections: Column, pieces: Column) -> Column:
    """Root, beginnings of the section digests and pieces as text: what two texts are compared by."""
    short = F.transform(sections, lambda s: F.substring(s, 1, 16))
    return F.concat_ws(":", root, F.array_join(short, ","), F.array_join(pieces.cast("array<string>"), ","))


def _unlike(a: Column, b: Column) -> Column:
    """Position from 1 of the first place where two arrays differ, 0 if they do not."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.array_position(same, F.lit(False)), F.lit(0))


def with_edit(df: DataFrame, a: str, b: str) -> DataFrame:
    """`df`, which has the trees `a` and `b`, with edit_first and edit_last.

    These are the first and last paragraph of `a` that are not those of `b`, counted from the start
    and from the end; null where the roots are equal. If paragraphs were only put in, edit_last is
    edit_first less one. Only sections that differ are looked into.
    """
    made = {}
    for name in (a, b):
        starts, paragraphs = F.col(f"{name}_starts"), F.col(f"{name}_paragraphs")
        made[name] = starts, paragraphs, F.col(f"{name}_sections")
    head = F.array_position(
        F.zip_with(made[a][2], made[b][2], lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False)
    )
    tail = F.array_position(
        F.zip_with(F.reverse(made[a][2]), F.reverse(made[b][2]), lambda x, y: F.coalesce(x == y, F.lit(False))),
        F.lit(False),
    )
    # Sections before `_head` and the last `_tail` - 1 are alike; zip_with pads the shorter side.
    df = df.withColumns({"_head": head.cast("int"), "_tail": tail.cast("int")})
    first, skipped = {}, {}
    for name, (starts, paragraphs, sections) in made.items():
        first[name] = F.coalesce(F.get(starts, F.col("_head") - 1), F.size(paragraphs) + 1)
        kept = F.size(sections) - F.col("_tail") + 1  # sections up to the last one that differs
        skipped[name] = F.size(paragraphs) + 1 - F.coalesce(
            F.when(kept >= 0, F.get(starts, kept)), F.when(kept >= 0, F.size(paragraphs) + 1), F.lit(1)
        )
    rest = {n: F.slice(made[n][1], first[n], F.size(made[n][1])) for n in (a, b)}
    ahead = first[a] + F.array_position(
        F.zip_with(rest[a], rest[b], lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False)
    ) - 1
    front = {n: F.slice(made[n][1], 1, F.size(made[n][1]) - F.least(skipped[a], skipped[b])) for n in (a, b)}
    behind = F.least(skipped[a], skipped[b]) + F.array_position(
        F.zip_with(F.reverse(front[a]), F.reverse(front[b]), lambda x, y: F.coalesce(x == y, F.lit(False))),
        F.lit(False),
    ) - 1
    df = df.withColumns({"_ahead": ahead, "_behind": behind})
    # A paragraph counts as unchanged from one side only.
    least = F.least(F.size(made[a][1]), F.size(made[b][1]))
    last = F.size(made[a][1]) - F.least(F.col("_behind"), least - (F.col("_ahead") - 1))
    alike = F.col(f"{a}_root") == F.col(f"{b}_root")
    return df.withColumns(
        {
            "edit_first": F.when(~alike, F.col("_ahead")).cast("bigint"),
            "edit_last": F.when(~alike, last).cast("bigint"),
        }
    ).drop("_head", "_tail", "_ahead", "_behind")


def fingerprints(docs: DataFrame) -> DataFrame:
    """-> doc_id, n_chars, root, sections, paragraphs, starts, pieces, fingerprint: a row per row.

    Null texts count as empty, and an empty text is one empty paragraph, so equal texts have equal
    trees whatever their ids. No shuffle; other columns are not read.
    """
    texts = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    tree = with_tree(texts, "text", "t").withColumn("pieces", leaves(F.col("text")))
    return tree.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.col("t_root").alias("root"),
        F.col("t_sections").alias("sections"),
        F.col("t_paragraphs").alias("paragraphs"),
        F.col("t_starts").alias("starts"),
        "pieces",
        fingerprint(F.col("t_root"), F.col("t_sections"), F.col("pieces")).alias("fingerprint"),
    )


def _firsts(docs: DataFrame, bucket_rows: int) -> list[int]:
    """The smallest ids of buckets of neighbouring ids, ascending: FAN * FAN of them at most."""
    ids = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    buckets = min(FAN * FAN, -(-ids.count() // bucket_rows))
    if buckets <= 1:
        return [r[0] for r in ids.agg(F.min("doc_id")).collect() if r[0] is not None]
    shares = [i / buckets for i in range(buckets)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 10 * FAN * FAN)).first()[0]
    bounds = [-(2**63), *sorted(set(found))]
    place, _ = _bucket(F.col("doc_id"), bounds)
    least = ids.groupBy(place.alias("bucket")).agg(F.min("doc_id").alias("first"))
    return sorted(r.first for r in least.select("first").collect())


def _bucket(key: Column, firsts: list[int]) -> tuple[Column, Column]:
    """-> the number, from 0, of the last of `firsts` that is not above `key`, and that first."""
    groups = [firsts[i : i + FAN] for i in range(0, len(firsts), FAN)]

    def number(i: int) -> str:
        return f"{i}L" if i > -(2**63) else "(-9223372036854775807L - 1L)"

    def listed(values: list[int]) -> str:
        return f"array({','.join(map(number, values))})"

    heads = F.expr(listed([g[0] for g in groups]))
    tables = F.expr(f"array({','.join(map(listed, groups))})")
    group = F.greatest(F.size(F.filter(heads, lambda h: h <= key)), F.lit(1))
    within = F.filter(F.get(tables, group - 1), lambda h: h <= key)
    return (group - 1) * FAN + F.size(within) - 1, F.get(within, F.size(within) - 1)


def with_next(docs: DataFrame, columns: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, text, ... -> the same with next_<column> of the row that follows by ascending id.

    The first row follows the last. Rows of one id go by their texts. Rows without an id have no
    next one (null). Whole rows move once, into buckets of neighbouring ids; a row that opens
    a bucket is also copied to the bucket before it. What the driver learns are at most FAN * FAN
    ids. Rows that repeat one id lie in one bucket.
    """
    firsts = _firsts(docs, bucket_rows)
    doc_id = F.col("doc_id").cast("bigint")
    own, first = _bucket(doc_id, firsts) if firsts else (F.lit(0), F.lit(None).cast("bigint"))
    orphan = -1 - F.pmod(F.xxhash64("text"), F.lit(ORPHANS)).cast("int")
    place = F.when(doc_id.isNull(), orphan).otherwise(own)
    places = F.when(
        first == doc_id, F.array(F.struct(own.alias("b"), F.lit(0).alias("c")), F.struct(
            F.when(own == 0, len(firsts) - 1).otherwise(own - 1).alias("b"), F.lit(1).alias("c")))
    ).otherwise(F.array(F.struct(place.alias("b"), F.lit(0).alias("c"))))
    dealt = docs.withColumn("_places", places).select("*", F.inline("_places").alias("_bucket", "_copy"))
    line = Window.partitionBy("_bucket").orderBy("_copy", "doc_id", "text")
    following = {
        f"next_{c}": F.when(F.col("_bucket") >= 0, F.lead(c).over(line)) for c in columns
    }
    return dealt.withColumns(following).filter("_copy = 0").drop("_places", "_bucket", "_copy")


def compare_edits(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every document against its edited text and against the document that follows it.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many, or
    all, of the text that follows by id. -> doc_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next, changed (sections of the text that the edited
    one lacks), edit_first, edit_last: a row per row.

    A null text counts as empty. Of rows with one id each is followed by the next by text. A row
    without an id is followed by nothing: its edited text loses its end, and near_next is its
    likeness to an empty text. The last id is followed by the first, so a document alone is followed by itself.
    """
    texts = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    texts = texts.withColumn("pieces", leaves(F.col("text")))
    met = with_next(texts, ["text", "pieces"], bucket_rows)
    met = met.withColumn("n_chars", F.length("text").cast("bigint"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
        F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), quarter),
    )
    met = met.withColumn("edited", edited).withColumn("edited_pieces", leaves(F.col("edited")))
    met = with_edit(with_tree(with_tree(met, "text", "t"), "edited", "e"), "t", "e")
    none = F.array().cast("array<bigint>")
    return met.select(
        "doc_id",
        "n_chars",
        "edited",
        fingerprint(F.col("t_root"), F.col("t_sections"), F.col("pieces")).alias("fingerprint"),
        fingerprint(F.col("e_root"), F.col("e_sections"), F.col("edited_pieces")).alias("edited_fingerprint"),
        likeness(F.col("pieces"), F.col("edited_pieces")).alias("near_edited"),
        likeness(F.col("pieces"), F.coalesce("next_pieces", none)).alias("near_next"),
        F.size(F.array_except("t_sections", "e_sections")).cast("bigint").alias("changed"),
        "edit_first",
        "edit_last",
    )
