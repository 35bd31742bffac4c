"""License scan by diagonal voting, in DataFrame operations only.

All rolling word pairs of all texts, and all runs of four words, are joined by their hash to the
places they have in license templates, short ones by pairs and long ones by fours. A hit votes for
its diagonal, text position less template position. Neighbouring diagonals, as words put in or left
out make them, are merged, and a span counts as a license if enough of the template stands in it and
all the words that tell it from its neighbours. A phrase template counts only where all its words do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM, LONG_GRAM = 2, 4  # words of a rolling hash, for short and for long templates
LONG_TEMPLATE = 40  # words
LEAST_SHARE = 0.6  # of a template's word pairs
GAP = 3  # diagonals this near to each other are merged
STRETCH = 1.5  # a span may be this much longer than its template

# Phrases and their labels (fixed values).
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Grants as the licenses word them: label, text, runs of words that have to stand in a place that
# counts, as they tell a license from its neighbours (fixed values).
GRANTS = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction",
        (),
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software and to permit persons to"
        " whom the software is furnished to do so subject to the following conditions the above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the software the software is provided as is without warranty of any kind"
        " express or implied including but not limited to the warranties of merchantability fitness"
        " for a particular purpose and noninfringement in no event shall the authors or copyright"
        " holders be liable for any claim damages or other liability whether in an action of contract"
        " tort or otherwise arising from out of or in connection with the software or the use or other"
        " dealings in the software",
        (),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file"
        " except in compliance with the license",
        ("apache license",),
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file"
        " except in compliance with the license you may obtain a copy of the license at http www"
        " apache org licenses license 2 0 unless required by applicable law or agreed to in writing"
        " software distributed under the license is distributed on an as is basis without warranties"
        " or conditions of any kind either express or implied see the license for the specific"
        " language governing permissions and limitations under the license",
        ("under the apache license",),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation",
        ("gnu general public license",),
    ),
    *(
        (
            f"{label}-{version.replace(' ', '.')}",
            "this program is free software you can redistribute it and or modify it under the terms"
            f" of the gnu {name} public license as published by the free software foundation either"
            f" version {version} of the license or at your option any later version this program is"
            " distributed in the hope that it will be useful but without any warranty without even"
            " the implied warranty of merchantability or fitness for a particular purpose see the"
            f" gnu {name} public license for more details",
            (f"gnu {name} public license", f"version {version} of the license"),
        )
        for label, name, version in (
            ("gpl", "general", "2"),
            ("gpl", "general", "3"),
            ("lgpl", "lesser general", "2 1"),
            ("lgpl", "lesser general", "3"),
            ("agpl", "affero general", "3"),
        )
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a"
        " copy of the mpl was not distributed with this file you can obtain one at http mozilla org"
        " mpl 2 0",
        ("mozilla public license", "v 2 0"),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        (),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met redistributions of source code"
        " must retain the above copyright notice this list of conditions and the following disclaimer"
        " redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials provided"
        " with the distribution",
        (),
    ),
    (
        "bsd-3-clause",
        "redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials provided"
        " with the distribution neither the name of the copyright holder nor the names of its"
        " contributors may be used to endorse or promote products derived from this software without"
        " specific prior written permission",
        ("neither the name of", "used to endorse or promote"),
    ),
    *(
        (f"cc-{kind.replace(' ', '-')}", f"licensed under cc {kind} 4 0", (f"cc {kind} 4",))
        for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
    ),
    *(
        (
            f"cc-{kind}",
            f"licensed under a creative commons {name} 4 0 international license",
            (f"commons {name} 4 0",),
        )
        for kind, name in (
            ("by", "attribution"),
            ("by-sa", "attribution sharealike"),
            ("by-nd", "attribution noderivatives"),
            ("by-nc", "attribution noncommercial"),
            ("by-nc-sa", "attribution noncommercial sharealike"),
            ("by-nc-nd", "attribution noncommercial noderivatives"),
        )
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to"
        " copy modify publish use compile sell or distribute this software either in source code form"
        " or as a compiled binary for any purpose commercial or non commercial and by any means",
        ("into the public domain",),
    ),
    (
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or"
        " neighboring rights to this work",
        ("waived all copyright",),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this permission"
        " notice appear in all copies",
        ("with or without fee",),
    ),
)

# Words are runs of ASCII letters and digits and of anything that is not ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BETWEEN), "")


def gram_words(words: Sequence[str]) -> int:
    """How many words the rolling hashes of a template span: short ones need their pairs."""
    return LONG_GRAM if len(words) >= LONG_TEMPLATE else GRAM


def template_grams(
    spark: SparkSession,
    phrases: Sequence[tuple[str, str]],
    grants: Sequence[tuple[str, ...]],
) -> DataFrame:
    """-> template, label, phrase, grams (of the template), musts, k, tpos, t0 to t3: a row per gram.

    `musts` are the places of grams that must be found: those that lie in a run of words that has
    to stand, or touch it where the run is shorter than a gram. A grant without such runs may be a
    pair of label and text.
    """
    rows = []
    every = [(label, text, ()) for label, text in phrases]
    every += [(grant[0], grant[1], grant[2] if len(grant) > 2 else ()) for grant in grants]
    for number, (label, text, runs) in enumerate(every):
        words = text.split()
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text!r}")
        k = gram_words(words)
        grams = [words[i : i + k] for i in range(len(words) - k + 1)]
        musts = set()
        for run in (r.split() for r in runs):
            first = next((i for i in range(len(words)) if words[i : i + len(run)] == run), None)
            if first is None:
                raise ValueError(f"{' '.join(run)!r} does not stand in {text!r}")
            if len(run) >= k:
                musts |= set(range(first, first + len(run) - k + 1))
            else:
                musts.add(min(first, len(grams) - 1))
        for i, gram in enumerate(grams):
            padded = [*gram, None, None][:LONG_GRAM]
            rows.append(
                (number, label, number < len(phrases), len(grams), sorted(musts), k, i, *padded)
            )
    schema = (
        "template int, label string, phrase boolean, grams int, musts array<int>, k int, tpos int,"
        " t0 string, t1 string, t2 string, t3 string"
    )
    return spark.createDataFrame(rows, schema)


def license_scan(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    grants: Sequence[tuple[str, ...]] = GRANTS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """-> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: a row per row.

    n_base counts all places where a phrase stands, first_word and last_word are the smallest and
    largest of their starts (null without any). base_labels come from phrases, labels from phrases
    and grants; both are distinct, sorted, joined by commas, and empty if there are none. score is
    the largest share of a template's grams found in a span, 1 for a phrase in full, 0 without
    a hit. A span counts only with all the words that tell a grant from its neighbours: what lacks
    the "nc" of a Creative Commons license is none that forbids commerce, however like one it is. Null and empty texts have no words; null ids and repeated rows give rows like others.
    The templates are a parameter of some hundred words and so may be broadcast.
    """
    spark = docs.sparkSession
    templates = template_grams(spark, phrases, grants)
    long = F.xxhash64("t0", "t1", "t2", "t3")
    templates = templates.withColumn("gram", F.when(F.col("k") == GRAM, F.xxhash64("t0", "t1")).otherwise(long))
    split = docs.select(
        docs["doc_id"],
        F.monotonically_increasing_id().alias("row"),
        words_of(docs["text"]).alias("words"),
    )
    after = [
        F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))).alias(f"w{i}")
        for i in range(1, LONG_GRAM)
    ]
    rolling = F.arrays_zip(F.col("words").alias("w0"), *after)
    placed = split.select(
        "doc_id", "row", F.size("words").alias("n_words"), F.posexplode_outer(rolling).alias("pos", "w")
    ).select("doc_id", "row", "n_words", "pos", "w.*")
    short, long = F.xxhash64("w0", "w1"), F.xxhash64("w0", "w1", "w2", "w3")
    kinds = F.array(
        F.struct(F.lit(GRAM).alias("span"), short.alias("gram")),
        F.struct(F.lit(LONG_GRAM).alias("span"), long.alias("gram")),
    )
    rolled = placed.select("*", F.inline(kinds))
    hits = rolled.join(F.broadcast(templates), "gram", "left")
    hit = (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (F.col("k") == F.col("span"))
    hit &= (F.col("k") == GRAM) | ((F.col("w2") == F.col("t2")) & (F.col("w3") == F.col("t3")))
    # The first word of a text, or the lack of any, stands for the text itself.
    opening = (F.coalesce(F.col("pos"), F.lit(0)) == 0) & (F.col("span") == GRAM)
    hits = hits.filter(hit | opening)
    real = F.coalesce(hit, F.lit(False))
    text = ["doc_id", "row", "n_words"]
    diagonals = hits.groupBy(
        *text,
        F.when(real, F.col("template")).alias("template"),
        F.when(real, F.col("pos") - F.col("tpos")).alias("diagonal"),
    ).agg(
        F.first("label").alias("label"),
        F.first("phrase").alias("phrase"),
        F.first("grams").alias("grams"),
        F.first("musts").alias("musts"),
        F.first("k").alias("k"),
        F.collect_set("tpos").alias("votes"),  # no more than the template has
        F.min("pos").alias("low"),
        F.max("pos").alias("high"),
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(True))
    numbered = diagonals.withColumn("opens", apart.cast("int")).withColumn(
        "cluster", F.when(F.col("phrase"), F.col("diagonal")).otherwise(F.sum("opens").over(along))
    )
    spans = numbered.groupBy(*text, "template", "cluster").agg(
        F.first("label").alias("label"),
        F.first("phrase").alias("phrase"),
        F.first("grams").alias("grams"),
        F.first("diagonal").alias("start"),
        F.first("musts").alias("musts"),
        F.first("k").alias("k"),
        F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
        (F.max("high") - F.min("low") + F.first("k")).alias("length"),
    )
    spans = spans.withColumn("voted", F.size("votes"))
    told = F.coalesce(F.size(F.array_except("musts", "votes")) == 0, F.lit(True))
    share = F.coalesce(F.col("voted") / F.col("grams"), F.lit(0.0))
    verified = (F.col("length") <= (F.col("grams") + F.col("k") - 1) * STRETCH) & told
    base = F.coalesce(F.col("phrase") & (F.col("voted") == F.col("grams")), F.lit(False))
    found = F.coalesce(base | (~F.col("phrase") & verified & (share >= least_share)), F.lit(False))
    counts = F.col("phrase").isNotNull() & (base | ~F.col("phrase")) & (verified | base)

    def labels(which: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")

    return (
        spans.groupBy(*text)
        .agg(
            F.sum(base.cast("long")).alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            labels(base).alias("base_labels"),
            labels(found).alias("labels"),
            F.max(F.when(counts, share).otherwise(0.0)).alias("score"),
        )
        .select(
            "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word",
            "last_word", "base_labels", "labels", "score",
        )
    )
