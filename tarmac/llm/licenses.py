"""License scan by diagonal voting (DataFrame functions only).

Words are lower-cased runs of letters and digits. All rolling ``K``-word hashes of a text
are matched with those of the license templates: grams whose hash no template has are
dropped in the row, the rest are joined with the template positions (a small fixed
table, broadcast) and confirmed by their words. A match at text word p and template word
q votes for the diagonal p - q. Votes are counted per text, template and diagonal;
diagonals apart by at most ``DRIFT`` words, or a fourth of the template's if that is more,
are merged, so words put in or left out do not split a passage; and a merged passage is
verified by the share of voting grams found and by the length of its span.

The base phrases are templates that must match whole on one diagonal: each full diagonal
is one place. Other labels come from notices that may be changed: opening lines, and the
notices that the licenses ask for in whole (a label may have several). A notice's gram votes
if the notice holds it once and not both of its words are ``COMMON``, so a place in the text
votes for one diagonal of a notice, and ordinary prose hardly votes at all. The notice of
the GPL tells no version, that of Creative Commons no variant: they differ in a word or two.

Defined cases: a null text has no words. Rows keep their number by position in their
input partition, so repeated rows and ids are reported once each. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 2
DRIFT = 2  # words
DRIFT_SHARE = 4  # or one word in so many of the template
COVERAGE = 0.7
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that count as base labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Notices for the method's own labels (fixed values: wording of public licenses).
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at http www apache org licenses license "
                   "2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied "
                   "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "general public license as published by the free software foundation either version 3 of the license "
                   "or at your option any later version"),
    ("gpl-notice", "this program is distributed in the hope that it will be useful but without any warranty without even "
                   "the implied warranty of merchantability or fitness for a particular purpose see the gnu general public "
                   "license for more details"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
            "permit persons to whom the software is furnished to do so subject to the following conditions the above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met redistributions of source code must retain the above copyright notice this "
            "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
            "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
            "materials provided with the distribution"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
                "was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("creative-commons", "this work is licensed under the creative commons attribution 4 0 international license to view "
                         "a copy of this license visit http creativecommons org licenses by 4 0 or send a letter to "
                         "creative commons po box 1866 mountain view ca 94042 usa"),
    ("public-domain", "dedicated the work to the public domain by waiving all of his or her rights to the work"),
)
# Words whose pairs do not vote for a notice (fixed values).
COMMON = frozenset("a all an and any are as at by for in is it of on or that the this to under with you".split())


def template_grams() -> list[tuple[int, str, bool, int, int, int, str, str]]:
    """(template, label, base, its voting grams, its words, position, first word, second word) of the voting grams."""
    out = []
    listed = [(True, *x) for x in PHRASES] + [(False, *x) for x in NOTICES]
    for number, (base, label, phrase) in enumerate(listed):
        words = phrase.split()
        grams = [tuple(words[i:i + K]) for i in range(len(words) - K + 1)]
        voting = [i for i, g in enumerate(grams) if base or (grams.count(g) == 1 and not COMMON.issuperset(g))]
        out += [(number, label, base, len(voting), len(words), i, *grams[i]) for i in voting]
    return out


def text_words(text: Column) -> Column:
    """Words with A-Z alone in lower case (the Kelvin sign, which ``lower`` makes a k, stays)."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))


def gram_hits(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, p, w1, w2, h: matched grams; one row with null p if none."""
    grams = template_grams()
    known = [F.xxhash64(F.lit(a), F.lit(b)) for a, b in sorted({g[6:] for g in grams})]
    step = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_words(F.col("text")).alias("words"))
    step = step.withColumn("n", F.size("words"))
    places = F.when(F.col("n") >= K, F.sequence(F.lit(0), F.col("n") - K)).otherwise(F.array().cast("array<int>"))
    gram = lambda i: F.xxhash64(*(F.col("words")[i + k] for k in range(K)))
    step = step.withColumn("at", F.filter(places, lambda i: gram(i).isin(known)))
    hits = F.transform("at", lambda i: F.struct(i.cast("long").alias("p"), F.col("words")[i].alias("w1"), F.col("words")[i + 1].alias("w2")))
    step = step.select("row", "doc_id", F.col("n").cast("long").alias("n_words"), F.explode_outer(hits).alias("hit"))
    return step.select("row", "doc_id", "n_words", "hit.p", "hit.w1", "hit.w2", F.xxhash64("hit.w1", "hit.w2").alias("h"))


def scan(spark: SparkSession, docs: DataFrame, coverage: float = COVERAGE, drift: int = DRIFT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    schema = "template int, label string, base boolean, grams int, size int, q int, t1 string, t2 string"
    templates = spark.createDataFrame(template_grams(), schema).withColumn("h", F.xxhash64("t1", "t2"))
    matched = gram_hits(docs).join(F.broadcast(templates), "h", "left")
    confirmed = (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    kind = ("row", "doc_id", "n_words", "template", "label", "base", "grams", "size")
    voted = matched.groupBy(*kind, F.when(confirmed, F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    # neighbouring diagonals of a notice are one passage; a base phrase needs its own
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    most = F.greatest(F.lit(drift), F.floor(F.col("size") / DRIFT_SHARE))
    voted = voted.withColumn("fresh", F.when(F.col("base") | gap.isNull() | (gap > most), 1).otherwise(0))
    voted = voted.withColumn("passage", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    passages = voted.groupBy(*kind, "passage").agg(
        F.sum("votes").alias("votes"), F.min("diagonal").alias("diagonal"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    share = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    # a span longer than the notice and its drift holds votes of separate places
    fitting = (F.col("hi") - F.col("lo") + K) <= F.col("size") + most
    found = F.when(F.col("diagonal").isNull(), False).when(F.col("base"), F.col("votes") == F.col("grams")).otherwise(
        fitting & (share >= coverage))
    whole = F.coalesce(F.col("base"), F.lit(False)) & found
    text = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return passages.groupBy("row", "doc_id", "n_words").agg(
        F.sum(whole.cast("long")).alias("n_base"), F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"), text(F.when(whole, F.col("label"))).alias("base_labels"),
        text(F.when(found, F.col("label"))).alias("labels"),
        F.max(F.when(found, share).otherwise(0.0)).alias("score")).drop("row")
