"""License scans by diagonal voting, in DataFrame functions only.

All rolling word k-grams of a text are hashed and joined with the k-grams of
license templates. A match at word ``p`` of the text and ``q`` of a template votes
for the diagonal ``p - q``; votes are counted per document, template and
diagonal, neighbouring diagonals of a long template (words put in or left out)
are merged, and a merged span holds if enough of the template's k-grams are
found within a span of about its length. Every match is verified by its words,
so a hash alone decides nothing. Phrases must stand word for word: all their
k-grams on one diagonal.

The template table is fixed and small, so it is broadcast; texts are not
shuffled, only their matches and one row for each document.

Defined results: null and wordless texts have no words, no labels and score 0;
repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyflow.llm.common import comma_sorted, load_table, row_id, text_of

# The base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Phrases and public license notices of the method.
MORE_PHRASES = {
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "mit license": "mit",
    "apache license version 2 0": "apache-2.0", "mozilla public license": "mpl", "bsd 3 clause": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause", "affero general public license": "agpl", "lesser general public license": "lgpl",
    "general public license version 2": "gpl-2.0", "general public license version 3": "gpl-3.0",
    "creative commons attribution": "cc-by", "public domain dedication": "public-domain",
}
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files the software to deal in the software without restriction including "
           "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
           "of the software and to permit persons to whom the software is furnished to do so subject to the "
           "following conditions the above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the software",
    "apache-2.0": "licensed under the apache license version 2 0 the license you may not use this file except in "
                  "compliance with the license you may obtain a copy of the license at http www apache org licenses "
                  "license 2 0 unless required by applicable law or agreed to in writing software distributed under "
                  "the license is distributed on an as is basis without warranties or conditions of any kind either "
                  "express or implied",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation either version 3 of the license or at your "
           "option any later version this program is distributed in the hope that it will be useful but without any "
           "warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
           "that the following conditions are met redistributions of source code must retain the above copyright "
           "notice this list of conditions and the following disclaimer",
}
PHRASE_K, NOTICE_K = 2, 5
LEAST_SHARE = 0.5      # of a notice's k-grams
NO_MATCH = -1          # stands for the template in the row that every document has
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words, A-Z lower-cased. The two letters outside ASCII whose lower case is in it become another letter first."""
    plain = F.lower(F.regexp_replace(text, "[Kİ]", "é"))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def _grams(words: Column, size: Column, k: int) -> Column:
    """Rows of (pos, w0 .. w<k-1>) for each word, blanks after the last; one row for a text without words."""
    many = F.greatest(size, F.lit(1))
    padded = F.concat(words, F.array(*[F.lit("")] * k))
    return F.arrays_zip(F.sequence(F.lit(0), many - 1).alias("pos"),
                        *[F.slice(padded, F.lit(i + 1), many).alias(f"w{i}") for i in range(k)])


def _joined(k: int) -> Column:
    return F.concat_ws(" ", *[f"w{i}" for i in range(k)])


def templates(spark: SparkSession, k: int, texts: list[tuple[int, str]]) -> DataFrame:
    """Per k-gram hash of (number, text) templates: where it stands, (t, q, gram)."""
    rows = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(x).alias("x"))
                                                     for t, x in texts])).alias("r")).select("r.*")
    words = F.split("x", " ")
    grams = (rows.select("t", F.size(words).alias("n"), F.inline(_grams(words, F.size(words), k)))
             .where(F.col("pos") <= F.col("n") - k))
    return (grams.select(F.xxhash64(*[f"w{i}" for i in range(k)]).alias(f"h{k}"),
                         F.struct("t", F.col("pos").alias("q"), _joined(k).alias("gram")).alias("place"))
            .groupBy(f"h{k}").agg(F.collect_list("place").alias(f"places{k}")))


def _all_templates() -> list[tuple[str, str, bool]]:
    """(label, text, whether it is a phrase); base phrases first."""
    return ([(label, text, True) for text, label in (BASE_PHRASES | MORE_PHRASES).items()]
            + [(label, text, False) for label, text in NOTICES.items()])


def _per_template(values: list, t: str = "t") -> Column:
    """The template's value; null for a row without a match."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(t))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, and ``spans``, an array by first word of
    (first, last, t, share): verified places of template ``t``, and ``best``, the largest share of a notice found."""
    table = _all_templates()
    size = [len(x.split()) for _, x, _ in table]
    ks = [PHRASE_K if phrase else NOTICE_K for _, _, phrase in table]
    base = docs.select(row_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       words_of(text_of(text_col)).alias("words")).select(
        "rid", "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.inline(_grams(F.col("words"), F.size("words"), NOTICE_K)))
    hashed = base.select("*", *[F.xxhash64(*[f"w{i}" for i in range(k)]).alias(f"h{k}") for k in (PHRASE_K, NOTICE_K)])
    for k in (PHRASE_K, NOTICE_K):
        own = [(t, x) for t, (_, x, _) in enumerate(table) if ks[t] == k]
        # bounded: the fixed templates above
        hashed = hashed.join(F.broadcast(templates(docs.sparkSession, k, own)), f"h{k}", "left")
    none = F.array().cast("array<struct<t:int,q:int>>")

    def verified(k: int) -> Column:
        held = F.filter(f"places{k}", lambda x: x["gram"] == _joined(k))
        return F.when(F.col(f"places{k}").isNull(), none).otherwise(
            F.transform(held, lambda x: F.struct(x["t"].alias("t"), x["q"].alias("q"))))
    hits = (hashed.where(f"pos = 0 or places{PHRASE_K} is not null or places{NOTICE_K} is not null")
            .select("rid", "doc_id", "n_words", "pos", F.concat(verified(PHRASE_K), verified(NOTICE_K)).alias("at"))
            .where("pos = 0 or size(at) > 0")
            .select("rid", "doc_id", "n_words", "pos", F.explode(F.when(F.size("at") > 0, F.col("at")).otherwise(
                F.array(F.struct(F.lit(NO_MATCH).alias("t"), F.lit(0).alias("q"))))).alias("at")))
    # one exchange by document; what follows groups within it
    votes = (hits.select("rid", "doc_id", "n_words", "pos", "at.t", (F.col("pos") - F.col("at.q")).alias("diagonal"))
             .repartition("rid").groupBy("rid", "doc_id", "n_words", "t", "diagonal")
             .agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high")))
    # words put in or left out move the diagonal: those within a notice's length are one place of it, as long
    # as together they span less than that length (where they do not, they are parted at that width)
    along = Window.partitionBy("rid", "t").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    width = F.when(_per_template([p for _, _, p in table]), F.lit(1)).otherwise(_per_template(size))
    run = Window.partitionBy("rid", "t", "cluster")
    merged = (votes.withColumn("new", F.coalesce((gap >= width).cast("int"), F.lit(0)))
              .withColumn("cluster", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("bin", F.floor((F.col("diagonal") - F.min("diagonal").over(run)) / width))
              .groupBy("rid", "doc_id", "n_words", "t", "cluster", "bin")
              .agg(F.sum("votes").alias("votes"), F.min("low").alias("first"), F.max("high").alias("high"))
              .withColumn("last", F.col("high") + _per_template(ks) - 1)
              .withColumn("share", F.least(F.lit(1.0), F.col("votes") / (_per_template(size) - _per_template(ks) + 1))))
    fits = F.when(_per_template([p for _, _, p in table]), F.col("share") >= 1).otherwise(F.col("share") >= LEAST_SHARE)
    notice = F.when(~_per_template([p for _, _, p in table]), F.col("share"))
    span = F.when(fits & (F.col("t") != NO_MATCH), F.struct("first", "last", "t", "share"))
    return (merged.groupBy("rid", "doc_id", "n_words")
            .agg(F.array_sort(F.collect_list(span)).alias("spans"), F.max(notice).alias("best")).drop("rid"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents; ``score`` is 1 with a phrase, else the largest share of a notice found."""
    labels = F.array(*[F.lit(label) for label, _, _ in _all_templates()])
    base = F.filter("spans", lambda s: s["t"] < len(BASE_PHRASES))
    firsts = F.transform(base, lambda s: s["first"].cast("bigint"))

    def named(spans: Column) -> Column:
        return comma_sorted(F.transform(spans, lambda s: F.element_at(labels, s["t"] + 1)))
    return license_spans(load_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), named(base).alias("base_labels"), named(F.col("spans")).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("spans") > 0, F.array_max(
            F.transform("spans", lambda s: s["share"]))).otherwise(0.0)).alias("score"))
