"""License scan by diagonal voting: word k-grams joined to template positions, hits added up by diagonal.

Templates are short phrases and longer notices. All rolling k-grams of all texts
are joined by hash to the k-grams of the templates and compared as words. A hit
at word d of a text and word t of a template votes for the diagonal d - t: where
the template would begin. A phrase stands where its diagonal has all its votes.
For notices the votes of up to ``DRIFT`` neighbouring diagonals are merged, since
words put in or left out move the rest of a copy; the merged place is verified by the
share of the template's words that its hits cover, and the best of
neighbouring places is kept.

Every group is bounded: a diagonal holds at most a template's k-grams, a merged place
DRIFT + 1 diagonals. Templates are a parameter and are broadcast (MAX_GRAMS bounds them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ready, written

GRAM = 3
DRIFT = 6
#: A notice is found by this share of its words; one of fewer than ``SHORT`` words must be whole.
SHARE, SHORT = 0.8, 15
#: The bound of the broadcast template table.
MAX_GRAMS = 50_000

# The separators of words, the base phrases and the notices with their labels.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                 "license at http www apache org licenses license 2 0"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license "
                 "is distributed on an as is basis without warranties or conditions of any kind"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc0", "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under "
            "copyright law"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("boost", "boost software license version 1 0"),
    ("mit", "the mit license"),
)


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES, k: int = GRAM) -> DataFrame:
    """template, label, size (words), phrase, t, gram: the rolling k-grams of all templates."""
    rows = []
    for number, (label, text) in enumerate([*phrases, *notices]):
        words = text.split(" ")
        if len(words) < k:
            raise ValueError(f"a template needs at least {k} words: {text!r}")
        rows += [(number, label, len(words), number < len(phrases), t, " ".join(words[t:t + k]))
                 for t in range(len(words) - k + 1)]
    if len(rows) > MAX_GRAMS:
        raise ValueError(f"{len(rows)} template grams, more than {MAX_GRAMS}")
    return spark.createDataFrame(rows, "template int, label string, size int, phrase boolean, t int, gram string")


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def scanned(docs: DataFrame, templates: DataFrame, k: int = GRAM) -> DataFrame:
    """One row a document (d = -1: row, doc_id, n_words) and one for each hit (row, template, t, d).

    One pass: a document's k-grams are exploded and joined to the templates by
    hash; what does not meet one is dropped, but for the document's own entry.
    """
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), BETWEEN), "").alias("words"))
    n = F.size("words")
    rolled = F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.concat_ws(
        " ", *[F.element_at("words", i + j) for j in range(k)]))).otherwise(F.array().cast("array<string>"))
    own = F.array(F.lit(None).cast("string"))
    each = words.select("row", "doc_id", n.cast("bigint").alias("n_words"), F.posexplode(F.concat(own, rolled)).alias("p", "seen"))
    known = templates.select("template", "t", "gram", F.xxhash64("gram").alias("hash"))
    joined = each.withColumn("hash", F.xxhash64(F.lower("seen"))).join(F.broadcast(known), "hash", "left")
    hit = F.col("template").isNotNull() & (lowered(F.col("seen")) == F.col("gram"))
    return joined.filter((F.col("p") == 0) | hit).select(
        "row", "doc_id", "n_words", F.when(F.col("p") > 0, F.col("template")).alias("template"), "t",
        (F.col("p") - 1).cast("bigint").alias("d"))


def places(hits: DataFrame, templates: DataFrame, k: int = GRAM, drift: int = DRIFT) -> DataFrame:
    """row, label, phrase, size, first, last, share: where a template stands, the best of neighbouring places.

    ``share`` is the share of the template's words covered by hits; phrases are
    listed only where they stand whole. ``first`` and ``last`` are the words that the hits span.
    """
    about = templates.select("template", "label", "size", "phrase").distinct()
    votes = (hits.groupBy("row", "template", (F.col("d") - F.col("t")).alias("diagonal"))
             .agg(F.collect_set("t").alias("ts"), F.min("d").alias("first"), (F.max("d") + k - 1).alias("last"))
             .join(F.broadcast(about), "template"))
    whole = (votes.filter(F.col("phrase") & (F.size("ts") == F.col("size") - k + 1))
             .select("row", "label", "phrase", "size", "first", "last", F.lit(1.0).alias("share")))
    ordered = Window.partitionBy("row", "template").orderBy("diagonal")
    ahead = ordered.rangeBetween(0, drift)
    merged = votes.filter(~F.col("phrase")).select(
        "row", "template", "label", "phrase", "size", "diagonal", F.min("first").over(ahead).alias("first"),
        F.max("last").over(ahead).alias("last"), F.array_distinct(F.flatten(F.collect_list("ts").over(ahead))).alias("ts"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + (k - 1))))))
    rated = merged.withColumn("share", covered / F.col("size"))
    best = F.max(F.struct("share", -F.col("diagonal"))).over(ordered.rangeBetween(-drift, drift))
    kept = rated.withColumn("best", best).filter((F.col("share") == F.col("best.share"))
                                                 & (F.col("diagonal") == -F.col("best.col2")))
    return whole.unionByName(kept.select("row", "label", "phrase", "size", "first", "last", "share"))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = GRAM, drift: int = DRIFT) -> tuple[DataFrame, DataFrame]:
    """(documents: row, doc_id, n_words; places as in ``places``, strongest first), both written tables."""
    spark = ready(docs.sparkSession)
    templates = template_grams(spark, phrases, notices, k)
    both = written(scanned(docs, templates, k), "license-hits")
    hits = both.filter("template is not null").select("row", "template", "t", "d")
    return both.filter("template is null").select("row", "doc_id", "n_words"), written(
        places(hits, templates, k, drift).orderBy(F.desc("share")), "license-places")


def report(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document.

    Base columns count the places of the phrases. ``labels`` adds the notices with at least ``share``
    of their words (short ones: all) in one place; ``score`` is the largest share of any place (a phrase: 1). A null text has no words;
    null ids are ordinary; repeated rows are reported each; an empty table gives an empty result; other columns are ignored.
    """
    documents, found = scan(docs)
    base = F.col("phrase")
    told = F.col("share") >= F.when(F.col("size") < SHORT, F.lit(1.0)).otherwise(F.lit(share))
    counted = found.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"), F.collect_set(F.when(base, F.col("label"))).alias("base"),
        F.collect_set(F.when(told, F.col("label"))).alias("all"), F.max("share").alias("score"))
    joined = documents.join(counted, "row", "left")
    text = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return joined.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
                         "first_word", "last_word", text("base").alias("base_labels"), text("all").alias("labels"),
                         F.coalesce("score", F.lit(0.0)).alias("score"))
