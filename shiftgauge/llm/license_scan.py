"""License notices in texts, by diagonal voting; DataFrame functions only.

Every run of ``K`` words of every text is hashed and joined to its positions in the
templates. A notice copied into a text keeps its words in step, so its runs meet the
template on one diagonal (position in the text less position in the template). Votes are
counted per text, template and diagonal; diagonals that lie next to each other (a word was
added or left out) are merged; the merged span is verified by the share of the template's
runs it holds, in order.

Short phrases are templates of their own that must be there whole: a full diagonal is
exactly a place where the phrase's words stand one after the other. Longer templates are
notices; they add labels of their own.

The templates are broadcast; they are literals of the query, so their size is known. Words
are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. NULL is an empty text; a text
without words or notices gets a row without labels; repeated rows are answered each; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

K = 3
GAP = 4  # words that may be added or left out between neighbouring diagonals
LEAST = 0.6  # share of a notice's runs
LEAST_SHORT = 0.9  # of notices with fewer than ten runs, which may differ in one word alone

# Phrases and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Passages of common notices, as words in lower case.
NOTICES = [
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms"
        " of the gnu lesser general public license as published by the free software foundation",
    ),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
    ),
    (
        "apache-2-text",
        "you may not use this file except in compliance with the license you may obtain a copy"
        " of the license at http www apache org licenses license 2 0",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    (
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
    ),
]

_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words, A-Z not yet lower-cased, without the empty ones at the ends."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), lambda w: w != "")


def _run(array: Column, at: Column, k: int = K) -> Column:
    """The run of ``k`` words from position ``at`` on, A-Z lower-cased; NULL beyond the end."""
    parts = [F.get(array, at + i) for i in range(k)]
    # All letters of the templates are a to z; only A-Z and the Kelvin sign become such.
    return F.lower(F.concat_ws(" ", *parts))


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """template, label, exact, n_runs, at, run: one row per run of each template."""
    rows = [(label, text, True) for label, text in phrases]
    rows += [(label, text, False) for label, text in notices]
    array = F.array(
        *[
            F.struct(
                F.lit(i).alias("template"),
                F.lit(label).alias("label"),
                F.lit(text).alias("text"),
                F.lit(exact).alias("exact"),
            )
            for i, (label, text, exact) in enumerate(rows)
        ]
    )
    short = [text for _, text, _ in rows if len(text.split()) < K]
    if short:
        raise ValueError(f"templates need {K} words: {short}")
    split = F.split("text", " ")
    each = spark.range(1).select(F.inline(array)).withColumn("_words", split)
    runs = each.select(
        "template", "label", "exact", "_words", F.posexplode("_words").alias("at", "_word")
    )
    n_runs = F.size("_words") - (K - 1)
    return runs.where(F.col("at") < n_runs).select(
        "template", "label", "exact", n_runs.alias("n_runs"), "at",
        F.array_join(F.slice("_words", F.col("at") + 1, K), " ").alias("run"),
    )


def votes(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per word run that meets a template, and one per document in any case.

    ``row`` numbers the documents; template and diagonal are NULL in rows that only stand
    for the document.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        words(F.col("text").cast("string")).alias("_words"),
    )
    each = texts.select(
        "row", "doc_id", "_words", F.posexplode_outer("_words").alias("pos", "_word")
    )
    run = _run(F.col("_words"), F.col("pos"))
    hashed = each.select(
        "row",
        "doc_id",
        "pos",
        F.size("_words").cast("bigint").alias("n_words"),
        run.alias("_run"),
        F.xxhash64(run).alias("_hash"),
    )
    keyed = runs.withColumn("_key", F.xxhash64("run"))
    met = hashed.join(
        F.broadcast(keyed), (F.col("_hash") == F.col("_key")) & (F.col("_run") == F.col("run")),
        "left",
    )
    return met.where(
        F.col("template").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0)
    ).select(
        "row", "doc_id", "n_words", "pos", "template", "label", "exact", "n_runs", "at",
        (F.col("pos") - F.col("at")).alias("diagonal"),
    )


def find_licenses(docs: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """row, doc_id, n_words and spans (label, exact, start, end, share) of each document."""
    runs = templates(docs.sparkSession) if runs is None else runs
    met = votes(docs, runs)
    diagonals = met.groupBy("row", "doc_id", "n_words", "template", "diagonal").agg(
        F.first("label").alias("label"),
        F.first("exact").alias("exact"),
        F.first("n_runs").alias("n_runs"),
        F.count("at").alias("n_votes"),
        F.collect_set("at").alias("held"),
        F.min("pos").alias("start"),
        (F.max("pos") + K).alias("end"),
    )
    # A phrase's diagonal stands alone; those of a notice join the one before if it is near.
    in_order = Window.partitionBy("row", "template").orderBy("diagonal")
    far = (
        F.col("exact")
        | F.lag("diagonal").over(in_order).isNull()
        | (F.col("diagonal") - F.lag("diagonal").over(in_order) > GAP)
    )
    chained = diagonals.withColumn("chain", F.sum(far.cast("int")).over(in_order))
    merged = chained.groupBy("row", "doc_id", "n_words", "template", "chain").agg(
        F.first("label").alias("label"),
        F.first("exact").alias("exact"),
        F.first("n_runs").alias("n_runs"),
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("n_held"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
    share = F.col("n_held") / F.col("n_runs")
    least = F.when(F.col("n_runs") < 10, LEAST_SHORT).otherwise(LEAST)
    in_step = F.col("end") - F.col("start") <= (F.col("n_runs") + K - 1) * 1.5
    good = F.when(F.col("exact"), share == 1).otherwise((share >= least) & in_step)
    span = F.struct(
        "label", "exact", F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"), share.alias("share"),
    )
    return merged.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.collect_list(F.when(good, span))).alias("spans")
    )


def license_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its words, the places of the phrases, and labels."""
    found = find_licenses(docs)
    base = F.filter("spans", lambda s: s["exact"])
    starts = F.transform(base, lambda s: s["start"])
    texts = F.filter("spans", lambda s: ~s["exact"])

    def labels(spans):
        return F.array_join(
            F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ","
        )

    return found.select(
        "doc_id",
        F.greatest("n_words", F.lit(0)).alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias(
            "score"
        ),
        F.size(texts).cast("bigint").alias("n_notices"),
    )
