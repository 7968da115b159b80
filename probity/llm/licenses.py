"""License scan by diagonal voting, with DataFrame functions only.

Templates (license phrases and notices) become rows of word pairs with their
position.  Every rolling word pair of a document joins the template positions of
the same pair; a hit votes for its diagonal, the offset between the place in the
document and in the template.  Votes are summed by (document, template,
diagonal), neighbouring diagonals (within ``DRIFT`` words: an inserted or missing word
shifts the rest) are merged, and a span is verified: the votes must cover
``COVER`` of the template's pairs.  A base phrase must match on one diagonal with
every pair, which is the phrase standing word for word.

The template table is a constant of this module and is broadcast.  Only hits and
one row per document are shuffled, by document.

Defined cases: null texts have no words; rows that share doc_id and text give
one result row each; documents without hits have null first_word and last_word,
empty labels and score 0.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probity.llm import nativewords as nw

DRIFT = 3
COVER = 0.8
# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices of well-known licenses and their labels.
NOTICES = {
    "apache-2.0": ["licensed under the apache license version 2 0",
                   "you may not use this file except in compliance with the license you may obtain a copy of the license at"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"],
    "gpl-3.0": ["licensed under the gnu general public license version 3",
                "under the terms of the gnu general public license as published by the free software foundation"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}


def templates() -> list[tuple[str, int, int, int, str, bool]]:
    """(pair, template, position, pairs of the template, label, base)."""
    out = []
    every = [(t, lab, True) for t, lab in BASE.items()] + [(t, lab, False) for lab, ts in NOTICES.items() for t in ts]
    for tid, (text, label, base) in enumerate(every):
        w = re.findall("[0-9a-z]+", text)
        out += [(f"{a} {b}", tid, i, len(w) - 1, label, base) for i, (a, b) in enumerate(zip(w, w[1:]))]
    return out


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per document."""
    spark = docs.sparkSession
    rows = templates() + [(nw.ALONE, -1, 0, 0, None, False)]
    t = spark.createDataFrame(rows, "win string, tid int, tpos int, pairs int, label string, base boolean").withColumn(
        "bit", F.expr("shiftleft(1L, tpos)"))
    hit = nw.spread(docs, [2]).join(F.broadcast(t), "win")
    key = ["doc_id", "tkey"]
    # equal rows of ``documents`` repeat each hit: a diagonal counts positions, the alone rows count copies
    diag = (hit.groupBy(*key, "tid", (F.col("at") - F.col("tpos")).alias("diag"))
            .agg(F.max("n_words").alias("n_words"), F.count("*").alias("c"),
                 F.bit_or("bit").alias("mask"),
                 F.max("pairs").alias("pairs"), F.max("label").alias("label"), F.max("base").alias("base")))
    near = Window.partitionBy(*key, "tid").orderBy("diag").rangeBetween(-DRIFT, DRIFT)
    diag = diag.withColumn("votes", F.bit_count("mask")).withColumn("merged", F.bit_count(F.bit_or("mask").over(near)))
    place = F.col("base") & (F.col("votes") == F.col("pairs"))
    cover = F.when(F.col("base"), F.when(place, 1.0).otherwise(0.0)).otherwise(F.col("merged") / F.col("pairs"))
    diag = diag.withColumn("place", place).withColumn("cover", F.when(F.col("tid") >= 0, cover).otherwise(0.0))
    ok = F.col("cover") >= COVER
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    out = diag.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.max(F.when(F.col("tid") < 0, F.col("c")).otherwise(0)).cast("int").alias("copies"),
        F.sum(F.when(F.col("place"), 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(F.col("place"), F.col("diag"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("place"), F.col("diag"))).cast("long").alias("last_word"),
        join(F.when(F.col("place"), F.col("label"))).alias("base_labels"),
        join(F.when(ok, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(ok, F.col("cover"))), F.lit(0.0)).alias("score"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                      F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
