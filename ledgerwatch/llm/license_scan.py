"""Licence scans by diagonal voting, with DataFrame functions only.

Texts are cut into lower-cased words. Every rolling k-gram of words is hashed and joined to the positions of the same
hashes in the template texts (a fixed parameter of about a thousand words, so broadcast): whole public notices with k of 4, their
opening sentences and base phrases with k of 2. A hit at text word i and template word j votes for the diagonal i - j of that template,
and is verified by comparing the words themselves, not just their hashes. Votes are aggregated by diagonal, where one place of a
template has at most its own number of grams. A dropped or added word moves the rest of a notice to the next diagonal, so a window
over the diagonals merges each one with its neighbours, `most_shift` on either side or a twentieth of the template's words; the merged place
counts if the votes hold `least_share` of the template's grams, each counted once. Both steps are linear in the hits of a text.

Base phrases are templates that must match whole, on one diagonal: all places count. Longer templates add labels and spans; of two
places of a template that overlap the one with more votes stands, at a tie the first.
score is the largest share of a template's grams found in one place, 0 without a label.
Votes are a written table, so that row numbers don't change if an executor is lost.
Null and empty texts have no words. Rows are kept apart even if ids repeat or are null; an empty table gives no rows, and extra
columns don't matter. Texts are read whole, however long.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, id_and_text
from .license_texts import NOTICES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: (label, phrase): base phrases, counted wherever they stand.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
#: (label, text): opening words of public licence notices.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under cc by"),
    ("cc-by", "licensed under the creative commons attribution"),
    ("reserved", "all rights reserved"),
)
SHORT_GRAM, LONG_GRAM, UNIT = 2, 4, 1_000_000


def split(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, UPPER.lower())))


def template_grams(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES, notices=NOTICES, least_share: float = 0.75, most_shift: int = 3) -> DataFrame:
    """(gram, t, label, base, grams, k, shift, least, j, tw): the k-grams of each template and where they stand, by how many diagonals its
    places may be spread, and the fewest grams of a place."""
    rows = []
    every = [(x, y, True, SHORT_GRAM) for x, y in phrases] + [(x, y, False, SHORT_GRAM) for x, y in templates] + [(x, y, False, LONG_GRAM) for x, y in notices]
    for t, (label, text, base, k) in enumerate(every):
        words = split(text)
        n = len(words) - k + 1
        shift = 0 if base else min(max(most_shift, len(words) // 20), (len(words) - 1) // 2)  # two copies side by side stay two
        rows += [(t, label, base, n, k, shift, n if base else math.ceil(n * least_share), j, words[j : j + k]) for j in range(n)]
    grams = spark.createDataFrame(rows, "t int, label string, base boolean, grams int, k int, shift int, least int, j int, tw array<string>")
    return grams.withColumn("gram", F.xxhash64("tw"))


def places(votes: DataFrame) -> DataFrame:
    """(row, label, base, first, last, share) of the places of templates. votes: row, t, label, base, grams, k, shift, least, i, j."""
    own = ["row", "t", "label", "base", "grams", "k", "shift", "least"]
    diagonals = votes.groupBy(*own, (F.col("i") - F.col("j")).alias("diagonal")).agg(F.collect_list("j").alias("js"), F.min("i").alias("first"), F.max("i").alias("end"))
    # windows of one width in units of a template's own: within `shift` diagonals, and overlapping by a word
    scaled = lambda unit: F.floor(F.col("diagonal").cast("long") * UNIT / unit).cast("long")
    near = W.partitionBy("row", "t").orderBy(scaled(F.col("shift") + 0.5)).rangeBetween(-UNIT, UNIT)
    merged = diagonals.select(*own, "diagonal", F.size(F.array_distinct(F.flatten(F.collect_list("js").over(near)))).alias("n"), F.min("first").over(near).alias("first"), F.max("end").over(near).alias("end"))
    enough = merged.filter(F.col("n") >= F.col("least"))
    overlapping = W.partitionBy("row", "t").orderBy(scaled(F.col("grams") + F.col("k") - 1)).rangeBetween(2 - UNIT, UNIT - 2)
    rank = F.struct("n", -F.col("first"), -F.col("end"))
    best = enough.withColumn("best", F.max(rank).over(overlapping)).filter(F.col("base") | (F.col("best") == rank))
    return best.select("row", "t", "label", "base", "first", (F.col("end") + F.col("k") - 1).alias("last"), (F.col("n") / F.col("grams")).alias("share")).distinct()


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, notices=NOTICES, least_share: float = 0.75, most_shift: int = 3) -> DataFrame:
    """One row for each row of docs: word count, base places and their first and last word, labels, score, and all spans as label:first:last word."""
    spark = docs.sparkSession
    words = F.array_remove(F.split(F.translate("text", UPPER, UPPER.lower()), BETWEEN), "")
    texts = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("w"))
    later = [F.slice("w", k + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"w{k}") for k in range(1, LONG_GRAM)]
    runs = texts.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(F.arrays_zip(F.col("w").alias("w0"), *later)).alias("i", "run"))
    gram = lambda k: F.array(*(F.col(f"run.w{x}") for x in range(k)))
    # a gram that hangs over the end has nulls, which no template has
    grams = runs.select("row", "doc_id", "n_words", "i", F.explode(F.array(gram(SHORT_GRAM), gram(LONG_GRAM))).alias("words")).withColumn("gram", F.xxhash64("words"))
    known = template_grams(spark, phrases, templates, notices, least_share, most_shift)
    seen = grams.join(F.broadcast(known), "gram", "left").withColumn("same", F.coalesce(F.col("words") == F.col("tw"), F.lit(False)))
    seen = seen.filter(F.col("same") | F.coalesce(F.col("i") == 0, F.lit(True)))  # each row keeps its first gram
    votes = Scratch(spark).write(seen.select("row", "doc_id", "n_words", "same", "t", "label", "base", "grams", "k", "shift", "least", "i", "j"))
    found = places(votes.filter("same"))
    every = votes.filter("i IS NULL OR i = 0").select("row", "doc_id", "n_words").unionByName(found, allowMissingColumns=True)
    base, found = F.col("base"), F.col("share").isNotNull()
    out = every.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(found, F.struct("first", "last", "label")))), lambda x: F.concat_ws(":", x["label"], x["first"], x["last"])), ",").alias("spans"),
    )
    return out.drop("row")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir))
