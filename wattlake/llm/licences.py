"""Licence scan by diagonal voting, in DataFrame operations only.

Templates are word sequences: short phrases and longer notices.  Every rolling word k-gram of a text (k = 2 for
phrases, 4 for notices) is hashed and joined with the positions of equal k-grams in the templates.  A pair of
positions votes for its diagonal, text position minus template position: a template that stands in the text word
for word has all its votes on one diagonal, and a word left out or put in shifts the rest by one.  So votes are
gathered by diagonal, diagonals at most ``SLACK`` apart are merged, and the merged span is verified: a phrase
must have its every word on one diagonal; of a notice, at least ``MIN_COVER`` of the words must lie in matching
k-grams.  Hashes only find candidates; each joined k-gram's words are compared.

The template table is of fixed size (a few hundred k-grams) and is broadcast.  One pass reads the texts; each row
also sends one marker, so rows without a match need no second scan.  What is shuffled are votes, already gathered
by row and diagonal in each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.common import read

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASE_GRAM, NOTICE_GRAM = 2, 4
SLACK, MIN_COVER = 3, 0.7

# The phrases asked for and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening words of well-known public licence notices, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
    "the license": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


def word_list(text: Column) -> Column:
    """Words of a text with A-Z lowered; null as an empty text."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession, templates: list[tuple[str, str, int]]) -> DataFrame:
    """One row per template position: hash and words of its k-gram, template number, label, k, sizes."""
    listed = F.array(*[F.struct(F.split(F.lit(text), " ").alias("words"), F.lit(label).alias("label"), F.lit(k).alias("k"))
                       for text, label, k in templates])
    rows = spark.range(1).select(F.posexplode(listed).alias("template", "of")).select("template", "of.*")
    grams = rows.where(F.size("words") >= F.col("k")).select(
        "template", "label", "k", F.size("words").alias("n_template"),
        F.posexplode(F.transform(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1),
                                 lambda i: F.slice("words", i, F.col("k")))).alias("place", "gram"))
    return grams.withColumn("hash", gram_hash([F.get("gram", F.lit(i)) for i in range(NOTICE_GRAM)], F.col("k")))


def gram_hash(words: list[Column], k: Column) -> Column:
    pair = F.xxhash64(words[0], words[1])
    return F.when(k == PHRASE_GRAM, pair).otherwise(F.xxhash64(pair, F.xxhash64(words[2], words[3])))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None,
         notices: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``df``: key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` lists (label, start, end, cover) of each verified place.  ``score`` is the largest cover of any
    template, verified or not.  A null or empty text has 0 words and no place (null first and last word, empty
    labels, score 0).  Rows with equal key and text are counted first and returned as often as they occur.  A
    null key is a key like others.  Other columns are not carried.
    """
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    templates = [(words, label, PHRASE_GRAM) for words, label in phrases.items()] \
        + [(words, label, NOTICE_GRAM) for words, label in notices.items()]
    n_base = len(phrases)
    grams = template_grams(df.sparkSession, templates)

    words = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("digest"), word_list(F.col(text)).alias("words"))
    pairs = F.when(F.size("words") >= 2, F.transform(
        F.sequence(F.lit(0), F.size("words") - 2),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1)))).otherwise(F.array().cast("array<bigint>"))
    hashed = words.withColumn("pairs", pairs)
    quads = F.when(F.size("pairs") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("pairs") - 3),
        lambda i: F.xxhash64(F.get("pairs", i), F.get("pairs", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    # pairs, then quads, then the marker: a position beyond the pairs is one of a quad, the last is the marker
    places = hashed.select("key", "digest", "words", F.posexplode(F.concat("pairs", quads, F.array(F.lit(0).cast("bigint"))))
                           .alias("at", "hash"))
    n_pairs = F.greatest(F.size("words") - 1, F.lit(0))
    n_quads = F.greatest(F.size("words") - 3, F.lit(0))
    places = places.withColumn("is_marker", F.col("at") == n_pairs + n_quads).withColumn(
        "position", F.when(F.col("at") < n_pairs, F.col("at")).otherwise(F.col("at") - n_pairs)).withColumn(
        "k_text", F.when(F.col("at") < n_pairs, F.lit(PHRASE_GRAM)).otherwise(F.lit(NOTICE_GRAM)))
    marker = df.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("gram"), F.lit(-1).alias("template"), F.lit("").alias("label"),
        F.lit(0).alias("k"), F.lit(0).alias("place"), F.lit(0).alias("n_template"), F.lit(0).cast("bigint").alias("hash"))
    known = F.broadcast(grams.unionByName(marker))                       # a few hundred rows, fixed
    met = places.join(known, "hash").where(
        (F.col("is_marker") & (F.col("template") == -1))
        | (~F.col("is_marker") & (F.col("k") == F.col("k_text"))
           & (F.slice("words", F.col("position") + 1, F.col("k")) == F.col("gram"))))

    votes = met.groupBy("key", "digest", "template", "label", "k", "n_template",
                        F.when(F.col("is_marker"), F.size("words")).otherwise(F.col("position") - F.col("place"))
                        .alias("diagonal")) \
        .agg(F.count("*").alias("n"), F.collect_set("place").alias("places"))

    order = Window.partitionBy("key", "digest", "template").orderBy("diagonal")
    apart = (F.col("template") < n_base) | (F.col("diagonal") - F.lag("diagonal").over(order) > SLACK)
    runs = votes.withColumn("run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    spans = runs.groupBy("key", "digest", "template", "label", "k", "n_template", "run").agg(
        F.max("n").alias("n"), F.min("diagonal").alias("diagonal"),
        F.array_distinct(F.flatten(F.collect_list(F.transform("places", lambda p: p.cast("int"))))).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("places") + F.col("k")).alias("end"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    spans = spans.withColumn("cover", F.when(F.col("template") >= 0, covered / F.col("n_template")))
    verified = F.when(F.col("template") < 0, False).when(F.col("template") < n_base, F.col("cover") == 1) \
        .otherwise(F.col("cover") >= MIN_COVER)
    base = verified & (F.col("template") < n_base)
    found = spans.withColumn("verified", verified).withColumn("base", base).groupBy("key", "digest").agg(
        F.max(F.when(F.col("template") < 0, F.col("n"))).alias("copies"),
        F.max(F.when(F.col("template") < 0, F.col("diagonal"))).cast("long").alias("n_words"),
        F.count(F.when(F.col("base"), True)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("verified"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("verified"), F.struct("label", "start", "end", "cover")))).alias("spans"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.withColumn("copy", copies).drop("copy", "copies", "digest").withColumnRenamed("key", key)


def op1_licences(spark, sf_dir: str) -> DataFrame:
    """The licence scan of every document."""
    return scan(read(spark, sf_dir, "documents")).drop("spans")
