"""License scan: phrases, and an exact set-similarity join with license templates.

A text block matches a template where it holds at least ``CONTAINED`` of the template's
distinct words. Blocks are paragraphs; one of more than ``BLOCK`` words is cut into blocks
of that length that overlap by half, so any notice of half the length lies whole in one,
and words strewn over a long paragraph make no match. Texts are split into words once,
and what the join needs of them is stored. It finds every pair without comparing all:

* words are ordered by how many blocks hold them, rarest first;
* prefix filter: with ``o`` words required of ``t``, one of the rarest ``t - o + 1``
  words of the template must be in the block, so blocks are looked up by those only;
* length filter: the block must hold ``o`` words of the templates' vocabulary; those with
  fewer than any template requires are not stored in the first place;
* positional filter: at a word that a pair shares, the words before it and those from
  it on, of the side that has fewer, must suffice for ``o``.

What passes is verified on the whole sets.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedpulse.llm.common import ROW, documents, text_or_empty, written

# Words, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license notices, the labels of the method.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    (
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation",
    ),
    ("apache", "licensed under the apache license version 2.0"),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("mit", "released under the mit license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc0", "to the extent possible under law waived all copyright and related or neighboring rights"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
CONTAINED = 0.9
BLOCK = 128


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall("[0-9a-z]+", text.lower())))


def words_of(text: Column) -> Column:
    """The words of ``text``, split at all that is in none."""
    return F.array_remove(F.split(text, f"{NO_WORD}+"), "")


def least_shared(size: int, contained: float = CONTAINED) -> int:
    return math.ceil(contained * size - 1e-9)


def blocks_of(paragraphs: Column, vocabulary: list[str], least: int) -> Column:
    """The distinct template words of each block that holds ``least`` or more.

    ``paragraphs`` are arrays of words; what is too short to matter goes before blocks
    are cut.
    """
    wanted = F.array(*[F.lit(w) for w in vocabulary])
    likely = F.filter(paragraphs, lambda ws: F.size(F.array_intersect(ws, wanted)) >= least)
    cut = F.transform(
        likely,
        lambda ws: F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(ws) - BLOCK // 2), F.lit(BLOCK // 2)),
            lambda start: F.slice(ws, start, BLOCK),
        ),
    )
    held = F.transform(F.flatten(cut), lambda ws: F.array_intersect(ws, wanted))
    return F.filter(held, lambda ws: F.size(ws) >= least)


def word_order(blocks: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each template word by the number of blocks that hold it, rarest first.

    Counted over all blocks with words enough to match; only the templates' words are
    counted, as no other can be shared. The result has one row per template word.
    """
    counts = {
        r["word"]: r["count"]
        for r in blocks.select(F.explode("held").alias("word")).groupBy("word").count().collect()
    }
    ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    return {w: rank for rank, w in enumerate(ordered)}


def join_templates(
    blocks: DataFrame,
    order: dict[str, int],
    templates=TEMPLATES,
    contained: float = CONTAINED,
) -> DataFrame:
    """``(row, block, template, containment)`` of every pair that meets the threshold."""
    spark = blocks.sparkSession
    prefixes, sets = [], []
    for no, (_, text) in enumerate(templates):
        own = sorted(template_words(text), key=order.get)
        least = least_shared(len(own), contained)
        sets.append((no, own, least))
        for place in range(len(own) - least + 1):
            prefixes.append((own[place], no, place, len(own), least))
    # Both are as long as the templates, whatever the input.
    index = F.broadcast(
        spark.createDataFrame(prefixes, "word string, template int, t_place int, t_size int, least int")
    )
    whole = F.broadcast(spark.createDataFrame(sets, "template int, own array<string>, least int"))
    ranks = F.create_map(*[F.lit(x) for pair in sorted(order.items()) for x in pair])
    rare = sorted({p[0] for p in prefixes})
    # Words of the block in the global order; only prefix words are looked up.
    placed = blocks.withColumn(
        "held", F.array_sort(F.transform("held", lambda w: F.struct(ranks[w].alias("rank"), w.alias("word"))))
    )
    asked = placed.select(
        ROW, "block", "held", F.posexplode("held").alias("place", "at")
    ).where(F.col("at.word").isin(rare))
    found = (
        asked.join(index, F.col("at.word") == F.col("word"))
        .where(
            (F.size("held") >= F.col("least"))
            & (
                F.least(F.size("held") - F.col("place"), F.col("t_size") - F.col("t_place"))
                + F.least("place", "t_place")
                >= F.col("least")
            )
        )
        .select(ROW, "block", "template", "held")
        .distinct()
    )
    shared = F.size(F.array_intersect(F.transform("held", lambda x: x["word"]), F.col("own")))
    return (
        found.join(whole, "template")
        .withColumn("shared", shared)
        .where("shared >= least")
        .select(ROW, "block", "template", (F.col("shared") / F.size("own")).alias("containment"))
    )


def phrase_places(words: Column, phrase: str) -> Column:
    """Where the words of ``phrase`` stand one after another, from 0."""
    parts = phrase.split()
    return F.filter(
        F.sequence(F.lit(0), F.size(words) - len(parts)),
        lambda i: F.forall(
            F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(parts)]),
            lambda x: F.get(words, i + x["k"]) == x["p"],
        ),
    )


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` with its phrases, labels and score.

    Columns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``. ``score`` is 1 for a phrase, else the largest containment that met the
    threshold, else 0. Null texts count as empty. Null ids are kept, repeated rows
    come as often, other columns are not read. A text is read and split once; words,
    of texts with a phrase, and blocks, of those that may match, are stored by row.
    """
    lowered = F.translate(text_or_empty(text), UPPER, UPPER.lower())
    paragraphs = F.transform(F.split(lowered, r"\n[\x20\t\r]*\n"), words_of)
    vocabulary = sorted({w for _, t in TEMPLATES for w in template_words(t)})
    least = min(least_shared(len(template_words(t))) for _, t in TEMPLATES)
    # Few texts hold a phrase; only their words are put in order.
    likely = "|".join(p.replace(" ", f"{NO_WORD}+") for p in PHRASES)
    split = docs.select(
        F.monotonically_increasing_id().alias(ROW),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.rlike(lowered, F.lit(f"(?:{likely})")).alias("likely"),
        paragraphs.alias("paragraphs"),
    )
    own = written(
        split.select(
            ROW,
            "doc_id",
            F.aggregate("paragraphs", F.lit(0), lambda n, ws: n + F.size(ws)).cast("long").alias("n_words"),
            F.when(F.col("likely"), F.flatten("paragraphs")).alias("words"),
            blocks_of(F.col("paragraphs"), vocabulary, least).alias("blocks"),
        ),
        "license-words",
    )
    blocks = own.where(F.size("blocks") > 0).select(ROW, F.posexplode("blocks").alias("block", "held"))
    matches = join_templates(blocks, word_order(blocks, vocabulary))
    names = F.create_map(*[F.lit(x) for no, (label, _) in enumerate(TEMPLATES) for x in (no, label)])
    matches = matches.groupBy(ROW).agg(
        F.collect_set(names[F.col("template")]).alias("found"), F.max("containment").alias("best")
    )

    based = own.select(ROW, "doc_id", "n_words", "words")
    based = based.withColumn(
        "places",
        F.when(
            F.size("words") > 0,
            F.array(
                *[
                    F.struct(phrase_places(F.col("words"), p).alias("at"), F.lit(label).alias("label"))
                    for p, label in PHRASES.items()
                ]
            ),
        ),
    )
    based = based.select(
        ROW,
        "doc_id",
        "n_words",
        F.flatten(F.transform("places", lambda p: p["at"])).alias("at"),
        F.array_sort(
            F.transform(F.filter("places", lambda p: F.size(p["at"]) > 0), lambda p: p["label"])
        ).alias("base"),
    )
    nothing = F.expr("cast(array() as array<string>)")
    base, found = F.coalesce("base", nothing), F.coalesce("found", nothing)
    return based.join(matches, ROW, "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size(F.coalesce("at", F.expr("cast(array() as array<int>)"))), F.lit(0))
        .cast("long")
        .alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
