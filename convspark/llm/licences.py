"""Licence scan: exact set-similarity join of text blocks with licence templates."""

from __future__ import annotations

import re
from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convspark.llm.line_dedup import LOWER, UPPER
from convspark.llm.batches import set_aside
from convspark.workspace import materialise_counting

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that carry a label wherever their words stand consecutively. Fixed values.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices of public licences: (label, text). Fixed values.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("proprietary", "All rights reserved"),
)


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, every run of letters, digits and characters beyond ASCII."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _split(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def _literal(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _spans(reach: int) -> Column:
    """Blocks of 2 * reach words, one every reach words, so that each span of up to reach words lies in one."""
    last = F.greatest(F.size("_words") - reach - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last, F.lit(reach)),
        lambda i: F.struct(F.lit(reach).alias("reach"), F.slice("_words", i + 1, 2 * reach).alias("words")),
    )


def scan_licences(
    docs: DataFrame,
    threshold: float = 0.9,
    phrases: Mapping[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Find licence phrases word by word, and every text block that contains most words of a template.

    A block meets a template if it has at least ``threshold`` of the template's distinct words. Blocks
    overlap: a template of up to r words (r a power of two) looks at blocks of 2r words, one every r
    words, so that a notice wrapped over lines lies whole in a block. The join is exact. Template
    words are ordered by their number of documents in the whole table, rarest first. Only words of
    templates can be shared, so a block is cut down to these. A block and a template that meet share a
    word among the first of either in this order (prefix filter); the block must have enough words
    (length filter); and enough must follow the shared word on both sides (positional filter). What is
    left is verified by the full intersection. The template index is bounded by the parameter and broadcast; documents are not
    shuffled, only rows with a candidate are.

    Result: all input columns plus ``n_words``, ``n_base`` (all places of phrases), ``first_word``,
    ``last_word`` (smallest and largest start, null without), ``base_labels``, ``labels`` (distinct,
    sorted, joined by commas, empty without), ``score`` (1 for a phrase, else the largest containment
    of a template that is met, else 0). Input columns of these names are replaced. Null and empty
    texts have no words. Rows with equal id and text have equal results; an empty table gives an empty
    table.
    """
    made = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    narrow, back = set_aside(docs, id_column, text_column, made)
    tokens = [(label, list(dict.fromkeys(_split(text))), len(_split(text))) for label, text in templates]
    tokens = [t for t in tokens if t[1]]
    vocabulary = sorted({w for _, distinct, _ in tokens for w in distinct})
    base = narrow.withColumn("_words", words(F.col("text")))

    # base phrases, word by word; positions are worked out only where the joined words have the phrase
    joined = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))

    def places(phrase: str) -> Column:
        parts = _split(phrase)
        starts = F.sequence(F.lit(0), F.size("_words") - len(parts))

        def stands(i: Column) -> Column:
            found = F.get(F.col("_words"), i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                found = found & (F.get(F.col("_words"), i + k) == part)
            return found

        none = F.array().cast("array<int>")
        return F.when(F.contains(F.col("_joined"), F.lit(f" {' '.join(parts)} ")), F.filter(starts, stands)).otherwise(none)

    listed = list(phrases.items())
    found = base.withColumn("_joined", joined)
    for k, (phrase, _) in enumerate(listed):
        found = found.withColumn(f"_at{k}", places(phrase))
    every = F.concat(*[F.col(f"_at{k}") for k in range(len(listed))]) if listed else F.array().cast("array<int>")
    named = [F.when(F.size(f"_at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(listed)]
    found = found.withColumn("_every", every).withColumn(
        "_base", F.array_sort(F.array_distinct(F.array_compact(F.array(*named)))) if named else F.array().cast("array<string>")
    )

    # documents per template word, rarest first: the global order
    held = base.select(F.explode(F.array_intersect(_literal(vocabulary), "_words")).alias("word"))
    counts = dict.fromkeys(vocabulary, 0) | {
        r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    ordered = sorted(vocabulary, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(ordered)}

    index, least = [], {}
    for k, (label, distinct, length) in enumerate(tokens):
        inside, reach = sorted(distinct, key=rank.__getitem__), _reach(length)
        need = max(1, ceil(threshold * len(inside) - 1e-9))
        least[reach] = min(need, least.get(reach, need))
        for place, word in enumerate(inside[: len(inside) - need + 1]):
            index.append((word, reach, label, place, len(inside), need, inside))
    result = found
    if index:
        index_table = docs.sparkSession.createDataFrame(
            index, "_word string, _reach int, _label string, _place int, _size int, _need int, _all array<string>"
        )
        prefixes = _literal(sorted({row[0] for row in index}))
        fewest = F.lit(None).cast("int")
        for reach, need in least.items():
            fewest = F.when(F.col("_reach") == reach, F.lit(need)).otherwise(fewest)
        blocks = (
            base.where(F.arrays_overlap("_words", prefixes))
            .select(
                F.col("id").alias("_id"),
                F.xxhash64("text").alias("_text"),
                F.explode(F.concat(*map(_spans, least))).alias("_span"),
            )
            .select("_id", "_text", "_span.reach", F.array_intersect(_literal(ordered), "_span.words").alias("_held"))
            .withColumnRenamed("reach", "_reach")
            .withColumn("_fewest", fewest)
            .where(F.size("_held") >= F.col("_fewest"))
        )
        probes = blocks.select(
            "*", F.posexplode(F.slice("_held", F.lit(1), F.size("_held") - F.col("_fewest") + 1)).alias("_at", "_word")
        )
        after = F.least(F.size("_held") - F.col("_at"), F.col("_size") - F.col("_place"))
        met = (
            probes.join(F.broadcast(index_table), ["_word", "_reach"])
            .where((F.size("_held") >= F.col("_need")) & (after >= F.col("_need")))
            .withColumn("_shared", F.size(F.array_intersect("_held", "_all")))
            .where(F.col("_shared") >= F.col("_need"))
        )
        best, _ = materialise_counting(
            met.groupBy("_id", "_text").agg(
                F.collect_set("_label").alias("_met"), F.max(F.col("_shared") / F.col("_size")).alias("_best")
            ),
            "licence-blocks",
        )
        result = result.withColumn("_own", F.xxhash64("text")).join(
            best, F.col("id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_text")), "left"
        )
    else:
        result = result.withColumn("_met", F.array().cast("array<string>")).withColumn("_best", F.lit(0.0))
    labels = F.array_sort(F.array_union("_base", F.coalesce("_met", F.array().cast("array<string>"))))
    return back(
        result,
        F.size("_words").cast("long").alias("n_words"),
        F.size("_every").cast("long").alias("n_base"),
        F.array_min("_every").cast("long").alias("first_word"),
        F.array_max("_every").cast("long").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )


def _reach(length: int) -> int:
    """Words that a block advances by: the next power of two, so that few lengths of blocks are made."""
    return 1 << max(2, (length - 1).bit_length())
