"""License scans by diagonal voting.

All rolling word 3-grams of all texts are joined by hash to the positions of 3-grams in license
templates. A match at word ``p`` of a text and ``t`` of a template votes for the diagonal ``p - t``.
Neighbouring diagonals of one template, which an added or a lost word separates, are merged into a span,
and a span counts when enough of the template's 3-grams lie on it. The templates are few and fixed, so
their side is broadcast by its known size; votes are counted in each task before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
MASK_BITS = 62  # template positions per vote mask
MASKS = 4
BROADCAST_WORDS = 50_000  # templates up to this size, about 5 MB, are broadcast
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"
KELVIN, RING = "\u212a", "\u212b"


@dataclass(frozen=True)
class Template:
    """A license text under a label. A phrase must match whole; of other texts ``coverage`` is enough."""

    label: str
    text: str
    phrase: bool = False


#: Fixed phrases and labels of the base rules.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

#: Well-known public license notices, their first lines in full.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("gpl-3", "licensed under the GNU General Public License, version 3"),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    Template("lgpl-3", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
)

TEMPLATES = PHRASES + NOTICES


def license_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, A-Z in lower case.

    ``lower`` also folds other letters. That leaves word limits as they are, and the one letter that
    folds into a-z, the Kelvin sign, is replaced first, so that equality with ASCII words is exact.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(RING)))
    return F.array_remove(F.split(lowered, APART), "")


def template_words(template: Template) -> list[str]:
    lowered = "".join(c if c.isalnum() and c.isascii() else " " for c in template.text.lower())
    return lowered.split()


def template_positions(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per template and position: the three words, their number, and the template's size."""
    rows = []
    for number, template in enumerate(templates):
        words = template_words(template)
        grams = len(words) - K + 1
        if not 1 <= grams <= MASK_BITS * MASKS:
            raise ValueError(f"a template needs {K} to {MASK_BITS * MASKS + K - 1} words: {template.label}")
        rows += [(number, t, grams, template.label, template.phrase, *words[t : t + K]) for t in range(grams)]
    schema = "template int, t int, grams int, label string, phrase boolean, t0 string, t1 string, t2 string"
    return spark.createDataFrame(rows, schema).withColumn("t_hash", F.xxhash64("t0", "t1", "t2"))


def _grams(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per word 3-gram; texts with fewer words give one row without a position."""
    words = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), license_words(F.col(text)).alias("w")
    )
    rest = lambda by: F.slice("w", by + 1, F.greatest(F.size("w") - by, F.lit(0)))
    zipped = F.arrays_zip(F.col("w").alias("w0"), rest(1).alias("w1"), rest(2).alias("w2"))
    whole = F.slice(zipped, 1, F.greatest(F.size("w") - (K - 1), F.lit(0)))
    sized = words.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), whole.alias("grams"))
    each = sized.select("doc_id", "text_hash", "n_words", F.posexplode_outer("grams").alias("p", "gram"))
    return each.select("doc_id", "text_hash", "n_words", "p", "gram.*")


def _or(column: str) -> list[Column]:
    """Votes as bits: whatever is counted twice stays one vote."""
    return [F.bit_or(f"{column}{i}").alias(f"m{i}") for i in range(MASKS)]


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    slack: int = 4,
    coverage: float = 0.8,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``score`` and ``spans``.

    ``spans``: structs of label, phrase, first_word, last_word (start and end) and coverage, those that
    were verified, in order of place. ``score``: the largest coverage of any span, verified or not, 0
    where nothing matched. Diagonals of one template are merged up to ``slack`` apart, those of phrases
    never. A span is verified by ``coverage`` of the template and a length of at most one and a half
    templates. A null text counts as empty. Rows equal in id and text are scanned together and returned
    as often as they occur. Other columns are not carried; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    grams = _grams(docs, doc_id, text).withColumn("hash", F.xxhash64("w0", "w1", "w2"))
    same = [F.col(f"w{i}") == F.col(f"t{i}") for i in range(K)]
    positions = template_positions(spark, templates)
    if sum(len(template_words(t)) for t in templates) <= BROADCAST_WORDS:
        positions = F.broadcast(positions)  # else Spark would shuffle all 3-grams to join them
    hits = grams.join(positions, reduce(lambda a, b: a & b, same, F.col("hash") == F.col("t_hash")), "left")
    start = F.coalesce(F.col("p"), F.lit(0)) == 0
    hits = hits.filter(F.col("template").isNotNull() | start)
    bit = lambda i: F.when(
        F.floor(F.col("t") / MASK_BITS) == i, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("t", F.lit(MASK_BITS)))
    )
    marked = hits.withColumns({f"b{i}": F.coalesce(bit(i), F.lit(0).cast("long")) for i in range(MASKS)})
    # A row of `docs` has one place 0, which a diagonal sees once: its count there is the number of copies.
    doc = ["doc_id", "text_hash", "n_words"]
    votes = marked.groupBy(*doc, "template", "grams", "label", "phrase", (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.min("p").alias("first"), F.max("p").alias("last"), *_or("b"),
        F.sum(F.when(start, F.lit(1).cast("long")).otherwise(0)).alias("starts"),
    )
    near = Window.partitionBy(*doc, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(near)
    fresh = (gap.isNull() | (gap > F.when(F.col("phrase"), 0).otherwise(slack))).cast("int")
    islands = votes.withColumn("island", F.sum(fresh).over(near))
    spans = islands.groupBy(*doc, "template", "grams", "label", "phrase", "island").agg(
        F.min("first").alias("first"), (F.max("last") + (K - 1)).alias("last"), *_or("m"), F.max("starts").alias("starts")
    )
    bits = reduce(lambda a, b: a + b, [F.bit_count(f"m{i}") for i in range(MASKS)])
    spans = spans.withColumn("share", F.when(F.col("template").isNull(), 0.0).otherwise(bits / F.col("grams")))
    length = F.col("last") - F.col("first") + 1
    enough = F.when(F.col("phrase"), F.col("share") == 1.0).otherwise(
        (F.col("share") >= coverage) & (length <= 1.5 * (F.col("grams") + K - 1))
    )
    span = F.struct(
        F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"), "label", "phrase",
        F.col("share").alias("coverage"),
    )
    whole = spans.groupBy(*doc).agg(
        F.sort_array(F.collect_list(F.when(enough, span))).alias("spans"),
        F.max("share").alias("score"),
        F.max("starts").alias("copies"),
    )
    again = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return again.select("doc_id", "n_words", "spans", "score")


def license_digest(scanned: DataFrame) -> DataFrame:
    """Places and labels of the base phrases, and all labels, from the verified spans."""
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["first_word"])
    names = lambda spans: F.array_join(F.sort_array(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("spans")).alias("labels"),
        "score",
    )
