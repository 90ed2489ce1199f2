"""License scans: base phrases by word position, templates by an exact set-similarity join.

A text block is a window of as many consecutive words as the template has, wherever it starts
and across line ends, so a wrapped license text is found as it stands.  A template is found
in a block that holds at least ``min_containment`` of the template's distinct words and all of
its required words, with none of its excluding words in the block or ``NEAR`` words around it:
required and excluding words tell a license from its siblings, whose texts share the rest.

Any such block holds one of the template's ``|T| - ceil(t |T|) + 1`` globally rarest words (its
prefix), so only the surroundings of prefix words become candidate blocks, joined to the
templates on the prefix word; the length filter (enough template words around it) and the
positional filter (enough words from the match on in both frequency-ordered sets) drop
candidates before the windows around the match are counted.

Only DataFrame functions are used.  The corpus is read twice: once for the document frequency
of the template words, once for the counts and the surroundings of prefix words.  Whole
texts never move; what is found is keyed by a 128-bit hash of the text, so rows that repeat
share it and a text copied into a third of all rows is aggregated before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import materialize

MIN_CONTAINMENT = 0.8

# --- fixed values: base phrases and license templates (label, words) ---------------------
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# label, words, required words, excluding words
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0", "apache", ""),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "compliance", ""),
    ("apache", "software distributed under the license is distributed on an as is basis without warranties"
               " or conditions of any kind either express or implied", "basis", ""),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
            " provided that the following conditions are met", "redistribution", ""),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the"
            " following disclaimer", "redistributions retain", ""),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
            " following disclaimer in the documentation and or other materials provided with the distribution",
     "redistributions reproduce", ""),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "attribution",
     "sharealike noncommercial noderivatives"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc nc", ""),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     "attribution sharealike", "noncommercial"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work",
     "waived", ""),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public", "lesser affero"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
            " general public license as published by the free software foundation", "general public", "lesser affero"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted provided that the above copyright notice and this permission notice appear in all copies", "fee", ""),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser", ""),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
             " general public license as published by the free software foundation", "lesser", ""),
    ("mit", "released under the mit license", "mit", ""),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files to deal in the software without restriction", "charge person", ""),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial"
            " portions of the software", "substantial portions", ""),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", ""),
    ("reserved", "all rights reserved", "", ""),
]
NEAR = 3  # words before and after a block that may hold an excluding word
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words of a lower-cased text
# ------------------------------------------------------------------------------------------


def folded(text: Column) -> Column:
    """Lower-cased text; the Kelvin sign, whose lower case is an ASCII letter, stays apart."""
    return F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("�")))


def word_list(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def phrase_starts(words: Column, phrase: str) -> Column:
    """Word positions at which the phrase starts; only texts with all its words are searched."""
    parts = phrase.split()
    present = F.lit(True)
    for p in dict.fromkeys(parts):
        present = present & F.array_contains(words, p)
    last = F.size(words) - len(parts)

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, p in enumerate(parts):
            same = same & (F.get(words, i + k) == p)
        return same

    return F.when(present & (last >= 0), F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)) \
        .otherwise(F.array().cast("array<int>"))


def frequency_order(docs: DataFrame, text_col: str, vocabulary: list[str]) -> list[str]:
    """The template words, from the rarest to the most frequent by documents that hold them."""
    found = docs.select(F.array_intersect(strings(vocabulary), word_list(folded(F.col(text_col)))).alias("w"))
    counts = dict(found.select(F.explode("w").alias("w")).groupBy("w").count().collect())  # template words only
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def windows_found(around: Column, centre: Column, template: Column, size: Column, need: Column,
                  required: Column, excluding: Column) -> Column:
    """The largest share of the template's distinct words in a window that holds the word at
    ``centre`` and passes all conditions; null if none does."""
    def share(start: Column) -> Column:
        window = F.slice(around, start + 1, size)
        near = F.slice(around, F.greatest(start - NEAR, F.lit(0)) + 1, size + NEAR + F.least(start, F.lit(NEAR)))
        held = F.size(F.array_intersect(template, window))
        fits = ((held >= need) & (F.size(F.array_except(required, window)) == 0)
                & ~F.arrays_overlap(excluding, near))
        return F.when(fits, held / F.size(template))

    return F.array_max(F.transform(F.sequence(F.greatest(centre - size + 1, F.lit(0)), centre), share))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: list[tuple[str, str, str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
                  min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row.

    ``score`` is 1 if a base phrase stands in the text, else the largest share of a template's
    words in a block in which it is found, else 0.  A null text is empty: no words, no label.
    Null ids and repeated rows each have their row; other input columns are ignored.
    """
    sets = [(label, sorted(set(words.split())), len(words.split()), required.split(), excluding.split())
            for label, words, required, excluding in templates]
    vocabulary = sorted({w for _, words, *_ in sets for w in words})
    order = frequency_order(docs, text_col, vocabulary)
    place = {w: i for i, w in enumerate(order)}
    rows, prefix = [], set()
    for label, words, size, required, excluding in sets:
        ranked = sorted(words, key=place.__getitem__)
        need = math.ceil(min_containment * len(ranked) - 1e-9)
        for i, w in enumerate(ranked[:len(ranked) - need + 1]):
            rows.append((w, i, label, ranked, size, need, required, excluding))
            prefix.add(w)

    text = folded(F.col(text_col))
    prefix_words = strings(sorted(prefix))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t")).select(
        "doc_id", "t", word_list(F.col("t")).alias("words"))
    for i, (_, phrase) in enumerate(phrases):
        base = base.withColumn(f"p{i}", phrase_starts(F.col("words"), phrase))
    starts = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    base_set = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label))
                                         for i, (label, _) in enumerate(phrases)]))
    # each prefix word with the words around it, as far as a block that holds it can reach
    reach = max(size for _, _, size, *_ in sets) - 1 + NEAR
    at = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(prefix_words, w), i)), lambda i: i.isNotNull())
    around = F.transform(at, lambda i: F.struct(
        F.get("words", i).alias("word"), F.least(i, F.lit(reach)).alias("centre"),
        F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1).alias("around")))
    slim = materialize(
        base.withColumn("starts", starts).select(
            "doc_id", F.size("words").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
            F.array_min("starts").cast("long").alias("first_word"),
            F.array_max("starts").cast("long").alias("last_word"), F.array_distinct(base_set).alias("base_set"),
            F.xxhash64("t").alias("k1"), F.xxhash64(F.lit("text"), "t").alias("k2"),
            F.when(F.arrays_overlap("words", prefix_words), around).alias("blocks")), "license-blocks")

    prefixes = docs.sparkSession.createDataFrame(  # bounded by the templates
        rows, "word string, i int, label string, template array<string>, size int, need int, required array<string>, "
              "excluding array<string>")
    held = F.array_intersect(strings(order), F.col("around"))  # from the rarest
    rest = F.size("held") - F.array_position("held", F.col("word")).cast("int") + 1
    candidates = (slim.where("blocks is not null").select("k1", "k2", F.explode("blocks").alias("block"))
                  .select("k1", "k2", "block.word", "block.centre", "block.around").distinct()
                  .withColumn("held", held).join(F.broadcast(prefixes), "word")
                  .where((F.size("held") >= F.col("need")) & (F.least(F.size("template") - F.col("i"), rest) >= F.col("need")))
                  .where(F.size(F.array_intersect("held", "template")) >= F.col("need")))
    share = windows_found(*[F.col(c) for c in ("around", "centre", "template", "size", "need", "required", "excluding")])
    found = materialize(
        candidates.select("k1", "k2", "label", share.alias("share")).where("share is not null")
        .groupBy("k1", "k2").agg(F.collect_set("label").alias("found"), F.max("share").alias("best")), "licenses")

    joined = slim.join(found, ["k1", "k2"], "left")  # broadcast only if the written table is small
    every = F.array_union("base_set", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_set"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
