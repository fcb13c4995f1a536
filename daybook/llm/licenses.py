"""License scan by diagonal voting.

Every rolling word 2-gram of a text is joined, by its hash and then its two
words, to the positions that it has in the templates. A hit votes for the
diagonal (text position minus template position) of its template. A short
phrase stands wherever one diagonal has all of the phrase's grams. For longer
templates neighbouring diagonals, which words added or left out put apart,
are merged, and the span is verified by how much of the template its votes
cover.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.llm.common import ascii_lower

GRAM = 2
NEAR = 3  # diagonals this close are merged
VOTES = 2  # a diagonal of a template needs as many votes
COVER = 0.6  # share of a template's grams that a span must hold
LONGEST = 126  # grams of a template: two longs mark which were seen
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``exact`` ones are phrases that must stand whole; the others may be found in part."""

    label: str
    text: str
    exact: bool = False


# Phrases, and license texts or their openings, with their labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("mit", "released under the mit license"),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("apache", "licensed under the apache license version"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version"),
    Template("gpl", "this work is licensed under the gnu general public license version"),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
)


def template_words(text: str) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(GAP, lower) if w]


def words(text: Column) -> Column:
    """The words of a whole text, A-Z lower-cased; none for a null text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def gram_rows(templates: tuple[Template, ...]) -> list[tuple[int, int, str, str, bool, int, str]]:
    """(template, position, first word, second word, exact, grams of the template, label)."""
    out = []
    for t, template in enumerate(templates):
        w = template_words(template.text)
        grams = len(w) - GRAM + 1
        if not 1 <= grams <= LONGEST:
            raise ValueError(f"a template has from 2 to {LONGEST + 1} words: {template.text[:40]}")
        out += [(t, p, w[p], w[p + 1], template.exact, grams, template.label) for p in range(grams)]
    return out


def _grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """The template side; template -1 is the row that every text hits once, so no text is lost."""
    rows = [F.struct(F.lit(t).alias("template"), F.lit(p).alias("at"), F.lit(a).alias("w1"), F.lit(b).alias("w2"),
                     F.lit(x).alias("exact"), F.lit(g).alias("grams"), F.lit(label).alias("label"))
            for t, p, a, b, x, g, label in [(-1, 0, "", "", False, 0, ""), *gram_rows(templates)]]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("hash", F.xxhash64("w1", "w2"))


def votes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = PHRASES + TEMPLATES) -> DataFrame:
    """One row per text, template and diagonal: row, doc_id, n_words, the template's columns, n_votes, first, last, seen0, seen1.

    ``row`` tells repeated rows apart. Template -1 has one row for each text.
    """
    one = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                      words(F.col(f"`{text}`")).alias("words"))
    # Position -1 is the gram of two empty words.
    each = one.select("row", "doc_id", "words", F.size("words").cast("long").alias("n_words"),
                      F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - GRAM, F.lit(-1)))).alias("p"))
    word = {k: F.when(F.col("p") >= 0, F.get("words", F.col("p") + k)).otherwise("") for k in (0, 1)}
    # The template side is fixed and small: about one row for each of its words.
    side = F.broadcast(_grams(docs.sparkSession, templates))
    hit = each.withColumn("hash", F.xxhash64(word[0], word[1])).join(side, "hash") \
        .where((word[0] == F.col("w1")) & (word[1] == F.col("w2")))
    seen = [F.when(F.col("at").between(63 * k, 63 * k + 62), F.expr(f"shiftleft(1L, at - {63 * k})"))
            .otherwise(F.lit(0).cast("long")) for k in (0, 1)]
    return hit.groupBy("row", "doc_id", "n_words", "template", "exact", "grams", "label", (F.col("p") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("n_votes"), F.min("p").alias("first"), F.max("p").alias("last"),
        F.bit_or(seen[0]).alias("seen0"), F.bit_or(seen[1]).alias("seen1"))


def spans(found: DataFrame) -> DataFrame:
    """Verified and unverified spans: row, doc_id, n_words, template, exact, label, first, last (words), cover.

    Exact templates keep the diagonals that have all their grams. Others have
    neighbouring diagonals merged; ``cover`` is the share of the template's
    grams seen in the span. Template -1 passes through.
    """
    whole = F.col("n_votes") == F.col("grams")
    keep = found.where(F.when(F.col("template") < 0, F.lit(True)).when(F.col("exact"), whole).otherwise(F.col("n_votes") >= VOTES))
    # A window is one text's diagonals of one template.
    w = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.when(~F.col("exact") & (F.col("diagonal") - F.lag("diagonal").over(w) <= NEAR), 0).otherwise(1)
    merged = keep.withColumn("apart", apart).withColumn("span", F.sum("apart").over(w))
    return merged.groupBy("row", "doc_id", "n_words", "template", "exact", "grams", "label", "span").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.bit_or("seen0").alias("seen0"), F.bit_or("seen1").alias("seen1")) \
        .withColumn("cover", F.when(F.col("grams") > 0, (F.bit_count("seen0") + F.bit_count("seen1")) / F.col("grams")).otherwise(0.0)) \
        .withColumn("last", F.col("last") + GRAM - 1).drop("grams", "seen0", "seen1", "span")


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = PHRASES + TEMPLATES) -> DataFrame:
    """One row per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all phrases, first_word and last_word are the
    smallest and largest word they start at (null if there is none). labels
    adds those of templates covered by COVER or more. score is the best cover
    of any template, 1 where a phrase stands. Null and empty texts have zero
    words and no label; repeated rows are scanned each; an empty table gives
    no rows.
    """
    found = spans(votes(docs, id_col, text, templates))
    base = F.col("exact")
    good = base | ((F.col("template") >= 0) & (F.col("cover") >= COVER))

    def labels(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(good).alias("labels"),
        F.least(F.max("cover"), F.lit(1.0)).alias("score")).drop("row")
