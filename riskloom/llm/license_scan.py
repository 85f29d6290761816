"""License scan by diagonal voting, in DataFrame operations alone.

All rolling ``k``-word grams of a text are joined by hash (and, to be exact, by their
words) with the positions of the same grams in the templates. A hit votes for the
diagonal word position minus template position, and carries the template position as a
bit. A diagonal is merged with those up to ``DRIFT`` words above it, as inserted or missing
words move a match from one to the other; the merged bits say which part of the template
is there. So a span is verified by construction: each counted gram stands within ``DRIFT``
words of its place in the template, and a span is at most so much longer than that;
word pairs scattered over a text, or in another order, don't add up. A template is found
if its share is at least the template's own bound: all for the base phrases, which are
counted on single diagonals, ``NOTICE`` for license notices.

Templates are constants, given as an argument; the table of their grams is a local
relation, which Spark broadcasts by its own size limit or else joins by a shuffle.

Defined results: null, empty and wordless texts have 0 words, no labels ('') and score
0; a row per input row, repeated rows and null ``doc_id`` included; ``first_word`` and
``last_word`` are null without base places. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, DRIFT, NOTICE = 2, 8, 0.6
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    base: bool = False


# Base phrases and the wording of public license notices.
TEMPLATES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("warranty-notice", "the software is provided as is without warranty of any kind express or implied"),
)
# End of fixed values.


def text_words(text: Column) -> Column:
    """Lower-cased words of a text, as an array."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def grams(words: Column, k: int) -> Column:
    """All runs of ``k`` words, joined by spaces."""
    n = F.greatest(F.size(words) - (k - 1), F.lit(0))
    out = F.slice(words, F.lit(1), n)
    for i in range(2, k + 1):
        out = F.zip_with(out, F.slice(words, F.lit(i), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def gram_table(spark, templates: tuple[Template, ...], k: int) -> DataFrame:
    rows = []
    for number, t in enumerate(templates):
        words = t.words.split()
        count = len(words) - k + 1
        if not 1 <= count <= 63:
            raise ValueError(f"{t.label}: a template has {k} to {62 + k} words; give a longer one in parts")
        rows += [(" ".join(words[i : i + k]), number, t.label, t.base, i, count) for i in range(count)]
    values = ", ".join(f"('{g}', {n}, '{label}', {str(base).lower()}, {i}, {c})" for g, n, label, base, i, c in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(template_gram, template, label, base, at, grams)")
    return table.withColumn("template_hash", F.xxhash64("template_gram"))


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = GRAM, notice: float = NOTICE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_words(F.col("text").cast("string")).alias("words"), F.monotonically_increasing_id().alias("row"))
    each = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(grams(F.col("words"), k)).alias("place", "gram"))
    table = gram_table(docs.sparkSession, templates, k)
    same = (F.xxhash64("gram") == F.col("template_hash")) & (F.col("gram") == F.col("template_gram"))
    hits = each.join(table, same, "left")
    key = ["row", "doc_id", "n_words", "template", "label", "base", "grams"]
    bit = F.expr("shiftleft(1L, at)")
    votes = hits.withColumn("diagonal", F.col("place") - F.col("at")).groupBy(*key, "diagonal").agg(F.bit_or(bit).alias("bits"))
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(0, DRIFT)
    spans = votes.withColumn("bits", F.when(F.col("base"), F.col("bits")).otherwise(F.bit_or("bits").over(near)))
    spans = spans.withColumn("start", F.col("diagonal").cast("long"))
    share = F.coalesce(F.bit_count("bits") / F.col("grams"), F.lit(0.0))
    found = spans.withColumn("share", share)
    place = F.when(F.col("base") & (F.col("share") == 1), F.col("start"))
    label = F.when(F.col("share") >= F.when(F.col("base"), 1.0).otherwise(notice), F.col("label"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count(place).alias("n_base"),
        F.min(place).alias("first_word"),
        F.max(place).alias("last_word"),
        joined(F.when(F.col("base"), label)).alias("base_labels"),
        joined(label).alias("labels"),
        F.max("share").alias("score"),
    ).drop("row")
