"""License scan by diagonal voting, in DataFrame operations alone.

All rolling word k-gram hashes of a text join the positions at which templates have them. A hit at word p of a
text and word q of a template votes for the diagonal p - q. A diagonal with all of a template's k-grams is a
place where its words stand consecutively. For longer templates, neighbouring diagonals are merged, so that
inserted or missing words do not part a span, and the span is verified by the share of the template's distinct
k-grams in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 3
#: Words of neighbouring diagonals' distance, and share of a template's k-grams in a verified span.
GAP, SHARE = 4, 0.6
# Phrases with their labels, found where their words stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Opening words of well-known license texts and notices, with their labels.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "licensed under the apache license version 2 0": "apache-2",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "either version 2 of the license or at your option any later version": "gpl-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2",
}
_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = "\x00end"


def _templates(spark) -> DataFrame:
    """(template, label, base, grams, q, gram): the k-grams of all templates, a fixed small table."""
    rows = []
    for n, (text, label) in enumerate([*PHRASES.items(), *TEMPLATES.items()]):
        w = text.split()
        rows += [(n, label, text in PHRASES, len(w) - K + 1, q, w[q : q + K]) for q in range(len(w) - K + 1)]
    rows.append((-1, None, False, 0, 0, [_END] * K))
    df = spark.createDataFrame(rows, "template int, label string, base boolean, grams int, q int, words array<string>")
    return df.select("template", "label", "base", "grams", "q", _hash(F.col("words"), F.lit(0)).alias("gram"))


def _hash(words, i):
    return F.xxhash64(*(F.get(words, i + j) for j in range(K)))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Row by row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    Words are runs of ASCII letters, digits and non-ASCII characters, in lower case. ``score`` is the largest share of a
    template found in a verified span, 1 where a phrase stands, 0 without either. Null and empty texts have no words, no places and empty
    labels. Rows that repeat id and text are each returned. Other columns are ignored; an empty table gives an empty result.
    """
    # lower() also maps other capitals; the two that it would map to a letter of a template are put aside
    text = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u0138")), F.lit("\u0130"), F.lit("\u0131"))
    words = F.filter(F.split(F.lower(text), _WORDS), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), words.alias("words"))
    n = F.size("words")
    hits = F.transform(F.sequence(F.lit(0), n - K), lambda i: F.struct(i.alias("p"), _hash(F.col("words"), i).alias("gram")))
    # a last entry, met by the table's last row, keeps every text and its number of words
    end = F.array(F.struct(n.alias("p"), F.xxhash64(*[F.lit(_END)] * K).alias("gram")))
    grams = rows.select("doc_id", "row", F.explode(F.when(n >= K, F.concat(hits, end)).otherwise(end)).alias("at"))
    grams = grams.select("doc_id", "row", "at.p", "at.gram")
    met = grams.join(F.broadcast(_templates(docs.sparkSession)), "gram")

    key = ["doc_id", "row", "template", "label", "base", "grams"]
    votes = met.groupBy(*key, (F.when(F.col("template") >= 0, F.col("p") - F.col("q")).otherwise(F.col("p"))).alias("diagonal"))
    votes = votes.agg(F.collect_set("q").alias("found"), F.count("*").alias("rows"))
    along = Window.partitionBy("row", "doc_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > GAP
    spans = votes.withColumn("span", F.sum(F.when(apart, 1).otherwise(0)).over(along))
    share = lambda c: F.size(c) / F.col("grams")
    exact = F.col("base") & (share("found") == 1)
    merged = spans.groupBy(*key, "span").agg(
        F.array_distinct(F.flatten(F.collect_list("found"))).alias("all"),
        F.sum(F.when(exact, 1).otherwise(0)).alias("places"),
        F.min(F.when(exact, F.col("diagonal"))).alias("first"),
        F.max(F.when(exact, F.col("diagonal"))).alias("last"),
        F.max("diagonal").alias("diagonal"),
        F.max("rows").alias("rows"),
    )
    end_row, text_span = F.col("template") < 0, (F.col("template") >= 0) & ~F.col("base") & (share("all") >= SHARE)
    listed = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    out = merged.groupBy("doc_id", "row").agg(
        F.max(F.when(end_row, F.col("diagonal"))).cast("long").alias("n_words"),
        F.sum("places").cast("long").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        listed(F.col("places") > 0).alias("base_labels"),
        listed((F.col("places") > 0) | text_span).alias("labels"),
        F.coalesce(F.max(F.when(F.col("places") > 0, 1.0).when(text_span, share("all"))), F.lit(0.0)).alias("score"),
        F.max(F.when(end_row, F.col("rows"))).alias("copies"),
    )
    return out.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("nth", "copies", "row")
