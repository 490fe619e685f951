"""License scans: phrases, and an exact set-similarity join against templates.

DataFrame functions only. A text becomes its words (runs of digits, lower-case
letters and non-ASCII characters, after lower-casing A-Z), each between spaces.
Phrases are found by their places in that string. For templates, the words are
cut into overlapping text blocks, and a block matches a template when it holds
at least ``CONTAINMENT`` of the template's distinct tokens. The join is exact:

* tokens are ordered by how many documents hold them, rarest first, counted over
  all documents;
* a block that matches must hold one of the first ``size - need + 1`` tokens of
  the template (prefix filter), which an index of those tokens finds;
* it must hold ``need`` tokens of templates at all (length filter);
* from the first token in common, both orders must leave room for ``need`` in
  all (positional filter); what is left is verified.

Results for odd input: null and empty texts have no words and no labels;
documents are told apart by id and text, so repeated rows get equal results and a
null id is an id; an empty table gives an empty result; other columns of
documents play no part.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import ascii_lower, staged

# The phrases that are looked for, each with its label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices of well-known licences, each with its label.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the gnu affero general public license": "agpl-3.0",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
CONTAINMENT = 0.9
#: Words of a text block, and words from one block's start to the next; a notice of up to half a block lies in one whole.
BLOCK, STEP = 64, 32
PHRASE_ONLY_SCORE = 0.5
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def spaced_words(text: Column) -> Column:
    """The words, each as `` word ``: two spaces between words, one at both ends; empty without words."""
    inner = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, "  "))
    return F.when(inner == "", F.lit("")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _words_in(spaced: Column) -> Column:
    return ((F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def _phrase(words: str) -> str:
    return " " + "  ".join(words.split()) + " "


def phrase_columns(s: Column, n_words: Column, phrases: dict[str, str] = PHRASES) -> dict[str, Column]:
    """n_base, first_word, last_word and base_labels (sorted array) of spaced words."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        p, n = _phrase(phrase), len(phrase.split())
        has = s.contains(p)
        gone = F.octet_length(s) - F.octet_length(F.replace(s, F.lit(p), F.lit("")))
        counts.append(F.when(has, (gone / len(p.encode())).cast("long")).otherwise(0))
        firsts.append(F.when(has, _words_in(F.substring_index(s, p, 1))))
        lasts.append(F.when(has, n_words - _words_in(F.substring_index(s, p, -1)) - n))
        labels.append(F.when(has, F.lit(label)))
    return {
        "n_base": sum(counts, F.lit(0)).cast("long"),
        "first_word": F.array_min(F.array(*firsts)),
        "last_word": F.array_max(F.array(*lasts)),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def token_order(docs: DataFrame, text: str, templates: dict[str, str]) -> DataFrame:
    """token and rank: all tokens of the templates, those of fewest documents first (over all documents)."""
    vocabulary = sorted({w for t in templates for w in t.split()})
    s = docs.select(spaced_words(F.col(text)).alias("s")).where("s <> ''")
    held = s.select(
        F.explode(
            F.array_intersect(F.split(F.trim("s"), "  "), F.array(*[F.lit(w) for w in vocabulary]))
        ).alias("token")
    )
    every = docs.sparkSession.createDataFrame([(w,) for w in vocabulary], "token string")
    counted = every.join(held.groupBy("token").agg(F.count("*").alias("n")), "token", "left")
    # the vocabulary is a fixed short list, so that one window over it is small
    return counted.select(
        "token", F.row_number().over(Window.orderBy(F.coalesce("n", F.lit(0)), "token")).alias("rank")
    )


def _sorted_templates(ranks: dict[str, int], templates: dict[str, str], containment: float) -> list[tuple]:
    out = []
    for i, (notice, label) in enumerate(templates.items()):
        tokens = sorted(set(notice.split()), key=ranks.__getitem__)
        need = ceil(containment * len(tokens) - 1e-9)
        out.append((i, label, tokens, need))
    return out


def scan(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT,
) -> tuple[DataFrame, DataFrame]:
    """(documents, blocks).

    documents: key, n_words, n_base, first_word, last_word, base_labels, labels
    (arrays), score. blocks: key, text_hash, start (word), template, label,
    containment, for every text block and template that match.
    """
    spark = docs.sparkSession
    # a fixed list of tokens, as long as the templates
    ranks = {r["token"]: r["rank"] for r in token_order(docs, text, templates).collect()}
    plan = _sorted_templates(ranks, templates, containment)
    vocabulary = sorted(ranks, key=ranks.__getitem__)
    prefixes = [(w, p, i, label, tokens, need) for i, label, tokens, need in plan
                for p, w in enumerate(tokens[: len(tokens) - need + 1])]
    rare = F.array(*[F.lit(w) for w in sorted({x[0] for x in prefixes})])

    words = F.split(F.trim(F.col("s")), "  ")
    starts = F.sequence(F.lit(0), F.greatest(F.col("n_words") - STEP - 1, F.lit(0)), F.lit(STEP))
    blocks = F.transform(
        starts, lambda i: F.struct(i.alias("start"), F.array_distinct(F.slice("w", (i + 1).cast("int"), F.lit(BLOCK))).alias("t"))
    )
    spaced = docs.select(
        F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), spaced_words(F.col(text)).alias("s")
    )
    counted = spaced.withColumn("n_words", _words_in(F.col("s")))
    split = counted.withColumn("w", F.when(F.col("s") != "", words))
    found = split.select(
        "id", "text_hash", "n_words",
        *[c.alias(n) for n, c in phrase_columns(F.col("s"), F.col("n_words"), phrases).items()],
        F.when(F.arrays_overlap("w", rare), F.filter(blocks, lambda b: F.arrays_overlap(b["t"], rare))).alias("blocks"),
    )
    base = staged(found, "license-blocks")

    index = F.broadcast(
        spark.createDataFrame(
            prefixes, "token string, at int, template int, label string, tokens array<string>, need int"
        )
    )
    known = F.array(*[F.lit(w) for w in vocabulary])  # in global order, so that the intersection is
    cut = base.select("id", "text_hash", F.explode("blocks").alias("b")).select(
        "id", "text_hash", F.col("b.start").alias("start"), F.array_intersect(known, F.col("b.t")).alias("held")
    )
    probes = cut.distinct().select("*", F.posexplode("held").alias("place", "token"))
    candidates = (
        probes.join(index, "token")
        .where(F.size("held") >= F.col("need"))
        .groupBy("id", "text_hash", "start", "held", "template", "label", "tokens", "need")
        .agg(F.min(F.struct("at", "place")).alias("first"))
    )
    room = 1 + F.least(F.size("tokens") - F.col("first.at"), F.size("held") - F.col("first.place")) - 1
    shared = F.size(F.array_intersect("tokens", "held"))
    matches = (
        candidates.where(room >= F.col("need"))
        .withColumn("shared", shared)
        .where(F.col("shared") >= F.col("need"))
        .select("id", "text_hash", "start", "template", "label", (F.col("shared") / F.size("tokens")).alias("containment"))
    )
    summed = matches.groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    joined = base.drop("blocks").join(
        summed, F.col("id").eqNullSafe(F.col("_id")) & F.col("text_hash").eqNullSafe(F.col("_hash")), "left"
    )
    documents = joined.select(
        F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, PHRASE_ONLY_SCORE).otherwise(0.0)).alias("score"),
    )
    return documents, matches.withColumnRenamed("id", key)
