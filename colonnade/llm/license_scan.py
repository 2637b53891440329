"""License scan by an exact containment join of text blocks with license templates.

Blocks are the lines of a text and, for notices wrapped over several lines, the windows of as many consecutive words
of the whole text as the template has. A block matches a template when it holds at least ``THRESHOLD`` of the
template's distinct words; a window is asked for its own template only, and made only in texts that hold as many of
the template's words anywhere. The join is the set-similarity join with prefix, length and positional
filters: words are ordered by their frequency over all blocks, rarest first, so that a match must share a
word of a short template prefix; later positions bound what two sets can still share. Only words of
templates can take part, so a block is reduced to those first. Next to it, ``phrase_places`` finds fixed
phrases of consecutive words. DataFrame functions only.

Templates are parameters: their words (a few hundred) are literals of the plan, bounded by
``MOST_TEMPLATE_WORDS``.

Defined cases: null and empty texts have no words, no labels, score 0; equal rows are reported each; null
doc_ids too (rows are told apart by id and a 64-bit fingerprint of the text); other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm import common
from colonnade.session import materialize

THRESHOLD = 0.85
MOST_TEMPLATE_WORDS = 5000
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # before A-Z are lowered

# Phrases of consecutive words, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening notices of well-known public licenses, and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]


KELVIN, KRA = "\u212a", "\u0138"  # the one character that lower() would turn into an ASCII letter, and a stand-in


def plain_words(text: Column) -> Column:
    """The words, one blank between two."""
    return F.trim(F.regexp_replace(text, NOT_WORD, " "))


def normal_words(text: Column) -> Column:
    """Lower-cased words, one blank between two. Only ASCII words are looked for, so other letters may be lowered too."""
    return F.lower(F.replace(plain_words(text), F.lit(KELVIN), F.lit(KRA)))


def blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def word_count(words: Column) -> Column:
    return F.when(words == "", F.lit(0)).otherwise(blanks(words) + 1).cast("long")


def phrase_places(words: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """n_base, first_word, last_word and base_labels (an array) of the phrases in ``normal_words``."""
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    count, first, last, labels = [], [], [], []
    for phrase, label in phrases.items():
        mark = f" {phrase} "
        there = F.contains(padded, F.lit(mark))
        count.append(F.when(there, F.regexp_count(padded, F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        first.append(F.when(there, blanks(F.substring_index(padded, mark, 1))))
        last.append(F.when(there, word_count(words) - len(phrase.split()) - blanks(F.substring_index(padded, mark, -1))))
        labels.append(F.when(there, F.lit(label)))
    return {"n_base": sum(count[1:], count[0]).cast("long"), "first_word": F.least(*first, F.lit(None)).cast("long"),
            "last_word": F.greatest(*last, F.lit(None)).cast("long"), "base_labels": F.array_compact(F.array(*labels))}


def template_sets(templates: list[tuple[str, str]], threshold: float) -> list[dict]:
    """Distinct words of each template and the overlap it asks for."""
    rows = []
    for number, (label, text) in enumerate(templates):
        low = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text.lower())
        words = sorted(set(low.split()))
        if words:
            rows.append({"template": number, "label": label, "words": words, "need": math.ceil(threshold * len(words) - 1e-9),
                         "span": len(low.split())})
    if sum(len(r["words"]) for r in rows) > MOST_TEMPLATE_WORDS:
        raise ValueError("too many template words for literals of a plan")
    return rows


def windows(docs: DataFrame, sets: list[dict], vocabulary: list[str]) -> DataFrame:
    """(doc_id, mark, block, only, words): the template's words in each window, across lines, that holds enough of them;
    ``only`` is the template. Windows begin at a word of the template and are numbered down from -1."""
    known = F.array(*[F.struct(F.lit(t["template"]).alias("template"), F.lit(t["need"]).alias("need"), F.lit(t["span"]).alias("span"),
                               F.array(*map(F.lit, t["words"])).alias("words")) for t in sets])
    held = F.array(F.array_intersect("all_words", F.array(*map(F.lit, vocabulary))))
    able = F.transform(held, lambda h: F.filter(known, lambda t: F.size(F.array_intersect(h, t["words"])) >= t["need"]))[0]
    texts = docs.select("doc_id", "mark", F.split(normal_words(F.col("text")), " ").alias("all_words"))
    asked = texts.select("doc_id", "mark", "all_words", F.explode(able).alias("t"))
    starts = F.filter(F.sequence(F.lit(1), F.size("all_words")), lambda p: F.array_contains(F.col("t.words"), F.element_at("all_words", p)))
    spans = F.transform(starts, lambda p: F.array_intersect(F.slice("all_words", p, F.col("t.span")), F.col("t.words")))
    enough = F.array_distinct(F.filter(spans, lambda w: F.size(w) >= F.col("t.need")))
    found = asked.select("doc_id", "mark", F.col("t.template").alias("only"), F.posexplode(enough).alias("block", "words"))
    return found.select("doc_id", "mark", (-1 - F.col("block")).alias("block"), "only", "words")


def block_matches(docs: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """Every (doc_id, mark, block, template) whose block meets the threshold, with label, overlap and size of the
    template. ``docs`` has doc_id, mark and text; blocks from 0 are lines, those below 0 windows."""
    sets = template_sets(templates, threshold)
    vocabulary = sorted({w for t in sets for w in t["words"]})
    lines = docs.select("doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("block", "line"))
    held = F.array_intersect(F.split(normal_words(F.col("line")), " "), F.array(*map(F.lit, vocabulary)))
    blocks = lines.select("doc_id", "mark", "block", F.lit(None).cast("int").alias("only"), held.alias("words")).filter(F.size("words") > 0)
    blocks = materialize(blocks.unionByName(windows(docs, sets, vocabulary)), "license-blocks")
    # the global order: rarest word first; one row for each template word
    frequency = {r["word"]: r["n"] for r in blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    prefix: dict[str, list] = {}
    for t in sets:
        ranked = sorted(t["words"], key=order.__getitem__)
        for i, w in enumerate(ranked[:len(ranked) - t["need"] + 1]):
            prefix.setdefault(w, []).append((t["template"], i, len(ranked), t["need"]))
    rank = F.create_map(*chain.from_iterable((F.lit(w), F.lit(i)) for w, i in order.items()))
    smallest = min(t["need"] for t in sets)
    spark = docs.sparkSession
    index = spark.createDataFrame([(order[w], *x) for w, xs in prefix.items() for x in xs], "rank int, template int, i int, size int, need int")
    ranked = blocks.filter(F.size("words") >= smallest).select(
        "doc_id", "mark", "block", "only", F.array_sort(F.transform("words", lambda w: rank[w])).alias("ranks"))
    probes = ranked.select("*", F.posexplode("ranks").alias("j", "rank"))
    probes = probes.filter(F.col("j") <= F.size("ranks") - smallest)
    candidates = probes.join(F.broadcast(index), "rank").filter(
        (F.col("only").isNull() | (F.col("only") == F.col("template")))
        & (F.size("ranks") >= F.col("need"))  # length
        & (F.col("j") <= F.size("ranks") - F.col("need"))  # prefix of the block
        & (1 + F.least(F.col("size") - F.col("i") - 1, F.size("ranks") - F.col("j") - 1) >= F.col("need")))  # position
    members = F.create_map(*chain.from_iterable((F.lit(t["template"]), F.array(*[F.lit(order[w]) for w in t["words"]])) for t in sets))
    label = F.create_map(*chain.from_iterable((F.lit(t["template"]), F.lit(t["label"])) for t in sets))
    checked = candidates.withColumn("overlap", F.size(F.array_intersect("ranks", members[F.col("template")]))).filter("overlap >= need")
    return checked.groupBy("doc_id", "mark", "block", "template").agg(F.first("overlap").alias("overlap"), F.first("size").alias("size")).withColumn(
        "label", label[F.col("template")])


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select("doc_id", common.text_of(docs).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    found = block_matches(rows, templates, threshold).groupBy("doc_id", "mark").agg(
        F.collect_set("label").alias("found"), F.max(F.col("overlap") / F.col("size")).alias("score"))
    found = found.select(F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), "found", "score")
    counted = rows.withColumn("words", normal_words(F.col("text"))).select(
        "doc_id", "mark", word_count(F.col("words")).alias("n_words"), *[c.alias(n) for n, c in phrase_places(F.col("words"), phrases).items()])
    both = counted.join(found, counted["doc_id"].eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left")
    every = F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>")))
    line = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", line(F.col("base_labels")).alias("base_labels"),
                       line(every).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
