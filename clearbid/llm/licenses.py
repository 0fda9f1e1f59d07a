"""License scan: exact set-similarity join of text blocks with license templates.

A block is a run of up to ``RUN_LINES`` neighbouring lines, as its set of words,
one run from each line on, so that a notice wrapped over as many lines is whole
in one of them.  Of a template of fewer than ``SHORT`` words all must stand in a
run unless one line holds enough: stray words of neighbours would do otherwise.  A template is found in a block if at least ``CONTAINMENT`` of the template's words stand in it, those that name its license
(``NAMES``: an LGPL notice is one word away from a GPL notice) among them.  Words of
templates are ordered by how many blocks hold them, rarest first; a block that
contains enough of a template must share a word of the template's prefix within
its own prefix, have enough words (length filter), and leave enough words after
the shared one (positional filter).  What is left is verified exactly.  The
templates are a fixed short list, so their side of the join is broadcast.

Words that no template has cannot match and are dropped from the block sets
first, which changes no overlap.

Base labels are places where a phrase's words stand consecutively anywhere in
the text, across lines too.

Defined results: a null or empty text has no words, no labels and score 0; equal
rows get equal results; an empty table gives an empty result.  Extra columns are
ignored.  The score is 1 with a base place, else the best containment of a
template that was found, else 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import content_key, materialize

CONTAINMENT = 0.8
RUN_LINES = 3
SHORT = 8                 # templates of fewer words must stand whole in a run of several lines
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# label of each phrase
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# (label, opening words of the license or of its usual notice); the words of NAMES must stand among those found
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


# words without which a notice is that of another license
NAMES = {"apache", "attribution", "gnu", "lesser", "mit", "mozilla", "nc", "unencumbered"}


def names_of(words: str) -> list[str]:
    return sorted(NAMES & set(words.split()))


def _words(line: Column) -> Column:
    return F.filter(F.split(line, NON_WORD), lambda x: x != "")


def _places(phrase: str) -> Column:
    """Start positions of a phrase in the word array ``w``."""
    parts = phrase.split()

    def at(i):
        ok = F.get("w", i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            ok = ok & F.coalesce(F.get("w", i + k) == p, F.lit(False))
        return ok
    return F.filter(F.sequence(F.lit(0), F.size("w") - 1), at)


def read_blocks(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT,
                run_lines: int = RUN_LINES) -> DataFrame:
    """(doc_id, key, n_words, <label> start positions, blocks): blocks are (first line, set of template words)."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    least = min(math.ceil(containment * len(set(t.split())) - 1e-9) for _, t in templates)
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    df = docs.select("doc_id", content_key(F.col("doc_id"), F.col("text")).alias("key"), text.alias("low"))
    df = df.withColumn("lines", F.transform(F.split("low", "\n", -1), _words))
    known = F.array(*[F.lit(w) for w in vocabulary])
    df = df.withColumn("sets", F.transform("lines", lambda b: F.array_intersect(b, known)))
    runs = F.transform("sets", lambda b, i: F.struct(i.cast("int").alias("block"), F.array_distinct(F.flatten(F.slice("sets", i + 1, run_lines))).alias("words"), b.alias("own")))
    blocks = F.filter(runs, lambda b: F.size(b["words"]) >= least)
    loose = "|".join(NON_WORD.join(p.split()) for p in PHRASES)
    # only texts where a phrase's letters stand in order need their words numbered
    df = df.select("doc_id", "key", F.aggregate("lines", F.lit(0).cast("long"), lambda n, b: n + F.size(b)).alias("n_words"),
                   F.when(F.col("low").rlike(loose), F.flatten("lines")).alias("w"), blocks.alias("blocks"))
    none = F.array().cast("array<int>")
    return df.select("doc_id", "key", "n_words", "blocks", *[
        F.when(F.size(F.coalesce("w", F.array().cast("array<string>"))) > 0, _places(p)).otherwise(none).alias(label)
        for p, label in PHRASES.items()])


def match_blocks(blocks: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, key, block, template, label, containment) for a written table with (doc_id, key, blocks).

    A block is named by its first line, a template by its place in the list.  A
    match is repeated for each prefix word that it shares.
    """
    spark = blocks.sparkSession
    rows = blocks.select("doc_id", "key", F.explode("blocks").alias("b")).select("doc_id", "key", "b.block", "b.own", F.col("b.words").alias("b"))
    counts = {r["t"]: r["n"] for r in rows.select(F.explode("b").alias("t")).groupBy("t")
              .agg(F.count(F.lit(1)).alias("n")).collect()}   # at most the words of the templates
    vocabulary = sorted({w for _, t in templates for w in t.split()}, key=lambda w: (counts.get(w, 0), w))
    order = {w: i for i, w in enumerate(vocabulary)}
    prefix = []
    for t, (label, words) in enumerate(templates):
        ranks = sorted(order[w] for w in set(words.split()))
        need = math.ceil(containment * len(ranks) - 1e-9)
        names = [order[w] for w in names_of(words)]
        prefix += [(r, i, t, label, len(ranks), need, ranks, names) for i, r in enumerate(ranks[:len(ranks) - need + 1])]
    index = F.broadcast(spark.createDataFrame(prefix, "rank int, i int, template int, label string, size int, need int, words array<int>, names array<int>"))
    ranked = F.create_map(*[F.lit(x) for w, r in order.items() for x in (w, r)])
    sets = rows.select("doc_id", "key", "block", F.transform("own", lambda w: F.element_at(ranked, w)).alias("own"),
                       F.sort_array(F.transform("b", lambda w: F.element_at(ranked, w))).alias("r"))
    probes = sets.select("doc_id", "key", "block", "own", "r", F.size("r").alias("n"), F.posexplode("r").alias("j", "rank"))
    left = F.least(F.col("size") - F.col("i"), F.col("n") - F.col("j"))
    met = (probes.join(index, "rank").filter((F.col("n") >= F.col("need")) & (left >= F.col("need")))
           .withColumn("shared", F.size(F.array_intersect("r", "words"))).filter((F.col("shared") >= F.col("need")) & (F.size(F.array_except("names", "r")) == 0))
           .filter((F.col("size") >= SHORT) | (F.col("shared") == F.col("size")) | (F.size(F.array_intersect("own", "words")) >= F.col("need"))))
    return met.select("doc_id", "key", "block", "template", "label", (F.col("shared") / F.col("size")).alias("containment"))


def find_templates(blocks: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(key, found: labels, best: largest containment) for a written table with (doc_id, key, blocks)."""
    return (match_blocks(blocks, templates, containment).groupBy("key")
            .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best")))


def find_blocks(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT,
                run_lines: int = RUN_LINES) -> DataFrame:
    """(doc_id, key, block, template, label, containment), one row per match of a distinct document; runs overlap."""
    return match_blocks(materialize(read_blocks(docs, templates, containment, run_lines), "blocks"), templates, containment).distinct()


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT,
         run_lines: int = RUN_LINES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), labels as sorted arrays."""
    blocks = materialize(read_blocks(docs, templates, containment, run_lines), "blocks")
    found = find_templates(blocks, templates, containment)
    places = F.concat(*[F.col(label) for label in PHRASES.values()])
    base = F.array_sort(F.array_compact(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in PHRASES.values()])))
    none = F.array().cast("array<string>")
    n_base = F.size(places).cast("long")
    return blocks.join(found, "key", "left").select(
        "doc_id", "n_words", n_base.alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("found", none))).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
