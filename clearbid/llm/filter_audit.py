"""What each filter of a cleaning chain removes, in every order of the filters.

Each filter is a written table of the ids that fail it.  Per filter, a left-semi
and a left-anti join split the rows into those that fail it and those that pass,
so after the last filter the rows of one cell have failed exactly the same
filters and share their fate in every prefix of every order.  The cells of a
part, at most 2^filters, then stand for its rows: a left-anti join with the
failing ids of a prefix leaves its survivors, a left-semi join of those with the
next filter's ids gives what that filter removes, and a left-semi join of the
filter's own ids with the prefix's gives what was gone before (redundant).
Losses are the removed rows that stand in a table of wanted (or unwanted) ids.

A prefix's survivors depend on the set of its filters alone, so 2^n sets are
computed for the n! orders.  Every row carries an id of its own, written once:
doc_ids may be null or repeated.

Defined results of the five filters: a null text is '', a null source the part
''; an empty text has no words and fails A alone (and E, if a smaller doc_id is
empty too); a null doc_id is neither smaller nor larger than another, so it
fails no E and makes none fail; rows of equal doc_id and text are no smaller
than each other; a document with several label rows has the label if any row
says so, a null doc_id has none; an empty table gives no rows.  Further columns
of ``docs`` are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import materialize

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = "[#$%&*|]"
HEAVY = 200   # a text with more than 1/200 of all rows is heavy; at most 200 texts can be


def read_facts(docs: DataFrame) -> DataFrame:
    """One written row per document: its row id, part, text key and the verdicts of filters A to D."""
    text = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    words = text.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    upper = F.char_length(F.regexp_replace("text", "[^A-Z]+", ""))
    return materialize(words.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "part", F.sha2("text", 256).alias("text_key"),
        (n < MIN_WORDS).alias("A"), (100 * distinct < MIN_DISTINCT_PERCENT * n).alias("B"),
        (100 * upper > MAX_UPPER_PERCENT * F.char_length("text")).alias("C"), F.col("text").rlike(SYMBOLS).alias("D")), "facts")


def later_copies(facts: DataFrame) -> DataFrame:
    """Row ids whose text a smaller doc_id has too.

    The smallest doc_id of each repeated text is joined back to its rows: the
    heavy texts, ``HEAVY`` at most, by broadcast, so that no task gathers one;
    the others by the text's key.
    """
    groups = facts.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(groups.filter("n > 1"), "repeated")
    heavy_from = facts.count() / HEAVY
    heavy = F.broadcast(repeated.filter(F.col("n") > heavy_from).select("text_key", "first"))
    others = repeated.filter(F.col("n") <= heavy_from).select("text_key", "first")
    rows = facts.select("row_id", "doc_id", "text_key")
    of_heavy = rows.join(heavy, "text_key")
    of_others = rows.join(heavy, "text_key", "left_anti").join(others, "text_key")
    return of_heavy.union(of_others).filter("doc_id > first").select("row_id")


def split_rows(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Add ``cell`` to rows (row_id, ...): bit k is set if ``tables[k]`` holds the row's id."""
    cells = rows.withColumn("cell", F.lit(0).cast("long"))
    for k, ids in enumerate(tables):
        held = cells.join(ids, "row_id", "left_semi").withColumn("cell", F.col("cell") + (1 << k))
        cells = materialize(held.union(cells.join(ids, "row_id", "left_anti")), "cells")
    return cells


def literal_rows(rows: list[tuple], names: list[str]) -> Column:
    """Generator of constant rows."""
    return F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]))


def interactions(rows: DataFrame, failing: dict[str, DataFrame], losses: dict[str, DataFrame]) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, <losses>, shapley).

    ``rows`` holds (row_id, part); ``failing`` and ``losses`` are written tables
    of row ids, ``failing`` by a filter's one-letter name.
    """
    names, n = list(failing), len(failing)
    counted = split_rows(rows.select("row_id", "part"), [*failing.values(), *losses.values()])
    bit = lambda k: F.expr(f"(cell & {1 << k}L) <> 0")
    mask = F.expr(f"CAST(cell & {(1 << n) - 1}L AS INT)")
    sums = [F.sum(F.when(bit(n + k), 1).otherwise(0)).alias(loss) for k, loss in enumerate(losses)]
    cells = materialize(counted.groupBy("part", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"), *sums), "filter-cells")

    fails = cells.select("part", "mask", "n", F.expr(f"explode(filter(sequence(0, {n - 1}), f -> (mask & shiftleft(1, f)) <> 0))").alias("filter"))
    pairs = [(s, f) for s in range(1 << n) for f in range(n)]
    members = literal_rows([(s, f) for s, f in pairs if s >> f & 1], ["prefix", "filter"]).alias("m")
    turns = literal_rows([(s, f) for s, f in pairs if not s >> f & 1], ["prefix", "filter"]).alias("m")
    one = cells.sparkSession.range(1)
    nothing = cells.select("part").distinct().select("part", turns).select("part", "m.*")
    members, turns = (F.broadcast(one.select(rows).select("m.*")) for rows in (members, turns))   # 2^n n rows at most

    gone = fails.join(members, "filter").select("part", "mask", "prefix")
    tried = cells.withColumn("prefix", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
    reached = tried.join(gone, ["part", "mask", "prefix"], "left_anti").join(turns, "prefix")
    removed = reached.join(fails.drop("n"), ["part", "mask", "filter"], "left_semi")
    kept = reached.join(fails.drop("n"), ["part", "mask", "filter"], "left_anti")
    failed = fails.join(turns, "filter")
    before = failed.join(gone, ["part", "mask", "prefix"], "left_semi")
    alone = failed.filter(F.expr("mask = shiftleft(1, filter)"))

    measures = ["kept", "removed", "redundant", "unique_fails", *losses]

    def told(df: DataFrame, **values: str) -> DataFrame:
        return df.select("part", "prefix", "filter", *[(F.col(values[m]) if m in values else F.lit(0)).cast("long").alias(m) for m in measures])

    parts = told(nothing).union(told(kept, kept="n")).union(told(removed, removed="n", **{x: x for x in losses}))
    parts = parts.union(told(before, redundant="n")).union(told(alone, unique_fails="n"))
    totals = parts.groupBy("part", "prefix", "filter").agg(*[F.sum(m).alias(m) for m in measures])

    orders = [("".join(names[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k]) for order in permutations(range(n)) for k in range(n)]
    steps = cells.sparkSession.createDataFrame(orders, "filter_order string, step int, prefix int, filter int")
    told_steps = totals.join(F.broadcast(steps), ["prefix", "filter"])   # n! n rows
    weight = told_steps.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return told_steps.join(weight, ["part", "filter"]).select("part", "filter_order", "step", *measures, "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters A to E over ``docs``, with the labelled losses ``good_lost`` and ``toxic_lost``."""
    facts = read_facts(docs)
    failing = {f: materialize(facts.filter(F.col(f)).select("row_id"), f"failing-{f}") for f in "ABCD"}
    failing["E"] = materialize(later_copies(facts), "failing-E")
    losses = {loss: materialize(facts.join(labels.filter(F.col(label) == 1).select("doc_id"), "doc_id", "left_semi").select("row_id"), loss)
              for loss, label in (("good_lost", "quality"), ("toxic_lost", "toxic"))}
    return interactions(facts, failing, losses)
