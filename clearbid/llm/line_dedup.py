"""Line dedup by site-relative frequency.

Pages are grouped by host.  A line (trimmed of ASCII white space) that stands
on ``MIN_PAGES`` or more of a host's pages and on more than ``RATIO`` of all of
them is boilerplate of that host and is dropped from its pages.  Lines without
a word are never dropped.

Besides, a passage is caught however small its share of a host
(``long_words``; None leaves this rule out): a line of more words than that on ``MIN_PAGES`` or more different texts,
of whatever hosts, stays on one of them (that of the smallest hash) and is
dropped from all others.  Copies of a whole text count as one there, so no
passage is lost.

Only 16-byte line keys are shuffled for the counts, combined map-side per
(host, line), so a host with a third of all pages or a line on a third of all
pages is one counter per task.  Pages that hold boilerplate get their list of
lines to drop through a join on a content key, never on the host.

Defined results: a null text stays null and counts as a page without lines; a
null host is a host of its own; repeated rows count as pages each and get equal
results; a page that loses every line keeps its row with what blank lines it
had; an empty table gives an empty result.  Extra columns ride along; one named as the
count (``dropped``) is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import content_key, fresh, materialize

RATIO = 0.1
MIN_PAGES = 3
LONG_WORDS = 50           # passages have more words than this

BLANKS = " \t\n\x0b\f\r"


def lines(text: Column) -> Column:
    # a plain split on a single character; -1 keeps trailing empty lines
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Key of a line: MD5 of the trimmed line, null for a line without a word."""
    return bare_key(F.trim(line, F.lit(BLANKS)))


def bare_key(bare: Column) -> Column:
    return F.when(bare != "", F.unhex(F.md5(bare)))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, n_pages, host_pages) of the lines to drop; ``pages`` has host and keys (distinct line keys)."""
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counts = (pages.select("host", F.explode("keys").alias("line")).groupBy("host", "line")
              .agg(F.count(F.lit(1)).alias("n_pages")).filter(F.col("n_pages") >= min_pages))
    return (counts.alias("c").join(totals.alias("t"), F.expr("c.host <=> t.host"))
            .filter(F.col("n_pages") > ratio * F.col("host_pages"))
            .select("c.host", "line", "n_pages", "host_pages"))


def has_words_over(bare: Column, n: int) -> Column:
    # so many words need at least as many characters and the blanks between them
    return (F.char_length(bare) > 2 * n) & (F.size(F.split(bare, f"[{BLANKS}]+")) > n)


def repeated_passages(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(line, keeper) of the passages to drop but from ``keeper``; ``pages`` has page (key of the text) and long (line keys)."""
    return (pages.select("page", F.explode("long").alias("line")).distinct().groupBy("line")
            .agg(F.count(F.lit(1)).alias("n_pages"), F.min("page").alias("keeper")).filter(F.col("n_pages") >= min_pages)
            .select("line", "keeper"))


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES, long_words: int | None = LONG_WORDS,
                dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the cleaned ``text`` and the number of lines dropped from it."""
    columns = [c for c in docs.columns if c.lower() != dropped.lower()]
    own_key, own_drop = fresh(docs, "__key", "__drop")
    key = content_key(F.col(host), F.col(text))
    # distinct as strings: Spark hashes those, while binary keys would be compared pair by pair
    bare = F.array_distinct(F.transform(lines(F.col(text)), lambda x: F.trim(x, F.lit(BLANKS))))
    keys = F.array_compact(F.transform(bare, bare_key))
    none = F.array().cast("array<binary>")
    long = [] if long_words is None else [
        content_key(F.col(text)).alias("page"),
        F.coalesce(F.transform(F.filter(bare, lambda x: has_words_over(x, long_words)), bare_key), none).alias("long")]
    pages = materialize(docs.select(F.col(host).alias("host"), key.alias("__key"), F.coalesce(keys, none).alias("keys"), *long), "page-lines")
    bad = boilerplate(pages, ratio, min_pages).select("host", "line")
    # what to drop from each distinct page: at most the distinct lines of that page
    found = pages.select("host", "__key", F.explode("keys").alias("line")).alias("p")
    lost = found.join(bad.alias("b"), F.expr("p.host <=> b.host AND p.line = b.line"), "left_semi").select("__key", "line")
    if long_words is not None:
        passages = pages.select("__key", "page", F.explode("long").alias("line")).alias("p")
        lost = lost.union(passages.join(repeated_passages(pages, min_pages).alias("b"), F.expr("p.line = b.line AND p.page <> b.keeper"), "left_semi")
                          .select("__key", "line"))
    drop = lost.groupBy(F.col("__key").alias(own_key)).agg(F.collect_set("line").alias(own_drop))
    joined = docs.withColumn(own_key, key).join(drop, own_key, "left")
    before = lines(F.col(text))
    kept = F.filter(before, lambda x: ~F.coalesce(F.array_contains(F.col(own_drop), line_key(x)), F.lit(False)))
    clean = F.when(F.col(own_drop).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    count = F.when(F.col(own_drop).isNull(), F.lit(0)).otherwise(F.size(before) - F.size(kept)).cast("long")
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in columns], count.alias(dropped))
