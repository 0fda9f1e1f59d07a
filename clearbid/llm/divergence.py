"""How far the sources of a language differ in their words.

One pass of ``bytes.translate`` lowers A-Z and blanks every byte that stands in
no term; ``bytes.split`` and one Counter per document give its terms with their
frequencies.  A task adds its documents' counters up and hands a sum on when
it holds ``HELD_TERMS`` terms, so the shuffle sees sparse sums of (lang, source,
term) and no document's words.

Each language keeps the terms of at least ``MIN_DOCS`` of its documents.  A
group's smoothed share of a term, ``p = 1 + floor(10^9 (n + 2) / (N + 2 V))``, and
the term's part in a divergence, ``f(p, q) = floor((p - q)^2 / (p + q))``, are whole
numbers.  A pair of sources is summed over all kept terms without ever making
rows of terms that a source lacks: with zero(g) the share of a term without
occurrences, the sum of f over all terms is

    sum over the terms of a of f(p_a, zero_b), the same for b,
    plus (V - terms of a - terms of b) f(zero_a, zero_b),
    plus, for each term that both hold,
    f(p_a, p_b) - f(p_a, zero_b) - f(zero_a, p_b) + f(zero_a, zero_b).

The first two come from the histogram of a group's shares, the last from an
equi-join on the term.  f is symmetric, so each pair is summed once.

Defined results: a null text, lang or source is ''; an empty text has no terms;
repeated rows count once each; a group without kept terms takes part with zero
counts; a language that keeps no term gives pairs of value 0; the only source of
a language has no pair; equal values are ranked by the item's UTF-8 bytes; an
empty table gives no rows.  Further columns of ``docs`` are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbid.llm.common import materialize, ship

ship(__name__)

MIN_DOCS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
HELD_TERMS = 200_000   # terms that a task sums up before it hands them on
BLOCK = 1 << 20        # bytes of a text that are split at once
SALT = 64              # shares of a language's groups are dealt over so many keys

# A-Z become a-z; bytes of multi-byte characters and a-z stay; all others are blank.
TERM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_text(text: bytes) -> Counter:
    """Terms of one document and how often each occurs; long texts are split block by block, at blanks."""
    clean, counts, at = text.translate(TERM_TABLE), Counter(), 0
    while at < len(clean):
        end = len(clean) if len(clean) - at <= BLOCK else clean.find(b" ", at + BLOCK)
        end = len(clean) if end < 0 else end
        counts.update(clean[at:end].split())
        at = end
    return counts


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, n_docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()),
                pa.array([n_docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "n_docs"])
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            counts = count_text(text.as_py())
            n, n_docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            size -= len(n)
            for term, k in counts.items():
                n[term] += k
            n_docs.update(list(counts))
            size += len(n)
            if size >= HELD_TERMS:
                yield from hand_on()
                size = 0
    yield from hand_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, n_docs): occurrences and documents of each term in each group."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    sums = read.mapInArrow(_sum_batches, "lang string, source string, term string, n bigint, n_docs bigint")
    return sums.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(n: str, total: str, terms: str) -> Column:
    """``1 + floor(UNIT (n + 2) / (total + 2 terms))`` without rounding."""
    whole = f"CAST({UNIT} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))"
    return F.expr(f"1 + ({whole}) DIV CAST(greatest({total} + 2 * {terms}, 1) AS DECIMAL(20,0))")


def part(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) DIV (({p}) + ({q}))"


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts of the terms that their language keeps, with the language's own count.

    ``leads`` marks one row of each term of a language, to count terms by.
    """
    term = Window.partitionBy("lang", "term")
    return (counts.withColumn("lang_docs", F.sum("n_docs").over(term)).withColumn("lang_n", F.sum("n").over(term))
            .withColumn("leads", F.row_number().over(term.orderBy("source")) == 1)
            .filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "leads"))


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, total, terms, lang_total, lang_terms, zero), one for each occurring group."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"),
                                              F.sum(F.col("leads").cast("long")).alias("leads"))
    full = groups.join(sums, ["lang", "source"], "left").na.fill(0, ["total", "terms", "leads"])
    lang = Window.partitionBy("lang")
    return (full.withColumn("lang_total", F.sum("total").over(lang)).withColumn("lang_terms", F.sum("leads").over(lang))
            .withColumn("zero", share("0", "total", "lang_terms")).drop("leads"))


def source_pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value): divergence of each ordered pair of a language's sources."""
    shares = (held.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
              .select("lang", "source", "p", "k", F.lit(0).cast("long").alias("all_terms"))
              .union(groups.select("lang", "source", "zero", -F.col("terms"), "lang_terms")))
    left = shares.withColumn("salt", F.pmod(F.xxhash64("source", "p", "k"), F.lit(SALT)))
    right = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"),
                          F.explode(F.expr(f"sequence(0L, {SALT - 1}L)")).alias("salt"))
    pair = (F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"))
    times = F.col("k") + F.when(F.col("source") < F.col("other"), F.col("all_terms")).otherwise(0)
    alone = (left.join(right, ["lang", "salt"]).filter(F.col("source") != F.col("other"))
             .select("lang", *pair, (times * F.expr(part("p", "other_zero"))).alias("value")))
    one, two = (held.select("lang", "term", F.col("source").alias(s), F.col("p").alias(f"p{s}"), F.col("zero").alias(f"z{s}")) for s in "ab")
    both = one.join(two, ["lang", "term"]).filter(F.col("a") < F.col("b")).select(
        "lang", "a", "b", F.expr(f"{part('pa', 'pb')} - {part('pa', 'zb')} - {part('za', 'pb')} + {part('za', 'zb')}").alias("value"))
    summed = alone.union(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                              F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s")
    return summed.select("lang", sides, "value").select("lang", "s.source", "s.item", "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` for each other source, ``term`` for the top terms.

    A term's value compares the group with its whole language, and only terms
    that the group holds more of than the language are ranked.
    """
    kept = materialize(kept_terms(term_counts(docs), min_docs), "divergence-kept")
    groups = materialize(group_totals(docs, kept), "divergence-groups")
    held = materialize(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "zero", share("n", "total", "lang_terms").alias("p"),
        share("lang_n", "lang_total", "lang_terms").alias("q")), "divergence-shares")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (held.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(part("p", "q")).alias("value"))
             .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms))
    pairs = (source_pairs(held, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(order)))
    return pairs.union(terms)
