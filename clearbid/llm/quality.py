"""Document quality rules with host verdicts; DataFrame functions only.

Per text: word and symbol counts, repeated lines, and words that lie in 3-word
windows found twice or more.  Rule failures are then summed by host and each
host's failure rate is shrunk towards the corpus by a beta prior whose strength
is the method-of-moments fit over all hosts, so that a host with two pages is
not judged by two pages.  A host is rejected by a rule if its rate surely stands
out: the lower bound of its shrunk rate (``BOUND`` posterior standard deviations
below it) is above ``HOST_TIMES`` the corpus rate and above ``HOST_LIMIT``.  The
verdict is joined back to the host's documents.

Repeated windows are found inside the row: 34-bit window hashes with their
positions are sorted as plain longs, and only positions whose hash occurs twice
are compared as strings, so the count is exact and nothing of a text is shuffled.

Defined results: a null or empty text has no words and fails as too short; a
null host is a host of its own; repeated rows count and are judged each; an
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import materialize

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_LIMIT = 0.2          # a host is judged by a rule only if this share of its documents surely fails it,
HOST_TIMES = 2.0          # and if that is so many times the share in the corpus
BOUND = 3.0
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6
POSITION_BITS = 30


def text_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words), one row per row."""
    text = F.coalesce("text", F.lit(""))
    bare = F.trim(F.col("text"), F.lit(BLANKS))
    df = docs.select("doc_id", F.col(host).alias("host"), text.alias("text"))
    worded = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select("doc_id", "host", "text", F.when(bare == "", F.array().cast("array<string>"))
                   .otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("w"), worded.alias("lines"))
    shift = 1 << POSITION_BITS
    packed = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.shiftleft(
        F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)), POSITION_BITS).bitwiseOR(i.cast("long")))
        ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        "doc_id", "host", "w", F.size("w").cast("long").alias("n_words"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"[^\x20\x09-\x0D]+", ""))).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        packed.alias("packed"))
    df = df.withColumn("s", F.sort_array("packed")).drop("packed")
    hashed = lambda x: F.shiftrightunsigned(x, POSITION_BITS)
    twice = F.filter("s", lambda x, k: (hashed(x) == F.coalesce(hashed(F.get("s", k + 1)), F.lit(-1)))
                     | ((k > 0) & (hashed(x) == F.coalesce(hashed(F.get("s", k - 1)), F.lit(-1)))))
    # exact check of the few candidates: the three words themselves
    df = df.withColumn("c", F.transform(twice, lambda x: x.bitwiseAND(F.lit(shift - 1)).cast("int"))).drop("s")
    named = F.sort_array(F.transform("c", lambda p: F.struct(
        F.concat_ws(" ", F.get("w", p), F.get("w", p + 1), F.get("w", p + 2)).alias("g"), p.alias("p"))))
    df = df.withColumn("g", F.when(F.size("c") == 0, F.lit(None)).otherwise(named)).drop("w")
    same = lambda a, b: F.coalesce(a["g"] == b["g"], F.lit(False))
    places = F.array_sort(F.transform(F.filter("g", lambda x, k: same(x, F.get("g", k + 1)) | ((k > 0) & same(x, F.get("g", k - 1)))), lambda x: x["p"]))
    df = df.withColumn("at", places)
    # union of the windows [p, p + 3): each adds what the window before does not cover
    covered = F.aggregate("at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                          lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
                          lambda acc: acc["n"])
    return df.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Rule name -> failed; every column is a non-null boolean."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "dup_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
    }


def host_verdicts(stats: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n, <rule> shrunk rates, rejected): failures by host, shrunk by an empirical beta prior."""
    names = list(rules())
    hosts = materialize(stats.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(k) for k, c in rules().items()]), "hosts")
    totals = hosts.agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in names]).first()
    n, m = totals["n"] or 0, totals["m"]
    means = {k: (totals[k] or 0) / n if n else 0.0 for k in names}
    spread = hosts.agg(F.lit(0).alias("none"), *[
        (F.sum(F.col("n") * F.pow(F.col(k) / F.col("n") - means[k], 2)) / max(n, 1)).alias(k) for k in names]).first()
    rates, rejected = [], F.lit(False)
    for k in names:
        within = means[k] * (1 - means[k])
        between = (spread[k] or 0.0) - within * (m - 1) / max(n, 1)   # variance beyond what sampling explains
        strength = MAX_STRENGTH if between <= within / MAX_STRENGTH else within / between - 1
        strength = min(MAX_STRENGTH, max(MIN_STRENGTH, strength))
        rate = (F.col(k) + strength * means[k]) / (F.col("n") + strength)
        rates.append(rate.alias(k))
        surely = rate - BOUND * F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1))
        rejected = rejected | (surely > max(limit, HOST_TIMES * means[k]))
    return hosts.select("host", "n", *rates, rejected.alias("rejected"))


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Statistics, ``base_failed``, ``host_rejected`` and ``kept`` for every row of ``docs``."""
    stats = materialize(text_stats(docs, host), "stats")
    verdicts = host_verdicts(stats, limit).select(F.col("host").alias("h"), "rejected")
    failed = rules()["short"] | rules()["repeats"]
    return (stats.join(verdicts, stats["host"].eqNullSafe(F.col("h")), "left")
            .withColumn("base_failed", failed).withColumn("host_rejected", F.coalesce("rejected", F.lit(False)))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("h", "rejected"))
