"""Table upkeep jobs: migration (C22), environment sync (C23), retention (O2).

Each table is copied by its own Spark job (read -> write); nothing passes
through the driver.  Event tables are rewritten partitioned by UTC ``date``
so later time-bounded scans prune partitions.

Copies are verified by ``table_digest``: per partition the number of rows and two
order-free combinations (sum and xor) of row hashes, compared between source and
copy.  A migration that runs again copies only the partitions whose digests
differ, so it resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbid.operators.ranking import longest_prefix, newest_n, stale_per_key
from clearbid.sources import sinks
from clearbid.sources.owned import stored

# The event tables the migration copies (the reference list,
# with its two fused names split) and the request/response log tables.
AD_EVENT_TABLES = [
    "actions", "auction_stats", "auction_defaults", "auctions", "bid_responses", "bids",
    "click_matched_actions", "clicks", "imp_matched_actions", "impressions", "win_notices",
]
HTTP_EVENT_TABLES = ["http_requests", "http_responses"]

# The environment sync plan.  Full copies, newest-N copies of
# the aggregate tables (with their sort field) and copy-once tables.
SYNC_FULL = ["advertisers", "publishers", "organizations", "users", "payments", "insertionorders",
             "accesscodes", "termsandconditions", "demohourlyadstats", "screenshots", "blockedips",
             "blockeduseragents", "salespeople"]
SYNC_NEWEST = [("hourlyadstats", "hour"), ("geoadstats", "hour"), ("keywordadstats", "hour"),
               ("dailyadstats", "date")]
SYNC_NEWEST_LIMIT = 100_000
SYNC_ONCE = ["cliques"]


def _time_col(df: DataFrame) -> str | None:
    for c in ("tstamp", "hour", "date"):
        if c in df.columns:
            return c
    return None


def row_hash(df: DataFrame, seed: int) -> Column:
    """64-bit hash of a row, whatever the order of its columns; NULLs are told apart by their place."""
    cols = sorted(df.columns)
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in cols])
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in cols], nulls)


def table_digest(df: DataFrame, part: Column | None = None) -> DataFrame:
    """(part, n_rows, hash_sum, hash_xor): equal for equal multisets of rows, in any order and any files."""
    hashed = df.select((F.lit(None).cast("date") if part is None else part).alias("part"), row_hash(df, 1).alias("a"), row_hash(df, 2).alias("b"))
    return hashed.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("a").cast("decimal(20,0)")).alias("hash_sum"),
                                      F.bit_xor("b").alias("hash_xor"))


def compare_tables(source: DataFrame, copy: DataFrame | None) -> DataFrame:
    """(part, n_source, n_copy, equal) for each day (or the whole table) that either side has."""
    tcol = _time_col(source)
    day = None if tcol is None else F.to_date(tcol)
    there = table_digest(source.limit(0) if copy is None else copy.select(*source.columns), day)
    a, b = table_digest(source, day).alias("a"), there.alias("b")
    same = F.expr("a.n_rows <=> b.n_rows AND a.hash_sum <=> b.hash_sum AND a.hash_xor <=> b.hash_xor")
    # a table without times has one part, a null; full outer joins take equality of texts
    on = F.coalesce(F.col("a.part").cast("string"), F.lit("")) == F.coalesce(F.col("b.part").cast("string"), F.lit(""))
    return a.join(b, on, "full").select(F.coalesce("a.part", "b.part").alias("part"), F.coalesce("a.n_rows", F.lit(0)).alias("n_source"),
                                        F.coalesce("b.n_rows", F.lit(0)).alias("n_copy"), same.alias("equal"))


def copy_verified(source: DataFrame, path: str) -> int:
    """Make ``path`` hold exactly ``source``, day by day; returns how many parts were written.

    Days that are equal already stay as they are.  What was written is read
    back and compared; a difference raises.
    """
    spark = source.sparkSession
    found = compare_tables(source, stored(spark, path)).filter("NOT equal").collect()   # one row per day of the table
    if not found:
        return 0
    tcol = _time_col(source)
    if tcol is None:
        source.write.mode("overwrite").parquet(path)
    else:
        part = "day" if "date" in source.columns else "date"
        days = {r["part"] for r in found}
        wanted = F.to_date(tcol).isin([d for d in days if d]) | (F.to_date(tcol).isNull() if None in days else F.lit(False))
        rows = source.filter(wanted).withColumn(part, F.to_date(tcol))
        if any(r["n_source"] == 0 for r in found):
            raise ValueError(f"{path} holds days that the source lacks: {sorted(str(r['part']) for r in found if r['n_source'] == 0)}")
        sinks.overwrite_partitions(rows, path, [part])
    wrong = compare_tables(source, stored(spark, path)).filter("NOT equal").collect()
    if wrong:
        raise ValueError(f"{path} differs from its source in {sorted(str(r['part']) for r in wrong)}")
    return len(found)


def migrate_dataset(spark: SparkSession, source_root: str, dest_root: str,
                    names: tuple[str, ...] = (*AD_EVENT_TABLES, *HTTP_EVENT_TABLES)) -> dict[str, int | None]:
    """C22 over the table lists: table -> parts written (None: not at the source).

    Tables are copied one after the other, each verified, and a run that broke
    off goes on with what is missing or different.
    """
    done: dict[str, int | None] = {}
    for name in names:
        source = stored(spark, os.path.join(source_root, name))
        done[name] = None if source is None else copy_verified(source, os.path.join(dest_root, name))
    return done


def migrate_tables(spark: SparkSession, sources: dict[str, DataFrame], dest_root: str) -> dict[str, str]:
    """Copy every table whole into ``dest_root``; time tables partitioned by day.

    Rows are clustered by day before the write so each day partition gets few
    files.  Returns table -> written path.
    """
    written = {}
    for name, df in sources.items():
        path = os.path.join(dest_root, name)
        tcol = _time_col(df)
        if tcol is None:
            df.write.mode("overwrite").parquet(path)
        else:
            # event tables get the ``date`` partition column the bounded scans
            # prune on; tables that already hold a ``date`` field use ``day``
            part = "day" if "date" in df.columns else "date"
            out = df.withColumn(part, F.to_date(tcol))
            sinks.overwrite_partitions(out, path, [part])
        written[name] = path
    return written


def sync_environment(spark: SparkSession, source_root: str, dest_root: str,
                     full: list[str] = SYNC_FULL, newest: list[tuple[str, str]] = SYNC_NEWEST,
                     once: list[str] = SYNC_ONCE, limit: int = SYNC_NEWEST_LIMIT) -> dict[str, str]:
    """Production -> development copy.

    ``full`` tables are replaced whole, ``newest`` aggregate tables keep their
    newest ``limit`` rows by the sort field (ties broken by all other columns),
    ``once`` tables are copied only if the target is missing or empty.
    A table missing at the source raises before anything is touched.
    """
    done = {}
    absent = [n for n in [*full, *[n for n, _ in newest], *once] if stored(spark, os.path.join(source_root, n)) is None]
    if absent:
        raise FileNotFoundError(f"not at the source: {', '.join(absent)}")
    for name in full:
        src = os.path.join(source_root, name)
        sinks.replace(spark.read.parquet(src), os.path.join(dest_root, name))
        done[name] = "replaced"
    for name, field in newest:
        src = os.path.join(source_root, name)
        df = spark.read.parquet(src)
        tie = [c for c in df.columns if c != field]
        sinks.replace(newest_n(df, field, limit, tie), os.path.join(dest_root, name))
        done[name] = f"newest {limit}"
    for name in once:
        src = os.path.join(source_root, name)
        copied = sinks.copy_once(spark.read.parquet(src), os.path.join(dest_root, name))
        done[name] = "copied" if copied else "kept"
    return done


def retention(df: DataFrame, keys: list[str], created: str, keep: int, row_id: list[str],
              prefix: tuple[str, str] | None = None, prefixes: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Rows to purge: all but the ``keep`` newest per key by ``created``.

    ``prefix`` = (column, text) looks only at rows whose column starts with the
    text (P9), as names that carry their key in front do.  ``prefixes`` =
    (column, frame with a column ``prefix``) does so for many texts at once: rows
    go by the longest prefix that matches, which joins ``keys``; others stay.
    """
    if keep < 1:
        raise ValueError("keep must be >= 1")
    if prefix:
        df = df.filter(F.col(prefix[0]).startswith(prefix[1]))
    if prefixes:
        columns, own = df.columns, "_matched"
        df = longest_prefix(df, prefixes[0], prefixes[1], own)
        return stale_per_key(df, [*keys, own], [F.col(created).desc()] + [F.col(c).desc() for c in row_id], keep, row_id).select(
            *columns, F.col(own).alias("prefix"))
    order: list[Column] = [F.col(created).desc()] + [F.col(c).desc() for c in row_id]
    return stale_per_key(df, keys, order, keep, row_id)
