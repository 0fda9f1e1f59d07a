"""Newest-N copy and keep-N-newest-per-key retention.

``newest_n`` serves the environment sync (latest N rows of an aggregate table
by its hour/date field).  A global ``orderBy().limit(N)`` funnels N rows from
every partition into one task, so instead a histogram over hour buckets of the
sort field (bounded by the time span) gives, for each bucket, how many newer
rows exist; buckets entirely inside the first N keep all their rows through a
semi-join, and only the single boundary bucket is ranked row by row — by a
range partitioning and per-partition counts, not in one task.  A sort field of
any other type has no such buckets: there a quantile sketch proposes thresholds
near the N-th row and one exact count decides between them.

``longest_prefix`` matches names to the longest of many prefixes by equality.

``keep_newest_per_key`` is the snapshot-retention rule re-aimed at table rows:
per key keep the N newest, the rest are stale.  ``row_number() <= N`` is
planned with a partial ``WindowGroupLimit`` before the shuffle, so a hot key
sends at most N rows per input partition, never all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbid.session import ensure_checkpoint_dir

SKETCH = 10_000   # accuracy of the quantile sketch: ranks are off by about one part in so many


def newest_n(df: DataFrame, sort_col: str, n: int, tiebreak: list[str]) -> DataFrame:
    """The ``n`` rows with the largest ``sort_col`` (ties broken by ``tiebreak`` ascending).

    The histogram is taken over hour buckets of a timestamp sort field (or the
    days of a date field), so its size is bounded by the time span, never by the
    row count; its running sum is the only unpartitioned window.  Buckets wholly
    inside the first ``n`` rows are kept by a semi-join; only the one boundary
    bucket is ranked row by row.  Other types go by thresholds (``_largest_n``).
    """
    if n <= 0:
        return df.limit(0)
    dtype = df.schema[sort_col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        bucket = F.date_trunc("hour", F.col(sort_col)).cast(dtype)
    elif isinstance(dtype, T.DateType):
        bucket = F.col(sort_col)
    else:
        return _largest_n(df, sort_col, n, tiebreak)
    b = df.withColumn("_bucket", bucket)
    hist = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    newer = Window.orderBy(F.col("_bucket").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    hist = (hist.withColumn("_above", F.coalesce(F.sum("_cnt").over(newer), F.lit(0)))
            .filter(F.col("_above") < n)
            .withColumn("_room", F.lit(n) - F.col("_above")))
    whole = hist.filter(F.col("_cnt") <= F.col("_room")).select("_bucket")
    edge = hist.filter(F.col("_cnt") > F.col("_room")).select(F.col("_bucket").alias("_edge"), "_room")
    full = b.join(whole, b["_bucket"].eqNullSafe(whole["_bucket"]), "left_semi")
    e = b.join(edge, b["_bucket"].eqNullSafe(edge["_edge"]), "inner").drop("_edge")
    order = [F.col(sort_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    part = _positions(e, order).filter(F.col("_rn") <= F.col("_room")).drop("_rn", "_room")
    return full.unionByName(part).drop("_bucket")


def sort_number(col: str, dtype: T.DataType) -> Column:
    """A double that never falls where ``col`` rises: equal numbers may stand for different values.

    Texts and bytes go by their first seven bytes, NaN above all numbers, as Spark sorts it.
    """
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(F.col(col).cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    number = F.col(col).cast("double")
    return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)


def _largest_n(df: DataFrame, sort_col: str, n: int, tiebreak: list[str]) -> DataFrame:
    """``newest_n`` for sort fields without time buckets.

    A quantile sketch of the field gives thresholds around the ``n``-th row, a
    second pass counts exactly how many rows each lets through.  Rows above the
    last threshold with at most ``n`` rows are kept whole; the rows from there
    down to the first threshold with at least ``n`` are ranked (``_positions``).
    However far the sketch is off, the counts are exact: a bad guess only makes
    more rows to rank.
    """
    b = df.withColumn("_number", sort_number(sort_col, df.schema[sort_col].dataType))
    total, known = b.agg(F.count(F.lit(1)), F.count("_number")).first()
    order = [F.col(sort_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]

    def first(rows: DataFrame, room: int) -> DataFrame:
        return _positions(rows, order).filter(F.col("_rn") <= room).drop("_rn")
    if n >= total:
        return df
    if n >= known:   # all rows with a value, and some of those without
        return b.filter(F.col("_number").isNotNull()).unionByName(first(b.filter(F.col("_number").isNull()), n - known)).drop("_number")
    tail, off = n / known, 2 / SKETCH
    shares = sorted({min(1.0, max(0.0, 1 - t)) for t in (tail - 2 * off, tail - off, tail, tail + off, tail + 2 * off, 2 * tail + 4 * off)})
    guesses = sorted(set(b.agg(F.percentile_approx("_number", shares, SKETCH)).first()[0]))
    counts = b.agg(*[F.coalesce(F.sum((F.col("_number") >= F.lit(g)).cast("long")), F.lit(0)).alias(f"c{i}") for i, g in enumerate(guesses)]).first()
    enough = [g for g, c in zip(guesses, counts, strict=True) if c >= n]
    within = [(g, c) for g, c in zip(guesses, counts, strict=True) if c <= n]
    low = F.col("_number").isNotNull() if not enough else F.col("_number") >= F.lit(max(enough))
    if not within:
        return first(b.filter(low), n).drop("_number")
    top, above = min(within)
    full = b.filter(F.col("_number") >= F.lit(top))
    if above == n:
        return full.drop("_number")
    return full.unionByName(first(b.filter(low & (F.col("_number") < F.lit(top))), n - above)).drop("_number")


def _positions(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``_rn``, the 1-based position of each row in ``order``, without one
    task ranking them all (the boundary bucket can be a whole busy hour whose
    rows share one sort value).

    A range partitioning by ``order`` spreads the rows in order, each
    partition sorts its own, and a row's position is the row count of the
    partitions before it plus its place in its partition.  The spread rows are
    checkpointed (to the session's checkpoint folder) so the counts and the
    rows come from the same sampled range bounds; the offsets table has one
    row per partition, so broadcasting it is bounded by the partition count.
    """
    ensure_checkpoint_dir(df.sparkSession)
    spread = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint())
    counts = spread.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # monotonically_increasing_id = partition index << 33 | place in partition
    place = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (spread.join(F.broadcast(offsets), "_pid")
            .withColumn("_rn", F.col("_off") + place + 1)
            .drop("_pid", "_mid", "_off"))


def longest_prefix(df: DataFrame, name: str, prefixes: DataFrame, out_col: str = "prefix") -> DataFrame:
    """Rows of ``df`` with the longest of ``prefixes`` (column ``prefix``) that their ``name`` starts with; others go.

    A name's beginnings, one for each distinct prefix length, meet the prefixes
    by equality, so nothing is compared with all prefixes; distinct names are
    matched once.  Lengths are counted in characters; the empty prefix matches
    every name.
    """
    texts = prefixes.select(F.col("prefix").alias("_prefix")).filter("_prefix IS NOT NULL").distinct()
    lengths = sorted(r[0] for r in texts.select(F.char_length("_prefix")).distinct().collect())   # a few numbers
    if not lengths:
        return df.limit(0).withColumn(out_col, F.lit(None).cast("string"))
    starts = F.array_compact(F.array(*[F.when(F.char_length("_name") >= k, F.substring("_name", 1, k)) for k in lengths]))
    names = df.select(F.col(name).alias("_name")).filter("_name IS NOT NULL").distinct()
    met = names.select("_name", F.explode(starts).alias("_prefix")).join(texts, "_prefix")
    best = met.groupBy("_name").agg(F.max_by("_prefix", F.char_length("_prefix")).alias("_best"))
    return df.join(best, F.col(name) == F.col("_name")).select(*df.columns, F.col("_best").alias(out_col))


def keep_newest_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """Rows ranked 1..n per key by ``order`` (e.g. ``[F.desc('created')]``), with ``rank`` column."""
    if n < 1:
        raise ValueError("keep at least one row per key")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def stale_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, row_id: list[str]) -> DataFrame:
    """Rows beyond the ``n`` newest per key (what retention deletes).

    Computed as all rows minus the kept ones (anti-join on ``row_id``) so the
    ranking step keeps its partial group limit.
    """
    kept = keep_newest_per_key(df, keys, order, n).select(*row_id)
    return df.join(kept, row_id, "left_anti")
