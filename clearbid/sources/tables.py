"""Table readers and the time-bounded scans (S1-S7).

Bounds are plain comparisons on ``tstamp``.  Tables written by this package are
partitioned by ``date`` (the UTC day of ``tstamp``); for those the readers
also add the matching ``date`` bounds, since Spark does not derive a
partition filter from a filter on another column.  Tables of
``layout.write_events`` carry ``at_minute`` as well, a whole number by which the
Parquet reader skips row groups; it cannot by a ``timestamp_ntz``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbid.functions import Interval, ts_lit
from clearbid.schemas import AD_TABLES, check_columns


def read_table(spark: SparkSession, root: str, name: str, check: bool = True) -> DataFrame:
    """S1/S5/S7: a named table below ``root`` (Parquet, possibly date-partitioned)."""
    df = spark.read.parquet(f"{root}/{name}")
    if check and name in AD_TABLES:
        check_columns(df, AD_TABLES[name], name)
    return df


EPOCH = datetime(1970, 1, 1)


def at_minute(col: str) -> Column:
    """Minutes from 1970 on of a ``timestamp_ntz``, whatever the session's time zone."""
    return F.unix_date(F.to_date(col)).cast("bigint") * 1440 + F.hour(col) * 60 + F.minute(col)


def _minute(at: datetime) -> int:
    return (at - EPOCH) // timedelta(minutes=1)


def bounded(df: DataFrame, col: str = "tstamp", lo: datetime | None = None,
            hi: datetime | None = None) -> DataFrame:
    """``lo <= col < hi`` (either side optional), plus partition bounds.

    When ``df`` carries the ``date`` partition column (UTC day of ``col``),
    the same bounds are stated on ``date`` so the scan lists only the touched
    day folders (``PartitionFilters``); where it carries ``at_minute``, on that
    too, which the Parquet reader compares with its row groups.
    """
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= ts_lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) < ts_lit(hi))
    if "date" in df.columns and col == "tstamp":
        if lo is not None:
            cond = cond & (F.col("date") >= F.lit(lo.date()))
        if hi is not None:
            cond = cond & (F.col("date") <= F.lit(hi.date()))
    if "at_minute" in df.columns and col == "tstamp":
        if lo is not None:
            cond = cond & (F.col("at_minute") >= F.lit(_minute(lo)))
        if hi is not None:
            cond = cond & (F.col("at_minute") <= F.lit(_minute(hi)))
    return df.filter(cond)


def only_keys_of(big: DataFrame, keys_from: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``big`` whose ``keys`` occur in ``keys_from``: a plain semi-join.

    No action, no hint and no size switch: the plan has one shape for every
    interval, and Spark picks the join from the sizes it measures.
    """
    return big.join(keys_from.select(*keys).distinct(), keys, "left_semi")


def time_range(df: DataFrame, interval: Interval, col: str = "tstamp") -> DataFrame:
    """S2/S6: rows with ``interval.start <= col < interval.end``."""
    return bounded(df, col, interval.start, interval.end)


def widened_range(df: DataFrame, interval: Interval, hours: int = 1, col: str = "tstamp") -> DataFrame:
    """S3: the interval widened by ``hours`` on both sides."""
    return time_range(df, interval.widened(hours), col)


def lookback(df: DataFrame, anchor: datetime, days: int, col: str = "tstamp") -> DataFrame:
    """S4: rows with ``col >= anchor - days`` (no upper bound)."""
    return bounded(df, col, anchor - timedelta(days=days), None)
