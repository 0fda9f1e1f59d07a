"""Hourly -> daily rollup and the keyed daily upsert.

Daily rows group the hourly stats by (advertiser, campaign, adv_clique,
publisher, site, pub_clique).  Sums follow document-store ``$sum``: NULL or
missing values are skipped and an all-missing group sums to 0; ``clearprice``
is an average of the hourly averages over rows that have one (NULL when none).
``uniques`` is left out since distinct counts do not add up.

``daily_partials`` keeps, per hour and group, what those aggregates need (sums,
and sum and count of the prices); ``merge_partials`` makes daily rows of them.  A
job that replaces some hours of a day replaces their partials and merges the
day's, a few rows per group, instead of reading all stats of the day again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.functions import Interval, day_floor, ts_lit
from clearbid.schemas import DAILY_KEYS

GROUP = ["advertiser", "campaign", "adv_clique", "publisher", "site", "pub_clique"]
LONG_SUMS = ["bids", "imps", "defaults", "clicks", "view_convs", "click_convs"]
OUTPUT = ["date", *GROUP, "bids", "imps", "defaults", "clearprice", "spend", "clicks",
          "view_convs", "click_convs"]


def _sum0(name: str, cast: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast(cast).alias(name)


def daily_ad_stats(hourly: DataFrame, day_start: datetime | None = None,
                   day_end: datetime | None = None) -> DataFrame:
    """Daily rollup of hourly stats.

    With ``day_start``/``day_end`` the rows of that range get the literal date
    ``day_start`` floored to midnight (one run of the reference job); without
    them every day of the table is rolled up at once, keyed by the day of
    ``hour`` (the backfill form).
    """
    h = hourly
    if day_start is not None:
        h = h.filter(Interval(day_start, day_end).contains("hour"))
        date = ts_lit(day_start.replace(hour=0, minute=0, second=0, microsecond=0))
    else:
        date = day_floor("hour")
    h = h.select(date.alias("date"), *GROUP, *LONG_SUMS, "spend", "clearprice")
    out = h.groupBy("date", *GROUP).agg(
        *[_sum0(c, "bigint") for c in LONG_SUMS],
        _sum0("spend", "double"),
        F.avg("clearprice").alias("clearprice"),
    )
    return out.select(*OUTPUT)


PARTIAL_SUMS = [*LONG_SUMS, "spend", "price_sum", "price_n"]


def daily_partials(hourly: DataFrame) -> DataFrame:
    """Mergeable state of the daily rows, one row per hour and group."""
    return hourly.groupBy("hour", *GROUP).agg(
        *[_sum0(c, "bigint") for c in LONG_SUMS], _sum0("spend", "double"),
        F.coalesce(F.sum("clearprice"), F.lit(0.0)).alias("price_sum"), F.count("clearprice").alias("price_n"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Daily rows (as ``daily_ad_stats``) of the days that ``partials`` hold."""
    out = partials.groupBy(day_floor("hour").alias("date"), *GROUP).agg(*[F.sum(c).alias(c) for c in PARTIAL_SUMS])
    price = F.when(F.col("price_n") > 0, F.col("price_sum") / F.col("price_n")).alias("clearprice")
    return out.withColumn("clearprice", price).select(*OUTPUT)


def upsert(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keyed upsert as a set operation: new rows replace old rows of equal key.

    Keys match NULL to NULL (default rows carry no advertiser/campaign), old
    keys absent from ``new`` stay untouched, nothing is deleted.  Columns of
    ``old`` that ``new`` lacks keep the old value of the key (NULL for a new
    key); columns only ``new`` has are added.  The null-safe joins plan as
    hash/sort-merge joins on coalesced keys.
    """
    keys = keys or DAILY_KEYS
    cond = None
    nk = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    for k in keys:
        c = old[k].eqNullSafe(nk[f"_k_{k}"])
        cond = c if cond is None else cond & c
    kept = old.join(nk, cond, "left_anti")
    lacking = [c for c in old.columns if c not in new.columns]
    if lacking:
        was = old.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *lacking)
        match = None
        for k in keys:
            c = new[k].eqNullSafe(was[f"_k_{k}"])
            match = c if match is None else match & c
        new = new.join(was, match, "left").drop(*[f"_k_{k}" for k in keys])
    return kept.unionByName(new, allowMissingColumns=True)
