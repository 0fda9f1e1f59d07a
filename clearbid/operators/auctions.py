"""Second-price auction statistics (clearing price, bid density).

Semantics kept from the reference queries:

* bids compete per (auctionId, impid, adv_clique); only bids of the
  impression's adv_clique join an auction slot;
* every bid equal to the group maximum is a winner, so the clearing price is
  the best *strictly lower* bid plus 0.01, or the maximum itself when no lower
  bid exists ({3, 3} -> 3.0, {4, 4, 2.5} -> 2.51, {5, NULL} -> 5.0);
* output is one row per (tstamp, auctionId, uuid, impid) of ``level='info'``
  auctions in the interval; bids and impressions are read one hour wider on
  both sides.

Plan shape (scale): bids are first reduced to distinct prices per group
(a partial aggregation map-side, so a slot with a huge number of bids ships
one row per price, never every bid), then hash-partitioned by ``impid``.
Every later step keys on a superset of impid - the window for the group
maximum (over distinct prices, not bids), the one-row-per-group statistics
(num_bids, max_bid, second), the join with auctions ⋈ impressions (also
partitioned by impid) and the final per-slot aggregation - so none of them
shuffles again.  A group's distinct prices are bounded by the price grid
(cents), not by its bid count.  Bid IDs are assumed unique (the winner mark
in the reference joins on bidid alone).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearbid.functions import Interval, hour_floor
from clearbid.session import written
from clearbid.sources.tables import bounded

GROUP = ["auctionId", "impid", "adv_clique"]
OUT_KEYS = ["tstamp", "auctionId", "uuid", "impid"]
HOT_ROWS = 500_000   # bids of a group that one task takes without a thought
PARTS = 2_000        # a group below 1/PARTS of the bids is never hot


def bid_group_stats(bids: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """One row per bid group: num_bids, max_bid and the best bid below the max.

    ``bids`` needs ``bidid``, ``bid`` and the group columns (plus
    ``extra_keys``).  NULL bids count in ``num_bids`` but never price.
    """
    keys = GROUP + list(extra_keys or [])
    # distinct prices first (partially aggregated map-side, so a slot with a
    # huge number of bids sends one row per price, never every bid), then one
    # hash partitioning by impid that every later step and the joins reuse
    per_price = (bids.groupBy(*keys, "bid").agg(F.count("bidid").alias("n"))
                 .repartition("impid"))
    top = per_price.withColumn("group_max", F.max("bid").over(Window.partitionBy(*keys)))
    return top.groupBy(*keys).agg(
        F.sum("n").alias("num_bids"),
        F.max("bid").alias("max_bid"),
        F.max(F.when(F.col("bid") < F.col("group_max"), F.col("bid"))).alias("second_bid"),
    )


def _finish(joined: DataFrame) -> DataFrame:
    out = joined.groupBy(*OUT_KEYS).agg(
        F.sum("num_bids").alias("num_bids"),
        F.max("max_bid").alias("max_bid"),
        F.max(F.col("second_bid") + F.lit(0.01)).alias("second_price"),
    )
    return out.select(
        *OUT_KEYS,
        F.col("num_bids").cast("bigint").alias("num_bids"),
        "max_bid",
        F.coalesce("second_price", "max_bid").alias("clearprice"),
    )


def auction_stats(auctions: DataFrame, impressions: DataFrame, bids: DataFrame,
                  interval: Interval, widen_hours: int = 1) -> DataFrame:
    """Clearing price and bid count per priced auction slot in ``interval``."""
    wide = interval.widened(widen_hours)
    a = (bounded(auctions, "tstamp", interval.start, interval.end)
         .filter(F.col("level") == "info").select(*OUT_KEYS))
    i = bounded(impressions, "tstamp", wide.start, wide.end).select("impid", "adv_clique")
    b = bounded(bids, "tstamp", wide.start, wide.end).select("bidid", *GROUP, "bid")
    stats = bid_group_stats(b)
    return _finish(a.join(i, "impid").join(stats, GROUP))


def auction_stats_hourly(auctions: DataFrame, impressions: DataFrame, bids: DataFrame,
                         interval: Interval | None = None, widen_hours: int = 1) -> DataFrame:
    """``auction_stats`` for every hour at once, as if run once per hour.

    Each auction slot sees the bids and impressions of
    [hour - widen, hour + 1h + widen) around its own hour.  Bids are bucketed
    by their own hour and joined to the slots that can see that hour before the
    group maximum is taken: no copies of a bid, bids of unpriced slots vanish
    early, no per-hour job loop.
    """
    w = widen_hours
    a = auctions.filter(F.col("level") == "info")
    i = impressions
    b = bids
    if interval is not None:
        a = bounded(a, "tstamp", interval.start, interval.end)
        wide = interval.widened(w)
        i = bounded(i, "tstamp", wide.start, wide.end)
        b = bounded(b, "tstamp", wide.start, wide.end)
    a = a.select(*OUT_KEYS, hour_floor("tstamp").alias("auction_hour"))
    i = i.select("impid", "adv_clique", F.col("tstamp").alias("imp_tstamp"))
    # distinct prices per hour of bids, partially aggregated map-side; then partitioned like the slots
    prices = (b.select("bidid", *GROUP, "bid", hour_floor("tstamp").alias("bid_hour"))
              .groupBy(*GROUP, "bid_hour", "bid").agg(F.count("bidid").alias("n"))
              .repartition("impid"))
    hours = lambda k: F.expr(f"INTERVAL {k} HOURS")
    slots = a.join(i, "impid").filter((F.col("imp_tstamp") >= F.col("auction_hour") - hours(w))
                                      & (F.col("imp_tstamp") < F.col("auction_hour") + hours(1 + w)))
    # bids in hours auction_hour - w .. auction_hour + w
    seen = slots.join(prices, GROUP).filter((F.col("bid_hour") >= F.col("auction_hour") - hours(w))
                                            & (F.col("bid_hour") <= F.col("auction_hour") + hours(w)))
    top = seen.withColumn("group_max", F.max("bid").over(Window.partitionBy(*GROUP, "auction_hour")))
    return _finish(top.select(*OUT_KEYS, F.col("n").alias("num_bids"), F.col("bid").alias("max_bid"),
                              F.when(F.col("bid") < F.col("group_max"), F.col("bid")).alias("second_bid")))


def auction_stats_defaults(auctions: DataFrame, interval: Interval | None) -> DataFrame:
    """Zero-bid rows for errored auctions (no bids, price 0.0)."""
    a = auctions.filter(F.col("level") == "error")
    if interval is not None:
        a = bounded(a, "tstamp", interval.start, interval.end)
    return a.select(*OUT_KEYS).dropDuplicates(OUT_KEYS).select(
        *OUT_KEYS,
        F.lit(0).cast("bigint").alias("num_bids"),
        F.lit(0.0).cast("double").alias("max_bid"),
        F.lit(0.0).cast("double").alias("clearprice"),
    )


def losing_bids(bids: DataFrame, interval: Interval | None = None, widen_hours: int = 1,
                hot_rows: int | None = None) -> DataFrame:
    """Bids below their group maximum (the reference's anti-join marker).

    Groups are reduced map-side to their maximum and count and written; one whose prices
    are all equal has no loser and goes there.  The maxima of hot groups, with more than
    ``hot_rows`` bids and a ``PARTS``-th of all that were counted, are broadcast, so their
    bids are not shuffled; at most ``PARTS`` groups are that big.  All other bids meet
    their maximum in one join, whose skewed partitions AQE may split.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    b = bids
    if interval is not None:
        wide = interval.widened(widen_hours)
        b = bounded(b, "tstamp", wide.start, wide.end)
    b = b.select("bidid", *GROUP, "bid", "tstamp")
    tops = written(b.groupBy(*GROUP).agg(F.max("bid").alias("group_max"), F.min("bid").alias("least"), F.count(F.lit(1)).alias("n"))
                   .filter(F.col("least") < F.col("group_max")).drop("least"), "bid-maxima")
    total = tops.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    limit = max(hot_rows, math.ceil(total / PARTS))
    if total <= limit or tops.filter(F.col("n") > limit).isEmpty():
        met = b.join(tops.drop("n"), GROUP)
    else:
        hot = F.broadcast(tops.filter(F.col("n") > limit).drop("n"))   # PARTS rows at most
        light = b.join(hot, GROUP, "left_anti").join(tops.filter(F.col("n") <= limit).drop("n"), GROUP)
        met = light.unionByName(b.join(hot, GROUP))
    return (met.filter(F.col("bid") < F.col("group_max"))
            .select("tstamp", "bidid", *GROUP, "bid", "group_max"))
