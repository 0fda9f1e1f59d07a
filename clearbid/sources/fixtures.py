"""Ad tables derived from the driver test data (``events``, ``nation``, ``region``).

The driver data holds no ad tables, so auctions, impressions, bids, clicks,
actions and auction defaults are derived from ``events`` with fixed rules.
The same rules are written as DuckDB SQL in ``clearbid.oracle`` so both
engines see identical rows.  Everything is a narrow projection of ``events``
(row fan-out by ``explode`` of a short literal array, never a cross join); the
only join is to the 25-row ``nation`` dimension and its ``region``.

Each derived frame keeps the helper columns ``eid`` (= event_id) and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _tag(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _secs(n: int) -> Column:
    return F.expr(f"INTERVAL {n} SECONDS")


def derive_auctions(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    slots = F.when(eid % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    base = (events.filter(F.col("event_type").isin("view", "error"))
            .select("event_id", "ts", "user_id", "event_type", F.explode(slots).alias("slot")))
    base = base.join(geo, (uid % 25) == geo.n_nationkey)
    kw = (F.when(eid % 9 == 0, F.lit(None).cast("string"))
          .when(eid % 9 == 1, F.lit(""))
          .otherwise(F.concat(_tag("k", eid % 3), F.lit(","), _tag("k", 3 + eid % 5))))
    return base.select(
        F.col("ts").alias("tstamp"),
        _tag("a", eid).alias("auctionId"),
        _tag("i", eid * 10 + F.col("slot")).alias("impid"),
        _tag("u", uid).alias("uuid"),
        F.when(F.col("event_type") == "view", F.lit("info")).otherwise(F.lit("error")).alias("level"),
        _tag("pub", uid % 3).alias("publisher"),
        _tag("site", uid % 6).alias("site"),
        _tag("page", eid % 4).alias("page"),
        _tag("pl", F.col("slot")).alias("placement"),
        _tag("pc", uid % 3).alias("pub_clique"),
        F.when(uid % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country"),
        F.col("r_name").alias("region"),
        _tag("city", uid % 7).alias("city"),
        (F.lit(500) + uid % 50).cast("bigint").alias("metro"),
        _tag("z", uid % 40).alias("zip"),
        kw.alias("keywords"),
        eid.alias("eid"),
        F.col("slot"),
    )


def derive_impressions(auctions: DataFrame) -> DataFrame:
    eid = F.col("eid")
    return auctions.filter(F.col("level") == "info").select(
        (F.col("tstamp") + _secs(2)).alias("tstamp"),
        "auctionId", "impid", "uuid",
        _tag("adv", eid % 4).alias("advertiser"),
        _tag("cmp", eid % 8).alias("campaign"),
        _tag("cg", eid % 3).alias("creativegroup"),
        _tag("cr", F.col("slot")).alias("creative"),
        _tag("ac", eid % 2).alias("adv_clique"),
        "eid", "slot",
    )


def derive_bids(auctions: DataFrame) -> DataFrame:
    eid = F.col("eid")
    k = F.col("k")
    base = (auctions.filter(F.col("level") == "info")
            .select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), 1 + eid % 5)).alias("k")))
    clique = (eid + F.when(k == 5, F.lit(1)).otherwise(F.lit(0))) % 2
    price = (F.lit(1) + (eid * 7 + (k % 3) * 3) % 20).cast("double") * F.lit(0.25).cast("double")
    return base.select(
        (F.col("tstamp") + _secs(1)).alias("tstamp"),
        F.concat(F.col("impid"), F.lit("b"), k.cast("string")).alias("bidid"),
        "auctionId", "impid",
        _tag("ac", clique).alias("adv_clique"),
        price.alias("bid"),
        "eid", "slot",
    )


def derive_clicks(impressions: DataFrame) -> DataFrame:
    eid = F.col("eid")
    every = F.filter(F.array(F.lit(5), F.lit(25)), lambda c: eid % c == 0)
    base = impressions.filter(F.col("slot") == 0).select("*", F.explode(every).alias("c"))
    return base.select(
        (F.col("tstamp") + _secs(60)).alias("tstamp"),
        F.concat(F.col("impid"), F.lit("c"), F.col("c").cast("string")).alias("clickid"),
        "impid", "uuid", "advertiser", "campaign", "creativegroup", "creative",
        "eid", "slot",
    )


def derive_actions(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return events.filter(F.col("event_type").isin("purchase", "signup")).select(
        F.col("ts").alias("tstamp"),
        _tag("x", eid).alias("actionid"),
        _tag("u", F.col("user_id")).alias("uuid"),
        _tag("adv", eid % 4).alias("advertiser"),
        F.col("event_type").alias("actionbeacon"),
        "value",
        eid.alias("eid"),
    )


def derive_auction_defaults(auctions: DataFrame) -> DataFrame:
    return auctions.filter(F.col("level") == "error").select("tstamp", "auctionId").distinct()


def ad_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six ad tables for the driver data in ``sf_dir``."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    events = read("events")
    auctions = derive_auctions(events, read("nation"), read("region"))
    impressions = derive_impressions(auctions)
    return {
        "auctions": auctions,
        "impressions": impressions,
        "bids": derive_bids(auctions),
        "clicks": derive_clicks(impressions),
        "actions": derive_actions(events),
        "auction_defaults": derive_auction_defaults(auctions),
    }


def write_ad_tables(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Materialize the derived ad tables as Parquet, partitioned by event date.

    The bench and the hourly job read these like production tables, so the
    scans see date partitions and pushed time filters.
    """
    paths = {}
    for name, df in ad_tables(spark, sf_dir).items():
        path = f"{root}/{name}"
        (df.withColumn("date", F.to_date("tstamp"))
           .hint("rebalance", "date")
           .write.mode("overwrite").partitionBy("date").parquet(path))
        paths[name] = path
    return paths
