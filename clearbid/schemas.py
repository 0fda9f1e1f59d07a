"""Declared schemas of the ad tables and the derived tables.

Tables are read with these schemas checked (``check_columns``) so a missing or
mistyped column fails at plan time, not deep inside a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


AUCTIONS = _struct(
    ("tstamp", TS), ("auctionId", S), ("impid", S), ("uuid", S), ("level", S),
    ("publisher", S), ("site", S), ("page", S), ("placement", S), ("pub_clique", S),
    ("country", S), ("region", S), ("city", S), ("metro", L), ("zip", S), ("keywords", S),
)
IMPRESSIONS = _struct(
    ("tstamp", TS), ("impid", S), ("uuid", S), ("advertiser", S), ("campaign", S),
    ("creativegroup", S), ("creative", S), ("adv_clique", S),
)
BIDS = _struct(
    ("tstamp", TS), ("bidid", S), ("auctionId", S), ("impid", S), ("adv_clique", S), ("bid", D),
)
CLICKS = _struct(
    ("tstamp", TS), ("clickid", S), ("impid", S), ("uuid", S), ("advertiser", S),
    ("campaign", S), ("creativegroup", S), ("creative", S),
)
ACTIONS = _struct(
    ("tstamp", TS), ("actionid", S), ("uuid", S), ("advertiser", S), ("actionbeacon", S), ("value", D),
)
AUCTION_DEFAULTS = _struct(("tstamp", TS), ("auctionId", S))

AUCTION_STATS = _struct(
    ("tstamp", TS), ("auctionId", S), ("uuid", S), ("impid", S),
    ("num_bids", L), ("max_bid", D), ("clearprice", D),
)

IMP_MATCHED_ACTIONS = _struct(
    ("imp_tstamp", TS), ("action_tstamp", TS), ("uuid", S), ("actionid", S), ("impid", S),
    ("advertiser", S), ("campaign", S), ("creativegroup", S), ("creative", S), ("adv_clique", S),
    ("actionbeacon", S), ("value", D), ("publisher", S), ("site", S), ("page", S),
    ("placement", S), ("pub_clique", S),
)
CLICK_MATCHED_ACTIONS = _struct(
    ("click_tstamp", TS), ("action_tstamp", TS), ("uuid", S), ("actionid", S), ("impid", S),
    ("clickid", S), ("advertiser", S), ("campaign", S), ("creativegroup", S), ("creative", S),
    ("actionbeacon", S), ("value", D), ("publisher", S), ("site", S), ("page", S),
    ("placement", S), ("pub_clique", S),
)

# Measures shared by the three hourly stat tables, in output order.
MEASURES = _struct(
    ("clearprice", D), ("bids", L), ("spend", D), ("imps", L), ("uniques", L),
    ("clicks", L), ("view_convs", L), ("click_convs", L), ("defaults", L),
)

DAILY_KEYS = ["date", "advertiser", "campaign", "adv_clique", "publisher", "site", "pub_clique"]
DAILYADSTATS = _struct(
    ("date", TS), ("advertiser", S), ("campaign", S), ("adv_clique", S), ("publisher", S),
    ("site", S), ("pub_clique", S), ("bids", L), ("imps", L), ("defaults", L),
    ("clearprice", D), ("spend", D), ("clicks", L), ("view_convs", L), ("click_convs", L),
)

# mergeable state of the daily rows, per hour
DAILY_PARTIALS = _struct(
    ("hour", TS), ("advertiser", S), ("campaign", S), ("adv_clique", S), ("publisher", S),
    ("site", S), ("pub_clique", S), ("bids", L), ("imps", L), ("defaults", L), ("clicks", L),
    ("view_convs", L), ("click_convs", L), ("spend", D), ("price_sum", D), ("price_n", L),
)

AD_TABLES = {
    "auctions": AUCTIONS,
    "impressions": IMPRESSIONS,
    "bids": BIDS,
    "clicks": CLICKS,
    "actions": ACTIONS,
    "auction_defaults": AUCTION_DEFAULTS,
    "auction_stats": AUCTION_STATS,
    "imp_matched_actions": IMP_MATCHED_ACTIONS,
    "click_matched_actions": CLICK_MATCHED_ACTIONS,
}


def check_columns(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Fail fast if ``df`` lacks a declared column or holds it with another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"{name}: missing column {field.name!r}")
        if have[field.name] != field.dataType:
            raise TypeError(f"{name}.{field.name}: expected {field.dataType.simpleString()}, "
                            f"got {have[field.name].simpleString()}")
    return df
