"""Hourly ad-stat rollups: 3 measure families x 3 grains.

Families (each one reference query per grain):

* ``imps_clicks``  auctions ⋈ impressions ⋈ auction_stats ⟕ clicks, priced CPM
  (``spend = sum(clearprice)/1000``) or CPC (``spend = sum(clearprice)`` over
  clicked rows).  Several clicks on one impression fan out and count the
  impression (and its bids and CPM spend) again, as in the reference.
* ``conversions`` imp_matched_actions ⟕ click_matched_actions on actionid:
  a view conversion when there is no click match or the click is not later
  than the impression, a click conversion otherwise.
* ``defaults``     auctions ⋈ auction_defaults on auctionId.

Grains: ``HOURLY`` (placement/creative dims), ``GEO`` (country,
'country-region', city, DMA, zip; grouped by the projected region label) and
``KEYWORD`` (raw keyword string as the group key, split into an array after
the aggregation, so 'a,b' and 'b,a' stay apart).

``hour`` is the literal interval start for an interval run; with
``per_hour=True`` it is the hour of the event, which is what a loop of
one-hour runs would produce, but computed in one job.

Only ``auctions.tstamp`` (or the action time) is bounded above; impressions,
clicks, stats and defaults have no upper bound, so late clicks still count.
``history_hours`` adds a *lower* bound (interval start minus that many hours)
to those scans so an hourly run does not read the whole history.  It is exact
when impid (and auctionId) identify one auction slot, which the data model
states: a priced slot's impression lies in the one-hour widened window, and
clicks and defaults follow their auction.  ``history_hours=None`` joins them
unbounded.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.functions import Interval, geo_region, hour_floor, split_keywords, ts_lit
from clearbid.sources.tables import bounded

CPM, CPC = "CPM", "CPC"


@dataclass(frozen=True)
class Grain:
    name: str
    imps_dims: tuple[str, ...]
    conv_dims: tuple[str, ...]
    default_dims: tuple[str, ...]
    auction_extra: tuple[str, ...] = ()   # columns conversions fetch from auctions
    keywords: bool = False


_GEO = ("country", "region", "city", "DMA", "zip")

HOURLY = Grain(
    "hourly",
    imps_dims=("publisher", "site", "page", "placement", "advertiser", "campaign", "creativegroup",
               "creative", "pub_clique", "adv_clique"),
    conv_dims=("publisher", "site", "page", "placement", "advertiser", "campaign", "creativegroup",
               "creative", "actionbeacon", "pub_clique", "adv_clique"),
    default_dims=("publisher", "site", "page", "placement", "pub_clique"),
)
GEO = Grain(
    "geo",
    imps_dims=("publisher", "site", "page", "advertiser", "campaign", "pub_clique", "adv_clique") + _GEO,
    conv_dims=("publisher", "site", "page", "advertiser", "campaign", "actionbeacon", "pub_clique",
               "adv_clique") + _GEO,
    default_dims=("publisher", "site", "page", "pub_clique") + _GEO,
    auction_extra=_GEO,
)
KEYWORD = Grain(
    "keyword",
    imps_dims=("publisher", "site", "page", "placement", "keywords", "advertiser", "campaign",
               "creativegroup", "creative", "pub_clique", "adv_clique"),
    conv_dims=("publisher", "site", "page", "placement", "advertiser", "campaign", "creativegroup",
               "creative", "actionbeacon", "pub_clique", "adv_clique", "keywords"),
    default_dims=("publisher", "site", "page", "placement", "pub_clique", "keywords"),
    auction_extra=("keywords",),
    keywords=True,
)
GRAINS = {"hourly": HOURLY, "geo": GEO, "keyword": KEYWORD}


def _auction_dims(auctions: DataFrame) -> list[Column]:
    """Auction-side dims with geo renames applied (metro -> DMA, region label)."""
    return [
        "publisher", "site", "page", "placement", "pub_clique", "country",
        geo_region("country", "region").alias("region"), "city", F.col("metro").alias("DMA"),
        "zip", "keywords",
    ]


def _label(per_hour: bool, interval: Interval | None, ts: str) -> Column:
    if per_hour:
        return hour_floor(ts).alias("hour")
    return ts_lit(interval.start).alias("hour")


def _finish(df: DataFrame, grain: Grain) -> DataFrame:
    if grain.keywords:
        df = df.withColumn("keywords", split_keywords("keywords"))
    return df


def _zero_long(*names: str) -> list[Column]:
    return [F.lit(0).cast("bigint").alias(n) for n in names]


def _history_lo(interval: Interval | None, history_hours: int | None):
    if interval is None or history_hours is None:
        return None
    return interval.start - timedelta(hours=history_hours)


def joined_impressions(auctions: DataFrame, impressions: DataFrame, auction_stats: DataFrame,
                       clicks: DataFrame, interval: Interval | None, per_hour: bool = False,
                       history_hours: int | None = None) -> DataFrame:
    """The shared 4-way join behind every imps/clicks rollup (all grains).

    All joins key on impid (auction_stats also on auctionId), so with
    impid-based co-partitioning every input is shuffled once.  Only auctions
    are bounded by the interval; ``history_hours`` is an opt-in that also drops
    impressions, clicks and stats older than so many hours before it, for
    tables where such rows cannot belong to the interval's auctions.
    """
    lo = _history_lo(interval, history_hours)
    if lo is not None:
        impressions = bounded(impressions, "tstamp", lo)
        clicks = bounded(clicks, "tstamp", lo)
        auction_stats = bounded(auction_stats, "tstamp", lo)
    a = auctions if interval is None else bounded(auctions, "tstamp", interval.start, interval.end)
    a = a.select(_label(per_hour, interval, "tstamp"), "impid", "auctionId", "uuid",
                 *_auction_dims(auctions))
    i = impressions.select("impid", "advertiser", "campaign", "creativegroup", "creative", "adv_clique")
    s = auction_stats.select("impid", "auctionId", "clearprice", "num_bids")
    c = clicks.select("impid", "clickid")
    return a.join(i, "impid").join(s, ["impid", "auctionId"]).join(c, "impid", "left")


def _imps_measures(pricing: str) -> list[Column]:
    clicked = F.when(F.col("clickid").isNull(), F.lit(0)).otherwise(F.lit(1))
    if pricing == CPC:
        spend = F.sum(F.col("clearprice") * clicked)
    else:  # anything but CPC prices per impression, as the reference falls back to CPM
        spend = F.sum("clearprice") / F.lit(1000)
    return [
        F.avg("clearprice").alias("clearprice"),
        F.sum("num_bids").cast("bigint").alias("bids"),
        spend.cast("double").alias("spend"),
        F.count("impid").alias("imps"),
        F.countDistinct("uuid").alias("uniques"),
        F.count("clickid").alias("clicks"),
    ]


def _imps_columns(rows: DataFrame, grain: Grain) -> DataFrame:
    out = rows.select("hour", *grain.imps_dims, "clearprice", "bids", "spend", "imps", "uniques",
                      "clicks", *_zero_long("view_convs", "click_convs"))
    return _finish(out, grain)


def imps_clicks(joined: DataFrame, grain: Grain, pricing: str = CPM) -> DataFrame:
    """Imps/clicks measures of one grain from ``joined_impressions``."""
    return _imps_columns(joined.groupBy("hour", *grain.imps_dims).agg(*_imps_measures(pricing)), grain)


def imps_clicks_sets(joined: DataFrame, grains: tuple[Grain, ...], pricing: str = CPM) -> DataFrame:
    """Imps/clicks measures of several grains in one aggregation over ``joined_impressions``.

    Each row goes into one grouping set per grain; the distinct users of all
    sets are counted by the same two-level aggregation.  ``_set`` is the
    ``grouping_id`` of a row's grain (``grain_set``), since a dimension may be
    NULL in itself.
    """
    dims = _all_dims(grains)
    sets = joined.groupingSets([["hour", *g.imps_dims] for g in grains], "hour", *dims)
    return sets.agg(*_imps_measures(pricing), F.grouping_id().alias("_set"))


def _all_dims(grains: tuple[Grain, ...], dims: str = "imps_dims") -> list[str]:
    return list(dict.fromkeys(d for g in grains for d in getattr(g, dims)))


def grain_set(grain: Grain, grains: tuple[Grain, ...], dims: str = "imps_dims") -> int:
    """``grouping_id`` of a grain among ``grains``: a bit for each dimension that it leaves out."""
    bits = "".join("0" if d in getattr(grain, dims) else "1" for d in _all_dims(grains, dims))
    return int("0" + bits, 2)


def of_set(sets: DataFrame, grain: Grain, grains: tuple[Grain, ...]) -> DataFrame:
    """The rows of one grain of ``imps_clicks_sets``, as ``imps_clicks`` returns them."""
    return _imps_columns(sets.filter(F.col("_set") == grain_set(grain, grains)), grain)


def conversions(imp_matched: DataFrame, click_matched: DataFrame, grain: Grain,
                interval: Interval | None, auctions: DataFrame | None = None,
                per_hour: bool = False, auction_lo=None) -> DataFrame:
    """View/click conversion counts of one grain.

    Dims come from the impression match; click matches without one are not
    counted.  Geo and keyword grains fetch their dims from the auction of the
    matched impression.  ``auction_lo`` lower-bounds that auctions scan (the
    attribution already required the auction to be at or after its own
    lookback bound); None scans all auctions.
    """
    j = joined_conversions(imp_matched, click_matched, (grain,), interval, per_hour)
    if grain.auction_extra:
        j = _with_auction_dims(j, (grain,), auctions, auction_lo)
    return _conv_columns(j.groupBy("hour", *grain.conv_dims).agg(*_conv_measures()), grain)


def joined_conversions(imp_matched: DataFrame, click_matched: DataFrame, grains: tuple[Grain, ...],
                       interval: Interval | None, per_hour: bool = False) -> DataFrame:
    """View matches with ``_view`` and ``_click``, whether each is a view or a click conversion; for all ``grains``."""
    i = imp_matched if interval is None else imp_matched.filter(interval.contains("action_tstamp"))
    own = list(dict.fromkeys(d for g in grains for d in g.conv_dims if d not in g.auction_extra))
    i = i.select(_label(per_hour, interval, "action_tstamp"), "actionid", "imp_tstamp", "impid", *own)
    j = i.join(click_matched.select("actionid", "click_tstamp"), "actionid", "left")
    ct, it = F.col("click_tstamp"), F.col("imp_tstamp")
    view = F.when(ct.isNull() | (ct <= it), F.lit(1)).otherwise(F.lit(0))
    click = F.when(ct.isNotNull() & (ct > it), F.lit(1)).otherwise(F.lit(0))
    return j.select("hour", "impid", *own, view.alias("_view"), click.alias("_click"))


def _with_auction_dims(joined: DataFrame, grains: tuple[Grain, ...], auctions: DataFrame, auction_lo=None) -> DataFrame:
    au = auctions if auction_lo is None else bounded(auctions, "tstamp", auction_lo)
    extra = list(dict.fromkeys(d for g in grains for d in g.auction_extra))
    return joined.join(au.select("impid", *_auction_dims(au)).select("impid", *extra), "impid")


def conversions_sets(joined: DataFrame, grains: tuple[Grain, ...], auctions: DataFrame, auction_lo=None) -> DataFrame:
    """Conversions of several grains that fetch dims from auctions: one join, one aggregation over ``joined_conversions``."""
    rows = _with_auction_dims(joined, grains, auctions, auction_lo)
    dims = _all_dims(grains, "conv_dims")
    sets = rows.groupingSets([["hour", *g.conv_dims] for g in grains], "hour", *dims)
    return sets.agg(*_conv_measures(), F.grouping_id().alias("_set"))


def conversions_of(joined: DataFrame, sets: DataFrame | None, grain: Grain, fetching: tuple[Grain, ...]) -> DataFrame:
    """The rows of one grain as ``conversions`` returns them; ``sets`` holds the grains ``fetching`` from auctions."""
    if grain.auction_extra:
        return _conv_columns(sets.filter(F.col("_set") == grain_set(grain, fetching, "conv_dims")), grain)
    return _conv_columns(joined.groupBy("hour", *grain.conv_dims).agg(*_conv_measures()), grain)


def _conv_measures() -> list[Column]:
    return [F.sum("_view").cast("bigint").alias("view_convs"), F.sum("_click").cast("bigint").alias("click_convs")]


def _conv_columns(rows: DataFrame, grain: Grain) -> DataFrame:
    out = rows.select("hour", *grain.conv_dims, *_zero_long("bids"),
                     F.lit(0.0).cast("double").alias("spend"),
                     *_zero_long("imps", "uniques", "clicks"), "view_convs", "click_convs")
    return _finish(out, grain)


def defaults(auctions: DataFrame, auction_defaults: DataFrame, grain: Grain,
             interval: Interval | None, per_hour: bool = False,
             history_hours: int | None = None) -> DataFrame:
    """Default (no-fill) counts and unique users of one grain."""
    joined = _joined_defaults(auctions, auction_defaults, interval, per_hour, history_hours)
    return _default_columns(joined.groupBy("hour", *grain.default_dims).agg(*_default_measures()), grain)


def defaults_sets(auctions: DataFrame, auction_defaults: DataFrame, grains: tuple[Grain, ...],
                  interval: Interval | None, per_hour: bool = False, history_hours: int | None = None) -> DataFrame:
    """Defaults of several grains: one join and one aggregation, as ``imps_clicks_sets``."""
    joined = _joined_defaults(auctions, auction_defaults, interval, per_hour, history_hours)
    dims = _all_dims(grains, "default_dims")
    sets = joined.groupingSets([["hour", *g.default_dims] for g in grains], "hour", *dims)
    return sets.agg(*_default_measures(), F.grouping_id().alias("_set"))


def defaults_of(sets: DataFrame, grain: Grain, grains: tuple[Grain, ...]) -> DataFrame:
    """The rows of one grain of ``defaults_sets``, as ``defaults`` returns them."""
    return _default_columns(sets.filter(F.col("_set") == grain_set(grain, grains, "default_dims")), grain)


def _joined_defaults(auctions: DataFrame, auction_defaults: DataFrame, interval: Interval | None, per_hour: bool,
                     history_hours: int | None) -> DataFrame:
    lo = _history_lo(interval, history_hours)
    if lo is not None:
        auction_defaults = bounded(auction_defaults, "tstamp", lo)
    a = auctions if interval is None else bounded(auctions, "tstamp", interval.start, interval.end)
    a = a.select(_label(per_hour, interval, "tstamp"), "auctionId", "uuid", *_auction_dims(auctions))
    d = auction_defaults.select(F.col("auctionId"), F.col("auctionId").alias("_default_id"))
    return a.join(d, "auctionId")


def _default_measures() -> list[Column]:
    return [F.count("_default_id").alias("defaults"), F.countDistinct("uuid").alias("uniques")]


def _default_columns(rows: DataFrame, grain: Grain) -> DataFrame:
    out = rows.select("hour", *grain.default_dims, "defaults", "uniques")
    return _finish(out, grain)


# Column order of the stored hourly tables (dims then measures).
def stat_columns(grain: Grain) -> list[str]:
    dims = []
    for d in grain.imps_dims + grain.conv_dims + grain.default_dims:
        if d not in dims:
            dims.append(d)
    return ["hour", *dims, "clearprice", "bids", "spend", "imps", "uniques", "clicks",
            "view_convs", "click_convs", "defaults"]


def union_kinds(imps: DataFrame, convs: DataFrame, dflts: DataFrame, grain: Grain) -> DataFrame:
    """The three row kinds of one stats table in one frame; absent fields are NULL."""
    u = imps.unionByName(convs, allowMissingColumns=True).unionByName(dflts, allowMissingColumns=True)
    return u.select(*stat_columns(grain))
