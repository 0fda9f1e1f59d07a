"""Multi-operator jobs: the hourly run, hourly/daily backfill.

``intermediates`` and ``grain_frames`` wire every operator of one interval
run (or of a whole span, one label per hour) into DataFrames;
``plans.hourly.run`` writes them, sharing one imps/clicks join across the
three grains.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame

from clearbid.functions import Interval
from clearbid.operators import attribution as attr
from clearbid.operators import auctions as auc
from clearbid.operators import rollups as ru
from clearbid.operators.daily import daily_ad_stats

DEFAULT_LOOKBACK_DAYS = 30


@dataclass
class AdTables:
    auctions: DataFrame
    impressions: DataFrame
    bids: DataFrame
    clicks: DataFrame
    actions: DataFrame
    auction_defaults: DataFrame

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> "AdTables":
        return cls(**{k: tables[k] for k in cls.__dataclass_fields__})


@dataclass
class Intermediates:
    auction_stats: DataFrame
    imp_matched_actions: DataFrame
    click_matched_actions: DataFrame


def intermediates(t: AdTables, interval: Interval | None, per_hour: bool,
                  view_lookback: int = DEFAULT_LOOKBACK_DAYS,
                  click_lookback: int = DEFAULT_LOOKBACK_DAYS) -> Intermediates:
    """auction_stats (priced ∪ errored), view and click matches."""
    if per_hour:
        priced = auc.auction_stats_hourly(t.auctions, t.impressions, t.bids, interval)
        imp_m = attr.imp_matched_actions_hourly(t.impressions, t.actions, t.auctions, view_lookback, interval)
        click_m = attr.click_matched_actions_hourly(t.clicks, t.actions, t.auctions, click_lookback, interval)
    else:
        priced = auc.auction_stats(t.auctions, t.impressions, t.bids, interval)
        imp_m = attr.imp_matched_actions(t.impressions, t.actions, t.auctions, interval, view_lookback)
        click_m = attr.click_matched_actions(t.clicks, t.actions, t.auctions, interval, click_lookback)
    stats = priced.unionByName(auc.auction_stats_defaults(t.auctions, interval))
    return Intermediates(stats, imp_m, click_m)


def grain_frames(t: AdTables, mid: Intermediates, grain: ru.Grain, interval: Interval | None,
                 per_hour: bool, pricing: str = ru.CPM,
                 imps: DataFrame | None = None, convs: DataFrame | None = None, dflts: DataFrame | None = None,
                 view_lookback: int = DEFAULT_LOOKBACK_DAYS,
                 history_hours: int | None = None) -> dict[str, DataFrame]:
    """The three row kinds of one grain; ``imps``, ``convs``, ``dflts`` if that kind is already at hand."""
    if imps is None:
        joined = ru.joined_impressions(t.auctions, t.impressions, mid.auction_stats, t.clicks,
                                       interval, per_hour, history_hours)
        imps = ru.imps_clicks(joined, grain, pricing)
    # matched impressions only ever point at auctions inside the view lookback
    auction_lo = None if interval is None else interval.start - timedelta(days=view_lookback)
    return {
        "imps": imps,
        "convs": convs if convs is not None else ru.conversions(mid.imp_matched_actions, mid.click_matched_actions, grain,
                                                                interval, t.auctions, per_hour, auction_lo),
        "defaults": dflts if dflts is not None else ru.defaults(t.auctions, t.auction_defaults, grain, interval, per_hour,
                                                                history_hours),
    }


def stats_table(t: AdTables, grain: ru.Grain, interval: Interval | None, per_hour: bool,
                pricing: str = ru.CPM, mid: Intermediates | None = None) -> DataFrame:
    """One stats table (imps ∪ conversions ∪ defaults) of a grain."""
    mid = mid or intermediates(t, interval, per_hour)
    f = grain_frames(t, mid, grain, interval, per_hour, pricing)
    return ru.union_kinds(f["imps"], f["convs"], f["defaults"], grain)


def hourly_backfill(t: AdTables, interval: Interval | None = None, pricing: str = ru.CPM,
                    grain: ru.Grain = ru.HOURLY) -> DataFrame:
    """Every hour of ``interval`` (whole table if None) in one job, labelled by hour."""
    return stats_table(t, grain, interval, per_hour=True, pricing=pricing)


def daily_backfill(hourly: DataFrame) -> DataFrame:
    """Every day of an hourly stats table in one job."""
    return daily_ad_stats(hourly)
