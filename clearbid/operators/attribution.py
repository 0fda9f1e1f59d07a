"""Last-touch attribution of conversions to impressions (view) or clicks.

For every action in the interval, the newest touch (impression or click) of
the same (uuid, advertiser) at or before the action time and inside the
lookback is found.  Auctions are then fetched for the touches of the chosen
times alone, and of touches tied at one time the one that wins the tie passes
on to the actions, never each of them; one row per actionid is kept.

Rules kept from the reference queries:

* the newest time is picked whether or not its touches have an auction: if no
  tied touch at that time has one, the action is dropped (no fall-back to an
  older touch);
* touches are looked back from the interval **end**; auctions from the end for
  view attribution but from the **start** for click attribution;
* one row per actionid: ties are broken deterministically by the smallest
  (action time, uuid, advertiser, beacon, value, impid[, clickid], ...) tuple,
  which also collapses duplicate action IDs.

``*_hourly`` variants attribute every hour of a span in one job: each action
uses the bounds of its own hour, exactly as if the job ran once per hour.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbid.functions import Interval, hour_floor
from clearbid.operators.asof import KeyCounts, count_keys, heavy_touch, is_heavy, known
from clearbid.session import written
from clearbid.sources.tables import bounded

KEYS = ["uuid", "advertiser"]
ACTION_COLS = ["actionid", "tstamp", "uuid", "advertiser", "actionbeacon", "value"]
IMP_TOUCH = ["impid", "campaign", "creativegroup", "creative", "adv_clique"]
CLICK_TOUCH = ["impid", "clickid", "campaign", "creativegroup", "creative"]
PUB_COLS = ["publisher", "site", "page", "placement", "pub_clique"]

IMP_OUTPUT = ["imp_tstamp", "action_tstamp", "uuid", "actionid", "impid", "advertiser", "campaign",
              "creativegroup", "creative", "adv_clique", "actionbeacon", "value", "publisher", "site",
              "page", "placement", "pub_clique"]
CLICK_OUTPUT = ["click_tstamp", "action_tstamp", "uuid", "actionid", "impid", "clickid", "advertiser",
                "campaign", "creativegroup", "creative", "actionbeacon", "value", "publisher", "site",
                "page", "placement", "pub_clique"]
# tie-break order inside one actionid (first = most significant)
IMP_ORDER = ["action_tstamp", "uuid", "advertiser", "actionbeacon", "value", "impid", "imp_tstamp",
             "campaign", "creativegroup", "creative", "adv_clique", "publisher", "site", "page",
             "placement", "pub_clique"]
CLICK_ORDER = ["action_tstamp", "uuid", "advertiser", "actionbeacon", "value", "impid", "clickid",
               "click_tstamp", "campaign", "creativegroup", "creative", "publisher", "site", "page",
               "placement", "pub_clique"]


def one_row_per(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Keep, per ``key``, the first row by ``order`` (NULLs first).

    Where rows are shuffled for it, Spark limits each group to one row
    map-side, so a hot key never gathers its rows in one task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


@dataclass(frozen=True)
class Match:
    """What the two forms of the match share; bounds are columns over the action row (or None = unbounded)."""

    touch_cols: list[str]
    touch_time: str
    order: list[str]
    output: list[str]
    touch_bound: Column | None = None
    auction_bound: Column | None = None   # a full hour

    @property
    def fields(self) -> list[str]:
        """The part of ``order`` that a touch decides; the other columns are those of the action or the time."""
        return [c for c in self.order if c in self.touch_cols + PUB_COLS]

    def bounds(self) -> list[Column]:
        return [bound.alias(name) for name, bound in (("_touch_lo", self.touch_bound), ("_auction_lo", self.auction_bound)) if bound is not None]

    def in_touch_bound(self) -> Column:
        return F.lit(True) if self.touch_bound is None else F.col(self.touch_time) >= F.col("_touch_lo")


def _attribute(actions: DataFrame, touches: DataFrame, auctions: DataFrame, m: Match) -> DataFrame:
    """Last touch of every action, one row per actionid.

    The rows are counted first.  If the actions are few, touches of users without
    one go by a broadcast semi-join; heavy keys, if any, are matched apart.
    """
    actions = actions.select(*ACTION_COLS, *m.bounds()).filter(known(KEYS))
    touches = touches.select(*KEYS, "tstamp", *m.touch_cols).filter(known(KEYS))
    auctions = auctions.select("impid", F.col("tstamp").alias("_auction"), *PUB_COLS)
    counts = count_keys(actions, touches, KEYS)
    if counts.few_actions:
        touches = touches.join(F.broadcast(actions.select(*KEYS)), KEYS, "left_semi")
    if counts.heavy:
        light = ~is_heavy(KEYS, counts)
        hit = _in_one_pass(actions.filter(light), touches.filter(light), auctions, m).unionByName(
            _of_heavy_keys(actions, touches, auctions, m, counts))
    else:
        hit = _in_one_pass(actions, touches, auctions, m)
    return one_row_per(hit, ["actionid"], [F.col(c) for c in m.order]).select(*m.output)


def _in_one_pass(actions: DataFrame, touches: DataFrame, auctions: DataFrame, m: Match) -> DataFrame:
    """The match of keys that one task can take.

    Touches and actions are united and shuffled once by key; a running maximum
    gives every row the time of its newest touch.  Rows whose time no action chose
    go.  The touches that are left are joined to their auctions, and per time the
    first of the tied ones by ``order`` that has an auction passes on to the
    actions by a second window.  Auctions that an action may use are those from
    its own bound on: in descending order of their hour they stand before it.
    So tied touches and actions meet in a window, never as a product.
    """
    is_action, time = F.col("_act").isNotNull(), m.touch_time
    acts = actions.select(*KEYS, "tstamp", *[c for c in actions.columns if c[0] == "_"], F.struct(*ACTION_COLS).alias("_act"))
    held = touches.withColumn(time, F.col("tstamp"))
    newest = F.max(time).over(Window.partitionBy(*KEYS).orderBy("tstamp").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    told = held.unionByName(acts, allowMissingColumns=True).withColumn(time, newest).filter(F.col(time).isNotNull() & (~is_action | m.in_touch_bound()))
    asked = F.max(is_action).over(Window.partitionBy(*KEYS, time))
    told = told.withColumn("_asked", asked).filter(F.col("_asked") & (is_action | F.col("impid").isNotNull())).drop("_asked")

    # actions pass the join by a key of their own, which no auction has and which spreads them
    rows = told.withColumn("_touch", ~is_action).withColumn("_slot", F.when(is_action, F.col("_act.actionid")).otherwise(F.col("impid")))
    au = auctions.withColumnRenamed("impid", "_slot").withColumn("_touch", F.lit(True))
    seen = rows.join(au, ["_touch", "_slot"], "left").filter(~F.col("_touch") | F.col("_auction").isNotNull())
    hour = F.lit(0) if m.auction_bound is None else F.when(F.col("_touch"), hour_floor("_auction")).otherwise(F.col("_auction_lo"))
    earlier = Window.partitionBy(*KEYS, time).orderBy(hour.desc(), F.col("_touch").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    choice = F.min(F.when(F.col("_touch"), F.struct(*m.fields))).over(earlier)
    hit = seen.select(time, "_act", "_touch", choice.alias("_choice")).filter(~F.col("_touch") & F.col("_choice").isNotNull())
    return hit.select(time, F.col("_act.*"), "_choice.*").withColumnRenamed("tstamp", "action_tstamp").select(*m.output)


def _of_heavy_keys(actions: DataFrame, touches: DataFrame, auctions: DataFrame, m: Match, counts: KeyCounts) -> DataFrame:
    """The match of keys that no single task should take.

    Times are matched on narrow rows cut into cells and written.  The touches of
    the chosen times are fetched by a semi-join, reduced to one per time (and
    hour of auctions), and joined to the actions that chose the time.
    """
    time = m.touch_time
    chosen = heavy_touch(actions, touches, KEYS, counts, time).filter(F.col(time).isNotNull() & m.in_touch_bound())
    chosen = written(chosen.withColumnRenamed("tstamp", "action_tstamp"), "last-touch")
    at = touches.filter(is_heavy(KEYS, counts)).withColumnRenamed("tstamp", time)
    found = at.join(chosen.select(*KEYS, time), [*KEYS, time], "left_semi")
    seen, per = found.join(auctions, "impid").filter(F.col("_auction").isNotNull()), [*KEYS, time]
    if m.auction_bound is not None:
        seen, per = seen.withColumn("_hour", hour_floor("_auction")), [*per, "_hour"]
    best = one_row_per(seen, per, [F.col(c) for c in m.fields]).select(*per, *m.fields)
    hit = chosen.join(best, [*KEYS, time])
    if m.auction_bound is not None:
        hit = hit.filter(F.col("_hour") >= F.col("_auction_lo"))
    return hit.select(*m.output)


def imp_matched_actions(impressions: DataFrame, actions: DataFrame, auctions: DataFrame,
                        interval: Interval, lookback_days: int) -> DataFrame:
    """View attribution for actions in ``interval`` (lookback from the end)."""
    lo = interval.lookback_from_end(lookback_days)
    return _attribute(
        bounded(actions, "tstamp", interval.start, interval.end),
        bounded(impressions, "tstamp", lo, interval.end),   # a later touch precedes no action
        bounded(auctions, "tstamp", lo),
        Match(IMP_TOUCH, "imp_tstamp", IMP_ORDER, IMP_OUTPUT))


def click_matched_actions(clicks: DataFrame, actions: DataFrame, auctions: DataFrame,
                          interval: Interval, lookback_days: int) -> DataFrame:
    """Click attribution (touch lookback from the end, auctions from the start)."""
    lo_touch = interval.lookback_from_end(lookback_days)
    lo_auction = interval.lookback_from_start(lookback_days)
    return _attribute(
        bounded(actions, "tstamp", interval.start, interval.end),
        bounded(clicks, "tstamp", lo_touch, interval.end),
        bounded(auctions, "tstamp", lo_auction),
        Match(CLICK_TOUCH, "click_tstamp", CLICK_ORDER, CLICK_OUTPUT))


def _hour_bounds(lookback_days: int) -> tuple[Column, Column, Column]:
    hour = hour_floor("tstamp")
    end = hour + F.expr("INTERVAL 1 HOURS")
    back = F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    return hour, end - back, hour - back


def _span(actions: DataFrame, touches: DataFrame, auctions: DataFrame,
          interval: Interval | None, lookback_days: int):
    """Bound a whole-span run: actions to the span, touches and auctions from
    the earliest lookback any hour of the span can reach, touches up to its end."""
    if interval is None:
        return actions, touches, auctions
    lo = interval.start - timedelta(days=lookback_days)
    return (bounded(actions, "tstamp", interval.start, interval.end),
            bounded(touches, "tstamp", lo, interval.end), bounded(auctions, "tstamp", lo))


def imp_matched_actions_hourly(impressions: DataFrame, actions: DataFrame, auctions: DataFrame,
                               lookback_days: int, interval: Interval | None = None) -> DataFrame:
    """View attribution of every hour in ``interval`` (whole table if None)."""
    _, lo_end, _ = _hour_bounds(lookback_days)
    acts, imps, aucs = _span(actions, impressions, auctions, interval, lookback_days)
    return _attribute(acts, imps, aucs, Match(IMP_TOUCH, "imp_tstamp", IMP_ORDER, IMP_OUTPUT, lo_end, lo_end))


def click_matched_actions_hourly(clicks: DataFrame, actions: DataFrame, auctions: DataFrame,
                                 lookback_days: int, interval: Interval | None = None) -> DataFrame:
    """Click attribution of every hour in ``interval`` (whole table if None)."""
    _, lo_end, lo_start = _hour_bounds(lookback_days)
    acts, clk, aucs = _span(actions, clicks, auctions, interval, lookback_days)
    return _attribute(acts, clk, aucs, Match(CLICK_TOUCH, "click_tstamp", CLICK_ORDER, CLICK_OUTPUT, lo_end, lo_start))
