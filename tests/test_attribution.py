from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clearbid.functions import Interval
from clearbid.operators.asof import latest_touch_time
from clearbid.operators.attribution import (click_matched_actions, click_matched_actions_hourly,
                                            imp_matched_actions, imp_matched_actions_hourly)
from clearbid.schemas import ACTIONS, AUCTIONS, CLICKS, IMPRESSIONS
from conftest import BASE, at

IV = Interval(BASE, BASE + timedelta(hours=1))


def _imp(impid, minute, uuid="u1", adv="adv1"):
    return (at(minute), impid, uuid, adv, "cmp", "cg", "cr", "ac0")


def _auction(impid, minute=0):
    return (at(minute), "a" + impid, impid, "u1", "info", "pub", "site", "page", "pl0", "pc", "C", "R", "c", 1,
            "z", "k")


def _action(aid, minute, uuid="u1", adv="adv1"):
    return (at(minute), aid, uuid, adv, "purchase", 1.0)


def _run(spark, imps, auctions, actions, lookback=30, interval=IV):
    i = spark.createDataFrame(imps, IMPRESSIONS)
    a = spark.createDataFrame(auctions, AUCTIONS)
    x = spark.createDataFrame(actions, ACTIONS)
    return imp_matched_actions(i, x, a, interval, lookback).collect()


def test_tie_with_one_auction_picks_it(spark):
    rows = _run(spark, [_imp("i2", 8), _imp("i3", 8)], [_auction("i3")], [_action("x1", 10)])
    assert [(r.actionid, r.impid) for r in rows] == [("x1", "i3")]


def test_burst_of_tied_touches_keeps_every_candidate(spark):
    # 2000 touches at one instant, only one with an auction, and older touches
    # with auctions that must not be used as a fall-back
    burst = [_imp(f"b{n:04d}", 8) for n in range(2000)]
    older = [_imp("o1", 5), _imp("o2", 6)]
    rows = _run(spark, burst + older, [_auction("b1234"), _auction("o1"), _auction("o2")],
                [_action("x1", 9), _action("x2", 8), _action("x3", 7)])
    assert sorted((r.actionid, r.impid) for r in rows) == [("x1", "b1234"), ("x2", "b1234"), ("x3", "o2")]


def test_latest_touch_without_auction_drops_action(spark):
    rows = _run(spark, [_imp("i9", 9), _imp("i7", 7)], [_auction("i7")], [_action("x1", 10)])
    assert rows == []


def test_equal_time_matches_and_later_touch_unused(spark):
    rows = _run(spark, [_imp("i10", 10), _imp("i12", 12)], [_auction("i10"), _auction("i12")],
                [_action("x1", 10)])
    assert [(r.impid, r.imp_tstamp) for r in rows] == [("i10", at(10))]


def test_outside_lookback_no_match(spark):
    # lookback measured from the interval end: touches before end - 1 day are invisible
    old = (BASE - timedelta(days=2), "i1", "u1", "adv1", "cmp", "cg", "cr", "ac0")
    rows = _run(spark, [old], [_auction("i1", -3 * 24 * 60)], [_action("x1", 10)], lookback=1)
    assert rows == []


def test_duplicate_actionids_collapse_to_one_row(spark):
    rows = _run(spark, [_imp("i1", 1), _imp("i2", 2)], [_auction("i1"), _auction("i2")],
                [_action("x1", 10), _action("x1", 20)])
    assert len(rows) == 1 and rows[0].action_tstamp == at(10) and rows[0].impid == "i2"


def test_carry_in_from_earlier_hours(spark):
    # touch three hours before the action
    touches = spark.createDataFrame([("u1", "adv1", BASE - timedelta(hours=3))], "uuid string, advertiser string, tstamp timestamp_ntz")
    acts = spark.createDataFrame([("x1", "u1", "adv1", BASE + timedelta(minutes=5)),
                                  ("x2", "u2", "adv1", BASE + timedelta(minutes=5))],
                                 "actionid string, uuid string, advertiser string, tstamp timestamp_ntz")
    got = {r.actionid: r.touch_tstamp for r in latest_touch_time(acts, touches, ["uuid", "advertiser"]).collect()}
    assert got == {"x1": BASE - timedelta(hours=3), "x2": None}


def test_asof_matches_brute_force_on_hot_key(spark):
    import random
    rnd = random.Random(7)
    start = datetime(2024, 1, 1)
    touch = [("hot", "adv", start + timedelta(minutes=rnd.randrange(0, 60 * 48))) for _ in range(400)]
    touch += [(f"u{n}", "adv", start + timedelta(minutes=rnd.randrange(0, 60 * 48))) for n in range(50)]
    acts = [(f"x{n}", "hot" if n % 2 else f"u{n % 50}", "adv", start + timedelta(minutes=rnd.randrange(0, 60 * 48)))
            for n in range(300)]
    t = spark.createDataFrame(touch, "uuid string, advertiser string, tstamp timestamp_ntz")
    a = spark.createDataFrame(acts, "actionid string, uuid string, advertiser string, tstamp timestamp_ntz")
    got = {r.actionid: r.touch_tstamp for r in latest_touch_time(a, t, ["uuid", "advertiser"]).collect()}
    for aid, uuid, adv, ts in acts:
        prior = [tt for (u, ad, tt) in touch if u == uuid and ad == adv and tt <= ts]
        assert got[aid] == (max(prior) if prior else None)


def test_heavy_keys_are_cut_in_time(spark, monkeypatch):
    """A key far above the others: its rows, a burst inside one hour among them, are dealt over cells."""
    import random

    from clearbid.operators import asof
    rnd = random.Random(11)
    start = datetime(2024, 1, 1)
    when = lambda n: start + timedelta(microseconds=rnd.randrange(0, 3_600_000_000 * n))
    touch = [("", "adv", when(1)) for _ in range(600)] + [("", "adv", start + timedelta(hours=40))] * 300
    touch += [(f"u{n % 40}", "adv", when(48)) for n in range(200)] + [(None, "adv", when(48))] * 50
    acts = [(f"x{n}", "" if n % 2 else f"u{n % 50}", "adv", when(1) if n % 4 == 1 else when(48)) for n in range(400)]
    acts += [("null", None, "adv", when(48)), ("notime", "u1", "adv", None), ("tie", "", "adv", start + timedelta(hours=40))]
    t = spark.createDataFrame(touch, "uuid string, advertiser string, tstamp timestamp_ntz")
    a = spark.createDataFrame(acts, "actionid string, uuid string, advertiser string, tstamp timestamp_ntz")
    keys = ["uuid", "advertiser"]
    counts = asof.count_keys(a.filter("uuid IS NOT NULL"), t.filter("uuid IS NOT NULL"), keys, 100)
    assert len(counts.heavy) == 1
    rows = a.union(t.select(F.lit("t"), "*")).filter("uuid = ''").select(F.xxhash64(*keys).alias("h"), "tstamp")
    edges = asof.cell_edges(rows, counts.heavy, counts.limit).first().edges
    assert len(edges) >= 8 and sum(e < start + timedelta(hours=1) for e in edges) >= 5
    for cell_rows in (100, 37, 10**6):
        got = {r.actionid: r.touch_tstamp for r in latest_touch_time(a, t, keys, cell_rows=cell_rows).collect()}
        for aid, uuid, _, ts in acts:
            prior = [tt for (u, _, tt) in touch if u == uuid and uuid is not None and ts is not None and tt <= ts]
            assert got[aid] == (max(prior) if prior else None)


def test_attribution_of_heavy_keys_equals_the_one_pass_form(spark, monkeypatch):
    """Interval and per-hour forms with some keys cut in cells, and with all of them."""
    from clearbid.operators import asof
    from clearbid.sources.fixtures import ad_tables
    t = ad_tables(spark, "/root/testdata/sf0.001")
    span = Interval(datetime(2024, 1, 3), datetime(2024, 1, 20))
    forms = [lambda: imp_matched_actions(t["impressions"], t["actions"], t["auctions"], span, 7),
             lambda: click_matched_actions_hourly(t["clicks"], t["actions"], t["auctions"], 7, span),
             lambda: imp_matched_actions_hourly(t["impressions"], t["actions"], t["auctions"], 2, span)]
    want = [sorted(f().collect()) for f in forms]
    assert all(len(w) > 10 for w in want)
    monkeypatch.setattr(asof, "PARTS", 1000)
    for cell_rows in (5, 1):
        monkeypatch.setattr(asof, "CELL_ROWS", cell_rows)
        assert [sorted(f().collect()) for f in forms] == want


def test_many_actions_keep_touches_unfiltered(spark, monkeypatch):
    from clearbid.operators import asof
    monkeypatch.setattr(asof, "SMALL_ACTIONS", 0)
    rows = _run(spark, [_imp("i2", 8), _imp("i3", 8), _imp("i4", 9, "u2")], [_auction("i3"), _auction("i4")], [_action("x1", 10), _action("x2", 9, "u2")])
    assert sorted((r.actionid, r.impid) for r in rows) == [("x1", "i3"), ("x2", "i4")]


def test_touches_are_bounded_by_the_intervals_end(spark):
    i = spark.createDataFrame([_imp("i1", 5)], IMPRESSIONS)
    from clearbid.sources.tables import bounded
    assert bounded(i, "tstamp", BASE, IV.end).count() == 1
    rows = _run(spark, [_imp("i1", 5), _imp("late", 61)], [_auction("i1"), _auction("late")], [_action("x1", 59)])
    assert [(r.actionid, r.impid) for r in rows] == [("x1", "i1")]


def test_click_attribution_uses_start_for_auctions(spark):
    # auction between start - 1 day and end - 1 day: seen by click attribution
    # (auction lookback from the start) but not by view attribution (from the end)
    auction_t = BASE - timedelta(days=1) + timedelta(minutes=30)
    auction = (auction_t,) + _auction("i1")[1:]
    clicks = spark.createDataFrame([(at(5), "c1", "i1", "u1", "adv1", "cmp", "cg", "cr")], CLICKS)
    a = spark.createDataFrame([auction], AUCTIONS)
    x = spark.createDataFrame([_action("x1", 10)], ACTIONS)
    rows = click_matched_actions(clicks, x, a, IV, 1).collect()
    assert [(r.actionid, r.clickid) for r in rows] == [("x1", "c1")]
    assert _run(spark, [_imp("i1", 5)], [auction], [_action("x1", 10)], lookback=1) == []


def test_hourly_equals_loop_of_hours(spark):
    from clearbid.sources.fixtures import ad_tables
    t = ad_tables(spark, "/root/testdata/sf0.001")
    day = datetime(2024, 1, 9)
    hours = [day + timedelta(hours=h) for h in range(0, 24)]
    span = Interval(day, day + timedelta(days=1))
    loop_imp, loop_clk = [], []
    for h in hours:
        iv = Interval(h, h + timedelta(hours=1))
        loop_imp += imp_matched_actions(t["impressions"], t["actions"], t["auctions"], iv, 7).collect()
        loop_clk += click_matched_actions(t["clicks"], t["actions"], t["auctions"], iv, 7).collect()
    one_imp = imp_matched_actions_hourly(t["impressions"], t["actions"], t["auctions"], 7, span).collect()
    one_clk = click_matched_actions_hourly(t["clicks"], t["actions"], t["auctions"], 7, span).collect()
    assert sorted(loop_imp) == sorted(one_imp) and len(one_imp) > 0
    assert sorted(loop_clk) == sorted(one_clk)


def test_tied_touches_meet_actions_as_one_state(spark):
    # 1,000 touches and 999 actions at one instant: the match works on one state per time
    imps = [_imp(f"t{n:04d}", 8) for n in range(1000)]
    acts = [_action(f"x{n:04d}", 9) for n in range(999)]
    i, a, x = (spark.createDataFrame(imps, IMPRESSIONS), spark.createDataFrame([_auction("t0007"), _auction("t0500")], AUCTIONS),
               spark.createDataFrame(acts, ACTIONS))
    df = imp_matched_actions(i, x, a, IV, 30)
    assert {r.impid for r in df.collect()} == {"t0007"} and df.count() == 999
    # tied touches and actions meet in a window: the only joins are the semi-join by user and the one with auctions
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 2 and sum("Join LeftSemi, (((uuid" in j or "Join LeftSemi, ((uuid" in j for j in joins) == 1
    assert not any("imp_tstamp" in j for j in joins)


def test_per_hour_click_auction_between_the_two_bounds(spark):
    # clicks look back from the hour's end, auctions from its start: an auction in between counts only there
    clicks = [(at(70), "k1", "i1", "u1", "adv1", "cmp", "cg", "cr")]
    day = 24 * 60
    c = spark.createDataFrame(clicks, CLICKS)
    x = spark.createDataFrame([_action("x1", day + 10)], ACTIONS)   # hour [24 h, 25 h): clicks from 1 h, auctions from 0 h
    for minute, found in ((30, 1), (-30, 0)):
        a = spark.createDataFrame([_auction("i1", minute)], AUCTIONS)
        assert click_matched_actions_hourly(c, x, a, 1).count() == found
