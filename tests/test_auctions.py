from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clearbid.functions import Interval
from clearbid.operators.auctions import (auction_stats, auction_stats_defaults, auction_stats_hourly,
                                         losing_bids)
from clearbid.schemas import AUCTIONS, BIDS, IMPRESSIONS
from conftest import at

IV = Interval(datetime(2024, 1, 10, 12), datetime(2024, 1, 10, 13))


def _auction_row(aid, impid, level="info", minute=10):
    return (at(minute), aid, impid, "u1", level, "p", "s", "pg", "pl0", "pc", "C", "R", "c", 1, "z", "k")


def _frames(spark, groups):
    """groups: list of bid lists, one auction slot each; all bids in clique ac0."""
    auctions, imps, bids = [], [], []
    for n, prices in enumerate(groups):
        aid, impid = f"a{n}", f"i{n}"
        auctions.append(_auction_row(aid, impid))
        imps.append((at(10), impid, "u1", "adv", "cmp", "cg", "cr", "ac0"))
        for k, p in enumerate(prices):
            bids.append((at(10), f"{impid}b{k}", aid, impid, "ac0", p))
    return (spark.createDataFrame(auctions, AUCTIONS), spark.createDataFrame(imps, IMPRESSIONS),
            spark.createDataFrame(bids, BIDS))


def test_second_price_cases(spark):
    groups = [[1.0], [2.0, 1.5], [3.0, 3.0], [4.0, 4.0, 2.5], [5.0, None]]
    a, i, b = _frames(spark, groups)
    got = {r.auctionId: (r.num_bids, r.max_bid, round(r.clearprice, 6))
           for r in auction_stats(a, i, b, IV).collect()}
    assert got == {"a0": (1, 1.0, 1.0), "a1": (2, 2.0, 1.51), "a2": (2, 3.0, 3.0),
                   "a3": (3, 4.0, 2.51), "a4": (2, 5.0, 5.0)}


def test_hourly_form_equals_interval_form(spark):
    groups = [[1.0], [2.0, 1.5], [3.0, 3.0], [4.0, 4.0, 2.5], [5.0, None]]
    a, i, b = _frames(spark, groups)
    one = sorted(auction_stats(a, i, b, IV).collect())
    per_hour = sorted(auction_stats_hourly(a, i, b).collect())
    assert one == per_hour


def test_other_clique_and_outside_window_ignored(spark):
    a, i, b = _frames(spark, [[2.0]])
    extra = spark.createDataFrame([
        (at(10), "i0bx", "a0", "i0", "ac1", 9.0),                 # other clique
        (datetime(2024, 1, 10, 10, 30), "i0by", "a0", "i0", "ac0", 8.0),  # before wideStart
        (datetime(2024, 1, 10, 13, 30), "i0bz", "a0", "i0", "ac0", 1.0),  # inside wideEnd
    ], BIDS)
    r = auction_stats(a, i, b.unionByName(extra), IV).collect()[0]
    assert (r.num_bids, r.max_bid, round(r.clearprice, 6)) == (2, 2.0, 1.01)


def test_error_auctions_give_zero_rows(spark):
    rows = [_auction_row("a9", "i90", level="error"), _auction_row("a9", "i90", level="error")]
    a = spark.createDataFrame(rows, AUCTIONS)
    got = auction_stats_defaults(a, IV).collect()
    assert [(r.impid, r.num_bids, r.max_bid, r.clearprice) for r in got] == [("i90", 0, 0.0, 0.0)]


def test_losers_are_below_group_max(spark):
    a, i, b = _frames(spark, [[4.0, 4.0, 2.5]])
    got = [r.bid for r in losing_bids(b).collect()]
    assert got == [2.5]


def _losers(groups):
    return sorted(p for prices in groups for p in prices if p is not None and p < max(x for x in prices if x is not None))


def test_losers_of_a_hot_group_are_the_same(spark):
    groups = [[float(k % 7) for k in range(60)], [1.0, 2.0, None], [3.0, 3.0], [5.0], [None, None], [2.5, 9.0, 9.0, 1.0]]
    bids = _frames(spark, groups)[2]
    plain = losing_bids(bids)
    split = losing_bids(bids, hot_rows=10)
    assert sorted(r.bid for r in plain.collect()) == sorted(r.bid for r in split.collect()) == _losers(groups)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_bids_of_a_hot_group_are_not_shuffled(spark):
    bids = _frames(spark, [[float(k % 7) for k in range(60)], [1.0, 2.0]])[2]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = losing_bids(bids, hot_rows=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the two sides of the light groups' join; hot groups and the anti-join need none
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("BroadcastHashJoin") == 2, plan


def test_losers_without_bids_and_without_groups(spark):
    bids = _frames(spark, [[1.0, 2.0]])[2]
    assert losing_bids(bids.limit(0)).collect() == []
    blank = spark.createDataFrame([(at(10), "b1", None, "i", "c", 1.0), (at(10), "b2", None, "i", "c", 2.0)], BIDS)
    assert losing_bids(blank).collect() == losing_bids(blank, hot_rows=1).collect() == []


def test_invariant_max_bid_vs_clearprice(spark):
    from clearbid.sources.fixtures import ad_tables
    t = ad_tables(spark, "/root/testdata/sf0.001")
    s = auction_stats(t["auctions"], t["impressions"], t["bids"], Interval("2024-01-01 00:00:00",
                                                                           "2024-01-31 00:00:00"))
    bad = s.filter(F.col("max_bid") < F.col("clearprice") - F.lit(0.01) - F.lit(1e-9)).count()
    assert bad == 0 and s.count() == 256


def test_interval_rules():
    assert Interval("2024-01-01 00:00:00", "2024-01-01 00:00:00").days() == []
    with pytest.raises(ValueError):
        Interval("2024-01-02 00:00:00", "2024-01-01 00:00:00")


def test_default_interval_is_last_full_hour():
    iv = Interval.default(datetime(2024, 1, 10, 13, 42, 7))
    assert (iv.start, iv.end) == (datetime(2024, 1, 10, 12), datetime(2024, 1, 10, 13))
    assert Interval("2024-01-10 12:00:00", "2024-01-11 01:00:00").days() == [datetime(2024, 1, 10),
                                                                            datetime(2024, 1, 11)]
