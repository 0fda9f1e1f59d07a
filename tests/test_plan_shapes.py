"""Plan-shape guards for the scale properties the operators rely on.

Shapes are read from the optimized physical plan (AQE re-planning aside):
no collected tie lists in the as-of, bids partially aggregated before their
first exchange, and keep-N retention limited map-side.
"""

from datetime import timedelta

from pyspark.sql import functions as F

from clearbid.operators.attribution import imp_matched_actions
from clearbid.operators.auctions import auction_stats
from clearbid.operators.ranking import keep_newest_per_key
from clearbid.schemas import ACTIONS, AUCTIONS, BIDS, IMPRESSIONS
from clearbid.functions import Interval
from conftest import BASE, at


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_asof_gathers_no_tie_lists(spark):
    imps = spark.createDataFrame([(at(1), "i1", "u1", "adv1", "cmp", "cg", "cr", "ac0")], IMPRESSIONS)
    auctions = spark.createDataFrame(
        [(at(0), "a1", "i1", "u1", "info", "p", "s", "pg", "pl", "pc", "C", "R", "c", 1, "z", "k")], AUCTIONS)
    actions = spark.createDataFrame([(at(5), "x1", "u1", "adv1", "purchase", 1.0)], ACTIONS)
    df = imp_matched_actions(imps, actions, auctions, Interval(BASE, BASE + timedelta(hours=1)), 30)
    plan = _plan(df)
    assert "collect_list" not in plan and "collect_set" not in plan
    assert df.count() == 1


def test_bids_partially_aggregated_before_exchange(spark):
    auctions = spark.createDataFrame(
        [(at(10), "a1", "i1", "u1", "info", "p", "s", "pg", "pl", "pc", "C", "R", "c", 1, "z", "k")], AUCTIONS)
    imps = spark.createDataFrame([(at(10), "i1", "u1", "adv", "cmp", "cg", "cr", "ac0")], IMPRESSIONS)
    bids = spark.createDataFrame([(at(10), f"b{k}", "a1", "i1", "ac0", 1.0 + k % 3) for k in range(9)], BIDS)
    iv = Interval(BASE + timedelta(minutes=0), BASE + timedelta(hours=1))
    plan = _plan(auction_stats(auctions, imps, bids, iv))
    lines = plan.splitlines()
    # the deepest (first-executed) aggregation over bids is a map-side partial count
    partial = [n for n, line in enumerate(lines) if "partial_count(bidid" in line]
    assert partial, plan
    below = "\n".join(lines[partial[-1]:])
    assert "Exchange" not in below.split("Scan")[0], plan


def test_keep_n_is_limited_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), F.col("id").alias("created"))
    plan = _plan(keep_newest_per_key(df, ["key"], [F.desc("created")], 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan
