from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clearbid.functions import Interval
from clearbid.operators.daily import daily_ad_stats
from clearbid.plans import hourly as job
from clearbid.plans import jobs
from clearbid.sources.fixtures import ad_tables

DAY = datetime(2024, 1, 12)


def _rows(df, cols):
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_backfill_job_writes_tables_and_is_idempotent(spark, tmp_root):
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    span = Interval(DAY, DAY + timedelta(hours=6))
    paths = job.backfill(spark, t, tmp_root, span, view_lookback=7, click_lookback=7)
    first = job.read_stats(spark, paths["hourlyadstats"]).drop("kind")
    cols = sorted(first.columns)
    once = _rows(first, cols)
    job.backfill(spark, t, tmp_root, span, view_lookback=7, click_lookback=7)
    again = _rows(job.read_stats(spark, paths["hourlyadstats"]).drop("kind"), cols)
    assert once == again and len(once) > 0

    expect = jobs.stats_table(t, jobs.ru.HOURLY, span, per_hour=True,
                              mid=jobs.intermediates(t, span, True, 7, 7))
    assert once == _rows(expect, cols)

    daily = job.read_daily(spark, paths["dailyadstats"])
    want = daily_ad_stats(expect)
    dcols = sorted(want.columns)
    assert _rows(daily, dcols) == _rows(want, dcols)

    for name in ("geoadstats", "keywordadstats", "auction_stats"):
        assert spark.read.parquet(paths[name]).count() > 0
    from clearbid.schemas import IMP_MATCHED_ACTIONS
    matched = job.read_intermediate(spark, paths["imp_matched_actions"], IMP_MATCHED_ACTIONS)
    assert matched.count() == jobs.intermediates(t, span, True, 7, 7).imp_matched_actions.count()


def test_single_hour_runs_label_with_start(spark, tmp_root):
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    busy = [r.h for r in t.auctions.filter(F.col("level") == "info")
            .select(F.date_trunc("hour", "tstamp").cast("timestamp_ntz").alias("h"))
            .distinct().orderBy("h").limit(2).collect()]
    for h in busy:
        paths = job.run(spark, t, tmp_root, Interval(h, h + timedelta(hours=1)), pricing="bogus",
                        grains=(jobs.ru.HOURLY,))
    hours = {r.hour for r in job.read_stats(spark, paths["hourlyadstats"]).select("hour").distinct().collect()}
    assert hours == set(busy)
    # re-running an hour replaces it: every table holds the same rows as before
    def table(p):
        from clearbid import schemas as S
        name = p.rsplit("/", 1)[1]
        if name == "hourlyadstats":
            df = job.read_stats(spark, p)
        elif name == "dailyadstats":
            df = job.read_daily(spark, p)
        elif name == "dailypartials":
            df = job.read_owned(spark, p, S.DAILY_PARTIALS, "hour")
        else:
            df = job.read_intermediate(spark, p, getattr(S, name.upper()))
        return _rows(df, sorted(df.columns))

    snap = {n: table(p) for n, p in paths.items()}
    assert snap["hourlyadstats"] and snap["dailyadstats"] and snap["auction_stats"]
    job.run(spark, t, tmp_root, Interval(busy[0], busy[0] + timedelta(hours=1)), pricing="bogus",
            grains=(jobs.ru.HOURLY,))
    for n, p in paths.items():
        assert table(p) == snap[n], n
    kinds = {r.kind for r in job.read_stats(spark, paths["hourlyadstats"]).select("kind").distinct().collect()}
    assert kinds <= {"imps", "convs", "defaults"}
    day = busy[0].replace(hour=0)
    assert job.read_daily(spark, paths["dailyadstats"]).filter(F.col("date") == day).count() > 0


def test_rerun_with_fewer_rows_leaves_nothing_stale(spark, tmp_root):
    t = ad_tables(spark, "/root/testdata/sf0.001")
    span = Interval(DAY, DAY + timedelta(hours=12))
    paths = job.backfill(spark, jobs.AdTables.of(t), tmp_root, span, view_lookback=7, click_lookback=7)
    before = job.read_stats(spark, paths["hourlyadstats"])
    assert before.filter("kind = 'convs'").count() > 0
    t["actions"] = t["actions"].filter("false")
    job.backfill(spark, jobs.AdTables.of(t), tmp_root, span, view_lookback=7, click_lookback=7)
    after = job.read_stats(spark, paths["hourlyadstats"])
    assert after.filter("kind = 'convs'").count() == 0 and after.filter("kind = 'imps'").count() > 0
    daily = job.read_daily(spark, paths["dailyadstats"]).agg(F.sum("view_convs").alias("v"), F.sum("click_convs").alias("c")).first()
    assert (daily.v, daily.c) == (0, 0)


def test_per_hour_runs_need_whole_hours(spark, tmp_root):
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    with pytest.raises(ValueError):
        job.backfill(spark, t, tmp_root, Interval(DAY + timedelta(minutes=30), DAY + timedelta(hours=2)))


def test_history_option_leaves_out_older_rows(spark, tmp_root):
    t = ad_tables(spark, "/root/testdata/sf0.001")
    span = Interval(DAY, DAY + timedelta(hours=6))
    whole = job.backfill(spark, jobs.AdTables.of(t), tmp_root + "/a", span, view_lookback=7, click_lookback=7)
    bounded = job.backfill(spark, jobs.AdTables.of(t), tmp_root + "/b", span, view_lookback=7, click_lookback=7, history_hours=2)
    stale = t | {"impressions": t["impressions"].withColumn("tstamp", F.col("tstamp") - F.expr("INTERVAL 3 DAYS"))}
    left_out = job.backfill(spark, jobs.AdTables.of(stale), tmp_root + "/c", span, view_lookback=7, click_lookback=7, history_hours=2)
    rows = lambda p: _rows(job.read_stats(spark, p["geoadstats"], jobs.ru.GEO), jobs.ru.stat_columns(jobs.ru.GEO))
    assert rows(whole) == rows(bounded) and len(rows(whole)) > 0
    assert not [r for r in job.read_stats(spark, left_out["geoadstats"], jobs.ru.GEO).collect() if r.kind == "imps"]


def test_grouping_sets_equal_one_pass_per_grain(spark):
    """Dimensions that are NULL themselves stay apart from those that a grain leaves out; one aggregation serves all grains."""
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    span = Interval(datetime(2024, 1, 1), datetime(2024, 1, 31))
    joined = jobs.ru.joined_impressions(t.auctions, t.impressions, jobs.intermediates(t, span, False).auction_stats, t.clicks, span)
    odd = joined.withColumn("country", F.when(F.col("city") != "city1", F.col("country"))).withColumn("placement", F.lit(None).cast("string"))
    grains = (jobs.ru.HOURLY, jobs.ru.GEO, jobs.ru.KEYWORD)
    for pricing in (jobs.ru.CPM, jobs.ru.CPC):
        sets = jobs.ru.imps_clicks_sets(odd, grains, pricing)
        for g in grains:
            want = jobs.ru.imps_clicks(odd, g, pricing)
            assert _rows(jobs.ru.of_set(sets, g, grains), want.columns) == _rows(want, want.columns)
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("count(distinct uuid") == 1
