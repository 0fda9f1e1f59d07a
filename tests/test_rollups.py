from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clearbid.functions import Interval, split_keywords
from clearbid.operators import rollups as ru
from clearbid.plans import jobs
from clearbid.schemas import AUCTION_STATS, AUCTIONS, CLICKS, IMPRESSIONS
from clearbid.sources.fixtures import ad_tables
from conftest import BASE, at

IV = Interval(BASE, BASE + timedelta(hours=1))


def _auction(impid, country="C", region="R", keywords="k"):
    return (at(1), "a" + impid, impid, "u1", "info", "pub", "site", "page", "pl0", "pc", country, region,
            "c", 1, "z", keywords)


def _joined(spark, auctions, clicks):
    a = spark.createDataFrame(auctions, AUCTIONS)
    imps = [(at(1), r[2], "u1", "adv", "cmp", "cg", "cr", "ac0") for r in auctions]
    stats = [(at(1), r[1], "u1", r[2], 3, 2.0, 1.5) for r in auctions]
    i = spark.createDataFrame(imps, IMPRESSIONS)
    s = spark.createDataFrame(stats, AUCTION_STATS)
    c = spark.createDataFrame(clicks, CLICKS)
    return ru.joined_impressions(a, i, s, c, IV)


def test_fan_out_counts_twice(spark):
    clicks = [(at(2), "c1", "i1", "u1", "adv", "cmp", "cg", "cr"), (at(3), "c2", "i1", "u1", "adv", "cmp", "cg", "cr")]
    j = _joined(spark, [_auction("i1")], clicks)
    cpm = ru.imps_clicks(j, ru.HOURLY, ru.CPM).collect()[0]
    cpc = ru.imps_clicks(j, ru.HOURLY, ru.CPC).collect()[0]
    assert (cpm.imps, cpm.clicks, cpm.bids, cpm.uniques) == (2, 2, 6, 1)
    assert abs(cpm.spend - 3.0 / 1000) < 1e-12 and abs(cpc.spend - 3.0) < 1e-12
    assert cpm.hour == BASE


def test_null_country_one_group(spark):
    j = _joined(spark, [_auction("i1", country=None), _auction("i2", country=None)], [])
    rows = ru.imps_clicks(j, ru.GEO).collect()
    assert len(rows) == 1 and rows[0].region is None and rows[0].imps == 2


def test_keywords_split(spark):
    df = spark.createDataFrame([("a,,b,",), ("",), (None,)], "k string")
    got = [r.s for r in df.select(split_keywords("k").alias("s")).collect()]
    assert got == [["a", "", "b", ""], [], None]


def test_keyword_grain_groups_raw_string(spark):
    j = _joined(spark, [_auction("i1", keywords="a,b"), _auction("i2", keywords="b,a")], [])
    rows = ru.imps_clicks(j, ru.KEYWORD).collect()
    assert sorted(r.keywords for r in rows) == [["a", "b"], ["b", "a"]]


def test_conversion_classes(spark):
    imp = spark.createDataFrame([
        ("x1", at(10), at(5), "i1"), ("x2", at(10), at(5), "i1"), ("x3", at(10), at(5), "i1")],
        "actionid string, action_tstamp timestamp_ntz, imp_tstamp timestamp_ntz, impid string")
    for d in ru.HOURLY.conv_dims:
        imp = imp.withColumn(d, F.lit("d"))
    clk = spark.createDataFrame([("x1", at(4)), ("x2", at(6))], "actionid string, click_tstamp timestamp_ntz")
    r = ru.conversions(imp, clk, ru.HOURLY, IV).collect()[0]
    assert (r.view_convs, r.click_convs) == (2, 1)


def test_invariants_on_driver_data(spark):
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    span = Interval(datetime(2024, 1, 1), datetime(2024, 1, 31))
    mid = jobs.intermediates(t, span, False)
    hourly = jobs.grain_frames(t, mid, ru.HOURLY, span, False)
    keyword = jobs.grain_frames(t, mid, ru.KEYWORD, span, False)
    tot = lambda df, c: df.agg(F.sum(c)).first()[0]
    # conversions = view + click = matched actions
    convs = hourly["convs"]
    assert tot(convs, "view_convs") + tot(convs, "click_convs") == mid.imp_matched_actions.count()
    # keyword rows summed over keywords = hourly rows for additive measures
    for m in ("imps", "clicks", "bids"):
        assert tot(hourly["imps"], m) == tot(keyword["imps"], m)
    assert tot(hourly["defaults"], "defaults") == tot(keyword["defaults"], "defaults")


def test_backfill_equals_union_of_hour_runs(spark):
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    day = datetime(2024, 1, 12)
    span = Interval(day, day + timedelta(hours=6))
    one = jobs.hourly_backfill(t, span)
    loop = None
    for h in range(6):
        iv = Interval(day + timedelta(hours=h), day + timedelta(hours=h + 1))
        part = jobs.stats_table(t, ru.HOURLY, iv, per_hour=False)
        loop = part if loop is None else loop.unionByName(part)
    r = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row)
                          for row in df.collect())
    assert r(one) == r(loop) and one.count() > 0


def test_daily_sums_equal_hourly_sums(spark):
    from clearbid.operators.daily import daily_ad_stats
    t = jobs.AdTables.of(ad_tables(spark, "/root/testdata/sf0.001"))
    hourly = jobs.hourly_backfill(t)
    daily = daily_ad_stats(hourly)
    for m in ("bids", "imps", "clicks", "view_convs", "click_convs", "defaults"):
        h = hourly.agg(F.coalesce(F.sum(m), F.lit(0))).first()[0]
        d = daily.agg(F.sum(m)).first()[0]
        assert h == d, m
    hs = hourly.agg(F.sum("spend")).first()[0]
    ds = daily.agg(F.sum("spend")).first()[0]
    assert abs(hs - ds) < 1e-9


def test_conversions_and_defaults_of_all_grains_come_from_one_join(spark):
    """The job's shared forms equal those of each grain alone; slots that repeat, null dims and keys included."""
    base = "tstamp timestamp_ntz, auctionId string, impid string, uuid string, publisher string, site string, page string, placement string, pub_clique string"
    geo = "country string, region string, city string, metro bigint, zip string, keywords string"
    t = datetime(2024, 1, 10, 12, 5)
    auctions = spark.createDataFrame(
        [(t, "a1", "i1", "u1", "p", "s", None, "pl", "pc", "US", "West", "c", 1, "z", "k,l"), (t, "a1", "i1", "u2", "p", "s", None, "pl", "pc", None, "West", "c", None, "z", None),
         (t, "a2", "i2", "u1", "p", "s", "g", "pl", "pc", "US", None, None, 1, "z", ""), (t, None, None, "u3", None, "s", "g", "pl", None, "US", "West", "c", 1, None, "k")], f"{base}, {geo}")
    slot = "imp_tstamp timestamp_ntz, action_tstamp timestamp_ntz, actionid string, impid string, publisher string, site string, page string, placement string, pub_clique string, " \
           "advertiser string, campaign string, creativegroup string, creative string, adv_clique string, actionbeacon string"
    dims = ("p", "s", None, "pl", "pc", "adv", None, "cg", "cr", "ac", "buy")
    imp = spark.createDataFrame([(t, t, "x1", "i1", *dims), (t, t, "x2", "i1", *dims), (t, t, "x3", "gone", *dims), (t, t, None, "i2", *dims), (t, t, "x4", None, *dims)], slot)
    click = spark.createDataFrame([("x1", t + timedelta(minutes=1)), ("x2", t), (None, t)], "actionid string, click_tstamp timestamp_ntz")
    no_fill = spark.createDataFrame([(t, "a1"), (t + timedelta(seconds=1), "a1"), (t, "a2"), (t, None)], "tstamp timestamp_ntz, auctionId string")
    grains = (ru.HOURLY, ru.GEO, ru.KEYWORD)
    fetching = (ru.GEO, ru.KEYWORD)
    joined = ru.joined_conversions(imp, click, grains, None, True)
    convs, dflts = ru.conversions_sets(joined, fetching, auctions), ru.defaults_sets(auctions, no_fill, grains, None, True)
    rows = lambda df: sorted(map(repr, df.collect()))
    for g in grains:
        alone = ru.conversions(imp, click, g, None, auctions, True)
        shared = ru.conversions_of(joined, convs, g, fetching)
        assert shared.columns == alone.columns and rows(shared) == rows(alone) != []
        alone, shared = ru.defaults(auctions, no_fill, g, None, True), ru.defaults_of(dflts, g, grains)
        assert shared.columns == alone.columns and rows(shared) == rows(alone) != []
