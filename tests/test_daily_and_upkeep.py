from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clearbid.operators.daily import daily_ad_stats, upsert
from clearbid.operators.ranking import keep_newest_per_key, newest_n
from clearbid.plans.maintenance import retention
from clearbid.schemas import DAILYADSTATS, MEASURES
from clearbid.sources import sinks

DAY = datetime(2024, 1, 10)
HOURLY_SCHEMA = ("hour timestamp_ntz, advertiser string, campaign string, adv_clique string, publisher string, "
                 "site string, pub_clique string, clearprice double, bids bigint, spend double, imps bigint, "
                 "uniques bigint, clicks bigint, view_convs bigint, click_convs bigint, defaults bigint")


def test_daily_sums_of_missing_values(spark):
    rows = [(DAY, None, None, None, "p", "s", "pc", None, None, None, None, 3, None, None, None, 4),
            (DAY + timedelta(hours=3), None, None, None, "p", "s", "pc", None, None, None, None, 1, None, None, None, 1)]
    h = spark.createDataFrame(rows, HOURLY_SCHEMA)
    r = daily_ad_stats(h, DAY, DAY + timedelta(days=1)).collect()[0]
    assert (r.bids, r.imps, r.spend, r.clicks, r.defaults, r.clearprice) == (0, 0, 0.0, 0, 5, None)
    assert r.date == DAY


def test_daily_clearprice_is_average_of_hourly(spark):
    rows = [(DAY, "a", "c", "ac", "p", "s", "pc", 1.0, 2, 0.5, 3, 1, 0, 0, 0, None),
            (DAY + timedelta(hours=1), "a", "c", "ac", "p", "s", "pc", 3.0, 1, 0.25, 1, 1, 1, 0, 0, None),
            (DAY + timedelta(hours=2), "a", "c", "ac", "p", "s", "pc", None, 0, 0.0, 0, 0, 0, 2, 1, None)]
    r = daily_ad_stats(spark.createDataFrame(rows, HOURLY_SCHEMA)).collect()[0]
    assert (r.clearprice, r.bids, r.imps, r.spend, r.view_convs, r.click_convs) == (2.0, 3, 4, 0.75, 2, 1)


def _daily(spark, rows):
    return spark.createDataFrame(rows, DAILYADSTATS)


def _row(adv, imps):
    return (DAY, adv, "c", "ac", "p", "s", "pc", 0, imps, 0, None, 0.0, 0, 0, 0)


def test_upsert_null_keys_and_stale_keys(spark):
    old = _daily(spark, [_row(None, 1), _row("stale", 7)])
    new = _daily(spark, [_row(None, 2), _row("fresh", 3)])
    got = {r.advertiser: r.imps for r in upsert(old, new).collect()}
    assert got == {None: 2, "stale": 7, "fresh": 3}


def test_upsert_sink_is_idempotent(spark, tmp_root):
    path = tmp_root + "/daily"
    new = _daily(spark, [_row(None, 2), _row("a", 3)])
    sinks.upsert_daily(spark, new, path)
    sinks.upsert_daily(spark, new, path)
    got = sorted((r.advertiser or "", r.imps) for r in spark.read.parquet(path).collect())
    assert got == [("", 2), ("a", 3)]
    sinks.upsert_daily(spark, _daily(spark, [_row("a", 9)]), path)
    got = sorted((r.advertiser or "", r.imps) for r in spark.read.parquet(path).collect())
    assert got == [("", 2), ("a", 9)]


def test_partition_overwrite_rerun_same_rows(spark, tmp_root):
    path = tmp_root + "/hourly"
    df = spark.createDataFrame([(DAY, "imps", 1), (DAY, "imps", 2), (DAY, "convs", 5)],
                               "hour timestamp_ntz, kind string, v int")
    sinks.overwrite_partitions(df, path, ["hour", "kind"])
    sinks.overwrite_partitions(df, path, ["hour", "kind"])
    sinks.overwrite_partitions(df.filter(F.col("kind") == "convs"), path, ["hour", "kind"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 5]


def test_copy_once(spark, tmp_root):
    path = tmp_root + "/once"
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert sinks.copy_once(a, path) is True
    assert sinks.copy_once(b, path) is False
    assert [r.x for r in spark.read.parquet(path).collect()] == [1]


def test_retention_keeps_five(spark):
    rows = [("disk", f"snap{n}", datetime(2024, 1, n + 1)) for n in range(7)]
    rows += [("other", "o1", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "key string, name string, created timestamp_ntz")
    stale = sorted(r.name for r in retention(df, ["key"], "created", 5, ["name"]).collect())
    assert stale == ["snap0", "snap1"]
    assert [r.name for r in retention(df, ["key"], "created", 6, ["name"], prefix=("key", "di")).collect()] == ["snap0"]
    assert retention(df, ["key"], "created", 1, ["name"], prefix=("key", "oth")).count() == 0
    kept = keep_newest_per_key(df, ["key"], [F.desc("created")], 5)
    assert kept.count() == 6


def test_newest_n_boundary_ties(spark):
    rows = [(datetime(2024, 1, d), f"r{d}{k}") for d in (1, 2, 3) for k in range(4)]
    df = spark.createDataFrame(rows, "hour timestamp_ntz, name string")
    got = sorted(r.name for r in newest_n(df, "hour", 6, ["name"]).collect())
    assert got == ["r20", "r21", "r30", "r31", "r32", "r33"]
    assert newest_n(df, "hour", 100, ["name"]).count() == 12
    assert newest_n(df, "hour", 4, ["name"]).count() == 4


def test_measures_schema_declared():
    assert [f.name for f in MEASURES.fields][:3] == ["clearprice", "bids", "spend"]


def test_newest_n_fine_timestamps_matches_sort(spark):
    import random
    rnd = random.Random(3)
    rows = [(datetime(2024, 1, 1) + timedelta(seconds=rnd.randrange(0, 3 * 3600)), f"n{k}") for k in range(300)]
    rows += [(rows[0][0], "tie-a"), (rows[0][0], "tie-b")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, name string")
    for n in (1, 57, 150, 299, 302, 400):
        want = sorted(rows, key=lambda r: (-r[0].timestamp(), r[1]))[:n]
        got = newest_n(df, "ts", n, ["name"]).collect()
        assert sorted((r.ts, r.name) for r in got) == sorted(want)


def test_newest_n_busy_boundary_hour_spread_over_partitions(spark):
    # one hour holds most rows (all with the same sort value), spread over many
    # input partitions; the boundary hour is ranked by the tie-break alone
    import random
    rnd = random.Random(11)
    busy = datetime(2024, 1, 1, 5)
    rows = [(busy, f"b{rnd.randrange(0, 400):03d}", k) for k in range(3000)]
    rows += [(datetime(2024, 1, 1, 6), f"q{k}", k) for k in range(40)]
    rows += [(datetime(2024, 1, 1, 4), f"o{k}", k) for k in range(40)]
    df = spark.createDataFrame(rows, "hour timestamp_ntz, name string, k int").repartition(13)
    for n in (41, 500, 3039, 3041):
        want = sorted(rows, key=lambda r: (-r[0].timestamp(), r[1], r[2]))[:n]
        got = newest_n(df, "hour", n, ["name", "k"]).collect()
        assert sorted((r.hour, r.name, r.k) for r in got) == sorted(want)


def test_append_skips_empty_results(spark, tmp_root):
    path = tmp_root + "/appended"
    empty = spark.createDataFrame([], "hour timestamp_ntz, v int")
    assert sinks.append(empty, path, ["hour"]) is False
    rows = spark.createDataFrame([(DAY, 1)], "hour timestamp_ntz, v int")
    assert sinks.append(rows, path, ["hour"]) is True
    assert sinks.append(rows, path, ["hour"]) is True   # append semantics: a second load adds rows
    assert spark.read.parquet(path).count() == 2


def test_newest_n_of_any_type(spark):
    """Numbers with many values, ties, NULLs and NaN, texts that share a beginning, and whole tables."""
    import random

    from clearbid.operators import ranking
    rnd = random.Random(5)
    rows = [(k, rnd.choice([None, float(rnd.randrange(400)), rnd.random() * 1e6, float("nan"), 7.0]),
             rnd.choice([None, "", "same beginning " + str(rnd.randrange(50)), "Ünder", str(rnd.randrange(10**6))]), rnd.randrange(-3, 3)) for k in range(600)]
    df = spark.createDataFrame(rows, "k long, d double, s string, i int").repartition(7)

    def key(v):
        if v is None:
            return (0,)
        return (1, 1, 0.0) if v != v else (1, 0, v.encode() if isinstance(v, str) else v)
    for c, at in (("d", 1), ("s", 2), ("i", 3)):
        for n in (1, 37, 300, 550, 600, 900):
            order = sorted(rows, key=lambda r: r[0])
            order.sort(key=lambda r: key(r[at]), reverse=True)
            assert sorted(r.k for r in newest_n(df, c, n, ["k"]).select("k").collect()) == sorted(r[0] for r in order[:n]), (c, n)
    assert newest_n(df, "d", 5, ["k"]).columns == df.columns
    plan = ranking.newest_n(df, "d", 50, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(d" not in plan


def test_longest_prefix(spark):
    from clearbid.operators.ranking import longest_prefix
    names = spark.createDataFrame([(1, "disk-a-1"), (2, "disk-a-2"), (3, "disk-ab-1"), (4, "other"), (5, None), (6, "dis"), (7, "disk-a-1"), (8, "Éa")], "id int, name string")
    texts = lambda *p: spark.createDataFrame([(x,) for x in p], "prefix string")
    got = {r.id: r.prefix for r in longest_prefix(names, "name", texts("disk-a", "disk-ab", "di", "disk-a", "É", None)).collect()}
    assert got == {1: "disk-a", 2: "disk-a", 3: "disk-ab", 6: "di", 7: "disk-a", 8: "É"}
    assert longest_prefix(names, "name", texts("")).count() == 7 and longest_prefix(names, "name", texts("x").limit(0)).count() == 0
    stale = retention(names, [], "id", 1, ["id"], prefixes=("name", texts("disk-a", "disk-ab", "di")))
    assert {(r.id, r.prefix) for r in stale.collect()} == {(1, "disk-a"), (2, "disk-a")}


def test_digests_tell_any_change(spark):
    from clearbid.plans.maintenance import compare_tables, table_digest
    base = [(DAY, 1, None, 2.0), (DAY, None, "x", 2.0), (DAY, None, "x", 2.0), (None, 3, "y", None)]
    schema = "tstamp timestamp_ntz, a int, b string, c double"
    df = spark.createDataFrame(base, schema)
    shuffled = spark.createDataFrame(base[::-1], schema).repartition(3).select("c", "b", "a", "tstamp")
    assert table_digest(df).collect() == table_digest(shuffled).collect()
    assert [r.equal for r in compare_tables(df, shuffled).collect()] == [True, True]
    others = [base[:3] + [(None, 3, "y", 0.0)], base[:2] + base[3:], base + base[1:2], [(DAY, 2, None, 1.0)] + base[1:],
              base[:3] + [(None, None, "y", 3.0)], base[:1] + [(DAY, None, "x", 2.0), (DAY, 2, "x", None), base[3]]]
    for rows in others:
        assert not all(r.equal for r in compare_tables(df, spark.createDataFrame(rows, schema)).collect()), rows
    assert [(r.n_source, r.n_copy, r.equal) for r in compare_tables(df, None).orderBy("part").collect()] == [(1, 0, False), (3, 0, False)]


def test_migration_resumes_and_verifies(spark, tmp_root, monkeypatch):
    from clearbid.plans import maintenance as m
    root, dest = tmp_root + "/src", tmp_root + "/dst"
    days = [(DAY + timedelta(days=d), d) for d in range(4)]
    spark.createDataFrame(days, "tstamp timestamp_ntz, v int").write.parquet(f"{root}/clicks")
    spark.createDataFrame([(1,), (2,)], "v int").write.parquet(f"{root}/bids")
    done = m.migrate_dataset(spark, root, dest)
    assert done["clicks"] == 4 and done["bids"] == 1 and done["http_requests"] is None
    assert set(done) == {*m.AD_EVENT_TABLES, *m.HTTP_EVENT_TABLES}
    files = lambda: sorted(r[0] for r in spark.read.parquet(f"{dest}/clicks").select(F.input_file_name()).distinct().collect())
    before = files()
    assert m.migrate_dataset(spark, root, dest, ("clicks", "bids")) == {"clicks": 0, "bids": 0} and files() == before
    spark.createDataFrame([(DAY + timedelta(hours=1), 9)], "tstamp timestamp_ntz, v int").write.mode("append").parquet(f"{root}/clicks")
    assert m.migrate_dataset(spark, root, dest, ("clicks",)) == {"clicks": 1}
    assert len(set(files()) & set(before)) == 3 and spark.read.parquet(f"{dest}/clicks").count() == 5
    # a copy that does not come out right is an error
    monkeypatch.setattr(m.sinks, "overwrite_partitions", lambda df, path, parts: None)
    spark.createDataFrame([(DAY + timedelta(days=9), 9)], "tstamp timestamp_ntz, v int").write.mode("append").parquet(f"{root}/clicks")
    with pytest.raises(ValueError, match="differs"):
        m.migrate_dataset(spark, root, dest, ("clicks",))


def test_daily_rows_merge_from_partials(spark):
    from clearbid.operators.daily import daily_partials, merge_partials
    t = HOURLY_SCHEMA
    names = [f.split()[0] for f in t.split(", ")] if isinstance(t, str) else t.names
    base = dict.fromkeys(names)
    told = []
    for h in range(30):
        for adv in ("a", None):
            told.append(base | {"hour": DAY + timedelta(hours=h), "advertiser": adv, "bids": h, "imps": 1 if h % 2 else None, "spend": 0.5 * h,
                                "clearprice": None if adv is None or h % 3 else 0.25 * h})
    hourly = spark.createDataFrame([tuple(r[n] for n in names) for r in told], t)
    want, got = daily_ad_stats(hourly), merge_partials(daily_partials(hourly))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 4
