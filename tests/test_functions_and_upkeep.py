import os
from datetime import datetime

import pytest

from clearbid.functions import decode_cells, geo_region, hour_floor, parse_rfc3339
from clearbid.plans.maintenance import migrate_tables, sync_environment
from clearbid.sources import tables as src
from clearbid.functions import Interval


def test_parse_rfc3339_to_utc(spark):
    df = spark.createDataFrame([("2017-11-09T13:00:00.000-08:00",), ("2017-11-09T21:30:00Z",)], "s string")
    got = [r.t for r in df.select(parse_rfc3339("s").alias("t")).collect()]
    assert got == [datetime(2017, 11, 9, 21, 0), datetime(2017, 11, 9, 21, 30)]


def test_decode_cells(spark):
    df = spark.createDataFrame([("7", "1.5", "true", "1510232400.9", "x")],
                               "i string, f string, b string, t string, s string")
    r = decode_cells(df, {"i": "INTEGER", "f": "FLOAT", "b": "BOOLEAN", "t": "TIMESTAMP", "s": "STRING"}).first()
    assert (r.i, r.f, r.b, r.t, r.s) == (7, 1.5, True, datetime(2017, 11, 9, 13, 0), "x")
    with pytest.raises(KeyError):
        decode_cells(df, {"i": "RECORD"})
    dirty = spark.createDataFrame([("x",)], "i string")
    assert decode_cells(dirty, {"i": "INTEGER"}, strict=False).first().i is None


def test_hour_floor_and_region(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5, 59, 59), "US", "CA"), (datetime(2024, 1, 1, 6, 0), None, "CA")],
                               "t timestamp_ntz, c string, r string")
    rows = df.select(hour_floor("t").alias("h"), geo_region("c", "r").alias("g")).collect()
    assert [(r.h, r.g) for r in rows] == [(datetime(2024, 1, 1, 5), "US-CA"), (datetime(2024, 1, 1, 6), None)]


def test_migration_partitions_and_pruning(spark, tmp_root):
    df = spark.createDataFrame([(datetime(2024, 1, d, 3), d) for d in (1, 2, 3)], "tstamp timestamp_ntz, v int")
    out = migrate_tables(spark, {"events": df}, tmp_root)
    back = spark.read.parquet(out["events"])
    got = src.time_range(back, Interval(datetime(2024, 1, 2), datetime(2024, 1, 3)))
    assert [r.v for r in got.collect()] == [2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.index("PartitionFilters: ["):]
    part = part[:part.index("]")]
    assert "date" in part and "2024-01-02" in part


def test_sync_environment(spark, tmp_root):
    prod, dev = tmp_root + "/prod", tmp_root + "/dev"
    hours = [(datetime(2024, 1, 1, h), f"p{h}") for h in range(5)]
    spark.createDataFrame(hours, "hour timestamp_ntz, publisher string").write.parquet(prod + "/hourlyadstats")
    spark.createDataFrame([(1,)], "x int").write.parquet(prod + "/cliques")
    spark.createDataFrame([(1,)], "x int").write.parquet(prod + "/users")
    done = sync_environment(spark, prod, dev, full=["users"], newest=[("hourlyadstats", "hour")],
                            once=["cliques"], limit=2)
    assert done == {"users": "replaced", "hourlyadstats": "newest 2", "cliques": "copied"}
    got = sorted(r.publisher for r in spark.read.parquet(dev + "/hourlyadstats").collect())
    assert got == ["p3", "p4"]
    again = sync_environment(spark, prod, dev, full=[], newest=[], once=["cliques"])
    assert again == {"cliques": "kept"}


def test_sync_names_missing_tables_and_touches_nothing(spark, tmp_root):
    prod, dev = tmp_root + "/prod", tmp_root + "/dev"
    spark.createDataFrame([(1,)], "x int").write.parquet(prod + "/users")
    with pytest.raises(FileNotFoundError, match="missing"):
        sync_environment(spark, prod, dev, full=["users", "missing"], newest=[], once=[])
    assert not os.path.exists(dev + "/users")


def test_only_keys_of_is_a_plain_semi_join(spark):
    big = spark.createDataFrame([(f"u{n}", n) for n in range(20)], "uuid string, v int")
    small = spark.createDataFrame([("u1",), ("u3",), ("u3",), (None,)], "uuid string")
    assert sorted(r.v for r in src.only_keys_of(big, small, ["uuid"]).collect()) == [1, 3]


def test_wall_clock_does_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # the hour that spring skips and the one that autumn repeats
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' t, '2024-11-03T05:30:00Z' a, '2024-11-03T06:30:00Z' b, '1730611800.9' c, '-1.5' d")
        r = df.select(hour_floor("t").alias("h"), parse_rfc3339("a").alias("a"), parse_rfc3339("b").alias("b"), "c", "d").first()
        assert (r.h, r.a, r.b) == (datetime(2024, 3, 10, 2), datetime(2024, 11, 3, 5, 30), datetime(2024, 11, 3, 6, 30))
        got = decode_cells(df.select("c", "d"), {"c": "TIMESTAMP", "d": "TIMESTAMP"}).first()
        assert (got.c, got.d) == (datetime(2024, 11, 3, 5, 30), datetime(1969, 12, 31, 23, 59, 58))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
