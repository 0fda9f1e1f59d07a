import glob
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clearbid.functions import Interval
from clearbid.session import written
from clearbid.sources import layout
from clearbid.sources.tables import bounded, time_range

DAY = datetime(2024, 1, 1)


def rows_read(df) -> int:
    """Rows that the scan handed on: those of the row groups it did not skip."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def events(spark):
    seconds = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)")
    df = spark.range(0, 80_000, 1, 1).select(seconds.alias("tstamp"), F.md5((F.col("id") % 30_000).cast("string")).alias("uuid"),
                                             F.sha2(F.col("id").cast("string"), 256).alias("impid"), "id")
    import tempfile
    path = tempfile.mkdtemp(prefix="clearbid-layout-") + "/events"
    layout.write_events(df, path, row_group_bytes=1 << 20, ids_per_group=20_000)
    return df, spark.read.parquet(path), path


def test_rows_are_sorted_and_groups_carry_time_and_ids(events):
    _, _, path = events
    for f in glob.glob(f"{path}/date=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        at = names.index("at_minute")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        assert len(stats) > 2
        assert all(a.max <= b.min for a, b in zip(stats, stats[1:]))


def test_time_bounds_skip_row_groups(events):
    df, table, _ = events
    hour = Interval(DAY + timedelta(hours=3), DAY + timedelta(hours=4))
    got = time_range(table, hour)
    assert "at_minute" in got._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert 3600 <= rows_read(got) < 20_000
    assert [r["id"] for r in got.orderBy("id").collect()] == [r["id"] for r in time_range(df, hour).orderBy("id").collect()]
    # bounds inside a minute are exact
    lo, hi = DAY + timedelta(seconds=100, microseconds=1), DAY + timedelta(seconds=170)
    assert sorted(r["id"] for r in bounded(table, "tstamp", lo, hi).collect()) == list(range(101, 170))


def test_few_users_skip_row_groups(events):
    df, table, _ = events
    users = [r["uuid"] for r in df.filter("id in (25000, 25001)").collect()]   # seen at two times each
    got = layout.lookback_of(table, users, DAY + timedelta(days=1), 1)
    assert sorted(r["id"] for r in got.collect()) == [25000, 25001, 55000, 55001]
    assert rows_read(got) < 40_000
    assert layout.lookback_of(table, [], DAY, 1).count() == 0
    with pytest.raises(ValueError):
        layout.lookback_of(table, map(str, range(layout.LISTED_IDS + 1)), DAY, 1)


def test_minutes_do_not_depend_on_the_time_zone(spark, events):
    df, table, _ = events
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        first = df.limit(1).select(layout.at_minute("tstamp").alias("m")).first()["m"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert first == table.agg(F.min("at_minute")).first()[0] == 28401120


SCHEMA = "day date, name string, n bigint"


def frame(spark, *rows):
    return spark.createDataFrame([(DAY.date() + timedelta(days=d), k, n) for d, k, n in rows], SCHEMA)


def test_keyed_upsert(spark, tmp_root):
    path, keys = f"{tmp_root}/keyed", ["day", "name"]

    def content():
        got = layout.read_keyed(spark, path, frame(spark).schema, "day").collect()
        return sorted(((r["day"] - DAY.date()).days, r["name"] or "", r["n"]) for r in got)

    layout.upsert_keyed(frame(spark), path, keys, "day", 4)
    assert content() == []
    layout.upsert_keyed(frame(spark, (0, "a", 1), (0, None, 2), (1, "a", 3)), path, keys, "day", 4)
    layout.upsert_keyed(frame(spark, (0, None, 20), (0, "b", 4), (2, "c", 5)), path, keys, "day", 16)   # 4 buckets hold
    want = [(0, "", 20), (0, "a", 1), (0, "b", 4), (1, "a", 3), (2, "c", 5)]
    assert content() == want
    layout.upsert_keyed(frame(spark, (0, None, 20), (2, "c", 5)), path, keys, "day")
    assert content() == want
    with pytest.raises(ValueError):
        layout.upsert_keyed(frame(spark), path, ["name"], "day")


def test_the_target_is_not_shuffled(spark, tmp_root):
    path, keys = f"{tmp_root}/keyed", ["day", "name"]
    layout.upsert_keyed(frame(spark, *[(d, f"k{i}", i) for d in range(2) for i in range(200)]), path, keys, "day", 8)
    name = layout.open_keyed(spark, path, frame(spark).schema, "day", 8)
    new = written(frame(spark, *[(0, f"k{i}", -i) for i in range(100, 300)]).withColumn(layout.KEY, F.xxhash64(*keys)), "keyed-new")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = layout.merge_keyed(spark.table(name), new, keys)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    join = plan[plan.index("SortMergeJoin"):]
    left = join[:join.index("Bucketed: true")]
    assert "Exchange" not in left
    assert "SelectedBucketsCount: 8 out of 8" in plan
