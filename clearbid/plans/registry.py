"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the driver tables of ``sf_dir`` and derives the ad tables
from them, so its work grows with the data.  Interval runs use the whole
event span [2024-01-01, 2024-01-31) with the reference's 30-day lookback, so
they cover every row; the hourly/daily backfills label each hour (day).  The
per-hour attribution queries look back 7 days, so their bounds cut rows.
Doubles are rounded to 6 places in both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbid import oracle as O
from clearbid.functions import Interval
from clearbid.functions.core import decode_cells, parse_rfc3339
from clearbid.operators import attribution as attr
from clearbid.operators import auctions as auc
from clearbid.operators import rollups as ru
from clearbid.operators.asof import latest_touch_time
from clearbid.operators.daily import daily_ad_stats
from clearbid.operators.ranking import newest_n, stale_per_key
from clearbid.plans import jobs
from clearbid.sources import tables as src
from clearbid.sources.fixtures import ad_tables

START = datetime(2024, 1, 1)
END = datetime(2024, 1, 31)
SPAN = Interval(START, END)
LOOKBACK = 30
WEEK = Interval(datetime(2024, 1, 8), datetime(2024, 1, 15))
WEEK_LOOKBACK = 7
SYNC_LIMIT = 1_000     # rows per aggregate table in the environment sync: below the row counts at sf0.01, so it cuts
NEWEST_LIMIT = 3_000   # of the newest-N query: well inside the table at every scale, within an hour's rows
DAMAGED = datetime(2024, 1, 12)   # the day that the verified migration finds damaged
BLANK_CELL = 200       # rows of a key that one cell holds in the as-of of blank users: they hold far more at every scale
KEYED_BUCKETS = 8      # buckets of the keyed daily table
TOP_USERS = 20         # users of the week in the lookback by user (the feature: a report on a few)
RETAIN = 5             # versions kept per key by retention


def _tables(spark: SparkSession, sf_dir: str) -> jobs.AdTables:
    return jobs.AdTables.of(ad_tables(spark, sf_dir))


def _round(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            c = F.col(f.name)   # same nudged rounding as oracle.R
            cols.append(F.round(c + F.signum(c) * F.lit(1e-12), 6).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _span_mid(t: jobs.AdTables, per_hour: bool) -> jobs.Intermediates:
    return jobs.intermediates(t, None if per_hour else SPAN, per_hour, LOOKBACK, LOOKBACK)


# columns compared per table by the migration and sync queries: time, texts and numbers, amounts
MIGRATED = {
    "actions": ("tstamp", ["actionid", "uuid", "advertiser", "actionbeacon"], "value"),
    "auction_defaults": ("tstamp", ["auctionId"], None),
    "auctions": ("tstamp", ["auctionId", "impid", "uuid", "level", "publisher", "site", "page", "placement", "pub_clique",
                            "country", "region", "city", "metro", "zip", "keywords"], None),
    "bids": ("tstamp", ["bidid", "auctionId", "impid", "adv_clique"], "bid"),
    "clicks": ("tstamp", ["clickid", "impid", "uuid", "advertiser", "campaign", "creativegroup", "creative"], None),
    "impressions": ("tstamp", ["auctionId", "impid", "uuid", "advertiser", "campaign", "creativegroup", "creative", "adv_clique"], None),
}
SYNCED = {
    "advertisers": (None, ["s_suppkey", "s_name", "s_nationkey"], "s_acctbal"),
    "cliques": (None, ["c_custkey", "c_name", "c_nationkey"], "c_acctbal"),
    "dailyadstats": ("date", ["advertiser", "campaign", "adv_clique", "publisher", "site", "pub_clique", "bids", "imps",
                              "defaults", "clicks", "view_convs", "click_convs"], "spend"),
    "hourlyadstats": ("hour", [c for c in ru.stat_columns(ru.HOURLY) if c not in ("hour", "spend", "clearprice")], "spend"),
}


# ----------------------------------------------------------------------- Spark side

def _contents(tables: dict[str, DataFrame], plan: dict) -> DataFrame:
    """The rows of several tables as (table_name, at, body, amount)."""
    u = None
    for name, df in tables.items():
        at, texts, amount = plan[name]
        body = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in texts])
        part = df.select(F.lit(name).alias("table_name"), (F.col(at) if at else F.lit(None)).cast("timestamp_ntz").alias("at"),
                         body.alias("body"), (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"))
        u = part if u is None else u.unionByName(part)
    return _round(u)


def q_auction_stats(spark, sf):
    t = _tables(spark, sf)
    return _round(auc.auction_stats(t.auctions, t.impressions, t.bids, SPAN))


def q_auction_stats_defaults(spark, sf):
    t = _tables(spark, sf)
    return _round(auc.auction_stats_defaults(t.auctions, SPAN))


def q_auction_stats_hourly(spark, sf):
    t = _tables(spark, sf)
    return _round(jobs.intermediates(t, None, True).auction_stats)


def q_losing_bids(spark, sf):
    t = _tables(spark, sf)
    return _round(auc.losing_bids(t.bids, SPAN))


def q_imp_matched(spark, sf):
    t = _tables(spark, sf)
    return _round(attr.imp_matched_actions(t.impressions, t.actions, t.auctions, SPAN, LOOKBACK))


def q_click_matched(spark, sf):
    t = _tables(spark, sf)
    return _round(attr.click_matched_actions(t.clicks, t.actions, t.auctions, SPAN, LOOKBACK))


def q_imp_matched_hourly(spark, sf):
    t = _tables(spark, sf)
    return _round(attr.imp_matched_actions_hourly(t.impressions, t.actions, t.auctions, WEEK_LOOKBACK))


def q_click_matched_hourly(spark, sf):
    t = _tables(spark, sf)
    return _round(attr.click_matched_actions_hourly(t.clicks, t.actions, t.auctions, WEEK_LOOKBACK))


def _rollup(grain: ru.Grain, family: str, pricing: str = ru.CPM):
    def run(spark, sf):
        t = _tables(spark, sf)
        mid = _span_mid(t, False)
        frames = jobs.grain_frames(t, mid, grain, SPAN, False, pricing)
        return _round(frames[family])
    return run


def q_hourlyadstats_all(spark, sf):
    t = _tables(spark, sf)
    return _round(jobs.stats_table(t, ru.HOURLY, SPAN, False))


def _union_grain(grain: ru.Grain):
    def run(spark, sf):
        t = _tables(spark, sf)
        return _round(jobs.stats_table(t, grain, SPAN, False))
    return run


def q_hourly_backfill(spark, sf):
    return _round(jobs.hourly_backfill(_tables(spark, sf)))


# what the hourly job leaves behind: table -> (time column, dimensions and counts)
JOB_TABLES = {f"{n}adstats": ("hour", [c for c in ru.stat_columns(g) if c not in ("hour", "spend", "clearprice")]) for n, g in ru.GRAINS.items()}
JOB_TABLES["dailyadstats"] = ("date", ["advertiser", "campaign", "adv_clique", "publisher", "site", "pub_clique", "bids", "imps",
                                       "defaults", "clicks", "view_convs", "click_convs"])


def _run_hourly_job(spark, t: dict[str, DataFrame], out: str) -> DataFrame:
    """Run the written hourly job over whole tables and read back all that it stored:
    the three stats tables and the daily rows, as (table_name, at, body, spend, clearprice)."""
    from clearbid.plans import hourly
    paths = hourly.run(spark, jobs.AdTables.of(t), out, SPAN, per_hour=True, view_lookback=LOOKBACK, click_lookback=LOOKBACK)
    tables = {f"{n}adstats": hourly.read_stats(spark, paths[f"{n}adstats"], g) for n, g in ru.GRAINS.items()}
    tables["dailyadstats"] = hourly.read_daily(spark, paths["dailyadstats"])
    u = None
    for name, df in tables.items():
        at, texts = JOB_TABLES[name]
        cells = [F.array_join("keywords", ",") if c == "keywords" else F.col(c).cast("string") for c in texts]
        part = df.select(F.lit(name).alias("table_name"), F.col(at).alias("at"),
                         F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in cells]).alias("body"), "spend", "clearprice")
        u = part if u is None else u.unionByName(part)
    return u


def q_hourly_job(spark, sf):
    """The hourly job itself: intermediates, stats of all three grains and daily rows, written and read back."""
    from clearbid.session import scratch_dir
    return _round(_run_hourly_job(spark, ad_tables(spark, sf), scratch_dir(spark, "hourly-job")))


def q_hourly_job_rerun(spark, sf):
    """The hourly job twice into one place: first with conversions seven hours late and
    clicks twice over, then with the tables as they are.  Only the second run's rows may be left."""
    from clearbid.session import scratch_dir
    out = scratch_dir(spark, "hourly-rerun")
    t = ad_tables(spark, sf)
    late = F.col("tstamp") + F.expr("INTERVAL 7 HOURS")
    wrong = t | {"actions": t["actions"].withColumn("tstamp", late), "clicks": t["clicks"].union(t["clicks"])}
    _run_hourly_job(spark, wrong, out)
    return _round(_run_hourly_job(spark, t, out))


def q_keyword_backfill(spark, sf):
    """The keyword catch-up: keyword stats of every hour of the table, one job."""
    return _round(jobs.hourly_backfill(_tables(spark, sf), grain=ru.KEYWORD))


def q_dailyadstats(spark, sf):
    t = _tables(spark, sf)
    hourly = jobs.stats_table(t, ru.HOURLY, SPAN, False)
    return _round(daily_ad_stats(hourly, START, START + timedelta(days=1)))


def q_daily_backfill(spark, sf):
    return _round(jobs.daily_backfill(jobs.hourly_backfill(_tables(spark, sf))))


def q_daily_upsert(spark, sf):
    hourly = jobs.hourly_backfill(_tables(spark, sf))
    # the daily table as it stood at noon of each day, then refreshed with the hours from 6 on:
    # keys seen only before 6 are the target's alone and must stay
    old = daily_ad_stats(hourly.filter(F.hour("hour") < 12))
    new = daily_ad_stats(hourly.filter(F.hour("hour") >= 6))
    from clearbid.session import scratch_dir
    from clearbid.sources import sinks
    path = scratch_dir(spark, "dailyadstats")
    sinks.upsert_daily(spark, old, path)
    sinks.upsert_daily(spark, new, path)
    return _round(spark.read.schema(new.schema).parquet(path).drop("day"))


def q_keyed_upsert(spark, sf):
    """As ``daily_upsert``, into a table bucketed on its keys: the target is merged where it lies."""
    from clearbid.schemas import DAILY_KEYS
    from clearbid.session import scratch_dir
    from clearbid.sources.layout import read_keyed, upsert_keyed
    hourly = jobs.hourly_backfill(_tables(spark, sf))
    old = daily_ad_stats(hourly.filter(F.hour("hour") < 12))
    new = daily_ad_stats(hourly.filter(F.hour("hour") >= 6))
    path = scratch_dir(spark, "keyed-daily")
    for rows in (old, new):
        upsert_keyed(rows.withColumn("date", F.to_date("date")), path, DAILY_KEYS, "date", KEYED_BUCKETS)
    schema = T.StructType([T.StructField(f.name, T.DateType()) if f.name == "date" else f for f in new.schema.fields])
    kept = read_keyed(spark, path, schema, "date")
    return _round(kept.withColumn("date", F.col("date").cast("timestamp_ntz")).select(*new.columns))


def q_user_lookback(spark, sf):
    """Touches, within the lookback, of the users whose actions of the week are worth most."""
    from clearbid.session import scratch_dir
    from clearbid.sources.layout import lookback_of, write_events
    t = _tables(spark, sf)
    worth = src.time_range(t.actions, WEEK).groupBy("uuid").agg(F.sum(F.col("value").cast("decimal(38,6)")).alias("worth"))
    top = [r["uuid"] for r in worth.orderBy(F.col("worth").desc_nulls_last(), "uuid").limit(TOP_USERS).collect()]
    path = scratch_dir(spark, "impressions")
    write_events(t.impressions.drop("eid", "slot"), path)
    stored = spark.read.parquet(path)
    return lookback_of(stored, top, WEEK.end, WEEK_LOOKBACK).drop("at_minute", "date")


def q_latest_n_sync(spark, sf):
    """Newest rows of a stored aggregate table (the sync reads tables, not plans):
    the hourly backfill is written once to the shared scratch folder first."""
    from clearbid.session import scratch_dir
    path = scratch_dir(spark, "hourlyadstats")
    jobs.hourly_backfill(_tables(spark, sf)).write.parquet(path)
    hourly = spark.read.parquet(path)
    tiebreak = [c for c in hourly.columns if c != "hour"]
    return _round(newest_n(hourly, "hour", NEWEST_LIMIT, tiebreak))


def q_retention_keep_n(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return stale_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], RETAIN,
                         ["o_orderkey"])


def q_asof_blank_users(spark, sf):
    """Newest impression at or before each action by (uuid, advertiser), where every third user is
    blank: the blank keys hold a third of all rows and are cut in time."""
    t = _tables(spark, sf)
    blank = F.when(F.substring("uuid", 2, 20).cast("long") % 3 == 0, F.lit("")).otherwise(F.col("uuid")).alias("uuid")
    actions = t.actions.select("actionid", blank, "advertiser", "tstamp")
    touches = t.impressions.select(blank, "advertiser", "tstamp")
    return latest_touch_time(actions, touches, ["uuid", "advertiser"], cell_rows=BLANK_CELL)


def q_append_rows(spark, sf):
    """Orders loaded in two appends, with an empty load first, which writes nothing."""
    from clearbid.sources import sinks
    from clearbid.session import scratch_dir
    target = scratch_dir(spark, "appended")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    even = F.col("o_orderkey") % 2 == 0
    wrote = [sinks.append(orders.filter(c), target) for c in (F.col("o_orderkey").isNull(), even, ~even)]
    if wrote[0] or not all(wrote[1:]):
        raise AssertionError(f"loads that wrote: {wrote}")
    return spark.read.parquet(target)


def q_retention_by_prefix(spark, sf):
    """Part names by the longest of many overlapping prefixes (the first word, and the beginnings of
    every seventh part's name): all but the newest few of each prefix."""
    from clearbid.plans.maintenance import retention
    part = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_name", "p_size")
    words = part.select(F.split("p_name", " ")[0].alias("prefix"))
    some = part.filter(F.col("p_partkey") % 7 == 0)
    prefixes = words.union(some.select(F.substring("p_name", 1, 2))).union(some.select(F.substring("p_name", 1, 7)))
    return retention(part, [], "p_size", RETAIN, ["p_partkey"], prefixes=("p_name", prefixes))


def q_largest_n(spark, sf):
    """The order lines of the highest price: a field of nearly as many values as rows."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return _round(newest_n(lines, "l_extendedprice", NEWEST_LIMIT, ["l_orderkey", "l_linenumber", "l_partkey"]))


def q_migration_verified(spark, sf):
    """The table lists migrated with verification.  The copy is then damaged: one action's value and one
    click of a day.  The rows tell, day by day, what the comparison finds (phase 'damaged') and
    what it finds after the migration has run again and mended just those days ('resumed')."""
    from clearbid.plans.maintenance import compare_tables, migrate_dataset
    from clearbid.session import scratch_dir
    from clearbid.sources import sinks
    root, dest = scratch_dir(spark, "warehouse"), scratch_dir(spark, "migrated")
    for name, df in ad_tables(spark, sf).items():
        df.drop(*[c for c in ("eid", "slot") if c in df.columns]).write.parquet(f"{root}/{name}")
    done = migrate_dataset(spark, root, dest)
    copied = [name for name, parts in done.items() if parts is not None]

    def damage(name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        day = spark.read.parquet(f"{dest}/{name}").filter(F.col("date") == F.lit(DAMAGED.date()))
        stage = scratch_dir(spark, "damaged")
        change(day).write.parquet(stage)
        sinks.overwrite_partitions(spark.read.parquet(stage), f"{dest}/{name}", ["date"])
    damage("actions", lambda d: d.withColumn("value", F.when(F.col("actionid") == d.agg(F.min("actionid")).first()[0], -1.0).otherwise(F.col("value"))))
    damage("clicks", lambda d: d.filter(F.col("clickid") != d.agg(F.min("clickid")).first()[0]))

    def told(phase: str) -> DataFrame:
        u = None
        for name in copied:
            rows = compare_tables(spark.read.parquet(f"{root}/{name}"), spark.read.parquet(f"{dest}/{name}"))
            rows = rows.select(F.lit(phase).alias("phase"), F.lit(name).alias("table_name"), F.col("part").alias("day"), "n_source", "n_copy", "equal")
            u = rows if u is None else u.unionByName(rows)
        path = scratch_dir(spark, f"compared-{phase}")
        u.write.parquet(path)
        return spark.read.parquet(path)
    damaged = told("damaged")
    again = migrate_dataset(spark, root, dest)
    if {name: parts for name, parts in again.items() if parts} != {"actions": 1, "clicks": 1}:
        raise AssertionError(f"the second run wrote {again}")
    return damaged.unionByName(told("resumed"))


def q_time_range_scan(spark, sf):
    t = _tables(spark, sf)
    return _round(src.time_range(t.actions, WEEK).drop("eid"))


def q_widened_scan(spark, sf):
    t = _tables(spark, sf)
    return _round(src.widened_range(t.bids, WEEK, hours=1).drop("eid", "slot"))


def q_lookback_scan(spark, sf):
    t = _tables(spark, sf)
    return src.lookback(t.impressions, WEEK.end, WEEK_LOOKBACK).drop("eid", "slot")


def q_copy_once(spark, sf):
    from clearbid.sources import sinks
    from clearbid.session import scratch_dir
    target = scratch_dir(spark, "copy_once") + "/orders"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    sinks.copy_once(orders, target)
    sinks.copy_once(orders, target)   # second run finds the copy and skips
    return spark.read.parquet(target)


def q_table_migration(spark, sf):
    from clearbid.plans.maintenance import migrate_tables
    from clearbid.session import scratch_dir
    root = scratch_dir(spark, "migration")
    tables = ad_tables(spark, sf)
    written = migrate_tables(spark, {k: v.drop(*[c for c in ("eid", "slot") if c in v.columns])
                                     for k, v in tables.items()}, root)
    return _contents({name: spark.read.parquet(path) for name, path in written.items()}, MIGRATED)


def q_environment_sync(spark, sf):
    """Write the aggregate tables to a 'production' folder, sync them to a
    'development' folder (whole tables over an older copy, newest N per
    aggregate table, copy-once for the rest) and return the rows that arrived."""
    from clearbid.plans.maintenance import sync_environment
    from clearbid.session import scratch_dir
    prod, dev = scratch_dir(spark, "prod"), scratch_dir(spark, "dev")
    hourly = jobs.hourly_backfill(_tables(spark, sf))
    hourly.write.parquet(f"{prod}/hourlyadstats")
    spark.read.parquet(f"{prod}/hourlyadstats").transform(jobs.daily_backfill).write.parquet(f"{prod}/dailyadstats")
    supplier = spark.read.parquet(f"{sf}/supplier.parquet")
    supplier.write.parquet(f"{prod}/advertisers")
    supplier.union(supplier).write.parquet(f"{dev}/advertisers")   # an older copy that must go whole
    spark.read.parquet(f"{sf}/customer.parquet").write.parquet(f"{prod}/cliques")
    done = sync_environment(spark, prod, dev, full=["advertisers"],
                            newest=[("hourlyadstats", "hour"), ("dailyadstats", "date")], once=["cliques"],
                            limit=SYNC_LIMIT)
    return _contents({name: spark.read.parquet(f"{dev}/{name}") for name in done}, SYNCED)


def q_rfc3339_parse(spark, sf):
    """Event times written as RFC 3339 text with three kinds of offset and read back."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    text = F.replace(F.col("ts").cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))
    zone = F.element_at(F.array(F.lit("Z"), F.lit("+05:30"), F.lit("-08:00")), (F.col("event_id") % 3 + 1).cast("int"))
    return events.select("event_id", parse_rfc3339(F.concat(text, zone)).alias("utc"))


def q_cell_decode(spark, sf):
    """Order lines written as text cells and decoded by warehouse type name."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01")).cast("long") * 86400
    cells = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_returnflag").alias("flag"), F.col("l_orderkey").cast("string").alias("orderkey"),
        F.col("l_extendedprice").cast("double").cast("string").alias("price"),
        F.when(F.col("l_linenumber") % 2 == 0, "True").otherwise("false").alias("even"),
        F.concat((day + F.col("l_linenumber")).cast("string"), F.lit(".75")).alias("shipped"))
    return _round(decode_cells(cells, {"flag": "STRING", "orderkey": "INTEGER", "price": "FLOAT",
                                       "even": "BOOLEAN", "shipped": "TIMESTAMP"}))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "auction_stats": q_auction_stats,
    "auction_stats_defaults": q_auction_stats_defaults,
    "auction_stats_hourly": q_auction_stats_hourly,
    "anti_join_losers": q_losing_bids,
    "imp_matched_actions": q_imp_matched,
    "click_matched_actions": q_click_matched,
    "imp_matched_actions_hourly": q_imp_matched_hourly,
    "click_matched_actions_hourly": q_click_matched_hourly,
}
for _g in (ru.HOURLY, ru.GEO, ru.KEYWORD):
    QUERIES[f"{_g.name}_cpm"] = _rollup(_g, "imps", ru.CPM)
    QUERIES[f"{_g.name}_cpc"] = _rollup(_g, "imps", ru.CPC)
    QUERIES[f"{_g.name}_actions"] = _rollup(_g, "convs")
    QUERIES[f"{_g.name}_defaults"] = _rollup(_g, "defaults")
QUERIES.update({
    "hourlyadstats_all": q_hourlyadstats_all,
    "geoadstats_all": _union_grain(ru.GEO),
    "keywordadstats_all": _union_grain(ru.KEYWORD),
    "hourly_backfill": q_hourly_backfill,
    "hourly_job": q_hourly_job,
    "hourly_job_rerun": q_hourly_job_rerun,
    "keyword_backfill": q_keyword_backfill,
    "dailyadstats": q_dailyadstats,
    "daily_backfill": q_daily_backfill,
    "daily_upsert": q_daily_upsert,
    "keyed_upsert": q_keyed_upsert,
    "latest_n_sync": q_latest_n_sync,
    "retention_keep_n": q_retention_keep_n,
    "retention_by_prefix": q_retention_by_prefix,
    "asof_blank_users": q_asof_blank_users,
    "append_rows": q_append_rows,
    "largest_n": q_largest_n,
    "migration_verified": q_migration_verified,
    "time_range_scan": q_time_range_scan,
    "widened_scan": q_widened_scan,
    "lookback_scan": q_lookback_scan,
    "user_lookback": q_user_lookback,
    "copy_once": q_copy_once,
    "table_migration": q_table_migration,
    "environment_sync": q_environment_sync,
    "rfc3339_parse": q_rfc3339_parse,
    "cell_decode": q_cell_decode,
})


# ----------------------------------------------------------------------- oracle side

def _o_auction_stats() -> str:
    cols = ["tstamp", "auctionId", "uuid", "impid", "num_bids", "max_bid", "clearprice"]
    sql = O.with_fixtures(O.auction_stats_cte("ast", START, END))
    q = ", ".join(f'{O.R(c)} AS {c}' if c in ("max_bid", "clearprice") else f'"{c}"' for c in cols)
    return f"{sql}\nSELECT {q} FROM ast_info"


def _o_auction_defaults() -> str:
    sql = O.with_fixtures(O.auction_stats_cte("ast", START, END))
    return f'{sql}\nSELECT tstamp, "auctionId", uuid, impid, num_bids, max_bid, clearprice FROM ast_err'


def _o_auction_hourly() -> str:
    sql = O.with_fixtures(O.auction_stats_hourly_cte("ash"))
    return (f'{sql}\nSELECT tstamp, "auctionId", uuid, impid, num_bids, {O.R("max_bid")} AS max_bid, '
            f'{O.R("clearprice")} AS clearprice FROM ash')


def _o_losers() -> str:
    ws, we = O.T(START - timedelta(hours=1)), O.T(END + timedelta(hours=1))
    return O.with_fixtures(f"""
b AS (SELECT * FROM bids WHERE tstamp >= {ws} AND tstamp < {we}),
m AS (SELECT "auctionId", impid, adv_clique, MAX(bid) AS group_max FROM b GROUP BY 1, 2, 3),
winners AS (SELECT b.bidid FROM b JOIN m USING ("auctionId", impid, adv_clique) WHERE b.bid = m.group_max)""") + """
SELECT b.tstamp, b.bidid, b."auctionId", b.impid, b.adv_clique, """ + O.R("b.bid") + " AS bid, " + O.R("m.group_max") + """ AS group_max
FROM b LEFT JOIN winners w ON b.bidid = w.bidid JOIN m USING ("auctionId", impid, adv_clique)
WHERE w.bidid IS NULL AND b.bid IS NOT NULL"""


def _o_matched(cte: str, cols: list[str]) -> str:
    sql = O.with_fixtures(cte)
    return f"{sql}\n" + O.rounded_select(cols, {"value"}, "mt")


def _span_ctes(per_hour: bool) -> list[str]:
    if per_hour:
        return [O.auction_stats_hourly_cte("ast"), O.imp_matched_hourly_cte("imt", LOOKBACK),
                O.click_matched_hourly_cte("cmt", LOOKBACK)]
    return [O.auction_stats_cte("ast", START, END), O.imp_matched_cte("imt", START, END, LOOKBACK),
            O.click_matched_cte("cmt", START, END, LOOKBACK)]


def _labels(per_hour: bool):
    if per_hour:
        return ("date_trunc('hour', a.tstamp)", "TRUE",
                "date_trunc('hour', i.action_tstamp)", "TRUE")
    span_a = f"a.tstamp >= {O.T(START)} AND a.tstamp < {O.T(END)}"
    span_i = f"i.action_tstamp >= {O.T(START)} AND i.action_tstamp < {O.T(END)}"
    return O.T(START), span_a, O.T(START), span_i


def _family_sql(grain: str, family: str, per_hour: bool, pricing: str = "CPM") -> tuple[list[str], str]:
    la, wa, li, wi = _labels(per_hour)
    if family == "imps":
        return O.imps_rollup_sql(grain, pricing, la, wa, "ast")
    if family == "convs":
        return O.actions_rollup_sql(grain, li, wi, "imt", "cmt")
    return O.defaults_rollup_sql(grain, la, wa)


def _o_rollup(grain: str, family: str, pricing: str = "CPM") -> str:
    cols, inner = _family_sql(grain, family, False, pricing)
    return O.with_fixtures(*_span_ctes(False)) + "\n" + O.finalize(cols, inner)


def _stats_union_cte(name: str, grain: str, per_hour: bool, pricing: str = "CPM") -> str:
    parts = []
    for fam in ("imps", "convs", "defaults"):
        _, inner = _family_sql(grain, fam, per_hour, pricing)
        parts.append(f"({inner})")
    return f"{name} AS ({' UNION ALL BY NAME '.join(parts)})"


def _stat_cols(grain: str) -> list[str]:
    g = ru.GRAINS[grain]
    return ru.stat_columns(g)


def _o_union(grain: str) -> str:
    sql = O.with_fixtures(*_span_ctes(False), _stats_union_cte("hs", grain, False))
    return sql + "\n" + O.finalize(_stat_cols(grain), "SELECT * FROM hs")


def _o_hourly_backfill(grain: str = "hourly") -> str:
    sql = O.with_fixtures(*_span_ctes(True), _stats_union_cte("hs", grain, True))
    return sql + "\n" + O.finalize(_stat_cols(grain), "SELECT * FROM hs")


def _o_hourly_job() -> str:
    """All that the job stores, from one literal statement per table."""
    stats = [_stats_union_cte(n, n, True) for n in ru.GRAINS]
    sql = O.with_fixtures(*_span_ctes(True), *stats, f"daily AS ({_daily_select('hourly', DAY_OF_HOUR)})")
    parts = []
    for name, (at, texts) in JOB_TABLES.items():
        cells = ["array_to_string(CASE WHEN keywords = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(keywords, ',') END, ',')" if c == "keywords"
                 else f"CAST({c} AS VARCHAR)" for c in texts]
        body = ", ".join(f"COALESCE({c}, '~')" for c in cells)
        parts.append(f"SELECT '{name}' AS table_name, {at} AS at, concat_ws('|', {body}) AS body, {O.R('spend')} AS spend, "
                     f"{O.R('clearprice')} AS clearprice FROM {name.removesuffix('adstats')}")
    return sql + "\n" + "\nUNION ALL ".join(parts)


DAILY_GROUP = ["advertiser", "campaign", "adv_clique", "publisher", "site", "pub_clique"]
DAILY_OUT = ["date", *DAILY_GROUP, "bids", "imps", "defaults", "clearprice", "spend", "clicks",
             "view_convs", "click_convs"]


def _daily_select(src_name: str, date_expr: str, where: str = "TRUE") -> str:
    longs = ["bids", "imps", "defaults", "clicks", "view_convs", "click_convs"]
    aggs = [f"CAST(COALESCE(SUM({c}), 0) AS BIGINT) AS {c}" for c in longs]
    aggs += ["CAST(COALESCE(SUM(spend), 0) AS DOUBLE) AS spend", "AVG(clearprice) AS clearprice"]
    return (f"SELECT {date_expr} AS date, {', '.join(DAILY_GROUP)}, {', '.join(aggs)} "
            f"FROM {src_name} WHERE {where} GROUP BY ALL")


def _o_dailyadstats() -> str:
    sql = O.with_fixtures(*_span_ctes(False), _stats_union_cte("hs", "hourly", False))
    where = f"hour >= {O.T(START)} AND hour < {O.T(START + timedelta(days=1))}"
    inner = _daily_select("hs", O.T(START), where)
    return sql + "\n" + O.finalize(DAILY_OUT, inner)


def _o_daily_backfill() -> str:
    sql = O.with_fixtures(*_span_ctes(True), _stats_union_cte("hs", "hourly", True))
    return sql + "\n" + O.finalize(DAILY_OUT, _daily_select("hs", DAY_OF_HOUR))


DAY_OF_HOUR = "date_trunc('day', hour)"


def _o_daily_upsert() -> str:
    keys = ["date"] + DAILY_GROUP
    match = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in keys)
    sql = O.with_fixtures(
        *_span_ctes(True), _stats_union_cte("hs", "hourly", True),
        f"old AS ({_daily_select('hs', DAY_OF_HOUR, 'date_part(' + repr('hour') + ', hour) < 12')})",
        f"new AS ({_daily_select('hs', DAY_OF_HOUR, 'date_part(' + repr('hour') + ', hour) >= 6')})",
        f"merged AS (SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {match}) "
        f"UNION ALL BY NAME SELECT * FROM new)")
    return sql + "\n" + O.finalize(DAILY_OUT, "SELECT * FROM merged")


def _o_latest_n() -> str:
    cols = _stat_cols("hourly")
    order = ", ".join(["hour DESC NULLS LAST"] + [f"{c} ASC NULLS FIRST" for c in cols if c != "hour"])
    sql = O.with_fixtures(*_span_ctes(True), _stats_union_cte("hs", "hourly", True))
    return sql + "\n" + O.finalize(cols, f"SELECT * FROM hs ORDER BY {order} LIMIT {NEWEST_LIMIT}")


def _o_retention() -> str:
    return f"""SELECT o_orderkey, o_custkey, o_orderdate FROM (
  SELECT o_orderkey, o_custkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn > {RETAIN}"""


def _o_retention_by_prefix() -> str:
    return f"""WITH prefixes AS (SELECT DISTINCT prefix FROM (
    SELECT string_split(p_name, ' ')[1] AS prefix FROM part
    UNION ALL SELECT p_name[1:2] FROM part WHERE p_partkey % 7 = 0 UNION ALL SELECT p_name[1:7] FROM part WHERE p_partkey % 7 = 0)),
  matched AS (SELECT p_partkey, p_name, p_size, prefix, row_number() OVER (PARTITION BY p_partkey ORDER BY length(prefix) DESC) AS nth
              FROM part JOIN prefixes ON starts_with(p_name, prefix)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY p_size DESC, p_partkey DESC) AS rn FROM matched WHERE nth = 1)
SELECT p_partkey, p_name, p_size, prefix FROM ranked WHERE rn > {RETAIN}"""


def _o_largest_n() -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, {O.R("l_extendedprice")} AS l_extendedprice FROM (
  SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT {NEWEST_LIMIT})"""


def _o_migration_verified() -> str:
    day = f"DATE '{DAMAGED.date()}'"
    parts = []
    for name in MIGRATED:
        for phase in ("damaged", "resumed"):
            hurt = f"d = {day}" if phase == "damaged" and name in ("actions", "clicks") else "false"
            parts.append(f"SELECT '{phase}' AS phase, '{name}' AS table_name, d AS day, n AS n_source, "
                         f"n - CASE WHEN '{name}' = 'clicks' AND {hurt} THEN 1 ELSE 0 END AS n_copy, NOT ({hurt}) AS equal "
                         f"FROM (SELECT CAST(tstamp AS DATE) AS d, count(*) AS n FROM {name} GROUP BY 1)")
    return O.with_fixtures() + "\n" + "\nUNION ALL ".join(parts)


def _o_time_range() -> str:
    return O.with_fixtures() + (f"\nSELECT tstamp, actionid, uuid, advertiser, actionbeacon, {O.R("value")} AS value "
                                f"FROM actions WHERE tstamp >= {O.T(WEEK.start)} AND tstamp < {O.T(WEEK.end)}")


def _o_widened() -> str:
    ws, we = O.T(WEEK.start - timedelta(hours=1)), O.T(WEEK.end + timedelta(hours=1))
    return O.with_fixtures() + (f'\nSELECT tstamp, bidid, "auctionId", impid, adv_clique, {O.R("bid")} AS bid '
                                f"FROM bids WHERE tstamp >= {ws} AND tstamp < {we}")


def _o_lookback() -> str:
    lo = O.T(WEEK.end - timedelta(days=WEEK_LOOKBACK))
    return O.with_fixtures() + (f'\nSELECT tstamp, "auctionId", impid, uuid, advertiser, campaign, creativegroup, '
                                f"creative, adv_clique FROM impressions WHERE tstamp >= {lo}")


def _o_user_lookback() -> str:
    top = (f"SELECT uuid FROM actions WHERE tstamp >= {O.T(WEEK.start)} AND tstamp < {O.T(WEEK.end)} GROUP BY uuid "
           f"ORDER BY sum(CAST(value AS DECIMAL(38, 6))) DESC NULLS LAST, uuid LIMIT {TOP_USERS}")
    return _o_lookback() + f" AND uuid IN ({top})"


def _contents_sql(plan: dict, sources: dict[str, str] | None = None) -> str:
    parts = []
    for name, (at, texts, amount) in plan.items():
        body = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in texts)
        parts.append(f"SELECT '{name}' AS table_name, CAST({at or 'NULL'} AS TIMESTAMP) AS at, concat_ws('|', {body}) AS body, "
                     f"{O.R(f'CAST({amount} AS DOUBLE)') if amount else 'CAST(NULL AS DOUBLE)'} AS amount FROM {(sources or {}).get(name, name)}")
    return "\nUNION ALL ".join(parts)


def _o_migration() -> str:
    return O.with_fixtures() + "\n" + _contents_sql(MIGRATED)


def _o_environment_sync() -> str:
    sql = O.with_fixtures(*_span_ctes(True), _stats_union_cte("hs", "hourly", True),
                          f"dl AS ({_daily_select('hs', DAY_OF_HOUR)})")

    def newest(cols, src, field):
        order = ", ".join([f"{field} DESC NULLS LAST"] + [f"{c} ASC NULLS FIRST" for c in cols if c != field])
        return f"({O.finalize(cols, f'SELECT * FROM {src} ORDER BY {order} LIMIT {SYNC_LIMIT}')})"

    return sql + "\n" + _contents_sql(SYNCED, {
        "advertisers": "supplier", "cliques": "customer", "dailyadstats": newest(DAILY_OUT, "dl", "date"),
        "hourlyadstats": newest(_stat_cols("hourly"), "hs", "hour")})


ORACLES: dict[str, str] = {
    "auction_stats": _o_auction_stats(),
    "auction_stats_defaults": _o_auction_defaults(),
    "auction_stats_hourly": _o_auction_hourly(),
    "anti_join_losers": _o_losers(),
    "imp_matched_actions": _o_matched(O.imp_matched_cte("mt", START, END, LOOKBACK), O.IMP_COLS),
    "click_matched_actions": _o_matched(O.click_matched_cte("mt", START, END, LOOKBACK), O.CLICK_COLS),
    "imp_matched_actions_hourly": _o_matched(O.imp_matched_hourly_cte("mt", WEEK_LOOKBACK), O.IMP_COLS),
    "click_matched_actions_hourly": _o_matched(O.click_matched_hourly_cte("mt", WEEK_LOOKBACK), O.CLICK_COLS),
}
for _g in ("hourly", "geo", "keyword"):
    ORACLES[f"{_g}_cpm"] = _o_rollup(_g, "imps", "CPM")
    ORACLES[f"{_g}_cpc"] = _o_rollup(_g, "imps", "CPC")
    ORACLES[f"{_g}_actions"] = _o_rollup(_g, "convs")
    ORACLES[f"{_g}_defaults"] = _o_rollup(_g, "defaults")
ORACLES.update({
    "hourlyadstats_all": _o_union("hourly"),
    "geoadstats_all": _o_union("geo"),
    "keywordadstats_all": _o_union("keyword"),
    "hourly_backfill": _o_hourly_backfill(),
    "hourly_job": _o_hourly_job(),
    "hourly_job_rerun": _o_hourly_job(),
    "keyword_backfill": _o_hourly_backfill("keyword"),
    "dailyadstats": _o_dailyadstats(),
    "daily_backfill": _o_daily_backfill(),
    "daily_upsert": _o_daily_upsert(),
    "keyed_upsert": _o_daily_upsert(),
    "latest_n_sync": _o_latest_n(),
    "retention_keep_n": _o_retention(),
    "retention_by_prefix": _o_retention_by_prefix(),
    "asof_blank_users": O.with_fixtures() + """,
  a AS (SELECT actionid, CASE WHEN CAST(uuid[2:] AS BIGINT) % 3 = 0 THEN '' ELSE uuid END AS uuid, advertiser, tstamp FROM actions),
  i AS (SELECT CASE WHEN CAST(uuid[2:] AS BIGINT) % 3 = 0 THEN '' ELSE uuid END AS uuid, advertiser, tstamp FROM impressions)
SELECT a.actionid, a.uuid, a.advertiser, a.tstamp, max(i.tstamp) AS touch_tstamp
FROM a LEFT JOIN i ON i.uuid = a.uuid AND i.advertiser = a.advertiser AND i.tstamp <= a.tstamp GROUP BY ALL""",
    "append_rows": "SELECT * FROM orders",
    "largest_n": _o_largest_n(),
    "migration_verified": _o_migration_verified(),
    "time_range_scan": _o_time_range(),
    "widened_scan": _o_widened(),
    "lookback_scan": _o_lookback(),
    "user_lookback": _o_user_lookback(),
    "copy_once": "SELECT * FROM orders",
    "table_migration": _o_migration(),
    "environment_sync": _o_environment_sync(),
    "rfc3339_parse": """SELECT event_id, CAST(ts AS TIMESTAMP) - CASE event_id % 3 WHEN 1 THEN INTERVAL 330 MINUTES
        WHEN 2 THEN INTERVAL (-8) HOURS ELSE INTERVAL 0 HOURS END AS utc FROM events""",
    "cell_decode": f"""SELECT l_returnflag AS flag, CAST(l_orderkey AS BIGINT) AS orderkey,
        {O.R("CAST(l_extendedprice AS DOUBLE)")} AS price, l_linenumber % 2 = 0 AS even,
        CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_seconds(l_linenumber) AS shipped FROM lineitem""",
})
