"""Benchmark the headline queries.

Reads the driver tables at $BENCH_SF_DIR (default /root/testdata/sf0.1),
derives the ad tables once and writes them as date-partitioned Parquet in a
fresh scratch folder (the production input layout), then times each query as
a full execution (``write.format("noop")``) on ``local[$BENCH_CPUS]``.

``queries`` holds the built forms; ``naive_*`` entries time the formulations
three separate joins for three grains, one job per hour).  ``value`` is the
sum of the built forms (median of $BENCH_REPEAT runs each, after
$BENCH_WARMUP warm-up runs that let the JIT settle).

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime, timedelta

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clearbid.functions import Interval  # noqa: E402
from clearbid.operators import attribution as attr  # noqa: E402
from clearbid.operators import auctions as auc  # noqa: E402
from clearbid.operators import rollups as ru  # noqa: E402
from clearbid.plans import hourly as hourly_job  # noqa: E402
from clearbid.plans import jobs  # noqa: E402
from clearbid.session import build_session, scratch_dir, written  # noqa: E402
from clearbid.sources.fixtures import write_ad_tables  # noqa: E402

SPAN = Interval(datetime(2024, 1, 1), datetime(2024, 1, 31))
LOOKBACK = 30
DAY = datetime(2024, 1, 15)
BACKFILL_HOURS = 6


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


# ----------------------------------------------------------- naive formulations

def naive_second_price(t: jobs.AdTables, iv: Interval) -> DataFrame:
    """Group max by aggregation, self-join to mark winners, left join (reference form)."""
    wide = iv.widened(1)
    b = t.bids.filter(wide.contains("tstamp"))
    m = b.groupBy("auctionId", "impid", "adv_clique").agg(F.max("bid").alias("mx"))
    win = b.join(m, ["auctionId", "impid", "adv_clique"]).filter(F.col("bid") == F.col("mx")).select("bidid")
    win = win.withColumn("_w", F.lit(1))
    a = t.auctions.filter(iv.contains("tstamp") & (F.col("level") == "info"))
    i = t.impressions.filter(wide.contains("tstamp")).select("impid", "adv_clique")
    j = (a.join(i, "impid").join(b.select("bidid", "auctionId", "impid", "adv_clique", "bid"),
                                 ["auctionId", "impid", "adv_clique"])
         .join(win, "bidid", "left"))
    g = j.groupBy("tstamp", "auctionId", "uuid", "impid").agg(
        F.count("bidid").alias("num_bids"), F.max("bid").alias("max_bid"),
        F.max(F.when(F.col("_w").isNull(), F.col("bid")) + F.lit(0.01)).alias("cp"))
    return g.select("tstamp", "auctionId", "uuid", "impid", "num_bids", "max_bid",
                    F.coalesce("cp", "max_bid").alias("clearprice"))


def naive_last_touch(t: jobs.AdTables, iv: Interval, lookback: int) -> DataFrame:
    """Every action joined to every earlier touch of its user, max, re-join, rank."""
    lo = iv.lookback_from_end(lookback)
    acts = t.actions.filter(iv.contains("tstamp"))
    imps = t.impressions.filter(F.col("tstamp") >= F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    pairs = acts.alias("x").join(imps.alias("i"), ["uuid", "advertiser"]).filter(F.col("i.tstamp") <= F.col("x.tstamp"))
    m = pairs.groupBy("actionid", F.col("x.tstamp").alias("action_tstamp"), "uuid", "advertiser",
                      "actionbeacon", "value").agg(F.max("i.tstamp").alias("imp_tstamp"))
    hit = (m.join(imps.select("uuid", "advertiser", F.col("tstamp").alias("imp_tstamp"), "impid", "campaign",
                              "creativegroup", "creative", "adv_clique"),
                  ["uuid", "advertiser", "imp_tstamp"])
           .join(t.auctions.filter(F.col("tstamp") >= F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
                 .select("impid", *attr.PUB_COLS), "impid"))
    w = Window.partitionBy("actionid").orderBy("impid")
    return hit.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(*attr.IMP_OUTPUT)


def naive_three_grains(t: jobs.AdTables, mid: jobs.Intermediates, iv: Interval) -> list[DataFrame]:
    out = []
    for g in (ru.HOURLY, ru.GEO, ru.KEYWORD):
        j = ru.joined_impressions(t.auctions, t.impressions, mid.auction_stats, t.clicks, iv)
        out.append(ru.imps_clicks(j, g))
    return out


# -------------------------------------------------------------------- harness

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2, cpus))
    # below the shared checkpoint folder the session names (a private one only if unset)
    scratch = scratch_dir(spark, "bench")

    t0 = time.time()
    paths = write_ad_tables(spark, sf_dir, os.path.join(scratch, "ad"))
    prep = time.time() - t0
    t = jobs.AdTables.of({k: spark.read.parquet(v) for k, v in paths.items()})
    mid = jobs.intermediates(t, SPAN, False, LOOKBACK, LOOKBACK)
    day_hours = [DAY + timedelta(hours=h) for h in range(BACKFILL_HOURS)]
    backfill_span = Interval(DAY, DAY + timedelta(hours=BACKFILL_HOURS))

    def stats_written() -> DataFrame:
        return spark.read.parquet(stats_path)

    stats_path = os.path.join(scratch, "auction_stats")
    mid.auction_stats.write.mode("overwrite").parquet(stats_path)

    def three_grains_shared():
        grains = (ru.HOURLY, ru.GEO, ru.KEYWORD)   # as the hourly job: one aggregation, written, read per grain
        j = ru.joined_impressions(t.auctions, t.impressions, stats_written(), t.clicks, SPAN)
        sets = written(ru.imps_clicks_sets(j, grains), "bench-sets")
        for g in grains:
            run(ru.of_set(sets, g, grains))

    def three_grains_naive():
        m = jobs.Intermediates(stats_written(), mid.imp_matched_actions, mid.click_matched_actions)
        for df in naive_three_grains(t, m, SPAN):
            run(df)

    def backfill_one_job():
        run(jobs.hourly_backfill(t, backfill_span))

    def backfill_loop():
        for h in day_hours:
            run(jobs.stats_table(t, ru.HOURLY, Interval(h, h + timedelta(hours=1)), per_hour=False))

    built = {
        "auction_stats": lambda: run(auc.auction_stats(t.auctions, t.impressions, t.bids, SPAN)),
        "auction_stats_hourly": lambda: run(auc.auction_stats_hourly(t.auctions, t.impressions, t.bids)),
        "imp_matched_actions": lambda: run(attr.imp_matched_actions(t.impressions, t.actions, t.auctions,
                                                                    SPAN, LOOKBACK)),
        "click_matched_actions": lambda: run(attr.click_matched_actions(t.clicks, t.actions, t.auctions,
                                                                        SPAN, LOOKBACK)),
        "hourly_cpm": lambda: run(ru.imps_clicks(ru.joined_impressions(
            t.auctions, t.impressions, stats_written(), t.clicks, SPAN), ru.HOURLY)),
        "three_grains": three_grains_shared,
        "hourly_actions": lambda: run(jobs.grain_frames(t, mid, ru.HOURLY, SPAN, False)["convs"]),
        "hourly_backfill_6h": backfill_one_job,
        "hourly_backfill_all": lambda: run(jobs.hourly_backfill(t)),
        "daily_backfill": lambda: run(jobs.daily_backfill(jobs.hourly_backfill(t))),
        "hourly_job_written": lambda: hourly_job.run(spark, t, scratch_dir(spark, "bench-job"),
                                                     Interval(DAY, DAY + timedelta(hours=1))),
    }
    naive = {
        "naive_second_price": lambda: run(naive_second_price(t, SPAN)),
        "naive_last_touch": lambda: run(naive_last_touch(t, SPAN, LOOKBACK)),
        "naive_three_grains": three_grains_naive,
        "naive_backfill_6h_loop": backfill_loop,
    }

    timings: dict[str, float] = {}
    pairs = {"auction_stats": "naive_second_price", "imp_matched_actions": "naive_last_touch",
             "three_grains": "naive_three_grains", "hourly_backfill_6h": "naive_backfill_6h_loop"}
    # each built form alternates with its naive form, so neither gets the warmer JVM
    for name, fn in built.items():
        turn = {name: fn, **({pairs[name]: naive[pairs[name]]} if name in pairs else {})}
        runs: dict[str, list[float]] = {k: [] for k in turn}
        for _ in range(warmup + repeat):
            for k, f in turn.items():
                s = time.time()
                f()
                runs[k].append(time.time() - s)
        for k, v in runs.items():
            timings[k] = round(statistics.median(v[warmup:]), 3)

    total = round(sum(timings[k] for k in built), 3)
    print(json.dumps({
        "metric": "sum_median_sec_built_queries",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "built_to_naive": {k: round(timings[k] / timings[v], 2) for k, v in pairs.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
        "repeat": repeat,
        "warmup": warmup,
        "prepare_sec": round(prep, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
