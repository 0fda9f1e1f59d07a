"""The hourly job (C19) and its one-job backfill form (C20, C21).

One run for ``[start, end)``:

1. intermediates - auction_stats (priced ∪ errored), imp_matched_actions,
   click_matched_actions - are written;
2. the imps/clicks join (auctions ⋈ impressions ⋈ auction_stats ⟕ clicks) is
   aggregated for the hourly, geo and keyword grains at once (grouping sets),
   and the small result is written; conversions and defaults are joined once as well;
3. each stats table gets its three row kinds in one write, ``kind`` being a
   plain column;
4. the run's hours are reduced to mergeable partials, and every UTC day it
   touches is merged from the day's partials, which replaces the day in
   ``dailyadstats``.

Every table is kept by ``sources.owned``: rows by UTC day, ``hour`` a sorted
column, and a run's rows shown once it has written all of them; a run that dies
leaves each table as it was or replaced as a whole, and re-runs are idempotent.

``per_hour=True`` runs any span as if it were a loop of one-hour runs (each
row labelled with its own hour and bounded by its own hour's lookback), but
as one Spark job per table instead of one job per hour.

Written tables are the lineage cuts: a lost executor recomputes at most the
current stage from the last written table in the shared folder.
"""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbid import schemas as S

from clearbid.functions import Interval, hour_floor, ts_lit
from clearbid.operators import rollups as ru
from clearbid.operators.daily import daily_partials, merge_partials
from clearbid.plans.jobs import DEFAULT_LOOKBACK_DAYS, AdTables, grain_frames, intermediates
from clearbid.session import SESSION_DEFAULTS, ensure_checkpoint_dir, written
from clearbid.sources.owned import read_owned, replace_span

STATS_TABLES = {"hourly": "hourlyadstats", "geo": "geoadstats", "keyword": "keywordadstats"}


def _hour_col(per_hour: bool, interval: Interval, ts: str):
    return hour_floor(ts) if per_hour else ts_lit(interval.start)


def run(spark: SparkSession, tables: AdTables, out_root: str, interval: Interval,
        pricing: str = ru.CPM, per_hour: bool = False,
        view_lookback: int = DEFAULT_LOOKBACK_DAYS,
        click_lookback: int = DEFAULT_LOOKBACK_DAYS,
        grains: tuple[ru.Grain, ...] = (ru.HOURLY, ru.GEO, ru.KEYWORD),
        history_hours: int | None = None) -> dict[str, str]:
    """Run the hourly job for ``interval``; returns table name -> path.

    ``history_hours`` leaves out impressions, clicks and defaults older than so
    many hours before the interval (see ``rollups``); None joins them whole.
    """
    if pricing not in (ru.CPM, ru.CPC):
        warnings.warn(f"pricing {pricing!r} is unknown, falling back to {ru.CPM}", stacklevel=2)
        pricing = ru.CPM
    with _sharing_partitions(spark):
        return _run(spark, tables, out_root, interval, pricing, per_hour, view_lookback, click_lookback, grains, history_hours)


@contextmanager
def _sharing_partitions(spark: SparkSession) -> Iterator[None]:
    """Joins on more columns than the impid use a partitioning by impid, whatever the session says: all writes of a run fall inside."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, SESSION_DEFAULTS[name])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _run(spark: SparkSession, tables: AdTables, out_root: str, interval: Interval, pricing: str, per_hour: bool,
         view_lookback: int, click_lookback: int, grains: tuple[ru.Grain, ...], history_hours: int | None) -> dict[str, str]:
    if per_hour and any((t.minute, t.second, t.microsecond) != (0, 0, 0) for t in (interval.start, interval.end)):
        raise ValueError("a per-hour run replaces whole hours: its bounds must be full hours")
    paths = {n: os.path.join(out_root, n) for n in
             ["auction_stats", "imp_matched_actions", "click_matched_actions", "dailyadstats", "dailypartials",
              *[STATS_TABLES[g.name] for g in grains]]}

    # hours this run owns: a single-interval run labels all its rows with the start
    owned = (interval.start, interval.end) if per_hour else (interval.start, interval.start + timedelta(microseconds=1))

    # 1. intermediates, labelled with the hour they belong to and read back: rows of other
    # hours are other runs' (a slot's stats are made by the run of its auction's hour)
    mid = intermediates(tables, interval, per_hour, view_lookback, click_lookback)
    stored = {}
    for name, ts, schema in (("auction_stats", "tstamp", S.AUCTION_STATS), ("imp_matched_actions", "action_tstamp", S.IMP_MATCHED_ACTIONS),
                             ("click_matched_actions", "action_tstamp", S.CLICK_MATCHED_ACTIONS)):
        replace_span(getattr(mid, name).withColumn("hour", _hour_col(per_hour, interval, ts)), paths[name], "hour", *owned)
        stored[name] = read_intermediate(spark, paths[name], schema, *owned)
    stored = type(mid)(**stored)

    # 2. the shared imps/clicks join, aggregated once for all grains
    joined = ru.joined_impressions(tables.auctions, tables.impressions, stored.auction_stats,
                                   tables.clicks, interval, per_hour, history_hours)
    sets = written(ru.imps_clicks_sets(joined, grains, pricing), "imps-clicks")

    # likewise the conversions and the defaults; only some grains fetch dims of conversions from auctions
    fetching = tuple(g for g in grains if g.auction_extra)
    convs = written(ru.joined_conversions(stored.imp_matched_actions, stored.click_matched_actions, grains, interval, per_hour),
                    "conversions")
    conv_sets = written(ru.conversions_sets(convs, fetching, tables.auctions, interval.start - timedelta(days=view_lookback)),
                        "conversion-sets") if fetching else None
    dflt_sets = written(ru.defaults_sets(tables.auctions, tables.auction_defaults, grains, interval, per_hour, history_hours),
                        "default-sets")

    # 3. three row kinds per grain
    for g in grains:
        frames = grain_frames(tables, stored, g, interval, per_hour, pricing, imps=ru.of_set(sets, g, grains),
                              convs=ru.conversions_of(convs, conv_sets, g, fetching),
                              dflts=ru.defaults_of(dflt_sets, g, grains),
                              view_lookback=view_lookback, history_hours=history_hours)
        u = None
        for kind in ("imps", "convs", "defaults"):
            rows = frames[kind].withColumn("kind", F.lit(kind))
            u = rows if u is None else u.unionByName(rows, allowMissingColumns=True)
        replace_span(u.select(*ru.stat_columns(g), "kind"), paths[STATS_TABLES[g.name]], "hour", *owned)

    # 4. partials of the run's own hours; every touched day is merged from all its hours' partials
    days = interval.days()
    if ru.HOURLY in grains and days:
        whole = (days[0], days[-1] + timedelta(days=1))
        own = read_stats(spark, paths["hourlyadstats"], ru.HOURLY, *owned)
        replace_span(daily_partials(own), paths["dailypartials"], "hour", *owned)
        touched = read_owned(spark, paths["dailypartials"], S.DAILY_PARTIALS, "hour", *whole)
        replace_span(merge_partials(touched), paths["dailyadstats"], "date", *whole)
    return paths


def backfill(spark: SparkSession, tables: AdTables, out_root: str, interval: Interval,
             pricing: str = ru.CPM, view_lookback: int = DEFAULT_LOOKBACK_DAYS,
             click_lookback: int = DEFAULT_LOOKBACK_DAYS, history_hours: int | None = None) -> dict[str, str]:
    """Hourly backfill of a span: every hour in one job per table."""
    return run(spark, tables, out_root, interval, pricing, per_hour=True, view_lookback=view_lookback,
               click_lookback=click_lookback, history_hours=history_hours)


def stats_schema(grain: ru.Grain) -> T.StructType:
    """Declared schema of a stored stats table."""
    types = {f.name: f.dataType for f in S.MEASURES.fields}
    types |= {"hour": T.TimestampNTZType(), "keywords": T.ArrayType(T.StringType()), "DMA": T.LongType()}
    fields = [T.StructField(c, types.get(c, T.StringType()), True) for c in ru.stat_columns(grain)]
    return T.StructType([*fields, T.StructField("kind", T.StringType(), True)])


def read_stats(spark: SparkSession, path: str, grain: ru.Grain = ru.HOURLY, lo: datetime | None = None,
               hi: datetime | None = None) -> DataFrame:
    """A stats table with its ``kind``, or its hours in ``[lo, hi)``."""
    return read_owned(spark, path, stats_schema(grain), "hour", lo, hi)


def read_daily(spark: SparkSession, path: str, lo: datetime | None = None, hi: datetime | None = None) -> DataFrame:
    return read_owned(spark, path, S.DAILYADSTATS, "date", lo, hi)


def read_intermediate(spark: SparkSession, path: str, schema: T.StructType, lo: datetime | None = None,
                      hi: datetime | None = None) -> DataFrame:
    """An intermediate table, or its rows labelled with the hours in ``[lo, hi)``."""
    full = T.StructType([*schema.fields, T.StructField("hour", T.TimestampNTZType())])
    return read_owned(spark, path, full, "hour", lo, hi).drop("hour")


def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files clearbid.zip clearbid/plans/hourly.py --tables ROOT --out ROOT``.

    Reads the six ad tables below ``--tables``; the interval defaults to the
    last full UTC hour; ``--backfill`` labels every hour of the interval.
    """
    import argparse

    from clearbid.sources.tables import read_table

    p = argparse.ArgumentParser(description="hourly ad stats job")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--start", help="UTC '%%Y-%%m-%%d %%H:%%M:%%S', inclusive")
    p.add_argument("--end", help="UTC '%%Y-%%m-%%d %%H:%%M:%%S', exclusive")
    p.add_argument("--pricing", default=ru.CPM)
    p.add_argument("--view-lookback", type=int, default=DEFAULT_LOOKBACK_DAYS)
    p.add_argument("--click-lookback", type=int, default=DEFAULT_LOOKBACK_DAYS)
    p.add_argument("--backfill", action="store_true")
    p.add_argument("--history-hours", type=int, help="leave out impressions, clicks and defaults older than this before the interval")
    args = p.parse_args(argv)
    default = Interval.default()
    interval = Interval(args.start or default.start, args.end or default.end)
    builder = SparkSession.builder.appName("clearbid-hourly")
    for key, value in SESSION_DEFAULTS.items():   # master and sizes come from spark-submit
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    tables = AdTables.of({n: read_table(spark, args.tables, n) for n in AdTables.__dataclass_fields__})
    run(spark, tables, args.out, interval, args.pricing, per_hour=args.backfill,
        view_lookback=args.view_lookback, click_lookback=args.click_lookback, history_hours=args.history_hours)


if __name__ == "__main__":
    main()
