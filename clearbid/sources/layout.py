"""Stored layouts that let readers skip: row groups by time and id (S2, S4), buckets by key (K3).

**Event tables.**  ``write_events`` keeps rows by UTC ``date``, sorted inside a file by time, with the
minute of the time as a whole number (``at_minute``) and Parquet bloom filters on the id columns.
Spark does not hand bounds on ``timestamp_ntz`` to the Parquet reader; bounds on a whole number do
reach it, so ``tables.bounded`` states them on ``at_minute`` too and row groups outside are not read.
A filter on a few ids skips row groups by their bloom filters or dictionaries.

**Keyed tables.**  ``upsert_keyed`` keeps a table bucketed by a hash of its upsert keys
(``upsert_key``), within the partitions of one column.  A merge shuffles the new rows to the
buckets and reads the target in them, so the target is not shuffled.  The hash only brings rows
together; the keys themselves decide, null matching null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbid.session import written
from clearbid.sources.owned import stored
from clearbid.sources.tables import at_minute, lookback

ID_COLUMNS = ("uuid", "impid")
ROW_GROUP_BYTES = 32 << 20
IDS_PER_GROUP = 500_000     # distinct ids of a row group that its bloom filter is sized for
LISTED_IDS = 1_000          # ids that a scan takes as a list; more of them belong in a semi-join
KEY = "upsert_key"


def write_events(df: DataFrame, path: str, ids: Iterable[str] = ID_COLUMNS, time: str = "tstamp",
                 row_group_bytes: int = ROW_GROUP_BYTES, ids_per_group: int = IDS_PER_GROUP) -> None:
    """Write an event table so that scans skip row groups by time and by id.

    A busy day is split over several tasks, each sorting its own rows; ids that
    ``df`` lacks are passed over, rows without a time have no date and stay.
    """
    rows = df.withColumn("at_minute", at_minute(time)).withColumn("date", F.to_date(time))
    out = (rows.hint("rebalance", "date").sortWithinPartitions("date", time)
           .write.mode("overwrite").partitionBy("date").option("parquet.block.size", row_group_bytes))
    for c in ids:
        if c in df.columns:
            out = (out.option(f"parquet.bloom.filter.enabled#{c}", "true")
                   .option(f"parquet.bloom.filter.expected.ndv#{c}", ids_per_group))
    out.parquet(path)


def lookback_of(df: DataFrame, ids: Iterable[str], anchor: datetime, days: int, column: str = "uuid") -> DataFrame:
    """S4 for a few users: rows of ``ids`` from ``days`` before ``anchor`` on; the ids reach the Parquet reader."""
    ids = sorted(set(ids))
    if len(ids) > LISTED_IDS:
        raise ValueError(f"{len(ids)} ids are too many for a list; use a semi-join")
    return lookback(df, anchor, days).filter(F.col(column).isin(ids))


def _hash(keys: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


@contextmanager
def _only_named_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace the partitions that they bring rows for, and no others."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def open_keyed(spark: SparkSession, path: str, schema: T.StructType, by: str, buckets: int) -> str:
    """Name of the catalog entry over a keyed table at ``path``; its files are untouched.

    The number of buckets is written beside the table when it is made and holds
    from then on, whatever a later caller asks for.
    """
    spec = stored(spark, f"{path}/_buckets", "buckets int")
    if spec is None:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/_buckets")
    else:
        buckets = spec.first()["buckets"]
    name = "clearbid_keyed_" + hashlib.md5(path.encode()).hexdigest()[:16]
    fields = [f for f in schema.fields if f.name not in (by, KEY)] + [T.StructField(KEY, T.LongType()), schema[by]]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{by}`) "
              f"CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return name


def merge_keyed(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose keys ``new`` lacks, and the rows of ``new``; both carry ``upsert_key``.

    Only ``new`` is moved: it is dealt by the key that ``target`` is bucketed by.
    """
    mine = new.select(KEY, *keys).distinct().select(F.col(KEY).alias("_k"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    same = target[KEY] == mine["_k"]
    for k in keys:
        same = same & target[k].eqNullSafe(mine[f"_k_{k}"])
    return target.join(mine, same, "left_anti").select(*target.columns).unionByName(new.select(*target.columns))


def upsert_keyed(new_rows: DataFrame, path: str, keys: list[str], by: str, buckets: int = 64) -> str:
    """K3: upsert into a table bucketed by ``keys`` and partitioned by ``by``, one of the keys.

    New rows replace rows of equal keys, null matching null, and other rows
    stay.  Only partitions that ``new_rows`` has are read and rewritten; they are
    swapped once all of their files are written.  ``new_rows`` is computed once;
    its keys should be distinct, since every row of it is kept.  No rows, no
    change.  Returns the catalog name.
    """
    if by not in keys:
        raise ValueError(f"partitions by {by}, which is no key: a key's rows could lie in two of them")
    spark, schema = new_rows.sparkSession, new_rows.schema
    new = written(new_rows.withColumn(KEY, _hash(keys)), "keyed-new")
    name = open_keyed(spark, path, schema, by, buckets)
    target = spark.table(name)
    held = [r[0] for r in new.select(by).distinct().collect()]   # partitions, as many folders as will be written
    if not held:
        return name
    known = [v for v in held if v is not None]
    within = F.col(by).isin(known) if known else F.lit(False)
    touched = target.filter(within | F.col(by).isNull() if len(known) < len(held) else within)
    with _only_named_partitions(spark):
        (merge_keyed(touched, new.repartition(KEY), keys).select(*target.columns)
         .write.mode("overwrite").insertInto(name))
    return name


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, by: str) -> DataFrame:
    """The rows of a keyed table with the columns of ``schema``."""
    return spark.table(open_keyed(spark, path, schema, by, 1)).select(*schema.names)
