"""Sinks (K1-K6): partition overwrite, keyed upsert, replace, copy-once.

``overwrite_partitions`` replaces the partitions present in a frame, which
suits a sink that is fed one kind of rows at a time.  A job that owns an
interval of a table writes it with ``owned.replace_span``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbid.functions import day_floor
from clearbid.operators.daily import upsert
from clearbid.schemas import DAILY_KEYS
from clearbid.session import scratch_dir
from clearbid.sources.owned import stored


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """K1 (idempotent form): replace only the partitions present in ``df``.

    Rows are clustered by the partition columns with a ``rebalance`` hint:
    under AQE a large partition (a busy hour) is split across several write
    tasks at the advisory size and small ones are coalesced, so neither one
    task writes a whole hour nor do small hours scatter into many files.
    """
    (df.hint("rebalance", *partition_cols)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).parquet(path))


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> bool:
    """K1/K2 as in the reference: append, skip the write when there is no row."""
    if df.isEmpty():
        return False
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return True


def replace(df: DataFrame, path: str) -> None:
    """K4: the target becomes exactly the source (empty source -> empty target)."""
    df.write.mode("overwrite").parquet(path)


def copy_once(df: DataFrame, path: str) -> bool:
    """K5: copy only when the target does not exist yet or holds no row."""
    there = stored(df.sparkSession, path)
    if there is not None and not there.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def upsert_daily(spark: SparkSession, new_rows: DataFrame, path: str, keys: tuple[str, ...] = tuple(DAILY_KEYS)) -> dict[str, int]:
    """K3/C18: upsert daily rows into a ``date``-partitioned table.

    Only the dates present in ``new_rows`` are read, merged (null-safe keys,
    stale keys kept, fields that the new rows lack keep their old values) and
    rewritten; ``new_rows`` is computed once.  Returns how many rows were
    updated and inserted.  The merged rows are first written to a
    staging folder under the shared checkpoint folder, which cuts the lineage
    to the partitions being replaced, so a failed task can never lose rows of
    the target.
    """
    staged_new = scratch_dir(spark, "daily-new")
    dated = new_rows.withColumn("date", day_floor("date"))
    dated.write.mode("overwrite").parquet(staged_new)
    new_rows = read_written(spark, staged_new, dated.schema, must_exist=True)
    total = new_rows.count()
    schema = new_rows.schema
    updated = 0
    day = {"day": T.DateType()}
    there = stored(spark, path)
    if there is not None:
        # fields of the target that the new rows lack belong to the merged schema too
        have = there.schema
        schema = T.StructType([*schema.fields, *[f for f in have.fields if f.name not in {*schema.names, "day"}]])
        # semi-join on the partition column: dynamic partition pruning reads
        # only the touched days of the target
        days = new_rows.select(F.to_date("date").alias("day")).distinct()
        old = read_written(spark, path, schema, day).join(days, "day", "left_semi")
        old = old.select(*schema.names)
        merged = upsert(old, new_rows, list(keys))
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
        both = same[0]
        for c in same[1:]:
            both = both & c
        updated = new_rows.alias("n").join(old.select(*keys).distinct().alias("o"), both, "left_semi").count()
    else:
        merged = new_rows
    stage = scratch_dir(spark, "daily-upsert")
    merged.write.mode("overwrite").parquet(stage)
    staged = read_written(spark, stage, schema, must_exist=True)
    overwrite_partitions(staged.withColumn("day", F.to_date("date")), path, ["day"])
    return {"updated": updated, "inserted": total - updated}


def read_written(spark: SparkSession, path: str, schema: T.StructType,
                 partition_cols: dict[str, T.DataType] | None = None, must_exist: bool = False) -> DataFrame:
    """Read a table this package wrote, with its declared schema.

    Declaring the schema keeps partition values typed and lets a run that wrote no row read back an empty
    table instead of failing schema inference.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(n, t, True)
                                               for n, t in (partition_cols or {}).items()])
    there = stored(spark, path, full)
    if there is None and must_exist:   # this run has just written it
        raise FileNotFoundError(path)
    return spark.createDataFrame([], full) if there is None else there
