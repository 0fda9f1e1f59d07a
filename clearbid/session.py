"""Spark session defaults and the shared scratch location.

The operators never depend on these settings for correctness (all times are
``timestamp_ntz``, so the session time zone does not shift values); the
settings only shape the physical plan.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that shape plans for the ad tables.
#  * AQE re-plans joins from real shuffle sizes, coalesces small partitions and
#    splits skewed join partitions.
#  * requireAllClusterKeysForCoPartition=false lets the impid-keyed joins
#    (auctions, impressions, auction_stats on (impid, auctionId), clicks) share
#    one hash partitioning on impid instead of re-shuffling for the two-key join.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "clearbid", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's directory) from the
    session; only when neither is set on a local master (tests) a private
    folder is made.  On any other master an unset folder is an error: what
    executors wrote to their own disks would be missing to all others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is not set, and {master} needs a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="clearbid-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Used for written tables that cut lineage (staged upserts, copies) so that
    a lost executor never loses the only copy of an intermediate.
    """
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "clearbid", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back.

    A frame that a plan reads more than once is computed once, its size is
    known to the planner, and a lost executor costs a re-read.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
