"""Stored tables whose time spans belong to runs: write, commit, retire (K1, C19).

A run that replaces ``[start, end)`` of a table

1. **writes** its rows as new files below ``day=<UTC day>/run=<run>``; nothing that
   readers see is touched, and no reader sees the new files yet;
2. **commits** by adding one small file to ``_runs``: run, sequence number and span;
3. **retires** the folders of runs that own none of their day any more.

The owner of an instant is the last committed run whose span covers it, and
``read_owned`` shows each row only if its run owns its time.  So a run that dies
before step 2 leaves the table as it was, one that dies after it has replaced the
whole span, hours without a new row included, and running it again mends either.
What step 3 removes no reader can see; where files cannot be deleted
they only take room.  One run per table commits at a time.

Folders are by day, one file or a few per run and day, with the rows sorted by
time; an hour is a range of rows, not a folder.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException, PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbid.functions import ts_lit

MARKERS = "run string, seq bigint, lo timestamp_ntz, hi timestamp_ntz"
Span = tuple[datetime, datetime, str]


def stored(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none (no file, where no schema is given)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def paint(spans: list[Span], lo: datetime, hi: datetime, run: str) -> None:
    """Give ``[lo, hi)`` to ``run`` in a sorted list of disjoint spans."""
    first = bisect_right([s[1] for s in spans], lo)
    last = bisect_left([s[0] for s in spans], hi)
    keep = [(a, min(b, lo), r) for a, b, r in spans[first:last] if a < lo]
    keep.append((lo, hi, run))
    keep += [(max(a, hi), b, r) for a, b, r in spans[first:last] if b > hi]
    spans[first:last] = keep


def owners(spark: SparkSession, path: str, lo: datetime | None = None, hi: datetime | None = None) -> list[Span]:
    """Disjoint spans (from, to, run) of a table in time order, or those that meet ``[lo, hi)``.

    Markers are a few bytes for each run of the table, read by the driver.
    """
    markers = stored(spark, f"{path}/_runs", MARKERS)
    spans: list[Span] = []
    for m in [] if markers is None else sorted(markers.collect(), key=lambda m: (m.seq, m.run, m.lo)):
        paint(spans, m.lo, m.hi, m.run)
    return [s for s in spans if (lo is None or s[1] > lo) and (hi is None or s[0] < hi)]


def replace_span(df: DataFrame, path: str, label: str, start: datetime, end: datetime) -> str:
    """Make the rows of ``[start, end)`` by the time column ``label`` exactly those of ``df``; returns the run.

    ``df`` may read the table itself.  Rows outside the span are not shown.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    if start >= end:
        return run
    rows = df.withColumn("day", F.to_date(label)).withColumn("run", F.lit(run))
    (rows.hint("rebalance", "day").sortWithinPartitions("day", "run", label)
     .write.mode("append").partitionBy("day", "run").parquet(path))
    commit(spark, path, run, start, end)
    retire(spark, path)
    return run


def commit(spark: SparkSession, path: str, run: str, start: datetime, end: datetime) -> None:
    """One file of one row: it is there or it is not."""
    markers = stored(spark, f"{path}/_runs", MARKERS)
    last = None if markers is None else markers.agg(F.max("seq")).first()[0]
    row = spark.createDataFrame([(run, (last or 0) + 1, start, end)], MARKERS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/_runs")


def retire(spark: SparkSession, path: str) -> list[str]:
    """Delete the ``run=`` folders whose run owns nothing of their day; returns them.

    Spark has no call that removes files, so this goes through the session's
    Hadoop file system; a remote session has none and leaves the files.
    """
    try:
        context = spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):
        return []
    owned = {(day, run) for lo, hi, run in owners(spark, path) for day in _days(lo, hi)}
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(context._jsc.hadoopConfiguration())
    gone = []
    if not fs.exists(root):
        return gone
    for day in fs.listStatus(root):
        name = day.getPath().getName()
        if not name.startswith("day="):
            continue
        for run in fs.listStatus(day.getPath()):
            own = run.getPath().getName()
            if own.startswith("run=") and (name[4:], own[4:]) not in owned:
                fs.delete(run.getPath(), True)
                gone.append(f"{name}/{own}")
        if not fs.listStatus(day.getPath()):
            fs.delete(day.getPath(), True)
    return gone


def _days(lo: datetime, hi: datetime):
    day = lo.replace(hour=0, minute=0, second=0, microsecond=0)
    while day < hi:
        yield day.date().isoformat()
        day += timedelta(days=1)


def read_owned(spark: SparkSession, path: str, schema: T.StructType, label: str,
               lo: datetime | None = None, hi: datetime | None = None) -> DataFrame:
    """Rows of a table that their runs own, with ``lo <= label < hi``.

    The days and runs in question prune folders; the spans, one row for each,
    decide by row.  A table without a run is empty.
    """
    spans = owners(spark, path, lo, hi)
    full = T.StructType([*schema.fields, T.StructField("day", T.DateType()), T.StructField("run", T.StringType())])
    table = stored(spark, path, full) if spans else None
    if table is None:
        return spark.createDataFrame([], schema)
    first, last = max(spans[0][0], lo or spans[0][0]), min(spans[-1][1], hi or spans[-1][1])
    rows = table.filter(F.col("day").between(F.lit(first.date()), F.lit(last.date())) & F.col("run").isin(sorted({s[2] for s in spans})))
    rows = rows.filter((F.col(label) >= ts_lit(first)) & (F.col(label) < ts_lit(last)))
    if len({s[2] for s in spans}) > 1:   # a single run owns all that the bounds above let through, or gaps where it has no row
        held = spark.createDataFrame(spans, "_lo timestamp_ntz, _hi timestamp_ntz, _run string")
        rows = rows.join(F.broadcast(held), (F.col("run") == F.col("_run")) & (F.col(label) >= F.col("_lo")) & (F.col(label) < F.col("_hi")))
    return rows.select(*schema.names)
