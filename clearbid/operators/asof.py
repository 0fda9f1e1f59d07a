"""Latest-preceding ("as-of") match: for each action, the newest touch time of
the same key with ``touch.tstamp <= action.tstamp``.

Spark has no as-of join, and a join of actions to every earlier touch of the
same user is quadratic per user.  Here only narrow rows (key, time) meet: touches
and actions are united, shuffled once by key, and a running maximum in time order
gives each action its newest touch (RANGE frame, so equal times count).

A key is one task's work unless it is heavy.  A bounded count finds the heavy
keys: where the rows are more than one cell holds, a frequent-items sketch of the keys' hashes (``approx_top_k``, a fixed
number of counters per task) names every key that holds more than one
``PARTS``-th of all rows, and those above ``cell_rows`` are cut in time at
quantiles of their own rows, so that a burst inside one hour is split too.  Their
rows are shuffled by (key, cell); the newest touch of each cell, one row per cell,
carries over to the later cells.  At most ``PARTS`` keys and twice as many cells
reach the driver.  Keys whose hash equals a heavy one's are cut along with it,
which changes no result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 2_000            # a key below 1/PARTS of all rows is never cut
TRACKED = 100_000        # counters of the sketch: keys of 1/PARTS of all rows are far above its error
CELL_ROWS = 500_000      # rows of a key that one task takes without a thought
SMALL_ACTIONS = 200_000  # action keys that are broadcast to drop touches of other users before the shuffle
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "tstamp"]])


@dataclass(frozen=True)
class KeyCounts:
    """What one bounded count says of the keys: which are heavy, and how they are to be cut."""

    actions: int
    touches: int
    heavy: dict[int, int]   # hash of the key: rows
    limit: int              # rows per cell

    @property
    def few_actions(self) -> bool:
        """Whether the actions' keys are worth broadcasting to drop touches of other users."""
        return self.actions <= min(SMALL_ACTIONS, self.touches)


def count_keys(actions: DataFrame, touches: DataFrame, keys: list[str], cell_rows: int | None = None) -> KeyCounts:
    """Count the rows; where a key could fill more than a cell, sketch the keys too."""
    cell_rows = CELL_ROWS if cell_rows is None else cell_rows
    told = actions.select(*keys, F.lit(1).alias("_a")).union(touches.select(*keys, F.lit(0)))
    row = told.agg(F.count(F.lit(1)).alias("n"), F.sum("_a").alias("actions")).first()
    limit, top = max(cell_rows, math.ceil(row.n / PARTS)), []
    if row.n > limit:
        top = told.select(F.xxhash64(*keys).alias("h")).agg(F.expr(f"approx_top_k(h, {PARTS}, {TRACKED})")).first()[0] or []
    return KeyCounts(row.actions or 0, row.n - (row.actions or 0), {t["item"]: t["count"] for t in top if t["count"] > limit}, limit)


def is_heavy(keys: list[str], counts: KeyCounts) -> Column:
    return F.xxhash64(*keys).isin(list(counts.heavy))


def cell_edges(rows: DataFrame, heavy: dict[int, int], limit: int) -> DataFrame:
    """Rows (h, edges): the times at which each heavy key's rows (h, tstamp) are cut, one per heavy key."""
    spark = rows.sparkSession
    most = min(PARTS, max(math.ceil(n / limit) for n in heavy.values()))
    shares = ", ".join(f"{(k + 1) / most!r}D" for k in range(most - 1)) or "0.5D"
    found = rows.groupBy("h").agg(F.expr(f"percentile_approx(tstamp - {EPOCH}, array({shares}), 10000)").alias("cuts")).collect()
    own = []
    for r in found:   # PARTS keys at most, and PARTS cuts of each
        cells = min(most, math.ceil(heavy[r["h"]] / limit))
        own.append((r["h"], sorted({r["cuts"][round((k + 1) * most / cells) - 1] for k in range(cells - 1)})))
    table = spark.createDataFrame(own, "h bigint, cuts array<interval day to second>")
    return table.select("h", F.expr(f"transform(cuts, c -> {EPOCH} + c)").alias("edges"))


def _running(actions: DataFrame, touches: DataFrame, within: list[str], out_col: str) -> DataFrame:
    """Action rows with the newest touch time at or before them, inside ``within``."""
    cols = actions.columns
    told = actions.select(*within, "tstamp", F.lit(None).cast("timestamp_ntz").alias(out_col), F.struct(*cols).alias("_act"))
    held = touches.select(*within, "tstamp", F.col("tstamp").alias(out_col), F.lit(None).cast(told.schema["_act"].dataType).alias("_act"))
    newest = F.max(out_col).over(Window.partitionBy(*within).orderBy("tstamp").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    done = held.union(told).withColumn(out_col, newest).filter(F.col("_act").isNotNull())
    return done.select(F.col("_act.*"), out_col)


def _by_cell(actions: DataFrame, touches: DataFrame, keys: list[str], edges: DataFrame, out_col: str) -> DataFrame:
    """The match of heavy keys: a running maximum per (key, cell), and what earlier cells carry over."""
    small = F.broadcast(edges)   # PARTS rows at most
    cell = F.size(F.filter("edges", lambda e: e <= F.col("tstamp"))).alias("_cell")

    def cut(df: DataFrame) -> DataFrame:
        return df.withColumn("h", F.xxhash64(*keys)).join(small, "h").select(*df.columns, cell)
    acts, held = cut(actions), cut(touches)
    top = held.groupBy(*keys, "_cell").agg(F.max("tstamp").alias("_top"))
    hours = acts.select(*keys, "_cell").distinct().select(*keys, "_cell", F.lit(None).cast("timestamp_ntz").alias("_top"))
    per_cell = top.union(hours).groupBy(*keys, "_cell").agg(F.max("_top").alias("_top"))   # one row per cell
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_cell.select(*keys, "_cell", F.max("_top").over(earlier).alias("_carry"))
    local = _running(acts, held, [*keys, "_cell"], out_col)
    # a touch in the action's own cell is always newer than any earlier cell's
    return (local.join(carry, [*keys, "_cell"], "left").withColumn(out_col, F.coalesce(out_col, "_carry"))
            .select(*actions.columns, out_col))


def heavy_touch(actions: DataFrame, touches: DataFrame, keys: list[str], counts: KeyCounts, out_col: str) -> DataFrame:
    """Actions of the heavy keys with ``out_col``."""
    acts, held = actions.filter(is_heavy(keys, counts)), touches.select(*keys, "tstamp").filter(is_heavy(keys, counts))
    rows = acts.select(*keys, "tstamp").union(held).select(F.xxhash64(*keys).alias("h"), "tstamp")
    return _by_cell(acts, held, keys, cell_edges(rows, counts.heavy, counts.limit), out_col)


def latest_touch_time(actions: DataFrame, touches: DataFrame, keys: list[str],
                      out_col: str = "touch_tstamp", cell_rows: int | None = None) -> DataFrame:
    """Add ``out_col`` = newest ``touches.tstamp`` <= ``actions.tstamp`` per key (NULL if none).

    Actions with a NULL key or time match nothing (equality semantics).
    """
    none = actions.filter(~known(keys)).withColumn(out_col, F.lit(None).cast("timestamp_ntz"))
    actions, touches = actions.filter(known(keys)), touches.select(*keys, "tstamp").filter(known(keys))
    counts = count_keys(actions, touches, keys, cell_rows)
    if not counts.heavy:
        return _running(actions, touches, keys, out_col).unionByName(none)
    light = ~is_heavy(keys, counts)
    return (_running(actions.filter(light), touches.filter(light), keys, out_col)
            .unionByName(heavy_touch(actions, touches, keys, counts, out_col)).unionByName(none))
