"""Helpers shared by the operators: written intermediates, ranks, components."""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearbid.session import scratch_dir

# ASCII bytes that are no word character of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``
# become spaces and A-Z become a-z; bytes of multi-byte characters stay.
ALNUM_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
# A-Z become a-z, all else stays.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Most text that a task hands to Python at once.
BATCH_BYTES = "2m"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of ``BATCH_BYTES``, unless the session names a size itself.

    Spark's own bound is 10,000 rows whatever their length: a task's whole share
    of the texts, held by Spark and by Python at the same time.  The size is read
    when a plan runs, often after the operator has returned it, so it stays set.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def ship(module: str) -> None:
    """Send the functions of ``module`` to workers by value.

    Executors then need neither this repository on their path nor a shared
    folder that holds it.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation
    of everything before, and a frame used twice is computed once.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened by underscores until no column of ``df`` has it in any spelling."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def content_key(*cols: Column) -> Column:
    """128-bit key of several columns; nulls and empty strings differ."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in cols]
    return F.md5(F.concat_ws("\x00", *parts))


def id_width(tokenizer_json: str, *more: int) -> int:
    """Bytes that hold each id of the tokenizer and of ``more``: 2 or 4."""
    from tokenizers import Tokenizer

    ids = [*Tokenizer.from_str(tokenizer_json).get_vocab(with_added_tokens=True).values(), *more]
    return 2 if max(ids) < 1 << 16 else 4


def _widen(ids: pa.Array, length: pa.Array) -> pa.Array:
    wide = []
    for got, n in zip(ids, length, strict=True):
        raw = got.as_py()
        wide.append(np.frombuffer(raw, "<u2").astype("<u4").tobytes() if len(raw) == 2 * n.as_py() else raw)
    return pa.array(wide, pa.binary())


def wide_ids(ids: str, length: str) -> Column:
    """``ids`` (2 or 4 bytes each, ``length`` of them) as little-endian unsigned 32 bit."""
    return F.arrow_udf(_widen, "binary")(ids, length)


def rank_in_groups(df: DataFrame, keys: list[str], order: list[str], n_rows: int, name: str = "rank") -> DataFrame:
    """Add a gapless 0-based rank within ``keys`` without one task per group.

    Rows of a group are dealt over about sqrt(n_rows) cells by the hash of the
    ordering columns.  A window ranks each cell, a second one over the cell
    counts gives each cell its offset, so neither window sees more than about
    sqrt(n_rows) rows of one group plus its ties.  The rank follows ``order``
    inside a cell (a leading ``-`` turns a column round) and is stable under
    task retries.
    """
    by = [F.col(c[1:]).desc() if c[0] == "-" else F.col(c) for c in order]
    cells = max(1, math.isqrt(max(0, n_rows)))
    dealt = df.withColumn("__cell", F.pmod(F.xxhash64(*[c.lstrip("-") for c in order]), F.lit(cells)))
    counts = dealt.groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__at"))
    within = F.row_number().over(Window.partitionBy(*keys, "__cell").orderBy(*by)) - 1
    return (dealt.withColumn("__in", within).join(offsets, [*keys, "__cell"])
            .withColumn(name, F.col("__at") + F.col("__in")).drop("__cell", "__at", "__in"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v): one row (node, root) per linked node.

    ``root`` is the smallest node of the component.  Each round gives every
    node the smallest label among its neighbours' (a map-side combined
    minimum, so a hub gathers one row per task) and then jumps to the label of
    that label; each round's labels are a written table.
    """
    both = materialize(edges.select("u", "v").union(edges.select("v", "u")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("root")), "labels")
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near")))
        step = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("root").alias("beyond"))
        moved = materialize(step.join(jump, "to").select(
            "node", F.least("to", "beyond").alias("root"), (F.least("to", "beyond") < F.col("root")).alias("moved")), "labels")
        labels = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
