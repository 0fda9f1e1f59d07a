"""Sharding by longest-processing-time scheduling.

Rows with equal text form a group that stays together.  The groups, largest
first, go to the least loaded shard through a heap.  Groups of more than
1/``LARGE`` of all bytes are scheduled alone (there are fewer than ``LARGE``);
all others are first gathered into ``BUNDLES`` bundles by the hash of their
text, so the heap holds at most ``BUNDLES`` + ``LARGE`` entries whatever the
size of the corpus, and a bundle is a negligible part of a shard.  On a small
table most bundles are single groups.

Defined results: a null text counts as empty (size 1) and groups with it;
repeated rows are rows of their own; ties are broken by bundle number and row
order; a group larger than an even share fills a shard alone, as it must stay
together; an empty table gives an empty result.  ``shard_documents`` returns the
placement alone; ``write_shards`` writes the documents with all their columns, the
texts among them, one folder per shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import materialize, rank_in_groups

BUNDLES = 16384
LARGE = 512


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Longest processing time first: (bundle, size) -> shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for bundle, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[bundle] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard_documents(docs: DataFrame, shards: int = 8, bundles: int = BUNDLES, large: int = LARGE) -> DataFrame:
    """(doc_id, size, text_crc32, group, bundle, shard, slot), one row per row of ``docs``.

    ``slot`` numbers the rows of a shard from 0 without gaps, bundle by bundle.
    """
    # the written number tells repeated rows apart, which would share one cell of the ranking otherwise
    rows = materialize(docs.select("doc_id", *text_facts(), F.monotonically_increasing_id().alias("row")), "sizes")
    plan, n = place_groups(rows, shards, bundles, large)
    ranked = rank_in_groups(plan(rows, "group"), ["bundle"], ["group", "doc_id", "row"], n, "place")
    return ranked.select("doc_id", "size", "text_crc32", "group", "bundle", "shard",
                         (F.col("first_slot") + F.col("place")).cast("long").alias("slot"))


def text_facts() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [(F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text).alias("group")]


def place_groups(rows: DataFrame, shards: int, bundles: int, large: int) -> tuple[Callable[[DataFrame, str], DataFrame], int]:
    """A function that adds (bundle, shard, first_slot) to rows by the column of their group, and the number of rows.

    ``rows`` is a written table of (group, size).  The function joins two small
    tables by broadcast, at most ``bundles`` + ``large`` rows, and moves no row.
    """
    spark = rows.sparkSession
    groups = materialize(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    alone = [r["group"] for r in groups.filter(F.col("bytes") * large > total["b"]).orderBy("group").collect()]   # fewer than ``large``
    own = F.broadcast(spark.createDataFrame([(g, bundles + i) for i, g in enumerate(alone)], "group string, own int"))
    hashed = F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("int")
    bundled = groups.join(own, "group", "left").select("group", "bytes", "n", F.coalesce("own", hashed).alias("bundle"))
    loads = bundled.groupBy("bundle").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()   # at most bundles + large
    at = schedule([(r["bundle"], r["bytes"]) for r in loads], shards)
    used, placed = [0] * shards, []
    for r in sorted(loads, key=lambda r: r["bundle"]):
        s = at[r["bundle"]]
        placed.append((r["bundle"], s, used[s]))
        used[s] += r["n"]
    places = F.broadcast(spark.createDataFrame(placed, "bundle int, shard int, first_slot long"))

    def plan(df: DataFrame, group: str) -> DataFrame:
        marked = df.join(own.withColumnRenamed("group", group), group, "left")
        return marked.withColumn("bundle", F.coalesce("own", F.pmod(F.xxhash64(group), F.lit(bundles)).cast("int"))).drop("own").join(places, "bundle")
    return plan, total["n"]


def write_shards(docs: DataFrame, path: str, shards: int = 8, bundles: int = BUNDLES, large: int = LARGE) -> None:
    """Write ``docs`` whole, as ``path/part_of=<shard>``, by the same placement as ``shard_documents``.

    Documents are written where they are read, without a shuffle; a column of
    ``docs`` called ``part_of`` would be lost and is refused.
    """
    if "part_of" in {c.lower() for c in docs.columns}:
        raise ValueError("documents already have a column part_of")
    plan, _ = place_groups(materialize(docs.select(*text_facts()), "sizes"), shards, bundles, large)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.md5(F.coalesce("text", F.lit(""))).alias("group"))
    plan(packed, "group").select("doc.*", F.col("shard").alias("part_of")).write.partitionBy("part_of").parquet(path)
