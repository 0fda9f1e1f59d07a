"""Toxicity score: character n-gram linear classifier with naive Bayes features.

Features are the hashed 3- to 5-grams of the lower-cased text that occur in
it, each scaled by its naive Bayes log-count ratio; a logistic regression on
them is trained on labelled rows.  The model is fitted on at most
``TRAIN_PER_CLASS`` labelled documents of each class, those with the smallest
hash of their id, whatever the length of their texts; everything else covers all
rows: each whole text is scored.  Tasks turn the sample's whole texts into
distinct features and count them; the driver gets the counts, of a fixed number
of features, and then each sample row's features that the model uses, never a text.

Defined results: a null or empty text has no feature and scores the bias alone;
repeated rows score alike; rows labelled twice count as toxic if one label says
so; null labels are ignored; without training texts of both classes nothing is
learnt and nothing rejected: every text scores the smoothed share of toxic
labels, at most ``UNLEARNT``.  Extra columns ride along.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import materialize, ship, small_batches

ship(__name__)

TRAIN_PER_CLASS = 4000    # bound of the training sample, rows of each class
GRAMS = (3, 4, 5)
HASH_BITS = 20
MIN_ROWS = 4              # training rows in which a feature must occur
MIN_RATIO = 1.0           # features whose log-count ratio is nearer to 0 are left out
UNLEARNT = 0.49           # highest score of a model that has learnt nothing; 0.5 rejects
FOLDS = 5                 # rows with crc32(doc_id as text) mod 5 = 0 are held out


def gram_ids(text: str, last: np.ndarray) -> np.ndarray:
    """Hashed ids of the distinct character n-grams of a whole text.

    ``last`` is scratch space of one slot per id; what it holds does not matter.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    for n in GRAMS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ codes[k:len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append((h >> np.uint64(64 - HASH_BITS)).astype(np.int32))
    if not out:
        return np.empty(0, np.int32)
    ids = np.concatenate(out)
    # distinct ids without sorting: of equal ids only the last to be written survives
    places = np.arange(len(ids), dtype=np.int32)
    last[ids] = places
    return ids[last[ids] == places]


def slots() -> np.ndarray:
    return np.zeros(1 << HASH_BITS, np.int32)


def ratios(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of each feature that is used, else 0; ``counts`` has a line per class."""
    share = np.log(counts[1] + 1.0) - np.log(rows[1] + 2.0) - np.log(counts[0] + 1.0) + np.log(rows[0] + 2.0)
    return np.where((counts.sum(axis=0) >= MIN_ROWS) & (np.abs(share) >= MIN_RATIO), share, 0.0)


def fit(kept: list[np.ndarray], ratio: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weight and squared ratio per hashed feature and the bias, from the used features of each sample row.

    ``weights`` bring the sample's classes back to their shares among all
    labelled rows, so that 0.5 is the even point of the whole population.
    """
    size = 1 << HASH_BITS
    ids = np.concatenate([*kept, np.empty(0, np.int32)])
    row_of = np.repeat(np.arange(len(kept), dtype=np.int32), [len(k) for k in kept])
    values = ratio[ids]
    # features of a text are scaled to length one, so that long texts do not saturate
    norm = np.sqrt(np.bincount(row_of, values * values, len(kept)))
    values = values / np.maximum(norm, 1e-9)[row_of] if len(values) else values
    w, bias = np.zeros(size), float(np.log((weights * toxic).sum() / (weights * (1 - toxic)).sum()))
    grad2, bias2 = np.full(size, 1e-8), 1e-8
    penalty = 1e-5
    for _ in range(150):   # full-batch steps with per-feature step sizes: the same model on every run
        z = np.bincount(row_of, values * w[ids], len(kept)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        err = weights * (p - toxic) / weights.sum()
        g = np.bincount(ids, values * err[row_of], size) + penalty * w
        grad2 += g * g
        w -= 1.0 * g / np.sqrt(grad2)
        bias2 += err.sum() ** 2
        bias -= 0.2 * err.sum() / np.sqrt(bias2)
    return (w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), bias


def grams(texts: pa.Array) -> pa.Array:
    """The distinct feature ids of each whole text, 32 bits each."""
    last = slots()
    return pa.array([gram_ids(t.as_py() or "", last).tobytes() for t in texts], pa.binary())


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, grams) -> (toxic, gram, n): one row per feature that a task has seen in a class."""
    counts = np.zeros((2, 1 << HASH_BITS), np.int64)
    for batch in batches:
        for y, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts[y][np.frombuffer(ids.as_py(), np.int32)] += 1   # ids of a text are distinct
    for y in (0, 1):
        at = np.flatnonzero(counts[y])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), y, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[y][at])],
                                         names=["toxic", "gram", "n"])


def used_only(ratio):
    """Arrow UDF: the feature ids whose ratio in the broadcast line is not 0."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        used = ratio.value != 0
        for batch in batches:
            rows = [np.frombuffer(b.as_py(), np.int32) for b in batch]
            yield pa.array([ids[used[ids]].tobytes() for ids in rows], pa.binary())

    return F.arrow_udf(run, "binary")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def unlearnt(totals: dict[int, int]) -> tuple[np.ndarray, np.ndarray, float]:
    """The model without features, from the labelled rows of each class."""
    share = min((totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1), UNLEARNT)
    return np.zeros(1 << HASH_BITS, np.float32), np.zeros(1 << HASH_BITS, np.float32), float(np.log(share / (1 - share)))


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights, squared ratios, bias) from a bounded sample of the labelled rows outside the held-out fold."""
    small_batches(docs.sparkSession)
    marked = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return unlearnt(totals)
    by_hash = F.xxhash64("doc_id")
    sample = None
    for y in (0, 1):
        part = marked.filter(F.col("toxic") == y).orderBy(by_hash, "doc_id").limit(TRAIN_PER_CLASS)
        sample = part if sample is None else sample.union(part)
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(   # at most 2 * TRAIN_PER_CLASS ids
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic"), F.xxhash64("doc_id", "text").alias("h"))
    # an id that many rows carry must not lift the bound, and repeated rows teach once
    distinct = picked.select("toxic", "h").distinct()
    first = [distinct.filter(F.col("toxic") == y).orderBy("h").limit(TRAIN_PER_CLASS) for y in (0, 1)]
    teaching = picked.join(F.broadcast(first[0].union(first[1]).select("h").distinct()), "h", "left_semi")
    sample_rows = materialize(teaching.select("toxic", "h", F.arrow_udf(grams, "binary")("text").alias("grams")).dropDuplicates(["h"]), "grams")
    rows = {r["toxic"]: r["n"] for r in sample_rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(rows) < 2:
        return unlearnt(totals)
    counted = (sample_rows.select("toxic", "grams").mapInArrow(count_grams, "toxic int, gram int, n long")
               .groupBy("toxic", "gram").agg(F.sum("n").alias("n")).toArrow())   # at most 2 rows per feature
    counts = np.zeros((2, 1 << HASH_BITS), np.int64)
    counts[counted["toxic"].to_numpy(), counted["gram"].to_numpy()] = counted["n"].to_numpy()
    ratio = ratios(counts, np.array([rows[0], rows[1]], float))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    taught = sample_rows.select("toxic", "h", used_only(shared)("grams").alias("grams")).orderBy("h").toArrow()   # at most 2 * TRAIN_PER_CLASS rows
    toxic = taught["toxic"].to_numpy().astype(float)
    kept = [np.frombuffer(b.as_py(), np.int32) for b in taught["grams"]]
    share = np.array([totals[int(y)] / rows[int(y)] for y in toxic])
    return fit(kept, ratio, toxic, share)


def scorer(docs: DataFrame, labels: DataFrame) -> Column:
    """Column with the score of ``text``; the fitted weights are broadcast (their size is fixed)."""
    weights, squares, bias = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((weights, squares, bias))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        (w, sq, b), last = shared.value, slots()
        for batch in batches:
            out = np.empty(len(batch))
            for i, text in enumerate(batch):
                ids = gram_ids(text.as_py() or "", last)
                norm = float(np.sqrt(sq[ids].sum(dtype=np.float64)))
                out[i] = b + (float(w[ids].sum(dtype=np.float64)) / norm if norm > 0 else 0.0)
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return F.arrow_udf(run, "double")(F.col("text"))


def score(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of each whole text."""
    return docs.withColumn(name, scorer(docs, labels))
