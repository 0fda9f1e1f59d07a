"""Sequence packing by cutting-stock column generation.

A document is its token ids and an end id.  Whole sequences are cut off its
front; what remains is one piece of 1 to ``max_len`` ids.  The piece lengths
form a histogram of at most ``max_len`` rows, the only thing that reaches the
driver.  Lengths are rounded up to size classes (steps of 1/128 of the size),
and a linear program over patterns (how many pieces of each class one sequence
holds) is solved by column generation: a knapsack dynamic program prices new
patterns at the duals until the program is within ``TOLERANCE`` of its bound.
Patterns are rounded down, the rest of the demand is filled largest first, and
the pieces of each class, ranked in a distributed way, take the slots.

Defined results: a null or empty text is one piece holding the end id alone;
repeated rows (equal doc_id, equal text) are packed once each; a null doc_id is
kept; an empty table gives an empty result.  Extra columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearbid.llm.common import id_width, materialize, rank_in_groups, ship, small_batches, wide_ids

ship(__name__)

MAX_LEN = 4096
END_ID = 2
CLASS_STEP = 128       # size classes are 1/128 of their size apart
TOLERANCE = 1e-3       # the linear program stops this close to its lower bound
MAX_PRICINGS = 400     # or after so many knapsack pricings,
MAX_PIVOTS = 20        # or so many pivots per class; only the padding depends on it
CACHE_WORDS = 300_000  # words whose ids one task keeps; others are encoded again

PIECES = "array<struct<start:bigint,length:bigint,doc_tokens:bigint,ids:binary>>"


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for 256, 257, ... in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    code = dict(zip(printable, printable)) | {b: 256 + n for n, b in enumerate(others)}
    return [chr(code[b]) for b in range(256)]


def word_encoder(tokenizer_json: str, width: int = 4):
    """Function text -> its ids, little-endian, ``width`` bytes each.

    The tokenizer splits at white space and encodes each pre-token alone.  A
    text of ASCII and Latin-1 letters is cut into its pre-tokens here and each
    distinct one goes to the BPE model of the file once per task.  In any other
    text the words of that kind do, and the rest, as well as words holding a
    special token, go through the whole tokenizer one by one.
    """
    import re

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    # printable ASCII and the letters of Latin-1: composed, and each with one lower-case form
    simple = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
    letter = "a-z\u00df-\u00f6\u00f8-\u00ff"
    split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[0-9]|[^\\s{letter}0-9]+").findall
    letters, model, blank = byte_letters(), tokenizer.model, re.compile("[\t-\r ]+").split
    known: dict[str, bytes] = {}
    pieces: dict[str, bytes] = {}

    def piece_ids(piece: str) -> bytes:
        got = pieces.get(piece)
        if got is None:
            spelled = piece if piece.isascii() else "".join([letters[b] for b in piece.encode()])
            got = b"".join([t.id.to_bytes(width, "little") for t in model.tokenize(spelled)])
            if len(pieces) < CACHE_WORDS:
                pieces[piece] = got
        return got

    def whole(word: str) -> bytes:
        return b"".join([i.to_bytes(width, "little") for i in tokenizer.encode(word, add_special_tokens=False).ids])

    def cut(text: str) -> bytes:
        get = pieces.get
        return b"".join([get(p) or piece_ids(p) for p in split(text.lower())])

    # the short way only where it gives the tokenizer's own ids
    probe = "Don't we'll 'd x9 CC-BY a_b $$$ (i.e.) it's [x]!! \u00c9cole \u00fcber\u00dftra\u00dfe \u00d1u's\n 1 23"
    plain = cut(probe) == whole(probe)

    def short(text: str) -> bool:
        return plain and simple(text) is not None and not ("|>" in text and any(s in text for s in specials))

    def word_ids(word: str) -> bytes:
        got = known.get(word)
        if got is None:
            got = cut(word) if short(word) else whole(word)
            if len(known) < CACHE_WORDS:
                known[word] = got
        return got

    def encode(text: str) -> bytes:
        return cut(text) if short(text) else b"".join([word_ids(w) for w in blank(text) if w])

    return encode


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, start, length, doc_tokens, ids): each document's pieces, ids in ``id_width`` bytes each.

    The tokenizer file is read on the driver (its size is fixed) and broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    width = id_width(tokenizer_json, end_id)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = end_id.to_bytes(width, "little")
    size = width * max_len

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = word_encoder(shared.value, width)
        for batch in batches:
            ids, starts, lengths, totals, offsets = [], [], [], [], [0]
            for text in batch:
                got = encode(text.as_py() or "") + end
                for k in range(0, len(got), size):
                    ids.append(got[k:k + size])
                    starts.append(k // width)
                    lengths.append(len(ids[-1]) // width)
                    totals.append(len(got) // width)
                offsets.append(len(ids))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(totals, pa.int64()), pa.array(ids, pa.binary())],
                names=["start", "length", "doc_tokens", "ids"]))

    cut = F.arrow_udf(run, PIECES)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return (docs.select("doc_id", text).select("doc_id", F.explode(cut("text")).alias("p"))
            .select("doc_id", "p.start", "p.length", "p.doc_tokens", "p.ids"))


# ------------------------------------------------------------------- the plan (driver, bounded)

def size_classes(capacity: int, step: int = CLASS_STEP) -> np.ndarray:
    edges = [1]
    while edges[-1] < capacity:
        edges.append(min(capacity, edges[-1] + max(1, edges[-1] // step)))
    return np.array(edges, np.int64)


def price(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """Most valuable pattern: knapsack by dynamic programming over the capacity.

    Each class is offered in 1, 2, 4, ... copies, so every step is one vector
    operation over all capacities.
    """
    best, taken = np.zeros(capacity + 1), []
    for i in np.flatnonzero(values > 1e-12):
        k = 1
        while k * sizes[i] <= capacity:
            w = int(k * sizes[i])
            offer = best[:-w] + k * values[i]
            better = offer > best[w:] + 1e-13
            if better.any():
                best[w:][better] = offer[better]
                taken.append((i, k, w, better))
            k *= 2
    pattern, room = np.zeros(len(sizes)), capacity
    for i, k, w, better in reversed(taken):
        if room >= w and better[room - w]:
            pattern[i] += k
            room -= w
    return pattern


def largest_first(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of largest-first filling, each used as often as the demand left allows."""
    left, out = demand.astype(np.int64).copy(), []
    order = np.argsort(-sizes)
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for i in order:
            if left[i] and sizes[i] <= room:
                pattern[i] = min(int(left[i]), room // int(sizes[i]))
                room -= int(pattern[i] * sizes[i])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        left -= times * pattern
        out.append((pattern, times))
    return out


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used; together they hold the demand exactly.

    Revised simplex on ``min sum x, P x = demand``.  Columns of the largest-first
    filling are offered before the knapsack is solved; the bound is Farley's.
    """
    m = len(sizes)
    fits = capacity // sizes
    # unequal tiny additions keep ties from turning the simplex in circles
    basis, x = np.diag(fits.astype(float)), (demand + 1e-7 * np.arange(1, m + 1) / m) / fits
    inverse = np.diag(1.0 / fits)
    pool = np.array([p for p, _ in largest_first(sizes, demand, capacity)], float).reshape(-1, m)
    bound, pricings, pivots = float(demand @ (sizes / capacity)), 0, 0
    while x.sum() > bound * (1 + TOLERANCE) and pricings < MAX_PRICINGS and pivots < MAX_PIVOTS * m:
        pivots += 1
        duals = inverse.sum(axis=0)
        worth = pool @ duals
        column = pool[int(worth.argmax())]
        if worth.max() <= 1 + 1e-6:
            column = price(sizes, np.maximum(duals, 0), capacity)
            pricings += 1
            worth = float(column @ duals)
            bound = max(bound, x.sum() / max(worth, 1.0))
            if worth <= 1 + 1e-6:
                break
            pool = np.vstack([pool, column])
        y = inverse @ column
        ratio = np.where(y > 1e-9, x / np.where(y > 1e-9, y, 1), np.inf)
        k = int(ratio.argmin())
        step = ratio[k]
        x = x - step * y
        x[k] = step
        inverse[k] /= y[k]
        y[k] = 0
        inverse -= np.outer(y, inverse[k])
        basis[:, k] = column
    out, left = [], demand.astype(np.int64).copy()
    for k in np.argsort(-x):
        pattern = np.rint(basis[:, k]).astype(np.int64)
        used = pattern > 0
        times = min(int(np.floor(max(x[k], 0) + 1e-6)), int((left[used] // pattern[used]).min()))
        if times > 0:
            out.append((pattern, times))
            left -= times * pattern
    return out + largest_first(sizes, left, capacity)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (class, lo, hi, per_sequence, first_sequence, first_slot).

    Ranks ``lo`` to ``hi`` of a class fill the sequences from ``first_sequence``
    on, ``per_sequence`` pieces each.  There are at most a few rows per pattern,
    and patterns are bounded by the number of classes.
    """
    if not histogram:
        return []
    edges = size_classes(capacity)
    demand = np.zeros(len(edges), np.int64)
    for length, n in histogram.items():
        demand[int(np.searchsorted(edges, length))] += n
    live = np.flatnonzero(demand)
    rows, taken, sequence = [], np.zeros(len(live), np.int64), 0
    for pattern, times in cutting_stock(edges[live], demand[live].astype(float), capacity):
        slot = 0
        for i in np.flatnonzero(pattern):
            per, n = int(pattern[i]), int(pattern[i]) * times
            rows.append((int(live[i]), int(taken[i]), int(taken[i]) + n, per, sequence, slot))
            taken[i] += n
            slot += per
        sequence += times
    return rows


# ------------------------------------------------------------------- assignment (distributed)

def assign_sequences(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (length, ...).

    ``pieces`` with unique keys ``piece_key`` should be a written table, since it
    is read four times; others are written here under a key.  Keys and lengths alone are ranked and placed, and any further
    column, the ids above all, joins its place once at the end.  The order of the
    keys decides all ties, so a task that runs again places its pieces alike.
    """
    if "piece_key" not in pieces.columns:
        return assign_sequences(materialize(pieces.withColumn("piece_key", F.monotonically_increasing_id()), "pieces"), max_len).drop("piece_key")
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(histogram, max_len)
    schema = "size_class int, lo bigint, hi bigint, per bigint, first_sequence bigint, first_slot bigint"
    slots = F.broadcast(spark.createDataFrame(rows, schema))   # bounded by classes and patterns
    classes = [(n, int(np.searchsorted(size_classes(max_len), n))) for n in histogram]
    by_length = F.broadcast(spark.createDataFrame(classes, "length bigint, size_class int"))   # at most max_len rows
    narrow = pieces.select("piece_key", "length").join(by_length, "length")
    ranked = rank_in_groups(narrow, ["size_class"], ["piece_key"], sum(histogram.values()), "rank")
    at = F.col("rank") - F.col("lo")
    placed = (ranked.join(slots, (ranked["size_class"] == slots["size_class"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
              .withColumn("sequence_id", (F.col("first_sequence") + F.expr("(rank - lo) div per")))
              .withColumn("slot", F.col("first_slot") + at % F.col("per")))
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    places = placed.select("piece_key", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
    return pieces.join(places, "piece_key")


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids and places: (doc_id, start, length, doc_tokens, ids, sequence_id, offset).

    The ids are written once, move through one shuffle, and take 16 bits each
    until they leave, while the vocabulary allows it.
    """
    keyed = tokenize_pieces(docs, tokenizer_path, max_len, end_id).withColumn("piece_key", F.monotonically_increasing_id())
    done = assign_sequences(materialize(keyed, "pieces"), max_len)
    return done.select("doc_id", "start", "length", "doc_tokens", wide_ids("ids", "length").alias("ids"), "sequence_id", "offset")
