"""Sequence packing by best-two-fit.

A document is its token ids and an end id; one longer than a sequence is cut
into whole sequences behind a first piece that holds the remainder.  The piece
lengths form a histogram of at most ``max_len`` rows, the only thing that reaches
the driver.  A bin is filled greedily, largest piece first; when nothing fits
any more, its smallest piece gives way to two unpacked pieces if they fill the
bin more tightly, and of all such pairs the one that leaves the smallest gap is
taken.  A bin built once is repeated while the histogram holds its pieces, as the
next bin would come out the same, so the plan has a few rows per length however
many pieces there are.  Pieces of one length are interchangeable: they are ranked
in a distributed way and take that length's places by rank.

Ids are kept as 16 bits per id while the vocabulary allows it, and leave as
little-endian unsigned 32 bits.  Ranking and placing move only piece keys and lengths;
the ids meet their places in one join at the end.

Defined results: a null or empty text is one piece holding the end id alone;
repeated rows (equal doc_id, equal text) are packed once each; a null doc_id is
kept; an empty table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import id_width, materialize, rank_in_groups, ship, small_batches, wide_ids
from clearbid.llm.packing import byte_letters

ship(__name__)

MAX_LEN = 2048
END_ID = 0
CACHE_WORDS = 300_000   # pre-tokens whose ids one task keeps; others are encoded again
BLOCK = 1 << 20         # characters that are cut into pre-tokens at once

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids:binary>>"


def byte_encoder(tokenizer_json: str, width: int = 4):
    """Function text -> its ids, little-endian, ``width`` bytes each.

    A byte-level tokenizer cuts a text into pre-tokens and encodes each alone.
    Where a blank stands between two other characters a pre-token always begins,
    so texts are cut there into blocks and, if they hold more than ASCII and
    Latin-1 letters, into words.  Words of those letters are cut into pre-tokens
    here, and each distinct one goes to the BPE model of the file once per task;
    all other words, and those holding a special token, go through the whole
    tokenizer.
    """
    import re

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    letter = "A-Za-zÀ-ÖØ-öø-ÿ"
    simple = re.compile(f"[\t-\r -~{letter}]*").fullmatch
    split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[0-9]+| ?[^\\s0-9{letter}]+|\\s+(?!\\S)|\\s+").findall
    gap = re.compile(r"(?<=[\w!-~])(?= [\w!-~])")
    letters, model = byte_letters(), tokenizer.model
    pieces: dict[str, bytes] = {}

    def packed(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(width, "little") for i in ids])

    def whole(text: str) -> bytes:
        return packed(tokenizer.encode(text, add_special_tokens=False).ids)

    def keep(key: str, ids: bytes) -> bytes:
        if len(pieces) < CACHE_WORDS:
            pieces[key] = ids
        return ids

    def piece_ids(piece: str) -> bytes:
        return keep(piece, packed([t.id for t in model.tokenize("".join([letters[b] for b in piece.encode()]))]))

    def cut(text: str) -> bytes:
        get = pieces.get
        return b"".join([get(p) or piece_ids(p) for p in split(text)])

    # the short way only where it gives the tokenizer's own ids
    probe = "Don't we'll  'd x9 CC-BY a_b $$$ (i.e.) it's [x]!! École überßtraße\tÑu's\n\n  1 23 \x0c\r\n end  "
    plain = cut(probe) == whole(probe)

    def short(text: str) -> bool:
        return plain and simple(text) is not None and not any(s in text for s in specials)

    def blocks(text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > BLOCK:
            found = gap.search(text, at + BLOCK)
            if found is None:
                break
            yield text[at:found.start()]
            at = found.start()
        yield text[at:] if at else text

    def block_ids(text: str) -> bytes:
        if short(text):
            return cut(text)
        return b"".join([cut(w) if short(w) else whole(w) for w in gap.split(text)])

    return lambda text: b"".join([block_ids(b) for b in blocks(text)])


def cut_pieces(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids), ids in the narrow width; the remainder comes first.

    The tokenizer file is read on the driver (its size is fixed) and broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    width = id_width(tokenizer_json, end_id)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = end_id.to_bytes(width, "little")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = byte_encoder(shared.value, width)
        for batch in batches:
            ids, numbers, starts, lengths, offsets = [], [], [], [], [0]
            for text in batch:
                got = encode(text.as_py() or "") + end
                total = len(got) // width
                edges = [0, *range(total % max_len or max_len, total + 1, max_len)]
                for number, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                    ids.append(got[lo * width:hi * width])
                    numbers.append(number)
                    starts.append(lo)
                    lengths.append(hi - lo)
                offsets.append(len(ids))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                names=["piece", "start", "length", "ids"]))

    cut = F.arrow_udf(run, PIECES)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select("doc_id", text).select("doc_id", F.explode(cut("text")).alias("p")).select("doc_id", "p.piece", "p.start", "p.length", "p.ids")


# ------------------------------------------------------------------- the plan (driver, bounded)

def tighter_pair(sizes: np.ndarray, counts: np.ndarray, above: int, most: int) -> tuple[int, int] | None:
    """Two pieces of ``sizes`` (ascending, ``counts`` of each) whose sum is nearest to ``most`` and over ``above``."""
    have = sizes[(counts > 0) & (sizes < most)]
    if not len(have):
        return None
    at = np.searchsorted(have, most - have, side="right") - 1          # the largest partner of each
    alone = (at >= 0) & (have[at] == have) & (counts[np.searchsorted(sizes, have)] < 2)
    at = np.where(alone, at - 1, at)                                   # a single piece is no partner of itself
    total = np.where(at >= 0, have + have[at], 0)
    best = int(total.argmax())
    return (int(have[best]), int(have[at[best]])) if total[best] > above else None


def best_two_fit(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins ({length: pieces}, how often), which hold the histogram exactly."""
    left = dict(histogram)
    live, out = sorted(k for k, n in left.items() if n), []
    while live:
        bin_, room, i = {}, capacity, bisect_right(live, capacity) - 1
        while i >= 0:
            size = live[i]
            bin_[size] = min(left[size], room // size)
            room -= bin_[size] * size
            i = min(i, bisect_right(live, room)) - 1
        need, smallest = dict(bin_), min(bin_)
        if sum(bin_.values()) > 1 and room:
            near = live[:bisect_right(live, smallest - 1)]
            rest = np.array([left[s] - bin_.get(s, 0) for s in near], np.int64)
            pair = tighter_pair(np.array(near, np.int64), rest, smallest, room + smallest)
            if pair:
                bin_[smallest] -= 1
                for s in pair:
                    bin_[s] = bin_.get(s, 0) + 1
                    need[s] = max(need.get(s, 0), bin_[s])
        times = min(left[s] // n for s, n in need.items())
        for s, n in bin_.items():
            left[s] -= n * times
        live = [s for s in live if left[s]] if any(not left[s] for s in bin_) else live
        out.append(({s: n for s, n in bin_.items() if n}, times))
    return out


def places(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, lo, hi, per, first_sequence, first_offset).

    Ranks ``lo`` to ``hi`` of a length fill the sequences from ``first_sequence``
    on, ``per`` pieces each, side by side from ``first_offset`` on.
    """
    rows, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for bin_, times in best_two_fit(histogram, capacity):
        offset = 0
        for size in sorted(bin_, reverse=True):
            per = bin_[size]
            rows.append((size, taken[size], taken[size] + per * times, per, sequence, offset))
            taken[size] += per * times
            offset += per * size
        sequence += times
    return rows


# ------------------------------------------------------------------- assignment (distributed)

def place_pieces(lengths: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Rows (piece_key, sequence_id, offset) for a written table of (piece_key, length); keys are unique."""
    spark = lengths.sparkSession
    histogram = {r["length"]: r["n"] for r in lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "length bigint, lo bigint, hi bigint, per bigint, first_sequence bigint, first_offset bigint"
    slots = F.broadcast(spark.createDataFrame(places(histogram, max_len), schema))   # bounded by lengths and patterns
    ranked = rank_in_groups(lengths.select("piece_key", "length"), ["length"], ["piece_key"], sum(histogram.values()))
    placed = ranked.join(slots, "length").filter("rank >= lo AND rank < hi")
    return placed.select("piece_key", F.expr("first_sequence + (rank - lo) div per").alias("sequence_id"),
                         F.expr("first_offset + (rank - lo) % per * length").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids and places: (doc_id, piece, start, length, ids, sequence_id, offset)."""
    keyed = cut_pieces(docs, tokenizer_path, max_len, end_id).withColumn("piece_key", F.monotonically_increasing_id())
    pieces = materialize(keyed, "two-fit-pieces")
    done = pieces.join(place_pieces(pieces, max_len), "piece_key")
    return done.select("doc_id", "piece", "start", "length", wide_ids("ids", "length").alias("ids"), "sequence_id", "offset")
