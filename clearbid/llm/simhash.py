"""SimHash near-duplicates through a byte-position inverted index.

A document's 64-bit fingerprint is eight positional bytes.  Two fingerprints
at ``max_bits`` = 4 or fewer differing bits differ in at most four bytes, so
they share at least ``8 - max_bits`` = 4 positional bytes: the guaranteed
minimum of matches.  A posting per single byte value would hold 1/256 of all
fingerprints, so tallying those would grow with the square of the corpus;
the postings here are by four positions and their four bytes (one for each of
the 70 choices of positions), which is the count filter as a key: a pair meets
in a posting exactly if its tally of shared bytes reaches the minimum.  Pairs
that meet are tallied over all eight bytes and verified bit by bit.

A posting emits at most one link fewer than it has members where it is large
(links that span what it connects, never all pairs); a posting of more than
``SPLIT`` members is dealt over block pairs, so none is worked in one task.
The classes are the connected components of the links.

Defined results: a null, empty or blank text has fingerprint zero and links
like any other; ties and repeated rows share a fingerprint and so a class; the
class id is the smallest doc_id in it, null only if all its ids are null; an
empty table gives an empty result.  Extra columns are ignored.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearbid.llm.common import components, content_key, fresh, LOWER_TABLE, materialize, ship, small_batches

ship(__name__)

SHINGLE = 4        # words
MAX_BITS = 4
SEED = 42
SMALL = 16         # members up to which a posting's pairs are compared side by side
SPLIT = 8192       # members above which a posting is dealt over block pairs


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles (repeats count), XXH64 of each."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        h = np.array([xxh64_intdigest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], np.uint64)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):
        bits = np.unpackbits(h[k:k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(t.as_py(), shingle) for t in batch], np.uint64).view(np.int64))

    small_batches(docs.sparkSession)
    return docs.withColumn(name, F.arrow_udf(run, "bigint")(F.col("text")))


def near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally of shared positional bytes reaches the minimum, then the exact bit distance."""
    x = np.atleast_1d(a ^ b)
    ok = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= 8 - max_bits
    ok[ok] = np.bitwise_count(x[ok]) <= max_bits
    return ok


def spanning(members: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the posting's pairs connect; each member is reached once."""
    out, rest = [], members
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            c = frontier.pop()
            ok = near(rest, c, max_bits)
            if ok.any():
                out.append((np.full(int(ok.sum()), c), rest[ok]))
                frontier.extend(rest[ok])
                rest = rest[~ok]
    return out


def link_postings(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within postings, given as rows sorted by key."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    links = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
    for s, n in zip(first[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        links += spanning(fps[s:s + n], max_bits)
    few = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    keys, fps = keys[few], fps[few]
    for d in range(1, SMALL):
        at = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(at):
            break
        at = at[near(fps[at], fps[at + d], max_bits)]
        links.append((fps[at], fps[at + d]))
    return np.concatenate([u for u, _ in links]), np.concatenate([v for _, v in links])


def posting_linker(max_bits: int, split: int | None):
    """mapInArrow function over rows (key, fp) sorted by key.

    Yields links (u, v, key null) and the members of postings above ``split``
    (u, v null, key).  Holds at most one posting and one batch at a time.
    """

    def rows(u, v, key):
        none = pa.nulls(len(u), pa.int64())
        as_long = lambda x: none if x is None else pa.array(np.asarray(x, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([as_long(u), as_long(v), as_long(key)], names=["u", "v", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.empty(0, np.uint64)
        large = None     # key whose rows are passed on
        for batch in batches:
            k = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            f = np.ascontiguousarray(batch.column(1).to_numpy(zero_copy_only=False)).view(np.uint64)
            if not len(k):
                continue
            if large is not None:
                n = int(np.searchsorted(k != large, True)) if k[-1] != large else len(k)
                yield rows(f[:n], None, k[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                large = None
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            cut = int(np.flatnonzero(keys[1:] != keys[:-1])[-1]) + 1 if (keys[1:] != keys[:-1]).any() else 0
            done, keys = keys[:cut], keys[cut:]
            done_fps, fps = fps[:cut], fps[cut:]
            if len(done):
                first = np.flatnonzero(np.concatenate([[True], done[1:] != done[:-1]]))
                sizes = np.diff(np.append(first, len(done)))
                over = np.repeat(sizes > split, sizes) if split else np.zeros(len(done), bool)
                if over.any():
                    yield rows(done_fps[over], None, done[over])
                u, v = link_postings(done[~over], done_fps[~over], max_bits) if not over.all() else (done[:0], done[:0])
                yield rows(u, v, None)
            if split and len(keys) > split:
                large = keys[0]
                yield rows(fps, None, keys)
                keys = fps = np.empty(0, np.uint64)
        if len(keys):
            u, v = link_postings(keys, fps, max_bits)
            yield rows(u, v, None)

    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that span all pairs within ``max_bits``."""
    schema = "u bigint, v bigint, key bigint"
    postings = []
    for n, chosen in enumerate(combinations(range(8), 8 - max_bits)):
        value = F.lit(0).cast("bigint")
        for p in chosen:
            value = F.shiftleft(value, 8).bitwiseOR(F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255)))
        postings.append(value.bitwiseOR(F.shiftleft(F.lit(n).cast("bigint"), 8 * (8 - max_bits))) if max_bits >= 4 else F.xxhash64(F.lit(n), value))
    index = nodes.select(F.explode(F.array(*postings)).alias("key"), "fp")
    found = materialize(index.repartition("key").sortWithinPartitions("key")
                        .mapInArrow(posting_linker(max_bits, split), schema), "links")
    links, large = found.filter("key is null").select("u", "v"), found.filter("key is not null").select("key", F.col("u").alias("fp"))
    if large.isEmpty():
        return links
    # a large posting: its members in blocks, each pair of blocks a cell of its own
    blocks = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) * 2 / split).cast("int").alias("blocks"))
    cells = (large.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp"))
    more = cells.repartition("key").sortWithinPartitions("key").mapInArrow(posting_linker(max_bits, None), schema)
    return links.union(materialize(more.select("u", "v"), "cell-links"))


def classes(rows: DataFrame, max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """(fp, root, component_id) for a written table of rows (doc_id, fp)."""
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(near_links(nodes, max_bits, split))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    rows = materialize(fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash")
    return rows.join(classes(rows, max_bits, split), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id, then the smallest content key.

    Rows of equal doc_id and text are told apart by their other columns, and
    reduced to one before they are gathered.
    """
    columns = docs.columns
    own_key, nth = fresh(docs, "__key", "__copy")
    key = content_key(F.col("doc_id"), F.col("text"))
    rows = materialize(fingerprints(docs.select("doc_id", "text"), shingle)
                       .select("doc_id", "fp", key.alias("__key")), "simhash")
    per_fp = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key")).alias("best"))
    labelled = per_fp.join(classes(rows, max_bits, split), "fp")
    chosen = labelled.groupBy("root").agg(F.min("best").alias("best")).select("best.__key")
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    once = F.row_number().over(Window.partitionBy(own_key).orderBy(*(others or [F.col(own_key)])))
    single = docs.withColumn(own_key, key).withColumn(nth, once).filter(F.col(nth) == 1)
    return single.join(chosen.withColumnRenamed("__key", own_key), own_key, "left_semi").select(*columns)
