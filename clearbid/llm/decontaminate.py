"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased.  A window is ``WINDOW`` consecutive words of a benchmark item; an
item with fewer words, but not none, is one window.  The windows are broadcast
in blocks of about ``block_bytes`` of item text, one scan of the texts for each
block, so a benchmark of any size keeps its bound.  Scans before the last write
what they have found alone, by the text's key, and the last one brings it
together with the documents.  Each document's words become vocabulary numbers;
places where a whole window of known words stands are looked up by a rolling
hash and verified word by word.

Defined results: null or empty texts have no words and no hits; an item without
words has no window; repeated items (equal id) count once; a null item_id hits
under the name ``null``; repeated documents get equal results; empty tables give
empty or hit-free results.  Extra columns of ``docs`` ride along.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbid.llm.common import ALNUM_TABLE, content_key, fresh, materialize, ship, small_batches

ship(__name__)

WINDOW = 13
BLOCK_BYTES = 8 << 20     # item text in one broadcast block (some 1,200,000 windows of 12 bytes each, and the words)
SHARE = 20                # contaminated: SHARE * n_hit >= n_words

HITS = "struct<n_words:bigint,n_hit:bigint,spans:array<struct<first:bigint,last:bigint>>,items:array<string>>"
# the characters that are no word characters, A-Z being letters here
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split()


class WindowIndex:
    """Windows of a block of items: each place in the items' words, sorted by the hash of the window there."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        numbers = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)] for _, text in items]
        lengths = np.array([len(n) for n in numbers], np.int64)
        self.ends = np.cumsum(lengths)
        self.words = np.array([w for n in numbers for w in n], np.uint32)
        self.mix = np.random.default_rng(7).integers(1, 1 << 63, window, dtype=np.uint64) | np.uint64(1)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}   # words in a window -> hashes in order, places
        sizes = np.minimum(lengths, window)
        begins = self.ends - lengths
        for k in np.unique(sizes[sizes > 0]).tolist():
            own = np.flatnonzero(sizes == k)
            places = np.concatenate([np.arange(begins[i], self.ends[i] - k + 1, dtype=np.int64) for i in own])
            h = self.roll(self.words, places, k)
            order = np.argsort(h, kind="stable")
            self.windows[k] = h[order], places[order]

    def roll(self, words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
        h = np.zeros(len(starts), np.uint64)
        for j in range(k):
            h = (h ^ words[starts + j].astype(np.uint64)) * self.mix[j]
            h ^= h >> np.uint64(31)
        return h

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(first word, last word) of each place where a window occurs, and the items that hold one of them."""
        get = self.vocabulary.get
        number = np.array([get(w, 0) for w in words], np.uint32)
        known = np.concatenate([[0], np.cumsum(number > 0)])
        spans, items = [], set()
        for k, (hashes, places) in self.windows.items():
            if len(words) < k:
                continue
            starts = np.flatnonzero(known[k:] - known[:-k] == k)
            if not len(starts):
                continue
            h = self.roll(number, starts, k)
            lo = np.searchsorted(hashes, h)
            met = hashes[np.minimum(lo, len(hashes) - 1)] == h
            hi = np.searchsorted(hashes, h[met], "right")
            seen: dict[bytes, bool] = {}   # each distinct window of the document is compared once
            for i, a, b in zip(starts[met].tolist(), lo[met].tolist(), hi.tolist()):
                here = number[i:i + k]
                key = here.tobytes()
                if key not in seen:
                    equal = np.ones(b - a, bool)
                    for j in range(k):
                        equal &= self.words[places[a:b] + j] == here[j]
                    seen[key] = bool(equal.any())
                    holders = np.unique(np.searchsorted(self.ends, places[a:b][equal], "right"))
                    items.update(self.names[n] for n in holders.tolist())
                if seen[key]:
                    spans.append((i, i + k - 1))
        return spans, items


def scanner(items, window: int):
    """Arrow UDF (text, list of hits of earlier blocks) -> hits, over one broadcast block."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index = WindowIndex(items.value, window)
        for texts, earlier in batches:
            out = []
            for text, before in zip(texts, earlier):
                words, before = words_of(text.as_py()), before.as_py()
                spans, names = index.scan(words)
                for hit in before or []:
                    names |= set(hit["items"])
                    spans += [(s["first"], s["last"]) for s in hit["spans"]]
                merged: list[list[int]] = []
                for a, b in sorted(spans):
                    if merged and a <= merged[-1][1] + 1:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                out.append({"n_words": len(words), "n_hit": sum(b - a + 1 for a, b in merged),
                            "spans": [{"first": a, "last": b} for a, b in merged], "items": sorted(names)})
            yield pa.array(out, HITS_ARROW)

    return F.arrow_udf(run, HITS)


HITS_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("items", pa.list_(pa.string()))])


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
              name: str = "hits") -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, n_hit, merged spans of hit words, item ids.

    A column of that name is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("words")).distinct()   # copies would share a block
    total = items.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_bytes))

    def scan(b: int):
        rows = items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b).collect()   # about block_bytes of text
        return scanner(spark.sparkContext.broadcast([(r["item"], r["words"]) for r in rows]), window)

    none = F.lit(None).cast(f"array<{HITS}>")
    if blocks == 1:
        return docs.withColumn(name, scan(0)(F.col("text"), none))
    found = None
    for b in range(blocks - 1):
        once = scan(b).asNondeterministic()   # else the filter would scan the texts a second time
        hits = docs.select(content_key(F.col("text")).alias("key"), once(F.col("text"), none).alias("hit")).filter("hit.n_hit > 0")
        hits = materialize(hits.groupBy("key").agg(F.first("hit").alias("hit")), "hits")   # equal texts have equal hits
        found = hits if found is None else found.union(hits)
    key, earlier = fresh(docs, "__text_key", "__earlier")
    one = found.groupBy("key").agg(F.collect_list("hit").alias(earlier)).withColumnRenamed("key", key)   # one hit per block and text
    joined = docs.withColumn(key, content_key(F.col("text"))).join(one, key, "left")
    return joined.withColumn(name, scan(blocks - 1)(F.col("text"), F.col(earlier))).select(*[c for c in docs.columns if c != name], name)


def contaminated(hits: str = "hits", share: int = SHARE) -> Column:
    n_hit, n_words = F.col(hits)["n_hit"], F.col(hits)["n_words"]
    return (n_hit > 0) & (share * n_hit >= n_words)


def drop_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, unchanged."""
    name, = fresh(docs, "__hits")
    return find_hits(docs, benchmark, name=name, **options).filter(~contaminated(name)).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with every hit span, first word to last word, cut out of the text."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import re
        for texts, hits in batches:
            out = []
            for text, hit in zip(texts, hits):
                text, spans = text.as_py(), hit.as_py()["spans"]
                if spans:
                    at = [m.span() for m in re.finditer(WORD, text)]
                    for s in reversed(spans):
                        text = text[:at[s["first"]][0]] + text[at[s["last"]][1]:]
                out.append(text)
            yield pa.array(out, pa.string())

    name, = fresh(docs, "__hits")
    found = find_hits(docs, benchmark, name=name, **options)
    return found.withColumn("text", F.arrow_udf(run, "string")(F.col("text"), F.col(name))).select(*docs.columns)
