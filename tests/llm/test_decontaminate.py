import numpy as np
import pytest
from pyspark.sql import functions as F

from clearbid.llm import decontaminate
from tests.llm.cases import documents


def slow(text, items, window):
    """(n_words, n_hit, item ids) by comparing every window with every place."""
    words, hit, names = decontaminate.words_of(text), set(), set()
    for name, item in items:
        own = decontaminate.words_of(item)
        k = min(window, len(own))
        for i in range(len(own) - k + 1 if k else 0):
            for j in range(len(words) - k + 1):
                if words[j:j + k] == own[i:i + k]:
                    hit.update(range(j, j + k))
                    names.add("null" if name is None else str(name))
    return len(words), len(hit), sorted(names)


def table(seed):
    """Items that share a passage, short items and copies; texts that quote them, some of them repeated."""
    rng = np.random.default_rng(seed)
    pick = lambda k: " ".join(rng.choice(["red", "Blue", "grün", "7", "x"], k))
    shared = pick(9)
    items = [(i, f"{pick(rng.integers(0, 6))} {shared if i % 3 == 0 else ''} {pick(rng.integers(0, 8))}") for i in range(24)]
    items += [(None, "red blue 7"), (100, "x"), (101, None), (102, ""), items[0], (items[0][0], "grün grün grün grün")]
    texts = [(i, " and ".join([pick(rng.integers(0, 12)), shared if i % 2 else "", items[i % 24][1]])) for i in range(40)]
    return items, [*texts, texts[1], texts[1], (77, None), (77, ""), (None, texts[3][1])]


@pytest.mark.parametrize("block_bytes", [1 << 20, 300, 60])
def test_hits_against_brute_force(spark, block_bytes):
    items, texts = table(5)
    docs = documents(spark, texts).withColumn("key", F.lit(1)).withColumn("__earlier", F.lit("e")).withColumn("hit", F.col("doc_id"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_hits(docs, bench, window=5, block_bytes=block_bytes, name="got")
    assert found.columns == [*docs.columns, "got"]
    got = [(r["doc_id"], r["text"], r["got"]["n_words"], r["got"]["n_hit"], r["got"]["items"], r["hit"]) for r in found.collect()]
    want = [(i, text, *slow(text, items, 5), i) for i, text in texts]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {w[3] > 0 for w in want} == {True, False}


def test_equal_hashes_are_told_apart_by_words():
    items, texts = table(6)
    named = [("null" if i is None else str(i), t or "") for i, t in items]
    index = decontaminate.WindowIndex(named, 5)
    index.roll = lambda words, starts, k: np.zeros(len(starts), np.uint64)
    index.windows = {k: (np.zeros_like(h), places) for k, (h, places) in index.windows.items()}
    for _, text in texts:
        spans, names = index.scan(decontaminate.words_of(text))
        assert (len({w for a, b in spans for w in range(a, b + 1)}), sorted(names)) == slow(text, items, 5)[1:]
