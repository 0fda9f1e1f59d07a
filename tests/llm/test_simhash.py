import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clearbid.llm import queries, simhash
from tests.llm.cases import ODD, documents, rows

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, w = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\f\r":
            if w:
                words.append(w)
            w = ""
        else:
            w += c
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(fps, max_bits=4):
    """fp per id -> smallest linked id, by all pairs."""
    parent = {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= max_bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_against_plain_python():
    texts = ["a b c", "A b\tc  d e", "", None, " \n ", "É é İ K ß x y z", " ".join(random.Random(1).choices("abcdefgh", k=9000))]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_query_against_all_pairs(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    want = slow_classes(fps)
    got = queries.op8_simhash(spark, SF).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted(
        (i, f"{fps[i]:016x}", want[i]) for i in texts)


@pytest.mark.parametrize("split", [8192, 20])
def test_dense_balls_and_chains_against_all_pairs(spark, split):
    """Many fingerprints near one centre, a chain of 4-bit steps, far ones; small postings limit forces block pairs."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    step = rng.getrandbits(64)
    for k in range(12):
        fps.add(step)
        step ^= sum(1 << b for b in rng.sample(range(64), 4))
    fps |= {rng.getrandbits(64) for _ in range(100)}
    by_id = dict(enumerate(sorted(fps)))
    frame = spark.createDataFrame([(i, signed(f)) for i, f in by_id.items()], "doc_id long, fp long")
    found = frame.join(simhash.classes(frame, split=split), "fp").select("doc_id", "component_id").collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == slow_classes(by_id)


def test_links_of_a_posting_span_but_are_few():
    members = np.array([0] + [1 << b for b in range(60)], np.uint64)
    u, v = simhash.link_postings(np.zeros(len(members), np.uint64), members, 4)
    assert len(u) == len(members) - 1


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    found = rows(simhash.near_duplicates(docs), "doc_id", "fp", "component_id")
    assert len(found) == len(ODD)
    classes = {r[0]: r[2] for r in found}
    assert classes[1] == classes[2] == classes[3] == 1     # no words: fingerprint zero, linked
    assert classes[4] == classes[7] == 4
    assert {r[1] for r in found if r[0] in (1, 2, 3)} == {0}


def test_keep_one_of_each_class(spark):
    docs = documents(spark, ODD)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 4, 5, 6]
    assert kept.filter("doc_id is null").count() == 1
    assert simhash.keep_one(docs.filter("false")).count() == 0


def test_rows_without_ids_keep_one_of_each_class(spark):
    docs = documents(spark, [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (None, "quite another text than that")])
    assert simhash.keep_one(docs).count() == 2
    assert simhash.near_duplicates(docs).filter("component_id is null").count() == 3


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_copies_do_not_multiply_postings(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("same text in all of these rows").alias("text"))
    assert rows(simhash.near_duplicates(docs), "component_id") == [(0,)] * 300
