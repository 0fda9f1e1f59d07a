import zlib

import numpy as np
from pyspark.sql import functions as F

from clearbid.llm import queries, toxicity
from tests.llm.cases import ODD, documents

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = queries.op9_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    got = found.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").toPandas()
    order = got["score"].rank()
    n1, n0 = int((got["toxic"] == 1).sum()), int((got["toxic"] == 0).sum())
    auc = (order[got["toxic"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert auc > 0.95
    assert (got["predicted"] == got["toxic"]).mean() > 0.95
    assert got["predicted"][got["toxic"] == 0].mean() < 0.01


def test_folds_and_odd_rows(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (6, 0, 0), (7, 0, 1), (7, 0, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, labels, "s").select("doc_id", "s", toxicity.held_out(F.col("doc_id")).alias("h"), "score").collect()
    assert len(got) == len(ODD) and all(0 <= r["s"] <= 1 and r["score"] == "x" for r in got)
    for r in got:
        assert r["h"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0)


def test_without_labels_nothing_is_rejected(spark):
    docs = documents(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, none, "s").filter("s > 0.5").count() == 0
    one = spark.createDataFrame([(i, 1, 1) for i in range(50)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, one, "s").filter("s > 0.5").count() == 0


def test_distinct_grams_match_a_set():
    last = toxicity.slots()
    for text in ["", "ab", "abcabcabc", "Éa\U0001F600 test test"]:
        ids = toxicity.gram_ids(text, last)
        assert len(ids) == len(set(ids.tolist()))
    assert np.array_equal(np.sort(toxicity.gram_ids("xyzw", last)), np.unique(toxicity.gram_ids("xyzw" , toxicity.slots() + 9)))


def test_empty_table(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(documents(spark, []), labels).count() == 0


def test_long_texts_teach_as_others_do(spark):
    texts = [(i, ("vile " if i % 2 else "kind ") * (1 + i % 7) + f"word{i}") for i in range(200)]
    long = [(1000 + i, "grim " * 20000 + f"word{i}") for i in range(40)]   # a word that only long texts hold
    docs = documents(spark, texts + long).withColumn("toxic", F.lit(9)).withColumn("h", F.lit(9))
    labels = spark.createDataFrame([(i, 1, int("kind" not in t)) for i, t in texts + long], "doc_id long, quality int, toxic int")
    asked = documents(spark, [(-1, "grim"), (-2, "kind")])
    got = {r["doc_id"]: r["s"] for r in asked.withColumn("s", toxicity.scorer(docs, labels)).collect()}
    assert got[-1] > 0.5 > got[-2]


def test_nothing_learnt_rejects_nothing(spark):
    texts = [(i, ("vile " * 40 if i % 2 else "kind ") + f"word{i}") for i in range(60)]
    docs = documents(spark, texts)
    schema = "doc_id long, quality int, toxic int"
    cases = [[], [(i, 1, 1) for i in range(60)], [(i, 1, 0) for i in range(60)],
             [(i, 1, 0) for i in range(60)] + [(i, 1, 1) for i in range(1000, 1300)]]   # the toxic ids have no document
    for rows in cases:
        assert toxicity.score(docs, spark.createDataFrame(rows, schema), "s").filter("s >= 0.5").count() == 0


def test_a_repeated_row_takes_one_place_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_PER_CLASS", 30)
    texts = [(i, ("vile " if i % 2 else "kind ") + f"word{i}") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    learnt = toxicity.train(documents(spark, texts), labels)
    for i in (1, 2, 3, 4, 6, 7, 8, 9):   # one row, whatever its hash, repeated beyond the sample
        repeated = toxicity.train(documents(spark, texts + [texts[i]] * 100), labels)
        assert all(np.array_equal(a, b) for a, b in zip(learnt, repeated))


def slow_grams(text):
    """Hashed n-grams of a text, one by one, in plain integers."""
    codes, out = [ord(c) for c in text.lower()], set()
    for n in toxicity.GRAMS:
        for i in range(len(codes) - n + 1):
            h = n
            for c in codes[i:i + n]:
                h = (h ^ c) * 0x9E3779B97F4A7C15 % 2**64
                h ^= h >> 29
            out.add(h >> (64 - toxicity.HASH_BITS))
    return out


def test_counts_ratios_and_scores_against_a_slow_form(spark):
    """The features are the hashed grams, their scale the naive Bayes log-count ratio, the score what the weights sum to."""
    rng = np.random.default_rng(3)
    pick = lambda words, k: " ".join(rng.choice(words, k))
    mild, harsh = ["river", "stone", "Garden", "window", "été", "paper"], ["vile", "Scum", "idiot", "stone", "paper"]
    told = [(i, pick(harsh if i % 3 == 0 else mild, 12)) for i in range(90)] + [(90, ""), (91, None), (92, "ab"), (93, "river " * 3000), (0, None)]
    marks = [(i, 1, int(i % 3 == 0)) for i in range(0, 90, 2)] + [(91, 0, 1), (92, 0, 0), (500, 0, 1)]
    docs, labels = documents(spark, told), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    weights, squares, bias = toxicity.train(docs, labels)

    toxic = {i: t for i, _, t in marks if zlib.crc32(str(i).encode()) % 5}
    taught = {(i, text or "") for i, text in told if i in toxic}
    counts, rows = ({}, {}), [0, 0]
    for i, text in taught:
        rows[toxic[i]] += 1
        for g in slow_grams(text):
            counts[toxic[i]][g] = counts[toxic[i]].get(g, 0) + 1
    ratios = {}
    for g in counts[0].keys() | counts[1].keys():
        a, b = counts[0].get(g, 0), counts[1].get(g, 0)
        r = np.log(b + 1) - np.log(rows[1] + 2) - np.log(a + 1) + np.log(rows[0] + 2)
        if a + b >= toxicity.MIN_ROWS and abs(r) >= toxicity.MIN_RATIO:
            ratios[g] = r
    assert ratios and set(np.flatnonzero(squares)) == set(ratios)
    assert all(abs(squares[g] - r * r) < 1e-4 for g, r in ratios.items())
    assert set(np.flatnonzero(weights)) <= set(ratios)

    got = {(r["doc_id"], r["text"]): r["s"] for r in toxicity.score(docs, labels, "s").collect()}
    for i, text in told:
        own = [g for g in slow_grams(text or "") if g in ratios]
        norm = sum(ratios[g] ** 2 for g in own) ** 0.5
        z = bias + (sum(float(weights[g]) for g in own) / norm if own else 0.0)
        assert abs(got[i, text] - 1 / (1 + np.exp(-z))) < 1e-5
    # the weights are those of a model that has learnt the two kinds of words
    assert all((got[i, t] >= 0.5) == (i % 3 == 0) for i, t in told[:90] if i or t)


def test_the_fitted_model_is_near_the_best_one():
    """Steps of the optimizer against plain gradient descent on the same loss, run much longer."""
    texts = ["vile scum here", "a vile idiot", "garden stone", "river stone here", "vile garden", "stone river"] * 4
    y = np.array([1, 1, 0, 0, 1, 0] * 4, float)
    rows = [toxicity.gram_ids(t, toxicity.slots()) for t in texts]
    counts = np.zeros((2, 1 << toxicity.HASH_BITS))
    for ids, toxic in zip(rows, y):
        counts[int(toxic)][ids] += 1
    ratio = toxicity.ratios(counts, np.bincount(y.astype(int)).astype(float))
    weights, squares, bias = toxicity.fit([ids[ratio[ids] != 0] for ids in rows], ratio, y, np.ones(len(y)))
    grams = sorted(set().union(*map(slow_grams, texts)) & set(np.flatnonzero(squares)))
    x = np.array([[np.sqrt(squares[g]) if g in slow_grams(t) else 0.0 for g in grams] for t in texts])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    loss = lambda z: float(np.mean(np.logaddexp(0, z) - y * z))
    own = np.array([bias + sum(float(weights[g]) for g in slow_grams(t)) / np.sqrt(sum(float(squares[g]) for g in slow_grams(t))) for t in texts])
    assert loss(own) < 0.05 and ((own > 0) == (y == 1)).all()
    w, b = np.zeros(len(grams)), 0.0
    for _ in range(2000):
        err = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - 0.5 * x.T @ err / len(y), b - 0.5 * err.mean()
    assert loss(own) < 1.2 * loss(x @ w + b) + 0.01
