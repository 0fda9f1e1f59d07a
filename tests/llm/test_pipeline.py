"""The stages against brute force, on a small table with the odd rows in it."""

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clearbid.llm import decontaminate, line_dedup, queries, simhash, toxicity
from tests.llm.cases import LONG
from tests.llm.test_simhash import slow_classes, slow_fingerprint

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"plain{k}" for k in range(51))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after every stage, over the small table plus odd rows and an extra column."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "src0", None), (9002, "", "en", None, 0), (9003, LONG, "en", "src1", len(LONG)), (None, "no id at all here", "en", "src1", 17)]
    odd += [(9010 + i, f"own page {i}\n {PASSAGE}\t\nend {i}", "en", f"src{i}", 1) for i in range(6)]
    odd += [(9020 + i, f"site menu\nabout number {i}\n\n", "en", "small host", 1) for i in range(5)]
    docs = base.union(spark.createDataFrame(odd, base.schema)).union(base.limit(2))
    docs.write.parquet(f"{root}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    out, docs = [("input", spark.read.parquet(f"{root}/documents.parquet").collect())], spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, root)
        if name != "packing":
            assert done.columns == columns
        done.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append((name, docs.collect()))
    return dict(out)


def slow_line_stage(rows):
    """The line rule row by row: which (doc_id, text, lang, source, n_chars) the stage returns."""
    def keys(text):
        return {x.strip(line_dedup.BLANKS) for x in (text or "").split("\n")} - {""}
    pages, on_host, texts = Counter(r["source"] for r in rows), Counter(), defaultdict(set)
    for r in rows:
        for line in keys(r["text"]):
            on_host[r["source"], line] += 1
            if len(line.split()) > line_dedup.LONG_WORDS:
                texts[line].add(r["text"])
    keeper = {line: min(t, key=lambda x: hashlib.md5(b"v" + x.encode()).hexdigest()) for line, t in texts.items() if len(t) >= line_dedup.MIN_PAGES}
    out = []
    for r in rows:
        text, n = r["text"], r["n_chars"]
        if text is not None:
            lost = {x for x in keys(text) if on_host[r["source"], x] >= line_dedup.MIN_PAGES and on_host[r["source"], x] > line_dedup.RATIO * pages[r["source"]]}
            lost |= {x for x in keys(text) if x in keeper and keeper[x] != text}
            if lost:
                text = "\n".join(x for x in text.split("\n") if x.strip(line_dedup.BLANKS) not in lost)
                n = len(text)
        out.append((r["doc_id"], text, r["lang"], r["source"], n))
    return out


def test_line_stage_drops_what_the_rule_says(stages):
    before, after = stages["toxicity"], stages["line_dedup"]
    told = slow_line_stage(before)
    assert Counter(told) == Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in after)
    # planted lines went: a passage of 51 words stays on one text, a menu on none
    planted = [r["text"] for r in before if r["text"] and PASSAGE in r["text"]]
    assert len(planted) >= line_dedup.MIN_PAGES and sum(PASSAGE in (r["text"] or "") for r in after) == 1
    assert not any("site menu" in (r["text"] or "") for r in after)


def test_one_document_of_each_class_stays(stages):
    before, after = stages["line_dedup"], stages["near_duplicates"]
    fps = {k: slow_fingerprint(r["text"]) for k, r in enumerate(before)}
    assert len(after) == len(set(slow_classes(fps).values()))
    kept = [slow_fingerprint(r["text"]) for r in after]
    assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(kept) for b in kept[:i])


def test_contaminated_documents_go_and_others_stay(stages, spark):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = set()
    for _, t in items:
        w = decontaminate.words_of(t)
        k = min(13, len(w))
        windows |= {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    keep = []
    for r in stages["near_duplicates"]:
        w, hit = decontaminate.words_of(r["text"]), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
        if not (hit and 20 * len(hit) >= len(w)):
            keep.append(r)
    key = lambda r: (r["doc_id"] is not None, r["doc_id"], r["text"] or "")
    assert sorted(stages["decontamination"], key=key) == sorted(keep, key=key)


def test_packing_covers_what_is_left(stages):
    ids = sorted(r["doc_id"] or -1 for r in stages["packing"] if r["start"] == 0)
    assert ids == sorted(r["doc_id"] or -1 for r in stages["decontamination"])


def test_empty_tables_pass_every_stage(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("labels", [[], [(i, 1, 1) for i in range(9)], [(i, 1, 0) for i in range(9)] + [(i, 1, 1) for i in range(100, 200)]],
                         ids=["empty", "one class", "unmatched"])
def test_documents_pass_without_usable_labels(spark, tmp_path, labels):
    words = [" ".join(f"w{(7 * i + 1) ** k % 1009}" for k in range(40)) for i in range(9)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(words)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == list(range(9))


def test_texts_reach_python_in_bounded_batches(spark):
    # before, a task's 400 texts of 50 KB came as one batch
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('some text ', 5000)").alias("text"))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([("a", "some words")], "item_id string, text string")
    rows_of = F.arrow_udf(lambda texts: pa.array([len(texts)] * len(texts), pa.int64()), "bigint")
    for stage in (lambda: toxicity.score(docs, labels), lambda: simhash.fingerprints(docs),
                  lambda: decontaminate.drop_documents(docs, benchmark), lambda: queries.packed(docs), lambda: queries.op13_two_fit(spark, SF)):
        spark.conf.unset(key)
        stage()
        assert docs.select(rows_of("text").alias("n")).agg(F.max("n")).first()[0] * 50_000 <= 4_000_000
    spark.conf.set(key, "1k")   # a size of the session's own stays
    toxicity.score(docs, labels)
    assert spark.conf.get(key) == "1k"
    spark.conf.unset(key)
