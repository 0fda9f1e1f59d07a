"""Rules against their SQL on planted rows, and columns whose names the operators would take."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clearbid.llm import decontaminate, divergence, filter_audit, licenses, line_dedup, oracles, packing, quality, queries, revisits, sharding, simhash, toxicity, two_fit
from tests.llm.cases import rows

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def both(spark, folder, name, docs):
    """Rows of a registered query and of its SQL over ``docs`` as the table documents."""
    docs.write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = queries.QUERIES[name](spark, str(folder))
    told = con.execute(oracles.ORACLES[name])
    at = [d[0] for d in told.description]
    key = lambda r: tuple((x is not None, x) for x in r)
    one, two = rows(found, *at), sorted(told.fetchall(), key=key)
    assert one == two
    return [dict(zip(at, r, strict=True)) for r in one]


NOTICES = [(1, "Licensed under the GNU General Public License, version 3."), (2, "Licensed under the GNU Lesser General Public License, version 3."),
           (3, "Released under the Apache License."), (4, "released under the BSD license"), (5, "Released under the MIT License"),
           (6, "x\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted\ny"),
           (7, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."), (8, "licensed under CC BY 4.0"),
           (9, "licensed under cc by nc 4 0"), (10, None), (11, ""), (12, "released under\nthe mit\nlicense"), (13, "released\nunder the\n\nmit license"),
           (14, "Licensed under the GNU General Public License,\nversion 3"), (15, "the mit\nunder released x"), (16, "licensed under the license version 2 0")]


def test_licenses_by_name_and_in_wrapped_lines(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in NOTICES], COLUMNS)
    got = {r["doc_id"]: r["labels"] for r in both(spark, tmp_path, "op5_licenses", docs)}
    assert got == {1: "gpl", 2: "gpl,lgpl", 3: "", 4: "", 5: "mit", 6: "bsd", 7: "mpl-2.0", 8: "cc-by", 9: "cc-by,cc-by-nc", 10: "", 11: "",
                   12: "mit", 13: "", 14: "gpl", 15: "", 16: ""}


def test_planted_host_is_rejected(spark, tmp_path):
    good = " ".join(f"w{k}" for k in range(60))
    told = [(i, "too short" if i % 2 else f"{good} {i}", "en", "spam", None) for i in range(100)]           # half of it fails
    told += [(1000 + i, "brief" if i % 25 == 0 else f"{good} {i}", "en", f"h{i % 9}", None) for i in range(900)]
    told += [(5000 + i, "brief", "en", "new", None) for i in range(2)] + [(6000, None, "en", None, None), (6001, good, "en", None, None)]
    got = both(spark, tmp_path, "op2_quality", spark.createDataFrame(told, COLUMNS))
    lost = {r["doc_id"] for r in got if not r["kept"] and not r["base_failed"]}
    assert lost == {i for i in range(100) if i % 2 == 0}


def test_planted_passages_and_boilerplate(spark, tmp_path):
    passage, fifty = " ".join(f"p{k}" for k in range(51)), " ".join(f"q{k}" for k in range(50))
    told = [(i, f"menu\nown {i}", "en", "a", None) for i in range(6)] + [(10 + i, f"own {i}\n {passage}\t\nend", "en", f"h{i}", None) for i in range(5)]
    told += [(20 + i, f"{fifty}\nown {i} x", "en", f"g{i}", None) for i in range(5)] + [(30, None, "en", "a", None), (31, "", None, None, None)]
    told += [(40 + i, f"{passage} twice\nown {i} z", "en", f"k{i}", None) for i in range(2)]
    got = {r["doc_id"]: r for r in both(spark, tmp_path, "op4_line_dedup", spark.createDataFrame(told, COLUMNS))}
    assert all(got[i]["text"] == f"own {i}" for i in range(6))
    assert sum(passage in got[10 + i]["text"] for i in range(5)) == 1
    assert all(got[20 + i]["n_dropped"] == 0 for i in range(5)) and all(got[40 + i]["n_dropped"] == 0 for i in range(2))


def test_header_names_in_any_case_and_an_early_record(spark):
    data = [(1, "http://a.com/x", 1_000_000, "response", {"ETag": "zzz", "Content-Type": "t"}), (2, "http://a.com/x", 1_000_100, "revisit", {"ETAG": "e1"}),
            (3, "http://a.com/x", 1_000_200, "revisit", {"etag": "W/zzz", "Date": "d"}), (4, "http://a.com/x", 1_000_300, "revisit", {"Etag": "e1", "eTag": "zzz"}),
            (5, "http://a.com/y", 0, "response", {}), (6, None, 1_000_000, "response", {"etag": "e"}), (7, None, 1_000_001, "revisit", {"etag": "e"}),
            (8, "http://a.com/x", None, "revisit", {})]
    data += [(100 + i, "http://hot.com/", 1_000_000 + i, "response" if i % 3 == 0 else "revisit", {"Last-Modified": f"m{i // 3}"}) for i in range(300)]
    df = spark.createDataFrame(data, "record_id long, url string, at long, kind string, headers map<string,string>").withColumn("ts", F.timestamp_seconds("at"))
    got = {r["record_id"]: (r["ref_record_id"], r["outcome"], r["headers"]) for r in revisits.resolve(df).collect()}
    assert got[2] == (None, "validators differ", None) and got[3] == (1, "resolved", {"etag": "W/zzz", "content-type": "t", "date": "d"})
    assert got[4][:2] == (1, "resolved") and got[7][:2] == (None, "no earlier response") and got[8][:2] == (None, "no earlier response")
    assert all(got[100 + i][:2] == (100 + i - i % 3, "resolved") for i in range(300) if i % 3)


TAKEN = [["n_dropped", "__key", "__drop", "__hits", "__copy", "hits", "piece_key", "cell", "rank", "words", "key", "blocks"], ["__KEY"]]


@pytest.mark.parametrize("names", TAKEN, ids=["taken", "case"])
def test_columns_of_any_name_ride_along(spark, names):
    name = names[0]
    words = " ".join(f"w{k}" for k in range(60))
    told = [(1, words), (1, words), (2, None), (3, ""), (4, "menu\n" + words + " x y z"), (5, "menu\nlone item words here"), (6, "menu\nother words")]
    docs = spark.createDataFrame([(i, t, "en", "s", None, *[f"own {n}"] * len(names)) for n, (i, t) in enumerate(told)],
                                 ", ".join([COLUMNS, *[f"`{c}` string" for c in names]]))
    own = lambda df: [sorted(r[c] for r in df.collect()) for c in names]
    every = [[f"own {n}" for n in range(7)]] * len(names)
    bench = spark.createDataFrame([(1, "lone item words here")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")

    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r[name] for r in kept.collect()} <= {f"own {n}" for n in range(7)}
    assert {r[name] for r in kept.filter("doc_id = 1").collect()} == {"own 0"}
    clean = corpus_pipeline.drop_boilerplate(spark, docs, "")
    assert clean.columns == docs.columns and own(clean) == every
    counted = line_dedup.dedup_lines(docs)
    assert counted.columns == [c for c in docs.columns if c != "n_dropped"] + ["n_dropped"] and counted.count() == 7
    left = decontaminate.drop_documents(docs, bench)
    assert left.columns == docs.columns and own(left) == [[x for x in e if x != "own 5"] for e in every]
    cut = decontaminate.remove_spans(docs, bench)
    assert cut.columns == docs.columns and own(cut) == every
    for df in (quality.judge(docs), licenses.scan(docs), simhash.near_duplicates(docs), sharding.shard_documents(docs), toxicity.score(docs, labels)):
        assert df.count() == 7
    assert divergence.audit(docs, 1).filter("part = 'term'").count() == 0 and filter_audit.audit(docs, labels).count() == 600
    assert packing.pack(docs, queries.public_tokenizers.path(queries.TOKENIZER)).count() == 7
    assert two_fit.pack(docs, queries.public_tokenizers.path(queries.BYTE_TOKENIZER)).count() == 7


def test_rows_that_differ_in_other_columns_only_are_picked_alike(spark):
    told = [(1, "a b c d e", lang, source, n) for n, (lang, source) in enumerate([("fr", "b"), ("en", "c"), ("en", "a"), (None, "z"), (None, "z")])]
    for seed in range(3):
        docs = spark.createDataFrame(sorted(told, key=lambda r: hash((seed, r[4]))), COLUMNS).repartition(3)
        assert [(r["lang"], r["source"], r["n_chars"]) for r in simhash.keep_one(docs).collect()] == [(None, "z", 3)]


def test_license_names_are_template_words():
    words = {w for _, t in licenses.TEMPLATES for w in t.split()}
    assert words >= licenses.NAMES
