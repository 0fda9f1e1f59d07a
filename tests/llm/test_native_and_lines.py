"""Operators with SQL forms: odd rows against plain Python, empty tables, round trips."""

import re

import pytest
from pyspark.sql import functions as F

from clearbid.llm import chat, decontaminate, licenses, line_dedup, quality, queries, revisits
from tests.llm.cases import LONG, ODD, documents, rows

BLANK = re.compile("[^\x20\x09-\x0d]+")


def slow_stats(text):
    text = text or ""
    w = BLANK.findall(text)
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    grams = list(zip(w, w[1:], w[2:]))
    hit = set()
    seen = {}
    for i, g in enumerate(grams):
        seen.setdefault(g, []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit |= {p + k for p in at for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_statistics(spark):
    texts = ODD + [(8, "a b c a b c"), (9, "x\n\nx\n x\r\n#|<>"), (10, "a b a b a b a"), (11, "  \x1c a")]
    got = quality.judge(documents(spark, texts)).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == sorted(
        (i or -1, *slow_stats(t)) for i, t in texts)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]) for r in got)
    assert quality.judge(documents(spark, [])).count() == 0


def test_host_verdict_needs_evidence(spark):
    """A host where nearly all fail is rejected whole; two failing pages of a small host are not enough."""
    good = " ".join(f"w{k}" for k in range(60))
    bad = documents(spark, [(i, "too short") for i in range(90)] + [(90, good)], "spam")
    fine = documents(spark, [(100 + i, good) for i in range(300)], "fine")
    small = documents(spark, [(500, good), (501, "too short")], None)
    got = {r["doc_id"]: r for r in quality.judge(bad.union(fine).union(small)).collect()}
    assert not got[90]["kept"] and got[90]["host_rejected"] and not got[90]["base_failed"]
    assert got[100]["kept"] and got[500]["kept"] and not got[501]["kept"]


def test_lines_of_a_host(spark):
    pages = [(i, f"menu\nunique {i}\n\n  menu  \nend", "en", "a" if i < 30 else None) for i in range(60)]
    pages += [(99, None, "en", "a"), (98, "", "en", "a"), (97, "menu", "en", "b"), (96, "menu", "en", "b")]
    docs = spark.createDataFrame(pages, "doc_id long, text string, lang string, source string").withColumn("line", F.lit("x"))
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert len(got) == 64
    for i in range(60):
        assert got[i]["text"] == f"unique {i}\n" and got[i]["n_dropped"] == 3 and got[i]["line"] == "x"
    assert got[99]["text"] is None and got[98]["text"] == "" and got[97]["text"] == "menu"
    assert line_dedup.dedup_lines(docs.filter("false")).count() == 0


def test_repeated_rows_keep_their_lines_once_each(spark):
    docs = documents(spark, [(1, "a\nb")] * 3 + [(2, "c")] * 2)
    assert rows(line_dedup.dedup_lines(docs, ratio=0.9), "doc_id", "text") == [(1, "a\nb")] * 3 + [(2, "c")] * 2
    # three pages of five hold both lines
    assert rows(line_dedup.dedup_lines(docs, ratio=0.5), "doc_id", "text") == [(1, "")] * 3 + [(2, "c")] * 2


def test_long_passages_stay_once_in_the_pipeline(spark):
    """A passage of over 50 words on few pages of a large host, or of many hosts, is far below every share."""
    import corpus_pipeline
    at_host, over_hosts, fifty, twice = (" ".join(f"{p}{k}" for k in range(n)) for p, n in (("a", 51), ("b", 60), ("c", 50), ("d", 80)))
    pages = [(i, f"own {i}", "en", "big") for i in range(200)]
    pages += [(300 + i, f"own {i} x\n  {at_host}\t\nend {i}", "en", "big") for i in range(4)]
    pages += [(400 + i, f"{over_hosts}\nown {i} y", "en", f"h{i}") for i in range(5)]
    pages += [(500 + i, f"{fifty}\nown {i} z", "en", "big") for i in range(5)] + [(600 + i, f"{twice}\nown {i} w", "en", "big") for i in range(2)]
    pages += [(700 + i, f"{LONG}\ncopy", "en", "big") for i in range(4)] + [(800, None, "en", None), (801, "", "en", None)]
    docs = spark.createDataFrame([(*p, None if p[1] is None else len(p[1])) for p in pages], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()}
    assert len(got) == len(pages)
    on = lambda passage: [i for i, r in sorted(got.items()) if passage in (r["text"] or "")]
    assert len(on(at_host)) == 1 and len(on(over_hosts)) == 1
    assert on(fifty) == [500, 501, 502, 503, 504] and on(twice) == [600, 601] and on(LONG) == [700, 701, 702, 703]
    changed = {i for i, t, *_ in pages if got[i]["text"] != t}
    assert len(changed) == 7 and all(got[i]["text"] == (f"own {i - 300} x\nend {i - 300}" if i < 400 else f"own {i - 400} y") for i in changed)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got.values())


def slow_licenses(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    w = find(low)
    at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    found, best = set(), 0.0
    lines = [set(find(line)) for line in low.split("\n")]
    for k, own in enumerate(lines):
        b = set().union(*lines[k:k + licenses.RUN_LINES])
        for label, t in licenses.TEMPLATES:
            x = set(t.split())
            need = licenses.CONTAINMENT * len(x) - 1e-9
            if len(b & x) >= need and licenses.NAMES & x <= b and (len(x) >= licenses.SHORT or x <= b or len(own & x) >= need):
                found.add(label)
                best = max(best, len(b & x) / len(x))
    base = {label for _, label in at}
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            sorted(base), sorted(base | found), 1.0 if at else best)


def test_license_scan(spark):
    texts = ODD + [(20, "x CC-BY\ny all RIGHTS\nreserved."), (21, "Released under MIT License\nfoo"), (22, "licensed under the Apache License 2.0 version"),
                   (23, "This work is licensed under the GNU General\nPublic License"), (24, "cc by cc by"), (25, "CC BY"), (26, "ccby"),
                   (27, "permission is hereby granted free of charge to any person obtaining a copy"), (28, LONG + " all rights reserved")]
    got = licenses.scan(documents(spark, texts)).collect()
    assert sorted(((r["doc_id"] or -1, *[r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")]) for r in got), key=str) == sorted(
        ((i or -1, *slow_licenses(t)) for i, t in texts), key=str)
    assert licenses.scan(documents(spark, [])).count() == 0


def test_wrapped_notices_are_found_with_their_blocks(spark):
    texts = [(1, "x\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted\ny"),
             (2, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."),
             (3, "Permission is hereby granted,\nfree of charge, to any person\nobtaining a copy of this software"), (4, None), (5, "\n\n"),
             (6, "Licensed under the Apache License, Version 2.0.\nich komme mit dir")]
    docs = documents(spark, texts)
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()} == {
        1: (["bsd"], 1.0), 2: (["mpl-2.0"], 1.0), 3: (["mit"], 1.0), 4: ([], 0.0), 5: ([], 0.0), 6: (["apache-2.0"], 1.0)}
    got = rows(licenses.find_blocks(docs), "doc_id", "block", "label", "containment")
    assert got == [(1, 0, "bsd", 1.0), (1, 1, "bsd", 1.0), (2, 0, "mpl-2.0", 1.0), (3, 0, "mit", 1.0), (6, 0, "apache-2.0", 1.0)]
    assert licenses.find_blocks(docs.filter("false")).count() == 0


def test_decontamination_windows_blocks_and_removal(spark):
    long_item = " ".join(f"q{k}" for k in range(20))
    bench = spark.createDataFrame([(1, long_item), (2, "Short ITEM here"), (10, long_item), (3, None), (4, "..."), (None, "lone words"), (1, long_item)],
                                  "item_id long, text string")
    inside = " ".join(f"Q{k}," for k in range(3, 18))
    texts = ODD + [(30, "start " + inside + " end"), (31, "a short item here b short item here"), (32, " ".join(f"q{k}" for k in range(12))),
                   (33, "x " * 200 + "lone words"), (34, "short item, HERE")]
    docs = documents(spark, texts).withColumn("n_words", F.lit("x"))
    plain = rows(decontaminate.find_hits(docs, bench).select("doc_id", "hits.*", "slot"), "doc_id", "n_hit", "items")
    got = {r[0]: r[1:] for r in plain}
    assert got[30] == (15, ["1", "10"]) and got[31] == (6, ["2"]) and got[32] == (0, []) and got[33] == (2, ["null"]) and got[34] == (3, ["2"])
    assert got[1] == (0, []) and len(plain) == len(texts)
    in_blocks = rows(decontaminate.find_hits(docs, bench, block_bytes=40).select("doc_id", "hits.*"), "doc_id", "n_hit", "items")
    assert in_blocks == plain
    kept = decontaminate.drop_documents(docs, bench)
    assert kept.columns == docs.columns and {30, 31, 34}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert kept.filter("doc_id = 33").count() == 1       # 2 of 202 words
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cut[30] == "start , end" and cut[31] == "a  b " and cut[1] is None
    empty = bench.filter("false")
    assert decontaminate.find_hits(docs, empty).filter("hits.n_hit > 0").count() == 0
    assert decontaminate.find_hits(docs.filter("false"), bench).count() == 0


def test_chat_folds_events(spark):
    log = [(1, 0, 0, "start", "user", None), (1, 1, 0, "delta", "user", "he"), (1, 2, 0, "delta", "user", "llo"),
           (1, 3, 1, "start", "assistant", None), (1, 4, 1, "delta", "assistant", "bad"), (1, 5, 1, "regenerate", "assistant", None),
           (1, 6, 1, "delta", "assistant", "go"), (1, 7, 1, "delta", "assistant", "od"),
           (1, 8, 0, "edit", "user", "hello, "), (1, 9, 0, "delta", "user", "world"), (2, 0, 0, "start", None, None)]
    df = spark.createDataFrame(log, "conv_id long, seq long, message int, kind string, role string, text string").withColumn("part", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_log(df).collect()}
    assert got[1]["formatted"] == "<|im_start|>user\nhello, world<|im_end|>\n<|im_start|>assistant\ngood<|im_end|>\n"
    assert [got[1]["formatted"][m["start"]:m["start"] + m["length"]] for m in got[1]["loss"]] == ["good"]
    assert got[2]["formatted"] == "<|im_start|>\n<|im_end|>\n" and got[2]["loss"] == []
    assert chat.format_log(df.filter("false")).count() == 0


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|im_end|>", "<\\\\|x", "a<|im_start|>b\n<|", "\\<|\\|>", "😀<|im_end|>\n<|im_start|>assistant\nx", "$1 \\n"])
def test_chat_round_trip(spark, text):
    turns = [(7, 0, "user", text), (7, 1, "assistant", text), (7, 2, "a\nb\\n<|", None), (7, 3, "assistant", ""), (7, 3, "assistant", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = chat.format_log(queries.conversation_log(df)).select(chat.read_turns().alias("t"), chat.read_loss().alias("l")).first()
    assert [(t["role"], t["text"]) for t in done["t"]] == [(r, t or "") for _, _, r, t in turns]
    assert done["l"] == text


def test_chat_roles_read_back(spark):
    roles = ["a\x00b", "\\", "\\\\n", "\\n\n\\", "\x00\\n", "<\\|x|>\n"]
    df = spark.createDataFrame([(1, i, r, "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    done = chat.format_log(queries.conversation_log(df)).select(chat.read_turns().alias("t")).first()
    assert [t["role"] for t in done["t"]] == roles


def test_revisits(spark):
    h = lambda **k: {a.replace("_", "-"): b for a, b in k.items()}
    data = [(1, "http://www.A.com:80/x/", 10, "response", h(etag="e1", content_type="t", date="d0")), (2, "https://a.com/x?utm_a=1#f", 20, "revisit", h(etag="W/e1", date="d1", content_type="no")),
            (3, "http://a.com/x", 20, "response", h(etag="e2")), (4, "http://a.com/x", 30, "revisit", h(etag="e1")), (5, "http://a.com/x", 30, "revisit", None),
            (6, "http://a.com/y", 5, "revisit", h(etag="e1")), (7, None, 50, "revisit", h(etag="e1")), (8, "http://a.com/x", 40, "revisit", h(last_modified="m")),
            (9, "http://a.com/x/index.html", 40, "response", h(last_modified="m", age="1")), (10, "http://a.com/x", 41, "revisit", h(last_modified="m", expires="z")),
            (10, "http://a.com/x", 41, "revisit", h(last_modified="m", expires="z"))]
    df = spark.createDataFrame([(*d, "p") for d in data], "record_id long, url string, at long, kind string, headers map<string,string>, payload string")
    df = df.withColumn("ts", F.timestamp_seconds("at")).withColumn("ref", F.lit(1))
    got = sorted(((r["record_id"], r["ref_record_id"], r["outcome"], r["headers"]) for r in revisits.resolve(df).collect()), key=lambda r: r[0])
    assert [g[:3] for g in got] == [(2, 1, "resolved"), (4, None, "validators differ"), (5, 3, "unverified"), (6, None, "no earlier response"),
                                    (7, None, "no earlier response"), (8, 3, "unverified"), (10, 9, "resolved"), (10, 9, "resolved")]
    assert got[0][3] == {"etag": "W/e1", "content-type": "t", "date": "d1"} and got[-1][3] == {"last-modified": "m", "age": "1", "expires": "z"}
    assert revisits.resolve(df.filter("false")).count() == 0


def test_revisits_of_a_null_url_are_never_resolved(spark):
    data = [(1, None, 10, "response"), (2, None, 11, "revisit"), (3, "http://a.com/x", 10, "response"), (4, "http://a.com/x", 11, "revisit"),
            (5, "http://a.com/y", 100000, "response")]   # the cells are wide
    df = spark.createDataFrame([(*d, {"etag": "e"}, "p") for d in data], "record_id long, url string, at long, kind string, headers map<string,string>, payload string")
    got = {r["record_id"]: (r["ref_record_id"], r["outcome"]) for r in revisits.resolve(df.withColumn("ts", F.timestamp_seconds("at"))).collect()}
    assert got == {2: (None, "no earlier response"), 4: (3, "resolved")}


def test_copies_of_a_benchmark_row_are_broadcast_once(spark, monkeypatch):
    sent, scanner = [], decontaminate.scanner
    monkeypatch.setattr(decontaminate, "scanner", lambda items, window: sent.append(items.value) or scanner(items, window))
    bench = spark.createDataFrame([(1, "lone words")] * 50, "item_id long, text string")
    found = decontaminate.find_hits(documents(spark, [(1, "x lone words")]), bench).select("hits.*").first()
    assert sent == [[("1", "lone words")]] and found["n_hit"] == 2 and found["items"] == ["1"]
