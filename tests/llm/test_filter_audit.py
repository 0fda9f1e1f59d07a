"""Filter interactions against a plain walk through every order."""

import re
from itertools import permutations

from clearbid.llm import filter_audit
from tests.llm.cases import LONG, rows

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "doc_id long, text string, source string, row_id string, part string, cell string, A string, n string"


def documents(spark, told):
    return spark.createDataFrame([(i, text, source, "x", "x", "x", "x", "x") for i, text, source in told], SCHEMA)


def labels(spark, told):
    return spark.createDataFrame(told, "doc_id long, quality int, toxic int, row_id string")


def plain(docs, marks):
    def fails(doc_id, text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        copies = [i for i, t, _ in docs if (t or "") == text and i is not None and doc_id is not None and i < doc_id]
        told = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                "D": any(c in "#$%&*|" for c in text), "E": bool(copies)}
        return {f for f, bad in told.items() if bad}
    has = lambda i, k: any(m[k] == 1 and m[0] == i for m in marks if i is not None and m[0] is not None)
    facts = [(source or "", fails(i, text or ""), has(i, 1), has(i, 2)) for i, text, source in docs]
    out = []
    for part in {p for p, *_ in facts}:
        own, removed_by, told = [f for f in facts if f[0] == part], {}, []
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in own) - len(gone)
                left = [x for x in left if f not in x[1]]
                removed_by[f] = removed_by.get(f, 0) + len(gone)
                told.append((part, order, step, len(left), len(gone), redundant, sum(x[1] == {f} for x in own),
                             sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        out += [(*t[:-1], removed_by[t[-1]]) for t in told]
    return sorted(out)


def words(n, tail=""):
    return " ".join(f"w{k}" for k in range(n)) + tail


DOCS = [(1, words(250), "a"), (2, words(250), "a"), (3, words(250) + " #", "a"), (None, words(250), "a"), (1, words(250), "b"), (4, None, "a"),
        (5, "", None), (6, "A B C", None), (7, "a " * 300, "b"), (7, "a " * 300, "b"), (8, "A\x1cb " * 300 + "$", "b"), (9, LONG, "c"),
        (10, words(300).upper(), "c"), (11, words(300), "c"), (12, "a " * 300 + "%", "b"), (None, None, None)]
MARKS = [(1, 1, 0, "x"), (1, 0, 0, "x"), (2, 1, 1, "x"), (7, 0, 1, "x"), (10, 1, 0, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (8, None, 1, "x"), (12, 1, None, "x")]


def test_equals_a_walk_through_every_order(spark):
    """Nulls, empty and long texts, copies, repeated ids, repeated and null labels, clashing columns."""
    got = filter_audit.audit(documents(spark, DOCS), labels(spark, MARKS))
    assert got.columns == list(COLUMNS)
    assert rows(got, *COLUMNS) == plain(DOCS, MARKS)


def test_heavy_texts(spark, monkeypatch):
    """Copies that are joined by broadcast and those that are joined by key."""
    docs = [(i, words(200 + (i % 3 > 0) * (i % 7)), f"s{i % 2}") for i in range(90)]
    marks = [(i, i % 2, i % 5 == 0, "x") for i in range(0, 90, 3)]
    marks = [(i, q, int(t), x) for i, q, t, x in marks]
    for heavy in (2, 10, 200):
        monkeypatch.setattr(filter_audit, "HEAVY", heavy)
        assert rows(filter_audit.audit(documents(spark, docs), labels(spark, marks)), *COLUMNS) == plain(docs, marks)


def test_one_row_per_order_and_step(spark):
    got = filter_audit.audit(documents(spark, [(1, "x", "only")]), labels(spark, []))
    assert got.count() == 600 and got.select("filter_order").distinct().count() == 120


def test_no_documents(spark):
    assert filter_audit.audit(documents(spark, []), labels(spark, MARKS)).count() == 0


def test_other_filters(spark):
    """The general form: two filters by their ids alone."""
    table = spark.createDataFrame([(i, "p") for i in range(10)], "row_id long, part string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "row_id long")
    got = filter_audit.interactions(table, {"X": ids(0, 1, 2, 99), "Y": ids(2, 3)}, {"lost": ids(2, 3, 4)})
    assert rows(got, "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "lost", "shapley") == [
        ("XY", 1, 7, 3, 0, 2, 1, 5), ("XY", 2, 6, 1, 1, 1, 1, 3), ("YX", 1, 8, 2, 0, 1, 2, 3), ("YX", 2, 6, 2, 1, 2, 0, 5)]
