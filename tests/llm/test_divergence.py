"""Source divergence against a plain dense form and the SQL."""

import re
from collections import Counter, defaultdict

import pytest
from clearbid.llm import divergence
from tests.llm.cases import rows

COLUMNS = ("lang", "source", "part", "item", "value", "rank")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p string, salt string"


def documents(spark, told):
    return spark.createDataFrame([(i, text, lang, source, "x", 1, "x", "x") for i, (lang, source, text) in enumerate(told)], SCHEMA)


def plain(told, min_docs):
    """Every kept term in every group, one by one."""
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in told]
    in_docs, of_lang, of_group, groups = Counter(), Counter(), Counter(), defaultdict(set)
    for lang, source, ws in words:
        groups[lang].add(source)
        in_docs.update((lang, w) for w in set(ws))
        of_lang.update((lang, w) for w in ws)
        of_group.update((lang, source, w) for w in ws)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, sources in groups.items():
        kept = [w for (k, w), n in in_docs.items() if k == lang and n >= min_docs]
        v = len(kept)

        def share(count, kept=kept, v=v):
            total = sum(count(w) for w in kept)
            return {w: 1 + 10**9 * (count(w) + 2) // (total + 2 * v) for w in kept}
        q = share(lambda w, lang=lang: of_lang[lang, w])
        p = {s: share(lambda w, lang=lang, s=s: of_group[lang, s, w]) for s in sources}
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if of_group[lang, s, w] and p[s][w] > q[w]]
            out += [(lang, s, "pair", o, -x, k + 1) for k, (x, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", w, -x, k + 1) for k, (x, _, w) in enumerate(sorted(terms)) if k < divergence.TOP_TERMS]
    return sorted(out)


TOLD = [("en", "a", "Red red blue1green"), ("en", "a", "red blue"), ("en", "b", "blue blue É é"), ("en", "b", "red É"), ("en", None, None),
        ("en", "c", "  12 "), (None, "a", "red red"), (None, "b", "red"), (None, "b", ""), ("fr", "solo", "mot mot"), ("fr", "solo", "mot"),
        ("de", "x", "selten"), ("de", "y", "anders"), ("en", "a", "Red red blue1green"), ("en", "ä", "zebra zoo zebra"), ("en", "z", "zebra zoo zoo")]


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_equals_the_dense_form(spark, min_docs):
    """Nulls, empty texts, groups and languages without terms, ties, a lone source, repeated rows, clashing columns."""
    got = divergence.audit(documents(spark, TOLD), min_docs)
    assert got.columns == list(COLUMNS)
    assert rows(got, *COLUMNS) == plain(TOLD, min_docs)


def test_many_terms(spark):
    told = [("en", f"s{i % 5}", " ".join(f"{'abcdefgh'[k]}{'xyz'[(k * i) % 3] * ((i + k) % 4)}" for k in range(8))) for i in range(120)]
    assert rows(divergence.audit(documents(spark, told)), *COLUMNS) == plain(told, divergence.MIN_DOCS)


def test_long_texts_are_split_at_blanks(spark, monkeypatch):
    text = b"Word,word " * 500 + b"e" * 300 + "Éa1É".encode() + b" tail"
    whole = divergence.count_text(text)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    assert divergence.count_text(text) == whole
    assert whole[b"word"] == 1000 and whole["Éa".encode()] == 0 and whole[b"e" * 300 + "Éa".encode()] == 1


def test_tasks_hand_on_before_they_hold_too_much(monkeypatch):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(["s"] * 4), pa.array([b"a b", b"c d", b"a c", b""])], names=["lang", "source", "text"])
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    out = [r for b in divergence._sum_batches([batch, batch]) for r in b.to_pylist()]
    total = Counter()
    for r in out:
        total[r["term"]] += r["n"]
    assert total == Counter(a=4, b=2, c=4, d=2) and len(out) > 4


def test_no_documents(spark):
    assert divergence.audit(documents(spark, []).limit(0)).count() == 0


def test_whole_numbers_beyond_doubles():
    """The share is exact where its numerator has passed 64 bits."""
    from pyspark.sql import SparkSession
    n, total, v = 10**12 + 7, 9 * 10**15 + 11, 10**6 + 3
    row = SparkSession.active().range(1).selectExpr(f"{n}L AS n", f"{total}L AS total", f"{v}L AS v").select(divergence.share("n", "total", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * v)
