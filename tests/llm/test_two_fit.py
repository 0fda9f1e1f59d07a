"""Best-two-fit: ids against the tokenizer, whole pieces, gapless bins, the plan against bins built one by one."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from clearbid.llm import two_fit
from clearbid.llm.queries import op13_two_fit
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import LONG, ODD, documents
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encode(tokenizer):
    return two_fit.byte_encoder(tokenizer.to_str())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.text(st.characters(codec="utf-8") | st.sampled_from(list(" \n\t\x0b\x1c\x85 　'sStdE1é|<>_#")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_tokenizers(tokenizer, encode, text):
    assert encode(text) == struct.pack(f"<{len(ids_of(tokenizer, text))}I", *ids_of(tokenizer, text))


def test_special_strings_and_blocks(tokenizer, encode, monkeypatch):
    monkeypatch.setattr(two_fit, "BLOCK", 11)
    for text in ("a <|endoftext|> b<|endoftext|>", "it's  two  blanks \n and 日本 語 x " * 9, "x" * 40 + " y", " " * 50 + "z", LONG[:400]):
        ids = ids_of(tokenizer, text)
        assert encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def check(found, texts, tokenizer, max_len):
    """``found`` rows hold every id of ``texts`` once, in whole pieces, in bins without gaps."""
    wanted = Counter()
    for doc_id, text in texts:
        ids = [*ids_of(tokenizer, text), 0]
        edges = [0, *range(len(ids) % max_len or max_len, len(ids) + 1, max_len)]
        wanted.update((doc_id, k, a, b - a, struct.pack(f"<{b - a}I", *ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in found) == wanted
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= max_len
    return len(bins)


def test_pack(spark, tokenizer):
    """Nulls, empty and very long texts, repeated rows, a null id, clashing columns."""
    found = two_fit.pack(documents(spark, ODD).withColumnsRenamed({"slot": "piece_key", "key": "offset", "host": "ids"}), PATH, 64).collect()
    n = check(found, ODD, tokenizer, 64)
    assert n <= -(-sum(r.length for r in found) // 64) + 1


def test_no_documents(spark):
    assert two_fit.pack(documents(spark, []), PATH).count() == 0


def test_wide_vocabularies_keep_their_ids(spark, tokenizer):
    found = two_fit.pack(documents(spark, [(1, "a b")]), PATH, 8, end_id=70000).collect()
    assert bytes(found[0].ids) == struct.pack("<3I", *ids_of(tokenizer, "a b"), 70000)


def one_by_one(histogram, capacity):
    """Best-two-fit over single pieces, as the method states it."""
    left, out = sorted(Counter(histogram).elements(), reverse=True), []
    while left:
        held, room = [], capacity
        for x in list(left):
            if x <= room:
                held.append(x)
                room -= x
                left.remove(x)
        if len(held) > 1:
            small, best = held[-1], None
            for i, a in enumerate(left):
                for b in left[i + 1:]:
                    if small < a + b <= room + small and (best is None or a + b > sum(best)):
                        best = (a, b)
            if best:
                held.remove(small)
                left += [small]
                for x in best:
                    left.remove(x)
                held += best
                left.sort(reverse=True)
        out.append(sum(held))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_bins_built_one_by_one(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.randint(1, rng.choice([20, 40, 60])) for _ in range(rng.choice([5, 60, 200])))
    plan = two_fit.best_two_fit(histogram, 60)
    held = Counter()
    for bin_, times in plan:
        assert sum(k * n for k, n in bin_.items()) <= 60
        held.update({k: n * times for k, n in bin_.items()})
    assert held == histogram
    assert Counter(s for b, times in plan for s in [sum(k * n for k, n in b.items())] * times) == Counter(one_by_one(histogram, 60))


def test_two_small_pieces_beat_one():
    """60 + 30 leaves 10; 60 with 21 and 19 leaves none."""
    assert two_fit.best_two_fit({60: 1, 30: 1, 21: 1, 19: 1}, 100)[0] == ({60: 1, 21: 1, 19: 1}, 1)


def test_query_over_whole_documents(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    found = op13_two_fit(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    crcs = {}
    for d in docs:
        ids = [*ids_of(tokenizer, d.text), 0]
        crcs[d.doc_id] = ids
    for r in found:
        ids = crcs[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    assert sum(r.length for r in found) == sum(len(x) for x in crcs.values())
    sequences = len({r.sequence_id for r in found})
    assert sequences <= 1.02 * sum(r.length for r in found) / 2048 + 1
