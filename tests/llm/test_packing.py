import random
import zlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarn.llm import packing


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " a", "the", "\n\n", "  ", "é", "日本", "'s", "1234", "\U0001f600", "<|im_end|>"]), max_size=12).map("".join))
def test_ids_are_those_of_the_public_tokenizer(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_are_those_of_the_public_tokenizer, "t") else test_ids_are_those_of_the_public_tokenizer.t
    test_ids_are_those_of_the_public_tokenizer.t = t
    own = getattr(test_ids_are_those_of_the_public_tokenizer, "own", None) or packing.Encoder()
    test_ids_are_those_of_the_public_tokenizer.own = own
    assert own(text) == t.encode(text, add_special_tokens=False).ids


def check(rows, docs, tokenizer, capacity=packing.CAPACITY):
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(docs)
    bins = {}
    for doc_id, text in docs.items():
        ids = array("I", [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID])
        mine = sorted(got[doc_id], key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(mine):
            assert (r.piece, r.start) == (k, at)
            assert k == 0 or r.length == capacity
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids) and (len(ids) > capacity or len(mine) == 1)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_documents_come_back_and_sequences_are_few(spark, sf_dir, public):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(df).collect()
    bins = check(rows, {r.doc_id: r.text for r in df.collect()}, public)
    least = -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert len(bins) <= least + 1


def test_edges(spark, documents, clashing, public):
    docs = {1: None, 2: "", 3: "word " * 30_000, 4: "<|endoftext|>", 5: "a"}
    check(packing.pack(clashing(documents(docs.items()))).collect(), docs, public)
    twice = packing.pack(documents([(7, "x y z")] * 5 + [(None, "q")])).collect()
    assert len(twice) == 6 and len({(r.sequence_id, r.offset) for r in twice}) == 6
    assert packing.pack(documents([(1, "a")]).limit(0)).collect() == []


def test_islands_share_what_is_left(documents, public):
    docs = {i: "tok " * (100 + 37 * i % 700) for i in range(120)}
    rows = packing.pack(documents(docs.items()), island=16).collect()
    bins = check(rows, docs, public)
    assert len(bins) <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(0, 5))
def test_evolution_keeps_every_piece(sizes, seed):
    bins = packing.evolve(sizes, [(50, 50), (60, 40)], seed, capacity=100)
    assert sorted(s for b in bins for s in b) == sorted(sizes)
    assert all(sum(b) <= 100 for b in bins)


@pytest.mark.parametrize("seed", range(4))
def test_evolution_betters_best_fit(seed):
    rng = random.Random(seed)
    # bins of three that fill up; longest-first best fit takes the wrong ones
    sizes = []
    for _ in range(60):
        a = rng.randrange(380, 490)
        b = rng.randrange(250, (1024 - a) // 2 + 1)
        sizes += [a, b, 1024 - a - b]
    first = packing.child_of((), (), packing.Counter(sizes), 1024)
    found = packing.evolve(sizes)
    assert sorted(x for b in found for x in b) == sorted(sizes) and all(sum(b) <= 1024 for b in found)
    assert len(found) <= 62 < len(first) - 5
    # many pieces of any length, of which best fit leaves some over
    sizes = [rng.randrange(100, 700) for _ in range(2000)]
    assert len(packing.evolve(sizes)) < len(packing.child_of((), (), packing.Counter(sizes), 1024))


def test_crossover_keeps_bins_of_both_parents():
    counts = packing.Counter([60, 40, 55, 45, 50, 50, 30])
    child = packing.child_of([[60, 40]], [[60, 40], [50, 50], [55, 30]], counts, 100, random.Random(0))
    assert [60, 40] in child and [50, 50] in child and sum(map(sum, child)) == 330 and len(child) == 4


def test_elite_patterns_are_injected():
    sizes = [60, 40, 55, 45, 50, 50]
    assert len(packing.child_of([(60, 40), (55, 45)], (), packing.Counter(sizes), 100)) == 3


def test_pieces():
    assert packing.pieces(1024) == [(0, 1024)]
    assert packing.pieces(1025) == [(0, 1), (1, 1024)]
    assert packing.pieces(1) == [(0, 1)]
    assert packing.pieces(2050) == [(0, 2), (2, 1024), (1026, 1024)]
