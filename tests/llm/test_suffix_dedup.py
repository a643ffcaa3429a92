import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarn.llm import suffix_dedup as sd


def brute(docs, length):
    """doc number -> (n_bytes, n_removed, n_spans, kept)"""
    data = [(t or "").encode() for _, t in docs]
    counts = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(df, **options):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_repeated) for r in sd.dedup(df, **options).collect())


def want(docs, length, short=sd.SHORT):
    """The last number is what strings of `short` bytes cover."""
    covered = [x[1] for x in brute(docs, short)]
    return Counter((i, *x, n) for (i, _), x, n in zip(docs, brute(docs, length), covered, strict=True))


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    got = run(df)
    assert got == want(docs, sd.LENGTH) and any(k[2] for k in got)


@pytest.mark.parametrize("seed", range(3))
def test_many_borders(documents, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(30, 400))) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(base)
            a = rng.randrange(len(p))
            parts.append(p[a : a + rng.randrange(1, 200)])
            if rng.random() < 0.5:
                parts.append(rng.choice("xyzé") * rng.randrange(3))
        docs.append((i, "".join(parts)))
    found = run(documents(docs), length=64, gap=24, short=48)
    assert found == want(docs, 64, 48) and any(k[2] not in (0, k[1]) for k in found)
    # groups too large for one task, texts in windows
    assert run(documents(docs), length=64, gap=24, short=48, group=3) == found
    assert run(documents(docs), length=64, gap=24, short=48, chunk=100) == found
    assert run(documents(docs), length=64, gap=24, short=48, group=1, chunk=37, band=3) == found


def test_edges(documents, clashing):
    long = "".join(random.Random(5).choice("abcdefgh") for _ in range(150_000))
    docs = [(1, None), (2, ""), (3, "a" * 3000), (4, "ab" * 700), (5, long), (6, long[70_000:70_500]), (7, long[100:499]), (8, "é" * 300), (9, "x" * 400), (None, long[2000:2600])]
    assert run(clashing(documents(docs))) == want(docs, sd.LENGTH)
    same = [(7, long[:500])] * 3 + [(8, long[:500]), (8, "other")]
    assert run(documents(same)) == want(same, sd.LENGTH)
    assert run(documents(docs).limit(0)) == Counter()


def test_hot_passage_between_different_neighbours(documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(90))
    docs = [(i, " ".join(word() for _ in range(20)) + passage + " ".join(word() for _ in range(20))) for i in range(80)]
    got = run(documents(docs))
    assert got == want(docs, sd.LENGTH)
    assert all(k[2] >= len(passage) for k in got)


def test_bands_of_a_crowd_are_few(documents, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(90))
    docs = [(i, " ".join(word() for _ in range(40)) + passage + " ".join(word() for _ in range(40))) for i in range(60)]
    made, crowds = [], []
    banded = sd.banded

    def counted(phrases, *rest):
        out = banded(phrases, *rest)
        crowds.append(phrases.count())
        made.append(out.count())
        return out

    monkeypatch.setattr(sd, "banded", counted)
    assert run(documents(docs), group=8) == want(docs, sd.LENGTH)
    assert crowds[0] > 60 and sum(made) <= 9 * crowds[0]


def test_rewritten_keeps_columns_and_rows(documents, clashing):
    p = "".join(random.Random(2).choice("abcdefgh ") for _ in range(600))
    df = clashing(documents([(1, "one " + p), (2, p + " two"), (3, "three"), (4, None)]))
    out = sd.rewritten(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[1].text, rows[2].text, rows[3].text, rows[4].text) == ("one ", " two", "three", None)
    assert rows[1].n_chars == 4 and rows[1].ranges == "ranges"


def test_cuts_leave_whole_characters(documents):
    p = "".join(random.Random(3).choice("abcdefgh ") for _ in range(500))
    # both texts go on with a two-byte sign that shares its first byte, and begin with one that shares its last
    docs = documents([(1, "one \u00e9" + p + "\u00e9 end"), (2, "two \u0129" + p + "\u00e8 rest")])
    assert {r.doc_id: r.text for r in sd.rewritten(docs).collect()} == {1: "one \u00e9\u00e9 end", 2: "two \u0129\u00e8 rest"}
    assert {r.n_removed for r in sd.dedup(docs).collect()} == {502}


def test_orders_tell_which_strings_are_equal():
    rng = random.Random(4)
    heads = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))) for _ in range(300)]
    tails = [b"t" + bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    groups = np.array([i % 3 for i in range(300)])
    least = np.array([rng.randrange(len(h) + 1) for h in heads])
    strings = Counter()
    for g, h, t, low in zip(groups, heads, tails, least, strict=True):
        strings.update((g, o, (h[len(h) - o :] + t)[:6]) for o in range(low, len(h) + 1) if o + len(t) >= 6)
    found = sd.combined(groups, heads, tails, least, 6)
    for i, (g, h, t, low) in enumerate(zip(groups, heads, tails, least, strict=True)):
        for o in range(found.shape[1]):
            asked = low <= o <= len(h) and o + len(t) >= 6
            assert found[i, o] == (asked and strings[(g, o, (h[len(h) - o :] + t)[:6])] > 1)
    assert found.any()


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=60, max_size=400), st.integers(0, 50))
def test_a_string_has_the_same_trigger_wherever_it_stands(data, shift):
    length, gap = 60, 20
    one = np.frombuffer(data, np.uint8)
    two = np.concatenate((np.arange(shift, dtype=np.uint8), one))
    owners = []
    for buffer, offset in ((one, 0), (two, shift)):
        _, place, first, last = sd.triggers(buffer, np.array([len(buffer)]), length, gap)
        owner = {s: int(p) - offset for p, a, z in zip(place, first, last, strict=True) for s in range(a - offset, z - offset + 1)}
        assert len(owner) == len(buffer) - length + 1
        owners.append(owner)
    assert all(owners[1][s] == p for s, p in owners[0].items())
