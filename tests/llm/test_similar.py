from collections import Counter
from itertools import combinations

import numpy as np

import corpus_pipeline
from tarn.llm import shingles, simhash


def brute_kept(docs):
    """The smallest doc_id of each component of pairs of 0.8 or more, by all pairs."""
    sets = {i: np.unique(shingles.shingle_hashes(t, 5)).tolist() for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    of = {}
    for i, s in sets.items():
        for h in s:
            of.setdefault(h, []).append(i)
    shared = Counter(pair for at in of.values() for pair in combinations(sorted(at), 2))
    near = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    near += combinations(sorted(i for i, s in sets.items() if not s), 2)
    for a, b in near:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i for i in sets if root(i) == i}


def test_the_stage_drops_what_four_bits_miss(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    kept = {r.doc_id for r in stage(spark, docs, sf_dir).select("doc_id").collect()}
    assert not {1, 255} <= kept
    assert kept == brute_kept([(r.doc_id, r.text) for r in docs.collect()])


def test_chains_whose_ends_differ(documents):
    words = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(words[: 100 - 6 * k])) for k in range(6)]
    out = simhash.keep_one(documents(rows))
    assert {r.doc_id for r in out.collect()} == brute_kept(rows) == {0}


def test_edges(documents, clashing):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text), (2, text), (3, "something else"), (4, None), (5, " "), (None, "no id"), (None, "no id"), (None, text)]
    df = clashing(documents(rows))
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(1, text), (3, "something else"), (4, None), (None, "no id")])
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_a_common_passage_is_no_likeness(documents):
    """Many texts of which a half is the same share bands, but are no near-duplicates; two of them are."""
    common = " ".join(f"c{i}" for i in range(100))
    rows = [(k, common + " " + " ".join(f"d{k}x{i}" for i in range(60))) for k in range(120)]
    rows += [(200 + k, rows[k][1] + " more words") for k in (3, 77)]
    out = simhash.keep_one(documents(rows))
    assert {r.doc_id for r in out.collect()} == brute_kept(rows) == set(range(120))


def test_bounds_of_chance():
    from math import comb

    n = shingles.BANDS * shingles.ROWS
    assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(shingles.EQUAL)) < 0.0005
    assert (1 - 0.8**shingles.ROWS) ** shingles.BANDS < 0.0003
