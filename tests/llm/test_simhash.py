import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tarn.llm import components, simhash


def brute_fp(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(nodes, near):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in near:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def check(df, docs):
    fps = {i: brute_fp(t) for i, t in docs}
    ids = sorted(fps)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = brute_components(ids, near)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in ids}


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_edges(documents, clashing):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, "a " * 40_000), (8, "É é"), (9, "é é")]
    check(clashing(documents(docs)), docs)
    rows = simhash.near_duplicates(documents([(5, "x y"), (5, "x y"), (None, "x y"), (None, "q")])).collect()
    assert Counter((r.doc_id, r.component_id) for r in rows) == {(5, 5): 2, (None, 5): 1, (None, None): 1}
    assert simhash.near_duplicates(documents(docs).limit(0)).collect() == []


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_dense_and_far_prints(spark, block):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    fps = {0} | set(seeds)
    for s in seeds:
        for _ in range(60):
            x = s
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").repartition(3)
    got = [(int(np.int64(r.u).view(np.uint64)), int(np.int64(r.v).view(np.uint64))) for r in simhash.links(df, block=block).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in got)
    near = [(a, b) for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= 4]
    assert brute_components(fps, got) == brute_components(fps, near)


def test_thresholds_cover_every_difference():
    pairs = np.full((64, 64), 25.0) + np.eye(64) * 25
    for n in (100, 10**6, 10**9):
        groups, thresholds, _ = simhash.allot(n, pairs / 100 * n, 4)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(thresholds) == 4 - len(groups) + 1
    # correlated bits share a group
    pairs[0, 63] = pairs[63, 0] = 49
    assert any({0, 63} <= set(g) for g in simhash.partitions(100, pairs, 5))


def test_keep_one(documents, clashing):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text), (2, text), (3, "something else"), (3, "third thing here"), (None, "no id"), (None, "no id")]
    df = clashing(documents(rows))
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(1, text), (3, "something else"), (3, "third thing here"), (None, "no id")])


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200), (300, 301), (301, 300)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    got = {r.vertex: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in brute_components(nodes, [e for e in edges if e[0] != e[1]]).items()}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []
