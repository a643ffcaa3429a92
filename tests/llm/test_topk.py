import math
import random

import numpy as np

from tarn.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    fine = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    out = {}
    for q, v in {(q, tuple(v)) for q, v in fine if q % 100 == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in fine if i != q]
        out[q] = [(r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def run(df):
    got = {}
    for r in topk.top_k(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(x) for q, x in got.items()}


def test_whole_table(spark, sf_dir, oracle):
    oracle.same(topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), topk.ORACLE)


def test_ties_and_wrong_vectors(spark, clashing):
    rng = random.Random(0)
    rows = [(i, [rng.randrange(-2, 3) / 4 for _ in range(4)]) for i in range(700)]
    rows += [(1000, None), (1100, [1.0, None, 0.0, 0.0]), (1200, [float("nan")] * 4), (1300, [float("inf"), 0.0, 0.0, 0.0]), (None, [9.0] * 4), (1400, []), (1500, [0.5, 0.25])]
    df = clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5))
    assert run(df) == {q: x for q, x in brute(rows).items() if x}


def test_few_candidates_and_repeated_rows(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert run(make([(0, [1.0]), (5, [2.0])])) == {0: [(1, 5, 2 * 1024 * 1024)]}
    assert run(make([(0, [1.0])])) == {} and run(make([(0, [1.0])]).limit(0)) == {}
    assert run(make([(0, [1.0]), (7, [1.0]), (7, [1.0])])) == {0: [(1, 7, 1 << 20), (2, 7, 1 << 20)]}


def test_scores_beyond_doubles(spark):
    rows = [(0, [3e9, 1.0]), (1, [3e9, 2.0]), (2, [3e38, 3e38]), (3, [-3e38, 0.0]), (4, [3e9, -5.0])]
    got = run(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))[0]
    assert got[0][1] == 1 or got[0][1] == 2
    assert {i for _, i, _ in got} == {1, 2, 3, 4} and [i for _, i, _ in got][-1] == 3


def test_bounds_hold_and_blocks_are_left_out():
    rng = np.random.default_rng(0)
    ids = np.arange(2000)
    data = np.floor(rng.normal(size=(2000, 8)) * 100)
    data[:100] *= 30
    blocks = [topk.Block(ids[a : a + 100], data[a : a + 100], 8) for a in range(0, 2000, 100)]
    queries = np.floor(rng.normal(size=(5, 8)) * 100)
    for b in blocks:
        assert (b.bounds(queries)[:, None] >= topk.products(queries, b.index)).all()
    done = []
    real, topk.products = topk.products, lambda a, b: done.append(len(a)) or real(a, b)
    try:
        best = [[] for _ in range(5)]
        topk.search(np.full(5, -1), queries, blocks, 10, best)
    finally:
        topk.products = real
    assert sum(done) < 5 * len(blocks)
    for q, heap in zip(queries, best, strict=True):
        assert sorted((s for s, _ in heap), reverse=True) == sorted((data @ q).astype(int).tolist(), reverse=True)[:10]
