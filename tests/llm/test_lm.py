import math
import random
import zlib
from collections import Counter

import pytest

from tarn.llm import lm

SCHEMA = "doc_id long, text string, lang string"


def brute_base(docs):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter()
    for i, text in docs:
        if not held(i):
            counts.update([*lm.words(text), lm.END])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        tokens = [*lm.words(text), lm.END]
        out.append((i, held(i), len(tokens), sum(counts[t] > 0 for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)))
    return out


def test_base_is_the_brute_force_one(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {x[0]: x for x in brute_base([(r.doc_id, r.text) for r in df.collect()])}
    better = total = 0
    for r in lm.score_all(df).collect():
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[1:5]
        assert r.base_score == pytest.approx(w[5], abs=1e-6)
        if r.held_out:
            better, total = better + r.score, total + r.base_score
    assert better > total


def test_next_symbols_sum_to_one(spark):
    text = "a b c a b d a b c e a b c " * 30
    df = spark.createDataFrame([(1, text + "x y z", "en"), (3, text, "en"), (4, "c b a " * 20, "en")], SCHEMA)
    tree, _ = lm.train(df, p_min=0.02, least=2)
    import numpy as np

    assert len(tree.parent) > 2 and all(len(x) for x in tree.codes) and len(tree.states) == 3
    for s in range(len(tree.parent)):
        p = tree.p(np.full(tree.size, s), np.arange(tree.size)).sum()
        assert p + tree.ratio[s] * tree.other == pytest.approx(1, abs=1e-6)
        assert p == pytest.approx(tree.in_h[s], abs=1e-6)
    rows = {r.doc_id: r for r in lm.score(df, tree, lm.train(df, p_min=0.02, least=2)[1]).collect()}
    assert rows[3].score > rows[3].base_score


def naive(training, texts, least, depth, divergence, kappa, entry_min=0.0):
    """log10 of each text's probability, by dictionaries of contexts as they are defined."""
    counts, follow = Counter(), {}
    for text in training:
        tokens = [*lm.words(text), lm.END]
        counts.update(tokens)
        for i, w in enumerate(tokens):
            for d in range(1, depth + 1):
                before = ([lm.END] * d + tokens[:i])[-d:]
                follow.setdefault(tuple(before), Counter())[w] += 1
    total, size = sum(counts.values()), len(counts)
    root = lambda w: (counts[w] + 1) / (total + size + 1)
    h = {w for w, c in counts.items() if c >= least}
    out_h = 1 - sum(root(w) for w in h)
    # a candidate of d tokens follows from one of d - 1 that this token often follows, and its suffix must be one
    candidates = {1: {(w,) for w in h}}
    for d in range(2, depth + 1):
        candidates[d] = {(*c, w) for c in candidates[d - 1] for w, n in follow.get(c, Counter()).items() if w in h and n >= least and (*c[1:], w) in candidates[d - 1]}
    kept = {(): None}

    def parent(c):
        return next(c[i:] for i in range(1, len(c) + 1) if c[i:] in kept)

    def p(state, w):
        if not state:
            return root(w)
        n, part, left, *_ = kept[state]
        return part.get(w, 0) / (n + kappa) + left * p(parent(state), w)

    def ratio(state):
        return kept[state][3] if state else 1.0

    for d in range(1, depth + 1):
        for c in sorted(candidates[d]):
            f, up = follow.get(c, Counter()), parent(c)
            n = sum(f.values())
            n_out = sum(x for w, x in f.items() if w not in h)
            part = {w: x for w, x in f.items() if w in h and x >= max(2, total * entry_min)}
            in_up = sum(p(up, w) for w in h)
            p_out = (n_out + kappa * ratio(up) * out_h) / (n + kappa)
            left = (n - n_out - sum(part.values()) + kappa * in_up) / ((n + kappa) * in_up)
            own = {w: part.get(w, 0) / (n + kappa) + left * p(up, w) for w in h}
            gain = sum(x * math.log(x / p(up, w)) for w, x in own.items()) + p_out * math.log(p_out / (ratio(up) * out_h))
            if gain >= divergence:
                kept[c] = (n, part, left, p_out / out_h)
    out = []
    for text in texts:
        tokens, sum_ = [*lm.words(text), lm.END], 0.0
        for i, w in enumerate(tokens):
            # the deepest candidate whose suffixes are all candidates
            before = tuple(([lm.END] * depth + tokens[:i])[-depth:])
            state = ()
            for d in range(1, depth + 1):
                if before[-d:] not in candidates[d]:
                    break
                if before[-d:] in kept:
                    state = before[-d:]
            sum_ += math.log10(p(state, w) if w in h else root(w) * ratio(state))
        out.append(sum_)
    return out, len(kept) - 1


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_scores_are_those_of_a_naive_tree(spark, depth):
    rng = random.Random(depth)
    phrases = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 5))) for _ in range(6)]
    texts = [" ".join(rng.choice([*phrases, "rare%d" % rng.randrange(40), "x"]) for _ in range(rng.randrange(30))) for _ in range(120)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    want, states = naive(texts, texts, 12, depth, 0.02, 4.0)
    tree, tokens = lm.train(df, p_min=0.0, entry_min=0.0, divergence=0.02, least=12, depth=depth)
    assert len(tree.parent) == states > 5
    got = {r.doc_id: r.score for r in lm.score(df, tree, tokens).collect()}
    assert all(got[i] == pytest.approx(x, abs=1e-6) for i, x in enumerate(want))


def test_the_tree_grows_with_the_corpus(spark, sf_dir):
    grown = []
    for sf in ("0.001", "0.01"):
        docs = spark.read.parquet(f"{sf_dir.replace('0.001', sf)}/documents.parquet")
        grown.append(len(lm.train(docs)[0].parent))
    assert grown[1] > 2 * grown[0] > 0


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", None), (2, "", None), (None, "q " * 5000, None), (5, " \t\n", None)], SCHEMA).withColumnRenamed("lang", "token")
    rows = lm.score_all(df).collect()
    assert len(rows) == 5 and {r.n_tokens for r in rows} == {1, 5001}
    assert lm.score_all(df.limit(0)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = lm.score_all(spark.createDataFrame([(held, "a b", None)], SCHEMA)).first()
    assert (only.n_known, only.train_tokens, only.n_tokens) == (0, 0, 3) and only.base_score == 0


def naive_with_rarer(training, texts, often, least, depth, divergence, kappa):
    """As naive, where only tokens that occur often are told apart as followers, and contexts are of any tokens."""
    counts, follow = Counter(), {}
    for text in training:
        tokens = [*lm.words(text), lm.END]
        counts.update(tokens)
        for i, w in enumerate(tokens):
            for d in range(1, min(depth, i + 1) + 1):
                follow.setdefault(tuple(([lm.END] + tokens[:i])[-d:]), Counter())[w] += 1
    total, size = sum(counts.values()), len(counts)
    root = lambda w: (counts[w] + 1) / (total + size + 1)
    h = {w for w, c in counts.items() if c >= often}
    out_h = 1 - sum(root(w) for w in h)
    kept = {(): None}
    parent = lambda c: next(c[i:] for i in range(1, len(c) + 1) if c[i:] in kept)
    ratio = lambda s: kept[s][3] if s else 1.0

    def p(state, w):
        if not state:
            return root(w)
        n, part, left, _ = kept[state]
        return part.get(w, 0) / (n + kappa) + left * p(parent(state), w)

    for c in sorted(follow, key=lambda c: (len(c), c)):
        f, up = follow[c], parent(c)
        n = sum(f.values())
        if n < least:
            continue
        n_out = sum(x for w, x in f.items() if w not in h)
        part = {w: x for w, x in f.items() if w in h and x >= 2}
        in_up = sum(p(up, w) for w in h)
        p_out = (n_out + kappa * ratio(up) * out_h) / (n + kappa)
        left = (n - n_out - sum(part.values()) + kappa * in_up) / ((n + kappa) * in_up)
        own = {w: part.get(w, 0) / (n + kappa) + left * p(up, w) for w in h}
        gain = sum(x * math.log(x / p(up, w)) for w, x in own.items()) + p_out * math.log(p_out / (ratio(up) * out_h))
        if gain >= divergence:
            kept[c] = (n, part, left, p_out / out_h)
    out = []
    for text in texts:
        tokens, sum_ = [*lm.words(text), lm.END], 0.0
        for i, w in enumerate(tokens):
            before = tuple(([lm.END] + tokens[:i])[-depth:])
            state = next(before[j:] for j in range(len(before) + 1) if before[j:] in kept)
            sum_ += math.log10(p(state, w) if w in h else root(w) * ratio(state))
        out.append(sum_)
    return out, {c for c in kept if sum(follow.get(c, Counter()).values()) < often and c}


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_contexts_too_rare_for_the_tree_are_learned_too(spark, monkeypatch, depth):
    rng = random.Random(depth)
    phrases = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 5))) for _ in range(6)]
    phrases += ["r%d %s" % (i, " ".join(rng.choice("abcdefgh") for _ in range(3))) for i in range(12)]
    texts = ["", "a", *(" ".join(rng.choice([*phrases, "rare%d" % rng.randrange(40), "x"]) for _ in range(rng.randrange(30))) for _ in range(160))]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    training = [t for t, out in zip(texts, held, strict=True) if not out]
    total = sum(len(lm.words(t)) + 1 for t in training)
    want, rare = naive_with_rarer(training, texts, 150, 8, depth, 0.02, 4.0)
    assert {len(c) for c in rare} == set(range(1, depth + 1))
    # with and without the tokens that may be in contexts
    monkeypatch.setattr(lm, "MIDDLE", 0 if depth == 2 else lm.MIDDLE)
    tree, tokens = lm.vocabulary(df.where(~lm.held_out(7, 2)), p_min=150 / total, least=8)
    assert (tree.middle is None) == (depth == 2)
    rows = lm.coded(df, tree)
    lm.grow(tree, rows.where("not held_out"), entry_min=0.0, divergence=0.02, depth=depth)
    assert len(tree.parent)
    more = lm.rarer(rows, tree, least=8, divergence=0.02, depth=depth, at_once=500)
    out = lm.scored(rows, tree, tokens, more).collect()
    got = {r.doc_id: r.score for r in out}
    base = {x[0]: x for x in brute_base(list(enumerate(texts)))}
    assert all(r.n_known == base[r.doc_id][3] and r.base_score == pytest.approx(base[r.doc_id][5], abs=1e-6) for r in out)
    alone = {r.doc_id: r.score for r in lm.scored(rows, tree, tokens).collect()}
    assert all(got[i] == pytest.approx(x, abs=1e-6) for i, x in enumerate(want))
    assert sum(abs(got[i] - alone[i]) > 1e-3 for i in got) > len(got) // 2


def test_dealing_takes_little_memory(spark, monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    text = " ".join("a b c d e f g h".split() * 40 + ["r%d" % (i % 40) for i in range(400)])
    df = spark.createDataFrame([(1, text, "en"), (2, text, "en")], SCHEMA)
    tree, _ = lm.vocabulary(df, p_min=0.02, least=8)
    rows, passes, real = lm.coded(df, tree), [], lm.arrow_map
    monkeypatch.setattr(lm, "arrow_map", lambda df, fn, schema: (passes.append(fn), real(df, fn, schema))[1])
    lm.rarer(rows, tree, least=8, at_once=50)
    deal, *_ = passes
    n, size = 2000, 1500
    # nearly every place has a context beyond the tree, which is a root only
    ids = np.random.default_rng(1).integers(0, tree.size, n * size).astype(np.int32)
    far = np.zeros(0, np.int64)
    lists = [pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * size, ids), pa.ListArray.from_arrays(np.zeros(n + 1, np.int32), far)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([False] * n), *lists], names=["row", "held_out", "ids", "far"])
    tracemalloc.start()
    try:
        places = sum(len(x) for out in deal(iter([batch])) for x in out["places"])
        dealt = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert places and dealt < 150, dealt


def test_lookups_find_every_number(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 3000):
        codes = np.unique(rng.integers(0, 1 << 40, n) * (1 << 20 if n == 5 else 1))
        asked = np.concatenate((rng.permutation(codes), codes + 1, [-1, 0]))
        where = {c: i for i, c in enumerate(codes.tolist())}
        which, found = lm.Lookup(codes).find(asked)
        assert which.tolist() == [i for i, c in enumerate(asked.tolist()) if c in where]
        assert found.tolist() == [where[c] for c in asked.tolist() if c in where]
