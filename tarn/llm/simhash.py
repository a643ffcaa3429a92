"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: a bit is 1 if it is set in over half of a document's shingle hashes (XXH64, seed 42).

Linking, at DISTANCE or fewer differing bits, is done on distinct fingerprints:
1. the 64 bits are grouped into partitions, correlated bits together; counts of single bits and pairs of bits over all
   fingerprints give the correlations (a 64 by 64 matrix is all that reaches the driver);
2. thresholds t_i with sum(t_i) = DISTANCE - partitions + 1 (-1: not searched) are allotted by dynamic programming on
   estimated candidate counts: two fingerprints that differ in at most DISTANCE bits differ in at most t_i bits of some
   partition i. The number of partitions is the one with the least estimated work;
3. each fingerprint is filed under its own value of every searched partition, and probes all values within t_i;
4. the members of a bucket are compared in blocks of BLOCK; a bucket of many blocks is dealt out as pairs of blocks. Only
   a spanning forest of the true links of each pair of blocks is kept, so no group emits all its pairs;
5. connected components of the forest are those of all links.

Near-duplicates by similarity (`keep_one`) are pairs whose sets of SIMILAR_WORDS-word shingles have a Jaccard similarity
of SIMILARITY. Equal sets are one vertex. Fingerprints give the links first: those of 1 to 4, verified on the texts. At 0.8
fingerprints differ in about 10 bits, and a search at the 16 or so bits that reach nearly all such pairs would compare a
share of all pairs that does not fall with their number; what lies beyond DISTANCE is therefore found by bands of minima:
6. vertices that share a band (a pair at 0.8 shares none with a chance of 0.0002, one at 0.9 of 1e-7) are a bucket; every
   member is paired with one of them, another one in each band, unless both are in one component already; pairs of which
   EQUAL minima agree are verified on the texts;
7. members of a bucket that are still in different components meet in pairs of blocks, as in 4, each pair in the first band
   that it shares; of those of which EQUAL minima agree, the texts are compared in the task, which hands on a spanning forest.
   So the components are those of all candidate pairs, and no group emits all its pairs.

Cases: null or blank texts have fingerprint zero and are linked like any other; equal texts have equal fingerprints;
repeated rows stay; a null doc_id is never a component's name unless all are null; empty tables give no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, drop, free_name, same_row, with_key, zipped
from .components import components
from .shingles import EQUAL, SIMILARITY, bands, jaccard, minima, shingle_hashes, signed, sketch, sketches, verified

BITS = 64
DISTANCE = 4
WORDS = 4
#: Of shingles, where texts are held to be alike by similarity.
SIMILAR_WORDS = 5
#: Fingerprints compared at a time.
BLOCK = 1024
#: Work of filing or probing once against comparing once.
PROBE_COST = 400

_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint as an unsigned number; zero if there is no hash."""
    n = len(hashes)
    if not n:
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(n, 8)
    if n < 64:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _SET for k in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long)."""

    def run(batches):
        for batch in batches:
            fps = [majority(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "fp": np.array(fps, np.uint64).view(np.int64)}

    return arrow_map(with_key(docs), run, "doc_id long, text_hash long, fp long")


def bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each pair of bits is set."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        yield {"i": np.append(np.arange(BITS * BITS), -1).astype(np.int32), "c": np.append(total.ravel(), n).astype(np.int64)}

    got = {r.i: r.c for r in arrow_map(distinct, run, "i int, c long").groupBy("i").agg(F.sum("c").alias("c")).collect()}
    n = got.get(-1, 0)
    return n, np.array([got.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def partitions(n: int, pairs: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size; each group grows by the bit most correlated with it."""
    p = np.diag(pairs) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((pairs / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = (len(left) + parts - k - 1) // (parts - k)
        group = [left.pop(0)]
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            left.remove(best)
            group.append(best)
        out.append(sorted(group))
    return out


def agreement(group: list[int], p: np.ndarray, most: int) -> list[float]:
    """Estimated chance that two fingerprints differ in at most t bits of group, for t from 0."""
    chance = np.zeros(most + 2)
    chance[0] = 1.0
    for b in group:
        d = 2 * p[b] * (1 - p[b])
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return list(np.cumsum(chance)[: most + 1])


def allot(n: int, pairs: np.ndarray, distance: int) -> tuple[list[list[int]], list[int], float]:
    """Partitions and thresholds of the least estimated work."""
    p = np.diag(pairs) / max(n, 1)
    best = None
    for parts in range(1, distance + 2):
        groups = partitions(n, pairs, parts)
        total = distance - parts + 1
        costs = []
        for g in groups:
            agree = agreement(g, p, distance)
            costs.append([0.0] + [n * PROBE_COST * sum(math.comb(len(g), j) for j in range(t + 1)) + n * n / 2 * agree[t] for t in range(distance + 1)])
        # table[s]: least cost of the groups so far with thresholds that sum to s, and the thresholds
        table = {0: (0.0, [])}
        for c in costs:
            new = {}
            for s, (cost, chosen) in table.items():
                for t in range(-1, distance + 1):
                    x = (cost + c[t + 1], [*chosen, t])
                    if s + t not in new or x[0] < new[s + t][0]:
                        new[s + t] = x
            table = new
        cost, thresholds = table[total]
        if best is None or cost < best[2]:
            best = (groups, thresholds, cost)
    return best


def values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of group, packed."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(group):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _filed(distinct: DataFrame, groups, thresholds) -> DataFrame:
    searched = [(i, g, t) for i, (g, t) in enumerate(zip(groups, thresholds, strict=True)) if t >= 0]

    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for i, g, t in searched:
                own = values(fps.view(np.uint64), g)
                for j in range(t + 1):
                    for flips in combinations(range(len(g)), j):
                        at = own ^ np.uint64(sum(1 << f for f in flips))
                        yield {"part": np.full(len(fps), i, np.int32), "value": at.view(np.int64), "fp": fps, "probe": np.full(len(fps), j > 0)}

    return arrow_map(distinct, run, "part int, value long, fp long, probe boolean")


def forest(a: np.ndarray, b: np.ndarray, distance: int, same: bool) -> list[tuple[int, int]]:
    """Links (u, v) between fingerprints of a and of b (same: one block) that join what no earlier link joins."""
    every = a if same else np.concatenate((a, b))
    parent = list(range(len(every)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out, step = [], max(1, (1 << 20) // max(len(b), 1))
    for s in range(0, len(a), step):
        near = np.bitwise_count(a[s : s + step, None] ^ b[None, :]) <= distance
        i, j = np.nonzero(near)
        i = i + s
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        else:
            j = j + len(a)
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[ry] = rx
                out.append((int(every[x].view(np.int64)), int(every[y].view(np.int64))))
    return out


def links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(u, v): links between fingerprints whose components are those of all pairs within distance. distinct: (fp)."""
    n, pairs = bit_counts(distinct)
    groups, thresholds, _ = allot(n, pairs, distance)
    filed = _filed(distinct, groups, thresholds)
    # sizes of buckets, summed before the shuffle; buckets without a pair go
    sizes = filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("probe").alias("probes")).where("n > 1 and n > probes")
    sizes = cut(sizes.select("part", "value", "n"), "buckets")
    key = ["part", "value", "b1", "b2"]
    dealt = _in_blocks(filed, sizes, ["part", "value"], "fp", ("fp", "probe"), block)

    def group(g):
        if len(g["fp"]) < 2:
            return
        fps, first = g["fp"].view(np.uint64), g["block"] == g["b1"][0]
        found = []
        if g["b1"][0] == g["b2"][0]:
            # who is filed here under its own value meets all others; two probes meet in another bucket
            own, probing = fps[~g["probe"]], fps[g["probe"]]
            found = forest(own, own, distance, True) + (forest(own, probing, distance, False) if len(probing) else [])
        else:
            for x, y in ((~g["probe"], True), (~g["probe"], False)):
                left = fps[first & ~g["probe"]] if y else fps[first & g["probe"]]
                right = fps[~first & x] if not y else fps[~first]
                if len(left) and len(right):
                    found += forest(left, right, distance, False)
        if found:
            u, v = zip(*found, strict=True)
            yield {"u": list(u), "v": list(v)}

    return arrow_map(dealt, _runs(key, ("block", "fp", "probe"), group), "u long, v long")


def _runs(key, columns, group):
    """A function of batches sorted by key: what group gives for the columns of each run of equal keys."""

    def run(batches):
        held = None
        for batch in batches:
            now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*key, *columns)}
            if held is not None:
                now = {c: np.concatenate((held[c], now[c])) for c in now}
            size = len(now[key[0]])
            new = np.zeros(size, bool)
            for c in key:
                new[1:] |= now[c][1:] != now[c][:-1]
            cuts = np.flatnonzero(new)
            begin = [0, *cuts.tolist()] if size else []
            for a, z in zip(begin, begin[1:], strict=False):
                yield from group({c: x[a:z] for c, x in now.items()})
            held = {c: x[begin[-1] :] for c, x in now.items()} if begin else None
        if held is not None:
            yield from group(held)

    return run


def _in_blocks(rows: DataFrame, sizes: DataFrame, bucket, by: str, columns, block: int) -> DataFrame:
    """rows of buckets, dealt out as pairs of blocks of about `block` rows. sizes: the buckets and their n."""
    sizes = sizes.select(*bucket, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = rows.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64(by), F.col("blocks").cast("long")).cast("int"))
    # a row meets those of its own block and of every other one
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(*bucket, F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "block", *columns)
    key = [*bucket, "b1", "b2"]
    return rows.repartition(*key).sortWithinPartitions(*key)


def classes_of(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: rows (doc_id, text_hash, fp), fingerprints (fp, root), components (root, least); least is the
    smallest (no_id, doc_id, text_hash) of a component, rows without doc_id last."""
    prints = cut(fingerprints(docs, words), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = cut(prints.groupBy("fp").agg(F.min(row).alias("least")), "classes")
    joined = components(links(classes.select("fp"), distance))
    named = cut(classes.join(joined, classes["fp"] == joined["vertex"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root")), "roots")
    return prints, named.select("fp", "root"), cut(named.groupBy("root").agg(F.min("least").alias("least")), "names")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) for every row of docs."""
    prints, roots, names = classes_of(docs, distance, words)
    of = cut(roots.join(names, "root").select("fp", F.col("least.doc_id").alias("component_id")), "named")
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, vertex (a hash of the set of shingles), fp, bands, sketch."""

    def run(batches):
        for batch in batches:
            hashes = [shingle_hashes(t, words) for t in batch.column("text").to_pylist()]
            sets = [np.unique(x) for x in hashes]
            fps = np.array([majority(x) for x in hashes], np.uint64).view(np.int64)
            least = [minima(x) for x in sets]
            yield {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "vertex": [signed(s) for s in sets], "fp": fps, "bands": [bands(x) for x in least], "sketch": [sketch(x) for x in least]}

    return arrow_map(with_key(docs), run, "doc_id long, text_hash long, vertex long, fp long, bands array<long>, sketch binary")


def _like(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) of (u, v, a, b) whose sketches a and b are alike."""

    def run(batches):
        for batch in batches:
            near = (sketches(batch.column("a").to_pylist()) == sketches(batch.column("b").to_pylist())).sum(axis=1) >= EQUAL
            yield {c: batch.column(c).to_numpy()[near] for c in ("u", "v")}

    return arrow_map(pairs.select("u", "v", "a", "b"), run, "u long, v long").distinct()


def _linked_in_blocks(apart: DataFrame, sizes: DataFrame, bucket, similarity: float, words: int, block: int = BLOCK // 4) -> DataFrame:
    """(u, v): links between members of a bucket with different roots, as many as join what is alike, no more. apart: band,
    value, vertex, root, bands, sketch, ztext. A pair is looked at in the first band that it shares."""
    columns = ("vertex", "root", "bands", "sketch", "ztext")
    dealt = _in_blocks(apart, sizes, bucket, "vertex", columns, block)

    def group(g):
        first = g["block"] == g["b1"][0]
        other = ~first if g["b1"][0] != g["b2"][0] else first
        ids, prints, shared, band = g["vertex"], sketches(g["sketch"]), np.stack(g["bands"]), g["band"][0]
        roots = g["root"].copy()
        sets: dict[int, np.ndarray] = {}

        def of(i):
            if i not in sets:
                sets[i] = np.unique(shingle_hashes(zstandard.ZstdDecompressor().decompress(g["ztext"][i]).decode(), words))
            return sets[i]

        u, v = [], []
        for i in np.flatnonzero(first):
            near = np.flatnonzero(other & (roots != roots[i]))
            if not len(near):
                continue
            near = near[(prints[near] == prints[i]).sum(axis=1) >= EQUAL]
            for j in near[(shared[near] == shared[i]).argmax(axis=1) == band]:
                if roots[i] != roots[j] and jaccard(of(i), of(j)) >= similarity:
                    roots[roots == roots[j]] = roots[i]
                    u.append(int(min(ids[i], ids[j])))
                    v.append(int(max(ids[i], ids[j])))
        if u:
            yield {"u": u, "v": v}

    return arrow_map(dealt, _runs([*bucket, "b1", "b2"], ("block", *columns), group), "u long, v long")


def alike(classes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, words: int = SIMILAR_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(vertex, component) of vertices with verified links. classes: vertex, least, fp, bands, sketch."""
    # one vertex stands for its fingerprint in the links of fingerprints; the others of that fingerprint hang on it
    heads = cut(classes.groupBy("fp").agg(F.min("vertex").alias("head")), "heads")
    near = links(heads.select("fp"), distance)
    u, v = (heads.select(F.col("fp").alias(x), F.col("head").alias(f"{x}_head")) for x in "uv")
    near = near.join(u, "u").join(v, "v").select(F.least("u_head", "v_head").alias("u"), F.greatest("u_head", "v_head").alias("v"))
    equal = classes.join(heads, "fp").where("vertex <> head").select(F.least("head", "vertex").alias("u"), F.greatest("head", "vertex").alias("v"))
    near = cut(near.unionByName(equal).distinct(), "near")

    # members of buckets of more than one vertex
    key = ["band", "value"]
    filed = classes.select("vertex", "bands", "sketch", F.posexplode("bands").alias("band", "value"))
    several = filed.groupBy(*key).agg(F.min("vertex").alias("a"), F.max("vertex").alias("z")).where("a <> z").select(*key)
    members = cut(filed.join(several, key), "members")

    # the texts of all that may be compared, dealt out once
    asked = members.select("vertex").unionByName(near.select(F.explode(F.array("u", "v")).alias("vertex"))).distinct()
    wanted = classes.join(asked, "vertex", "left_semi").select("vertex", "least.doc_id", "least.text_hash")
    texts = zipped(with_key(docs))
    texts = cut(texts.join(wanted, same_row(texts, wanted)).select("vertex", "ztext").dropDuplicates(["vertex"]), "texts")

    found = cut(verified(near, texts, similarity, words), "found")
    named = cut(components(found), "named")
    rooted = members.join(named, "vertex", "left").select(*key, "vertex", "bands", "sketch", F.coalesce("component", "vertex").alias("root"))
    order = F.struct(F.xxhash64("band", "vertex").alias("h"), F.struct("vertex", "root", "sketch").alias("center"))
    # buckets of one component go
    buckets = rooted.groupBy(*key).agg(F.min("root").alias("a"), F.max("root").alias("z"), F.min(order).alias("least")).where("a <> z").select(*key, "least.center")
    rooted = cut(rooted.join(buckets, key), "rooted")
    stars = rooted.where("center.root <> root").select(F.least("center.vertex", "vertex").alias("u"), F.greatest("center.vertex", "vertex").alias("v"), F.col("center.sketch").alias("a"), F.col("sketch").alias("b"))
    stars = cut(_like(stars), "stars")
    found = found.unionByName(cut(verified(stars, texts, similarity, words), "found"))
    drop(members, named)
    named = cut(components(found), "named")
    apart = cut(rooted.select(*key, "vertex", "bands", "sketch").join(named, "vertex", "left").select(*key, "vertex", "bands", "sketch", F.coalesce("component", "vertex").alias("root")), "apart")
    mixed = cut(apart.groupBy(*key).agg(F.min("root").alias("a"), F.max("root").alias("z"), F.count(F.lit(1)).alias("n")).where("a <> z").select(*key, "n"), "mixed")
    apart = apart.join(mixed.drop("n"), key).join(texts, "vertex")
    last = cut(_linked_in_blocks(apart, mixed, key, similarity, words), "last")
    drop(near, rooted, mixed, texts)
    return components(found.unionByName(last))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, words: int = SIMILAR_WORDS) -> DataFrame:
    """docs without near-duplicates by similarity: of each component the row with the smallest doc_id; of equal rows one."""
    prints = cut(_sketched(docs, words), "sketched")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = cut(prints.groupBy("vertex").agg(F.min(row).alias("least"), F.min("fp").alias("fp"), F.min("bands").alias("bands"), F.min("sketch").alias("sketch")), "classes")
    joined = alike(classes, docs, similarity, words)
    roots = classes.join(joined, "vertex", "left").select("least", F.coalesce("component", "vertex").alias("root"))
    kept = cut(roots.groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.text_hash"), "kept")
    hashed = free_name(docs, "_hash")
    docs = docs.withColumn(hashed, F.xxhash64("text"))
    out = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]) & (docs[hashed] == kept["text_hash"]), "left_semi")
    if prints.groupBy("doc_id", "text_hash").count().where("count > 1").head(1):
        out = out.dropDuplicates(["doc_id", hashed])
    drop(prints, classes)
    return out.drop(hashed)
