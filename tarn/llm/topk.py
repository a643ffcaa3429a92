"""Exact top-k by inner product: vectors as documents, dimensions as terms, block-at-a-time pruning.

Each component x becomes floor(1024 * x). Candidates lie in blocks of BLOCK vectors, a block being a range of vec_id of one
task; a block keeps its forward index (a matrix) and, for each term, its largest and smallest weight. For a query, the
sum over terms of the larger of weight * largest and weight * smallest bounds every score in the block. A task orders its
blocks by that bound for each query and scores them through their forward indexes until the bounds fall below the query's
kth score so far; a bound that equals it is still scored, as ties go to the smaller vec_id.

Queries come in groups of QUERY_GROUP, which bounds what is collected and broadcast: one group at a time is on the driver
and the executors, and what its pass finds is stored before the next. A task holds BLOCKS blocks at a time. What a task
emits is k rows a query; a window by query ranks these, of which Spark drops all but k a task before the shuffle.

Scores are computed in doubles where no sum can exceed 2**53, else in Python's integers, and clipped to a long.

Cases: vectors that are null, or hold a null or non-finite component, take no part; a shorter vector counts as padded with
zeros; vectors without a vec_id take no part; repeated rows of one vec_id are each a candidate (none for itself) and its
query is asked once for each distinct vector; with fewer than k candidates all come; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut

K = 10
SCALE = 1024
BLOCK = 256
BLOCKS = 64
QUERY_GROUP = 4096
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
RESULT = "query_id long, vec_id long, score long"


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of those that take part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select("vec_id", x.alias("vector"))


def whole(vector) -> np.ndarray:
    """floor(1024 * x), as doubles that are whole numbers; only a component beyond 1e305 overflows, and is clipped."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(np.asarray(vector, float) * SCALE), posinf=1.7e308, neginf=-1.7e308)


def matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray):
    """Exact inner products of the rows of a and b, clipped to longs."""
    if a.shape[1] == 0 or np.abs(a).sum(axis=1).max(initial=0) * np.abs(b).max(initial=0) < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole_a, whole_b = ([[int(x) for x in row] for row in m] for m in (a, b))
    return np.array([[max(-_LONG - 1, min(_LONG, sum(x * y for x, y in zip(p, q, strict=True)))) for q in whole_b] for p in whole_a], np.int64).reshape(len(a), len(b))


class Block:
    def __init__(self, ids, rows, width):
        self.ids, self.index = np.asarray(ids, np.int64), matrix(rows, width)
        self.high, self.low = self.index.max(axis=0), self.index.min(axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """At least every score, with room for rounding."""
        with np.errstate(over="ignore", invalid="ignore"):
            up = np.maximum(queries, 0) @ np.maximum(self.high, 0) - np.maximum(-queries, 0) @ np.minimum(self.low, 0)
            up += np.maximum(queries, 0) @ np.minimum(self.high, 0) - np.maximum(-queries, 0) @ np.maximum(self.low, 0)
            size = np.abs(queries) @ np.maximum(np.abs(self.high), np.abs(self.low))
        return np.nan_to_num(up + 1 + size * 1e-12, nan=np.inf, posinf=np.inf, neginf=-np.inf)


def search(query_ids, queries: np.ndarray, blocks: list[Block], k: int, best: list[list]) -> None:
    """best: for each query a heap of its k best (score, -vec_id) so far; blocks with the highest bound come first."""
    if not blocks:
        return
    bounds = np.stack([b.bounds(queries) for b in blocks])
    order = np.argsort(-bounds, axis=0, kind="stable")
    live = np.arange(len(query_ids))
    for step in range(len(blocks)):
        at = order[step, live]
        keep = [len(best[q]) < k or bounds[b, q] >= best[q][0][0] for q, b in zip(live, at, strict=True)]
        live, at = live[keep], at[keep]
        if not len(live):
            return
        for b in np.unique(at):
            asking = live[at == b]
            block = blocks[b]
            scores = products(queries[asking], block.index)
            for row, q in zip(scores, asking, strict=True):
                heap = best[q]
                low = heap[0][0] if len(heap) == k else -_LONG - 1
                near = np.flatnonzero((row >= low) & (block.ids != query_ids[q]))
                if len(near) > k:
                    near = near[np.lexsort((block.ids[near], -row[near]))[:k]]
                for i in near.tolist():
                    item = (int(row[i]), -int(block.ids[i]))
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)


def top_k(vectors: DataFrame, is_query=None, k: int = K, group: int = QUERY_GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other vectors for each query (default: vec_id divisible by 100)."""
    context = vectors.sparkSession.sparkContext
    rows = cut(valid(vectors), "vectors")
    asked = rows.where((F.col("vec_id") % 100 == 0) if is_query is None else is_query).distinct()
    n = -(-asked.count() // group)
    if n > 1:
        # the groups are files of their own, so that each is read once
        asked = cut(asked.withColumn("group", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n))).repartitionByRange(n, "group"), "asked")
    parts, shared = [], None
    for g in range(n):
        queries = sorted((r.vec_id, tuple(r.vector)) for r in (asked.where(F.col("group") == g) if n > 1 else asked).select("vec_id", "vector").collect())
        if parts:
            parts[-1] = cut(parts[-1], "found")
            shared.unpersist()
        shared = context.broadcast(pickle.dumps(queries))
        parts.append(_pass(rows, shared, k))
    out = parts[0] if parts else vectors.sparkSession.createDataFrame([], RESULT)
    for part in parts[1:]:
        out = out.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(rows: DataFrame, shared, k: int) -> DataFrame:
    """The k best of each task for each query of one group."""

    def run(batches):
        queries = pickle.loads(shared.value)
        ids = np.array([q for q, _ in queries], np.int64)
        best: list[list] = [[] for _ in ids]
        held_ids: list[int] = []
        held: list = []

        def flush():
            width = max(max(map(len, held)), max(len(v) for _, v in queries))
            asking = matrix([whole(v) for _, v in queries], width)
            order = np.argsort(held_ids, kind="stable")
            blocks = [Block([held_ids[i] for i in order[a : a + BLOCK]], [held[i] for i in order[a : a + BLOCK]], width) for a in range(0, len(order), BLOCK)]
            search(ids, asking, blocks, k, best)
            held_ids.clear()
            held.clear()

        for batch in batches:
            flat = batch.column("vector")
            values, ends = whole(flat.flatten().to_numpy(zero_copy_only=False)), np.cumsum([0, *flat.value_lengths().to_pylist()])
            for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
                held_ids.append(vec_id)
                held.append(values[ends[i] : ends[i + 1]])
                if len(held) >= BLOCK * BLOCKS:
                    flush()
        if held:
            flush()
        found = [(int(q), -v, s) for q, heap in zip(ids, best, strict=True) for s, v in heap]
        yield {c: [r[i] for r in found] for i, c in enumerate(("query_id", "vec_id", "score"))}

    return arrow_map(rows, run, RESULT)


ORACLE = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM fine q JOIN fine c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""
