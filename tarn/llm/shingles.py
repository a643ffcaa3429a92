"""Word shingles, bands of their minima, and the similarity of their sets."""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

SEED = 42
SIMILARITY = 0.8
#: A pair at similarity s shares no band with a chance of (1 - s^ROWS)^BANDS, which is 0.0002 at 0.8.
BANDS = 16
ROWS = 4
#: Of a pair's BANDS * ROWS minima so many are equal before its texts are compared; at 0.8 fewer are with a chance of 0.0004.
EQUAL = 40

_RNG = np.random.default_rng(SEED)
_ADD = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends, at = [], -1
    for t in tokens:
        at += len(t) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=False)], np.uint64)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of a set of hashes under each of BANDS * ROWS orders."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for a in range(0, len(hashes), 1024):
        mixed = (hashes[a : a + 1024, None] ^ _ADD) * _TIMES
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * np.uint64(0x9E3779B97F4A7C15)).min(axis=0))
    return least


def bands(least: np.ndarray) -> list[int]:
    """A signed hash for each band; those of an empty set are all alike."""
    return [signed(least[k * ROWS : (k + 1) * ROWS]) for k in range(BANDS)]


def sketch(least: np.ndarray) -> bytes:
    """16 bits of each minimum."""
    return (least >> np.uint64(48)).astype("<u2").tobytes()


def sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, BANDS * ROWS)


def signed(values: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(values.tobytes(), SEED) - (1 << 63)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """The pairs (u, v) whose texts are alike. texts: vertex, ztext."""
    both = pairs.join(texts.select(F.col("vertex").alias("u"), F.col("ztext").alias("a")), "u").join(texts.select(F.col("vertex").alias("v"), F.col("ztext").alias("b")), "v")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        of = lambda z: np.unique(shingle_hashes(unpack.decompress(z).decode(), words))
        for batch in batches:
            sets = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            near = [jaccard(of(a), of(b)) >= similarity for a, b in sets]
            yield {c: [x for x, ok in zip(batch.column(c).to_pylist(), near, strict=True) if ok] for c in ("u", "v")}

    return arrow_map(both.select("u", "v", "a", "b"), run, "u long, v long")
