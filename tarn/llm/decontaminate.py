"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as words: ASCII letters lower-cased, other ASCII than letters and digits is white space.
An item of n bytes may differ in RATE * n edits. It is cut into one piece more than that, so any occurrence within the
budget holds some piece unchanged. An Aho-Corasick automaton finds every piece in one pass over a whole text. Around each
hit, sequences of GRAM bytes are counted: an edit spoils at most GRAM of an item's sequences, so a window that has too few
holds no occurrence. In the others, Myers' bit-parallel algorithm takes the least edit distance of the item to a part of
the text.

Items of fewer than MIN_WORDS words, whose edits would make other sentences, are found unchanged and between word borders.

The automaton travels as a broadcast, which goes when its pass has ended; a benchmark of more than GROUP_BYTES is searched
in groups of about that size, one pass over the documents each, and only one group at a time is on the driver.

Cases: null texts and items, and items without a letter or digit, match nothing; repeated rows are each reported; empty
tables give no rows.
"""

from __future__ import annotations

import pickle

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, sliced

RATE = 0.1
MIN_WORDS = 5
GRAM = 4
GROUP_BYTES = 1 << 20
RESULT = "doc_id long, item_id long, edits long, item_bytes long, at_byte long"

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: str | None) -> str:
    """The compared form, one character a byte."""
    return b" ".join((text or "").encode().translate(_PLAIN).split()).decode("latin-1")


def split(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of nearly equal length with their places."""
    n = budget + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern of m characters to any part of text, and where that part ends."""
    every, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = every, 0, m, m, 0
    get = peq.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (every & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & every, (mh << 1) & every
        pv = mh | (every & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def grams(data: np.ndarray) -> np.ndarray:
    """16 bits of a hash of the GRAM bytes at each place."""
    n = max(len(data) - GRAM + 1, 0)
    h = np.zeros(n, np.uint32)
    for k in range(GRAM):
        h = (h + data[k : k + n]) * np.uint32(2654435761)
    return (h >> np.uint32(16)).astype(np.uint16)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("latin-1"), np.uint8)


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = plain(text)
            if not item:
                continue
            budget = int(rate * len(item)) if item.count(" ") + 1 >= MIN_WORDS else 0
            for at, piece in split(item, budget):
                pieces.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, item, budget, masks(item) if budget else None, grams(_bytes(item)) if budget else None))
        self.automaton = ahocorasick.Automaton()
        for piece, at in pieces.items():
            self.automaton.add_word(piece, (len(piece), at))
        if pieces:
            self.automaton.make_automaton()
        self.any = bool(pieces)
        self.seen = np.zeros(1 << 16, bool)

    def __call__(self, text: str | None, first_only: bool = False) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, bytes of the item, where its occurrence ends) for each item found."""
        if not self.any or not text:
            return []
        text = plain(text)
        spots: dict[int, list[int]] = {}
        for end, (n, at) in self.automaton.iter(text):
            for k, offset in at:
                spots.setdefault(k, []).append(end + 1 - n - offset)
        out, codes = [], None
        for k, starts in spots.items():
            item_id, item, budget, peq, own = self.items[k]
            m = len(item)
            if not budget:
                whole = [a for a in starts if _bordered(text, a, a + m)]
                best, where = (0, whole[0] + m) if whole else (1, 0)
            else:
                if codes is None:
                    codes = grams(_bytes(text))
                best, where = self._nearest(text, codes, item, budget, peq, own, sorted(starts))
            if best <= budget:
                out.append((item_id, best, m, where))
                if first_only:
                    break
        return out

    def _nearest(self, text, codes, item, budget, peq, own, starts) -> tuple[int, int]:
        """The least distance within the budget, or one more, and where that occurrence ends."""
        best, where, m, i = budget + 1, 0, len(item), 0
        least = len(own) - GRAM * budget
        while i < len(starts) and best:
            # hits that may belong to one occurrence share a window
            j = i
            while j + 1 < len(starts) and starts[j + 1] - starts[j] <= budget:
                j += 1
            a, z = max(0, starts[i] - budget), starts[j] + m + budget
            i = j + 1
            there = codes[a : max(z - GRAM + 1, a)]
            self.seen[there] = True
            shared = int(self.seen[own].sum())
            self.seen[there] = False
            if shared < least:
                continue
            window = text[a:z]
            if (at := window.find(item)) >= 0:
                return 0, a + at + m
            d, e = myers(peq, m, window)
            if d < best:
                best, where = d, a + e
        return best, where


def _bordered(text: str, a: int, z: int) -> bool:
    return (a == 0 or text[a - 1] == " ") and (z == len(text) or text[z] == " ")


def _groups(benchmark: DataFrame, group_bytes: int):
    """The items, of which each group is checked to hold about group_bytes at most; one group at a time."""
    rows = benchmark.where("text is not null").select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // group_bytes)
    for g in range(n):
        yield sorted(map(tuple, rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == g).collect()), key=lambda x: (x[0] is None, x))


def _passes(docs: DataFrame, benchmark: DataFrame, group_bytes: int, step):
    """step(docs, broadcast items) for each group of items. All but the last pass are stored, so that their broadcast can go."""
    held = None
    for items in _groups(benchmark, group_bytes):
        if held is not None:
            yield cut(held[0], "decontaminated")
            held[1].unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(items))
        held = step(shared), shared
    if held is not None:
        yield held[0]


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """A row for each document row and test item found in it: doc_id, item_id, edits, item_bytes, at_byte."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def step(shared):
        def run(batches):
            found = Matcher(pickle.loads(shared.value), rate)
            for batch in batches:
                rows = [(i, *x) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for x in found(t)]
                yield {c: [r[k] for r in rows] for k, c in enumerate(names)}

        return arrow_map(texts, run, RESULT)

    out = None
    for part in _passes(docs, benchmark, group_bytes, step):
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], RESULT) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """docs without those in which a test item is found."""
    left, schema = docs, docs.schema

    def step(shared):
        def run(batches):
            found = Matcher(pickle.loads(shared.value), rate)
            for batch in sliced(batches):
                yield batch.filter(pa.array([not found(t, True) for t in batch.column("text").to_pylist()], pa.bool_()))

        return left.mapInArrow(run, schema)

    for part in _passes(docs, benchmark, group_bytes, step):
        left = part
    return left
