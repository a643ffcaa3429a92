"""Language-model scores by a probabilistic suffix tree over words.

Tokens are the words of a text, ASCII letters lower-cased, then one end. Every training token is counted. The root of the
tree is the add-one unigram distribution of all of them. Contexts of one to DEPTH tokens are candidates if they occur at least
LEAST times, so the tree grows with the corpus. They are retained if their next-symbol distribution diverges from their
parent's, the longest retained suffix's, by at least DIVERGENCE nats. The state of a place is the longest retained suffix of
what stands before it; a text begins after ends. Candidates that make up at least P_MIN of the training tokens (so there are at
most 1 / P_MIN of a length) are broadcast; all others are learned where their places meet (see rarer).

Next symbols: H is the set of tokens that are frequent enough to be broadcast. A state s with n followers, of which n_H are in H:
  w in H:  p(w|s) = c(s,w) / (n + KAPPA) + left(s) * p(w|parent), the first part for followers that make up at least
           ENTRY_MIN of the training tokens, left(s) being what makes the sum over H (n_H + KAPPA * p(H|parent)) / (n + KAPPA);
  others:  p(w|s) = p(w|root) * p(not H|s) / p(not H|root).
For contexts that are not broadcast, every follower in H that occurs twice after them is kept.
So broadcast contexts, H and their followers have sizes bounded by P_MIN and ENTRY_MIN whatever the corpus, as have counts of
tokens that make up at least KNOWN_MIN. Counts of up to MIDDLE tokens that occur LEAST times are broadcast by hash; counts of
rarer tokens are joined by a shuffle, for which only a text's distinct rare tokens travel.

Cases: a null or blank text is one end; nothing to train on leaves add-one on no counts; a null doc_id counts as a
training row; repeated rows are counted and scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import copy
import math
import pickle
from collections import Counter
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, drop, sliced
from .language import held_out

LEAST = 16
DEPTH = 3
P_MIN = 2.0**-19
ENTRY_MIN = 2.0**-21
#: Tokens that make up at least this share have their counts broadcast: at most 1 / KNOWN_MIN of them.
KNOWN_MIN = 2.0**-19
DIVERGENCE = 0.01
KAPPA = 4.0
#: No word holds a space.
END = b" "
#: Bytes of coded texts whose places are looked at together: each place takes some 200 bytes meanwhile.
PIECE = 1 << 19
#: Places that a task gathers before it hands them on, and bytes of them, packed, that go together.
HELD = 1_250_000
OUT_BYTES = 4 << 20
#: Places of rarer contexts that a task learns from, and texts whose changes it sums, at once.
AT_ONCE = 1_000_000
TEXTS_AT_ONCE = 30_000
#: Tokens outside H whose hashes and counts may be broadcast.
MIDDLE = 1 << 22
#: Distinct tokens, or codes of followers, that a task gathers before it hands them on.
FLUSH = 500_000
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def token_counts(training: DataFrame) -> DataFrame:
    """(token, c) of all training texts; each task sums its own first."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(words(text))
                counts[END] += 1
                if len(counts) >= FLUSH:
                    yield {"token": list(counts), "c": list(counts.values())}
                    counts.clear()
        yield {"token": list(counts), "c": list(counts.values())}

    return arrow_map(training.select("text"), run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Lookup:
    """Where numbers stand in a list of distinct ones, by a table of their hashes: a look or two, where a search by halves takes
    twenty in places that are far apart."""

    def __init__(self, codes: np.ndarray):
        self.shift = np.uint64(64 - max(4, (2 * len(codes)).bit_length()))
        slot = self._slot(codes)
        order = np.argsort(slot)
        self.codes, self.index = codes[order], order.astype(np.int32)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(slot, minlength=1 << (64 - int(self.shift)))))).astype(np.int32)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.int64, copy=False).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of codes are there, ascending, and where."""
        slot = self._slot(codes)
        a, z = self.first[slot], self.first[slot + 1]
        live = np.flatnonzero(a < z)
        a, z, code = a[live], z[live], codes[live]
        which, where = [], []
        while len(live):
            hit = self.codes[a] == code
            which.append(live[hit])
            where.append(self.index[a[hit]])
            on = np.flatnonzero(~hit & (a + 1 < z))
            live, a, z, code = live[on], a[on] + 1, z[on], code[on]
        if len(which) < 2:
            return (which[0], where[0]) if which else (live, live)
        which, where = np.concatenate(which), np.concatenate(where)
        order = np.argsort(which, kind="stable")
        return which[order], where[order]


class Tree:
    """Root, states, and their followers."""

    def __init__(self, tokens: list[tuple[bytes, int]], total: int, distinct: int):
        self.total, self.distinct, self.size = total, distinct, len(tokens)
        self.ids = {t: i for i, (t, _) in enumerate(tokens)}
        self.end = self.ids.get(END, self.size)
        self.counts = np.array([c for _, c in tokens], np.int64)
        self.root = (self.counts + 1) / (total + distinct + 1)
        self.other = max(1 - self.root.sum(), 1e-12)
        self.low = np.log10(1 / (total + distinct + 1))
        #: candidates of each depth by number: at depth 1 tokens of H; deeper, the number of the suffix and the token before
        #: it, as sorted codes; and the state of each, or -1
        self.codes: list[np.ndarray] = []
        self.states: list[np.ndarray] = []
        #: for each state: parent (-1: root), left, p(not H|s) / p(not H|root), p(H|s)
        self.parent, self.left, self.ratio, self.in_h = np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0)
        self.entry_codes, self.entry_p = np.zeros(0, np.int64), np.zeros(0)
        #: log10 of the root's p of tokens outside H whose counts are known here
        self.known: dict[bytes, float] = {}
        #: sorted hashes of the tokens outside H that may stand in contexts, and log10 of the root's p of each; None: not known
        self.middle: np.ndarray | None = None
        self.middle_p = np.zeros(0)
        #: of codes and entry_codes, on workers (see _model)
        self.lookups: list[Lookup] = []
        self.entry_lookup: Lookup | None = None

    def without_words(self) -> Tree:
        """For passes over coded texts."""
        out = copy.copy(self)
        out.ids, out.known = {}, {}
        return out

    def before(self, ids: np.ndarray, starts: np.ndarray, depth: int, end: int | None = None) -> list[np.ndarray]:
        """The token before each place, the one before that, and so on; a text begins after ends."""
        end = self.end if end is None else end
        sizes = np.diff(np.append(starts, len(ids)))
        out = []
        for d in range(1, depth + 1):
            token = np.empty(len(ids), ids.dtype)
            token[d:] = ids[: max(0, len(ids) - d)]
            for j in range(d):
                token[starts[sizes > j] + j] = end
            out.append(token)
        return out

    def number(self, before: list[np.ndarray], depth: int) -> np.ndarray:
        """The number among the candidates of this depth of what stands before each place, or -1."""
        number = np.where(before[0] < self.size, before[0], -1)
        for d in range(1, depth):
            number = self._deeper(number, before[d], d)
        return number

    def _deeper(self, number: np.ndarray, token: np.ndarray, d: int) -> np.ndarray:
        codes = self.codes[d - 1]
        if not len(codes):
            return np.full(len(number), -1)
        if self.lookups:
            out = np.full(len(number), -1)
            at = np.flatnonzero((number >= 0) & (token < self.size))
            which, where = self.lookups[d - 1].find(number[at] * (self.size + 1) + token[at])
            out[at[which]] = where
            return out
        code = number * (self.size + 1) + token
        k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where((number >= 0) & (token < self.size) & (codes[k] == code), k, -1)

    def in_middle(self, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash would be in middle, and whether it is there."""
        if self.middle is None or not len(self.middle):
            return np.zeros(len(far), np.int64), np.zeros(len(far), bool)
        at = np.minimum(np.searchsorted(self.middle, far), len(self.middle) - 1)
        return at, self.middle[at] == far

    def p(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """p(token | state) for tokens of H."""
        out = np.zeros(len(state))
        scale = np.ones(len(state))
        at = state.copy()
        while True:
            live = np.flatnonzero(at >= 0)
            if not len(live):
                break
            code = at[live] * (self.size + 1) + token[live]
            if self.entry_lookup is not None:
                which, k = self.entry_lookup.find(code)
                which = live[which]
            else:
                k = np.minimum(np.searchsorted(self.entry_codes, code), len(self.entry_codes) - 1)
                hit = self.entry_codes[k] == code if len(self.entry_codes) else np.zeros(len(code), bool)
                which, k = live[hit], k[hit]
            out[which] += scale[which] * self.entry_p[k]
            scale[live] *= self.left[at[live]]
            at[live] = self.parent[at[live]]
        return out + scale * self.root[token]

    def state_of(self, before: list[np.ndarray]) -> np.ndarray:
        """The longest retained suffix of each place."""
        number = np.where(before[0] < self.size, before[0], -1)
        state = np.full(len(number), -1)
        for d, states in enumerate(self.states):
            if d:
                number = self._deeper(number, before[d], d)
            if len(states):
                found = np.where(number >= 0, states[number], -1)
                state = np.where(found >= 0, found, state)
        return state

    def add(self, contexts: np.ndarray, parents: np.ndarray, n: np.ndarray, n_other: np.ndarray, entries, divergence: float, kappa: float) -> np.ndarray:
        """States for those contexts whose distribution diverges from their parent's; entries: (context index, token, c).

        Returns for each context its state, or -1.
        """
        which, token, c = entries
        parent_h = np.where(parents >= 0, self.in_h[parents], 1 - self.other) if len(self.in_h) else np.full(len(n), 1 - self.other)
        parent_ratio = np.where(parents >= 0, self.ratio[parents], 1.0) if len(self.ratio) else np.ones(len(n))
        kept = np.bincount(which, weights=c, minlength=len(n)) if len(which) else np.zeros(len(n))
        p_other = (n_other + kappa * parent_ratio * self.other) / (n + kappa)
        left = np.maximum(n - n_other - kept + kappa * parent_h, 1e-12) / ((n + kappa) * np.maximum(parent_h, 1e-12))
        entry = c / (n[which] + kappa)
        if len(which):
            base = self.p(parents[which], token)
            full = entry + left[which] * base
            gain = np.bincount(which, weights=full * np.log(full / base), minlength=len(n))
            rest = np.maximum(1 - p_other - np.bincount(which, weights=full, minlength=len(n)), 0)
        else:
            gain, rest = np.zeros(len(n)), 1 - p_other
        gain = gain + rest * np.log(np.maximum(left, 1e-12)) + p_other * np.log(np.maximum(p_other, 1e-12) / np.maximum(parent_ratio * self.other, 1e-12))
        keep = gain >= divergence
        state = np.where(keep, np.cumsum(keep) - 1 + len(self.parent), -1)
        self.parent = np.concatenate((self.parent, parents[keep]))
        self.left = np.concatenate((self.left, left[keep]))
        self.ratio = np.concatenate((self.ratio, (p_other / self.other)[keep]))
        self.in_h = np.concatenate((self.in_h, (1 - p_other)[keep]))
        mine = keep[which] if len(which) else np.zeros(0, bool)
        codes, probs = state[which][mine] * (self.size + 1) + token[mine], entry[mine]
        # states are numbered upwards, so new codes come after those that are there
        order = np.argsort(codes)
        self.entry_codes, self.entry_p = np.concatenate((self.entry_codes, codes[order])), np.concatenate((self.entry_p, probs[order]))
        return state


def _shared(df: DataFrame, tree: Tree):
    """The tree as a broadcast of bytes, which workers without this package can read too."""
    return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(tree))


def _model(shared, entries: bool = False) -> Tree:
    """The tree of a broadcast, with lookups of its candidates and, if asked for, of its entries. The broadcast, which a worker
    keeps for its next tasks, holds it in place of the bytes."""
    if not hasattr(shared, "tree"):
        shared.tree = pickle.loads(shared.value)
        shared.tree.lookups = [Lookup(x) for x in shared.tree.codes]
        shared.tree.entry_lookup = Lookup(shared.tree.entry_codes) if entries else None
        shared.__dict__.pop("_value", None)
    return shared.tree


def _hash(token: bytes) -> int:
    """A signed 64-bit hash, below zero, which no number of a token of H is."""
    return -1 - (xxhash.xxh64_intdigest(token) >> 1)


CODED = "doc_id long, held_out boolean, ids array<int>, far array<long>, known long, known_sum double, rest array<struct<token: binary, n: int>>"


def coded(docs: DataFrame, tree: Tree) -> DataFrame:
    """Stored: each text as ids of its tokens (the size of H for others), hashes of those others in their order, what is known of
    them, and counts of the rest."""
    shared = _shared(docs, tree)

    def run(batches):
        model = pickle.loads(shared.value)
        get, other, known, hashed = model.ids.get, model.size, model.known.get, xxhash.xxh64_intdigest
        end = [] if model.end < model.size else [(END, 1)]
        for batch in batches:
            ids, rare = [], []
            for text in batch.column("text").to_pylist():
                w = words(text)
                ids.append([get(x, other) for x in w])
                rare.append([x for x, i in zip(w, ids[-1], strict=True) if i == other])
                ids[-1].append(model.end)
            far = np.array([-1 - (hashed(x) >> 1) for some in rare for x in some], np.int64)
            which = np.repeat(np.arange(len(rare)), [len(x) for x in rare])
            at, hit = model.in_middle(far)
            found, total = np.bincount(which[hit], minlength=len(rare)), np.bincount(which[hit], weights=model.middle_p[at[hit]] if hit.any() else None, minlength=len(rare)).astype(float)
            ends = np.cumsum([0, *(len(x) for x in rare)])
            rest = []
            for k, some in enumerate(rare):
                left = Counter(compress(some, (~hit[ends[k] : ends[k + 1]]).tolist()))
                for x in [x for x in left if known(x) is not None] if model.known else ():
                    n = left.pop(x)
                    found[k], total[k] = found[k] + n, total[k] + n * known(x)
                rest.append([{"token": t, "n": n} for t, n in (*left.items(), *end)])
            yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "ids": ids, "far": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(far)), "known": found, "known_sum": total, "rest": rest}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(7, 2).alias("held_out"))
    # the row number is stored with the row, so it stays the same whatever is computed again
    return cut(arrow_map(rows, run, CODED).withColumn("row", F.monotonically_increasing_id()), "coded")


def _sequence(batch) -> tuple[np.ndarray, np.ndarray]:
    """The joined ids of a batch and where each text begins. Every text has its end."""
    column = batch.column("ids")
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate(([0], ends[:-1])).astype(np.int64)


def _followers(rows: DataFrame, tree: Tree, depth: int) -> DataFrame:
    """(context, token, c): how often each token follows each candidate of this depth; token H stands for all others."""
    shared = _shared(rows, tree.without_words())

    def run(batches):
        model = _model(shared)
        held, size = [], 0

        def out():
            code, c = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return {"context": code // (model.size + 1), "token": code % (model.size + 1), "c": c}

        for batch in sliced(batches, PIECE):
            if not batch.num_rows:
                continue
            ids, starts = _sequence(batch)
            context = model.number(model.before(ids, starts, depth), depth)
            ok = context >= 0
            held.append(context[ok] * (model.size + 1) + ids[ok])
            size += int(ok.sum())
            if size >= 8 * FLUSH:
                yield out()
                size = 0
        if held:
            yield out()

    return arrow_map(rows.select("ids"), run, "context long, token long, c long").groupBy("context", "token").agg(F.sum("c").alias("c"))


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    """df on the driver, of a size that the caller knows to be bounded."""
    found = df.toArrow()
    return {c: found.column(c).to_numpy() for c in df.columns}


def _grow(tree: Tree, followers: DataFrame, parents: np.ndarray, total: int, entry_min: float, divergence: float, kappa: float) -> np.ndarray:
    """Adds the states of a depth's candidates, of which there are at most 1 / P_MIN; followers kept: 1 / ENTRY_MIN."""
    sums = _columns(followers.groupBy("context").agg(F.sum("c").alias("n"), F.sum(F.when(F.col("token") == tree.size, F.col("c")).otherwise(0)).alias("o")))
    n, o = np.zeros(len(parents)), np.zeros(len(parents))
    n[sums["context"]], o[sums["context"]] = sums["n"], sums["o"]
    rows = _columns(followers.where((F.col("token") < tree.size) & (F.col("c") >= max(2, total * entry_min))))
    return tree.add(np.arange(len(parents)), parents, n, o, (rows["context"].astype(np.int64), rows["token"].astype(np.int64), rows["c"].astype(float)), divergence, kappa)


def vocabulary(training: DataFrame, p_min: float = P_MIN, least: int = LEAST) -> tuple[Tree, DataFrame]:
    """A tree that is a root only, and the stored table (token, c)."""
    tokens = cut(token_counts(training), "tokens")
    sums = tokens.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums.n or 0, sums.v
    often = max(least, total * p_min)
    known = _columns(tokens.where(F.col("c") >= min(often, max(1, total * KNOWN_MIN))))
    common = sorted(zip(map(bytes, known["token"]), known["c"].tolist(), strict=True), key=lambda x: (-x[1], x[0]))
    tree = Tree([x for x in common if x[1] >= often], total, distinct)
    tree.often = often
    tree.known = {t: math.log10(c + 1) + tree.low for t, c in common[tree.size :]}
    some = tokens.where((F.col("c") >= least) & (F.col("c") < often))
    if often > least and some.count() <= MIDDLE:

        def run(batches):
            for batch in batches:
                yield {"hash": [_hash(x) for x in batch.column("token").to_pylist()], "c": batch.column("c")}

        middle = _columns(arrow_map(some, run, "hash long, c long"))
        order = np.argsort(middle["hash"])
        tree.middle, tree.middle_p = middle["hash"][order], np.log10(middle["c"][order] + 1.0) + tree.low
    return tree, tokens


def grow(tree: Tree, rows: DataFrame, entry_min: float = ENTRY_MIN, divergence: float = DIVERGENCE, kappa: float = KAPPA, depth: int = DEPTH) -> None:
    """Adds the states that the training texts in rows (see coded) give."""
    if not tree.size:
        return
    # a candidate's tokens, the last one first, and its longest retained proper suffix
    contexts, parents = np.arange(tree.size)[:, None], np.full(tree.size, -1)
    for d in range(1, depth + 1):
        followers = cut(_followers(rows, tree, d), "followers")
        states = _grow(tree, followers, parents, tree.total, entry_min, divergence, kappa)
        tree.states.append(states)
        if d == depth:
            drop(followers)
            break
        # what follows a candidate often is, together with it, a candidate of the next depth, if its own suffix is one
        longer = _columns(followers.where((F.col("token") < tree.size) & (F.col("c") >= tree.often)).select("context", "token"))
        drop(followers)
        longer = np.column_stack((longer["token"].astype(np.int64), contexts[longer["context"].astype(np.int64)]))
        suffix = tree.number([longer[:, i] for i in range(d)], d)
        longer, suffix = longer[suffix >= 0], suffix[suffix >= 0]
        if not len(suffix):
            break
        codes = suffix * (tree.size + 1) + longer[:, d]
        order = np.argsort(codes)
        own = np.where(states >= 0, states, parents)
        contexts, parents = longer[order], own[suffix[order]]
        tree.codes.append(codes[order])


def train(
    training: DataFrame, p_min: float = P_MIN, entry_min: float = ENTRY_MIN, divergence: float = DIVERGENCE, kappa: float = KAPPA, least: int = LEAST, depth: int = DEPTH
) -> tuple[Tree, DataFrame]:
    """The tree, and the stored table (token, c)."""
    tree, tokens = vocabulary(training, p_min, least)
    rows = coded(training, tree)
    grow(tree, rows, entry_min, divergence, kappa, depth)
    drop(rows)
    return tree, tokens


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the end of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What is dealt of a place: how many tokens the tree's longest candidate before it has, that one's number, the token before
#: that (whole, in two parts) and the two tokens still before, the token itself, the row, whether it is a training place.
_PLACE = (np.uint8, np.int32, np.uint32, np.uint32, np.uint32, np.uint32, np.int32, np.int64, np.bool_)
#: What is handed back: a row and by how much its score changes.
_CHANGE = (np.int64, np.float64)
#: No token stands there, or none that makes a longer context.
_NO = 0x7FFFFFFF
#: For a token that is itself too rare for any context.
_RARE = -(1 << 63)


def _packed(columns: list[np.ndarray], kinds) -> bytes:
    """Columns byte by byte, which squeeze better so; rows, which mostly ascend, as differences."""
    columns = [np.diff(x, prepend=0) if t is np.int64 else x for x, t in zip(columns, kinds, strict=True)]
    raw = b"".join(x.astype(t, copy=False).view(np.uint8).reshape(len(x), -1).T.tobytes() for x, t in zip(columns, kinds, strict=True))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpacked(blobs: list[bytes], kinds) -> list[np.ndarray]:
    """The columns of all blobs, which are let go one by one."""
    width = sum(np.dtype(t).itemsize for t in kinds)
    sizes = [zstandard.frame_content_size(x) // width for x in blobs]
    columns = [np.empty(sum(sizes), t) for t in kinds]
    a = 0
    blobs.reverse()
    for n in sizes:
        raw, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(blobs.pop()), np.uint8), 0
        for x in columns:
            size = x.dtype.itemsize
            part = np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(x.dtype).ravel()
            x[a : a + n] = np.cumsum(part) if x.dtype == np.int64 else part
            at += n * size
        a += n
    return columns


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of parts parts each is dealt to, by 64-bit hashes, in as few bytes as hold it: short numbers are sorted by their digits."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)


def _split(part: np.ndarray, columns: list[np.ndarray], kinds):
    """Lists of parts that there are, and of their rows packed, by the first column, OUT_BYTES or little more at a time; no
    column is there twice."""
    order = np.lexsort((columns[0], part))
    sizes = np.bincount(part)
    numbers, blobs, size, a = [], [], 0, 0
    for k in np.flatnonzero(sizes).tolist():
        at = order[a : a + sizes[k]]
        numbers.append(k)
        blobs.append(_packed([x[at] for x in columns], kinds))
        a, size = a + len(at), size + len(blobs[-1])
        if size >= OUT_BYTES:
            yield numbers, blobs
            numbers, blobs, size = [], [], 0
    if blobs:
        yield numbers, blobs


def _context(found: np.ndarray, number: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """64-bit hashes of the shortest contexts beyond the tree, by which they are dealt and told apart."""
    token = high.astype(np.uint64) << np.uint64(32) | low
    return _mix(_mix(token + np.uint64(0x9E3779B97F4A7C15)) + (number.astype(np.uint64) << np.uint64(2) | found))


def _open_places(model: Tree, batch, depth: int) -> list[np.ndarray]:
    """The columns of _PLACE for those places of a batch that have a context of at most depth tokens beyond the tree's, of
    tokens of H and middle."""
    ids, starts = _sequence(batch)
    sizes = np.diff(np.append(starts, len(ids)))
    # tokens as they are told apart: numbers of H, hashes of others
    end = model.end if model.end < model.size else _hash(END)
    exact = ids.copy()
    exact[starts + sizes - 1] = end
    others = ids == model.size
    others[starts + sizes - 1] = False
    far = batch.column("far").flatten().to_numpy(zero_copy_only=False)
    if model.middle is not None:
        far = np.where(model.in_middle(far)[1], far, _RARE)
    exact[others] = far
    token = model.before(exact, starts, depth, end)

    def short(at, d):
        x = token[d][at]
        # what stands before a text's beginning makes no longer context
        return np.where((token[d - 1][at] == end) | (x == _RARE), _NO, np.where(x >= 0, x, (x & 0x7FFFFFFF) | 0x80000000)).astype(np.uint32)

    out = []
    at, number = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    for d in range(depth):
        t = token[d][at]
        if d:
            real = token[d - 1][at] != end
            at, number, t = at[real], number[real], t[real]
            longer = model._deeper(number, np.where(t >= 0, t, model.size), d) if d <= len(model.codes) else np.full(len(at), -1)
        else:
            longer = np.where(t >= 0, t, -1)
        gone = (longer < 0) & (t != _RARE)
        here, whole = at[gone], t[gone].view(np.uint64)
        more = [short(here, e) if e < depth else np.full(len(here), _NO, np.uint32) for e in (d + 1, d + 2)]
        if d + 2 < depth:
            more[1][more[0] == _NO] = _NO
        out.append([np.full(len(here), d, np.uint8), number[gone].astype(np.int32), (whole & np.uint64(0xFFFFFFFF)).astype(np.uint32), (whole >> np.uint64(32)).astype(np.uint32), *more, here])
        at, number = at[longer >= 0], longer[longer >= 0]
    *columns, places = [np.concatenate(x) for x in zip(*out, strict=True)]
    text = np.repeat(np.arange(len(starts)), sizes)[places]
    row = batch.column("row").to_numpy(zero_copy_only=False)[text]
    return [*columns, ids[places].astype(np.int32), row, ~batch.column("held_out").to_numpy(zero_copy_only=False)[text]]


def _learned(model: Tree, places: list[np.ndarray], least: int, divergence: float, kappa: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, by how much its log10 p changes) of places whose state is one of the contexts that these places, all of theirs, give.

    places is emptied.
    """
    found, number, low, high, second, third, token, row, train = places
    places.clear()
    before, own = np.full(len(row), -1), None
    for d, states in enumerate(model.states, 1):
        # the longest retained suffix of each candidate
        own = states if own is None else np.where(states >= 0, states, own[model.codes[d - 2] // (model.size + 1)])
        on = found == d
        before[on] = own[number[on]]
    _, group = np.unique(_context(found, number, low, high), return_inverse=True)
    del found, number, low, high
    at = np.arange(len(row))
    now, token = before.copy(), token.astype(np.int64)
    for following in (second, third, None):
        # contexts that occur often enough, by number
        keep = np.bincount(group, weights=train[at]) >= least
        at, group = at[keep[group]], (np.cumsum(keep) - 1)[group[keep[group]]]
        if not len(at):
            break
        first = np.empty(int(keep.sum()), np.int64)
        first[group] = np.arange(len(group))
        learn = train[at]
        g, w = group[learn], token[at[learn]]
        code, c = np.unique(g[w < model.size] * (model.size + 1) + w[w < model.size], return_counts=True)
        code, c = code[c >= 2], c[c >= 2]
        entries = (code // (model.size + 1), code % (model.size + 1), c.astype(float))
        states = model.add(np.arange(len(first)), now[at[first]], np.bincount(g).astype(float), np.bincount(g, weights=w == model.size), entries, divergence, kappa)
        now[at] = np.where(states[group] >= 0, states[group], now[at])
        if following is None:
            break
        longer = following[at] != _NO
        at, group = at[longer], group[longer]
        _, group = np.unique(group.astype(np.uint64) << np.uint64(32) | following[at], return_inverse=True)
    new = np.flatnonzero(now != before)
    a, z, token = before[new], now[new], token[new]
    in_h = token < model.size
    out = np.log10(model.ratio[z]) - np.log10(np.where(a >= 0, model.ratio[a], 1.0)) if len(new) else np.zeros(0)
    out[in_h] = np.log10(model.p(z[in_h], token[in_h])) - np.log10(model.p(a[in_h], token[in_h]))
    return row[new], out


def _numbers(spark, parts: int) -> np.ndarray:
    """A number for each of parts partitions that Spark deals there."""
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p")
    out = np.arange(parts)
    for p, n in spark.range(16 * parts).select(place, "id").groupBy("p").agg(F.min("id")).collect():
        out[p] = n
    return out


def rarer(rows: DataFrame, tree: Tree, least: int = LEAST, divergence: float = DIVERGENCE, kappa: float = KAPPA, depth: int = DEPTH, at_once: int = AT_ONCE) -> DataFrame | None:
    """Stored (row, delta): what the contexts that occur least times, but not often enough for the tree, add to the scores.

    Places are dealt by the shortest context beyond the tree's, so that all of a context meet. Only those are not whose context
    has a token that itself occurs fewer than least times, while the tokens that occur least times can be broadcast.
    """
    if not tree.size or tree.often <= least:
        return None
    spark = rows.sparkSession
    shared = _shared(rows, tree.without_words())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(1.2 * tree.total / at_once))
    texts = int(tree.counts[tree.end]) if tree.end < tree.size else 1
    back = max(12, math.ceil(texts / TEXTS_AT_ONCE))
    numbers, back_numbers = _numbers(spark, parts), _numbers(spark, back)

    def deal(batches):
        model = _model(shared)
        kinds = (np.uint16 if parts <= 1 << 16 else np.uint32, *_PLACE)
        held, size = [np.empty(0, t) for t in kinds], 0

        def out():
            for part, blobs in _split(held[0][:size], [x[:size] for x in held[1:]], _PLACE):
                yield {"part": numbers[part], "places": blobs}

        for batch in sliced(batches, PIECE):
            if not batch.num_rows:
                continue
            columns = _open_places(model, batch, depth)
            n = len(columns[0])
            if size + n > len(held[0]):
                yield from out()
                size = 0
                if n > len(held[0]):
                    held = [np.empty(max(n, HELD), t) for t in kinds]
            for x, y in zip(held, (_part(_context(*columns[:4]), parts), *columns), strict=True):
                x[size : size + n] = y
            size += n
        yield from out()

    def learn(batches):
        held = [x for batch in batches for x in batch.column("places").to_pylist()]
        if held:
            row, delta = _learned(copy.copy(_model(shared)), _unpacked(held, _PLACE), least, divergence, kappa)
            if len(row):
                found, place = np.unique(row, return_inverse=True)
                for part, blobs in _split(_part(_mix(found.astype(np.uint64)), back), [found, np.bincount(place, weights=delta)], _CHANGE):
                    yield {"part": back_numbers[part], "changes": blobs}

    def summed(batches):
        held = [x for batch in batches for x in batch.column("changes").to_pylist()]
        if held:
            row, delta = _unpacked(held, _CHANGE)
            found, place = np.unique(row, return_inverse=True)
            yield {"row": found, "delta": np.bincount(place, weights=delta)}

    dealt = arrow_map(rows.select("row", "held_out", "ids", "far"), deal, "part int, places binary").repartition(parts, "part")
    changes = arrow_map(dealt.select("places"), learn, "part int, changes binary").repartition(back, "part")
    return cut(arrow_map(changes.select("changes"), summed, "row long, delta double"), "rarer")


def score(docs: DataFrame, tree: Tree, tokens: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs, by the tree alone."""
    return scored(coded(docs, tree), tree, tokens)


def scored(rows: DataFrame, tree: Tree, tokens: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """As score, of stored rows; more: (row, delta) that are added to scores."""
    shared = _shared(rows, tree.without_words())

    def run(batches):
        model = _model(shared, True)
        log_root = np.log10(model.root) if model.size else np.zeros(0)
        for batch in sliced(batches, PIECE):
            if not batch.num_rows:
                continue
            ids, starts = _sequence(batch)
            in_h = ids < model.size
            base, full = np.zeros(len(ids)), np.zeros(len(ids))
            if model.size:
                state = model.state_of(model.before(ids, starts, max(1, len(model.states))))
                base[in_h] = log_root[ids[in_h]]
                full[in_h] = np.log10(model.p(state[in_h], ids[in_h]))
                far = ~in_h & (state >= 0)
                full[far] = np.log10(model.ratio[state[far]])
            sums = batch.column("known_sum").to_numpy(zero_copy_only=False)
            yield {
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": np.append(starts[1:], len(ids)) - starts,
                "in_h": np.add.reduceat(in_h.astype(np.int64), starts) + batch.column("known").to_numpy(zero_copy_only=False), "base": np.add.reduceat(base, starts) + sums, "full": np.add.reduceat(full, starts) + sums,
            }

    kept = arrow_map(rows.drop("rest", "far"), run, "row long, doc_id long, held_out boolean, n_tokens long, in_h long, base double, full double")
    rest = rows.select("row", F.explode("rest").alias("x")).select("row", "x.token", "x.n")
    low = F.lit(float(tree.low))
    known = F.coalesce(F.col("c"), F.lit(0))
    tail = (
        rest.join(tokens, "token", "left")
        .groupBy("row")
        .agg(F.sum(F.when(known > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * (F.log10((known + 1).cast("double")) + low)).alias("sum"))
    )
    out = kept.join(tail, "row", "left")
    plus, delta = F.coalesce(F.col("sum"), F.lit(0.0)), F.lit(0.0)
    if more is not None:
        out = out.join(more, "row", "left")
        delta = F.coalesce(F.col("delta"), F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("in_h") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") + plus).alias("base_score"), (F.col("full") + plus + delta).alias("score"),
    )


def score_all(docs: DataFrame) -> DataFrame:
    """Learns from rows whose crc32(doc_id as text) mod 7 is not 2 and scores every row."""
    tree, tokens = vocabulary(docs.where(~held_out(7, 2)))
    rows = coded(docs, tree)
    grow(tree, rows.where(~F.col("held_out")))
    return scored(rows, tree, tokens, rarer(rows, tree))
