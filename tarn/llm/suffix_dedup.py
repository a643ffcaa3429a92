"""Removal of long repeated substrings by prefix-free parsing, without a suffix array on one machine.

A byte goes if a LENGTH-byte string that covers it also starts anywhere else (another place of the same document counts,
overlaps too; matches do not cross documents). Strings are judged on the input. Several lengths can be asked for at once.

Parsing. A rolling hash of every GRAM bytes is taken; a place is a trigger if its hash is the smallest (the last one of
equals) of some run of GAP places, so every string has a trigger of its own, fixed by its own bytes alone, in its first GAP
places. Triggers cut the text into phrases: the run of string starts that one trigger owns, with the bytes those strings
cover. The dictionary is the set of distinct phrases; the parse is the list of triggers of each document.

Corpus order. As in prefix-free parsing, the place of a string in the order of all suffixes is that of its part before the
trigger, a suffix of the phrase's head, then that of the text after the trigger, a suffix of the parse. Only neighbours that
share a whole string matter, so both orders are only built where two suffixes of the parse agree that far:
1. triggers are grouped by the bytes that follow them, as many as the right part of any string has at least; such a group
   is a range of the parse's suffix order. A trigger alone in its group owns no repeated string;
2. if all phrases of a group are equal, each string of each of them is repeated, and order has no more to tell;
3. else equal phrases are repeated as a whole, and the distinct ones are ordered, one copy of each: `combined` sorts what
   follows the triggers (suffix array of the parse, with the common prefix of neighbours) and what stands before them,
   backwards (suffix array of the dictionary's heads, likewise). The strings that start o bytes before their triggers are
   equal where neither array has a neighbour pair in between that shares too little: less than o bytes on the left, or
   less than the string's rest on the right;
4. a group of more than GROUP distinct phrases is no task's work. Its strings are taken in bands of WIDE * BAND neighbouring
   starts, and bands are treated as phrases were: grouped by the bytes common to their strings, those of which another has
   the same bytes as a whole are repeated, and of the others one of each kind is ordered. Only a group of more than GROUP
   kinds is taken in bands of BAND starts, one of each kind; and one that is still too large has its few strings counted by
   fingerprint.
Only triggers, one copy of the phrases of 3, and the strings of 4 are shuffled, never all positions. Groups, phrases and the
strings of 4 are told apart by 64-bit polynomial hashes, the latter two within a group; strings in 3 by their bytes.

Cases: null text counts as empty; texts shorter than LENGTH keep everything; a text of any length is parsed in windows of
CHUNK bytes that overlap; rows alike in doc_id and text are copies of each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, drop, free_name, same_row, sliced, with_key, zipped

LENGTH = 400
#: The shorter repeats that dedup also counts: nearly every passage of over 50 words has that many bytes.
SHORT = 240
GRAM = 16
GAP = 128
#: Bytes hashed at a time.
CHUNK = 1 << 20
#: Distinct phrases of a group that one task orders, and how many it orders at a time, groups of them together.
GROUP = 1024
TOGETHER = 4096
BAND = 8
#: How many of them are taken together first.
WIDE = 4
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long, kept string"
#: Low bits of a gram's key that hold its place: more than any buffer needs, and as many for each, so that a string's
#: trigger is the same in any buffer.
_PLACE_BITS = np.uint64(23)

_rng = np.random.default_rng(20240607)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_BACK = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of any substrings of a buffer: prefix sums of value * BASE**place modulo 2**64."""

    _powers = _backs = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Hasher._powers) < n:
            m = max(n, 2 * CHUNK)
            for name, base in (("_powers", _BASE), ("_backs", _BACK)):
                steps = np.full(m, base, np.uint64)
                steps[0] = 1
                setattr(Hasher, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_VALUE[data] * Hasher._powers[: n - 1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * Hasher._backs[start]

    def runs(self, length: int) -> np.ndarray:
        """Of every substring of this length."""
        return (self.sums[length:] - self.sums[:-length]) * Hasher._backs[: len(self.sums) - length]


def triggers(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gap: int = GAP, hasher: Hasher | None = None, limits: np.ndarray | None = None):
    """Of a buffer of texts that end at `ends`: (text, place, first and last string start) of each trigger. limits: how many
    places of each text may be starts."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    if n < length or not (ends - starts >= length).any():
        return empty, empty, empty, empty
    if n >> int(_PLACE_BITS):
        raise ValueError("a buffer must be shorter than 8 MB")
    hasher = hasher or Hasher(data)
    keys = _mix(hasher.runs(GRAM))
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    keys &= ~low
    keys |= low - np.arange(len(keys), dtype=np.uint64)
    # the least of every run of `gap`: blockwise minima from the left and from the right
    blocks = -(-len(keys) // gap)
    padded = np.full(blocks * gap, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, gap)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    least = np.minimum(right[:m], left[gap - 1 : gap - 1 + m])
    owner = (low - (least & low)).astype(np.int64)
    last = ends - length
    if limits is not None:
        last = np.minimum(last, starts + limits - 1)
    text_of = np.repeat(np.arange(len(ends)), ends - starts)[:m]
    ok = np.flatnonzero(np.arange(m) <= last[text_of])
    if not len(ok):
        return empty, empty, empty, empty
    own = owner[ok]
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (ok[1:] != ok[:-1] + 1))))
    final = np.concatenate((new[1:], [len(ok)])) - 1
    return text_of[ok[new]], own[new], ok[new], ok[final]


def _chunks(batches, overlap: int, chunk: int):
    """Buffers of about `chunk` bytes: lists of (doc_id, text_hash, where it begins in its text, bytes, places that may be
    starts). A longer text comes in windows, each with the `overlap` bytes after it."""
    rows, size = [], 0
    for batch in batches:
        for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
            data = (text or "").encode()
            for a in range(0, max(len(data), 1), chunk):
                rows.append((doc_id, text_hash, a, data[a : a + chunk + overlap], chunk))
                size += len(rows[-1][3])
                if size >= chunk:
                    yield rows
                    rows, size = [], 0
    if rows:
        yield rows


def _joined(texts: list[bytes]):
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(x) for x in texts])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def parse(keyed: DataFrame, lengths: tuple[int, ...], gap: int, chunk: int = CHUNK) -> DataFrame:
    """The parse: a row for each trigger that owns strings of the least length. spot holds the first string's start, and
    how far from it the trigger and the last string's start are, in one number, as millions of these rows travel."""
    short, long = min(lengths), max(lengths)

    def run(batches):
        for rows in _chunks(batches, long + gap + GRAM, chunk):
            data, ends = _joined([r[3] for r in rows])
            hasher = Hasher(data)
            text, at, first, last = triggers(data, ends, short, gap, hasher, np.array([r[4] for r in rows]))
            if not len(text):
                continue
            end = np.minimum(last + long, ends[text])
            phrase = hasher(first, end)
            phrase = _mix(phrase ^ _mix((((end - first) << 32) | ((at - first) << 16) | (last - first)).astype(np.uint64)))
            begin = np.concatenate(([0], ends[:-1]))[text] - np.array([r[2] for r in rows])[text]
            ids, hashes = [rows[i][0] for i in text], [rows[i][1] for i in text]
            spot = (first - begin) << 32 | (at - first) << 16 | (last - first)
            yield {"k": signed(_mix(hasher(at, at + short - gap + 1))), "phrase": signed(phrase), "doc_id": ids, "text_hash": hashes, "spot": spot}

    return arrow_map(keyed, run, "k long, phrase long, doc_id long, text_hash long, spot long")


def _gone_along(order: list[int], rows: list[bytes], groups: np.ndarray) -> np.ndarray:
    """For neighbours in the order, how many leading bytes they share; -1 across groups."""
    size = np.array([len(rows[i]) for i in order])
    width = int(size.max(initial=1)) or 1
    table = np.frombuffer(b"".join(rows[i].ljust(width, b"\0") for i in order), np.uint8).reshape(len(order), width)
    differ = table[1:] != table[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared = np.minimum(shared, np.minimum(size[1:], size[:-1]))
    shared[groups[order][1:] != groups[order][:-1]] = -1
    return shared


def combined(groups: np.ndarray, heads: list[bytes], tails: list[bytes], least: np.ndarray, length: int) -> np.ndarray:
    """(phrase, o): whether the string that starts o bytes before the phrase's trigger also starts elsewhere in its group.

    heads and tails: the bytes before and from the trigger; a phrase's strings start least to len(head) bytes before it.
    """
    n = len(heads)
    most = np.array([len(h) for h in heads])
    sizes = np.array([len(t) for t in tails])
    back = [h[::-1] for h in heads]
    # the two suffix arrays with the common prefixes of neighbours
    by_tail = sorted(range(n), key=lambda i: (groups[i], tails[i]))
    by_head = sorted(range(n), key=lambda i: (groups[i], back[i]))
    after, before = _gone_along(by_tail, tails, groups), _gone_along(by_head, back, groups)
    found = np.zeros((n, int(most.max(initial=0)) + 1), bool)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(found.shape[1]):
        at = np.flatnonzero((least <= o) & (o <= most) & (length - o <= sizes))
        if len(at) < 2:
            continue
        left[by_head] = np.concatenate(([0], np.cumsum(before < o)))
        right[by_tail] = np.concatenate(([0], np.cumsum(after < length - o)))
        _, same, count = np.unique(left[at] * n + right[at], return_inverse=True, return_counts=True)
        found[at[count[same] > 1], o] = True
    return found


def ordered(phrases: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """The runs of repeated strings of phrases (k, doc_id, text_hash, first, ahead, last, single, bytes, which) of groups of
    bounded size: doc_id, text_hash, run. Phrases with copies only meet others here. which: the length asked for, or EVERY."""
    dealt = phrases.repartition("k").sortWithinPartitions("k")

    def run(batches):
        held = []
        for batch in batches:
            held += batch.to_pylist()
            if len(held) >= TOGETHER:
                done = len(held)
                while done and held[done - 1]["k"] == held[-1]["k"]:
                    done -= 1
                yield told(held[:done])
                held = held[done:]
        yield told(held)

    def told(rows):
        out = {c: [] for c in ("doc_id", "text_hash", "run")}
        for which, length in enumerate(lengths):
            some = [r for r in rows if r["which"] in (which, EVERY)]
            if not some:
                continue
            groups = np.array([r["k"] for r in some])
            heads, tails = [r["bytes"][: r["ahead"]] for r in some], [r["bytes"][r["ahead"] :] for r in some]
            least = np.array([r["ahead"] - r["last"] for r in some])
            for r, row in zip(some, combined(groups, heads, tails, least, length), strict=True):
                if r["single"] and row.any():
                    runs = _runs(np.sort(r["first"] + r["ahead"] - np.flatnonzero(row)), which)
                    for c, v in zip(out, ([r["doc_id"]] * len(runs), [r["text_hash"]] * len(runs), runs), strict=True):
                        out[c] += v
        return out

    return arrow_map(dealt, run, FOUND)


FOUND = "doc_id long, text_hash long, run long"
#: In a run: all lengths.
EVERY = 15


def run_of(first, last, which):
    """A run of string starts, and the place of their length in the lengths asked for, as one number."""
    return first * (1 << 20) + (last - first) * (1 << 4) + which


def _runs(starts: np.ndarray, which: int) -> list[int]:
    """Sorted starts as runs of neighbours."""
    new = np.flatnonzero(np.diff(starts) != 1) + 1
    first, last = starts[np.concatenate(([0], new))], starts[np.concatenate((new - 1, [len(starts) - 1]))]
    return run_of(first.astype(np.int64), last, which).tolist()


def _bands_of(r: dict, lengths, band: int):
    """(which length, band, nearest and farthest start in it, counted from the trigger backwards) of a phrase."""
    for which, length in enumerate(lengths):
        near, far = max(r["ahead"] - r["last"], length - (len(r["bytes"]) - r["ahead"])), r["ahead"]
        for j in range(near // band, far // band + 1):
            a, z = max(near, j * band), min(far, j * band + band - 1)
            if a <= z:
                yield which, j, a, z


def banded(phrases: DataFrame, lengths: tuple[int, ...], band: int, wide: int | None = None) -> DataFrame:
    """k, phrase, which, band, core (of the bytes common to the band's strings), full (of all their bytes), run. With wide, a
    multiple of band, only of the parts of those bands of that width that `todo` names."""
    names = ("k", "phrase", "which", "band", "core", "full", "run")

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                hasher = Hasher(np.frombuffer(r["bytes"], np.uint8))
                found = list(_bands_of(r, lengths, band))
                if wide:
                    asked = {(t["which"], t["band"]) for t in r["todo"]}
                    found = [x for x in found if (x[0], x[1] * band // wide) in asked]
                which, j, a, z = np.array(found, np.int64).reshape(-1, 4).T
                at, size = r["ahead"], np.array(lengths)[which]
                mark = _mix((j << 8 | which).astype(np.uint64))
                core = _mix(hasher(at - j * band, at + size - (j * band + band - 1)) ^ mark)
                full = _mix(hasher(at - z, at + size - a) ^ mark ^ _mix((a << 20 | z).astype(np.uint64)))
                start = r["first"] + at
                rows += zip([r["k"]] * len(j), [r["phrase"]] * len(j), which.tolist(), j.tolist(), signed(core).tolist(), signed(full).tolist(), run_of(start - z, start - a, which).tolist(), strict=True)
            yield {c: [r[i] for r in rows] for i, c in enumerate(names)}

    return arrow_map(phrases, run, "k long, phrase long, which int, band int, core long, full long, run long")


def _asked(r: dict, lengths, band: int):
    """Those of a phrase's bands that its todo names, with that entry."""
    asked = {(t["which"], t["band"]): t for t in r["todo"]}
    for which, j, a, z in _bands_of(r, lengths, band):
        if (which, j) in asked:
            yield asked[which, j], a, z


def band_bytes(phrases: DataFrame, lengths: tuple[int, ...], band: int) -> DataFrame:
    """The bands in `todo` of phrases as phrases of their own, for `ordered`."""

    def run(batches):
        for batch in batches:
            out = {c.split()[0]: [] for c in PHRASE.split(", ")}
            for r in batch.to_pylist():
                for t, a, z in _asked(r, lengths, band):
                    at = r["ahead"]
                    row = (t["core"], r["doc_id"], r["text_hash"], r["first"] + at - z, z, z - a, t["single"], r["bytes"][at - z : at + lengths[t["which"]] - a], t["which"])
                    for c, v in zip(out, row, strict=True):
                        out[c].append(v)
            yield out

    return arrow_map(phrases, run, PHRASE)


def printed(phrases: DataFrame, lengths: tuple[int, ...], band: int) -> DataFrame:
    """group, w (fingerprint), phrase, run of each string of the bands in `todo` of phrases."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                hasher = Hasher(np.frombuffer(r["bytes"], np.uint8))
                for t, a, z in _asked(r, lengths, band):
                    o = np.arange(a, z + 1)
                    s = r["ahead"] - o
                    w = _mix(hasher(s, s + lengths[t["which"]]) ^ _mix((o << 16 | t["which"]).astype(np.uint64)))
                    start = r["first"] + s
                    # half of the group's number is enough beside a fingerprint of 64 bits
                    rows += zip([r["k"] >> 32] * len(o), signed(w).tolist(), [r["phrase"]] * len(o), run_of(start, start, t["which"]).tolist(), strict=True)
            yield {c: [r[i] for r in rows] for i, c in enumerate(("group", "w", "phrase", "run"))}

    return arrow_map(phrases, run, "group int, w long, phrase long, run long")


PHRASE = "k long, doc_id long, text_hash long, first int, ahead int, last int, single boolean, bytes binary, which int"


def phrase_bytes(packed: DataFrame, long: int) -> DataFrame:
    """The dictionary: the bytes of each phrase that is to be ordered. packed has ztext and todo."""
    names = ("k", "doc_id", "text_hash", "first", "ahead", "last", "single", "hot", "bytes")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {c: [] for c in names}
            for doc_id, text_hash, z, todo in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "ztext", "todo")), strict=True):
                data = unpack.decompress(z)
                for t in todo:
                    a = t["first"]
                    row = (t["k"], doc_id, text_hash, a, t["place"] - a, t["last"] - a, t["single"], t["hot"], data[a : t["last"] + long])
                    for c, v in zip(names, row, strict=True):
                        out[c].append(v)
                    if len(out["k"]) >= TOGETHER:
                        yield out
                        out = {c: [] for c in names}
            yield out

    return arrow_map(packed, run, "k long, doc_id long, text_hash long, first int, ahead int, last int, single boolean, hot boolean, bytes binary")


def spans_of(runs: np.ndarray, which: int, length: int, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated strings of this length cover; no string reaches over n_bytes."""
    first, last, of = runs >> 20, (runs >> 20) + (runs >> 4 & 0xFFFF), runs & 15
    keep = ((of == EVERY) | (of == which)) & (first <= n_bytes - length)
    first, end = first[keep], np.minimum(last[keep], n_bytes - length) + length
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(first[1:] > end[:-1]) + 1
    return list(zip(first[np.concatenate(([0], new))].tolist(), end[np.concatenate((new - 1, [len(end) - 1]))].tolist(), strict=True))


def _each_runs(column) -> list[np.ndarray]:
    """The runs of each row of an Arrow list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum([x or 0 for x in column.value_lengths().to_pylist()])
    return np.split(flat, ends[:-1]) if len(ends) else []


def repeated_starts(docs: DataFrame, lengths: tuple[int, ...] = (LENGTH,), gap: int = GAP, group: int = GROUP, chunk: int = CHUNK, band: int = BAND) -> DataFrame:
    """doc_id, text_hash, runs: where repeated strings start (see run_of) in each document that has any."""
    if not GRAM <= gap <= min(lengths) - GRAM:
        raise ValueError("gap must be at least GRAM and leave GRAM bytes of a string")
    if gap > 1 << 15:
        raise ValueError("gap must be at most 32768")
    keyed = with_key(docs)
    found = parse(keyed, lengths, gap, chunk)
    groups = found.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("phrase").alias("low"), F.max("phrase").alias("high")).where("n > 1").select("k", (F.col("low") != F.col("high")).alias("mixed"))
    first = F.shiftright("spot", 32)
    place, last = (first + F.shiftright("spot", 16).bitwiseAND(0xFFFF)), (first + F.col("spot").bitwiseAND(0xFFFF))
    held = _dealt(found, groups, "k").select("k", "phrase", "doc_id", "text_hash", place.cast("int").alias("place"), first.cast("int").alias("first"), last.cast("int").alias("last"), "mixed")
    held = cut(held, "held")
    mixed = held.where("mixed").drop("mixed")
    # a copy of each distinct phrase of a mixed group, and how many there are
    counted = cut(mixed.groupBy("k", "phrase").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "first")).alias("one")), "phrases")
    crowds = counted.groupBy("k").count().where(F.col("count") > group).select("k", F.lit(True).alias("hot"))
    odd = F.bitwise_not("k")
    phrases = counted.withColumn("_k", odd).join(crowds.select(odd.alias("_k"), "hot"), "_k", "left").select("k", "phrase", "n", "one", F.coalesce("hot", F.lit(False)).alias("hot"))
    told = _dealt(mixed, phrases, "k", "phrase").select("k", "doc_id", "text_hash", "place", "first", "last", (F.col("n") > 1).alias("whole"), "hot", (F.struct("doc_id", "text_hash", "first").eqNullSafe(F.col("one"))).alias("take"))
    told = cut(told, "told")
    todo = told.where("take").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("k", "place", "first", "last", (~F.col("whole")).alias("single"), "hot")).alias("todo"))
    dictionary = cut(phrase_bytes(_joined_to(zipped(keyed), todo, "inner"), max(lengths)), "dictionary")
    parts = [held.where("not mixed"), told.where("whole")]
    parts = [p.select("doc_id", "text_hash", run_of(F.col("first").cast("long"), F.col("last").cast("long"), EVERY).alias("run")) for p in parts]
    parts.append(ordered(dictionary.where("not hot").drop("hot").withColumn("which", F.lit(EVERY)), lengths))
    crowded = dictionary.where("hot").drop("hot")
    if crowded.head(1):
        parts += _of_bands(crowded, lengths, band, group)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    out = cut(every.groupBy("doc_id", "text_hash").agg(F.collect_set("run").alias("runs")), "runs")
    drop(held, counted, told, dictionary)
    return out


def _of_bands(crowded: DataFrame, lengths: tuple[int, ...], band: int, group: int) -> list[DataFrame]:
    """The runs of repeated strings of phrases of groups of any size."""
    # the phrase's number is stored with it
    crowded = cut(crowded.withColumn("phrase", F.monotonically_increasing_id()), "crowded")
    parts, rows, wide = [], crowded, None
    for width in (WIDE * band, band) if WIDE * band < min(lengths) else (band,):
        bands = cut(banded(rows, lengths, width, wide), "bands")
        kinds = cut(bands.groupBy("k", "core", "full").agg(F.count(F.lit(1)).alias("n"), F.min("phrase").alias("one")), "kinds")
        # of the groups, those of one band alone go; the number of kinds tells who orders the others
        cores = kinds.groupBy("k", "core").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")).where(F.col("all") > 1).select("k", "core", "kinds")
        met = cut(_dealt(bands, _dealt(kinds, cores, "k", "core"), "k", "core", "full").where((F.col("n") > 1) | (F.col("kinds") > 1)).select("phrase", "which", "band", "core", "run", "n", "kinds", (F.col("phrase") == F.col("one")).alias("take")), "met")
        drop(bands, kinds)
        todo = met.where("take and kinds > 1").select("phrase", (F.col("kinds") > group).alias("many"), F.struct("which", "band", "core", (F.col("n") == 1).alias("single")).alias("t"))
        few, many = (crowded.join(todo.where(x).groupBy("phrase").agg(F.collect_list("t").alias("todo")), "phrase") for x in ("not many", "many"))
        parts += [_at(crowded, met.where("n > 1").select("phrase", "run")), ordered(band_bytes(few, lengths, width), lengths)]
        rows, wide = cut(many, "many"), width
        if not rows.head(1):
            return parts
    each = cut(printed(rows, lengths, width), "strings")
    twice = each.groupBy("group", "w").count().where("count > 1").select("group", "w")
    return [*parts, _at(crowded, _dealt(each, twice, "group", "w").select("phrase", "run"))]


def _at(phrases: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text_hash, run of (phrase, run)."""
    return phrases.select("phrase", "doc_id", "text_hash").join(found, "phrase").select("doc_id", "text_hash", "run")


def _dealt(rows: DataFrame, sums: DataFrame, *key: str) -> DataFrame:
    """rows joined with sums by key. Both are dealt out by the keys' complements: an aggregation by the keys themselves
    would be joined where its rows lie, and then Spark could not split a key that many rows have."""
    odd = [F.bitwise_not(k).alias(f"_{k}") for k in key]
    left = rows.select(*odd, *(c for c in rows.columns if c not in key))
    right = sums.select(*odd, *(c for c in sums.columns if c not in key))
    joined = left.join(right, [f"_{k}" for k in key])
    return joined.select(*(F.bitwise_not(f"_{k}").alias(k) for k in key), *(c for c in joined.columns if c not in {f"_{k}" for k in key}))


def _joined_to(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    column = lists.columns[-1]
    return texts.join(lists, same_row(texts, lists), how).select(texts["doc_id"], texts["text_hash"], "ztext", column)


def dedup(docs: DataFrame, length: int = LENGTH, gap: int = GAP, with_text: bool = True, short: int | None = SHORT, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated (bytes that strings of `short` bytes cover which also
    start elsewhere; null without short) and, with_text, kept: the text left (broken UTF-8 is replaced)."""
    lengths = (length,) if short is None else (length, short)
    joined = _joined_to(zipped(with_key(docs)), repeated_starts(docs, lengths, gap, **sizes), "left")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {c.split()[0]: [] for c in RESULT.split(", ")}
            for doc_id, z, r in zip(batch.column("doc_id").to_pylist(), batch.column("ztext").to_pylist(), _each_runs(batch.column("runs")), strict=True):
                data = unpack.decompress(z)
                cuts = spans_of(r, 0, length, len(data))
                left = _without(data, cuts)
                covered = None if short is None else sum(b - a for a, b in spans_of(r, 1, short, len(data)))
                row = (doc_id, len(data), len(data) - len(left), len(cuts), hashlib.sha256(left).hexdigest(), covered, left.decode(errors="replace") if with_text else None)
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
            yield out

    return arrow_map(joined, run, RESULT)


def _without(data: bytes, cuts) -> bytes:
    parts, at = [], 0
    for a, b in cuts:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def whole_characters(data: bytes, cuts) -> list[tuple[int, int]]:
    """The cuts without characters of which a part would stay."""
    inside = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    out = []
    for a, b in cuts:
        while inside(a):
            a += 1
        while inside(b):
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def rewritten(docs: DataFrame, length: int = LENGTH, gap: int = GAP) -> DataFrame:
    """docs with text, and n_chars if there is one, without what dedup removes; other columns and rows stay. A character of
    which a cut would leave a part stays whole. A null text stays null."""
    runs = repeated_starts(docs, (length,), gap)
    schema = docs.schema
    hashed, column = free_name(docs, "_hash"), free_name(docs, "_runs")
    keyed = docs.withColumn(hashed, F.xxhash64("text"))
    runs = runs.withColumnRenamed("runs", column)
    joined = keyed.join(runs, keyed["doc_id"].eqNullSafe(runs["doc_id"]) & (keyed[hashed] == runs["text_hash"]), "left")
    joined = joined.select(*(keyed[c] for c in docs.columns), column)

    def run(batches):
        for batch in sliced(batches):
            texts, sizes = [], []
            for text, r in zip(batch.column("text").to_pylist(), _each_runs(batch.column(column)), strict=True):
                if len(r):
                    data = text.encode()
                    text = _without(data, whole_characters(data, spans_of(r, 0, length, len(data)))).decode()
                texts.append(text)
                sizes.append(None if text is None else len(text))
            new = {"text": pa.array(texts, pa.string())}
            if "n_chars" in schema.names:
                new["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in schema.names], names=schema.names)

    return joined.mapInArrow(run, schema)
