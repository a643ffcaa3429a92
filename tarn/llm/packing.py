"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Only lengths matter to a packing, so a chromosome is a list of bins and a bin a tuple of piece lengths; pieces of one
length stand for each other. A child takes whole well-filled bins from one parent (crossover), keeps those bins of the
other parent whose pieces are still there (which removes duplicates). The pieces that this displaces first fill bins to the
brim, as they are or in exchange for a piece of the bin (`exchange`); of the rest, each longest piece opens a bin that gets
the best fitting set of others (`fill`). A mutant is a parent whose worst bins, and a few others, are taken apart. Plain best
fit is the first ancestor. A packing with as many bins as the sum of lengths needs ends the search; on the given documents
best fit is mostly one bin above that in an island, and the search finds that bin.

Islands: every task evolves its own pieces, ISLAND of them at a time. After an epoch, full sequences are settled;
the pieces of the others, far fewer, move to islands drawn anew and GROWTH times as large, and the commonest well-filled bins of all islands (the elite, at
most ELITE length patterns) move with them and are injected into the first generation there. An island's memory is
bounded by ISLAND and GROWTH, the broadcast by ELITE.

Cases: null text counts as empty and still holds the end id; an empty table gives no rows; rows with an equal doc_id
are packed each for itself; other columns are ignored.
"""

from __future__ import annotations

import bisect
import random
import zlib
from array import array
from collections import Counter

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut

CAPACITY = 1024
END_ID = 2
ISLAND = 8192
GROWTH = 4
ELITE = 256
EPOCHS = 3
POPULATION = 6
GENERATIONS = 24
#: Lengths that a search for a pair looks at, and those of the longest and of the others from which a bin's set is chosen.
PAIRS = 64
LONGEST, OTHERS = 12, 28
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", sequence_id long, offset long, fill long, pattern string"


class Encoder:
    """Ids of byte-level BPE. The rank file holds the vocabulary of the JSON file; a test holds both libraries' ids equal."""

    def __init__(self, vocabulary: str | None = None):
        import base64

        import public_tokenizers
        import tiktoken

        path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.special = "<|endoftext|>"
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={self.special: len(ranks)})

    def __call__(self, text: str) -> list[int]:
        if self.special in text:
            return self.bpe.encode(text, allowed_special="all", disallowed_special=())
        return self.bpe.encode_ordinary(text)


def pieces(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(bins: list[list[int]], sizes: list[int], capacity: int) -> None:
    """Put sizes, longest first, each where it leaves the least room. A bit per free length finds that bin."""
    free: dict[int, list[int]] = {}
    mask = 0
    for i, b in enumerate(bins):
        if r := capacity - sum(b):
            free.setdefault(r, []).append(i)
            mask |= 1 << r
    for s in sorted(sizes, reverse=True):
        if m := mask >> s:
            r = s + (m & -m).bit_length() - 1
            at = free[r]
            i = at.pop()
            if not at:
                mask ^= 1 << r
            bins[i].append(s)
            left = r - s
        else:
            i, left = len(bins), capacity - s
            bins.append([s])
        if left:
            free.setdefault(left, []).append(i)
            mask |= 1 << left


def _pair(left: dict[int, int], total: int) -> tuple[int, ...]:
    """One or two pieces of left, as lengths, that make up total; () if none is found."""
    if left.get(total, 0) > 0:
        return (total,)
    for k, (a, n) in enumerate(left.items()):
        if k == PAIRS:
            break
        if 0 < n and 0 < a < total and left.get(total - a, 0) > (a == total - a):
            return a, total - a
    return ()


def exchange(bins: list[list[int]], left: dict[int, int], capacity: int) -> None:
    """Fill bins to the brim with one or two pieces of left, or with such in exchange for one of the bin's pieces."""
    for b in bins:
        room = capacity - sum(b)
        if not room:
            continue
        for out in (0, *sorted(set(b))):
            if found := _pair(left, room + out):
                if len(found) == 1 and found[0] == out:
                    continue
                for s in found:
                    left[s] -= 1
                    if not left[s]:
                        del left[s]
                if out:
                    b.remove(out)
                    left[out] = left.get(out, 0) + 1
                b += found
                break


def fill(bins: list[list[int]], left: dict[int, int], capacity: int, rng: random.Random) -> None:
    """New bins for all of left: each begins with the longest piece and gets, of a choice of the others, the set that comes
    nearest to capacity. Sums are bits of a number; longer pieces are taken first, as short ones fit later too."""
    sizes = sorted(left)
    while sizes:
        b = [sizes[-1]]
        left[b[0]] -= 1
        if not left[b[0]]:
            sizes.pop()
        room = capacity - b[0]
        fit = bisect.bisect_right(sizes, room)
        if fit <= LONGEST + OTHERS:
            pool = sizes[:fit][::-1]
        else:
            pool = sizes[fit - LONGEST : fit][::-1] + sorted((sizes[i] for i in rng.sample(range(fit - LONGEST), OTHERS)), reverse=True)
        pool = [s for s in pool for _ in range(min(left[s], 2))]
        mask, sums = (1 << room + 1) - 1, [1]
        for s in pool:
            sums.append((sums[-1] | sums[-1] << s) & mask)
            if sums[-1] >> room & 1:
                break
        total = sums[-1].bit_length() - 1
        for k in range(len(sums) - 1, 0, -1):
            if not sums[k - 1] >> total & 1:
                s = pool[k - 1]
                b.append(s)
                total -= s
                left[s] -= 1
                if not left[s]:
                    del sizes[bisect.bisect_left(sizes, s)]
        bins.append(b)


def child_of(injected, kept, counts: Counter, capacity: int, rng: random.Random | None = None) -> list[list[int]]:
    """Injected bins first, then those of the other parent, as far as their pieces are left; then what this displaced, which
    is best-fitted where there is no rng."""
    left = dict(counts)
    bins = []
    for group in (injected, kept):
        for b in group:
            ok = True
            for j, s in enumerate(b):
                if left.get(s, 0) <= 0:
                    for t in b[:j]:
                        left[t] += 1
                    ok = False
                    break
                left[s] -= 1
            if ok:
                bins.append(list(b))
    left = {s: n for s, n in sorted(left.items(), reverse=True) if n}
    if rng is None:
        best_fit(bins, [s for s, n in left.items() for _ in range(n)], capacity)
    else:
        exchange(bins, left, capacity)
        fill(bins, left, capacity, rng)
    return bins


def fitness(bins, capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among as many, those that gather the free room in few bins."""
    return -len(bins), sum((sum(b) / capacity) ** 2 for b in bins)


def evolve(sizes: list[int], elite=(), seed: int = 0, capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS) -> list[list[int]]:
    """The best packing found; stops when it has as few bins as the sum of lengths allows."""
    if not sizes:
        return []
    rng = random.Random(seed)
    counts = Counter(sizes)
    least = -(-sum(sizes) // capacity)
    first = child_of((), (), counts, capacity)
    if len(first) <= least:
        return first
    people = [(fitness(first, capacity), first)]

    def born(injected, kept):
        child = child_of(injected, kept, counts, capacity, rng)
        people.append((fitness(child, capacity), child))

    born(elite, ())
    for generation in range(generations):
        people.sort(key=lambda p: p[0], reverse=True)
        del people[population:]
        best = people[0][1]
        if len(best) <= least:
            break
        a = best if generation % 2 == 0 else rng.choice(people)[1]
        b = rng.choice(people)[1]
        # the bins that are full, or the fullest: some of one parent go into the other, whose worst come apart
        order = sorted(b, key=sum)
        worst = max(2, len(order) // rng.choice((10, 20, 40)))
        gone = set(rng.sample(range(len(order)), k=min(len(order), worst))) | set(range(worst))
        kept = [x for i, x in enumerate(order) if i not in gone]
        rng.shuffle(kept)
        if a is b:
            born((), kept)
        else:
            good = [x for x in a if sum(x) >= capacity - 1]
            born(rng.sample(good, k=(len(good) + 1) // 2), kept)
    return max(people, key=lambda p: p[0])[1]


def place(rows: dict[str, list], elite, seed: int, first_id: int, capacity: int = CAPACITY) -> dict[str, list]:
    """rows of one island with sequence_id, offset, fill and pattern."""
    by_size: dict[int, list[int]] = {}
    for i, n in enumerate(rows["length"]):
        by_size.setdefault(n, []).append(i)
    alone = by_size.pop(capacity, [])
    packed = evolve([n for n, at in by_size.items() for _ in at], elite, seed, capacity)
    size = len(rows["length"])
    out = dict(rows) | {"sequence_id": [0] * size, "offset": [0] * size, "fill": [capacity] * size, "pattern": [None] * size}
    for k, i in enumerate(alone):
        out["sequence_id"][i] = first_id + k
    for k, b in enumerate(packed, len(alone)):
        at, total, b = 0, sum(b), sorted(b, reverse=True)
        pattern = ",".join(map(str, b)) if len(b) > 1 else None
        for s in b:
            i = by_size[s].pop()
            out["sequence_id"][i], out["offset"][i], out["fill"][i] = first_id + k, at, total
            if at == 0:
                out["pattern"][i] = pattern
            at += s
    return out


def _id_base(epoch: int) -> int:
    return (epoch << 58) | (TaskContext.get().partitionId() << 34)


def _islands(batches_of_rows, elite, epoch: int, island: int, capacity: int):
    base, used, n, kept = _id_base(epoch), 0, 0, None
    for rows in batches_of_rows:
        kept = rows if kept is None else {k: kept[k] + rows[k] for k in kept}
        while len(kept["length"]) >= island:
            now, kept = {k: v[:island] for k, v in kept.items()}, {k: v[island:] for k, v in kept.items()}
            yield place(now, elite, base + n, base + used, capacity)
            used, n = used + island, n + 1
    if kept and kept["length"]:
        yield place(kept, elite, base + n, base + used, capacity)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, island: int = ISLAND, epochs: int = EPOCHS) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""

    def tokenised(batches):
        encode = Encoder(vocabulary)
        for batch in batches:
            rows = {c.split()[0]: [] for c in PIECE.split(", ")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = array("I", encode(text or ""))
                ids.append(END_ID)
                for k, (s, n) in enumerate(pieces(len(ids), capacity)):
                    for c, v in zip(rows, (doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())), strict=True):
                        rows[c].append(v)
            yield rows

    def first(batches):
        yield from _islands(tokenised(batches), (), 0, island, capacity)

    names = [c.split()[0] for c in PIECE.split(", ")]
    done, now = [], cut(arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), first, PLACED), "pack")
    for epoch in range(1, epochs):
        full = F.col("fill") == capacity
        done.append(now.where(full))
        open_ = now.where(~full).select(*names)
        n = open_.count()
        if not n:
            break
        # the elite: at most ELITE patterns of full sequences, by how many islands' sequences use them
        elite = [tuple(map(int, r.pattern.split(","))) for r in now.where(full & F.col("pattern").isNotNull()).groupBy("pattern").count().orderBy(F.desc("count"), "pattern").limit(ELITE).collect()]
        elite = [b for b in elite for _ in range(4)]

        size = island * GROWTH**epoch

        def again(batches, epoch=epoch, elite=elite, size=size):
            yield from _islands(({c: b.column(c).to_pylist() for c in names} for b in batches), elite, epoch, size, capacity)

        now = cut(arrow_map(open_.repartition(-(-n // size)), again, PLACED), "pack")
    done.append(now)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select(*names, "sequence_id", "offset")
