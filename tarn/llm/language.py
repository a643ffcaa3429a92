"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

Subwords are the GRAMS-byte sequences of a lower-cased text, each run of white space one space; each is hashed to one of
BUCKETS embeddings. A text is the mean of its embeddings; a linear layer and softmax give languages. In prediction,
embedding and layer are one table of logits by bucket, so that a whole text of any length is a sum of table rows.

Training: at most SAMPLE labelled rows a language (in expectation, by a hash of the row; never more than twice that in
all, the least hashes first), and of a text longer than SAMPLE_CHARS as many characters from a place that the hash gives; the
sample is the only thing collected. At most LANGUAGES labels are learned, the commonest. One more class, `und`, is learned
from SAMPLE bags of buckets drawn at random, which is what the subwords of an unrelated language look like; so a text can
be far from all languages even where there is one. A tenth of the sample is held back to set the softmax temperature and the
threshold below which a prediction is rejected: the confidence that all but REJECTED of the right predictions reach (the
least of fewer than 1 / REJECTED; of the training rows where none is held back), one half at most.

Cases: a null text, or one without a letter, is `und` with score 0 and rejected; without any labelled row everything is
`und`; null labels are not learned from; a null doc_id counts as not held out; repeated rows are each predicted.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

GRAMS = (3, 4)
BUCKETS = 1 << 15
DIM = 16
SAMPLE = 400
SAMPLE_CHARS = 8000
LANGUAGES = 1000
EPOCHS = 4
#: A smaller sample is passed over more often, so that what is learned of it does not depend on its size.
STEPS = 6000
RATE = 8.0
REJECTED = 0.01
UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
_LETTER = re.compile(r"[^\W\d_]")
_MUL = tuple(np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263))


def held_out(mod: int, rest: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def _bytes(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").lower().encode().split()) + b" "


def grams(data: np.ndarray) -> list[np.ndarray]:
    """Buckets of the sequences of each length of GRAMS that start at each place."""
    wide = data.astype(np.uint32)
    out = []
    for n in GRAMS:
        m = max(len(wide) - n + 1, 0)
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h += wide[k : k + m] * _MUL[k]
            h ^= h >> np.uint32(13)
        out.append(((h * _MUL[0]) >> np.uint32(17)).astype(np.int32))
    return out


class Model:
    def __init__(self, languages, table, bias, temperature=1.0, threshold=0.0):
        self.languages, self.table, self.bias, self.temperature, self.threshold = languages, table, bias, temperature, threshold

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """One pass over the joined texts; a text's sequences do not reach into the next."""
        raw = [_bytes(t) for t in texts]
        size = np.array([len(x) for x in raw])
        starts = np.cumsum(size) - size
        total, count = np.zeros((len(raw), len(self.languages))), np.zeros(len(raw))
        for n, h in zip(GRAMS, grams(np.frombuffer(b"".join(raw), np.uint8)), strict=True):
            ends = np.maximum(starts + size - n + 1, starts)
            for k, column in enumerate(self.table.T):
                sums = np.concatenate(([0.0], np.cumsum(column[h], dtype=np.float64)))
                ends_, starts_ = np.minimum(ends, len(h)), np.minimum(starts, len(h))
                total[:, k] += sums[ends_] - sums[starts_]
            count += ends - starts
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = _softmax(self.logits(texts) / self.temperature)
        p = np.where([x == UNKNOWN for x in self.languages], -1.0, p)
        best = p.argmax(axis=1)
        known = np.array([bool(t and _LETTER.search(t)) for t in texts])
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, p.max(axis=1), 0.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, str]], seed: int = 0) -> Model:
    """rows: (text, language)."""
    languages = sorted({lang for _, lang in rows} - {UNKNOWN})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    languages.append(UNKNOWN)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    examples = []
    for i in order:
        text, lang = rows[i]
        at, n = np.unique(np.concatenate(grams(np.frombuffer(_bytes(text), np.uint8))), return_counts=True)
        if len(at):
            examples.append((at, (n / n.sum()).astype(np.float32), languages.index(lang), text))
    back = examples[: len(examples) // 10]
    train = examples[len(back) :]
    back = [x for x in back or train if languages[x[2]] != UNKNOWN]
    for _, text in (rows[i] for i in rng.integers(0, len(rows), SAMPLE)):
        at, n = np.unique(rng.integers(0, BUCKETS, max(1, sum(map(len, grams(np.frombuffer(_bytes(text), np.uint8)))))), return_counts=True)
        train.append((at, (n / n.sum()).astype(np.float32), len(languages) - 1, None))
    embedding = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    epochs = max(EPOCHS, -(-STEPS // len(train)))
    steps, done = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            at, share, lang, _text = train[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ embedding[at]
            error = _softmax((mean @ layer + bias)[None])[0].astype(np.float32)
            error[lang] -= 1
            down = layer @ error
            layer -= rate * 0.05 * np.outer(mean, error)
            bias -= rate * 0.01 * error
            embedding[at] -= rate * share[:, None] * down
    model = Model(languages, embedding @ layer, bias)
    if back:
        logits = model.logits([x[3] for x in back])
        truth = np.array([x[2] for x in back])
        scales = np.geomspace(0.05, 20, 60)
        model.temperature = float(min(scales, key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()))
        p = _softmax(logits / model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == truth]
        k = max(1, int(REJECTED * (len(right) + 1)))
        model.threshold = float(min([0.5, *np.sort(right)[k - 1 : k]]))
    return model


def sample(docs: DataFrame, per_language: int = SAMPLE, chars: int = SAMPLE_CHARS, languages: int = LANGUAGES) -> list[tuple[str, str]]:
    """(text, label) pairs to learn from; the same ones whatever the order in which tasks end."""
    rows = docs.where(~held_out(4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    wanted = F.lit(False)
    for lang, n in counts.items():
        wanted = wanted | ((F.col("lang") == lang) & (draw < int(min(1.0, per_language / n) * (1 << 30))))
    start = F.pmod(draw, F.greatest(F.length("text") - chars + 1, F.lit(1)).cast("long")).cast("int") + 1
    part = F.substring(F.col("text"), start, F.lit(chars)).alias("text")
    got = rows.where(wanted).select(draw.alias("draw"), part, "lang").orderBy("draw", "lang", "text").limit(2 * per_language * len(counts)).collect()
    return sorted((r.text, r.lang) for r in got)


def train(docs: DataFrame, per_language: int = SAMPLE) -> Model:
    """Learns from text and lang of rows whose crc32(doc_id as text) mod 4 is not 2."""
    return fit(sample(docs, per_language))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row."""
    model = model or train(docs)

    def run(batches):
        for batch in batches:
            for a, z in _slices(batch):
                part = batch.slice(a, z - a)
                lang, score = model.predict(part.column("text").to_pylist())
                yield {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": lang, "score": score, "rejected": [x == UNKNOWN or s < model.threshold for x, s in zip(lang, score, strict=True)]}

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(4, 2).alias("held_out")), run, RESULT)


def _slices(batch, most: int = 1 << 20):
    """Row ranges of about `most` characters, so that a batch of long texts is not hashed at once."""
    a = size = 0
    for i, n in enumerate(batch.column("text").to_pylist()):
        size += len(n or "")
        if size >= most:
            yield a, i + 1
            a, size = i + 1, 0
    if a < batch.num_rows:
        yield a, batch.num_rows


def keep_known(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs without those whose language is rejected."""
    import pyarrow as pa

    from .common import sliced

    model = model or train(docs)

    def run(batches):
        for batch in sliced(batches):
            for a, z in _slices(batch):
                part = batch.slice(a, z - a)
                lang, score = model.predict(part.column("text").to_pylist())
                yield part.filter(pa.array([x != UNKNOWN and s >= model.threshold for x, s in zip(lang, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
