"""Toxicity: subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word's features are the byte n-grams of the word between two boundary marks, hashed into buckets, so that misspellings and
inflections that were never seen share vectors with what was. A span's bag is the mean of its features' embeddings, and a softmax
layer over the mean gives its logit. A document is read as overlapping spans of words and takes its highest span's logit, so that
a few words in a very long text count as much as in a short one; the labels are of documents, so training alternates between
choosing each toxic document's spans and fitting the embeddings and the layer. The model is a bounded fit on a bounded sample of
labelled rows; each text is then scored whole, in one pass without a shuffle.
"""

from __future__ import annotations

import warnings
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, fresh, save

GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIM = 16
#: What AdaGrad's sums of squares start from: large enough that n-grams seen once or twice stay near zero.
G0 = 3e-4
#: Words in a span, and from one span to the next.
SPAN, STEP = 16, 8
#: A span with fewer n-grams than this is averaged as if the rest were zero: a few characters are little evidence.
LEAST = 120
#: Labelled rows of each label that training reads, whole.
TRAIN_ROWS = 2000
#: Spans of a training text that a round fits: drawn by chance, and, of clean texts, the worst ones by the model so far. Every round
#: looks at all spans of all training texts to choose them.
DRAWN, WORST = 12, 6
PREDICT_AT = 0.3


def words_of(text: str | None) -> list[bytes]:
    """The words; one that repeats itself directly counts once."""
    words = (text or "").encode("utf-8", "replace").translate(ALNUM_TABLE).split()
    return [w for w, before in zip(words, [None, *words]) if w != before]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, by word; number of n-grams of each word). n-grams reach over no boundary but a word's own two marks.

    A word that repeats itself directly counts once.
    """
    return grams(words_of(text))


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """features() of words."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    buf = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = buf == 32
    seen = np.cumsum(blank)  # marks up to and with a byte
    word_of = seen - 1  # of a byte: the word that it is in; of a mark: the word after it
    marks = np.flatnonzero(blank)
    ids, owner = [], []
    x = buf.astype(np.uint64)
    for n in GRAMS:
        if len(buf) < n:
            continue
        h = np.zeros(len(buf) - n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(1099511628211) + x[k : len(buf) - n + 1 + k] + np.uint64(n)
        # The next mark after the start has to be the last byte or lie beyond it.
        ok = marks[np.minimum(seen[: len(h)], len(marks) - 1)] >= np.arange(n - 1, len(h) + n - 1)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        ids.append(((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32)[ok])
        owner.append(word_of[:-1][: len(h)][ok].astype(np.int32))
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(words)).astype(np.int32)


def spans(n_words: int) -> np.ndarray:
    """First words of the spans; the last span reaches the last word."""
    if n_words <= SPAN:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n_words - SPAN + 1, STEP)
    return starts if starts[-1] == n_words - SPAN else np.append(starts, n_words - SPAN)


class Model:
    """Embeddings, softmax layer and the calibration of a document's logit."""

    def __init__(self, emb: np.ndarray, layer: np.ndarray, bias: float, a: float = 1.0, b: float = 0.0):
        self.emb, self.layer, self.bias, self.a, self.b = emb, layer, bias, a, b

    def slim(self) -> tuple[np.ndarray, float, float, float]:
        """What scoring needs: for two classes the softmax depends on emb @ (layer[1] - layer[0]) alone."""
        return (self.emb @ (self.layer[1] - self.layer[0])).astype(np.float64), self.bias, self.a, self.b


def span_logits(weight: np.ndarray, bias: float, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The logit of each span: the mean over the n-grams of its words."""
    if not len(counts):
        return np.array([bias])
    ends = np.cumsum(counts)
    s = np.concatenate([[0.0], np.cumsum(weight[ids], dtype=np.float64)])[np.concatenate([[0], ends])]
    c = np.concatenate([[0], ends])
    first = spans(len(counts))
    last = np.minimum(first + SPAN, len(counts))
    return (s[last] - s[first]) / np.maximum(LEAST, c[last] - c[first]) + bias


def score_one(slim: tuple, text: str | None) -> float:
    """Between 0 and 1. A text without words (null, empty, punctuation) gets the layer's bias alone."""
    weight, bias, a, b = slim
    top = float(span_logits(weight, bias, *features(text)).max())
    return float(1 / (1 + np.exp(-np.clip(a * top + b, -30, 30))))


class Sample:
    """Labelled texts as numbers of words. Each distinct word's n-grams are held once, so a text takes less room than its characters."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.docs: list[np.ndarray] = []
        self.toxic: list[int] = []

    def add(self, words: list[bytes], toxic: int) -> None:
        self.docs.append(np.array([self.number.setdefault(w, len(self.number)) for w in words], np.int32))
        self.toxic.append(toxic)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them), for each start and size."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def train(sample: Sample, rounds: int = 8, seed: int = 7) -> Model:
    """Fit embeddings and layer together (AdaGrad on the log loss); an empty or one-sided sample gives a model that scores near 0."""
    rng = np.random.default_rng(seed)
    y, docs = np.array(sample.toxic), sample.docs
    emb, layer, bias = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32), np.zeros((2, DIM)), -3.0
    layer[1] = rng.normal(0, 1, DIM) / np.sqrt(DIM)
    if not (y == 1).any() or not (y == 0).any():
        if len(y):
            warnings.warn(f"toxicity: all {len(y)} labelled training texts are {'toxic' if y[0] else 'clean'}, so nothing can be learned and nothing is rejected", stacklevel=2)
        return Model(emb * 0, layer, -6.0)
    buckets, sizes = grams(list(sample.number))
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes

    def logits(weight: np.ndarray, bias: float, wanted):
        """span_logits() of each wanted document."""
        by_word = np.diff(np.concatenate([[0.0], np.cumsum(weight[buckets], dtype=np.float64)])[np.concatenate([[0], ends])])
        for d in wanted:
            if not len(docs[d]):
                yield d, np.array([bias])
                continue
            first = spans(len(docs[d]))
            last = np.minimum(first + SPAN, len(docs[d]))
            s, c = (np.concatenate([[0], np.cumsum(x[docs[d]])]) for x in (by_word, sizes))
            yield d, (s[last] - s[first]) / np.maximum(LEAST, c[last] - c[first]) + bias

    fit = rng.random(len(docs)) < 0.8  # the rest calibrates
    g2, gl2, gb2 = np.full(BUCKETS, G0), np.full((2, DIM), 1e-6), 1e-6
    for r in range(rounds):
        weight = emb @ (layer[1] - layer[0])
        items: list[tuple[int, int, int, float]] = []  # document, span, label, weight
        for d, z in logits(weight, bias, np.flatnonzero(fit)):
            n = len(z)
            if y[d] == 0:
                chosen = rng.permutation(n)[:DRAWN]
                if r:  # and the spans that look worst
                    chosen = np.unique(np.append(chosen, np.argsort(-z)[:WORST]))
                items += [(d, s, 0, 1.0) for s in chosen]
            elif r == 0:
                chosen = rng.permutation(n)[:DRAWN]
                items += [(d, s, 1, 1.0) for s in chosen]
            else:
                chosen = np.flatnonzero(z >= max(z.max() - 1e-9, 0.5))
                chosen = chosen if len(chosen) else np.array([z.argmax()])
                items += [(d, s, 1, 2.0) for s in chosen[:DRAWN]]
        order = rng.permutation(len(items))
        for at in range(0, len(items), 128):
            part = [items[i] for i in order[at : at + 128]]
            pieces = [docs[d][first : first + SPAN] for d, first in ((d, spans(len(docs[d]))[s]) for d, s, _, _ in part)]
            words = np.concatenate(pieces)
            ids = buckets[ragged(starts[words], sizes[words])]
            owner = np.repeat(np.repeat(np.arange(len(part)), [len(p) for p in pieces]), sizes[words])
            # Some words of each span lose some n-grams, as a misspelling would take them.
            kept = rng.random(len(ids)) > 0.15
            ids, owner = ids[kept], owner[kept]
            lens = np.bincount(owner, minlength=len(part))
            mean = np.zeros((len(part), DIM))
            if len(ids):
                full = lens > 0
                mean[full] = np.add.reduceat(emb[ids], (np.cumsum(lens) - lens)[full])
            mean /= np.maximum(LEAST, lens)[:, None]
            side = layer[1] - layer[0]
            p = 1 / (1 + np.exp(-np.clip(mean @ side + bias, -30, 30)))
            err = (p - np.array([t for _, _, t, _ in part])) * np.array([w for *_, w in part])
            # The softmax's gradient on a mean is err * side, so the embeddings' is of rank one.
            u = np.bincount(ids, weights=(err / np.maximum(LEAST, lens))[owner], minlength=BUCKETS) if len(ids) else np.zeros(BUCKETS)
            hit = np.flatnonzero(u)
            g2[hit] += u[hit] ** 2
            emb[hit] -= (0.5 * u[hit] / np.sqrt(g2[hit]))[:, None] * side
            gl = np.stack([-(err @ mean), err @ mean]) / len(part)
            gl2 += gl**2
            layer -= 0.1 * gl / np.sqrt(gl2)
            gb = err.mean()
            gb2 += gb**2
            bias -= 0.1 * gb / np.sqrt(gb2)
    model = Model(emb, layer, bias)
    weight = emb @ (layer[1] - layer[0])
    rest = np.flatnonzero(~fit)
    if len(set(y[rest])) == 2:
        z = np.array([x.max() for _, x in logits(weight, bias, rest)])
        model.a, model.b = calibrated(z, y[rest])
    return model


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift by Newton's method, with smoothed targets, so that few or separable rows give finite ones."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - t) * z).sum(), (p - t).sum()])
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1, 2 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Sample:
    """At most `rows` labelled training texts of each label, in the order of a hash of their id, whatever their length.

    Training ids are those whose crc32 (of the id as text) mod 4 isn't 2. Ids with both labels, or none, are no training rows, and
    ids without a text take no place. Tasks hand on each picked text's words, compressed.
    """
    known = (
        labels.filter("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 4 != 2")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))
        .filter("low = high")
        .join(docs.select(F.col("doc_id").alias("__id")), "__id", "left_semi")
    )

    def run(batches):
        for batch in batches:
            packed = [zlib.compress(b" ".join(words_of(t.as_py())), 1) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["id", "words", "toxic"])

    picked = [
        known.filter(F.col("high") == side).select("__id", F.lit(side).alias("__toxic")).orderBy(F.xxhash64("__id"), "__id").limit(rows)
        for side in (0, 1)
    ]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * rows at most
    found = docs.select(F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("__text")).join(ids, F.col("__doc") == F.col("__id"))
    found = save(found.select(F.col("__id").cast("bigint").alias("id"), "__text", "__toxic").mapInArrow(run, "id bigint, words binary, toxic int"), "sample")
    out = Sample()
    both = [found.filter(F.col("toxic") == side).orderBy(F.xxhash64("id"), "id", "words").limit(rows).collect() for side in (0, 1)]
    # Both labels in one order, so that neither the fitting nor the calibration rows lean to one.
    for r in sorted((r for part in both for r in part), key=lambda r: (zlib.crc32(str(r.id).encode()), r.id, bytes(r.words))):
        out.add(zlib.decompress(r.words).split(), r.toxic)
    return out


def with_toxicity(docs: DataFrame, model: Model, score: str = "score", toxic: str = "toxic") -> DataFrame:
    """docs with the columns of those names (double, boolean), which docs hasn't."""
    slim = docs.sparkSession.sparkContext.broadcast(model.slim())  # BUCKETS doubles, whatever the input
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            scores = pa.array([score_one(slim.value, t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], schema=out)

    kept = docs.select("*", F.lit(None).cast("double").alias(score))
    out = pa.schema([*_arrow(docs), pa.field(score, pa.float64())])
    return docs.mapInArrow(run, kept.schema).withColumn(toxic, F.col(score) >= PREDICT_AT)


def _arrow(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted.

    Null and empty texts get the score of a text without words. Repeated rows are scored alike; a null doc_id is not held out.
    Without labels of both kinds every score is near 0. Other columns of either table are never read.
    """
    model = train(sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))
    scored = with_toxicity(docs.select("doc_id", "text"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.col("toxic").cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs, in its own columns, without those that the model rejects (score of PREDICT_AT or more)."""
    model = train(sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))
    score, toxic = fresh("score", docs), fresh("toxic", docs)
    return with_toxicity(docs, model, score, toxic).filter(~F.col(toxic)).drop(score, toxic)
