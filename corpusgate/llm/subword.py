"""A supervised quality classifier over subword embeddings, trained in numpy.

A word is its own hashed vector and those of its character n-grams (with marks for its two ends), averaged; a document is the
average of its words; a softmax layer over that tells good from bad.  A word that repeats the one before it counts as a
pseudo-word of its own, since repetition is no property of a spelling.  Vectors and layer are learnt together by stochastic
gradient descent, a document a step.

As the output is linear in the average, a trained model is kept as two logits for each bucket; a text is scored from its words' logits,
each distinct word of a batch looked at once.  Scoring reads whole texts in one narrow pass without a shuffle.

Training takes at most ``per_label`` labelled rows of each label, the first ones by the hash of their key, whose text has at most
``max_bytes`` bytes (the documented bound).  Null labels, null keys and null texts are not learnt from.  Scored are
all rows: null and empty texts get what the layer says without any word.  Without rows to learn from every score is 0.5.
"""

from __future__ import annotations

import collections
import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import map_texts, slices

BUCKETS, SIZE, GRAMS = 1 << 18, 8, (2, 3, 4)
_OPEN, _CLOSE = 0x110000, 0x110001  # beyond Unicode: the ends of a word
_AGAIN = b" again"  # no word holds a space


def words_of(text: str | None) -> list[bytes]:
    """The words between ASCII spaces; one that repeats its neighbour is the pseudo-word."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return [_AGAIN if w == before else w for before, w in zip([None, *words], words, strict=False)]


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the words, one word after the other, and how many each word has."""
    texts = [w.decode("utf-8", "surrogatepass") for w in words]
    lengths = np.array([len(t) + 2 for t in texts], np.int64)
    ends = np.cumsum(lengths)
    points = np.empty(int(ends[-1]) if len(words) else 0, np.uint64)
    inner = np.ones(len(points), bool)
    inner[ends - 1] = inner[ends - lengths] = False
    points[ends - lengths], points[ends - 1] = _OPEN, _CLOSE
    points[inner] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths)
    owners, buckets = [np.arange(len(words))], [np.array([zlib.crc32(w) for w in words], np.int64)]
    for n in GRAMS:
        if len(points) < n:
            continue
        mixed = np.full(len(points) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ points[i : len(points) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        whole = owner[: len(mixed)] == owner[n - 1 :]
        owners.append(owner[: len(mixed)][whole])
        buckets.append(mixed[whole].astype(np.int64))
    every = np.concatenate(owners)
    order = np.argsort(every, kind="stable")
    return (np.concatenate(buckets) % BUCKETS)[order], np.bincount(every, minlength=len(words))


@dataclass(frozen=True)
class Model:
    """Logits of both labels for each bucket, and without any word.  Of fixed size."""

    logits: np.ndarray
    bias: np.ndarray

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """The logits of each word: the average over its features."""
        if not words:
            return np.zeros((0, 2))
        buckets, counts = features(words)
        return np.add.reduceat(self.logits[buckets], np.cumsum(counts) - counts) / counts[:, None]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1."""
        return Scorer(self).scores(texts)


class Scorer:
    """A model with the logits of the words met so far; they are forgotten when there are more than ``most``."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most = model, most
        self._forget()

    def _forget(self) -> None:
        self.number = collections.defaultdict(itertools.count().__next__)
        self.known = np.zeros((0, 2))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if len(self.known) > self.most:
            self._forget()
        split = [words_of(t) for t in texts]
        ids = np.fromiter(map(self.number.__getitem__, itertools.chain.from_iterable(split)), np.int64)
        new = list(itertools.islice(self.number, len(self.known), None))
        self.known = np.concatenate([self.known, self.model.of_words(new)])
        counts = np.array([len(w) for w in split], np.int64)
        sums = np.zeros((len(texts), 2))
        some = np.flatnonzero(counts)
        if len(some):
            sums[some] = np.add.reduceat(self.known[ids], (np.cumsum(counts) - counts)[some])
        z = sums / np.maximum(counts, 1)[:, None] + self.model.bias
        return 1 / (1 + np.exp(z[:, 0] - z[:, 1]))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which add up to 1."""
    counted = collections.Counter(words_of(text))
    if not counted:
        return np.zeros(0, np.int64), np.zeros(0)
    buckets, counts = features(list(counted))
    share = np.fromiter(counted.values(), float) / counted.total() / counts
    distinct, which = np.unique(buckets, return_inverse=True)
    return distinct, np.bincount(which, np.repeat(share, counts))


def fit(rows: list[tuple[str, int]], *, epochs: int = 6, rate: float = 0.6, seed: int = 3) -> Model | None:
    """Stochastic gradient descent on cross-entropy; the rate falls to nothing over the epochs."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    out, bias = np.zeros((SIZE, 2)), np.zeros(2)
    known = [document_features(t) for t, _ in rows]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            (buckets, weights), label = known[i], rows[i][1]
            step = rate * (1 - done / steps)
            done += 1
            mean = weights @ vectors[buckets]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            gap = p / p.sum()
            gap[label] -= 1
            back = out @ gap
            out -= step * np.outer(mean, gap)
            bias -= step * 0.1 * gap
            # Each vector moves by its weight in the document, scaled so that common and rare features learn alike.
            vectors[buckets] -= (step * weights / max(weights.max(initial=0), 1e-9))[:, None].astype(np.float32) * back.astype(np.float32)
    return Model((vectors @ out).astype(np.float32), bias)


def held_out(key: Column) -> Column:
    """True for the fifth of the keys that is never learnt from; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
          per_label: int = 1000, max_bytes: int = 1 << 15) -> Model | None:
    known = labels.select(F.col(key).cast("string").alias("k"), F.col(label).cast("int").alias("label")).where(
        F.col("k").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("k")))
    first = [known.where(F.col("label") == v).orderBy(F.xxhash64("k"), "k").limit(2 * per_label) for v in (0, 1)]
    picked = [(r.k, r.label) for part in first for r in part.collect()]
    if not picked:
        return None
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked, "k string, label int"))  # 4 * per_label rows at most
    texts = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("text")).where(F.octet_length("text") <= max_bytes)
    joined = texts.join(chosen, "k")
    rows = [r for v in (0, 1) for r in joined.where(F.col("label") == v).orderBy(F.xxhash64("k"), "k", "text").limit(per_label).collect()]
    return fit([(r.text, r.label) for r in rows])


def predict(docs: DataFrame, model: Model | None, keep: list[str], *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The columns of ``keep``, ``score`` (probability of label 1) and ``predicted`` (1 from ``threshold`` on)."""
    def run(batches):
        scorer = None if model is None else Scorer(model)
        for b in slices(batches, 2 << 20, "_text"):
            scores = np.full(b.num_rows, 0.5) if scorer is None else scorer.scores(b.column("_text").to_pylist())
            yield b, [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())]

    return map_texts(docs, keep, F.col(text).cast("string"), [("score", "double"), ("predicted", "int")], run)
