"""Language identification by a byte convolutional network, trained in numpy on labelled text.

A text is cut into fixed windows of bytes, the last one padded with zeros.  Each window goes through an embedding,
filters of several widths, a maximum over positions and a softmax; a text's probability is the mean over all its windows,
weighted by their bytes.  Whole texts are read, in one narrow pass without a shuffle.

Training takes at most ``per_class`` texts of each label and ``per_text`` windows of each (the documented bound); the
rest of the corpus is only predicted.  A null text, or one without any letter, is ``und`` with score 0, and so is every
text if there is nothing to learn from.  Ties go to the label that sorts first.  Null labels are not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import let_go, map_texts, quoted, slices

UNKNOWN = "und"
WINDOW, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
REACH = max(WIDTHS)


@dataclass(frozen=True)
class LanguageModel:
    """Weights of fixed size: an embedding row per byte (byte 0 pads and is zero), one matrix for all filters."""

    labels: tuple[str, ...]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # REACH * EMBED x FILTERS * len(WIDTHS); a narrow filter has zeros beyond its width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def probabilities(self, windows: np.ndarray, block: int = 128) -> np.ndarray:
        """Softmax for each row of an (n, WINDOW) array of bytes."""
        result = np.empty((len(windows), len(self.labels)), np.float32)
        for at in range(0, len(windows), block):
            pooled, _ = _pool(self.embed[windows[at : at + block]], self.filters)
            result[at : at + block] = _softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias)
        return result


def _columns(x: np.ndarray) -> np.ndarray:
    """Every run of REACH embeddings as one row."""
    n, length, e = x.shape
    s = x.strides
    return np.lib.stride_tricks.as_strided(x, (n, length - REACH + 1, REACH * e), (s[0], s[1], s[2])).reshape(-1, REACH * e)


def _pool(x: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen = (_columns(x) @ filters).reshape(len(x), -1, filters.shape[1])
    return seen.max(axis=1), seen


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, one at least."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


def fit(rows: list[tuple[bytes, str]], *, epochs: int = 12, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> LanguageModel | None:
    """Adam on cross-entropy.  Each window is shown whole and cut to a random length, so that short texts are learnt too."""
    labels = tuple(sorted({label for _, label in rows}))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    rows = sorted(rows)
    data = np.zeros((len(rows), WINDOW), np.uint8)
    for i, (text, _) in enumerate(rows):
        data[i, : len(text)] = np.frombuffer(text[:WINDOW], np.uint8)
    truth = np.array([labels.index(label) for _, label in rows])
    mask = np.concatenate([np.arange(REACH * EMBED)[:, None] < w * EMBED for w in WIDTHS for _ in range(FILTERS)], axis=1)
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.3, mask.shape) * mask,
        "bias": np.zeros(mask.shape[1]), "out": rng.normal(0, 0.2, (mask.shape[1], len(labels))), "out_bias": np.zeros(len(labels)),
    }
    p["embed"][0] = 0
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x, y = data[pick].copy(), truth[pick]
            cut = np.where(rng.random(len(pick)) < 0.5, WINDOW, rng.integers(6, WINDOW, len(pick)))
            x[np.arange(WINDOW) >= cut[:, None]] = 0
            e = p["embed"][x]
            columns = _columns(e)
            seen = (columns @ p["filters"]).reshape(len(x), -1, mask.shape[1])
            best = seen.argmax(axis=1)
            pooled = np.take_along_axis(seen, best[:, None], 1)[:, 0] + p["bias"]
            hidden = np.maximum(pooled, 0)
            d = _softmax(hidden @ p["out"] + p["out_bias"])
            d[np.arange(len(y)), y] -= 1
            d /= len(y)
            back = (d @ p["out"].T) * (pooled > 0)
            where = (np.arange(len(x))[:, None] * seen.shape[1] + best).ravel()
            chosen = columns[where].reshape(len(x), mask.shape[1], -1)
            d_cols = back[:, :, None] * p["filters"].T[None]
            d_embed = np.zeros_like(p["embed"])
            for j in range(REACH):
                byte = np.take_along_axis(x, best + j, 1)
                np.add.at(d_embed, byte.ravel(), d_cols[:, :, j * EMBED : (j + 1) * EMBED].reshape(-1, EMBED))
            d_embed[0] = 0
            grads = {
                "embed": d_embed, "filters": np.einsum("nf,nfk->kf", back, chosen) * mask, "bias": back.sum(0),
                "out": hidden.T @ d, "out_bias": d.sum(0),
            }
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return LanguageModel(labels, **{k: x.astype(np.float32) for k, x in p.items()})


def held_out(key: Column) -> Column:
    """True for the third of the keys that is never learnt from; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang", per_class: int = 250, per_text: int = 6) -> LanguageModel | None:
    """Fit on the texts of each label that come first by the hash of their key, a third of the keys left out."""
    known = docs.where(~held_out(F.col(key)) & F.col(label).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    first = Window.partitionBy("label").orderBy("h", "k")
    picked = (
        known.select(F.col(key).alias("k"), F.col(label).cast("string").alias("label"), F.xxhash64(F.col(key).cast("string")).alias("h"))
        .withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_class).select("k").collect()
    )
    if not picked:
        return None

    def sample(batches):
        for b in slices(batches):
            out = []
            for t, label_ in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
                data = t.encode("utf-8", "surrogatepass")
                room = max(0, len(data) - WINDOW)
                starts = {room * i // max(1, per_text - 1) for i in range(per_text)}
                out += [(data[s : s + WINDOW], label_) for s in sorted(starts) if data]
            if out:
                yield pa.RecordBatch.from_pydict({"w": pa.array([w for w, _ in out], pa.binary()), "label": [x for _, x in out]})

    chosen = known.where(F.col(key).isin([r.k for r in picked])).select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    windows = chosen.mapInArrow(sample, "w binary, label string").orderBy(F.xxhash64("w", "label"), "w").limit(2 * len(picked) * per_text)
    return fit([(bytes(r.w), r.label) for r in windows.collect()])


def with_letters(text: Column) -> Column:
    """The text if it has a letter, else null."""
    return F.when(text.cast("string").rlike(r"\p{L}"), text.cast("string"))


def judged(texts: pa.Array, model: LanguageModel) -> tuple[list[str], list[float]]:
    """Label and probability of each text; null is unknown."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    datas = [x if x is None else x.encode("utf-8", "surrogatepass") for x in texts.to_pylist()]
    rows = [i for i, x in enumerate(datas) if x is not None]
    if rows:
        parts = [windows_of(datas[i]) for i in rows]
        counts = np.array([len(x) for x in parts])
        p = model.probabilities(np.concatenate(parts)).astype(np.float64)
        weight = np.full(len(p), float(WINDOW))
        ends = np.cumsum(counts)
        weight[ends - 1] = [len(datas[i]) - (len(x) - 1) * WINDOW for i, x in zip(rows, parts, strict=True)]
        weight = np.maximum(weight, 1)
        total = np.add.reduceat(p * weight[:, None], ends - counts) / np.add.reduceat(weight, ends - counts)[:, None]
        for i, t in zip(rows, total, strict=True):
            best = int(t.argmax())
            labels[i], scores[i] = model.labels[best], float(min(1.0, t[best]))
    return labels, scores


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[str], *, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of ``keep`` and, under ``names``, the label and its probability."""
    pred, score = names
    if model is None:
        return docs.select(*quoted(keep), F.lit(UNKNOWN).alias(pred), F.lit(0.0).alias(score))

    def label(batches):
        let_go()
        for b in slices(batches, 2 << 20, "_text"):
            labels, scores = judged(b.column("_text"), model)
            yield b, [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]

    return map_texts(docs, keep, with_letters(F.col(text)), [(pred, "string"), (score, "double")], label)


def keep_known(docs: DataFrame, model: LanguageModel | None, *, text: str = "text", least: float = 0.0) -> DataFrame:
    """The same columns, without the rows whose language is unknown or whose probability is below ``least``."""
    if model is None:
        return docs.where(F.lit(False))

    # Only the verdict comes back from Python: the columns of the table, the text among them, stay where they are.
    @F.arrow_udf("boolean")
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        for column in texts:
            verdicts = []
            for b in slices([pa.RecordBatch.from_arrays([column], ["_text"])], 2 << 20, "_text"):
                labels, scores = judged(b.column("_text"), model)
                verdicts += [x != UNKNOWN and y >= least for x, y in zip(labels, scores, strict=True)]
            yield pa.array(verdicts, pa.bool_())

    return docs.where(known(with_letters(F.col(text))))
