"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by a learned layer over
surface features; gated attention, learned from document labels alone, weighs the
passages, and the weighted mean of their codes gives the document's score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.common import give_back, worker_state

TOKEN = re.compile(r"\S+")
PASSAGE_WORDS = 100
#: Training reads about this many labelled rows at most, picked by a hash of the key.
MAX_TRAINING_ROWS = 6000
EPOCHS = 30
HIDDEN = 24
THRESHOLD = 0.3

_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
#: Byte value -> group: one for each ASCII punctuation mark, then control, space, line end, digit, upper, lower, above ASCII.
_GROUP = np.array(
    [
        _PUNCTUATION.index(b) if b in _PUNCTUATION else len(_PUNCTUATION) + (6 if b > 126 else 5 if chr(b).islower() else 4 if chr(b).isupper() else 3 if chr(b).isdigit() else 2 if b == 10 else 1 if b == 32 else 0)
        for b in range(256)
    ]
)
_GROUPS = len(_PUNCTUATION) + 7
_SHAPES = 16
_LOOKS = 4
N_FEATURES = _GROUPS + _SHAPES + _LOOKS


def passages(text: str) -> list[str]:
    """Consecutive runs of PASSAGE_WORDS words that cover the whole text; one empty passage for a text without words."""
    starts = [m.start() for i, m in enumerate(TOKEN.finditer(text)) if i % PASSAGE_WORDS == 0]
    if not starts:
        return [""]
    starts[0] = 0
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]


def passage_features(text: str | None) -> np.ndarray:
    """A row of surface features for each passage: rates of bytes by kind, of word lengths, and how words repeat."""
    parts = passages(text or "")
    out = np.zeros((len(parts), N_FEATURES), np.float32)
    seen: set[str] = set()
    for row, part in zip(out, parts, strict=True):
        raw = np.frombuffer(part.encode("utf-8", "replace"), np.uint8)
        if not len(raw):
            continue
        row[:_GROUPS] = np.bincount(_GROUP[raw], minlength=_GROUPS) / len(raw)
        words = part.split()
        n = max(1, len(words))
        row[_GROUPS : _GROUPS + _SHAPES] = np.bincount([min(len(w), _SHAPES) - 1 for w in words], minlength=_SHAPES) / n
        distinct = set(words)
        lines = [x for x in part.split("\n") if x]
        row[-4:] = len(distinct) / n, len(distinct & seen) / n, len(set(lines)) / max(1, len(lines)), min(1.0, len(lines) / n)
        seen = distinct
    # square roots spread the small rates
    return np.sqrt(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _softmax_by_bag(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    e = np.exp(x - np.repeat(np.maximum.reduceat(x, starts), sizes))
    return e / np.repeat(np.add.reduceat(e, starts), sizes)


@dataclass
class QualityModel:
    """Weights of the encoder (w, b), the gated attention (v, u, a) and the scorer (s, c); features are standardised first."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        starts = np.cumsum(sizes) - sizes
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        weight = _softmax_by_bag((t * g) @ p["a"], starts, sizes)
        z = np.add.reduceat(h * weight[:, None], starts)
        return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "y": _sigmoid(z @ p["s"] + p["c"][0]), "starts": starts}

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def scores(self, texts: list[str | None]) -> list[float]:
        if not texts:
            return []
        bags = [passage_features(t) for t in texts]
        sizes = np.array([len(b) for b in bags])
        return self._forward(self.standard(np.concatenate(bags)), sizes)["y"].astype(float).tolist()

    def attention(self, text: str | None) -> tuple[list[str], np.ndarray]:
        """The passages of a text and the weight of each in its score."""
        x = passage_features(text)
        return passages(text or ""), self._forward(self.standard(x), np.array([len(x)]))["weight"]

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the bags."""
        p, f = self.weights, self._forward(x, sizes)
        h, t, g, weight = f["h"], f["t"], f["g"], f["weight"]
        d_out = (f["y"] - y) / len(y)
        d_z = np.repeat(d_out[:, None] * p["s"], sizes, axis=0)
        d_weight = (d_z * h).sum(axis=1)
        mean = np.repeat(np.add.reduceat(weight * d_weight, f["starts"]), sizes)
        d_logit = (weight * (d_weight - mean))[:, None] * p["a"]
        d_t, d_g = d_logit * g * (1 - t**2), d_logit * t * g * (1 - g)
        d_h = (d_z * weight[:, None] + d_t @ p["v"].T + d_g @ p["u"].T) * (1 - h**2)
        return {
            "w": x.T @ d_h, "b": d_h.sum(axis=0), "v": h.T @ d_t, "u": h.T @ d_g,
            "a": ((weight * (d_weight - mean))[:, None] * t * g).sum(axis=0), "s": f["z"].T @ d_out, "c": np.array([d_out.sum()]),
        }


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, hidden: int = HIDDEN, batch: int = 64, rate: float = 5e-3, decay: float = 1e-4) -> QualityModel:
    """Adam on minibatches of bags, from a fixed seed."""
    rng = np.random.default_rng(7)
    every = np.concatenate(bags)
    model = QualityModel(every.mean(axis=0), every.std(axis=0) + 0.02, {})
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    rate_0 = float(np.clip(labels.mean(), 0.01, 0.99))
    model.weights = {"w": draw(N_FEATURES, hidden), "b": np.zeros(hidden), "v": draw(hidden, hidden), "u": draw(hidden, hidden), "a": draw(hidden), "s": draw(hidden) * 0.1, "c": np.array([np.log(rate_0 / (1 - rate_0))])}
    bags = [model.standard(b) for b in bags]
    m, v = ({k: np.zeros_like(w) for k, w in model.weights.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            at = order[i : i + batch]
            grads = model.gradients(np.concatenate([bags[j] for j in at]), np.array([len(bags[j]) for j in at]), labels[at])
            step += 1
            now = rate * (1 - epoch / epochs)
            for k, w in model.weights.items():
                grad = grads[k] + decay * w * (k != "c")
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                w -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def is_held_out(key: Column) -> Column:
    """Rows that never train: crc32 of the key as text leaves 0 when divided by 5. A null key never trains either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _flat_features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    worker_state("quality", dict)  # other operators' caches make room
    for batch in batches:
        yield batch.map(lambda t: passage_features(t).ravel())
        give_back()


def train(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, max_rows: int = MAX_TRAINING_ROWS) -> QualityModel | None:
    """Fit on documents with a 0/1 label outside the held-out fold; None without any.

    Labels are picked first, by a hash of the key and to about ``max_rows``, so the
    side that is broadcast to the documents has a fixed bound and no text is
    shuffled. A key with several labels counts with their mean. Passage features of
    the picked documents, whole texts, go to the driver, which fits the weights.
    """
    known = labels.select(F.col(label_key).alias("k"), F.col(label).cast("double").alias("label"))
    known = known.where(F.col("k").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("k")))
    n = known.count()
    if n == 0:
        return None
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit("quality"), "k"), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    known = known.groupBy("k").agg(F.avg("label").alias("label"))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(known), "k").select("k", "label", _flat_features(F.col("text")).alias("x")).toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values("k", kind="stable")
    bags = [np.asarray(x, np.float32).reshape(-1, N_FEATURES) for x in rows["x"]]
    return fit(bags, rows["label"].to_numpy(float))


def scorer(model: QualityModel | None):
    """A vectorised function text -> score; 0.5 for every text without a model."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_state("quality", dict)  # other operators' caches make room
        for batch in batches:
            texts = batch.tolist()
            out: list[float] = []
            for i in range(0, len(texts), 500):
                out += model.scores(texts[i : i + 500]) if model else [0.5] * len(texts[i : i + 500])
            yield pd.Series(out, dtype="float64")
            del batch, texts, out
            give_back()

    return score


def classify(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, threshold: float = THRESHOLD, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(key, held_out, score, predicted) of every row's whole text.

    ``score`` from 0 to 1 rises with the chance of label 1; ``predicted`` is 1 from
    ``threshold`` on. Null and empty texts are scored as one empty passage. Keys
    may be null or repeat; other columns are not read.
    """
    score = scorer(train(docs, key, text, labels, label_key, label, max_rows))
    out = docs.select(F.col(key), is_held_out(F.col(key)).alias("held_out"), score(F.col(text)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
