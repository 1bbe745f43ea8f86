"""Quality of a text from trusted positives and unlabelled text, without trusting any negative.

A linear model on the text's form is fitted by minimising the non-negative unbiased risk
(Kiryo et al.): with class prior p, the loss of unlabelled text as negative less p times
the loss of positives as negative estimates the loss of the negatives; where it falls below
zero the step goes back.  The loss is logistic, so the score is a probability.  The prior
is estimated first: a classifier of positive against unlabelled text is fitted, and of all
its upper score ranges the one that holds least unlabelled text per positive text bounds it.

The fit uses at most ``SAMPLE`` positive documents and ``UNLABELLED`` of all documents, those of the
smallest hash of their id.  A document is a trusted positive if all its labels are 1.  Unlabelled text is
all text: the mixture whose share of positives is estimated, labels ignored, however many there are.
An id on several rows counts once, with the text of the smallest hash.
Null and empty texts have score 0, and no part in the fit; rows of null id are only scored.  Without positives nothing is learned and every other
text has score 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common

#: Positive documents and documents of the mixture that the model is fitted on, at most.
SAMPLE, UNLABELLED = 8_000, 8_000
STEPS, RATE, DECAY = 400, 0.05, 1e-4

_CLASSES = 16
_CLASS = np.full(256, 13, np.uint8)  # outside ASCII
_CLASS[:128] = 12  # control
for _i, _members in enumerate((range(97, 123), range(65, 91), range(48, 58), b" ", b"\n\r", b".", b",", b";:!?", b"'\"`", b"()[]{}<>", b"#$%&*+=@^_~|\\/", b"-")):
    _CLASS[list(_members)] = _i
FEATURES = _CLASSES * _CLASSES + 129 + 7


def features(texts: list[bytes]) -> np.ndarray:
    """Square roots of the shares of bytes and of pairs of byte classes; lengths and repetition."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    pairs, single = out[:, : _CLASSES**2], out[:, _CLASSES**2 : _CLASSES**2 + 129]
    for i, text in enumerate(texts):
        if not text:
            continue
        data = np.frombuffer(text, np.uint8)
        kind = _CLASS[data]
        pairs[i] = np.bincount(kind[:-1] * np.uint8(_CLASSES) + kind[1:], minlength=_CLASSES**2)
        counts = np.bincount(data, minlength=256)
        single[i, :128], single[i, 128] = counts[:128], counts[128:].sum()
        pairs[i] /= max(1, len(data) - 1)
        single[i] /= len(data)
        words, lines = text.split(), [x for x in text.split(b"\n") if x]
        out[i, -7:] = (np.log10(len(data)), np.log10(1 + len(words)), len(data) / (1 + len(words)) / 10, len(set(words)) / max(1, len(words)),
                       len(set(lines)) / max(1, len(lines)), np.log10(1 + len(lines)),
                       np.sqrt(sum(map(eq, words, words[1:])) / max(1, len(words))))
    np.sqrt(out[:, :-7], out=out[:, :-7])
    return out


@dataclass(frozen=True)
class Model:
    """A linear model on standardised features; ``prior`` is the estimated share of positives in unlabelled text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def slope(x: np.ndarray, n: int, prior: float | None, w: np.ndarray) -> np.ndarray:
    """How the risk changes with the weights and, last, the bias.  The first ``n`` rows are positives, the others
    unlabelled; without a prior they count as negatives."""
    z = x @ w[:-1] + w[-1]
    p = _sigmoid(z)
    g = np.zeros(len(x))  # slope of the risk by each logit
    if prior is None:
        g[:n], g[n:] = (p[:n] - 1) / n, p[n:] / (len(x) - n)
    else:
        as_negative = np.logaddexp(0, z)
        rest = as_negative[n:].mean() - prior * as_negative[:n].mean()
        back = -prior * p[:n] / n, p[n:] / (len(x) - n)
        if rest >= 0:
            g[:n], g[n:] = prior * (p[:n] - 1) / n + back[0], back[1]
        else:
            g[:n], g[n:] = -back[0], -back[1]
    return np.append(x.T @ g, g.sum())


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> tuple[np.ndarray, float]:
    """Weights and bias of least risk: non-negative for a prior, positive against unlabelled without one (Adam)."""
    x = np.concatenate([positive, unlabelled])
    w = np.zeros(x.shape[1] + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        down = slope(x, len(positive), prior, w)
        down[:-1] += DECAY * w[:-1]
        first += 0.1 * (down - first)
        second += 0.01 * (down * down - second)
        w -= RATE / (1 + step / 100) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least share of unlabelled over share of positive scores above a threshold, over those that keep half the positives."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.5, 51))
    ratios = [(unlabelled >= c).mean() / (positive >= c).mean() for c in cuts]
    return float(np.clip(min(ratios), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    # The prior is read off rows that its classifier was not fitted on.
    w, b = _descend(p[::2], u[::2], None)
    prior = estimated_prior(p[1::2] @ w + b, u[1::2] @ w + b) if min(len(p), len(u)) > 1 else 0.5
    w, b = _descend(p, u, prior)
    return Model(mean, scale, w, b, prior)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", sample: int = SAMPLE,
          unlabelled: int = UNLABELLED) -> Model | None:
    """Fit on the rows of ``docs``; None where no document is a trusted positive."""
    common.prepared(docs.sparkSession)
    known = labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(quality).alias("q"))
    texts = docs.where(F.col(doc_id).isNotNull() & (F.octet_length(text) > 0)).select(F.col(doc_id).alias("id"), common.text_bytes(text).alias("__text"))
    ids = texts.select("id").distinct()
    order = [F.xxhash64("id"), "id"]
    positive = ids.join(known.where("q = 1"), "id", "left_semi").orderBy(*order).limit(sample)
    mixture = ids.orderBy(*order).limit(unlabelled)
    chosen = positive.select("id", F.lit(1).alias("kind")).union(mixture.select("id", F.lit(0).alias("kind")))
    kinds = chosen.groupBy("id").agg(F.collect_set("kind").alias("kinds"))
    rows = texts.join(F.broadcast(kinds), "id")  # sample + unlabelled ids
    rows = rows.groupBy("id").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"), F.first("kinds").alias("kinds"))
    rows = rows.select("id", F.explode("kinds").alias("kind"), "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("kind"), pa.array([x.tobytes() for x in found], pa.binary())], ["id", "kind", "x"])

    table = rows.select("id", "kind", "__text").mapInArrow(run, "id long, kind int, x binary").toArrow().sort_by([("kind", "ascending"), ("id", "ascending")])
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)
    kind = table.column("kind").to_numpy()
    if not (kind == 1).any() or not (kind == 0).any():
        return None
    return fit(x[kind == 1], x[kind == 0])


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str | Column] = (), threshold: float = 0.7) -> DataFrame:
    """Per row: ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    spark = common.prepared(docs.sparkSession)
    rows = docs.select(*keep, common.text_bytes(text).alias("__text"))
    kept = rows.drop("__text").schema
    held = spark.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            empty = np.array([not t for t in texts], bool)
            own = held.value
            p = np.full(len(texts), 0.5) if own is None else _sigmoid(own.logits(features(texts)))
            p = np.where(empty, 0.0, p)
            carried = batch.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*carried.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*carried.schema.names, "score", "predicted"])

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double, predicted int"]))
