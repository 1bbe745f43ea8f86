"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of all labelled texts: each task adds up one dense count per
language it meets and hands on what is not zero; the sums make a matrix of buckets by
languages, whose size is fixed by these two numbers.  Scoring workers hold its logarithm
and add up, per batch of texts, the columns of the n-grams that occur.

A text that is null or has no letter is ``und`` with score 0; so is every text if nothing
was learned.  Between languages of equal probability the smaller name wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common

#: Lengths of the n-grams, buckets at most, and bytes of the matrix that goes to the workers.
LENGTHS = (1, 2, 3)
BUCKETS = 1 << 16
MATRIX_BYTES = 64_000_000
SMOOTHING = 0.5
#: Text bytes that are turned into n-grams together.
FLUSH_BYTES = 1_000_000

_GAP = " " * max(LENGTHS)
_letters: np.ndarray | None = None


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_matrix: np.ndarray  # languages by buckets

    @property
    def buckets(self) -> int:
        return self.log_matrix.shape[1]


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters


def grams(texts: list[str], buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams that end at each letter, one array per length; the first letter of each text (one more at the end)."""
    lowered = [t.lower() for t in texts]
    line = _GAP + _GAP.join(lowered)
    code = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[code]
    code = np.where(letter, code, np.uint32(0x20))
    at = np.flatnonzero(letter)
    edges = np.cumsum([0, *(len(t) + len(_GAP) for t in lowered)])
    out, key = [], np.zeros(len(at), np.uint64)
    for n in LENGTHS:
        key = key * np.uint64(0x9E3779B1) + code[at - n + 1] + np.uint64(n)
        out.append((common.mix(key) % np.uint64(buckets)).astype(np.int32))
    return out, np.searchsorted(at, edges)


def _flushes(batch: pa.RecordBatch) -> Iterator[slice]:
    sizes = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("__text")])
    first = 0
    while first < batch.num_rows:
        done = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, done + FLUSH_BYTES, side="right")))
        yield slice(first, last)
        first = last


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count the n-grams of every row whose text and language are not null."""
    common.prepared(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), common.text_bytes(text).alias("__text"))
    classes = rows.groupBy("lang").count().orderBy("lang").collect()  # one line per language
    languages = tuple(r["lang"] for r in classes)
    if not languages:
        return Model((), np.zeros(0), np.zeros((0, BUCKETS), np.float32))
    buckets = min(BUCKETS, 1 << int(np.log2(MATRIX_BYTES / 4 / len(languages))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            own = batch.column("lang").to_pylist()
            for part in _flushes(batch):
                texts = [x.as_py().decode() for x in batch.column("__text")[part]]
                found, firsts = grams(texts, buckets)
                for name in set(own[part]):
                    held = sums.setdefault(name, np.zeros(buckets, np.int64))
                    mine = np.repeat([x == name for x in own[part]], np.diff(firsts))
                    for bucket in found:
                        held += np.bincount(bucket[mine], minlength=buckets)
        for name, held in sums.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(held[at])], ["lang", "bucket", "n"])

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most buckets times languages
    counts = np.zeros((len(languages), buckets))
    place = {name: i for i, name in enumerate(languages)}
    row = np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)
    counts[row, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    counts += SMOOTHING
    matrix = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    prior = np.array([r["count"] for r in classes], float)
    return Model(languages, np.log(prior / prior.sum()), matrix)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str | Column] = ()) -> DataFrame:
    """Per row: ``lang_pred``, ``score`` (its posterior probability) and ``fit``, by how much more likely than under a
    uniform choice of buckets an n-gram is on average (natural logarithm; null for ``und``)."""
    spark = common.prepared(docs.sparkSession)
    rows = docs.select(*keep, common.text_bytes(text).alias("__text"))
    kept = rows.drop("__text").schema
    held = spark.sparkContext.broadcast(model)  # MATRIX_BYTES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        names = np.array([*own.languages, "und"], object)
        for batch in batches:
            best, score, fit = [], [], []
            for part in _flushes(batch):
                texts = [x.as_py().decode() for x in batch.column("__text")[part]]
                found, firsts = grams(texts, own.buckets)
                size = np.diff(firsts)
                total = np.zeros((len(texts), len(own.languages)))
                some = size > 0
                for k in range(len(own.languages)):
                    each = np.zeros(firsts[-1])
                    for bucket in found:
                        each += own.log_matrix[k][bucket]
                    if some.any():
                        total[some, k] = np.add.reduceat(each, firsts[:-1][some])
                if not own.languages:
                    best += [len(names) - 1] * len(texts)
                    score += [0.0] * len(texts)
                    fit += [None] * len(texts)
                    continue
                joint = total + own.log_prior
                top = joint.argmax(axis=1)
                share = np.exp(joint - joint.max(axis=1, keepdims=True))
                share = share.max(axis=1) / share.sum(axis=1)
                mean = total[np.arange(len(top)), top] / np.maximum(size * len(LENGTHS), 1) + np.log(own.buckets)
                best += np.where(some, top, len(names) - 1).tolist()
                score += np.where(some, share, 0.0).tolist()
                fit += [m if s else None for m, s in zip(mean.tolist(), some.tolist())]
            carried = batch.drop_columns(["__text"])
            columns = [pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(fit, pa.float64())]
            yield pa.RecordBatch.from_arrays([*carried.columns, *columns], [*carried.schema.names, "lang_pred", "score", "fit"])

    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double, fit double"]
    return rows.mapInArrow(run, ", ".join(fields))
