"""Concatenate and cut: all documents as one row of tokens, cut into windows of fixed length.

The first pass tokenises and writes, per document, its ids, the number of its task and the
tokens before it in that task.  A prefix sum over the tasks' totals then gives every
document its global offset; the second pass cuts each document at the multiples of the
window length.  Nothing is shuffled but one total per task, and no row waits for another.

A document's ids are followed by one end id; null texts are empty and consist of it alone.
Only the last window can be short.  Repeated rows are packed as often as they stand there.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm import common
from tidegate.session import scratch_path

#: Distinct word pieces whose ids a worker remembers before it starts afresh.
REMEMBERED = 400_000

# Contractions and classes of the vocabulary's own word splitting, for ASCII and Latin letters.
_PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Remembered(dict):
    """Ids, as bytes, of pieces and of white-space separated chunks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.letters = _byte_letters()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = self._splits_as_expected()

    def _splits_as_expected(self) -> bool:
        """Whether pieces can be split here: on a probe it gives what the vocabulary itself gives."""
        probe = "It's we'll I'D 'tis Straße ÀÉÑ a1b22 co-op (x.y)!? \x01 \x1c z 'Re end"
        own = [x for piece in _PIECES.findall(probe.lower()) for x in self._model(piece)]
        return own == self.tokenizer.encode(probe, add_special_tokens=False).ids

    def _model(self, piece: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize("".join([self.letters[b] for b in piece.encode()]))]

    def __missing__(self, piece: str | bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if isinstance(piece, bytes):  # a chunk with other letters: through the whole tokenizer
            found = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        else:
            found = self._model(piece)
        self[piece] = out = np.array(found, self.kind).tobytes()
        return out

    def encode(self, data: bytes) -> bytes:
        text = data.decode()
        if self.plain and not any(s in text for s in self.specials):
            if _PLAIN.fullmatch(text):
                return b"".join(map(self.__getitem__, _PIECES.findall(text.lower())))
            parts = []
            for chunk in data.split():
                word = chunk.decode()
                parts += map(self.__getitem__, _PIECES.findall(word.lower())) if _PLAIN.fullmatch(word) else [self[chunk]]
            return b"".join(parts)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()


_held: dict[str, _Remembered] = {}


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = 1, text: str = "text", keep: list[str | Column] = ()) -> DataFrame:
    """First pass, as a table: ``part``, ``before`` (tokens before the row in its part), ``n``, ``ids`` (little-endian)."""
    spark = common.prepared(docs.sparkSession)
    rows = docs.select(*keep, common.text_bytes(text).alias("__text"))
    kept = rows.drop("__text").schema
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "part int, before long, n long, width int, ids binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _held.get(tokenizer)
        if known is None:
            known = _held[tokenizer] = _Remembered(tokenizer)
        width = np.dtype(known.kind).itemsize
        end, part, before = np.array([end_id], known.kind).tobytes(), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [known.encode(x.as_py()) + end for x in batch.column("__text")]
            n = np.array([len(x) // width for x in ids], np.int64)
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            carried = batch.drop_columns(["__text"])
            columns = [pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n),
                       pa.array(np.full(len(n), width, np.int32)), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([*carried.columns, *columns], [*carried.schema.names, "part", "before", "n", "width", "ids"])

    at = scratch_path(spark, "tokens")
    rows.mapInArrow(run, fields).write.parquet(at)
    return spark.read.parquet(at)


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, text: str = "text", keep: list[str | Column] = (),
         with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: where it starts in the document and in which window, its ids and their crc32,
    and whether the document goes on in the next window."""
    tokens = tokenised(docs, tokenizer, end_id, text, keep)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # One line of two numbers per task of the first pass.
    placed = tokens.join(F.broadcast(bases), "part").withColumn("__at", F.col("base") + F.col("before")).drop("part", "base", "before")
    kept = placed.drop("__at", "n", "width", "ids").schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    fields += ["start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, continues boolean"]
    fields += ["ids array<int>"] if with_ids else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, rows, pieces = [], [], []
            at, n, width = (batch.column(c).to_pylist() for c in ("__at", "n", "width"))
            for i, value in enumerate(batch.column("ids")):
                ids = np.frombuffer(value.as_buffer(), f"<u{width[i]}").astype("<u4")
                start = 0
                while start < n[i]:
                    place = at[i] + start
                    size = min(n[i] - start, length - place % length)
                    piece = ids[start : start + size]
                    source.append(i)
                    rows.append((start, size, zlib.crc32(piece), n[i], place // length, place % length, start + size < n[i]))
                    pieces.append(piece)
                    start += size
            carried = batch.drop_columns(["__at", "n", "width", "ids"]).take(pa.array(source, pa.int64()))
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "continues"]
            columns = [pa.array([r[k] for r in rows], pa.bool_() if k == 6 else pa.int64()) for k in range(7)]
            if with_ids:
                names.append("ids")
                columns.append(pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*carried.columns, *columns], [*carried.schema.names, *names])

    return placed.mapInArrow(cut, ", ".join(fields))
