"""Passages of test questions and answers in documents, found by one Aho-Corasick automaton.

Both sides are normalised byte by byte (A-Z lower-cased, every ASCII byte that is no digit
or letter a space), so an offset in the normalised words leads back to the original text.
A window is ``width`` consecutive words of an item; an item of fewer words is one window.
The automaton holds all windows and reads every text once.  Its patterns go to the workers
while they take up to ``MAX_PATTERN_BYTES``; a larger benchmark is split into blocks of
that size, which read the texts one after the other and add to the same hits.

Null or wordless texts have no hits; null or wordless items have no windows.  Items of
equal id count as one; an item of null id marks words but is not listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common
from tidegate.session import scratch_path

#: Text of benchmark items whose windows one automaton holds.
MAX_PATTERN_BYTES = 4_000_000
_TABLE = bytes(common.LOWER[c] if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Windows:
    """The windows of some items, and the automaton over them."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int):
        self.items: dict[bytes, set[str | None]] = {}
        self.length: dict[bytes, int] = {}
        for item_id, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - width + 1) if words else 0):
                window = b" ".join(words[i : i + width])
                self.items.setdefault(window, set()).add(item_id)
                self.length[window] = min(width, len(words))
        self._automaton: ahocorasick.Automaton | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}  # built once in each worker

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for window in self.length:
                padded = f" {window.decode('latin-1')} "
                self._automaton.add_word(padded, (len(padded), window))
            self._automaton.make_automaton()
        return self._automaton

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges of all occurrences, and the items they come from."""
        if not self.length or not words:
            return [], set()
        line = b" " + b" ".join(words) + b" "
        found = list(self.automaton.iter(line.decode("latin-1")))
        if not found:
            return [], set()
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        at = np.searchsorted(gaps, [end - size + 1 for end, (size, _) in found]).tolist()
        spans = [(i, i + self.length[w]) for i, (_, (_, w)) in zip(at, found)]
        return spans, {x for _, (_, w) in found for x in self.items[w] if x is not None}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _original(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code points of the text."""
    data = np.frombuffer(text, np.uint8)
    solid = np.frombuffer(text.translate(_TABLE), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [{"start": int(point[starts[a]]), "end": int(point[ends[b - 1]])} for a, b in spans]


_HITS = "array<struct<start:bigint,end:bigint>>"
_OUT = (f"n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans {_HITS}")


def scan(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         keep: list[str | Column] = ()) -> DataFrame:
    """Per row of ``docs``: words, words inside a window, items found, and the hit passages as code points."""
    spark = common.prepared(docs.sparkSession)
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), common.text_bytes(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = -(-size // MAX_PATTERN_BYTES) or 1
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    rows = docs.select(*keep, common.text_bytes(text).alias("__text"), F.lit(None).cast("array<bigint>").alias("__hits"),
                       F.lit(None).cast("array<string>").alias("__items"))
    for i in range(blocks):
        own = [(r["id"], bytes(r["text"])) for r in items.where(block == i).toLocalIterator()]
        windows = spark.sparkContext.broadcast(Windows(own, width))
        if i:  # one automaton at a time in a worker's memory
            rows.write.parquet(at := scratch_path(spark, "decontaminate"))
            rows = spark.read.parquet(at).drop("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")
        fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), _OUT])
        rows = rows.mapInArrow(_finder(windows), fields)
    return rows.drop("__text", "__hits", "__items")


def _finder(windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = windows.value
        for batch in batches:
            out, hits, listed = [], [], []
            for value, old, known in zip(batch.column("__text"), batch.column("__hits"), batch.column("__items")):
                data = value.as_py()
                words = words_of(data)
                spans, items = own.find(words)
                if old.is_valid:
                    flat = old.as_py()
                    spans, items = spans + list(zip(flat[::2], flat[1::2])), items | set(known.as_py())
                spans, ids = merged(spans), sorted(items)
                hits.append([x for s in spans for x in s])
                listed.append(ids)
                n_hit = sum(b - a for a, b in spans)
                out.append((len(words), n_hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), n_hit > 0,
                            _original(data, spans) if spans else []))
            columns = {name: batch.column(name) for name in batch.schema.names if name not in ("__hits", "__items")}
            columns |= {"__hits": pa.array(hits, pa.list_(pa.int64())), "__items": pa.array(listed, pa.list_(pa.string()))}
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
            for i, (name, kind) in enumerate(zip(names, kinds)):
                columns[name] = pa.array([r[i] for r in out], kind)
            yield pa.RecordBatch.from_arrays([columns[n] for n in [*batch.schema.names, *names]], [*batch.schema.names, *names])

    return run
