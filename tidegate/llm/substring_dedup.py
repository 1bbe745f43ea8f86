"""Repeated passages, found by doubling: windows that repeat at one length alone are tried at twice that length.

The first level looks at windows of half the wanted length.  Of the half windows inside a
wanted window only the one of smallest hash counts, which is the same one in every copy; so
about a quarter of the positions is counted.  A window is hashed at the next length, from the hashes of its halves, only if
both repeat, and so on until nothing survives or ``longest`` is reached.
Each level is one shuffle of hashes dealt to shards, and one set of sorted arrays in the shared
folder, which the next scan maps into memory.  The texts are scanned for the half windows, for the wanted windows and
once more for those of them that repeat; from then on a level reads what the level before left, a row per
document that still has windows, and not the texts.

A window counts as repeated if it starts in two documents of different ids; of the copies,
the ones in the document of the smallest id stay.  Rows of equal id count as one document.
A row of null id loses nothing, and no other row loses anything to it.  Null texts have no
words; texts shorter than a window stay whole.  Windows are known by 96 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import arrays, common
from tidegate.session import scratch_path
from tidegate.sources.storage import remove

#: Text bytes that a task hashes before it hands the windows on.
FLUSH_BYTES = 12_000_000
_NO_ID = np.iinfo(np.int64).max
_ROW = "shard int, b0 binary, b1 binary, b2 binary, b3 binary"
_LEFT = "id long, places binary, hash binary, check binary"
_SEEDS = (13, 7_919)
_FACTORS = tuple(common.mix(np.full(1, s + 1, np.uint64))[0] | np.uint64(1) for s in _SEEDS)


@dataclass(frozen=True)
class Levels:
    """The window lengths that were counted and where their arrays lie."""

    folder: str
    bits: int
    lengths: tuple[int, ...]


class _Texts:
    """The words of some documents as hashes."""

    def __init__(self, ids: np.ndarray, columns: list[pa.Array]):
        column = pa.chunked_array(columns).combine_chunks() if len(columns) > 1 else columns[0]
        self.ids = ids
        self.data, offsets = common.buffers(column)
        self.starts, self.ends, self.firsts = common.word_spans(self.data, offsets)
        self.words = common.word_hashes(self.data, self.starts, self.ends)
        self.doc = np.repeat(np.arange(len(ids)), np.diff(self.firsts))

    def inside(self, length: int) -> np.ndarray:
        """Which runs of ``length`` words lie in one document."""
        n = len(self.words) - length + 1
        return self.doc[:n] == self.doc[length - 1 :] if n > 0 else np.zeros(0, bool)

    def anchors(self, wanted: int) -> np.ndarray:
        """For every wanted window the smallest hash of the half windows in it."""
        half = (wanted + 1) // 2
        short = common.window_hashes(self.words, half, half)
        n, least, size = max(0, len(self.words) - wanted + 1), short, 1
        while size < wanted - half + 1:  # the least of so many, from two that overlap or touch
            more = min(size, wanted - half + 1 - size)
            least = np.minimum(least[: len(least) - more], least[more:])
            size += more
        return least[:n]

    def wanted(self, levels: Levels) -> _Windows:
        """The windows of the first wanted length whose anchor repeats."""
        length = levels.lengths[1]
        places = np.flatnonzero(self.inside(length))
        least = self.anchors(length)[places]
        news = common.runs(least)  # neighbours mostly share the anchor
        hit = _member(levels, 0, least[news])
        places = places[np.repeat(hit, np.diff(np.append(news, len(least))))]
        both = [common.window_hashes_at(self.words, length, places, seed) for seed in _SEEDS]
        return _Windows(self.ids, self.doc[places], places - self.firsts[self.doc[places]], both[0], both[1] >> np.uint64(32))


@dataclass(frozen=True)
class _Windows:
    """Windows of one length that may repeat: document, first word in it, two hashes; by document and word."""

    ids: np.ndarray
    doc: np.ndarray
    places: np.ndarray
    hashes: np.ndarray
    checks: np.ndarray

    def doubled(self, found: np.ndarray, length: int) -> _Windows:
        """The windows of twice the length whose halves are both among those found; their hashes are made from those of the halves."""
        doc, places, h, c = (x[found] for x in (self.doc, self.places, self.hashes, self.checks))
        key, n = (doc << 32) + places, len(doc)
        wanted, other = key + length, np.minimum(np.arange(n) + length, n - 1)  # the other half, if all between are there
        gap = np.flatnonzero(key[other] != wanted)
        other[gap] = np.minimum(np.searchsorted(key, wanted[gap]), n - 1)
        fits = np.flatnonzero(key[other] == wanted)
        other = other[fits]
        return _Windows(self.ids, doc[fits], places[fits], common.mix(h[fits] * _FACTORS[0] + h[other]),
                        common.mix(c[fits] * _FACTORS[1] + c[other]) >> np.uint64(32))

    def as_rows(self) -> Iterator[pa.RecordBatch]:
        """A row for every document that has windows, a few documents in a batch."""
        firsts = common.runs(self.doc)
        ends = np.append(firsts, len(self.doc))
        parts = (self.places.astype(np.int32), self.hashes, self.checks.astype(np.uint32))
        for at in range(0, len(firsts), common.BATCH_DOCS):
            bounds = ends[at : at + common.BATCH_DOCS + 1]
            columns = [pa.array(self.ids[self.doc[bounds[:-1]]])]
            for values in parts:
                offsets = ((bounds - bounds[0]) * values.itemsize).astype(np.int32)
                data = pa.py_buffer(values[bounds[0] : bounds[-1]].tobytes())
                columns.append(pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), data]))
            yield pa.RecordBatch.from_arrays(columns, ["id", "places", "hash", "check"])

    def shuffled(self, bits: int) -> Iterator[pa.RecordBatch]:
        """The distinct windows with the smallest and the largest id they start in, by shard."""
        ids = self.ids[self.doc]
        h, c, low, high = _merged(self.hashes, self.checks.astype(np.uint32), ids, ids)
        for shard, part in common.shard_slices(h, bits):
            yield _as_batch(shard, common.blob(h[part], c[part], low[part], high[part]))


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[_Windows]:
    """What rows made by ``_Windows.as_rows`` hold, several documents together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= FLUSH_BYTES:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> _Windows:
    table = pa.Table.from_batches(held)
    (places, offsets), (hashes, _), (checks, _) = (common.buffers(table.column(c)) for c in ("places", "hash", "check"))
    doc = np.repeat(np.arange(table.num_rows), np.diff(offsets) // 4)
    places, hashes, checks = (np.frombuffer(x.tobytes(), t) for x, t in ((places, np.int32), (hashes, np.uint64), (checks, np.uint32)))
    return _Windows(table.column("id").to_numpy(), doc, places.astype(np.int64), hashes, checks.astype(np.uint64))


def _member(levels: Levels, level: int, hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes), bool)
    for shard, at in common.by_shard(hashes, levels.bits):
        held = arrays.load(levels.folder, f"hash{level}-{shard}")
        if held is not None:
            out[at] = common.is_member(hashes[at], held)
    return out


def _smallest(levels: Levels, level: int, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a window repeats, and the smallest id of a document it starts in."""
    found, first = np.zeros(len(hashes), bool), np.full(len(hashes), _NO_ID)
    by = common.order(hashes)  # look-ups go forward through the array
    ordered = hashes[by]
    for shard, part in common.shard_slices(ordered, levels.bits):
        held = arrays.load(levels.folder, f"hash{level}-{shard}")
        if held is None or not len(held):
            continue
        check, ids = (arrays.load(levels.folder, f"{name}{level}-{shard}") for name in ("check", "first"))
        place = np.searchsorted(held, ordered[part])
        place[place == len(held)] = 0
        there = np.flatnonzero(held[place] == ordered[part])
        at, place = by[part][there], place[there]
        while len(at):  # two windows may share the first 64 bits
            same = check[place] == checks[at]
            found[at[same]] = True
            first[at[same]] = ids[place[same]]
            at, place = at[~same], place[~same] + 1
            more = place < len(held)
            more[more] = held[place[more]] == hashes[at[more]]
            at, place = at[more], place[more]
    return found, first


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Texts, list[pa.RecordBatch]]]:
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("__text").nbytes
        if size >= FLUSH_BYTES:
            yield _texts(held), held
            held, size = [], 0
    if held:
        yield _texts(held), held


def _texts(held: list[pa.RecordBatch]) -> _Texts:
    ids = np.concatenate([b.column("__id").fill_null(_NO_ID).to_numpy(zero_copy_only=False) for b in held])
    return _Texts(ids, [b.column("__text") for b in held])


def _as_batch(shard: int, parts: list[bytes]) -> pa.RecordBatch:
    parts = [*parts, *[b""] * (4 - len(parts))]
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)],
                                      ["shard", "b0", "b1", "b2", "b3"])


def _anchor_reducer(folder: str):
    def reduce(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Anchors that several tasks, or several documents of one task, hold."""
        seen = common.unblob(table.column("b0"), np.uint64)
        often = common.unblob(table.column("b1"), np.uint8)
        both = np.sort(np.concatenate([seen, seen[often > 0]]))
        firsts = common.runs(both)
        kept = both[firsts][np.diff(np.append(firsts, len(both))) > 1]
        arrays.save(folder, f"hash0-{key[0].as_py()}", kept)
        return pa.table({"n": pa.array([len(kept)], pa.int64())})

    return reduce


def _window_reducer(folder: str, level: int):
    def reduce(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Windows that start in documents of different ids, with the smallest id."""
        h, c = common.unblob(table.column("b0"), np.uint64), common.unblob(table.column("b1"), np.uint32)
        low, high = common.unblob(table.column("b2"), np.int64), common.unblob(table.column("b3"), np.int64)
        h, c, low, high = _merged(h, c, low, high)
        kept, shard = low < high, key[0].as_py()
        for name, values in (("hash", h), ("check", c), ("first", low)):
            arrays.save(folder, f"{name}{level}-{shard}", values[kept])
        return pa.table({"n": pa.array([int(kept.sum())], pa.int64())})

    return reduce


def _merged(h: np.ndarray, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    by = common.order(h)
    if not len(h):
        return h, c, low, high
    same = h[by[1:]] == h[by[:-1]]
    if (c[by[1:]] != c[by[:-1]])[same].any():  # windows that share 64 bits and are told apart by the others
        by = np.lexsort((c, h))
    h, c, low, high = h[by], c[by], low[by], high[by]
    firsts = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
    return h[firsts], c[firsts], np.minimum.reduceat(low, firsts), np.maximum.reduceat(high, firsts)


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 13, longest: int | None = None) -> Levels:
    """Count the windows of ``min_words`` words, then of twice that, and so on up to ``longest`` (None: until none survives)."""
    if min_words < 2:
        raise ValueError("a window has two words at least")
    spark = common.prepared(docs.sparkSession)
    bits, folder = common.shard_bits(docs, text), scratch_path(spark, "windows")
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), common.text_bytes(text).alias("__text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, _ in _flushes(batches):
            inside = texts.inside(min_words)
            least, doc = texts.anchors(min_words)[inside], texts.doc[: len(inside)][inside]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
            ordered = np.sort(least[new])
            firsts = common.runs(ordered)
            often = np.diff(np.append(firsts, len(ordered))) > 1
            ordered = ordered[firsts]
            for shard, part in common.shard_slices(ordered, bits):
                yield _as_batch(shard, common.blob(ordered[part], often[part].astype(np.uint8)))

    def wanted(levels: Levels):
        return lambda batches: (batch for texts, _ in _flushes(batches) for batch in texts.wanted(levels).shuffled(bits))

    def repeated(levels: Levels):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for texts, _ in _flushes(batches):
                yield from _next(levels, 1, texts.wanted(levels))[0].as_rows()

        return run

    def doubled(levels: Levels, level: int):
        return lambda batches: (batch for windows in _left(batches) for batch in _next(levels, level, windows)[0].as_rows())

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for windows in _left(batches):
            yield from windows.shuffled(bits)

    lengths = [(min_words + 1) // 2]
    left = _total(rows.mapInArrow(anchors, _ROW).groupBy("shard").applyInArrow(_anchor_reducer(folder), "n long"))
    length, windows, at = min_words, None, None
    while left and (longest is None or length <= max(longest, min_words)):
        level, levels, before = len(lengths), Levels(folder, bits, (*lengths, length)), at
        if level == 2:
            windows, at = common.written_lean(rows.mapInArrow(repeated(levels), _LEFT), "windows2")
        elif level > 2:
            windows, at = common.written_lean(windows.mapInArrow(doubled(levels, level - 1), _LEFT), f"windows{level}")
        if before is not None:
            remove(spark, before)
        found = rows.mapInArrow(wanted(levels), _ROW) if level == 1 else windows.mapInArrow(tried, _ROW)
        left = _total(found.groupBy("shard").applyInArrow(_window_reducer(folder, level), "n long"))
        lengths.append(length)
        length *= 2
    if at is not None:
        remove(spark, at)
    if len(lengths) == 1:
        lengths.append(min_words)  # nothing repeats; the arrays of this length are absent
    return Levels(folder, bits, tuple(lengths))


def _next(levels: Levels, level: int, windows: _Windows) -> tuple[_Windows, np.ndarray, np.ndarray]:
    """The windows of the next level; which of this level repeat, and the smallest id they start in."""
    found, first = _smallest(levels, level, windows.hashes, windows.checks)
    return windows.doubled(found, levels.lengths[level]), found, first


def _total(counts: DataFrame) -> int:
    """The sum of the counts of the shards; the shuffle that made them is done with then."""
    counts, _ = common.written_lean(counts, "counts")
    return counts.agg(F.sum("n").alias("n")).first()["n"] or 0


def remove_repeats(docs: DataFrame, levels: Levels, doc_id: str = "doc_id", text: str = "text", keep: list[str | Column] = (), with_text: bool = True) -> DataFrame:
    """Per row: words, words removed, the longest counted length at which a window of it repeats an earlier
    document (0: none), the SHA-256 of the kept words joined by one space, and (``with_text``) these words."""
    common.prepared(docs.sparkSession)
    rows = docs.select(*keep, F.col(doc_id).cast("long").alias("__id"), common.text_bytes(text).alias("__text"))
    kept = rows.drop("__id", "__text").schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    fields += ["n_words long", "n_removed long", "longest_repeat long", "kept_sha256 string"]
    fields += ["kept_text string"] if with_text else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, held in _flushes(batches):
            gone, longest = np.zeros(len(texts.words) + 1, np.int64), np.zeros(len(texts.ids), np.int64)
            windows = texts.wanted(levels)
            for level, length in enumerate(levels.lengths[1:], 1):
                doc, places = windows.doc, windows.places
                windows, _, first = _next(levels, level, windows)
                later = (first < texts.ids[doc]) & (texts.ids[doc] != _NO_ID)
                if level == 1:
                    begins = places[later] + texts.firsts[doc[later]]
                    np.add.at(gone, begins, 1)
                    np.add.at(gone, begins + length, -1)
                longest[doc[later]] = length
            stays = np.cumsum(gone)[:-1] == 0
            n_words = np.diff(texts.firsts)
            before = np.concatenate([[0], np.cumsum(~stays)])
            n_removed = before[texts.firsts[1:]] - before[texts.firsts[:-1]]
            data, sums, out = texts.data.tobytes(), [], []
            for i in range(len(texts.ids)):
                span = slice(texts.firsts[i], texts.firsts[i + 1])
                at = np.flatnonzero(stays[span]) + texts.firsts[i]
                words = b" ".join([data[s:e] for s, e in zip(texts.starts[at].tolist(), texts.ends[at].tolist())])
                sums.append(hashlib.sha256(words).hexdigest())
                if with_text:
                    out.append(words)
            carried = pa.Table.from_batches([b.drop_columns(["__id", "__text"]) for b in held]).combine_chunks()
            columns = [pa.array(n_words.astype(np.int64)), pa.array(n_removed.astype(np.int64)), pa.array(longest), pa.array(sums)]
            names = [*carried.column_names, "n_words", "n_removed", "longest_repeat", "kept_sha256"]
            if with_text:
                columns.append(pa.array(out, pa.binary()).cast(pa.string()))
                names.append("kept_text")
            yield from pa.Table.from_arrays([*carried.columns, *columns], names).to_batches()

    return rows.mapInArrow(run, ", ".join(fields))
