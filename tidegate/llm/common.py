"""What several operators share: bytes of texts, words and their hashes, blobs dealt to shards."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Documents handed to Python at a time; a batch of the longest documents stays within tens of MB.
BATCH_DOCS = 256
#: Text bytes per shard of a table that is built in shards; one shard is one group in a reducer.
SHARD_BYTES = 6_000_000

# The white space of the word definition, multipliers of SplitMix64.
SPACES = b"\t\n\x0b\x0c\r "
MIX1, MIX2, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = bytes(range(256)).lower()
_BYTE = np.random.default_rng(20_240_229).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95
_WORD_BLOCK = 1 << 15  # bytes, or words, that are hashed at a time: what lies between stays in the cache
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches (a batch is bounded by documents, and documents can be long).

    Workers look for this package where the driver found it; on a cluster it is
    installed there or sent with ``--py-files``.
    """
    path = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in path:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, path)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_DOCS)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written_lean(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows from a fresh folder below the shared one, and the folder; the shuffles that made them are removed once
    they are written."""
    spark, setting = rows.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        rows.write.parquet(at := scratch_path(spark, name))
    finally:
        spark.conf.set(setting, before)
    return spark.read.parquet(at), at


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def text_bytes(text: str = "text") -> Column:
    """The text as UTF-8; null as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def shard_bits(df: DataFrame, text: str = "text", shard_bytes: int = SHARD_BYTES) -> int:
    """Bits of a shard number so that a shard is made from about ``shard_bytes`` of text."""
    total = df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(1, math.ceil(math.log2(max(1.0, total / shard_bytes))))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: every input bit reaches every output bit."""
    h = h + GOLDEN
    h ^= h >> np.uint64(30)
    h *= MIX1
    h ^= h >> np.uint64(27)
    h *= MIX2
    h ^= h >> np.uint64(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and the offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width, len(column) + 1, column.offset * np.dtype(width).itemsize)
    offsets = offsets.astype(np.int64)
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word (one more at the end)."""
    n = len(data)
    solid = np.zeros(n + 1, bool)
    solid[:n] = (data != 32) & (data - np.uint8(9) > 4)  # 9 to 13 and 32 are white space
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = solid[:n].copy()
    starts[1:] &= ~solid[: n - 1] | first[1:n]
    ends = solid[:n] & (~solid[1:] | first[1:])
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def _power_tables(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, _WORD_BLOCK)
        both = []
        for factor in (base, pow(base, -1, 2**64)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            both.append(np.cumprod(table, dtype=np.uint64))
        _powers[base] = both[0], both[1]
    return _powers[base]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``: polynomials over random byte values, mixed."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        origin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, origin + _WORD_BLOCK, side="right")))
        size = int(ends[j - 1] - origin)
        up, down = _power_tables(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[origin : origin + size]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - origin, ends[i:j] - origin
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def _window_sums(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """For every run of ``length`` words their polynomial, from sums up to its ends: a run costs the same at any length."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = int(mix(np.full(1, seed, np.uint64))[0]) | 1
    out = np.empty(n, np.uint64)
    step = max(_WORD_BLOCK, 4 * length)
    up, down = _power_tables(step + length, factor)
    for i in range(0, n, step):
        own = words[i : i + step + length - 1]
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * up[: len(own)], out=sums[1:])
        total = sums[length:] - sums[:-length]
        total *= down[: len(total)]
        out[i : i + step] = total
    return out


def window_hashes(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every run of ``length`` words; the last ``length - 1`` starts have none."""
    return mix(_window_sums(words, length, seed))


def window_hashes_at(words: np.ndarray, length: int, places: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words that start at some places."""
    return mix(_window_sums(words, length, seed)[places])


def is_member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values stand in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def runs(ordered: np.ndarray) -> np.ndarray:
    """First index of every run of equal values."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def order(values: np.ndarray) -> np.ndarray:
    """``argsort`` of unsigned 64-bit values, equal ones as they stand: sorted with their places in the lowest bits, which is
    several times as fast.  The bits that make room are compared afterwards, in what is then almost sorted."""
    n = len(values)
    if n < 2:
        return np.arange(n)
    places = (1 << (n - 1).bit_length()) - 1
    free = 64 - int(values.max()).bit_length()
    packed = (values << np.uint64(free)) & np.uint64(~places & 0xFFFFFFFFFFFFFFFF)
    packed |= np.arange(n, dtype=np.uint64)
    packed.sort()
    by = (packed & np.uint64(places)).astype(np.int64)
    ordered = values[by]
    return by[np.argsort(ordered, kind="stable")] if (ordered[1:] < ordered[:-1]).any() else by


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unsigned 64-bit values: the first place of every distinct one, in their order; for every value which it is; how often each stands there."""
    by = order(values)
    firsts = runs(values[by])
    counts = np.diff(np.append(firsts, len(by)))
    which = np.empty(len(by), np.int64)
    which[by] = np.repeat(np.arange(len(firsts)), counts)
    return by[firsts], which, counts


def shard_slices(ordered: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted hashes by their top bits."""
    shard = (ordered >> np.uint64(64 - bits)).astype(np.int64)
    firsts = runs(shard)
    for a, b in zip(firsts, [*firsts[1:], len(ordered)]):
        yield int(shard[a]), slice(int(a), int(b))


def by_shard(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the hashes of each shard."""
    shard = hashes >> np.uint64(64 - bits)
    by = np.argsort(shard.astype(np.uint16) if bits <= 16 else shard, kind="stable")  # radix sort of short numbers
    shard = shard[by]
    firsts = runs(shard)
    for a, b in zip(firsts, [*firsts[1:], len(by)]):
        yield int(shard[a]), by[a:b]


def blob(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def unblob(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """All values of a binary column, one after the other."""
    parts = [np.frombuffer(x.as_buffer(), dtype) for c in column.chunks for x in c if x.is_valid and len(x.as_buffer())]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)
