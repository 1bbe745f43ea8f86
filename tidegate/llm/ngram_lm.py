"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and looked up in mapped hash arrays.

A tally task pre-counts the n-grams of a few million tokens, deals them to shards by
their context, and one reducer per shard adds them up, writes tables of its n-grams with their counts and of its
contexts with their figures to the shared folder, and passes what the next lower order
needs: for every n-gram without its first word in how many n-grams it continues, and
for every context its total and how many of its followers were seen once, twice, more
often.  The texts are read ``PASSES`` times, each time for a part of the shards, and every order is a job of its own
whose shuffle goes when it is written: the disk holds a part of the n-grams on their way at a time, and the model.  Contexts so frequent that one shard would get a large part of all tokens are
dealt by the whole n-gram instead, and only their figures are added up by another shuffle.
In the shuffle a frequent word is its rank and a rare one its hash; ranks, counts and
sizes are as narrow as their largest value and compressed by byte planes.  Scoring
workers map the arrays into memory.  Words, contexts and n-grams are 64-bit hashes; a table
holds 32 bits of each in buckets by the bits before these, one or two to a bucket, so that a look-up reads one place.

Texts are bytes; A-Z is lower-cased.  Null texts are empty, an empty text has the one
token ``end``.  Repeated rows count as often as they stand there.  An empty training
table gives every token the uniform probability over the unknown word alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import arrays, common
from tidegate.session import scratch_path
from tidegate.sources.storage import remove

#: Tokens that a tally task counts before it hands them on, and that a scoring task looks up together.
TALLY_TOKENS = 2_000_000
SCORE_TOKENS = 1_000_000
#: A context that makes up this part of a task's tokens may be dealt over all shards.
HOT_SHARE = 1 / 1024
_HOT_STEP = 8  # contexts and words are weighed on every eighth token; they only decide where rows go and how they are written
#: A word that makes up this part of all tokens is written as its rank in the shuffle; at most 1 / share of them.
RANKED_SHARE = 1 / (1 << 20)
#: Times the texts are read to be counted, each time for a part of the shards.
PASSES = 2

_START = common.mix(np.full(1, 11, np.uint64))[0]
_END = common.mix(np.full(1, 13, np.uint64))[0]
_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)
_ROW = "shard int, kind int, b0 binary, b1 binary, b2 binary, b3 binary, b4 binary, b5 binary"
_GRAMS, _CONTEXTS, _STATS = 0, 1, 2
_FIGURES = 6  # per order: n-grams counted once, twice, three and four times; n-grams; their total


@dataclass(frozen=True)
class Model:
    """Where the arrays lie and what the formulas need besides them."""

    folder: str
    order: int
    bits: int
    hot: np.ndarray
    discounts: tuple[tuple[float, float, float], ...]
    tokens: int
    vocabulary: int
    unigram_total: int
    unigram_rest: float


def _key(words: np.ndarray) -> np.ndarray:
    """One hash for every row of a matrix of word hashes."""
    total = np.zeros(len(words), np.uint64)
    for column in words.T:
        total = total * _FACTOR + column
    return total


def _keys(sequence: np.ndarray, words: int) -> np.ndarray:
    """The hash of the words that end at every place of a sequence; too few stand before the first places, which mean nothing."""
    key = sequence
    for _ in range(words - 1):
        key = np.roll(key, 1) * _FACTOR + sequence
    return key


def _is_hot(context: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which contexts are hot ones, of which there are few: only those that share 16 bits with one are compared."""
    out = np.zeros(len(context), bool)
    if len(hot):
        alike = np.zeros(1 << 16, bool)
        alike[hot >> np.uint64(48)] = True
        maybe = np.flatnonzero(alike[context >> np.uint64(48)])
        out[maybe] = common.is_member(context[maybe], hot)
    return out


def _route(context: np.ndarray, key: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The hash by which an n-gram finds its shard."""
    dealt = np.flatnonzero(_is_hot(context, hot))
    if len(dealt):
        context = context.copy()
        context[dealt] = common.mix(key[dealt])
    return context


def _sequences(batch: pa.RecordBatch, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with ``order - 1`` starts before and one end after each text; tokens of each text."""
    data, offsets = common.buffers(batch.column("__text"))
    data = np.frombuffer(data.tobytes().translate(common.LOWER), np.uint8)
    starts, ends, firsts = common.word_spans(data, offsets)
    words = common.word_hashes(data, starts, ends)
    tokens = np.diff(firsts) + 1
    out = np.full(len(words) + len(tokens) * order, _START, np.uint64)
    lasts = np.cumsum(tokens + order - 1) - 1
    out[lasts] = _END
    place = np.arange(len(words)) + np.repeat(np.arange(len(tokens)) * order + order - 1, tokens - 1)
    out[place] = words
    return out, tokens


def _predicted(tokens: np.ndarray, order: int) -> np.ndarray:
    """Places of the tokens that are predicted."""
    return np.arange(int(tokens.sum())) + np.repeat(np.arange(1, len(tokens) + 1) * (order - 1), tokens)


def _flushes(batches: Iterator[pa.RecordBatch], order: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Sequences of several batches, together about ``most`` tokens; the batches."""
    sequences, tokens, held, size = [], [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        s, t = _sequences(batch, order)
        sequences.append(s)
        tokens.append(t)
        held.append(batch.drop_columns(["__text"]))
        size += len(s)
        if size >= most:
            yield np.concatenate(sequences), np.concatenate(tokens), held
            sequences, tokens, held, size = [], [], [], 0
    if held:
        yield np.concatenate(sequences), np.concatenate(tokens), held


def _ranked(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every word as the rank of its hash among the distinct ones; the distinct ones in order."""
    one, which, _ = common.distinct(sequence)
    return which.view(np.uint64), sequence[one]


def _numbered(sequence: np.ndarray, frequent: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every word as a number by its rank, rare ones last; the distinct words in that order, and their ranks."""
    numbers, words = _ranked(sequence)
    ranks = frequent.of(words)
    by = common.order(ranks.view(np.uint64))
    number = np.empty(len(by), np.uint64)
    number[by] = np.arange(len(by), dtype=np.uint64)
    return number[numbers.view(np.int64)], words[by], ranks[by]


def _distinct_grams(sequence: np.ndarray, places: np.ndarray, order: int, frequent: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams that end at the places, as a matrix of word hashes and one of ranks, in the order of ranks; their counts."""
    numbers, words, ranks = _numbered(sequence, frequent)
    code = numbers[places - order + 1]
    levels = []
    for back in range(order - 2, 0, -1):  # for three words and more, the context so far becomes one number
        code, seen = _ranked((code << np.uint64(32)) | numbers[places - back])
        levels.append(seen)
    pairs = np.sort((code << np.uint64(32)) | numbers[places])
    firsts = common.runs(pairs)
    counts = np.diff(np.append(firsts, len(pairs)))
    left, columns = pairs[firsts], []
    for seen in [None, *reversed(levels)]:
        left = left if seen is None else seen[left.astype(np.int64)]
        columns.append((left & np.uint64(0xFFFFFFFF)).astype(np.int64))
        left = left >> np.uint64(32)
    columns.append(left.astype(np.int64))
    own = np.stack(columns[::-1], axis=1)
    return words[own], ranks[own], counts


def _places_of(part: int, sequence: np.ndarray, places: np.ndarray, order: int, hot: np.ndarray, bits: int) -> np.ndarray:
    """The places whose n-grams go to the shards of one part."""
    context = _keys(sequence, order - 1)[places - 1]
    route = _route(context, context * _FACTOR + sequence[places], hot)
    return places[(route >> np.uint64(64 - bits)) % np.uint64(PASSES) == part]


def _packed(values: np.ndarray) -> bytes:
    """Unsigned integers, as narrow as the largest one allows, by byte planes and compressed."""
    narrow = _small(np.ascontiguousarray(values))
    width = narrow.dtype.itemsize
    raw = bytes([width]) + narrow.view(np.uint8).reshape(len(narrow), width).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(cell: pa.Scalar) -> np.ndarray:
    data = cell.as_py()
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{raw[0]}").astype(np.uint64)


@dataclass
class _Ranks:
    """Frequent words, the most frequent first; a rare word has the rank after the last."""

    words: np.ndarray

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words in order, an end behind them; their ranks; by the top bits of a word, where the ones with these bits begin."""
        by = np.argsort(self.words)
        bits = max(1, len(by).bit_length() + 1)
        begins = np.searchsorted(self.words[by], np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        return np.append(self.words[by], np.uint64(0xFFFFFFFFFFFFFFFF)), np.append(by, len(by)), begins

    def __getstate__(self) -> dict:
        return {"words": self.words}

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(words.shape, np.int64)
        ordered, by, begins = self._sorted
        flat = words.reshape(-1)
        at = begins[(flat >> np.uint64(65 - len(begins).bit_length())).astype(np.int64)]
        behind = np.flatnonzero(ordered[at] < flat)
        while len(behind):  # few words share their top bits
            at[behind] += 1
            behind = behind[ordered[at[behind]] < flat[behind]]
        return np.where(ordered[at] == flat, by[at], len(self.words)).reshape(words.shape)

    def back(self, ranks: np.ndarray, rare: np.ndarray) -> np.ndarray:
        out = np.append(self.words, np.uint64(0))[ranks.astype(np.int64)]
        out[ranks == len(self.words)] = rare
        return out


def _gram_rows(grams: np.ndarray, ranks: np.ndarray, counts: np.ndarray, raw: np.ndarray, hot: np.ndarray, frequent: _Ranks,
               bits: int) -> Iterator[dict]:
    """Blobs per shard of n-grams that come in the order of their ranks.  A context is written once for all its followers
    that stand together."""
    if grams.shape[1] > 1:
        context = _key(grams[:, :-1])
        route = _route(context, context * _FACTOR + grams[:, -1], hot)
    else:  # single words have no context, and are looked up by their own hash
        route = grams[:, 0]
    for shard, by in common.by_shard(route, bits):
        own, rank = grams.take(by, axis=0), ranks.take(by, axis=0)
        new = np.full(len(own), own.shape[1] == 1)
        new[0] = True
        for column in own[:, :-1].T:
            new[1:] |= column[1:] != column[:-1]
        firsts = np.flatnonzero(new)
        size = np.diff(np.append(firsts, len(own)))
        before, word = rank[firsts, :-1].T.reshape(-1), rank[:, -1]
        hashes = np.concatenate([own[firsts, :-1].T.reshape(-1), own[:, -1]])
        yield {"shard": shard, "kind": _GRAMS, "b0": _packed(before), "b1": _packed(size), "b2": _packed(word), "b3": _packed(counts[by]),
               "b4": _packed(raw[by]), "b5": hashes[np.concatenate([before, word]) == len(frequent.words)].tobytes()}


def _by_ranks(ranks: np.ndarray, most: int) -> np.ndarray:
    """The order of rows of ranks up to ``most``."""
    width = most.bit_length()
    if width * ranks.shape[1] > 64:
        return np.lexsort(ranks.T[::-1])
    key = np.zeros(len(ranks), np.uint64)
    for column in ranks.T:
        key = (key << np.uint64(width)) | column.astype(np.uint64)
    return common.order(key)


def _read_grams(rows: pa.Table, level: int, frequent: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, counts and raw counts of rows made by ``_gram_rows``."""
    matrices, counts, raws = [np.zeros((0, level), np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for before, size, word, n, raw, rare in zip(*(rows.column(f"b{i}") for i in range(6))):
        before, size, word = _unpacked(before), _unpacked(size).astype(np.int64), _unpacked(word)
        words = frequent.back(np.concatenate([before, word]), np.frombuffer(rare.as_py(), np.uint64))
        context = words[: len(before)].reshape(level - 1, len(size)).T
        matrices.append(np.concatenate([np.repeat(context, size, axis=0), words[len(before) :, None]], axis=1))
        counts.append(_unpacked(n))
        raws.append(_unpacked(raw))
    return np.concatenate(matrices), np.concatenate(counts), np.concatenate(raws)


def _as_batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), *((f"b{i}", pa.binary()) for i in range(6))])
    return pa.RecordBatch.from_pylist(rows, schema)


def hot_contexts(docs: DataFrame, order: int) -> tuple[np.ndarray, _Ranks]:
    """Contexts that make up more than ``HOT_SHARE`` of all tokens, for every order, and words above ``RANKED_SHARE``;
    few by this definition."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sequence, tokens, _ in _flushes(batches, order, TALLY_TOKENS):
            places = _predicted(tokens, order)[::_HOT_STEP]
            out_key, out_n, out_words = [np.zeros(1, np.uint64)], [np.array([len(places)])], [0]  # key 0: all tokens
            for words in range(order):  # no word: the predicted one itself
                key = _key(np.stack([sequence[places - back] for back in range(words, 0, -1)], axis=1)) if words else sequence[places]
                seen, n = np.unique(key, return_counts=True)
                frequent = n >= max(2, len(places) * (HOT_SHARE if words else RANKED_SHARE))
                out_key.append(seen[frequent])
                out_n.append(n[frequent])
                out_words.append(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(out_words) > 0, [len(k) for k in out_key])),
                 pa.array(np.concatenate(out_key).view(np.int64)), pa.array(np.concatenate(out_n).astype(np.int64))], ["context", "key", "n"])

    sums = docs.mapInArrow(weigh, "context boolean, key long, n long").groupBy("context", "key").agg(F.sum("n").alias("n"))
    sums, at = common.written_lean(sums, "weights")  # read twice, weighed once
    # At most (order - 1) / share contexts and 1 / share words can pass; the sum is one row, so the join is with one row.
    total = sums.agg(F.max(F.when(F.col("key") == 0, F.col("n"))).alias("total")).first()["total"] or 0
    least = F.when(F.col("context"), total * HOT_SHARE).otherwise(total * RANKED_SHARE)
    found = sums.where((F.col("key") != 0) & (F.col("n") > least)).toPandas().sort_values(["n", "key"], ascending=[False, True])
    remove(docs.sparkSession, at)
    keys, context = found["key"].to_numpy(np.int64).view(np.uint64), found["context"].to_numpy(bool)
    return np.sort(keys[context]), _Ranks(np.append(_START, keys[~context & (keys != _START)]))


def _small(values: np.ndarray) -> np.ndarray:
    """Unsigned integers no wider than the largest one needs."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


_MANY = 255  # a number from here on stands in a list of its own
_STEP = 32  # runs of which the first one's begin is stored in full


def _keep_short(held: dict[str, np.ndarray], name: str, values: np.ndarray) -> None:
    """Numbers that are mostly small, a byte each."""
    many = np.flatnonzero(values >= _MANY)
    held[name] = np.minimum(values, _MANY).astype(np.uint8)
    if len(many):
        held |= {f"many{name}": _small(many), f"more{name}": _small(values[many])}


def _short_at(held: dict[str, np.ndarray], name: str, places: np.ndarray) -> np.ndarray:
    out = held[name][places].astype(np.int64)
    often = np.flatnonzero(out == _MANY)
    if len(often):
        out[often] = held[f"more{name}"][np.searchsorted(held[f"many{name}"], places[often])]
    return out


def _keep_runs(held: dict[str, np.ndarray], name: str, firsts: np.ndarray, total: int) -> None:
    """Where runs begin that lie one behind the other up to ``total``: the begin of every ``_STEP``-th, of the others how far behind that."""
    firsts = np.append(firsts, total)
    held[name] = _small(firsts - np.repeat(firsts[::_STEP], _STEP)[: len(firsts)])
    held[f"begin{name}"] = _small(firsts[::_STEP])


def _runs_at(held: dict[str, np.ndarray], name: str, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs at some places."""
    begins, behind = held[f"begin{name}"], held[name]
    low = begins[places // _STEP].astype(np.int64)
    low += behind[places]
    places = places + 1
    high = begins[places // _STEP].astype(np.int64)
    high += behind[places]
    return low, high


def _keep_table(held: dict[str, np.ndarray], name: str, keys: np.ndarray) -> None:
    """Sorted distinct hashes in buckets by their top bits, with the 32 bits that come next; one or two to a bucket."""
    bits = max(1, len(keys).bit_length() - 1)
    size = np.bincount((keys >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    _keep_runs(held, f"{name}bucket", np.cumsum(size) - size, len(keys))
    held[name] = _next_bits(keys, bits)


def _next_bits(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _find(held: dict[str, np.ndarray], name: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes stand in a table, and where."""
    stored, bits = held[name], (len(held[f"{name}bucket"]) - 1).bit_length() - 1
    low, high = _runs_at(held, f"{name}bucket", (keys >> np.uint64(64 - bits)).astype(np.int64))
    own = _next_bits(keys, bits)
    behind = np.flatnonzero((low < high) & (stored[np.minimum(low, len(stored) - 1)] < own))
    while len(behind):
        low[behind] += 1
        behind = behind[low[behind] < high[behind]]
        behind = behind[stored[low[behind]] < own[behind]]
    hit = np.flatnonzero(low < high)
    hit = hit[stored[low[hit]] == own[hit]]
    return hit, low[hit]


def _keep_figures(held: dict[str, np.ndarray], prefix: str, stats: np.ndarray) -> None:
    """The figures of contexts, of which most are alike: a number per context, small for frequent ones, and a table by number."""
    one, codes, n = common.distinct(_key(stats))
    by = np.argsort(-n, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    _keep_short(held, f"{prefix}followers", rank[codes])
    held[f"{prefix}figures"] = _small(stats[one[by]])


def _keep_grams(held: dict[str, np.ndarray], gram: np.ndarray, matrix: np.ndarray, n: np.ndarray, hot: np.ndarray,
                bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keep the n-grams of a shard, in the order of their hashes, and its contexts with their figures: total, followers seen
    once, twice, more often.  Hot contexts, of which this shard has a part, are not kept but given back with their figures."""
    _keep_table(held, "gram", gram)
    _keep_short(held, "count", n)
    context = _key(matrix[:, :-1])
    by = common.order(context)
    context, n = context[by], n[by]
    firsts = common.runs(context)
    stats = np.stack([np.add.reduceat(x, firsts, dtype=np.uint64) for x in (n, n == 1, n == 2, n > 2)], axis=1)
    context = context[firsts]
    shared = _is_hot(context, hot)
    if not shared.all():  # the others have the top bits of the shard in common
        _keep_table(held, "context", context[~shared] << np.uint64(bits))
        _keep_figures(held, "", stats[~shared])
    return context[shared], stats[shared]


def _tally_reducer(folder: str, level: int, order: int, hot: np.ndarray, frequent: _Ranks, bits: int):
    """Adds up a shard of n-grams of ``level`` words and writes it; yields the rows of the next lower level."""

    def reduce(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard, kinds = key[0].as_py(), table.column("kind").to_numpy()
        rows: list[dict] = []
        held: dict[str, np.ndarray] = {}
        figures = common.unblob(table.filter(pa.array(kinds == _STATS)).column("b0"), np.int64).reshape(-1, order, _FIGURES).sum(axis=0)

        seen = table.filter(pa.array(kinds == _CONTEXTS))
        context = common.unblob(seen.column("b0"), np.uint64)
        if len(context):
            stats = common.unblob(seen.column("b1"), np.uint64).reshape(-1, 4)
            by = common.order(context)
            firsts = common.runs(context[by])
            held["hotcontext"] = context[by][firsts]
            _keep_figures(held, "hot", np.add.reduceat(stats[by], firsts, axis=0))

        matrix, n, raw = _read_grams(table.filter(pa.array(kinds == _GRAMS)), level, frequent)
        if len(matrix):
            gram = _key(matrix)
            by = common.order(gram)
            gram = gram[by]
            firsts = common.runs(gram)
            gram, matrix = gram[firsts], matrix.take(by[firsts], axis=0)
            n, raw = np.add.reduceat(n[by], firsts), np.add.reduceat(raw[by], firsts)
            if level == 1:
                _keep_table(held, "gram", gram << np.uint64(bits))
                held |= {"count": _small(n), "raw": _small(raw)}
            figures[level - 1] += [*np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)[1:5], np.count_nonzero(n), int(n.sum())]
            if level == 1:
                rows.append({"shard": shard, "kind": _STATS, "b1": int(raw.sum()).to_bytes(8, "little")})
            else:
                rows += _lower(held, gram, matrix, n, raw, hot, frequent, bits)
        if held:
            arrays.save_together(folder, f"grams{level}-{shard}", held)
        rows.append({"shard": shard, "kind": _STATS, "b0": figures.astype(np.int64).tobytes()})
        return pa.Table.from_batches([_as_batch(rows)])

    return reduce


def _lower(held: dict[str, np.ndarray], gram: np.ndarray, matrix: np.ndarray, n: np.ndarray, raw: np.ndarray, hot: np.ndarray, frequent: _Ranks,
           bits: int) -> list[dict]:
    """Keep the n-grams of a shard.  Rows of the next lower level: continuation counts of the n-grams without their first
    word, and the figures of the contexts that other shards hold too."""
    context, stats = _keep_grams(held, gram, matrix, n, hot, bits)
    rows = [{"shard": to, "kind": _CONTEXTS, "b0": context[part].tobytes(), "b1": stats[part].tobytes()}
            for to, part in common.shard_slices(context, bits)]
    suffix = _key(matrix[:, 1:])
    by = common.order(suffix)
    firsts = common.runs(suffix[by])
    continued = np.diff(np.append(firsts, len(by)))
    lower, raw = matrix[:, 1:].take(by[firsts], axis=0), np.add.reduceat(raw[by], firsts)
    ranks = frequent.of(lower)
    by = _by_ranks(ranks, len(frequent.words))
    rows += _gram_rows(lower.take(by, axis=0), ranks.take(by, axis=0), continued[by], raw[by], hot, frequent, bits)
    return rows


def train(docs: DataFrame, order: int = 2, text: str = "text") -> Model:
    """Count the n-grams of all texts of ``docs`` and store the model in the shared folder."""
    if order < 2:
        raise ValueError("a model interpolates at least two orders")
    spark = common.prepared(docs.sparkSession)
    bits = common.shard_bits(docs, text)
    texts = docs.select(common.text_bytes(text).alias("__text"))
    hot, frequent = hot_contexts(texts, order)
    folder = scratch_path(spark, "ngrams")

    def tally(part: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for sequence, tokens, _ in _flushes(batches, order, TALLY_TOKENS):
                own = _places_of(part, sequence, _predicted(tokens, order), order, hot, bits)
                if len(own):
                    grams, ranks, counts = _distinct_grams(sequence, own, order, frequent)
                    for row in _gram_rows(grams, ranks, counts, counts, hot, frequent, bits):
                        yield _as_batch([row])

        return run

    levels, done = [texts.mapInArrow(tally(part), _ROW) for part in range(PASSES)], []
    for words in range(order, 0, -1):
        reducer = _tally_reducer(folder, words, order, hot, frequent, bits)
        found = [common.written_lean(rows.groupBy("shard").applyInArrow(reducer, _ROW), f"grams{words}") for rows in levels]
        for at in done:  # counted and written
            remove(spark, at)
        level, done = reduce(DataFrame.unionByName, [rows for rows, _ in found]), [at for _, at in found]
        levels = [level.where(F.pmod("shard", F.lit(2 * PASSES)) == part) for part in range(2 * PASSES)]  # a part of the shuffle at a time
    figures, tokens = np.zeros((order, _FIGURES), np.int64), 0
    for row in level.select("b0", "b1").toLocalIterator():  # one short row per shard
        if row["b1"] is not None:
            tokens += int.from_bytes(row["b1"], "little")
        else:
            figures += np.frombuffer(bytes(row["b0"]), np.int64).reshape(order, _FIGURES)
    discounts = tuple(_discounts(*figures[k, :4].tolist()) for k in range(order))
    once, twice, _, _, vocabulary, total = figures[0].tolist()
    taken = np.dot(discounts[0], [once, twice, vocabulary - once - twice])
    rest = float(taken) / total if total else 1.0
    return Model(folder, order, bits, hot, discounts, tokens, vocabulary, total, rest)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken from counts of one, two, three and more (Chen and Goodman); half a count where they can't be told."""
    if not (n1 and n2 and n3):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < most else most / 2 for d, most in zip(found, (1, 2, 3)))


def _singles(model: Model, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Continuation counts and counts in training of single words; zero for unknown ones."""
    n, raw = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    for shard, wanted in common.by_shard(key, model.bits):
        held = arrays.load_together(model.folder, f"grams1-{shard}")
        if held is None or "gram" not in held:
            continue
        hit, at = _find(held, "gram", key[wanted] << np.uint64(model.bits))
        n[wanted[hit]], raw[wanted[hit]] = held["count"][at], held["raw"][at]
    return n, raw


def _counts(model: Model, level: int, context: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Counts of n-grams by the hashes of their context and of the whole."""
    out = np.zeros(len(gram), np.int64)
    for shard, wanted in common.by_shard(_route(context, gram, model.hot), model.bits):
        held = arrays.load_together(model.folder, f"grams{level}-{shard}")
        if held is None or "gram" not in held:
            continue
        hit, at = _find(held, "gram", gram[wanted])
        out[wanted[hit]] = _short_at(held, "count", at)
    return out


def _followers(model: Model, level: int, context: np.ndarray) -> np.ndarray:
    """The figures of distinct contexts: total, followers seen once, twice, more often."""
    out = np.zeros((len(context), 4), np.int64)
    hot = _is_hot(context, model.hot)
    own = np.flatnonzero(~hot)
    for shard, wanted in common.by_shard(context[own], model.bits):
        held = arrays.load_together(model.folder, f"grams{level}-{shard}")
        if held is None or "context" not in held:
            continue
        wanted = own[wanted]
        hit, at = _find(held, "context", context[wanted] << np.uint64(model.bits))
        out[wanted[hit]] = held["figures"][_short_at(held, "followers", at)]
    own = np.flatnonzero(hot)
    for shard, wanted in common.by_shard(context[own], model.bits):
        held = arrays.load_together(model.folder, f"grams{level - 1}-{shard}")  # hot contexts are added up one job later
        if held is None or "hotcontext" not in held:
            continue
        wanted, contexts = own[wanted], held["hotcontext"]
        at = np.minimum(np.searchsorted(contexts, context[wanted]), len(contexts) - 1)
        hit = contexts[at] == context[wanted]
        out[wanted[hit]] = held["hotfigures"][_short_at(held, "hotfollowers", at[hit])]
    return out


def _discounted(model: Model, level: int, n: np.ndarray) -> np.ndarray:
    taken = np.array([0.0, *model.discounts[level - 1]])
    return np.maximum(n - taken[np.minimum(n, 3)], 0.0)


def _probabilities(model: Model, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Model probability of every word of a sequence after those before it, and that word's count in training.

    The first ``order - 1`` have too few before them and mean nothing.  Words and n-grams below the highest order are
    looked up once each, in the order in which they are stored, and again as the contexts of the next order.
    """
    one, which, _ = common.distinct(sequence)
    key, own = sequence, sequence[one]
    n, raw = _singles(model, own)
    single = model.unigram_rest / (model.vocabulary + 1)
    single = single + (_discounted(model, 1, n) / model.unigram_total if model.unigram_total else 0.0)
    p, raw = np.broadcast_to(single, one.shape)[which], raw[which]
    for level in range(2, model.order + 1):
        followers = _followers(model, level, own)
        total = followers[:, 0]
        kept = sum(n * d for n, d in zip(followers[:, 1:].T, model.discounts[level - 1]))
        kept = np.where(total > 0, kept / np.maximum(total, 1), 1.0)
        before, context = np.roll(which, 1), np.roll(key, 1)  # a word's context ends at the word before
        key = context * _FACTOR + sequence
        if level < model.order:
            one, which, _ = common.distinct(key)
            own = key[one]
            n = _counts(model, level, context[one], own)[which]
        else:
            n = _counts(model, level, context, key)
        p = _discounted(model, level, n) / np.maximum(total, 1)[before] + kept[before] * p
    return p, raw


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str | Column] = ()) -> DataFrame:
    """Per row of ``docs``: tokens, known tokens, log10 probability under the model and under the unigram base.

    ``keep`` names the columns of ``docs`` that the result carries besides.
    """
    common.prepared(docs.sparkSession)
    rows = docs.select(*keep, common.text_bytes(text).alias("__text"))
    kept = rows.drop("__text").schema
    order, out = model.order, "n_tokens long, n_known long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sequence, tokens, held in _flushes(batches, order, SCORE_TOKENS):
            places = _predicted(tokens, order)
            p, raw = (x[places] for x in _probabilities(model, sequence))
            firsts = np.cumsum(tokens) - tokens
            base = np.log10((raw + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))
            columns = [pa.array(tokens.astype(np.int64))]
            for values, kind in ((raw > 0, np.int64), (base, np.float64), (np.log10(p), np.float64)):
                columns.append(pa.array(np.add.reduceat(values.astype(kind), firsts)))
            carried = pa.Table.from_batches(held).combine_chunks()
            names = [*carried.column_names, "n_tokens", "n_known", "base_score", "score"]
            yield from pa.Table.from_arrays([*carried.columns, *columns], names).to_batches()

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), out])
    return rows.mapInArrow(run, fields)
