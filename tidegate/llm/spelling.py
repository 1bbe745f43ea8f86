"""Words that are one letter apart, and the usual form of each, by a bit-sliced index over positions.

The vocabulary of a block is a row of bits, a word per bit, the most frequent first.  For every
position and letter one set of bits says which words have that letter there.  A word is looked
up by going along its letters with two kinds of sets: the words that agree so far without an
error, and those that agree with exactly one, kept apart by what the error was, as it shifts the
position that is compared next: a replaced letter by none, a letter more by one to the right, a
letter less by one to the left.  All are updated a machine word at a time, for many words looked
up at once.  The near words are what is left at the end with the right length, the nearest
form is the lowest bit, their number the count of bits.

Words within one error share their first or their last letters: with a shorter length of L the
first or the last half of L - 1.  So a word is put into blocks by up to ``KEY_LETTERS`` of
these letters, for pairs with its own length as the shorter one and for pairs with one less.  A pair that a
block of first letters holds is left out where the last letters agree too (the set without an error
after the first letters is taken away).  A block above ``SLICE`` words is cut into slices, and every
slice meets every other: all of its words are looked up, whatever a block's size.

Runs of letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z is lower-cased.  Null and empty texts have
no runs.  A null id is the empty text.  Repeated rows count as often as they stand there.  Ties go to
the smaller word in code-point order.  An empty table, or one without a word often enough, gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common
from tidegate.llm.running import written

#: Letters of a block's key at most; words of a slice of a block; distinct words a counting task holds at a time.
KEY_LETTERS, SLICE, TALLY = 3, 16_384, 400_000
#: Characters of a text that are cut into runs at a time, and cells of a set of bits that many looked-up words share.
PIECE, CELLS = 1 << 22, 1 << 18
MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2

# Letters of a run, and which runs lose a letter.
_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")
_EVERY = 97


def _runs(text: str) -> Iterator[list[str]]:
    """The runs of a text, some millions of characters at a time; no run is cut."""
    start = 0
    while len(text) - start > PIECE:
        gap = _OTHER.search(text, start + PIECE)
        end = gap.start() if gap else len(text)
        yield _RUN.findall(text, start, end)
        start = end
    yield _RUN.findall(text, start)


def tally(doc_id: str, text: bytes, counts: Counter, min_letters: int = MIN_LETTERS) -> None:
    """Add the words of a document; of one run in ``_EVERY``, by its checksum with the id, one letter is left out."""
    low = text.translate(common.LOWER).decode()
    before = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    for runs in _runs(low):
        found.update(runs)
    for word, n in found.items():
        if len(word) < min_letters:
            continue
        h = zlib.crc32(word.encode(), before)
        if h % _EVERY == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < min_letters:
                continue
        counts[word] += n


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, from ``min_count`` on."""
    common.prepared(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), common.text_bytes(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for own, value in zip(batch.column("id").to_pylist(), batch.column("__text")):
                tally(own, value.as_py(), counts, min_letters)
            if len(counts) > TALLY:
                yield flushed()
        yield flushed()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _blocks(words: DataFrame) -> DataFrame:
    """``word``, ``n``, its ``block`` (shorter length, side, letters) and the slices in which it is held and looked up."""
    size = F.length("word")
    places = []
    for less in (0, 1):
        shorter = size - less
        letters = F.least(F.lit(KEY_LETTERS), F.floor(shorter / 2)).cast("int")
        for side, key in (("a", F.substr("word", F.lit(1), letters)), ("b", F.substr("word", size - letters + 1, letters))):
            fits = (shorter >= 1) & (letters >= int(side == "b"))  # without letters to go by, one block holds all pairs
            places.append(F.when(fits, F.concat_ws(":", shorter.cast("string"), F.lit(side), key)))
    placed = words.select("word", "n", F.explode(F.array_compact(F.array(*places))).alias("block"))
    # A block of one word has no pair; of the others most need one slice.
    counts = placed.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    placed = placed.join(counts, "block").withColumn("slices", F.ceil(F.col("size") / SLICE).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    placed = placed.select("block", "word", "n", "own", other)
    held = placed.select("block", F.col("own").alias("held"), F.col("other").alias("asked"), "word", "n", (F.col("own") == F.col("other")).alias("both"), F.lit(True).alias("is_held"))
    asked = placed.where("own != other").select("block", F.col("other").alias("held"), F.col("own").alias("asked"), "word", "n", F.lit(False).alias("both"), F.lit(False).alias("is_held"))
    return held.unionByName(asked)


def _letters(words: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), "<u4").reshape(len(words), width)


def _bits(rows: np.ndarray, columns: np.ndarray, n_rows: int, n: int) -> np.ndarray:
    """Sets of bits, one per row: the columns set in each."""
    cells = np.zeros((n_rows, -(-n // 64) * 64), bool)
    cells[rows, columns] = True
    return np.packbits(cells, axis=1, bitorder="little").view("<u8")


class Index:
    """Words of a block, by decreasing count, as sets of bits by position and letter."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words, self.counts = [words[i] for i in order], np.array([counts[i] for i in order], np.int64)
        self.sizes = np.array([len(w) for w in self.words])
        self.n, width = len(words), int(self.sizes.max())
        matrix, every = _letters(self.words, width), np.arange(self.n)
        self.all = _bits(np.zeros(self.n, int), every, 1, self.n)[0]
        self.none = np.zeros_like(self.all)
        self.at = []
        for p in range(width):
            seen, code = np.unique(matrix[:, p], return_inverse=True)
            self.at.append((seen, np.concatenate([_bits(code, every, len(seen), self.n), self.none[None]])))

    def of_length(self, size: int) -> np.ndarray:
        own = np.flatnonzero(self.sizes == size)
        return _bits(np.zeros(len(own), int), own, 1, self.n)[0]

    def having(self, position: int, letters: np.ndarray) -> np.ndarray:
        """A set for each letter: the words that have it at the position."""
        if not 0 <= position < len(self.at):
            return np.broadcast_to(self.none, (len(letters), len(self.none)))
        seen, sets = self.at[position]
        code = np.minimum(np.searchsorted(seen, letters), len(seen) - 1)
        return sets[np.where(seen[code] == letters, code, len(seen))]

    def near(self, asked: np.ndarray, shorter: int, but_first: int) -> np.ndarray:
        """For each row of letters the set of words at exactly one error, the shorter of both words having ``shorter`` letters;
        without those that agree in the first ``but_first`` letters, if any."""
        n, size = asked.shape
        exact = np.broadcast_to(self.all, (n, len(self.all)))
        replaced = more = less = np.zeros((n, len(self.all)), np.uint64)
        first = None
        for i in range(size):
            here = self.having(i, asked[:, i])
            if size == shorter:
                more = (more | exact) & self.having(i + 1, asked[:, i])
                replaced = (replaced & here) | (exact & ~here)
            else:
                less = (less & self.having(i - 1, asked[:, i])) | exact
            exact = exact & here
            if i + 1 == but_first:
                first = exact
        if size == shorter:
            out = (replaced & self.of_length(size)) | ((more | exact) & self.of_length(size + 1))
        else:
            out = less & self.of_length(size - 1)
        return out if first is None else out & ~first


def _look_up(block: str, held: tuple[list[str], list[int]], asked: list[str]) -> Iterator[tuple[str, int, int, str]]:
    """Of each asked word with near ones: their number, the count of the most frequent, and that word."""
    shorter, side = int(block.split(":", 2)[0]), block.split(":", 2)[1]
    index = Index(*held)
    but_first = min(KEY_LETTERS, shorter // 2) if side == "b" else 0
    step = max(1, CELLS // len(index.all))
    for size in (shorter, shorter + 1):
        own = [w for w in asked if len(w) == size]
        for a in range(0, len(own), step):
            part = own[a : a + step]
            sets = index.near(_letters(part, size), shorter, but_first)
            counts = np.bitwise_count(sets).sum(axis=1, dtype=np.int64)
            hit = np.flatnonzero(counts)
            cell = (sets[hit] != 0).argmax(axis=1)
            low = sets[hit, cell]
            bit = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64) + 64 * cell
            for i, b in zip(hit.tolist(), bit.tolist()):
                yield part[i], int(counts[i]), int(index.counts[b]), index.words[b]


def near_words(words: DataFrame) -> DataFrame:
    """Per ``word`` of a table of distinct words with counts ``n`` that has any near one: ``n_near``, and the most frequent
    near word, ``near``, with its count ``near_n``."""
    common.prepared(words.sparkSession)
    group = ["block", "held", "asked"]
    rows = _blocks(words).repartition(*group).sortWithinPartitions(*group)
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def looked_up(table: pa.Table) -> pa.RecordBatch:
            keys = list(zip(*(table.column(c).to_pylist() for c in group)))
            words, counts, both, held = (table.column(c).to_pylist() for c in ("word", "n", "both", "is_held"))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            out = []
            for a, b in zip(edges, edges[1:]):
                own = [i for i in range(a, b) if held[i]]
                asked = [words[i] for i in range(a, b) if both[i] or not held[i]]
                if own and asked:
                    out += _look_up(keys[a][0], ([words[i] for i in own], [counts[i] for i in own]), asked)
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size < 2 * SLICE:
                continue
            table = pa.Table.from_batches(waiting)
            last = tuple(table.column(c)[size - 1].as_py() for c in group)
            cut = size
            while cut and tuple(table.column(c)[cut - 1].as_py() for c in group) == last:  # its rest may come with the next batch
                cut -= 1
            if cut:
                yield looked_up(table.slice(0, cut))
            waiting, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield looked_up(pa.Table.from_batches(waiting))

    found = rows.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last word that following ``form`` leads to.  Counts grow at every step, so chains are
    short and have no circles; each round doubles the steps."""
    links = written(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        if not links.where("moved").limit(1).count():
            return links.select("word", "root")
        links = links.select("word", "root")


def usual_forms(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                ratio: int = RATIO) -> DataFrame:
    """Per word: ``form`` (its most frequent near word, if at least ``ratio`` times as frequent), ``root`` (the last one that
    forms lead to, else the word), ``n``, ``n_near``, ``form_n``."""
    words = written(vocabulary(docs, doc_id, text, min_letters, min_count), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    usual = F.col("near_n") >= ratio * F.col("n")
    forms = written(near.select("word", F.when(usual, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(usual, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(forms.where("form is not null"))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
