"""Secrets in texts: fixed formats, and values in credential contexts that would be expensive to guess.

The cost of a value is that of the cheapest way to write it as words, dates, repeats,
keyboard walks, syllables and characters tried one by one (a dynamic programme over its
positions, in powers of ten).  A character costs as much as the classes of the value have
members; only letters whose pairs are usual in words are guessed by syllables.  A value after a credential word counts as a secret from
``MIN_GUESSES`` on, so that names, prose and placeholders stay; so do references in code,
letters and dots alone that spell words (``process.env.DB_PASSWORD``).

Words are those that a guesser tries first and the most frequent ones of the documents
(``learned_words``), by rank; what stands in a credential context or is a secret does not count.
The work is linear in the length of a value, and ends as soon as it is clear on which side of the limit its cost is.

Base kinds are found as they are asked for and always stay; ``value`` spans are added.
Spans are code points, end exclusive.  Null and empty texts have none.  Rows are judged one by one, so repeated
rows have equal results and an empty table none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm import common
from tidegate.llm.running import written

#: Power of ten of the guesses from which a value in a credential context is a secret.
MIN_GUESSES = 9.0
KINDS = ("assign", "access", "hex", "value")

# The formats asked for.
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")  # maximal runs, so the same as filtering all runs by length
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Credential contexts, wider than the base: any of these words, a separator, a value.
_CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "login", "://")
_CONTEXT = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|signing|encryption)[_-]?key|credentials?|"""
    r"""auth(?:orization)?|login)["']?(?:\x20*(?:=>|:=|[:=])\x20*|\x20(?i:is)\x20)["'`]?([^\s"'`<>,;()\[\]{}]{6,})""")
_BEARER = re.compile(r"(?ai:bearer|basic)\x20+([A-Za-z0-9._~+/=-]{8,})")
_URL = re.compile(r"://[^\s:/@]+:([^\s:/@]{4,})@")

# Frequent words of passwords and placeholders, by how early a guesser tries them.
WORDS = (
    "password pass admin welcome login letmein qwerty dragon monkey master shadow sunshine princess football baseball "
    "iloveyou trustno hello freedom whatever michael jordan superman batman secret test user guest root default changeme "
    "example sample dummy placeholder none null true false your here token key value string name email server system "
    "service client access auth private public production development staging local host database data main home "
    "summer winter spring autumn january february march april june july august september october november december "
    "monday tuesday wednesday thursday friday saturday sunday love money power magic star blue green black white red "
    "orange silver golden tiger eagle lion horse cookie coffee cheese apple banana pepper ginger killer hunter ranger "
    "soccer hockey tennis computer internet google the and for with that this from have not you are was but all can"
).split()
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
#: Words learned from the documents, at most; their letters; how often one must stand there; words a counting task holds.
LEARNED, SHORTEST, LONGEST, OFTEN, TALLY = 20_000, 3, 16, 5, 400_000
_WORD = re.compile("[a-z]+")
_REFERENCE = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)+")
_HUMP = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_LEET = str.maketrans("@4301!57$", "aaeoiists")
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp")
_WALKS = tuple({a: b for a, b in zip(row, row[1:])} | {row[-1]: ""} for one in _ROWS for row in (one, one[::-1]))
_DATE = re.compile(r"(?:19|20)[0-9]{2}(?:[-/._]?[01][0-9](?:[-/._]?[0-3][0-9])?)?|[0-3]?[0-9][-/._][01]?[0-9][-/._](?:[0-9]{4}|[0-9]{2})")
_LETTERS = re.compile("[A-Za-z]?[a-z]{3,}|[A-Z]{3,}")
_CLASSES = ((re.compile("[a-z]"), 26), (re.compile("[A-Z]"), 26), (re.compile("[0-9]"), 10), (re.compile(r"[!-/:-@\[-`{-~]"), 33))
_HEX_ONLY = re.compile("(?:[0-9a-f]+|[0-9A-F]+)")
_CONSONANTS = re.compile("[b-df-hj-np-tv-xz]{5}")
_SEPARATORS = frozenset("-_./:")
# Letters that often follow a letter in English, German, French and Spanish words.
_FOLLOWING = dict(zip("abcdefghijklmnopqrstuvwxyz", (
    "bcdefghiklmnprstuvwxyz abeilorsuy acehiklorstuy adegilnorsuy abcdefghiklmnopqrstuvwxyz aefilortuy aeghilnorstuy aeilnortuy "
    "abcdefgkllmnoprstuvxzq aeou aeilnorstuy abcdefgiklmopstuvy abeimnopstuy acdefghijklnoqstuvyz abcdefghiklmnoprstuvwxyz "
    "aehilopprstuy u abcdefgiklmnoprstuvyz acehiklmnopqstuwy acehilmnorstuwyz abcdefgiklmnoprstvxyz aeiouy adehilnors aceiptuy "
    "abcdeilmnoprst aeiltouwyz").split()))


def _pronounceable(letters: str) -> bool:
    """Whether the pairs of the letters are those of words: one unusual pair, or five consonants on end, in six letters pass."""
    low = letters.lower()
    unusual = sum(b not in _FOLLOWING[a] for a, b in zip(low, low[1:])) + len(_CONSONANTS.findall(low))
    return unusual <= (len(low) - 1) // 6


def _per_character(value: str) -> float:
    """Power of ten of the characters that the classes used in the value have."""
    if _HEX_ONLY.fullmatch(value) and not value.isdecimal():
        return math.log10(16)
    rest = value[1:] if value[:1].isupper() else value  # a capital at the start is tried before others
    return math.log10(max(10, sum(size for pattern, size in _CLASSES if pattern.search(rest))))


def _is_reference(value: str) -> bool:
    """Names of code: letters, underscores and dots whose words can be spoken, are short or all capitals."""
    return _REFERENCE.fullmatch(value) is not None and all(len(w) <= 3 or w.isupper() or _pronounceable(w) for w in _HUMP.findall(value))


def guesses(value: str, ranks: Mapping[str, int] = _RANK, enough: float | None = None) -> float:
    """Power of ten of the guesses for the cheapest segmentation of ``value``.

    With ``enough`` the answer is only on the right side of it: the work ends once that is known.
    """
    n, lower = len(value), value.lower()
    plain = lower.translate(_LEET)
    if len(lower) != n or len(plain) != n:
        lower = plain = "".join(c if c.isascii() else "?" for c in value).lower()
    best = [0.0] + [math.inf] * n
    single = _per_character(value)
    spoken = {m.start(): m.end() for m in _LETTERS.finditer(value) if _pronounceable(m[0])}
    # A few letters beside other characters may be usual by chance.
    spoken = {a: b for a, b in spoken.items() if b - a >= 6 or (a == 0 or value[a - 1] in _SEPARATORS) and (b == n or value[b] in _SEPARATORS)}
    spoken_end = 0
    same_end, unit_end, walk_end = 0, {2: -1, 3: -1, 4: -1}, [0] * len(_WALKS)  # ends of the runs met last
    look = 32
    for i in range(n):
        if i == look and enough is not None:
            look *= 2
            if best[n] < enough or (least := min(best[i:])) >= enough:  # a path to the end passes one of these
                return best[n] if best[n] < enough else least
        at = best[i] + 0.3 * (i > 0)  # another segment doubles the orders to try

        def reach(end: int, cost: float) -> None:
            best[end] = min(best[end], at + cost)

        for end in range(i + 1, min(n, i + LONGEST) + 1):
            rank = ranks.get(plain[i:end])
            if rank:
                changed = value[i:end] != plain[i:end]
                reach(end, math.log10(rank + 1) + 0.6 * changed)
        if value[i].isdigit() and (date := _DATE.match(value, i)):
            reach(date.end(), 4.6 if date.end() - i > 4 else 2.1)
        if same_end <= i:
            same_end = i + 1
            while same_end < n and value[same_end] == value[i]:
                same_end += 1
        if same_end - i >= 3:
            reach(same_end, 1.0 + math.log10(same_end - i))
        for unit, end in unit_end.items():
            if end < i:  # the first place from here on that differs from the one a unit later
                end = i
                while end + unit < n and value[end] == value[end + unit]:
                    end += 1
                unit_end[unit] = end
            times = (end - i + unit) // unit
            if times >= 2:
                reach(i + times * unit, unit + math.log10(times))
        for w, row in enumerate(_WALKS):
            if walk_end[w] <= i:
                end = i
                if lower[i] in row:
                    end = i + 1
                    while end < n and row[lower[end - 1]] == lower[end]:
                        end += 1
                walk_end[w] = end
            if walk_end[w] - i >= 3:
                reach(walk_end[w], 1.5 + math.log10(walk_end[w] - i))
        if i in spoken:  # letters as in prose are guessed by syllables
            spoken_end = spoken[i]
            reach(spoken_end, 0.45 * (spoken_end - i) + 0.5)
        one = 0.6 if i < spoken_end else 1.0 if value[i] in _SEPARATORS or not value[i].isascii() else single
        best[i + 1] = min(best[i + 1], best[i] + one)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, in order."""
    low = text.lower()
    out = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if any(w in low for w in _ASSIGN_WORDS) or not text.isascii():
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return sorted(out)


def _contexts(text: str) -> set[tuple[int, int]]:
    """Places of the values in credential contexts."""
    low = text.lower()
    if not any(w in low for w in _CONTEXT_WORDS):
        return set()
    return {m.span(1) for pattern in (_CONTEXT, _BEARER, _URL) for m in pattern.finditer(text)}


def value_spans(text: str, min_guesses: float = MIN_GUESSES, ranks: Mapping[str, int] = _RANK) -> list[tuple[int, int, int]]:
    """Values in credential contexts that cost at least so much."""

    def is_secret(value: str) -> bool:
        return not _is_reference(value) and guesses(value, ranks, min_guesses) >= min_guesses

    return sorted((a, 3, b) for a, b in _contexts(text) if is_secret(text[a:b].rstrip(".!?:")))


def ranked(words: list[str]) -> dict[str, int]:
    """Ranks of the words that a guesser tries first and, after them, of learned ones, the most frequent first."""
    return {w: i + 1 for i, w in enumerate(dict.fromkeys([*WORDS, *words]))}


def learned_words(docs: DataFrame, text: str = "text", most: int = LEARNED) -> list[str]:
    """The ``most`` most frequent words of all texts, without what stands in credential contexts or is a secret by its format."""
    common.prepared(docs.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            own = [(w, n) for w, n in counts.items() if SHORTEST <= len(w) <= LONGEST]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in own], pa.string()), pa.array([n for _, n in own], pa.int64())], ["word", "n"])

        for batch in batches:
            for cell in batch.column("__text"):
                value = cell.as_py()
                secret = [*_contexts(value), *((a, b) for a, _, b in base_spans(value))]
                counts.update(_WORD.findall((redacted(value, [(a, 0, b) for a, b in secret], " ") if secret else value).lower()))
            if len(counts) > TALLY:
                yield flushed()
        yield flushed()

    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    sums = rows.mapInArrow(tally, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    # Written first: each task's list then goes to one task, not to the driver, which gets the one that counts.
    return [r["word"] for r in written(sums.orderBy(F.desc("n"), "word").limit(most), "words").orderBy(F.desc("n"), "word").collect()]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, done = [], 0
    for a, _, b in sorted(spans):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join(out) + text[done:] if spans else text


def scan(docs: DataFrame, text: str = "text", keep: list[str | Column] = (), min_guesses: float = MIN_GUESSES, mark: str | None = None,
         words: list[str] = ()) -> DataFrame:
    """``words``: learned ones, by rank.  Per row: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``n_value``, ``spans``, and with ``mark`` the text
    with every span replaced by it (``redacted``; null texts stay null)."""
    spark = common.prepared(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    kept = rows.drop("__text").schema
    ranks = spark.sparkContext.broadcast(ranked(list(words)))  # bounded by the number of learned words
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept),
              "n_assign long, n_access long, n_hex long, base_sha256 string, n_value long, spans string", *["redacted string"] * (mark is not None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, texts = [], []
            for cell in batch.column("__text"):
                value = cell.as_py() or ""
                base, more = base_spans(value), value_spans(value, min_guesses, ranks.value)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                out.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), len(more), _joined(sorted(base + more))))
                if mark is not None:
                    texts.append(redacted(value, base + more, mark) if cell.is_valid else None)
            carried = batch.drop_columns(["__text"])
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "n_value", "spans"]
            columns = [pa.array([r[i] for r in out], pa.string() if i in (3, 5) else pa.int64()) for i in range(6)]
            if mark is not None:
                names.append("redacted")
                columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*carried.columns, *columns], [*carried.schema.names, *names])

    return rows.mapInArrow(run, ", ".join(fields))
