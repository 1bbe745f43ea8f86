"""Language model, repeated passages, decontamination: against plain Python over dictionaries."""

from __future__ import annotations

import functools
import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF_DIR, rows
from tests.oracle import compare, connect
from tidegate.llm import arrays, common, decontaminate, ngram_lm, queries, substring_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_words_and_hashes():
    texts = [(t or "").encode() for _, t, *_ in rows()]
    data, offsets = common.buffers(pa.array([b"xx", *texts], pa.binary())[1:])
    starts, ends, firsts = common.word_spans(data, offsets)
    got = [[bytes(data[s:e]) for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(firsts, firsts[1:])]
    assert got == [WORD.findall(t) for t in texts]
    seen = {}
    for word, h in zip([w for t in got for w in t], common.word_hashes(data, starts, ends).tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def tokens(text: str | None) -> list[bytes]:
    return [w.lower() for w in WORD.findall((text or "").encode())] + [b"\n"]


def plain_model(train: list[str | None]):
    """Modified Kneser-Ney of order two over dictionaries."""
    pairs = Counter((a, b) for t in train for s in [[b"\t", *tokens(t)]] for a, b in zip(s, s[1:]))
    followers, before = defaultdict(list), Counter(b for _, b in pairs)
    for (a, _), n in pairs.items():
        followers[a].append(n)
    d2, d1 = (ngram_lm._discounts(*(Counter(c.values())[k] for k in (1, 2, 3, 4))) for c in (pairs, before))
    taken = lambda d, n: ([0.0] + list(d))[min(n, 3)]
    total, v = sum(before.values()), len(before)
    rest = sum(taken(d1, n) for n in before.values()) / total

    def p(a: bytes, b: bytes) -> float:
        low = rest / (v + 1) + max(before[b] - taken(d1, before[b]), 0) / total
        if a not in followers:
            return low
        n = followers[a]
        return max(pairs[a, b] - taken(d2, pairs[a, b]), 0) / sum(n) + sum(taken(d2, x) for x in n) / sum(n) * low

    return p, Counter(w for t in train for w in tokens(t))


def test_kneser_ney(spark, edge):
    model = ngram_lm.train(edge)
    got = ngram_lm.score(edge, model, keep=["doc_id", "text"]).collect()
    p, counts = plain_model([r["text"] for r in edge.collect()])
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.vocabulary) == (n, v)
    for r in got:
        own = tokens(r["text"])
        assert r["n_tokens"] == len(own) == r["n_known"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want = sum(math.log10(p(a, b)) for a, b in zip([b"\t", *own], own))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(want, rel=1e-9)
    for context in (b"\t", b"the", b"cat", b"never-seen"):  # all continuations, with one unknown word, add up to one
        assert sum(p(context, w) for w in [*counts, b"unknown-word"]) == pytest.approx(1)


def test_kneser_ney_orders_and_hot_contexts(spark, edge, monkeypatch):
    found = {}
    for order in (2, 3):
        for share in (1 / 1024, 1e-9):  # as good as every context dealt over all shards
            monkeypatch.setattr(ngram_lm, "HOT_SHARE", share)
            model = ngram_lm.train(edge, order=order)
            assert share > 1e-6 or len(model.hot)
            found[order, share] = sorted((r["doc_id"] or -99, round(r["score"], 6)) for r in ngram_lm.score(edge, model, keep=["doc_id"]).collect())
    assert found[2, 1e-9] == found[2, 1 / 1024] and found[3, 1e-9] == found[3, 1 / 1024]
    assert sum(s for _, s in found[3, 1e-9]) > sum(s for _, s in found[2, 1e-9])


def test_kneser_ney_query_has_trigrams(spark):
    docs = common.read_table(spark, SF_DIR, "documents")
    model = ngram_lm.train(docs.where(common.fold(10) != 0), order=3)
    want = {r["doc_id"]: r["score"] for r in ngram_lm.score(docs, model, keep=["doc_id"]).collect()}
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op1_kneser_ney"](spark, SF_DIR).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_kneser_ney_three_words(spark, edge, monkeypatch):
    texts = [r["text"] for r in edge.collect()]
    grams = Counter(g for t in texts for s in [[b"\t", b"\t", *tokens(t)]] for g in zip(s, s[1:], s[2:]))
    pairs = Counter((b, c) for _, b, c in grams)
    singles = Counter(b for _, b in pairs)
    d3, d2, d1 = (ngram_lm._discounts(*(Counter(c.values())[k] for k in (1, 2, 3, 4))) for c in (grams, pairs, singles))
    taken = lambda d, n: ([0.0] + list(d))[min(n, 3)]
    total, followers = sum(singles.values()), defaultdict(list)
    for counts in (grams, pairs):
        for g, n in counts.items():
            followers[g[:-1]].append(n)

    def over(g: tuple, counts: Counter, d: tuple, low: float) -> float:
        n = followers.get(g[:-1])
        return low if n is None else max(counts[g] - taken(d, counts[g]), 0) / sum(n) + sum(taken(d, x) for x in n) / sum(n) * low

    rest = sum(taken(d1, n) for n in singles.values())

    @functools.cache
    def p(g: tuple) -> float:
        low = rest / total / (len(singles) + 1) + max(singles[g[2]] - taken(d1, singles[g[2]]), 0) / total
        return over(g, grams, d3, over(g[1:], pairs, d2, low))

    for share in (ngram_lm.RANKED_SHARE, 0.01, 2.0):  # most words by rank, some, none but the start
        monkeypatch.setattr(ngram_lm, "RANKED_SHARE", share)
        model = ngram_lm.train(edge, order=3)
        for r in ngram_lm.score(edge, model, keep=["text"]).collect():
            own = tokens(r["text"])
            assert r["score"] == pytest.approx(sum(math.log10(p(g)) for g in zip([b"\t", b"\t", *own], [b"\t", *own], own)), rel=1e-9)


def test_kneser_ney_without_training(spark, edge, nothing):
    model = ngram_lm.train(nothing)
    got = ngram_lm.score(edge, model).collect()
    assert len(got) == edge.count() and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)
    assert ngram_lm.score(nothing, model).count() == 0


def plain_removal(docs: list[tuple[int | None, bytes]], width: int) -> list[tuple]:
    words = [(d, WORD.findall(t)) for d, t in docs]
    first: dict = {}
    for d, w in words:
        for i in range(len(w) - width + 1):
            if d is not None:
                key = hash(tuple(w[i : i + width]))
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if d is not None and first[hash(tuple(w[i : i + width]))] < d:
                gone[i : i + width] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d if d is not None else -99, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("width", [2, 13])
def test_repeats_removed(edge, width):
    levels = substring_dedup.repeated_windows(edge, min_words=width, longest=width)
    got = substring_dedup.remove_repeats(edge, levels, keep=["doc_id"]).collect()
    want = plain_removal([(r["doc_id"], (r["text"] or "").encode()) for r in edge.collect()], width)
    assert sorted((-99 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_repeats_doubled_to_the_end(edge, nothing):
    levels = substring_dedup.repeated_windows(edge, min_words=13)
    assert list(levels.lengths)[:3] == [7, 13, 26] and levels.lengths[-1] * 2 > 60_000
    got = {r["doc_id"]: r["longest_repeat"] for r in substring_dedup.remove_repeats(edge, levels, keep=["doc_id"]).collect()}
    assert got[8] == levels.lengths[-2] and got[7] == 0 and got[11] == 13 and got[5] == 13
    none = substring_dedup.repeated_windows(nothing)
    assert substring_dedup.remove_repeats(nothing, none).count() == 0


def test_repeats_read_the_texts_three_times_however_many_lengths(spark, edge, monkeypatch):
    plans, written = [], common.written_lean

    def noted(rows, name):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return written(rows, name)

    monkeypatch.setattr(common, "written_lean", noted)
    levels = substring_dedup.repeated_windows(edge, min_words=13)
    assert len(levels.lengths) > 10
    assert len([p for p in plans if "InMemoryTableScan" in p]) == 3  # half windows, 13 words, those of them that repeat


def test_window_hashes_know_the_words(monkeypatch):
    monkeypatch.setattr(common, "_WORD_BLOCK", 64)  # several blocks
    words = np.random.default_rng(3).integers(0, 5, 3_000).astype(np.uint64)
    for length in (1, 2, 7, 13):
        seen = {}
        for i, h in enumerate(common.window_hashes(words, length, 13).tolist()):
            assert seen.setdefault(tuple(words[i : i + length].tolist()), h) == h
        assert len(set(seen.values())) == len(seen)
        places = np.array([2, 700, len(words) - length])
        assert (common.window_hashes_at(words, length, places, 13) == common.window_hashes(words, length, 13)[places]).all()


def test_decontamination_in_blocks(spark, edge, nothing, monkeypatch):
    items = [("q1", "CAT sat; on a mat. While rain-fell over every red roof"), ("q2", "two  words"), ("q2", "two words"), (None, "Sole"), ("q4", None),
             ("q5", "..."), ("q6", "the cat sat on a mat while rain fell over every red")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    want = {}
    for size in (10**9, 20):  # one automaton, several
        monkeypatch.setattr(decontaminate, "MAX_PATTERN_BYTES", size)
        got = decontaminate.scan(edge, benchmark, keep=["doc_id", "text"]).collect()
        found = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], str(r["spans"])) for r in got)
        assert want.setdefault("all", found) == found
        by = {r["doc_id"]: r for r in got}
        assert (by[13]["n_hit"], by[13]["n_items"], by[12]["n_hit"], by[12]["n_items"]) == (2, 1, 1, 0)
        assert by[5]["n_items"] == 2 and by[5]["items_sha256"] == hashlib.sha256(b"q1,q6").hexdigest()
        s = by[9]["spans"][0]
        assert by[9]["text"][s["start"] : s["end"]] == "THE CAT SAT ON A MAT WHILE RAIN FELL OVER EVERY RED ROOF"
    assert decontaminate.scan(edge, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.scan(nothing, benchmark).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) is None


def test_runs_are_found_by_the_lengths_beside_them(tmp_path):
    rng = np.random.default_rng(5)
    for n in (1, ngram_lm._STEP, ngram_lm._STEP * 7 + 3):
        lengths = np.where(rng.random(n) < 0.2, rng.integers(250, 70_000, n), rng.integers(1, 9, n))
        ends, held = np.cumsum(lengths), {"none": np.zeros((0, 4), np.uint16)}
        ngram_lm._keep_runs(held, "size", ends - lengths, int(ends[-1]))
        arrays.save_together(str(tmp_path / str(n)), "a", held)
        read = arrays.load_together(str(tmp_path / str(n)), "a")
        assert {k: (v.dtype, v.tolist()) for k, v in read.items()} == {k: (v.dtype, v.tolist()) for k, v in held.items()}
        places = rng.permutation(np.repeat(np.arange(n), 2))
        low, high = ngram_lm._runs_at(read, "size", places)
        assert (low == (ends - lengths)[places]).all() and (high == ends[places]).all()
    assert arrays.load_together(str(tmp_path), "absent") is None


def test_kneser_ney_opens_a_file_per_order_and_shard(spark, edge, monkeypatch):
    monkeypatch.setattr(common, "shard_bits", lambda *_: 4)
    model = ngram_lm.train(edge, order=3)
    names = [n for n in os.listdir(arrays.mounted(model.folder)) if not n.startswith(".")]
    assert names and len(names) <= 3 * 16 and all(n.endswith(".pack") for n in names)


@pytest.mark.parametrize("top", [3, 2**20, 2**64 - 1])
def test_values_are_ordered_with_their_places(top):
    values = np.random.default_rng(7).integers(0, top, 5_000, dtype=np.uint64, endpoint=True)
    values = np.concatenate([values, values[::-1], np.array([0, top], np.uint64)])
    assert (common.order(values) == np.argsort(values, kind="stable")).all()
    one, which, n = common.distinct(values)
    seen, first, back, counts = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    assert (values[one] == seen).all() and (one == first).all() and (which == back).all() and (n == counts).all()
    assert len(common.order(values[:0])) == 0 and len(common.distinct(values[:0])[0]) == 0


def test_ranks_of_words_by_their_top_bits():
    words = np.random.default_rng(9).integers(0, 2**64, 3_000, dtype=np.uint64)
    words = np.concatenate([words, words[:50] + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    for held in (words, words[:1], words[:0]):
        ranks, place = ngram_lm._Ranks(held), {w: i for i, w in enumerate(held.tolist())}
        asked = np.concatenate([words, words + np.uint64(2)]).reshape(2, -1)
        assert ranks.of(asked).tolist() == [[place.get(w, len(held)) for w in row] for row in asked.tolist()]


def test_hashes_are_found_in_small_buckets(tmp_path):
    rng = np.random.default_rng(13)
    for n in (1, 2, 3, 64, 50_000):
        keys = np.unique(np.concatenate([rng.integers(0, 2**64, n, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)[: n - 1]]))
        held = {}
        ngram_lm._keep_table(held, "key", keys)
        assert len(keys) < 1000 or sum(a.nbytes for a in held.values()) < 6 * len(keys)
        arrays.save_together(str(tmp_path / str(n)), "a", held)
        read = arrays.load_together(str(tmp_path / str(n)), "a")
        low, high = ngram_lm._runs_at(read, "keybucket", np.arange(len(held["keybucket"]) - 1))
        assert (low[1:] == high[:-1]).all() and (low[0], high[-1]) == (0, len(keys)) and (high - low).max() <= 16
        asked = rng.permutation(np.concatenate([keys, keys, rng.integers(0, 2**64, n, dtype=np.uint64)]))
        hit, at = ngram_lm._find(read, "key", asked)
        assert (hit == np.flatnonzero(np.isin(asked, keys))).all() and (keys[at] == asked[hit]).all()


def test_scoring_sorts_its_words_once_an_order(spark, edge, monkeypatch):
    model = ngram_lm.train(edge, order=3)
    texts = [(r["text"] or "").encode() for r in edge.collect()]
    sequence, own = ngram_lm._sequences(pa.record_batch([pa.array(texts, pa.binary())], ["__text"]), 3)
    sizes, order = [], common.order
    monkeypatch.setattr(common, "order", lambda values: sizes.append(len(values)) or order(values))
    p, raw = (x[ngram_lm._predicted(own, 3)] for x in ngram_lm._probabilities(model, sequence))
    assert sum(sizes) <= 2 * len(sequence)
    firsts = np.cumsum(own) - own
    want = sorted(r["score"] for r in ngram_lm.score(edge, model).collect())
    assert sorted(np.add.reduceat(np.log10(p), firsts)) == pytest.approx(want, rel=1e-9) and (raw > 0).all()


def test_contexts_are_weighed_in_one_reading(spark, edge):
    read, n = spark.sparkContext.accumulator(0), edge.count()

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    texts = edge.select(common.text_bytes().alias("__text"))
    ngram_lm.hot_contexts(texts.mapInArrow(counted, texts.schema), 3)
    assert read.value == n
