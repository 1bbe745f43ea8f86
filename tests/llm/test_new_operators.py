"""Mixing, spelling variants and hard negatives: against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import mixing, negatives, queries, spelling
from tidegate.llm.running import running_sums, written

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def test_running_sums(spark):
    rows = written(spark.createDataFrame([(i % 7, float(i % 5), None if i % 11 == 0 else i) for i in range(500)], "k int, v double, n long").repartition(6), "rows")
    got = running_sums(rows, [F.col("k").desc(), F.col("v")], ["v", "n"]).collect()
    assert len(got) == 500
    by: dict = defaultdict(list)
    for r in got:
        by[-r["k"], r["v"]].append(r)
    before_v = before_n = 0
    for key in sorted(by):
        own = sorted(by[key], key=lambda r: (r["before_v"], r["before_n"]))
        assert own[0]["before_v"] == before_v and own[0]["before_n"] == before_n
        before_v, before_n = before_v + sum(r["v"] for r in own), before_n + sum(r["n"] or 0 for r in own)


def plain_targets(sizes: dict, share: float, most: float, weights=(5, 2, 1)) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * left / total > most * sizes[s]}
        if not above:
            return out | {s: weight[s] * left / total for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= above
    return out


@pytest.mark.parametrize("share,most", [(1.5, 2.0), (0.4, 1.0), (3.0, 2.0), (2.5, 3.0)])
def test_mix(spark, edge, share, most):
    docs = edge.select("doc_id", "text", F.when(F.col("doc_id") % 4 == 1, "b").when(F.col("doc_id") % 4 == 2, "a").when(F.col("doc_id") % 4 == 3, "é").otherwise(
        F.when(F.col("doc_id").isNotNull(), "Z")).alias("source"), F.lit(1).alias("size"), F.lit("x").alias("passes"), F.lit(2).alias("row"))
    mixed = written(mixing.mix(docs, share, most, keep=["doc_id", "text", F.col("source").alias("own")]), "mixed")
    got = mixed.collect()
    assert len(got) == docs.count()
    total, taken, target = Counter(), Counter(), {}
    for r in got:
        size = len(WORD.findall((r["text"] or "").encode()))
        assert r["size"] == size and 0 <= r["taken"] <= most * size and r["taken"] == sum(p["words"] for p in r["passes"])
        total[r["own"]] += size
        taken[r["own"]] += r["taken"]
        target[r["own"]] = r["target"]
    want = plain_targets(dict(total), share, most)
    assert {s: r for s, r in target.items()} == pytest.approx(want)
    for s in total:
        assert taken[s] == int(target[s]) and all(r["source_size"] == total[s] for r in got if r["own"] == s)
    # The time at which a pass begins is the one by which the source's curve has given the words before it.
    order = sorted(total, key=lambda s: (s is None, s or ""))
    for place, s in enumerate(order):
        schedule = mixing.SCHEDULES[place % 3]
        met = sorted((p["position"], p["words"]) for r in got if r["own"] == s for p in r["passes"])
        given, grid = 0, np.linspace(0, 1, 200_001)
        curve = np.concatenate([[0], np.cumsum(np.diff(grid) * np.interp((grid[1:] + grid[:-1]) / 2, *zip(*schedule)))])
        for at, words in met:
            assert np.interp(at, grid, curve) / curve[-1] * int(target[s]) == pytest.approx(given, abs=1e-3 * int(target[s]) + 1)
            given += words
    again = sorted(map(str, mixing.mix(docs.repartition(5), share, most, keep=["doc_id", "text", F.col("source").alias("own")]).collect()))
    assert again == sorted(map(str, got))
    line = [r["position"] for r in mixing.training_order(mixed).collect()]
    assert line == sorted(line) and len(line) == sum(len(r["passes"]) for r in got)


def test_mix_of_nothing_and_one_hot_source(spark, nothing):
    assert mixing.mix(nothing, keep=["doc_id"]).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r["target"], r["taken"], len(r["passes"])) for r in mixing.mix(empty).collect()} == {(0.0, 0, 0)}
    rows = spark.createDataFrame([(7, "w " * 10, "s")] * 300 + [(i, "w " * 10, "s") for i in range(300)] + [(i, "w", "t") for i in range(9)], "doc_id long, text string, source string")
    got = mixing.mix(rows, keep=["doc_id"]).collect()
    assert sum(r["taken"] for r in got if r["source_size"] == 6000) == int(got[0]["target"] if got[0]["source_size"] == 6000 else got[-1]["target"])
    assert len(got) == 609


def test_schedules():
    assert mixing.areas(((0, 0), (0.5, 2), (1, 0))) == [0.0, 0.5, 1.0]
    for bad in (((0, 1), (0.5, 1)), ((0, 1), (0, 2), (1, 1)), ((0, -1), (1, 1)), ((0, 0), (1, 0))):
        with pytest.raises(ValueError):
            mixing.areas(bad)


def test_time_within_gaps(spark):
    gap = ((0.0, 1.0), (0.25, 0.0), (0.75, 0.0), (1.0, 1.0))  # nothing is taken in the middle
    rows = spark.createDataFrame([(x,) for x in (0.0, 0.4999, 0.5, 0.75)], "share double")
    at = [r["t"] for r in rows.select(mixing.time_of(F.col("share"), gap).alias("t")).collect()]
    assert at[0] == 0 and at[1] < 0.25 and at[2] == 0.75 and 0.75 < at[3] < 1


def plain_vocabulary(docs: list[tuple], least: int, often: int) -> dict[str, int]:
    counts: Counter = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= often}


def one_error(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts: dict[str, int], ratio: int) -> list[tuple]:
    near = {w: [x for x in counts if one_error(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


@pytest.mark.parametrize("least,often,cut", [(5, 3, 16_384), (1, 1, 16_384), (1, 1, 5), (3, 2, 7)])
def test_spelling(spark, edge, nothing, monkeypatch, least, often, cut):
    monkeypatch.setattr(spelling, "SLICE", cut)
    monkeypatch.setattr(spelling, "PIECE", 50)
    dice = np.random.default_rng(4)
    letters = list("abé")
    words = ["".join(dice.choice(letters, dice.integers(1, 8))) for _ in range(150)]
    texts = [(100 + i, " ".join(dice.choice(words, 40)).upper() if i % 3 else "-".join(dice.choice(words, 60))) for i in range(25)]
    texts += [(None, "Émile ÉMILE émile Emile emile ×÷ naïve naive naïve 3abcde4abcde"), (1, None), (2, ""), (3, "x" * 5000), (4, "x" * 5001)] + [(5, "twice twice twize")] * 3
    docs = edge.where("length(coalesce(text, '')) < 1000").select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string")).withColumn("n", F.lit(1))
    own = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in spelling.usual_forms(docs, min_letters=least, min_count=often).collect()))
    assert got == plain_forms(plain_vocabulary(own, least, often), 2)
    assert spelling.usual_forms(nothing).count() == 0


def plain_negatives(rows: list[tuple], anchor, k=5, low=80, high=100) -> list[tuple]:
    rows = list(dict.fromkeys((i, label, tuple(v)) for i, label, v in rows if i is not None and label is not None and v is not None and None not in v))
    most = min(Counter(len(v) for *_, v in rows).items(), key=lambda x: (-x[1], x[0]))[0] if rows else 0
    rows = [r for r in rows if len(r[2]) == most]
    out = []
    for i, label, v in rows:
        if not anchor(i):
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i]
        positives = sorted(x for x in score if x[2] == label)[:k]
        others = sorted(x for x in score if x[2] != label)
        for p, j, _ in positives:
            fits = [x for x in others if low * -p <= 100 * -x[0] <= high * -p][:k]
            out += [(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(negatives, "BLOCK_ROWS", 8)
        monkeypatch.setattr(negatives, "RUN_BLOCKS", 2)
        monkeypatch.setattr(negatives, "MEET", 3)
        monkeypatch.setattr(negatives, "LINES", 4)
    dice = np.random.default_rng(6)
    centres = dice.integers(-60, 60, (12, 6))
    rows = [(int(i) - 20, int(dice.integers(0, 4)), [int(x) for x in centres[i % 12] + dice.integers(-3, 4, 6)]) for i in range(260)]
    rows += [(1000 + i, i % 3, [50, 50, 0, 0, 0, 1]) for i in range(120)]  # a third is one vector
    rows += [(2000, None, [1] * 6), (2010, 1, None), (2020, 1, [1, None, 1, 1, 1, 1]), (2030, 1, [1, 2]), (None, 1, [5] * 6), (2040, 1, [0] * 6), rows[0], rows[1], (2050, 1, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<int>").withColumns({"run": F.lit(1), "key": F.lit("k"), "anchor": F.lit(2)}).repartition(5)
    got = sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 10 == 0).collect())
    assert got == plain_negatives(rows, lambda i: i % 10 == 0)
    assert negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine(df, F.lit(False)).count() == 0
    assert negatives.mine(df, F.col("vec_id") == 2010).count() == 0


def test_zone_maps_spare_runs(spark, monkeypatch):
    """Of vectors in clusters an anchor reads a part of the runs; large numbers stay exact."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 8)
    monkeypatch.setattr(negatives, "RUN_BLOCKS", 8)
    dice = np.random.default_rng(7)
    centres = dice.integers(-1000, 1000, (16, 8)) * 1000
    rows = [(int(i), int(i % 5), [int(x) for x in centres[i % 16] + dice.integers(-9, 10, 8)]) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<long>")
    reached, reach = [], negatives._reach

    def counted(asked, zones, same, width):
        out = written(reach(asked, zones, same, width), "reach")
        reached.append((asked.count(), zones.count(), out.count()))
        return out

    monkeypatch.setattr(negatives, "_reach", counted)
    got = sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 20 == 0).collect())
    assert got == plain_negatives(rows, lambda i: i % 20 == 0)
    for asked, runs, pairs in reached:
        assert runs >= 25 and pairs < 0.35 * asked * runs
    assert negatives.scores(np.array([[3_000_000_000]]), np.array([[3_000_000_001]]))[0, 0] == 9_000_000_003_000_000_000


def test_hilbert_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = negatives.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()  # neighbours on the curve are neighbours in space


def test_queries_against_their_contract(spark):
    sf_dir = "/root/testdata/sf0.001"
    mixed = queries.QUERIES["op11_mixing"](spark, sf_dir)
    assert mixed.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert dict(mixed.dtypes) | {} and [dict(mixed.dtypes)[c] for c in mixed.columns[1:5]] == ["bigint", "bigint", "double", "bigint"]
    words = queries.QUERIES["op12_spelling"](spark, sf_dir)
    assert words.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    mined = queries.QUERIES["op13_hard_negatives"](spark, sf_dir)
    assert [t for _, t in mined.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hashlib.md5(b"5:mix").hexdigest()  # the order of documents is the one that SQL can tell
