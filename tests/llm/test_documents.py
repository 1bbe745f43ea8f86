"""The other operators and the pipeline: against plain Python, held-out labels or exact search."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SF_DIR
from tidegate.llm import common, language_id, nearest, packing, pii, quality, queries, secret_scan, simhash

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def texts_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def luhn(digits: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def plain_pii(t: str) -> list[tuple[int, int, int]]:
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if 16 <= len(d) <= 19 and luhn(d) if kind == 2 else 8 <= len(d) <= 15:
                out.append((kind, *m.span()))
    return sorted(out)


def joined(spans, kinds) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in spans)


def test_pii(spark, edge, nothing):
    more = ["1 2 3 4 " * 20_000, "a" * 50_000 + "@b" + ".c" * 20_000, "xy a@b.co", "a@b.c.@d.e..f@g-.h 1.2.3.4.5.6.7.8 41111111 +1.23(45)67-89- +999"]
    docs = edge.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.find(docs).collect())
    want = []
    for i, t in texts_of(docs):
        base = plain_pii(t)
        want.append((str(i), *(sum(k == kind for k, *_ in base) for kind in range(4)), hashlib.sha256(joined(base, pii.KINDS).encode()).hexdigest()))
    assert got == sorted(want)
    assert pii.find(nothing).count() == 0


def test_pii_is_native_and_adds(spark):
    rows = [(i, f"call me on tel +1 (212) 555-01{i % 100:02d} today") for i in range(400)] + [(1000 + i, f"order 2023-0{i % 9 + 1}-11 of {i}") for i in range(400)]
    rows += [(5000, "my phone is 1 (212) 555-0199 today")]
    out = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["n_phone"] == 1 and got[0]["n_added"] == 0 and got[1001]["spans"] == ""
    assert got[5000]["spans"] == "number:12:28"


def test_pii_adds_what_is_more_frequent_than_the_fixed_formats(spark):
    rows = [(i, f"call me on tel +1 (212) 555-01{i % 100:02d} today") for i in range(200)]
    rows += [(1000 + i, f"call me on tel (212) 555-01{i % 100:02d} today") for i in range(800)]
    rows += [(2000 + i, f"write to jane{i}@mail.com soon") for i in range(200)] + [(3000 + i, f"write to jane{i} (at) mail (dot) com soon") for i in range(800)]
    rows += [(4000 + i, f"order 2023-0{i % 9 + 1}-11 of {i}") for i in range(400)] + [(5000 + i, f"on 2023-0{i % 9 + 1}-11 we met") for i in range(400)]
    rows += [(6000 + i, f"order ref (212) 555-01{i % 100:02d} shipped") for i in range(200)]
    rows += [(7000 + i, f"paid by card 4111 1111 1111 1111 or 41111111111111{i % 90 + 10}" if i % 2 else f"no {4111111111111112 + 10 * i} here") for i in range(100)]
    got = {r["doc_id"]: r["n_added"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {k: sum(n for i, n in got.items() if i // 1000 == k) for k in range(7)}
    assert added == {0: 0, 1: 800, 2: 0, 3: 800, 4: 0, 5: 0, 6: 0} and got[7000] == got[7002] == 0


def test_packing(edge, nothing):
    by: dict = {}
    pieces = packing.pack(edge, VOCABULARY, keep=["doc_id", "text"]).collect()
    for r in pieces:
        by.setdefault((r["doc_id"], r["sequence_id"] * 2048 + r["offset"] - r["start"]), []).append(r)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert len(by) == edge.count()
    for own in by.values():
        own.sort(key=lambda r: r["start"])
        ids = tokenizer.encode(own[0]["text"] or "", add_special_tokens=False).ids + [1]
        assert [x for r in own for x in r["ids"]] == ids and all(r["doc_tokens"] == len(ids) for r in own)
        assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in own)
        assert [r["continues"] for r in own] == [True] * (len(own) - 1) + [False]
    end = 0
    for at, size in sorted((r["sequence_id"] * 2048 + r["offset"], r["length"]) for r in pieces):
        assert at == end
        end += size
    assert packing.pack(nothing, VOCABULARY).count() == 0


def test_language(spark, edge, nothing):
    docs = common.read_table(spark, "/root/testdata/sf0.01", "documents")
    got = queries.QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()
    model = language_id.train(edge)
    by = {r["doc_id"]: r for r in language_id.predict(edge, model, keep=["doc_id"]).collect()}
    assert {i for i, r in by.items() if r["lang_pred"] == "und"} >= {1, 2, 4, 6} and by[5]["lang_pred"] == "en" and 0 <= by[5]["score"] <= 1
    none = language_id.train(nothing)
    assert {r["lang_pred"] for r in language_id.predict(edge, none).collect()} == {"und"}
    assert language_id.predict(nothing, model).count() == 0


def plain_fingerprint(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[i : i + 3]), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[tuple]) -> list[tuple]:
    group = {fp: fp for _, fp in prints}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 2 and find(a) != find(b):
                group[find(a)] = find(b)
    least: dict = {}
    for i, fp in prints:
        if i is not None:
            least[find(fp)] = min(i, least.get(find(fp), i))
    return sorted((str(i), f"{fp:016x}", least.get(find(fp))) for i, fp in prints)


def test_simhash_documents(edge, nothing):
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(edge).collect())
    assert got == plain_components([(i, plain_fingerprint(t)) for i, t in texts_of(edge)])
    kept = simhash.keep_first(edge).collect()
    ids = [r["doc_id"] for r in kept]
    assert len([i for i in ids if i is not None]) == len({c for i, _, c in got if i != "None"}) and ids.count(None) == 2 and ids.count(11) <= 1
    assert kept[0].asDict().keys() == {f.name for f in edge.schema}
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_first(nothing).count() == 0


def test_rows_go_for_their_own_text(spark):
    a, b = "one two three four five six seven", "quite another text that has nothing of the first"

    def kept(rows):
        return sorted(tuple(r) for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect())

    assert kept([(1, a, 0), (2, a, 0), (2, b, 0)]) == [(1, a, 0), (2, b, 0)]
    assert kept([(5, a, 0), (5, b, 0)]) == sorted([(5, a, 0), (5, b, 0)])
    assert kept([(5, a, 0)] * 3 + [(6, a, 0)]) == [(5, a, 0)]
    rows = simhash.keep_first(spark.createDataFrame([(5, a), (None, a), (None, a), (7, None), (8, "")], "doc_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["5", "7", "None", "None"]


def test_masks_cover_every_pair():
    tables = simhash.masks()
    for i in range(64):
        for j in range(i, 64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in tables)


def test_simhash_links(spark):
    rng = np.random.default_rng(3)
    values = [int(x) for x in rng.integers(0, 2**63, 60)]
    for _ in range(200):  # chains and dense groups, and pairs three bits apart that stay apart
        x = values[rng.integers(len(values))]
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        values.append(x)
    values = list(dict.fromkeys(values))
    nodes = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes)).collect()}
    prints = [(i, v) for i, v in enumerate(values)]
    want = {f: c for _, f, c in plain_components(prints)}
    groups: dict = {}
    for v in values:
        groups.setdefault(got.get(simhash._signed(v), simhash._signed(v)), set()).add(want[f"{v:016x}"])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_quality(spark, edge, nothing):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.QUERIES["op7_quality_pu"](spark, sf_dir).join(common.read_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").where("held_out")
    rows = got.collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9 and all(0 <= r["score"] <= 1 for r in rows)
    labels = spark.createDataFrame([(5, 1), (3, 1), (7, 1), (7, 1), (11, 0), (99, 1), (None, 1)], "doc_id long, quality int")
    model = quality.train(edge, labels)
    by = {r["doc_id"]: r["score"] for r in quality.score(edge, model, keep=["doc_id"]).collect()}
    assert by[2] == 0 and all(0 <= s <= 1 for s in by.values())
    assert quality.train(edge, labels.limit(0)) is None and quality.train(nothing, labels) is None
    assert {r["score"] for r in quality.score(edge, None).collect()} == {0.0, 0.5}


def plain_risk(x: np.ndarray, n: int, prior: float, w: np.ndarray) -> tuple[float, bool]:
    """Positive-unlabelled risk of a linear model, term by term; whether the negatives' part is below zero."""
    loss = lambda z, y: np.log1p(np.exp(-y * z)) if -y * z < 30 else -y * z
    z = [float(sum(a * b for a, b in zip(row, w[:-1])) + w[-1]) for row in x]
    positive = prior * sum(loss(v, 1) for v in z[:n]) / n
    rest = sum(loss(v, -1) for v in z[n:]) / (len(z) - n) - prior * sum(loss(v, -1) for v in z[:n]) / n
    return (positive + rest, False) if rest >= 0 else (-rest, True)


def test_quality_risk_and_slope():
    dice = np.random.default_rng(2)
    sides = set()
    for prior in (0.1, 0.5, 0.95):
        for scale in (0.1, 1.0, 4.0):
            p, u = dice.normal(0.5, 1, (6, 3)), dice.normal(0, 1, (9, 3))
            w = dice.normal(0, scale, 4)
            got = quality.slope(np.concatenate([p, u]), 6, prior, w)
            for i in range(4):
                step = np.zeros(4)
                step[i] = 1e-6
                (above, side), (below, other) = (plain_risk(np.concatenate([p, u]), 6, prior, w + s) for s in (step, -step))
                assert side == other and got[i] == pytest.approx((above - below) / 2e-6, abs=1e-5)
            sides.add(side)
    assert sides == {True, False}


def test_quality_fit_is_bounded_and_has_no_switch(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda p, u: seen.update(p=len(p), u=len(u)))
    docs = spark.createDataFrame([(1, f"text {i} of one id") for i in range(500)] + [(i, f"text number {i}") for i in range(2, 90)], "doc_id long, text string")
    for labelled in (range(0, 40), range(0, 90)):  # with and without documents that have no label
        labels = spark.createDataFrame([(i, 1) for i in labelled], "doc_id long, quality int")
        quality.train(docs, labels, sample=20, unlabelled=30)
        assert seen == {"p": 20, "u": 30}


def test_nearest_exact_where_all_is_searched(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:300] = x[100]  # a third is one vector
    data = [(int(i) - 50, [float(v) for v in row], 0) for i, row in enumerate(x)]
    data += [(7000, None, 0), (7050, [0.0] * 16, 0), (7100, [float("nan")] * 16, 0), (7150, [1.0], 0), (None, data[3][1], 0), (7200, [1e300] * 16, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int")
    got: dict = {}
    for r in nearest.search(df, F.col("vec_id") % 50 == 0, share=1e9).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    use = [(i, np.array(v) / np.max(np.abs(v))) for i, v, _ in data if i is not None and v and len(v) == 16 and np.all(np.isfinite(v)) and any(v)]
    ids = np.array([i for i, _ in use])
    unit = np.array([v / np.linalg.norm(v) for _, v in use])
    assert set(got) == {int(i) for i in ids if i % 50 == 0}
    for q, found in got.items():
        s = unit @ unit[ids == q][0]
        order = [int(ids[k]) for k in np.lexsort((ids, -np.round(s, 12))) if ids[k] != q][:5]
        assert [v for _, v, _ in sorted(found)] == order and [r for r, *_ in sorted(found)] == [1, 2, 3, 4, 5]
    few = nearest.search(df.where("vec_id in (0, 1)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(0, 1)]
    assert nearest.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_ties(spark):
    rows = [(i, [float(2 ** (i % 20)) * x for x in (0.25, -0.5, 0.75, 1.0)]) for i in range(60)]
    rows += [(100 + i, [float(3 + i), -7.0, 0.1 * i, 2.0]) for i in range(30)]
    found = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, share=1e9)
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found.orderBy("rank").collect()] == [(i, i, 1.0) for i in range(1, 6)]


def test_nearest_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = common.read_table(spark, sf_dir, "embeddings").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = wanted = 0
    got: dict = {}
    for r in queries.QUERIES["op8_rp_forest"](spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    for q in ids[ids % 50 == 0]:
        s = unit @ unit[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -s))] if i != q][:5]
        hits, wanted = hits + len(got[q] & set(best)), wanted + 5
    assert hits >= 0.9 * wanted


def plain_secrets(t: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16])


def test_secrets(spark, edge, nothing):
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(
        [(50, "Pwd: hunter2 password: correct horse, PASSWORD=Zq8#vR2!mK9x, see https://bob:tR0ub4dor8xQ@host/ (password: changeme123)"), (51, "ſecret: abcdefghijklmnopq")], "doc_id long, text string"))
    by = {}
    for r in secret_scan.scan(docs, keep=["doc_id", "text"], mark="<S>").collect():
        t = r["text"] or ""
        base = plain_secrets(t)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(joined([(k, a, b) for a, k, b in base], secret_scan.KINDS).encode()).hexdigest()
        assert (r["redacted"] is None) == (r["text"] is None)
        by[r["doc_id"]] = r
    assert by[50]["n_value"] == 2 and by[50]["redacted"].count("<S>") == 2 and "changeme123" in by[50]["redacted"] and by[5]["spans"] == ""
    assert secret_scan.scan(nothing).count() == 0


def test_guesses_are_ordered():
    cost = secret_scan.guesses
    assert cost("password") < cost("p4ssw0rd") < cost("password1987") < cost("kX9$vQ2m")
    assert cost("aaaaaaaaaaaa") < 4 and cost("qwertyuiop") < 4 and cost("2024-05-17") < 6 and cost("thereanea") < secret_scan.MIN_GUESSES
    assert cost("") == 0 and cost("f3ef4d6b2755a36d7d9c2") > 15 and cost("x7" * 5_000) < 6


def pieces(value: str, ranks: dict) -> dict[int, list[tuple[int, float]]]:
    """Every way to go on from a place of a value, one by one: where to and at what cost."""
    n, low, plain = len(value), value.lower(), value.lower().translate(secret_scan._LEET)
    spoken = {m.start(): m.end() for m in secret_scan._LETTERS.finditer(value) if secret_scan._pronounceable(m[0])}
    spoken = {a: b for a, b in spoken.items() if b - a >= 6 or (a == 0 or value[a - 1] in "-_./:") and (b == n or value[b] in "-_./:")}
    single, out = secret_scan._per_character(value), {}
    for i in range(n):
        to = []
        for j in range(i + 1, n + 1):
            if plain[i:j] in ranks:
                to.append((j, np.log10(ranks[plain[i:j]] + 1) + 0.6 * (value[i:j] != plain[i:j])))
        if m := secret_scan._DATE.match(value, i):
            to.append((m.end(), 4.6 if m.end() - i > 4 else 2.1))
        j = max(j for j in range(i + 1, n + 1) if len(set(value[i:j])) == 1)
        if j - i >= 3:
            to.append((j, 1 + np.log10(j - i)))
        for unit in (2, 3, 4):
            times = max([t for t in range(1, n + 1) if value[i : i + unit] * t == value[i : i + unit * t] and i + unit * t <= n], default=1)
            if times >= 2:
                to.append((i + unit * times, unit + np.log10(times)))
        for one in secret_scan._ROWS:
            for row in (one, one[::-1]):
                j = max([j for j in range(i, n + 1) if low[i:j] in row])
                if j - i >= 3:
                    to.append((j, 1.5 + np.log10(j - i)))
        if i in spoken:
            to.append((spoken[i], 0.45 * (spoken[i] - i) + 0.5))
        inside = any(a <= i < b for a, b in spoken.items())
        out[i] = [(j, c + 0.3 * (i > 0)) for j, c in to] + [(i + 1, 0.6 if inside else 1.0 if value[i] in "-_./:" else single)]
    return out


def test_segmentation_against_all_splits():
    ranks, dice = secret_scan.ranked(["river", "stone", "able"]), np.random.default_rng(9)
    parts = ["river", "St0ne", "able", "qwer", "321", "aaa", "ababab", "1987", "12-05-87", "x", "K", "$", "7", "-", "fghj", "xyzxyz", "hello", "p4ss", "zq"]
    for _ in range(400):
        value = "".join(dice.choice(parts, dice.integers(1, 4)))[:12]
        steps = pieces(value, ranks)

        def cheapest(i: int) -> float:
            return 0.0 if i == len(value) else min(c + cheapest(j) for j, c in steps[i])

        want = cheapest(0)
        assert secret_scan.guesses(value, ranks) == pytest.approx(want), value
        for enough in (3.0, 9.0):
            assert (secret_scan.guesses(value * 9, ranks, enough) >= enough) == (secret_scan.guesses(value * 9, ranks) >= enough)


def test_long_values_take_linear_time():
    long = ["a" * 200_000, "x7Kq" * 50_000, "password" * 25_000, "".join(chr(33 + i * 7919 % 90) for i in range(200_000))]
    began = time.perf_counter()
    for value in long:
        secret_scan.value_spans(f"password={value}")
    assert time.perf_counter() - began < 4


def test_learned_words(spark, edge):
    texts = ["the river Bank, the RIVER"] * 6 + ["password: riverstone token=abcdefabcdefabcd"] * 50 + [None, ""] + ["rare"] * 4
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert secret_scan.learned_words(docs) == ["password", "river", "the", "bank"]
    assert secret_scan.learned_words(docs, most=2) == ["password", "river"]
    assert secret_scan.learned_words(edge.limit(0)) == []
    value = "pwd: gleamotter end"
    assert secret_scan.value_spans(value.replace("gleamotter", "gleam7otter"))
    assert not secret_scan.value_spans(value.replace("gleamotter", "gleam7otter"), ranks=secret_scan.ranked(["gleam", "otter"]))
    for code in ("process.env.DB_PASSWORD", "config.getSecretValue", "os.environ.get"):
        assert not secret_scan.value_spans(f"password = {code}(x)")


def test_random_values_are_found_and_words_kept():
    rng = np.random.default_rng(8)
    draw = lambda chars, n: "".join(rng.choice(list(chars), n))
    lower, mixed = "abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(33, 127) if chr(c) not in "\"'`<>,;()[]{}.!?:"]
    found = lambda value: bool(secret_scan.value_spans(f"pwd: {value} end"))
    assert found("kX9$vQ2m") and sum(found(draw(mixed, 8)) for _ in range(500)) >= 0.99 * 500
    for n, least in ((8, 0.85), (12, 0.95), (18, 0.99)):
        assert sum(found(draw(lower, n)) for _ in range(500)) >= least * 500
    kept = """required optional variable undefined configuration temporary forgotten protected REQUIRED UNKNOWN Please Object Update Lambda something
        somewhere unavailable authentication environment administrator instructions contraseña Passwort vergessen erforderlich obligatoire
        mot-de-passe changeme123 your_password your-api-key example-token placeholder XXXXXXXX ******** 12345678 qwertyuiop hunter2
        Summer2024! admin@example.com user_name client_credentials"""
    assert [w for w in kept.split() if found(w)] == []


def test_pipeline_against_plain_python(spark, edge, tmp_path):
    edge.withColumn("__row", F.lit(7)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("q", "Two words")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    model = language_id.train(edge)
    fits = {r["text"] for r in language_id.predict(edge, model, keep=["text"]).where("lang_pred != 'und' and fit > 0").collect()}
    docs = [(i, t) for i, t in docs if t in fits and any(c.isalpha() for c in t)]
    group = {(i, f): c for i, f, c in plain_components([(i, plain_fingerprint(t)) for i, t in docs])}
    docs = list(dict.fromkeys((i, t) for i, t in docs if i is None or group[str(i), f"{plain_fingerprint(t):016x}"] == i))
    docs = [(i, t) for i, t in docs if "two words" not in t]
    counts: Counter = Counter()
    for _, t in docs:
        hidden = [(a, 0, b) for a, b in secret_scan._contexts(t)] + secret_scan.base_spans(t)
        counts.update(w for w in re.findall("[a-z]+", secret_scan.redacted(t, hidden, " ").lower()) if 3 <= len(w) <= 16)
    ranks = secret_scan.ranked([w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= 5])
    tokenizer = Tokenizer.from_file(VOCABULARY)
    sizes = sorted((str(i), len(tokenizer.encode(secret_scan.redacted(t, secret_scan.base_spans(t) + secret_scan.value_spans(t, ranks=ranks), "[SECRET]"), add_special_tokens=False).ids) + 1) for i, t in docs)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    starts = sorted((str(r["doc_id"]), r["doc_tokens"]) for r in got if r["start"] == 0)
    assert starts == sizes and sum(r["length"] for r in got) == sum(n for _, n in sizes)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op5_language_id", "op7_quality_pu", "op8_rp_forest", "op13_hard_negatives"}))
def test_query_runs(spark, name):
    n = common.read_table(spark, SF_DIR, "documents").count()
    out = queries.QUERIES[name](spark, SF_DIR)
    assert out.select("doc_id").distinct().count() == n
