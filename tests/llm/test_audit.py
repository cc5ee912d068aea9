"""Quality, hard negatives and source divergence against plain versions."""

import math
import re
from collections import Counter, defaultdict
from itertools import product
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
import xxhash

from sessionloom.llm import divergence as D
from sessionloom.llm import hard_negatives as H
from sessionloom.llm import quality as Q

SF = "/root/testdata/sf0.01"

# --- operator 11 ---


def test_ngrams_of_long_texts(monkeypatch):
    """Any cut of a long text gives the places of the whole one."""
    text = "  a bb!! ccc  \n\t" + " ".join(f"wörd{k % 7},, x{k}" for k in range(300)) + " " * 500 + "end END end   "
    whole, _ = Q.places([text])
    for long in (1, 7, 50, 1000):
        monkeypatch.setattr(Q, "LONG", long)
        (at, found), = Q.each_text([text])
        assert at == 0 and Counter(found.tolist()) == Counter(whole.tolist())
        assert [k for k, _ in Q.each_text(["", None, text, "a b", text, ""])] == list(range(6))
        assert [x.size for _, x in Q.each_text(["", None, text, "a b", "a a"])] == [0, 0, whole.size, 3, 3]
    assert Q.places(["é"])[0].size == 1 and Q.places(["a-b"])[0].size == 5


def test_ftrl_is_the_textbook_loop():
    """One coordinate at a time, with dictionaries."""
    rng = np.random.default_rng(3)
    model, z, n = Q.Ftrl(), defaultdict(float), defaultdict(float)
    for _ in range(60):
        at, x = Q.values(rng.integers(0, 50, rng.integers(0, 30)))
        label = int(rng.random() < 0.4)
        w = {}
        for i in at.tolist():
            w[i] = 0.0 if abs(z[i]) <= Q.L1 else -(z[i] - math.copysign(Q.L1, z[i])) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2)
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at.tolist(), x.tolist(), strict=True))))
        for i, v in zip(at.tolist(), x.tolist(), strict=True):
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / Q.ALPHA * w[i]
            n[i] += g * g
        model.learn(at, x, label)
    assert np.allclose(model.z[list(z)], list(z.values())) and np.allclose(model.n[list(n)], list(n.values()))


def test_quality_on_held_out_rows(spark):
    got = Q.op11_quality(spark, SF).toPandas()
    docs, labels = (pd.read_parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert sorted(got["doc_id"]) == sorted(docs["doc_id"]) and got["score"].between(0, 1).all()
    assert (got["held_out"] == [crc32(str(k).encode()) % 5 == 0 for k in got["doc_id"]]).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    met = got[got["held_out"]].merge(labels, on="doc_id")
    assert (met["predicted"] == met["quality"]).mean() >= 0.95
    rank, good = met["score"].rank(), met["quality"] == 1
    assert (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum()) >= 0.98
    again = Q.op11_quality(spark, SF).toPandas()
    assert np.allclose(got.set_index("doc_id")["score"], again.set_index("doc_id")["score"].loc[got["doc_id"]])


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, "good words", "x"), (2, "bad $$$ $$$", "x"), (3, None, "x"), (None, "good", "x"), (3, "", "x"), (1, "good words", "y")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, 1), (2, None), (1, 0)], "doc_id long, quality int")
    got = Q.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    assert {r["score"] for r in Q.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.classify(docs.limit(0), labels).count() == 0
    big = "word " * 400_000
    w = np.random.default_rng(0).normal(size=(1 << Q.BITS) + 1).astype(np.float32)
    assert np.allclose(Q.scores([big], w), Q.scores([big[: 5 * 200_000]], w), atol=1e-3)


# --- operator 12 ---


def plain(rows, every=100, first=5):
    """All pairs of rows (id, label, vector), in Python's whole numbers."""
    out = []
    own = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, y, v in rows]
    for a, ya, va in own:
        if a % every:
            continue
        score = [(sum(x * z for x, z in zip(va, v, strict=True)), i, y) for i, y, v in own if i != a and len(v) == len(va)]
        order = sorted(score, key=lambda r: (-r[0], r[1]))
        for p, i, _ in [r for r in order if r[2] == ya][:first]:
            fit = [r for r in order if r[2] != ya and 80 * p <= 100 * r[0] <= 100 * p][:first]
            out += [(a, i, k + 1, j, p, s) for k, (s, j, _) in enumerate(fit)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<double>, rank string"


@pytest.mark.parametrize("kind", ["clusters", "copies", "small", "huge"])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(H, "LEAST_GROUP", 40)
    monkeypatch.setattr(H, "LEAF", 8)
    monkeypatch.setattr(H, "GROWTH", 2)
    rng = np.random.default_rng(len(kind))
    n = 600
    v = rng.normal(size=(n, 6)) * 0.3
    if kind == "clusters":
        v = rng.normal(size=(12, 6))[rng.integers(0, 12, n)] + 0.05 * v
    if kind == "copies":
        v[rng.random(n) < 0.4] = v[0]
    if kind == "small":  # many ties
        v = rng.integers(-1, 2, (n, 6)) / 256
    if kind == "huge":  # beyond what doubles multiply exactly
        v = rng.integers(-3, 4, (n, 6)) * 2.0**20 + rng.integers(0, 3, (n, 6)) / 256
    rows = [(int(i), int(y), [float(x) for x in r]) for i, y, r in zip(rng.permutation(4 * n)[:n], rng.integers(0, 3, n), v, strict=True)]
    got = H.mine(spark.createDataFrame([(*r, "x") for r in rows], VECTORS), every=10).collect()
    assert sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got) == plain(rows, 10)
    assert got


def test_hard_negative_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(100, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [0.7, 0.0]), (4, 2, [1.0, 0.0]), (200, 3, [1.0, 1.0]), (5, 2, [1.0, 0.0, 0.0])]
    bad = [(6, 1, None), (7, None, [1.0, 0.0]), (8, 1, [nan, 0.0]), (9, 1, [inf, 0.0]), (None, 1, [1.0, 0.0]), (10, 1, []), (11, 1, [None, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in good + bad + good[:1]], VECTORS)
    got = sorted(tuple(r) for r in H.mine(df).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == plain(good) and [r[3] for r in got] == [4, 200, 2]
    assert H.mine(df.limit(0)).count() == 0


# --- operator 13 ---


def plain_audit(rows, least=3, most=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for lang, source, text in rows]
    low = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    docs = [(lang, source, [t.translate(low) for t in terms]) for lang, source, terms in docs]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in seen.items() if n >= least]
        count = {s: Counter() for x, s, _ in docs if x == lang}
        for x, s, terms in docs:
            if x == lang:
                count[s].update(t for t in terms if seen[t] >= least)
        share = lambda c, v=len(kept): {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept}  # noqa: B023, E731
        p, q = {s: share(c) for s, c in count.items()}, share(sum(count.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in count:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in count if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found, cap in (("pair", pairs, None), ("term", terms, most)):
                ranked = sorted(found, key=lambda r: (-r[1], r[0].encode()))[:cap]
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(ranked)]
    return sorted(out)


def audited(spark, rows):
    df = spark.createDataFrame([(*r, 5) for r in rows], "lang string, source string, text string, value int")
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in D.audit(df).collect())


def test_xxh64_of_all_sizes():
    rng = np.random.default_rng(5)
    data = np.append(rng.integers(0, 256, 4000).astype(np.uint8), np.zeros(40, np.uint8))
    start = np.concatenate([rng.integers(0, 3900, 80) for _ in range(41)])
    size = np.repeat(np.arange(41), 80) + (np.arange(start.size) % 80 == 0) * 50
    assert D.hashes(data, start, size).tolist() == [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(start.tolist(), size.tolist(), strict=True)]


def test_slices_with_one_hash_are_told_apart(monkeypatch):
    texts = ["one Two three one", "É é two", "a" * 40 + "b " + "a" * 40 + "c", "", None]
    want = None
    for same in (False, True):
        if same:
            monkeypatch.setattr(D, "hashes", lambda data, start, size: np.zeros(start.size, np.uint64))
        data, start, size, owner = D.terms_of(texts)
        first, group = D.grouped(data, start, size)
        got = [(o, data[start[first[g]] : start[first[g]] + size[first[g]]].tobytes().decode()) for o, g in zip(owner.tolist(), group.tolist(), strict=True)]
        want = want or got
        assert got == want == [(0, "one"), (0, "two"), (0, "three"), (0, "one"), (1, "É"), (1, "é"), (1, "two"), (2, "a" * 40 + "b"), (2, "a" * 40 + "c")]


@pytest.mark.parametrize("chunk", [3, 250_000])
def test_audit_against_counters(spark, monkeypatch, chunk):
    monkeypatch.setattr(D, "CHUNK", chunk)
    rng = np.random.default_rng(8)
    words = ["alpha", "Beta", "gAmma", "ü", "ÜBER", "x" * 35, "x" * 35 + "y", "delta", "日本", "e", "mid-word", "a1b"]
    rows = [(("en", "de", None)[rng.integers(3)], ("s1", "s2", "s3", None)[rng.integers(4)], " ".join(rng.choice(words, rng.integers(0, 9)))) for _ in range(60)]
    rows += [("only", "one", "a a a"), ("fr", "p", "x"), ("fr", "q", None), ("en", "quiet", ""), rows[0], rows[0]]
    assert audited(spark, rows) == plain_audit(rows)


def test_audit_keeps_the_best_terms_and_large_counts(spark, monkeypatch):
    rng = np.random.default_rng(9)
    names = ["".join(p) for p in product("abcdefgh", repeat=3)]
    rows = [("en", f"s{k % 3}", " ".join(names[j] for j in range(len(names)) if rng.random() < 0.6 or j % 3 == k % 3)) for k in range(9)]
    got = audited(spark, rows)
    assert got == plain_audit(rows) and max(r[5] for r in got if r[2] == "term") <= D.TERMS
    monkeypatch.setattr(D, "TERMS", 7)
    assert audited(spark, rows) == plain_audit(rows, most=7)
    assert D.shares(np.array([10**13, 0]), 10**13, 2).tolist() == [1 + 10**9 * (10**13 + 1) // (10**13 + 2), 1]
    assert audited(spark, []) == []


@pytest.mark.parametrize("held", [50, 1_500_000])
def test_terms_handed_on_early(spark, monkeypatch, held):
    monkeypatch.setattr(D, "HELD", held)
    rows = [("en", f"s{k % 2}", f"common word{chr(97 + k % 9)} Common") for k in range(40)]
    assert audited(spark, rows) == plain_audit(rows)
