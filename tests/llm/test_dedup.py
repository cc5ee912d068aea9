"""Operators 2, 3, 9 against brute force, with hot groups, ties, nulls and clashing columns."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.llm import embedding_join, exact_dedup, jaccard_join
from sessionloom.llm.components import components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(200)], [(0, k) for k in range(1, 300)], [(random.Random(k).randrange(150), random.Random(k + 999).randrange(150)) for k in range(120)]])
def test_components(spark, links):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links for x in p}
    assert got == roots(nodes, links)


def test_exact_groups(docs_of):
    given = [(5, "a b"), (3, "a\t\nb"), (9, "a  b"), (4, "ab"), (7, None), (8, ""), (2, " a b"), (None, "a b"), (11, "z"), (11, "z")]
    for digest in (exact_dedup.sha256_digest, lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 2), 2, "0"))):  # the second one collides
        got = defaultdict(list)
        for r in exact_dedup.exact_groups(docs_of(given), digest=digest).collect():
            got[r["doc_id"]].append((r["keep_id"], r["group_size"], r["kept"]))
        assert got[5] == got[9] == [(3, 4, False)] and got[3] == [(3, 4, True)] and got[None] == [(3, 4, False)]
        assert got[4] == [(4, 1, True)] and got[7] == [(7, 2, True)] and got[8] == [(7, 2, False)] and got[2] == [(2, 1, True)]
        assert got[11] == [(11, 2, True)] * 2
    kept = exact_dedup.keep_rows(docs_of(given))
    assert kept.columns == docs_of(given).columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 7, 11]
    assert exact_dedup.exact_groups(docs_of([])).count() == 0


def test_stream_state_goes_on(spark, tmp_path):
    """In micro-batches of one file each, then with more landed."""
    schema = "doc_id long, digest binary, file string, row long"
    state, landing = str(tmp_path / "state"), str(tmp_path / "landing")
    spark.createDataFrame([(5, b"x", "f1", 0), (6, b"y", "f1", 1), (7, b"y", "f1", 2)], schema).repartition(3).write.parquet(landing)
    exact_dedup.groups_of_stream(spark, landing, spark.read.parquet(landing).schema, state, 3).collect()
    assert len(list((tmp_path / "state/groups").glob("batch=*"))) == 3
    spark.createDataFrame([(2, b"x", "f2", 0), (9, b"z", "f2", 1)], schema).write.mode("append").parquet(landing)
    got = {bytes(r["digest"]): (r["first"]["doc_id"], r["first"]["file"], r["first"]["row"], r["n"]) for r in exact_dedup.groups_of_stream(spark, landing, spark.read.parquet(landing).schema, state).collect()}
    assert got == {b"x": (2, "f2", 0, 2), b"y": (6, "f1", 1, 2), b"z": (9, "f2", 1, 1)}


@pytest.mark.parametrize("stored", [True, False])
def test_runs_over_one_state(spark, docs_of, tmp_path, monkeypatch, stored):
    """Three runs, whose texts lie in files or don't; digests clash across runs, and are told apart by the bytes that locators lead to."""
    clash = lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 2, "0"))
    runs = [[(5, "aa"), (6, "b"), (7, None)], [(3, "a a"), (8, "aa"), (9, "bbbb"), (4, "aa")], [(1, "bbbb"), (2, "zz  z"), (10, "b"), (11, "zz z")]]
    seen = []
    for k, rows in enumerate(runs):
        docs = docs_of(rows)
        if stored:
            docs.repartition(2).write.parquet(str(tmp_path / f"in put{k}"))
            docs = spark.read.parquet(str(tmp_path / f"in put{k}"))
        if k == 1:  # the first try ends behind the query

            def fails(*a):
                raise RuntimeError("lost")

            with monkeypatch.context() as m:
                m.setattr(exact_dedup, "cut", fails)
                with pytest.raises(RuntimeError, match="lost"):
                    exact_dedup.exact_groups(docs, clash, str(tmp_path / "state"), "again")
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs, clash, str(tmp_path / "state"), "again" if k == 1 else None).collect()}
        seen += rows
        text = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        group = lambda t: [i for i, x in seen if text(x) == text(t)]
        assert got == {i: (min(group(t)), len(group(t)), i == min(group(t))) for i, t in rows}
    # the same name again: nothing is landed twice
    assert {r["doc_id"]: r["group_size"] for r in exact_dedup.exact_groups(docs, clash, str(tmp_path / "state"), "1").collect()} == {1: 2, 2: 2, 10: 2, 11: 2}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    out, k = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 30, 120, 400]))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 8])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = word()
            base = t if rng.random() < 0.5 else base  # chains as well as stars
            out.append((k, " ".join(t)))
            k += 1
    base = [word() for _ in range(90)]
    for _ in range(60):  # a dense group around the threshold
        t = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            t[rng.randrange(len(t))] = word()
        out.append((k, " ".join(t)))
        k += 1
    return [*out, (k, None), (k + 1, ""), (k + 2, " \n"), (k + 3, "one"), (k + 4, "ONE"), (k + 5, "x\ty z w v"), (k + 6, "x y z w v")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_join_is_brute_force(docs_of, seed, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(jaccard_join, "LIKELY", (0.5, 0.8, float("inf")))  # counts on pairs that are no links
    if seed == 2:
        monkeypatch.setattr(jaccard_join, "BLOCK", 3)  # many blocks of few holders
        monkeypatch.setattr(jaccard_join, "SLICE_CHARS", 300)  # holders meet across slices
    given = near_texts(seed)
    sets = {i: shingles(t) for i, t in given}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = {i: (len(s), c) for (i, s), c in zip(sets.items(), roots(sets, links).values(), strict=True)}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_groups(docs_of(given)).collect()} == want
    if seed == 1:
        assert sorted(r["doc_id"] for r in jaccard_join.keep_one(docs_of(given)).collect()) == sorted(i for i, (_, c) in want.items() if i == c)
        assert jaccard_join.near_groups(docs_of([])).count() == 0


@pytest.mark.parametrize("block", [4096, 7])
def test_embedding_join_is_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    x = [base[rng.integers(40)] + rng.normal(size=8) * 0.25 for _ in range(150)] + [base[0]] * 20 + [base[1] * 3, base[1] * 1e-3]
    rows = [(k, [float(np.float32(v)) for v in r], 0, 1) for k, r in enumerate(x)]
    k = len(rows)
    odd = [None, [], [0.0] * 8, [1.0] * 7 + [None], [1.0] * 7 + [float("nan")], [float("inf")] + [1.0] * 7, [1.0, 2.0]]
    rows += [(k + i, v, 0, 1) for i, v in enumerate(odd)] + [(k + 50, [2.0, 4.0], 0, 1)]
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_join.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key int")).collect()}
    u = np.array([r[1] for r in rows[:k]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    comp = roots(range(k), [tuple(p) for p in np.argwhere(s)])
    assert {i: got[i] for i in range(k)} == {i: (int(s[i].sum()), comp[i], comp[i] == i) for i in range(k)}
    assert all(got[k + i] == (0, k + i, True) for i in range(6))
    assert got[k + 6] == (1, k + 6, True) and got[k + 50] == (1, k + 6, False)
    assert embedding_join.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_join_prunes_clusters(spark, monkeypatch):
    """Clusters far apart: under a fifth of the pairs are compared, by blocks and by leaves, and the links are brute force's."""
    monkeypatch.setattr(embedding_join, "BLOCK", 256)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(60, 64))
    x = (centres[rng.integers(60, size=3000)] + rng.normal(size=(3000, 64)) * 0.12).astype(np.float32)
    df = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    assert {r["vec_id"]: r["n_links"] for r in embedding_join.near_vectors(df).collect()} == dict(enumerate(s.sum(1).tolist()))
    r = embedding_join.compared(df).first()
    print("compared", r["compared"], "of", r["pairs"])
    assert s.sum() / 2 <= r["compared"] < 0.2 * r["pairs"]


def test_places_never_exceed_distances():
    rng = np.random.default_rng(5)
    x = embedding_join._unit(rng.normal(size=(300, 64)) + rng.normal(size=64))
    frame = embedding_join.Frame(x, 0.447)
    p, far = frame.places(x), lambda m: np.linalg.norm(m[:, None] - m[None], axis=2)
    assert (far(p) <= far(x) + 1e-9).all() and frame.axes.shape == (64, 32) and 4 / frame.width <= 128


def test_templates_below_the_threshold_stay_few_rows(spark, docs_of):
    """A passage in 20,000 texts that are otherwise unlike, just too short a share to link: no block of holders meets another."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = " ".join(word() for _ in range(34))  # 30 shingles
    docs = docs_of([(k, passage + " " + " ".join(word() for _ in range(11))) for k in range(20_000)])
    assert all(r["component_id"] == r["doc_id"] and r["n_shingles"] == 41 for r in jaccard_join.near_groups(docs).collect())


def test_block_cells_send_holders_to_pairs_left_only(spark):
    """Holders of one shingle with sizes and reach that allow no link give no rows; those that may link give a few rows each."""
    import pandas as pd

    rng = np.random.default_rng(2)
    blob = lambda: rng.integers(0, 2, 2048, dtype=np.uint8)
    base = np.packbits(blob()).tobytes()
    make = lambda reach, bits: spark.createDataFrame(pd.DataFrame({"token": 7, "part": 1, "id": np.arange(5000), "n": 100, "comp": np.arange(5000), "signature": bits, "reach": reach}), "token long, part long, id long, n long, comp long, signature binary, reach int")
    assert jaccard_join._block_cells(make(80, [base] * 5000), 75).count() == 0  # 86 are needed
    rows = jaccard_join._block_cells(make(100, [base] * 5000), 75)
    blocks = rows.select("x").distinct().count()
    assert rows.count() == 5000 * blocks and rows.where("left").select("id").distinct().count() == 5000


def test_long_texts_in_parts(monkeypatch):
    from sessionloom.llm import shingles

    rng = random.Random(4)
    for n in (0, 3, 5, 6, 4000):
        text = "  ".join("".join(rng.choice("aBc") for _ in range(rng.choice([1, 3, 400]))) for _ in range(n)) + " "
        want = shingles._sets([text], 5)[0]
        for long in (10, 1000):
            monkeypatch.setattr(shingles, "LONG", long)
            assert (shingles._long_set(text, 5) == want).all() and shingles._long_set(text, 5).size == want.size


def test_helper_columns_of_the_input_stay(docs_of):
    docs = docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")])
    for name in ("_row_sha", "_stay_id", "_STAY_SHA", "stay_rows", "digest", "text_sha256", "keep_id", "n", "first", "locator", "bits", "bucket", "place"):
        docs = docs.withColumn(name, F.lit(name))
    kept = exact_dedup.keep_rows(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in docs.collect() if r["doc_id"] != 2)
    near = jaccard_join.keep_one(docs.withColumn("_stay", F.lit(1)))
    assert "_stay" in near.columns and sorted(r["doc_id"] for r in near.collect()) == [1, 3]


def test_hot_digest_in_the_stream(docs_of):
    """Copies with very many rows, among them one whose digest collides: found by the least and the greatest text."""
    given = [(k, "same") for k in range(300)] + [(k, f"t{k}") for k in range(300, 400)] + [(900, "abcd")]
    digest = lambda t: F.unhex(F.lpad(F.hex(F.length(t)), 4, "0"))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(docs_of(given), digest=digest).collect()}
    assert got == {k: (0, 300) for k in range(300)} | {k: (k, 1) for k in (*range(300, 400), 900)}


def test_rows_of_one_doc_id_stay_together(docs_of):
    words = " ".join(f"w{k}" for k in range(30))
    docs = docs_of([(1, words), (2, words + " z"), (2, "other text of five words"), (3, None), (None, words)])
    assert sorted(str(r["doc_id"]) for r in jaccard_join.keep_one(docs).collect()) == ["1", "3", "None"]
