"""Operator 4 by held-out accuracy, the SQL oracles, and the pipeline."""

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import language_id, queries
from sessionloom.llm.common import table

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_grams_by_definition():
    def plain(text):
        s = "".join(c.lower() if c.isalpha() else " " for c in text or "")
        s = " ".join(s.split()) + " " if s.strip() else ""
        if (text or " ")[0].isalpha() or not s:
            pass
        return ["   " + s][0]

    for t in ["Ab, c1d", None, "", "123", "é" * 5]:
        keys, at, n = language_id.grams([t])
        s = plain(t)
        want = [s[k : k + 4] for k in range(len(s) - 3)] if s.strip() else []
        got = ["".join(chr(int(k) >> 16 * i & 0xFFFF) for i in (3, 2, 1, 0)) for k in keys]
        assert got == want and at.tolist() == [0, len(want)] and n[0] == sum(c.isalpha() for c in t or "")


def test_probabilities_sum_to_one():
    import numpy as np

    keys, _, _ = language_id.grams(["the cat sat on the mat and the hat", "a cat"])
    model = language_id.KneserNey(*np.unique(keys, return_counts=True))
    every = np.arange(1 << 16, dtype=np.uint64)
    for context in ("the", " ca", "zzz"):
        base = np.uint64(sum(ord(c) << 16 * (3 - k) for k, c in enumerate(context)))
        assert abs(np.exp(model.log_p(base + every)).sum() - 1) < 1e-3


def normal(text):
    """Letters in lower case, runs of anything else as one space, three spaces before and one behind."""
    low = lambda c: c.lower() if len(c.lower()) == 1 else c
    words = "".join(low(c) if unicodedata.category(c)[0] == "L" else " " for c in text or "")
    s = re.sub(" +", " ", words)
    return "   " + (s if s.endswith(" ") else s + " ") if s.strip() else ""


class PlainKneserNey:
    """The interpolated model by its definition, with dictionaries and recursion."""

    def __init__(self, texts):
        grams = Counter(s[i : i + 4] for s in map(normal, texts) for i in range(len(s) - 3))
        self.tables = {}
        for order in (4, 3, 2, 1):
            once, twice = (sum(n == k for n in grams.values()) for k in (1, 2))
            d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
            total, types = Counter(), Counter()
            for g, n in grams.items():
                total[g[:-1]] += n
                types[g[:-1]] += 1
            self.tables[order] = grams, total, types, d
            grams = Counter(g[1:] for g in grams)

    def p(self, gram):
        if not gram:
            return 1 / 65_536
        grams, total, types, d = self.tables[len(gram)]
        if not total[gram[:-1]]:
            return self.p(gram[1:])
        return (max(grams[gram] - d, 0) + d * types[gram[:-1]] * self.p(gram[1:])) / total[gram[:-1]]

    def surprisals(self, text):
        s = normal(text)
        return [-math.log(self.p(s[i : i + 4])) for i in range(len(s) - 3)]


@pytest.fixture(scope="module")
def fifty():
    import pandas as pd

    return pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text", "lang"]].dropna().head(50)


def test_models_are_plain_kneser_ney(fifty):
    langs = sorted(set(fifty.lang))
    plain = {x: PlainKneserNey(fifty.text[fifty.lang == x]) for x in langs}
    model = language_id.LanguageModel({x: language_id.KneserNey(*np.unique(language_id.grams(list(fifty.text[fifty.lang == x]))[0], return_counts=True)) for x in langs})
    probes = [t[:300] for t in fifty.text[:12]] + ["Zürich 漢字 x", "a"]
    h, size, _, square = model.measures(probes, squares=True)
    for i, t in enumerate(probes):
        for k, x in enumerate(langs):
            want = plain[x].surprisals(t)
            assert size[i] == len(want) and abs(h[i, k] - np.mean(want)) < 1e-3 and abs(square[i, k] - np.mean(np.square(want))) < 1e-2


def test_long_texts_in_windows(fifty, monkeypatch):
    model = language_id.LanguageModel({"x": language_id.KneserNey(*np.unique(language_id.grams(list(fifty.text))[0], return_counts=True))})
    texts = [fifty.text.iloc[0] * 3, None, "漢字" * 500, " . " * 300, "a", fifty.text.iloc[1] + " ... " * 50]
    want, counted = model.measures(texts, squares=True), np.sort(language_id.grams(texts)[0])
    for window in (7, 64, 1000):
        monkeypatch.setattr(language_id, "WINDOW", window)
        got = model.measures(texts, squares=True)
        for a, b in zip(got, want, strict=True):
            assert np.allclose(a, b, equal_nan=True)
        assert (np.sort(np.concatenate([k for _, k, _, _ in language_id.parts(texts)])) == counted).all()


def test_counts_keep_a_fixed_size(monkeypatch):
    monkeypatch.setattr(language_id, "COUNT_BITS", 4)
    monkeypatch.setattr(language_id._Counts, "MOST", 100)
    rng = np.random.default_rng(1)
    held, want, got = language_id._Counts(), Counter(), Counter()
    batches = []
    for _ in range(30):
        lang, keys = "ab"[rng.integers(2)], rng.integers(0, 60, 40).astype(np.uint64) << np.uint64(50)
        want.update((lang, int(k)) for k in keys)
        batches += held.add(lang, keys)
        assert held.size <= 140
    for b in [*batches, *held.all()]:
        for r in b.to_pylist():
            got[r["lang"], r["gram"] % (1 << 64)] += r["n"]
    assert got == want


def test_noise_and_a_language_left_out_are_rejected(spark):
    """Learned from three languages of the table: held-out rows of these stay but for one in a hundred, the fourth language and noise go."""
    import random

    docs = table(spark, SF_MORE, "documents").select("doc_id", "text", "lang").where("length(text) >= 200")
    rng = random.Random(6)
    noise = [(10**6 + k, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(400)), "noise") for k in range(60)]
    model = language_id.learn(docs.where("lang != 'de'"))
    assert "de" not in model.langs and np.isfinite(model.limit).all() and (model.spread > 0).all()
    rows = docs.union(spark.createDataFrame(noise, docs.schema))
    got = language_id.identify(rows, model).join(rows.select("doc_id", "lang"), "doc_id").collect()
    share = lambda pick: (lambda x: sum(r["rejected"] for r in x) / len(x))([r for r in got if pick(r)])
    assert share(lambda r: r["lang"] == "noise") == 1.0
    assert share(lambda r: r["lang"] == "de") >= 0.9
    assert share(lambda r: r["lang"] in model.langs and r["held_out"]) <= 0.01


def test_held_out_accuracy(spark):
    docs = table(spark, SF_MORE, "documents")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.97 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark, docs_of):
    given = [(k, t) for k, t in enumerate(["the cat and the dog " * 9, "le chat et le chien " * 9] * 12)] + [(50, None), (51, "12 + 3"), (52, "漢字" * 60), (53, "the")]
    lang = {k: ["en", "fr"][k % 2] for k in range(24)} | {50: None, 51: "en", 52: None, 53: None}
    docs = docs_of(given, lang)
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert all(got[k]["lang_pred"] == lang[k] and not got[k]["rejected"] for k in range(24))
    assert got[50]["lang_pred"] == got[51]["lang_pred"] == "und" and got[52]["rejected"] and got[53]["lang_pred"] == "en" and not got[53]["rejected"]
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [*range(24), 53]
    empty = language_id.identify(docs_of([]))
    assert empty.count() == 0
    alone = language_id.identify(docs_of([(1, "no label")], {1: None})).first()
    assert (alone["lang_pred"], alone["score"]) == ("und", 0.0)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    text = lambda df: sorted(tuple(map(str, r)) for r in df[columns].itertuples(index=False, name=None))
    assert text(got) == text(want)


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    n = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, SF), "test")
        if k < 3:
            assert docs.columns == before.columns and docs.exceptAll(before).count() == 0
    assert n >= before.count() > 0.7 * n
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == {r["doc_id"] for r in before.select("doc_id").collect()}


def test_models_keep_all_grams(spark):
    """Tables by Spark are KneserNey's own over all counts, also beyond the former 400,000 4-grams of a language."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    keys, _, _ = language_id.grams(["the cat sat on the mat and the hat", "漢字가나다 漢字 a cat", "힣￠Ａ" * 4])
    few = np.unique(keys, return_counts=True)
    code = rng.integers(0x4E00, 0xD7A0, (450_000, 4)).astype(np.uint64)
    many = np.unique(code[:, 0] << np.uint64(48) | code[:, 1] % np.uint64(64) << np.uint64(32) | code[:, 2] % np.uint64(64) << np.uint64(16) | code[:, 3], return_counts=True)
    many = many[0], many[1] + (np.arange(many[0].size) % 4 == 0)
    assert many[0].size > 400_000 and (many[0] >> np.uint64(63)).any()
    import pandas as pd

    given = spark.createDataFrame(pd.concat([pd.DataFrame({"lang": x, "gram": k.view(np.int64), "n": n.astype(np.int64)}) for x, (k, n) in (("few", few), ("many", many))]))
    made = language_id.written_models(given.repartition(8, F.col("gram")))
    for lang, (k, n) in (("few", few), ("many", many)):
        probe = np.unique(np.concatenate([k, k ^ np.uint64(1), rng.integers(0, 1 << 63, 1000).astype(np.uint64), few[0]]))
        assert np.allclose(made[lang].log_p(probe), language_id.KneserNey(k, n).log_p(probe), rtol=1e-5)


def plain_pipeline(rows):
    """doc_id -> text of what reaches the packing, by plain Python: languages, exact copies, near copies."""
    train = [r for r in rows if r["text"] is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    calibrates = {r["doc_id"] for r in train if r["calibrates"]}
    langs = sorted({r["lang"] for r in train if r["doc_id"] not in calibrates})
    models = {x: PlainKneserNey([r["text"] for r in train if r["lang"] == x and r["doc_id"] not in calibrates]) for x in langs}
    letters = lambda t: sum(unicodedata.category(c)[0] == "L" for c in t)
    limit, spread = {}, {}
    for x in langs:
        own = [(letters(r["text"]), models[x].surprisals(r["text"])) for r in train if r["lang"] == x and r["doc_id"] in calibrates and letters(r["text"])]
        sure = [np.mean(s) for n, s in own if n >= 40]
        limit[x], spread[x] = 1.1 * max(sure) if sure else 5.0, math.sqrt(np.mean([np.var(s) for _, s in own])) if own else 0.0
    kept = {}
    for r in rows:
        t = r["text"] or ""
        if not letters(t):
            continue
        s = {x: models[x].surprisals(t) for x in langs}
        best = min(langs, key=lambda x: np.mean(s[x]))
        if letters(t) < 40 or np.mean(s[best]) <= limit[best] + 3 * spread[best] / math.sqrt(len(s[best])):
            kept[r["doc_id"]] = t
    first = {}
    for k in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[k]), k)
    kept = {k: kept[k] for k in first.values()}
    sets = {}
    for k, t in kept.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {k: k for k in kept}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: t for k, t in kept.items() if root(k) == k}


def test_pipeline_is_plain_python(spark, tmp_path):
    """run() on a small table with odd rows: the same documents reach the packing, whose pieces are the library's and lie without gaps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents").limit(120)
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "12 34"), (10**6 + 3, "a\t b  c"), (10**6 + 4, "a b c"), (10**6 + 5, "ab cd " * 4000)]
    more = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True).withColumn("length", F.lit("clash"))
    more.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r.asDict() for r in more.withColumn("calibrates", language_id.calibrates(F.col("doc_id"))).collect()]
    want = plain_pipeline(rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == set(want)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, t in want.items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        cuts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        assert sorted(pieces[k]) == [(i, i * 4096, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for i, c in enumerate(cuts)]
    for spots in places.values():
        spots.sort()
        assert [o for o, _ in spots] == [0, *np.cumsum([n for _, n in spots])[:-1]] and sum(n for _, n in spots) <= 4096
    assert len(places) <= 1.1 * math.ceil(sum(n for x in places.values() for _, n in x) / 4096) + 1


def test_pipeline_of_nothing(spark, tmp_path):
    table(spark, SF, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
