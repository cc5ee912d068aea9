"""Partitions rebuilt as a write, walks in rounds, thinned events, and medians by counting."""

import os
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.operators import aggregates as A
from sessionloom.operators import ledger as L
from sessionloom.plans import reports as R
from sessionloom.sources import inventory as I


def test_partitions_are_rebuilt_once(spark, tmp_path):
    path = str(tmp_path / "kpi")
    make = lambda rows: spark.createDataFrame(rows, "day string, n int")
    assert L.write_partitions(make([("d1", 1), ("d2", 2), ("d3", 3), ("d4", 4)]), path, "day", ["d1", "d2", "d3", "d4"], "first")
    files = lambda: {str(p.relative_to(path)) for p in (tmp_path / "kpi").rglob("*.parquet")}
    rows = lambda: sorted((r["day"], r["n"]) for r in spark.read.parquet(path).collect())
    before = files()

    @F.udf("int")
    def fails(n):
        if n == 31:
            raise ValueError("half-way")
        return n

    # partitions written in other tasks don't show when one task fails
    with pytest.raises(Exception, match="half-way"):
        L.write_partitions(make([("d2", 21), ("d3", 31)]).repartition(2, "day").withColumn("n", fails("n")), path, "day", ["d2", "d3"], "second")
    assert files() == before and rows() == [("d1", 1), ("d2", 2), ("d3", 3), ("d4", 4)]
    # d3 has no rows any more
    for first in (True, False):
        assert L.write_partitions(make([("d2", 21), ("d2", 22)]), path, "day", ["d2", "d3"], "second") is first
        assert rows() == [("d1", 1), ("d2", 21), ("d2", 22), ("d4", 4)]
    assert {f for f in before if f.startswith(("day=d1", "day=d4"))} <= files() and not {f for f in files() if f.startswith("day=d3")}
    # a run that ended before its marker was written
    os.remove(tmp_path / "kpi/_runs/second")
    assert L.write_partitions(make([("d2", 21), ("d2", 22)]), path, "day", ["d2", "d3"], "second") and rows() == [("d1", 1), ("d2", 21), ("d2", 22), ("d4", 4)]
    with pytest.raises(ValueError, match="aren't to be rebuilt"):
        L.write_partitions(make([("d1", 9)]), path, "day", ["d2"], "third")


def test_walk_is_the_plain_inventory(spark, tmp_path):
    top = tmp_path / "disk"
    deep = top / "only/one/folder"
    for k in range(12):
        s = deep / f"session_202401{k + 1:02d}_000000"
        for sub in ("cameras/a/b", "sensors", "empty"):
            (s / sub).mkdir(parents=True)
        (s / "cameras/a/b/x.jsonl").write_text("x" * k)
        (s / "uploaded_sessions.json").write_text("inside a session")
    for path in ("only/.hidden/session_20240101_000000", "lost+found/session_20240101_000000", "only/sessions_envoyes", "1/2/3/4/5/6/session_20240102_000000", "1/2/3/4/5/6/7/session_20240103_000000"):
        (top / path).mkdir(parents=True)
        (top / path / "f").write_text("f")
    (top / "only/uploaded_sessions.json").write_text("{}")
    (deep / "uploaded_sessions.json").write_text("{}")
    os.symlink(deep, top / "link")
    for roots, rule in (([str(top)], "digit"), ([str(top / "only"), str(top / "1"), str(top / "nothing")], "stamp"), ([], "digit")):
        files, ledgers = I.walk(spark, roots, rule)
        want = sorted(map(tuple, I.inventory(spark, roots, rule).collect())) if roots else []
        assert sorted(map(tuple, files.collect())) == want
        assert {r["path"] for r in ledgers.collect()} == ({str(top / "only/uploaded_sessions.json"), str(deep / "uploaded_sessions.json")} if roots else set())
    # times of sub-folders count
    os.utime(deep / "session_20240105_000000/cameras/a", (1, 4e9))
    files, _ = I.walk(spark, [str(top)])
    assert {r["session"]: r["mtime"] for r in I.sessions(files).collect()}["session_20240105_000000"] == 4e9


def test_one_folder_uses_all_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / "top/one/deep" / f"session_2024010{k % 9 + 1}_{k:06d}" / "cameras").mkdir(parents=True)
    files, _ = I.walk(spark, [str(tmp_path / "top")], tasks=4)
    level = files.where("name = 'cameras'").select(F.input_file_name().alias("f")).distinct().count()
    assert files.where("name = 'cameras'").count() == 40 and level == 4


def test_events_kept_apart(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 3)), float(t)) for t in rng.uniform(0, 100, 200)] + [(9, 4.9), (9, 5.1), (9, 9.9)]
    want, last = [], {}
    for g, t in sorted(rows):
        if g not in last or t - last[g] >= 5:
            last[g] = t
            want.append((g, t))
    assert sorted(tuple(r) for r in R.kept_apart(spark.createDataFrame(rows, "g int, t double"), "g", "t", 5.0).collect()) == want
    # 0.2 s apart on the edge of a slot: one of them counts
    assert [t for g, t in want if g == 9] == [4.9, 9.9]


@pytest.mark.parametrize("most", [0, 3, 40, 10**6])
def test_medians_by_counting(spark, most, monkeypatch):
    monkeypatch.setattr(A, "CELLS", 4)
    rng = np.random.default_rng(most)
    groups = {"even": rng.normal(size=30), "odd": rng.normal(size=31) * 1e300, "ties": rng.integers(0, 3, 50), "same": np.full(20, 7.0), "pair": np.array([1.0, 2.0]), "one": np.array([5.0]), "wide": np.array([-1.7e308, 1.7e308, 1e-300, 3.0, 4.0])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("even", None), ("none", None), ("even", float("inf")), ("even", float("nan"))]
    got = {r["g"]: r["median"] for r in A.exact_medians(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", most).collect()}
    assert got.pop("none") is None
    assert set(got) == set(groups) and all(np.isclose(got[g], statistics.median(map(float, v)), rtol=1e-15) for g, v in groups.items())


def test_video_length_is_a_fifth_reason(spark):
    rows = spark.createDataFrame([("s", c, float(t)) for c in "abc" for t in range(10)], "s string, c string, t double")
    found = lambda videos: {r["c"]: r["confidence"] for r in A.median_outliers(rows, "s", "c", "t", videos=spark.createDataFrame(videos, "s string, c string, video_seconds double")).collect()}
    assert found([("s", "a", 10.0), ("s", "b", 10.0), ("s", "c", 5.0)]) == {"a": "OK", "b": "OK", "c": "LOW"}
    assert set(found([("s", "c", 5.0)]).values()) == {"OK"} == set(found([("s", "c", None)]).values())
