"""Timers, initial state, the polling source and the stability gate."""

import time
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sessionloom.sources import polling
from sessionloom.streaming import stateful as S
from sessionloom.streaming import watch

QUEUE = "q string, item string, at double"


@pytest.fixture
def stored(spark):
    S.with_rocksdb(spark)
    yield
    spark.conf.unset(S.PROVIDER[0])


def sink(path):
    return lambda b, k: b.write.mode("overwrite").parquet(f"{path}/run={k}")


def read(spark, path):
    try:
        return spark.read.parquet(str(path)).collect()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
            return []
        raise


def test_batches_close_by_the_clock(spark, tmp_path, stored):
    """Three items close their batch after the time, with no further input; a query that was stopped before goes on with the open batch."""
    put = lambda rows: spark.createDataFrame(rows, QUEUE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put([("a", "1", 1.0), ("a", "3", 3.0), ("a", "2", 2.0), ("b", "0", 0.0)] + [("b", str(k), float(k)) for k in range(1, 7)] + [(None, "x", 1.0), ("a", None, 1.0)])
    stream = spark.readStream.schema(QUEUE).parquet(str(tmp_path / "in"))
    # every 100 ms, as long as asked
    def run(until, seconds=60.0):
        q = S.timed_batches(stream, "q", "item", "at", most=5, seconds=6.0).writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="100 milliseconds").foreachBatch(sink(tmp_path / "out")).start()
        began = time.time()
        while not until() and time.time() - began < seconds and q.isActive:
            time.sleep(0.1)
        q.stop()
        assert q.exception() is None

    got = lambda: sorted((r["q"], r["batch"], r["items"], r["closed_by"]) for r in read(spark, tmp_path / "out"))
    run(lambda: len(got()) >= 1)
    assert got() == [("b", 0, ["0", "1", "2", "3", "4"], "size")]  # the full one only
    run(lambda: len(got()) >= 3)
    assert got() == [("a", 0, ["1", "2", "3"], "time"), ("b", 0, ["0", "1", "2", "3", "4"], "size"), ("b", 1, ["5", "6"], "time")]
    put([("a", str(k), float(k)) for k in range(10, 17)])
    run(lambda: len(got()) >= 5)
    assert [r for r in got() if r[0] == "a"][1:] == [("a", 1, ["10", "11", "12", "13", "14"], "size"), ("a", 2, ["15", "16"], "time")]


def test_seeded_names_are_never_given_out(spark, tmp_path, stored):
    put = lambda rows: spark.createDataFrame(rows, QUEUE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seed = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "q string")
    put([("a", "1", 1.0), ("b", "later", 2.0), ("b", "first", 1.0), (None, "x", 0.0)])
    stream = spark.readStream.schema(QUEUE).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second time from the checkpoint, with nothing new
        watch.drain(S.unprocessed(stream, "q", "at", seed), sink(tmp_path / "out"), str(tmp_path / "state"))
        assert sorted((r["q"], r["item"]) for r in read(spark, tmp_path / "out")) == [("b", "first")]
    put([("a", "2", 9.0), ("b", "again", 9.0), ("c", "1", 9.0), ("z", "1", 9.0)])
    watch.drain(S.unprocessed(stream, "q", "at", seed), sink(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted((r["q"], r["item"]) for r in read(spark, tmp_path / "out")) == [("b", "first"), ("c", "1")]
    watch.drain(S.unprocessed(stream, "q", "at"), sink(tmp_path / "all"), str(tmp_path / "state2"))
    assert sorted(r["q"] for r in read(spark, tmp_path / "all")) == ["a", "b", "c", "z"]


@pytest.fixture
def disk(tmp_path):
    top = tmp_path / "disk"

    def put(name, text, folder="day"):
        path = top / folder / name / "cameras"
        path.mkdir(parents=True, exist_ok=True)
        (path / "x.jsonl").write_text(text)

    top.mkdir()
    return top, put


def test_polls_give_each_change_once(spark, tmp_path, disk):
    import shutil

    top, put = disk
    stream = polling.polled(spark, [str(top)], str(tmp_path / "polls"), parts=3)
    got = lambda: sorted((r["run"], r["name"][-1], r["change"], r["size"]) for r in read(spark, tmp_path / "out"))
    poll = lambda: watch.drain(stream, sink(tmp_path / "out"), str(tmp_path / "state"))
    poll()
    put("session_1_a", "xx"), put("session_1_b", "y", "other/deep"), put("no", "z"), put(".session_1_h", "z")
    poll()
    put("session_1_a", "xxx"), put("session_1_c", "1")
    shutil.rmtree(top / "other/deep/session_1_b")
    poll()
    poll()
    assert [g[1:] for g in got()] == [("a", "new", 2), ("b", "new", 1), ("a", "changed", 3), ("b", "gone", None), ("c", "new", 1)]
    # a batch that was planned and read, but not finished, comes again as it was, whatever has happened meanwhile
    put("session_1_d", "1")

    def fails(b, k):
        b.write.mode("overwrite").parquet(str(tmp_path / "lost"))
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        watch.drain(stream, fails, str(tmp_path / "state"))
    assert [r["name"][-1] for r in read(spark, tmp_path / "lost")] == ["d"]
    put("session_1_d", "22"), put("session_1_e", "1")
    poll()
    assert [g[1:] for g in got()][5:6] == [("d", "new", 1)]
    poll()
    assert [g[1:] for g in got()][5:] == [("d", "new", 1), ("d", "changed", 2), ("e", "new", 1)]
    # a poll that was planned and never read is listed when it is
    with pytest.raises(Exception, match="killed"):
        watch.drain(stream, lambda b, k: (_ for _ in ()).throw(RuntimeError("killed")), str(tmp_path / "state"))
    put("session_1_f", "1")
    poll(), poll()
    assert [g[1:] for g in got()][8:] == [("f", "new", 1)]
    assert len(list((tmp_path / "polls").iterdir())) <= 2 * 3 and not list((tmp_path / "polls").glob("draft*"))


def test_doubled_task_gives_the_first_ones_rows(tmp_path, disk):
    top, put = disk
    reader = polling.PollReader({"path": str(top), "state": str(tmp_path / "polls"), "parts": "1"})
    put("session_1_a", "x")
    part, = reader.partitions({"poll": 0}, reader.latestOffset())
    first = list(reader.read(part))
    put("session_1_b", "x")
    assert list(reader.read(part)) == first and len(first) == 1
    # both have begun to list: who writes first is right
    made = reader._listed(0, 1)
    assert [r[0] for r in made["rows"]] == ["session_1_a"]
    # after a restart the next poll's number comes after those on disk, and commit keeps the base
    again = polling.PollReader({"path": str(top), "state": str(tmp_path / "polls"), "parts": "1", "seconds": "3600"})
    assert again.latestOffset() == {"poll": 2} == again.latestOffset()
    assert [r[0] for r in again.read(again.partitions({"poll": 1}, {"poll": 2})[0])] == ["session_1_b"]
    again.commit({"poll": 2})
    assert again._files() == [(0, 2)]


def test_polls_feed_the_gate(spark, tmp_path, disk):
    top, put = disk
    polls = polling.polled(spark, [str(top)], str(tmp_path / "polls"), unchanged=True, parts=2)
    gate = watch.stability_gate(polls.select("name", "size", "mtime", "observed_at"), 1.0)
    poll = lambda: watch.drain(gate, sink(tmp_path / "out"), str(tmp_path / "state"))
    put("session_1_a", "x"), put("session_1_b", "x")
    poll()
    put("session_1_b", "grows")
    time.sleep(1.1)
    poll()
    assert [r["name"] for r in read(spark, tmp_path / "out")] == ["session_1_a"]
    time.sleep(1.1)
    poll(), poll()
    assert sorted(r["name"] for r in read(spark, tmp_path / "out")) == ["session_1_a", "session_1_b"]


def plain_gate(listings, stable):
    held, out = {}, []
    for name, size, mtime, at in sorted(listings, key=lambda r: r[3]):
        if size is None:
            held.pop(name, None)
        elif name not in held or held[name][:2] != (size, mtime):
            held[name] = (size, mtime, at, False)
        elif not held[name][3] and at - held[name][2] >= stable:
            held[name] = (*held[name][:3], True)
            out.append((name, size, mtime, held[name][2], at))
    return sorted(out)


def test_gate_rows_at_random():
    """Any cut of a name's listings into micro-batches gives what the plain loop gives."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 30))
        t = pd.DataFrame({"size_": [None if x == 0 else float(x) for x in rng.integers(0, 3, n)], "mtime": rng.integers(0, 2, n).astype(float), "observed_at": np.cumsum(rng.integers(1, 4, n)).astype(float)})
        held, out = None, []
        for part in np.array_split(t, rng.integers(1, 4)):
            if len(part):
                found, held = watch.gate_rows(part, held, 3.0)
                out += found
        want = plain_gate([("n", None if pd.isna(a) else int(a), b, c) for a, b, c in t.itertuples(index=False)], 3.0)
        assert sorted(("n", *r) for r in out) == want


def test_gate_keeps_the_order_of_a_large_name(spark, tmp_path):
    """25,000 shuffled listings of one name come in several tables."""
    rows = spark.range(25_000).select(F.lit("n").alias("name"), F.lit(5).alias("size"), F.lit(1.0).alias("mtime"), F.col("id").cast("double").alias("observed_at"))
    rows.orderBy(F.rand(3)).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    watch.drain(watch.stability_gate(stream), sink(tmp_path / "out"), str(tmp_path / "state"))
    (r,) = read(spark, tmp_path / "out")
    assert (r["since"], r["emitted_at"]) == (0.0, 60.0)


def test_batches_by_items_times_in_any_order(spark, tmp_path):
    rng = np.random.default_rng(4)
    at = rng.permutation(30_000)
    rows = spark.createDataFrame(pd.DataFrame({"q": "a", "item": at, "at": at / 10.0}))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    watch.drain(watch.batched(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "q", "item", "at", 50, 20.0), sink(tmp_path / "out"), str(tmp_path / "state"))
    got = defaultdict(list)
    for r in read(spark, tmp_path / "out"):
        got[r["batch"]].append(r["item"])
    assert [sorted(got[k]) for k in sorted(got)] == [list(range(k, k + 50)) for k in range(0, 30_000, 50)]
