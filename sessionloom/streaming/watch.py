"""Continuous discovery: stability gate, processed-set deduplication, running totals, idempotent ledger, heartbeat."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STABLE_SECONDS = 60.0
GATE = "name string, size long, mtime double, since double, emitted_at double"


def gate_rows(t: pd.DataFrame, held: tuple | None, stable: float) -> tuple[list[tuple], tuple | None]:
    """(size, mtime, since, emitted_at) of the listings t (in order of time) of one name that pass the gate, and what is known after them: size, mtime, since, emitted."""
    gone = t["size_"].isna().to_numpy()
    size, mtime, at = t["size_"].fillna(-1).to_numpy(np.int64), t["mtime"].to_numpy(float), t["observed_at"].to_numpy(float)
    if held is not None:  # the last state goes on as a row of its own
        gone, size, mtime, at = np.append(False, gone), np.append(held[0], size), np.append(held[1], mtime), np.append(held[2], at)
    if not at.size:
        return [], held
    new = np.append(True, (size[1:] != size[:-1]) | (mtime[1:] != mtime[:-1]) | gone[1:] | gone[:-1])
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    ripe = ~gone & (at - at[first][run] >= stable)
    ripe[first] = False  # the listing that begins a wait doesn't end it
    if held is not None and held[3]:
        ripe[run == 0] = False
    k = np.flatnonzero(ripe)
    k = k[np.unique(run[k], return_index=True)[1]]  # once for each wait
    out = [(int(size[j]), float(mtime[j]), float(at[first[run[j]]]), float(at[j])) for j in k.tolist()]
    if gone[-1]:
        return out, None
    done = bool(ripe[run == run[-1]].any()) or (held is not None and held[3] and run[-1] == 0)
    return out, (int(size[-1]), float(mtime[-1]), float(at[first[-1]]), done)


def stability_gate(seen: DataFrame, stable: float = STABLE_SECONDS) -> DataFrame:
    """Names whose (size, mtime) has not changed for `stable` seconds of observation time, each once per state.

    seen: name, size, mtime, observed_at (seconds) of successive listings. A change starts the wait anew; a listing row
    with a null size means that the name is gone, which forgets it. A micro-batch's listings of a name are put in order together, however
    many tables they come in.
    """

    def run(key, tables: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out, held = gate_rows(pd.concat(list(tables)).sort_values("observed_at", kind="stable"), state.get if state.exists else None, stable)
        if held is not None:
            state.update(held)
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(key[0], *r) for r in out], columns=["name", "size", "mtime", "since", "emitted_at"])

    rows = seen.select("name", F.col("size").cast("long").alias("size_"), F.col("mtime").cast("double").alias("mtime"), F.col("observed_at").cast("double").alias("observed_at"))
    return rows.groupBy("name").applyInPandasWithState(run, GATE, "size long, mtime double, since double, emitted boolean", "append", GroupStateTimeout.NoTimeout)


def never_twice(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key over the life of the query (state without expiry)."""
    return stream.dropDuplicates(keys)


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("largest"))


def tumbling(stream: DataFrame, at: str, width: str, late: str, keys: list[str] = ()) -> DataFrame:
    """Counts in event-time windows, with a watermark. NTZ times are cast, since watermarks need a time zone."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, width), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def drain(stream: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there now; sink(batch, id) gets each micro-batch."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()


def collect_stream(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All output of a stream over what is there now, as a table (small results: tests and reports)."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def ledger_sink(path: str, keys: list[str]):
    """A foreachBatch sink that appends rows whose keys the ledger lacks, so a repeated batch adds nothing."""
    from sessionloom.operators.ledger import append_once

    def sink(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            ledger = spark.read.schema(batch.schema).parquet(path)
            ledger.take(1)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            ledger = spark.createDataFrame([], batch.schema)
        append_once(ledger, batch, keys).write.mode("append").parquet(path)

    return sink


def heartbeat(disks: DataFrame, at, host: str) -> DataFrame:
    """One JSON message for each disk (disk_uuid, label, total_bytes, free_bytes): the value a message queue would get."""
    gb = lambda c: F.round(F.round(c / 1e9, 6), 1)
    used = F.col("total_bytes") - F.col("free_bytes")
    pct = F.round(F.round(F.coalesce(F.try_divide(100.0 * used, F.col("total_bytes")), F.lit(0.0)), 6), 1)
    message = F.struct(F.lit(host).alias("host"), "disk_uuid", "label", gb(F.col("total_bytes")).alias("total_gb"), gb(F.col("free_bytes")).alias("free_gb"), pct.alias("used_pct"), F.lit(at).alias("at"))
    return disks.select(F.col("disk_uuid").alias("key"), F.to_json(message).alias("value"))


def snapshots(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A stream of listings: each poll writes one file of rows (name, size, mtime, observed_at) to the folder. The bound on files for each trigger keeps a slow consumer from being flooded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def attempts(outcomes: DataFrame) -> DataFrame:
    """name, tries, state of rows (name, ok, at): the last outcome decides; what failed is pending and tried again, without a limit."""
    out = outcomes.groupBy("name").agg(F.count(F.lit(1)).alias("tries"), F.max_by("ok", "at").alias("ok"))
    return out.select("name", "tries", F.when(F.col("ok"), "done").otherwise("pending").alias("state"))


def batched(stream: DataFrame, key: str, item: str, at: str, most: int = 50, seconds: float = 20.0) -> DataFrame:
    """key, item, batch: a queue's items in batches of `most`, or of those that come within `seconds` of a batch's first one, by the items' own times.

    A batch's number is known when an item comes; see `stateful.timed_batches` for batches that close by the clock.
    """

    def run(k, tables: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch, count, first = state.get if state.exists else (0, 0, 0.0)
        t, numbers = pd.concat(list(tables)).sort_values(["at_", "item_"], kind="stable"), []
        for x in t["at_"]:
            if count and (count >= most or x - first >= seconds):
                batch, count = batch + 1, 0
            first = x if not count else first
            count += 1
            numbers.append(batch)
        state.update((batch, count, first))
        yield pd.DataFrame({key: k[0], item: t["item_"], "batch": numbers})

    rows = stream.select(key, F.col(item).cast("long").alias("item_"), F.col(at).cast("double").alias("at_"))
    kind = stream.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, {item} long, batch long", "batch long, count long, first double", "append", GroupStateTimeout.NoTimeout)


def throttled(recompute: Callable[[SparkSession], None], seconds: float = 60.0, clock: Callable[[], float] = time.monotonic):
    """A foreachBatch sink that recomputes an aggregate when there are new rows, and not more often than every `seconds`; what was put off is done with the next batch."""
    state = {"last": None, "new": False}

    def sink(batch: DataFrame, _: int) -> None:
        state["new"] = state["new"] or bool(batch.take(1))
        now = clock()
        if state["new"] and (state["last"] is None or now - state["last"] >= seconds):
            recompute(batch.sparkSession)
            state.update(last=now, new=False)

    return sink


class Snapshot:
    """A table that is loaded anew when it is older than `ttl` seconds; a load that fails keeps the last one."""

    def __init__(self, load: Callable[[], DataFrame], ttl: float = 120.0, clock: Callable[[], float] = time.monotonic):
        self.load, self.ttl, self.clock = load, ttl, clock
        self.table: DataFrame | None = None
        self.at = 0.0

    def get(self) -> DataFrame:
        now = self.clock()
        if self.table is None or now - self.at >= self.ttl:
            try:
                self.table = self.load()
            except Exception:
                if self.table is None:
                    raise
            self.at = now
        return self.table


def staged(stream: DataFrame, stages: list[Callable[[DataFrame], DataFrame]], sinks: list[Callable[[DataFrame, int], None]], checkpoint: str) -> None:
    """Each micro-batch goes through all stages, and each stage's rows are written before the next one starts; so a stage never runs ahead of the one after it."""

    def sink(batch: DataFrame, k: int) -> None:
        for stage, write in zip(stages, sinks, strict=True):
            batch = stage(batch)
            write(batch, k)

    drain(stream, sink, checkpoint)


def file_stream(spark: SparkSession, folder: str, schema, name: str) -> DataFrame:
    """A stream over one file of a folder, as file streams need a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
