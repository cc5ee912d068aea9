"""Stateful processors with timers and an initial state: batches that close by size or by the clock, and names that are handled once.

They keep their state in RocksDB (`with_rocksdb`), so it isn't bounded by an executor's memory, and go on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def with_rocksdb(spark: SparkSession) -> None:
    """Processors of this module need a store with column families."""
    spark.conf.set(*PROVIDER)


class _Batches(StatefulProcessor):
    """The open batch's items, its number and its first item's time; a timer stands at the end of an open batch's time."""

    def __init__(self, key: str, most: int, ms: int):
        self.key, self.most, self.ms = key, most, ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", "item string")
        self.head = handle.getValueState("head", "number long, count long, timer long")

    def _closed(self, key, number: int, items: list[str], by: str) -> dict:
        return {self.key: key[0], "batch": number, "items": items, "closed_by": by}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number, count, timer = self.head.get() if self.head.exists() else (0, 0, 0)
        new = pd.concat(list(rows)).sort_values(["at_", "item_"], kind="stable")["item_"].tolist()
        waiting = [r[0] for r in self.items.get()] if count else []
        out = []
        while count + len(new) >= self.most:
            take = self.most - count
            out.append(self._closed(key, number, waiting + new[:take], "size"))
            new, waiting, number, count = new[take:], [], number + 1, 0
            if timer:
                self.handle.deleteTimer(timer)
            timer = 0
        if new:
            if not count:
                self.items.clear()
                timer = timerValues.getCurrentProcessingTimeInMs() + self.ms
                self.handle.registerTimer(timer)
            self.items.appendList([(x,) for x in new])
            count += len(new)
        elif not count:
            self.items.clear()
        self.head.update((number, count, timer))
        yield pd.DataFrame(out, columns=[self.key, "batch", "items", "closed_by"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, count, timer = self.head.get()
        if not count or expiredTimerInfo.getExpiryTimeInMs() != timer:
            yield pd.DataFrame([], columns=[self.key, "batch", "items", "closed_by"])
            return
        items = [r[0] for r in self.items.get()]
        self.items.clear()
        self.head.update((number + 1, 0, 0))
        yield pd.DataFrame([self._closed(key, number, items, "time")])

    def close(self) -> None:
        pass


def timed_batches(stream: DataFrame, key: str, item: str, at: str, most: int = 50, seconds: float = 20.0) -> DataFrame:
    """key, batch, items, closed_by (size, time) of a queue: a batch closes with its `most`-th item, or `seconds` after its first one came, without a further item.

    Items of one micro-batch come in order of (at, item). Batches are numbered from 0 for each key; after a restart the open batch and its timer go on.
    An open batch holds fewer than `most` items. Rows with a null key or item are left out.
    """
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key), F.col(item).cast("string").alias("item_"), F.col(at).cast("double").alias("at_")).where(F.col(key).isNotNull() & F.col("item_").isNotNull())
    return rows.groupBy(key).transformWithStateInPandas(_Batches(key, most, round(seconds * 1000)), f"{key} {kind}, batch long, items array<string>, closed_by string", "append", "processingTime")


class _Once(StatefulProcessor):
    """Whether a key was handled."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "done boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.done.update((True,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.done.exists():
            yield pd.DataFrame([], columns=self.columns)
            return
        first = pd.concat(list(rows)).sort_values("order_", kind="stable").head(1)
        self.done.update((True,))
        yield first[self.columns]

    def close(self) -> None:
        pass


def unprocessed(stream: DataFrame, key: str, order: str, seed: DataFrame | None = None) -> DataFrame:
    """The first row (by `order` within a micro-batch) of each key that no row was given out for, and that the seed lacks.

    seed: a table with the keys that were handled before this query existed; it becomes the initial state of a new query's checkpoint, and a
    restarted query goes on from its own state, in which it is included. The state holds a mark for each key, without expiry. Rows with a null key are left out.
    """
    columns = stream.columns
    rows = stream.withColumn("order_", F.col(order)).where(F.col(key).isNotNull())
    start = None if seed is None else seed.select(F.col(key).cast(stream.schema[key].dataType).alias(key)).where(F.col(key).isNotNull()).distinct().groupBy(key)
    return rows.groupBy(key).transformWithStateInPandas(_Once(columns), stream.schema, "append", "none", initialState=start)
