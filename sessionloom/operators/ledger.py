"""Ledgers: what was delivered, skipped or is pending; upserts and state changes as new tables, never in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the states of a batch and where each may go next.
TRANSITIONS = {"pending_validation": ("approved", "rejected"), "approved": ("sending",), "sending": ("sent", "send_failed"), "send_failed": ("sending",), "rejected": (), "sent": ()}


def not_in(rows: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(ledger.select(*keys).distinct(), keys, "left_anti")


def also_in(rows: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(ledger.select(*keys).distinct(), keys, "left_semi")


def restrict(rows: DataFrame, manifest: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows a manifest names, and the names it has that no row carries."""
    return also_in(rows, manifest, keys), not_in(manifest.select(*keys).distinct(), rows, keys)


def coverage_status(rows: DataFrame, key: str, delivered: DataFrame, sent: DataFrame, skipped: DataFrame) -> DataFrame:
    """rows with status: delivered before sent before skipped before pending."""
    mark = lambda df, name: df.select(key).distinct().withColumn(f"_{name}", F.lit(True))
    out = rows
    for df, name in ((delivered, "delivered"), (sent, "sent"), (skipped, "skipped")):
        out = out.join(mark(df, name), key, "left")
    status = F.when(F.col("_delivered"), "delivered").when(F.col("_sent"), "sent").when(F.col("_skipped"), "skipped").otherwise("pending")
    return out.withColumn("status", status).drop("_delivered", "_sent", "_skipped")


def coverage_totals(rows: DataFrame, bucket: str, size: str) -> DataFrame:
    """Counts and bytes of each bucket by status, and the covered share (100 where there is nothing)."""
    covered = F.col("status").isin("delivered", "sent")
    out = rows.groupBy(bucket).agg(
        *[F.count_if(F.col("status") == s).cast("long").alias(f"n_{s}") for s in ("delivered", "sent", "skipped", "pending")],
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.when(covered, F.col(size))), F.lit(0)).alias("covered_bytes"),
    )
    return out.withColumn("covered_pct", F.round(F.coalesce(F.try_divide(100.0 * F.col("covered_bytes"), F.col("bytes")), F.lit(100.0)), 4))


def pending_reason(issues: Column, errors: Column, otherwise: str = "not sent yet") -> Column:
    """The first two issues, else the first two errors, else a fixed text."""
    text = lambda a: F.when(F.size(a) > 0, F.array_join(F.slice(a, 1, 2), "; "))
    return F.coalesce(text(issues), text(errors), F.lit(otherwise))


def merge_ledgers(ledgers: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each name: that of the ledger read last."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return ledgers.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str], keep_first: bool) -> DataFrame:
    """All keys of both tables; where both have a value, the old one (keep_first) or the new one. New keys are added."""
    n = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    pick = lambda c: F.coalesce(*((F.col(c), F.col(f"_new_{c}")) if keep_first else (F.col(f"_new_{c}"), F.col(c)))).alias(c)
    rest = [F.col(c) for c in old.columns if c not in (key, *columns)]
    return old.join(n, key, "full_outer").select(F.col(key), *rest, *map(pick, columns))


def append_once(ledger: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append: those whose keys the ledger lacks, each once; so repeating a delivery changes nothing."""
    return not_in(rows.dropDuplicates(keys), ledger, keys)


def delete_cascade(parents: DataFrame, doomed: DataFrame, key: str, children: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables without the doomed keys, children first."""
    out = {name: not_in(child, doomed, [key]) for name, child in children.items()}
    return out | {"parents": not_in(parents, doomed, [key])}


def rebuild_partitions(snapshot: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """The snapshot with the groups of the fresh rows replaced."""
    return snapshot.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def write_partitions(fresh: DataFrame, path: str, key: str, values: list, run: str) -> bool:
    """Replace the partitions `values` of a table at path (partitioned by key) by the fresh rows, and say whether anything was done.

    The rows are staged by a dynamic partition overwrite and come into place when all are written, so a run that fails on the way changes nothing. Other
    partitions' files aren't touched. Values without fresh rows lose their partition. A marker then says that the run is done: repeating it does nothing, and
    repeating a run that ended before its marker does the same again. Fresh rows of other values are an error.
    """
    from sessionloom.session import path_exists

    spark = fresh.sparkSession
    marker = f"{path.rstrip('/')}/_runs/{run}"
    if path_exists(spark, marker):
        return False
    found = {r[0] for r in fresh.select(key).distinct().limit(len(values) + 1).collect()}  # a value for each partition to be rebuilt
    if not found <= set(values):
        raise ValueError(f"rows of partitions that aren't to be rebuilt: {sorted(map(str, found - set(values)))[:3]}")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for v in sorted(set(values) - found, key=str):
        store.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{key}={v}"), True)
    store.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_runs"))
    store.create(jvm.org.apache.hadoop.fs.Path(marker), True).close()
    return True


def mark_replicas(sessions: DataFrame, copied: DataFrame, key: str, column: str) -> DataFrame:
    return upsert(sessions, copied, key, [column], keep_first=False).join(sessions.select(key), key, "left_semi")


def advance(batches: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Batches after one event each (key, to_status); an event that its state doesn't allow changes nothing and is marked."""
    allowed = F.create_map(*[x for k, v in TRANSITIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    out = batches.join(events, key, "left")
    ok = F.coalesce(F.array_contains(F.try_element_at(allowed, F.col("status")), F.col("to_status")), F.lit(False))
    return out.withColumn("refused", F.col("to_status").isNotNull() & ~ok).withColumn("status", F.when(ok, F.col("to_status")).otherwise(F.col("status"))).drop("to_status")


def selection_changed(old: Column, new: Column) -> Column:
    return F.coalesce(F.array_sort(old) != F.array_sort(new), F.lit(True))


def route(delivered: Column, ok: Column, issues: Column) -> Column:
    """Where a checked session goes."""
    return F.when(delivered, "skip_move").when(ok & (F.size(issues) == 0), "send").when(ok, "hold").otherwise("quarantine")


def resolve_ids(names: DataFrame, sessions: DataFrame, name: str, folder: str, key: str) -> DataFrame:
    """name and session id: by folder, else by id, else the smallest id that starts with the name."""
    by_folder = sessions.groupBy(F.col(folder).alias(name)).agg(F.min(key).alias("_folder"))
    by_id = sessions.select(F.col(key).alias(name), F.col(key).alias("_id")).distinct()
    out = names.join(by_folder, name, "left").join(by_id, name, "left")
    open_names = out.where("_folder is null and _id is null").select(name).distinct()
    # prefixes by length: an equi-join on each length that occurs among the open names
    lengths = open_names.select(F.length(name).alias("k")).distinct()
    pre = sessions.select(F.col(key)).distinct().crossJoin(F.broadcast(lengths.agg(F.array_sort(F.collect_set("k")).alias("ks")))).select(key, F.explode("ks").alias("k")).select(key, F.substring(F.col(key), F.lit(1), F.col("k")).alias(name))
    by_prefix = pre.groupBy(name).agg(F.min(key).alias("_prefix"))
    return out.join(by_prefix, name, "left").select(name, F.coalesce("_folder", "_id", "_prefix").alias(key))
