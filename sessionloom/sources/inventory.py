"""A Python data source that lists files with size and time, zero-length ones included (Spark's file sources skip those)."""

from __future__ import annotations

import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "root string, session string, session_path string, subdir string, name string, path string, size long, mtime double, is_dir boolean, depth int"
# Folders that are never entered, folders that are no session whatever the name rule, and files that tools leave behind.
SYSTEM = frozenset(("lost+found", "system volume information", "$recycle.bin"))
RESERVED = frozenset(("sessions", "sessions_quarantine", "sessions_envoyee", "sessions_envoyes"))
METADATA = ("config.json", "mission.json", "analysis.json", "result.json", "metadata.json", "postprocess.log")
LEDGER = "uploaded_sessions.json"
#: How strictly a folder name must look like a session. Fixed values.
NAME_RULES = {"loose": r"^session", "flat": r"^session_", "digit": r"(?i)^session_\d", "stamp": r"^session_\d{8}_\d{6}"}


class SessionWalk:
    """Finds session folders below others and lists them. Hidden and system folders and links are not entered."""

    def __init__(self, rule: str, depth: int):
        self.rule, self.depth = re.compile(rule), depth

    @staticmethod
    def folders(folder: str) -> list[os.DirEntry]:
        """The folders directly below one, by name; none where it can't be read."""
        try:
            with os.scandir(folder) as found:
                return sorted((e for e in found if e.is_dir(follow_symlinks=False)), key=lambda e: e.name)
        except OSError:
            return []

    def is_session(self, name: str) -> bool:
        return bool(self.rule.search(name)) and name.lower() not in RESERVED

    @staticmethod
    def is_closed(name: str) -> bool:
        return name.startswith(".") or name.lower() in SYSTEM

    def files(self, root: str, session: str, top: str, depth: int):
        """Rows of SCHEMA of one session: itself, and all folders and files below it."""
        try:
            yield (root, session, top, "", "", top, 0, os.stat(top).st_mtime, True, depth)
        except OSError:
            return
        for folder, dirs, files in os.walk(top):
            dirs.sort()
            sub = os.path.relpath(folder, top)
            for name, is_dir in [(d, True) for d in dirs] + [(f, False) for f in sorted(files)]:
                path = os.path.join(folder, name)
                try:
                    s = os.stat(path)
                except OSError:
                    continue
                yield (root, session, top, "" if sub == "." else sub, name, path, 0 if is_dir else s.st_size, s.st_mtime, is_dir, depth)

    def sessions(self, tops: list, depth: int = 1):
        """(name, path, bytes, latest time) of the sessions among and below folders."""
        for e in tops:
            if self.is_closed(e.name):
                continue
            if self.is_session(e.name):
                rows = list(self.files("", e.name, e.path, depth))
                if rows:
                    yield e.name, e.path, sum(r[6] for r in rows), max(r[7] for r in rows)
            elif depth <= self.depth:
                yield from self.sessions(self.folders(e.path), depth + 1)


class _Part(InputPartition):
    def __init__(self, root: str, top: str | None):
        self.root, self.top = root, top


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.roots = [r for r in options.get("path", options.get("roots", "")).split(";") if r]
        self.walk = SessionWalk(NAME_RULES.get(options.get("rule", "digit"), options.get("rule", "digit")), int(options.get("depth", "6")))

    def partitions(self):
        # one partition for each entry directly below a root, so walking is spread over tasks
        return [_Part(root, e.name) for root in self.roots for e in self.walk.folders(root)] or [_Part("", None)]

    def read(self, part):
        if part.top is not None:
            yield from self._find(part.root, os.path.join(part.root, part.top), 1)

    def _find(self, root: str, folder: str, depth: int):
        name = os.path.basename(folder)
        if self.walk.is_closed(name):
            return
        if self.walk.is_session(name):
            yield from self.walk.files(root, name, folder, depth)
        elif depth <= self.walk.depth:
            for e in self.walk.folders(folder):
                yield from self._find(root, e.path, depth + 1)


class InventorySource(DataSource):
    """Options: path (roots by `;`), rule (a key of NAME_RULES or a pattern), depth (levels below a root whose folders are searched)."""

    @classmethod
    def name(cls) -> str:
        return "session_inventory"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def inventory(spark: SparkSession, roots: list[str], rule: str = "digit", depth: int = 6) -> DataFrame:
    spark.dataSource.register(InventorySource)
    return spark.read.format("session_inventory").option("path", ";".join(roots)).option("rule", rule).option("depth", str(depth)).load()


_OPEN = "root string, session string, session_path string, path string, depth int"


def walk(spark: SparkSession, roots: list[str], rule: str = "digit", depth: int = 6, ledger: str = LEDGER, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, ledgers): the rows of `inventory`, and root, path of the ledgers met outside sessions; for trees of any shape.

    A round lists each open folder once; the folders found in it, dealt evenly to `tasks` tasks (all cores by default), are the open ones of the next round. So one deep or
    wide folder is spread as soon as it is seen. There are as many rounds as levels; rows and open folders of a round are written, and the driver sees their number alone.
    """
    from sessionloom.session import fresh

    own = SessionWalk(NAME_RULES.get(rule, rule), depth)
    tasks = tasks or spark.sparkContext.defaultParallelism
    folder = fresh(spark, "walk")
    rows = f"{SCHEMA}, kind string"
    names = [f.split()[0] for f in rows.split(", ")]

    def found(root: str, session: str | None, top: str | None, folder: str, level: int):
        """Rows of one folder; kind: file (a row of the inventory), open (a folder to be listed), ledger."""
        if session is not None and folder == top:
            try:
                yield (root, session, top, "", "", top, 0, os.stat(top).st_mtime, True, level, "file")
            except OSError:
                return
        try:
            with os.scandir(folder) as entries:
                entries = sorted(entries, key=lambda e: e.name)
        except OSError:
            return
        for e in entries:
            is_dir = e.is_dir(follow_symlinks=False)
            if session is None:
                if is_dir and not own.is_closed(e.name):
                    if own.is_session(e.name):
                        yield (root, e.name, e.path, None, None, e.path, None, None, True, level, "open")
                    elif level <= own.depth:
                        yield (root, None, None, None, None, e.path, None, None, True, level + 1, "open")
                elif e.name == ledger and not is_dir:
                    yield (root, None, None, None, e.name, e.path, None, None, False, level, "ledger")
                continue
            try:
                s = e.stat()
            except OSError:
                continue
            sub = os.path.relpath(folder, top)
            yield (root, session, top, "" if sub == "." else sub, e.name, e.path, 0 if e.is_dir() else s.st_size, s.st_mtime, e.is_dir(), level, "file")
            if is_dir:
                yield (root, session, top, None, None, e.path, None, None, True, level, "open")

    def listed(batches):
        for b in batches:
            for r in b.itertuples(index=False):
                got = list(found(r.root, r.session, r.session_path, r.path, int(r.depth)))
                for lo in range(0, len(got), 10_000):
                    yield pd.DataFrame(got[lo : lo + 10_000], columns=names)

    open_ = spark.createDataFrame([(r, None, None, r, 1) for r in roots], _OPEN)
    k, n = 0, len(roots)
    while n:
        open_.repartition(min(n, tasks)).mapInPandas(listed, rows).write.parquet(f"{folder}/level={k}")
        open_ = spark.read.schema(rows).parquet(f"{folder}/level={k}").where("kind = 'open'").select("root", "session", "session_path", "path", "depth")
        k, n = k + 1, open_.count()
    all_ = spark.read.schema(rows).parquet(f"{folder}/*") if k else spark.createDataFrame([], rows)
    return all_.where("kind = 'file'").drop("kind"), all_.where("kind = 'ledger'").select("root", "path")


def sessions(files: DataFrame) -> DataFrame:
    """One row for each session folder: file count, bytes, latest change (the folder's own included), empty files."""
    real = ~F.col("is_dir")
    return files.groupBy("root", "session", "session_path").agg(
        F.count_if(real).cast("long").alias("files"),
        F.coalesce(F.sum(F.when(real, F.col("size"))), F.lit(0)).alias("size_bytes"),
        F.max("mtime").alias("mtime"),
        F.count_if(real & (F.col("size") == 0)).cast("long").alias("empty_files"),
        F.count_if(real & ~F.col("name").isin(*METADATA)).cast("long").alias("data_files"),
        F.coalesce(F.sum(F.when(real & ~F.col("name").isin(*METADATA), F.col("size"))), F.lit(0)).alias("data_bytes"),
    )


def emptiness(sessions: DataFrame) -> DataFrame:
    """sessions with `empty`: no files, metadata alone, or data files without a byte."""
    return sessions.withColumn("empty", (F.col("files") == 0) | (F.col("data_files") == 0) | (F.col("data_bytes") == 0))


def first_wins(sessions: DataFrame, disks: DataFrame) -> DataFrame:
    """A name found on several disks counts on the first one. disks: root, disk_order."""
    best = sessions.join(disks, "root").groupBy("session").agg(F.min(F.struct("disk_order", "root", "session_path")).alias("b"))
    return sessions.join(best.select("session", F.col("b.session_path").alias("session_path")), ["session", "session_path"], "left_semi")


def disks_of(spec: str, spark: SparkSession) -> DataFrame:
    """mount, kind, label, uuid of a text `path:type:label:uuid;…`; entries with missing parts or an unknown type are left out."""
    rows = spark.createDataFrame([(spec,)], "spec string").select(F.posexplode(F.split("spec", ";")).alias("disk_order", "entry"))
    p = F.split(F.trim("entry"), ":")
    out = rows.where(F.size(p) >= 4).select("disk_order", p[0].alias("mount"), F.lower(p[1]).alias("kind"), p[2].alias("label"), p[3].alias("uuid"))
    return out.where(F.col("kind").isin("ssd", "hdd") & (F.col("uuid") != "") & (F.col("mount") != ""))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Names of a text file, one a line; blank lines and those that begin with # are left out."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name != '' and not startswith(name, '#')").distinct()


def keep_newest(files: DataFrame, n: int) -> DataFrame:
    """The files beyond the newest n of each folder: what a rotation would delete."""
    from pyspark.sql import Window

    w = Window.partitionBy("session_path").orderBy(F.desc("mtime"), "name")
    return files.where(~F.col("is_dir")).withColumn("rn", F.row_number().over(w)).where(F.col("rn") > n).drop("rn")
