"""Documents and streams of session folders: tolerant JSON, JSONL time series, CSV with synonyms, head-and-tail file checks."""

from __future__ import annotations

import io
import json
import os
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EDGE = 1 << 20
TAIL = 8192


def texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, text of whole small documents; a path that holds nothing gives no row."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text")) if paths else spark.createDataFrame([], "path string, text string")


def parsed(docs: DataFrame) -> DataFrame:
    """docs with `doc`, a variant, null where the text isn't JSON; never an error."""
    return docs.withColumn("doc", F.try_parse_json("text"))


def field(doc: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(doc, path, kind)


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, lineno, line of JSONL files of any length; lines are numbered from 0, blank ones counted but left out.

    Files are read in byte ranges (spark.sql.files.maxPartitionBytes); ranges agree on line ends, as a range goes on to the end of the line it ends in, and
    the next one begins behind it. A line's number is its place in its range plus the lines of the file's ranges before: sums over a row for each range, so no
    task sees a whole file. Lines end with a line feed, a carriage return or both; the last one may have no end.
    """
    if not paths:
        return spark.createDataFrame([], "path string, lineno long, line string")
    read = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_row"), F.col("value").alias("line"))
    ranges = read.groupBy("path", "_from").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("path").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = read.join(ranges.select("path", "_from", (before - F.col("_first")).alias("_shift")), ["path", "_from"])
    return placed.where(F.col("line").rlike(r"\S")).select("path", (F.col("_row") + F.col("_shift")).alias("lineno"), "line")


def before_errors(rows: DataFrame, bad: Column, until_error: bool = True) -> DataFrame:
    """The rows (path, lineno, ...) before their file's first bad one; without until_error, those of files without a bad one. The first bad line is a minimum over all ranges."""
    first = rows.where(bad).groupBy("path").agg(F.min("lineno").alias("_bad"))
    met = rows.join(first, "path", "left")
    return met.where(F.col("_bad").isNull() | ((F.col("lineno") < F.col("_bad")) if until_error else F.lit(False))).drop("_bad")


def timestamps_ms(rows: DataFrame, until_error: bool = True) -> DataFrame:
    """path, lineno, frame_index, ts_ms from lines: `capture_time` in ms, else `capture_timestamp_sec` in seconds.

    until_error keeps the lines before a file's first invalid one; otherwise a file with an invalid line gives nothing. A line is invalid that isn't a JSON object, or whose
    time isn't a number; one without a time is passed over.
    """
    given = lambda k, kind: field(F.col("doc"), f"$.{k}", kind)
    text = F.coalesce(given("capture_time", "string"), given("capture_timestamp_sec", "string"))
    at = F.when(given("capture_time", "string").isNotNull(), given("capture_time", "double")).otherwise(given("capture_timestamp_sec", "double") * 1000)
    out = rows.withColumn("doc", F.try_parse_json("line")).withColumn("_at", at)
    bad = F.col("doc").isNull() | ~F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT")) | (text.isNotNull() & F.col("_at").isNull())
    good = before_errors(out.withColumn("_bad_line", bad).select("path", "lineno", "_bad_line", given("frame_index", "bigint").alias("frame_index"), F.col("_at").alias("ts_ms")), F.col("_bad_line"), until_error)
    return good.drop("_bad_line").where("ts_ms is not null")


def first_last(rows: DataFrame, at: str = "ts_ms") -> DataFrame:
    """path, t_start, t_end, n of files with two lines or more."""
    return rows.groupBy("path").agg(F.min_by(at, "lineno").alias("t_start"), F.max_by(at, "lineno").alias("t_end"), F.count(F.lit(1)).alias("n")).where("n >= 2")


def grid(rows: DataFrame, camera: str, alias: str | None = None) -> DataFrame:
    """path, lineno, ts, file of one camera in resampled lines: its own time, else the grid's; an alias covers a misspelt key."""
    doc = F.try_parse_json("line")
    names = [camera] + ([alias] if alias else [])
    at = F.coalesce(*[field(doc, f"$.frames['{n}'].capture_timestamp_sec", "double") for n in names], field(doc, "$.grid_t", "double"))
    return rows.select("path", "lineno", at.alias("ts"), F.coalesce(*[field(doc, f"$.frames['{n}'].file") for n in names]).alias("file")).where("ts is not null")


def grid_times(rows: DataFrame, camera: str, alias: str | None = None) -> DataFrame:
    """path, lineno, ts of one camera in resampled lines, all of a file's or none: a line that doesn't parse, or gives neither the camera's time nor the grid's, spoils its file.

    A camera's entry must name its time; one that is null stands for the grid's.
    """
    entry = lambda n: field(F.col("doc"), f"$.frames['{n}']", "variant")
    mine = entry(camera) if alias is None else F.coalesce(entry(camera), entry(alias))
    out = rows.withColumn("doc", F.try_parse_json("line")).withColumn("_entry", mine)
    given = field(F.col("_entry"), "$.capture_timestamp_sec", "variant")
    ts = F.when(given.isNotNull() & ~F.coalesce(F.is_variant_null(given), F.lit(False)), field(F.col("_entry"), "$.capture_timestamp_sec", "double")).otherwise(field(F.col("doc"), "$.grid_t", "double"))
    out = out.withColumn("ts", ts)
    bad = F.col("doc").isNull() | (F.col("_entry").isNotNull() & given.isNull()) | F.col("ts").isNull()
    return before_errors(out.select("path", "lineno", "ts", bad.alias("_spoilt")), F.col("_spoilt"), False).select("path", "lineno", "ts")


def camera_times(grid: DataFrame, own: DataFrame, camera: str, alias: str | None = None) -> DataFrame:
    """session, lineno, ts of a camera's frames: from the resampled lines of its session, or, where these give none, from the camera's own lines.

    grid, own: session, path, lineno, line. Own lines without a time are passed over; lines that don't parse spoil their file.
    """
    of = lambda rows: rows.select("path", "session").distinct()
    first = grid_times(grid.drop("session"), camera, alias).join(of(grid), "path").select("session", "lineno", "ts")
    rest = own.join(first.select("session").distinct(), "session", "left_anti")
    doc = rest.withColumn("doc", F.try_parse_json("line"))
    kept = before_errors(doc.select("path", "session", "lineno", F.col("doc").isNull().alias("_spoilt"), field(F.col("doc"), "$.capture_timestamp_sec", "double").alias("ts")), F.col("_spoilt"), False)
    return first.unionByName(kept.where("ts is not null").select("session", "lineno", "ts"))


def sensor_openings(rows: DataFrame) -> DataFrame:
    doc = F.try_parse_json("line")
    return rows.select("path", "lineno", field(doc, "$.host_time_sec", "double").alias("t"), field(doc, "$.Opening_width", "double").alias("opening")).where("t is not null and opening is not null")


def sensor_quaternions(rows: DataFrame) -> DataFrame:
    """path, lineno, t, q of usable quaternions; see `quaternion_ratio` for how many there were."""
    from sessionloom.functions.scalars import valid_quaternion

    doc = F.try_parse_json("line")
    out = rows.select("path", "lineno", field(doc, "$.host_time_sec", "double").alias("t"), field(doc, "$.q", "array<double>").alias("q"))
    return out.withColumn("valid", F.coalesce(valid_quaternion(F.col("q")), F.lit(False)))


def quaternion_ratio(rows: DataFrame) -> DataFrame:
    return rows.groupBy("path").agg(F.count(F.lit(1)).alias("total"), F.count_if("valid").cast("long").alias("valid"), F.avg(F.col("valid").cast("double")).alias("valid_ratio"))


def map_entries_of(doc: Column, path: str) -> Column:
    """Entries of a map whose values may have any type; exploding and reading them one by one skips the bad ones."""
    return F.from_json(F.to_json(F.try_variant_get(doc, path, "variant")), "map<string,string>")


def csv_series(spark: SparkSession, path: str, times: list[str], values: list[str]) -> DataFrame | None:
    """t_ms, v of a CSV by the first time and value columns that it has; None where one is missing."""
    from sessionloom.functions.scalars import pick_column

    rows = spark.read.option("header", True).csv(path)
    t, v = pick_column(rows.columns, times), pick_column(rows.columns, values)
    return None if t is None or v is None else rows.select(F.col(t).try_cast("double").alias("t_ms"), F.col(v).try_cast("double").alias("v")).where("t_ms is not null and v is not null")


@contextmanager
def opened(path: str):
    """A file of any store that its path names (by URI, or a local one), read anywhere in it, and its size."""
    if "://" not in path:
        path = path.removeprefix("file:")
        with open(path, "rb") as f:
            yield f, os.path.getsize(path)
    else:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_file(place) as f:
            yield io.BufferedReader(f), f.size()


def _read_edges(path: str, head: int, tail: int) -> tuple[bytes, bytes, int] | None:
    try:
        with opened(path) as (f, size):
            first = f.read(head)
            f.seek(max(0, size - tail))
            return first, f.read(tail), size
    except OSError:
        return None


def mp4_boxes_ok(path: str) -> bool:
    """Walks the top-level boxes by their headers; a file needs `ftyp` and `moov`. A box that leaves the file ends the walk; one shorter than its header fails."""
    seen, at = set(), 0
    try:
        with opened(path) as (f, size):
            while at + 8 <= size:
                f.seek(at)
                head = f.read(16)
                length, kind, least = int.from_bytes(head[:4], "big"), head[4:8], 8
                if length == 1:
                    if len(head) < 16:
                        break
                    length, least = int.from_bytes(head[8:16], "big"), 16
                elif length == 0:
                    length = size - at
                if length < least:
                    return False
                seen.add(kind)
                at += length
    except OSError:
        return False
    return {b"ftyp", b"moov"} <= seen


def mp4_edges_ok(path: str) -> bool:
    found = _read_edges(path, EDGE, EDGE)
    return found is not None and b"ftyp" in found[0] and (b"moov" in found[0] or b"moov" in found[1])


def jsonl_edges_ok(path: str) -> bool:
    """The first line, of any length, and the last line of the file's end parse; a blank first line or a last line longer than TAIL bytes fails."""
    try:
        with opened(path) as (f, size):
            first = f.readline()
            f.seek(max(0, size - TAIL))
            ends = [x for x in f.read(TAIL).split(b"\n") if x.strip()]
        json.loads(first)
        json.loads(ends[-1])
    except (OSError, ValueError, IndexError):
        return False
    return True


def jsonl_edges_many(paths: pd.Series) -> pd.Series:
    return paths.map(jsonl_edges_ok)


def jsonl_whole_ok(lines: DataFrame) -> DataFrame:
    """path, ok of files by their lines (path, lineno, line): the first and last non-blank lines parse. Each is a least or greatest line over all ranges."""
    ends = lines.where("trim(line) != ''").groupBy("path").agg(F.min_by("line", "lineno").alias("first"), F.max_by("line", "lineno").alias("last"))
    return ends.select("path", (F.try_parse_json("first").isNotNull() & F.try_parse_json("last").isNotNull()).alias("ok"))


def file_checks(files: DataFrame) -> DataFrame:
    """files with `ok`: containers by their boxes, streams by their first and last line, documents by parsing, others non-empty. Paths may be URIs of a store that all tasks reach."""

    def one(path: str, size: int) -> bool:
        low = path.lower()
        if size == 0:
            return False
        if low.endswith(".mp4"):
            return mp4_boxes_ok(path)
        if low.endswith(".jsonl"):
            return jsonl_edges_ok(path)
        if low.endswith(".json"):
            try:
                with opened(path) as (f, _):
                    json.loads(f.read().decode("utf-8", "replace"))
            except (OSError, ValueError):
                return False
        return True

    @F.pandas_udf("boolean")
    def run(path: pd.Series, size: pd.Series) -> pd.Series:
        return pd.Series([one(p, s) for p, s in zip(path, size, strict=True)], dtype=bool)

    return files.withColumn("ok", run("path", "size"))
