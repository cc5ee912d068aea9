"""Summaries of runs, and reports as tables and written files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.scalars import format_duration, format_size, grade, hours_minutes, round1, tag
from sessionloom.operators.aggregates import LETTERS, count_where


def run_summary(folders: DataFrame) -> DataFrame:
    """One row: on_disk, valid, valid_pct, invalid_pct, total and clean hours, scored, avg_score, and the share of each grade of the scored.

    folders: session, valid, score, duration_seconds, has_errors. Percentages are null where there is nothing to share.
    """
    g = grade(F.col("score"))
    out = folders.agg(
        F.count(F.lit(1)).alias("on_disk"), count_where(F.col("valid")).alias("valid"), F.count("score").alias("scored"), round1(F.avg("score")).alias("avg_score"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("seconds"), F.coalesce(F.sum(F.when(~F.col("has_errors"), F.col("duration_seconds"))), F.lit(0.0)).alias("clean"),
        *[count_where(g == x).alias(f"n_{x.lower()}") for x in LETTERS],
    )
    share = lambda n, of: round1(F.try_divide(100.0 * n, F.col(of)))
    return out.select(
        "on_disk", "valid", share(F.col("valid"), "on_disk").alias("valid_pct"), share(F.col("on_disk") - F.col("valid"), "on_disk").alias("invalid_pct"),
        hours_minutes(F.floor("seconds")).alias("total_hours"), hours_minutes(F.floor("clean")).alias("clean_hours"), "scored", "avg_score",
        *[share(F.col(f"n_{x.lower()}"), "scored").alias(f"{x.lower()}_pct") for x in LETTERS],
    )


def live_stats(rows: DataFrame) -> DataFrame:
    """kind, name, n, mean: counts of grades (no grade: F), statuses (none: ERROR) and tags of issue lines, means of the criteria and of the score.

    rows: session, score, grade, status, criteria (map of names to scores), lines (array).
    """
    counts = F.array(F.struct(F.lit("grade").alias("kind"), F.coalesce("grade", F.lit("F")).alias("name"), F.lit(None).cast("double").alias("v")), F.struct(F.lit("status").alias("kind"), F.coalesce("status", F.lit("ERROR")).alias("name"), F.lit(None).cast("double").alias("v")), F.struct(F.lit("score").alias("kind"), F.lit("score").alias("name"), F.coalesce("score", F.lit(0.0)).alias("v")))
    criteria = F.transform(F.map_entries(F.coalesce("criteria", F.create_map().cast("map<string,double>"))), lambda e: F.struct(F.lit("criterion").alias("kind"), e["key"].alias("name"), e["value"].alias("v")))
    tags = F.transform(F.coalesce("lines", F.array().cast("array<string>")), lambda x: F.struct(F.lit("issue").alias("kind"), tag(F.trim(x)).alias("name"), F.lit(None).cast("double").alias("v")))
    each = rows.select(F.explode(F.concat(counts, criteria, tags)).alias("x")).select("x.*")
    return each.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 6).alias("mean"))


def contamination_totals(findings: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: analysed, contaminated (any HIGH), warned (LOW alone), flagged (any finding). findings: session, confidence."""
    flags = contamination_flags(findings)
    out = sessions.select("session").distinct().join(flags, "session", "left")
    high, flagged = F.coalesce("contaminated", F.lit(False)), F.coalesce("flagged", F.lit(False))
    return out.agg(F.count(F.lit(1)).alias("analysed"), count_where(high).alias("contaminated"), count_where(flagged & ~high).alias("warned"), count_where(flagged).alias("flagged"))


def contamination_flags(findings: DataFrame) -> DataFrame:
    """session, contaminated (any HIGH), flagged (any finding, on which a pipeline fails)."""
    real = findings.where("confidence in ('HIGH', 'LOW')")
    return real.groupBy("session").agg(F.bool_or(F.col("confidence") == "HIGH").alias("contaminated"), F.lit(True).alias("flagged"))


def verdict_totals(rows: DataFrame) -> DataFrame:
    """One row: same, swap, inconclusive, robust, margin_sum of rows (verdict, margin, robust)."""
    is_ = lambda v: count_where(F.col("verdict") == v).alias(v)
    return rows.agg(is_("same"), is_("swap"), is_("inconclusive"), count_where(F.coalesce("robust", F.lit(False))).alias("robust"), F.round(F.coalesce(F.sum("margin"), F.lit(0.0)), 6).alias("margin_sum"))


def smallest_p(rows: DataFrame, n: int = 30) -> DataFrame:
    """The n candidates with the smallest p; ties by session."""
    return rows.orderBy("p", "session").limit(n)


def sessions_on_disk(entries: DataFrame) -> DataFrame:
    """disk, sessions: folders whose name begins with session, whatever the case. entries: disk, name, is_dir."""
    return entries.groupBy("disk").agg(count_where(F.col("is_dir") & F.startswith(F.lower("name"), F.lit("session"))).alias("sessions"))


def folders_per_disk(entries: DataFrame) -> DataFrame:
    """disk, names (sorted, joined), n. The list is the report; its rows are one disk's folders."""
    return entries.groupBy("disk").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("names"), F.count(F.lit(1)).alias("n"))


def totals(rows: DataFrame, keys: list[str] = ()) -> DataFrame:
    """sessions, bytes, seconds of a batch or a ledger."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("sessions"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), F.round(F.coalesce(F.sum("duration_seconds"), F.lit(0.0)), 4).alias("seconds"))


def representative_fraction(keys: DataFrame) -> DataFrame:
    """One row: probe, fraction: groups plus ungrouped sessions over all of a probe (rows of `key`, null where there is none); 1 for an empty probe."""
    out = keys.agg(F.count(F.lit(1)).alias("probe"), F.count_distinct("key").alias("groups"), count_where(F.col("key").isNull()).alias("alone"))
    return out.select("probe", F.round(F.coalesce(F.try_divide(F.col("groups") + F.col("alone"), F.col("probe")), F.lit(1.0)), 6).alias("fraction"))


def treatment(rows: DataFrame, conclusions: DataFrame) -> DataFrame:
    """session, document: the JSON of a checked session.

    rows: session, passed, score, grade, file_count, size_bytes, duration_seconds; conclusions: session, conclusions, warnings, errors (see `sessions.verdict`).
    """
    met = rows.join(conclusions.select("session", "conclusions", "warnings", "errors"), "session", "left")
    lists = {c: F.coalesce(c, F.array().cast("array<string>")) for c in ("conclusions", "warnings", "errors")}
    verdict = F.when(~F.coalesce("passed", F.lit(False)), "failed").when(F.size(lists["warnings"]) > 0, "warning").otherwise("passed")
    document = F.struct(
        F.lit("1.1").alias("version"), F.col("session").alias("session_id"), F.coalesce("passed", F.lit(False)).alias("passed"), verdict.alias("verdict"),
        F.struct("score", "grade").alias("quality"), F.struct("file_count", "size_bytes", "duration_seconds").alias("stats"), *[v.alias(c) for c, v in lists.items()],
    )
    return met.select("session", F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def mail_body(entries: DataFrame, zip_bytes: Column, attached: Column) -> DataFrame:
    """batch, body: a summary of each session of a batch in name order, and how the archive is delivered.

    entries: batch, session, operator_name, operator_id, rig, site, mission, result, duration_seconds, size_bytes.
    """
    dash = lambda c: F.coalesce(c, F.lit("—"))
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("── "), "session"),
        F.concat(F.lit("  operator: "), dash("operator_name"), F.lit(" ("), dash("operator_id"), F.lit(")")),
        F.concat(F.lit("  rig: "), dash("rig"), F.lit(", "), dash("site")),
        F.concat(F.lit("  mission: "), dash("mission")),
        F.concat(F.lit("  result: "), dash("result")),
        F.concat(F.lit("  duration: "), format_duration(F.coalesce("duration_seconds", F.lit(0.0)))),
        F.concat(F.lit("  size: "), format_size(F.coalesce("size_bytes", F.lit(0)))),
    )
    each = entries.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("session", lines.alias("l")))), lambda x: x["l"]), "\n").alias("all"))
    end = F.when(attached, F.lit("archive attached: ")).otherwise(F.lit("archive too large to attach: "))
    return each.select("batch", F.concat_ws("\n", F.format_string("%d session(s)", "n"), "all", F.concat(end, format_size(zip_bytes))).alias("body"))


def write_lines(rows: DataFrame, path: str) -> None:
    """A row for each session as JSON lines."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_trajectory(rows: DataFrame, path: str) -> None:
    """Poses as CSV in the order of time, side and source: sorted by range partitions, so the files in order are one sorted table."""
    rows.orderBy("ts_ms", "side", "source").write.mode("overwrite").option("header", True).csv(path)


def write_manifest(sessions: DataFrame, path: str) -> None:
    """Folder names, one a line."""
    sessions.select(F.col("session").cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def kept_apart(rows: DataFrame, group: str, at: str, gap: float) -> DataFrame:
    """Each group's first row by time, and then each that comes at least `gap` after the last one kept. Groups are streamed in order through a fold that keeps one time; rows with a null group or time are left out."""
    place, when = rows.columns.index(group), rows.columns.index(at)

    def fold(batches):
        last, since = None, 0.0
        for b in batches:
            keep = []
            for g, t in zip(b.column(place).to_pylist(), b.column(when).to_pylist(), strict=True):
                keep.append(g != last or t - since >= gap)
                if keep[-1]:
                    last, since = g, t
            yield b.filter(pa.array(keep, pa.bool_()))

    dealt = rows.where(F.col(group).isNotNull() & F.col(at).isNotNull()).repartition(group).sortWithinPartitions(group, at, *[c for c in rows.columns if c not in (group, at)])
    return dealt.mapInArrow(fold, rows.schema)


def run_progress(runs: DataFrame, events: DataFrame, every: float = 5.0) -> DataFrame:
    """run, status, done, total, updated_at after events (run, kind: start, progress, completed or aborted, at, done, total).

    A progress event counts if it is the run's first or comes at least `every` seconds after the last one that counted; the last event that counts decides
    the status. runs: the table before.
    """
    from sessionloom.operators.ledger import upsert

    progress = events.where("kind = 'progress'").select("run", "kind", "at", "done", "total")
    kept = kept_apart(progress, "run", "at", every).unionByName(events.where("kind != 'progress'").select("run", "kind", "at", "done", "total"))
    state = F.when(F.col("kind").isin("completed", "aborted"), F.col("kind")).otherwise("running")
    last = kept.groupBy("run").agg(F.max(F.struct("at", F.col("kind").isin("completed", "aborted").alias("ends"), state.alias("status"), "done", "total")).alias("x"))
    new = last.select("run", "x.status", "x.done", "x.total", F.col("x.at").alias("updated_at"))
    return upsert(runs, new, "run", ["status", "done", "total", "updated_at"], keep_first=False)
