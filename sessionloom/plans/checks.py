"""Checks of one session and the decisions built on them: completeness, metadata, capture reports, delivery, batches, names.

Inputs are DataFrames with a row for each session or file (see FIXTURES.md); decisions come out as columns or action tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.scalars import resolve_name, rig_number

# How long a folder must be unchanged, the least bytes and the duration range of a session.
STABLE_SECONDS = 300
LEAST_BYTES = 1024
DURATION_SECONDS = (10.0, 7200.0)
KINDS = ("result", "mission", "config", "analysis")


def _list(c: str | Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


# --- documents of a session ---


def documents_of(files: DataFrame) -> DataFrame:
    """session, result, mission, config, analysis: the texts of a folder's documents that parse, one row for each session.

    files: session, name, text. A document that is missing or no JSON is null, and never an error.
    """
    text = F.when(F.try_parse_json("text").isNotNull(), F.col("text"))
    return files.groupBy("session").agg(*[F.max(F.when(F.col("name") == f"{k}.json", text)).alias(k) for k in KINDS])


def metadata_of(files: DataFrame) -> DataFrame:
    """session, source, valid, metadata (a text): metadata.json, else config.json, else mission.json; the first that exists decides.

    A metadata.json or config.json that doesn't parse is invalid; nothing after it is tried. mission.json counts only if it parses.
    """
    has = lambda n: F.max((F.col("name") == n).cast("int")) == 1
    text = lambda n: F.max(F.when((F.col("name") == n) & F.try_parse_json("text").isNotNull(), F.col("text")))
    names = ("metadata.json", "config.json", "mission.json")
    out = files.groupBy("session").agg(*[has(n).alias(f"has{k}") for k, n in enumerate(names)], *[text(n).alias(f"text{k}") for k, n in enumerate(names)])
    source = F.when(F.col("has0"), names[0]).when(F.col("has1"), names[1]).when(F.col("text2").isNotNull(), names[2])
    chosen = F.when(F.col("has0"), F.col("text0")).when(F.col("has1"), F.col("text1")).otherwise(F.col("text2"))
    return out.select("session", source.alias("source"), chosen.isNotNull().alias("valid"), chosen.alias("metadata"))


def session_paths(sessions: DataFrame, folders: DataFrame) -> DataFrame:
    """session_id, path: the folder of each registered session among those that exist (folders: name), or what it would be called.

    By its recorded folder (else its id), by the time in `sess_<time>_<hash>`, by the first folder whose name begins with that time, then the same by a
    time written with dashes in the recorded folder. Beginnings are an equi-join on the part up to the time.
    """
    stamp = lambda d, t: F.concat(F.lit("session_"), d, F.lit("_"), t)
    own = F.coalesce(F.nullif("session_folder", F.lit("")), F.col("session_id"))
    by_id = F.nullif(F.regexp_extract("session_id", r"^sess_([0-9]{8}_[0-9]{6})(?:_[0-9a-f]+)?$", 1), F.lit(""))
    dashed = r"([0-9]{4})-([0-9]{2})-([0-9]{2})_([0-9]{2})-([0-9]{2})-([0-9]{2})"
    g = lambda k: F.regexp_extract("folder", dashed, k)
    rows = sessions.select("session_id", own.alias("folder"), F.concat(F.lit("session_"), by_id).alias("k1"))
    rows = rows.withColumn("k2", F.when(g(0) != "", stamp(F.concat(g(1), g(2), g(3)), F.concat(g(4), g(5), g(6)))))
    exact = folders.select("name").distinct()
    begin = exact.groupBy(F.substring("name", 1, len("session_20240101_000000")).alias("begin")).agg(F.min("name").alias("first"))
    for c, table in (("folder", exact), ("k1", exact), ("k2", exact)):
        rows = rows.join(table.select(F.col("name").alias(c), F.lit(True).alias(f"is_{c}")), c, "left")
    for c in ("k1", "k2"):
        rows = rows.join(begin.select(F.col("begin").alias(c), F.col("first").alias(f"first_{c}")), c, "left")
    path = F.coalesce(F.when(F.col("is_folder"), F.col("folder")), F.when(F.col("is_k1"), F.col("k1")), "first_k1", F.when(F.col("is_k2"), F.col("k2")), "first_k2", "folder")
    return rows.select("session_id", path.alias("path"))


def camera_statistics(files: DataFrame, stats: DataFrame, ignored: tuple[str, ...] = ("resampled_30hz.jsonl",)) -> DataFrame:
    """session, camera, t_start, t_end, duration, frames, files, video_size of cameras with a usable stream.

    files: session, name, size of the camera folder; stats: session, name, t_start, t_end, n of its streams (see `documents.first_last`).
    """
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    video = F.lower("name").rlike(r"\.(mp4|avi|mkv|mov)$")
    named = files.where(~F.col("name").isin(*ignored)).withColumn("camera", stem)
    each = named.groupBy("session", "camera").agg(F.count(F.lit(1)).alias("files"), F.min(F.when(video, F.struct("name", "size")))["size"].alias("video_size"))
    streams = stats.where(F.col("name").endswith(".jsonl") & ~F.col("name").isin(*ignored)).select("session", stem.alias("camera"), "t_start", "t_end", (F.col("t_end") - F.col("t_start")).alias("duration"), F.col("n").alias("frames"))
    return streams.join(each, ["session", "camera"]).select("session", "camera", "t_start", "t_end", "duration", "frames", "files", "video_size")


# --- single checks: ok null means skipped ---


def analysis_check(errors: Column, present: Column) -> Column:
    """False with capture errors; warnings don't block; null where the report is missing."""
    return F.when(present, F.size(_list(errors)) == 0)


def analysis_errors(errors: Column) -> Column:
    """The error list; empty where the report is missing or has none."""
    return _list(errors)


def tracking_check(failed: Column, error: Column, left: Column, right: Column) -> Column:
    """False if tracking ran and found neither gripper; true if the module failed; null if it reported an error of its input."""
    found = F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))
    return F.when(failed, True).when(error.isNotNull(), None).otherwise(found)


def scenario_check(recorded: Column, written: Column) -> Column:
    """Equal as strings; where either is missing or empty, passed."""
    text = lambda c: F.nullif(c.cast("string"), F.lit(""))
    return F.coalesce(text(recorded) == text(written), F.lit(True))


def duration_check(seconds: Column) -> Column:
    return F.coalesce(seconds.between(*DURATION_SECONDS), F.lit(True))


def file_checks(sessions: DataFrame, files: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """session, folder_exists, files_present, no_empty_files, min_size, checks_ok (of these four and metadata_valid).

    sessions: session, folder_exists, metadata_valid; files: session, size. A folder that doesn't exist fails all.
    """
    each = files.groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("size") == 0).alias("empty"), F.sum("size").alias("bytes"))
    there = F.coalesce("folder_exists", F.lit(False))
    rules = {"files_present": F.coalesce("n", F.lit(0)) > 0, "no_empty_files": F.coalesce("empty", F.lit(0)) == 0, "min_size": F.coalesce("bytes", F.lit(0)) >= least_bytes}
    out = sessions.join(each, "session", "left").withColumns({"folder_exists": there} | {k: there & v for k, v in rules.items()})
    checks = [there, there & F.coalesce("metadata_valid", F.lit(False)), *[F.col(k) for k in rules]]
    return out.select("session", "folder_exists", *rules, sum((c.cast("int") for c in checks), F.lit(0)).alias("checks_ok"))


def role_mismatch(role: Column, expected: Column) -> Column:
    """A camera that is clearly a gripper's or the head's, and not the one its name says."""
    return F.coalesce(role.isin("gripper", "head") & (role != expected), F.lit(False))


def frame_drop_check(cameras: DataFrame, most_severe: int = 5, most_pct: float = 10.0) -> DataFrame:
    """session, severe, worst_pct, ok of rows (session, camera, severe, drop_pct); see `ordered.frame_gaps`. Shares are rounded to 2 places before they are compared."""
    out = cameras.groupBy("session").agg(F.sum("severe").alias("severe"), F.max(F.round("drop_pct", 2)).alias("worst_pct"))
    return out.withColumn("ok", (F.col("severe") <= most_severe) & (F.col("worst_pct") <= most_pct))


def drift_check(cameras: DataFrame, nominal: float = 30.0, least_frames: int = 10, least_seconds: float = 1.0, most_delta: float = 1.0) -> DataFrame:
    """session, worst_delta, spread, ok of rows (session, camera, frames, seconds): measured rates against the nominal one; short streams are left out. Deltas are rounded to 3 places before they are compared."""
    fps = (F.col("frames") - 1) / F.col("seconds")
    used = cameras.where((F.col("frames") >= least_frames) & (F.col("seconds") >= least_seconds)).withColumn("delta", F.round(F.abs(fps - nominal), 3))
    out = used.groupBy("session").agg(F.max("delta").alias("worst_delta"), (F.max("delta") - F.min("delta")).alias("spread"))
    return out.withColumn("ok", F.col("worst_delta") <= most_delta)


# --- decisions ---


def completeness(sessions: DataFrame, expected: DataFrame, files: DataFrame, now: Column, stable: float = STABLE_SECONDS) -> DataFrame:
    """session, complete, reason: may a folder be handled, or is it still being recorded or copied? The first reason in order counts.

    sessions: session, result_present, result (null: unreadable), config_present, config_ok, mtime (seconds); expected: session, path (the files
    that its configuration declares); files: session, path, size. Paths that aren't there or hold nothing keep a session back, the first by name.
    """
    # both sides are dealt out and counted, never joined: estimates of exploded files are far too low, and a broadcast of them fills the driver
    both = expected.select("session", "path", F.lit(True).alias("_absent")).unionByName(files.where("size > 0").select("session", "path", F.lit(False).alias("_absent")))
    missing = both.groupBy("session", "path").agg(F.bool_and("_absent").alias("_absent")).where("_absent").groupBy("session").agg(F.min("path").alias("missing"))
    age = now - F.col("mtime")
    reason = (
        F.when(~F.coalesce("result_present", F.lit(False)), "result missing")
        .when(F.col("result").isNull(), "result unreadable")
        .when(F.upper("result") != "SUCCESS", "result not SUCCESS")
        .when(~F.coalesce("config_present", F.lit(False)), "config missing")
        .when(~F.coalesce("config_ok", F.lit(False)), "config unreadable")
        .when(F.col("missing").isNotNull(), F.concat(F.col("missing"), F.lit(" missing or empty")))
        .when(age < stable, "changed lately")
    )
    return sessions.join(missing.hint("merge"), "session", "left").select("session", reason.isNull().alias("complete"), F.coalesce(reason, F.lit("")).alias("reason"))


def declared_files(configs: DataFrame) -> DataFrame:
    """session, path of the files that a configuration (session, cameras and sensors: arrays of names) declares; nameless entries are left out."""
    named = lambda c: F.explode(F.filter(_list(c), lambda n: n.isNotNull() & (n != "")))
    of = lambda c, sub, end: configs.select("session", named(c).alias("n")).select("session", F.concat(F.lit(f"{sub}/"), "n", F.lit(end)).alias("path"))
    return of("cameras", "cameras", ".mp4").union(of("cameras", "cameras", ".jsonl")).union(of("sensors", "sensors", ".jsonl")).distinct()


def upload_decision(sessions: DataFrame, delivered: DataFrame) -> DataFrame:
    """session, outcome: invalid, rejected, empty, already_sent or deliver; the first that holds.

    sessions: session, issues (array), errors (array), empty; delivered: session.
    """
    out = sessions.join(delivered.select("session").distinct().withColumn("_sent", F.lit(True)), "session", "left")
    outcome = F.when(F.size(_list("issues")) > 0, "invalid").when(F.size(_list("errors")) > 0, "rejected").when(F.coalesce("empty", F.lit(False)), "empty").when(F.col("_sent"), "already_sent").otherwise("deliver")
    return out.select("session", outcome.alias("outcome"))


def batch_guard(batches: DataFrame, force: bool = False) -> DataFrame:
    """batch_id, action: whether a built batch is registered, from rows (batch_id, status, old_sessions, new_sessions).

    status is null for a new batch. Nothing selected, a rejected batch, one beyond validation and an unchanged selection do nothing.
    """
    known = F.col("status").isNotNull() & F.lit(not force)
    same = F.array_sort(_list("old_sessions")) == F.array_sort(_list("new_sessions"))
    action = F.when(known & (F.col("status") == "rejected"), "rejected").when(known & (F.col("status") != "pending_validation"), "closed").when(F.size(_list("new_sessions")) == 0, "empty").when(known & same, "unchanged").otherwise("register")
    return batches.select("batch_id", action.alias("action"))


def one_per_operator(sessions: DataFrame, cap_bytes: float) -> DataFrame:
    """The first valid session by name of each operator, in name order until the bytes of those before reach the cap.

    sessions: session, operator, valid, size_bytes. The cap is checked before a session is added, so the last one may go over it.
    """
    from sessionloom.operators.ordered import first_of_group, numbered_sums

    first = first_of_group(sessions, ["operator"], ["session"], F.col("valid"))
    return numbered_sums(first, ["session"], "size_bytes", "before").where(F.col("before") < cap_bytes)


def select_day(sessions: DataFrame, day: str, letter: str | None = None) -> DataFrame:
    """The sessions of a day (and grade), in order of their start."""
    out = sessions.where(F.to_date("started_at") == F.lit(day).cast("date"))
    out = out if letter is None else out.where(F.col("quality_grade") == letter)
    return out.orderBy("started_at", "session_id")


def choose(sessions: DataFrame, mode: str, count: int, seed: int = 0) -> DataFrame:
    """The count most recent, oldest or random sessions (by mtime; ties by session)."""
    order = {"recent": [F.desc("mtime"), "session"], "oldest": [F.asc("mtime"), "session"], "random": [F.xxhash64("session", F.lit(seed)), "session"]}[mode]
    return sessions.orderBy(*order).limit(count)


def watch_evaluation(sessions: DataFrame) -> DataFrame:
    """session, state (scored or retry), score, grade, size_bytes, duration of new folders; a folder whose report can't be read is tried again.

    sessions: the columns of `sessions.light_score`, readable, size_bytes, durations (a map of streams).
    """
    from sessionloom.operators.aggregates import max_of_streams
    from sessionloom.plans.sessions import light_score

    ok = F.coalesce("readable", F.lit(False))
    scored = light_score(sessions)
    return scored.select("session", F.when(ok, "scored").otherwise("retry").alias("state"), F.when(ok, F.col("score")).alias("score"), F.when(ok, F.col("grade")).alias("grade"), F.when(ok, F.col("size_bytes")).alias("size_bytes"), F.when(ok, max_of_streams(F.col("durations"))).alias("duration"))


def fast_scan(folders: DataFrame, reports: DataFrame) -> DataFrame:
    """disk, sessions, with_analysis, seconds: every folder counts; one without a readable report adds nothing to the time.

    folders: disk, session; reports: session, seconds.
    """
    met = folders.join(reports.groupBy("session").agg(F.max("seconds").alias("seconds"), F.lit(True).alias("known")), "session", "left")
    return met.groupBy("disk").agg(F.count(F.lit(1)).alias("sessions"), F.count("known").alias("with_analysis"), F.sum(F.coalesce("seconds", F.lit(0.0))).alias("seconds"))


# --- names ---


def group_key(name: Column, rig_id: Column, operator: Column) -> Column:
    """struct(rig, day, hour) of a session; null where the name has no time or the rig is unknown. Rig 1 is a placeholder and gives way to the operator's."""
    day, hour = (F.nullif(F.regexp_extract(name, r"(?i)^session_([0-9]{8})_([0-9]{2})[0-9]{4}", k), F.lit("")) for k in (1, 2))
    own = F.nullif(F.nullif(F.regexp_extract(rig_id, r"[0-9]+", 0), F.lit("")).try_cast("int"), F.lit(1))
    rig = F.coalesce(own, rig_number(operator))
    return F.when(day.isNotNull() & rig.isNotNull(), F.struct(F.concat(F.lit("rig_"), rig.cast("string")).alias("rig"), day.alias("day"), hour.alias("hour")))


def relative_date(text: Column, today: Column) -> Column:
    """A day by name (today, yesterday, their French names, or nothing for today) or as YYYY-MM-DD; null for anything else."""
    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(t.isin("today", "auj", "aujourdhui", ""), today).when(t.isin("yesterday", "hier"), F.date_sub(today, 1)).when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), t.try_cast("date"))


def config_key(version: str, *flags) -> Column:
    """version:flag:flag… of a run's settings."""
    return F.concat_ws(":", F.lit(version), *[F.col(f).cast("string") if isinstance(f, str) else f.cast("string") for f in flags])


def board_layout(text: Column) -> Column:
    """map(id -> struct(x, y)) of a layout {id: [x, y]}; empty where any key or value is no number, or the text no JSON."""
    raw = F.from_json(text, "map<string,array<string>>")
    pair = lambda v: F.struct(v[0].try_cast("double").alias("x"), v[1].try_cast("double").alias("y"))
    entries = F.transform(F.map_entries(raw), lambda e: F.struct(e["key"].try_cast("int").alias("key"), pair(F.when(F.size(e["value"]) >= 2, e["value"])).alias("value")))
    bad = F.exists(entries, lambda e: e["key"].isNull() | e["value"]["x"].isNull() | e["value"]["y"].isNull())
    empty = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<struct<x:double,y:double>>"))
    return F.coalesce(F.when(~bad, F.map_from_entries(entries)), empty)


def rename_plan(names: DataFrame, expected: tuple[str, ...] = ("head", "left", "right"), prefixes: tuple[str, ...] = ()) -> DataFrame:
    """session, name, target, error of names to change, from rows (session, name, truth).

    truth is what a sensor's own first line says (null for cameras, or where it is no expected name); it beats the name. A session
    with a name that resolves to nothing, two names for one target, or a target that a staying file has, has that error in all its rows.
    """
    want = F.array(*map(F.lit, expected))
    truth = F.when(F.array_contains(want, F.col("truth")), F.col("truth"))
    target = F.coalesce(truth, F.when(F.array_contains(want, F.col("name")), F.col("name")), resolve_name(F.col("name"), expected, prefixes=prefixes))
    each = names.select("session", "name", target.alias("target"))
    per = each.groupBy("session").agg(
        F.bool_or(F.col("target").isNull()).alias("lost"),
        F.collect_set("name").alias("present"),
        F.collect_list(F.when(F.col("name") != F.col("target"), F.struct(F.col("name").alias("n"), F.col("target").alias("t")))).alias("moves"),
    )
    targets, sources = F.col("moves")["t"], F.col("moves")["n"]
    clash = F.size(F.array_distinct(targets)) < F.size(targets)
    taken = F.size(F.array_intersect(targets, F.array_except("present", sources))) > 0
    per = per.select("session", F.when(F.col("lost"), "unresolved").when(clash, "several for one target").when(taken, "target taken").alias("error"))
    return each.join(per, "session").where("target is null or name != target")


def rename_summary(plan: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: sessions, to_fix, moved (without errors), errors."""
    per = plan.groupBy("session").agg(F.max("error").alias("error"))
    out = sessions.select("session").distinct().join(per.withColumn("planned", F.lit(True)), "session", "left")
    return out.agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("planned") & F.col("error").isNull()).cast("long").alias("to_fix"), F.count("error").alias("errors"))


def swap_fixes(findings: DataFrame) -> DataFrame:
    """session, name, target: exchanges of head and one gripper video, only where exactly these two are mistaken.

    findings: session, name, role, mismatch. Sensors are never touched.
    """
    head = F.col("name").isin("head", "wall")
    wrong = findings.where("mismatch")
    one = wrong.groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(head & (F.col("role") == "gripper"), F.col("name"))).alias("a"), F.collect_set(F.when(~head & (F.col("role") == "head"), F.col("name"))).alias("b"))
    pairs = one.where((F.col("n") == 2) & (F.size("a") == 1) & (F.size("b") == 1)).select("session", F.col("a")[0].alias("a"), F.col("b")[0].alias("b"))
    return pairs.select("session", F.explode(F.array(F.struct(F.col("a").alias("name"), F.col("b").alias("target")), F.struct(F.col("b").alias("name"), F.col("a").alias("target")))).alias("x")).select("session", "x.*")


def side_swaps(verdicts: DataFrame) -> DataFrame:
    """session, name, target: left and right videos exchanged where the verdict is swap."""
    sides = F.explode(F.array(F.struct(F.lit("left").alias("name"), F.lit("right").alias("target")), F.struct(F.lit("right").alias("name"), F.lit("left").alias("target"))))
    return verdicts.where("verdict = 'swap'").select("session", sides.alias("x")).select("session", "x.*")


def grid_renames(frames: DataFrame, renames: DataFrame) -> DataFrame:
    """session, idx, camera, file of a grid after renames (session, name, target), keys and the camera in paths alike; `rigth` becomes right first.

    frames: session, idx, camera, file. All names change at once, so exchanged ones aren't translated twice.
    """
    fixed = lambda c: F.when(c == "rigth", "right").otherwise(c)
    part = F.regexp_extract(F.coalesce("file", F.lit("")), r"/cameras/([^/]+)/", 1)
    rows = frames.select("session", "idx", fixed(F.col("camera")).alias("k"), "file", fixed(part).alias("p"))
    for c, t in (("k", "tk"), ("p", "tp")):
        rows = rows.join(renames.select("session", F.col("name").alias(c), F.col("target").alias(t)), ["session", c], "left")
    path = F.regexp_replace("file", F.lit(r"/cameras/[^/]+/"), F.concat(F.lit("/cameras/"), F.coalesce("tp", "p"), F.lit("/")))
    return rows.select("session", "idx", F.coalesce("tk", "k").alias("camera"), F.when(F.col("p") != "", path).otherwise(F.col("file")).alias("file"))


# --- poses and markers ---


def detection_rates(frames: DataFrame) -> DataFrame:
    """session, left_rate, right_rate, any_rate of rows (session, left, right): the larger of the two stands for any."""
    rate = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    out = frames.groupBy("session").agg(rate("left").alias("left_rate"), rate("right").alias("right_rate"))
    return out.withColumn("any_rate", F.greatest("left_rate", "right_rate"))


def median_pose(poses: DataFrame, keys: list[str], axes: tuple[str, ...] = ("x_mm", "y_mm", "z_mm")) -> DataFrame:
    """keys, the median of each axis, n."""
    return poses.groupBy(*keys).agg(*[F.median(a).alias(a) for a in axes], F.count(F.lit(1)).alias("n"))


def median_vector(rows: DataFrame, keys: list[str], vector: str, order: list[str], most: int = 60) -> DataFrame:
    """keys, the elementwise median of the first `most` vectors in order (a feature of the measure, not a cut of the input)."""
    from sessionloom.operators.ordered import top_of_group

    first = top_of_group(rows, keys, order, most)
    each = first.select(*keys, F.posexplode(vector).alias("k", "v")).groupBy(*keys, "k").agg(F.median("v").alias("m"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "m"))), lambda x: x["m"]).alias(vector))


def marker_pairs(markers: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, b, pixels of all pairs of markers in one frame (a handful), from rows (keys, marker, x, y)."""
    side = lambda k: markers.select(*keys, F.col("marker").alias(k), F.col("x").alias(f"x_{k}"), F.col("y").alias(f"y_{k}"))
    met = side("a").join(side("b"), keys).where("a < b")
    return met.select(*keys, "a", "b", F.sqrt(F.pow(F.col("x_a") - F.col("x_b"), 2) + F.pow(F.col("y_a") - F.col("y_b"), 2)).alias("pixels"))


def marker_visibility(samples: DataFrame, ids: tuple[int, int] = (244, 255)) -> DataFrame:
    """session, camera, ratio of the sampled frames that show both markers; null without samples. samples: session, camera, frame, markers (array, null: not sampled)."""
    both = F.array_contains("markers", ids[0]) & F.array_contains("markers", ids[1])
    return samples.groupBy("session", "camera").agg(F.avg(F.when(F.col("markers").isNotNull(), both.cast("double"))).alias("ratio"))


def confidence(kind: str, n: Column, error: Column | None = None) -> Column:
    """How far a pose is trusted: corner (n corners), board (n markers and the reprojection error in pixels), markers (n single ones)."""
    if kind == "corner":
        return F.least(F.lit(1.0), 0.45 + 0.14 * n)
    if kind == "board":
        return F.least(F.lit(1.0), F.greatest(F.lit(0.1), 1 - error / 5)) * F.when(n >= 3, 1.0).otherwise(0.85)
    return F.least(F.lit(1.0), 0.4 + 0.15 * n) * F.when(n >= 3, 1.0).otherwise(0.8)


def frame_times(flow: DataFrame, frames: DataFrame, fps: float = 30.0) -> DataFrame:
    """session, frame, ts, magnitude: each sampled frame's time by its number; unknown numbers count on from the first frame.

    flow: session, frame, magnitude; frames: session, frame, ts.
    """
    first = frames.groupBy("session").agg(F.min_by("ts", "frame").alias("first"))
    met = flow.join(frames, ["session", "frame"], "left").join(first, "session", "left")
    return met.select("session", "frame", F.coalesce("ts", F.coalesce("first", F.lit(0.0)) + F.col("frame") / fps).alias("ts"), "magnitude")


def result_lookup(sessions: DataFrame, registered: DataFrame) -> DataFrame:
    """session, reference: the registered id by name, or the name itself."""
    return sessions.join(registered.groupBy("session").agg(F.min("session_id").alias("session_id")), "session", "left").select("session", F.coalesce("session_id", "session").alias("reference"))
