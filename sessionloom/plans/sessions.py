"""Composites over session tables: scores, structure and consistency checks, batches, replication, coverage, the post-pipeline.

Inputs are DataFrames (see FIXTURES.md); nothing is moved, deleted or sent: those steps come out as action tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.scalars import grade, name_timestamp, rig_of_config, round1
from sessionloom.operators import ordered as O

# Weights of the full score, required files, alias of the fixed camera, files that tools leave behind.
WEIGHTS = {"sync": 0.20, "stability": 0.20, "detectability": 0.20, "coverage": 0.10, "imu": 0.10, "integrity": 0.08, "temporal": 0.07, "duration": 0.05}
LIGHT_WEIGHTS = {"sync": 0.40, "fps": 0.35, "cam_sensor": 0.25}
REQUIRED = ("cameras/head.jsonl", "cameras/head.mp4", "cameras/left.jsonl", "cameras/left.mp4", "cameras/right.jsonl", "cameras/right.mp4", "config.json", "mission.json", "sensors/left.jsonl", "sensors/right.jsonl")
OPTIONAL = ("analysis.json", "cameras/resample_report.json", "cameras/resampled_30hz.jsonl", "postprocess.log", "result.json", "treatment.json")
LEAST_VIDEO_BYTES = 100_000


def _clamped(x: Column) -> Column:
    """Not below 0; null stays null (greatest alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), x))


def _analysis_score(rows: DataFrame, fps: Column, offset_cost: float, bad_start: float) -> DataFrame:
    sync = F.coalesce(_clamped(100 - 5 * F.abs("max_drift")), F.lit(50.0))
    delta = F.coalesce("sync_delta", F.lit(0.0))
    cam = F.when(F.coalesce("sync_ok", F.lit(True)), _clamped(100 - offset_cost * delta)).otherwise(_clamped(bad_start - 100 * delta))
    out = rows.withColumns({"sync": sync, "fps": F.coalesce(_clamped(fps), F.lit(50.0)), "cam_sensor": cam})
    failed = F.size(F.coalesce("errors", F.array().cast("array<string>"))) > 0
    total = sum((w * F.col(k) for k, w in LIGHT_WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("score", F.when(failed, 0.0).otherwise(round1(total))).withColumn("grade", grade(F.col("score")))


def _percent(part: str) -> Column:
    """Of the expected frames: 0 where there are cameras without any, null without cameras."""
    return F.when(F.col("expected_frames") > 0, 100.0 * F.col(part) / F.nullif(F.col("expected_frames"), F.lit(0))).when(F.col("expected_frames").isNotNull(), 0.0)


def light_score(rows: DataFrame) -> DataFrame:
    """rows with sync, fps, cam_sensor, score, grade; only the total is rounded.

    rows: session, errors (array), max_drift (null without pairs), expected_frames (null without cameras), gap_frames, queue_drops,
    sync_ok, sync_delta. A check without data gives 50 (sync, fps). Any error gives 0 and F.
    """
    return _analysis_score(rows, 100 - 1.5 * _percent("gap_frames") - F.least(0.2 * _percent("queue_drops"), F.lit(10.0)), 200, 20)


def watch_score(rows: DataFrame) -> DataFrame:
    """The other preset of coefficients: gaps twice, each queue drop five, offset by 300, from 30 where the sync check failed."""
    return _analysis_score(rows, 100 - 2 * _percent("gap_frames") - 5 * F.col("queue_drops"), 300, 30)


def full_score(rows: DataFrame) -> DataFrame:
    """rows with eight criteria, score, grade.

    rows: session, max_drift (null without measured pairs), fps_spread (null with fewer than two cameras), worst_drop_pct, severe_drops, max_local_std,
    gap_pct and queue_drops (null without analysis of cameras), any_rate, poses (optional: poses in the head view), left_rate, right_rate, imu_ratio,
    vision (boolean; false: no tracking results), checks_ok, checks_total, overlap, duration_ok. Missing frame drops or drift count as 50 each.
    Each criterion is rounded before it is weighted. Without vision, detectability, coverage and imu are 0, so the best
    score is 60.
    """
    c = F.col
    vision = F.coalesce("vision", F.lit(False))
    seen = lambda k: F.when(vision, c(k))
    sync = F.coalesce(_clamped(100 - 5 * F.abs("max_drift")), _clamped(100 - 60 * c("fps_spread")), F.lit(50.0))
    drop = F.coalesce(_clamped(100 - 4 * c("worst_drop_pct") - 3 * F.coalesce("severe_drops", F.lit(0))), F.lit(50.0))
    std = F.coalesce(_clamped(100 - 30 * c("max_local_std")), F.lit(50.0))
    kernel = _clamped(100 - 2 * c("gap_pct") - 5 * F.coalesce("queue_drops", F.lit(0)))
    stability = F.when(c("gap_pct").isNull(), 0.65 * drop + 0.35 * std).otherwise(0.45 * drop + 0.25 * std + 0.30 * kernel)
    poses = seen("poses") if "poses" in rows.columns else F.lit(0)
    left, right = F.coalesce(seen("left_rate"), F.lit(0.0)), F.coalesce(seen("right_rate"), F.lit(0.0))
    low, high = F.least(left, right), F.greatest(left, right)
    criteria = {
        "sync": sync, "stability": stability,
        "detectability": F.coalesce(100.0 * seen("any_rate"), F.when(poses > 0, 20.0), F.lit(0.0)),
        "coverage": F.when(low > 0, 100.0 * low / F.nullif(high, F.lit(0.0))).when(high > 0, 25.0).otherwise(0.0),
        "imu": F.coalesce(100.0 * seen("imu_ratio"), F.lit(0.0)),
        "integrity": F.coalesce(F.try_divide(100.0 * c("checks_ok"), c("checks_total")), F.lit(0.0)),
        "temporal": F.coalesce(100.0 * c("overlap"), F.lit(50.0)),
        "duration": F.when(c("duration_ok").isNull(), 50.0).when(c("duration_ok"), 100.0).otherwise(0.0),
    }
    out = rows.withColumns({k: round1(v) for k, v in criteria.items()})
    total = sum((w * F.col(k) for k, w in WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("score", round1(total)).withColumn("grade", grade(F.col("score")))


def passes(critical_failed: Column, score: Column, least: float = 40.0) -> Column:
    return ~critical_failed & (score >= least)


def verdict(checks: DataFrame) -> DataFrame:
    """session, verdict (passed, warning, failed), conclusions, warnings, errors from rows (session, check, ok, critical, detail)."""
    text = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.concat_ws(": ", "check", "detail"))))
    ok, bad = F.col("ok"), ~F.col("ok")
    out = checks.groupBy("session").agg(text(ok).alias("conclusions"), text(bad & ~F.col("critical")).alias("warnings"), text(bad & F.col("critical")).alias("errors"))
    return out.withColumn("verdict", F.when(F.size("errors") > 0, "failed").when(F.size("warnings") > 0, "warning").otherwise("passed"))


def exact_set(files: DataFrame, required=REQUIRED, optional=OPTIONAL) -> DataFrame:
    """session, missing, extra, corrupt, ok: the files of each folder against the required set; `wall` counts as `head`."""
    rel = F.regexp_replace(F.concat_ws("/", F.nullif("subdir", F.lit("")), "name"), r"^cameras/wall\.", "cameras/head.")
    each = files.where(~F.col("is_dir")).groupBy("session").agg(F.collect_set(rel).alias("present"), F.array_sort(F.collect_set(F.when(~F.col("ok"), rel))).alias("corrupt"))
    want = F.array(*map(F.lit, required))
    out = files.select("session").distinct().join(each, "session", "left").withColumns({"present": F.coalesce("present", F.array().cast("array<string>")), "corrupt": F.coalesce("corrupt", F.array().cast("array<string>"))})
    out = out.select("session", F.array_sort(F.array_except(want, "present")).alias("missing"), F.array_sort(F.array_except("present", F.array(*map(F.lit, (*required, *optional))))).alias("extra"), "corrupt")
    return out.withColumn("ok", (F.size("missing") == 0) & (F.size("extra") == 0) & (F.size("corrupt") == 0))


def integrity_view(report: DataFrame, extra_only: bool = False, missing_only: bool = False) -> DataFrame:
    """Of an `exact_set` the sessions that aren't clean; with a choice those with extra files, or with missing ones (both: with both)."""
    out = report.where(~F.col("ok"))
    out = out.where(F.size("extra") > 0) if extra_only else out
    return out.where(F.size("missing") > 0) if missing_only else out


def capture_integrity(sessions: DataFrame, files: DataFrame) -> DataFrame:
    """sessions with missing, corrupt, and score, grade and errors as they are then: any missing or corrupt file of the capture gives 0 and F.

    sessions: session, cameras and sensors (arrays of declared names; empty ones don't count), score, grade, errors (array); files: session, subdir, name, size, ok (see
    `documents.file_checks`). A file without bytes is missing. With a camera the resampled grid and its report are expected too.
    """
    none = F.array().cast("array<string>")
    names = lambda c: F.filter(F.coalesce(c, none), lambda n: F.coalesce(n, F.lit("")) != "")
    of = lambda c, folder, *ends: F.flatten(F.transform(names(c), lambda n: F.array(*[F.concat(F.lit(f"{folder}/"), n, F.lit(e)) for e in ends])))
    grid = F.when(F.size(names("cameras")) > 0, F.array(F.lit("cameras/resample_report.json"), F.lit("cameras/resampled_30hz.jsonl"))).otherwise(none)
    want = F.concat(of("cameras", "cameras", ".mp4", ".jsonl"), grid, of("sensors", "sensors", ".jsonl"))
    there = files.where("size > 0").select("session", F.concat_ws("/", "subdir", "name").alias("f"), "ok")
    each = there.groupBy("session").agg(F.collect_set("f").alias("_there"), F.collect_set(F.when(~F.col("ok"), F.col("f"))).alias("_bad"))
    out = sessions.join(each, "session", "left").withColumn("_want", want)
    out = out.withColumns({"missing": F.array_except("_want", F.coalesce("_there", none)), "corrupt": F.array_intersect("_want", F.coalesce("_bad", none))})
    broken = (F.size("missing") > 0) | (F.size("corrupt") > 0)
    told = lambda c, text: F.transform(c, lambda f: F.concat(F.lit(text), f))
    errors = F.concat(F.coalesce("errors", none), told("missing", "missing file: "), told("corrupt", "corrupt file: "))
    return out.withColumns({"errors": errors, "score": F.when(broken, 0.0).otherwise(F.col("score")), "grade": F.when(broken, "F").otherwise(F.col("grade"))}).drop("_want", "_there", "_bad")


def structure_issues(sessions: DataFrame, files: DataFrame, with_analysis_errors: bool = False) -> DataFrame:
    """session, issues: what keeps a session from delivery, in a fixed order.

    sessions: session, result, config_ok, camera_errors (array), mission_ok, sync_ok, errors (array); files: the inventory.
    """
    size = lambda sub, name: F.max(F.when((F.col("subdir") == sub) & (F.col("name") == name), F.col("size")))
    cams, sides = ("head", "left", "right"), ("left", "right")
    named = files.withColumn("name", F.regexp_replace("name", r"^wall\.", "head."))
    have = named.groupBy("session").agg(*[size("cameras", f"{k}.{x}").alias(f"{k}_{x}") for k in cams for x in ("mp4", "jsonl")], size("cameras", "resampled_30hz.jsonl").alias("grid"), *[size("sensors", f"{k}.jsonl").alias(f"sensor_{k}") for k in sides])
    rows = sessions.join(have, "session", "left")
    no, c = F.lit(None).cast("string"), F.col
    empty = lambda k: F.coalesce(c(k), F.lit(0)) <= 0
    rules = [
        F.when(F.upper(F.coalesce("result", F.lit(""))) != "SUCCESS", "[result] not SUCCESS"),
        F.when(~F.coalesce("config_ok", F.lit(False)), "[config] missing or invalid"),
        F.when(F.size(F.coalesce("camera_errors", F.array().cast("array<string>"))) > 0, F.concat(F.lit("[camera] "), F.array_join("camera_errors", ", "))),
        F.when(~F.coalesce("mission_ok", F.lit(False)), "[mission] missing or invalid"),
        F.when(~F.coalesce("sync_ok", F.lit(True)), "[sync] check failed"),
        *[F.when(F.coalesce(c(f"{k}_mp4"), F.lit(0)) < LEAST_VIDEO_BYTES, f"[video] {k} missing or too small") for k in cams],
        *[F.when(empty(f"{k}_jsonl"), f"[frames] {k} missing or empty") for k in cams],
        F.when(empty("grid"), "[grid] missing or empty"),
        *[F.when(empty(f"sensor_{k}"), f"[sensor] {k} missing or empty") for k in sides],
    ]
    issues = F.filter(F.array(*[F.coalesce(r, no) for r in rules]), lambda x: x.isNotNull())
    if with_analysis_errors:
        issues = F.concat(issues, F.transform(F.coalesce("errors", F.array().cast("array<string>")), lambda e: F.concat(F.lit("[analysis] "), e)))
    return rows.select("session", issues.alias("issues"))


def camera_sync(grid: DataFrame, frames: DataFrame, gap_ms: float = 2.0, ratio: float = 0.02, cameras: DataFrame | None = None) -> DataFrame:
    """session, camera, total, bad, bad_path, ratio, path_ratio, median_bad_ms, ok: grid points without a frame within the gap, and points whose file names another camera than their key.

    grid: session, camera, idx, ts_ms, file and, where it differs from camera, key (the name as written); frames: session, camera, frame_id, ts_ms; cameras: session,
    camera of the streams that exist (by default those with frames). All points of a stream that exists and gives no times are bad, as are points without a time; their
    gap is infinite in the median. Cameras whose stream doesn't exist, or without grid points, give no row.
    """
    grid = grid if "key" in grid.columns else grid.withColumn("key", F.col("camera"))
    there = (frames if cameras is None else cameras).select("session", "camera").distinct()
    near = O.nearest(grid, frames.where("ts_ms is not null"), ["session", "camera"], "ts_ms", "idx", "frame_id")
    path = F.regexp_extract(F.coalesce("file", F.lit("")), r"/?cameras/([^/]+)/", 1)
    met = grid.select("session", "camera", "idx", "key", path.alias("path")).join(near, ["session", "camera", "idx"]).join(there, ["session", "camera"], "left_semi")
    met = met.withColumn("gap", F.coalesce("gap", F.lit(float("inf"))))
    bad, other = F.col("gap") > gap_ms, (F.col("path") != "") & (F.col("path") != F.col("key"))
    median = F.median(F.when(bad, F.col("gap")))
    out = met.groupBy("session", "camera").agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).cast("long").alias("bad"), F.count_if(other).cast("long").alias("bad_path"), F.when(F.isnan(median), float("inf")).otherwise(F.round(median, 3)).alias("median_bad_ms"))
    return out.withColumns({"ratio": F.col("bad") / F.col("total"), "path_ratio": F.col("bad_path") / F.col("total")}).withColumn("ok", (F.col("ratio") <= ratio) & (F.col("path_ratio") <= ratio))


def name_anomalies(sessions: DataFrame, expected=("left", "right", "wall")) -> DataFrame:
    """session, unexpected, missing of camera names (array `cameras`); sessions without a configuration are left out."""
    want = F.array(*map(F.lit, expected))
    out = sessions.where("cameras is not null").select("session", F.array_sort(F.array_except("cameras", want)).alias("unexpected"), F.array_sort(F.array_except(want, "cameras")).alias("missing"))
    return out.where((F.size("unexpected") > 0) | (F.size("missing") > 0))


def classify(invalid: Column, rejected: Column, empty: Column) -> Column:
    return F.when(invalid, "invalid").when(rejected, "rejected").when(empty, "empty").otherwise("valid")


def daily_batch(sessions: DataFrame, day: str, rig: int, hours: tuple[int, int] = (7, 24), cap_bytes: int = 5 * 1024**3) -> DataFrame:
    """The sessions of a rig and day within the hours, valid ones by name until the cap. Of equal names the smaller comes first, then by operator and rig fields.

    sessions: name, rig_code, rig_id, operator, valid, size_bytes.
    """
    at = name_timestamp(F.col("name"))
    rows = sessions.withColumn("at", at).where((F.to_date("at") == F.lit(day).cast("date")) & (F.hour("at") >= hours[0]) & (F.hour("at") < hours[1]))
    rows = rows.where((rig_of_config(F.col("rig_code"), F.col("rig_id"), F.col("operator")) == rig) & F.col("valid")).withColumn("rig", F.lit(rig))
    return O.capacity_prefix(rows, ["rig"], ["name", "size_bytes", "operator", "rig_code", "rig_id"], "size_bytes", cap_bytes)


def replication_plan(sessions: DataFrame, disks: DataFrame, limit: int | None = None, reserve: float = 10 * 1024**3) -> DataFrame:
    """session_id, source, target, action: sessions on an SSD alone, oldest first, each to the first HDD by label that keeps the reserve free with it.

    disks: disk_uuid, label (optional), mount_path, disk_type, free_bytes. What is planned before counts as used; a session that fits on
    no disk waits, and smaller ones after it may still go.
    """
    from sessionloom.operators.grouped import first_fit

    todo = sessions.where("ssd_disk_uuid is not null and hdd_disk_uuid is null").join(disks.select(F.col("disk_uuid").alias("ssd_disk_uuid"), F.col("mount_path").alias("source")), "ssd_disk_uuid")
    todo = todo.withColumn("late", F.coalesce(F.col("started_at").cast("timestamp"), F.lit("9999-12-31").cast("timestamp")))
    if limit:
        todo = todo.orderBy("late", "session_id").limit(limit)
    label = "label" if "label" in disks.columns else "disk_uuid"
    hdd = [(r["mount_path"], r["free_bytes"] or 0) for r in disks.where("lower(disk_type) = 'hdd'").orderBy(label, "disk_uuid").select("mount_path", "free_bytes").collect()]  # disks: a few rows
    placed = first_fit(todo, hdd, ["late", "session_id"], "session_id", "size_bytes", reserve)
    out = todo.select("session_id", "source").join(placed, "session_id")
    return out.select("session_id", "source", "target", F.when(F.col("target").isNull(), "wait").otherwise("copy").alias("action"))


def migration_plan(found: DataFrame, confirmed: DataFrame, existing: DataFrame) -> DataFrame:
    """session, action: folders confirmed redundant move, unless the target has them; the others stay."""
    out = found.join(confirmed.select("session").distinct().withColumn("_ok", F.lit(True)), "session", "left").join(existing.select("session").distinct().withColumn("_there", F.lit(True)), "session", "left")
    return out.withColumn("action", F.when(F.col("_ok").isNull(), "keep").when(F.col("_there"), "skip").otherwise("move")).drop("_ok", "_there")


def post_pipeline(sessions: DataFrame) -> DataFrame:
    """sessions with status and action.

    sessions: session, delivered, error (boolean), integrity_ok, sync_ok, findings (count, LOW ones too), charuco_anomaly, lr_verdict, issues (array).
    Score and structure don't change the status; issues hold an OK session back.
    """
    from sessionloom.operators.ledger import route

    clean = F.col("integrity_ok") & F.col("sync_ok") & (F.col("findings") == 0) & ~F.col("charuco_anomaly") & (F.coalesce("lr_verdict", F.lit("")) != "swap")
    out = sessions.withColumn("status", F.when(F.coalesce("error", F.lit(False)), "ERROR").when(F.coalesce(clean, F.lit(False)), "OK").otherwise("ANOMALY"))
    return out.withColumn("action", route(F.coalesce("delivered", F.lit(False)), F.col("status") == "OK", F.coalesce("issues", F.array().cast("array<string>"))))


def reuse_reports(sessions: DataFrame, reports: DataFrame, dry_run: bool = False) -> DataFrame:
    """sessions with `cached`: an earlier report of the same fingerprint and settings; only OK ones outside a dry run."""
    ok = reports if dry_run else reports.where("status = 'OK'")
    known = ok.select("session", "fingerprint", "config_key", F.lit(True).alias("_hit")).distinct()
    return sessions.join(known, ["session", "fingerprint", "config_key"], "left").withColumn("cached", F.coalesce("_hit", F.lit(False))).drop("_hit")


def label_inversion(corr: DataFrame, margin: float = 0.12) -> DataFrame:
    """session, verdict from rows (session, side, own, other): correlations of a side's flow with its own and the other half of the head view.

    A side is consistent if its own correlation is the larger one, signs included; a tie isn't. Only where all sides are inconsistent is a session
    `inverted` (all of them by the margin) or `suspect` (one of them). Sides without correlations don't count; sessions without any side give no row.
    """
    own, other = F.col("own"), F.col("other")
    out = corr.where(own.isNotNull() & other.isNotNull()).groupBy("session").agg(F.bool_and(own <= other).alias("bad"), F.min(F.abs(own - other)).alias("least"), F.max(F.abs(own - other)).alias("most"))
    return out.select("session", F.when(F.col("bad") & (F.col("least") >= margin), "inverted").when(F.col("bad") & (F.col("most") >= margin), "suspect").otherwise("ok").alias("verdict"))


def enough_data(points: Column, span: Column, least_points: int = 30, least_span: float = 3.0) -> Column:
    """Whether a series suffices for a verdict."""
    return F.coalesce((points >= least_points) & (span >= least_span), F.lit(False))


def pairing_verdict(ll: Column, rr: Column, lr: Column, rl: Column, margin: float = 0.30, floor: float = 0.80, enough: Column | None = None) -> Column:
    """same, swap or inconclusive of left and right streams by their four correlations: sums of both sides, at least margin apart.

    Inconclusive without enough data on both sides, and where neither pairing has a correlation of at least floor.
    """
    size = lambda c: F.coalesce(F.abs(c), F.lit(0.0))
    same, swap = size(ll) + size(rr), size(lr) + size(rl)
    weak = (F.greatest(size(ll), size(rr)) < floor) & (F.greatest(size(lr), size(rl)) < floor)
    open_ = weak | (F.abs(same - swap) < margin)
    return F.when(open_ if enough is None else open_ | ~enough, "inconclusive").when(same > swap, "same").otherwise("swap")


def quick_pairing(samples: DataFrame, sensors: DataFrame, requested: int = 10) -> DataFrame:
    """session, r_ll, r_rr, r_lr, r_rl, found_left, found_right, verdict from few samples a side.

    samples: session, side, sample_id, t, distance (null: none was measured), opening (the side's own sensor at that time, by which the samples were
    chosen: see `diverse_sample`); sensors: session, side, t, opening. The other side's sensor is interpolated at the same times. Samples
    with a distance count as found. Fewer than 4 of them (none, too) or a flat side correlate as 0, a side without any sample as null; fewer than half
    the requested samples (4 at least) are inconclusive.
    """
    from sessionloom.operators.aggregates import pearson

    other = F.when(F.col("side") == "left", "right").otherwise("left")
    crossed = O.interpolated(samples, sensors.withColumn("side", other), ["session", "side"], "t", "opening", "sample_id").select("session", "side", "sample_id", F.col("opening").alias("crossed"))
    guarded = lambda c: F.when(F.count("distance") < 4, 0.0).otherwise(pearson("distance", c, 1e-9))
    found = lambda c: F.when(F.col("distance").isNotNull(), F.col(c))
    met = samples.join(crossed, ["session", "side", "sample_id"]).withColumns({c: found(c) for c in ("opening", "crossed")})
    each = met.groupBy("session", "side").agg(F.count("distance").alias("found"), guarded("opening").alias("own"), guarded("crossed").alias("cross"))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    out = each.groupBy("session").agg(of("left", "own").alias("r_ll"), of("right", "own").alias("r_rr"), of("left", "cross").alias("r_lr"), of("right", "cross").alias("r_rl"), F.coalesce(of("left", "found"), F.lit(0)).alias("found_left"), F.coalesce(of("right", "found"), F.lit(0)).alias("found_right"))
    enough = F.least("found_left", "found_right") >= max(4, requested / 2)
    return out.withColumn("verdict", pairing_verdict(F.col("r_ll"), F.col("r_rr"), F.col("r_lr"), F.col("r_rl"), enough=enough))


def full_pairing(series: DataFrame, session: str = "session", **how) -> DataFrame:
    """session, the four best-lag correlations, verdict, of whole series; see `grouped.pairings`."""
    from sessionloom.operators.grouped import pairings

    out = pairings(series, session, **how)
    return out.withColumn("verdict", pairing_verdict(F.col("r_ll"), F.col("r_rr"), F.col("r_lr"), F.col("r_rl"), enough=F.col("enough_left") & F.col("enough_right")))


def role(ratio: Column) -> Column:
    return F.when(ratio.isNull(), None).when(ratio >= 0.05, "gripper").when(ratio <= 0.02, "head").otherwise("ambiguous")


def cross_validation(head: DataFrame, stereo: DataFrame, most_mm: float = 50.0, poses: DataFrame | None = None, least: int = 3) -> DataFrame:
    """session, compared, agreed, rate, mean_mm: head poses brought to the stereo times by interpolation, within most_mm in 3-D.

    head, stereo: session, pose_id, ts_ms, x_mm, y_mm, z_mm. Stereo poses before the first or after the last head pose aren't compared; sessions with
    fewer than `least` poses on a side, or without any pose to compare, give 0, 0, 0 and null. poses: session, stereo_rotation, stereo_shift, head_rotation, head_shift
    (rotation vectors, shifts in metres) of the cameras: where a session has them, points are compared in the world's coordinates, else in the cameras'.
    """
    from sessionloom.functions.scalars import camera_to_world

    axes = ["x_mm", "y_mm", "z_mm"]
    number = lambda rows, name: rows.groupBy("session").agg(F.count(F.lit(1)).alias(name))
    counts = number(stereo, "_stereo").join(number(head, "_head"), "session", "left")
    at = O.interpolated(stereo, head, ["session"], "ts_ms", axes, "pose_id", held=False)
    met = stereo.join(at.select("session", "pose_id", *[F.col(a).alias(f"head_{a}") for a in axes]), ["session", "pose_id"])
    point = lambda prefix: F.array(*[F.col(f"{prefix}{a}").cast("double") for a in axes])
    mine, theirs = point(""), point("head_")
    if poses is not None:
        met = met.join(poses, "session", "left")
        known = F.col("stereo_rotation").isNotNull() & F.col("stereo_shift").isNotNull() & F.col("head_rotation").isNotNull() & F.col("head_shift").isNotNull()
        scaled = lambda p, k: F.transform(p, lambda v: v * k)
        world = lambda p, side: F.when(known, scaled(camera_to_world(F.col(f"{side}_rotation"), F.col(f"{side}_shift"), scaled(p, 1e-3)), 1e3)).otherwise(p)
        mine, theirs = world(mine, "stereo"), world(theirs, "head")
    met = met.withColumn("_a", mine).withColumn("_b", theirs)
    far = F.sqrt(sum((F.pow(F.col("_a")[k] - F.col("_b")[k], 2) for k in range(3)), F.lit(0.0)))
    near = (F.col("mm") <= most_mm).cast("double")
    found = met.withColumn("mm", far).where("mm is not null").groupBy("session").agg(F.count(F.lit(1)).alias("compared"), F.sum(near).cast("long").alias("agreed"), F.round(F.avg(near), 6).alias("rate"), F.round(F.avg("mm"), 4).alias("mean_mm"))
    found = found.join(counts.where((F.col("_stereo") >= least) & (F.col("_head") >= least)).select("session"), "session", "left_semi")
    return counts.select("session").join(found, "session", "left").select("session", F.coalesce("compared", F.lit(0)).alias("compared"), F.coalesce("agreed", F.lit(0)).alias("agreed"), F.coalesce("rate", F.lit(0.0)).alias("rate"), "mean_mm")


def throughput(steps: DataFrame, caps: DataFrame) -> DataFrame:
    """Mean time of each step, and the stage with the least sessions a second. steps: step, seconds; caps: stage, per_second."""
    means = steps.groupBy("step").agg(F.round(F.avg("seconds"), 6).alias("mean_s"))
    slowest = caps.agg(F.min(F.struct("per_second", "stage")).alias("m")).select(F.col("m.stage").alias("bottleneck"), F.col("m.per_second").alias("per_second"))
    return means.crossJoin(F.broadcast(slowest))
