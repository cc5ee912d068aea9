"""Scalar functions over columns: grades, names, dates, rigs, formats, JSON, geometry, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade limits, the expected stream names with their alias, and prefixes a stream name may carry.
GRADES = (("A", 85), ("B", 70), ("C", 55), ("D", 40))
STREAMS = ("head", "left", "right")
ALIASES = {"wall": "head", "rigth": "right"}


def round1(x: Column) -> Column:
    """One decimal, halves away from zero; rounded to six first, so engines that differ in the last bits agree."""
    return F.round(F.round(x, 6), 1)


def grade(score: Column) -> Column:
    """A from 85, B from 70, C from 55, D from 40, else F; null stays null."""
    out = F.when(score.isNull(), None)
    for letter, least in GRADES:
        out = out.when(score >= least, letter)
    return out.otherwise("F")


def first_not_empty(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def resolve_name(name: Column, expected=STREAMS, aliases=ALIASES, prefixes=(), most_edits: int = 2) -> Column:
    """The expected name meant: exact, alias, lower case, without a known prefix, else nearest within most_edits (ties by name), else null."""
    low = F.lower(F.trim(name))
    bare = low
    for p in prefixes:
        bare = F.when(F.startswith(bare, F.lit(p)), F.substring(bare, len(p) + 1, 10_000)).otherwise(bare)
    known = F.array(*map(F.lit, sorted(expected)))
    as_alias = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
    exact = [F.when(F.array_contains(known, c), c) for c in (name, low, bare)]
    renamed = [F.try_element_at(as_alias, c) for c in (low, bare)]
    near = F.array_min(F.transform(known, lambda k: F.struct(F.levenshtein(bare, k).alias("d"), k.alias("k"))))
    return F.coalesce(exact[0], renamed[0], exact[1], exact[2], renamed[1], F.when(near["d"] <= most_edits, near["k"]))


def rename_map_ok(targets: Column, sources: Column, present: Column) -> Column:
    """Targets are distinct, and none is taken by a present name that isn't itself renamed."""
    return (F.size(F.array_distinct(targets)) == F.size(targets)) & (F.size(F.array_intersect(targets, F.array_except(present, sources))) == 0)


def name_timestamp(name: Column) -> Column:
    """The time written in `…_YYYYMMDD_HHMMSS…` or `…YYYY-MM-DD_HH-MM-SS…`; null where there is none or no such time."""
    dense = F.regexp_extract(name, r"([0-9]{8})_([0-9]{6})", 0)
    dashed = F.regexp_extract(name, r"[0-9]{4}-[0-9]{2}-[0-9]{2}[_T][0-9]{2}-[0-9]{2}-[0-9]{2}", 0)
    return F.coalesce(F.try_to_timestamp(F.nullif(dense, F.lit("")), F.lit("yyyyMMdd_HHmmss")), F.try_to_timestamp(F.regexp_replace(F.nullif(dashed, F.lit("")), "T", "_"), F.lit("yyyy-MM-dd_HH-mm-ss")))


def rig_number(operator: Column, fleet: int = 30) -> Column:
    """The first number of an operator name; numbers above the fleet size count on from it."""
    n = F.nullif(F.regexp_extract(operator, r"[0-9]+", 0), F.lit("")).try_cast("int")
    return F.when(n <= fleet, n).otherwise(n - fleet)


def rig_of_config(code: Column, rig_id: Column, operator: Column, placeholder: int = 1) -> Column:
    """The number of the rig's code, else of its id; the placeholder number is not trusted and gives way to the operator's."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"[0-9]+", 0), F.lit("")).try_cast("int")
    own = F.coalesce(number(code), number(rig_id))
    return F.when(own.isNull() | (own == placeholder), F.coalesce(rig_number(operator), own)).otherwise(own)


def fixed_rig(code: Column, operator: Column) -> Column:
    """struct(rig_id, code): replaced only where the number is absent or 1."""
    own = F.nullif(F.regexp_extract(code, r"[0-9]+", 0), F.lit("")).try_cast("int")
    n = F.when(own.isNull() | (own == 1), rig_number(operator))
    return F.struct(F.when(n.isNotNull(), F.concat(F.lit("rig_"), n.cast("string"))).alias("rig_id"), F.coalesce(F.concat(F.lit("RIG-"), n.cast("string")), code).alias("code"))


def format_size(n: Column) -> Column:
    unit = lambda k, u: F.format_string(f"%.1f {u}", round1(n / F.lit(float(1024**k))))
    return F.when(n < 1024, F.format_string("%d B", n)).when(n < 1024**2, unit(1, "KB")).when(n < 1024**3, unit(2, "MB")).otherwise(unit(3, "GB"))


def hours_minutes(seconds: Column) -> Column:
    """`1h05` of a number of seconds."""
    return F.format_string("%dh%02d", F.floor(seconds / 3600), F.floor(F.pmod(seconds, F.lit(3600)) / 60))


def format_duration(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %02ds", F.floor(s / 60), F.pmod(s, F.lit(60)))).otherwise(F.format_string("%dh %02dm", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)))


def tag(message: Column, default: str = "other") -> Column:
    """The word in brackets that a message begins with."""
    return F.coalesce(F.nullif(F.regexp_extract(message, r"^\[([^\]]+)\]", 1), F.lit("")), F.lit(default))


def euler_angles(q: Column) -> Column:
    """struct(roll, pitch, yaw) in degrees of a quaternion array (w, x, y, z); zeros where its norm is under 1e-6."""
    norm = F.sqrt(sum((q[k] * q[k] for k in range(4)), F.lit(0.0)))
    w, x, y, z = (q[k] / norm for k in range(4))
    roll = F.degrees(F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)))
    pitch = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (w * y - z * x)))))
    yaw = F.degrees(F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)))
    flat = norm < 1e-6
    return F.struct(*[F.when(flat, F.lit(0.0)).otherwise(v).alias(n) for v, n in ((roll, "roll"), (pitch, "pitch"), (yaw, "yaw"))])


def valid_quaternion(q: Column) -> Column:
    return q.isNotNull() & (F.size(q) == 4) & ~F.forall(q, lambda v: F.abs(v) < 1e-9) & F.forall(q, lambda v: v.isNotNull())


def camera_to_world(rvec: Column, t: Column, p: Column) -> Column:
    """Rᵀ(p − t) with R the rotation by rvec (Rodrigues' formula in closed form); arrays of three."""
    angle = F.sqrt(rvec[0] * rvec[0] + rvec[1] * rvec[1] + rvec[2] * rvec[2])
    k = [F.when(angle > 1e-12, rvec[i] / angle).otherwise(0.0) for i in range(3)]
    d = [p[i] - t[i] for i in range(3)]
    cross = [k[(i + 1) % 3] * d[(i + 2) % 3] - k[(i + 2) % 3] * d[(i + 1) % 3] for i in range(3)]
    dot = sum((k[i] * d[i] for i in range(3)), F.lit(0.0))
    return F.array(*[d[i] * F.cos(angle) - cross[i] * F.sin(angle) + k[i] * dot * (1 - F.cos(angle)) for i in range(3)])


def depth_of_size(size_mm: Column, pixels: Column, width: Column, focal_share: float = 0.8) -> Column:
    """Distance of an object of a known size: focal length (a share of the width) times size over pixels."""
    return F.try_divide(size_mm * F.lit(focal_share) * width, pixels)


def circular_shift(t: Column, start: Column, shift, period: Column) -> Column:
    return start + F.pmod(t - start + shift, period)


def json_text(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def fingerprint(parts: Column) -> Column:
    """SHA-1 of a list of strings whatever its order."""
    return F.sha1(F.array_join(F.array_sort(parts), "|").cast("binary"))


def checked_range(x: Column, least: float, most: float) -> Column:
    """Whether x lies in a range; a missing value passes."""
    return F.when(x.isNull(), True).otherwise(x.between(least, most))


def pick_column(columns: list[str], wanted: list[str]) -> str | None:
    """The first of the wanted names that a table has."""
    return next((c for c in wanted if c in columns), None)
