"""Grouped aggregates: KPI snapshots, quality shares, histograms, outliers, guarded correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.functions.scalars import grade, round1
from sessionloom.session import written

LETTERS = "ABCDF"


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def kpi_snapshot(rows: DataFrame, keys: list[str], score: str, errors: Column | None = None, warnings: Column | None = None) -> DataFrame:
    """One row for each group of scored rows: counts, rounded mean, range, one count for each grade, issue totals."""
    g = grade(F.col(score))
    issues = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in ((errors, "errors_count"), (warnings, "warnings_count")) if c is not None]
    return rows.where(F.col(score).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count(score).alias("scored_count"),
        round1(F.avg(score)).alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        *[count_where(g == x).alias(f"grade_{x.lower()}_count") for x in LETTERS],
        *issues,
    )


def fleet_quality(rows: DataFrame, score: str, seconds: str, keys: list[str] = ()) -> DataFrame:
    """Counts, mean, grade counts, usable share of the scored (A to D), captured and usable hours."""
    g = grade(F.col(score))
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count(score).alias("scored"),
        round1(F.avg(score)).alias("avg_score"),
        *[count_where(g == x).alias(f"n_{x.lower()}") for x in LETTERS],
        F.round(F.coalesce(F.sum(seconds), F.lit(0)) / 3600, 4).alias("hours"),
        F.round(F.coalesce(F.sum(F.when(g != "F", F.col(seconds))), F.lit(0)) / 3600, 4).alias("usable_hours"),
    )
    usable = F.when(F.col("scored") > 0, round1(100.0 * (F.col("scored") - F.col("n_f")) / F.nullif(F.col("scored"), F.lit(0))))
    return out.withColumn("usable_pct", usable)


def histogram(rows: DataFrame, value: Column, missing: str) -> DataFrame:
    return rows.groupBy(F.coalesce(value, F.lit(missing)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def redundancy(rows: DataFrame, first: Column, second: Column) -> DataFrame:
    """Rows on the first disk alone, on the second alone, on both."""
    return rows.agg(count_where(first & ~second).alias("first_only"), count_where(~first & second).alias("second_only"), count_where(first & second).alias("both"))


def overlap_ratio(rows: DataFrame, keys: list[str], stream: str, at: str, streams_needed: int = 2) -> DataFrame:
    """Shared time of a group's streams over their whole time: 0 where they don't meet, null with fewer streams."""
    each = rows.groupBy(*keys, stream).agg(F.min(at).alias("_s"), F.max(at).alias("_e"))
    shared, whole = F.greatest(F.lit(0.0), F.min("_e") - F.max("_s")), F.max("_e") - F.min("_s")
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("streams"), F.when(F.count(F.lit(1)) >= streams_needed, F.round(F.coalesce(F.try_divide(shared, whole), F.lit(0.0)), 6)).alias("overlap"))


def median_outliers(rows: DataFrame, group: str, member: str, at: str, most_seconds: float = 3.0, ratio: tuple[float, float] = (0.70, 1.30), videos: DataFrame | None = None) -> DataFrame:
    """Members whose start, end, duration or count is off their group's median; HIGH with two reasons or more, else LOW or OK.

    videos: group, member, video_seconds. Where two members or more of a group have it, one that is off their median is a fifth reason.
    """
    each = rows.groupBy(group, member).agg(F.min(at).alias("t0"), F.max(at).alias("t1"), F.count(F.lit(1)).alias("n")).withColumn("dur", F.col("t1") - F.col("t0"))
    each = each.withColumn("video_seconds", F.lit(None).cast("double")) if videos is None else each.join(videos.groupBy(group, member).agg(F.max("video_seconds").alias("video_seconds")), [group, member], "left")
    medians = each.groupBy(group).agg(*[F.median(c).alias(f"m_{c}") for c in ("t0", "t1", "dur", "n")], F.when(F.count("video_seconds") >= 2, F.median("video_seconds")).alias("m_video_seconds"))
    far = lambda c: (F.abs(F.col(c) - F.col(f"m_{c}")) > most_seconds).cast("int")
    off = lambda c: F.coalesce((~F.try_divide(F.col(c), F.col(f"m_{c}")).between(*ratio)).cast("int"), F.lit(0))
    out = each.join(medians, group).withColumn("reasons", far("t0") + far("t1") + off("dur") + off("n") + off("video_seconds"))
    return out.select(group, member, "n", "reasons", F.when(F.col("reasons") >= 2, "HIGH").when(F.col("reasons") == 1, "LOW").otherwise("OK").alias("confidence"))


#: A group with more values than this gets its median by counting in cells.
COUNTED_ROWS = 1_000_000
CELLS = 4096


def exact_medians(rows: DataFrame, keys: list[str], value: str, most: int = COUNTED_ROWS) -> DataFrame:
    """keys, median of the finite values of each group (null without any), equal to `median` and without a buffer of a large group's values.

    In a group of more than `most` values each of the one or two middle ranks has an interval that holds it. A round counts the interval's values in CELLS cells and takes the
    cell with the rank as the next interval, until few values (or one) are left, which are counted by value. Values shrink by orders of magnitude with each round; ties are
    one row with a count.
    """
    own = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNull() | ((F.abs("_v") < float("inf")) & ~F.isnan("_v")))
    counts = own.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    large = written(counts.where(F.col("_n") > most), "large-groups")
    if large.isEmpty():
        return own.groupBy(*keys).agg(F.median("_v").alias("median"))
    few = own.join(large.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.median("_v").alias("median"))
    middle = F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)))
    # rank: the place among the interval's own values; left: how many these are
    asked = large.select(*keys, "_lo", "_hi", F.col("_n").alias("_left"), F.explode(middle).alias("_target")).withColumn("_rank", F.col("_target"))
    found = []
    goal = [*keys, "_target"]
    upto = Window.partitionBy(*goal).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        asked = written(asked, "median-intervals")
        small = asked.where((F.col("_left") <= most) | (F.col("_lo") == F.col("_hi")))
        met = own.join(small, keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).groupBy(*goal, "_rank", "_v").agg(F.count(F.lit(1)).alias("_m"))
        before = F.coalesce(F.sum("_m").over(Window.partitionBy(*goal).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found.append(met.withColumn("_b", before).where((F.col("_b") < F.col("_rank")) & (F.col("_rank") <= F.col("_b") + F.col("_m"))).select(*goal, "_v"))
        asked = asked.where((F.col("_left") > most) & (F.col("_lo") < F.col("_hi")))
        if asked.isEmpty():
            break
        inside = own.join(asked, keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        share = (F.col("_v") / 4 - F.col("_lo") / 4) / (F.col("_hi") / 4 - F.col("_lo") / 4)  # no difference overflows
        cells = inside.groupBy(*goal, "_rank", F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).alias("_cell")).agg(F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        cells = cells.withColumn("_b", F.coalesce(F.sum("_m").over(upto), F.lit(0))).where((F.col("_b") < F.col("_rank")) & (F.col("_rank") <= F.col("_b") + F.col("_m")))
        asked = cells.select(*keys, "_lo", "_hi", F.col("_m").alias("_left"), "_target", (F.col("_rank") - F.col("_b")).alias("_rank"))
    all_ = found[0]
    for f in found[1:]:
        all_ = all_.unionByName(f)
    return few.unionByName(all_.groupBy(*keys).agg(F.avg("_v").alias("median")))


def pearson(x: str, y: str, flat: float = 1e-8) -> Column:
    """Correlation as an aggregate; 0 where either side hardly varies. No branch can raise."""
    r = F.coalesce(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), F.lit(0.0))
    return F.when((F.stddev_pop(x) < flat) | (F.stddev_pop(y) < flat), 0.0).otherwise(r)


def rmse(x: str, y: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(x) - F.col(y), 2)))


def top_values(rows: DataFrame, value: Column, n: int) -> DataFrame:
    """The most frequent values; ties by value."""
    return rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n)


def group_fingerprint(rows: DataFrame, keys: list[str], part: Column) -> DataFrame:
    """SHA-1 over a group's sorted parts; for groups of bounded size, as the files of a folder are."""
    return rows.groupBy(*keys).agg(F.sha1(F.array_join(F.array_sort(F.collect_list(part)), "|").cast("binary")).alias("fingerprint"), F.count(F.lit(1)).alias("files"))


def max_of_streams(values: Column) -> Column:
    """The largest value of a map of streams; 0 where there is none."""
    return F.coalesce(F.array_max(F.map_values(values)), F.lit(0.0))


def upper_median(values: Column) -> Column:
    """The element at half the length of the sorted positive values."""
    kept = F.array_sort(F.filter(values, lambda v: v > 0))
    return F.when(F.size(kept) > 0, F.element_at(kept, (F.floor(F.size(kept) / 2) + 1).cast("int")))


def worst(rows: DataFrame, group: str, name: str, value: str) -> DataFrame:
    """The member with the largest value; the first by name on ties."""
    best = F.max(F.struct(F.col(value).alias("v"), F.lit(1).alias("one")))["v"]
    top = rows.groupBy(group).agg(best.alias("value"))
    return rows.join(top, group).where(F.col(value) == F.col("value")).groupBy(group).agg(F.min(name).alias("worst"), F.first("value").alias("value"))


def disk_totals(rows: DataFrame, disk: str, analysed: Column, seconds: str) -> DataFrame:
    return rows.groupBy(disk).agg(F.count(F.lit(1)).alias("sessions"), count_where(analysed).alias("with_analysis"), F.round(F.coalesce(F.sum(seconds), F.lit(0)), 4).alias("seconds"))


def benjamini_hochberg(rows: DataFrame, key: str, p: str, q: float) -> DataFrame:
    """key, p, rank, passes: all ranks up to the largest with p <= rank / n * q pass.

    Ranks come from distinct p-values and running counts of them, so no task holds all rows.
    """
    counts = rows.where(F.col(p).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("m"))
    spread = counts.withColumn("slot", F.floor(F.col(p) * 1024).cast("int"))
    slots = spread.groupBy("slot").agg(F.sum("m").alias("m"))
    total = slots.agg(F.sum("m").alias("n"))
    before = slots.withColumn("before", F.coalesce(F.sum("m").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("slot", "before")
    ranked = spread.join(before, "slot").withColumn("rank", F.col("before") + F.sum("m").over(Window.partitionBy("slot").orderBy(p).rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.crossJoin(F.broadcast(total))  # one row
    cut = ranked.where(F.col(p) <= F.col("rank") / F.col("n") * q).agg(F.max(p).alias("cut"))
    return rows.where(F.col(p).isNotNull()).join(ranked.select(p, F.col("rank").alias("last_rank")), p).crossJoin(F.broadcast(cut)).select(key, p, "last_rank", F.coalesce(F.col(p) <= F.col("cut"), F.lit(False)).alias("passes"))
