"""Operators over ordered rows: gaps, rates in sliding windows, derivatives, capacity, representatives, nearest and interpolated values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import written


def _by(keys, *order):
    return Window.partitionBy(*keys).orderBy(*order)


#: A key with more rows than this is cut into ranges of about as many.
RANGE_ROWS = 1_000_000


def _large(rows: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with up to `most` rows (and of keys with a null), and of the others; None where there are none."""
    whole = F.expr(" and ".join(f"`{k}` is not null" for k in keys))
    hot = written(rows.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*keys), "hot-keys")
    if hot.isEmpty():
        return rows, None
    return rows.join(hot, keys, "left_anti").select(*rows.columns), rows.join(hot, keys, "left_semi").select(*rows.columns)


def with_previous(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], most: int = RANGE_ROWS) -> DataFrame:
    """rows with `_prev`, a struct of the columns of the row before it in its key (null for the first). The order must be total within a key.

    Keys with more than `most` rows are cut into ranges of their order. Each range is handed the last row of the one before: a row for each range and key.
    """
    value = F.struct(*columns)
    few, many = _large(rows, keys, most)
    out = few.withColumn("_prev", F.lag(value).over(_by(keys, *order)))
    if many is None:
        return out
    placed = numbered(many, [*keys, *order]).withColumn("_range", F.floor(F.col("number") / most))
    last = placed.groupBy(*keys, "_range").agg(F.max_by(value, "number").alias("_last"))
    handed = last.select(*keys, "_range", F.lag("_last").over(_by(keys, "_range")).alias("_handed"))
    met = placed.join(handed, [*keys, "_range"]).withColumn("_prev", F.coalesce(F.lag(value).over(_by([*keys, "_range"], "number")), "_handed"))
    return out.unionByName(met.select(*rows.columns, "_prev"))


def running_sums(rows: DataFrame, keys: list[str], order: list[str], size: str, name: str, most: int = RANGE_ROWS) -> DataFrame:
    """rows with `name`, the sum of the sizes up to each row of its key. Keys with more than `most` rows are added up in ranges of their order, after the sums of the ranges before."""
    few, many = _large(rows, keys, most)
    out = few.withColumn(name, F.sum(size).over(_by(keys, *order).rowsBetween(Window.unboundedPreceding, 0)))
    if many is None:
        return out
    placed = numbered(many, [*keys, *order]).withColumn("_range", F.floor(F.col("number") / most))
    sums = placed.groupBy(*keys, "_range").agg(F.coalesce(F.sum(size), F.lit(0)).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(_by(keys, "_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum(size).over(_by([*keys, "_range"], "number").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    met = placed.join(sums.select(*keys, "_range", before.alias("_before")), [*keys, "_range"]).withColumn(name, (F.col("_before") + inside).cast(out.schema[name].dataType))
    return out.unionByName(met.select(*rows.columns, name))


def frame_gaps(rows: DataFrame, keys: list[str], at: str, tie: str, nominal: float, drop: float = 2.5, severe: float = 10.0, most: int = RANGE_ROWS) -> DataFrame:
    """Gaps between neighbours: how many are above drop and severe times the nominal step, the largest, and the share."""
    met = with_previous(rows.select(*dict.fromkeys([*keys, at, tie])), keys, [at, tie], [at], most)
    out = met.withColumn("gap", F.col(at) - F.col(f"_prev.{at}")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.col("gap") > drop * nominal).cast("long").alias("drops"),
        F.count_if(F.col("gap") > severe * nominal).cast("long").alias("severe"),
        F.max("gap").alias("max_gap"),
    )
    return out.withColumn("drop_pct", F.round(F.coalesce(F.try_divide(100.0 * F.col("drops"), F.col("frames") - 1), F.lit(0.0)), 4))


def sliding_rate(rows: DataFrame, keys: list[str], at: str, width: float, hop: float, least: int = 5) -> DataFrame:
    """Rate in windows of width every hop from each group's first time; full windows with more than least points.

    The rate is that of the points themselves: their steps over the time from a window's first to its last point (null where that is 0).
    A point is copied to the windows it lies in (width / hop of them), so membership needs no range join.
    """
    ends = rows.groupBy(*keys).agg(F.min(at).alias("t0"), F.max(at).alias("t1"))
    last = F.floor((F.col(at) - F.col("t0")) / hop).cast("long")
    first = F.greatest(F.lit(0), F.floor((F.col(at) - F.col("t0") - width) / hop).cast("long") + 1)
    placed = rows.join(ends, keys).withColumn("k", F.explode(F.sequence(first, last)))
    out = placed.groupBy(*keys, "k").agg(F.count(F.lit(1)).alias("n"), F.first("t0").alias("t0"), F.first("t1").alias("t1"), F.min(at).alias("w0"), F.max(at).alias("w1"))
    out = out.where((F.col("t0") + F.col("k") * hop + width <= F.col("t1")) & (F.col("n") > least))
    return out.select(*keys, "k", "n", F.try_divide(F.col("n") - 1, F.col("w1") - F.col("w0")).alias("rate"))


def drift(rows: DataFrame, keys: list[str], at: str, nominal: float, width: float, hop: float, least_points: int = 10, least_span: float = 0.0) -> DataFrame:
    """keys, windows, rate, delta, std_rate, trend of streams with enough points and span, rounded to 3 places.

    rate and delta are of the whole stream (against the nominal rate), std_rate (population) and trend (the last minus the first) of its sliding rates. A
    stream without a full window has no rate but its own: deviation and trend 0.
    """
    whole = rows.groupBy(*keys).agg(F.count(at).alias("_n"), (F.max(at) - F.min(at)).alias("_span")).where((F.col("_n") >= least_points) & (F.col("_span") > 0) & (F.col("_span") >= least_span))
    rates = sliding_rate(rows.where(F.col(at).isNotNull()), keys, at, width, hop).groupBy(*keys).agg(F.count("rate").alias("windows"), F.stddev_pop("rate").alias("std_rate"), (F.max_by("rate", "k") - F.min_by("rate", "k")).alias("trend"))
    rate = (F.col("_n") - 1) / F.col("_span")
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 3).alias(c)
    return whole.join(rates, keys, "left").select(*keys, F.coalesce("windows", F.lit(0)).alias("windows"), F.round(rate, 3).alias("rate"), F.round(rate - nominal, 3).alias("delta"), zero("std_rate"), zero("trend"))


def displacement(rows: DataFrame, keys: list[str], order: list[str], axes: list[str], most: int = RANGE_ROWS) -> DataFrame:
    """Steps along each axis and their length; zeros in the first row."""
    met = with_previous(rows, keys, order, axes, most)
    out = met.withColumns({f"d_{a}": F.coalesce(F.col(a) - F.col(f"_prev.{a}"), F.lit(0.0)) for a in axes}).drop("_prev")
    return out.withColumn("step", F.sqrt(sum((F.col(f"d_{a}") * F.col(f"d_{a}") for a in axes), F.lit(0.0))))


def derivative(rows: DataFrame, keys: list[str], at: str, value: str, tie: str, least: int = 3, most: int = RANGE_ROWS) -> DataFrame:
    """|change| over time at midpoints; equal times keep their first value; groups with fewer than least steps are left out."""
    first = rows.where(F.col(value).isNotNull()).groupBy(*keys, at).agg(F.min_by(value, tie).alias(value))
    steps = with_previous(first, keys, [at], [at, value], most)
    steps = steps.withColumn("dt", F.col(at) - F.col(f"_prev.{at}")).withColumn("dv", F.abs(F.col(value) - F.col(f"_prev.{value}"))).where("dt > 0")
    enough = first.groupBy(*keys).agg(F.count(at).alias("_m")).where(F.col("_m") - 1 >= least).select(*keys)
    return steps.join(enough, keys, "left_semi").select(*keys, (F.col(at) - F.col("dt") / 2).alias("mid"), (F.col("dv") / F.col("dt")).alias("speed"))


def capacity_prefix(rows: DataFrame, keys: list[str], order: list[str], size: str, cap: float, most: int = RANGE_ROWS) -> DataFrame:
    """Rows in order until the next would go over the cap (sizes are not negative; exactly at the cap is kept)."""
    return running_sums(rows, keys, order, size, "total", most).where(F.col("total") <= cap)


def first_of_group(rows: DataFrame, keys: list[str], order: list, where: Column | None = None) -> DataFrame:
    """The first row of each group (that meets a condition)."""
    rows = rows if where is None else rows.where(where)
    return rows.withColumn("_rn", F.row_number().over(_by(keys, *order))).where("_rn = 1").drop("_rn")


def top_of_group(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(_by(keys, *order))).where(F.col("rank") <= n)


def representatives(rows: DataFrame, keys: list[str], path: str, verdict: str) -> DataFrame:
    """The first row by path of each group decides for all; a missing verdict escalates. Rows with a null key stand for themselves."""
    grouped = rows.where(F.expr(" and ".join(f"{k} is not null" for k in keys)))
    alone = rows.where(F.expr(" or ".join(f"{k} is null" for k in keys)))
    lead = grouped.groupBy(*keys).agg(F.min(F.struct(path, verdict)).alias("lead"))
    out = grouped.join(lead, keys).select(*rows.columns, F.col(f"lead.{path}").alias("lead_path"), F.coalesce(F.col(f"lead.{verdict}"), F.lit(True)).alias("escalate"))
    return out.unionByName(alone.select("*", F.col(path).alias("lead_path"), F.coalesce(F.col(verdict), F.lit(True)).alias("escalate")))


def numbered(rows: DataFrame, order: list[str], start: int = 0) -> DataFrame:
    """rows with `number`, their place in a total order, by range partitions and their running sizes (no single-task window).

    The order must be total (end it with a key). The sorted rows are written, so that numbers stay when a task is repeated.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    sizes = placed.groupBy(F.shiftright("_row", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_m"))  # a row for each partition
    before = F.coalesce(F.sum("_m").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("_before", before).select("_part", "_before")
    out = placed.withColumn("_part", F.shiftright("_row", 33)).join(offsets, "_part")
    return out.withColumn("number", F.col("_before") + F.col("_row").bitwiseAND((1 << 33) - 1) + start).drop("_part", "_before", "_row")


def numbered_sums(rows: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """rows with `name`, the sum of the sizes of all rows before them in a total order, from sums of chunks (no single-task window)."""
    placed = numbered(rows, order).withColumn("_chunk", F.floor(F.col("number") / 10_000))
    sums = placed.groupBy("_chunk").agg(F.sum(size).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for 10,000
    inside = F.coalesce(F.sum(size).over(Window.partitionBy("_chunk").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = placed.join(sums.withColumn("_before", before).select("_chunk", "_before"), "_chunk").withColumn(name, F.col("_before") + inside)
    return out.drop("_chunk", "_before", "number")


def chunk_ids(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    return numbered(rows, order).withColumn("chunk", F.floor(F.col("number") / size).cast("long"))


def even_sample(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows at int(i * len / n) for i below n: an evenly spread sample."""
    placed = numbered(rows, order)
    total = placed.agg(F.count(F.lit(1)).alias("_total"))
    picks = rows.sparkSession.range(n).crossJoin(F.broadcast(total)).select(F.floor(F.col("id") * F.col("_total") / n).cast("long").alias("number")).distinct()
    return placed.join(picks, "number", "left_semi") if n else placed.limit(0)


CELLS = 64


def _cuts(rows: DataFrame, keys: list[str], most: int) -> DataFrame | None:
    """keys and cuts, the times at which ranges of about `most` rows begin, of keys with more rows than that; None where there is none.

    rows: keys, t. The cuts come from counts in CELLS cells for each range between a key's ends, so no task sees all of a key's times. Rows of one cell
    stay together. The result has a time for each `most` rows.
    """
    counts = rows.groupBy(*keys).agg(F.count("t").alias("_n"), F.min("t").alias("_lo"), F.max("t").alias("_hi"))
    hot = written(counts.where((F.col("_n") > most) & (F.col("_hi") > F.col("_lo"))), "hot-keys")
    if hot.isEmpty():
        return None
    width = (F.col("_hi") - F.col("_lo")) / (F.ceil(F.col("_n") / most) * CELLS)
    cells = rows.join(hot, keys).groupBy(*keys, F.floor((F.col("t") - F.col("_lo")) / width).alias("_cell")).agg(F.count(F.lit(1)).alias("_m"), F.min("t").alias("_from"))
    before = F.coalesce(F.sum("_m").over(_by(keys, "_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = cells.withColumn("_k", F.floor(before / most)).groupBy(*keys, "_k").agg(F.min("_from").alias("_from"))
    return written(ranges.where("_k > 0").groupBy(*keys).agg(F.array_sort(F.collect_list("_from")).alias("cuts")), "range-cuts")


def in_ranges(left: DataFrame, right: DataFrame, keys: list[str], tie: str, most: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """left and right with `_range`, so that the last right row before and the first one after each left row lie in its own (keys, _range).

    Both have the keys and a time `t`. A key's rows are cut into ranges of time of about `most` rows. Each range of each key is handed the last right row of the
    ranges before it and the first one of those after it (of equal times the first by `tie`): one row for each range and key. Tasks then work on (keys, _range), so one
    key with all rows is spread over all of them.
    """
    cuts = _cuts(left.select(*keys, "t").unionByName(right.select(*keys, "t")), keys, most)
    if cuts is None:
        return left.withColumn("_range", F.lit(0)), right.withColumn("_range", F.lit(0))
    at = lambda t: F.coalesce(F.size(F.filter("cuts", lambda c: c <= t)), F.lit(0))
    placed = [d.join(cuts, keys, "left").withColumn("_range", F.when(F.col("cuts").isNull() | F.col("t").isNull(), 0).otherwise(at(F.col("t")))).drop("cuts") for d in (left, right)]
    row = F.struct(*right.columns)
    first = lambda time: F.min(F.when(F.col("t").isNotNull(), F.struct(time.alias("t"), F.col(tie).alias("tie"), row.alias("row"))))
    ends = placed[1].join(cuts.select(*keys), keys, "left_semi").groupBy(*keys, "_range").agg(first(-F.col("t")).alias("_last"), first(F.col("t")).alias("_first"))
    ranges = cuts.select(*keys, F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("_range")).join(ends, [*keys, "_range"], "left")
    back = F.last("_last", ignorenulls=True).over(_by(keys, "_range").rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.first("_first", ignorenulls=True).over(_by(keys, "_range").rowsBetween(1, Window.unboundedFollowing))
    handed = ranges.select("_range", back.alias("_b"), ahead.alias("_a")).select("_range", F.explode(F.array("_b", "_a")).alias("x")).where("x is not null").select("x.row.*", "_range")
    return placed[0], placed[1].unionByName(handed)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, left_id: str, right_id: str, most: int = RANGE_ROWS) -> DataFrame:
    """For each left row the right row nearest in time (the earlier one on ties, of equal times the one with the least id): left_id, right_id, gap.

    Both sides are put in one order and each left row looks back and forward: one shuffle and one sort, no range join; see `in_ranges` for keys with very many rows.
    """
    null = F.lit(None)
    l, r = in_ranges(left.select(*keys, F.col(at).alias("t"), F.col(left_id).alias("lid")), right.select(*keys, F.col(at).alias("t"), F.col(right_id).alias("rid")), keys, "rid", most)
    l = l.select(*keys, "_range", "t", "lid", null.cast("double").alias("rt"), null.cast(r.schema["rid"].dataType).alias("rid"), F.lit(1).alias("_side"))
    r = r.select(*keys, "_range", "t", null.cast(l.schema["lid"].dataType).alias("lid"), F.col("t").alias("rt"), "rid", F.lit(0).alias("_side"))
    both, own = l.unionByName(r), [*keys, "_range"]
    pair = F.when(F.col("_side") == 0, F.struct("rt", "rid"))
    back = F.last(pair, ignorenulls=True).over(_by(own, "t", F.asc("_side"), F.desc("rid")).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(pair, ignorenulls=True).over(_by(own, "t", F.desc("_side"), "rid").rowsBetween(0, Window.unboundedFollowing))
    found = both.withColumn("b", back).withColumn("a", ahead).where("_side = 1")
    behind, before = F.col("t") - F.col("b.rt"), F.col("a.rt") - F.col("t")
    use_back = F.col("a").isNull() | (F.col("b").isNotNull() & (behind <= before))
    return found.select(*keys, F.col("lid").alias(left_id), F.when(use_back, F.col("b.rid")).otherwise(F.col("a.rid")).alias(right_id), F.when(use_back, behind).otherwise(before).alias("gap"))


def interpolated(points: DataFrame, series: DataFrame, keys: list[str], at: str, value: str | list[str], point_id: str, most: int = RANGE_ROWS, held: bool = True) -> DataFrame:
    """A series' value (or several) at other times: linear between neighbours. Equal times in the series should be merged first.

    Before the first and after the last time of the series its ends are held, or, without `held`, values are null.
    """
    values = [value] if isinstance(value, str) else list(value)
    null = F.lit(None)
    p, s = in_ranges(points.select(*keys, F.col(at).alias("t"), F.col(point_id).alias("pid")), series.select(*keys, F.col(at).alias("t"), F.struct(*[F.col(v).cast("double").alias(v) for v in values]).alias("sv")), keys, "sv", most)
    p = p.select(*keys, "_range", "t", "pid", null.cast("double").alias("st"), null.cast(s.schema["sv"].dataType).alias("sv"), F.lit(1).alias("_side"))
    s = s.select(*keys, "_range", "t", null.cast(p.schema["pid"].dataType).alias("pid"), F.col("t").alias("st"), "sv", F.lit(0).alias("_side"))
    pair, own = F.when(F.col("_side") == 0, F.struct("st", "sv")), [*keys, "_range"]
    both = p.unionByName(s)
    back = F.last(pair, ignorenulls=True).over(_by(own, "t", F.asc("_side")).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(pair, ignorenulls=True).over(_by(own, "t", F.desc("_side")).rowsBetween(0, Window.unboundedFollowing))
    found = both.withColumn("b", back).withColumn("a", ahead).where("_side = 1")
    share = F.try_divide(F.col("t") - F.col("b.st"), F.col("a.st") - F.col("b.st"))

    def one(v: str) -> Column:
        a, b = F.col(f"a.sv.{v}"), F.col(f"b.sv.{v}")
        ends = F.when(F.col("b").isNull(), a if held else None).when(F.col("a").isNull(), b if held else None)
        return ends.otherwise(F.coalesce(b + share * (a - b), b)).alias(v)

    return found.select(*keys, F.col("pid").alias(point_id), F.col("t").alias(at), *map(one, values))
