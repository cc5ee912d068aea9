"""Order-dependent and lag-scanning operators: greedy choices over ranges and chunks, series of sessions in numpy."""

from __future__ import annotations

import math
from hashlib import md5
from itertools import pairwise, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sessionloom.session import fresh, path_exists, written


def each_group(rows: DataFrame, key: str, order: list[str], run, schema: str) -> DataFrame:
    """run(key, table) gives tuples for each group; a group's rows come in order, and a task holds one group at a time.

    Groups are told apart in a sorted stream, so thousands of small ones cost one call of Python a batch, not one each.
    Rows with a null key are left out.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def packed(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found, strict=True)) or [[] for _ in fields]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], schema=fields)

    def scan(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            found: list[tuple] = []
            k = b.column(key).to_numpy(zero_copy_only=False)
            for lo, hi in pairwise([0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), b.num_rows] if b.num_rows else []):
                if held and k[lo] != last:
                    found += run(last, pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(lo, hi - lo))
                last = k[lo].item() if hasattr(k[lo], "item") else k[lo]
            yield packed(found)
        if held:
            yield packed(list(run(last, pa.Table.from_batches(held))))

    return rows.where(F.col(key).isNotNull()).repartition(key).sortWithinPartitions(key, *order).mapInArrow(scan, schema)


#: A group with more rows than this is chosen from by phases over all tasks, a smaller one in one pass of one task.
PHASED_ROWS = 1_000_000
CHUNK_ROWS = 100_000


def skip_capacity(rows: DataFrame, group: str, order: str, size: str, cap: float, most: int = PHASED_ROWS) -> DataFrame:
    """First fit in name order: a row that would go over the cap is passed over, later ones may still fit.

    Rows come in order of (order, size); sizes are not negative, and sums of whole numbers are exact. Groups of up to `most` rows are streamed in order through a fold that keeps one number. Of larger ones see
    `phased_capacity`. Rows with a null group, order or size are left out.
    """
    rows = rows.where(F.col(group).isNotNull() & F.col(order).isNotNull() & F.col(size).isNotNull())
    large = written(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(group), "large-groups")
    if large.isEmpty():
        return _folded_capacity(rows, group, order, size, cap)
    few, many = rows.join(large, group, "left_anti"), rows.join(large, group, "left_semi")
    return _folded_capacity(few, group, order, size, cap).unionByName(phased_capacity(many, group, order, size, cap))


def _folded_capacity(rows: DataFrame, group: str, order: str, size: str, cap: float) -> DataFrame:
    taken = rows.withColumn("_size", F.col(size).cast("double"))
    place, at = taken.columns.index(group), taken.columns.index("_size")
    names = rows.columns

    def fold(batches):
        last, room = None, cap
        for b in batches:
            keep = []
            for g, s in zip(b.column(place).to_pylist(), b.column(at).to_pylist(), strict=True):
                if g != last:
                    last, room = g, cap
                fits = s <= room
                if fits:
                    room -= s
                keep.append(fits)
            yield b.select(names).filter(pa.array(keep, pa.bool_()))

    return taken.repartition(group).sortWithinPartitions(group, order, "_size").mapInArrow(fold, rows.schema)


def phased_capacity(rows: DataFrame, group: str, order: str, size: str, cap: float, chunk: int = CHUNK_ROWS) -> DataFrame:
    """skip_capacity for groups of any size, spread over all tasks.

    In a phase that begins with room R, rows of at most R / 2 (small ones) all fit as long as the room is above R / 2, so what they leave is a running sum. The
    phase ends with the small row that brings the room down to R / 2, or with the first larger row that fits; either way the room is halved at least, so there are
    as many phases as halvings between the cap and the smallest size. Rows are numbered and cut into chunks once; a phase adds up the chunks' small rows, passes over chunks whose least larger
    row can't fit (their sums of small rows known), and looks into those that are left. The driver sees no rows, only whether a group is still open.
    """
    from sessionloom.operators.ordered import numbered

    spark = rows.sparkSession
    placed = numbered(rows.withColumn("_size", F.col(size).cast("double")), [group, order, "_size", *[c for c in rows.columns if c not in (group, order)]])
    placed = written(placed.withColumn("_chunk", F.floor(F.col("number") / chunk)), "capacity-rows")
    narrow = placed.select(group, "_chunk", "number", "_size")
    kind = rows.schema[group].dataType.simpleString()
    open_ = written(rows.select(group).distinct().select(group, F.lit(float(cap)).alias("room"), F.lit(-1).cast("long").alias("done")), "capacity-open")
    phases = []  # (group, room, done, to): small rows of half the room in done+1..to are taken, and row `to` itself
    small, big = F.col("_size") <= F.col("room") / 2, (F.col("_size") > F.col("room") / 2) & (F.col("_size") <= F.col("room"))
    total = lambda c: F.sum(F.when(c, F.col("_size")).otherwise(0.0))
    while not open_.isEmpty():
        rest = narrow.join(open_, group).where(F.col("number") > F.col("done"))
        sums = rest.groupBy(group, "room", "done", "_chunk").agg(total(small).alias("_s"), F.min(F.when(big, F.col("_size"))).alias("_least"))
        upto = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_before", F.coalesce(F.sum("_s").over(upto), F.lit(0.0)))
        # the chunk in which small rows halve the room, and those before it in which a larger row may fit
        live = (F.col("room") - F.col("_before") > F.col("room") / 2) & ((F.col("_before") + F.col("_s") >= F.col("room") / 2) | (F.col("_least") <= F.col("room") - F.col("_before")))
        looked = rest.join(written(sums.where(live).select(group, "_chunk", "_before"), "capacity-chunks"), [group, "_chunk"])
        inside = Window.partitionBy(group, "_chunk").orderBy("number")
        left = F.col("room") - F.col("_before") - F.coalesce(total(small).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        looked = looked.withColumn("_left", left).where(F.col("_left") > F.col("room") / 2)
        ends = looked.where((small & (F.col("_left") - F.col("_size") <= F.col("room") / 2)) | (big & (F.col("_size") <= F.col("_left"))))
        end = ends.groupBy(group).agg(F.min(F.struct("number", (F.col("_left") - F.col("_size")).alias("room"))).alias("e"))
        after = open_.join(end, group, "left").select(group, F.col("room"), F.col("done"), F.col("e.number").alias("to"), F.col("e.room").alias("next"))
        after = written(after, "capacity-phase")
        phases.append(after)
        # without an end all small rows of the rest fit; with no room left only rows of size 0 do
        open_ = after.where("to is not null").select(group, F.col("next").alias("room"), F.col("to").alias("done"))
        spent = open_.where("room <= 0")
        phases.append(spent.select(group, "room", "done", F.lit(None).cast("long").alias("to"), F.lit(None).cast("double").alias("next")))
        open_ = open_.where("room > 0")
    known = spark.createDataFrame([], f"{group} {kind}, room double, done long, to long, next double")
    for p in phases:
        known = known.unionByName(p)
    # a group has as many rows here as phases
    each = known.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("done", "room", "to"))).alias("_phases"))
    met = placed.join(each, group)
    mine = F.try_element_at(F.filter("_phases", lambda p: p["done"] < F.col("number")), F.lit(-1))
    met = met.withColumn("_p", mine).where((F.col("_size") <= F.col("_p.room") / 2) | (F.col("number") == F.col("_p.to")))
    return met.select(*rows.columns)


def diverse_sample(rows: DataFrame, group: str, value: str, tie: str, n: int) -> DataFrame:
    """For n targets evenly from the least to the largest value, the nearest unused row each (first by value and tie).

    Only a target's n nearest rows can be its choice, as the targets before it use up n - 1 at most; these are ranked with a
    limit before the shuffle, so a hot group is no single task's work. The choice itself sees n * n rows a group.
    """
    rows = rows.where(F.col(value).isNotNull())
    ends = rows.groupBy(group).agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / max(n - 1, 1)
    target = F.when((F.col("_k") == n - 1) & F.lit(n > 1), F.col("_hi")).otherwise(F.col("_lo") + F.col("_k") * step)
    near = rows.join(ends, group).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("_d", F.abs(F.col(value).cast("double") - target))
    ranked = near.withColumn("_rn", F.row_number().over(Window.partitionBy(group, "_k").orderBy("_d", value, tie))).where(F.col("_rn") <= n)
    each = ranked.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_k", "_rn", F.struct(F.col(value).alias("v"), F.col(tie).alias("t")).alias("id"), F.struct(*rows.columns).alias("row")))).alias("all"))
    kind = each.schema["all"].dataType.simpleString()
    # candidates come by target and nearness; a target that has its row takes no other one, and no row is taken twice
    free = lambda s, x: ~F.exists(s, lambda y: (y["_k"] == x["_k"]) | (y["id"] == x["id"]))
    chosen = F.aggregate("all", F.array().cast(kind), lambda s, x: F.when(free(s, x), F.concat(s, F.array(x))).otherwise(s))
    return each.select(F.explode(chosen["row"]).alias("row")).select("row.*")


def _series(t: pa.Table, names: tuple[str, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Times and values of the named series of a table sorted by series and time, without nulls."""
    series = t.column("series").to_numpy(zero_copy_only=False)
    x, y = (t.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("t", "v"))
    ok = ~(np.isnan(x) | np.isnan(y))
    return [(x[pick], y[pick]) for pick in ((series == n) & ok for n in names)]


def _of(rows: DataFrame, group: str) -> DataFrame:
    return rows.select(group, "series", F.col("t").cast("double").alias("t"), F.col("v").cast("double").alias("v"))


def lags_of(reach: float, lag_step: float) -> np.ndarray:
    return np.arange(-reach, reach + lag_step, lag_step)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of each run of `width` values, in linear time: of two halves that meet at multiples of width."""
    n = x.size - width + 1
    whole = np.append(x, np.full(-x.size % width, x[-1])).reshape(-1, width)
    ahead = pick.accumulate(whole, axis=1).ravel()
    back = pick.accumulate(whole[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1 : width - 1 + n])


def _lag_sums(a: np.ndarray, ta: np.ndarray, grid: np.ndarray, tb: np.ndarray, vb: np.ndarray, step: float, lags: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each lag the sums of a*b, b, b*b over the grid, and the least and greatest b, of b(t - lag), held at its ends.

    Lags in whole steps of the grid are runs of one longer series: products by FFT (directly where there are few), the rest by running sums.
    """
    off = np.rint(lags / step).astype(np.int64)
    if np.abs(off * step - lags).max() > 1e-9 * max(1.0, step):
        b = np.interp(grid[None, :] - lags[:, None], tb, vb)
        return b @ a, b.sum(1), (b * b).sum(1), b.min(1), b.max(1)
    n, most = grid.size, int(off.max())
    delta = grid[1] - grid[0] if n > 1 else step
    long = np.interp(np.concatenate([grid[0] - delta * np.arange(most, 0, -1), grid, grid[-1] + delta * np.arange(1, 1 - int(off.min()))]) if most >= 0 and off.min() <= 0 else grid[0] + delta * np.arange(-most, n - int(off.min())), tb, vb)
    at = most - off
    if n * lags.size <= 200_000:
        b = np.lib.stride_tricks.sliding_window_view(long, n)[at]
        return b @ a, b.sum(1), (b * b).sum(1), b.min(1), b.max(1)
    size = 1 << (long.size + n - 1).bit_length()
    products = np.fft.irfft(np.fft.rfft(long, size) * np.conj(np.fft.rfft(a, size)), size)[at]
    runs = lambda x: (lambda c: c[at + n] - c[at])(np.append(0.0, np.cumsum(x)))
    return products, runs(long), runs(long * long), _sliding(long, n, np.minimum)[at], _sliding(long, n, np.maximum)[at]


def best_lag_of(ta, va, tb, vb, grid_step: float, reach: float, lag_step: float, least_overlap: float = 0.0, least: int = 5, flat: float = 1e-9) -> tuple[float, float]:
    """(lag, r): the first of the lags from -reach on with the largest |correlation| of a(t) and b(t - lag); (0, 0) if none.

    The grid is the time both series share without a lag; b is held at its ends. A side that hardly varies on the grid gives 0. Correlations that are equal to nine places tie.
    """
    if min(ta.size, tb.size) < least:
        return 0.0, 0.0
    lo, hi = max(ta[0], tb[0]), min(ta[-1], tb[-1])
    if hi <= lo or hi - lo < least_overlap:
        return 0.0, 0.0
    grid = np.arange(lo, hi, grid_step)
    a = np.interp(grid, ta, va)
    a = a - a.mean()
    spread = a.std()
    if spread < flat:
        return 0.0, 0.0
    lags = lags_of(reach, lag_step)
    ab, sb, sbb, low, high = _lag_sums(a, ta, grid, tb, vb - vb.mean(), grid_step, lags)
    deviation = np.sqrt(np.maximum(0.0, sbb / grid.size - (sb / grid.size) ** 2))
    flat_b = (high - low < flat) | (deviation < flat)
    r = np.where(flat_b, 0.0, ab / grid.size / (spread * np.where(flat_b, 1.0, deviation)))
    k = int(np.round(np.abs(r), 9).argmax())
    return (float(lags[k]), float(r[k])) if r[k] else (0.0, 0.0)


#: Grid points of a block of a series.
BLOCK_POINTS = 65_536


def _padded_sums(a: np.ndarray, b: np.ndarray, inside: np.ndarray, lags: int) -> tuple[np.ndarray, ...]:
    """For each lag k from -lags to lags the sums of a[i] * b[i + k], a[i], b[i + k] and 1 over places inside the grid. b and inside reach `lags` beyond a on either side, with zeros outside."""
    n = a.size
    if n * (2 * lags + 1) <= 200_000:
        run = lambda x: np.lib.stride_tricks.sliding_window_view(x, n)
        return run(b) @ a, run(inside) @ a, run(b).sum(1), run(inside).sum(1)
    size = 1 << (b.size + n - 1).bit_length()
    turned = np.conj(np.fft.rfft(a, size))
    products = lambda x: np.fft.irfft(np.fft.rfft(x, size) * turned, size)[: 2 * lags + 1]
    runs = lambda x: (lambda c: c[n:] - c[:-n])(np.append(0.0, np.cumsum(x)))
    return products(b), products(inside), runs(b), runs(inside)


HELD_SUMS, PADDED_SUMS = ("ab", "sbk", "sbbk", "low", "high"), ("ab", "sak", "sbk", "nk")


def lag_sums(rows: DataFrame, group: str, pairs: list[tuple[str, str]], grid_step: float, lags: np.ndarray | int, least_overlap: float, least: int, block: int = BLOCK_POINTS) -> DataFrame:
    """group, a, b, k, n, sa, saa, a_low, a_high, sb, sbb, b_low, b_high, a_mean, b_mean and sums for each lag, of the pairs (a, b) of series names in rows (group, series, t, v).

    a and b are interpolated on the grid of the time they share, less their series' means (a_mean, b_mean). lags: times, for which b(t - lag) is taken beyond the grid, held at its
    ends (sums HELD_SUMS); or a number of grid steps, for which products stay inside the grid (PADDED_SUMS, lag k - lags).

    The grid of a pair is cut into blocks of `block` points (as far as the lags reach, at least). A block takes its own samples and those of the blocks beside it, and, where these have none
    that far out, the last sample before and the first one after: one row for each block. It gives sums for each lag, which Spark adds up. Pairs without enough samples or overlap give no row.
    """
    rows = _of(rows, group).where("t is not null and v is not null and not isnan(t) and not isnan(v)").where(F.col(group).isNotNull())
    spark, kind = rows.sparkSession, rows.schema[group].dataType.simpleString()
    padded = isinstance(lags, int)
    block = max(block, lags + 1 if padded else math.ceil(np.abs(lags).max() / grid_step) + 1)
    ends = rows.groupBy(group, "series").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count(F.lit(1)).alias("m"), F.avg("v").alias("mean"))
    side = lambda x: ends.select(F.col(group), F.col("series").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("t0", "t1", "m", "mean")])
    named = F.broadcast(spark.createDataFrame(list(dict.fromkeys(pairs)), "a string, b string"))  # the caller's pairs
    lo, hi = F.greatest("a_t0", "b_t0"), F.least("a_t1", "b_t1")
    met = side("a").join(named, "a").join(side("b"), [group, "b"]).withColumns({"lo": lo, "span": hi - lo})
    met = met.where((F.col("span") > 0) & (F.col("span") >= least_overlap) & (F.least("a_m", "b_m") >= least))
    met = written(met.select(group, "a", "b", "a_mean", "b_mean", "lo", F.ceil(F.col("span") / grid_step).cast("long").alias("n"), F.greatest(F.lit(1), F.ceil(F.ceil(F.col("span") / grid_step) / block)).cast("int").alias("blocks")), "lag-pairs")
    width, key = block * grid_step, [group, "a", "b"]
    parts, long = [], not met.where("blocks > 2").isEmpty()
    for x in ("a", "b"):
        own = rows.join(met.withColumn("series", F.col(x)), [group, "series"]).withColumn("home", F.greatest(F.lit(0), F.least(F.col("blocks") - 1, F.floor((F.col("t") - F.col("lo")) / width))).cast("int"))
        near = own.withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0), F.col("home") - 1), F.least(F.col("blocks") - 1, F.col("home") + 1))))
        parts.append(near.select(*key, "block", "t", "v", F.lit(x).alias("series")))
        if long:
            sample = F.struct("t", "v")
            edges = own.where("blocks > 2").groupBy(*key, "home").agg(F.min(sample).alias("first"), F.max(sample).alias("last"))
            all_ = met.where("blocks > 2").select(*key, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("home")).join(edges, [*key, "home"], "left")
            w = Window.partitionBy(*key).orderBy("home")
            far = all_.select(*key, F.col("home").alias("block"), F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -2)).alias("before"), F.first("first", True).over(w.rowsBetween(2, Window.unboundedFollowing)).alias("after"))
            far = far.select(*key, "block", F.explode(F.array("before", "after")).alias("x")).where("x is not null")
            parts.append(far.select(*key, "block", "x.t", "x.v", F.lit(x).alias("series")))
    samples = parts[0]
    for p in parts[1:]:
        samples = samples.unionByName(p)
    samples = samples.join(met, key).withColumn("key", F.struct(*key, "block").cast("string"))

    def run(_, t: pa.Table) -> list[tuple]:
        (ta, va), (tb, vb) = _series(t, ("a", "b"))
        one = {c: t.column(c)[0].as_py() for c in (*key, "block", "a_mean", "b_mean", "lo", "n")}
        first = one["block"] * block
        place = np.arange(first, min(first + block, one["n"]))
        if not (place.size and ta.size and tb.size):
            return []
        delta = (one["lo"] + grid_step) - one["lo"]
        grid, vb = one["lo"] + delta * place, vb - one["b_mean"]
        a, b = np.interp(grid, ta, va) - one["a_mean"], np.interp(grid, tb, vb)
        if padded:
            reach = np.arange(place[0] - lags, place[-1] + lags + 1)
            inside = ((reach >= 0) & (reach < one["n"])).astype(float)
            sums = _padded_sums(a, np.interp(one["lo"] + delta * reach, tb, vb) * inside, inside, lags)
        else:
            sums = _lag_sums(a, ta, grid, tb, vb, grid_step, lags)
        ends = (f for x in (a, b) for f in (float(x.sum()), float(x @ x), float(x.min()), float(x.max())))
        return [(*(one[c] for c in key), one["a_mean"], one["b_mean"], grid.size, *ends, *(x.tolist() for x in sums))]

    arrays = PADDED_SUMS if padded else HELD_SUMS
    scalars = ["n", "sa", "saa", "a_low", "a_high", "sb", "sbb", "b_low", "b_high"]
    found = each_group(samples.select("key", *key, "block", "series", "t", "v", "a_mean", "b_mean", "lo", "n"), "key", ["series", "t"], run, f"{group} {kind}, a string, b string, a_mean double, b_mean double, n long, " + ", ".join(f"{c} double" for c in scalars[1:]) + ", " + ", ".join(f"{c} array<double>" for c in arrays))
    each = found.select(*key, "a_mean", "b_mean", *scalars, F.posexplode(F.arrays_zip(*arrays)).alias("k", "x")).select(*key, "a_mean", "b_mean", *scalars, "k", "x.*")
    pick = lambda c: F.min if c.endswith("low") else F.max if c.endswith("high") else F.sum
    return each.groupBy(*key, "k").agg(*[pick(c)(c).alias(c) for c in (*scalars, *arrays)], *[F.first(c).alias(c) for c in ("a_mean", "b_mean")])


def _deviation(squares: str, total: str):
    """Of values whose mean is near 0, from sums."""
    return F.sqrt(F.greatest(F.lit(0.0), F.col(squares) / F.col("n") - F.pow(F.col(total) / F.col("n"), 2)))


def best_lags(rows: DataFrame, group: str, pairs: list[tuple[str, str]], grid_step: float = 0.02, reach: float = 1.0, lag_step: float = 0.02, least_overlap: float = 0.0, block: int = BLOCK_POINTS, least: int = 5, flat: float = 1e-9) -> DataFrame:
    """group, a, b, lag, r for the pairs (a, b) of series names in rows (group, series, t, v): what `best_lag_of` gives, with long series spread over tasks (see `lag_sums`)."""
    lags = lags_of(reach, lag_step)
    total = lag_sums(rows, group, pairs, grid_step, lags, least_overlap, least, block)
    da, db = _deviation("saa", "sa"), _deviation("sbbk", "sbk")
    none = (F.col("a_high") - F.col("a_low") < flat) | (F.col("high") - F.col("low") < flat) | (da < flat) | (db < flat)
    r = F.when(none, 0.0).otherwise(F.try_divide(F.col("ab") / F.col("n") - F.col("sa") / F.col("n") * F.col("sbk") / F.col("n"), da * db))
    best = total.withColumn("r", r).groupBy(group, "a", "b").agg(F.max(F.struct(F.round(F.abs("r"), 9).alias("size"), (-F.col("k")).alias("k"), "r")).alias("x"))
    lag = F.element_at(F.array(*[F.lit(float(x)) for x in lags]), (1 - F.col("x.k")).cast("int"))
    return best.select(group, "a", "b", F.when(F.col("x.r") != 0, lag).otherwise(0.0).alias("lag"), F.col("x.r").alias("r"))


def _lag_time(lag, lags: int, step: float):
    """A lag of so many grid steps as a time, rounded to one place as a number of its own."""
    return F.element_at(F.array(*[F.lit(round(k * step, 1)) for k in range(-lags, lags + 1)]), (lag + lags + 1).cast("int"))


def _biased(total: DataFrame, key: list[str], lags: int, a_scale, b_scale) -> DataFrame:
    """total with r, the normalised cross-correlation of each lag, and best: that of the largest |r| (the first, to nine places), at its lag; zero: that of lag 0."""
    ma, mb = F.col("sa") / F.col("n"), F.col("sb") / F.col("n")
    r = (F.col("ab") - mb * F.col("sak") - ma * F.col("sbk") + F.col("nk") * ma * mb) / (a_scale * b_scale)
    found = total.where("nk > 0").withColumn("r", r)
    best = F.max(F.struct(F.round(F.abs("r"), 9).alias("size"), (-F.col("k")).alias("k"), "r"))
    at_zero = F.max(F.when(F.col("k") == lags, F.struct("n", "sa", "saa", "a_low", "a_high", "sb", "sbb", "b_low", "b_high", "ab", "a_mean", "b_mean", "r")))
    return found.groupBy(*key).agg(best.alias("best"), at_zero.alias("zero")).select(*key, (-F.col("best.k") - lags).alias("best_lag"), F.col("best.r").alias("best_r"), "zero")


def best_lag(rows: DataFrame, group: str, a: str, b: str, grid_step: float = 0.02, reach: float = 1.0, lag_step: float = 0.02, least_overlap: float = 0.0, block: int = BLOCK_POINTS) -> DataFrame:
    """group, lag, r of the series named a and b in rows (group, series, t, v); 0 and 0 for groups without enough of both."""
    found = best_lags(rows, group, [(a, b)], grid_step, reach, lag_step, least_overlap, block).select(group, "lag", "r")
    groups = rows.select(group).where(F.col(group).isNotNull()).distinct()
    return groups.join(found, group, "left").select(group, F.coalesce("lag", F.lit(0.0)).alias("lag"), F.coalesce("r", F.lit(0.0)).alias("r"))


#: Left and right video with left and right sensor.
PAIRS = tuple(product(("left", "right"), ("left", "right")))
SIDES = ("video_left", "video_right", "sensor_left", "sensor_right")


def pairings(rows: DataFrame, group: str, grid_step: float = 0.02, reach: float = 1.0, lag_step: float = 0.02, least_points: int = 30, least_span: float = 3.0, block: int = BLOCK_POINTS) -> DataFrame:
    """group, r_ll, r_lr, r_rl, r_rr (video side, sensor side), lag_ll, lag_rr, enough_left, enough_right of series SIDES.

    enough: the video's samples suffice (least_points and least_span).
    """
    found = best_lags(rows, group, [(f"video_{v}", f"sensor_{s}") for v, s in PAIRS], grid_step, reach, lag_step, block=block)
    of = lambda c, v, s: F.max(F.when((F.col("a") == f"video_{v}") & (F.col("b") == f"sensor_{s}"), F.col(c)))
    wide = found.groupBy(group).agg(*[of("r", v, s).alias(f"r_{v[0]}{s[0]}") for v, s in PAIRS], *[of("lag", v, v).alias(f"lag_{v[0]}{v[0]}") for v in ("left", "right")])
    sound = rows.where(F.col(group).isNotNull())
    mine = lambda v: F.when((F.col("series") == f"video_{v}") & F.col("v").isNotNull(), F.col("t"))
    enough = sound.groupBy(group).agg(*[F.coalesce((F.count(mine(v)) >= least_points) & (F.max(mine(v)) - F.min(mine(v)) >= least_span), F.lit(False)).alias(f"enough_{v}") for v in ("left", "right")])
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return enough.join(wide, group, "left").select(group, *[zero(f"r_{v[0]}{s[0]}") for v, s in PAIRS], zero("lag_ll"), zero("lag_rr"), "enough_left", "enough_right")


def gripper_flow_sides(rows: DataFrame, group: str, step: float = 33.33, least_overlap: float = 2000.0, reach: int = 45, prefer_zero: float = 0.8, flat: float = 1e-6, block: int = BLOCK_POINTS) -> DataFrame:
    """group, side, correlation, lag_ms, note from rows (group, side, series, t, v) of series gripper and flow, t in ms.

    The normalised cross-correlation, each lag divided by the full length; lag 0 if it reaches a share of the best. note is overlap or flat where there is no correlation; a side
    without both series gives no row. Long series are spread over tasks (see `lag_sums`).
    """
    sound = rows.where(F.col(group).isNotNull() & F.col("side").isNotNull() & F.col("t").isNotNull() & F.col("v").isNotNull())
    of = lambda name, how: how(F.when(F.col("series") == name, F.col("t")))
    sides = sound.where(F.col("series").isin("gripper", "flow")).groupBy(group, "side").agg(*[of(n, h).alias(f"{n}_{c}") for n in ("gripper", "flow") for c, h in (("t0", F.min), ("t1", F.max))])
    sides = sides.where("gripper_t0 is not null and flow_t0 is not null")
    span = F.least("gripper_t1", "flow_t1") - F.greatest("gripper_t0", "flow_t0")
    sides = sides.select(group, "side", (span < least_overlap).alias("short"), F.struct(group, "side").alias("_side"))
    total = lag_sums(sound.select(F.struct(group, "side").alias("_side"), "series", "t", "v"), "_side", [("gripper", "flow")], step, reach, least_overlap, 1, block)
    spread = lambda x: _deviation(f"s{x}{x}", f"s{x}")
    found = _biased(total, ["_side"], reach, spread("a") * F.col("n") + 1e-8, spread("b") + 1e-8)
    still = (F.col("zero.a_high") - F.col("zero.a_low") < flat) | (F.col("zero.b_high") - F.col("zero.b_low") < flat)
    at_zero = F.abs("zero.r") >= prefer_zero * F.abs("best_r")
    met = sides.join(found.withColumn("still", still), "_side", "left")
    note = F.when(F.col("short"), "overlap").when(F.coalesce("still", F.lit(True)), "flat")
    r, lag = F.when(at_zero, F.col("zero.r")).otherwise(F.col("best_r")), F.when(at_zero, 0).otherwise(F.col("best_lag"))
    return met.select(group, "side", F.when(note.isNull(), F.round(r, 4)).alias("correlation"), F.when(note.isNull(), _lag_time(lag, reach, step)).alias("lag_ms"), note.alias("note"))


def gripper_flow_check(sides: DataFrame, group: str, least: float = 0.30) -> DataFrame:
    """group, weakest, ok: the least |correlation| of a group's sides; groups without one pass."""
    out = sides.groupBy(group).agg(F.min(F.abs("correlation")).alias("weakest"))
    return out.withColumn("ok", F.coalesce(F.col("weakest") >= least, F.lit(True)))


def trajectory_correlation(rows: DataFrame, group: str, step_ms: float, least_overlap: float = 2000.0, reach_ms: float = 1500.0, coherent: float = 0.70, block: int = BLOCK_POINTS) -> DataFrame:
    """group, points, pearson_x/y/z, rmse_x/y/z, lag_ms, coherent of two trajectories in rows (group, source, t_ms, x, y, z), source stereo or head.

    Fewer than five points on a side, or too short an overlap, give zeros and null errors. Long trajectories are spread over tasks (see `lag_sums`).
    """
    lags = int(reach_ms / step_ms + 1e-9)
    axes = F.explode(F.array(*[F.struct(F.concat("source", F.lit(f".{a}")).alias("series"), F.col(a).cast("double").alias("v")) for a in "xyz"]))
    series = rows.where(F.col("source").isin("stereo", "head")).select(group, F.col("t_ms").alias("t"), axes.alias("s")).select(group, "t", "s.series", "s.v")
    total = lag_sums(series, group, [(f"head.{a}", f"stereo.{a}") for a in "xyz"], step_ms, lags, least_overlap, 5, block)
    spread = lambda x: _deviation(f"s{x}{x}", f"s{x}")
    found = _biased(total, [group, "a"], lags, spread("a") + 1e-8, spread("b") + 1e-8)
    z = lambda c: F.col(f"zero.{c}")
    n = z("n")
    deviation = lambda x: F.sqrt(F.greatest(F.lit(0.0), z(f"s{x}{x}") / n - F.pow(z(f"s{x}") / n, 2)))
    still = (deviation("a") < 1e-8) | (deviation("b") < 1e-8) | (z("a_high") - z("a_low") < 1e-8) | (z("b_high") - z("b_low") < 1e-8)
    pearson = F.when(still, 0.0).otherwise(F.try_divide(z("ab") / n - z("sa") / n * z("sb") / n, deviation("a") * deviation("b")))
    apart = z("b_mean") - z("a_mean")
    square = (z("sbb") - 2 * z("ab") + z("saa") + 2 * apart * (z("sb") - z("sa"))) / n + apart * apart
    each = found.select(group, F.substring_index("a", ".", -1).alias("axis"), n.alias("points"), pearson.alias("r"), F.sqrt(F.greatest(F.lit(0.0), square)).alias("error"), F.col("best_lag"))
    of = lambda c, a: F.max(F.when(F.col("axis") == a, F.col(c)))
    wide = each.groupBy(group).agg(F.max("points").alias("points"), *[of("r", a).alias(f"r_{a}") for a in "xyz"], *[F.round(of("error", a), 2).alias(f"rmse_{a}") for a in "xyz"], _lag_time(of("best_lag", "x"), lags, step_ms).alias("lag_ms"))
    groups = rows.select(group).where(F.col(group).isNotNull()).distinct().join(wide, group, "left")
    mean = sum((F.abs(F.coalesce(f"r_{a}", F.lit(0.0))) for a in "xyz"), F.lit(0.0)) / 3
    zero = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    return groups.select(group, F.coalesce("points", F.lit(0)).alias("points"), *[zero(F.round(f"r_{a}", 4), f"pearson_{a}") for a in "xyz"], *[f"rmse_{a}" for a in "xyz"], zero(F.col("lag_ms"), "lag_ms"), (F.col("points").isNotNull() & (mean >= coherent)).alias("coherent"))


def speed_of(t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """|dv / dt| at midpoints of distinct times (the first value of each); empty with fewer than three steps."""
    t, first = np.unique(t, return_index=True)
    if t.size < 4:
        return np.empty(0), np.empty(0)
    return (t[1:] + t[:-1]) / 2, np.abs(np.diff(v[first])) / np.diff(t)


def draw_shares(name: str, draws: range) -> np.ndarray:
    """Numbers from 0 to below 1 that belong to a group's name and the draws' numbers: the first 32 bits of MD5 of `name:number`, which any engine can compute."""
    return np.array([int(md5(f"{name}:{k}".encode()).hexdigest()[:8], 16) for k in draws]) / 2.0**32


DRAWS_AT_ONCE = 50


def _margins(rows: DataFrame, group: str, draws: int, at_once: int, how: dict) -> DataFrame:
    """group, margin, draws, as_large: the real margin, how many draws there are, and how many of their margins are as large.

    The draws are numbered and cut into blocks of `at_once`. Each block is a row for each of a group's samples, so a group's draws are spread over tasks; the counts are added by Spark.
    """
    guard, grid_step, reach, lag_step, least_overlap = (how[k] for k in ("guard", "grid_step", "reach", "lag_step", "least_overlap"))

    def shifted(t: np.ndarray, v: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray]:
        at = t[0] + np.mod(t - t[0] + shift, t[-1] - t[0])
        order = np.argsort(at, kind="stable")
        return at[order], v[order]

    def run(key, t: pa.Table) -> list[tuple]:
        s = dict(zip(SIDES, _series(t, SIDES), strict=True))
        sensors = {side: speed_of(*s[f"sensor_{side}"]) for side in ("left", "right")}
        if min(x[0].size for x in (s["video_left"], s["video_right"], *sensors.values())) < 5:
            return []

        def margin(moved) -> float:
            r = {p: abs(best_lag_of(*s[f"video_{p[0]}"], *moved[p[1]], grid_step, reach, lag_step, least_overlap)[1]) for p in PAIRS}
            return sum(v if a == b else -v for (a, b), v in r.items())

        name, block = t.column(group)[0].as_py(), t.column("block")[0].as_py()
        real = margin(sensors)
        period = min(x[0][-1] - x[0][0] for x in sensors.values())
        if period <= 2 * guard:
            return [(name, real, 0, 0)]
        mine = range(block * at_once, min(draws, (block + 1) * at_once))
        shifts = guard + draw_shares(str(name), mine) * (period - 2 * guard)
        # margins that agree to nine places are as large
        as_large = sum(round(abs(margin({side: shifted(*x, shift) for side, x in sensors.items()})) - abs(real), 9) >= 0 for shift in shifts)
        return [(name, real, len(mine), as_large)]

    kind = rows.schema[group].dataType.simpleString()
    placed = _of(rows, group).where(F.col(group).isNotNull()).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, math.ceil(draws / at_once) - 1)))))
    placed = placed.withColumn("key", F.struct(group, "block").cast("string"))
    found = each_group(placed, "key", ["series", "t"], run, f"{group} {kind}, margin double, draws long, as_large long")
    return found.groupBy(group).agg(F.max("margin").alias("margin"), F.sum("draws").alias("draws"), F.sum("as_large").alias("as_large"))


def permutation_test(rows: DataFrame, group: str, draws: int = 300, grid_step: float = 0.05, reach: float = 0.5, lag_step: float = 0.05, guard: float = 1.0, least_overlap: float = 2.0, refine: int | None = None, at_once: int = DRAWS_AT_ONCE) -> DataFrame:
    """group, margin, p, vote: are left video and sensor, and right ones, paired rightly?

    Series SIDES: flow of the videos, openings of the sensors, of which the speeds are compared.
    margin = |LL| + |RR| - |LR| - |RL| of best-lag correlations. Each draw shifts both sensors by one circular shift, from guard
    to the shorter sensor's span less guard; p is (1 + draws with a margin as large) / (1 + draws), or 1 where a sensor is too short
    to be shifted. Draws are numbered and belong to the group's name (`draw_shares`), so p is the same however they are cut into blocks.
    With refine, a group whose p is below 0.05 is drawn anew, so often, and that p replaces the first.
    Groups with fewer than five points in a series are left out.
    """
    how = {"guard": guard, "grid_step": grid_step, "reach": reach, "lag_step": lag_step, "least_overlap": least_overlap}
    p = (1 + F.col("as_large")) / (1 + F.col("draws"))
    first = _margins(rows, group, draws, at_once, how).select(group, "margin", p.alias("p"))
    if refine:
        first = written(first, "first-draws")
        close = first.where("p < 0.05").select(group)
        again = _margins(rows.join(close, group, "left_semi"), group, refine, at_once, how).select(group, p.alias("_p"))
        first = first.join(again, group, "left").select(group, "margin", F.coalesce("_p", "p").alias("p"))
    return first.withColumn("vote", F.when(F.col("p") >= 0.05, "inconclusive").when(F.col("margin") > 0, "same").otherwise("swap"))


def pairing_verdicts(rows: DataFrame, group: str, draws: int = 300, refine: int = 5000, q: float = 0.05, **how) -> DataFrame:
    """group, margin, p, vote, robust: the permutation test in two passes, then Benjamini-Hochberg over all groups.

    p can't fall below 1 / (1 + draws), too coarse for many groups, so candidates are drawn again with refine draws.
    """
    from sessionloom.operators.aggregates import benjamini_hochberg

    tested = written(permutation_test(rows, group, draws, refine=refine, **how), "pairing")  # draws aren't repeated for the ranks
    passed = benjamini_hochberg(tested.select(group, "p"), group, "p", q).select(group, F.col("passes").alias("robust"))
    return tested.join(passed, group)


class Room:
    """Free space of targets in order, as a tournament tree: each node has the largest space below it, so the first target with room is found in log time."""

    def __init__(self, free: list[float]):
        self.n = 1
        while self.n < len(free):
            self.n *= 2
        self.most = [-math.inf] * self.n + list(free) + [-math.inf] * (self.n - len(free))
        for k in range(self.n - 1, 0, -1):
            self.most[k] = max(self.most[2 * k], self.most[2 * k + 1])

    def free(self, count: int) -> list[float]:
        return self.most[self.n : self.n + count]

    def take(self, size: float, reserve: float) -> int | None:
        """The first target that keeps the reserve free with an item of that size, which it then holds; None where nothing fits."""
        most = self.most
        if most[1] - size < reserve:
            return None
        k = 1
        while k < self.n:
            k *= 2
            if most[k] - size < reserve:
                k += 1
        at = k - self.n
        most[k] -= size
        while k > 1:
            k //= 2
            most[k] = max(most[2 * k], most[2 * k + 1])
        return at


def first_fit(items: DataFrame, targets: list[tuple[str, float]], order: list[str], key: str, size: str, reserve: float, chunk: int = 1_000_000) -> DataFrame:
    """key, target (null where nothing fits): items in order, each to the first target with room for it that keeps the reserve free.

    What an item finds depends on all before it, so items are numbered in order, cut into chunks that are written once, and folded a chunk at a time, one chunk's rows
    (key and size) in a task; between chunks the driver holds the free space of the targets alone. A chunk is read when its turn comes, and no other one then. Items larger than any
    target's space don't come into chunks, and once no target could take even the smallest item, the rest wait without being read.
    """
    from sessionloom.operators.ordered import numbered

    spark = items.sparkSession
    kind = items.schema[key].dataType.simpleString()
    names, free = [n for n, _ in targets], [float(f) for _, f in targets]
    sized = items.select(key, F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("_size"), *[c for c in order if c not in (key, size)])
    rows = numbered(sized.where(F.col("_size") <= max(free, default=-math.inf) - reserve), order)
    folder = fresh(spark, "first-fit")
    cut = rows.select(key, "_size", "number", F.floor(F.col("number") / chunk).cast("int").alias("chunk"))
    cut.repartition("chunk").sortWithinPartitions("chunk", "number").write.partitionBy("chunk").parquet(f"{folder}/rows")
    sizes = spark.read.schema(f"{key} {kind}, _size double, number long, chunk int").parquet(f"{folder}/rows").agg(F.max("chunk"), F.min("_size")).first()
    for k in range(0 if sizes[0] is None else sizes[0] + 1):
        if max(free) - reserve < sizes[1]:
            break

        def fold(batches, free=tuple(free)):
            room = Room(free)
            for b in batches:
                found = [room.take(s, reserve) for s in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int32()), pa.nulls(b.num_rows, pa.list_(pa.float64()))], names=[key, "at", "free"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, b.column(0).type), pa.nulls(1, pa.int32()), pa.array([room.free(len(free))], pa.list_(pa.float64()))], names=[key, "at", "free"])

        part = spark.read.schema(f"{key} {kind}, _size double, number long").parquet(f"{folder}/rows/chunk={k}").coalesce(1).sortWithinPartitions("number").select(key, "_size")
        part.mapInArrow(fold, f"{key} {kind}, at int, free array<double>").write.parquet(f"{folder}/done/chunk={k}")
        done = spark.read.schema(f"{key} {kind}, at int, free array<double>").parquet(f"{folder}/done/chunk={k}")
        free = list(done.where("free is not null").first()["free"])
    table = spark.createDataFrame(list(enumerate(names)), "at int, target string")
    placed = spark.createDataFrame([], f"{key} {kind}, at int")
    if sizes[0] is not None and names:
        placed = spark.read.schema(f"{key} {kind}, at int").parquet(f"{folder}/done") if path_exists(spark, f"{folder}/done") else placed
    return items.select(key).join(placed.where("at is not null").join(table, "at").select(key, "target"), key, "left")


def replace_json_values(rows: DataFrame, column: str, renames: dict[str, str]) -> DataFrame:
    """Every string value (not key) of a JSON document that equals a name is renamed; invalid documents stay as they are."""
    import json

    def walk(x):
        if isinstance(x, dict):
            return {k: walk(v) for k, v in x.items()}
        if isinstance(x, list):
            return [walk(v) for v in x]
        return renames.get(x, x) if isinstance(x, str) else x

    def one(text):
        try:
            return json.dumps(walk(json.loads(text)), ensure_ascii=False)
        except (TypeError, ValueError):
            return text

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    return rows.withColumn(column, run(column))


def replace_quoted(rows: DataFrame, column: str, renames: dict[str, str]) -> DataFrame:
    """Quoted names in one pass, so that swapped names aren't translated twice."""
    import re

    pattern = re.compile('"(' + "|".join(map(re.escape, sorted(renames, key=lambda k: (-len(k), k)))) + ')"') if renames else None

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None or pattern is None else pattern.sub(lambda m: f'"{renames[m.group(1)]}"', x))

    return rows.withColumn(column, run(column))
