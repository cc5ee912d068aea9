"""Operator 2: near-duplicate embeddings by an epsilon grid order join.

Cosine >= 0.9 of unit vectors is a distance of at most eps = sqrt(0.2). Vectors are centred and rotated to principal dimensions
(fitted on at most FIT_ROWS vectors; any centre and rotation give the same links). The leading ORDER_DIMS are cut into grid cells
of width eps, and these into halves, quarters and so on; cells are ordered recursively over all these dimensions at once (their
bits interleaved), so that an interval of the order is narrow in several dimensions and not in the first one alone. Spark range-sorts
the distinct vectors by cells, and each range is cut into blocks of BLOCK vectors. The self-join of the sequence is done by recursion on
intervals: pairs of intervals are split into pairs of their parts, and a pair is dropped when no two of its vectors can be within eps.
The bound adds up the gaps of the two boxes in BOUND_DIMS dimensions and the gap between the norms of what is left of the
vectors beyond them. Down to blocks, each level is an equi-join of interval pairs with the table of parts; inside a pair of blocks the recursion
goes on to leaves of LEAF vectors and to single vectors against leaves. What is left is compared by matrix products in double precision.

How much this prunes depends on the data: clustered vectors leave few pairs (`compared` tells), vectors without structure in
their leading dimensions leave nearly all, and no order of cells can change that at this eps.

A block pair returns at most one count and one edge to a spanning forest for each of its vectors, not its links, so a dense
group of m vectors costs O(m) rows a block pair. Equal vectors are collapsed first and counted.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths don't link; repeated rows count as copies; rows without vec_id are returned unlinked; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, scratch, settings, table, tidy
from sessionloom.llm.components import components

COSINE = 0.9
FIT_ROWS = 10_000
ORDER_DIMS = 8
ORDER_BITS = 7  # for each of these dimensions: 56 bits
BOUND_DIMS = 32
BLOCK = 4096
LEAF = 32
FANOUT_BITS = 3
CHUNK_BITS = 20  # a block's number is its range's number and, in this many bits, its place in the range


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(blobs: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1)


def _vectors(rows: DataFrame, kind: str) -> DataFrame:
    """vec_id, dim (0 where a vector links with nothing), vector (its components as bytes)."""

    def run(batches):
        for b in batches:
            dim, blob = [], []
            for v in b.column(1):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False)
                    x = x if np.isfinite(x).all() and x.any() else None
                dim.append(0 if x is None else x.size)
                blob.append(None if x is None else (x + 0).astype(kind).tobytes())  # -0 becomes 0
            yield pa.RecordBatch.from_pydict({"vec_id": b.column(0), "dim": pa.array(dim, pa.int32()), "vector": pa.array(blob, pa.binary())})

    return rows.mapInArrow(tidy(run), "vec_id long, dim int, vector binary")


class Frame:
    """Centre, principal axes and eps of a set of vectors."""

    def __init__(self, sample: np.ndarray, eps: float):
        self.eps, self.centre = eps, sample.mean(axis=0)
        x = sample - self.centre
        values, axes = np.linalg.eigh(x.T @ x)
        self.axes = axes[:, np.argsort(values)[::-1][:BOUND_DIMS]]
        # an eps cell is cut into as many halves as ORDER_BITS allow; coordinates lie in -2..2
        cells = math.ceil(4 / eps)
        self.width = eps / 2 ** max(0, ORDER_BITS - math.ceil(math.log2(cells))) if cells <= 1 << ORDER_BITS else 4 / (1 << ORDER_BITS)

    def places(self, unit: np.ndarray) -> np.ndarray:
        """Coordinates on the axes, and last the norm of the rest: distances of places are at most those of the vectors."""
        x = unit - self.centre
        p = x @ self.axes
        rest = np.sqrt(np.maximum(0, (x * x).sum(1) - (p * p).sum(1)))
        return np.concatenate([p, rest[:, None]], axis=1)

    def keys(self, places: np.ndarray) -> np.ndarray:
        """The place in the recursive order of cells."""
        g = min(ORDER_DIMS, self.axes.shape[1])
        cell = np.clip(np.floor((places[:, :g] + 2) / self.width), 0, (1 << ORDER_BITS) - 1).astype(np.int64)
        out = np.zeros(len(places), np.int64)
        for bit in range(ORDER_BITS - 1, -1, -1):
            for k in range(g):
                out = out << 1 | cell[:, k] >> bit & 1
        return out


def _frame(reps: DataFrame, kind: str, eps: float) -> Frame:
    sample = reps.select("vector", F.xxhash64("rep").alias("h")).orderBy("h").limit(FIT_ROWS).toArrow()
    return Frame(_unit(_matrix(sample.column("vector").to_pylist(), kind)), eps)


def _blocks(reps: DataFrame, kind: str, frame: Frame, ranges: int) -> DataFrame:
    """block, reps, counts, vectors (bytes) and the box lo_k, hi_k of each block of the grid order."""
    g = frame.axes.shape[1] + 1

    def cells(batches):
        for b in batches:
            key = frame.keys(frame.places(_unit(_matrix(b.column(2).to_pylist(), kind)))) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key)], names=["rep", "copies", "vector", "cell"])

    def number(batches):
        done = 0
        for b in batches:
            at = done + np.arange(b.num_rows)
            done += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(b.column(3).to_numpy().astype(np.int64) << CHUNK_BITS | at // BLOCK)], names=["rep", "copies", "vector", "block"])

    def pack(t: pa.Table) -> pa.Table:
        p = frame.places(_unit(_matrix(t.column("vector").to_pylist(), kind)))
        order = np.argsort(frame.keys(p), kind="stable")
        t, p = t.take(pa.array(order)), p[order]
        out = {"block": t.column("block")[:1], "reps": pa.array([t.column("rep").to_numpy().tobytes()]), "counts": pa.array([t.column("copies").to_numpy().tobytes()]), "vectors": pa.array([b"".join(t.column("vector").to_pylist())])}
        return pa.table(out | {f"lo{k}": pa.array([p[:, k].min()]) for k in range(g)} | {f"hi{k}": pa.array([p[:, k].max()]) for k in range(g)})

    placed = reps.select("rep", "copies", "vector").mapInArrow(tidy(cells), "rep long, copies long, vector binary, cell long")
    ordered = placed.repartitionByRange(ranges, "cell", "rep").sortWithinPartitions("cell", "rep").select("rep", "copies", "vector", F.spark_partition_id().alias("task"))
    boxes = ", ".join(f"{side}{k} double" for side in ("lo", "hi") for k in range(g))
    numbered = ordered.mapInArrow(tidy(number), "rep long, copies long, vector binary, block long")
    return numbered.groupBy("block").applyInArrow(pack, f"block long, reps binary, counts binary, vectors binary, {boxes}")


def _block_pairs(blocks: DataFrame, g: int, eps: float) -> DataFrame:
    """i <= j of the block pairs that the recursion can't exclude."""
    spark = blocks.sparkSession
    sides = [f"{side}{k}" for side in ("lo", "hi") for k in range(g)]
    boxes = cut(blocks.select("block", *sides), "ego-boxes")
    ranges = (boxes.agg(F.max(F.shiftright("block", CHUNK_BITS))).first()[0] or 0) + 1
    shifts = [0, *range(CHUNK_BITS, CHUNK_BITS + max(1, ranges - 1).bit_length() + FANOUT_BITS, FANOUT_BITS)]
    pairs = spark.createDataFrame([(0, 0)], "i long, j long")
    gap = " + ".join(f"pow(greatest(0D, a_lo{k} - b_hi{k}, b_lo{k} - a_hi{k}), 2)" for k in range(g))
    for shift, up in zip(shifts[-2::-1], shifts[:0:-1], strict=True):
        parts = boxes.groupBy(F.shiftright("block", shift).alias("node")).agg(*[(F.min if s[:2] == "lo" else F.max)(s).alias(s) for s in sides])
        parts = parts.withColumn("up", F.shiftright("node", up - shift))
        side = lambda x, p: p.select(F.col("node").alias(f"{x}_node"), F.col("up").alias(f"{x}_up"), *[F.col(s).alias(f"{x}_{s}") for s in sides])  # noqa: B023, E731
        met = pairs.join(side("a", parts), F.col("i") == F.col("a_up")).join(side("b", parts), F.col("j") == F.col("b_up"))
        pairs = cut(met.where("a_node <= b_node").where(f"{gap} <= {eps * eps + 1e-9!r}").select(F.col("a_node").alias("i"), F.col("b_node").alias("j")), "ego-pairs")
    return pairs


def _merged(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, component) of the nodes of edges (u, v) that aren't their component's smallest node."""
    node, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = place[: u.size], place[u.size :]
    label = np.arange(node.size)
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(node.size))
    return node[far], node[label[far]]


def _gap(lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> np.ndarray:
    """The square of the least distance between boxes; a point is a box."""
    d = np.maximum(0, np.maximum(lo - hi2, lo2 - hi))
    return (d * d).sum(-1)


def _pair_links(ids, counts, x, y, same: bool, frame: Frame, cosine: float) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, int]:
    """Of two blocks: links of each vector, edges (u, v) that join the linked ones, and how many pairs were compared."""
    most = frame.eps**2 + 1e-9
    p, q = frame.places(x), frame.places(y)
    n = [np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)]
    edges, compared = [(np.empty(0, np.int64),) * 2], 0
    at = np.arange(0, len(y), LEAF)
    lo, hi = np.minimum.reduceat(q, at), np.maximum.reduceat(q, at)
    for begin in range(0, len(x), LEAF):
        i = np.arange(begin, min(begin + LEAF, len(x)))
        a_lo, a_hi = p[i].min(0), p[i].max(0)
        leaves = np.flatnonzero((_gap(a_lo, a_hi, lo, hi) <= most) & (~same | (at >= begin)))
        if not leaves.size:
            continue
        j = (at[leaves][:, None] + np.arange(LEAF)).ravel()
        j = j[j < len(y)]
        j = j[_gap(a_lo, a_hi, q[j], q[j]) <= most]
        if not j.size:
            continue
        i = i[_gap(p[i], p[i], q[j].min(0), q[j].max(0)) <= most]
        compared += i.size * j.size
        dots = x[i] @ y[j].T
        ok = dots >= cosine + 1e-9
        for r, c in np.argwhere((dots >= cosine - 1e-9) & ~ok).tolist():
            ok[r, c] = math.fsum(x[i[r]] * y[j[c]]) >= cosine
        if same:
            ok &= j[None, :] > i[:, None]
        if not ok.any():
            continue
        n[0][i] += ok @ counts[1][j]
        n[1][j] += ok.T @ counts[0][i]
        # a vector of y and the first of x it links with; vectors of x that link with one of y
        hit = np.flatnonzero(ok.any(0))
        edges.append((ids[1][j[hit]], ids[0][i[ok[:, hit].argmax(0)]]))
        near = ok.astype(np.float32)
        r, c = np.nonzero(np.triu(near @ near.T, 1))
        edges.append((ids[0][i[r]], ids[0][i[c]]))
    u, v = (np.concatenate(z) for z in zip(*edges, strict=True))
    return n, *_merged(u, v), compared


def _links(blocks: DataFrame, pairs: DataFrame, kind: str, frame: Frame, cosine: float) -> DataFrame:
    """(a, null, n): a links with n vectors of a block; (a, b, null): a and b lie in one component; (null, null, n): n pairs were compared."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = [np.frombuffer(r[f"{s}_reps"], np.int64) for s in "ab"]
                count = [np.frombuffer(r[f"{s}_counts"], np.int64) for s in "ab"]
                x, y = (_unit(np.frombuffer(r[f"{s}_vectors"], kind).reshape(len(k), -1)) for s, k in zip("ab", ids, strict=True))
                n, u, v, compared = _pair_links(ids, count, x, y, r["i"] == r["j"], frame, cosine)
                a, n = np.concatenate(ids), np.concatenate(n)
                a, n = a[n > 0], n[n > 0]
                cols = [[pa.array(a), pa.array(u), pa.nulls(1, pa.int64())], [pa.nulls(a.size, pa.int64()), pa.array(v), pa.nulls(1, pa.int64())], [pa.array(n), pa.nulls(u.size, pa.int64()), pa.array([compared], pa.int64())]]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in cols], names=["a", "b", "n"])

    side = lambda x: blocks.select(F.col("block").alias(f"{x}_block"), *[F.col(c).alias(f"{x}_{c}") for c in ("reps", "counts", "vectors")])
    met = pairs.join(side("a"), F.col("i") == F.col("a_block")).join(side("b"), F.col("j") == F.col("b_block")).drop("a_block", "b_block")
    with settings(blocks.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):  # a row is two blocks
        return cut(met.mapInArrow(tidy(run), "a long, b long, n long"), "ego-links")


def _joined(rows: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """vectors (vec_id, dim, key), classes of equal ones (dim, key, rep, copies), and the rows of _links."""
    spark = rows.sparkSession
    kind = "<f4" if dict(rows.dtypes)["embedding"] == "array<float>" else "<f8"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"))
    vectors = cut(_vectors(rows, kind).withColumn("key", F.unhex(F.sha2("vector", 256))), "ego-vectors")
    usable = vectors.where("dim > 0 and vec_id is not null")
    classes = cut(usable.groupBy("dim", "key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "ego-classes")
    eps = math.sqrt(2 - 2 * cosine)
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = spark.createDataFrame([], "a long, b long, n long")
    for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():  # lengths that occur, one as a rule
        reps = classes.where(F.col("dim") == r["dim"])
        frame = _frame(reps, kind, eps)
        ranges = max(1, min(math.ceil(r["n"] / BLOCK), max(shuffles, math.ceil(r["n"] / (16 * BLOCK)))))
        blocks = cut(_blocks(reps, kind, frame, ranges), "ego-blocks")
        links = links.union(_links(blocks, _block_pairs(blocks, frame.axes.shape[1] + 1, eps), kind, frame, cosine))
    return vectors, classes, links


def compared(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row: pairs of unlike vectors that were compared, and all there are."""
    with scratch(rows.sparkSession) as keep:
        _, classes, links = _joined(rows, cosine)
        done = links.where("a is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("compared"))
        return keep(done.crossJoin(classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) / 2")), F.lit(0.0)).cast("long").alias("pairs"))), "ego-compared")


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    with scratch(rows.sparkSession) as keep:
        vectors, classes, links = _joined(rows, cosine)
        counts = links.where("a is not null and n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
        parts = components(links.where("b is not null").select("a", "b")).select(F.col("node").alias("rep"), "component")
        known = classes.join(counts, "rep", "left").join(parts, "rep", "left")
        known = known.select("dim", "key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
        out = vectors.select("vec_id", "dim", "key").join(known, ["dim", "key"], "left")
        component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
        n = F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long")
        return keep(out.select("vec_id", n.alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")), "ego-rows")


def op2_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
