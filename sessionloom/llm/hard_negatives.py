"""Operator 12: hard negatives by one-dimensional distance keys.

Components x become floor(256 * x), so scores are integer inner products. A vector v is augmented by sqrt(M^2 - |v|^2), M the largest
norm of the table, and an anchor q by 0; then |q' - v'|^2 = |q|^2 + M^2 - 2 score, and the highest scores are the nearest neighbours.
Each augmented vector gets the nearest of PIVOTS pivots and its distance to it; the table is range-sorted by (pivot, distance) and written, and each range
is a group. By the triangle inequality the rows at distance d from a pivot lie in an annulus about an anchor, so a group's key
intervals bound its scores for that anchor from both sides.

A search asks for the first rows of each anchor in windows of scores. It goes by rounds: an anchor visits the group with the best bound, then the next
GROWTH - 1 groups, then GROWTH times as many and so on, each time without those whose bound can't beat the last of its rows so far, or whose
scores lie outside all of its windows. Inside a group the same goes on over leaves of LEAF keys. What is left unvisited at the end is excluded by its
bound, so results are exact. Vectors are dealt to their group, anchors to the groups they visit; a task holds one group's vectors
and a batch of anchors. The first search finds positives (same label), the second negatives in the windows that the positives' scores open.

Of rows equal in label and vector only the first COPIES by vec_id are stored, as no list can hold more of them; so a group of copies of any size is
as many rows.

Defined results: rows with null vec_id, label or vector, an empty vector, or a component that is null, non-finite or beyond 1e150 take no
part; vectors of other lengths than the anchor's aren't compared; of rows with one vec_id the least (label, vector) counts; scores beyond 64 bits count as the
64-bit number nearest to them; anchors without positives, and positives without negatives, give no row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.common import cut, scratch, table, tidy

FIRST = 5
COPIES = FIRST + 1  # an anchor may be one of its own copies
ANCHOR_EVERY = 100
PIVOTS = 32
FIT_ROWS = 4_000
GROUP = 65_536
LEAST_GROUP = 2_048
GROWTH = 8
LEAF = 256
LOWEST, HIGHEST = -(1 << 63) + 1, (1 << 63) - 1


def _rows(rows: DataFrame) -> DataFrame:
    """vec_id, label, dim, vec (whole numbers as 4-byte floats where they fit, else 8), norm, of rows that take part."""

    def run(batches):
        for b in batches:
            keep, dim, vec, norm = [], [], [], []
            for i, v in enumerate(b.column(2)):
                if not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(256 * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                most = np.abs(x).max()
                if not most <= 1e150:  # nan too
                    continue
                keep.append(i)
                dim.append(x.size)
                norm.append(float(most * math.sqrt(((x / most) ** 2).sum())) if most else 0.0)
                vec.append((x + 0).astype("<f4" if most <= 1 << 24 else "<f8").tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(dim, pa.int32()), pa.array(vec, pa.binary()), pa.array(norm, pa.float64())], names=["vec_id", "label", "dim", "vec", "norm"])

    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    own = rows.select(vec_id.alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and label is not null and embedding is not null")
    read = own.mapInArrow(tidy(run), "vec_id long, label long, dim int, vec binary, norm double")
    return read.groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vec", "norm")).alias("r")).select("vec_id", "r.*")


def matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    if all(len(x) == 4 * dim for x in blobs):
        return np.frombuffer(b"".join(blobs), "<f4").reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(x, "<f4" if len(x) == 4 * dim else "<f8").astype(np.float64) for x in blobs]) if blobs else np.empty((0, dim))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a and b."""
    if not a.size or not b.size or a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in r] for r in x.tolist()], object)
    return np.clip(whole(a) @ whole(b).T, LOWEST, HIGHEST).astype(np.int64)


class Keys:
    """Pivots, and the scale in which distances are taken (so that no square overflows)."""

    def __init__(self, sample: np.ndarray, most: float):
        self.scale = most or 1.0
        x = self.augmented(sample)
        pick = np.random.default_rng(7).permutation(len(x))[:PIVOTS]
        self.pivots = x[pick]
        for _ in range(8):
            near = self.distances(x).argmin(1)
            for k in np.unique(near).tolist():
                self.pivots[k] = x[near == k].mean(0)

    def augmented(self, v: np.ndarray, anchor: bool = False) -> np.ndarray:
        x = v / self.scale
        last = np.zeros(len(x)) if anchor else np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
        return np.concatenate([x, last[:, None]], 1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        d = (x * x).sum(1)[:, None] + (self.pivots * self.pivots).sum(1)[None, :] - 2 * x @ self.pivots.T
        return np.sqrt(np.maximum(0, d))

    def bounds(self, anchors: np.ndarray, pivot: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor with rows whose keys lie in the intervals (pivot, low..high)."""
        x = self.augmented(anchors, anchor=True)
        d = self.distances(x)[:, pivot]
        near, far = np.maximum(0, np.maximum(d - high, low - d)), d + high
        both = (x * x).sum(1)[:, None] + 1
        slack = 1e-6 * (both + 1)  # more than rounding can do
        return ((both - far * far) / 2 - slack) * self.scale**2 - 1, ((both - near * near) / 2 + slack) * self.scale**2 + 1


def _index(rows: DataFrame, dim: int, n: int) -> tuple[DataFrame, Keys, np.ndarray]:
    """The stored vectors (grp, pivot, dist, vec_id, label, vec), the keys, and the intervals (grp, pivot, low, high) of the groups."""
    spark = rows.sparkSession
    most = rows.agg(F.max("norm")).first()[0]
    sample = rows.select("vec", F.xxhash64("vec_id", F.lit("pivots")).alias("h")).orderBy("h").limit(FIT_ROWS).toArrow()
    keys = Keys(matrix(sample.column("vec").to_pylist(), dim), most)

    def place(batches):
        for b in batches:
            d = keys.distances(keys.augmented(matrix(b.column(2).to_pylist(), dim)))
            at = d.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(at)), at]), *b.columns], names=["pivot", "dist", "vec_id", "label", "vec"])

    first = F.row_number().over(Window.partitionBy("label", "vec").orderBy("vec_id"))
    stored = rows.withColumn("_k", first).where(F.col("_k") <= COPIES).select("vec_id", "label", "vec")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(math.ceil(n / LEAST_GROUP), max(shuffles, math.ceil(n / GROUP))))
    placed = stored.mapInArrow(tidy(place), "pivot int, dist double, vec_id long, label long, vec binary")
    order = ["pivot", "dist", "vec_id"]
    index = cut(placed.repartitionByRange(groups, *order).sortWithinPartitions(*order).withColumn("grp", F.spark_partition_id()), "negatives-index")
    spans = index.groupBy("grp", "pivot").agg(F.min("dist").alias("low"), F.max("dist").alias("high")).orderBy("grp", "pivot").toArrow()  # a row or two for each group
    return index, keys, np.rec.fromarrays([spans.column(c).to_numpy() for c in ("grp", "pivot", "low", "high")], names="grp,pivot,low,high")


def _best_of(bound: np.ndarray, grp: np.ndarray, pick) -> np.ndarray:
    """Bounds of intervals (in the order of their groups) merged by group."""
    return pick.reduceat(bound, np.flatnonzero(np.append(True, grp[1:] != grp[:-1])), axis=1)


def _long_array(values: np.ndarray) -> pa.Array:
    """A list of numbers for each row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1] or 1)[: len(values) + 1].astype(np.int32)), pa.array(values.ravel()))


_ASKED = ["lo", "hi", "ts", "ti"]


def _windows(b: pa.RecordBatch) -> list[np.ndarray]:
    return [b.column(b.schema.get_field_index(c)).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for c in _ASKED]


def _visits(requests: DataFrame, dim: int, keys: Keys, spans: np.ndarray, begin: int, end: int) -> DataFrame:
    """requests with grp: each to the groups that come begin-th to end-th by their bounds, without those that can't add to any window."""
    shipped = requests.sparkSession.sparkContext.broadcast((keys, spans))

    def run(batches):
        own, s = shipped.value
        groups = np.unique(s.grp)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                b = batch.slice(at, 1_000)
                low, high = own.bounds(matrix(b.column(2).to_pylist(), dim), s.pivot, s.low, s.high)
                low, high = _best_of(low, s.grp, np.minimum), _best_of(high, s.grp, np.maximum)
                turn = np.argsort(-high, 1, kind="stable")[:, begin:end]
                lo, hi, ts, _ = _windows(b)
                low, high = np.take_along_axis(low, turn, 1), np.take_along_axis(high, turn, 1)
                r, c = np.nonzero(((high[:, :, None] >= np.maximum(lo, ts)[:, None, :]) & (low[:, :, None] <= hi[:, None, :]) & (lo <= hi)[:, None, :]).any(2))
                yield pa.RecordBatch.from_arrays([pa.array(groups[turn[r, c]].astype(np.int32)), *b.take(pa.array(r)).columns], names=["grp", *b.schema.names])

    lists = ", ".join(f"{c} array<bigint>" for c in _ASKED)
    return requests.select("vec_id", "label", "vec", *_ASKED).mapInArrow(tidy(run), f"grp int, vec_id long, label long, vec binary, {lists}")


class Group:
    """One group's vectors in key order, and the search in it."""

    def __init__(self, keys: Keys, batches: list[pa.RecordBatch], dim: int):
        col = lambda c: np.concatenate([b.column(b.schema.get_field_index(c)).to_numpy() for b in batches])
        self.keys, self.ids, self.labels, pivot, dist = keys, col("vec_id"), col("label"), col("pivot").astype(np.int64), col("dist")
        self.v = matrix([x for b in batches for x in b.column(b.schema.get_field_index("vec")).to_pylist()], dim)
        at = np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1]))
        at = np.unique(np.concatenate([np.arange(lo, hi, LEAF) for lo, hi in zip(at, [*at[1:], pivot.size], strict=True)]))
        self.at, self.pivot, self.low, self.high = np.append(at, pivot.size), pivot[at], dist[at], dist[np.append(at[1:], pivot.size) - 1]

    def search(self, ids, labels, q, lo, hi, ts, ti, same: bool, k: int):
        """(request, window, score, vec_id) of at most the first k rows a window that come before its last one so far, (ts, ti)."""
        ts, ti = ts.copy(), ti.copy()
        score, found = np.full((*lo.shape, k), LOWEST - 1, np.int64), np.full((*lo.shape, k), HIGHEST, np.int64)
        least, most = self.keys.bounds(q, self.pivot, self.low, self.high)
        for leaf in np.argsort(-most.max(0), kind="stable").tolist() if len(q) else []:
            open_ = (most[:, leaf, None] >= np.maximum(lo, ts)) & (least[:, leaf, None] <= hi) & (lo <= hi)
            at = np.flatnonzero(open_.any(1))
            if not at.size:
                continue
            rows = slice(self.at[leaf], self.at[leaf + 1])
            s, other = inner(q[at], self.v[rows]), self.ids[rows]
            usable = ((self.labels[rows] == labels[at, None]) == same) & (other != ids[at, None])
            for w in range(lo.shape[1]):
                t = ts[at, w, None]
                ok = usable & (s >= lo[at, w, None]) & (s <= hi[at, w, None]) & ((s > t) | ((s == t) & (other < ti[at, w, None])))
                r, c = np.nonzero(ok)
                if r.size:
                    self._merge(score[:, w], found[:, w], ts[:, w], ti[:, w], at[r], s[r, c], other[c], k)
        r, w, j = np.nonzero(found < HIGHEST)
        return r, w, score[r, w, j], found[r, w, j]

    @staticmethod
    def _merge(score, found, ts, ti, r, s, i, k: int) -> None:
        hit = np.unique(r)
        old_r, old_s, old_i = np.repeat(hit, k), score[hit].ravel(), found[hit].ravel()
        real = old_i < HIGHEST
        r, s, i = np.concatenate([r, old_r[real]]), np.concatenate([s, old_s[real]]), np.concatenate([i, old_i[real]])
        order = np.lexsort((i, -s, r))
        r, s, i = r[order], s[order], i[order]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        rank = np.arange(r.size) - np.repeat(first, np.diff(np.append(first, r.size)))
        keep = rank < k
        score[r[keep], rank[keep]], found[r[keep], rank[keep]] = s[keep], i[keep]
        full = hit[found[hit, k - 1] < HIGHEST]
        better = (score[full, k - 1] > ts[full]) | ((score[full, k - 1] == ts[full]) & (found[full, k - 1] < ti[full]))
        full = full[better]
        ts[full], ti[full] = score[full, k - 1], found[full, k - 1]


def _met(index: DataFrame, visits: DataFrame, keys: Keys, dim: int, groups: int, same: bool, k: int) -> DataFrame:
    """anchor_id, w, score, vec_id that the visited groups add."""
    lists = [F.lit(None).cast("array<bigint>").alias(c) for c in _ASKED]
    both = index.select("grp", F.lit(0).alias("tag"), "pivot", "dist", "vec_id", "label", "vec", *lists).unionByName(visits.select("grp", F.lit(1).alias("tag"), F.lit(None).cast("int").alias("pivot"), F.lit(None).cast("double").alias("dist"), "vec_id", "label", "vec", *_ASKED))
    dealt = both.repartition(groups, "grp").sortWithinPartitions("grp", "tag", "pivot", "dist", "vec_id")
    shipped = index.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        now, held, group = None, [], None
        for batch in batches:
            g, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (tag[1:] != tag[:-1])) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                b = batch.slice(lo, hi - lo)
                if g[lo] != now:
                    now, held, group = g[lo], [], None
                if tag[lo] == 0:
                    held.append(b)
                    continue
                group = group or Group(shipped.value, held, dim)
                for at in range(0, b.num_rows, 1_000):
                    part = b.slice(at, 1_000)
                    ids, labels = part.column(4).to_numpy(), part.column(5).to_numpy()
                    r, w, s, i = group.search(ids, labels, matrix(part.column(6).to_pylist(), dim), *_windows(part), same, k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(w.astype(np.int32)), pa.array(s), pa.array(i)], names=["anchor_id", "w", "score", "vec_id"])

    return dealt.mapInArrow(tidy(run), "anchor_id long, w int, score long, vec_id long")


def search(index: DataFrame, keys: Keys, spans: np.ndarray, dim: int, asked: DataFrame, windows: int, same: bool, k: int = FIRST) -> DataFrame:
    """anchor_id, w, score, vec_id, rank: the first k rows by (score descending, vec_id) of each window of each anchor.

    asked: vec_id, label, vec, lo, hi (arrays of `windows` bounds; lo above hi: an empty window). same: rows of the anchor's label, or of others.
    """
    spark = index.sparkSession
    found = spark.createDataFrame([], "anchor_id long, w int, score long, vec_id long, rank int")
    groups = np.unique(spans.grp).size
    begin, end = 0, 1
    rank = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id"))
    while begin < groups:
        last = found.where(F.col("rank") == k).groupBy(F.col("anchor_id").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct(F.col("score").alias("s"), F.col("vec_id").alias("i"))))).alias("last"))
        of = lambda part, none: F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda w: F.coalesce(F.try_element_at("last", w)[part], F.lit(none)))
        requests = asked.join(last, "vec_id", "left").select("vec_id", "label", "vec", "lo", "hi", of("s", LOWEST).alias("ts"), of("i", HIGHEST).alias("ti"))
        new = _met(index, _visits(requests, dim, keys, spans, begin, end), keys, dim, groups, same, k)
        found = cut(found.drop("rank").unionByName(new).withColumn("rank", rank).where(F.col("rank") <= k), "negatives-found")
        begin, end = end, end * GROWTH
    return found


def mine(rows: DataFrame, every: int = ANCHOR_EVERY, first: int = FIRST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for anchors with vec_id divisible by `every`.

    Rows (vec_id, label, embedding). A positive of score p opens the window ceil(0.8 p) to p for its negatives.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    with scratch(spark) as keep:
        own = cut(_rows(rows), "negatives-rows")
        out = spark.createDataFrame([], schema)
        for r in own.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():  # lengths that occur, one as a rule
            dim = r["dim"]
            of = own.where(F.col("dim") == dim)
            index, keys, spans = _index(of, dim, r["n"])
            anchors = of.where(F.col("vec_id") % every == 0).select("vec_id", "label", "vec")
            all_ = lambda v: F.array(F.lit(v).cast("long"))
            positives = search(index, keys, spans, dim, anchors.withColumn("lo", all_(LOWEST)).withColumn("hi", all_(HIGHEST)), 1, True, first)
            # ceil(4 p / 5) in whole numbers
            opened = positives.withColumn("low", F.expr("score - score div 5 - case when score % 5 < 0 then -1 else 0 end"))
            at = F.map_from_entries(F.collect_list(F.struct("rank", F.struct("low", F.col("score").alias("high")))))
            asked = anchors.join(opened.groupBy(F.col("anchor_id").alias("vec_id")).agg(at.alias("at")), "vec_id")
            bound = lambda part, none: F.transform(F.sequence(F.lit(1), F.lit(first)), lambda w: F.coalesce(F.try_element_at("at", w)[part], F.lit(none).cast("long")))  # noqa: B023, E731
            negatives = search(index, keys, spans, dim, asked.select("vec_id", "label", "vec", bound("low", 1).alias("lo"), bound("high", 0).alias("hi")), first, False, first)
            pairs = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), (F.col("rank") - 1).alias("w"), F.col("score").alias("positive_score"))
            met = pairs.join(negatives.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score"), ["anchor_id", "w"])
            out = out.unionByName(met.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        return keep(out, "negatives")


OP12_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
