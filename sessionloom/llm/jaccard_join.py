"""Operator 3: exact n-gram Jaccard join with signature trees, and the groups of near duplicates it links.

A document is the set of its distinct five-word shingles (64-bit hashes). Two documents link when the intersection is at
least 75 % of the union. Pairs are found exactly, never all of a group:

1. Equal sets form a class; its smallest doc_id stands for it. The same pass gives each set its size and a bitmap of 2,048
   bits or more, and adds up a count sketch of all shingles (2^20 counters, fixed size), which gives one global order of
   shingles, rare ones first.
2. Linked sets share a shingle among the first n - ceil(0.75 n) + 1 of that order. These prefixes are dealt by shingle
   range, packed as arrays; a shingle that a task holds several times among DEALT_TOKENS goes out once, with the other
   holders as pairs, so a shingle in very many documents sends few entries for each task. Each shingle in two or more
   documents gives incidences (shingle, holder, hub), the hub being the smallest holder.
3. Pairs of holder and hub that sizes and bitmaps don't exclude are verified on whole sets, and linked documents are
   contracted.
4. Shingles with three or more holders that still lie in different components go to signature trees: holders are grouped by shingle
   (of shingles with the same holders the first in order is taken); nodes hold the OR of the bitmaps, size ranges and the
   largest reach; two trees are traversed together, and node pairs are pruned by the largest possible overlap
   against the overlap their sizes need, or when both nodes lie in one component. A holder's reach is how many of its shingles
   come from the shared one on in the global order: two sets whose first common shingle it is can't share more. Holders of a
   shingle in more than BLOCK documents are range-sorted by size and bitmap and cut into blocks; one summary row for
   each block (the root of its tree) meets the other summaries of its shingle and size band, and holders are sent only to
   the pairs of blocks left. Of likely links among the pairs left a
   spanning forest is verified on whole sets, and every pair whose ends it doesn't join. If a link
   that was counted on fails, this step is repeated from the components found, at last for all pairs left; so no link is
   lost, and a group of m near copies costs about m pairs, not m squared.

Broadcasts: the sketch, and id filters of 8 MB, all of fixed size. Texts are read twice or three times and never shuffled; sets are
shuffled for candidates only.

Defined results: null text, empty text and text without words have no shingles and link with nothing (each its own
component); repeated rows and ties fall into one class under the smallest doc_id; rows that share a doc_id and not the text
are one document with several sets, which links where any of them does; rows without doc_id are left out of the
links and returned with a null component; an empty table gives no rows; further columns are ignored. Texts of any length are
read in parts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, free_name, own_columns, scratch, settings, table, text_slices, tidy
from sessionloom.llm.components import components
from sessionloom.llm.shingles import FILTER_BITS, U, key_filter, mix, shingle_sets

PERCENT = 75
SKETCH_BITS = 20
SLICES = 16
BUCKET_SHINGLES = 300_000
BLOCK = 1024
SIGNATURE = 32  # 64-bit words
WIDEST = 1024  # bytes of a bitmap in a tree
GROUP_ROWS = 4000
PART_ROWS = 16_000
#: Estimated overlap over needed overlap from which a pair counts as a likely link, by round; the last round leaves nothing out.
LIKELY = (1.0, 1.1, math.inf)
FANOUT = 8
ONE_NODE = 32  # holders that make up a single node, whose pairs are tested at once
SLICE_CHARS = 400_000
DEALT_TOKENS = 65_000  # held by a task before they are sorted and sent
PAIRS_AT_ONCE = 1 << 22  # bytes of bitmaps


def _needed(size_sum, percent: int):
    """The least overlap of two sets with these sizes together that link: 100 i >= p (s - i)."""
    return -((-percent * size_sum) // (100 + percent))


def _signatures(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """Bitmaps of the sets h[at[k]:at[k + 1]]: SIGNATURE words, doubled until there are two bits for each shingle."""
    n, base = np.diff(at), 64 * SIGNATURE
    width = base << np.maximum(0, np.ceil(np.log2(np.maximum(2 * n, 1) / base))).astype(np.int64)
    start = np.append(0, np.cumsum(width))
    owner = np.repeat(np.arange(n.size), n)
    flags = np.zeros(start[-1], np.uint8)
    flags[start[owner] + (h & (width[owner] - 1).astype(U)).astype(np.int64)] = 1
    packed, cuts = np.packbits(flags).tobytes(), (start // 8).tolist()
    return pa.array([packed[x:y] for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary())


PROFILE = ["doc_id", "n", "s1", "s2", "slice", "signature"]


def _profiles(docs: DataFrame) -> DataFrame:
    """doc rows (doc_id, n, s1, s2: a 128-bit digest of the set, signature) and sketch rows (slice, signature: a blob of counters)."""
    width = (1 << SKETCH_BITS) // SLICES

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in text_slices(texts, SLICE_CHARS):
                h, at = shingle_sets(texts[lo:hi])
                sketch += np.bincount(h >> U(64 - SKETCH_BITS), minlength=sketch.size)
                a, x = np.append(U(0), np.cumsum(mix(h ^ U(0x5851F42D4C957F2D)))), np.append(U(0), np.cumsum(mix(h + U(0x14057B7EF767814F))))
                n = hi - lo
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(np.diff(at)), pa.array(np.diff(a[at]).view(np.int64)), pa.array(np.diff(x[at]).view(np.int64)), pa.nulls(n, pa.int32()), _signatures(h, at)], names=PROFILE)
        if sketch.any():
            none = pa.nulls(SLICES, pa.int64())
            blobs = [sketch[k * width : (k + 1) * width].astype(np.int32).tobytes() for k in range(SLICES)]
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names=PROFILE)

    return docs.mapInArrow(tidy(run), "doc_id long, n long, s1 long, s2 long, slice int, signature binary")


def _sketch(profiles: DataFrame) -> np.ndarray:
    width = (1 << SKETCH_BITS) // SLICES

    def add(batches):
        """Sums of the counters met in a task, so a slice sends one row for each task."""
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[s] = total.get(s, 0) + np.frombuffer(blob, np.int32 if len(blob) == 4 * width else np.int64)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(total, pa.int32()), "blob": pa.array([v.astype(np.int64).tobytes() for v in total.values()], pa.binary())})

    rows = profiles.where("slice is not null").select("slice", F.col("signature").alias("blob")).repartition(SLICES, "slice").mapInArrow(add, "slice int, blob binary").toArrow()  # SLICES rows
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for s, blob in zip(rows.column("slice").to_pylist(), rows.column("blob").to_pylist(), strict=True):
        out[s * width : (s + 1) * width] += np.frombuffer(blob, np.int64)
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def _chosen(filter_words, places: list[np.ndarray]) -> np.ndarray:
    ok = np.ones(places[0].size, bool)
    for p in places:
        ok &= (filter_words[p >> 6] >> (p & 63).astype(U)) & U(1) > 0
    return ok


def _filtered(docs: DataFrame, keys: DataFrame, column: str):
    """docs with the filter's two bit places of each id, and the broadcast filter."""
    words = docs.sparkSession.sparkContext.broadcast(key_filter(keys, column))
    places = [F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(k)), 64 - FILTER_BITS).alias(f"p{k}") for k in range(2)]
    return docs.select("doc_id", "text", *places), words


def _incidences(docs: DataFrame, reps: DataFrame, sketch: np.ndarray, buckets: int, percent: int) -> DataFrame:
    """token, rank, member, member_reach, hub, hub_reach of every prefix shingle that two or more of the representatives hold (the hub's own row left out).

    rank: the token's place in the global order, but for ties; reach: how many shingles of a set come from the token on in that order.
    """
    rows, passing = _filtered(docs, reps, "rep")
    order = docs.sparkSession.sparkContext.broadcast(sketch)
    shift = U(64 - int(math.log2(buckets)))
    packed = ("tokens", "holders", "reaches", "hubs", "hub_reaches")

    def sent(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        token, holder, reach = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.lexsort((holder, token))
        token, holder, reach = token[by], holder[by], reach[by]
        new = np.append(True, token[1:] != token[:-1])
        lead = np.maximum.accumulate(np.where(new, np.arange(token.size), 0))
        hub, hub_reach = holder[lead], reach[lead]
        out = [[], [], [], [], [], []]
        cuts = np.searchsorted(token[new], np.arange(buckets, dtype=U) << shift if buckets > 1 else np.zeros(1, U))
        for k, (x, y) in enumerate(zip(cuts, np.append(cuts[1:], new.sum()), strict=True)):
            if y > x:
                for col, v in zip(out, (k, token[new][x:y].tobytes(), holder[new][x:y].tobytes(), reach[new][x:y].tobytes(), None, None), strict=True):
                    col.append(v)
        # other holders met by the task; any bucket will do, so they are dealt by holder
        rest = np.flatnonzero(~new & (holder != hub))
        if rest.size:
            to = mix(holder[rest].view(U)) % U(buckets)
            rest = rest[np.argsort(to, kind="stable")]
            to = np.sort(to)
            edges = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), rest.size)
            for x, y in zip(edges, edges[1:], strict=False):
                r = rest[x:y]
                for col, v in zip(out, (int(to[x]), *(c[r].tobytes() for c in (token, holder, reach, hub, hub_reach))), strict=True):
                    col.append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], names=["bucket", *packed])

    def deal(batches):
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            ok = _chosen(passing.value, [b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)])
            ids, texts = ids[ok], [t for t, k in zip(texts, ok.tolist(), strict=True) if k]
            for lo, hi in text_slices(texts, SLICE_CHARS):
                h, at = shingle_sets(texts[lo:hi])
                if not h.size:
                    continue
                n = np.diff(at)
                owner = np.repeat(np.arange(hi - lo), n)
                by = np.lexsort((h, order.value[h >> U(64 - SKETCH_BITS)], owner))
                prefix = n + (percent * n) // -100 + 1  # n - ceil(percent n / 100) + 1
                place = np.arange(h.size) - at[owner]
                first = place < prefix[owner]
                held.append((h[by][first], ids[lo:hi][owner[first]], (n[owner] - place)[first].astype(np.int32)))
            if sum(x[0].size for x in held) > DEALT_TOKENS:
                yield sent(held)
                held = []
        if held:
            yield sent(held)

    def meet(t: pa.Table) -> pa.Table:
        parts = list(zip(*(t.column(c).to_pylist() for c in packed), strict=True))
        token, holder, reach = (np.frombuffer(b"".join(p[k] for p in parts if p[3] is None), kind) for k, kind in ((0, U), (1, np.int64), (2, np.int32)))
        by = np.lexsort((holder, token))
        token, holder, reach = token[by], holder[by], reach[by]
        new = np.append(True, token[1:] != token[:-1])[: token.size]
        lead = np.maximum.accumulate(np.where(new, np.arange(token.size), 0)) if token.size else np.empty(0, np.int64)
        other = holder != holder[lead]
        cols = [[v[other] for v in (token, holder, reach, holder[lead], reach[lead])]]
        cols += [[np.frombuffer(v, kind) for v, kind in zip(p, (U, np.int64, np.int32, np.int64, np.int32), strict=True)] for p in parts if p[3] is not None]
        token, *rest = (np.concatenate([c[k] for c in cols]) for k in range(5))
        rank = order.value[token >> U(64 - SKETCH_BITS)]
        return pa.table({name: pa.array(v) for name, v in zip(("token", "rank", "member", "member_reach", "hub", "hub_reach"), (token.view(np.int64), rank, *rest), strict=True)})

    dealt = rows.mapInArrow(tidy(deal), "bucket int, " + ", ".join(f"{c} binary" for c in packed))
    return dealt.groupBy("bucket").applyInArrow(meet, "token long, rank int, member long, member_reach int, hub long, hub_reach int")


def _sets(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """id, n, hashes (ascending, 8 bytes each) of the documents that ids may name."""
    rows, passing = _filtered(docs, ids, column)

    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            ok = _chosen(passing.value, [b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)])
            ids, texts = ids[ok], [t for t, k in zip(texts, ok.tolist(), strict=True) if k]
            for lo, hi in text_slices(texts, SLICE_CHARS):
                h, at = shingle_sets(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]), pa.array(np.diff(at)), pa.array([h[x:y].tobytes() for x, y in zip(at, at[1:], strict=False)], pa.binary())], names=["id", "n", "hashes"])

    return rows.mapInArrow(tidy(run), "id long, n long, hashes binary").where("n > 0")


def _folded(blob: bytes, size: int) -> bytes:
    """The bitmap with fewer bits: halves are put on each other, as places are taken modulo the width."""
    while len(blob) > size:
        x = np.frombuffer(blob, U)
        blob = (x[: x.size // 2] | x[x.size // 2 :]).tobytes()
    return blob


def _bits(blobs: list[bytes], size: int = 8 * SIGNATURE) -> np.ndarray:
    return np.frombuffer(b"".join([_folded(x, size) for x in blobs]), U).reshape(len(blobs), size // 8)


def _widened(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of one width, the widest there is up to WIDEST, and each one's number of bits set at its own width.

    A narrower bitmap is repeated: every place that a shingle of the set may have is set.
    """
    size = min(max(map(len, blobs)), WIDEST)
    own = [_folded(x, size) for x in blobs]
    bits = np.frombuffer(b"".join([x * (size // len(x)) for x in own]), U).reshape(len(own), size // 8)
    return bits, np.bitwise_count(bits).sum(1, dtype=np.int64) * np.array([len(x) for x in own]) // size


def _common(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many bits the bitmaps x[i] and y[j] share, some pairs at a time."""
    step = max(1, PAIRS_AT_ONCE // (8 * x.shape[1]))
    return np.concatenate([np.empty(0, np.int64), *(np.bitwise_count(x[i[k : k + step]] & y[j[k : k + step]]).sum(1, dtype=np.int64) for k in range(0, i.size, step))])


def _possible(pairs: DataFrame, every: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps (at the width both have) allow a link."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 4))
            x, y = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            size = np.array([min(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64)
            ok = np.zeros(size.size, bool)
            for z in np.unique(size).tolist():
                k = np.flatnonzero(size == z)
                u, v = _bits([x[i] for i in k], z), _bits([y[i] for i in k], z)
                count = lambda bits: np.bitwise_count(bits).sum(1, dtype=np.int64)
                slack = np.minimum(n[k] - count(u), m[k] - count(v))
                ok[k] = count(u & v) + slack >= _needed(n[k] + m[k], percent)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(ok)) for k in (0, 1)], names=["a", "b"])

    side = lambda x: every.select(F.col("doc_id").alias(x), F.col("n").alias(f"{x}_n"), F.col("signature").alias(f"{x}_bits"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)")
    return met.select("a", "b", "a_n", "a_bits", "b_n", "b_bits").mapInArrow(tidy(run), "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets. b is the side that recurs often (a hub)."""

    def run(batches):
        for b in batches:
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            ok = []
            for p, q in zip(x, y, strict=True):
                small, large = np.frombuffer(p, U), np.frombuffer(q, U)
                small, large = (small, large) if small.size <= large.size else (large, small)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, large.size - 1)] == small).sum())
                ok.append(100 * both >= percent * (small.size + large.size - both))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok, pa.bool_())), b.column(1).filter(pa.array(ok, pa.bool_()))], names=["a", "b"])

    s = sets.select("id", "n", "hashes")
    one = pairs.join(s.toDF("a", "an", "x"), "a")
    two = one.join(s.toDF("b", "bn", "y"), "b").where(f"100 * least(an, bn) >= {percent} * greatest(an, bn)")
    return two.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def _linked(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    with scratch(docs.sparkSession) as keep:  # the sets go when their links are written
        return keep(_verified(pairs, cut(_sets(docs, ids, "id"), "jaccard-sets"), percent), "jaccard-links")


class _Tree:
    """A signature tree over sorted holders: levels of nodes with OR bitmaps, size ranges, slack, components and reach."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, slack: np.ndarray, reach: np.ndarray):
        # slack: shingles that share a bit with others
        self.levels = [(bits, n, n, slack, comp, comp, reach)]
        while len(self.levels[-1][1]) > 1:
            low = self.levels[-1]
            at = np.arange(0, len(low[1]), FANOUT)
            self.levels.append(tuple(f.reduceat(v, at) for f, v in zip((np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum, np.maximum), low, strict=True)))


def _surviving(s: _Tree, t: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that no bound excludes, by traversing both trees together, level by level."""
    ls, lt = len(s.levels) - 1, len(t.levels) - 1
    i = j = np.zeros(1, np.int64)
    while True:
        (lo_s, hi_s, sl_s, c0, c1, r_s), (lo_t, hi_t, sl_t, d0, d1, r_t) = ([v[k] for v in x.levels[lev][1:]] for x, lev, k in ((s, ls, i), (t, lt, j)))
        ok = (np.minimum(r_s, r_t) >= _needed(lo_s + lo_t, percent)) & (100 * hi_s >= percent * lo_t) & (100 * hi_t >= percent * lo_s)
        ok &= ~((c0 == c1) & (d0 == d1) & (c0 == d0))
        most = _common(s.levels[ls][0], i[ok], t.levels[lt][0], j[ok]) + np.minimum(sl_s, sl_t)[ok]
        ok[ok] = most >= _needed(lo_s + lo_t, percent)[ok]
        i, j = i[ok], j[ok]
        if not i.size or ls == lt == 0:
            return i, j
        if ls >= lt:
            ls -= 1
            i, j = (i[:, None] * FANOUT + np.arange(FANOUT)).ravel(), np.repeat(j, FANOUT)
            inside = i < len(s.levels[ls][1])
        else:
            lt -= 1
            i, j = np.repeat(i, FANOUT), (j[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            inside = j < len(t.levels[lt][1])
        i, j = i[inside], j[inside]


def _spanning(comp_a: np.ndarray, comp_b: np.ndarray, likeness: np.ndarray, likely: float) -> np.ndarray:
    """Which of the pairs to verify, and which of these were counted on.

    Of likely links only a spanning forest of the components is taken, the likeliest first; every other pair is taken if
    its ends are still apart. Returns 0 (left out), 1 (taken), 2 (taken, and others were left out because of it).
    """
    nodes, place = np.unique(np.concatenate([comp_a, comp_b]), return_inverse=True)
    u, v = place[: comp_a.size], place[comp_a.size :]
    label, out = np.arange(nodes.size), np.zeros(comp_a.size, np.int8)
    sure = np.flatnonzero(likeness >= likely)
    sure = sure[np.argsort(-likeness[sure], kind="stable")]
    while True:
        open_pairs = sure[label[u[sure]] != label[v[sure]]]
        if not open_pairs.size:
            break
        # each component takes its likeliest link to another one
        ends = np.concatenate([label[u[open_pairs]], label[v[open_pairs]]])
        rank = np.tile(np.arange(open_pairs.size), 2)
        order = np.lexsort((rank, ends))
        first = np.append(True, ends[order][1:] != ends[order][:-1])
        taken = open_pairs[np.unique(rank[order][first])]
        out[taken] = 2
        x, y = label[u[taken]], label[v[taken]]
        merged = np.arange(nodes.size)
        while True:
            least = np.minimum(merged[x], merged[y])
            new = merged.copy()
            np.minimum.at(new, x, least)
            np.minimum.at(new, y, least)
            new = new[new]
            if (new == merged).all():
                break
            merged = new
        label = merged[label]
    out[(label[u] != label[v])] = 1
    return out


HOLDER = ["token", "part", "id", "n", "comp", "signature", "reach"]


def _block_cells(held: DataFrame, percent: int, alone: bool = False) -> DataFrame:
    """Rows (token, part, ..., x, y, left) of the holders of shingles in more than BLOCK documents, once for each pair of blocks that summaries don't exclude.

    alone: each block against itself only.
    """
    shuffles = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    order = ["token", "band", F.floor(F.log(F.col("n").cast("double")) * 32), "signature", "id"]
    placed = held.withColumn("band", band).repartitionByRange(shuffles, *order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())

    def cut_blocks(batches):
        """Numbers the blocks of a sorted range; a block holds one shingle and band."""
        last, size, number = None, 0, -1
        for b in batches:
            token, bands, task = (b.column(c).to_numpy() for c in ("token", "band", "task"))
            block = np.empty(b.num_rows, np.int64)
            edges = [0, *(np.flatnonzero((token[1:] != token[:-1]) | (bands[1:] != bands[:-1])) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if (token[lo], bands[lo]) != last:
                    last, size, number = (token[lo], bands[lo]), 0, number + 1
                at = (size + np.arange(hi - lo)) // BLOCK
                block[lo:hi] = number + at
                number, size = int(number + at[-1]), int((size + hi - lo - 1) % BLOCK + 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*HOLDER, "band")), pa.array(task.astype(np.int64) << 32 | block)], names=[*HOLDER, "band", "block"])

    blocks = cut(placed.mapInArrow(tidy(cut_blocks), "token long, part long, id long, n long, comp long, signature binary, reach int, band int, block long"), "jaccard-blocks")

    if alone:
        return blocks.select(*HOLDER, F.col("block").alias("x"), F.col("block").alias("y"), F.lit(True).alias("left"))

    def root(t: pa.Table) -> pa.Table:
        """The root of a block's tree."""
        n, comp, reach = (t.column(c).to_numpy() for c in ("n", "comp", "reach"))
        bits = _bits(t.column("signature").to_pylist())
        one = {"token": t.column("token")[:1], "band": t.column("band")[:1], "block": t.column("block")[:1], "words": pa.array([np.bitwise_or.reduce(bits, 0).view(np.int64).tolist()], pa.list_(pa.int64()))}
        slack = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        return pa.table(one | {k: pa.array([int(v)], pa.int64()) for k, v in (("lo", n.min()), ("hi", n.max()), ("slack", slack.max()), ("c0", comp.min()), ("c1", comp.max()), ("reach", reach.max()))})

    fields = ["block", "words", "lo", "hi", "slack", "c0", "c1", "reach"]
    roots = cut(blocks.groupBy("block").applyInArrow(root, "token long, band int, block long, words array<long>, lo long, hi long, slack long, c0 long, c1 long, reach long"), "jaccard-roots")
    side = lambda k, shift: roots.select("token", (F.col("band") + shift).alias("band"), *[F.col(c).alias(f"{k}_{c}") for c in fields])
    # blocks of a band with each other, and with those of the band below
    met = side("a", 0).join(side("b", 0), ["token", "band"]).where("a_block >= b_block").unionByName(side("a", 0).join(side("b", 1), ["token", "band"]))
    need = f"ceil({percent} * (a_lo + b_lo) / {100 + percent})"
    met = met.where(f"least(a_reach, b_reach) >= {need} and 100 * a_hi >= {percent} * b_lo and 100 * b_hi >= {percent} * a_lo and not (a_c0 = a_c1 and b_c0 = b_c1 and a_c0 = b_c0)")
    shared = "aggregate(zip_with(a_words, b_words, (x, y) -> bit_count(x & y)), 0, (s, x) -> s + x)"
    pairs = cut(met.where(f"{shared} + least(a_slack, b_slack) >= {need}").select(F.col("a_block").alias("x"), F.col("b_block").alias("y")), "jaccard-block-pairs")
    left = blocks.join(pairs, F.col("block") == F.col("x")).withColumn("left", F.lit(True))
    right = blocks.join(pairs.where("x != y"), F.col("block") == F.col("y")).withColumn("left", F.lit(False))
    return left.unionByName(right).select(*HOLDER, "x", "y", "left")


def _tree_pairs(held: DataFrame, percent: int, buckets: int, likely: float, alone: bool = False) -> DataFrame:
    """Candidate pairs (a, b, counted), a < b, from holders (token, m, part, id, n, comp, signature, reach) of shingles that join components.

    m is a shingle's number of holders: up to BLOCK they are one group; more are cut into blocks, of which `alone` takes each by itself.
    counted: other pairs were left out because this one is likely to link.
    """
    def cell_pairs(self_pairs, n, comp, reach, bits, own, left) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows of one large cell, by two trees."""
        if comp.min() == comp.max() or not (self_pairs or (left.any() and not left.all())):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sides = []
        for pick in (left, left if self_pairs else ~left):
            k = np.flatnonzero(pick)
            k = k[np.lexsort((*bits[k].T[::-1], comp[k], n[k]))]
            sides.append((k, _Tree(n[k], comp[k], bits[k], (n - own)[k], reach[k])))
        (p, s), (q, u) = sides
        i, j = _surviving(s, u, percent)
        return p[i], q[j]

    def node_pairs(begin, size, n, comp, reach, bits, own) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows of all cells that are a single node."""
        row = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        later = np.repeat(begin + size, size) - row - 1
        i = np.repeat(row, later)
        j = i + 1 + np.arange(i.size) - np.repeat(np.cumsum(later) - later, later)
        need = _needed(n[i] + n[j], percent)
        ok = (comp[i] != comp[j]) & (np.minimum(reach[i], reach[j]) >= need) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j, need = i[ok], j[ok], need[ok]
        ok = _common(bits, i, bits, j) + np.minimum((n - own)[i], (n - own)[j]) >= need
        return i[ok], j[ok]

    def join(t: pa.Table) -> pa.Table:
        """The cells of a bucket."""
        keys = [t.column(c).to_numpy() for c in ("token", "x", "y")]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        begin = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
        size = np.diff(np.append(begin, order.size))
        ids, n, comp, reach, left = (t.column(c).to_numpy()[order] for c in ("id", "n", "comp", "reach", "left"))
        bits, own = _widened([_folded(x, WIDEST) for x in t.column("signature").take(pa.array(order)).to_pylist()])
        alone = keys[1][begin] == keys[2][begin]  # a cell against itself
        small = alone & (size <= ONE_NODE)
        found = [node_pairs(begin[small], size[small], n, comp, reach, bits, own)]
        for k in np.flatnonzero(~small).tolist():
            at = slice(begin[k], begin[k] + size[k])
            i, j = cell_pairs(alone[k], n[at], comp[at], reach[at], bits[at], own[at], left[at])
            found.append((i + begin[k], j + begin[k]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        swap = ids[i] > ids[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        # cells of a bucket share most holders: each pair once, and one forest for all
        by = np.lexsort((ids[j], ids[i]))
        i, j = i[by], j[by]
        a, b = ids[i], ids[j]
        new = (a != b) & np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: a.size]
        i, j = i[new], j[new]
        # shared bits less those that meet by chance, against the overlap needed
        full = np.bitwise_count(bits).sum(1, dtype=np.int64)
        both = _common(bits, i, bits, j)
        likeness = (both - (full[i] - both) * (full[j] - both) / (64 * bits.shape[1])) / _needed(n[i] + n[j], percent)
        pick = _spanning(comp[i], comp[j], likeness, likely)
        return pa.table({"a": pa.array(ids[i][pick > 0]), "b": pa.array(ids[j][pick > 0]), "counted": pa.array(pick[pick > 0] == 2)})

    whole = held.where(F.col("m") <= BLOCK).select(*HOLDER, F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(True).alias("left"))
    large = held.where(F.col("m") > BLOCK)
    cells = whole.unionByName(_block_cells(large, percent, alone)) if large.take(1) else whole
    # shingles of one group of documents go together, as many as the group's share of rows allows; so do pairs of one block
    bucket = F.pmod(F.xxhash64("part", "x", "y"), F.lit(buckets))
    return cells.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(join, "a long, b long, counted boolean").groupBy("a", "b").agg(F.bool_or("counted").alias("counted"))


#: Every step is written and read again, so a step's shuffle files can go when it has run.
TIDY_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    with scratch(docs.sparkSession) as keep, settings(docs.sparkSession, TIDY_SHUFFLES):
        return keep(_groups(docs, percent), "jaccard-rows")


def _groups(docs: DataFrame, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = own_columns(docs, {"doc_id": "long", "text": "string"})
    profiles = cut(_profiles(docs), "jaccard-profiles")
    every = profiles.where("slice is null").drop("slice")
    sketch = _sketch(profiles)
    sized = every.where("n > 0 and doc_id is not null")
    classes = cut(sized.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 1 << max(5, math.ceil(math.log2(max(2 * shuffles, shingles * (1 - percent / 100) / BUCKET_SHINGLES))))

    met = cut(_incidences(docs, classes.select("rep"), sketch, buckets, percent), "jaccard-met")
    hubs = met.select(F.col("member").alias("a"), F.col("hub").alias("b")).distinct()
    links = _linked(docs, cut(_possible(hubs, sized, percent), "jaccard-pairs"), percent)
    parts = cut(components(links), "jaccard-parts")

    # what is left: shingles with three or more holders, in different components; the pair of two is verified
    one = lambda who: met.select("token", "rank", F.col(who).alias("id"), F.col(f"{who}_reach").alias("reach"))
    holders = one("member").union(one("hub")).groupBy("token", "rank", "id").agg(F.max("reach").alias("reach"))
    alike = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"x{k}") for k in range(2)]
    # of shingles with the same holders the first in the global order, to which reach belongs (tokens compare without sign)
    first = F.min(F.struct("rank", F.col("token").bitwiseXOR(F.lit(-(1 << 63))), "token"))
    chosen = holders.groupBy("token", "rank").agg(F.count(F.lit(1)).alias("m"), *alike).where("m > 2").groupBy("m", "x0", "x1").agg(first.alias("t")).select("m", "t.token")
    holders = cut(holders.drop("rank").join(chosen, "token"), "jaccard-holders")
    tried, alone = None, bool(holders.where(F.col("m") > BLOCK).take(1))
    # large groups first, their blocks each by itself: what they join makes most pairs of blocks one component
    for likely in (LIKELY[0], *LIKELY) if alone else LIKELY:
        these = holders.where(F.col("m") > BLOCK) if alone else holders
        placed = these.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
        tokens = placed.groupBy("token").agg(F.first("m").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
        shares = tokens.groupBy("lo").agg(F.ceil(F.sum("m") / PART_ROWS).cast("long").alias("shares"))
        tokens = tokens.join(shares, "lo").select("token", F.xxhash64("lo", F.pmod(F.xxhash64("token"), "shares")).alias("part"))
        held = placed.join(tokens, "token").join(sized.select(F.col("doc_id").alias("id"), "n", "signature"), "id")
        with scratch(spark) as keep:  # a round's holders and blocks go when its pairs are written
            held = cut(held.dropDuplicates(["token", "id"]), "jaccard-held")
            rows = held.count()
            if not rows and not alone:
                break
            wanted = keep(_tree_pairs(held, percent, max(shuffles, math.ceil(rows / GROUP_ROWS)), likely, alone), "jaccard-pairs")
        more = wanted.select("a", "b") if tried is None else wanted.select("a", "b").join(tried, ["a", "b"], "left_anti")
        tried = more if tried is None else tried.union(more)
        links = links.union(_linked(docs, cut(_possible(more, sized, percent), "jaccard-pairs"), percent))
        parts = cut(components(links), "jaccard-parts")
        # pairs were left out where a likely link would join their ends: once more if one of those is no link
        if not alone and not wanted.where("counted").join(links, ["a", "b"], "left_anti").take(1):
            break
        alone = False

    parts = parts.select(F.col("node").alias("rep"), "component")

    # members of a class share its representative's component
    known = classes.join(parts, "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = every.join(known, ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: of each group the one with the smallest doc_id, and rows linked with nothing.

    Rows that share a doc_id are one document and stay or go together; rows without doc_id stay.
    """
    name = free_name("_stay", docs.columns)
    stay = near_groups(docs, percent).where("component_id = doc_id or component_id is null").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(stay[name]), "left_semi")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
