"""Operator 13: an audit of how the sources of a language differ in their words.

Terms are runs of ASCII letters and bytes beyond ASCII, A-Z lower-cased. A lookup table over the concatenated UTF-8 buffers of many texts lower-cases
them and marks the bytes of terms; changes of the mark are the terms' ends. All slices are hashed by XXH64 at once (short
ones in numpy, those of 32 bytes and more by the library) and grouped by hash; every slice is compared byte by byte with the first one of its group, and a group
that holds unlike slices is told apart by the bytes themselves. Each task sums its terms by language and source before they are shuffled by the terms.

Of each language the terms of at least LEAST_DOCS documents are kept and written with their counts by source. They are dealt by hash to chunks of
about CHUNK counts. A chunk is a CSR matrix (sources by terms), of which sums of f over terms come from `reduceat` over its entries: terms that
neither source has contribute one constant each, so nothing dense in sources times terms is built. Chunks give partial sums for each pair of sources, and the best TERMS terms for
each source; Spark adds and ranks them. All arithmetic is in whole numbers of 64 bits, or in Python's where counts are too large for that.

Defined results: null text, lang and source count as ''; documents are rows, so repeated rows count each; a language without kept
terms gives its pairs with value 0; a language with one source has no pairs; doc_id isn't read; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.common import cut, scratch, table, text_slices, tidy
from sessionloom.llm.shingles import U

LEAST_DOCS = 3
TERMS = 200
UNIT = 1_000_000_000
CHUNK = 250_000
HIGHEST = (1 << 63) - 1
HELD = 1_500_000  # entries that a task holds before it hands them on

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(97, 123), *range(128, 256)]] = True

# XXH64's primes. Fixed values.
P1, P2, P3, P4, P5 = (U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << U(bits) | x >> U(64 - bits)


def hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of slices of a buffer that goes on for 32 bytes or more behind the last one."""
    words = np.ndarray((data.size - 7,), "<u8", data, strides=(1,))
    halves = np.ndarray((data.size - 3,), "<u4", data, strides=(1,))
    h = P5 + size.astype(U)
    left, at = size.copy(), start.copy()
    for _ in range(3):
        go = np.flatnonzero(left >= 8)
        if not go.size:
            break
        h[go] = _rotated(h[go] ^ _rotated(words[at[go]] * P2, 31) * P1, 27) * P1 + P4
        at[go] += 8
        left[go] -= 8
    go = np.flatnonzero((left >= 4) & (size < 32))
    h[go] = _rotated(h[go] ^ halves[at[go]].astype(U) * P1, 23) * P2 + P3
    at[go] += 4
    left[go] -= 4
    for _ in range(3):
        go = np.flatnonzero((left > 0) & (size < 32))
        h[go] = _rotated(h[go] ^ data[at[go]].astype(U) * P5, 11) * P1
        at[go] += 1
        left[go] -= 1
    h = (h ^ h >> U(33)) * P2
    h = (h ^ h >> U(29)) * P3
    h ^= h >> U(32)
    for k in np.flatnonzero(size >= 32).tolist():
        h[k] = xxhash.xxh64_intdigest(data[start[k] : start[k] + size[k]].tobytes())
    return h


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the slices of one size from a and from b are equal, byte by byte."""
    words = np.ndarray((data.size - 7,), "<u8", data, strides=(1,))
    out = np.ones(a.size, bool)
    for k in range(0, int(size.max()) if size.size else 0, 8):
        go = np.flatnonzero(size > k)
        rest = np.minimum(size[go] - k, 8)
        mask = np.where(rest < 8, (U(1) << (U(8) * (rest % 8).astype(U))) - U(1), ~U(0))
        out[go] &= (words[a[go] + k] ^ words[b[go] + k]) & mask == 0
    return out


def grouped(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first slice of each group of equal slices, and each slice's group."""
    _, first, group = np.unique(hashes(data, start, size), return_index=True, return_inverse=True)
    rep = first[group]
    same = size == size[rep]
    same[same] = _same(data, start[same], start[rep[same]], size[same])
    if not same.all():  # unlike slices with one hash
        first, more = first.tolist(), {}
        for k in np.flatnonzero(~same).tolist():
            text = data[start[k] : start[k] + size[k]].tobytes()
            if text not in more:
                more[text] = len(first)
                first.append(k)
            group[k] = more[text]
        first = np.array(first)
    return first, group


def terms_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased buffer, start and size of all terms, and the text each belongs to."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = _LOWER[np.frombuffer(b"\0".join(raw) + bytes(40), np.uint8)]
    edge = np.flatnonzero(np.diff(_TERM[data].view(np.int8), prepend=np.int8(0)))
    start, stop = edge[::2], edge[1::2]
    return data, start, stop - start, np.searchsorted(np.cumsum([len(r) + 1 for r in raw]) - 1, start)


class _Held:
    """Counts of (language and source, term) of a task, handed on when there are many."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, group: np.ndarray, terms: list[bytes], term: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        known = self.terms
        at = np.fromiter((known.setdefault(t, len(known)) for t in terms), np.int64, len(terms))
        self.parts.append((group << 40 | at[term], n, docs))
        self.size += group.size
        if self.size > HELD:
            self._sum()

    def _sum(self) -> None:
        key, back = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
        n, docs = (np.zeros(key.size, np.int64) for _ in range(2))
        np.add.at(n, back, np.concatenate([p[1] for p in self.parts]))
        np.add.at(docs, back, np.concatenate([p[2] for p in self.parts]))
        self.parts, self.size = [(key, n, docs)], key.size

    def rows(self):
        if not self.parts:
            return
        self._sum()
        key, n, docs = self.parts[0]
        terms = pa.array(list(self.terms), pa.binary())
        langs, sources = (pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1))
        for lo in range(0, key.size, 100_000):
            part = slice(lo, lo + 100_000)
            group, term = pa.array(key[part] >> 40), pa.array(key[part] & (1 << 40) - 1)
            yield pa.RecordBatch.from_arrays([langs.take(group), sources.take(group), terms.take(term), pa.array(n[part]), pa.array(docs[part])], names=["lang", "source", "term", "n", "docs"])
        self.__init__()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term (bytes), n, docs of parts of the documents (lang, source, text): to be summed."""

    def run(batches):
        held = _Held()
        for b in batches:
            names = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            texts = b.column(2).to_pylist()
            for lo, hi in text_slices(texts, 4_000_000):
                data, start, size, owner = terms_of(texts[lo:hi])
                if not start.size:
                    continue
                first, term = grouped(data, start, size)
                # by text first, so that a text counts once for each of its terms
                pair, n = np.unique(owner.astype(np.int64) << 32 | term, return_counts=True)
                of_text = np.array([held.groups.setdefault(names[k], len(held.groups)) for k in range(lo, hi)], np.int64)
                key, back = np.unique(of_text[pair >> 32] << 32 | pair & 0xFFFFFFFF, return_inverse=True)
                raw = data.tobytes()
                held.add(key >> 32, [raw[start[k] : start[k] + size[k]] for k in first.tolist()], key & 0xFFFFFFFF, np.bincount(back, n).astype(np.int64), np.bincount(back))
                if held.size > HELD:
                    yield from held.rows()
        yield from held.rows()

    return docs.mapInArrow(tidy(run), "lang string, source string, term binary, n long, docs long")


def shares(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / (total + kept))."""
    if count.size and int(count.max()) + 1 > HIGHEST // UNIT:
        return np.array([1 + UNIT * (c + 1) // (total + kept) for c in count.tolist()], np.int64)
    return 1 + UNIT * (count.astype(np.int64) + 1) // (total + kept)


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def chunk_sums(source: np.ndarray, term: np.ndarray, count: np.ndarray, totals: list[int], terms: int, kept: int) -> np.ndarray:
    """Sums of f over the chunk's terms for each pair of sources (row: p, column: q). Entries (source, term, count) are sorted by source and term."""
    s = len(totals)
    ptr = np.searchsorted(source, np.arange(s + 1))
    size = np.diff(ptr)
    total = np.array([totals[k] for k in range(s)], object)
    none = np.array([int(shares(np.zeros(1, np.int64), int(t), kept)[0]) for t in total], np.int64)
    p = np.concatenate([shares(count[ptr[k] : ptr[k + 1]], int(total[k]), kept) for k in range(s)]) if s else np.empty(0, np.int64)
    out = np.zeros((s, s), np.int64)
    filled = np.flatnonzero(size)
    own = np.zeros(terms, np.int64)
    for k in range(s):
        mine = slice(ptr[k], ptr[k + 1])
        # against sources without the term, then mended where they have it
        if size[k]:
            for r in range(0, s, 64):
                q = none[r : r + 64]
                out[k, r : r + 64] += gaps(p[mine][None, :], q[:, None]).sum(1)
        own[term[mine]] = p[mine]
        met = own[term]
        q = none[source]
        # where both have the term: the right value for the one above; where only the other has it: its value against this one's share of nothing
        change = np.where(met > 0, gaps(np.maximum(met, 1), p) - gaps(np.maximum(met, 1), q), gaps(none[k], p) - gaps(none[k], q))
        if filled.size:
            out[k, filled] += np.add.reduceat(change, ptr[filled])
        out[k] += (terms - size[k]) * gaps(none[k], none)
        own[term[mine]] = 0
    return out


def _chunks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, part, item, value: partial sums of pairs, and the best terms of each chunk.

    kept: lang, chunk, term, counts (structs source, n); groups: lang, chunk, source, total, kept, lang_total.
    """

    def run(key, rows: pa.Table, sides: pa.Table) -> pa.Table:
        names = sides.column("source").to_pylist()
        totals, v = sides.column("total").to_pylist(), sides.column("kept")[0].as_py()
        at = {n: k for k, n in enumerate(names)}
        words = rows.column("term").to_pylist()
        lists = rows.column("counts").combine_chunks()
        flat, each = lists.flatten(), np.diff(lists.offsets.to_numpy())
        source = np.array([at[n] for n in flat.field("source").to_pylist()], np.int64)
        count, term = flat.field("n").to_numpy(), np.repeat(np.arange(len(words)), each)
        order = np.lexsort((term, source))
        source, term, count = source[order], term[order], count[order]
        out = {"lang": [], "source": [], "part": [], "item": [], "value": []}

        def add(source: str, part: str, items: list[str], values: list[int]) -> None:
            out["lang"].extend([key[0].as_py()] * len(items))
            out["source"].extend([source] * len(items))
            out["part"].extend([part] * len(items))
            out["item"].extend(items)
            out["value"].extend(values)

        sums = chunk_sums(source, term, count, totals, len(words), v)
        whole = np.zeros(len(words), np.int64)
        np.add.at(whole, term, count)
        q = shares(whole, sides.column("lang_total")[0].as_py(), v) if words else whole
        ptr = np.searchsorted(source, np.arange(len(names) + 1))
        for k, name in enumerate(names):
            add(name, "pair", [x for j, x in enumerate(names) if j != k], [x for j, x in enumerate(sums[k].tolist()) if j != k])
            mine = slice(ptr[k], ptr[k + 1])
            p, t = shares(count[mine], totals[k], v), term[mine]
            f, more = gaps(p, q[t]), p > q[t]
            f, t = f[more], t[more]
            if f.size > TERMS:  # all that aren't below the last of the best
                pick = f >= np.partition(f, f.size - TERMS)[f.size - TERMS]
                f, t = f[pick], t[pick]
            best = sorted(zip((-f).tolist(), [words[j] for j in t.tolist()], strict=True))[:TERMS]
            add(name, "term", [w.decode("utf-8", "surrogatepass") for _, w in best], [-x for x, _ in best])
        return pa.table(out, schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]))

    return kept.groupBy("lang", "chunk").cogroup(groups.groupBy("lang", "chunk")).applyInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank of documents (lang, source, text)."""
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = docs.select(text("lang"), text("source"), text("text"))
    with scratch(spark) as keep:
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # one shuffle, by language and term, serves both sums
        dealt = term_counts(own).repartition(shuffles, "lang", "term")
        by_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        kept = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts")).where(F.col("docs") >= least)
        kept = cut(kept.select("lang", "term", "counts"), "divergence-terms")
        each = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"), F.count(F.lit(1)).alias("entries"))
        sides = cut(own.select("lang", "source").distinct().join(each, ["lang", "source"], "left").na.fill(0), "divergence-sources")
        of_lang = sides.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.greatest(F.lit(1), F.ceil(F.sum("entries") / CHUNK)).cast("int").alias("chunks"))
        of_lang = of_lang.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")), "lang", "left").na.fill(0)
        groups = sides.join(of_lang, "lang").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        placed = kept.join(of_lang.select("lang", "chunks"), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks").cast("long")).cast("int"))
        found = cut(_chunks(placed.select("lang", "chunk", "term", "counts"), groups.select("lang", "chunk", "source", "total", "kept", "lang_total")), "divergence-parts")
        pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
        rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
        ranked = pairs.withColumn("rank", rank).unionByName(found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TERMS))
        return keep(ranked, "divergence")


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
g AS (SELECT s.lang, s.source, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS total FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c ON c.lang = s.lang AND c.source = s.source GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (CAST(coalesce(c.n, 0) AS HUGEINT) + 1)) // (total + v) AS p FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT a.lang, a.term, 1 + (1000000000 * (CAST(n AS HUGEINT) + 1)) // (total + v) AS q FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2) a JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY 1) b ON b.lang = a.lang JOIN v ON v.lang = a.lang),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
