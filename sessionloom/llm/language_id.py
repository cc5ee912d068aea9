"""Operator 4: language identification by interpolated Kneser-Ney character models.

Text is lower-cased, everything but letters becomes one space, and every character is predicted from the three before
it. Counts of all 4-grams of all training rows are gathered by language in the scan and summed by Spark. From all of them
Spark computes for each language continuation counts of the lower orders, one discount for each order, and tables of
probabilities and back-off weights by gram (packed into 64 bits, 16 for each letter; letters beyond share one code). The
language with the lowest cross-entropy per character is chosen.

Rejection is calibrated on training-side rows that are kept out of the counts (one in CALIBRATION_SHARE, by a hash of
doc_id). Of a language's calibration rows, q is the cross-entropy that all but the share FALSE_REJECTS stay below, and s the
deviation of a character's surprisal. A text of n letters and spaces is rejected above q + SIGMAS * s / sqrt(n): the second part is
the chance deviation of a mean of n characters, so that short texts aren't rejected for being short. About FALSE_REJECTS of
good rows are rejected. Where a language has too few calibration rows to see that quantile, q is a tenth above
the largest of them, or HARD_LIMIT nats without any. Texts of fewer than SURE_LETTERS letters are never rejected, unless they have none.

The tables are whole at every size: they are sorted by range partitions and written to the shared folder as arrays of keys
and values. Workers map them into memory and search them; from a store that can't be mapped they fetch a file once. Only file
names are broadcast, and neither driver nor worker holds a table. Nothing but 4-gram counts and the tables made of them is
shuffled. Texts of any length are read in windows of WINDOW characters that hand on their last letters, and what a worker keeps
(scores of grams, counts before they are summed) has a fixed size in bytes.

Defined results: null text or text without letters gives `und` with score 0; with nothing to learn from every row is `und`;
ties in cross-entropy go to the first language in order; repeated rows are predicted each; rows with null lang are
predicted but not learned from; null doc_id counts as not held out; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import os
import shutil
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, fresh_path, table, text_slices, tidy
from sessionloom.llm.shingles import U

ORDER = 4
CALIBRATION_SHARE = 16
FALSE_REJECTS = 0.002
SIGMAS = 3.0
HARD_LIMIT = 5.0
SURE_LETTERS = 40
UNIFORM = 1 / 65_536
WINDOW = 250_000
CACHE_BYTES = 24_000_000
COUNT_BITS = 19
SHARPNESS = (1, 2, 4, 8, 16, 32)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The letter each code point stands for, in 16 bits: lower case, 32 for all that is no letter, one code for letters beyond."""
    out = np.full(0x110000, 32, np.uint16)
    for c in range(0x110000):
        x = chr(c)
        if unicodedata.category(x)[0] == "L":
            low = x.lower()
            out[c] = min(ord(low), 0xFFFF) if len(low) == 1 else min(c, 0xFFFF)
    return out


def _codes(text: str) -> np.ndarray:
    return letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-grams of all texts, where each text's start (and the end), and the number of letters of each text."""
    code = _codes("\0".join(t or "" for t in texts) + "\0")
    ends = np.cumsum([len(t or "") + 1 for t in texts]) - 1
    letter = code != 32
    n_letters = np.diff(np.append(0, np.cumsum(letter)[ends]))
    # runs without letters become one space; one space closes each text that has a letter
    keep = letter | np.append(False, letter[:-1])
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(-1, ends)))[keep]
    code = code[keep].astype(U)
    first = np.append(True, owner[1:] != owner[:-1])[: code.size]
    start = np.flatnonzero(first)
    place = np.arange(code.size) - np.repeat(start, np.diff(np.append(start, code.size))) if code.size else np.empty(0, np.int64)
    packed = code.copy()
    for k in range(1, ORDER):
        before = np.full(code.size, 32, U)
        before[k:] = code[:-k] if k < code.size else before[k:]
        before[place < k] = 32
        packed |= before << U(16 * k)
    return packed, np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))), n_letters


def windows(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """The packed 4-grams of one long text, and its letters, a window of WINDOW characters at a time."""
    last, after_letter = np.full(ORDER - 1, 32, np.uint16), False
    for lo in range(0, len(text), WINDOW):
        code = _codes(text[lo : lo + WINDOW] + "\0" * (lo + WINDOW >= len(text)))
        letter = code != 32
        keep = letter | np.append(after_letter, letter[:-1])
        after_letter = bool(letter[-1])
        code = np.append(last, code[keep])
        last = code[-(ORDER - 1) :]
        packed = code[ORDER - 1 :].astype(U)
        for k in range(1, ORDER):
            packed |= code[ORDER - 1 - k : code.size - k].astype(U) << U(16 * k)
        yield packed, int(letter.sum())


def parts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, keys, where each text's keys start, letters) of runs of texts; a long text comes in several parts."""
    for lo, hi in text_slices(texts, WINDOW):
        if hi == lo + 1 and len(texts[lo] or "") > WINDOW:
            for keys, n in windows(texts[lo]):
                yield lo, keys, np.array([0, keys.size]), np.array([n])
        else:
            yield lo, *grams(texts[lo:hi])


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * U(0x9E3779B97F4A7C15)) >> U(64 - bits)).astype(np.int64)


class _Counts:
    """Counts of (language, 4-gram): a table with one entry for each slot; entries whose slot is taken are handed out summed, at a fixed number of them."""

    MOST = 1 << 19

    def __init__(self):
        self.langs: dict[str, int] = {}
        self.keys, self.lang, self.n = np.zeros(1 << COUNT_BITS, U), np.zeros(1 << COUNT_BITS, np.int32), np.zeros(1 << COUNT_BITS, np.int64)
        self.more: list[tuple[np.ndarray, int]] = []
        self.size = 0

    def add(self, lang: str, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        k = self.langs.setdefault(lang, len(self.langs) + 1)
        slot = _slot(keys ^ U(k * 0x9E3779B1), COUNT_BITS)
        free = self.lang[slot] == 0
        self.keys[slot[free]] = keys[free]
        self.lang[slot[free]] = k
        hit = (self.keys[slot] == keys) & (self.lang[slot] == k)
        self.n += np.bincount(slot[hit], minlength=self.n.size)
        if not hit.all():
            self.more.append((keys[~hit], k))
            self.size += int((~hit).sum())
            if self.size > self.MOST:
                yield from self._rest()

    def _rest(self) -> Iterator[pa.RecordBatch]:
        for k in {k for _, k in self.more}:
            yield from self._rows(*np.unique(np.concatenate([x for x, y in self.more if y == k]), return_counts=True), k)
        self.more, self.size = [], 0

    def _rows(self, keys: np.ndarray, n: np.ndarray, lang) -> Iterator[pa.RecordBatch]:
        names = pa.array(["", *self.langs], pa.string())
        for lo in range(0, keys.size, 100_000):
            part = slice(lo, lo + 100_000)
            which = np.broadcast_to(lang, keys.shape)[part].astype(np.int32)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(which)), pa.array(keys[part].view(np.int64)), pa.array(n[part].astype(np.int64))], names=["lang", "gram", "n"])

    def all(self) -> Iterator[pa.RecordBatch]:
        yield from self._rest()
        used = self.n > 0
        yield from self._rows(self.keys[used], self.n[used], self.lang[used])


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram, n over all rows (lang, text)."""

    def run(batches):
        found = _Counts()
        for b in batches:
            langs, texts = np.array(b.column(0).to_pylist(), object), b.column(1).to_pylist()
            for lang in sorted(set(langs)):
                for _, keys, _, _ in parts([t for t, x in zip(texts, langs == lang, strict=True) if x]):
                    yield from found.add(lang, keys)
        yield from found.all()

    return rows.select("lang", "text").mapInArrow(tidy(run), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Table:
    """A sorted array of keys with values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)

    def get(self, keys: np.ndarray, otherwise: float) -> np.ndarray:
        if not self.keys.size:
            return np.full(keys.size, otherwise, np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.float32(otherwise))


@lru_cache(maxsize=100_000)
def _local(path: str) -> str:
    """The path of a shared file on this machine: its own where the folder is mounted, else that of a copy, fetched once for each worker."""
    store, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    if isinstance(store, fs.LocalFileSystem):
        return place
    copy = os.path.join(tempfile.mkdtemp(prefix="lang-table-"), os.path.basename(place))
    with store.open_input_stream(place) as source, open(copy, "wb") as target:
        shutil.copyfileobj(source, target)
    return copy


class _Mapped:
    """A table as sorted arrays in files of the shared folder, mapped where they are searched."""

    def __init__(self, parts: list[tuple[int, str]]):
        parts = sorted(parts)  # (first key, path without its ending)
        self.first, self.paths = np.array([p[0] for p in parts], U), [p[1] for p in parts]
        self.maps: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"maps": {}}

    def get(self, keys: np.ndarray, otherwise: float) -> np.ndarray:
        out = np.full(keys.size, otherwise, np.float32)
        part = np.searchsorted(self.first, keys, "right") - 1
        for k in np.unique(part[part >= 0]).tolist():
            if k not in self.maps:
                self.maps[k] = np.memmap(_local(self.paths[k] + ".keys"), U, "r"), np.memmap(_local(self.paths[k] + ".values"), np.float32, "r")
            known, values = self.maps[k]
            mine = np.flatnonzero(part == k)
            at = np.minimum(np.searchsorted(known, keys[mine]), known.size - 1)
            hit = known[at] == keys[mine]
            out[mine[hit]] = values[at[hit]]
        return out


class KneserNey:
    """One language: for each order the discounted probability of a seen gram and the back-off weight of a seen context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.orders: list[tuple[_Table, _Table]] = []
        for order in range(ORDER, 0, -1):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
            context, back, types = np.unique(keys >> U(16), return_inverse=True, return_counts=True)
            total = np.bincount(back, counts)
            self.orders.append((_Table(keys, np.maximum(counts - d, 0) / total[back]), _Table(context, d * types / total)))
            # the next order counts in how many contexts a gram was seen
            keys, counts = np.unique(keys & ((U(1) << U(16 * (order - 1))) - U(1)), return_counts=True)

    @classmethod
    def of(cls, orders: list[tuple[_Mapped, _Mapped]]) -> KneserNey:
        own = cls.__new__(cls)
        own.orders = orders
        return own

    def log_p(self, keys: np.ndarray) -> np.ndarray:
        p, weight = np.zeros(keys.size), np.ones(keys.size)
        for order, (seen, context) in zip(range(ORDER, 0, -1), self.orders, strict=True):
            gram = keys & ((U(1) << U(16 * order)) - U(1)) if order < ORDER else keys
            p += weight * seen.get(gram, 0)
            weight *= context.get(gram >> U(16), 1)
        return np.log(p + weight * UNIFORM)


class LanguageModel:
    def __init__(self, models: dict[str, KneserNey]):
        self.langs = sorted(models)
        self.models = [models[k] for k in self.langs]
        self.limit = np.full(len(self.langs), HARD_LIMIT)
        self.spread = np.zeros(len(self.langs))
        self.sharpness = 1.0
        self.bits = max(8, int(math.log2(CACHE_BYTES / (8 + 4 * max(1, len(self.langs))))))
        self.cache: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self):
        return self.__dict__ | {"cache": None}

    def forget(self) -> None:
        self.cache = None

    def _scores(self, keys: np.ndarray) -> np.ndarray:
        """log p of each gram under each language."""
        if self.cache is None:
            self.cache = np.zeros(1 << self.bits, U), np.zeros((1 << self.bits, len(self.langs)), np.float32)
        held, score = self.cache
        slot = _slot(keys, self.bits)
        miss = np.flatnonzero(held[slot] != keys)
        values = score[slot]
        if miss.size:
            new, back = np.unique(keys[miss], return_inverse=True)
            found = np.stack([m.log_p(new) for m in self.models], 1).astype(np.float32)
            values[miss] = found[back]
            held[_slot(new, self.bits)], score[_slot(new, self.bits)] = new, found
        return values

    def measures(self, texts: list[str | None], squares: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """Cross-entropy per character of each text under each language (nan without letters), characters, letters, mean squares of surprisals."""
        total, square = (np.zeros((len(texts), len(self.langs))) for _ in range(2))
        size, n_letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for lo, keys, at, n in parts(texts):
            here = lo + np.flatnonzero(np.diff(at))
            size[lo : lo + n.size] += np.diff(at)
            n_letters[lo : lo + n.size] += n
            if here.size:
                values, begin = self._scores(keys), at[here - lo]
                total[here] -= np.add.reduceat(values, begin, axis=0, dtype=np.float64)
                if squares:
                    square[here] += np.add.reduceat(values * values, begin, axis=0, dtype=np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            return total / size[:, None], size, n_letters, square / size[:, None] if squares else None

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text."""
        if not self.langs:
            return [("und", 0.0, True)] * len(texts)
        h, size, n, _ = self.measures(texts)
        out = []
        for row, m, k in zip(h, size.tolist(), n.tolist(), strict=True):
            if not k:
                out.append(("und", 0.0, True))
                continue
            best = int(row.argmin())
            p = 1 / np.exp(-self.sharpness * (row - row[best])).sum()
            over = max(0.0, float(row[best] / (self.limit[best] + SIGMAS * self.spread[best] / math.sqrt(m)) - 1))
            out.append((self.langs[best], float(p * np.exp(-over)), bool(over > 0 and k >= SURE_LETTERS)))
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def calibrates(doc_id: Column) -> Column:
    """Whether a training row is for the rejection limits only."""
    return F.pmod(F.xxhash64(doc_id, F.lit("calibration")), F.lit(CALIBRATION_SHARE)) == 0


def model_tables(counts: DataFrame) -> DataFrame:
    """lang, part, gram, value of KneserNey's tables from all counts (lang, gram, n); part: 2 x order for grams, 1 more for contexts.

    The counts of each order are written before they are used, and the driver gets the discounts: a row for each language and order.
    """
    tables = []
    for order in range(ORDER, 0, -1):
        once, twice = F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))
        found = counts.groupBy("lang").agg(once.alias("once"), twice.alias("twice")).collect()
        discount = {r["lang"]: min(max(r["once"] / max(r["once"] + 2 * r["twice"], 1), 0.1), 0.95) for r in found}
        d = F.create_map(*[F.lit(x) for kv in discount.items() for x in kv])[F.col("lang")] if discount else F.lit(0.0)
        own = counts.withColumn("context", F.shiftrightunsigned("gram", 16))
        contexts = cut(own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")), "lang-contexts")
        seen = own.join(contexts, ["lang", "context"])  # a context has at most 65,536 grams
        tables.append(seen.select("lang", F.lit(2 * order).alias("part"), "gram", (F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total")).cast("float").alias("value")))
        tables.append(contexts.select("lang", F.lit(2 * order + 1).alias("part"), F.col("context").alias("gram"), (d * F.col("types") / F.col("total")).cast("float").alias("value")))
        # the next order counts in how many contexts a gram was seen
        if order > 1:
            counts = cut(counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1)).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    return reduce(DataFrame.union, tables)


def written_models(counts: DataFrame) -> dict[str, KneserNey]:
    """The models of all languages, their tables in files; the driver gets a row for each file."""
    folder = fresh_path(counts.sparkSession, "lang-tables")

    def write(batches):
        store, place = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        store.create_dir(place)
        last, files, made = None, [], []
        for b in batches:
            langs, parts = b.column(0).to_pylist(), b.column(1).to_numpy()
            keys, values = b.column(2).to_numpy().view(U), b.column(3).to_numpy()
            ends = [i for i in range(1, b.num_rows) if langs[i] != langs[i - 1] or parts[i] != parts[i - 1]]
            for lo, hi in zip([0, *ends], [*ends, b.num_rows], strict=True):
                if lo == hi:
                    continue
                if (langs[lo], parts[lo]) != last:
                    for f in files:
                        f.close()
                    last, name = (langs[lo], parts[lo]), uuid.uuid4().hex
                    files = [store.open_output_stream(f"{place}/{name}{end}") for end in (".keys", ".values")]
                    made.append((langs[lo], int(parts[lo]), int(keys[lo : lo + 1].view(np.int64)[0]), f"{folder}/{name}"))
                files[0].write(keys[lo:hi].tobytes())
                files[1].write(values[lo:hi].astype(np.float32).tobytes())
        for f in files:
            f.close()
        cols = list(zip(*made, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.string()), strict=True)], names=["lang", "part", "first", "path"])

    # keys are compared without sign
    order = ["lang", "part", F.col("gram").bitwiseXOR(F.lit(-(1 << 63)))]
    made = model_tables(counts).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidy(write), "lang string, part int, first long, path string").collect()
    found: dict[str, dict[int, list[tuple[int, str]]]] = {}
    for r in made:
        found.setdefault(r["lang"], {}).setdefault(r["part"], []).append((r["first"] % (1 << 64), r["path"]))
    return {lang: KneserNey.of([(_Mapped(parts[2 * k]), _Mapped(parts[2 * k + 1])) for k in range(ORDER, 0, -1)]) for lang, parts in found.items()}


def learn(docs: DataFrame) -> LanguageModel:
    """Models of all languages from the rows of docs (doc_id, text, lang) that aren't held out and have a language."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    models = written_models(cut(gram_counts(rows.where(~calibrates(F.col("doc_id")))), "lang-counts"))
    model = LanguageModel(models)
    if models:
        _calibrate(model, rows.where(calibrates(F.col("doc_id"))))
    return model


def _calibrate(model: LanguageModel, rows: DataFrame) -> None:
    """Limits, spreads and sharpness from sums and quantiles of all calibration rows; the driver gets a row for each language."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)
    losses = [f"loss{s}" for s in SHARPNESS]

    def score(batches):
        own = shipped.value
        known = {x: k for k, x in enumerate(own.langs)}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            h, _, n, square = own.measures(texts, squares=True)
            ok = np.flatnonzero((n > 0) & np.array([x in known for x in langs], bool))
            right = np.array([known[langs[i]] for i in ok], np.int64)
            h, square = h[ok], square[ok]
            mine = h[np.arange(ok.size), right]
            cols = [b.column(0).take(pa.array(ok)), pa.array(np.where(n[ok] >= SURE_LETTERS, mine, np.nan)), pa.array(square[np.arange(ok.size), right] - mine * mine)]
            for s in SHARPNESS:
                e = np.exp(-s * (h - h.min(1, keepdims=True))) if ok.size else h
                cols.append(pa.array(-np.log(1e-12 + e[np.arange(ok.size), right] / e.sum(1))))
            yield pa.RecordBatch.from_arrays(cols, names=["lang", "h", "v", *losses])

    try:
        scored = rows.select("lang", "text").mapInArrow(tidy(score, lambda: shipped.value.forget()), "lang string, h double, v double, " + ", ".join(f"{c} double" for c in losses))
        h = F.when(~F.isnan("h"), F.col("h"))
        aggs = [F.count(h).alias("sure"), F.max(h).alias("most"), F.percentile_approx(h, 1 - FALSE_REJECTS, 100_000).alias("q"), F.avg("v").alias("v"), F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in losses]]
        found = scored.groupBy("lang").agg(*aggs).collect()
    finally:
        shipped.destroy()
    for r in found:
        k = model.langs.index(r["lang"])
        if r["sure"]:
            model.limit[k] = r["q"] if r["sure"] * FALSE_REJECTS >= 1 else 1.1 * r["most"]
        model.spread[k] = math.sqrt(max(0.0, r["v"]))
    if found:
        model.sharpness = float(min(SHARPNESS, key=lambda s: sum(r[f"loss{s}"] for r in found)))


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    shipped = docs.sparkSession.sparkContext.broadcast(model or learn(own))

    def run(batches):
        for b in batches:
            cols = list(zip(*shipped.value.predict(b.column(2).to_pylist()), strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": pa.array(cols[0], pa.string()), "score": pa.array(cols[1], pa.float64()), "rejected": pa.array(cols[2], pa.bool_())})

    rows = own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(tidy(run, lambda: shipped.value.forget()), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs that aren't rejected, with all their columns; texts stay where they are scanned."""
    shipped = docs.sparkSession.sparkContext.broadcast(learn(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))))
    place = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([not x[2] for x in shipped.value.predict(b.column(place).to_pylist())], pa.bool_()))

    return docs.mapInArrow(tidy(run, lambda: shipped.value.forget()), docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
