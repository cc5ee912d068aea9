"""Operator 11: a quality classifier by hashed word n-grams and logistic regression trained with follow-the-regularised-leader.

Words are runs of ASCII letters, digits and bytes beyond ASCII, and runs of other printable characters; case counts. Words and
pairs of neighbouring words are hashed to 2^BITS places; pairs of a word with itself share one, so that repetition counts whatever the
word. A text with n of these n-grams has the value SCALE * count / (n + SCALE) in
each place, so a score doesn't depend on a text's length, and very short texts stay near the prior; one more weight is the bias.

The labelled rows are a bounded sample (FIT_ROWS ids with the least hashes), dealt to shards of SHARD_ROWS rows. Each shard is one
pass of FTRL-Proximal (ALPHA, BETA, L1, L2) in the order of the ids' hashes; the shards' weights are averaged, so what a shard sees is
alike at every size. The driver and the workers hold the averaged weights alone: 2^BITS + 1 numbers. Scores are sparse dot products over
every whole text, where it is scanned: no text outside the sample is shuffled.

Defined results: null texts count as empty; texts without a word get the bias alone; with nothing to learn from every score is 0.5;
labels with a null id or quality aren't learned from, of repeated ones the largest counts; a repeated labelled document is learned once (its
least text); a null doc_id isn't held out; repeated rows are scored each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import scratch, table, text_slices, tidy
from sessionloom.llm.shingles import _BYTE, _PLACE, _STEP, U, mix

BITS = 18
SCALE = 32.0
FIT_ROWS = 40_000
SHARD_ROWS = 10_000
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.02, 0.1
THRESHOLD = 0.3
LONG = 1_000_000

_KIND = np.zeros(256, np.uint8)  # 0 between words, 1 in words, 2 in runs of other characters
_KIND[33:127] = 2
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def places(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The places of all n-grams, text after text, and where each text's begin (and the end)."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    text_end = np.cumsum([len(r) + 1 for r in raw]) - 1
    kind = _KIND[data]
    edge = np.append(True, kind[1:] != kind[:-1])
    at = np.flatnonzero(edge)
    size = np.diff(np.append(at, data.size))
    # a run's hash: bytes times powers of an odd step, summed, then mixed
    power = np.ones(int(size.max()), U)
    power[1:] = _STEP
    offset = np.arange(data.size) - np.repeat(at, size)
    word = mix(np.add.reduceat(_BYTE[data] * np.multiply.accumulate(power)[offset], at) ^ size.astype(U))
    inside = kind[at] > 0
    word, owner = word[inside], np.searchsorted(text_end, at[inside])
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    both = np.where(word[pair] == word[pair + 1], _PLACE[2], word[pair] * _PLACE[0] + word[pair + 1] * _PLACE[1])
    grams = np.concatenate([word, mix(both)])
    owner = np.concatenate([owner, owner[pair]])
    order = np.argsort(owner, kind="stable")
    return (grams[order] >> U(64 - BITS)).astype(np.int64), np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts))))


def _kind_of(c: str) -> int:
    return 1 if ord(c) > 127 else int(_KIND[ord(c)])


def parts(texts: list[str | None]):
    """(first text, places, where each text's begin) of runs of texts. A very long text comes in several parts that end at a space; each begins with the last word of the part before, for its pair."""
    for lo, hi in text_slices(texts, LONG):
        text = texts[lo] or ""
        if hi > lo + 1 or len(text) <= LONG:
            yield lo, *places(texts[lo:hi])
            continue
        begin, carried = 0, ""
        while begin < len(text):
            end = text.find(" ", begin + LONG)
            end = len(text) if end < 0 else end
            found, ends = places([carried + text[begin:end]])
            yield lo, *((found[1:], ends - np.array([0, 1])) if carried else (found, ends))  # the carried word is counted already
            stop = end
            while stop > begin and not _kind_of(text[stop - 1]):
                stop -= 1
            if stop > begin:  # a part without a word hands on what it was handed
                start = stop - 1
                while start > begin and _kind_of(text[start - 1]) == _kind_of(text[start]):
                    start -= 1
                carried = text[start:stop] + " "
            begin = end


def each_text(texts: list[str | None]):
    """(text's number, its places) in order."""
    at, held = None, []
    for lo, found, ends in parts(texts):
        for k in range(ends.size - 1):
            if lo + k != at:
                if at is not None:
                    yield at, np.concatenate(held)
                at, held = lo + k, []
            held.append(found[ends[k] : ends[k + 1]])
    if at is not None:
        yield at, np.concatenate(held)


class Ftrl:
    """FTRL-Proximal over sparse rows; the last weight is the bias."""

    def __init__(self, size: int = (1 << BITS) + 1):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + math.exp(-max(-500.0, min(500.0, float(w @ x))))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def values(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and values of one text, the bias last."""
    at, count = np.unique(found, return_counts=True)
    return np.append(at, 1 << BITS), np.append(SCALE * count / (count.sum() + SCALE), 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The weights from docs (doc_id, text) and labels (doc_id, quality) that aren't held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    with scratch(docs.sparkSession) as keep:
        picked = keep(known.withColumn("h", F.xxhash64("doc_id", F.lit("quality"))).orderBy("h", "doc_id").limit(FIT_ROWS), "quality-sample")
        shards = max(1, math.ceil(picked.count() / SHARD_ROWS))
        # ids and labels of FIT_ROWS rows at most are broadcast
        met = docs.join(F.broadcast(picked), "doc_id").withColumn("shard", F.pmod("h", F.lit(shards))).repartition(shards, "shard")
        once = met.groupBy("shard", "h", "doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        dealt = once.sortWithinPartitions("shard", "h", "doc_id").select("shard", "label", "text")

        def train(batches):
            shard, model = None, Ftrl()

            def done():
                w = model.weights()
                at = np.flatnonzero(w)
                return pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["at", "w"])

            for b in batches:
                shard_of, label, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
                for i, found in each_text(texts):
                    if shard_of[i] != shard and shard is not None:
                        yield done()
                        model = Ftrl()
                    shard = shard_of[i]
                    model.learn(*values(found), label[i])
            if shard is not None:
                yield done()

        found = dealt.mapInArrow(tidy(train), "at long, w double").groupBy("at").agg((F.sum("w") / shards).alias("w")).toArrow()  # a number for each place at most
    out = np.zeros((1 << BITS) + 1, np.float32)
    out[found.column("at").to_numpy()] = found.column("w").to_numpy()
    return out


def scores(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for lo, found, ends in parts(texts):
        here = np.flatnonzero(np.diff(ends))
        if here.size:
            total[lo + here] += np.add.reduceat(weights[found], ends[here], dtype=np.float64)
        n[lo : lo + ends.size - 1] += np.diff(ends)
    return 1 / (1 + np.exp(-np.clip(weights[-1] + SCALE * total / (n + SCALE), -500, 500)))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, weights: np.ndarray | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shipped = docs.sparkSession.sparkContext.broadcast(learn(own, labels) if weights is None else weights)

    def run(batches):
        for b in batches:
            s = scores(b.column(2).to_pylist(), shipped.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
