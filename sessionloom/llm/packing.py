"""Operator 10: best-fit packing of token pieces into sequences by large-item matching.

A document is its ids and an end id; a longer one is cut into pieces of the capacity. Pieces above a third of the
capacity pair at most twice per sequence: from the longest down, each takes the longest free partner that fits. The
others then go, from the longest down, each into the fullest sequence that still has room, else into a new one.

Equal lengths are interchangeable, so the plan needs only how many pieces have each length: at most `capacity` counts,
whatever the size of the corpus. `plan` packs counts, not pieces. A range of sequences with equal room is moved at once and
its room at least halves each time, so the plan stays under about 2 * capacity * log2(capacity) rows; both are broadcast.
Each piece then finds its place from its length and its number among the pieces of that length. That number comes from
row_number within (length, one of SALTS hash parts) and running counts of the parts, so a length that many pieces
share is not one task's work.

Shuffle: the narrow piece rows only (texts are tokenised in the scan, never shuffled); pieces are written once to the
shared folder, so the texts are tokenised once.

Defined results: null or empty text is the end id alone (one piece of length 1); repeated rows are packed as often as
they occur; an empty table gives no rows; further columns are ignored here and kept by `pack_rows`.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, own_columns, table, text_slices, tidy, tokenizer_bytes
from sessionloom.llm.word_bpe import word_bpe

CAPACITY = 4096
END_ID = 1
SALTS = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_bytes(tokenizer))
    end = end_id.to_bytes(4, "little")

    def run(batches):
        bpe = word_bpe(shipped.value)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                rows: list[tuple] = []
                for doc, data in zip(ids[lo:hi], bpe.encode_bytes(texts[lo:hi]), strict=True):
                    data += end
                    for k in range(0, len(data), 4 * capacity):
                        part = data[k : k + 4 * capacity]
                        rows.append((doc, k // (4 * capacity), k // 4, len(part) // 4, crc32(part)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(cols[0], pa.int64()), "piece": pa.array(cols[1], pa.int32()), "start": pa.array(cols[2], pa.int64()), "length": pa.array(cols[3], pa.int64()), "ids_crc32": pa.array(cols[4], pa.int64())})

    return own_columns(docs, {"doc_id": "long", "text": "string"}).mapInArrow(tidy(run, lambda: word_bpe(shipped.value).forget()), PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first number, pieces, first sequence, pieces per sequence, offset): where the pieces of a length go.

    Piece number first + j lies in sequence (first sequence + j // per) at offset + (j % per) * length.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    given = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences (first, number)
    rooms: list[int] = []  # the keys of room, ascending
    opened = 0

    def put(length: int, number: int, first: int, per: int, offset: int) -> None:
        out.append((length, given[length], number, first, per, offset))
        given[length] += number
        left[length] -= number

    def free(space: int, first: int, number: int) -> None:
        if space and number:
            if space not in room:
                room[space] = []
                insort(rooms, space)
            room[space].append((first, number))

    large = sorted(n for n in left if 3 * n > capacity)
    for a in reversed(large):
        while left[a]:
            k = bisect_left(large, min(a, capacity - a) + 1) - 1
            while k >= 0 and left[large[k]] < (2 if large[k] == a else 1):
                k -= 1
            if k < 0:
                m, used = left[a], a
                put(a, m, opened, 1, 0)
            elif large[k] == a:
                m, used = left[a] // 2, 2 * a
                put(a, 2 * m, opened, 2, 0)
            else:
                b = large[k]
                m, used = min(left[a], left[b]), a + b
                put(a, m, opened, 1, 0)
                put(b, m, opened, 1, a)
            free(capacity - used, opened, m)
            opened += m
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            k = bisect_left(rooms, n)
            if k == len(rooms):
                free(capacity, opened, number := -(-left[n] // (capacity // n)))
                opened += number
                k = len(rooms) - 1
            space = rooms[k]
            first, number = room[space].pop()
            if not room[space]:
                del room[space], rooms[k]
            per, offset = space // n, capacity - space
            full = min(number, left[n] // per)
            if full:
                put(n, full * per, first, per, offset)
                free(space - per * n, first, full)
            if full < number and left[n]:
                m = left[n]
                put(n, m, first + full, m, offset)
                free(space - m * n, first + full, 1)
                full += 1
            free(space, first + full, number - full)
    return np.array(out, np.int64).reshape(-1, 6)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    rows = cut(pieces(docs, tokenizer, capacity, end_id).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int")), "pack-pieces")
    parts = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = cut(parts.withColumn("before", before), "pack-parts")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = plan(counts, capacity)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    shipped = spark.sparkContext.broadcast(places)

    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    numbered = rows.withColumn("within", within).join(parts.drop("n"), ["length", "salt"]).withColumn("number", F.col("before") + F.col("within") - 1)

    def place(batches):
        p = shipped.value
        key = p[:, 0] << 45 | p[:, 1]
        for b in batches:
            length, number = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = p[np.searchsorted(key, length << 45 | number, side="right") - 1]
            j = number - at[:, 1]
            sequence, offset = at[:, 3] + j // at[:, 4], at[:, 5] + j % at[:, 4] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, PIECES + ", sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
