"""Word shingles of many texts at once, as 64-bit hashes (numpy, inside tasks), and filters of fixed size."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 5
U = np.uint64
_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
_STEP = U(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A text of more characters is read in parts, so that working memory follows its longest word and its set, not its length.
LONG = 400_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")


def _long_set(text: str, words: int) -> np.ndarray:
    """The shingles of one long text, from parts that end between words and begin with the last words of the part before."""
    found, carried, lo, hi = [np.empty(0, U)], "", 0, 0
    while hi < len(text):
        cut = _SPACE.search(text, max(hi + 1, min(lo + LONG, len(text))))
        hi = cut.start() if cut else len(text)
        part = carried + text[lo:hi]
        starts = [m.start() for m in _WORD.finditer(part)]
        if len(starts) < words and hi < len(text):
            continue  # fewer words than a shingle has: more of the text belongs to them
        if len(starts) >= words or lo == 0:
            found.append(_sets([part], words)[0])
            found = [np.unique(np.concatenate(found))]
        carried, lo = part[starts[1 - words] :] + " " if len(starts) >= words else "", hi
    return found[-1]


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each text, and where each text's hashes start (and the end)."""
    if len(texts) == 1 and len(texts[0] or "") > LONG:
        h = _long_set(texts[0], words)
        return h, np.array([0, h.size])
    return _sets(texts, words)


def _sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """What shingle_sets returns.

    A-Z are lower-cased; words are runs without space, tab, line feed, vertical tab, form feed, return. Fewer words than
    `words` make one shingle; no words make none.
    """
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    text_end = np.cumsum([len(r) + 1 for r in raw]) - 1
    white = _WHITE[data]
    inside = ~white
    start = np.flatnonzero(inside & np.append(True, white[:-1]))
    if not start.size:
        return np.empty(0, U), np.zeros(len(texts) + 1, np.int64)
    stop = np.flatnonzero(inside & np.append(white[1:], True)) + 1
    size = stop - start
    # a word's hash: bytes times powers of an odd step, summed (differences of running sums), then mixed
    at = np.arange(data.size) - np.repeat(start, np.diff(np.append(start, data.size))) if start[0] == 0 else np.maximum(np.arange(data.size) - np.repeat(np.append(0, start), np.diff(np.concatenate([[0], start, [data.size]]))), 0)
    power = np.ones(int(at.max()) + 1, U)
    power[1:] = _STEP
    power = np.multiply.accumulate(power)
    term = _BYTE[data] * power[at]
    term[white] = 0
    word = mix(np.add.reduceat(term, start) ^ size.astype(U))
    text_of = np.searchsorted(text_end, start)
    per_text = np.bincount(text_of, minlength=len(texts))
    first_word = np.append(0, np.cumsum(per_text))
    # windows of `words` words that stay in their text; shorter texts as one window
    n = word.size
    last = np.repeat(first_word[1:], per_text)
    here = np.arange(n)
    full = here + words <= last
    total = np.zeros(n, U)
    for k in range(words):
        total[: max(n - k, 0)] += word[k:] * _PLACE[k]
    short = np.flatnonzero((per_text > 0) & (per_text < words))
    keep = full.copy()
    for k in range(words - 1):
        pick = short[per_text[short] > k]
        w = first_word[pick]
        if k == 0:
            total[w] = U(0)
            keep[w] = True
        total[w] += word[w + k] * _PLACE[k] + U(k + 1)
    shingle, owner = mix(total[keep]), text_of[keep]
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    new = np.append(True, (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1]))
    shingle, owner = shingle[new], owner[new]
    return shingle, np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts))))


#: Bits of a filter: 8 MB, whatever the number of keys. A fuller filter lets more through and loses nothing.
FILTER_BITS = 26


def key_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of 2^bits bits over a long column, merged by Spark as 64-bit words; see `may_hold`."""
    places = F.explode(F.array(*[F.shiftrightunsigned(F.xxhash64(F.col(column).cast("long"), F.lit(k)), 64 - bits) for k in range(2)]))
    words = keys.select(places.alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("v"))
    got = words.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()  # at most 2^(bits - 6) rows
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got.column("w").to_numpy()] = got.column("v").to_numpy()
    return out.view(np.uint64)
