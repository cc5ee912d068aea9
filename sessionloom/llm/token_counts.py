"""Operator 6: token counts by compiled finite-state transducers.

Two deterministic machines work in cascade. The first reads character kinds and marks where the pre-tokenizer's pieces
begin; its table is compiled here from the pattern's cases, with one or two characters of delay where the pattern looks
ahead (white space before a word, contractions). A text is read in chunks of equal length: each chunk gives the map from
every entry state to its exit state, the maps are composed by a parallel prefix scan (doubling steps), and with its entry
state known each chunk is read again for the marks. So all chunks of all texts of a batch advance together.

The second machine reads the bytes of a piece. Its transitions carry the change in the number of tokens: a state holds,
for each suffix that can still grow into a longer token, the token before it and the count up to it; the next byte ends
exactly one token that is compatible with the token before it (the pair, merged again from bytes, gives itself). States
are compiled when first reached and are kept in a bounded table, as are the counts of whole pieces. Pieces of more than LONG_PIECE bytes are cut into chunks too, whose maps are taken at
the states that come in and composed (`chunked`).

Spark side: one narrow `mapInArrow`, no shuffle; the vocabulary is a broadcast of fixed size.

Defined results: null counts as empty; empty texts have no bytes and no tokens; a special token's string counts as one
token, as the library does by default; repeated rows are counted each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm.common import own_columns, table, text_slices, tidy, tokenizer_bytes
from sessionloom.llm.word_bpe import byte_letters

LIMIT = 512
CHUNK = 256
MEMO_PIECES = 400_000
MEMO_STATES = 150_000
PIECE_CHUNK, WARM = 1024, 64
LONG_PIECE = 4 * PIECE_CHUNK

# kinds of characters; END stands between texts
SPACE, WHITE, LETTER, DIGIT, OTHER, QUOTE, STMD, RV, E, L, END = range(11)
KINDS = 11
# states after a character; each but START says what the piece in progress looks like
START, SP, WS, RUN_SP, RUN_WS, LET, DIG, OTH, QUO, QUO_RV, QUO_L = range(11)
STATES = 11
BEGIN, BEGIN_BEFORE = 1, 2  # a piece begins at this character; at the one before


def _word_state(kind: int, after_space: bool) -> int:
    if kind == DIGIT:
        return DIG
    if kind == QUOTE:
        return OTH if after_space else QUO
    return OTH if kind == OTHER else LET


def compile_pieces() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by (state, kind), for 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?others|white space."""
    go, out = np.zeros((STATES, KINDS), np.int8), np.zeros((STATES, KINDS), np.int8)
    for s in range(STATES):
        for k in range(KINDS):
            white, letter = k in (SPACE, WHITE), k in (LETTER, STMD, RV, E, L)
            late = BEGIN_BEFORE if s in (QUO_RV, QUO_L) else 0  # 'r or 'l that no e or l follows: the quote was a piece
            if k == END:
                to, mark = START, late
            elif s in (SP, WS, RUN_SP, RUN_WS) and white:
                to, mark = (RUN_SP if k == SPACE else RUN_WS), 0
            elif white:
                to, mark = (SP if k == SPACE else WS), BEGIN | late
            elif s in (SP, RUN_SP):  # the last space goes with the word
                to, mark = _word_state(k, True), BEGIN_BEFORE if s == RUN_SP else 0
            elif s in (WS, RUN_WS):
                to, mark = _word_state(k, False), BEGIN | (BEGIN_BEFORE if s == RUN_WS else 0)
            elif s == QUO and k == STMD or s == QUO_RV and k == E or s == QUO_L and k == L:
                to, mark = START, 0
            elif s == QUO and k in (RV, L):
                to, mark = (QUO_RV if k == RV else QUO_L), 0
            elif s in (QUO, OTH) and k in (OTHER, QUOTE):
                to, mark = OTH, 0
            elif s in (LET, QUO_RV, QUO_L) and letter:
                to, mark = LET, late
            elif s == DIG and k == DIGIT:
                to, mark = DIG, 0
            else:
                to, mark = _word_state(k, False), BEGIN | late
            go[s, k], out[s, k] = to, mark
    return go, out


@lru_cache(maxsize=1)
def kinds_of_characters() -> np.ndarray:
    """The kind of every code point, by its Unicode category."""
    by_class = {"L": LETTER, "N": DIGIT, "Z": WHITE}
    out = np.array([by_class.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.int8)
    out[[*range(9, 14), 0x85]] = WHITE
    out[32], out[39] = SPACE, QUOTE
    for letters, kind in (("stmd", STMD), ("rv", RV), ("e", E), ("l", L)):
        out[[ord(x) for x in letters]] = kind
    return out


class TokenCounter:
    def __init__(self, data: bytes):
        spec = json.loads(data)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["model"]["ignore_merges"]:
            raise ValueError("only byte-level tokenizers without normaliser are supported")
        self.special = [x["content"] for x in spec["added_tokens"]]
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.go, self.out = compile_pieces()
        back = {c: b for b, c in byte_letters().items()}
        raw = lambda t: bytes(back[c] for c in t)
        self.rank = {(raw(a), raw(b)): r for r, (a, b) in enumerate(spec["model"]["merges"])}
        tokens = [raw(t) for t in spec["model"]["vocab"] if all(c in back for c in t)]
        self.tokens = {t for t in tokens if self.merge(t) == [t]}
        self.opens = {t[:k] for t in self.tokens for k in range(len(t))}  # proper prefixes, the empty one included
        self.pair_ok: dict[tuple[bytes, bytes], bool] = {}
        self.memo: dict[str, int] = {}
        self._forget_states()

    def _forget_states(self) -> None:
        # a state: for each open suffix, longest first: (suffix, token before it or None, tokens since it)
        first = ((b"", None, 0),)
        self.states, self.number, self.arrows = [first], {first: 0}, [{}]

    def merge(self, t: bytes) -> list[bytes]:
        parts = [t[k : k + 1] for k in range(len(t))]
        while len(parts) > 1:
            r, k = min((self.rank.get((a, b), 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if r == 1 << 30:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def fits(self, a: bytes, b: bytes) -> bool:
        found = self.pair_ok.get((a, b))
        if found is None:
            if len(self.pair_ok) > 1_000_000:
                self.pair_ok.clear()
            found = self.pair_ok[a, b] = self.merge(a + b) == [a, b]
        return found

    def arrow(self, s: int, byte: int) -> tuple[int, int]:
        """Compile one transition: the next state and the change in the count."""
        c = bytes((byte,))
        last, change = None, 0
        for suffix, before, since in self.states[s]:
            t = suffix + c
            if t in self.tokens and (before is None or self.fits(before, t)):
                last, change = t, 1 - since
                break
        made = [(suffix + c, before, since + change) for suffix, before, since in self.states[s] if suffix + c in self.opens]
        state = (*made, (b"", last, 0))
        n = self.number.get(state)
        if n is None:
            n = self.number[state] = len(self.states)
            self.states.append(state)
            self.arrows.append({})
        found = self.arrows[s][byte] = (n, change)
        return found

    def walk(self, s: int, data: bytes) -> tuple[int, int]:
        """The state after data, and the change in the count, from state s."""
        arrows, total = self.arrows, 0
        for byte in data:
            a = arrows[s].get(byte)
            if a is None:
                a = self.arrow(s, byte)
            s = a[0]
            total += a[1]
        return s, total

    def piece(self, data: bytes) -> int:
        total = self.walk(0, data)[1] if len(data) <= LONG_PIECE else self.chunked(data)
        if len(self.states) > MEMO_STATES:
            self._forget_states()
        return total

    def chunked(self, data: bytes) -> int:
        """The count of a long piece by maps of its chunks.

        All chunks advance together, each from the state that the bytes before it lead to (from the start state, WARM bytes back), which gives one entry of its map: entry state, exit state and count.
        Neighbours compose where an exit is the next one's entry; where it isn't, the chunk's map is taken at the state that does come in. Counts of composed maps add up.
        """
        n = -(-len(data) // PIECE_CHUNK)
        grid = np.frombuffer(data.ljust(n * PIECE_CHUNK, b"\0"), np.uint8).reshape(n, PIECE_CHUNK).T.astype(np.int64)
        state = np.zeros(n, np.int64)

        def advance(column: np.ndarray, at: np.ndarray) -> np.ndarray:
            pair, back = np.unique(state[at] << 8 | column[at], return_inverse=True)
            found = [self.arrows[p >> 8].get(p & 255) or self.arrow(p >> 8, p & 255) for p in pair.tolist()]
            found = np.array(found, np.int64).reshape(-1, 2)[back]
            state[at] = found[:, 0]
            return found[:, 1]

        later = np.arange(1, n)
        for j in range(PIECE_CHUNK - WARM, PIECE_CHUNK):  # the end of the chunk before
            advance(np.append(0, grid[j, :-1]), later)
        entry, count = state.copy(), np.zeros(n, np.int64)
        for j in range(PIECE_CHUNK):
            at = np.arange(n) if j < len(data) - (n - 1) * PIECE_CHUNK else np.arange(n - 1)
            count[at] += advance(grid[j], at)
        for k in range(1, n):
            if entry[k] != state[k - 1]:
                state[k], count[k] = self.walk(int(state[k - 1]), data[k * PIECE_CHUNK : (k + 1) * PIECE_CHUNK])
        return int(count.sum())

    def marks(self, kind: np.ndarray) -> np.ndarray:
        """Marks of a stream of kinds, by chunk maps and a prefix scan over them."""
        n = -(-kind.size // CHUNK)
        grid = np.full(n * CHUNK, END, np.int8)
        grid[: kind.size] = kind
        columns = np.ascontiguousarray(grid.reshape(n, CHUNK).T).astype(np.intp)
        go, out = self.go.ravel(), self.out.ravel()
        maps = np.tile(np.arange(STATES, dtype=np.int8), (n, 1))
        for column in columns:
            maps = go[maps * np.int16(KINDS) + column[:, None]]
        d = 1
        while d < n:  # after this step a map spans 2 * d chunks
            maps[d:] = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), 1)
            d *= 2
        state = np.append(START, maps[:-1, START]).astype(np.intp)
        marks = np.empty((CHUNK, n), np.int8)
        for j, column in enumerate(columns):
            at = state * KINDS + column
            marks[j] = out[at]
            state = go[at].astype(np.intp)
        return marks.T.ravel()[: kind.size]

    def counts(self, texts: list[str | None]) -> list[int]:
        parts, owner, totals = [], [], [0] * len(texts)
        for i, t in enumerate(texts):
            found = [t or ""]
            for x in self.special:
                if t and x in t:
                    found = [y for z in found for y in z.split(x)]
            totals[i] = sum(t.count(x) for x in self.special) if len(found) > 1 else 0
            parts += found
            owner += [i] * len(found)
        text = "\0".join(parts) + "\0"
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds_of_characters()[code]
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        kind[ends] = END
        marks = self.marks(kind)
        begins = (marks & BEGIN) > 0
        begins[:-1] |= (marks[1:] & BEGIN_BEFORE) > 0
        # a piece runs from its begin to the next begin or to its text's end
        at = np.flatnonzero(begins | (kind == END))
        starts = at[kind[at] != END]
        stops = at[np.flatnonzero(kind[at] != END) + 1]
        words = [text[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        memo = self.memo
        for w in set(words).difference(memo):
            memo[w] = self.piece(w.encode("utf-8"))
        each = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        for i, n in zip(owner, np.diff(np.append(0, np.append(0, np.cumsum(each))[np.searchsorted(starts, ends)])).tolist(), strict=True):
            totals[i] += n
        return totals


@lru_cache(maxsize=2)
def counter(data: bytes) -> TokenCounter:
    return TokenCounter(data)


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_bytes(tokenizer))

    def run(batches):
        c = counter(shipped.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = [x for lo, hi in text_slices(texts) for x in c.counts(texts[lo:hi])]
            size = [len(t.encode("utf-8")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_bytes": pa.array(size, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([x > limit for x in n], pa.bool_())})

    return own_columns(docs, {"doc_id": "long", "text": "string"}).mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
