"""Operator 1: SentencePiece (merge type) encoding and decoding.

Encoding: the vocabulary's pieces go into an Aho-Corasick automaton, which finds the longest piece starting at each
position. Tokens are taken longest first; a token may follow another only if the pair is compatible, i.e. merging the
pair's joined string from single characters gives back exactly these two tokens (each pair is re-merged once and
remembered). A position from which no continuation exists is marked in a bitfield, and the search steps back. A
sequence whose neighbours are all compatible is the merge result, so this equals the library's ids.

No piece has a space mark after another character (checked when the model is loaded), so merges never cross the start of
a run of space marks: a text is encoded unit by unit (spaces plus the word after them), and repeated units are
remembered in a bounded memo. Characters outside the vocabulary are cut out and given as byte tokens.

Spark side: one narrow `mapInArrow`; no shuffle, the model travels as a broadcast of fixed size (the vocabulary file).

Defined results: null text counts as empty; empty text has no tokens and decodes to the empty string; repeated rows are
kept as they are; an empty table gives an empty table; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm.common import own_columns, table, text_slices, tokenizer_bytes

MARK = "▁"
#: Units and token pairs remembered in a worker, so memory is bounded.
MEMO_UNITS = 500_000
MEMO_PAIRS = 2_000_000


#: The kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def piece_kinds(model: bytes) -> list[int]:
    """The kind of each piece of a model file, a protocol buffer whose field 1 holds the pieces, with the kind in their field 3."""

    def fields(data: bytes):
        at = 0

        def number() -> int:
            nonlocal at
            out = shift = 0
            while True:
                byte = data[at]
                at += 1
                out |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return out

        while at < len(data):
            key = number()
            kind, value = key & 7, None
            if kind == 0:
                value = number()
            else:
                size = number() if kind == 2 else 8 if kind == 1 else 4
                value = data[at : at + size]
                at += size
            yield key >> 3, value

    return [next((v for f, v in fields(piece) if f == 3), NORMAL) for field, piece in fields(model) if field == 1]


class PieceCodec:
    """Ids of a merge-type model from its own pieces and scores; the library only reads the file."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        if {USER_DEFINED, UNUSED} & set(piece_kinds(model)):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unk, self.control = sp.unk_id(), {i for i in range(n) if sp.is_control(i)}
        self.byte_id = {int(self.pieces[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.special = self.control | set(self.byte_of) | {self.unk}
        if sp.normalize(" Å a") != MARK * 2 + "Å" + MARK + "a":
            raise ValueError("only models with the identity normaliser and a space before the text are supported")
        self.rank = {p: (-sp.get_score(i), i) for i, p in enumerate(self.pieces) if i not in self.special}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has a space mark after another character")
        self.chars = {p for p in self.rank if len(p) == 1}
        # pieces that merging can't build never occur in a result
        self.match = ahocorasick.Automaton()
        self.id_of = {p: i for p, (_, i) in self.rank.items() if self.merge(p) == [p]}
        for p, i in self.id_of.items():
            self.match.add_word(p, (i, len(p) - 1))
        self.match.make_automaton()
        self.shorter: dict[int, int | None] = {}  # the longest token that is a proper prefix
        for p, i in self.id_of.items():
            self.shorter[i] = next((self.id_of[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id_of), None)
        self.length = [len(p) for p in self.pieces]
        self.decimal = [str(i) for i in range(n)]
        self.pair_ok: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, s: str) -> list[str]:
        """Merging by definition, for strings of at most two pieces: the best score first, the leftmost on ties."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = self.rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r[0] < best):
                    best, at = r[0], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether b may follow a: merging both strings joined gives these two tokens back."""
        p, q = self.pieces[a], self.pieces[b]
        if len(self.pair_ok) >= MEMO_PAIRS:
            self.pair_ok.clear()
        found = self.pair_ok[a << 32 | b] = self.merge(p + q) == [p, q]
        return found

    def known(self, s: str) -> list[int]:
        """Ids of a string of known characters, by backtracking."""
        n = len(s)
        longest = [0] * n
        for end, (i, back) in self.match.iter(s):
            longest[end - back] = i  # ends ascend, so the longest match from a start comes last
        failed, tokens, pos, last = bytearray((n >> 3) + 1), [], 0, -1  # a bit for each position
        pair_ok, length, shorter = self.pair_ok, self.length, self.shorter
        token = longest[0]
        while True:
            while token is not None:
                end = pos + length[token]
                if not failed[end >> 3] >> (end & 7) & 1:
                    ok = last < 0 or pair_ok.get(last << 32 | token)
                    if ok or (ok is None and self.fits(last, token)):
                        break
                token = shorter[token]
            if token is None:
                failed[pos >> 3] |= 1 << (pos & 7)  # no way on from here
                token = tokens.pop()
                pos -= length[token]
                last = tokens[-1] if tokens else -1
                continue
            tokens.append(token)
            if end == n:
                return tokens
            pos, last = end, token
            token = longest[pos]

    def unit(self, s: str) -> tuple[int, ...]:
        """Ids of a unit without its first space mark."""
        s = MARK + s.replace(" ", MARK)
        if set(s) <= self.chars:
            return tuple(self.known(s))
        out: list[int] = []
        start = 0
        for k in range(len(s) + 1):
            if k == len(s) or s[k] not in self.chars:
                if k > start:
                    out += self.known(s[start:k])
                if k < len(s):
                    out += [self.byte_id[b] for b in s[k].encode("utf-8")] if self.byte_id else [self.unk]
                start = k + 1
        return tuple(out)

    def units(self, text: str) -> list[str]:
        text = text.replace(MARK, " ")
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return [u[1:] for u in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def learn(self, texts: list[list[str]]) -> None:
        """Fill the memo for all units of these texts; it holds MEMO_UNITS units besides one slice's own."""
        if len(self.memo) > MEMO_UNITS:
            self.memo.clear()
        for u in set(chain.from_iterable(texts)).difference(self.memo):
            self.memo[u] = self.unit(u)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        units = self.units(text)
        self.learn([units])
        return list(chain.from_iterable(map(self.memo.__getitem__, units)))

    def decode(self, ids: list[int]) -> str:
        if self.special.isdisjoint(ids):
            text = "".join(map(self.pieces.__getitem__, ids)).replace(MARK, " ")
            return text[1:] if text[:1] == " " else text
        out, held, first = [], bytearray(), True
        for i in chain(ids, [-1]):
            if i in self.byte_of:
                held.append(self.byte_of[i])
                first = False
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i < 0 or i in self.control:
                continue
            piece = " ⁇ " if i == self.unk else self.pieces[i].replace(MARK, " ")
            out.append(piece[1:] if first and i != self.unk and piece[:1] == " " else piece)
            first = False
        return "".join(out)


def _utf8(data: bytes) -> str:
    """Each byte that isn't part of a valid sequence becomes one replacement character."""
    out, k = [], 0
    while k < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[k : k + n].decode("utf-8"))
                k += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    return PieceCodec(model)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with keep_ids, the ids and the decoded text."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_bytes(model))

    def run(batches):
        c = codec(shipped.value)
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            cols: list[list] = [[], [], [], [], []]
            for lo, hi in text_slices(texts):
                units = [c.units(t) if t else [] for t in texts[lo:hi]]
                c.learn(units)
                for u in units:
                    got = list(chain.from_iterable(map(c.memo.__getitem__, u)))
                    text = c.decode(got)
                    cols[0].append(len(got))
                    cols[1].append(_sha(",".join(map(c.decimal.__getitem__, got))))
                    cols[2].append(_sha(text))
                    if keep_ids:
                        cols[3].append(got)
                        cols[4].append(text)
            out = {"doc_id": ids, "n_tokens": pa.array(cols[0], pa.int64()), "ids_sha256": pa.array(cols[1], pa.string()), "decoded_sha256": pa.array(cols[2], pa.string())}
            if keep_ids:
                out |= {"ids": pa.array(cols[3], pa.list_(pa.int32())), "decoded": pa.array(cols[4], pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")
    return own_columns(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, schema)


def decode(rows: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, decoded of rows (doc_id, ids array<int>); null ids decode to the empty string."""
    shipped = rows.sparkSession.sparkContext.broadcast(tokenizer_bytes(model))

    def run(batches):
        c = codec(shipped.value)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "decoded": pa.array([c.decode([i for i in x or [] if i is not None]) for x in b.column(1).to_pylist()], pa.string())})

    return own_columns(rows, {"doc_id": "long", "ids": "array<int>"}).mapInArrow(run, "doc_id long, decoded string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), keep_ids=False)
