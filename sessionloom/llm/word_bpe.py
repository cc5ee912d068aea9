"""Ids of a lower-casing word-end BPE for many words at once.

Words between ASCII spaces are independent under this tokenizer (white space is dropped before splitting). Texts of
ASCII and Latin-1 letters are lower-cased and split here, and all their new words are merged together with numpy, one best
pair per word and round; every other word goes to the library itself. Ids of words are remembered in a bounded memo.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

MEMO_WORDS = 150_000
LONGEST_PIECE = 100
NONE = np.iinfo(np.int64).max
#: Fixed value: what the tokenizer's file must say for the split made here to hold.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters handled here, as Latin-1 bytes: ASCII from the space to the tilde, tab, line ends, letters from A-grave on.
SAFE = bytes([9, 10, 13, *range(32, 127), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])
LOWER = bytes(32 if c in (9, 10, 13) else c + 32 if 65 <= c <= 90 or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
#: Kinds of Latin-1 bytes: 0 space, 1 letter, 2 digit, 3 other.
KIND = np.array([0 if c == 32 else 1 if 97 <= c <= 122 or c >= 0xDF else 2 if 48 <= c <= 57 else 3 for c in range(256)], np.int8)


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a printable byte as itself and the others as letters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return out


class WordBpe:
    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(data)
        self.library = Tokenizer.from_str(data.decode("utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        end = spec["model"]["end_of_word_suffix"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.own = end == "</w>" and kinds == ["NFC", "Replace", "Lowercase"] and pattern == SPLIT
        self.special = [x["content"] for x in spec["added_tokens"]]
        letters = byte_letters()
        self.first = np.array([vocab.get(letters[b], -1) for b in range(256)], np.int64)
        self.last = np.array([vocab.get(letters[b] + end, -1) for b in range(256)], np.int64)
        a = np.array([[vocab[x], vocab[y], vocab[x + y]] for x, y in merges], np.int64)
        # a table of 2^20 slots, filled by rank; a key that finds its slot taken goes to the next one
        self.bits = 20
        self.keys, self.rank, self.made = (np.full(1 << self.bits, -1, np.int64) for _ in range(3))
        for r, (x, y, z) in enumerate(a.tolist()):
            k = x << 32 | y
            s = int(self._slot(np.array([k]))[0])
            while self.keys[s] >= 0:
                s = (s + 1) & ((1 << self.bits) - 1)
            self.keys[s], self.rank[s], self.made[s] = k, r, z
        self.latin: dict[bytes, bytes] = {b"": b""}
        self.memo: dict[str, bytes] = {"": b""}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, slot, -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while left.size:
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (held >= 0)]
        return out

    def merge(self, data: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of n pieces (UTF-8 bytes and each byte's piece, ascending), and where each piece's ids start (and the end)."""
        final = np.append(owner[1:] != owner[:-1], True)
        sym = np.where(final, self.last[data], self.first[data])
        done_sym, done_owner = [], []
        while sym.size:
            same = np.append(owner[1:] == owner[:-1], False)
            slot = np.full(sym.size, -1, np.int64)
            at = np.flatnonzero(same)
            slot[at] = self._find(sym[at] << 32 | sym[at + 1])
            rank = np.where(slot >= 0, self.rank[slot], NONE)
            starts = np.flatnonzero(np.append(True, ~same[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, sym.size))
            least_here = np.repeat(least, sizes)
            over = least_here == NONE
            if over.any():
                done_sym.append(sym[over])
                done_owner.append(owner[over])
            hit = np.flatnonzero((rank == least_here) & ~over)
            if hit.size:
                # of neighbouring hits (a run of one symbol) every second one merges, from the left
                begins = np.append(True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]]))
                run = np.maximum.accumulate(np.where(begins, np.arange(hit.size), 0))
                hit = hit[(np.arange(hit.size) - run) % 2 == 0]
                sym[hit] = self.made[slot[hit]]
                over[hit + 1] = True
            sym, owner = sym[~over], owner[~over]
        sym, owner = np.concatenate([sym, *done_sym]), np.concatenate([owner, *done_owner])
        order = np.argsort(owner, kind="stable")
        return sym[order].astype("<u4"), np.append(0, np.cumsum(np.bincount(owner, minlength=n)))

    def _learn_latin(self, words: list[bytes]) -> None:
        """Lower-cased Latin-1 words without apostrophes: split by kind of character, merge, remember."""
        data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        kind = KIND[data]
        starts = np.append(True, kind[1:] != kind[:-1]) | (kind == 2)
        inside = kind > 0
        owner = np.cumsum(starts & inside) - 1
        # the number of pieces before each word, then the UTF-8 form: two bytes from U+0080 on
        before = np.append(0, np.cumsum(starts & inside)[~inside])
        data, owner = data[inside], owner[inside]
        wide = data >= 0x80
        utf8 = np.repeat(data, 1 + wide)
        high = np.cumsum(1 + wide) - 1
        utf8[high[wide] - 1] = 0xC0 | data[wide] >> 6
        utf8[high[wide]] = 0x80 | data[wide] & 0x3F
        ids, at = self.merge(utf8, np.repeat(owner, 1 + wide), int(before[-1]))
        blob, at = ids.tobytes(), (4 * at[before]).tolist()
        self.latin.update((w, blob[i:j]) for w, i, j in zip(words, at, at[1:], strict=False))

    def forget(self) -> None:
        self.latin, self.memo = {b"": b""}, {"": b""}

    def learn(self, latin: set[bytes], other: set[str]) -> None:
        if len(self.latin) + len(self.memo) > MEMO_WORDS:
            self.forget()
        new = latin.difference(self.latin)
        rare = {w for w in new if b"'" in w or len(w) > LONGEST_PIECE}
        if new := list(new - rare if rare else new):
            self._learn_latin(new)
        rest: list = [*rare, *other.difference(self.memo)]
        for lo in range(0, len(rest), 4096):
            part = rest[lo : lo + 4096]
            found = self.library.encode_batch_fast([w.decode("latin-1") if isinstance(w, bytes) else w for w in part], add_special_tokens=False)
            for w, e in zip(part, found, strict=True):
                (self.latin if isinstance(w, bytes) else self.memo)[w] = np.array(e.ids, "<u4").tobytes()

    def encode_bytes(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        split: list = []
        for t in texts:
            try:
                raw = t.encode("latin-1") if self.own and t else b"\0"
            except UnicodeEncodeError:
                raw = b"\0"
            if b"<|" in raw or raw.translate(None, SAFE):  # a special string counts in its own case only
                split.append(t.replace("\n", " ").split(" ") if t else [])
            else:
                split.append(raw.translate(LOWER).split(b" "))
        latin = [s for s in split if s and isinstance(s[0], bytes)]
        self.learn(set().union(*latin), set().union(*(s for s in split if s and isinstance(s[0], str))))
        look = {bytes: self.latin.__getitem__, str: self.memo.__getitem__}
        return [b"".join(map(look[type(s[0])], s)) if s else b"" for s in split]


@lru_cache(maxsize=2)
def word_bpe(data: bytes) -> WordBpe:
    return WordBpe(data)
