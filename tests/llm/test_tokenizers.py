"""Operators 1, 6 and 10 against the libraries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sessionloom.llm import packing, sentencepiece_codec, token_counts, word_bpe
from sessionloom.llm.common import tokenizer_bytes

ODD = [None, "", " ", "   a", "a  b ", "\n", "▁x", "é漢😀\x00", "<s></s><unk>", "<|endoftext|> a<|endoftext|>", "<|EndOfText|>", "'re'r' 'll'l don't", "x" * 3000, " " * 700, "mßa×ÿ÷'s", "İΣ ﬁ\xa0q", "a" * 5000 + " the " * 400, "the of", "the of"]


def texts(seed, letters, n=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_encoding_and_decoding_are_the_librarys():
    import sentencepiece

    model = tokenizer_bytes("piece_bpe_32k.model")
    own, lib = sentencepiece_codec.codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ODD + texts(1, " " * 6 + "abcdetnrs.,éß漢字\n\t\x00▁😀0129<>"):
        ids = own.encode(t)
        assert ids == lib.encode(t or "")
        assert own.decode(ids) == lib.decode(ids)
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.randrange(300 if rng.random() < 0.5 else 32_000) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == lib.decode(ids)


def test_encode_rows(spark, docs_of):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=tokenizer_bytes("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in sentencepiece_codec.encode(docs_of(enumerate(ODD))).collect()}
    assert len(got) == len(ODD)
    for k, t in enumerate(ODD):
        ids = lib.encode(t or "")
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs_of(enumerate(ODD)))).collect()
    assert all(r["decoded"] == got[r["doc_id"]]["decoded"] for r in back)
    assert sentencepiece_codec.encode(docs_of([])).count() == 0


def test_counts_are_the_librarys():
    from tokenizers import Tokenizer

    data = tokenizer_bytes("byte_bpe_50k.json")
    lib = Tokenizer.from_str(data.decode())
    given = ODD + texts(3, "    abcdeéßtsrvlm'''.,!0129\n\t漢😀 \x1c\xa0\x85²ªॐ") + texts(4, "'srvelltmd ab.\n", 4000)
    got = token_counts.counter(data).counts(given)
    assert got == [len(lib.encode(t, add_special_tokens=False).ids) if t else 0 for t in given]


def test_chunk_maps_do_not_depend_on_the_chunk(monkeypatch):
    kinds = np.array([random.Random(5).randrange(token_counts.KINDS - 1) for _ in range(997)], np.int8)
    c = token_counts.counter(tokenizer_bytes("byte_bpe_50k.json"))
    found = []
    for size in (1, 7, 256, 5000):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        found.append(c.marks(kinds).tolist())
    assert found[0] == found[1] == found[2] == found[3]


@pytest.mark.parametrize("chunk,warm", [(1024, 64), (16, 8), (8, 1), (5, 5)])
def test_long_pieces_by_chunks(monkeypatch, chunk, warm):
    """Chunks whose warm-up leads to the true state, and those whose doesn't: as the whole piece, and as the library."""
    import tokenizers

    monkeypatch.setattr(token_counts, "PIECE_CHUNK", chunk)
    monkeypatch.setattr(token_counts, "WARM", warm)
    monkeypatch.setattr(token_counts, "LONG_PIECE", 4 * chunk)
    rng = random.Random(chunk)
    c = token_counts.TokenCounter(tokenizer_bytes("byte_bpe_50k.json"))
    words = ["the", "international", "aaaaaaaa", "ing", "zq", "é", "strasse", "日本", "x" * 300]
    given = ["".join(rng.choice(words) for _ in range(n)) for n in (1, 40, 700, 3000)] + ["a" * 20_001, "ab" * 6000, "日" * 5000] + ["".join(rng.choice("abcdefgh") for _ in range(30_000))]
    for t in given:
        assert c.piece(t.encode()) == c.walk(0, t.encode())[1]
    library = tokenizers.Tokenizer.from_str(tokenizer_bytes("byte_bpe_50k.json").decode())
    assert c.counts(given) == [len(x) for x in library.encode_batch(given, add_special_tokens=False)]


def test_a_piece_of_a_million_letters():
    import time

    c = token_counts.TokenCounter(tokenizer_bytes("byte_bpe_50k.json"))
    rng = random.Random(1)
    text = "".join(rng.choice(["tion", "er", "xyz", "straight", "qu", "e"]) for _ in range(330_000))[:1_000_000].encode()
    began = time.time()
    assert c.chunked(text) == c.walk(0, text)[1] and time.time() - began < 60


def test_count_rows(docs_of):
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs_of([(1, "a" * 4000), (2, None), (3, "é b")])).collect()}
    assert (got[2]["n_bytes"], got[2]["n_tokens"], got[2]["over_limit"]) == (0, 0, False)
    assert got[3]["n_bytes"] == 4
    assert token_counts.token_counts(docs_of([])).count() == 0


def test_word_ids_are_the_librarys():
    data = tokenizer_bytes("word_bpe_49k.json")
    own = word_bpe.word_bpe(data)
    assert own.own
    given = ODD + texts(6, "  abcdeÀéßtsrvlm'''.,!0129\n\tİΣ漢 ﬁ\x1c\xa0<|>")
    for t, ids in zip(given, own.encode_bytes(given), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.library.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(40))
def test_plan_fills_sequences_without_gaps(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 16, 64, 4096])
    counts = {rng.randint(1, cap): rng.randint(1, 60) for _ in range(rng.randint(0, 50))}
    use = defaultdict(list)
    for length, first, n, s, per, offset in packing.plan(counts, cap).tolist():
        for j in range(n):
            use[s + j // per].append((offset + j % per * length, length, first + j))
    seen = defaultdict(list)
    for x in use.values():
        at = 0
        for offset, length, number in sorted(x):
            assert offset == at
            at += length
            seen[length].append(number)
        assert at <= cap
        assert sum(3 * length > cap for _, length, _ in x) <= 2
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(v)) for k, v in counts.items()}
    large = sum(v for k, v in counts.items() if 2 * k > cap)
    total = sum(k * v for k, v in counts.items())
    assert len(use) <= max(large, -(-total * 3 // (2 * cap)) + 1, sum(v for k, v in counts.items() if 3 * k > cap))


def test_packing_rows(docs_of):
    given = [(k, " ".join(["word"] * (37 * k % 900))) for k in range(60)] + [(100, None), (101, "w " * 10_000), (102, ""), (102, "")]
    got = packing.pack(docs_of(given), capacity=512).collect()
    lib = word_bpe.word_bpe(tokenizer_bytes("word_bpe_49k.json")).library
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in given}
    assert sum(r["length"] for r in got) == sum(len(ids[i]) for i, _ in given)
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 512 * r["piece"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    use = defaultdict(list)
    for r in got:
        use[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in use.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 512
    assert packing.pack(docs_of([])).count() == 0


def test_models_with_special_pieces_are_refused():
    """A piece of another kind than the codec knows: user-defined or unused ones change the library's result."""
    from sessionloom.llm import sentencepiece_codec as S
    from sessionloom.llm.common import tokenizer_bytes

    data = tokenizer_bytes("piece_bpe_32k.model")
    assert set(S.piece_kinds(data)) <= {S.NORMAL, S.UNKNOWN, S.CONTROL, S.BYTE}
    for kind in (S.USER_DEFINED, S.UNUSED):
        piece = b"\x0a\x03xyz\x18" + bytes([kind])
        with pytest.raises(ValueError, match="user-defined"):
            S.PieceCodec(data + b"\x0a" + bytes([len(piece)]) + piece)


def test_plan_against_exhaustive_packing():
    """Small cases: never more than the least number of sequences by more than one, and mostly equal."""
    import random
    from functools import lru_cache

    from sessionloom.llm.packing import plan

    def least(lengths, capacity):
        @lru_cache(None)
        def place(k, rooms):
            if k == len(lengths):
                return len(rooms)
            n = lengths[k]
            options = [place(k + 1, tuple(sorted((*rooms[:i], r - n, *rooms[i + 1 :])))) for i, r in enumerate(rooms) if r >= n and r not in rooms[:i]]
            return min([*options, place(k + 1, tuple(sorted((*rooms, capacity - n))))])

        return place(0, ())

    rng, worse = random.Random(5), 0
    for _ in range(60):
        capacity = rng.choice([12, 20, 31])
        lengths = tuple(sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True))
        counts = {n: lengths.count(n) for n in lengths}
        used = {}
        for n, _, number, first, per, _ in plan(counts, capacity).tolist():
            for j in range(number):
                used.setdefault(first + j // per, []).append(n)
        assert sorted(x for v in used.values() for x in v) == sorted(lengths) and max(map(sum, used.values())) <= capacity
        more = len(used) - least(lengths, capacity)
        assert 0 <= more <= 1
        worse += more
    assert worse <= 6
