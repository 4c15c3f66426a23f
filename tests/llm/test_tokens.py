"""Token operators (ops 2, 9, 10) against the libraries, on texts that stress the cuts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from flightlens.llm import byte_bpe, library_tokens, packing, token_codes
from flightlens.llm.common import shared_folder
from flightlens.llm.library_tokens import ids_bytes
from llm_fixtures import docs  # noqa: F401

RANKS = P.path("byte_bpe_50k.tiktoken")
BYTES = P.path("byte_bpe_50k.json")
WORDS = P.path("word_bpe_49k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "é", "̈", "ß", "1", "23", "'s", "'LL", "!!", "中文",
         "\0", "<|endoftext|>", "​", "😀", "the", " the", "Σ", "İ", "²", "٣"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return [*made, "", "a" * 3000, "ab" * 900, "the quick brown fox. " * 400, "x" * 60 + " " + "y" * 60]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(texts, tik):
    for text, ids in zip(texts, byte_bpe.encode_texts(texts, RANKS, P.PATTERN)):
        assert ids.tolist() == tik.encode_ordinary(text), repr(text)


def test_matrix_and_long_form_agree(tik):
    bpe = byte_bpe.ByteBpe.from_file(RANKS, P.PATTERN)
    rng = random.Random(2)
    for _ in range(60):
        piece = "".join(rng.choice("aabcdeth") for _ in range(rng.randint(2, 200))).encode()
        long = bpe._merge_long(bpe.single[np.frombuffer(piece, np.uint8)])
        assert long.astype("<i4").tobytes() == bpe.encode_pieces([piece])[0] or piece in bpe.ranks


@pytest.mark.parametrize("path,drops", [(BYTES, False), (WORDS, True)])
def test_chunks_equal_whole_texts(texts, path, drops):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    for text, ids in zip(texts, ids_bytes(texts, path, drops)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path,drops", [(BYTES, False), (WORDS, True)])
def test_special_tokens_as_by_the_library(texts, path, drops):
    tokenizer = Tokenizer.from_file(path)
    texts = [*texts, "see <|endoftext|> here", "<|startoftext|>", "<|ENDOFTEXT|>"]
    for text, ids in zip(texts, ids_bytes(texts, path, drops, specials=True), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path,drops", [(BYTES, False), (WORDS, True)])
def test_words_and_their_marks_skip_the_library_pattern(path, drops, monkeypatch):
    """A word that marks follow is put together from codes of its own, not matched again (each costs most of a task)."""
    made, matched = library_tokens._tokenizer, []

    class Counting:
        def __init__(self, inner):
            self.__dict__["inner"] = inner

        def __getattr__(self, name):
            if name == "encode_batch_fast":
                return lambda texts, **kw: matched.extend(texts) or self.inner.encode_batch_fast(texts, **kw)
            return getattr(self.inner, name)

        def __setattr__(self, name, value):
            setattr(self.inner, name, value)

    monkeypatch.setattr(library_tokens, "_tokenizer", lambda p: Counting(made(p)))
    codes, _ = library_tokens._codes.__wrapped__(path, drops)
    words = ["Qwertzo", "zoblifant", "THE", "x", *(f"{a}{b}rin" for a in "abcdefghij" for b in "klmnopqrst")]
    text = " ".join(w + m for m in ("", ",", ".", "...", "?!", "<|", '")', "_") for w in words)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    expected = tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(3):  # first sight, second sight, from the cache
        assert np.frombuffer(codes.codes([text], library_tokens.words if drops else None)[0], "<u4").tolist() == expected
    assert not matched
    assert len(codes.cache) <= len(words) * 8
    odd = "don't, it's. a1, 7,8 caf\u00e9, \u0130x. -x, 'y' (zoblifant) " + text
    assert (np.frombuffer(codes.codes([odd], library_tokens.words if drops else None)[0], "<u4").tolist()
            == tokenizer.encode(odd, add_special_tokens=False).ids)


def test_code_files_hold_special_tokens(spark, docs):
    folder = shared_folder(spark, "codes-test")
    token_codes.write(docs([(1, "see <|endoftext|> here")]), BYTES, 2, folder)
    assert token_codes.read(spark, folder, with_ids=True).first()["ids"] == [3826, 220, 50256, 994, 2]


def test_encode_decode_rows(docs, tik):
    rows = [(1, "Hello  world\n\n the"), (2, None), (3, ""), (3, ""), (None, "x")]
    out = byte_bpe.encode_decode(docs(rows), RANKS, P.PATTERN).collect()
    assert len(out) == 5
    for r in out:
        text = next(t for i, t in rows if i == r["doc_id"]) or ""
        ids = tik.encode_ordinary(text)
        assert (r["n_tokens"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(text.encode()).hexdigest())
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_levels_give_random_access():
    rng = np.random.default_rng(1)
    ids = rng.choice([3, 255, 256, 50_000, 70_000, 2**24 + 5, 2**32 - 1], 5000).astype(np.uint32)
    blob = token_codes.pack_segment([7, None], np.array([10, 5000]), ids)
    reads = []

    def read(at, size):
        reads.append(size)
        return blob[at:at + size]

    segment = token_codes.Segment(read)
    assert segment.documents()[0] == [7, None] and segment.documents()[1].tolist() == [0, 10]
    reads.clear()
    for i in rng.integers(0, 5000, 200):
        assert segment.token(int(i)) == ids[i]
    assert max(reads) <= 64  # a bitmap block, never a level
    assert (segment.ids() == ids).all()


def test_code_files_round_trip(spark, docs, monkeypatch):
    monkeypatch.setattr(token_codes, "SEGMENT_TOKENS", 50)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat\n", "zyx"]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(200, None), (201, ""), (5, "repeated id"), (None, "no id")]
    folder = shared_folder(spark, "codes-test")
    token_codes.write(docs(rows), BYTES, 2, folder)
    got = sorted(token_codes.read(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    tokenizer = Tokenizer.from_file(BYTES)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (doc, text) in zip(got, want, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) == (doc, start, len(ids), crc, ids)
        start += len(ids)
    assert token_codes.token_at(spark, folder, start - 1) == 2


def test_empty_tables(docs):
    empty = docs([])
    assert token_codes.round_trip(empty, BYTES, 2).count() == 0
    assert packing.pack_documents(empty, WORDS).count() == 0
    assert byte_bpe.encode_decode(empty, RANKS, P.PATTERN).count() == 0


def test_packing_is_gapless_and_whole(docs):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(0, 90)) for i in range(300)] + [(301, None), (302, "w " * 350), (302, "w " * 350), (None, "x")]
    out = packing.pack_documents(docs(rows), WORDS, end_id=1, capacity=100).toPandas()
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert (g.length.cumsum() - g.length == g.offset).all() and g.length.sum() <= 100
    assert out.length.sum() == sum(len((t or "").split()) + 1 for _, t in rows)
    bound = -(-out.length.sum() // 100)
    assert out.sequence_id.nunique() <= bound * 1.03


def test_pieces_equal_the_library(texts, docs):
    """piece, start, length and checksum of every piece as the tokenizers library gives them, cuts and repeated rows included."""
    library = Tokenizer.from_file(WORDS)
    rows = [*enumerate(texts[::5]), (7, texts[35]), (900, None), (901, ""), (902, texts[-2]), (902, "w " * 63), (902, "w " * 64)]
    wanted = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at:at + 64], "<u4")
            wanted.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
    frame = docs(rows).repartition(4)
    out = packing.pack_documents(frame, WORDS, end_id=1, capacity=64).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(wanted)
    held = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(held.values()) <= 64


def test_evolution_beats_best_fit():
    """Triplets that fill a bin exactly, where best fit decreasing wastes bins."""
    rng = np.random.default_rng(8)
    items = []
    for _ in range(120):
        a, b = sorted(rng.integers(26, 49, 2))
        items += [a, b - a % 3, 100 - a - (b - a % 3)]
    lengths = np.array(items, np.int64)
    plain = packing.best_fit(lengths, np.full(len(lengths), -1, np.int32), 100)
    founders = packing._founders(lengths, 100, 0, rng)
    best = packing.evolve(lengths, founders, 100, 60, rng)[0]
    assert np.bincount(best, weights=lengths).max() <= 100
    assert best.max() <= plain.max()
    assert packing.fitness(lengths, best, 100) >= packing.fitness(lengths, plain, 100)
