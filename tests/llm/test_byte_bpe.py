"""Prefix encoding against the tiktoken library and against merging by rank."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from qaspark.llm import queries
from qaspark.llm.byte_bpe import ByteEncoder, OpenPiece, OpenText, Vocabulary, encode_texts, merge_by_rank, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SMALL = "/root/testdata/sf0.001"
LETTERS = "aabbcde éß日本\n\t 01'’lsrve.!  \x00"


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(PATH).ranks, special_tokens={})


def noise(rng, most):
    return "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, most)))


def test_random_texts_and_pieces(plain):
    rng, encoder = random.Random(1), ByteEncoder(vocabulary(PATH), public_tokenizers.PATTERN)
    for _ in range(3000):
        text = noise(rng, 40)
        assert encoder.encode(text) == plain.encode_ordinary(text)
    for _ in range(500):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 200)))
        assert encoder.vocabulary.encode_piece(text.encode()) == plain.encode_ordinary(text)


def test_every_prefix_has_the_last_token_of_its_own_encoding():
    words, piece = vocabulary(PATH), b"unbelievableoverestimatinglyaaaaaaaaaaa"
    table = OpenPiece(words, piece).last
    for n in range(1, len(piece) + 1):
        assert table[n - 1] == words.ranks[merge_by_rank(words.ranks, piece[:n])[-1]]


@pytest.mark.parametrize("seed", range(4))
def test_small_vocabularies_with_tokens_that_merging_never_reaches(seed):
    rng = random.Random(seed)
    ranks = {bytes([i]): i for i in range(256)}
    while len(ranks) < 320:
        token = b"".join(rng.choice([t for t in ranks if set(t) <= set(b"abc")]) for _ in range(2))
        if token not in ranks and len(token) < 9 and len(merge_by_rank(ranks, token)) == 2:
            ranks[token] = len(ranks)
    ranks[b"cdddc"] = len(ranks)
    words = Vocabulary(ranks)
    assert words.encode_piece(b"cdddc") == [320] and len(words.encode_piece(b"acdddc")) > 1
    with pytest.raises(ValueError):
        Vocabulary({**{bytes([i]): i for i in range(256)}, b"abc": 256, b"ab": 257})
    for _ in range(1500):
        piece = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12))).encode()
        if piece not in ranks:
            assert words.encode_piece(piece) == [ranks[t] for t in merge_by_rank(ranks, piece)]
        else:
            assert words.encode_piece(piece) == [ranks[piece]]


def test_appends_and_edits_equal_encoding_anew_and_touch_only_their_surroundings(plain):
    rng = random.Random(2)
    piece = OpenPiece(vocabulary(PATH), b"the" * 3000)
    begin = piece.computed
    for _ in range(60):
        n = len(piece.piece)
        a = rng.randint(0, n)
        piece.replace(a, min(n, a + rng.choice([0, 1, 5])), "".join(rng.choice("theandig") for _ in range(rng.randint(0, 6))).encode())
        piece.append(b"ing")
    assert piece.ids() == piece.vocabulary.encode_piece(piece.piece)
    assert (piece.computed - begin) / 120 < 300
    text = OpenText(ByteEncoder(vocabulary(PATH), public_tokenizers.PATTERN))
    for i in range(800):
        n = len(text.text)
        a = rng.randint(0, n)
        text.replace(a, min(n, a + rng.choice([0, 0, 1, 2, 9])), noise(rng, 12))
        assert text.ids() == plain.encode_ordinary(text.text)
    text = OpenText(text.encoder, "some words in a row " * 2000)
    begin = text.encoded
    text.replace(20_000, 20_001, "X")
    text.append("more")
    assert text.ids() == plain.encode_ordinary(text.text) and text.encoded - begin < 12


def test_new_pieces_share_tables_and_are_learned_once_in_a_worker(plain, monkeypatch):
    from qaspark.llm import byte_bpe

    words, rng = Vocabulary(vocabulary(PATH).ranks), random.Random(5)
    pieces = sorted({"".join(rng.choice("theandigoué日") for _ in range(rng.randint(1, 14))).encode() for _ in range(4000)} | {b"x" * n for n in range(1, 60)})
    tried = []
    monkeypatch.setattr(words, "_stay_apart", lambda left, right, plainly=words._stay_apart: tried.append((left, right)) or plainly(left, right))
    found = list(words.encode_pieces(pieces))
    assert found == [np.array(words.encode_piece(p), "<u4").tobytes() for p in pieces] and len(tried) == len(set(tried))
    assert found == [np.array([words.ranks[t] for t in ([p] if p in words.ranks else merge_by_rank(words.ranks, p))], "<u4").tobytes() for p in pieces]
    monkeypatch.setattr(byte_bpe, "_encoders", {})
    texts = [noise(rng, 60) for _ in range(300)] + ["", "x" * 300, "long " * 60_000]
    encoder = byte_bpe.byte_encoder(PATH, public_tokenizers.PATTERN)
    for _ in range(2):
        ids = [np.frombuffer(b"".join(s), "<u4").tolist() for s in encoder.streams(texts)]
        assert ids == [plain.encode_ordinary(t) for t in texts]
        # A later task learns nothing anew.
        encoder = byte_bpe.byte_encoder(PATH, public_tokenizers.PATTERN)
        monkeypatch.setattr(encoder, "_learn", lambda pieces: pieces and pytest.fail(f"learned again: {pieces}"))
    monkeypatch.undo()
    monkeypatch.setattr(byte_bpe, "MOST_PIECES", 50)
    encoder = ByteEncoder(words, public_tokenizers.PATTERN)
    for _ in range(3):
        ids = [np.frombuffer(b"".join(s), "<u4").tolist() for s in encoder.streams(texts)]
        assert ids == [plain.encode_ordinary(t) for t in texts]


def test_memory_of_pieces_is_bounded(monkeypatch, plain):
    from qaspark.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "MOST_PIECES", 50)
    monkeypatch.setattr(byte_bpe, "MOST_PAIRS", 50)
    monkeypatch.setattr(byte_bpe, "_PIECES_AT_ONCE", 8)
    encoder, rng = ByteEncoder(Vocabulary(vocabulary(PATH).ranks), public_tokenizers.PATTERN), random.Random(3)
    for _ in range(300):
        text = noise(rng, 80)
        assert encoder.encode(text) == plain.encode_ordinary(text)
        assert len(encoder._known) <= 50 + 80


def expected(plain, text):
    ids = plain.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_awkward_rows(spark, plain):
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (None, "null id"), (4, "long " * 200_000), (5, "x" * 70_000), (6, "<|endoftext|> é 日本 \r\n\r\n  a")]
    docs = spark.createDataFrame([(i, t, 9, "h") for i, t in rows], "doc_id long, text string, n_tokens int, ids_sha256 string")
    found = encode_texts(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r[0] or 0, *r[1:]) for r in found) == sorted((i or 0, *expected(plain, t)) for i, t in rows)
    assert encode_texts(docs.where("false"), PATH, public_tokenizers.PATTERN).collect() == []


def test_registered_query(spark, plain):
    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, SMALL).collect()}
    found = queries.op11_byte_bpe(spark, SMALL).collect()
    assert len(found) == len(docs) and all(tuple(r)[1:] == expected(plain, docs[r["doc_id"]]) for r in found)
