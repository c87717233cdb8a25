"""Byte-level BPE against the library whose merges it reproduces."""

import hashlib
import random

import numpy as np
import pytest

from variantloom.llm import byte_bpe

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.vocabulary_path())


def same(encoder, encoding, text):
    ids = np.frombuffer(encoder.ids(text), "<u4")
    assert ids.tolist() == encoding.encode_ordinary(text), text[:100]
    assert encoder.vocabulary.decode(ids) == text.encode()


def test_any_text(encoder):
    encoding, rng = library(encoder.vocabulary.ranks), random.Random(1)
    # white space of all kinds, accents, signs, letters and numbers that only newer lists hold
    signs = [chr(c) for c in range(0x20, 0x250)] + list("\x1c\x1f\x85\xa0 　\n\r\t\U0001f600՘࢏౜\U000107bb\U00011de0")
    signs += [" "] * 60 + ["'s", "'ll", "n", "e", "²", "½", "Ⅷ"] * 6
    for _ in range(600):
        same(encoder, encoding, "".join(rng.choice(signs) for _ in range(rng.randrange(60))))
    tokens = list(encoder.vocabulary.ranks)
    for _ in range(3000):
        same(encoder, encoding, b"".join(rng.choices(tokens, k=rng.randrange(1, 6))).decode("utf-8", "ignore"))
    for letters in ("ab", "aé", "eth", "in", " a", "0a", "!a'", " \n"):
        for _ in range(60):
            same(encoder, encoding, "".join(rng.choice(letters) for _ in range(rng.randrange(200))))


def test_long_pieces(encoder):
    encoding = library(encoder.vocabulary.ranks)
    for unit in ("a", "ab", "aab", "\n", " ", "é", "0", "="):
        same(encoder, encoding, unit * 3000)


def test_texts_longer_than_a_step(encoder, monkeypatch):
    encoding, rng = library(encoder.vocabulary.ranks), random.Random(2)
    monkeypatch.setattr(byte_bpe, "STEP_CHARS", 40)
    for _ in range(200):
        same(encoder, encoding, "".join(rng.choice(["a", "be", " ", "  ", "\n", "'s", "é", "."]) for _ in range(rng.randrange(300))))


def small_ranks():
    """A vocabulary with a token that no merges end in, and with tokens that begin with ones of greater rank."""
    ranks = {bytes([i]): i for i in range(256)}
    for token in (b"ab", b"bc", b"cd", b"abcd", b"abc", b"abcde", b"xyz", b"aa", b"aaa", b"aaaa", b"ba", b"aab"):
        ranks[token] = len(ranks)
    return ranks


def test_small_vocabulary_and_full_memories(monkeypatch):
    ranks = small_ranks()
    vocabulary, encoding, rng = byte_bpe.Vocabulary(ranks), library(ranks), random.Random(3)
    assert vocabulary.encode(b"xyz") == [ranks[b"xyz"]]
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    for _ in range(4000):
        piece = "".join(rng.choice("abcdexyz") for _ in range(rng.randrange(1, 14)))
        assert vocabulary.encode(piece.encode()) == encoding.encode_ordinary(piece), piece


def test_ranks_out_of_order_are_refused():
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"ab": 257}
    with pytest.raises(ValueError, match="greater ranks"):
        byte_bpe.Vocabulary(ranks)


def test_compatible_is_what_merging_leaves():
    ranks = small_ranks()
    vocabulary = byte_bpe.Vocabulary(ranks)
    for left in (b"a", b"ab", b"aa", b"abc", b"b", b"aaa"):
        for right in (b"a", b"bc", b"c", b"cd", b"aa", b"ba"):
            parts = [bytes([c]) for c in left + right]
            while True:  # merge by rank, the leftmost of equal ones first
                known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not known:
                    break
                _, i = min(known)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert vocabulary.compatible(ranks[left], ranks[right]) == (parts == [left, right]), (left, right)


def test_every_row(docs, no_docs, encoder):
    encoding = library(encoder.vocabulary.ranks)
    got = sorted(map(tuple, byte_bpe.digest(docs).collect()), key=str)
    want = []
    for row in docs.collect():
        text = row["text"] or ""
        ids = np.array(encoding.encode_ordinary(text), "<u4").tobytes()
        want.append((row["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert byte_bpe.digest(no_docs).count() == 0
    texts = byte_bpe.decoded_documents(byte_bpe.encoded_documents(docs)).collect()
    assert sorted(bytes(r["bytes"]) for r in texts) == sorted((r["text"] or "").encode() for r in docs.collect())
