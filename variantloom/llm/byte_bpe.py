"""Byte-level BPE encoding and decoding in linear time, equal to merging by rank.

The bytes of a piece are read as Latin-1 characters, so that an automaton over the vocabulary finds the longest token
at every place. The encoder takes longest tokens and goes back to shorter ones (the next token that begins it) wherever
two neighbours would not have stayed apart: two tokens are compatible if merging by rank the bytes of both leaves
exactly these two. Compatibility is remembered. A place from which no rest could be encoded is marked and not tried
again, so a piece takes time in proportion to its length. A vocabulary in which a token has a smaller rank than the
tokens it is merged from, which training does not make, is refused.

Work per row only: no shuffle, whatever sources or copies the table holds. A null or empty text has no ids. Rows keep
their ``doc_id`` as it is (null, repeated); other columns are left out. Very long texts are read in steps."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import STEP_CHARS, steps

#: Entries of each of a task's two memories, of pieces and of pairs of tokens; a full one is emptied.
REMEMBERED = 500_000
#: Longer pieces are not remembered.
SHORT = 48


class Vocabulary:
    """Tokens and ranks, and what merging by rank makes of them."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import ahocorasick

        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        #: For each token and longest token behind it, the longest that is compatible.
        self._follow: list[dict[int, int]] = [{} for _ in self.tokens]
        self._pairs = 0
        #: Next shorter token that begins a token; -1 if there is none.
        self._shorter = [self._beginning(token) for token in self.tokens]
        #: The two tokens whose merge forms a token; a single byte is its own halves.
        self._halves = {rank: (rank, rank) for token, rank in ranks.items() if len(token) == 1}
        self._merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            halves = self._last_merge(token, rank) if len(token) > 1 else None
            if halves:
                self._halves[rank], self._merged[halves] = halves, rank
            elif len(token) > 1 and len(self._merge(token)) == 1:
                raise ValueError(f"the parts of token {rank} have greater ranks than the token")
        # tokens that no merges end in stand for whole pieces only
        self._shorter = [self._reachable(rank) for rank in self._shorter]
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for rank in self._halves:
            self._automaton.add_word(self.tokens[rank].decode("latin-1"), rank)
        self._automaton.make_automaton()
        self._length = [len(token) for token in self.tokens]
        self._lengths = np.array(self._length, np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def _beginning(self, token: bytes) -> int:
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), -1)

    def _reachable(self, rank: int) -> int:
        while rank >= 0 and rank not in self._halves:
            rank = self._shorter[rank]
        return rank

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        left = self._shorter[rank]
        while left >= 0:
            right = self.ranks.get(token[len(self.tokens[left]):], rank)
            if left < rank > right and left in self._halves and right in self._halves and self.compatible(left, right):
                return left, right
            left = self._shorter[left]
        return None

    def _merge(self, piece: bytes) -> list[bytes]:
        """Merging by rank as it is defined, the leftmost of equal ranks first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while known := [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]:
            _, i = min(known)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank the joined bytes of two tokens leaves exactly these two.

        Undoes the merges next to the seam from the last to the first. A merge over the seam must not come before the
        merge that has just been undone; at equal ranks the one further left comes first."""
        merged, halves, before = self._merged, self._halves, 1 << 62
        while True:
            if merged.get((left, right), before) < before:
                return False
            if left > right:
                before, inner = left, halves[left][1]
                if inner != left:
                    left = inner
                    continue
            before, inner = right + 1, halves[right][0]
            if inner != right:
                right = inner
                continue
            before, inner = left, halves[left][1]
            if inner == left:
                return True
            left = inner

    def _follower(self, left: int, longest: int) -> int:
        """The longest token that begins ``longest`` and is compatible with ``left`` before it; -1 if there is none."""
        if self._pairs >= REMEMBERED:
            for known in self._follow:
                known.clear()
            self._pairs = 0
        self._pairs += 1
        rank = longest
        while rank >= 0 and not self.compatible(left, rank):
            rank = self._shorter[rank]
        self._follow[left][longest] = rank
        return rank

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, length, shorter, follow = piece.decode("latin-1"), self._length, self._shorter, self._follow
        end = len(text)
        longest, dead, ids = [-1] * end, bytearray(end + 1), []
        at, known = 0, None  # the place, and what is known of the token before it
        while at < end:
            rank = longest[at]
            if rank < 0:  # longest tokens one after another, up to a place that was seen
                start = at
                for last, rank in self._automaton.iter_long(text, at):
                    if longest[start] >= 0:
                        break
                    longest[start] = rank
                    start = last + 1
                rank = longest[at]
            while True:
                while rank >= 0:
                    if known is not None:
                        fits = known.get(rank)
                        rank = self._follower(ids[-1], rank) if fits is None else fits
                        if rank < 0:
                            break
                    if not dead[at + length[rank]]:
                        break
                    rank = shorter[rank]
                if rank >= 0:
                    break
                dead[at] = 1
                rank = ids.pop()
                at -= length[rank]
                rank, known = shorter[rank], follow[ids[-1]] if ids else None
            ids.append(rank)
            at, known = at + length[rank], follow[rank]
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids' tokens, one after another."""
        lengths = self._lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        # every byte's place among the bytes of all tokens
        places = np.repeat(self._starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1])
        return self._bytes[places].tobytes()


class _Remembered(dict):
    """Results of a function for short texts; emptied when full."""

    def __init__(self, of) -> None:
        super().__init__()
        self._of = of

    def __missing__(self, text: str) -> bytes:
        value = self._of(text)
        if len(text) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = value
        return value


def _unlike(name: str) -> frozenset[str]:
    """The characters that two regular expression engines hold of different kinds: the one that fixes the pattern's
    meaning knows an older list of letters and numbers."""
    import regex
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    single = {bytes([i]): i for i in range(256)}
    meant = tiktoken.Encoding("kind", pat_str=f"{name}+", mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
    return frozenset(bytes(meant).decode()) ^ frozenset(regex.findall(name, every))


class Encoder:
    """Texts to ids. The pattern cuts a text into pieces; the ids of short pieces are remembered."""

    #: The pattern of the public vocabularies never joins what stands on both sides of a single space between two other
    #: characters, and such a space begins what follows: there a very long text can be cut.
    _cut = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, pattern: str | None = None) -> None:
        import public_tokenizers
        import regex

        self.vocabulary = Vocabulary.read(path)
        pattern = pattern or public_tokenizers.PATTERN
        self._pieces = regex.compile(pattern).findall
        kinds = {name: _unlike(name) for name in (r"\p{L}", r"\p{N}")}
        self._rare = frozenset().union(*kinds.values())
        self._may_be_rare = re.compile(f"[{min(self._rare)}-\U0010ffff]").search if self._rare else lambda text: None
        for name, unlike in kinds.items():
            pattern = pattern.replace(name, f"[{name}~~[{''.join(sorted(unlike))}]]") if unlike else pattern
        self._rare_pieces = regex.compile(pattern, regex.V1).findall
        self._known = _Remembered(lambda piece: array("I", self.vocabulary.encode(piece.encode())).tobytes())

    def _parts(self, text: str) -> Iterator[str]:
        low = 0
        while len(text) - low > STEP_CHARS and (cut := self._cut.search(text, low + STEP_CHARS)):
            yield text[low : cut.start()]
            low = cut.start()
        yield text[low:]

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self._ids, self._parts(text)))

    def _ids(self, text: str) -> bytes:
        rare = not text.isascii() and self._may_be_rare(text) and not self._rare.isdisjoint(text)
        return b"".join(map(self._known.__getitem__, (self._rare_pieces if rare else self._pieces)(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a Python worker: it and its memories serve all tasks of the worker."""
    return Encoder(path)


def vocabulary_path() -> str:
    """The ranks of the multilingual 50k vocabulary, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``: the whole text's ids as little-endian unsigned 32-bit numbers."""
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path).ids
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = [n or 0 for n in pa.compute.binary_length(texts).to_pylist()]
            for low, high in steps(sizes):
                ids = [ids_of(t) if t else b"" for t in texts.slice(low, high - low).to_pylist()]
                yield pa.RecordBatch.from_arrays([keys.slice(low, high - low), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids binary")


def decoded_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``bytes``, the ids' tokens one after another: the text's UTF-8 where the ids are those of a text."""
    path = path or vocabulary_path()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path).vocabulary.decode
        for batch in batches:
            keys, ids = batch.column(0), batch.column(1)
            for low, high in steps([n or 0 for n in pa.compute.binary_length(ids).to_pylist()], 4 * STEP_CHARS):
                part = ids.slice(low, high - low)
                texts = [of(np.frombuffer(i, "<u4")) for i in part.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(low, high - low), part, pa.array(texts, pa.binary())], ["doc_id", "ids", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, ids binary, bytes binary")


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number of tokens, and digests of the ids and of the bytes they decode to, one row per row."""
    whole = decoded_documents(encoded_documents(docs, path), path)
    return whole.select(
        "doc_id", n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
