"""Substring dedup: words that lie in a passage which an earlier document has word for word.

Fixed-block anchors. Every document is cut into blocks of words that do not overlap; a passage of ``WIDTH`` words
contains a whole block wherever it begins. So the blocks are the index, and every rolling window of a block's
length probes it. A window that hits a block of an earlier document is a seed. Around seeds, and around blocks that
were hit, the windows of the full width are compared, all of them; neighbouring windows that are repeats
join to the maximal exact repeat. No pairs of documents are formed: a hash has one least document."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.chunks import (
    Chunk, bucket_codes, bucket_count, chunked, found_at, joined_arrays, least_of, opened, pack, pack_sorted, runs_of,
    unpack, unpack_sorted,
)
from variantloom.llm.common import hashed_words, stage, window_hashes, window_starts

#: Words of the shortest passage that is a repeat.
WIDTH = 50


def block_words(width: int) -> int:
    """The longest block of which any ``width`` words contain a whole one, aligned to a multiple of its length."""
    return (width + 1) // 2


class _Words:
    """A chunk's words: the parts of its documents, their hashes, and the document of each word."""

    def __init__(self, chunk: Chunk) -> None:
        self.parts = [t.split() for t in chunk.texts]
        self.hashes, self.counts = hashed_words(self.parts)
        self.ends = np.cumsum(self.counts)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.ids, self.known = chunk.ids, chunk.known

    def windows(self, width: int, least: int) -> np.ndarray:
        """Where windows start, in documents with an id and ``least`` words."""
        starts, _ = window_starts(self.counts, width)
        usable = self.known & (self.counts >= least)
        return starts[usable[self.owner[starts]]]

    def aligned(self, starts: np.ndarray, block: int) -> np.ndarray:
        of = self.owner[starts]
        return (starts - (self.ends[of] - self.counts[of])) % block == 0


def _anchors(width: int, buckets: int):
    block = block_words(width)

    def send(frames):
        for frame in frames:
            for row in frame.itertuples():
                w = _Words(opened(row))
                starts = w.windows(block, width)
                if not len(starts):
                    continue
                codes = bucket_codes(window_hashes(w.hashes, block)[starts], buckets)
                order = np.argsort(codes, kind="stable")
                ranked, owner = codes[order], w.owner[starts][order]
                new = np.append(True, ranked[1:] != ranked[:-1])
                first = np.flatnonzero(new)
                # hashes that two documents of this chunk share
                twice = np.zeros(len(first), bool)
                twice[(np.cumsum(new) - 1)[1:][~new[1:] & (owner[1:] != owner[:-1])]] = True
                probes = ranked[first]
                inside = w.aligned(starts, block)
                blocks, docs = least_of(codes[inside], w.ids[w.owner[starts[inside]]])
                names, runs = runs_of(probes)
                edges = np.searchsorted(blocks, names.astype(np.uint64) << np.uint64(32))
                edges = np.append(edges, len(blocks))
                low = np.uint32
                yield pd.DataFrame({
                    "bucket": names.astype(np.int32), "chunk": row.chunk,
                    "probes": [pack_sorted(probes[a:b].astype(low)) for a, b in zip(runs[:-1], runs[1:], strict=True)],
                    "twice": [pack(twice[a:b].view(np.uint8)) for a, b in zip(runs[:-1], runs[1:], strict=True)],
                    "blocks": [pack_sorted(blocks[a:b].astype(low)) for a, b in zip(edges[:-1], edges[1:], strict=True)],
                    "docs": [pack(docs[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)],
                })

    return send


def _probe(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers each chunk with its hashes that are a block somewhere and stand in two documents at least."""
    probes = [unpack_sorted(x, np.uint32) for x in frame["probes"]]
    blocks, docs = least_of(
        joined_arrays([unpack_sorted(x, np.uint32) for x in frame["blocks"]], np.uint32),
        joined_arrays([unpack(x, np.int64) for x in frame["docs"]], np.int64),
    )
    hits, twice = np.zeros(len(blocks), np.int64), np.zeros(len(blocks), bool)
    places = []
    for own, more in zip(probes, frame["twice"], strict=True):
        inside, at = found_at(own, blocks)
        hits[at[inside]] += 1
        twice[at[inside & (unpack(more, np.uint8) > 0)]] = True
        places.append((inside, at))
    shared = twice | (hits > 1)
    out = {"chunk": [], "bucket": [], "hashes": [], "docs": []}
    for chunk, bucket, own, (inside, at) in zip(frame["chunk"], frame["bucket"], probes, places, strict=True):
        use = inside & shared[at]
        if use.any():
            out["chunk"].append(chunk)
            out["bucket"].append(bucket)
            out["hashes"].append(pack_sorted(own[use]))
            out["docs"].append(pack(docs[at[use]]))
    return pd.DataFrame(out)


def _answers(frame: pd.DataFrame, hashes: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The answers to a chunk as sorted codes with their documents."""
    codes = [
        unpack_sorted(x, dtype).astype(np.uint64) | (np.uint64(b) << np.uint64(32) if dtype is np.uint32 else np.uint64(0))
        for b, x in zip(frame["bucket"], frame[hashes], strict=True)
    ]
    codes = joined_arrays(codes, np.uint64)
    docs = joined_arrays([unpack(x, np.int64) for x in frame["docs"]], np.int64)
    order = np.argsort(codes, kind="stable")
    return codes[order], docs[order]


def _extend(width: int, buckets: int):
    block = block_words(width)

    def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"bucket": [], "chunk": [], "hashes": [], "docs": []}
        if not len(left) or not len(right):
            return pd.DataFrame(out)
        row = next(left.itertuples())
        w = _Words(opened(row))
        starts = w.windows(block, width)
        codes = bucket_codes(window_hashes(w.hashes, block)[starts], buckets)
        table, docs = _answers(right, "hashes", np.uint32)
        hit, at = found_at(codes, table)
        own = w.ids[w.owner[starts]]
        seeds = starts[hit & ((docs[at] < own if len(docs) else hit) | w.aligned(starts, block))]
        # windows of full width that contain a seed, within its document
        of = w.owner[seeds]
        first = np.maximum(seeds - (width - block), w.ends[of] - w.counts[of])
        last = np.minimum(seeds, w.ends[of] - width)
        edges = np.zeros(len(w.hashes) + 1, np.int64)
        np.add.at(edges, first, 1)
        np.add.at(edges, last + 1, -1)
        wanted = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        if not len(wanted):
            return pd.DataFrame(out)
        hashes, docs = least_of(window_hashes(w.hashes, width)[wanted], w.ids[w.owner[wanted]])
        codes = bucket_codes(hashes, buckets)
        names, runs = runs_of(codes)
        for name, a, b in zip(names, runs[:-1], runs[1:], strict=True):
            out["bucket"].append(int(name))
            out["chunk"].append(row.chunk)
            out["hashes"].append(pack(hashes[a:b]))
            out["docs"].append(pack(docs[a:b]))
        return pd.DataFrame(out)

    return send


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers each chunk with its windows that stand in an earlier document elsewhere."""
    hashes = [unpack(x, np.uint64) for x in frame["hashes"]]
    docs = [unpack(x, np.int64) for x in frame["docs"]]
    table, least = least_of(joined_arrays(hashes, np.uint64), joined_arrays(docs, np.int64))
    out = {"chunk": [], "bucket": [], "hashes": [], "docs": []}
    for chunk, bucket, own, first in zip(frame["chunk"], frame["bucket"], hashes, docs, strict=True):
        earlier = least[np.searchsorted(table, own)]
        use = earlier < first
        if use.any():
            out["chunk"].append(chunk)
            out["bucket"].append(bucket)
            out["hashes"].append(pack_sorted(own[use]))
            out["docs"].append(pack(earlier[use]))
    return pd.DataFrame(out)


def _cut(width: int, keep_text: bool):
    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"] + ["kept"] * keep_text
        if not len(left):
            return pd.DataFrame({c: [] for c in columns})
        w = _Words(opened(next(left.itertuples())))
        starts = w.windows(width, width)
        gone = np.zeros(len(w.hashes), bool)
        if len(starts):
            hashes = window_hashes(w.hashes, width)[starts]
            own = w.ids[w.owner[starts]]
            here, least = least_of(hashes, own)
            again = least[np.searchsorted(here, hashes)] < own
            table, docs = _answers(right, "hashes", np.uint64)
            hit, at = found_at(hashes, table)
            if len(docs):
                again |= hit & (docs[at] < own)
            edges = np.zeros(len(w.hashes) + 1, np.int64)
            edges[starts[again]] += 1
            edges[starts[again] + width] -= 1
            gone = np.cumsum(edges[:-1]) > 0
        rows = {c: [] for c in columns}
        for i, parts in enumerate(w.parts):
            mask = gone[w.ends[i] - w.counts[i] : w.ends[i]]
            kept = b" ".join(compress(parts, ~mask))
            steps = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            rows["doc_id"].append(int(w.ids[i]) if w.known[i] else None)
            rows["n_words"].append(len(parts))
            rows["n_removed"].append(int(mask.sum()))
            rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            rows["spans"].append([{"first": int(a), "end": int(b)} for a, b in steps.reshape(-1, 2)])
            if keep_text:
                rows["kept"].append(kept.decode())
        return pd.DataFrame(rows).astype({"doc_id": "Int64"})

    return cut


def without_repeats(docs: DataFrame, width: int = WIDTH, keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``, ``spans`` (the word ranges of the maximal
    repeats that go) and, if asked for, ``kept`` (what stays, joined by single spaces).

    A word goes if a window of ``width`` words around it also starts in a document with a smaller id; windows
    are judged on the texts as given. Rows with one id do not take from each other. A document without an id
    neither gives nor takes; a null or empty text has no words."""
    buckets = bucket_count(docs)
    chunks = stage(chunked(docs), "repeat-chunks")
    anchors = chunks.mapInPandas(
        _anchors(width, buckets), "bucket int, chunk long, probes binary, twice binary, blocks binary, docs binary"
    )
    answer = "chunk long, bucket int, hashes binary, docs binary"
    seeds = anchors.groupBy("bucket").applyInPandas(_probe, answer)
    windows = chunks.groupBy("chunk").cogroup(seeds.groupBy("chunk")).applyInPandas(
        _extend(width, buckets), "bucket int, chunk long, hashes binary, docs binary"
    )
    repeats = windows.groupBy("bucket").applyInPandas(_compare, answer)
    return chunks.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInPandas(
        _cut(width, keep_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first: long, end: long>>"
        + ", kept string" * keep_text,
    )


def digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = """
WITH cut AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS pos FROM cut WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos : pos + 49], ' ')) AS passage FROM starts
), judged AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY passage) < doc_id AS again FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS pos FROM judged WHERE again
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM cut
), kept AS (
  SELECT p.doc_id, count(g.pos) AS n_removed, string_agg(p.word, ' ' ORDER BY p.pos) FILTER (g.pos IS NULL) AS kept
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id
)
SELECT c.doc_id, len(c.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM cut c LEFT JOIN kept k ON c.doc_id = k.doc_id
"""
