"""Counts over whole texts, made in Arrow batches: what the quality rules and the base rules read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from variantloom.llm.common import hashed_words, mixed, steps, window_hashes, window_starts, words

_SPACE = bytes([9, 10, 11, 12, 13, 32])
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_STOPS = b"!?.,;:"
_DIGITS = b"0123456789"
_BROKEN = bytes(range(128, 192))  # continuation bytes: all other bytes begin a character
#: Width of the windows whose repeats count.
REPEAT_WIDTH = 5

FIELDS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_stops", "n_digits", "n_distinct",
)


def repeated_words(hashes: np.ndarray, counts: np.ndarray, width: int = REPEAT_WIDTH) -> np.ndarray:
    """For each text, its words that lie in a window found twice or more in that text."""
    starts, owner = window_starts(counts, width)
    if not len(starts):
        return np.zeros(len(counts), np.int64)
    windows = window_hashes(hashes, width)[starts] ^ mixed(owner[starts].astype(np.uint64), 3)
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[starts[twice]] += 1
    edges[starts[twice] + width] -= 1  # starts are distinct, so no addition is lost
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(counts))


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return len(lines), len(lines) - len(set(lines))


def counts_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    without = lambda t, drop: len(t) - len(t.translate(None, drop))
    parts = [t.split() for t in texts]
    hashes, n = hashed_words(parts)
    lines = [line_counts(t) for t in texts]
    out = {
        "n_words": n,
        "word_chars": [len(t) - without(t, _SPACE) - without(t, _BROKEN) for t in texts],
        "n_symbols": [without(t, _SYMBOLS) for t in texts],
        "n_dup_lines": [d for _, d in lines],
        "n_repeat_words": repeated_words(hashes, n),
        "n_lines": [k for k, _ in lines],
        "n_upper": [without(t, _UPPER) for t in texts],
        "n_stops": [without(t, _STOPS) for t in texts],
        "n_digits": [without(t, _DIGITS) for t in texts],
        "n_distinct": [len(set(p)) for p in parts],
    }
    return {k: np.asarray(out[k], np.int64) for k in FIELDS}


def with_text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of ``FIELDS``, one row per row of ``docs``; a null text has zeros only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = [0 if t is None else t for t in pa.compute.binary_length(texts).to_pylist()]
            for low, high in steps(sizes):
                part = [(t or "").encode() for t in texts.slice(low, high - low).to_pylist()]
                values = counts_of(part)
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), *map(pa.array, values.values())], ["doc_id", *FIELDS])

    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", *(f"{f} long" for f in FIELDS)])
    return docs.select("doc_id", "text").mapInArrow(count, schema)
