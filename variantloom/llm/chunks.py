"""Documents in packed chunks, and packed messages between chunks and buckets of hashes.

Operators that look up a hash for every word cannot afford a Spark row for each. A chunk is a few megabytes of whole
documents, compressed, in one row of a staged table. It sends each bucket (a range of hash values) one row with
its distinct hashes, sorted and packed, so that a hash which stands everywhere crosses the network once per chunk; a
bucket answers with the few hashes that concern the chunk. The number of buckets follows the number of words, so
a bucket's share stays the same at every size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import steps

#: Characters of a chunk; a longer text is a chunk by itself.
CHUNK_CHARS = 4_000_000
#: Hashes that a bucket receives, on average, before equal ones of a chunk are joined.
BUCKET_HASHES = 1_500_000
CHUNK_SCHEMA = "chunk long, n_docs int, ids binary, known binary, sizes binary, texts binary"


def pack(values: np.ndarray) -> bytes:
    """An array as compressed byte planes; sorted integers as their differences."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 1)


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)


@dataclass
class Chunk:
    """Documents of a chunk: ids (0 where ``known`` is false) and texts as UTF-8; a null text is empty."""

    number: int
    ids: np.ndarray
    known: np.ndarray
    texts: list[bytes]


def chunked(docs: DataFrame) -> DataFrame:
    """``doc_id`` (integers) and ``text`` of all rows as chunks, each with a number of its own. Stage the result."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            values = [
                [part << 32 | serial], [len(ids)], [pack(np.array([i or 0 for i in ids], np.int64))],
                [pack(np.array([i is not None for i in ids], np.uint8))],
                [pack(np.array([len(t) for t in texts], np.int64))], [zstandard.compress(b"".join(texts), 3)],
            ]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            names = ["chunk", "n_docs", "ids", "known", "sizes", "texts"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            column = batch.column(1)
            for low, high in steps([n or 0 for n in pa.compute.binary_length(column).to_pylist()], CHUNK_CHARS):
                more = [(t or "").encode() for t in column.slice(low, high - low).to_pylist()]
                count = sum(map(len, more))
                if ids and size + count > CHUNK_CHARS:
                    yield row()
                    serial, ids, texts, size = serial + 1, [], [], 0
                ids += batch.column(0).slice(low, high - low).to_pylist()
                texts += more
                size += count
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(gather, CHUNK_SCHEMA)


def opened(row) -> Chunk:
    sizes, data = unpack(row.sizes, np.int64), zstandard.decompress(row.texts)
    ends = np.cumsum(sizes)
    texts = [data[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
    return Chunk(row.chunk, unpack(row.ids, np.int64), unpack(row.known, np.uint8) > 0, texts)


def bucket_count(docs: DataFrame) -> int:
    """Buckets for one hash per word, from the texts' total size and at least six characters to a word."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-chars // 6 // BUCKET_HASHES))


def bucket_codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket (from a hash's upper half, in order) above the hash's lower half. Sorted hashes give sorted codes
    but for what stands in one bucket."""
    low = np.uint64(0xFFFFFFFF)
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32) << np.uint64(32)) | (hashes & low)


def runs_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets in sorted codes, and where each one's run starts, with the end at last."""
    of = (codes >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    return of[starts], np.append(starts, len(codes))


def found_at(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in the sorted table, and its place there."""
    if not len(table):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def least_of(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the least value of each."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], values[first]


def joined_arrays(parts: Sequence[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if len(parts) else np.zeros(0, dtype)
