"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words that repeats itself with some smallest period q, at least ``max(MIN_LENGTH, MIN_POWER * q)``
words long, and cannot be extended at either end. Periods are dealt into scales, each from a least to a greatest period
about half as large again. A scale hashes every ``greatest - 1`` neighbouring words: inside a run of one of its periods
these are equal at the distance of the period and at no smaller one. Of the hashes in each window of neighbours only the
least is kept. Windows one period apart inside a run keep hashes one period apart, and the run is long enough for both
of them, so two neighbouring occurrences of an equal kept hash stand exactly one period apart in every run. Each such
pair is a seed, extended word by word to both ends and kept if the run is long enough and has no smaller period. Periods
up to ``SHORT_PERIOD`` are too short for windows; they are scanned directly, word against the word so far behind.

Words are compared by themselves; hashes only propose. Documents are put behind one another with a separator of their
own, so one step serves many short texts. Work per row only, no shuffle. A null or empty text has no words and no
runs. Rows keep ``doc_id`` as it is (null, repeated); other columns are left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import WORD, mixed, steps

MIN_LENGTH = 24
MIN_POWER = 3
SHORT_PERIOD = MIN_LENGTH // MIN_POWER
_ODD = 0x9E3779B97F4A7C15 | 1


def scales(longest: int) -> Iterator[tuple[int, int, int, int]]:
    """(least period, greatest period, words hashed together, places in a window) of each scale, up to ``longest``.

    A run of period q has 3q words, so a window of w places and its copy one period on, w + (k - 1) + q words in all,
    fit in it for every q of the scale: w + k - 1 <= 2 * least."""
    least = SHORT_PERIOD + 1
    while least <= longest:
        greatest = least + least // 2
        width = greatest - 1
        yield least, greatest, width, 2 * least - width + 1
        least = greatest + 1


class _Hashes:
    """Hashes of any number of neighbouring words, from running sums of word hashes times powers of an odd number."""

    def __init__(self, ids: np.ndarray) -> None:
        powers = np.full(len(ids), _ODD, np.uint64)
        powers[:1] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(len(ids), pow(_ODD, -1, 2**64), np.uint64)
        inverse[:1] = 1
        self._inverse = np.cumprod(inverse, dtype=np.uint64)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(ids.astype(np.uint64), 1) * powers, dtype=np.uint64)])

    def of(self, width: int) -> np.ndarray:
        n = len(self._inverse) - width + 1
        return mixed((self._sums[width:] - self._sums[:n]) * self._inverse[:n], 2)


def _sliding(values: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``width`` neighbours, by doubling."""
    out, size = values, 1
    while 2 * size <= width:
        out = of(out[:-size], out[size:])
        size *= 2
    n = len(values) - width + 1
    return of(out[:n], out[width - size : width - size + n])


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of some window of ``width`` places: of the windows over a place none has a
    greater minimum than the place's value, and one has that value."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    outside = np.zeros(width - 1, np.uint64)
    least = np.concatenate([outside, _sliding(values, width, np.minimum), outside])
    return np.flatnonzero(_sliding(least, width, np.maximum) == values)


def _extended(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``at`` whose words equal those one period on, as (start, end) of the run."""
    def reach(step: int) -> int:
        done, block = 0, 64
        while True:
            if step > 0:
                a = ids[at + done : at + done + block]
                b = ids[at + done + period : at + done + period + block]
                a = a[: len(b)]
            else:
                low = max(0, at - done - block)
                a = ids[low : at - done][::-1]
                b = ids[low + period : at - done + period][::-1]
            unequal = np.flatnonzero(a != b)
            if len(unequal):
                return done + int(unequal[0])
            done += len(a)
            if len(a) < block:
                return done
            block *= 2

    return at - reach(-1), at + reach(1) + period


def _primitive(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether no smaller period divides the stretch. As it holds three periods, any smaller one divides this one."""
    rest, divisor = period, 2
    while rest > 1:
        if divisor * divisor > rest:
            divisor = rest
        if rest % divisor == 0:
            smaller = period // divisor
            if np.array_equal(ids[start : end - smaller], ids[start + smaller : end]):
                return False
            while rest % divisor == 0:
                rest //= divisor
        divisor += 1
    return True


def _kept(ids: np.ndarray, found: set[tuple[int, int, int]], start: int, end: int, period: int) -> None:
    run = (start, end - start, period)
    if run not in found and end - start >= max(MIN_LENGTH, MIN_POWER * period) and _primitive(ids, start, end, period):
        found.add(run)


def runs_of(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period). ``longest`` is the longest part between separators."""
    found: set[tuple[int, int, int]] = set()
    longest = len(ids) if longest is None else longest
    for period in range(1, min(SHORT_PERIOD, longest // MIN_POWER) + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids[period:] == ids[:-period], [False]])))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start >= MIN_LENGTH - period:
                _kept(ids, found, start, stop + period, period)
    hashes = None
    for least, greatest, width, window in scales(longest // MIN_POWER):
        hashes = hashes or _Hashes(ids)
        values = hashes.of(width)
        places = minima(values, window)
        order = places[np.argsort(values[places], kind="stable")]
        ahead = order[1:] - order[:-1]
        pair = np.flatnonzero((values[order[1:]] == values[order[:-1]]) & (ahead >= least) & (ahead <= greatest))
        seeds = sorted(zip(ahead[pair].tolist(), order[pair].tolist()))
        last_period = end = -1
        for period, at in seeds:
            if period != last_period or at + period >= end:
                start, end = _extended(ids, at, period)
                last_period = period
                _kept(ids, found, start, end, period)
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: the runs (start, length, period) in order of start and period, and the words
    that no run holds behind its first period, joined by one space."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = [n or 0 for n in pa.compute.binary_length(texts).to_pylist()]
            for low, high in steps(sizes):
                words = [(t or "").encode().split() for t in texts.slice(low, high - low).to_pylist()]
                n_words, runs, collapsed = [], [], []
                for found, parts in zip(_runs_of_texts(words), words):
                    n_words.append(len(parts))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    if found:
                        gone = np.zeros(len(parts) + 1, np.int64)
                        for start, length, period in found:
                            gone[start + period] += 1
                            gone[start + length] -= 1
                        parts = [w for w, g in zip(parts, np.cumsum(gone).tolist()) if not g]
                    collapsed.append(b" ".join(parts).decode())
                yield pa.RecordBatch.from_arrays([
                    keys.slice(low, high - low), pa.array(n_words, pa.int64()), pa.array(runs, _RUNS), pa.array(collapsed, pa.string()),
                ], ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        find, f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text. Texts of like length share a row of words, as the scales follow the longest of them."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    groups: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= MIN_LENGTH:
            groups.setdefault(len(words).bit_length(), []).append(i)
    for members in groups.values():
        known: dict[bytes, int] = {}
        parts, starts, at = [], [], 0
        for turn, i in enumerate(members):
            ids = [known.setdefault(w, len(known)) for w in texts[i]]
            parts += [np.array(ids, np.int64), np.array([-1 - turn], np.int64)]  # a separator is like no other word
            starts.append(at)
            at += len(ids) + 1
        ends = np.array(starts)
        for start, length, period in runs_of(np.concatenate(parts), max(len(texts[i]) for i in members)):
            turn = int(np.searchsorted(ends, start, "right")) - 1
            out[members[turn]].append((start - starts[turn], length, period))
    return out


def planted(docs: DataFrame) -> DataFrame:
    """The documents of the query: one in ten by the crc32 of its id has its words from some place on replaced by
    repetitions of the first of them. Rows without an id stay."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    n, g = F.size("_words"), F.floor(mark / 10)
    rows = docs.select("doc_id", "text", F.when(mark % 10 == 0, words).alias("_words"))
    rows = rows.withColumn("_from", F.when(n > 0, (g % n).cast("int")))
    rows = rows.withColumn("_period", F.when(n > 0, (F.floor((n - F.col("_from")) / (3 + g % 8)) + 1).cast("int")))
    again = F.transform("_words", lambda w, i: F.when(i < F.col("_from"), w).otherwise(
        F.get("_words", F.col("_from") + (i - F.col("_from")) % F.col("_period"))))
    return rows.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run of greatest length by period, compared exactly; of equal ones the first by start, then period."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def digest(docs: DataFrame) -> DataFrame:
    """Number of runs, the strongest run, and digests of all runs and of the kept words, one row per row."""
    found = periodic_runs(planted(docs)).withColumn("_best", strongest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _crc_table() -> str:
    """The values by which crc32 is taken byte by byte, from its rule."""
    values = list(range(256))
    for _ in range(8):
        values = [v >> 1 ^ (0xEDB88320 if v & 1 else 0) for v in values]
    return ", ".join(map(str, values))


#: Words so far apart are compared sixteen at a time: a run holds at least as many equal neighbours.
SQL = rf"""
WITH crc AS (
  SELECT [{_crc_table()}]::BIGINT[] AS t
), given AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM documents, crc
), sized AS (
  SELECT *, len(w) AS n, h // 10 AS g FROM given
), starts AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized
), periods AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM starts
), words AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END) END AS w
  FROM periods
), grams AS (
  SELECT r, n, i, md5(array_to_string(w[i + 1 : i + 16], ' ')) AS gram
  FROM (SELECT r, n, w, unnest(range(n - 15)) AS i FROM words WHERE n >= 24)
), pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i
  WHERE 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT r, q, min(i) AS s, max(i) - min(i) + 16 + q AS l FROM islands GROUP BY r, q, island
), long AS (
  SELECT * FROM stretches WHERE l >= 24 AND l >= 3 * q
), runs AS (
  SELECT * FROM long x WHERE NOT EXISTS (
    SELECT 1 FROM long y WHERE y.r = x.r AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND y.s + y.l >= x.s + x.l)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY l::DOUBLE / q DESC, s, q) AS place FROM runs
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listing FROM runs GROUP BY r
), gone AS (
  SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
  SELECT x.r, string_agg(x.word, ' ' ORDER BY x.i) AS kept
  FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM words) x LEFT JOIN gone y ON x.r = y.r AND x.i = y.i
  WHERE y.i IS NULL GROUP BY x.r
)
SELECT w.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.q::BIGINT AS period,
  (1000 * b.l // b.q)::BIGINT AS exponent_milli, sha256(coalesce(l.listing, '')) AS runs_sha256,
  sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM words w LEFT JOIN listed l ON w.r = l.r LEFT JOIN ranked b ON w.r = b.r AND b.place = 1 LEFT JOIN kept k ON w.r = k.r
"""
