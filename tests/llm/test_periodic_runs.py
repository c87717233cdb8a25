"""Periodic runs against trying every period at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from variantloom.llm import periodic_runs
from variantloom.llm.common import WORD


def brute(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, n):
    kinds = rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        unit = [rng.randrange(rng.choice([1, 2, 3, 99])) for _ in range(rng.randrange(1, max(2, n // 3)))]
        start = rng.randrange(n)
        for i in range(start, min(n, start + rng.randrange(1, n + 1))):
            words[i] = unit[(i - start) % len(unit)]
        if rng.random() < 0.3:
            words[rng.randrange(n)] = 7
    return words


def test_runs_are_all_runs():
    rng, found = random.Random(5), 0
    for _ in range(700):
        words = periodic(rng, rng.randrange(1, 400))
        want = brute(words)
        found += len(want)
        assert periodic_runs.runs_of(np.array(words)) == want
    assert found > 200


def test_long_periods_and_nested_runs():
    rng = random.Random(6)
    inner = [1, 2, 3] * 12 + [rng.randrange(100, 200) for _ in range(300)]
    words = [9] * 30 + inner * 3 + inner[:50] + [4]
    assert periodic_runs.runs_of(np.array(words)) == brute(words)
    block = [rng.randrange(10**6) for _ in range(1700)]
    assert periodic_runs.runs_of(np.array(block * 4 + block[:11])) == [(0, 6811, 1700)]


def test_minima_are_those_of_windows():
    rng = np.random.default_rng(1)
    for n, width in ((1, 1), (5, 5), (40, 7), (40, 16), (200, 9), (3, 5)):
        values = rng.integers(0, 30, n).astype(np.uint64)
        want = sorted({i + int(j) for i in range(n - width + 1) for j in np.flatnonzero(values[i : i + width] == values[i : i + width].min())})
        assert periodic_runs.minima(values, width).tolist() == want


def expected(doc_id, text):
    words = re.findall(WORD, text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_every_row(spark, docs, no_docs):
    rng = random.Random(8)
    # ids whose words are replaced, among them texts with runs of their own
    more = [(i, " ".join(f"w{w}" for w in periodic(rng, rng.randrange(1, 200)))) for i in range(2000, 2120)]
    given = docs.select("doc_id", "text", "score", "line").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = given.collect()
    got = sorted(map(tuple, periodic_runs.digest(given).collect()), key=str)
    assert got == sorted((expected(r["doc_id"], r["text"]) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 20
    assert periodic_runs.digest(no_docs).count() == 0
    whole = periodic_runs.periodic_runs(docs).collect()
    assert len(whole) == docs.count() and all(r["n_words"] >= len(r["collapsed"].split()) for r in whole)
