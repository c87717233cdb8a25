"""Line dedup, substring dedup and the n-gram join against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from variantloom.llm import components, line_dedup, ngram_join, substring_dedup
from variantloom.llm.common import window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_window_hashes_know_their_words():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, 400).astype(np.uint64)
    for width in (1, 2, 5, 25, 50):
        seen = {}
        hashes = window_hashes(x, width)
        assert len(hashes) == 400 - width + 1
        for i, h in enumerate(hashes.tolist()):
            assert seen.setdefault(h, tuple(x[i : i + width])) == tuple(x[i : i + width])
        assert len(seen) == len(set(seen.values()))


def test_repeats_equal_brute_force(docs):
    rows = [r for r in docs.select("doc_id", "text").collect()]
    least = {}
    for r in rows:
        w = words(r["text"])
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            if r["doc_id"] is not None:
                least[key] = min(least.get(key, r["doc_id"]), r["doc_id"])
    expected = []
    for r in rows:
        w = words(r["text"])
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if r["doc_id"] is not None and least[tuple(w[i : i + 50])] < r["doc_id"]:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected.append((r["doc_id"], len(w), sum(gone), digest(kept), kept))
    found = substring_dedup.without_repeats(docs, keep_text=True).collect()
    order = lambda x: (x[0] is None, x)
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) for r in found], key=order) == sorted(expected, key=order)
    assert sum(x[2] for x in expected) > 200
    for r in found:
        assert sum(s["end"] - s["first"] for s in r["spans"]) == r["n_removed"]


def test_repeats_in_many_chunks(docs, monkeypatch):
    from variantloom.llm import chunks

    whole = sorted(map(tuple, substring_dedup.digest(docs.filter("doc_id is not null")).collect()))
    monkeypatch.setattr(chunks, "BUCKET_HASHES", 300)
    assert sorted(map(tuple, substring_dedup.digest(docs.filter("doc_id is not null").repartition(9)).collect())) == whole


def shingles(text):
    w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def test_join_equals_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    sets = defaultdict(list)
    for r in rows:
        sets[r["doc_id"]].append(shingles(r["text"]))
    ids = sorted(i for i in sets if i is not None)
    least = {i: i for i in ids}
    links = [
        (a, b) for a in ids for b in ids if b < a
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    found = ngram_join.joined_documents(docs).collect()
    assert len(found) == len(rows) and len(links) > 5
    for r in found:
        assert r["component_id"] == (None if r["doc_id"] is None else least[r["doc_id"]])
        assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(set(least.values()))
    assert kept.filter("doc_id is null").count() == 2


def test_join_of_one_large_group(spark):
    """Near copies that are similar to a middle text, but not all to each other, and a chain of small steps."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(40):
        own = list(base)
        for j in range(3):
            own[(k * 5 + j * 67) % 200] = f"x{k}-{j}"
        rows.append((k + 1, " ".join(own)))
    chain = [f"c{i}" for i in range(120)]
    for k in range(12):
        rows.append((500 + k, " ".join(chain[k * 8 : k * 8 + 100] + [f"z{k * 8 + i}" for i in range(0)])))
    rows.append((0, " ".join(base)))
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    for _ in range(60):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    found = ngram_join.joined_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == least


def test_join_of_chunks_without_candidates(spark):
    """A chunk of copies of another chunk's documents, and one whose sets share nothing, send no sets."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(4)]
    parts = [rows, [(10 + i, t) for i, t in rows], [(20, "nothing that stands anywhere else but here")], []]
    docs = spark.sparkContext.parallelize(range(4), 4).flatMap(lambda n: parts[n]).toDF("doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.joined_documents(docs).collect()}
    assert found == {**{i: i % 10 for i, _ in [*parts[0], *parts[1]]}, 20: 20}


def test_prefixes_meet_whatever_the_order():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(4, 60))
        a = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
        b = a.copy()
        b[: n // 9] = rng.choice(1 << 41, n // 9, replace=False).astype(np.uint64)
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (2 * n - both):
            continue
        least = ngram_join.least_common(n, n)
        assert both >= least
        values, of = np.concatenate([np.sort(a), np.sort(b)]), np.repeat([0, 1], n)
        spread = np.array([int(v % 7) + 2 if v in set(a) & set(b) else 1 for v in values.tolist()])
        for k in range(ngram_join.ORDERS):
            order, rank = ngram_join.ranked(values, of, spread, k)
            early = rank <= n - least
            assert set(values[order[early & (of == 0)]]) & set(values[order[early & (of == 1)]])
            assert (np.diff(np.minimum(spread[order[:n]], 2)) >= 0).all()


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(500, 499), (5, 5)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 60)}, 499: 499, 500: 499}


def test_lines_equal_brute_force(docs):
    rows = [r.asDict() for r in docs.collect()]
    space = " \t\n\x0b\x0c\r"
    sites, first = defaultdict(set), {}
    for r in rows:
        for k, line in enumerate((r["text"] or "").split("\n") if r["text"] is not None else []):
            key = line.strip(space)
            if key:
                if r["source"] is not None:
                    sites[key].add(r["source"])
                place = (r["doc_id"] is None, r["doc_id"] or 0, k)
                first[key] = min(first.get(key, place), place)
    expected = []
    for r in rows:
        lines = r["text"].split("\n") if r["text"] is not None else []
        keep = [
            x for k, x in enumerate(lines)
            if not x.strip(space) or len(sites[x.strip(space)]) < 6 or first[x.strip(space)] == (r["doc_id"] is None, r["doc_id"] or 0, k)
        ]
        text = None if r["text"] is None else "\n".join(keep)
        expected.append((r["doc_id"], text, r["lang"], r["source"], r["_gone"], r["line"], sum(bool(x.strip(space)) for x in lines), len(lines) - len(keep)))
    out = line_dedup.without_boilerplate(docs, sites=6)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    found = [(r["doc_id"], r["text"], r["lang"], r["source"], r["_gone"], r["line"], r["n_lines"], r["n_removed"]) for r in out.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert sum(x[-1] for x in expected) >= 40


def test_sketches_near_the_threshold_are_counted(spark):
    rows = [(i, f"line {k}", f"s{i % (96 + k)}") for k in range(9) for i in range(300)]
    rows = [(n, t, s) for n, (_, t, s) in enumerate(rows)]
    found = line_dedup.spread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), sites=100)
    h1, _ = line_dedup.line_hash(F.col("text"))
    names = spark.createDataFrame([(f"line {k}",) for k in range(9)], "text string").select("text", h1.alias("h1"))
    assert {r["text"] for r in found.join(names, "h1").collect()} == {f"line {k}" for k in range(4, 9)}


def test_empty_tables(no_docs):
    assert substring_dedup.digest(no_docs).count() == 0
    assert ngram_join.joined_documents(no_docs).count() == 0
    assert ngram_join.one_of_each_group(no_docs).count() == 0
    assert line_dedup.without_boilerplate(no_docs).count() == 0
