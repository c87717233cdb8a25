"""Free-text search against brute force in plain Python."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from variantloom.operators import search as se

DOCUMENT = "id string, name string, age int, seen boolean, tags array<struct<code:string,notes:array<string>>>, extra map<string,string>"


def flat(row):
    texts = [row[0], row[1], None if row[2] is None else str(row[2])]
    for tag in row[4] or []:
        texts += [tag[0], *(tag[1] or [])] if tag else []
    for k, v in (row[5] or {}).items():
        texts += [k, v]
    return Counter(w for t in texts if t for w in re.findall(r"[^\W_]+", t.lower()))


def brute(rows, queries, hits):
    counts = {r[0]: flat(r) for r in rows}
    have = Counter(w for c in counts.values() for w in c)
    weight = {w: round(1000 * math.log1p(len(counts) / n)) for w, n in have.items()}
    out = set()
    for q, text in queries:
        words = set(re.findall(r"[^\W_]+", (text or "").lower()))
        scores = [(-sum(2 * weight[w] * c[w] // (c[w] + 1) for w in words if c[w]), d) for d, c in counts.items() if words & set(c)]
        out |= {(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:hits])}
    return out


def found(spark, tmp_path, rows, queries, hits, name="index", fields=None):
    root = str(tmp_path / name)
    se.write_index(spark.createDataFrame(rows, DOCUMENT), "id", root)
    asked = spark.createDataFrame(queries, "q string, text string")
    return {tuple(r) for r in se.search(root, asked, "q", "text", hits, fields).collect()}


def test_search_equals_brute_force(spark, tmp_path):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    some = lambda n: " ".join(words[min(39, int(draw.expovariate(0.15)))] for _ in range(n))
    rows = [(f"D{i:03d}", some(3), draw.randrange(9), True, [(some(1), [some(2), None]), None, ("É-" + some(1), None)] if i % 3 else None,
             {"k": some(1)} if i % 2 else None) for i in range(120)]
    queries = [(f"q{i}", some(draw.randrange(1, 6))) for i in range(60)] + [("none", "unknown"), ("empty", ""), ("null", None), ("é", "É w0")]
    for hits in (1, 4):
        assert found(spark, tmp_path, rows, queries, hits, f"index{hits}") == brute(rows, queries, hits)


def test_frequent_words_lose_no_hit(spark, tmp_path):
    """The best document lacks the rarest token: two frequent tokens together outweigh it."""
    rows = [("A", "rare " + "x " * 30, 1, None, None, None), ("B", "often " * 20 + "usual " * 20, 1, None, None, None)]
    rows += [(f"C{i}", "often" if i % 2 else "usual", 1, None, None, None) for i in range(4)]
    queries = [("q", "rare often usual"), ("ties", "OFTEN")]
    got = found(spark, tmp_path, rows, queries, 1)
    assert got == brute(rows, queries, 1) and {(q, d) for q, _, d, _ in got} == {("q", "B"), ("ties", "B")}


def test_names_of_one_document_share_their_other_words(spark, tmp_path, monkeypatch):
    """Each query has a word that one document has, and two that many have: the many are searched once for all queries."""
    draw = random.Random(3)
    rows = [(f"D{i:03d}", f"own{i} " + " ".join(draw.choices(["usual", "often", "w1", "w2"], k=5)), 1, None, None, None) for i in range(60)]
    queries = [(f"q{i}", f"own{i} own{i + 1} usual often") for i in range(0, 60, 2)] + [(f"r{i}", f"own{i} often") for i in range(60)]
    calls, best = [], se._best_documents
    monkeypatch.setattr(se, "_best_documents", lambda terms, *rest: calls.append(terms.select("wanted").distinct().count()) or best(terms, *rest))
    monkeypatch.setattr(se, "SHARED", 2)
    assert found(spark, tmp_path, rows, queries, 3) == brute(rows, queries, 3)
    # without their rarest word the first queries still differ, then there are two sets of words
    assert calls == [90, 31, 1]


def test_search_in_some_fields(spark, tmp_path):
    rows = [("A", "heart", 1, None, [("lung", ["heart"])], None), ("B", "lung", 1, None, None, None)]
    assert {(q, d) for q, _, d, _ in found(spark, tmp_path, rows, [("q", "Lung")], 5, fields=["name"])} == {("q", "B")}
    assert {(q, d) for q, _, d, _ in found(spark, tmp_path, rows, [("q", "Lung")], 5, "again")} == {("q", "A"), ("q", "B")}


def test_empty_tables(spark, tmp_path):
    assert found(spark, tmp_path, [], [("q", "a")], 1) == set()
    assert found(spark, tmp_path, [(None, "a", 1, None, None, None), ("A", None, None, None, None, None)], [("q", "a"), ("z", "1")], 1, "nulls") == {
        ("q", 1, "A", 693)}


def test_paths_of_a_document(spark):
    rows = spark.createDataFrame([("A", "x", 3, True, [("c", ["n"])], {"k": "v"})], DOCUMENT)
    got = {(r["field"], r["token"]) for r in se.postings(rows.select("*", F.lit(b"z").alias("raw")), "id").collect()}
    assert got == {("id", "a"), ("name", "x"), ("age", "3"), ("tags.code", "c"), ("tags.notes", "n"), ("extra.key", "k"), ("extra.value", "v")}
