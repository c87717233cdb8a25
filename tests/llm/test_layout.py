"""Mixing, packing and sharding."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from variantloom.llm import mixing, packing, sharding


def test_targets_fill_up_and_stop():
    targets = mixing.fill_targets(np.array([100, 1000, 50, 10]), np.array([3.0, 1, 2, 3]), 1.5 * 1160, 2.0)
    assert targets[0] == 200 and targets[2] == 100 and targets[3] == 20
    assert targets[1] == pytest.approx(1.5 * 1160 - 320)
    assert mixing.fill_targets(np.array([5, 5]), np.array([1.0, 1]), 100, 2.0).tolist() == [10, 10]
    assert mixing.fill_targets(np.zeros(0, int), np.zeros(0), 0, 2.0).tolist() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4099])
def test_permutations_are_permutations(n):
    k = np.arange(n)
    out = mixing.permuted(k, n, 99)
    assert sorted(out.tolist()) == k.tolist()
    assert (mixing.permuted(out, n, 99, inverse=True) == k).all()
    if n > 100:
        assert (out != k).mean() > 0.9 and (out != mixing.permuted(k, n, 100)).mean() > 0.9


def test_shards_deal_out_every_slot():
    plan = mixing.make_plan([("b", 90_000), ("a", 50_000), (None, 700)], (3, 1, 2), 1.5, 2.0, block_words=64, shard_blocks=50)
    assert plan.sources == ["a", "b", None] and plan.shards > 30
    total = np.zeros(3, int)
    for shard in range(plan.shards):
        counts, before = mixing.shard_counts(plan, shard)
        assert (before == total).all()
        total += counts
    assert (total == plan.slots).all()


def test_mix_meets_targets(docs, spark):
    rows = [r.asDict() for r in mixing.mixed_sizes(docs, block_words=16, shard_blocks=40).collect()]
    sizes, taken = defaultdict(int), defaultdict(int)
    own = defaultdict(list)
    for r in docs.collect():
        n = len((r["text"] or "").encode().split())
        sizes[r["source"]] += n
        own[r["doc_id"], n].append(r["source"])
    assert sum(r["size"] for r in rows) == sum(sizes.values()) and len(rows) == docs.count()
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mixing.fill_targets(np.array([sizes[s] for s in names]), np.array([(3, 1, 2)[i % 3] for i in range(len(names))], float), 1.5 * sum(sizes.values()), 2.0), strict=True))
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        source = own[r["doc_id"], r["size"]].pop()
        own[r["doc_id"], r["size"]].insert(0, source)
        if len(set(own[r["doc_id"], r["size"]])) == 1:
            assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(targets[source])
        taken[r["source_size"], r["target"]] += r["taken"]
    expected = defaultdict(float)
    for s in names:
        expected[sizes[s], targets[s]] += targets[s]
    for (size, target), words in expected.items():
        found = sum(n for (a, b), n in taken.items() if a == size and b == pytest.approx(target))
        assert abs(found - words) <= len(names)
    again = sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in mixing.mixed_sizes(docs.repartition(7), block_words=16, shard_blocks=40).collect())
    assert again == sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rows)


def test_mixed_texts_are_what_was_taken(docs):
    sizes = Counter()
    for r in mixing.mixed_sizes(docs, block_words=16).collect():
        if r["taken"]:
            sizes[r["doc_id"], r["taken"]] += 1
    out = mixing.mixed_documents(docs, block_words=16)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert Counter((r["doc_id"], len(r["text"].encode().split())) for r in rows) == sizes
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(Counter((r["text"] or "").encode().split()))
    for r in rows:
        words = Counter(r["text"].encode().split())
        assert any(all(n <= 2 * t[w] for w, n in words.items()) for t in texts[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])


def reference_best_fit(lengths, tokens):
    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - n)
        else:
            opened += 1
            gaps.append(tokens - n)
    return opened


def laid_out(places, counts, tokens):
    """The number of sequences, after checking that all ranks have their place and no two pieces overlap."""
    used, ranks = defaultdict(list), defaultdict(list)
    for p in places:
        ranks[p["size"]] += range(p["first"], p["first"] + p["n"])
        for i in range(p["n"]):
            used[p["sequence"] + i // p["each"]].append((p["offset"] + i % p["each"] * p["size"], p["size"]))
    assert {length: len(r) for length, r in ranks.items()} == counts
    assert all(sorted(r) == list(range(counts[length])) for length, r in ranks.items())
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        assert sum(n for _, n in parts) <= tokens
    assert sorted(used) == list(range(len(used)))
    return len(used)


@pytest.mark.parametrize("tokens, high, n, range_runs", [(64, 64, 700, 512), (64, 12, 300, 8), (1024, 1024, 3000, 100)])
def test_rounds_come_near_one_by_one(spark, tmp_path, monkeypatch, tokens, high, n, range_runs):
    monkeypatch.setattr(packing, "RANGE_RUNS", range_runs)
    lengths = np.random.default_rng(n).integers(1, high + 1, n)
    counts = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    given = spark.createDataFrame(list(counts.items()), "length long, n long")
    places = packing.placed_runs(given, tokens, str(tmp_path)).collect()
    assert laid_out(places, counts, tokens) <= reference_best_fit(lengths, tokens) * 1.01 + 2


def test_a_sweep_gives_the_smallest_gap_to_the_longest_piece():
    out = packing.sweep([(5, 0, 2), (3, 4, 3), (9, 0, 1)], [(6, 10, 1), (8, 3, 1)], 16)
    placed = [row[1:] for row in out if row[0] == "placed"]
    # one of 5 takes the gap of 6, the other that of 8; its rest takes one of 3; nothing fits 9 and two of 3
    assert placed == [(5, 0, 1, 10, 1, 10), (5, 1, 1, 3, 1, 8), (3, 4, 1, 3, 1, 13)]
    assert sorted(row[1:4] for row in out if row[0] == "piece") == [(3, 5, 2), (9, 0, 1)]
    assert [row[1:4] for row in out if row[0] == "gap"] == [(1, 10, 1)]


def test_pieces_are_the_tokenizer_s(docs):
    tokenizers, public_tokenizers = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    of = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " ", "a  b", " lead", "trail ", "x\n y\n\nz ", "it's we'll x　 y", "\x1c \x1d a\x1cb \x85 c", "tab\t tab", "ñandú çà 12 3", "!? ... a.b . c"]
    special = ["<|endoftext|> a", "x <|endoftext|> y", "<|endoftext|><|endoftext|>", "a<|endoftext|>", "b <|endoftext |> <|endoftext|>\n c", "  <|endoftext|>  "]
    encoder = packing.encoder(*packing.vocabulary())
    for t in texts + special + [r["text"] or "" for r in docs.collect()]:
        assert np.frombuffer(encoder.ids(t), "<u4").tolist() == of.encode(t, add_special_tokens=False).ids, t
    of.encode_special_tokens = True
    plain = packing.encoder(packing.vocabulary()[0])
    for t in texts + special:
        assert np.frombuffer(plain.ids(t), "<u4").tolist() == of.encode(t, add_special_tokens=False).ids, t


def test_packing_round_trip(docs):
    of = packing.encoder(*packing.vocabulary())
    rows = packing.packed_documents(docs, keep_ids=True).collect()
    expected = Counter()
    for r in docs.collect():
        expected[r["doc_id"], of.ids(r["text"] or "") + np.array([2], "<u4").tobytes()] += 1
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
        assert r["piece"] == 0 or r["length"] == 1024
    for parts in sequences.values():
        assert sum(n for _, n in parts) <= 1024
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
    total = sum(r["length"] for r in rows)
    assert total == sum(len(b) // 4 * n for (_, b), n in expected.items())
    assert len(sequences) <= math.ceil(total / 1024) + 2
    for (doc, ids), n in expected.items():
        if n == 1 and sum(1 for d, _ in expected if d == doc) == 1:
            own = sorted(pieces[doc], key=lambda r: r["piece"])
            assert b"".join(r["ids"] for r in own) == ids
            assert [r["start"] for r in own] == [0, *itertools.accumulate(r["length"] for r in own)][:-1]
    whole = packing.sequences(packing.pack(docs.sparkSession.createDataFrame(rows).drop("sequence_id", "offset").cache()))
    assert {r["n_tokens"] * 4 == len(r["ids"]) for r in whole.collect()} == {True}


def test_shards_keep_their_law(docs):
    rows = sharding.sharded_documents(docs, 24).collect()
    assert len(rows) == docs.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24 and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()
    )
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_shards_follow_weights(spark):
    weights = [1.0, 2.0, 0.0, 5.0]
    rows = sharding.shard_records(spark.range(20_000), ["id"], weights, 2.0).collect()
    shares = Counter(r["shard"] for r in rows)
    for i, w in enumerate(weights):
        assert abs(shares[i] / 20_000 - w / 8) < 0.012
    moved = sum(r["grown_shard"] != r["shard"] for r in rows)
    assert abs(moved / 20_000 - 0.2) < 0.012
    assert all(r["grown_shard"] in (r["shard"], 4) for r in rows)
    with pytest.raises(ValueError):
        sharding.scores(["id"], [])


def test_shards_written(spark, docs, tmp_path):
    sharding.write_shards(docs, ["doc_id"], [1.0] * 3, str(tmp_path / "out"), files=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_empty_tables(no_docs):
    assert mixing.mixed_sizes(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
    assert packing.packed_documents(no_docs).count() == 0
    assert sharding.sharded_documents(no_docs, 24).count() == 0
