"""The classifiers and the learned rules: made-up labels with a known cause, odd rows, folds kept apart."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from variantloom.llm import quality_neighbours, quality_rules, textstats, toxicity_kernel

SYLLABLES = ["ta", "ri", "mon", "be", "lu", "sor", "en", "vi", "qua", "del", "o", "ni", "ster", "pa"]


def prose(rng, n):
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))
    return " ".join(word() + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(420):
        text, quality, toxic = prose(rng, rng.randrange(30, 120)), 1, 0
        if i % 6 == 0:
            text, quality = " ".join(w + rng.choice(["***", "$$$", "###"]) for w in text.split()), 0
        elif i % 6 == 1:
            text, quality = text[:120].upper() + "!! " + text[:120].upper() + "!! " + text[:120].upper(), 0
        if i % 5 == 2:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grobian", "grobiander", "grobiansk", "Zwackel", "zwackelig", "zwackels"]))
            text, toxic = " ".join(words), 1
        rows.append((i, text, 1.5))
        labels.append((i, quality, toxic))
    rows += [(5000, None, 0.0), (5001, "", 0.0), (5002, " \n ", 0.0), (None, prose(rng, 40), 0.0), (5003, prose(rng, 30_000), 0.0), rows[3], rows[3]]
    labels += [labels[3], (None, 1, 0), (7, None, None), (9999, 1, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, Score double").repartition(3).cache(),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache(),
    )


def right(rows, labels, column, held_out):
    truth = {r["doc_id"]: r[column] for r in labels.collect() if r[column] is not None}
    judged = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth and r["held_out"] == held_out]
    return Counter(judged)


@pytest.mark.parametrize("module, column, folds, fold", [(quality_neighbours, "quality", 5, 0), (toxicity_kernel, "toxic", 4, 2)])
def test_classifiers(labelled, module, column, folds, fold):
    docs, labels = labelled
    rows = module.judged_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)
    counts = right(rows, labels, column, True)
    total = sum(counts.values())
    assert total > 50 and (counts[0, 0] + counts[1, 1]) / total > 0.95
    same = [r["score"] for r in rows if r["doc_id"] == 3]
    assert len(same) == 3 and len(set(same)) == 1
    # labels of the held-out fold are not looked at
    turned = labels.withColumn(column, F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold, 1 - F.col(column)).otherwise(F.col(column)))
    again = {(r["doc_id"], round(r["score"], 9)) for r in module.judged_documents(docs, turned).collect()}
    assert again == {(r["doc_id"], round(r["score"], 9)) for r in rows}
    out = module.score_documents(docs, labels)
    assert [c for c in out.columns] == ["doc_id", "text", "score"]


@pytest.mark.parametrize("module", [quality_neighbours, toxicity_kernel])
def test_classifiers_without_labels_or_rows(labelled, module, no_docs, docs):
    _, labels = labelled
    rows = module.judged_documents(docs, labels.limit(0)).collect()
    assert len(rows) == docs.count() and len({r["score"] for r in rows}) == 1
    assert module.judged_documents(no_docs, labels).count() == 0


def plain_kernel(a, b, letters=3, decay=0.6):
    from itertools import combinations

    total = 0.0
    for i in combinations(range(len(a)), letters):
        for j in combinations(range(len(b)), letters):
            if all(a[x] == b[y] for x, y in zip(i, j, strict=True)):
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_equals_its_definition():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    a, b = toxicity_kernel.padded(words[:20], 8), toxicity_kernel.padded(words[20:], 8)
    expected = [plain_kernel(x, y) for x, y in zip(words[:20], words[20:], strict=True)]
    assert toxicity_kernel.kernel(a, b) == pytest.approx(expected, rel=1e-4)
    found = toxicity_kernel.similarities(words[:20], ["abc", "dabd"])
    for i, w in enumerate(words[:20]):
        for j, mark in enumerate(["abc", "dabd"]):
            common = sum((Counter(w) & Counter(mark)).values())
            assert found[i, j] == pytest.approx(plain_kernel(w, mark) / plain_kernel(mark, mark) if common >= 3 else 0, rel=1e-4, abs=1e-6)


def test_kernel_sees_through_gaps():
    marks = ["idiot", "worthless"]
    near = toxicity_kernel.unit_similarities(["idixot", "idioten", "xxidiotyy" + "z" * 60, "w0rthless", "table", "z" * 60 + "idiot"], marks)
    assert near[0, 0] > 0.4 and near[1, 0] >= 0.99 and near[2, 0] >= 0.99 and near[3, 1] > 0.5 and near[4].max() == 0 and near[5, 0] >= 0.99
    assert ["idiot"] == [w for s in toxicity_kernel.sentences("You i-d.i_o!t are. Fine") for w in s if "idi" in w]
    assert "idiot" in toxicity_kernel.sentences("an i d i o t here")[0]


ODD_TEXTS = [
    "", None, " \n\t ", "one", "You i-d.i_o!t are. Fine", "an i d i o t here a b\nw o r t h", "é ü ß x y. Ünï\u00a0çø\u2003dé\u3000\x1c\x85z! \u20ac\u2019s",
    "İstanbul ΣΑΣ. ...\r\n\x0b\x0c-- \ud7ff \U0001f600 \U0001f600 \U0001f600", "z" * 60 + "idiot", ". . a ! b ? c", "a\x00b \x00",
]


def test_words_of_many_texts_are_those_of_each():
    rng = random.Random(4)
    texts = ODD_TEXTS + ["".join(rng.choice("abé .!?\n\t\u00a0\u2028-") for _ in range(rng.randrange(60))) for _ in range(400)]
    words, of, owner = toxicity_kernel.split_words(texts)
    assert (np.diff(of, prepend=-1) <= 1).all() and (np.diff(owner, prepend=0) <= 1).all() and (np.diff(of) >= 0).all()
    found = [[] for _ in texts]
    for k in owner:
        found[k].append([])
    bounds = np.searchsorted(of, np.arange(len(owner) + 1))
    at = Counter()
    for k, low, high in zip(owner, bounds, bounds[1:], strict=False):
        found[k][at[k]] = words[low:high].to_pylist()
        at[k] += 1
    assert found == [toxicity_kernel.sentences(t) or [[""]] for t in texts]


def test_only_words_with_letters_in_order_are_computed(monkeypatch):
    computed, plain = [], toxicity_kernel.kernel
    monkeypatch.setattr(toxicity_kernel, "kernel", lambda a, b: computed.append(len(a)) or plain(a, b))
    found = toxicity_kernel.similarities(["toiid", "ssdolr", "idiot", "wlorsd"], ["idiot", "lords"])
    assert (found > 0).tolist() == [[False, False], [False, False], [True, False], [False, True]]
    assert sum(computed) == 2 + 2  # the landmarks themselves, and two pairs


def test_a_landmark_is_as_alike_at_any_place_of_a_word():
    units = ["z" * before + "worthless" + "z" * after for before in range(8) for after in range(8)]
    assert (toxicity_kernel.similarities(units, ["worthless", "idiot"])[:, 0] == 1.0).all()


def test_words_of_most_steps_stay_remembered(monkeypatch):
    monkeypatch.setattr(toxicity_kernel, "REMEMBERED", 40)
    rng, computed, plain = random.Random(9), Counter(), toxicity_kernel.unit_similarities
    monkeypatch.setattr(toxicity_kernel, "unit_similarities", lambda units, marks: computed.update(units) or plain(units, marks))
    often = ["idiot", "idioten", "table", "worthless", "worthy"]
    texts = [" ".join(often + ["".join(rng.choice("idotwrhles") for _ in range(7)) for _ in range(rng.randrange(6, 16))]) for _ in range(60)]
    machine = toxicity_kernel.Machine(["idiot", "worthless"], np.array([1.0, 2.0], np.float32), -0.7, np.zeros(4))
    for text in [*texts, " ".join(f"many{i}" for i in range(100)), *texts[:5], *ODD_TEXTS]:
        values, owner, toxic, size = machine.sentence_values([text])
        units = toxicity_kernel.sentences(text) or [[""]]
        each = [plain(s, machine.landmarks) for s in units]
        assert values == pytest.approx(np.stack([v.max(axis=0) for v in each]), abs=1e-6) and owner.tolist() == [0] * len(units)
        assert toxic.tolist() == [sum((v @ machine.weights - 0.7 > 0).sum() for v in each)] and size.tolist() == [sum(map(len, units))]
        if text is texts[-1]:
            assert [computed[w] for w in often] == [1] * 5


def test_counts_equal_plain_python(docs):
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r in textstats.with_text_counts(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        t = r["text"] or ""
        w = word.findall(t)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often = Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if word.search(x)]
        if len({x["text"] for x in docs.filter(F.col("doc_id") == r["doc_id"]).collect()}) > 1:
            continue
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))


def test_rules_learn_and_judge(labelled, docs, no_docs):
    own, labels = labelled
    rows = quality_rules.judged_documents(own, labels).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    held_out = [(r["kept"], bool(truth[r["doc_id"]])) for r in rows if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and not r["base_failed"]]
    assert len(held_out) > 40 and np.mean([a == b for a, b in held_out]) > 0.95
    assert all(not r["kept"] for r in rows if r["base_failed"])
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
    unlearned = quality_rules.judged_documents(docs, labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in unlearned) and len(unlearned) == docs.count()
    assert quality_rules.judged_documents(no_docs, labels).count() == 0


def test_rule_list_finds_thresholds():
    rng = np.random.default_rng(4)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.5)) | (x["c"] < 0.05)
    rules = quality_rules.learn(x, bad)
    out = np.zeros(3000, bool)
    for rule in rules:
        out |= np.logical_and.reduce([t.holds(x) for t in rule])
    assert (out == bad).mean() > 0.98
    assert quality_rules.learn(x, np.zeros(3000, bool)) == [] and quality_rules.learn({"a": np.zeros(0)}, np.zeros(0, bool)) == []
