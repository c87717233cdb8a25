"""Small tables with everything that may go wrong in one."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `score` double, `_gone` string, `line` int"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eta", "zeta", "iota", "kappa"]) + str(rng.randrange(60)) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, copies, near copies, repeated rows, long texts, short texts."""
    rng = random.Random(7)
    texts = [prose(rng, rng.choice([1, 3, 4, 5, 6, 20, 49, 50, 51, 120, 300])) for _ in range(60)]
    passage = prose(rng, 70)
    texts += [passage, prose(rng, 30) + " " + passage, passage + "\n" + prose(rng, 5), passage.upper(), passage + " " + passage]
    texts += [texts[10], texts[10] + " tail", texts[10].replace(" ", "  "), prose(rng, 6000), "", "   \n\t ", "one", "one", "Ünï çødé ünï çødé ünï çødé"]
    boiler = "All rights are reserved by everyone."
    texts += [f"{boiler}\n{prose(rng, 12)}\n  {boiler}" for _ in range(24)]
    rows = [(i, t, "en", f"src{i % 13}", len(t), 0.5, "x", 1) for i, t in enumerate(texts)]
    rows += [(1000, None, None, None, None, None, None, None), (None, texts[20], "en", None, 3, None, None, None)]
    rows += [(None, passage, None, "src1", None, None, None, None), (1001, passage, "en", None, 0, None, None, None)]
    return [*rows, rows[5], rows[5], rows[61]]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
