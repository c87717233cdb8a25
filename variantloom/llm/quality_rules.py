"""Quality rules as a learned decision list: ordered threshold conjunctions that end as one Spark expression.

Sequential covering: a rule is grown on two thirds of the labelled statistics, one threshold at a time by
information gain, and pruned on the last third; what it covers is taken out and the next rule is grown."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import crc_fold, stage, table
from variantloom.llm.textstats import with_text_counts

#: Labelled rows of each label that a list is learned from at most; those with the smallest hash of the id.
SAMPLE_ROWS = 8000
#: Folds of the labels, the last of which is kept for measuring.
FOLDS = 5
#: A rule must be right for this share of the labelled rows that it rejects.
PRECISION = 0.97


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.threshold if self.above else of[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def features() -> dict[str, Column]:
    """What rules may test: shares of the counts, all numbers even for empty texts."""
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "stops_per_word": share("n_stops", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "word_length": share("word_chars", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
    }


def _covers(rule: Sequence[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most_tests: int) -> list[Test]:
    inside, rule = np.ones(len(bad), bool), []
    while len(rule) < most_tests and (inside & ~bad).any():
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p0:
            break
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name, values in x.items():
            order = np.argsort(values[inside], kind="stable")
            v, b = values[inside][order], bad[inside][order]
            cuts = np.flatnonzero(v[1:] > v[:-1])  # a threshold lies between two different values
            p, n = np.cumsum(b)[cuts], np.cumsum(~b)[cuts]
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                if not len(cuts):
                    continue
                gain = pp * (np.log2(np.maximum(pp, 1e-9) / np.maximum(pp + nn, 1)) - base)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = gain[k], Test(name, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return rule


def _prune(rule: list[Test], x: dict[str, np.ndarray], bad: np.ndarray, precise) -> list[Test]:
    """The shortest beginning of a rule with the best (hits - misses) / covered on rows it was not grown from, among
    those that are precise; the whole rule if none is."""

    def worth(r: list[Test]) -> float:
        inside = _covers(r, x, len(bad))
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    beginnings = [rule[:k] for k in range(1, len(rule) + 1) if precise(rule[:k])]
    return max(beginnings, key=lambda r: (worth(r), -len(r)), default=rule)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 24, most_tests: int = 4, seed: int = 5) -> list[Rule]:
    """An ordered list of rules that reject; what no rule rejects is kept. Empty without rows of both labels."""
    left, rules, fresh = np.ones(len(bad), bool), [], np.random.default_rng(seed)
    while len(rules) < most_rules and (left & bad).sum() >= 3:
        at = np.flatnonzero(left)
        fold = fresh.integers(0, 3, len(at)) > 0
        grow, prune = at[fold], at[~fold]
        part = lambda rows: ({k: v[rows] for k, v in x.items()}, bad[rows])

        def precise(rule: list[Test]) -> bool:
            inside = _covers(rule, x, len(bad)) & left
            return bool(inside.any()) and bad[inside].mean() >= PRECISION

        rule = _prune(_grow(*part(grow), most_tests), *part(prune), precise)
        inside = _covers(rule, x, len(bad)) & left
        if not rule or not precise(rule) or (inside & bad).sum() < 3:
            break
        rules.append(tuple(rule))
        left &= ~inside
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The list as one expression: the first rule that holds rejects, else the row is kept."""
    of, out = features(), None
    for rule in rules:
        condition = F.lit(True)
        for test in rule:
            condition &= test.column(of)
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn_rules(counts: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learns from labelled rows outside the held-out fold, at most ``sample_rows`` of each label."""
    known = labels.filter(F.col("quality").isin(0, 1) & (crc_fold("doc_id", FOLDS) != 0)).select("doc_id", "quality")
    order = F.xxhash64("doc_id", F.lit(8))
    sample = None
    for label in (0, 1):
        part = known.filter(F.col("quality") == label).orderBy(order, "doc_id").limit(sample_rows)
        sample = part if sample is None else sample.unionByName(part)
    rows = counts.join(sample, "doc_id").select("quality", *[c.alias(n) for n, c in features().items()]).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable")
    return learn({n: rows[n].to_numpy(float) for n in features()}, rows["quality"].to_numpy() == 0)


def judged_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: its counts, ``base_failed`` (under 10 words, or over 20 % of the words in repeated
    windows) and ``kept``. Null and empty texts have zero counts and fail; repeated rows are judged alike."""
    counts = stage(with_text_counts(docs), "text-counts")
    rules = learn_rules(counts, labels, sample_rows)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))


def judge(spark, sf_dir: str) -> DataFrame:
    out = judged_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
