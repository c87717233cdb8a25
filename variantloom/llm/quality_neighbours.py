"""Quality classifier: every document is judged by its nearest labelled neighbours in a latent-semantic space.

Terms are what a text is made of on its surface: triples of character classes, and marks for capital letters,
symbols, repeated passages and repeated lines. A singular value decomposition of the labelled sample's term matrix
gives the space. The labelled vectors, a bounded number, go to all executors; there every document is multiplied
with all of them, block by block, and its nearest ones vote with their similarity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import crc_fold, steps
from variantloom.llm.textstats import counts_of

#: Labelled documents of each label that become vectors at most; those with the smallest hash of the id.
SAMPLE_ROWS = 3000
#: Terms of the matrix: the most frequent ones of the sample.
TERMS = 1024
DIMENSIONS = 64
NEIGHBOURS = 25
#: Power of the similarity in a vote.
SHARPNESS = 8
FOLDS = 5
THRESHOLD = 0.3
#: Documents multiplied with the labelled vectors at once.
BLOCK = 512

_GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\x0b\x0c\r", b".", b",",
    b"!", b"?", b"|", b"*", b"#", b"$", b"%", b"&", b"<>", b"'\"`", b"-_", b"/\\:;=+~^", b"()[]{}", b"@",
)
_OTHER, _WIDE, _SKIP = len(_GROUPS), len(_GROUPS) + 1, 255
CLASSES = len(_GROUPS) + 2
TRIPLES = CLASSES**3
#: Marks that stand beside the triples: share of the words or characters, and its weight.
MARKS = ("n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_stops", "n_digits", "n_distinct")
_PER = {"n_dup_lines": "n_lines", "n_upper": "word_chars", "n_digits": "word_chars"}


def _classes() -> np.ndarray:
    of = np.full(256, _OTHER, np.uint8)
    for k, group in enumerate(_GROUPS):
        of[list(group)] = k
    of[128:192] = _SKIP  # continuation bytes belong to the character before
    of[192:] = _WIDE
    return of


_CLASS = _classes()


def triples(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The class triples of all texts, and the text of each."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    of = _CLASS[joined]
    keep = of != _SKIP
    of, owner = of[keep].astype(np.int32), owner[keep]
    if len(of) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    inside = owner[2:] == owner[:-2]
    return ((of[:-2] * CLASSES + of[1:-1]) * CLASSES + of[2:])[inside], owner[2:][inside]


def marks(counts: dict[str, np.ndarray]) -> np.ndarray:
    """A column per mark: the square root of its share."""
    share = [np.sqrt(np.minimum(1.0, counts[m] / np.maximum(1, counts[_PER.get(m, "n_words")]))) for m in MARKS]
    return np.stack(share, axis=1).astype(np.float32)


@dataclass(frozen=True)
class Space:
    """The terms' places and weights, the projection, and the labelled vectors with their labels and weights."""

    place: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def project(self, shares: np.ndarray) -> np.ndarray:
        latent = (shares * self.weights - self.centre) @ self.projection
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """Square roots of the terms' shares in each text: of the triples, then the marks."""
        code, owner = triples(texts)
        n = len(self.weights) - len(MARKS)
        at = self.place[code]
        known = at >= 0
        table = np.bincount(owner[known] * n + at[known], minlength=len(texts) * n).reshape(len(texts), n)
        total = np.bincount(owner, minlength=len(texts))[:, None]
        return np.hstack([np.sqrt(table / np.maximum(1, total)).astype(np.float32), marks(counts_of(texts))])

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The share of label 1 in the votes of each text's neighbours; the prior for texts without a character."""
        out = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return out
        for low in range(0, len(texts), BLOCK):
            part = texts[low : low + BLOCK]
            near = self.project(self.shares(part)) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            at = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, at, axis=1), 0.0) ** SHARPNESS * self.votes[at]
            total = vote.sum(axis=1)
            sure = (total > 0) & np.array([bool(t.strip()) for t in part])
            out[low : low + len(part)][sure] = ((vote * self.labels[at]).sum(axis=1) / np.maximum(total, 1e-30))[sure]
        return np.clip(out, 0.0, 1.0)


def sample_rows(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """The sample's texts as sparse term counts, and how many labelled rows of each label there are.

    ``sample`` bounds the rows that are broadcast to the scan of the documents and those that come back."""
    known = (
        labels.filter(F.col("quality").isin(0, 1) & (crc_fold("doc_id", FOLDS) != 0))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    )
    totals = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            code, owner = triples(texts)
            values, n = np.unique(owner.astype(np.int64) * TRIPLES + code, return_counts=True)
            edges = np.searchsorted(values, np.arange(len(texts) + 1) * TRIPLES)
            offsets = pa.array(edges.astype(np.int32))
            extra = marks(counts_of(texts)) if texts else np.zeros((0, len(MARKS)), np.float32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("quality"),
                pa.ListArray.from_arrays(offsets, pa.array((values % TRIPLES).astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
                pa.array(list(extra), pa.list_(pa.float32())),
            ], ["doc_id", "quality", "codes", "counts", "marks"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, quality int, codes array<int>, counts array<int>, marks array<float>"), totals


def learn_space(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Space:
    rows, totals = sample_rows(docs, labels, sample)
    rows = sorted(rows.collect(), key=lambda r: r["doc_id"])
    y = np.array([r["quality"] for r in rows], np.float32)
    frequency = np.zeros(TRIPLES, np.int64)
    for r in rows:
        frequency[r["codes"]] += 1
    terms = np.argsort(-frequency, kind="stable")[: min(TERMS, int((frequency > 0).sum()))]
    place = np.full(TRIPLES, -1, np.int64)
    place[terms] = np.arange(len(terms))
    x = np.zeros((len(rows), len(terms) + len(MARKS)), np.float32)
    for i, r in enumerate(rows):
        at, n = place[r["codes"]], np.array(r["counts"], float)
        x[i, at[at >= 0]] = np.sqrt(n / max(1.0, n.sum()))[at >= 0]
        x[i, len(terms) :] = r["marks"]
    weights = np.concatenate([np.log1p(len(rows) / np.maximum(1, frequency[terms])), np.ones(len(MARKS))]).astype(np.float32)
    prior = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    if not len(rows):
        none = np.zeros((0, DIMENSIONS), np.float32)
        return Space(place, weights, np.zeros_like(weights), np.zeros((len(weights), DIMENSIONS), np.float32), none, y, y, prior)
    x *= weights
    centre = x.mean(axis=0)
    _, vectors = np.linalg.eigh((x - centre).T @ (x - centre))
    projection = np.ascontiguousarray(vectors[:, ::-1][:, :DIMENSIONS]).astype(np.float32)
    latent = (x - centre) @ projection
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    # a label's votes weigh as many rows as it has, however many of them became vectors
    votes = np.array([totals[int(q)] / max(1, (y == q).sum()) for q in y], np.float32)
    return Space(place, weights, centre, projection, latent.astype(np.float32), y, votes, prior)


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with their own columns, and ``score`` (0 to 1, the share of label 1 among the votes).

    Texts are read whole. Null and empty texts get the share of label 1 among the labels, or 0.5 if there is no
    label. Rows that repeat a text get one score. An own column ``score`` is replaced."""
    space = docs.sparkSession.sparkContext.broadcast(learn_space(docs, labels, sample))
    own = [c for c in docs.columns if c.lower() != "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [n or 0 for n in pa.compute.binary_length(batch.column("text")).to_pylist()]
            for low, high in steps(sizes):
                part = batch.slice(low, high - low)
                values = space.value.score([(t or "").encode() for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(values, pa.float64())], [*own, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    return docs.select(*own).mapInArrow(score, f"{fields}, score double")


def judged_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    out = score_documents(docs.select("doc_id", "text"), labels, sample)
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
