"""Toxicity: a support vector machine over a string kernel of subsequences, by Nyström landmarks.

The kernel of two words counts the subsequences of three letters they share, weighted down by the letters they
skip. So a word still resembles an insult that is inflected, gapped, or has letters put in. Landmarks are stretches
of words that tell the labelled documents apart, and some words of clean ones. A sentence's features are its words'
largest kernel values with the landmarks, made orthogonal by the landmarks' own kernel. Labels belong to documents:
of a toxic one, training picks the sentence that the machine finds most toxic, trains again, and so on. A
document's probability follows from its worst sentence, its number of toxic words and its length, because a
harmless word may hit a landmark by chance in a long text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import crc_fold, steps

#: Labelled documents of each label that are learned from at most; those with the smallest hash of the id.
SAMPLE_ROWS = 800
#: Sentences of a labelled document that are learned from at most: those closest to any landmark.
SAMPLE_SENTENCES = 24
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Letters of a shared subsequence, and the weight of each letter that it spans.
LETTERS, DECAY = 3, 0.6
#: Longest stretch of a word that is compared at once; longer words are cut into such windows, half overlapping.
WINDOW = 24
TOXIC_LANDMARKS, PLAIN_LANDMARKS = 24, 4
#: Words that contain a landmark which become landmarks too: those of toxic and those of clean documents.
OWN_WORDS = 2
#: Landmarks that stay: a first machine over all of them tells which ones matter.
KEPT_LANDMARKS = 40
#: Lengths of the stretches that may become landmarks.
STRETCHES = range(4, 11)
#: How many times as frequent a stretch must be among toxic documents as among clean ones, and by how many
#: standard deviations.
RATIO, DEVIATIONS = 2, 4.5
#: Share of a landmark's letters that a word must have, in any order, to be compared with it; else they count as unlike.
COMMON = 0.6
#: Words whose kernel values a task remembers; then it forgets those that fewer steps had.
REMEMBERED = 150_000
STEP_CHARS = 400_000
#: Pairs whose kernel is computed at once: their states stay in the processor's cache.
PAIRS = 16_384
_NO_LETTER = 2**32 - 1
_MARKS = bytes(x for x in range(33, 127) if not chr(x).isalnum())
#: What parts words for ``str.split``: single bytes, and what longer ones begin with.
_SPACE = np.array([x < 128 and chr(x).isspace() for x in range(256)])
_WIDE_SPACE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2[\x80\x81]|\xe3\x80\x80")
#: Bytes of a letter by its first one.
_LETTER_BYTES = np.array([1 + (x >= 0xC0) + (x >= 0xE0) + (x >= 0xF0) for x in range(256)])


def cleaned(text: str | None) -> bytes:
    """The text in lower case without punctuation, a line for each sentence."""
    raw = (text or "").lower().encode()
    for end in (b". ", b"! ", b"? "):
        raw = raw.replace(end, b"\n")
    return raw.translate(None, _MARKS)


def spelled(found: list[str]) -> list[str]:
    """The words that letters make which stand alone in a row."""
    out, run = [], ""
    for w in [*found, "  "]:
        if len(w) == 1:
            run += w
        else:
            if len(run) > 2:
                out.append(run)
            run = ""
    return out


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence, without their punctuation. Letters that stand alone in a row also make one word."""
    lines = [line.split() for line in cleaned(text).decode().split("\n")]
    return [found + spelled(found) for found in lines if found]


def split_words(texts: Sequence[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The same for many texts at once: all words, the number of each word's sentence (ascending, gapless) and the
    text of each sentence. A text without a word has one sentence with an empty one."""
    raws = [cleaned(t) for t in texts]
    for i, raw in enumerate(raws):
        if _WIDE_SPACE.search(raw):
            raws[i] = "\n".join(" ".join(line.split()) for line in raw.decode().split("\n")).encode()
    owner = np.repeat(np.arange(len(raws)), [raw.count(b"\n") + 1 for raw in raws])
    codes = np.frombuffer(b"".join(raw + b"\n" for raw in raws), np.uint8)
    inside = ~_SPACE[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    breaks = np.flatnonzero(codes == 10)
    line = np.searchsorted(breaks, starts)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(codes[inside]))
    single = np.bincount(line[ends - starts == _LETTER_BYTES[codes[starts]]], minlength=len(breaks))
    more = [
        (w, k) for k in np.flatnonzero(single > 2)
        for w in spelled(codes[breaks[k - 1] + 1 if k else 0 : breaks[k]].tobytes().decode().split())
    ]
    blank = np.flatnonzero(np.bincount(owner[line], minlength=len(raws)) == 0)
    more += [("", k) for k in np.searchsorted(owner, blank)]
    if more:
        line = np.concatenate([line, [k for _, k in more]])
        order = np.argsort(line, kind="stable")
        words, line = pa.concat_arrays([words, pa.array([w for w, _ in more], pa.string())]).take(pa.array(order)), line[order]
    new = np.diff(line, prepend=-1) > 0
    return words, np.cumsum(new) - 1, owner[line[new]]


def padded(units: Sequence[str], width: int) -> np.ndarray:
    """Code points of the units, a row each; 0 fills up."""
    out = np.zeros((len(units), width), np.uint32)
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The gap-weighted subsequence kernel of each row of ``a`` with the same row of ``b`` (code points, 0 for none)."""
    n, width = b.shape
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    b[b == 0] = _NO_LETTER
    decay = np.float32(DECAY)
    # the weight of the chains of shared letters by their length and the place in b where they end, a pair in each column
    ends = np.zeros((LETTERS - 1, width, n), np.float32)
    total, same = np.zeros(n, np.float32), np.empty((width, n), np.float32)
    before, longer = np.empty((LETTERS - 1, n), np.float32), np.empty((LETTERS - 1, n), np.float32)
    for x in a:
        np.equal(b, x, out=same)
        ends *= decay
        before[:] = 0
        for j in range(width):
            np.multiply(before, same[j], out=longer)
            before += ends[:, j]
            before *= decay
            ends[0, j] += same[j]
            ends[1:, j] += longer[:-1]
            total += longer[-1]
    return total * (decay * decay)


def letter_masks(codes: np.ndarray) -> np.ndarray:
    """Bits for letters (folded to 32 classes) that occur once, twice and three times at least: a row each."""
    n = len(codes)
    rows = np.repeat(np.arange(n), codes.shape[1])
    flat = codes.reshape(-1)
    at = (rows * 32 + flat % 32)[flat != 0]
    counts = np.bincount(at, minlength=n * 32).reshape(n, 32)
    return np.stack([np.packbits(counts >= k, axis=1).view(np.uint32)[:, 0] for k in range(1, LETTERS + 1)])


def longest_chains(masks: Iterable[np.ndarray]) -> np.ndarray:
    """Length of the longest common subsequence of pairs, by bits: for each letter of the first ones, ``masks`` tells
    at which places of the second that letter is."""
    free = np.uint32(2**32 - 1)
    for mask in masks:
        taken = free & mask
        free = (free + taken) | (free - taken)
    return np.bitwise_count(~free)


def similarities(units: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
    """Kernel of units with landmarks (both of at most ``WINDOW`` letters), as a share of the landmark's own.

    Only pairs that have ``COMMON`` of the landmark's letters in common are computed; all others count as zero."""
    by_size = np.argsort([len(m) for m in landmarks], kind="stable")
    widths = np.array([len(landmarks[i]) for i in by_size])
    marks = padded([landmarks[i] for i in by_size], widths[-1])
    own = np.maximum(kernel(marks, marks), 1e-9)
    marks_bits = letter_masks(marks)
    places = np.zeros((len(marks), 33), np.uint32)
    for k in range(marks.shape[1]):
        places[np.arange(len(marks)), marks[:, k] % 32] |= (marks[:, k] != 0).astype(np.uint32) << np.uint32(k)
    least = np.maximum(LETTERS, np.ceil(COMMON * widths - 1e-9)).astype(np.uint8)
    out = np.zeros((len(units), len(landmarks)), np.float32)
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    order = np.argsort(sizes, kind="stable")
    for low in range(0, len(units), 2048):
        rows = order[low : low + 2048]
        codes = padded([units[i] for i in rows], max(1, sizes[rows[-1]]))
        common = sum(np.bitwise_count(m[:, None] & u) for m, u in zip(marks_bits, letter_masks(codes), strict=True))
        # short landmarks first, so that the pairs of a block are about as wide as each other
        j, i = np.nonzero(common >= least[:, None])
        letters = np.ascontiguousarray(np.where(codes, codes % 32, 32).astype(np.int64).T)
        for first in range(0, len(i), PAIRS):
            p, q = i[first : first + PAIRS], j[first : first + PAIRS]
            # half of the pairs share letters, but too few in the same order: their kernel is zero
            chained = longest_chains(places.take(q * 33 + x.take(p)) for x in letters) >= LETTERS
            p, q = p[chained], q[chained]
            if len(p):
                out[rows[p], by_size[q]] = kernel(codes[p], marks[q, : widths[q[-1]]]) / own[q]
    return out


def unit_similarities(units: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
    """The same for units of any length: the largest value of a long unit's windows."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    out = np.zeros((len(units), len(landmarks)), np.float32)
    short = np.flatnonzero(sizes <= WINDOW)
    out[short] = similarities([units[i] for i in short], landmarks)
    for i in np.flatnonzero(sizes > WINDOW):
        parts = [units[i][at : at + WINDOW] for at in range(0, sizes[i] - WINDOW // 2, WINDOW // 2)]
        out[i] = similarities(parts, landmarks).max(axis=0)
    return out


@dataclass
class Machine:
    """The landmarks, the weight of each in a sentence's decision, and a document's logistic weights."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    logistic: np.ndarray
    _known: dict[str, int] = field(default_factory=dict)
    _values: np.ndarray | None = None
    #: of each known word whether it resembles any landmark, whether it is toxic by itself, and how many steps had it
    _alike: np.ndarray | None = None
    _toxic: np.ndarray | None = None
    _uses: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}, "_values": None, "_alike": None, "_toxic": None, "_uses": None}

    def _make_room(self, wanted: int) -> None:
        """For that many words more; of the known ones those stay that most steps had."""
        size, known = max(REMEMBERED, wanted), list(self._known)
        old = self._values, self._alike, self._toxic, self._uses
        self._values = np.zeros((size, len(self.landmarks)), np.float32)
        self._alike, self._toxic, self._uses = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, np.int32)
        if known:
            kept = np.argsort(-old[-1][: len(known)], kind="stable")[: min(size // 2, size - wanted)]
            for new, values in zip((self._values, self._alike, self._toxic, self._uses), old, strict=True):
                new[: len(kept)] = values[kept]
            self._known = {known[k]: at for at, k in enumerate(kept)}

    def _rows(self, units: list[str]) -> np.ndarray:
        """Where the values of the units, all different, are."""
        new = [u for u in units if u not in self._known]
        if self._values is None or len(self._known) + len(new) > len(self._values):
            self._make_room(len(units))
            new = [u for u in units if u not in self._known]
        if new:
            at = slice(len(self._known), len(self._known) + len(new))
            self._values[at] = values = unit_similarities(new, self.landmarks)
            self._alike[at] = values.any(axis=1)
            self._toxic[at] = values @ self.weights + self.bias > 0
            self._known.update(zip(new, range(at.start, at.stop), strict=True))
        rows = np.fromiter(map(self._known.__getitem__, units), np.int64, len(units))
        self._uses[rows] += 1
        return rows

    def sentence_values(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The largest kernel values of each sentence and its text, and the toxic words and all words of each text. A
        text has one sentence and one word at least."""
        words, of, owner = split_words(texts)
        words = words.dictionary_encode()
        rows = self._rows(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        values = np.zeros((len(owner), len(self.landmarks)), np.float32)
        # kernel values are never below zero: words that resemble no landmark change no sentence's largest ones
        if (alike := self._alike[rows]).any():
            firsts = np.flatnonzero(np.diff(of[alike], prepend=-1))
            values[of[alike][firsts]] = np.maximum.reduceat(self._values[rows[alike]], firsts, axis=0)
        toxic = np.bincount(owner[of], self._toxic[rows], minlength=len(texts))
        return values, owner, toxic, np.bincount(owner[of], minlength=len(texts))

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        """For each text the decision on its worst sentence, the logarithms of its toxic words and of its words."""
        values, owner, toxic, size = self.sentence_values(texts)
        worst = np.maximum.reduceat(values @ self.weights + self.bias, np.flatnonzero(np.diff(owner, prepend=-1)))
        return np.stack([worst, np.log1p(toxic), np.log1p(size)], axis=1).astype(float)

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(texts), 1 / (1 + np.exp(-self.logistic[-1])))
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.logistic[:-1] + self.logistic[-1], -60, 60)))


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Stretches of words that are clearly more frequent among toxic documents, one after another; the words that
    contain one are explained by it and no longer count for others. Of equal ones the longest. Then words
    that contain them, of toxic and of clean documents, and a few frequent clean words, for contrast."""

    def stretches(unit: str) -> set[str]:
        return {unit[i : i + n] for n in STRETCHES for i in range(len(unit) - n + 1)}

    def all_of(units: set[str]) -> set[str]:
        return {x for u in units for x in stretches(u)}

    counts, against = Counter(), Counter()
    for units in toxic:
        counts.update(all_of(units))
    wanted = {s for s, n in counts.items() if n >= max(3, len(toxic) // 100)}
    for units in clean:
        against.update(wanted & all_of(units))
    rate = len(toxic) / max(1, len(clean))

    def gain(stretch: str, n: int) -> float:
        by_chance = rate * against[stretch]
        clear = n > RATIO * by_chance and n - by_chance > DEVIATIONS * (by_chance + 1) ** 0.5
        return n - by_chance if clear else 0.0

    good = {s for s in wanted if gain(s, counts[s])}
    held = [{u: own for u in units if (own := good & stretches(u))} for units in toxic]
    joined = [set().union(*own.values()) for own in held]
    left, found = Counter(), []
    for own in joined:
        left.update(own)
    while left and len(found) < TOXIC_LANDMARKS:
        best = max(left, key=lambda s: (gain(s, left[s]), len(s), s))
        if not gain(best, left[best]):
            break
        found.append(best)
        for i, own in enumerate(joined):
            if best in own:
                held[i] = {u: x for u, x in held[i].items() if best not in u}
                joined[i] = set().union(*held[i].values())
                left.subtract(own - joined[i])
        left = +left
    out = list(found)
    for side in (toxic, clean):
        words = Counter(u for units in side for u in units if len(u) <= WINDOW)
        for stem in found:
            own = sorted((u for u in words if stem in u and u not in out), key=lambda u: (-words[u], u))
            out += own[:OWN_WORDS]
    common = Counter(u for units in clean for u in units if STRETCHES[0] <= len(u) <= STRETCHES[-1] and u not in out)
    return out + [u for u, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:PLAIN_LANDMARKS]]


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(30):
        active = y * (x @ w) < 1
        a, c = x[active], weight[active]
        new = np.linalg.solve((a * c[:, None]).T @ a + ridge, (a * (c * y[active])[:, None]).sum(axis=0))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def fit(landmarks: list[str], values: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> Machine:
    """Learns from the sentences' kernel values; ``owner`` gives a sentence's document, ``toxic`` a document's label."""
    marks = padded(landmarks, max(map(len, landmarks)))
    i, j = np.meshgrid(np.arange(len(landmarks)), np.arange(len(landmarks)), indexing="ij")
    gram = kernel(marks[i.ravel()], marks[j.ravel()]).reshape(i.shape).astype(float)
    scale = np.sqrt(np.diag(gram))
    eigen, basis = np.linalg.eigh(gram / np.outer(scale, scale))
    root = basis @ np.diag(1 / np.sqrt(np.maximum(eigen, 1e-3))) @ basis.T
    z = values.astype(float) @ root
    label = toxic[owner]
    picked = values.max(axis=1).astype(float)
    w = np.zeros(z.shape[1] + 1)
    last = None
    for _ in range(12):
        # the worst sentence of each toxic document, all sentences of the clean ones
        order = np.lexsort((-picked, owner))
        best = np.zeros(len(owner), bool)
        best[order[np.flatnonzero(np.diff(owner[order], prepend=-1))]] = True
        use = ~label | best
        if last is not None and (use == last).all():
            break
        last = use
        y = np.where(label[use], 1.0, -1.0)
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
        w = train(z[use], y, weight)
        picked = z @ w[:-1] + w[-1]
    return Machine(landmarks, (root @ w[:-1]).astype(np.float32), float(w[-1]), np.zeros(4))


def selected(landmarks: list[str], values: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> Machine:
    """A machine over the landmarks whose weights move the sentences' decisions most in a machine over all of them."""
    moves = np.abs(fit(landmarks, values, owner, toxic).weights) * values.std(axis=0)
    kept = np.sort(np.argsort(-moves, kind="stable")[:KEPT_LANDMARKS])
    return fit([landmarks[i] for i in kept], values[:, kept], owner, toxic)


def logistic(x: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Weights of the features and a constant, with smoothed labels; ``share`` is the part of toxic documents among
    all labels, and each label weighs that much."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, share / max(1, n1), (1 - share) / max(1, n0))
    x, w = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (weight * (p - target)) + 1e-5 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-5 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & (crc_fold("doc_id", FOLDS) != HELD_OUT))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # the sample's ids are bounded by twice the parameter
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), totals


def learn_machine(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Machine:
    """Learns from labelled rows outside the held-out fold, at most ``sample`` of each label, whole texts."""
    rows, totals = _sample(docs, labels, sample)
    kind = docs.schema["doc_id"].dataType.simpleString()
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    nothing = Machine([], np.zeros(0, np.float32), 0.0, np.array([np.log((share + 1e-6) / (1 - share + 1e-6))]))
    if not totals.get(0) or not totals.get(1):
        return nothing

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({u for s in sentences(t) for u in s}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["doc_id", "toxic", "units"])

    own = sorted(rows.mapInArrow(units, f"doc_id {kind}, toxic int, units array<string>").collect(), key=lambda r: (r["doc_id"], r["units"]))
    landmarks = choose_landmarks([set(r["units"]) for r in own if r["toxic"]], [set(r["units"]) for r in own if not r["toxic"]])
    if not landmarks:
        return nothing
    probe = Machine(landmarks, np.zeros(len(landmarks), np.float32), 0.0, np.zeros(4))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in steps([len(t or "") for t in texts], STEP_CHARS):
                found, owner, _, _ = probe.sentence_values(texts[low:high])
                kept = []
                for i in range(high - low):
                    of = found[owner == i]
                    kept.append(of[np.argsort(-of.max(axis=1), kind="stable")[:SAMPLE_SENTENCES]].reshape(-1))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(kept, pa.list_(pa.float32()))], ["doc_id", "toxic", "values"])

    own = sorted(rows.mapInArrow(values, f"doc_id {kind}, toxic int, values array<float>").collect(), key=lambda r: (r["doc_id"], r["values"]))
    parts = [np.array(r["values"], np.float32).reshape(-1, len(landmarks)) for r in own]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    machine = selected(landmarks, np.vstack(parts), owner, np.array([bool(r["toxic"]) for r in own]))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in steps([len(t or "") for t in texts], STEP_CHARS):
                part = batch.slice(low, high - low)
                found = pa.array(list(machine.features(texts[low:high])), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), found], ["doc_id", "toxic", "features"])

    own = sorted(rows.mapInArrow(features, f"doc_id {kind}, toxic int, features array<double>").collect(), key=lambda r: (r["doc_id"], r["features"]))
    machine.logistic = logistic(np.array([r["features"] for r in own]), np.array([bool(r["toxic"]) for r in own]), share)
    return machine


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with their own columns, and ``score``: the probability of label 1.

    Texts are read whole. Null and empty texts score as one sentence without a word; without labels of both kinds all
    texts get the share of label 1. Rows that repeat a text get one score. An own column ``score`` is replaced."""
    machine = docs.sparkSession.sparkContext.broadcast(learn_machine(docs, labels, sample))
    own = [c for c in docs.columns if c.lower() != "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [n or 0 for n in pa.compute.binary_length(batch.column("text")).to_pylist()]
            for low, high in steps(sizes, STEP_CHARS):
                part = batch.slice(low, high - low)
                values = machine.value.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(values, pa.float64())], [*own, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    return docs.select(*own).mapInArrow(score, f"{fields}, score double")


def judged_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    out = score_documents(docs.select("doc_id", "text"), labels, sample)
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
