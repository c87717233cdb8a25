"""Best-fit packing of tokenized documents into sequences of a fixed length, in bulk-synchronous rounds.

State is a Spark table of runs: all unplaced pieces of one length with their ranks, and all open sequences in which the
same number of tokens (the gap) is left. It has a few runs a length, however many documents there are. A round deals the
runs to ranges of sizes; a window over each range, with the boundaries carried over from the ranges above, finds every
piece's successor, the smallest gap that it fits in; pieces go to their successor's range. There the range is swept
from the longest piece down: each takes the smallest gap left, and where several want the same gap, ranks settle who gets it
(longer pieces first, then in order of rank). The gaps are updated, and pieces whose gaps are gone go on with the next
round. Pieces that no gap fits open new sequences, the longest of them one each and not quite as many as all of them
will need, so that the others fill what is left there. Only the sizes that cut the ranges and three counts come to the driver between rounds."""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.llm.common import clear, running_total, stage, steps, work_folder

SEQUENCE_TOKENS = 1024
#: The id that ends every document.
END_ID = 2
#: The pieces of a length are ranked in this many parts, and in more if a part would hold more than ``RANK_ROWS``.
RANK_PARTS, RANK_ROWS = 256, 100_000
#: Runs of a range of sizes, about.
RANGE_RUNS = 512
#: Of the sequences that the pieces without a gap would fill, the share that a round opens.
OPENED_SHARE = 0.9
#: Words whose ids a task remembers; then it forgets them all.
REMEMBERED = 100_000


class _Known(dict):
    """The ids of a piece of text, remembered."""

    def __init__(self, encode, before: str) -> None:
        super().__init__()
        self._encode, self._before = encode, before

    def __missing__(self, text: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[text] = array("I", self._encode(self._before + text)).tobytes()
        return ids


class Encoder:
    """Byte-level BPE from a vocabulary file of ranks. The strings of ``added`` tokens in a text are these tokens, as in
    a tokenizer that has them; all else is ordinary text.

    The pattern that cuts a text before merging never joins what stands on both sides of a single space, which
    belongs to what follows. So texts are cut at such spaces and the parts' ids are remembered."""

    _uneven = re.compile(r" \s|\s ")
    _cut = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, added: tuple[tuple[str, int], ...] = ()) -> None:
        import public_tokenizers
        import tiktoken

        self._added = {content: array("I", [i]).tobytes() for content, i in added}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self._added else None

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._plain = _Known(encoding.encode_ordinary, "")
        self._spaced = _Known(encoding.encode_ordinary, " ")

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if self._at_added and self._at_added.search(text):
            parts = self._at_added.split(text)  # every second part is an added token
            return b"".join(self._added[part] if i % 2 else self._ids(part) for i, part in enumerate(parts))
        return self._ids(text)

    def _ids(self, text: str) -> bytes:
        if self._uneven.search(text):
            return b"".join(map(self._plain.__getitem__, self._cut.split(text)))
        first, *rest = text.split(" ")
        return self._plain[first] + b"".join(map(self._spaced.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str, added: tuple[tuple[str, int], ...] = ()) -> Encoder:
    return Encoder(path, added)


def added_tokens(tokenizer: str) -> tuple[tuple[str, int], ...]:
    """The added tokens of a tokenizer's JSON file and their ids."""
    with open(tokenizer, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("added tokens with conditions are not supported")
    return tuple((t["content"], t["id"]) for t in added)


def vocabulary() -> tuple[str, tuple[tuple[str, int], ...]]:
    """The ranks of the 50k byte-level vocabulary, the same file on every machine that has the package, and the added
    tokens of its tokenizer, which only the driver reads."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def token_pieces(docs: DataFrame, using: tuple[str, tuple[tuple[str, int], ...]] | None = None, tokens: int = SEQUENCE_TOKENS,
                 keep_ids: bool = False) -> DataFrame:
    """The documents' ids in pieces: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (binary).

    A document is its text's ids and ``END_ID``; a null text is empty. Longer ones are cut so that all pieces but the
    first are full."""
    using, end = using or vocabulary(), array("I", [END_ID]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(*using)
        for batch in batches:
            sizes = [n or 0 for n in pa.compute.binary_length(batch.column(1)).to_pylist()]
            for first, last in steps(sizes):
                yield pieces_of(batch.slice(first, last - first), of)

    def pieces_of(batch: pa.RecordBatch, of: Encoder) -> pa.RecordBatch:
        owner, piece, start, length, crc, kept = [], [], [], [], [], []
        for row, text in enumerate(batch.column(1)):
            ids = of.ids(text.as_py() or "") + end
            low, size = 0, len(ids) // 4
            high = size % tokens or tokens
            while low < size:
                part = ids[4 * low : 4 * high]
                owner.append(row)
                piece.append(piece[-1] + 1 if low else 0)
                start.append(low)
                length.append(high - low)
                crc.append(zlib.crc32(part))
                if keep_ids:
                    kept.append(part)
                low, high = high, high + tokens
        arrays = [
            batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
            *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            *([pa.array(kept, pa.binary())] if keep_ids else []),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


#: Runs of pieces (``first`` is a rank), gaps (``first`` is a sequence) and, once placed, pieces with their places.
RUNS = "kind string, size int, first long, n long, sequence long, each int, offset int"
_COLUMNS = [c.split()[0] for c in RUNS.split(", ")]
_PIECE, _GAP, _PLACED = "piece", "gap", "placed"


def sweep(pieces: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], tokens: int) -> list[tuple]:
    """One range's round, as rows of ``RUNS``: pieces (length, first rank, number) take the smallest gaps (space, first
    sequence, number) of the range that they fit in, the longest first. In ``each = space // length`` pieces to a
    sequence, as after the first piece of a length the same sequence is the smallest gap for the next one."""
    have: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for space, first, n in sorted(gaps, reverse=True):
        have[space].append((first, n))
    out = []
    for length, rank, n in sorted(pieces, key=lambda p: (-p[0], p[1])):
        end = rank + n
        while rank < end and (fitting := [space for space, runs in have.items() if runs and space >= length]):
            space = min(fitting)
            each, (first, here) = space // length, have[space].pop()
            used = min(here, -(-(end - rank) // each))
            taken = min(end - rank, used * each)
            out.append((_PLACED, length, rank, taken, first, each, tokens - space))
            full, more = divmod(taken, each)
            for left, at, some in ((space, first + used, here - used), (space - each * length, first, full), (space - more * length, first + full, int(more > 0))):
                if some and left:
                    have[left].append((at, some))
            rank += taken
        if rank < end:
            out.append((_PIECE, length, rank, end - rank, None, None, None))
    return out + [(_GAP, space, first, n, None, None, None) for space, runs in have.items() for first, n in runs]


def opening(pieces: list[tuple[int, int, int]], opened: int, tokens: int) -> list[tuple]:
    """New sequences, each with one of the longest pieces that no gap fits: with all that are longer than half a sequence,
    or else with as many as hold ``OPENED_SHARE`` of the pieces' tokens. ``opened`` is the next sequence."""
    wanted = sum(n for length, _, n in pieces if 2 * length > tokens)
    wanted = wanted or max(1, int(OPENED_SHARE * sum(length * n for length, _, n in pieces) / tokens))
    out = []
    for length, rank, n in sorted(pieces, key=lambda p: (-p[0], p[1])):
        now = min(n, wanted)
        if now:
            out.append((_PLACED, length, rank, now, opened, 1, 0))
            if length < tokens:
                out.append((_GAP, tokens - length, opened, now, None, None, None))
        if now < n:
            out.append((_PIECE, length, rank + now, n - now, None, None, None))
        opened, wanted = opened + now, wanted - now
    return out


def next_round(runs: DataFrame, cuts: list[int], opened: int, tokens: int) -> DataFrame:
    """One round over the runs of pieces and gaps; ``cuts`` are the least sizes of all ranges but the first."""
    def range_of(size: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= size)) if cuts else F.lit(0)

    space = F.when(F.col("kind") == _GAP, F.col("size"))
    runs = runs.withColumn("_range", range_of(F.col("size")))
    # the smallest gap that fits: the last one in falling order of sizes, gaps before pieces of the same size
    inside = Window.partitionBy("_range").orderBy(F.col("size").desc(), F.col("kind"))
    found, fits = runs.withColumn("_inside", F.last(space, ignorenulls=True).over(inside)), F.col("_inside")
    if cuts:
        above = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = runs.groupBy("_range").agg(F.min(space).alias("_least"))
        carried = carried.select("_range", F.last("_least", ignorenulls=True).over(above).alias("_carried"))  # one row a range
        found, fits = found.join(carried, "_range"), F.coalesce("_inside", "_carried")
    found = found.withColumn("_to", F.when(fits.isNull(), F.lit(-1)).otherwise(range_of(fits)))

    def swept(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        of = lambda kind: list(rows.loc[rows["kind"] == kind, ["size", "first", "n"]].itertuples(index=False, name=None))
        out = opening(of(_PIECE), opened, tokens) if key[0] < 0 else sweep(of(_PIECE), of(_GAP), tokens)
        table = pd.DataFrame(out, columns=_COLUMNS)
        return table.astype({c: "Int64" for c in ("sequence", "each", "offset")})

    return found.select("_to", *_COLUMNS).groupBy("_to").applyInPandas(swept, RUNS)


def placed_runs(lengths: DataFrame, tokens: int, folder: str) -> DataFrame:
    """Places for ``lengths`` (``length, n``): runs of ranks with their first sequence, pieces to each, and offset."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("sequence", "long"), ("each", "int"), ("offset", "int"))]
    runs = stage(lengths.select(
        F.lit(_PIECE).alias("kind"), F.col("length").cast("int").alias("size"), F.lit(0).cast("long").alias("first"),
        F.col("n").cast("long").alias("n"), *none), "runs", folder)
    done, opened = [], 0
    while True:
        waiting = runs.where(F.col("kind") != _PLACED)
        facts = runs.agg(
            F.count(F.when(F.col("kind") == _PIECE, 1)).alias("pieces"), F.count(F.when(F.col("kind") != _PLACED, 1)).alias("runs"),
            # sequences begin with a piece at offset 0
            F.max(F.when(F.col("offset") == 0, F.col("sequence") + F.ceil(F.col("n") / F.col("each")))).alias("opened"),
        ).first()
        done.append(runs.where(F.col("kind") == _PLACED))
        opened = max(opened, facts["opened"] or 0)
        if not facts["pieces"]:
            break
        parts = -(-facts["runs"] // RANGE_RUNS)
        cuts = waiting.agg(F.percentile_approx("size", [i / parts for i in range(1, parts)]).alias("c")).first()["c"] if parts > 1 else []
        runs = stage(next_round(waiting, sorted(set(cuts)), opened, tokens), "runs", folder)
    all_done = done[0]
    for more in done[1:]:
        all_done = all_done.unionByName(more)
    return all_done


def pack(pieces: DataFrame, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to staged pieces; keeps all rows and columns."""
    spark = pieces.sparkSession
    folder = work_folder(spark, "packing-rounds")
    lengths = stage(pieces.groupBy("length").agg(F.count("*").alias("n")), "lengths", folder)
    places = stage(placed_runs(lengths, tokens, folder).select(
        F.col("size").alias("_length"), F.col("first").alias("_rank"), (F.col("first") + F.col("n")).alias("_end"),
        F.col("sequence").alias("_sequence"), F.col("each").alias("_each"), F.col("offset").alias("_offset")), "places")
    parts = max(RANK_PARTS, (lengths.agg(F.max("n")).first()[0] or 0) // RANK_ROWS)
    clear(spark, folder)
    ranked = running_total(pieces, ["length"], F.lit(1), ["doc_id", "piece", "ids_crc32"], "_at", parts)
    here = (F.col("length") == F.col("_length")) & (F.col("_at") >= F.col("_rank")) & (F.col("_at") < F.col("_end"))
    turn = F.col("_at") - F.col("_rank")
    # a few runs a length, whatever the number of pieces
    return ranked.join(F.broadcast(places), here).select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(turn / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + turn % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    )


def packed_documents(docs: DataFrame, using: tuple[str, tuple[tuple[str, int], ...]] | None = None, tokens: int = SEQUENCE_TOKENS,
                     keep_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Null and empty texts are one piece with ``END_ID`` alone; repeated rows are packed one by one; an empty table gives
    no piece. Other columns are left out."""
    return pack(stage(token_pieces(docs, using, tokens, keep_ids), "pieces"), tokens)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ``ids``: ``sequence_id, n_tokens, ids`` (at most one
    sequence's tokens in a row)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return out.select("sequence_id", "n_tokens", joined.alias("ids"))
