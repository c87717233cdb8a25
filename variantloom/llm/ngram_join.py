"""N-gram Jaccard join: documents whose sets of word shingles overlap by a share of their union.

Equal sets are one class from the start. For classes, the filter is a prefix of the set under a global order of
shingles: if two sets are similar enough, their prefixes share a shingle, whatever the order. All orders put rare
shingles first (they are counted over the corpus), and differ in how they rank those of like frequency; a pair is
a candidate only if it shares a prefix shingle under every order. What stands in one class alone comes first in all
orders and can be shared with none, so most documents have no candidates at all. How long the prefixes of a pair are
depends on both sizes: a shingle proposes a pair only if it stands early enough in either set for that.

Candidates are not all pairs of those that share a prefix shingle. First each is compared with the least one that has
the shingle. What that leaves apart is compared with every other in full, but for pairs that are connected by then."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.chunks import (
    Chunk, bucket_codes, bucket_count, chunked, found_at, joined_arrays, opened, pack, pack_sorted, runs_of, unpack,
    unpack_sorted,
)
from variantloom.llm.common import clear, hashed_words, mixed, stage, window_hashes, window_starts, work_folder
from variantloom.llm.components import components

SHINGLE_WORDS = 5
#: Similarity in percent from which two documents are linked.
PERCENT = 75
#: Orders whose filters must agree.
ORDERS = 3


def shingle_sets(chunk: Chunk, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each document, sorted, one document after another, and their numbers."""
    parts = [t.lower().split() for t in chunk.texts]  # bytes: only A to Z change
    hashes, counts = hashed_words(parts)
    starts, owner = window_starts(counts, width)
    values, of = [window_hashes(hashes, width)[starts]] if len(starts) else [], [owner[starts]]
    first = np.cumsum(counts) - counts
    for k in range(1, width):  # a document with fewer words is one shingle by itself
        short = np.flatnonzero(counts == k)
        if len(short):
            values.append(window_hashes(hashes, k, salt=k)[first[short]])
            of.append(short)
    values, of = joined_arrays(values, np.uint64), joined_arrays(of, np.int64)
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.append(True, (values[1:] != values[:-1]) | (of[1:] != of[:-1]))[: len(values)]
    return values[new], np.bincount(of[new], minlength=len(parts))


def _describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document: where it is, and 128 bits of its set."""
    for frame in frames:
        for row in frame.itertuples():
            chunk = opened(row)
            values, counts = shingle_sets(chunk)
            ends = np.cumsum(counts)
            sums = [xxhash.xxh3_128_intdigest(values[b - n : b].tobytes()) for b, n in zip(ends, counts, strict=True)]
            ids = pd.array(chunk.ids, dtype="Int64")
            ids[~chunk.known] = pd.NA
            yield pd.DataFrame({
                "chunk": row.chunk, "at": np.arange(len(counts), dtype=np.int32), "doc_id": ids, "n_shingles": counts.astype(np.int64),
                "h1": np.array([s >> 64 for s in sums], np.uint64).view(np.int64), "h2": np.array([s % 2**64 for s in sums], np.uint64).view(np.int64),
            })


def _class_sets(row, places: np.ndarray) -> tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]:
    """The sets of a chunk's documents that stand for their classes: chunk, hashes, document of each, and set sizes."""
    chunk = opened(row)
    values, counts = shingle_sets(chunk)
    of = np.repeat(np.arange(len(counts)), counts)
    use = np.zeros(len(counts), bool)
    use[places] = True
    return chunk, values[use[of]], of[use[of]], counts


def _places(frame: pd.DataFrame) -> np.ndarray:
    return joined_arrays([np.asarray(x, np.int64) for x in frame["places"] if x is not None], np.int64)


def _count(buckets: int):
    def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"bucket": [], "chunk": [], "hashes": [], "counts": []}
        if len(left) and len(right):
            row = next(left.itertuples())
            _, values, _, _ = _class_sets(row, _places(right))
            codes, counts = np.unique(bucket_codes(values, buckets), return_counts=True)
            names, runs = runs_of(codes)
            for name, a, b in zip(names, runs[:-1], runs[1:], strict=True):
                out["bucket"].append(int(name))
                out["chunk"].append(row.chunk)
                out["hashes"].append(pack_sorted(codes[a:b].astype(np.uint32)))
                out["counts"].append(pack(counts[a:b].astype(np.int64)))
        return pd.DataFrame(out)

    return send


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers each chunk with its hashes that stand in two classes at least, and in how many."""
    hashes = [unpack_sorted(x, np.uint32) for x in frame["hashes"]]
    counts = [unpack(x, np.int64) for x in frame["counts"]]
    keys, at = np.unique(joined_arrays(hashes, np.uint32), return_inverse=True)
    total = np.bincount(at, joined_arrays(counts, np.int64), minlength=len(keys)).astype(np.int64)
    out = {"chunk": [], "bucket": [], "hashes": [], "counts": []}
    for chunk, bucket, own in zip(frame["chunk"], frame["bucket"], hashes, strict=True):
        n = total[np.searchsorted(keys, own)]
        if (n > 1).any():
            out["chunk"].append(chunk)
            out["bucket"].append(bucket)
            out["hashes"].append(pack_sorted(own[n > 1]))
            out["counts"].append(pack(n[n > 1]))
    return pd.DataFrame(out)


def least_common(n: int, m: int):
    """Shingles that sets of these sizes share at least if they are linked."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def ranked(values: np.ndarray, of: np.ndarray, spread: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each set in one of the orders: where they are, and their ranks in their sets.

    ``values`` are hashes grouped by their set ``of``, and ``spread`` is each hash's number of sets. Rare ones come first, by
    their number or by its logarithm, then by a hash of their own to each order."""
    rarity = spread if order == 0 else np.where(spread > 1, 1 + np.floor(np.log2(spread)), 0)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    rank = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    return np.lexsort((mixed(values, 11 + order), rarity, of)), rank


def _filter(buckets: int):
    names = ["doc", "n", "lone", "centre", "shared", *(f"p{k + 1}" for k in range(ORDERS))]

    def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The sets that may be linked: their shared shingles sorted by value, the longest prefix that any partner asks
        for under each order, without the ``lone`` shingles that come before it, and how shared they are."""
        out = {c: [] for c in names}
        if not len(left) or not len(right):
            return pd.DataFrame(out, dtype=object)
        chunk, values, of, sizes = _class_sets(next(left.itertuples()), _places(right))
        answers = right[right["hashes"].notna()]
        codes = [
            unpack_sorted(x, np.uint32).astype(np.uint64) | np.uint64(int(b)) << np.uint64(32)
            for b, x in zip(answers["bucket"], answers["hashes"], strict=True)
        ]
        codes = joined_arrays(codes, np.uint64)
        counts = joined_arrays([unpack(x, np.int64) for x in answers["counts"]], np.int64)
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        hit, at = found_at(bucket_codes(values, buckets), codes)
        spread = np.ones(len(values), np.int64)
        spread[hit] = counts[at[hit]]
        orders = [values[ranked(values, of, spread, k)[0]] for k in range(ORDERS)]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(of)), strict=True):
            n, lone = int(b - a), int((spread[a:b] == 1).sum())
            longest = n - -(-PERCENT * n // 100) + 1
            if lone >= longest:
                continue
            i = int(of[a])
            out["doc"].append(int(chunk.ids[i]))
            out["n"].append(n)
            out["lone"].append(lone)
            out["centre"].append(float(np.log2(spread[a:b]).mean()))
            out["shared"].append(values[a:b][spread[a:b] > 1].tobytes())
            out["p1"].append(orders[0][a + lone : a + longest].view(np.int64))
            for k in range(1, ORDERS):
                out[f"p{k + 1}"].append(orders[k][a + lone : a + longest].tobytes())
        # without rows pandas would make floats of the columns, and Arrow no lists of floats
        return pd.DataFrame(out, dtype=None if out["doc"] else object)

    schema = "doc long, n long, lone long, centre double, shared binary, p1 array<long>"
    return send, schema + "".join(f", p{k + 1} binary" for k in range(1, ORDERS))


def _common(a: bytes, b: bytes) -> int:
    """How many values two sorted arrays without repeats share."""
    joined = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    joined.sort(kind="stable")
    return int((joined[1:] == joined[:-1]).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that pass the other orders' filters and are similar enough, counted in full."""
    for batch in batches:
        rows = batch.to_pydict()
        good = []
        for i in range(batch.num_rows):
            n, m = rows["n"][i], rows["n_b"][i]
            least = least_common(n, m)
            ends = [8 * max(0, size - least + 1 - rows[lone][i]) for size, lone in ((n, "lone"), (m, "lone_b"))]
            linked = all(
                _common(rows[f"p{k}"][i][: ends[0]], rows[f"p{k}_b"][i][: ends[1]]) for k in range(2, ORDERS + 1)
            )
            good.append(linked and _common(rows["shared"][i], rows["shared_b"][i]) >= least)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("doc_b"), pa.array(good, pa.bool_())], ["doc", "doc_b", "linked"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among candidate pairs ``doc, doc_b``; the sets travel to the pairs, two joins."""
    columns = ["n", "lone", "shared", *(f"p{k}" for k in range(2, ORDERS + 1))]
    one = pairs.join(sets.select("doc", *columns), "doc")
    two = sets.select(F.col("doc").alias("doc_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    rows = one.join(two, "doc_b").select("doc", "doc_b", *columns, *[f"{c}_b" for c in columns])
    return rows.mapInArrow(_verify, "doc long, doc_b long, linked boolean").filter("linked").drop("linked")


def _early() -> Column:
    """Whether a shingle that two sets share stands within the prefixes that these two ask for."""
    least = F.ceil((F.col("n") + F.col("n_b")) * PERCENT / (100 + PERCENT))
    return (F.col("rank") + least <= F.col("n")) & (F.col("rank_b") + least <= F.col("n_b"))


def class_links(sets: DataFrame, under: str) -> DataFrame:
    """Links between classes that connect all that are similar: ``doc, doc_b``. Works in a folder of its caller."""
    own = sets.select("doc", "n", "lone", "centre", F.posexplode("p1").alias("at", "token"))
    own = own.select("doc", "n", "centre", (F.col("lone") + F.col("at")).alias("rank"), "token")
    # the hub of a shingle is the set whose shingles are most shared: a text that others were made from
    hub = F.max(F.struct("centre", (-F.col("doc")).alias("minus"), "n", "rank")).alias("hub")
    hubs = own.groupBy("token").agg(hub, F.count("*").alias("size")).filter("size > 1")
    hubs = hubs.select("token", (-F.col("hub.minus")).alias("doc_b"), F.col("hub.n").alias("n_b"), F.col("hub.rank").alias("rank_b"))
    near = own.join(hubs, "token").filter((F.col("doc") != F.col("doc_b")) & _early())
    pair = [F.greatest("doc", "doc_b").alias("doc"), F.least("doc", "doc_b").alias("doc_b")]
    tried = stage(near.select(*pair).distinct(), "join-hub-pairs", under)
    links = stage(verified(tried, sets), "join-hub-links", under)
    group = components(links, "doc", "doc_b", under).withColumnRenamed("node", "doc")
    rows = stage(
        own.join(group, "doc", "left").select("token", "doc", "n", "rank", "centre", F.coalesce("component", "doc").alias("component")),
        "join-tokens", under,
    )
    # a shingle counts no more if all its sets are connected; those outside its hub's component meet all others
    tokens = rows.groupBy("token").agg(
        F.max(F.struct("centre", (-F.col("doc")).alias("minus"), "component")).alias("hub"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    )
    tokens = tokens.filter("low < high").select("token", F.col("hub.component").alias("main"))
    rows = rows.drop("centre").join(tokens, "token")
    apart = rows.filter("component != main").drop("main")
    other = rows.select("token", *[F.col(c).alias(f"{c}_b") for c in ("doc", "n", "rank", "component")], "main")
    once = (F.col("component_b") == F.col("main")) | (F.col("doc") < F.col("doc_b"))
    pairs = (
        apart.join(other, (apart["token"] == other["token"]) & (F.col("component") != F.col("component_b")) & once & _early())
        .select(*pair)
        .distinct()
        .join(tried, ["doc", "doc_b"], "left_anti")
    )
    more = stage(verified(stage(pairs, "join-pairs", under), sets), "join-links", under)
    return links.unionByName(more)


def joined_documents(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles`` and ``component_id``, the smallest id that links reach.

    The words of a text, with A to Z in lower case, give its distinct 5-word shingles; fewer words are one shingle;
    a null or empty text has none and is linked with nothing. Rows that share an id are one document. A row without
    an id is linked with nothing, and its component is null."""
    spark, buckets = docs.sparkSession, bucket_count(docs)
    work = work_folder(spark, "join")
    chunks = stage(chunked(docs), "join-chunks", work)
    sets = stage(
        chunks.mapInPandas(_describe, "chunk long, at int, doc_id long, n_shingles long, h1 long, h2 long"), "join-sets"
    )
    usable = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(usable.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "chunk", "at")).alias("first")), "join-classes", work)
    places = classes.groupBy("first.chunk").agg(F.collect_list("first.at").alias("places"))
    counts = chunks.groupBy("chunk").cogroup(places.groupBy("chunk")).applyInPandas(
        _count(buckets), "bucket int, chunk long, hashes binary, counts binary"
    )
    answers = counts.groupBy("bucket").applyInPandas(_shared, "chunk long, bucket int, hashes binary, counts binary")
    answers = answers.unionByName(places, allowMissingColumns=True)
    send, schema = _filter(buckets)
    filtered = stage(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(send, schema), "join-filtered", work)
    group = components(class_links(filtered, work), "doc", "doc_b", work)
    classes = classes.select("h1", "h2", F.col("first.doc_id").alias("node")).join(group, "node", "left")
    classes = stage(classes.select("h1", "h2", F.coalesce("component", "node").alias("component")), "join-classes")
    clear(spark, work)
    return (
        sets.join(classes, ["h1", "h2"], "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns, that have the smallest id of their component.

    Rows without an id stay; of rows that share an id, one stays."""
    found = joined_documents(docs).filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).join(found, "doc_id", "left_semi")
    return named.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


SQL = """
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS pos FROM cut WHERE len(words) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS shingle FROM placed
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * shared >= 75 * (s.n + t.n - shared)
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM sizes
  UNION SELECT node, y FROM reach JOIN links ON seen = x
), least AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT c.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, c.doc_id)::BIGINT AS component_id
FROM cut c LEFT JOIN sizes s ON c.doc_id = s.doc_id LEFT JOIN least l ON c.doc_id = l.node
"""
