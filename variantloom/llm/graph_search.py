"""Nearest neighbours by a pruned graph: each shard of the vectors is a directed graph that a beam search walks.

A shard's graph starts with random edges. Then every vector is looked up by a greedy search; what the search visited is
pruned to diverse neighbours (a candidate goes if it is closer to a kept neighbour, by a factor, than to the
vector itself), and edges back are added and pruned alike. Where many vectors lie close together, all these edges stay
among them; so every node also has a few random ones, by which a search gets from one such group to another. Searches
and prunings of many vectors run side by side as array operations; distances are sums of squared differences, which
keep close vectors apart. Equal vectors are one node. Every query searches every shard and the shards' results are merged."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.llm.common import stage

#: Distinct vectors of a shard, on average.
SHARD_VECTORS = 8192
#: Edges of a node, and of the list that a search keeps while the graph is built.
DEGREE, BUILD_BEAM = 32, 64
#: Random edges of a node besides.
JUMPS = 8
#: Beam of a query in each shard.
BEAM = 128
#: Factors of the two passes by which a kept neighbour must be closer to prune a candidate.
RELAX = (1.0, 1.2)
#: Vectors that search and prune side by side.
SIDE_BY_SIDE = 256
#: Distances between candidates that a pruning step holds at most.
PRUNE_CELLS = 6_000_000
#: Components of candidates that get exact distances side by side.
EXACT_CELLS = 4_000_000
#: Queries that one group of a shard answers: beyond it the shard is loaded more than once.
GROUP_QUERIES = 16384
NEIGHBOURS = 10


def _distances(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``q`` from the nodes in its row of ``ids``."""
    away = x[ids]
    away -= q[:, None]
    return np.einsum("bkd,bkd->bk", away, away)


@dataclass
class Graph:
    """The vectors of a shard, each node's edges (its own number fills up), where searches begin, and random edges."""

    vectors: np.ndarray
    edges: np.ndarray
    start: int
    jumps: np.ndarray

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query, the nearest nodes a greedy search found, with squared distances; -1 and infinity fill up."""
        n, b = len(self.vectors), len(q)
        rows = np.arange(b)
        ids = np.full((b, beam), -1, np.int64)
        far = np.full((b, beam), np.inf, self.vectors.dtype)
        done = np.ones((b, beam), bool)
        ids[:, 0] = self.start
        far[:, 0] = _distances(self.vectors, q, ids[:, :1])[:, 0]
        done[:, 0] = False
        seen = np.zeros((b, n), bool)
        seen[:, self.start] = True
        active = rows
        while len(active):
            at = np.argmax(~done[active], axis=1)  # the list is sorted: the nearest one not yet expanded
            done[active, at] = True
            near = np.concatenate([self.edges[ids[active, at]], self.jumps[ids[active, at]]], axis=1)
            near.sort(axis=1)
            new = ~seen[active[:, None], near]
            new[:, 1:] &= near[:, 1:] != near[:, :-1]  # an edge may be there twice
            seen[active[:, None], near] = True
            d = np.where(new, _distances(self.vectors, q[active], near), np.inf)
            all_far = np.concatenate([far[active], d], axis=1)
            order = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(all_far, order, axis=1), axis=1, kind="stable"), axis=1)
            far[active] = np.take_along_axis(all_far, order, axis=1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], near], axis=1), order, axis=1)
            done[active] = np.take_along_axis(np.concatenate([done[active], ~new], axis=1), order, axis=1)
            ids[active] = np.where(np.isinf(far[active]), -1, ids[active])
            active = active[~done[active].all(axis=1)]
        return ids, far

    def prune(self, nodes: np.ndarray, candidates: np.ndarray, relax: float) -> None:
        """Chooses each node's edges among its candidates (-1 for none): the nearest, then the nearest that no chosen
        one is closer to by the factor, and so on."""
        ids = np.sort(np.where((candidates == nodes[:, None]) | (candidates < 0), len(self.vectors), candidates), axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = len(self.vectors)
        empty = ids == len(self.vectors)
        ids[empty] = 0
        own = np.where(empty, np.inf, _distances(self.vectors, self.vectors[nodes], ids))
        order = np.argsort(own, axis=1, kind="stable")
        ids, own = np.take_along_axis(ids, order, axis=1), np.take_along_axis(own, order, axis=1)
        width = int((own < np.inf).sum(axis=1).max(initial=0))
        ids, own = ids[:, :width], own[:, :width]
        # seen from the node, which leaves no more error than a small part of a candidate's own distance
        x = self.vectors[ids] - self.vectors[nodes][:, None]
        norms = np.einsum("bkd,bkd->bk", x, x)
        between = norms[:, :, None] + norms[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
        rows, alive = np.arange(len(nodes)), own < np.inf
        out = np.repeat(nodes[:, None], DEGREE, axis=1)
        for k in range(DEGREE):
            any_left = alive.any(axis=1)
            if not any_left.any():
                break
            best = np.argmax(alive, axis=1)
            out[any_left, k] = ids[rows, best][any_left]
            alive &= relax * relax * between[rows, best] > own
            alive[rows, best] = False
        self.edges[nodes] = out


def build(vectors: np.ndarray, seed: int = 3) -> Graph:
    n, rng = len(vectors), np.random.default_rng(seed)
    centre = vectors.mean(axis=0)
    start = int(np.argmin(((vectors - centre) ** 2).sum(axis=1)))
    # permutations: as many random edges lead to each node as away from it
    jumps = np.stack([rng.permutation(n) for _ in range(JUMPS)], axis=1)
    graph = Graph(vectors, rng.integers(0, n, (n, DEGREE)), start, jumps)
    for relax in RELAX:
        order = rng.permutation(n)
        for low in range(0, n, SIDE_BY_SIDE):
            nodes = order[low : low + SIDE_BY_SIDE]
            visited, _ = graph.search(vectors[nodes], BUILD_BEAM)
            graph.prune(nodes, np.concatenate([visited, graph.edges[nodes]], axis=1), relax)
            # edges back, a row of candidates per node that gets some
            to, source = graph.edges[nodes].reshape(-1), np.repeat(nodes, DEGREE)
            real = to != source
            to, source = to[real], source[real]
            turn = np.argsort(to, kind="stable")
            to, source = to[turn], source[turn]
            targets, first, count = np.unique(to, return_index=True, return_counts=True)
            turn = np.argsort(count, kind="stable")
            targets, first, count = targets[turn], first[turn], count[turn]
            part = 0
            while part < len(targets):
                # nodes with like numbers of new edges side by side, fewer the more they have
                size = max(1, PRUNE_CELLS // (DEGREE + int(count[min(part + 511, len(count) - 1)])) ** 2)
                t, f, c = (v[part : part + min(size, 512)] for v in (targets, first, count))
                back = np.arange(int(c.max()))
                back = np.where(back < c[:, None], source[np.minimum(f[:, None] + back, len(source) - 1)], -1)
                graph.prune(t, np.concatenate([graph.edges[t], back], axis=1), relax)
                part += len(t)
    return graph


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, not all zeros, and all components finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _precision(kind: str) -> type:
    """In what a graph keeps vectors of a type: in no less than they come in."""
    return np.float64 if "double" in kind else np.float32


def _packed(vectors: pd.Series, dtype) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype) for v in vectors]) if len(vectors) else np.zeros((0, 0), dtype)


def graph_index(nodes: DataFrame) -> DataFrame:
    """The graphs of all shards, from ``shard, node, embedding``: one row per node with its place and its edges (places in
    the shard; the random ones among them). The first place is where searches begin."""
    kind = nodes.schema["embedding"].dataType.simpleString()
    precision = _precision(kind)

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", kind="stable")
        graph = build(_packed(frame["embedding"], precision))
        order = np.concatenate([[graph.start], np.delete(np.arange(len(frame)), graph.start)])
        place = np.argsort(order)
        edges = place[np.concatenate([graph.edges, graph.jumps], axis=1)[order]].astype(np.int32)
        return pd.DataFrame({
            "shard": frame["shard"].to_numpy(), "node": frame["node"].to_numpy()[order], "place": np.arange(len(frame), dtype=np.int32),
            "embedding": [frame["embedding"].iloc[i] for i in order], "edges": list(edges),
        })

    return nodes.groupBy("shard").applyInPandas(index, f"shard int, node long, place int, embedding {kind}, edges array<int>")


def search_shards(index: DataFrame, queries: DataFrame, shards: int, groups: int, neighbours: int, beam: int) -> DataFrame:
    """Every query in every shard: ``query_id, node, score`` of the nearest nodes found, with exact distances. Every node
    of the beam gets its exact distance before any is dropped.

    A shard and a group of queries meet in one partition: first the shard's nodes, which are held, then the queries,
    which stream by in batches."""
    kind = index.schema["embedding"].dataType.simpleString()
    precision = _precision(kind)
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    nodes = index.select("shard", each, F.lit(0).alias("kind"), "place", F.col("node").alias("id"), "embedding", "edges")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("part"), F.lit(1).alias("kind"),
        F.lit(0).alias("place"), F.col("query_id").alias("id"), F.col("embedding").cast(kind).alias("embedding"),
        F.lit(None).cast("array<int>").alias("edges"),
    )
    both = nodes.unionByName(asked).repartition(shards * groups, "shard", "part")
    both = both.sortWithinPartitions("shard", "part", "kind", "place", "id")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held, graph, ids, exact = None, [], None, None, None
        for frame in frames:
            for key, rows in frame.groupby(["shard", "part"], sort=True):
                if key != current:
                    current, held, graph = key, [], None
                own = rows[rows["kind"] == 0]
                if len(own):
                    held.append(own)
                asked = rows[rows["kind"] == 1]
                if not len(asked) or not held:
                    continue
                if graph is None:
                    nodes = pd.concat(held)
                    exact, ids = _packed(nodes["embedding"], np.float64), nodes["id"].to_numpy()
                    graph = Graph(exact.astype(precision), _packed(nodes["edges"], np.int64), 0, np.zeros((len(nodes), 0), np.int64))
                for low in range(0, len(asked), SIDE_BY_SIDE):
                    part = asked.iloc[low : low + SIDE_BY_SIDE]
                    q = _packed(part["embedding"], np.float64)
                    # one more than asked for: the query's own vector may be among them
                    found, _ = graph.search(q.astype(precision), max(beam, neighbours + 1))
                    score = np.full(found.shape, np.inf)
                    some = max(1, EXACT_CELLS // (found.shape[1] * q.shape[1]))
                    for at in range(0, len(q), some):
                        score[at : at + some] = _distances(exact, q[at : at + some], found[at : at + some])
                    score = np.where(found >= 0, np.sqrt(score), np.inf)
                    order = np.lexsort((ids[found], score), axis=1)[:, : neighbours + 1]
                    found, score = np.take_along_axis(found, order, axis=1), np.take_along_axis(score, order, axis=1)
                    owner, at = np.nonzero(found >= 0)
                    yield pd.DataFrame({"query_id": part["id"].to_numpy()[owner], "node": ids[found[owner, at]], "score": score[owner, at]})

    return both.mapInPandas(search, "query_id long, node long, score double")


def nearest(vectors: DataFrame, every: int = 100, neighbours: int = NEIGHBOURS, shard_vectors: int = SHARD_VECTORS, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, the nearest other rows found.

    Nearness is Euclidean distance, in double precision on the vectors as given; ties go to the smaller id. Vectors that
    are null, zero or not finite take no part, nor do rows without an id; a vector of another length than most is an
    error of the data and takes no part. Of rows that share an id and a vector one takes part. Equal vectors are one node
    of the graph; the smallest ``neighbours + 1`` ids of each are kept, which is as many as a result can hold."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(usable("embedding") & F.col("vec_id").isNotNull())
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # 0.0 for -0.0, so that equal vectors have equal keys
    rows = rows.filter(F.size("embedding") == length["n"]).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0).cast("float")))
    rows = stage(rows.distinct().withColumn("key", F.sha2(F.to_json(F.struct("embedding")), 256)), "search-rows")
    ranked = rows.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("vec_id")))
    ranked = stage(ranked.filter(F.col("at") <= neighbours + 1), "search-copies")
    nodes = ranked.filter("at = 1")
    shards = max(1, -(-nodes.count() // shard_vectors))
    nodes = nodes.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), F.col("vec_id").alias("node"), "embedding")
    index = stage(graph_index(nodes), "search-index")
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    groups = max(1, -(-queries.count() // GROUP_QUERIES))
    found = search_shards(index, queries, shards, groups, neighbours, beam)
    copies = ranked.select("key", F.col("vec_id").alias("copy")).join(ranked.filter("at = 1").select("key", F.col("vec_id").alias("node")), "key")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # nodes first, so that their copies are looked up only for what can be in a result
    near = found.withColumn("at", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "node"))).filter(F.col("at") <= neighbours + 1)
    return (
        near.join(copies.select("node", F.col("copy").alias("vec_id")), "node")
        .filter("vec_id <> query_id")
        .select("query_id", F.row_number().over(best).cast("int").alias("rank"), "vec_id", "score")
        .filter(F.col("rank") <= neighbours)
    )
