"""Approximate nearest neighbours with one navigable small-world graph per shard.

The vectors are dealt evenly into shards of about ``PER_SHARD`` rows. Each shard builds a hierarchical
graph over its distinct vectors and is stored as one row of flat arrays: vectors, and for each layer
the neighbour numbers of every node. Queries meet every shard in blocks of at most ``PER_BLOCK``; a shard
answers with its best ``k`` rows for each query, and the answers of all shards are merged. The distances of some
queries to all vectors of a shard come from one product of matrices, and the walks through the graph look them up.

Nearness is the inner product. A graph needs a metric, so every vector gets one more component that
makes all vectors of the shard equally long; then the nearest by distance is the largest inner
product. The scores returned are inner products of the original vectors in double precision.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, as
query or candidate; so do vectors of another length than the query; a query never finds its own row,
but may find a copy of it; ties go to the smaller id; with fewer candidates than ``k`` all are found;
rows with a null id can be found but ask nothing. Other columns of any name do no harm.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.sources import stage

PER_SHARD = 4096
PER_BLOCK = 8192
LEAST_BLOCK = 2048  # queries are cut into up to four blocks of this size, so that a few shards make enough tasks
AT_ONCE = 256  # queries whose distances to a shard are held at a time
LINKS = 12  # links of a node on upper layers, twice as many on the ground
BREADTH = 64  # width of the search while building
ANSWER_BREADTH = 96  # width of the search for a query


class Graph:
    """Layers of flat neighbour arrays over lengthened vectors."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int) -> None:
        self.vectors, self.layers, self.entry = vectors, layers, entry

    def _near(self, query: np.ndarray, starts: list[int], links: np.ndarray, breadth: int) -> list[tuple[float, int]]:
        """The ``breadth`` nearest nodes found from ``starts``, as (distance, node)."""
        seen = bytearray(len(self.vectors))
        gap = self.vectors[starts] - query
        found = [(float(d), s) for d, s in zip(np.einsum("ij,ij->i", gap, gap), starts)]
        for s in starts:
            seen[s] = 1
        heapq.heapify(found)
        best = [(-d, s) for d, s in found]
        heapq.heapify(best)
        while found:
            d, node = heapq.heappop(found)
            if d > -best[0][0] and len(best) >= breadth:
                break
            fresh = [n for n in links[node].tolist() if n >= 0 and not seen[n]]
            if not fresh:
                continue
            gap = self.vectors[fresh] - query
            for d, n in zip(np.einsum("ij,ij->i", gap, gap).tolist(), fresh):
                seen[n] = 1
                if len(best) < breadth:
                    heapq.heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                else:
                    continue
                heapq.heappush(found, (d, n))
        return sorted((-d, n) for d, n in best)

    def search(self, query: np.ndarray, breadth: int) -> list[tuple[float, int]]:
        near = [self.entry]
        for links in reversed(self.layers[1:]):
            near = [self._near(query, near, links, 1)[0][1]]
        return self._near(query, near, self.layers[0], breadth)


def _walk(far: list[float], starts: list[int], links: list[list[int]], breadth: int) -> list[tuple[float, int]]:
    """What :meth:`Graph._near` finds, from known distances ``far`` to all nodes."""
    push, pop, swap = heapq.heappush, heapq.heappop, heapq.heapreplace
    seen = bytearray(len(far))
    for s in starts:
        seen[s] = 1
    found = [(far[s], s) for s in starts]
    best = [(-d, s) for d, s in found]
    heapq.heapify(found)
    heapq.heapify(best)
    room = breadth - len(best)
    while found:
        d, node = pop(found)
        if room <= 0 and d > -best[0][0]:
            break
        for n in links[node]:
            if seen[n]:
                continue
            seen[n] = 1
            d = far[n]
            if room > 0:
                push(best, (-d, n))
                room -= 1
            elif d < -best[0][0]:
                swap(best, (-d, n))
            else:
                continue
            push(found, (d, n))
    return sorted((-d, n) for d, n in best)


def walk_down(far: list[float], layers: list[list[list[int]]], entry: int, breadth: int) -> list[int]:
    """The nodes that :meth:`Graph.search` finds, nearest first, from known distances to all nodes."""
    near = [entry]
    for links in reversed(layers[1:]):
        near = [_walk(far, near, links, 1)[0][1]]
    return [n for _, n in _walk(far, near, layers[0], breadth)]


def link_lists(layer: np.ndarray) -> list[list[int]]:
    """The neighbours of every node of a layer; a row holds them first and -1 behind."""
    return [row[:n] for row, n in zip(layer.tolist(), (layer >= 0).sum(axis=1).tolist())]


def _spread(vectors: np.ndarray, near: list[tuple[float, int]], most: int) -> list[int]:
    """Links for a node: near ones that are nearer to it than to a link already taken, then the rest."""
    nodes = [n for _, n in near]
    given = vectors[nodes]
    norms = np.einsum("ij,ij->i", given, given)
    apart = (norms[:, None] + norms - 2 * given @ given.T).tolist()
    taken: list[int] = []
    left: list[int] = []
    for i, (d, _) in enumerate(near):
        if len(taken) >= most:
            break
        row = apart[i]
        (left if any(row[j] <= d for j in taken) else taken).append(i)
    return [nodes[i] for i in (taken + left)[:most]]


def build(vectors: np.ndarray, seed: int = 5) -> Graph:
    """A graph over the rows of ``vectors``, inserted one by one."""
    n = len(vectors)
    random = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - random.random(n)) / np.log(LINKS)).astype(int), 8)
    layers = [np.full((n, 2 * LINKS if at == 0 else LINKS), -1, np.int32) for at in range(int(level.max(initial=0)) + 1)]
    graph, top = Graph(vectors, layers, 0), int(level[0]) if n else 0
    for node in range(1, n):
        query, near = vectors[node], [graph.entry]
        for at in range(top, int(level[node]), -1):
            near = [graph._near(query, near, layers[at], 1)[0][1]]
        for at in range(min(top, int(level[node])), -1, -1):
            found = graph._near(query, near, layers[at], BREADTH)
            width = layers[at].shape[1]
            links = _spread(vectors, found, LINKS)
            layers[at][node, : len(links)] = links
            for other in links:
                row = layers[at][other]
                free = int((row >= 0).sum())
                if free < width:
                    row[free] = node
                    continue
                around = np.append(row, node)
                gap = vectors[around] - vectors[other]
                dist = np.einsum("ij,ij->i", gap, gap)
                kept = _spread(vectors, [(float(dist[i]), int(around[i])) for i in np.argsort(dist, kind="stable")], width)
                row[:] = -1
                row[: len(kept)] = kept
            near = [m for _, m in found]
        if level[node] > top:
            top, graph.entry = int(level[node]), node
    graph.layers = layers[: top + 1]
    return graph


def _store(shard: pd.DataFrame) -> pd.DataFrame:
    """One row with the index of a shard, for each length of vectors in it."""
    out = []
    for size, part in shard.groupby("dim"):
        part = part.sort_values("row")
        given = np.stack(part["vector"].to_numpy()).astype(np.float64)
        distinct, of = np.unique(given, axis=0, return_inverse=True)
        norms = np.einsum("ij,ij->i", distinct, distinct)
        extra = np.sqrt(np.maximum(norms.max() - norms, 0))
        graph = build(np.concatenate([distinct, extra[:, None]], axis=1))
        order = np.argsort(of.ravel(), kind="stable")
        out.append(
            {
                "shard": shard["shard"].iloc[0],
                "dim": size,
                "entry": graph.entry,
                "vectors": distinct.tobytes(),
                "extra": extra.tobytes(),
                "layers": [layer.tobytes() for layer in graph.layers],
                "members": np.asarray(of.ravel()[order], np.int64).tobytes(),
                "rows": part["row"].to_numpy(np.int64)[order].tobytes(),
                "ids": part["id"].fillna(0).to_numpy(np.int64)[order].tobytes(),
                "no_id": part["id"].isna().to_numpy()[order].tobytes(),
            }
        )
    return pd.DataFrame(out)


_INDEX = "shard long, dim long, entry long, vectors binary, extra binary, layers array<binary>, members binary, rows binary, ids binary, no_id binary"


_FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def _answer(k: int):
    def answer(index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []  # (query number, scores, rows, ids, whether the id is null)
        for stored in index.itertuples():
            asked = np.flatnonzero((block["dim"] == stored.dim).to_numpy())
            if not len(asked):
                continue
            vectors = np.frombuffer(stored.vectors).reshape(-1, stored.dim)
            lengths = np.einsum("ij,ij->i", vectors, vectors) + np.frombuffer(stored.extra) ** 2
            layers = [link_lists(np.frombuffer(b, np.int32).reshape(len(vectors), -1)) for b in stored.layers]
            members, rows, ids = (np.frombuffer(b, np.int64) for b in (stored.members, stored.rows, stored.ids))
            no_id = np.frombuffer(stored.no_id, bool)
            begins = np.searchsorted(members, np.arange(len(vectors) + 1))
            own = block["row"].to_numpy(np.int64)
            for some in np.array_split(asked, -(-len(asked) // AT_ONCE)):
                queries = np.stack(block["vector"].iloc[some].to_numpy()).astype(np.float64)
                apart = lengths + np.einsum("ij,ij->i", queries, queries)[:, None] - 2 * (queries @ vectors.T)
                for q, query, far in zip(some, queries, apart):
                    nodes = np.array(walk_down(far.tolist(), layers, stored.entry, max(ANSWER_BREADTH, k)))
                    size = begins[nodes + 1] - begins[nodes]
                    score = np.repeat(vectors[nodes] @ query, size)
                    at = np.repeat(begins[nodes] - (np.cumsum(size) - size), size) + np.arange(len(score))
                    fine = rows[at] != own[q]
                    at, score = at[fine], score[fine]
                    best = np.lexsort((ids[at], no_id[at], -score))[:k]
                    found = at[best]
                    out.append((np.full(len(found), q), score[best], rows[found], ids[found], no_id[found]))
        if not out:
            return pd.DataFrame({"query_row": [], "query_id": [], "row": [], "vec_id": [], "score": []})
        asked, score, row, vec_id, hidden = (np.concatenate(part) for part in zip(*out))
        of = block[["row", "id"]].iloc[asked].reset_index(drop=True)
        named = pd.Series(pd.array(vec_id, dtype="Int64")).mask(hidden)
        return pd.DataFrame({"query_row": of["row"], "query_id": of["id"], "row": row, "vec_id": named, "score": score})

    return answer


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """The stored shards of ``vectors(row, id, vector, dim)``, written so that they are built once.

    Building takes long for the few bytes of a shard, so shards are dealt by ranges: about one a task, where a hash
    would put several together and adaptive execution would merge small partitions.
    """
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return stage(dealt.repartitionByRange(shards, "shard").groupBy("shard").applyInPandas(_store, _INDEX), "vector-index")


def search(table: DataFrame, is_query: Column, k: int = 20, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_row, query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query row.

    A task holds one shard and one block of queries, both of bounded size, however large the table is.
    """
    clean = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = stage(
        table.where(usable(F.col(vector))).select(
            F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), clean.alias("vector"), F.size(vector).cast("long").alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asks")
        ),
        "vectors",
    )
    shards = max(1, -(-rows.count() // PER_SHARD))
    index = build_index(rows.drop("asks"), shards)
    asked = rows.where("asks").drop("asks")
    n = asked.count()
    blocks = max(1, -(-n // PER_BLOCK), min(4, -(-n // LEAST_BLOCK)))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    )
    found = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(_answer(k), _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_row", "query_id", "rank", "vec_id", "score")
