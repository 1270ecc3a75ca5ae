"""Graph search: recall against brute force, exact scores, odd vectors."""

from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import neighbours
from tablecraft.llm.queries import QUERIES


def recall(rows, ids, vectors, k):
    at = {v: i for i, v in enumerate(ids)}
    hits = total = 0
    by = defaultdict(list)
    for r in rows:
        by[r.query_id].append(r)
    for q, found in by.items():
        score = vectors @ vectors[at[q]]
        score[at[q]] = -np.inf
        best = {ids[i] for i in np.lexsort((ids, -score))[:k]}
        hits += len(best & {r.vec_id for r in found})
        total += len(best)
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert all(abs(r.score - score[at[r.vec_id]]) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    return hits / total, len(by)


def test_recall_on_the_table(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PER_SHARD", 700)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], np.float64)
    rows = QUERIES["op10_nearest_vectors"](spark, "/root/testdata/sf0.1").collect()
    share, n = recall(rows, ids, vectors, 20)
    assert n == (ids % 20 == 0).sum() and share > 0.9


def test_recall_in_one_graph_with_uneven_norms():
    random = np.random.default_rng(4)
    vectors = random.normal(size=(1500, 24)) * random.uniform(0.2, 3, size=(1500, 1))
    norms = (vectors**2).sum(axis=1)
    graph = neighbours.build(np.concatenate([vectors, np.sqrt(norms.max() - norms)[:, None]], axis=1))
    hits = 0
    for q in vectors[:100]:
        best = set(np.argsort(-(vectors @ q))[:10].tolist())
        hits += len(best & {n for _, n in graph.search(np.append(q, 0), 96)[:10]})
    assert hits / 1000 > 0.9


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 1), (3, [-1.0, 0.0], 1), (4, None, 1), (5, [0.0, 0.0], 1),
        (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (None, [2.0, 0.0], 1), (20, [1.0, 2.0, 3.0], 1), (40, [], 1),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int")
    found = neighbours.search(table, F.col("vec_id") % 20 == 0, 20).collect()
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: (r.query_id, r.rank))]
    assert got == [(0, 1, None, 2.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0), (0, 4, 2, 0.5), (0, 5, 3, -1.0)]
    assert neighbours.search(table.limit(0), F.lit(True), 20).count() == 0


def test_recall_over_several_full_shards(spark):
    """Three shards of about ``PER_SHARD`` rows, in clusters and with uneven norms; a few hundred queries."""
    random = np.random.default_rng(9)
    n = 2 * neighbours.PER_SHARD + 1000
    centres = random.normal(size=(60, 24))
    vectors = (centres[random.integers(0, 60, n)] + 0.4 * random.normal(size=(n, 24))) * random.uniform(0.5, 1.5, size=(n, 1))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(8)
    rows = neighbours.search(table, F.col("vec_id") % 40 == 0, 20).collect()
    share, asked = recall(rows, np.arange(n), vectors, 20)
    assert asked == len(range(0, n, 40)) and share > 0.9


def shard_of(vectors, ids=None):
    n = len(vectors)
    return pd.DataFrame({"shard": 0, "row": range(n), "id": ids or range(n), "vector": list(vectors), "dim": vectors.shape[1]})


@pytest.mark.parametrize("breadth", [1, 10, 96, 2000])
def test_walks_over_known_distances_find_what_the_search_finds(breadth):
    random = np.random.default_rng(7)
    vectors = random.normal(size=(1200, 17))
    graph = neighbours.build(vectors)
    assert len(graph.layers) > 1
    layers = [neighbours.link_lists(layer) for layer in graph.layers]
    for q in random.normal(size=(40, 17)):
        far = ((vectors - q) ** 2).sum(axis=1).tolist()
        assert neighbours.walk_down(far, layers, graph.entry, breadth) == [n for _, n in graph.search(q, breadth)]


def test_a_block_is_answered_from_products_of_matrices(monkeypatch):
    """No distance is computed node by node, and copies, own rows and null ids keep their order."""
    random = np.random.default_rng(8)
    vectors = np.repeat(random.normal(size=(300, 9)), 2, axis=0)
    ids = [None if i % 50 == 0 else i for i in range(600)]
    index = pd.DataFrame(neighbours._store(shard_of(vectors, ids)))
    asked = shard_of(vectors[:500]).assign(block=0)
    monkeypatch.setattr(neighbours.Graph, "_near", None)
    found = neighbours._answer(5)(index, asked)
    assert list(found.columns) == ["query_row", "query_id", "row", "vec_id", "score"]
    for q, part in found.groupby("query_row"):
        score = vectors @ vectors[q]
        order = sorted((i for i in range(600) if i != q), key=lambda i: (-round(score[i], 9), ids[i] is None, ids[i] or 0))[:5]
        assert part["row"].tolist() == order and part["query_id"].eq(q).all()
        assert part["vec_id"].isna().tolist() == [ids[i] is None for i in order]
        assert np.allclose(part["score"], score[order])


def test_the_index_is_sent_to_few_blocks(spark, monkeypatch):
    """A block of queries takes a copy of the whole index through the shuffle."""
    blocks = []
    monkeypatch.setattr(neighbours.F, "sequence", lambda low, high, real=F.sequence: blocks.append(high._jc.toString()) or real(low, high))
    table = spark.range(40_000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), (F.col("id") % 7).cast("double")).alias("embedding"))
    neighbours.search(table, F.col("vec_id") % 2 == 0, 3)
    assert blocks[0] == "3"  # 20,000 queries


def test_shards_are_built_in_tasks_of_their_own(spark, monkeypatch):
    table = spark.range(1600).select(F.col("id").alias("row"), F.col("id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"), F.lit(2).cast("long").alias("dim"))
    monkeypatch.setattr(neighbours, "stage", lambda df, name: df)
    index = neighbours.build_index(table, 16)
    together = [r["n"] for r in index.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(together) == 16 and max(together) <= 2
    assert index._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
