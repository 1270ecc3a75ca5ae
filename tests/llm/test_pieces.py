"""Sampled segmentations: exact round trip, probabilities against enumeration, repeatable rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import pieces
from tablecraft.llm.queries import PIECE_MODEL, QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(PIECE_MODEL)


def all_paths(lattice, node, stop):
    if node == stop:
        yield [], 0.0
        return
    for e in range(lattice.begin[node], lattice.begin[node] + lattice.count[node]):
        for rest, log in all_paths(lattice, lattice.target[e], stop):
            yield [e, *rest], log + lattice.log[e]


def test_pairs_are_drawn_without_replacement(vocabulary):
    n = 6000
    lattice, samplers = pieces.sample(["hello"] * n, [f"k{i}" for i in range(n)], 2, vocabulary)
    exact = {tuple(p): math.exp(log) for p, log in all_paths(lattice, lattice.first[0], lattice.last[0])}
    assert sum(exact.values()) == pytest.approx(1)
    seen = Counter((tuple(s.paths[0]), tuple(s.paths[1])) for s in samplers)
    for (a, b), count in seen.most_common(4):
        expected = exact[a] * exact[b] / (1 - exact[a])
        assert count / n == pytest.approx(expected, abs=4 * math.sqrt(expected / n))
    for s in samplers[:50]:
        assert s.values == sorted(s.values, reverse=True)
        for path, logs in zip(s.paths, s.logs):
            assert logs[-1] == pytest.approx(math.log(exact[tuple(path)]), abs=1e-6)


def test_short_texts_give_all_segmentations(vocabulary):
    lattice, samplers = pieces.sample(["ab", "", None], ["x", "y", "z"], 50, vocabulary)
    paths = {tuple(p) for p, _ in all_paths(lattice, lattice.first[0], lattice.last[0])}
    assert {tuple(p) for p in samplers[0].paths} == paths
    assert [len(s.paths) for s in samplers[1:]] == [1, 1]


def test_odd_documents_round_trip(odd_docs, vocabulary):
    encoded = pieces.encode(odd_docs, vocabulary, 3, check=True)
    rows = encoded.collect()
    assert all(r.round_trip for r in rows)
    texts = Counter((r.doc_id, r.text or "") for r in odd_docs.collect())
    decoded = pieces.decode(encoded.where("sample = 1").drop("round_trip"), vocabulary).collect()
    assert Counter((r.key, r.text) for r in decoded) == texts
    by = defaultdict(list)
    for r in rows:
        by[r.key].append(r)
    for key, made in by.items():
        if key not in (12,):
            assert len({tuple(r.ids) for r in made}) == len(made)
        assert all(r.log_inclusion <= 0 and r.log_prob <= 1e-9 for r in made)
    assert all(r.log_inclusion == 0 for r in by[5])
    again = pieces.encode(odd_docs.repartition(7), vocabulary, 3).collect()
    plain = Counter((r.key, r["sample"], tuple(r.ids)) for r in rows)
    assert Counter((r.key, r["sample"], tuple(r.ids)) for r in again) == plain
    assert pieces.encode(odd_docs.limit(0), vocabulary, 3).count() == 0


def test_every_document(spark, sf_dir):
    rows = QUERIES["op3_sampled_pieces"](spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.length("text") > 1).count()
    summary = rows.groupBy("sample").agg(F.count("*").alias("n"), F.min("round_trip").alias("exact")).collect()
    assert len(summary) == 2 and all(r.exact and r.n >= n for r in summary)


def test_null_ids_decode_to_null(spark, vocabulary):
    rows = pieces.decode(spark.createDataFrame([(1, None), (2, [])], "key long, ids array<int>"), vocabulary).collect()
    assert [(r.key, r.text) for r in rows] == [(1, None), (2, "")]


def test_backward_sums_of_a_long_word(vocabulary):
    lattice = pieces.Lattice(["▁" + "ab" * 2000, "\n", "▁x"], vocabulary)
    assert np.isfinite(lattice.sums).all() and lattice.sums[lattice.last] == pytest.approx(0)
