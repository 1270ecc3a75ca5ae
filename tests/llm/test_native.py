"""Mixing, shards and exact dedup against SQL and brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablecraft.llm import exact_dedup, mixing, shards
from tablecraft.llm.oracle import ORACLE_SQL
from tablecraft.llm.queries import QUERIES
from tests.compare import connect, differences


NATIVE = {"op1_mix_sources", "op5_exact_dedup"}


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLE_SQL[key]) == []
    if key not in NATIVE:
        return
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert bad not in plan


def waterfill(sizes, weights, limit):
    targets, total, open_ = {}, sum(sizes.values()), set(sizes)
    left = total
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= limit * sizes[s]}
        if not full:
            return targets | {s: weights[s] * level for s in open_}
        targets |= {s: limit * sizes[s] for s in full}
        left -= sum(limit * sizes[s] for s in full)
        open_ -= full
    return targets


def test_mix_of_odd_documents(odd_docs):
    rows = mixing.mix(odd_docs, mixing.word_count(F.col("text"))).collect()
    assert len(rows) == odd_docs.count()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    targets = waterfill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s]


def test_mix_comes_near_the_targets(spark, sf_dir):
    rows = QUERIES["op1_mix_sources"](spark, sf_dir.replace("0.001", "0.01")).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_take_mix_repeats_rows(odd_docs):
    size = mixing.word_count(F.col("text"))
    wanted = Counter()
    for r in mixing.mix(odd_docs, size).collect():
        wanted[r.key] += r.copies
    mixed = mixing.take_mix(odd_docs, size)
    assert mixed.columns == odd_docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +wanted


@pytest.mark.parametrize("keys", [[None] * 400, [7] * 400, list(range(400))])
def test_equal_rows_are_taken_by_count(spark, keys):
    """A source of 400 equal rows, or rows that share a key, still comes near its target."""
    rows = [(k, "five words in every text", "a") for k in keys] + [(1000 + i, "word " * 10, "b") for i in range(100)]
    rows += [(None, f"text {i} of no key", "c") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    size = mixing.word_count(F.col("text"))
    taken, target, most = Counter(), {}, Counter()
    for r in mixing.mix(docs, size, limit=2).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1 for s in target) and len(target) == 3
    mixed = mixing.take_mix(docs, size, limit=2).withColumn("n", size).groupBy("source").agg(F.sum("n").alias("n")).collect()
    assert {r.source: r.n for r in mixed} == {s: n for s, n in taken.items() if n}


def test_empty_tables(no_docs):
    assert mixing.mix(no_docs, mixing.word_count(F.col("text"))).collect() == []
    assert mixing.take_mix(no_docs, mixing.word_count(F.col("text"))).collect() == []
    assert shards.shard(no_docs).collect() == []
    assert exact_dedup.copy_groups(no_docs).collect() == []
    assert exact_dedup.drop_copies(no_docs).collect() == []


@pytest.mark.parametrize("n", [1, 3, 16])
def test_shards_are_gapless_and_whole(odd_docs, n):
    rows = shards.shard(odd_docs, n).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    assert Counter((r.key, r.size, r.text_crc32) for r in rows) == Counter(
        (k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))


def test_shards_have_near_equal_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = shards.shard(docs, 16).collect()
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    by = Counter()
    for r in rows:
        by[r.shard] += r.size
    assert all(abs(b - total / 16) <= 0.02 * total / 16 + largest for b in by.values())
    shards_of, copies = defaultdict(set), Counter()
    for r in rows:
        shards_of[r.text_crc32].add(r.shard)
        copies[r.text_crc32] += 1
    assert sum(n > 1 for n in copies.values()) > 100
    assert all(len(x) == 1 for x in shards_of.values())


def test_slack_decides_whether_copies_are_divided(spark):
    """Groups of 100 copies in four shards of 500 rows: every cut falls into a group or beside it."""
    rows = [(i, f"text {i // 100:02d} of some length") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for slack, divided in ((0.0, None), (0.19, None), (1.0, 0)):
        by, shards_of = Counter(), defaultdict(set)
        for r in shards.shard(docs, 3, slack=slack).collect():
            by[r.shard] += r.size
            shards_of[r.text_crc32].add(r.shard)
        split = sum(len(x) > 1 for x in shards_of.values())
        largest, size = max(len(t) + 1 for _, t in rows), sum(len(t) + 1 for _, t in rows) / 3
        assert all(abs(b - size) <= slack * size + largest for b in by.values())
        assert split == 0 if divided == 0 or slack >= 0.16 else split > 0


def test_no_cut_is_lost_where_a_row_begins_just_below_its_target(spark):
    shards_, shard_bytes = 16, 2_000_000_000
    sizes, aims = [], [shard_bytes * n for n in range(1, shards_)]
    for n in range(shards_):  # the row of each target begins 0, 40, 80, ... bytes below it
        before = sum(sizes)
        sizes += [shard_bytes * (n + 1) - before - 40 * n, 1800] if n + 1 < shards_ else [shard_bytes * shards_ - before]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    placed = spark.createDataFrame([(i, s, z, i) for i, (s, z) in enumerate(zip(starts, sizes))], "text_hash long, start long, size long, row long")
    found = shards.cuts(placed, shards_)
    edges = [*zip(starts, range(len(sizes))), (sum(sizes), len(sizes))]
    assert found == [min(edges, key=lambda e: abs(e[0] - aim)) for aim in aims]


def test_copies_of_odd_documents(odd_docs):
    rows = exact_dedup.copy_groups(odd_docs).collect()
    groups = defaultdict(list)
    for r in odd_docs.collect():
        groups[hashlib.sha256((r.text or "").encode()).hexdigest()].append(r.doc_id)
    assert len(rows) == odd_docs.count()
    kept = Counter()
    for r in rows:
        members = groups[r.text_sha256]
        assert r.group_size == len(members)
        assert r.keep_key == max((m for m in members if m is not None), default=None)
        kept[r.text_sha256] += r.kept
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)


def test_drop_copies_keeps_one_of_each(odd_docs):
    left = exact_dedup.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    best = {}
    for r in odd_docs.collect():
        text = r.text or ""
        best[text] = max(best.get(text, -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in left.collect()) == Counter(best.items())


def test_a_full_filter_changes_nothing(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MOST_WORDS", 1)
    test_copies_of_odd_documents(odd_docs)
