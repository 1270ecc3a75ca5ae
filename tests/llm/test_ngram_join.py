"""The n-gram join against brute force, with hot passages, chains and groups of near copies."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tablecraft.llm import ngram_join
from tablecraft.llm.queries import QUERIES

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_sets(rows):
    out = []
    for key, text in rows:
        words = (text or "").encode().translate(LOWER).split()
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        out.append((key, grams))
    return out


def brute(rows):
    """(key, shingles, component) of every row; sets are compared where they share a shingle."""
    sets = word_sets(rows)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((key, len(s), least.get(find(i))) for i, (key, s) in enumerate(sets)), key=repr)


def found(df):
    return sorted(((r.key, r.n_shingles, r.component) for r in ngram_join.link(df).collect()), key=repr)


def edited(words, rng, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


@pytest.fixture
def small_limits(monkeypatch):
    """Few holders and small blocks, so that small tables take every path."""
    monkeypatch.setattr(ngram_join, "FEW", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "FLUSH", 500)
    monkeypatch.setattr(ngram_join, "FILTER_BITS", (6, 8))


def hard_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    base = rng.choices(vocabulary, k=80)
    for _ in range(25):  # near copies, chained by growing edits
        base = edited(base, rng, 0.012)
        rows.append(" ".join(base))
    for share in (10, 20, 40, 80):  # one passage in texts that differ otherwise
        rows += [" ".join(passage + rng.choices(vocabulary, k=share)) for _ in range(10)]
    rows += [" ".join(edited(passage, rng, 0.03)) for _ in range(10)]
    rows += [" ".join(rng.choices(vocabulary[:4], k=n)) for n in range(1, 13)]
    rows += ["Same Copy of a text that many rows share " * 3] * 12 + ["same copy OF a text that many rows share " * 3]
    rows += [None, "", "  ", "one", "One", "one two three four", "z" * 5000]
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)] + [(1, rows[0])]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_table(spark, small_limits, seed):
    rows = hard_rows(seed)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_documents(odd_docs):
    assert found(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert ngram_join.link(odd_docs).count() == odd_docs.count()
    assert ngram_join.link(odd_docs.limit(0)).count() == 0


def test_all_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op4_ngram_join"](spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)


def test_similar_sets_share_a_given_signature():
    rng = np.random.default_rng(5)
    for size in [1, 2, 3, 4, 5, 7, 9, 16, 17, 33, 64, 65, 200, 511]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            keep = a[rng.random(len(a)) > rng.random() * 0.25]
            b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, size // 4 + 1))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < 75 * (len(a) + len(b) - both):
                continue
            given = [{x for _, n, sigs in ngram_join.signatures(s) for x in np.sort(sigs)[:n].tolist()} for s in (a, b)]
            assert given[0] & given[1]
            assert ngram_join.sketch_gap(ngram_join.sketch(a), ngram_join.sketch(b)) <= len(a) + len(b) - 2 * both


def test_a_signature_frequent_in_one_task_is_frequent_everywhere():
    few = ngram_join.FEW
    crowd, other = np.arange(1, few + 7, dtype=np.uint64) << np.uint64(20) | np.uint64(50), np.uint64(999 << 20 | 50)
    parts = [ngram_join._packed([np.full(len(who), 5 << 40, np.uint64)], [who], 0) for who in (crowd, np.array([other]))]
    met = ngram_join._met(pa.Table.from_batches(parts)).to_pylist()
    assert {x for r in met if r["star"] for x in (r["a"], r["b"])} == {*crowd.tolist(), int(other)}


@pytest.mark.parametrize("seed", range(2))
def test_crowd_in_one_partition_and_a_few_elsewhere(spark, seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = [" ".join(passage + [f"s{seed}-{i}-{k}" for k in range(rng.choice((4, 12, 30)))]) for i in range(45)]
    rows = [(i, t) for i, t in enumerate(rows)]
    crowd, rest = (spark.createDataFrame(part, "doc_id long, text string").coalesce(1) for part in (rows[:36], rows[36:]))
    assert found(crowd.union(rest)) == brute(rows)


def test_null_keys_link(spark, small_limits):
    rng = random.Random(3)
    rows = []
    for n in range(8):
        words = [f"n{n}-{i}" for i in range(70)]
        rows += [(key, " ".join(edited(words, rng, 0.01))) for key in ((None, 5 + n), (None, None), (9, None, None))[n % 3]]
    rows += [(None, "same text with six words here")] * 3 + [(2, "same text with six words here")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_a_crowd_of_near_copies_gives_no_pairs(spark, monkeypatch):
    """All of 60 texts are alike, and 8 blocks of them meet; links stay below the number of sets."""
    monkeypatch.setattr(ngram_join, "FEW", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    made = []

    def counted(*given, real=ngram_join._met_blocks):
        links = real(*given)
        made.append((links.count(), given[2].count()))
        return links

    monkeypatch.setattr(ngram_join, "_met_blocks", counted)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(base, rng, 0.012))) for i in range(60)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    (own, blocks), (others, pairs) = made
    assert blocks > 4 and own < 60 and others < 60 + pairs


def test_forest_joins_what_links(spark):
    import pandas as pd

    rng = random.Random(1)
    base = list(range(1, 200))
    sets = [np.unique(np.array([x if rng.random() > 0.1 else rng.getrandbits(60) for x in base], np.uint64)) for _ in range(40)]
    frame = pd.DataFrame({"name": range(40), "size": [len(s) for s in sets], "sketch": [ngram_join.sketch(s).tobytes() for s in sets], "shingles": [s.tobytes() for s in sets], "component": [i // 2 for i in range(40)]})
    links = ngram_join._forest(frame, frame)
    parent = [i // 2 for i in range(40)]
    for a, b in links.itertuples(index=False):
        assert ngram_join._similar_sets(sets[a], sets[b])
        parent = [parent[a] if p == parent[b] else p for p in parent]
    for a in range(40):
        for b in range(40):
            assert not ngram_join._similar_sets(sets[a], sets[b]) or parent[a] == parent[b]
    assert len(links) == 20 - len(set(parent))


def staged(monkeypatch):
    """The names of the tables that the join writes from here on."""
    names = []
    monkeypatch.setattr(ngram_join, "stage", lambda df, name, real=ngram_join.stage, **more: names.append(name) or real(df, name, **more))
    return names


def reached(links):
    """The smallest name that each name reaches."""
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("at_once", [5, 500_000])
def test_components_of_hard_graphs(spark, monkeypatch, at_once):
    monkeypatch.setattr(ngram_join, "AT_ONCE", at_once)
    rng = random.Random(4)
    names = [rng.getrandbits(63) - 2**62 for _ in range(900)]
    chain, hub, rest = names[:200], names[200:400], names[400:]
    links = list(zip(chain, chain[1:])) + [(max(hub), x) for x in hub] + [tuple(rng.sample(rest, 2)) for _ in range(260)]
    links += [(rest[0], rest[0]), *links[:50], *[(b, a) for a, b in links[-50:]]]
    rng.shuffle(links)
    # Only names with a link of two ends have a component.
    want = {k: v for k, v in reached(links).items() if any(a != b and k in (a, b) for a, b in links)}
    got = ngram_join.components(spark.createDataFrame(links, "name_a long, name_b long").repartition(9)).collect()
    assert sorted(map(tuple, got)) == sorted(want.items())


def test_stars_take_no_round(spark, monkeypatch):
    """Links that are stars already, in any number of partitions and with copies, are only checked."""
    names = staged(monkeypatch)
    links = [(10 * k, 10 * k + i) for k in range(30) for i in range(1, 8)] * 2
    got = ngram_join.components(spark.createDataFrame(links, "name_a long, name_b long").repartition(8)).collect()
    assert sorted(map(tuple, got)) == sorted(reached(links).items())
    assert names == ["links"]


def test_rounds_of_a_chain_and_of_what_joins_two_chains(spark, monkeypatch):
    """Tasks join their own links first, so a chain in order takes few rounds; what is joined stays so."""
    names = staged(monkeypatch)
    chain = [(i, i + 1) for i in range(2000) if i != 1000]
    joined = ngram_join.stars(spark.createDataFrame(chain, "name_a long, name_b long").repartitionByRange(8, "name_a"))
    assert names.count("large-star") <= 3
    first = len(names)
    more = spark.createDataFrame([(1000, 1001)], joined.schema)
    both = ngram_join.components(joined.unionByName(more)).collect()
    assert sorted(map(tuple, both)) == [(i, 0) for i in range(2001)]
    assert names[first:].count("large-star") <= 2
