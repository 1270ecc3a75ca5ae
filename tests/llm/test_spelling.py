"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from tablecraft.llm import spelling
from tablecraft.llm.queries import QUERIES

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def counts(docs):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    close = {w: set() for w in n}
    keyed = {}
    for w in n:
        for i in range(len(w) + 1):
            for k in {w[:i] + "\0" + w[i + 1 :], w[:i] + "\0" + w[i:]}:
                keyed.setdefault(k, set()).add(w)
    for group in keyed.values():
        for a in group:
            close[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in n:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(close[w]), n.get(form[w])) for w in n)


def found(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("most", [spelling.MOST, 40, 3])
def test_variants_are_brute_force(spark, monkeypatch, most):
    """Many words share a beginning or an end, so that buckets are divided down to single places."""
    rng = random.Random(5)
    n = {}
    for _ in range(1500):
        start, end = rng.choice(["inter", "", "é", "aaaa"]), rng.choice(["tion", "", "aaaaa"])
        word = start + "".join(rng.choice("abé") for _ in range(rng.randint(2, 6))) + end
        if len(word) >= 5:
            n[word] = rng.choice([3, 4, 6, 8, 20, 50, 1000])
    n |= {"q" * 3000 + x: 3 + len(x) for x in ("", "q", "a", "ab")} | {"b" + "q" * 3000: 9}
    n |= {f"step{'x' * i}": 3 * 2**i for i in range(12)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found(spelling.variants(words, most=most)) == brute(n)


def test_blocks_of_one_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 7)
    rng = random.Random(2)
    n = {"".join(rng.choice("abc") for _ in range(6)): rng.randint(3, 40) for _ in range(300)}
    import numpy as np

    got = Counter()
    words = sorted(n)
    places = np.stack([np.full(len(words), 6), np.zeros(len(words), int), np.full(len(words), 6)])
    for batch in spelling._compared(words, np.array([n[w] for w in words]), np.zeros(len(words), int), places):
        for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got[w] += c
    assert got == Counter({w: c for w, _, _, _, c, _ in brute(n) if c})


def test_all_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    result = brute(counts(docs))
    assert found(QUERIES["op13_spelling"](spark, sf_dir)) == result
    assert sum(r[1] is not None for r in result) > 5


def test_odd_documents(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(spelling.variants(spelling.word_counts(odd_docs, damage=97))) == brute(counts(docs))
    assert found(spelling.variants(spelling.word_counts(no_docs, damage=97))) == []
