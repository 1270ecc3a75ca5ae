"""Benchmark search against brute force."""

import random
import re

import pytest

from tablecraft.llm import contamination

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        said = words(text)
        n = min(window, len(said))
        for i in range(len(said) - n + 1 if n else 0):
            windows.setdefault(tuple(said[i : i + n]), set()).add("" if name is None else str(name))
    made = []
    for key, text in docs:
        said, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(said) - n + 1):
                names = windows.get(tuple(said[i : i + n]))
                if names:
                    found |= names
                    hit |= set(range(i, i + n))
        made.append((key, len(said), len(hit), tuple(sorted(found))))
    return sorted(made, key=repr)


def searched(docs, items, **more):
    found = contamination.search(docs, items, **more).withColumn("n_hit", contamination.hit_words("spans"))
    return sorted(((r.key, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in found.collect()), key=repr)


def made_up(seed):
    """Texts over few words, so that windows share blocks, begin alike and end alike."""
    rng = random.Random(seed)
    said = ["a", "B", "é", "日本", "x1", "the", "The"]
    gaps = [" ", ", ", "\n", "--", "_", "\x00"]

    def text(n):
        return "".join(rng.choice(said) + rng.choice(gaps) for _ in range(n))

    items = [(i % 25, text(rng.choice([0, 1, 3, 9, 10, 11, 40]) if i else 2500)) for i in range(30)]
    items += [(None, text(12)), (None, None), (77, "--- , "), (78, items[5][1])]
    docs = [(i, text(rng.choice([0, 1, 8, 10, 60, 200]))) for i in range(60)]
    for i in range(20):
        cut = rng.choice(items)[1] or ""
        docs.append((100 + i, text(7) + cut + text(5)))
    docs += [(1, docs[0][1]), (1, docs[0][1]), (None, items[3][1]), (None, None), (5, "word " * 70_000 + (items[9][1] or "")), (6, "q" * 300_000)]
    return docs, [x for x in items if len(words(x[1])) not in (1, 3)] if seed else items


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("block_bytes", [contamination.BLOCK_BYTES, 1500])
def test_search_is_brute_force(spark, seed, block_bytes):
    docs, items = made_up(seed)
    given = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert searched(given, bench, block_bytes=block_bytes) == brute(docs, items)


def test_equal_fingerprints_do_not_hide_a_window(spark, monkeypatch):
    """With hashes of two values nearly everything collides; the comparison of words decides."""
    import numpy as np

    docs, items = made_up(1)
    joined = [(t or "").encode() for _, t in docs]
    monkeypatch.setattr(contamination, "mix64", lambda x: (x >> np.uint64(3)) & np.uint64(1))
    patterns = contamination.Patterns([(str(n), " ".join(words(t))) for n, t in items[1:] if words(t)], 10)
    text = contamination.Words(np.frombuffer(b"".join(joined), np.uint8), contamination.offsets([len(t) for t in joined]))
    spans, names = contamination._hits(text, patterns)
    hit = [sum(s["end"] - s["begin"] for s in x) for x in spans.to_pylist()]
    found = [(k, len(words(t)), n, tuple(sorted(x))) for (k, t), n, x in zip(docs, hit, names.to_pylist())]
    assert sorted(found, key=repr) == brute(docs, items[1:])


def test_odd_documents(spark, odd_docs, no_docs):
    items = [(1, " ".join(f"w{i}" for i in range(20, 40))), (2, "no key at all"), (3, "lang lang")]
    bench = spark.createDataFrame([(*x, "k", 1) for x in items], "item_id long, text string, key string, name int")
    given = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert searched(odd_docs, bench) == brute(given, items)
    assert searched(odd_docs, bench, block_bytes=10) == brute(given, items)
    assert searched(odd_docs, bench.limit(0)) == brute(given, [])
    assert searched(no_docs, bench) == [] == searched(no_docs, bench, block_bytes=10)
    clean = [r.key for r in contamination.clean_documents(odd_docs, bench).collect()]
    assert sorted(clean, key=repr) == sorted((k for k, _, n, _ in brute(given, items) if not n), key=repr)


def test_long_texts_are_cut_between_words():
    import numpy as np

    text = ("é" * 700 + " ") * 3000 + "z" * 2_500_000
    data = np.frombuffer(text.encode(), np.uint8)
    made = contamination.Words(data, np.array([0, len(data)]))
    assert len(made.hashes) == 3001 and made.lengths[-1] == 2_500_000
    assert len(set(made.hashes.tolist())) == 2
