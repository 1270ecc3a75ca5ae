import pytest

WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash
    with those that operators use."""
    base = " ".join(WORDS)
    near = " ".join([*WORDS[:30], "other", *WORDS[31:]])
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, near, "de", "a"),
        (4, None, "en", None),
        (5, "", None, "c"),
        (6, "", "fr", ""),
        (7, "x", "en", "a"),
        (8, "\t \n", "en", "b"),
        (9, "lang " * 30_000, "en", "c"),
        (10, "q" * 50_000, "en", "c"),
        (11, base.upper(), "en", "d"),
        (12, "ünï çödé ▁ 日本語 😀 </turn> ### \\", "fr", "d"),
        (12, "ünï çödé ▁ 日本語 😀 </turn> ### \\", "fr", "d"),
        (None, "no key at all", "en", "a"),
        (13, "four words are few", "en", "a"),
        (14, "four words are few", "en", "a"),
    ]
    clash = [(*r, None if r[1] is None else len(r[1]), 1, "k", 2, 3, "s", 4, "n", True) for r in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, shard int, component int, text_sha256 string, score int, name string, kept boolean"
    return spark.createDataFrame(clash, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
