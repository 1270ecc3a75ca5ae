"""Every stage of the pipeline against a brute-force version of it, and the whole on a small table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablecraft.llm import mixing
from tests.llm.test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = [docs]
    for _, step in corpus_pipeline.STAGES:
        made.append(step(spark, made[-1], sf_dir).cache())
    return made


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_the_classifier_keeps_clean_documents(spark, sf_dir, stages):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {k for k, _ in pairs(stages[1])}
    good = [k for k, q in label.items() if q == 1]
    bad = [k for k, q in label.items() if q == 0]
    assert sum(k in kept for k in good) >= 0.97 * len(good)
    assert sum(k in kept for k in bad) <= 0.1 * len(bad)


def test_copies_go(stages):
    best = {}
    for k, t in pairs(stages[1]):
        best[t or ""] = max(best.get(t or "", k), k)
    assert Counter(pairs(stages[2])) == Counter((k, t) for t, k in best.items())


def test_one_of_each_linked_group_stays(stages):
    heads = {c for _, _, c in brute(pairs(stages[2]))}
    assert {k for k, _ in pairs(stages[3])} == heads and stages[3].count() == len(heads)


def test_the_mix_repeats_documents(stages):
    copies = {r.key: r.copies for r in mixing.mix(stages[3], mixing.word_count(F.col("text"))).collect()}
    assert Counter(k for k, _ in pairs(stages[4])) == +Counter(copies)


def test_every_document_of_the_mix_is_encoded(stages):
    rows = stages[5].collect()
    assert all(r.round_trip for r in rows)
    assert {r.doc_id for r in rows} == {k for k, _ in pairs(stages[4])}


def test_whole_run(spark, sf_dir, stages):
    def key(df):
        return Counter((r.doc_id, r["sample"], tuple(r.ids)) for r in df.collect())

    assert key(corpus_pipeline.run(spark, sf_dir)) == key(stages[5])


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf_dir)
        assert docs.count() == 0


def test_columns_of_any_name_pass_every_stage(spark, sf_dir, odd_docs):
    """Names that stages and operators use themselves, and one with a dot."""
    docs = odd_docs.withColumn("a.b", F.lit(1)).withColumn("__kept", F.lit("x")).withColumn("cluster", F.lit(2))
    for name, step in corpus_pipeline.STAGES[:-1]:
        left = step(spark, docs, sf_dir).cache()
        assert left.columns == docs.columns, name
        assert left.count() > 0
        docs = left
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in encoded.collect()} == {r.doc_id for r in docs.collect()}


def test_a_group_without_keys_keeps_one_document(spark, sf_dir):
    words = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"o{i}" for i in range(80))
    rows = [(None, words), (None, words + " more"), (None, other), (3, other + " more"), (3, "not like any"), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.one_of_each_group(spark, docs, sf_dir)
    texts = [r.text for r in left.collect()]
    assert len(texts) == 5 and (words in texts) != (words + " more" in texts) and other + " more" in texts and other not in texts
