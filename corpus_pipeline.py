"""From raw documents to sampled piece sequences, in five stages.

Each stage is ``(name, function)``; a function takes the session, the documents its predecessor kept
and the folder of the tables. ``run`` writes what a stage returns into the shared folder and reads it
again as the next one's documents, so that a lost executor costs no more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import exact_dedup, mixing, ngram_join, pieces, quality
from tablecraft.llm.queries import PIECE_MODEL, SAMPLES, held_out
from tablecraft.sources import read_parquet, stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the rows of ``labels`` that are not
    held out."""
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet")
    model = quality.learn(docs, labels, F.coalesce(~held_out("doc_id"), F.lit(False)))
    return quality.keep_good(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest key."""
    return exact_dedup.drop_copies(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram links join, the one with the smallest key."""
    return ngram_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document comes as often as the mix repeats it."""
    return mixing.take_mix(docs, mixing.word_count(F.col("text")))


def sampled_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document of the mix, decoded again as a check."""
    return pieces.encode(docs, pieces.load(PIECE_MODEL), SAMPLES, check=True).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", one_of_each_group),
    ("source mix", mixed),
    ("SentencePiece samples", sampled_pieces),
]

# A classifier and a sampler have no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
