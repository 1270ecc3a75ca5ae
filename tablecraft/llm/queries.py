"""The registered queries of this subpackage: key -> function of (session, table folder).

Each one applies its operator to the whole table and derives the columns of its contract.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import chat, contamination, exact_dedup, html_text, language, mixing, neighbours, ngram_join, pieces, quality, repair, shards, spelling
from tablecraft.sources import read_parquet

PIECE_MODEL = os.environ.get("TABLECRAFT_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SAMPLES = 2  # segmentations sampled for each text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    return mixed.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


@query
def op2_byte_shards(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return shards.shard(docs, 16).select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_exact_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return exact_dedup.copy_groups(docs).select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", "text_sha256"
    )


@query
def op6_chat_examples(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    forged = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(forged)
    return chat.read_back(chat.conversation_examples(turns)).withColumnRenamed("key", "conv_id")


@query
def op7_main_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return html_text.extract(pages, "page_id", "url").withColumn("n_chars", F.char_length("text").cast("long"))


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


@query
def op8_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = language.learn(docs, F.coalesce(~held_out("doc_id"), F.lit(False)))
    return language.predict(docs, model, "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"))


@query
def op9_quality(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels, F.coalesce(~held_out("doc_id"), F.lit(False)))
    scored = quality.score(docs, model, "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op10_nearest_vectors(spark, sf_dir):
    found = neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
    return found.select("query_id", "rank", "vec_id", "score", "query_row")


@query
def op4_ngram_join(spark, sf_dir):
    linked = ngram_join.link(_table(spark, sf_dir, "documents"))
    return linked.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query
def op3_sampled_pieces(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    encoded = pieces.encode(docs, pieces.load(PIECE_MODEL), SAMPLES, check=True)
    return encoded.select(F.col("key").alias("doc_id"), "sample", F.size("ids").alias("n_pieces"), "log_prob", "log_inclusion", "round_trip", "ids")


@query
def op12_contamination(spark, sf_dir):
    found = contamination.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        contamination.hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op13_spelling(spark, sf_dir):
    return spelling.variants(spelling.word_counts(_table(spark, sf_dir, "documents"), damage=97))


@query
def op11_repair(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    damaged = repair.damage(turns, key="conv_id", turn="turn", role="role", text="text")
    keys = turns.select(F.col("conv_id").alias("key"))
    return repair.report(keys, repair.repair(damaged)).withColumnRenamed("key", "conv_id")
