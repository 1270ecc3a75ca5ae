"""Exact removal of copies with a two-pass Bloom filter.

Pass one gives every text one place in a blocked Bloom filter: a word of 64 bits and two bits in it,
both taken from a hash of the text. A place that is hit twice may belong to a repeated text; the bits
of such places are the filter of possibly repeated hashes. Pass two tests every row against it. Rows
that miss it are alone and pass straight through; only the others shuffle, by their SHA-256, which
decides exactly.

The filter has one word for every 16 rows and at most ``MOST_WORDS`` words, which bounds what is
broadcast (two numbers a word). With more rows than that the filter fills up and more rows take the
exact path; no result depends on it.

Defined results: a null text counts as empty; a row with a null key loses against any other; of rows
that share text and key exactly one stays; an empty table gives an empty result. Other columns of any
name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.sources import stage

ROWS_PER_WORD = 16
MOST_WORDS = 1 << 22


def _place(text_hash: Column, words: int) -> tuple[Column, Column]:
    """Word and bit mask of a hash: three disjoint parts of its bits."""
    mask = F.lit(1).cast("long")
    one, two = (F.call_function("shiftleft", mask, F.shiftrightunsigned(text_hash, n).bitwiseAND(F.lit(63)).cast("int")) for n in (58, 52))
    return F.pmod(text_hash.bitwiseAND(F.lit((1 << 52) - 1)), F.lit(words)), one.bitwiseOR(two)


def repeat_filter(hashes: DataFrame, words: int) -> DataFrame:
    """``(word, bits)`` of the places that two or more rows of ``hashes(text_hash)`` hit."""
    word, mask = _place(F.col("text_hash"), words)
    hit = hashes.groupBy(word.alias("word"), mask.alias("mask")).agg(F.count(F.lit(1)).alias("hits"))
    return hit.where("hits > 1").groupBy("word").agg(F.bit_or("mask").alias("bits"))


def possibly_repeated(df: DataFrame, text_hash: Column, found: DataFrame, words: int) -> DataFrame:
    """``df`` with ``__maybe``: whether the row's place is in the filter. The filter has at most
    ``words`` rows, so it is broadcast and the rows stay where they are."""
    word, mask = _place(text_hash, words)
    bits = F.broadcast(found.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")))
    joined = df.withColumns({"__at": word, "__mask": mask}).join(bits, F.col("__at") == F.col("__word"), "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    return joined.withColumn("__maybe", hit).drop("__at", "__mask", "__word", "__bits")


def filter_words(rows: int) -> int:
    return max(1, min(MOST_WORDS, rows // ROWS_PER_WORD))


def _hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def copy_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, keep_key, group_size, kept, text_sha256.

    The largest key of equal texts stays. Key, digest and hash are written once; the texts are read
    once and never shuffle. Groups are counted with partial aggregation, and only then do the rows of
    groups meet their count, so a text that a third of all rows share is split like any skewed join.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = stage(
        docs.select(F.col(key).alias("key"), F.sha2(whole.cast("binary"), 256).alias("text_sha256"), _hash(F.col(text)).alias("text_hash"), F.monotonically_increasing_id().alias("row")),
        "text-digests",
    )
    words = filter_words(rows.count())
    marked = possibly_repeated(rows, F.col("text_hash"), repeat_filter(rows, words), words)
    alone = marked.where(~F.col("__maybe")).select("key", F.col("key").alias("keep_key"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = marked.where(F.col("__maybe")).select("key", "text_sha256", "row")
    best = maybe.groupBy(F.col("text_sha256").alias("of")).agg(F.max(F.struct("key", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    met = maybe.join(best, F.col("text_sha256") == F.col("of")).select(
        "key", F.col("best.key").alias("keep_key"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(met)


def drop_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without copies, with their own columns; of equal texts the largest key stays.

    Documents that miss the filter are not shuffled at all. The others are reduced to one per text in
    each task before they shuffle.
    """
    words = filter_words(docs.count())
    found = repeat_filter(docs.select(_hash(F.col(text)).alias("text_hash")), words)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    marked = possibly_repeated(packed, _hash(F.col("__text")), found, words)
    alone = marked.where(~F.col("__maybe")).select("__doc")
    rank = F.struct(F.col("__key").isNotNull(), F.col("__key"))
    met = (
        marked.where(F.col("__maybe"))
        .groupBy(F.sha2(F.col("__text").cast("binary"), 256).alias("__sha"))
        .agg(F.max_by("__doc", rank).alias("__doc"))
        .select("__doc")
    )
    return alone.unionByName(met).select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])
