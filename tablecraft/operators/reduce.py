"""Semi-joins of very large tables with many keys: rows without a partner go before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.sources.workspace import stage

WORDS = 64  # 64-bit words of a block of the filter
BITS_PER_KEY = 12
MOST_BLOCKS = 1 << 16  # 32 MB of filter
HOT_SHARE = 0.001


def _spots(key: str, blocks: int) -> tuple[Column, Column, Column]:
    """Block of a key, word in the block, and the three bits of the word that stand for it."""
    h = F.xxhash64(key)
    bits = [F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int") for at in (40, 46, 52)]
    one = F.lit(1).cast("long")
    mask = F.expr("0L")
    for b in bits:
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, b))
    return F.pmod(h, F.lit(blocks)), F.shiftrightunsigned(h, 34).bitwiseAND(F.lit(WORDS - 1)).cast("int"), mask


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``(block, words)``: a Bloom filter of at most ``blocks`` rows of ``WORDS`` 64-bit words."""
    block, word, mask = _spots(key, blocks)
    words = keys.select(block.alias("block"), word.alias("word"), mask.alias("mask")).groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
    held = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("held"))
    return held.select(
        "block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(0).cast("long"))).alias("words")
    )


def filtered(df: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter. The filter is broadcast; its size is bounded."""
    block, word, mask = _spots(key, blocks)
    probe = df.withColumn("__block", block)
    met = probe.join(F.broadcast(bloom.select(F.col("block").alias("__block"), F.col("words").alias("__words"))), "__block")
    found = F.col("__words")[word].bitwiseAND(mask) == mask
    return met.where(found).select(*df.columns)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """``(key)`` of the values that hold at least ``share`` of the rows with a known key, and perhaps a few
    more; at most ``4 / share``. Found by a sketch in one scan, so that no row is shuffled."""
    most = int(4 / share)
    tracked = 16 * most
    found = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("found")
    ).first()
    hot = [(x["item"],) for x in found.found or [] if x["count"] >= share * found.n]
    return df.sparkSession.createDataFrame(hot, T.StructType([T.StructField(key, df.schema[key].dataType)]))


def semi_join(df: DataFrame, keys: DataFrame, key: str, *, share: float = HOT_SHARE, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys``, for a key table that is too large to broadcast.

    A Bloom filter of the keys is broadcast first, and only rows that pass it are shuffled to the exact
    join. Its size follows the number of keys up to ``most_blocks``; a filter that is too small for its keys
    lets more rows pass, never fewer. Rows of hot keys, which would meet in one task, are decided by a
    broadcast of those few keys and not shuffled at all.
    """
    wanted = stage(keys.select(key).where(F.col(key).isNotNull()).distinct(), "semi-join-keys")
    blocks = max(1, min(most_blocks, wanted.count() * BITS_PER_KEY // (64 * WORDS) + 1))
    bloom = stage(bloom_filter(wanted, key, blocks), "bloom-filter")
    hot = hot_keys(df, key, share)
    hot_wanted = hot.join(wanted, key, "left_semi")
    decided = df.join(F.broadcast(hot_wanted), key, "left_semi")
    rest = filtered(df.join(F.broadcast(hot), key, "left_anti"), key, bloom, blocks)
    return decided.unionByName(rest.join(wanted, key, "left_semi")).select(*df.columns)
