"""Contiguous shards of nearly equal bytes from global prefix sums.

The rows are put in one order, by a hash of the text and then by key, so that equal texts lie side by
side. Every partition of that order sums its own sizes; the totals of the partitions, one row each,
give the offset of each partition, and offset plus own sum is the position of every row in the whole
table. Cutting the positions at equal targets gives the shards.

A cut that falls into a run of equal texts moves to the nearer end of the run when the run is at most
``slack`` of a shard, so only large groups of copies are divided; shards then differ by at most that and one
row. ``slack=0`` divides every group at the row that is nearest, ``slack=1`` none that is smaller than a shard.

Defined results: a null text has size 1 and the checksum of no bytes, 0; null keys come first among
equal texts; repeated rows are rows of their own; with fewer rows than shards some shards are empty;
an empty table gives an empty result. Other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.sources import stage

SLACK = 0.01  # share of a shard


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row the bytes and the rows before it in its partition, batch by batch."""
    size_before = rows_before = 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        ends = size_before + np.cumsum(sizes)
        rows = rows_before + np.arange(len(sizes))
        columns = [*batch.columns, pa.array(ends - sizes), pa.array(rows)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "size_before", "rows_before"])
        if len(sizes):
            size_before, rows_before = int(ends[-1]), rows_before + len(sizes)


def placed_rows(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """``(key, size, text_crc32, text_hash, start, row)``: the place of every row in the whole order,
    in bytes and in rows.

    The texts are read once, into a table of five numbers a row. That table is dealt into ranges of
    the order, and written with the sums inside the range, so that a lost executor or a second read
    cannot deal the rows anew.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = stage(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.xxhash64(whole).alias("text_hash"),
        ),
        "shard-rows",
    )
    order = ["text_hash", "key"]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kinds = "key {}, size long, text_crc32 long, text_hash long, part int, size_before long, rows_before long"
    summed = stage(dealt.mapInArrow(_sum_up, kinds.format(narrow.schema["key"].dataType.simpleString())), "shard-sums")
    totals = summed.groupBy("part").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    offsets = totals.selectExpr(
        "part",
        "sum(size) over (order by part) - size as size_offset",
        "sum(rows) over (order by part) - rows as rows_offset",
    )
    return summed.join(offsets, "part").select(
        "key",
        "size",
        "text_crc32",
        "text_hash",
        (F.col("size_before") + F.col("size_offset")).alias("start"),
        (F.col("rows_before") + F.col("rows_offset")).alias("row"),
    )


def cuts(placed: DataFrame, shards: int, slack: float = SLACK) -> list[tuple[int, int]]:
    """Where shards 1, 2, ... begin, in bytes and in rows. At most ``shards`` rows and as many runs of
    equal texts reach the driver.

    Target ``n`` lies at ``n * total / shards``. All is decided in whole numbers, ``shards`` times as
    large: the one row of a target has ``start * shards <= n * total < (start + size) * shards``.
    """
    total = placed.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    end = F.col("start") + F.col("size")
    targets_before = [f"({x} * {shards}L + {total - 1}L) div {total}L" for x in ("start", "(start + size)")]
    crossing = placed.where(" <> ".join(targets_before)).select("text_hash", "start", "row", "size")
    runs = (
        placed.join(F.broadcast(crossing.select("text_hash").distinct()), "text_hash")
        .groupBy("text_hash")
        .agg(F.min("start").alias("first"), F.min("row").alias("first_row"), F.max(end).alias("last"), F.max("row").alias("last_row"))
    )
    found = []
    known = {r.text_hash: r for r in runs.collect()}
    rows = crossing.collect()
    for n in range(1, shards):
        aim = total * n
        at = next((r for r in rows if r.start * shards <= aim < (r.start + r.size) * shards), None)
        if at is None:
            raise RuntimeError(f"no row holds the beginning of shard {n} of {shards}")
        run = known[at.text_hash]
        if (run["last"] - run["first"]) * shards <= slack * total:
            low, high = (run["first"], run.first_row), (run["last"], run.last_row + 1)
        else:
            low, high = (at.start, at.row), (at.start + at.size, at.row + 1)
        found.append(low if aim - low[0] * shards <= high[0] * shards - aim else high)
    return found


def shard(docs: DataFrame, shards: int = 16, *, key: str = "doc_id", text: str = "text", slack: float = SLACK) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot.

    ``slot`` counts the rows of a shard from 0 without gaps, because a shard is one stretch of the
    order and the row number at its beginning is known.
    """
    placed = placed_rows(docs, key=key, text=text)
    begins = [(0, 0), *cuts(placed, shards, slack)]
    number = F.lit(0)
    first = F.lit(0).cast("long")
    for n, (_, row) in enumerate(begins):
        reached = F.col("row") >= row
        number = F.when(reached, n).otherwise(number)
        first = F.when(reached, F.lit(row).cast("long")).otherwise(first)
    return placed.select("key", "size", "text_crc32", number.cast("int").alias("shard"), (F.col("row") - first).alias("slot"))
