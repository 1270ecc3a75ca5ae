"""Mixing sources to target weights by nested hash thresholds.

Every row draws a fixed number from its key and text. The tokens of each source are summed by the leading
bits of that number; the running sums say in which bucket the budget of the source ends, and only the rows
of that one bucket are summed again by the next bits. After a few levels the end is known to the row,
and the mix is the filter ``draw < threshold``: no row is sorted and no row is counted twice. Rows of the very
draw in which the budget ends, which are equal rows, are taken one by one up to it.

Defined results: a null key or text draws like an empty text; a null text has size 0; a null source is a
source of its own, ranked last; of equal rows any may be the ones that are taken; an empty table gives an
empty result. Only the named columns are read, so other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.batches import plain_names
from tablecraft.sources import stage

WORD = r"[^\x20\x09-\x0D]+"
LEVELS, LEVEL_BITS = 3, 12  # nine hex digits of a digest, three at a level


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draw_of(key: Column, text: Column) -> Column:
    """A number below 2**36 that depends on key and text alone."""
    whole = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), whole).cast("binary"))
    return F.conv(F.substring(digest, 1, LEVELS * LEVEL_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], limit: int) -> DataFrame:
    """Target per source from ``(source, source_size)``: the total shared by weight, at most ``limit``
    times the source, the excess reshared among the others.

    A source is full when its limit is reached at the level that all sources not yet full share. In
    the order of limit per weight the full ones come first, so one ordered pass finds them all. The
    windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("place"))
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("most", F.col("source_size") * limit)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("most_before", F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    )
    left = (F.col("total") - F.col("most_before")).cast("double")
    full = F.col("most").cast("double") * F.col("weight_left") <= left * F.col("weight")
    shared = (
        ranked.withColumn("full", full)
        .withColumn("full_most", F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(everything))
        .withColumn("open_weight", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything))
    )
    share = (F.col("total") - F.col("full_most")).cast("double") * F.col("weight") / F.col("open_weight").cast("double")
    return shared.select("source", "source_size", F.when(F.col("full"), F.col("most").cast("double")).otherwise(share).alias("target"))


def source_thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Whole copies and the draw below which one more copy is taken, per source.

    ``sized`` holds ``(source, size, draw)``. The boundary bucket is the first one whose running sum
    goes over the budget; on the last level it is one draw, and ``room`` says how much of it fits.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    found = (
        targets.withColumn("copies", copies)
        .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
        .withColumn("bucket", F.lit(0).cast("long"))
        .withColumn("before", F.lit(0).cast("long"))
        .withColumn("width", F.lit(0).cast("long"))
    )
    kept = ["source", "source_size", "target", "copies", "budget"]
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        boundary = found.select(F.col("source").alias("of"), *kept[1:], "bucket", "before")
        inside = sized.join(
            boundary, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("draw", shift + LEVEL_BITS) == F.col("bucket"))
        )
        sums = inside.groupBy(*kept, "before", F.shiftright("draw", shift).alias("bucket")).agg(F.sum("size").alias("width"))
        running = F.sum("width").over(Window.partitionBy("source").orderBy("bucket")) + F.col("before")
        over = sums.withColumn("reached", running).where(F.col("reached") > F.col("budget"))
        first = over.groupBy(*kept).agg(F.min(F.struct("bucket", (F.col("reached") - F.col("width")).alias("before"), "width")).alias("at"))
        found = first.select(*kept, "at.*")
    return found.select(F.col("source").alias("of"), "budget", F.col("bucket").alias("last"), (F.col("budget") - F.col("before")).alias("room"))


def _sizes(docs: DataFrame, size: Column, key: str, text: str, source: str) -> DataFrame:
    read = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), draw_of(F.col(key), F.col(text)).alias("draw"))
    return stage(read, "mix-sizes")


def _plan(sized: DataFrame, weights: Sequence[int], limit: int) -> DataFrame:
    """One row per source: what its documents need to know whether the mix takes them. It is written
    before it is joined, so Spark knows its size and does not deal the documents out by source."""
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, limit)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    met = targets.join(source_thresholds(sized, targets), F.col("source").eqNullSafe(F.col("of")), "left")
    told = met.select(
        F.col("source").alias("planned"), "source_size", "target", whole.cast("long").alias("whole"), F.coalesce(F.when(F.col("budget") > 0, F.col("last")), F.lit(-1)).alias("last"), F.coalesce("room", F.lit(0.0)).alias("room")
    )
    return stage(told, "mix-plan")


def _with_copies(joined: DataFrame, draw: Column, size: Column, source: str, order: list[Column]) -> DataFrame:
    """Rows that know the plan, with ``__copies``. Where the budget ends inside a draw, its rows are summed up in
    turn, and a row is taken if at least half of it fits; there are no others of that draw than equal rows."""
    at_end = draw == F.col("__mix.last")
    once = joined.where(~at_end).withColumn("__copies", F.col("__mix.whole") + F.when(draw < F.col("__mix.last"), 1).otherwise(0))
    in_turn = Window.partitionBy(source).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(in_turn), F.lit(0))
    last = joined.where(at_end).withColumn("__before", before)
    fits = F.col("__mix.room") - F.col("__before") >= size / 2
    return once.unionByName(last.withColumn("__copies", F.col("__mix.whole") + F.when(fits, 1).otherwise(0)).drop("__before"))


def mix(docs: DataFrame, size: Column, *, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken.

    ``copies`` says how often the mix repeats the document, 0 for never; ``taken`` is that times its
    size. The weights repeat over the sources in the order of their names. The narrow table of sizes
    is written once, so the texts are read once however many levels follow.
    """
    sized = _sizes(docs, size, key, text, source)
    plan = _plan(sized, weights, limit).select(F.struct("*").alias("__mix"))
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("__mix.planned")))
    told = _with_copies(joined, F.col("draw"), F.col("size"), "source", [F.col("size"), F.col("key")])
    copies = F.col("__copies")
    return told.select("key", "source", "size", "__mix.source_size", "__mix.target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, size: Column, *, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """The documents of the mix, each as often as the mix repeats it, with their own columns.

    The thresholds are one row per source, so the texts are filtered where they lie and never shuffle
    for the mix: copies follow from source and draw alone, but for the equal rows in which a budget ends.
    """
    plan = _plan(_sizes(docs, size, key, text, source), weights, limit).select(F.struct("*").alias("__mix"))
    plain, (own_key, own_text, own_source) = plain_names(docs.withColumn("__size", size), key, text, source)
    own_size = f"c{len(docs.columns)}"
    joined = plain.join(plan, F.col(own_source).eqNullSafe(F.col("__mix.planned")))
    order = [F.col(own_size), F.col(own_key)]
    told = _with_copies(joined, draw_of(F.col(own_key), F.col(own_text)), F.col(own_size), own_source, order)
    repeated = told.select(*plain.columns[:-1], F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))).alias("__copy"))
    return repeated.drop("__copy").toDF(*docs.columns)
