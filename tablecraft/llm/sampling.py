"""A bounded sample of each class without sorting the classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.sources import stage


def smallest_of_each(rows: DataFrame, by: str, chance: str, most: int, *, ties: str) -> DataFrame:
    """The ``most`` rows of each class ``by`` with the smallest ``chance`` (a 64-bit hash), ties by ``ties``.

    The classes are counted first. A threshold on the hash, from the count of the class, then leaves a few more
    rows of each class than wanted wherever they lie, and only these are ranked, so no task sorts a class.
    That fewer are left than wanted is less likely than one in 10^9, and would make the sample smaller.
    """
    counts = rows.groupBy(F.col(by).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    counts = stage(counts, "class-counts")  # of known size, so the rows are not dealt out by class to meet it
    share = (most + 8 * most**0.5 + 8) / F.col("__n")
    place = F.col(chance) / F.lit(2.0**64) + 0.5
    near = rows.join(counts, F.col(by) == F.col("__class")).where(place < share).drop("__class", "__n")
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy(by).orderBy(chance, ties)))
    return ranked.where(F.col("__rank") <= most).drop("__rank")
