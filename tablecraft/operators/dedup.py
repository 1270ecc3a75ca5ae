"""Duplicates, first rows and distinct values, written so that one huge group is no hot spot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_mask(df: DataFrame, columns: list[str], key: str, name: str = "is_duplicate") -> DataFrame:
    """Mark every row but the first of each group of equal ``columns``; ``key`` is unique and gives
    the order, and a repeated key is an error. Null equals null.

    A window over the groups would put a third of the table into one task when a third of the rows
    are copies. Instead the first key of each group comes from a grouped minimum, which is combined
    before the shuffle, and is looked up by ``key``, which spreads evenly. The rows of one key lie
    together after that join, so they are counted without another shuffle.
    """
    firsts = df.groupBy(*columns).agg(F.min(key).alias(key)).select(key, F.lit(True).alias("__first"))
    met = df.join(firsts, key, "left").withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(key)))
    repeated = F.raise_error(F.lit(f"{key} is not unique")).cast("boolean")
    return met.select(*df.columns, F.when(F.col("__rows") > 1, repeated).otherwise(F.col("__first").isNull()).alias(name))


def drop_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Full-row duplicates by default; any one row per group when ``columns`` are given."""
    return df.dropDuplicates(columns) if columns else df.dropDuplicates()


def keep_first(df: DataFrame, columns: list[str], order_by: list[str]) -> DataFrame:
    """The first row per group in the order of ``order_by``.

    Spark turns the rank-1 filter into a group limit before the shuffle, so each task sends at most
    one row per group.
    """
    ranked = Window.partitionBy(*columns).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def distinct_values(df: DataFrame, columns: list[str], data_type: T.DataType | str = "bigint") -> DataFrame:
    """``(column, value)``: the distinct values of several id columns in one pass, nulls included."""
    typed = df.select(*[F.col(c).cast(data_type).alias(c) for c in columns])
    return typed.unpivot([], columns, "column", "value").distinct()
