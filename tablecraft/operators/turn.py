"""From one aggregate over a whole table to one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_per_entry(df: DataFrame, entries: list[dict[str, Column]]) -> DataFrame:
    """One row per entry; every value is an aggregate (or literal) and all share one scan.

    The single row is turned with ``unpivot``. Inlining an array of the aggregates reads shorter, but
    the optimizer takes very long over a filter on top of it.
    """
    fields = list(entries[0])
    row = df.agg(*[value.alias(f"v{i}_{name}") for i, e in enumerate(entries) for name, value in e.items()])
    facts = row.select(
        *[F.struct(*[F.col(f"v{i}_{name}").alias(name) for name in fields]).alias(f"v{i}") for i in range(len(entries))]
    )
    turned = facts.unpivot([], facts.columns, "place", "fact")
    return turned.select(*[F.col("fact")[name].alias(name) for name in fields])
