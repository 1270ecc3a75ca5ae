"""Null counts, sparse columns, and fills. Every profile is one aggregate over one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.functions import is_missing
from tablecraft.operators.turn import rows_per_entry


def _counted(df: DataFrame, nan_is_missing: bool) -> DataFrame:
    """``(column, null_count, row_count)``, one aggregate over one scan."""
    return rows_per_entry(
        df,
        [
            {
                "column": F.lit(f.name),
                "null_count": F.count_if(is_missing(f.name, f.dataType, nan_is_missing)),
                "row_count": F.count(F.lit(1)),
            }
            for f in df.schema.fields
        ],
    )


def null_counts(df: DataFrame, *, sparse: bool = False, nan_is_missing: bool = False) -> DataFrame:
    """``(column, null_count)``; with ``sparse`` the columns without a null are left out."""
    counts = _counted(df, nan_is_missing).drop("row_count")
    return counts.where("null_count > 0") if sparse else counts


def sparse_columns(df: DataFrame, fraction: float = 0.5) -> DataFrame:
    """``(column, null_count, row_count)`` of the columns with more than ``fraction`` nulls."""
    return _counted(df, False).where(F.col("null_count") > F.col("row_count") * F.lit(float(fraction)))


def drop_sparse(df: DataFrame, fraction: float = 0.5) -> DataFrame:
    """Drop the sparse columns. The names (at most one per column of ``df``) are fetched first."""
    return df.drop(*[row["column"] for row in sparse_columns(df, fraction).collect()])


def null_mask(df: DataFrame, key: str) -> DataFrame:
    """``key`` and, per other column, whether it is null."""
    return df.select(key, *[F.col(f"`{c}`").isNull().alias(c) for c in df.columns if c != key])


def fill_zero_when(df: DataFrame, columns: list[str], status: str, statuses: list[str]) -> DataFrame:
    """Null becomes 0 in ``columns`` where ``status`` is one of ``statuses``."""
    applies = F.col(status).isin(*statuses)
    return df.withColumns(
        {c: F.when(F.col(c).isNull() & applies, F.lit(0)).otherwise(F.col(c)) for c in columns}
    )


def mean_impute(df: DataFrame, column: str, *, truncate: bool = True) -> DataFrame:
    """Null becomes the mean of ``column``, cut to a whole number by default.

    The mean is a scalar subquery: one value, no join. A column of only nulls stays as it is.
    """
    mean = df.agg(F.avg(column).alias("mean"))
    if truncate:
        mean = mean.select(F.col("mean").cast("bigint").alias("mean"))
    kind = df.schema[column].dataType
    return df.withColumn(column, F.coalesce(F.col(column), mean.scalar().cast(kind)))


def drop_any_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=columns)


def fill_zero(df: DataFrame) -> DataFrame:
    """Null becomes 0 in numeric columns and the text "0" in string columns; NaN counts as null."""
    fills = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit("0"))
        elif isinstance(f.dataType, T.NumericType):
            zero = F.lit(0).cast(f.dataType)
            known = F.coalesce(F.col(f.name), zero)
            fills[f.name] = F.nanvl(known, zero) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else known
    return df.withColumns(fills)
