"""Projections, casts and filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.functions import day_text, default_label, employment_years, event_day, number_from_text
from tablecraft.operators.turn import rows_per_entry


def drop_columns(df: DataFrame, names: list[str], *, strict: bool = False) -> DataFrame:
    """Drop named columns. Unknown names are ignored, or refused with ``strict``."""
    missing = [n for n in names if n not in df.columns]
    if strict and missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)


def cast_numbers(
    df: DataFrame, columns: list[str], data_type: T.DataType | str = "float", *, strip_percent: bool = False
) -> DataFrame:
    """Cast the named columns that ``df`` has, in one projection; unreadable values become null."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(
        {
            c: number_from_text(c, data_type, strip_percent and c in texts)
            for c in columns
            if c in df.columns
        }
    )


def add_default_label(df: DataFrame, status: str = "loan_status", name: str = "isDefault") -> DataFrame:
    return df.withColumn(name, default_label(status))


def rename_to_end(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column; it becomes the last one."""
    return df.select(*[c for c in df.columns if c != old], F.col(old).alias(new))


def add_employment_years(df: DataFrame, level: str = "emp_length") -> DataFrame:
    return df.withColumn(f"{level}Index", employment_years(level))


def add_day_text(df: DataFrame, time: str = "event_time", name: str = "event_day") -> DataFrame:
    return df.withColumn(name, day_text(time, df.schema[time].dataType))


def add_event_date(df: DataFrame, time: str = "event_time", name: str = "event_date") -> DataFrame:
    return df.withColumn(name, event_day(time, df.schema[time].dataType))


def any_equal(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows where ``column`` equals one of a few literals, as a disjunction of equalities."""
    return df.where(reduce(lambda a, b: a | b, [F.col(column) == v for v in values]))


def not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column`` differs from ``value``; null never differs."""
    return df.where(F.col(column) != F.lit(value))


def above(df: DataFrame, column: str, bound) -> DataFrame:
    """Rows above a bound: an audit that should come back empty."""
    return df.where(F.col(column) > F.lit(bound))


def member_of(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(*values))


# Open intervals that each narrower type must contain, narrowest first.
_WHOLE = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]
_FLOAT_LIMIT = 3.4028234663852886e38
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _narrowest(field: T.StructField, low: Column, high: Column) -> Column:
    current = field.dataType.simpleString()
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when((low > -_FLOAT_LIMIT) & (high < _FLOAT_LIMIT), "float").otherwise("double")
    choice = F.lit(current)
    for name, bottom, top in reversed(_WHOLE):
        choice = F.when((low > bottom) & (high < top), name).otherwise(choice)
    return choice


def narrow_plan(df: DataFrame) -> DataFrame:
    """``(column, from_type, to_type)`` per numeric column: the smallest type that strictly holds
    its minimum and maximum. A column without values keeps its type."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, _NUMBERS)]
    entries = []
    for f in fields:
        low, high = F.min(f.name), F.max(f.name)
        current = f.dataType.simpleString()
        to_type = F.when(low.isNull(), current).otherwise(_narrowest(f, low, high))
        entries.append({"column": F.lit(f.name), "from_type": F.lit(current), "to_type": to_type})
    return rows_per_entry(df, entries)


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the type chosen by :func:`narrow_plan` (one row per column is
    fetched). Doubles may lose digits when they become floats; values never leave the range."""
    chosen = {r["column"]: r["to_type"] for r in narrow_plan(df).collect() if r["from_type"] != r["to_type"]}
    return df.withColumns({c: F.col(c).cast(t) for c, t in chosen.items()}) if chosen else df
