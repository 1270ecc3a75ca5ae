"""Column expressions shared by the operators. All are built-ins, so they stay in generated code."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.constants import DEFAULT_STATUSES, EMPLOYMENT_YEARS


def is_missing(name: str, data_type: T.DataType, nan_is_missing: bool = False) -> Column:
    """True for null, and for NaN in floating columns when asked for."""
    column = F.col(f"`{name}`")
    if nan_is_missing and isinstance(data_type, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def default_label(status: str = "loan_status") -> Column:
    """1 for a defaulted loan, else 0; an unknown (null) status counts as 0."""
    return F.when(F.col(status).isin(*DEFAULT_STATUSES), 1).otherwise(0)


def employment_years(level: str = "emp_length") -> Column:
    """Employment text as a whole number 0..10; unknown and null texts count as 0."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in EMPLOYMENT_YEARS.items()))
    return F.coalesce(F.try_element_at(pairs, F.col(level)), F.lit(0))


def number_from_text(name: str, data_type: T.DataType | str = "float", strip_percent: bool = False) -> Column:
    """A text (or number) as ``data_type``; null where it cannot be read as one."""
    column = F.col(name)
    if strip_percent:
        column = F.rtrim(F.trim(column.cast("string")), F.lit("%"))
    return column.try_cast(data_type)


def day_text(name: str, data_type: T.DataType) -> Column:
    """The day part ``yyyy-MM-dd`` as text, from a timestamp or from a text that starts with it."""
    if isinstance(data_type, T.StringType):
        return F.substring(name, 1, 10)
    return F.date_format(name, "yyyy-MM-dd")


def event_day(name: str, data_type: T.DataType) -> Column:
    """The day as a date. A text that does not start with a date raises under ANSI rules."""
    if isinstance(data_type, T.StringType):
        return F.to_date(F.substring(name, 1, 10), "yyyy-MM-dd")
    return F.to_date(name)


def whole_percent(part: Column, whole: Column) -> Column:
    """``part`` as percent of ``whole``; null when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100
