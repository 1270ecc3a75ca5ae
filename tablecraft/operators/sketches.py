"""Stored, mergeable summaries: quantiles, distinct counts and frequent values from one scan.

A state is a row per group (a day, a month, a load) that holds a sketch in a binary column. States are
ordinary tables: they are written once, new ones are appended, and any selection of them merges into
the summary of all their rows without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.operators.profile import numeric_columns
from tablecraft.operators.report import value_counts

QUANTILE_K = 1024
VISITOR_LG_K = 14
TRACKED = 1 << 16
MOST_TRACKED = 1_000_000  # the largest sketch that Spark builds
_QUARTILES = [0.25, 0.5, 0.75]


# --- quantiles -----------------------------------------------------------------------------------

def rank_error(k: int = QUANTILE_K) -> float:
    """How far, as a share of all values, the rank of a sketched quantile may be from the wanted one; an
    estimate exceeds it with a probability of one in a hundred, and twice it practically never."""
    return 2.296 / k**0.9723


def quantile_states(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None, *, k: int = QUANTILE_K) -> DataFrame:
    """One row per group of ``by`` and numeric column: ``column``, ``n``, ``mean``, ``m2`` (sum of squared
    distances from the mean), ``low``, ``high`` and the quantile ``sketch``. Nulls and NaN are left out. All
    columns share one scan; a task sends a few kilobytes per group and column."""
    names, keys = columns or numeric_columns(df), by or []
    facts = []
    for i, c in enumerate(names):
        value = F.col(f"`{c}`").cast("double")
        value = F.when(~F.isnan(value), value)
        n = F.count(value)
        facts.append(
            F.struct(
                F.lit(c).alias("column"),
                n.alias("n"),
                F.avg(value).alias("mean"),
                (F.var_pop(value) * n).alias("m2"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"),
            ).alias(f"__v{i}")
        )
    grouped = df.groupBy(*keys).agg(*facts)
    turned = grouped.unpivot(keys, [f"__v{i}" for i in range(len(names))], "__place", "__fact")
    return turned.select(*keys, "__fact.*")


def merge_quantiles(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """States of larger groups from states of smaller ones, in the same form."""
    keys = [*(by or []), "column"]
    means = states.groupBy(*keys).agg(F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("__mean"))
    met = states.join(means.select(*[F.col(c).alias(f"__{c}") for c in keys], "__mean"), _same(keys))
    apart = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("__mean"), F.lit(2.0))
    return met.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.first("__mean").alias("mean"),
        F.sum(apart).alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def _same(keys: list[str]) -> Column:
    condition = F.lit(True)
    for c in keys:
        condition &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return condition


def described(states: DataFrame, probabilities: list[float] | None = None, by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, sketched quantiles and maximum per state. The quantile of a
    state without values is null."""
    asked = probabilities or _QUARTILES
    quantiles = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in asked])))
    return states.select(
        *(by or []),
        "column",
        F.col("n").alias("count"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"),
        F.col("low").alias("min"),
        *[quantiles[i].alias(f"q{round(p * 100)}") for i, p in enumerate(asked)],
        F.col("high").alias("max"),
    )


def describe_sketch(df: DataFrame, columns: list[str] | None = None, *, k: int = QUANTILE_K) -> DataFrame:
    """:func:`profile.describe` with sketched quartiles: one scan and one row a task, at any size."""
    return described(quantile_states(df, columns, k=k))


def rank_spans(df: DataFrame, values: dict[str, list[float]]) -> DataFrame:
    """``(column, place, value, n, below, upto)``: how many values are below and at most each given one,
    exactly, from one scan. It proves or refutes what a sketch says."""
    entries = []
    for c, asked in values.items():
        v = F.col(f"`{c}`").cast("double")
        known = v.isNotNull() & ~F.isnan(v)
        for i, x in enumerate(asked):
            entries.append((c, i, x, F.count_if(known), F.count_if(known & (v < F.lit(x))), F.count_if(known & (v <= F.lit(x)))))
    row = df.agg(*[F.struct(n.alias("n"), b.alias("below"), u.alias("upto")).alias(f"f{i}") for i, (*_, n, b, u) in enumerate(entries)])
    facts = [
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("place"), F.lit(x).alias("value"), f"f{j}.n", f"f{j}.below", f"f{j}.upto")
        for j, (c, i, x, *_) in enumerate(entries)
    ]
    return row.select(F.explode(F.array(*facts)).alias("fact")).select("fact.*")


# --- distinct counts -----------------------------------------------------------------------------

def visitor_error(lg_k: int = VISITOR_LG_K) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def visitor_states(df: DataFrame, time: str = "event_time", user: str = "user_id", *, lg_k: int = VISITOR_LG_K) -> DataFrame:
    """``(day, sketch)``: a sketch of the known users of each day. No user is shuffled."""
    day = F.to_date(F.substring(time, 1, 10)) if isinstance(df.schema[time].dataType, T.StringType) else F.to_date(time)
    return df.where(F.col(user).isNotNull()).groupBy(day.alias("day")).agg(F.hll_sketch_agg(user, lg_k).alias("sketch"))


def visitors_by_range(states: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(first_day, last_day, visitors)``: about how many distinct users each range of days has. ``ranges``
    holds distinct ``(first_day, last_day)``, both inside; only states are read, as often as ranges ask
    for their day. A range without visitors has 0. States of one day, as loads leave them, may be several."""
    asked = ranges.select("first_day", "last_day", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    merged = asked.join(states, "day", "left").groupBy("first_day", "last_day").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("first_day", "last_day", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("long")).alias("visitors"))


# --- frequent values -----------------------------------------------------------------------------

def heavy_hitters(df: DataFrame, column: str, limit: int, *, name: str = "count", tracked: int = TRACKED) -> DataFrame:
    """The ``limit`` most frequent values with exact counts, nulls left out, ties in order of the value,
    as :func:`report.top_values` gives them, without shuffling every value.

    A sketch of ``tracked`` values a task names candidates, and a second scan counts these exactly. With N
    rows, a value that the sketch does not name comes at most ``7 N / (tracked / 0.75)`` times, and a named one
    at most as often as the sketch says. When the last exact count of the list is above both, no
    value is missing. Otherwise a larger sketch is tried, and beyond ``MOST_TRACKED`` all values are counted.
    """
    rows = df.select(column).where(F.col(column).isNotNull())
    schema = T.StructType([T.StructField(column, df.schema[column].dataType)])
    while tracked <= MOST_TRACKED:
        asked = min(4 * limit, tracked)
        named = rows.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{column}`, {asked}, {tracked})").alias("found")).first()
        candidates = df.sparkSession.createDataFrame([(x["item"],) for x in named.found or []], schema)
        counted = value_counts(rows.join(F.broadcast(candidates), column, "left_semi"), column, name=name).limit(limit)
        exact = [r[name] for r in counted.collect()]
        unnamed = 7 * named.n * 0.75 / tracked
        cut_off = named.found[-1]["count"] if len(named.found or []) == asked else 0
        least = exact[-1] if len(exact) == limit else 1
        if least > max(unnamed, cut_off):
            return counted
        tracked = min(4 * tracked, MOST_TRACKED) if tracked < MOST_TRACKED else MOST_TRACKED + 1
    return value_counts(rows, column, name=name).limit(limit)
