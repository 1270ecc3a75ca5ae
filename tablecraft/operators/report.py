"""Counts and activity reports. Every grouped count is combined before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.constants import BUYING_EVENTS, CART, PURCHASE, VIEW
from tablecraft.functions import whole_percent
from tablecraft.sources.workspace import stage


def value_counts(df: DataFrame, column: str, *, keep_null: bool = True, name: str = "count") -> DataFrame:
    """``(column, count)``, most frequent first, ties in order of the value."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def top_values(df: DataFrame, column: str, limit: int, name: str = "count") -> DataFrame:
    """The most frequent values, nulls left out; planned as a top-k."""
    return value_counts(df, column, keep_null=False, name=name).limit(limit)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def visitors_by_day(
    df: DataFrame, time: str = "event_time", user: str = "user_id", *, approximate: bool = False
) -> DataFrame:
    """``(day, visitors)``: distinct users per day in order of the day.

    Spark first groups by (day, user), which spreads a busy day over all tasks, and then counts.
    The key is the date where the time is a timestamp; it becomes text after the aggregation.
    ``approximate`` counts with a sketch and needs no shuffle of users.
    """
    kind = df.schema[time].dataType
    key = F.substring(time, 1, 10) if isinstance(kind, T.StringType) else F.to_date(time)
    distinct = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    counted = df.groupBy(key.alias("day")).agg(distinct.alias("visitors"))
    return counted.withColumn("day", F.col("day").cast("string")).orderBy("day")


def column_counts(df: DataFrame, key: str) -> DataFrame:
    """Non-null count of every other column per ``key``; null keys are skipped."""
    others = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.count(c).alias(c) for c in others])


def user_counts(df: DataFrame, key: str = "brand", user: str = "user_id") -> DataFrame:
    """Events with a known user per ``key``, rarest first."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(user).alias("user_count"))
        .orderBy("user_count", key)
    )


def sums_by(df: DataFrame, key: str, measures: list[str], *, decimals: int | None = None) -> DataFrame:
    """Sum of each measure per ``key``.

    Sums of doubles depend on the order of rows. With ``decimals`` fractional measures are summed
    exactly, each value rounded to that many digits; whole numbers always are. A sum that overflows,
    or a value too large for 38 digits, gives null instead of an error.
    """
    def total(c: str):
        if decimals is None or not isinstance(df.schema[c].dataType, T.FractionalType):
            return F.try_sum(c).alias(c)
        value = F.col(c).try_cast(f"decimal(38,{decimals})")
        lost = F.bool_or(value.isNull() & F.col(c).isNotNull())
        return F.when(~F.coalesce(lost, F.lit(False)), F.try_sum(value).cast("double")).alias(c)

    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[total(c) for c in measures])


def mean_by(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(measure).alias(name))


def conversion_rates(df: DataFrame, event_type: str = "event_type") -> DataFrame:
    """One row with the counts of views, carts and purchases and the three rates in percent."""
    kind = F.col(event_type)
    counts = df.agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("carts"),
        F.count_if(kind == PURCHASE).alias("purchases"),
    )
    views, carts, purchases = F.col("views"), F.col("carts"), F.col("purchases")
    return counts.select(
        "*",
        whole_percent(purchases, views).alias("view_to_purchase_pct"),
        whole_percent(carts, views).alias("view_to_cart_pct"),
        whole_percent(purchases, carts).alias("cart_to_purchase_pct"),
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """``(column, count, share_pct)``; the total is a scalar subquery over the grouped counts, whose
    shuffle Spark reuses."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("share_pct", whole_percent(F.col("count"), total)).orderBy(F.desc("count"), column)


def events_of(df: DataFrame, users: DataFrame, user: str = "user_id") -> DataFrame:
    """All events of the given users; repeated users do not repeat events.

    A left semi-join: broadcast when Spark measures the user side as small, else a sort-merge join
    in which adaptive execution splits the partition of a user with very many events.
    """
    return df.join(users.select(user), user, "left_semi").select(*df.columns)


def buyers(df: DataFrame, user: str = "user_id", event_type: str = "event_type") -> DataFrame:
    """Distinct users with a cart or purchase event."""
    return df.where(F.col(event_type).isin(*BUYING_EVENTS)).select(user).distinct()


def activity_per_user(df: DataFrame, user: str = "user_id", event_type: str = "event_type") -> DataFrame:
    """Events per user, for users with a cart or purchase event. One scan and one shuffle: buying is
    a flag of the same grouped aggregate, so no join is needed."""
    return (
        df.where(F.col(user).isNotNull())
        .groupBy(user)
        .agg(
            F.count(event_type).alias("activity_count"),
            F.bool_or(F.col(event_type).isin(*BUYING_EVENTS)).alias("__buys"),
        )
        .where("__buys")
        .drop("__buys")
    )


def activity_per_session(
    df: DataFrame, session: str = "user_session", user: str = "user_id", event_type: str = "event_type"
) -> DataFrame:
    """Events per session, for sessions of users with a cart or purchase event.

    Events are counted per (user, session) first, with a flag for buying; only these counts meet the
    semi-join with the users whose flags say that they buy, which takes the weight off a user or
    session with very many events. Both sides of the join read the grouped table, which is written, so
    that the events are scanned once.
    """
    counted = df.groupBy(user, session).agg(
        F.count(event_type).alias("n"), F.bool_or(F.col(event_type).isin(*BUYING_EVENTS)).alias("buys")
    )
    counted = stage(counted, "session-counts")
    buying = counted.where("buys").select(F.col(user).alias("__buyer")).distinct()
    kept = counted.where(F.col(session).isNotNull()).join(buying, F.col(user) == F.col("__buyer"), "left_semi")
    return kept.groupBy(session).agg(F.sum("n").alias("activity_count"))
