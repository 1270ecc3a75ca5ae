"""The shop study: raw events -> cleaned events -> reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablecraft.constants import PURCHASE, TOP_BRANDS, TOP_PURCHASE_BRANDS
from tablecraft.operators import clean, dedup, nulls, report


def clean_events(raw: DataFrame) -> DataFrame:
    """Drop the category text and fill nulls, so that a missing brand is counted as brand "0"."""
    return nulls.fill_zero(clean.drop_columns(raw, ["category_code"]))


def purchases(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Distinct purchase events; the technical key does not make two equal events different."""
    return dedup.drop_duplicates(clean.member_of(events.drop(key), "event_type", [PURCHASE]))


def cart_purchase_users(events: DataFrame, key: str = "event_id") -> DataFrame:
    """The first cart or purchase event of each user."""
    return dedup.keep_first(clean.member_of(events, "event_type", report.BUYING_EVENTS), ["user_id"], [key])


def shop_reports(raw: DataFrame) -> dict[str, DataFrame]:
    """Report name -> lazy result; nothing runs until one is used."""
    events = clean_events(raw)
    return {
        "event_types": report.value_counts(events, "event_type", keep_null=False),
        "event_type_shares": report.shares(events, "event_type"),
        "brands": report.value_counts(events, "brand", keep_null=False),
        "brand_shares": report.shares(events, "brand"),
        "brand_users": report.user_counts(events),
        "top_brands": report.top_values(events, "brand", TOP_BRANDS),
        "top_purchase_brands": report.top_values(purchases(events), "brand", TOP_PURCHASE_BRANDS),
        "visitors": report.visitors_by_day(events),
        "conversion": report.conversion_rates(events),
        "user_sums": report.sums_by(events, "user_id", ["product_id", "category_id", "price"], decimals=6),
        "product_prices": report.mean_by(events, "product_id", "price", "mean_price"),
        "activity_per_user": report.activity_per_user(events),
        "activity_per_session": report.activity_per_session(events),
    }
