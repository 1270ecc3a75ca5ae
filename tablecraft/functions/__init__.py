"""Column expressions."""

from tablecraft.functions.columns import (
    day_text,
    default_label,
    employment_years,
    event_day,
    is_missing,
    number_from_text,
    whole_percent,
)

__all__ = [
    "day_text", "default_label", "employment_years", "event_day", "is_missing",
    "number_from_text", "whole_percent",
]
