from pulsemart.functions.columns import (
    clip,
    days_between,
    day_literal,
    flag,
    instant_literal,
    is_not_in,
    money_avg,
    money_sum,
    percent_text,
    ratio_or_zero,
    sql_text,
    steps,
    tidy,
    tier_rank,
    title,
    to_day,
    to_instant,
    week_key,
    week_start,
    whole,
)

__all__ = [
    "clip",
    "days_between",
    "day_literal",
    "flag",
    "instant_literal",
    "is_not_in",
    "money_avg",
    "money_sum",
    "percent_text",
    "ratio_or_zero",
    "sql_text",
    "steps",
    "tidy",
    "tier_rank",
    "title",
    "to_day",
    "to_instant",
    "week_key",
    "week_start",
    "whole",
]
