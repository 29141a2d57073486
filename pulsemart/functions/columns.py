"""Column expressions shared by the operators; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tidy(c: str) -> Column:
    """Lower-case, then strip surrounding blanks."""
    return F.trim(F.lower(F.col(c)))


def to_day(c: str) -> Column:
    """Date, or NULL when the text is not one (plain casts throw under ANSI)."""
    return F.col(c).try_cast("date")


def to_instant(c: str) -> Column:
    return F.col(c).try_cast("timestamp_ntz")


def flag(c: str) -> Column:
    """Boolean from 0/1 or true/false in any type; NULL and anything else is false."""
    text = F.lower(F.trim(F.col(c).cast("string")))
    return F.coalesce(text.isin("1", "1.0", "true"), F.lit(False))


def is_not_in(c: Column, values: Iterable) -> Column:
    """NULL counts as outside the set, unlike SQL's three-valued NOT IN."""
    return ~F.coalesce(c.isin(*values), F.lit(False))


def day_literal(d: date) -> Column:
    return F.lit(d)


def instant_literal(d: date) -> Column:
    """Midnight of ``d`` without a time zone."""
    return F.lit(d).cast("timestamp_ntz")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def week_start(day: Column) -> Column:
    """Monday of the week; plain date arithmetic, so no session time zone is involved."""
    return F.date_sub(day, F.weekday(day))


def week_key(day: Column) -> Column:
    """``%Y-%W``: Monday-first week of the year 00-53, days before the first Monday in 00."""
    week = F.floor((F.dayofyear(day) + F.lit(6) - F.weekday(day)) / F.lit(7)).cast("int")
    return F.concat_ws("-", F.year(day).cast("string"), F.lpad(week.cast("string"), 2, "0"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """0 where the denominator is 0 or either side is NULL."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def steps(choices: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """First matching condition wins."""
    out = None
    for condition, value in choices:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def tier_rank(c: Column, tiers: Sequence[str]) -> Column:
    """Position on the tier axis; NULL for anything not on it."""
    out = F.when(c == tiers[0], 1)
    for position, tier in enumerate(tiers[1:], start=2):
        out = out.when(c == tier, position)
    return out


def money_sum(c: Column) -> Column:
    """Exact whatever the order of the rows: added up as decimals, to the sixth place. 0 for no rows."""
    return F.coalesce(F.sum(c.cast("decimal(28,6)")).cast("double"), F.lit(0.0))


def money_avg(c: Column) -> Column:
    """NULL for no values."""
    return F.try_divide(F.sum(c.cast("decimal(28,6)")).cast("double"), F.count(c))


def title(c: Column) -> Column:
    """Every run of letters starts with a capital and goes on in lower case: self-serve -> Self-Serve."""
    starts = F.regexp_replace(F.lower(c), r"(\p{L}+)", "\x00$1")
    parts = F.split(starts, "\x00")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def percent_text(c: Column) -> Column:
    """0.1234 -> '12.3%'."""
    return F.concat(F.bround(c * F.lit(100.0), 1).cast("string"), F.lit("%"))


def whole(c: Column) -> Column:
    """Half-even to a whole number, as shown in money columns."""
    return F.bround(c, 0).cast("bigint")
