"""Daily price limits and limit-up status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.codes import name_flag
from tickloom.functions.money import num
from tickloom.functions.text import text

TOLERANCE = 0.0051


def limit_ratio(code, name) -> Column:
    """The daily limit in percent; null for a stock's first days."""
    c, flag = F.lower(text(code)), F.coalesce(name_flag(name), F.lit(""))
    return (
        F.when(flag.isin("N", "C"), F.lit(None).cast("double"))
        .when(flag.isin("ST", "*ST"), 5.0)
        .when(c.startswith("bj"), 30.0)
        .when(c.rlike("^(sh688|sz300|sz301)"), 20.0)
        .otherwise(10.0)
    )


def limit_rule(code, name) -> Column:
    c, flag = F.lower(text(code)), F.coalesce(name_flag(name), F.lit(""))
    return (
        F.when(flag == "N", "ipo_first_day")
        .when(flag == "C", "ipo_first_5_days")
        .when(flag.isin("ST", "*ST"), "st_5pct")
        .when(c.startswith("bj"), "bse_30pct")
        .when(c.startswith("sh688"), "star_20pct")
        .when(c.rlike("^sz30[01]"), "chinext_20pct")
        .otherwise("main_10pct")
    )


def round_price(value) -> Column:
    return F.round(num(value) + 1e-9, 2)


def limit_up(pre_close, ratio) -> Column:
    return round_price(num(pre_close) * (1 + num(ratio) / 100))


def limit_down(pre_close, ratio) -> Column:
    return round_price(num(pre_close) * (1 - num(ratio) / 100))


def limit_status_of_day(pre_close, ratio) -> Column:
    return F.when(num(ratio).isNull(), "no_price_limit").when(num(pre_close).isNull(), "missing_pre_close").otherwise("normal")


def special_ratio(pre_close, up) -> Column:
    """The limit in percent that a published limit price means."""
    return F.round((F.try_divide(num(up), num(pre_close)) - 1) * 100, 6)


def price_close(left, right, tolerance: float = TOLERANCE) -> Column:
    return F.coalesce(F.abs(num(left) - num(right)) <= tolerance, F.lit(False))


def price_at_or_above(left, right, tolerance: float = TOLERANCE) -> Column:
    return F.coalesce(num(left) + tolerance >= num(right), F.lit(False))


def positive(value) -> Column:
    return F.coalesce(num(value) > 0, F.lit(False))


def limit_up_status(last, high, bid1, locked, up) -> Column:
    """sealed, touched or none."""
    queued = price_close(bid1, up) | positive(locked)
    return F.when(price_close(last, up) & queued, "sealed").when(price_at_or_above(high, up) | price_at_or_above(last, up), "touched").otherwise("none")


def ladder_level(streak, stats_are_todays: Column) -> Column:
    """Consecutive limit-up days, this one included."""
    prior = F.coalesce(num(streak).cast("int"), F.lit(0))
    return F.greatest(F.lit(1), prior + F.when(stats_are_todays, 0).otherwise(1))


def rolled_forward(value, sealed: Column, stats_are_todays: Column) -> Column:
    """A counter of days that today's seal raises, unless today is in it."""
    count = num(value).cast("int")
    return F.when(sealed & ~stats_are_todays, F.coalesce(count, F.lit(0)) + 1).otherwise(count)
