"""Money and ratio arithmetic.  Null in, null out; a zero divisor gives null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(value) -> Column:
    """A column as a double; numbers and column names are accepted."""
    column = value if isinstance(value, Column) else F.lit(value) if isinstance(value, (int, float)) else F.col(value)
    return column.cast("double")


def round6(value) -> Column:
    """Rounded half up on the decimal text to six places."""
    return F.round(num(value), 6)


def float_divide(top, bottom) -> Column:
    """Division of floating point: by zero it gives an infinity, or NaN for zero by zero."""
    t, b = num(top), num(bottom)
    endless = F.when(F.isnan(t) | (t == 0), float("nan")).when(t > 0, float("inf")).when(t < 0, float("-inf"))
    return F.when(b == 0, endless).otherwise(F.try_divide(t, b))


def percent_change(value, base, divide: Callable[[Column, Column], Column] = F.try_divide) -> Column:
    """A base of zero gives null, or what ``divide`` makes of it."""
    return F.round(divide(num(value) - num(base), num(base)) * 100, 6)


def safe_ratio(top, bottom) -> Column:
    return F.round(F.try_divide(num(top), num(bottom)), 6)


def safe_ratio_pct(top, bottom) -> Column:
    return F.round(F.try_divide(num(top), num(bottom)) * 100, 6)


def drawdown_pct(high, last, pre_close) -> Column:
    return safe_ratio_pct(num(high) - num(last), pre_close)


def attack_pct(last, low, pre_close) -> Column:
    return safe_ratio_pct(num(last) - num(low), pre_close)


def average_price(amount, lots) -> Column:
    return F.round(F.try_divide(num(amount), num(lots) * 100), 6)


def locked_amount(price, lots) -> Column:
    return F.round(num(price) * num(lots) * 100, 6)


def as_int(value) -> Column:
    """A whole number; text that isn't one is null."""
    return F.col(value).try_cast("long") if isinstance(value, str) else value.try_cast("long")


def int_diff(left, right) -> Column:
    return as_int(left) - as_int(right)


def balance_pct(left, right) -> Column:
    a, b = as_int(left), as_int(right)
    return F.round(F.try_divide((a - b).cast("double"), (a + b).cast("double")) * 100, 6)


def ten_thousand(value) -> Column:
    """Units from tens of thousands."""
    return F.round(num(value) * 10_000, 6)


def ten_thousand_shares_to_lots(value) -> Column:
    return F.round(num(value) * 10_000 / 100, 6)


def market_value(shares, price) -> Column:
    return F.round(num(shares) * num(price), 6)


def volume_change(current, previous) -> Column:
    return F.round(num(current) - num(previous), 6)


volume_change_pct = percent_change
volume_ratio = safe_ratio


def auction_open_lots(open_amount, open_price) -> Column:
    return F.round(F.try_divide(num(open_amount), num(open_price)) / 100, 6)


def open_volume_ratio(open_lots, volume_sum, volume_count, days: int = 5, minutes: int = 240) -> Column:
    """Opening lots against the mean minute of the last ``days`` days; null with fewer days."""
    return F.when(num(volume_count) >= days, F.round(F.try_divide(num(open_lots), num(volume_sum) / (minutes * days)), 6))


def price_from_raw(raw, decimals, decoded=None) -> Column:
    """An integer price with a number of decimals; a decoded price stands in for a missing one."""
    value = num(raw) / F.pow(F.lit(10.0), num(decimals))
    return F.coalesce(value, num(decoded)) if decoded is not None else value


def average_from_raw(raw, decimals) -> Column:
    return num(raw) / F.pow(F.lit(10.0), num(decimals) + 2)


def rescaled(price, decimals) -> Column:
    """A price that was decoded with two decimals, in its own decimals."""
    return num(price) * F.pow(F.lit(10.0), 2 - num(decimals))


def hundredth(value) -> Column:
    return F.round(num(value) / 100, 6)


def share_to_100m(value, large: float = 10_000) -> Column:
    """Shares in units of 1e8: numbers above ``large`` are counts, others are in that unit already."""
    number = num(value)
    return F.when(number > large, number / 1e8).otherwise(number)


def count_to_100m(value) -> Column:
    return num(value) / 1e8


def on_tick(price, tick, is_fx=None) -> Column:
    """A price moved to a multiple of its tick; currencies keep six decimals."""
    moved = F.when(num(tick) > 0, F.round(F.bround(num(price) / num(tick), 0) * num(tick), 6)).otherwise(F.round(num(price), 6))
    return moved if is_fx is None else F.when(is_fx, F.round(num(price), 6)).otherwise(moved)


def trade_price_scale(asset_type: Column) -> Column:
    return F.when(asset_type == "fx", 10_000).otherwise(1000)


def tick_decimals(tick) -> Column:
    """The number of decimals of a tick, up to eight."""
    text = F.regexp_replace(F.format_string("%.8f", num(tick)), "0+$", "")
    return F.length(F.regexp_extract(text, r"\.(\d*)$", 1))


def open_close_type(volume, change, marker) -> Column:
    """What a futures trade did to positions, by its volume, position change and direction."""
    v, c, m = num(volume), num(change), num(marker)

    def side(open_, swap, even, close, limit) -> Column:
        return F.when(c > 0, F.when(v > c, open_).otherwise("双开")).when(c == 0, swap).otherwise(F.when(limit, even).otherwise(close))

    long_side = side("多开", "多换", "双平", "空平", v == -c)
    short_side = side("空开", "空换", "双平", "多平", v == -c)
    other = side("开仓", "换手", "平仓", "双平", v > -c)
    return F.when(v <= 0, F.lit(None).cast("string")).when(m == 0, long_side).when(m == 1, short_side).otherwise(other)
