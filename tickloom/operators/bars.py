"""Price bars and their windows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.money import num, open_volume_ratio
from tickloom.operators.filters import is_active

_UNITS = {"m": "minutes", "min": "minutes", "s": "seconds"}
_NAMED = {"day": "day", "1d": "day", "d": "day", "daily": "day", "week": "week", "1w": "week", "w": "week", "month": "month", "quarter": "quarter", "year": "year", "1h": "60m"}


def period(value: str) -> str:
    """A period's own name; ValueError for anything that is none."""
    key = value.strip().lower()
    if key in _NAMED:
        return _NAMED[key]
    found = re.fullmatch(r"(\d+)(m|min|d|s)", key)
    if not found:
        raise ValueError(f"{value!r} is no period")
    number, unit = int(found[1]), found[2][0]
    most = {"m": 1440, "d": 365, "s": 60}[unit]
    if not 1 <= number <= most:
        raise ValueError(f"{value!r} is no period")
    return "day" if (number, unit) == (1, "d") else f"{number}{unit}"


def bucket(time: Column, of: str, by: list[str]) -> Column:
    """The start of the period that a time lies in; n-day periods count an instrument's own trading days."""
    name = period(of)
    if name in ("day", "week", "month", "quarter", "year"):
        return F.date_trunc(name, time)
    found = re.fullmatch(r"(\d+)([mds])", name)
    number, unit = int(found[1]), found[2]
    if unit == "d":
        group = F.floor((F.dense_rank().over(Window.partitionBy(*by).orderBy(F.to_date(time))) - 1) / number)
        return group
    return F.window(time, f"{number} {_UNITS[unit]}")["start"]


def ohlcv(ticks: DataFrame, of: str, by: list[str], time: str, price: str, tie: str, volume: str | None = None) -> DataFrame:
    """Bars of ticks: one partial aggregation and one shuffle on (key, bucket)."""
    order = F.struct(time, tie)
    size = num(volume) if volume else F.lit(1.0)
    start = bucket(F.col(time), of, by)
    rows = ticks.withColumn("bucket_", start)
    out = rows.groupBy(*by, "bucket_").agg(
        F.min(time).alias("first_time"),
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(size).alias("volume"),
        F.sum(num(price) * size).alias("amount"),
        F.count("*").alias("n_ticks"),
    )
    return out.withColumnRenamed("bucket_", "bar_start")


def ohlcv_of_periods(ticks: DataFrame, periods: list[str], by: list[str], time: str, price: str, tie: str, volume: str | None = None) -> DataFrame:
    """Bars of several periods from one scan and one shuffle, as grouping sets over the period starts.

    Open and close are the first and last by time.  Periods of n days count an
    instrument's own days and are not among these.
    """
    names = [period(p) for p in periods]
    if any(re.fullmatch(r"\d+d", n) for n in names):
        raise ValueError("periods of several days aren't grouped with others")
    order, size = F.struct(time, tie), num(volume) if volume else F.lit(1.0)
    starts = [f"start_{i}_" for i in range(len(names))]
    rows = ticks.withColumns({c: bucket(F.col(time), n, by) for c, n in zip(starts, names, strict=True)})
    sets = [[*(F.col(b) for b in by), F.col(c)] for c in starts]
    out = rows.groupingSets(sets, *by, *starts).agg(
        F.grouping_id(*by, *starts).alias("set_"),
        F.min(time).alias("first_time"),
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(size).alias("volume"),
        F.sum(num(price) * size).alias("amount"),
        F.count("*").alias("n_ticks"),
    )
    # a set's number has a bit for each start it leaves out
    number = {c: (1 << len(starts)) - 1 - (1 << (len(starts) - 1 - i)) for i, c in enumerate(starts)}
    named = F.coalesce(*(F.when(F.col("set_") == number[c], n) for c, n in zip(starts, names, strict=True)))
    start = F.coalesce(*(F.when(F.col("set_") == number[c], F.col(c)) for c in starts))
    return out.select(*by, named.alias("period"), start.alias("bar_start"), "first_time", "open", "high", "low", "close", "volume", "amount", "n_ticks")


def tail(df: DataFrame, n: int, by: list[str], order: str) -> DataFrame:
    """The last n rows of each key."""
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))).where(F.col("r_") <= n).drop("r_")


def last_active(df: DataFrame, n: int, by: list[str], date: str, before: str | None = None, volumes: tuple[str, ...] = ("volume",)) -> DataFrame:
    """The last n dates with trades before a date."""
    df = df.where(is_active(*volumes))
    return tail(df.where(F.col(date) < before) if before else df, n, by, date)


def with_open_ratio(df: DataFrame, by: list[str], date: str, open_lots: str, volume: str, days: int = 5) -> DataFrame:
    """Opening volume against the mean minute of the bars before."""
    frame = Window.partitionBy(*by).orderBy(date).rowsBetween(-days, -1)
    return df.withColumn("open_volume_ratio", open_volume_ratio(F.col(open_lots), F.sum(volume).over(frame), F.count(volume).over(frame), days))


def previous_close(df: DataFrame, by: list[str], date: str, close: str) -> DataFrame:
    return df.withColumn("pre_close", F.lag(close).over(Window.partitionBy(*by).orderBy(date)))


def intraday_against_previous(points: DataFrame, by: list[str], date: str, minute: str, volume: str) -> DataFrame:
    """Running volume of the day, and the same minute's of the day before."""
    running = F.sum(volume).over(Window.partitionBy(*by, date).orderBy(minute).rowsBetween(Window.unboundedPreceding, 0))
    rows = points.withColumn("cumulative_volume", running)
    before = F.lag("cumulative_volume").over(Window.partitionBy(*by, minute).orderBy(date))
    return rows.withColumn("previous_cumulative_volume", before).withColumn("cumulative_change", F.col("cumulative_volume") - F.col("previous_cumulative_volume"))


def realised_volatility(df: DataFrame, by: list[str], time: str, close: str) -> DataFrame:
    """Sum of squared log returns and its root; fewer than two positive closes give no row."""
    rows = df.where(num(close) > 0).withColumn("r_", F.log(num(close)) - F.log(F.lag(num(close)).over(Window.partitionBy(*by).orderBy(time))))
    out = rows.groupBy(*by).agg(F.sum(F.col("r_") * F.col("r_")).alias("realized_variance"), F.count("*").alias("n_closes")).where("n_closes >= 2")
    return out.withColumn("realized_volatility", F.sqrt("realized_variance"))


def streaks(df: DataFrame, by: list[str], date: str, flag: Column) -> DataFrame:
    """Adds how many rows in a row, up to each, have had the flag."""
    order = Window.partitionBy(*by).orderBy(date)
    rows = df.withColumns({"flag_": flag.cast("int")}).withColumn("island_", F.sum(1 - F.col("flag_")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.sum("flag_").over(Window.partitionBy(*by, "island_").orderBy(date).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("streak", run).drop("flag_", "island_")
