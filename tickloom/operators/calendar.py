"""Trading calendars: neighbours, coverage, missing ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.dates import is_true, of_date, real_date


def spine(spark: SparkSession, start: str, end: str, name: str = "cal_date") -> DataFrame:
    """Every natural day of a range, as compact text."""
    days = F.sequence(F.to_date(F.lit(start.replace("-", "")), "yyyyMMdd"), F.to_date(F.lit(end.replace("-", "")), "yyyyMMdd"))
    return spark.range(1).select(F.explode(days).alias("d")).select(of_date(F.col("d")).alias(name))


def neighbours(calendar: DataFrame, date: str = "cal_date", flag: str = "is_open", by: str = "exchange") -> DataFrame:
    """Adds the open days strictly before and after each day."""
    opened = F.when(is_true(flag), F.col(date))
    order = Window.partitionBy(by).orderBy(date)
    before = F.last(opened, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(opened, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    return calendar.withColumns({"pretrade_date": before, "next_trade_date": after})


def padded(start: str, end: str, months: int = 1) -> tuple[str, str]:
    """A range made wider, so that its edges have neighbours."""
    from datetime import date, timedelta

    def shifted(day: date, by: int) -> date:
        month = day.year * 12 + day.month - 1 + by
        first = date(month // 12, month % 12 + 1, 1)
        last = (date((month + 1) // 12, (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
        return first.replace(day=min(day.day, last))

    parse = lambda t: date(int(t[:4]), int(t[4:6]), int(t[6:8]))
    low, high = parse(start.replace("-", "")), parse(end.replace("-", ""))
    return shifted(low, -months).strftime("%Y%m%d"), shifted(high, months).strftime("%Y%m%d")


def open_dates(calendar: DataFrame, date: str = "cal_date", flag: str = "is_open", by: str = "exchange") -> DataFrame:
    """(exchange, date) of all open days, once each."""
    return calendar.where(is_true(flag)).select(by, date).distinct()


def coverage(calendar: DataFrame, date: str = "cal_date", flag: str = "is_open") -> DataFrame:
    return calendar.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count("*").alias("n_days"), F.count_if(is_true(flag)).alias("n_open"))


def missing_days(calendar: DataFrame, start: str, end: str, date: str = "cal_date") -> DataFrame:
    """Natural days of the range that the calendar lacks."""
    return spine(calendar.sparkSession, start, end, date).join(calendar.select(date).distinct(), date, "left_anti")


def ranges(days: DataFrame, date: str, by: list[str] | None = None) -> DataFrame:
    """Days next to each other as ranges: start, end, n_days.

    Days are taken once, so a key's are as many as its calendar has; without ``by``
    all are one calendar's, and one task's.
    """
    by = by or []
    once = days.select(*by, real_date(date).alias("d")).distinct()
    island = F.date_sub("d", F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("d")))
    out = once.withColumn("island_", island).groupBy(*by, "island_").agg(of_date(F.min("d")).alias("start_date"), of_date(F.max("d")).alias("end_date"), F.count("*").alias("n_days"))
    return out.drop("island_")


def merged_ranges(df: DataFrame, start: str, end: str, by: list[str]) -> DataFrame:
    """Ranges of dates that overlap or touch, merged."""
    order = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = (before.isNull() | (F.col(start) > F.date_add(before, 1))).cast("int")
    out = df.select(*by, start, end).withColumn("new_", new).withColumn("island_", F.sum("new_").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return out.groupBy(*by, "island_").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_ranges")).drop("island_")


def updated(old: DataFrame, new: DataFrame, by: str = "exchange", date: str = "cal_date") -> DataFrame:
    """A calendar with new days on top of old ones."""
    from tickloom.sources.writers import upserted

    return upserted(old, new, [by, date], date_field=date).orderBy(by, date)


def market_dates(calendar: DataFrame, now: str, exchange: str = "SSE", date: str = "cal_date", flag: str = "is_open", open_at: str = "0915", close_at: str = "1530") -> DataFrame:
    """The target and previous trade date at a moment (yyyyMMddHHmm): one row, with the phase.

    On an open day before the auction the last open day counts; otherwise the
    day itself.  A calendar that doesn't hold the day leaves it unconfirmed.
    """
    day, minute = now[:8], now[8:12]
    own = calendar.where(F.col("exchange") == exchange)
    opened = own.where(is_true(flag))
    known = own.where(F.col(date) == day).agg(F.max(F.when(is_true(flag), 1).otherwise(0)).alias("open_today"))
    last = opened.where(F.col(date) <= day).agg(F.slice(F.sort_array(F.collect_set(date), False), 1, 3).alias("days"))
    out = known.crossJoin(last)
    phase = F.when(F.col("open_today").isNull(), "unconfirmed").when(F.col("open_today") == 0, "closed").otherwise(F.lit("pre_auction" if minute < open_at else "trading" if minute < close_at else "closed"))
    early = (F.col("open_today") == 1) & F.lit(minute < open_at)
    pick = lambda i: F.get("days", F.when(early, i + 1).otherwise(i))
    return out.select(phase.alias("phase"), pick(0).alias("target_date"), pick(1).alias("previous_date"))
