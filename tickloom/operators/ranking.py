"""Ranks, orders and limits; every order is made total by its caller or by a last key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.money import num
from tickloom.operators.joins import exchange_order
from tickloom.storage import stored


def ranked(df: DataFrame, order: Sequence[Column], start: int = 0, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Numbers rows in an order, from start + 1, within each key or over all rows."""
    if by:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) + start)
    return numbered(df, order, start, name)


def numbered(df: DataFrame, order: Sequence[Column], start: int = 0, name: str = "rank") -> DataFrame:
    """Row numbers over all rows without gathering them in one task.

    Rows are dealt into sorted ranges of the order and written to the shared
    folder with their place in the range: ranges are sampled, so dealing twice
    would not give the same ones.  The numbers are places plus the sizes of the
    ranges before, one row a range.  One exchange in all.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place_", F.monotonically_increasing_id()), "numbered")
    # an id is the range times 2^33 plus the place in it
    part, place = F.shiftright("place_", 33), F.col("place_").bitwiseAND((1 << 33) - 1)
    sizes = dealt.groupBy(part.alias("part_")).agg(F.count("*").alias("size_"))
    shift = F.sum("size_").over(Window.orderBy("part_")) - F.col("size_")
    # as many rows as there are shuffle partitions
    rows = dealt.withColumn("part_", part).join(F.broadcast(sizes.select("part_", shift.alias("shift_"))), "part_")
    return rows.withColumn(name, place + F.col("shift_") + 1 + start).drop("part_", "place_", "shift_")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in an order, as a top-k: each task keeps n rows."""
    return df.orderBy(*order).limit(n)


def top_per_key(df: DataFrame, n: int, by: Sequence[str], *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last n rows in an ascending order, in that order."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n).orderBy(*order)


def page(df: DataFrame, offset: int, limit: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def first_groups(df: DataFrame, n: int, group: str) -> DataFrame:
    """All rows of the first n distinct values of a column."""
    return df.join(df.select(group).distinct().orderBy(group).limit(n), group, "left_semi")


def text_or_blank(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def number_or_zero(column: str) -> Column:
    return F.coalesce(num(column), F.lit(0.0))


def kline_order() -> list[Column]:
    return [text_or_blank("instrument_id"), text_or_blank("period"), text_or_blank("trade_time")]


def trade_order() -> list[Column]:
    return [text_or_blank("instrument_id"), text_or_blank("trade_date"), text_or_blank("trade_time"), number_or_zero("trade_index")]


def auction_order() -> list[Column]:
    return [text_or_blank("instrument_id"), text_or_blank("trade_time")]


def listing_order() -> list[Column]:
    return [exchange_order(F.col("exchange")), F.col("symbol").asc()]


def dataset_order() -> list[Column]:
    """Datasets with a time first, the newest of them first, then by name from the end."""
    return [F.col("updated_at").desc_nulls_last(), F.col("dataset").desc()]


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """What a descending scan reads before it falls below a threshold."""
    return df.where(num(column) >= threshold)
