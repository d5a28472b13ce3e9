"""Aggregates: modes, breadth, run summaries, profiles, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.dates import compact
from tickloom.functions.money import num


def dominant(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent value, the largest of a tie, its count and share of all rows with a value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.max_by(column, F.struct("n", column)).alias("value"), F.max("n").alias("n"), F.sum("n").alias("total")).withColumn("coverage", F.try_divide(F.col("n"), F.col("total")))


def status_counts(df: DataFrame, by: Sequence[str], status: str) -> DataFrame:
    return df.groupBy(*by, status).agg(F.count("*").alias("n"))


def latest(df: DataFrame, by: Sequence[str], *order: str) -> DataFrame:
    """Each key's last row by an order that should be total."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(*by).agg(F.max_by(whole, F.struct(*order)).alias("row_")).select("row_.*")


def date_profile(df: DataFrame, column: str) -> DataFrame:
    """Least, largest and distinct dates, compacted; and the least and largest text as it stands."""
    day = compact(column)
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.countDistinct(day).alias("n_dates"), F.min(F.col(column).cast("string")).alias("min_text"), F.max(F.col(column).cast("string")).alias("max_text"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null); a column that isn't there is null in every row."""
    counts = df.agg(F.count("*").alias("all_"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns if c in df.columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), (F.col(c) if c in df.columns else F.col("all_")).alias("n_null")) for c in columns))
    return counts.select(F.inline(pairs))


def duplicate_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows share their key with another, and how many such keys there are."""
    return duplicate_groups(df, key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"))


def breadth(df: DataFrame, change: str = "change_pct", status: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rising, falling, flat, and limit-up counts."""
    c = num(change)
    out = [F.count_if(c > 0).alias("n_rise"), F.count_if(c < 0).alias("n_fall"), F.count_if(c == 0).alias("n_flat"), F.count("*").alias("n_all")]
    return df.groupBy(*by).agg(*out, *([F.count_if(status).alias("n_limit_up")] if status is not None else []))


def count_checks(df: DataFrame, by: str, least: int) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n")).withColumn("enough", F.col("n") >= least)
