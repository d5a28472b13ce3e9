"""Days as bits: the days of a key are 64-bit words, a row a key and word.

A word holds 64 consecutive days, counted from 1970-01-01.  Words are built by a
partial OR in every task, so what is shuffled is a row a key and two months however
many rows the days have; sets of days meet as AND, OR and NOT of words, and are
counted without being spelt out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.dates import of_date, real_date


def day_number(date) -> Column:
    """Days since 1970-01-01 of a date's text; null if it is none."""
    return F.unix_date(real_date(date))


def day_words(df: DataFrame, by: Sequence[str], date: str, bits: str = "bits") -> DataFrame:
    """The days of each key: by, word, bits, and the first and last day of the word, ``low`` and ``high``."""
    days = df.select(*by, day_number(date).alias("day_")).where("day_ is not null")
    one = F.expr("shiftleft(1L, day_ & 63)")
    return days.groupBy(*by, F.shiftright("day_", 6).alias("word")).agg(F.bit_or(one).alias(bits), F.min("day_").alias("low"), F.max("day_").alias("high"))


def within(word: str, low: str, high: str) -> Column:
    """The bits of a word that lie within two days."""
    from_low = f"CASE WHEN {low} <= {word} * 64 THEN -1L ELSE shiftleft(-1L, least({low} - {word} * 64, 63)) END"
    to_high = f"CASE WHEN {high} >= {word} * 64 + 63 THEN -1L ELSE shiftrightunsigned(-1L, least({word} * 64 + 63 - {high}, 63)) END"
    return F.expr(f"CASE WHEN {high} < {word} * 64 OR {low} > {word} * 64 + 63 THEN 0L ELSE ({from_low}) & ({to_high}) END")


def without(bits: Column, other: Column) -> Column:
    return bits.bitwiseAND(F.bitwise_not(other))


def first_day(word: Column, bits: Column) -> Column:
    """The number of a word's first day; the word has one."""
    # bits below the lowest set one; the subtraction wraps where only the sign is set
    below = F.bitwise_not(bits).bitwiseAND(F.coalesce(F.try_subtract(bits, F.lit(1)), F.lit((1 << 63) - 1)))
    return word * 64 + F.bit_count(below)


def day_text(number: Column) -> Column:
    return of_date(F.date_from_unix_date(number.cast("int")))


def spelt(df: DataFrame, word: str, bits: str, name: str = "d") -> DataFrame:
    """A row a day of each word, as compact text."""
    days = df.withColumn("bit_", F.explode(F.expr(f"filter(sequence(0, 63), i -> getbit({bits}, i) = 1)")))
    return days.withColumn(name, day_text(F.col(word) * 64 + F.col("bit_"))).drop("bit_")
