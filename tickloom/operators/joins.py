"""Joins: equi, as-of, range, semi, anti, positional.

None collects a side, and none broadcasts one by hint; Catalyst broadcasts what
its statistics show to be small.  As-of joins are one union and one window, a
single shuffle on the key with no pairs made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_stats(securities: DataFrame, *stats: DataFrame) -> DataFrame:
    """Left joins of statistics on (market_id, six-digit code)."""
    out = securities.withColumn("code", F.lpad(F.col("code").cast("string"), 6, "0"))
    for table in stats:
        out = out.join(table.withColumn("code", F.lpad(F.col("code").cast("string"), 6, "0")), ["market_id", "code"], "left")
    return out


def quoted(codes: DataFrame, quotes: DataFrame, *more: DataFrame, key: str = "tdx_code") -> DataFrame:
    """Codes that have a quote, with whatever the other tables know of them."""
    out = codes.join(quotes, key)
    for table in more:
        out = out.join(table, key, "left")
    return out


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, values: Sequence[str], strict: bool = False, forward: bool = False) -> DataFrame:
    """Left rows with the values of the nearest right row at or before (after, if ``forward``) their time.

    ``strict`` leaves out equal times.  Of right rows with equal times the last
    by their values counts.
    """
    known = F.struct(F.col(right_on).alias("at_"), *(F.col(v) for v in values))
    a = left.select("*", F.col(left_on).alias("t_"), F.lit(1).alias("side_"), F.lit(None).cast(right.select(known.alias("k")).schema["k"].dataType).alias("known_"))
    b = right.select(*by, F.col(right_on).alias("t_"), F.lit(0).alias("side_"), known.alias("known_"))
    both = a.unionByName(b, allowMissingColumns=True)
    # right rows come first at equal times, or after if equal times don't count
    side = F.col("side_").desc() if strict else F.col("side_").asc()
    if forward:
        order = Window.partitionBy(*by).orderBy(F.col("t_").desc(), side, F.col("known_").desc())
    else:
        order = Window.partitionBy(*by).orderBy(F.col("t_").asc(), side, F.col("known_").asc())
    found = F.last("known_", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("found_", found).where("side_ = 1")
    return out.select(*left.columns, F.col("found_.at_").alias(f"matched_{right_on}"), *(F.col(f"found_.{v}").alias(v if v not in left.columns else f"{v}_right") for v in values))


def active_on(dates: DataFrame, lifecycle: DataFrame, date: str = "trade_date", listed: str = "list_date", delisted: str = "delist_date") -> DataFrame:
    """The rows of a lifecycle table alive on each date: a range join through months.

    Each life is dealt to the months it spans, so the join is on equal months
    with the range as a filter, and never a nested loop.  A missing listing
    date counts as listed long ago.
    """
    first, last = dates.agg(F.min(date), F.max(date)).first()
    if first is None:
        return dates.join(lifecycle, F.lit(False))
    month = lambda c: F.to_date(F.substring(c, 1, 6), "yyyyMM")
    low = F.greatest(F.coalesce(F.col(listed), F.lit(first)), F.lit(first))
    high = F.least(F.coalesce(F.col(delisted), F.lit(last)), F.lit(last))
    spans = lifecycle.where(low <= high).withColumn("month_", F.explode(F.sequence(month(low), month(high), F.expr("interval 1 month"))))
    out = dates.withColumn("month_", month(F.col(date))).join(spans, "month_")
    return out.where((F.col(listed).isNull() | (F.col(listed) <= F.col(date))) & (F.col(delisted).isNull() | (F.col(delisted) >= F.col(date)))).drop("month_")


def historical_list(dates: DataFrame, lifecycle: DataFrame, order: str) -> DataFrame:
    """Each date's living instruments, the first row of an id in input order, in exchange and symbol order."""
    from tickloom.sources.writers import keep_first

    once = keep_first(lifecycle.where("instrument_id is not null"), [F.col("instrument_id")], [F.col(order)])
    return active_on(dates, once).orderBy("trade_date", exchange_order(F.col("exchange")), "symbol")


def exchange_order(exchange: Column) -> Column:
    return F.when(exchange == "SSE", 0).when(exchange == "SZSE", 1).when(exchange == "BSE", 2).otherwise(99)


def semi(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def suspended(stocks: DataFrame, quotes: DataFrame, bit: int, code: str = "tdx_code", status: str = "status") -> DataFrame:
    """Stocks whose quote has a status bit, by code in any case."""
    own = quotes.select(F.lower(F.col(code)).alias("code_"), *(c for c in quotes.columns if c not in stocks.columns))
    out = stocks.withColumn("code_", F.lower(F.col(code))).join(own, "code_").drop("code_")
    return out.where(F.col(status).cast("long").bitwiseAND(F.lit(bit).cast("long")) != 0)


def with_names(rows: DataFrame, names: DataFrame, key: str = "tdx_code") -> DataFrame:
    """Names of the rows' codes only."""
    return rows.join(semi(names, rows, [key]).dropDuplicates([key]), key, "left")


def topics_of(stocks: DataFrame, topics: DataFrame, key: str = "instrument_id", topic: str = "topic_name", order: str = "ordinal") -> DataFrame:
    """Stocks with each of their topics once, the first in order."""
    from tickloom.operators.filters import is_noise
    from tickloom.sources.writers import keep_first

    clean = topics.withColumn(topic, F.trim(F.col(topic))).where(~is_noise(topic))
    return stocks.join(keep_first(clean, [F.col(key), F.col(topic)], [F.col(order)]), key)


def with_details(events: DataFrame, details: DataFrame, key: str) -> DataFrame:
    return events.join(details.dropDuplicates([key]), key, "left")


def with_one_row(rows: DataFrame, aggregate: DataFrame) -> DataFrame:
    """A one-row aggregate on every row."""
    return rows.crossJoin(F.broadcast(aggregate.limit(1)))


def positional(left: DataFrame, right: DataFrame, left_order: str, right_order: str, by: Sequence[str] = ()) -> DataFrame:
    """Row i of one with row i of the other, within each key."""
    from tickloom.operators.ranking import ranked

    fresh = [c for c in right.columns if c not in left.columns or c in by]
    other = ranked(right, [F.asc(right_order)], by=by, name="row_").select(*fresh, "row_")
    return ranked(left, [F.asc(left_order)], by=by, name="row_").join(other, [*by, "row_"], "left").drop("row_")


def by_key_or_code(quotes: DataFrame, instruments: DataFrame, values: Sequence[str]) -> DataFrame:
    """Instruments by (market, code), else by code alone (the smallest market that has it)."""
    exact = instruments.select("market", "code", F.struct(*values).alias("exact_"))
    loose = instruments.groupBy("code").agg(F.min_by(F.struct(*values), "market").alias("loose_"))
    out = quotes.join(exact, ["market", "code"], "left").join(loose, "code", "left")
    found = F.coalesce("exact_", "loose_")
    return out.select(*quotes.columns, *(found[v].alias(v) for v in values))


def with_dimensions(rows: DataFrame, regions: DataFrame, industries: DataFrame) -> DataFrame:
    """Region by raw id and industry by market:code."""
    keyed = rows.withColumn("industry_key", F.concat_ws(":", "market_id", "code"))
    return keyed.join(regions, "province_raw", "left").join(industries, "industry_key", "left").drop("industry_key")


def share_sources(rows: DataFrame, stats: Column, finance: Column) -> DataFrame:
    """Which of the two sides a row's shares come from."""
    label = F.concat_ws("+", F.when(finance, "finance"), F.when(stats, "stats"))
    return rows.withColumn("source", F.when(label == "", "empty").otherwise(label))


def overlap_ratio(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: the keys of each, those of both, and their share of the larger."""
    a, b = left.select(*on).distinct(), right.select(*on).distinct()
    counts = [d.agg(F.count("*").alias(n)) for d, n in ((a, "n_left"), (b, "n_right"), (a.intersect(b), "n_both"))]
    out = counts[0].crossJoin(counts[1]).crossJoin(counts[2])
    return out.withColumn("overlap", F.try_divide(F.col("n_both"), F.greatest("n_left", "n_right")))
