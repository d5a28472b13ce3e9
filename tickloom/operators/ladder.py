"""Price limits by day, the limit-up ladder and its themes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import codes, limits
from tickloom.functions.money import market_value, num, ten_thousand
from tickloom.functions.text import board_text, stock_summary
from tickloom.operators.joins import topics_of
from tickloom.operators.ranking import numbered

PUBLIC_FIELDS = (
    "rank", "trade_date", "instrument_id", "name", "ladder_level", "limit_status", "limit_board_text", "last_price", "change_pct", "limit_up_price",
    "seal_amount", "amount", "free_float_value", "year_limit_up_days", "primary_theme", "secondary_themes", "top_theme_names", "theme_count", "theme_strength_score",
)


def price_limits(rows: DataFrame, code: str = "tdx_code", name: str = "name", pre_close: str = "pre_close") -> DataFrame:
    """Adds the day's limit ratio, rule, prices and status."""
    ratio = limits.limit_ratio(code, name)
    return rows.withColumns({
        "limit_ratio": ratio,
        "limit_rule": limits.limit_rule(code, name),
        "limit_up_price": limits.limit_up(pre_close, ratio),
        "limit_down_price": limits.limit_down(pre_close, ratio),
        "limit_day_status": limits.limit_status_of_day(pre_close, ratio),
    })


def base_close(bars: DataFrame, targets: DataFrame, by: str = "tdx_code", date: str = "trade_date", close: str = "close") -> DataFrame:
    """The close of the last bar before each target's date, else of the newest bar."""
    both = targets.join(bars.select(by, F.col(date).alias("bar_date"), F.col(close).alias("bar_close")), by, "left")
    before = F.col("bar_date") < F.col(date)
    return both.groupBy(*targets.columns).agg(
        F.coalesce(F.max_by(F.when(before, F.col("bar_close")), F.when(before, F.col("bar_date"))), F.max_by("bar_close", "bar_date")).alias("pre_close"),
        F.coalesce(F.max(F.when(before, F.col("bar_date"))), F.max("bar_date")).alias("pre_close_date"),
    )


def ladder_rows(snapshot: DataFrame, boards: Sequence[str] = ("sse_main_board", "szse_main_board"), include_touched: bool = False) -> DataFrame:
    """The rows on the ladder, derived from a snapshot with statistics and names.

    Out are unknown codes, other boards, special treatment, days without limit,
    prices that aren't above zero, and what neither sealed nor (if asked) touched.
    """
    rows = price_limits(snapshot).withColumn("board", codes.board("tdx_code"))
    rows = rows.where(F.col("board").isin(list(boards)) & codes.st_type("name").isNull() & F.col("limit_ratio").isNotNull())
    rows = rows.where(limits.positive("last_price") & limits.positive("pre_close") & limits.positive("limit_up_price"))
    status = limits.limit_up_status("last_price", "high", "bid1_price", "locked_amount", "limit_up_price")
    rows = rows.withColumn("limit_status", status)
    rows = rows.where(F.col("limit_status").isin("sealed", "touched") if include_touched else F.col("limit_status") == "sealed")
    sealed = F.col("limit_status") == "sealed"
    todays = F.coalesce(F.col("stats_date") == F.col("trade_date"), F.lit(False))
    days = limits.rolled_forward("limit_stat_days", sealed, todays)
    count = limits.rolled_forward("limit_up_count_in_stat_days", sealed, todays)
    return rows.withColumns({
        "ladder_level": F.when(sealed, limits.ladder_level("limit_up_streak_days", todays)),
        "limit_board_text": board_text(days, count),
        "year_limit_up_days": F.when(num("year_limit_up_days").isNotNull(), limits.rolled_forward("year_limit_up_days", sealed, todays)),
        "seal_amount": F.when(sealed, num("locked_amount")),
        "free_float_value": market_value(ten_thousand("free_float_shares_10k"), "last_price"),
    })


def _stat_columns(sealed: Column, level: Column) -> dict[str, Column]:
    return {
        "same_theme_limit_up_count": F.sum(F.when(sealed, 1).otherwise(0)),
        "same_theme_highest_board": F.max(F.when(sealed, F.coalesce(level, F.lit(0))).otherwise(0)),
        "same_theme_lianban_count": F.sum(F.when(sealed & (level >= 2), 1).otherwise(0)),
    }


def strength(limit_ups: Column, highest: Column, lianban: Column) -> Column:
    return F.round((100 * limit_ups + 10 * highest + 5 * lianban).cast("double"), 6)


def theme_stats(rows: DataFrame, topics: DataFrame) -> DataFrame:
    """Per topic of the ladder's stocks: sealed stocks, highest level, levels of two and more, score.  Zeros stay."""
    joined = topics_of(rows.select("instrument_id", "limit_status", "ladder_level"), topics)
    stats = joined.groupBy("topic_name").agg(*(c.alias(n) for n, c in _stat_columns(F.col("limit_status") == "sealed", F.col("ladder_level")).items()))
    return stats.withColumn("theme_strength_score", strength(F.col("same_theme_limit_up_count"), F.col("same_theme_highest_board"), F.col("same_theme_lianban_count")))


def with_themes(rows: DataFrame, topics: DataFrame) -> DataFrame:
    """Adds each stock's themes by strength: the first, the next three, the first four, their number."""
    stats = theme_stats(rows, topics)
    mine = topics_of(rows.select("instrument_id"), topics).join(stats, "topic_name")
    # descending numbers negated, so that one ascending sort of structs gives the order
    key = F.struct(
        (-F.col("same_theme_limit_up_count")).alias("a"), (-F.col("same_theme_highest_board")).alias("b"), (-F.col("same_theme_lianban_count")).alias("c"),
        (-F.coalesce(num("relevance"), F.lit(0.0))).alias("d"), F.col("topic_name").alias("name"),
        F.struct("theme_strength_score", "same_theme_limit_up_count", "same_theme_highest_board", "same_theme_lianban_count").alias("stats"),
    )
    listed = mine.groupBy("instrument_id").agg(F.array_sort(F.collect_list(key)).alias("themes_"))
    names = F.transform("themes_", lambda t: t["name"])
    later = F.slice(names, 2, 3)
    first = F.get("themes_", 0)["stats"]
    out = rows.join(listed, "instrument_id", "left").withColumns({
        "primary_theme": F.get(names, 0),
        "secondary_themes": F.when(F.size(later) > 0, F.array_join(later, "+")),
        "top_theme_names": F.when(F.size(names) > 0, F.array_join(F.slice(names, 1, 4), "、")),
        "theme_count": F.coalesce(F.when(F.col("themes_").isNotNull(), F.size("themes_")), F.lit(0)),
    })
    return out.withColumns({n: first[n] for n in ("theme_strength_score", "same_theme_limit_up_count", "same_theme_highest_board", "same_theme_lianban_count")}).drop("themes_")


def ladder_order() -> list[Column]:
    """Level, sealed first, the theme's strength, its name (none last), seal, and rank."""
    zero = lambda c: F.coalesce(num(c), F.lit(0.0))
    return [
        zero("ladder_level").desc(),
        (F.col("limit_status") == "sealed").desc(),
        zero("same_theme_limit_up_count").desc(),
        zero("same_theme_highest_board").desc(),
        zero("same_theme_lianban_count").desc(),
        F.coalesce("primary_theme", F.lit("￿")).asc(),
        zero("seal_amount").desc(),
        zero("rank").asc(),
    ]


def limit_ladder(snapshot: DataFrame, topics: DataFrame, count: int | None = None, boards: Sequence[str] = ("sse_main_board", "szse_main_board"), include_touched: bool = False) -> DataFrame:
    """The ladder's public rows in order; at most ``count`` (1 to 500)."""
    if count is not None and not 1 <= count <= 500:
        raise ValueError("count lies between 1 and 500")
    rows = with_themes(ladder_rows(snapshot, boards, include_touched), topics).orderBy(*ladder_order(), "instrument_id")
    rows = rows if count is None else rows.limit(count)
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in PUBLIC_FIELDS))


def theme_rank(rows: DataFrame, topics: DataFrame, limit: int | None = None) -> DataFrame:
    """Themes of sealed stocks by strength, with leader and summary."""
    sealed = topics_of(rows.where("limit_status = 'sealed'"), topics.select("instrument_id", "topic_name", "topic_id", "ordinal"))
    level = F.coalesce(num("ladder_level").cast("int"), F.lit(0))
    seal = F.coalesce(num("seal_amount"), F.lit(0.0))
    out = sealed.groupBy("topic_name").agg(
        F.min_by("trade_date", "ordinal").alias("trade_date"),
        F.min_by("topic_id", F.when(F.coalesce("topic_id", F.lit("")) != "", F.col("ordinal"))).alias("topic_id"),
        F.count("*").alias("limit_up_count"),
        F.max(level).alias("highest_ladder_level"),
        F.count_if(level >= 2).alias("lianban_stock_count"),
        F.count_if(level < 2).alias("first_board_count"),
        F.round(F.sum(seal), 6).alias("seal_amount_sum"),
        F.round(F.sum(F.coalesce(num("amount"), F.lit(0.0))), 6).alias("amount_sum"),
    )
    # five stocks a theme; each task keeps five before anything is gathered
    first = Window.partitionBy("topic_name").orderBy(level.desc(), seal.desc(), F.coalesce(num("rank"), F.lit(0.0)), "instrument_id", "name")
    stock = F.struct(F.col("r_").alias("r"), "instrument_id", "name", "ladder_level", "limit_board_text", "seal_amount")
    leaders = sealed.withColumn("r_", F.row_number().over(first)).where("r_ <= 5").groupBy("topic_name").agg(F.array_sort(F.collect_list(stock)).alias("stocks_"))
    out = out.join(leaders, "topic_name").withColumn("theme_strength_score", strength(F.col("limit_up_count"), F.col("highest_ladder_level"), F.col("lianban_stock_count")))
    leader = F.get("stocks_", 0)
    out = out.withColumns({f"leader_{n}": leader[n] for n in ("instrument_id", "name", "ladder_level", "limit_board_text", "seal_amount")})
    out = out.withColumn("top_stock_summary", F.array_join(F.transform("stocks_", lambda s: stock_summary(s["name"], s["limit_board_text"], s["ladder_level"])), " ")).drop("stocks_")
    order = [F.desc("limit_up_count"), F.desc("highest_ladder_level"), F.desc("lianban_stock_count"), F.desc("theme_strength_score"), F.desc("seal_amount_sum"), F.asc("topic_name")]
    if limit is None:
        return numbered(out, order)
    return out.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def without_topics(rows: DataFrame, topics: DataFrame) -> DataFrame:
    """One row: how many stocks have no topic at all."""
    return rows.where("instrument_id <> ''").join(topics.select("instrument_id").distinct(), "instrument_id", "left_anti").agg(F.count("*").alias("n_missing"))
