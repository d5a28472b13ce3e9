"""Quote snapshots, order books and auction indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import money
from tickloom.functions.codes import exchange_of, instrument_id
from tickloom.functions.money import num
from tickloom.functions.text import board_text

LEVELS = 5


# What a snapshot derives, the columns it takes, and how.
_DERIVED = {
    "instrument_id": (("tdx_code",), instrument_id),
    "exchange": (("tdx_code",), exchange_of),
    "change": (("last_price", "pre_close"), lambda last, pre: money.round6(num(last) - num(pre))),
    "change_pct": (("last_price", "pre_close"), money.percent_change),
    "open_change_pct": (("open", "pre_close"), money.percent_change),
    "high_change_pct": (("high", "pre_close"), money.percent_change),
    "low_change_pct": (("low", "pre_close"), money.percent_change),
    "average_price": (("amount", "volume"), money.average_price),
    "drawdown_pct": (("high", "last_price", "pre_close"), money.drawdown_pct),
    "attack_pct": (("last_price", "low", "pre_close"), money.attack_pct),
    "inside_outside_ratio": (("inside_volume", "outside_volume"), money.safe_ratio),
    "locked_amount": (("bid1_price", "bid1_volume"), money.locked_amount),
    "balance_pct": (("bid1_volume", "ask1_volume"), money.balance_pct),
    "volume_gap": (("bid1_volume", "ask1_volume"), money.int_diff),
}


def derived(quotes: DataFrame) -> DataFrame:
    """Adds all that raw quotes with these columns give."""
    have = set(quotes.columns)
    return quotes.withColumns({name: how(*takes) for name, (takes, how) in _DERIVED.items() if have.issuperset(takes)})


def order_book(quotes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Five rows a quote from bid1_price .. ask5_volume; levels without a price stay as nulls."""
    column = lambda n, kind: (F.col(n) if n in quotes.columns else F.lit(None)).cast(kind)
    levels = F.array(*(
        F.struct(
            F.lit(i).alias("level"),
            money.round6(column(f"bid{i}_price", "double")).alias("bid_price"),
            column(f"bid{i}_volume", "long").alias("bid_volume"),
            money.round6(column(f"ask{i}_price", "double")).alias("ask_price"),
            column(f"ask{i}_volume", "long").alias("ask_volume"),
        )
        for i in range(1, LEVELS + 1)
    ))
    return quotes.select(*keep, F.inline(levels))


def widened(quotes: DataFrame, levels: str, sides: Sequence[str] = ("bid", "ask")) -> DataFrame:
    """Columns bid1_price .. ask5_volume from arrays of (price, volume) named bid_<levels> and ask_<levels>."""
    new = {f"{s}{i}_{f}": F.get(f"{s}_{levels}", i - 1)[f] for s in sides for i in range(1, LEVELS + 1) for f in ("price", "volume")}
    return quotes.withColumns(new)


def stats_alignment(target: Column, previous: Column, stats_date: Column) -> Column:
    """How a statistics row stands to the target date."""
    return (
        F.when(F.coalesce(stats_date, F.lit("")) == "", "stats_row_missing")
        .when((F.coalesce(target, F.lit("")) == "") | (F.coalesce(previous, F.lit("")) == ""), "trade_date_unavailable")
        .when(stats_date == target, "same_day")
        .when(stats_date == previous, "previous_trading_day")
        .otherwise("stats_date_unaligned")
    )


# What the previous day's figures are called on the day itself, and a day later.
_ALIGNED = {
    "prev_amount_10k": ("prev_amount_10k", "amount_10k"),
    "prev_seal_amount_10k": ("prev_seal_amount_10k", "seal_amount_10k"),
    "prev2_seal_amount_10k": ("prev2_seal_amount_10k", "prev_seal_amount_10k"),
    "prev_open_volume_hand": ("prev_open_volume_hand", "open_volume_hand"),
    "prev_open_amount_10k": ("prev_open_amount_10k", "open_amount_10k"),
}


def auction_indicators(rows: DataFrame, target: str, previous: str) -> DataFrame:
    """Opening-auction indicators of quotes joined with statistics, finance and the volumes of recent days.

    Expects recent_volume_sum and recent_volume_count of the last five active days.
    """
    status = stats_alignment(F.lit(target), F.lit(previous), F.col("stats_date"))
    rows = derived(rows).withColumn("indicator_status", status)
    same, later = F.col("indicator_status") == "same_day", F.col("indicator_status") == "previous_trading_day"
    rows = rows.withColumns({f"{k}_": F.when(same, num(a)).when(later, num(b)) for k, (a, b) in _ALIGNED.items()})
    prev_amount, prev_seal, prev2_seal, prev_open = (money.ten_thousand(f"{k}_") for k in ("prev_amount_10k", "prev_seal_amount_10k", "prev2_seal_amount_10k", "prev_open_amount_10k"))
    lots = money.auction_open_lots("open_amount", "open")
    free_float = money.ten_thousand("free_float_shares_10k")
    free_value = money.market_value(free_float, "last_price")
    out = {
        "open_volume_hand": lots,
        "open_volume_ratio": money.open_volume_ratio(lots, "recent_volume_sum", "recent_volume_count"),
        "open_turnover_z": money.safe_ratio_pct(lots, money.ten_thousand_shares_to_lots("free_float_shares_10k")),
        "open_prev_amount_ratio": money.safe_ratio_pct("open_amount", prev_amount),
        "auction_prev_volume_ratio": money.safe_ratio(lots, "prev_open_volume_hand_"),
        "open_prev_seal_ratio": money.safe_ratio_pct("open_amount", prev_seal),
        "prev_amount": prev_amount,
        "prev_seal_amount": prev_seal,
        "prev2_seal_amount": prev2_seal,
        "prev_open_volume_hand": money.round6("prev_open_volume_hand_"),
        "prev_open_amount": prev_open,
        "float_market_value": money.market_value("float_share", "last_price"),
        "free_float_shares": free_float,
        "free_float_market_value": free_value,
        "seal_amount": F.col("locked_amount"),
        "seal_to_amount_ratio": money.safe_ratio("locked_amount", "amount"),
        "seal_to_float_ratio": money.safe_ratio_pct("locked_amount", free_value),
        "seal_prev_ratio": money.safe_ratio("locked_amount", prev_seal),
        "limit_board_text": board_text("limit_stat_days", "limit_up_count_in_stat_days"),
    }
    return rows.withColumns(out).drop(*(f"{k}_" for k in _ALIGNED))


def alignment_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("indicator_status").agg(F.count("*").alias("n"))


def auction_amount(price, lots) -> Column:
    return F.round(num(price) * num(lots) * 100, 6)


def shares_on(rows: DataFrame) -> DataFrame:
    """Share counts of a day with where they come from; expects finance and statistics columns, null where missing."""
    finance = num("total_share").isNotNull() | num("float_share").isNotNull()
    stats = num("free_float_shares_10k").isNotNull()
    from tickloom.operators.joins import share_sources

    return share_sources(rows, stats, finance).withColumn("free_float_share", money.ten_thousand("free_float_shares_10k"))
