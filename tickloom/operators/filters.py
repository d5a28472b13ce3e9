"""Row filters of the sources.  Each takes a DataFrame and gives a DataFrame; an empty request filters nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import codes, dates
from tickloom.functions.money import num
from tickloom.functions.text import text


def by_code(df: DataFrame, asked: Sequence[str], symbol: str = "symbol", code: str = "tdx_code") -> DataFrame:
    return df.where(codes.matches_code(symbol, code, asked))


def by_name(df: DataFrame, asked: Sequence[str], name: str = "name", exact: bool = False) -> DataFrame:
    """Names that hold one of the asked, in any case; or that are one of them."""
    wanted = [a.strip() for a in asked if a.strip()]
    if not wanted:
        return df
    if exact:
        return df.where(F.trim(text(name)).isin(wanted))
    hit = F.lit(False)
    for w in wanted:
        hit = hit | F.lower(text(name)).contains(w.lower())
    return df.where(hit)


def by_board(df: DataFrame, boards: Sequence[str], code: str = "tdx_code") -> DataFrame:
    return df.where(codes.board(code).isin(list(boards))) if boards else df


def stocks_only(df: DataFrame, category: str = "tdx_category") -> DataFrame:
    return df.where(F.col(category).isin("a_share", "cdr"))


def indexes_of(df: DataFrame, kind: str | None = None, code: str = "tdx_code") -> DataFrame:
    out = df.withColumn("index_type", codes.index_type(code))
    return out.where(F.col("index_type") == kind) if kind else out


def etfs(df: DataFrame, code: str = "tdx_code") -> DataFrame:
    return df.withColumn("etf_type", codes.etf_type(code)).where("etf_type is not null")


# The names by which categories of corporate actions are asked for.
ACTION_CATEGORIES = {"xdxr": 1, "dividend": 1, "除权除息": 1, "equity": 5, "股本变化": 5, "restructure": 15, "重整调整": 15}


def by_category(df: DataFrame, asked: Sequence[str | int], category: str = "category_raw") -> DataFrame:
    """Corporate actions by category number or name; a missing category counts as 0."""
    names = [str(a).strip().lower() for a in asked if str(a).strip()]
    if unknown := [n for n in names if n not in ACTION_CATEGORIES and not n.lstrip("-").isdigit()]:
        raise ValueError(f"no such category: {', '.join(unknown)}")
    numbers = [ACTION_CATEGORIES.get(n) or int(n) for n in names]
    return df.where(F.coalesce(F.col(category), F.lit(0)).isin(numbers)) if numbers else df


def in_dates_or_undated(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    return df.where(dates.between_or_undated(column, start, end))


def in_years(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    return df.where(dates.year_between(column, start, end))


def by_dataset(df: DataFrame, dataset: str, date_columns: Mapping[str, str], start: str | None, end: str | None) -> DataFrame:
    """A date range on whatever column a dataset keeps its dates in."""
    return in_dates_or_undated(df, date_columns[dataset], start, end) if dataset in date_columns else df


def by_direction(df: DataFrame, word: str | None, column: str = "change_direction") -> DataFrame:
    return df.where(text(column).contains(word)) if word else df


def without_special(df: DataFrame, name: str = "name") -> DataFrame:
    """No special treatment and no delisting names."""
    return df.where(~F.coalesce(F.upper(F.trim(text(name))).rlike(r"^(\*?ST|S\*?ST|退)|退$"), F.lit(False)))


def without_pennies(df: DataFrame, name: str = "name", price: str = "last_price") -> DataFrame:
    """No special treatment, and no price of 1 or less; an unknown price stays."""
    st = F.coalesce(F.upper(F.trim(text(name))).rlike(r"^\*?ST"), F.lit(False))
    return df.where(~st & (num(price).isNull() | (num(price) > 1)))


def with_bits(df: DataFrame, column: str, mask: int) -> DataFrame:
    return df.where(F.col(column).cast("long").bitwiseAND(F.lit(mask).cast("long")) != 0)


def mask_of(values: Sequence[str | int], names: Mapping[str, int]) -> int:
    """Flags, names of flags or numbers in any base, combined."""
    out = 0
    for v in values:
        out |= v if isinstance(v, int) else names.get(v.strip().lower(), 0) or int(v, 0)
    if not 0 <= out <= 0xFFFF:
        raise ValueError("filters must lie between 0 and 65535")
    return out


# The names of a ranking request's flags.
RANK_FLAGS = {
    "new": 1,
    "exclude_new": 1,
    "次新": 1,
    "未开板次新": 1,
    "kcb": 2,
    "star": 2,
    "exclude_kcb": 2,
    "科创板": 2,
    "st": 4,
    "exclude_st": 4,
    "st股": 4,
    "cyb": 8,
    "chinext": 8,
    "exclude_cyb": 8,
    "创业板": 8,
    "bj": 16,
    "bse": 16,
    "exclude_bj": 16,
    "北证a": 16,
}


def rank_mask(values: Sequence[str | int]) -> int:
    return mask_of(values, RANK_FLAGS)


def is_active(*columns: str) -> Column:
    """Whether any of a bar's volume columns is above zero."""
    return F.greatest(F.lit(0.0), *(F.coalesce(num(c), F.lit(0.0)) for c in columns)) > 0


def opening_auction(df: DataFrame, time: str = "trade_time") -> DataFrame:
    return df.where(F.col(time) == "09:25")


def any_text(df: DataFrame, columns: Sequence[str], words: Sequence[str]) -> DataFrame:
    """Rows whose columns together hold one of the words."""
    if not words:
        return df
    whole, hit = F.lower(F.concat_ws(" ", *(text(c) for c in columns))), F.lit(False)
    for w in words:
        hit = hit | whole.contains(w.lower())
    return df.where(hit)


def instruments(df: DataFrame, asset_types: Sequence[str] = (), exchanges: Sequence[str] = (), symbols: Sequence[str] = (), names: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    for column, asked in (("asset_type", asset_types), ("exchange", exchanges), ("symbol", symbols)):
        df = df.where(F.upper(text(column)).isin([a.upper() for a in asked])) if asked else df
    df = any_text(df, ["name"], names)
    return df if limit is None else df.limit(limit)


def ladder_candidates(df: DataFrame, include_touched: bool = False, change: str = "change_pct", high_change: str = "high_change_pct") -> DataFrame:
    bar = 4.5 if include_touched else 8.5
    return df.where((num(change) >= bar) | (num(high_change) >= bar))


# Words of topics that say nothing about a stock's business.
NOISE_WORDS = ("不可减持", "持股", "罗素", "MSCI", "富时", "标普", "沪股通", "深股通", "融资融券", "转融券", "国企改革", "国资改革", "央企改革", "参股券商", "参股新三板", "最近闪拉", "定向增发", "并购基金", "财报", "证金", "汇金", "社保基金", "养老金")


def is_noise(topic, words: Sequence[str] = NOISE_WORDS) -> Column:
    """Blank topics, and those that hold one of the words in any case."""
    t = F.upper(F.trim(text(topic)))
    return F.coalesce(t, F.lit("")).isin("") | F.coalesce(t.rlike("|".join(w.upper() for w in words)), F.lit(False))
