"""Instrument codes, boards and name flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.text import text

# Exchanges and markets.
EXCHANGE_OF_MARKET = {"sh": "SSE", "sz": "SZSE", "bj": "BSE"}
MARKET_OF_EXCHANGE = {"SSE": "sh", "SH": "sh", "SHA": "sh", "SHSE": "sh", "SZSE": "sz", "SZ": "sz", "SZA": "sz", "BSE": "bj", "BJ": "bj"}


def _map(names: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in names.items() for x in pair))


def instrument_id(code) -> Column:
    """sz000001 as 000001.SZ; other codes in upper case."""
    c = F.lower(F.trim(text(code)))
    return F.when(c.rlike(r"^(sh|sz|bj)\d{6}$"), F.concat(F.substring(c, 3, 6), F.lit("."), F.upper(F.substring(c, 1, 2)))).otherwise(F.upper(c))


def market_code(name) -> Column:
    """000001.SZ or 000001 as sz000001; null if it can't be told.

    Symbols that start with 9 are taken for Shanghai before any other rule, 92
    included.
    """
    n = F.lower(F.trim(text(name)))
    bare = F.when(n.rlike(r"^[69]\d{5}$"), "sh").when(n.rlike(r"^[0-3]\d{5}$"), "sz").when(n.rlike(r"^8\d{5}$"), "bj")
    return (
        F.when(n.rlike(r"^(sh|sz|bj)\d{6}$"), n)
        .when(n.rlike(r"^\d{6}\.(sh|sz|bj)$"), F.concat(F.substring(n, 8, 2), F.substring(n, 1, 6)))
        .when(bare.isNotNull(), F.concat(bare, n))
    )


def exchange_of(code) -> Column:
    return F.try_element_at(_map(EXCHANGE_OF_MARKET), F.substring(F.lower(text(code)), 1, 2))


def market_of_exchange(exchange) -> Column:
    return F.try_element_at(_map(MARKET_OF_EXCHANGE), F.upper(F.trim(text(exchange))))


def exchange_of_symbol(symbol) -> Column:
    s = F.upper(text(symbol))
    return F.when(s.endswith(".SH"), "SSE").when(s.endswith(".SZ"), "SZSE").when(s.endswith(".BJ"), "BSE")


def any_symbol(value) -> Column:
    """The code of 000001.SZ, sz000001, SZ.000001, 0.000001 or 1.600000."""
    v = F.lower(F.trim(text(value)))
    dotted = F.regexp_extract(v, r"^(sh|sz|bj)\.(\d{6})$", 1)
    numbered = F.regexp_extract(v, r"^([01])\.(\d{6})$", 1)
    return F.coalesce(
        F.when(dotted != "", F.concat(dotted, F.regexp_extract(v, r"(\d{6})$", 1))),
        F.when(numbered != "", F.concat(F.when(numbered == "1", "sh").otherwise("sz"), F.regexp_extract(v, r"(\d{6})$", 1))),
        market_code(v),
    )


def _starts(code: Column, market: str, *heads: str) -> Column:
    return code.rlike(f"^{market}({'|'.join(heads)})")


def board(code) -> Column:
    c = F.lower(F.trim(text(code)))
    name = (
        F.when(c.startswith("bj"), "bse_listed_stock")
        .when(_starts(c, "sh", "688"), "sse_star_market")
        .when(_starts(c, "sh", "689"), "sse_cdr")
        .when(_starts(c, "sh", "600", "601", "603", "605"), "sse_main_board")
        .when(_starts(c, "sz", "300", "301"), "szse_chinext")
        .when(_starts(c, "sz", "000", "001", "002", "003", "004"), "szse_main_board")
    )
    return F.when(F.length(c) == 8, name)


def index_type(code) -> Column:
    c = F.lower(F.coalesce(text(code), F.lit("")))
    return F.when(c.rlike("^(sh000|sz399|bj899)"), "official_index").when(c.rlike("^(sh880|sh881|sh999)"), "tdx_block_index").otherwise("index")


def etf_type(code) -> Column:
    c = F.lower(F.coalesce(text(code), F.lit("")))
    return F.when(c.rlike("^sh(51|56|58)"), "sse_etf").when(c.startswith("sz15"), "szse_etf")


def name_flag(name) -> Column:
    """*ST, ST, N or C by how an upper-cased name starts; any Latin name in N or C counts."""
    n = F.upper(F.trim(text(name)))
    return F.when(n.startswith("*ST"), "*ST").when(n.startswith("ST"), "ST").when(n.startswith("N"), "N").when(n.startswith("C"), "C")


def st_type(name) -> Column:
    n = F.upper(F.trim(text(name)))
    return F.when(n.rlike(r"^S?\*ST"), "*ST").when(n.rlike("^S?ST"), "ST")


def matches_code(symbol, code, asked: Iterable[str]) -> Column:
    """Whether an instrument is one of the asked: 000001, 000001.SZ or sz000001."""
    asked = [a.strip().lower() for a in asked]
    if not asked:
        return F.lit(True)
    c = F.lower(text(code))
    return F.lower(text(symbol)).isin(asked) | c.isin(asked) | F.lower(instrument_id(c)).isin(asked)
