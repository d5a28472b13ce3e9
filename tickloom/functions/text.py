"""Text cleaning, parsing and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of null, by family of sources.
NULLS = ("", "--", "-", "none", "null")
NULLS_WIDE = ("", "--", "-", "none", "null", "nan", "n/a")


def text(value) -> Column:
    return (value if isinstance(value, Column) else F.col(value)).cast("string")


def clean_text(value, nulls: Sequence[str] = NULLS) -> Column:
    """Trimmed, runs of white space as one blank, null spellings as null."""
    flat = F.trim(F.regexp_replace(text(value), r"\s+", " "))
    return F.when(~F.lower(flat).isin(*nulls), flat)


def parse_float(value, nulls: Sequence[str] = NULLS_WIDE) -> Column:
    """A number with thousands separators; anything else is null."""
    return F.regexp_replace(clean_text(value, nulls), ",", "").try_cast("double")


def parse_number(value, whole: bool = False) -> Column:
    """A number without separators, percent signs and what follows a '#'."""
    plain = F.replace(F.regexp_replace(F.replace(F.trim(text(value)), F.lit(","), F.lit("")), "#.*$", ""), F.lit("%"), F.lit(""))
    number = F.when(plain != "", plain).try_cast("double")
    return number.cast("long") if whole else number


def parse_int(value, truncate: bool = False) -> Column:
    """A whole number; with ``truncate`` also the whole part of a decimal."""
    plain = F.trim(text(value))
    return plain.try_cast("double").cast("long") if truncate else F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("long"))


# The common entities; an ampersand comes last, so that nothing is decoded twice.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def strip_html(value, entities: Mapping[str, str] = ENTITIES) -> Column:
    """Text without tags; entities decoded, the common ones unless others are given."""
    out = F.regexp_replace(text(value), r"(?s)<[^>]*>", "")
    for name, letter in entities.items():
        out = F.replace(out, F.lit(name), F.lit(letter))
    out = F.trim(out)
    return F.when(out != "", out)


def first_text(*values) -> Column:
    """The first column that isn't null or blank."""
    return F.coalesce(*(F.when(F.trim(text(v)) != "", F.trim(text(v))) for v in values))


def identifier_text(value) -> Column:
    """12.0 as 12; other text trimmed."""
    plain = F.trim(text(value))
    return F.when(plain.rlike(r"^-?\d+\.0+$"), F.regexp_extract(plain, r"^(-?\d+)", 1)).otherwise(clean_text(value))


def record_key(*values) -> Column:
    """Values joined by '|', nulls as nothing."""
    return F.concat_ws("|", *(F.coalesce(text(v), F.lit("")) for v in values))


def mapped(value, names: Mapping[str, str], keep_others: bool = False) -> Column:
    """A value's name in a map; others are null, or themselves."""
    key = F.trim(text(value))
    pairs = [F.lit(x) for item in names.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(found, key) if keep_others else found


# The code maps of the fundamentals pages.
MARKET_OF_CODE = {"0": "sz", "1": "sh", "2": "bj"}
FINANCING_EVENTS = {"zf": "placement", "pf": "rights_issue", "gqjl": "incentive", "kzzdfxyss": "convertible_bond"}
NORTHBOUND_CHANNELS = {"sz": "深股通", "sh": "沪股通"}
CONVERTIBLE_STATUS = {"0": "未退市", "1": "已退市"}
TOPIC_EXPOSURES = {"zttzbkz": "sector", "zttzztk": "theme"}
VALUATION_METRICS = {"0": "pe", "1": "pb", "2": "pcf", "3": "ps"}


def rights_issue_plan(ratio, price) -> Column:
    r, p = first_text(ratio), first_text(price)
    return F.when(r.isNotNull() & p.isNotNull(), F.format_string("每10股配%s股，配股价%s元", r, p))


def hex_text(value) -> Column:
    return F.lower(F.hex(value if isinstance(value, Column) else F.col(value)))


def values_of(value) -> Column:
    """The items of text separated by commas of either width, or blanks."""
    return F.filter(F.split(F.coalesce(text(value), F.lit("")), r"[,，\s]+"), lambda x: x != "")


def board_text(days, count) -> Column:
    d, c = parse_int(days, True), parse_int(count, True)
    return F.when((d > 0) & (c > 0), F.format_string("%d天%d板", d, c))


def stock_summary(name, board, level) -> Column:
    """name（board text, or level and 板）"""
    label = F.coalesce(text(board), F.concat(text(level), F.lit("板")))
    return F.concat(text(name), F.lit("（"), label, F.lit("）"))


def path_text(code, names: Column, lengths: Sequence[int], separator: str = " / ") -> Column:
    """The names of a code's prefixes, without repeats in a row; names: a map column."""
    whole = F.trim(text(code))
    parts = F.array(*(F.when(F.length(whole) >= n, F.try_element_at(names, F.substring(whole, 1, n))) for n in lengths))
    known = F.filter(parts, lambda x: x.isNotNull())
    fresh = F.filter(known, lambda x, i: (i == 0) | (x != F.get(known, i - 1)))
    return F.when(F.size(fresh) > 0, F.array_join(fresh, separator))


def jsonp_body(value) -> Column:
    """The argument of a JSONP call, or the text itself if it is bare JSON."""
    body = F.regexp_extract(text(value), r"(?s)^[^\[{(]*\(\s*([\[{].*[\]}])\s*\)\s*;?\s*$", 1)
    return F.when(body != "", body).otherwise(F.when(F.trim(text(value)).rlike(r"(?s)^[\[{]"), F.trim(text(value))))
