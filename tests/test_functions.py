"""Column functions against small tables of expected values."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import codes, dates, limits, money, text


def value(spark, column, **cells):
    names = list(cells)
    kinds = {str: "string", int: "long", float: "double", type(None): "string"}
    schema = ", ".join(f"{n} {kinds[type(v)]}" for n, v in cells.items()) or "one int"
    row = tuple(cells.values()) or (1,)
    assert names or row
    return spark.createDataFrame([row], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "name"),
    [("sz000001", "000001.SZ"), ("SH600000", "600000.SH"), ("000001.sz", "000001.SZ"), ("hk00700", "HK00700")],
)
def test_instrument_id(spark, raw, name):
    assert value(spark, codes.instrument_id("a"), a=raw) == name


@pytest.mark.parametrize(
    ("raw", "code"),
    [("000001.SZ", "sz000001"), ("600000", "sh600000"), ("920001", "sh920001"), ("830001", "bj830001"), ("300001", "sz300001"), ("700001", None), ("1.600000", None)],
)
def test_market_code(spark, raw, code):
    assert value(spark, codes.market_code("a"), a=raw) == code


def test_any_symbol(spark):
    assert value(spark, codes.any_symbol("a"), a="1.600000") == "sh600000"
    assert value(spark, codes.any_symbol("a"), a="SZ.000001") == "sz000001"


@pytest.mark.parametrize(("name", "flag", "st_type"), [("*ST x", "*ST", "*ST"), ("ST x", "ST", "ST"), ("SST x", None, "ST"), ("S*ST x", None, "*ST"), ("Nova", "N", None), ("Cx", "C", None), ("平安银行", None, None), ("", None, None)])
def test_name_flags(spark, name, flag, st_type):
    assert value(spark, codes.name_flag("a"), a=name) == flag
    assert value(spark, codes.st_type("a"), a=name) == st_type


def test_ratios_are_null_for_nulls_and_zero(spark):
    assert value(spark, money.percent_change("a", "b"), a=11.0, b=10.0) == 10.0
    assert value(spark, money.percent_change("a", "b"), a=11.0, b=0.0) is None
    assert value(spark, money.safe_ratio("a", "b"), a=None, b=1.0) is None
    assert value(spark, money.average_price("a", "b"), a=1000.0, b=0.0) is None
    assert value(spark, money.balance_pct("a", "b"), a=30, b=10) == 50.0
    assert value(spark, money.balance_pct("a", "b"), a="1.5", b="x") is None
    assert value(spark, money.open_volume_ratio("a", "b", "c"), a=10.0, b=1200.0, c=5) == 10.0
    assert value(spark, money.open_volume_ratio("a", "b", "c"), a=10.0, b=1200.0, c=4) is None


def test_prices(spark):
    assert value(spark, money.price_from_raw("a", "b"), a=12345, b=2) == 123.45
    assert value(spark, money.on_tick("a", "b"), a=10.13, b=0.05) == 10.15
    assert value(spark, money.tick_decimals("a"), a=0.05) == 2
    assert value(spark, money.tick_decimals("a"), a=1.0) == 0


def test_price_limits(spark):
    ratio = limits.limit_ratio("c", "n")
    for code, name, expected in (("sz000001", "平安银行", 10.0), ("sh688001", "x", 20.0), ("sz301001", "x", 20.0), ("bj830001", "x", 30.0), ("sz000001", "ST x", 5.0), ("sz000001", "Nx", None)):
        assert value(spark, ratio, c=code, n=name) == expected
    assert value(spark, limits.limit_up("p", F.lit(10.0)), p=8.0) == 8.8
    assert value(spark, limits.limit_down("p", F.lit(10.0)), p=8.0) == 7.2
    assert value(spark, limits.limit_rule("c", "n"), c="sz000001", n="x") == "main_10pct"


def test_limit_up_status(spark):
    status = limits.limit_up_status("last", "high", "bid", "locked", F.lit(11.0))
    assert value(spark, status, last=11.0, high=11.0, bid=11.0, locked=0.0) == "sealed"
    assert value(spark, status, last=11.0, high=11.0, bid=10.9, locked=5.0) == "sealed"
    assert value(spark, status, last=11.0, high=11.0, bid=10.9, locked=0.0) == "touched"
    assert value(spark, status, last=10.0, high=10.5, bid=10.0, locked=0.0) == "none"


def test_text(spark):
    assert value(spark, text.clean_text("a"), a="  a \n b ") == "a b"
    assert value(spark, text.clean_text("a"), a=" -- ") is None
    assert value(spark, text.parse_float("a"), a="1,234.5") == 1234.5
    assert value(spark, text.parse_float("a"), a="N/A") is None
    assert value(spark, text.parse_number("a"), a="12.5%#x") == 12.5
    assert value(spark, text.parse_number("a", whole=True), a="12.9") == 12
    assert value(spark, text.parse_int("a"), a="1.5") is None
    assert value(spark, text.parse_int("a", truncate=True), a="1.5") == 1
    assert value(spark, text.strip_html("a"), a="<b>x &amp;lt; y</b>") == "x &lt; y"
    assert value(spark, text.identifier_text("a"), a="12.0") == "12"
    assert value(spark, text.board_text("a", "b"), a=8, b=6) == "8天6板"
    assert value(spark, text.board_text("a", "b"), a=0, b=6) is None
    assert value(spark, text.jsonp_body("a"), a='cb_1([1, {"a": 2}]);') == '[1, {"a": 2}]'
    assert value(spark, text.values_of("a"), a="a,b，c  d") == ["a", "b", "c", "d"]
    names = F.create_map(F.lit("T"), F.lit("all"), F.lit("T01"), F.lit("all"), F.lit("T0102"), F.lit("part"))
    assert value(spark, text.path_text("a", names, (1, 3, 5)), a="T0102") == "all / part"


def test_dates(spark):
    assert value(spark, dates.compact("a"), a="2024-01-02 09:30") == "20240102"
    assert value(spark, dates.compact("a"), a="2024-01") is None
    assert value(spark, dates.partial_date("a"), a="2024-01") == "202401"
    assert value(spark, dates.compact_if_dashed("a"), a="2024-1-02") == "2024-1-02"
    assert value(spark, dates.datetime_text("a"), a="2024-01-02 09:30") == "20240102093000"
    assert value(spark, dates.clock_text("a"), a="93005") == "09:30:05"
    assert [value(spark, dates.minute_label("a"), a=i) for i in (0, 119, 120, 239, -1)] == ["09:30", "11:29", "13:00", "14:59", None]
    assert value(spark, dates.is_true("a"), a="Yes") is True
    assert value(spark, dates.is_true("a"), a="0") is False


@settings(max_examples=15, deadline=None)
@given(prices=st.lists(st.floats(0.01, 500).map(lambda x: round(x, 2)), min_size=1, max_size=40))
def test_limits_equal_python(spark, prices):
    rows = spark.createDataFrame([(p, r) for p in prices for r in (5.0, 10.0, 20.0, 30.0)], "p double, r double")
    for row in rows.select("p", "r", limits.limit_up("p", "r").alias("up"), limits.limit_down("p", "r").alias("down")).collect():
        assert row.up == round(row.p * (1 + row.r / 100) + 1e-9, 2)
        assert row.down == round(row.p * (1 - row.r / 100) + 1e-9, 2)
