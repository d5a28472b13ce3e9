"""Composite operators against known cases."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import adjust, aggregates, bars, calendar, filters, joins, ladder, options, quality, ranking, reshape, snapshot


def test_adjustment_factors(spark):
    rows = spark.createDataFrame([("a", "20240531", 9000), ("a", "20240603", 10000)], "instrument_id string, trade_date string, last_close_milli long")
    events = spark.createDataFrame([("a", "20240601", 1, 1, 1.0, 0.0, 2.0, 0.0), ("a", "20240601", 2, 2, 9.0, 0.0, 9.0, 0.0)], "instrument_id string, event_date string, category_raw int, ordinal long, c1 double, c2 double, c3 double, c4 double")
    out = adjust.adjustment_factors(rows, events).orderBy("trade_date").collect()
    assert [r.qfq for r in out] == [0.825, 1.0]
    assert [r.hfq for r in out] == [1.0, 1.2121212121]
    anchored = adjust.selected(adjust.adjustment_factors(rows, events), "qfq", "2024-05-31").orderBy("trade_date").collect()
    assert [r.adj_factor for r in anchored] == [1.0, 1.2121212121]
    with pytest.raises(ValueError):
        adjust.selected(rows, "hfq", "20240531")
    with pytest.raises(Exception, match="no usable factor"):
        adjust.selected(adjust.adjustment_factors(rows, events), "qfq", "20200101").collect()


def test_last_event_of_a_bar_counts(spark):
    rows = spark.createDataFrame([("a", "20240603", 10000)], "instrument_id string, trade_date string, last_close_milli long")
    events = spark.createDataFrame([("a", "20240601", 1, 1, 9.0, 0.0, 0.0, 0.0), ("a", "20240602", 1, 2, 1.0, 0.0, 2.0, 0.0)], "instrument_id string, event_date string, category_raw int, ordinal long, c1 double, c2 double, c3 double, c4 double")
    assert adjust.adjustment_factors(rows, events).first().pre_last_close_milli == 8250


def test_ex_rights_close_is_cut_towards_zero(spark):
    row = spark.createDataFrame([(10, 100.0, 0.0, 0.0, 0.0)], "last long, a double, b double, c double, d double").select(adjust.ex_rights_close("last", "a", "b", "c", "d").alias("x")).first()
    assert row.x == -9990


def test_calendar_neighbours(spark):
    days = [("SSE", d, d not in ("20260619", "20260620", "20260621")) for d in ("20260616", "20260617", "20260618", "20260619", "20260620", "20260621", "20260622")]
    out = {r.cal_date: (r.pretrade_date, r.next_trade_date) for r in calendar.neighbours(spark.createDataFrame(days, "exchange string, cal_date string, is_open boolean")).collect()}
    assert out["20260617"] == ("20260616", "20260618")
    assert out["20260618"] == ("20260617", "20260622")
    assert out["20260619"] == ("20260618", "20260622")
    assert calendar.padded("20240131", "2024-03-31") == ("20231231", "20240430")


def test_market_dates(spark):
    cal = spark.createDataFrame([("SSE", f"2024010{i}", i in (2, 3, 4)) for i in range(1, 7)], "exchange string, cal_date string, is_open boolean")
    ask = lambda now: tuple(calendar.market_dates(cal, now).first())
    assert ask("202401031000") == ("trading", "20240103", "20240102")
    assert ask("202401030800") == ("pre_auction", "20240102", None)
    assert ask("202401061000") == ("closed", "20240104", "20240103")
    assert ask("202402011000")[0] == "unconfirmed"


def test_lifecycle(spark):
    rows = [("600000.SH", "SSE", "19991110", None), ("600001.SH", "SSE", "19980122", "20091229"), ("688001.SH", "SSE", "20190722", None), ("000001.SZ", "SZSE", None, None), ("000005.SZ", "SZSE", "19901210", "20240426"), ("300999.SZ", "SZSE", "20250101", None), ("920000.BJ", "BSE", "20230101", None), (None, "SSE", None, None)]
    life = spark.createDataFrame([(*r, (r[0] or "")[:6], i) for i, r in enumerate(rows)], "instrument_id string, exchange string, list_date string, delist_date string, symbol string, ordinal int")
    out = joins.historical_list(spark.createDataFrame([("20240102",)], "trade_date string"), life, "ordinal")
    assert [r.instrument_id for r in out.collect()] == ["600000.SH", "688001.SH", "000001.SZ", "000005.SZ", "920000.BJ"]


def test_asof(spark):
    left = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1)], "k string, t int")
    right = spark.createDataFrame([("a", 5, "x"), ("a", 6, "y")], "k string, s int, v string")
    got = lambda **o: [r.v for r in joins.asof(left, right, ["k"], "t", "s", ["v"], **o).orderBy("k", "t").collect()]
    assert got() == ["x", "y", None]
    assert got(strict=True) == [None, "y", None]
    assert got(forward=True) == ["x", None, None]


TOPICS = [("000001.SZ", "机器人", "T1", 1, 2.0), ("000001.SZ", "银行", "T2", 2, 1.0), ("000001.SZ", "MSCI中国", "T9", 3, 9.0), ("000001.SZ", "机器人", "T1", 4, 2.0), ("000002.SZ", "机器人", "T1", 5, 1.0), ("000002.SZ", "地产", "T3", 6, 1.0), ("000002.SZ", "融资融券", "T8", 7, 1.0)]


def stocks(spark):
    rows = [("000001.SZ", "平安银行", 4, "sealed", "8天6板", 8_000_000.0, 100_000_000.0, 1, "20240102"), ("000002.SZ", "万科A", 1, "sealed", "4天2板", 800_000.0, 96_400_000.0, 2, "20240102")]
    return spark.createDataFrame(rows, "instrument_id string, name string, ladder_level int, limit_status string, limit_board_text string, seal_amount double, amount double, rank int, trade_date string")


def test_theme_rank(spark):
    topics = spark.createDataFrame(TOPICS, "instrument_id string, topic_name string, topic_id string, ordinal int, relevance double")
    out = ladder.theme_rank(stocks(spark), topics).orderBy("rank").collect()
    assert [(r.topic_name, r.theme_strength_score) for r in out] == [("机器人", 245.0), ("银行", 145.0), ("地产", 110.0)]
    assert (out[0].leader_instrument_id, out[0].leader_ladder_level, out[0].seal_amount_sum, out[0].amount_sum) == ("000001.SZ", 4, 8_800_000.0, 196_400_000.0)
    assert out[0].top_stock_summary == "平安银行（8天6板） 万科A（4天2板）"


def test_themes_of_a_stock(spark):
    topics = spark.createDataFrame(TOPICS, "instrument_id string, topic_name string, topic_id string, ordinal int, relevance double")
    row = ladder.with_themes(stocks(spark), topics).where("instrument_id = '000001.SZ'").first()
    assert (row.primary_theme, row.secondary_themes, row.top_theme_names, row.theme_count) == ("机器人", "银行", "机器人、银行", 2)


def test_limit_ladder(spark):
    row = ("sz000001", "000001.SZ", "平安银行", 10.0, 11.0, 11.0, 11.0, 5_000.0, "20240101", "20240102", 3, 7, 5, 20, 100.0, 1, 1000.0, 10.0)
    names = "tdx_code string, instrument_id string, name string, pre_close double, last_price double, high double, bid1_price double, locked_amount double, stats_date string, trade_date string, limit_up_streak_days int, limit_stat_days int, limit_up_count_in_stat_days int, year_limit_up_days int, free_float_shares_10k double, rank int, amount double, change_pct double"
    other = ("sz300001", "300001.SZ", *row[2:])
    st = ("sz000002", "000002.SZ", "ST x", *row[3:])
    topics = spark.createDataFrame(TOPICS, "instrument_id string, topic_name string, topic_id string, ordinal int, relevance double")
    out = ladder.limit_ladder(spark.createDataFrame([row, other, st], names), topics, 10).collect()
    assert [(r.instrument_id, r.ladder_level, r.limit_board_text, r.year_limit_up_days, r.seal_amount, r.primary_theme) for r in out] == [("000001.SZ", 4, "8天6板", 21, 5000.0, "机器人")]
    assert len(out[0]) == 19
    with pytest.raises(ValueError):
        ladder.limit_ladder(spark.createDataFrame([row], names), topics, 501)


def test_stats_alignment(spark):
    day = lambda s, t="20240103", p="20240102": spark.range(1).select(snapshot.stats_alignment(F.lit(t), F.lit(p), F.lit(s)).alias("x")).first().x
    assert [day("20240103"), day("20240102"), day("20231229"), day(None), day("20240103", "")] == ["same_day", "previous_trading_day", "stats_date_unaligned", "stats_row_missing", "trade_date_unavailable"]


def test_realised_volatility(spark):
    rows = spark.createDataFrame([("x", 1, 3000.0), ("x", 2, 3000.0 * 2.718281828459045**0.0006506181101336204), ("y", 1, 5.0), ("z", 1, -1.0), ("z", 2, 2.0)], "s string, t int, c double")
    out = bars.realised_volatility(rows, ["s"], "t", "c").collect()
    assert [r.s for r in out] == ["x"]
    assert out[0].realized_variance == pytest.approx(4.2330392523384376e-07, rel=1e-6)


@pytest.mark.parametrize(("given", "name"), [("1m", "1m"), ("5min", "5m"), ("1d", "day"), ("Day", "day"), ("3d", "3d"), ("45s", "45s"), ("1h", "60m"), ("week", "week")])
def test_period(given, name):
    assert bars.period(given) == name


@pytest.mark.parametrize("given", ["", "0m", "1441m", "61s", "366d", "x"])
def test_no_period(given):
    with pytest.raises(ValueError):
        bars.period(given)


def test_option_chain(spark):
    contracts = spark.createDataFrame([("c1", "c1", "cu", "2401", 10000.0, "call", 1), ("p1", "p1", "cu", "2401", 10000.0, "put", 2), ("c2", "c2", "cu", "2401", 11000.0, "call", 3)], "instrument_id string, symbol string, product_code string, contract_month string, strike_price double, option_type string, ordinal int")
    quotes = spark.createDataFrame([("c1", 5.0), ("p1", 6.0)], "instrument_id string, last_price double")
    out = options.chain(contracts, quotes, ["last_price"]).collect()
    assert [(r.strike_price, r.call_last_price, r.put_last_price, r.put_instrument_id) for r in out] == [(10000.0, 5.0, 6.0, "p1"), (11000.0, None, None, None)]


def test_order_book(spark):
    quotes = spark.createDataFrame([("a", 10.0, 5)], "k string, bid1_price double, bid1_volume int")
    out = snapshot.order_book(quotes, ["k"]).collect()
    assert [r.level for r in out] == [1, 2, 3, 4, 5]
    assert (out[0].bid_price, out[0].bid_volume, out[0].ask_price, out[4].bid_price) == (10.0, 5, None, None)


def test_dominant_takes_the_largest_of_a_tie(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "d string")
    assert tuple(aggregates.dominant(df, "d").first())[:3] == ("b", 1, 2)


CAL = [("SSE", d, 1) for d in ("20240102", "20240103", "20240104")]


def test_calendar_gap(spark):
    data = spark.createDataFrame([("000001.SZ", "20240102"), ("000001.SZ", "20240104")], "s string, d string")
    cal = spark.createDataFrame([(e.replace("SSE", "SZSE"), *r) for e, *r in CAL], "exchange string, cal_date string, is_open int")
    row = quality.calendar_coverage(data, cal, "d").first()
    assert (row.status, row.n_expected, row.n_actual, row.n_missing, row.missing_samples) == ("warn", 3, 2, 1, ["20240103"])
    assert [tuple(r) for r in quality.symbol_coverage(data, cal, "s", "d").collect()] == [("000001.SZ", "20240103", False)]
    halted = spark.createDataFrame([("000001.SZ", "20240103")], "s string, d string")
    assert quality.symbol_coverage(data, cal, "s", "d", halted).first().explained is True


def test_extra_day_is_an_error(spark):
    cal = spark.createDataFrame(CAL, "exchange string, cal_date string, is_open int")
    row = quality.calendar_coverage(spark.createDataFrame([("20240106",)], "d string"), cal, "d").first()
    assert (row.status, row.n_extra) == ("error", 1)
    report = quality.evaluate(spark.createDataFrame([("a", "20240106")], "k string, d string"), ["k"], date="d")
    assert report["calendar"]["reason"] == "calendar_unavailable"
    assert report["status"] == "warn"


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "a int, b string")
    assert quality.key_check(df, ["a"])["n_duplicate_rows"] == 2
    assert quality.key_check(df, ["b"])["status"] == "missing_value"
    assert quality.key_check(df, ["c"])["status"] == "missing"
    assert quality.schema_check(df, ["a", "z"], ["a"])["status"] == "error"


def test_resource_checks(spark):
    one = spark.createDataFrame([(0, str(i), "20240102") for i in range(20)], "market_id int, code string, stats_date string")
    assert quality.resource_checks(one, one, least=10) == []
    assert quality.resource_checks(one, one.limit(5), least=10) != []


def test_noise(spark):
    df = spark.createDataFrame([("机器人",), ("msci中国",), (" ",), (None,), ("融资融券标的",)], "t string")
    assert [r.t for r in df.where(~filters.is_noise("t")).collect()] == ["机器人"]


def test_json_items(spark):
    df = spark.createDataFrame([('[{"a": "x"}, ["y", "z"]]',)], "j string")
    assert [r.a for r in reshape.json_items(df, "j", {"a": 0}).orderBy("item_index").collect()] == ["x", "y"]


def test_pennies(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", None), ("ST c", 5.0), ("d", 2.0)], "name string, last_price double")
    assert sorted(r.name for r in filters.without_pennies(df).collect()) == ["b", "d"]


def test_numbers_over_all_rows(spark):
    from tickloom.operators.ranking import numbered

    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    assert {(r.v, r["rank"]) for r in numbered(rows, [F.desc("v")], start=10).collect()} == {(v, 5010 - v) for v in range(5000)}
    assert numbered(rows.limit(0), [F.asc("v")]).count() == 0


def test_action_categories(spark):
    df = spark.createDataFrame([(1,), (5,), (15,), (None,)], "category_raw int")
    assert [r[0] for r in filters.by_category(df, ["XDXR", "5"]).collect()] == [1, 5]
    assert filters.by_category(df, []).count() == 4
    assert filters.by_category(df, [0]).count() == 1
    with pytest.raises(ValueError):
        filters.by_category(df, ["odd"])


def test_rank_masks():
    assert filters.rank_mask(["ST", "star", "0x10", 1]) == 23
    assert filters.rank_mask([]) == 0
    for wrong in (["odd"], [70_000]):
        with pytest.raises(ValueError):
            filters.rank_mask(wrong)


@pytest.mark.parametrize("parts", [4, 8, 64])
def test_numbered_counts_every_row_once(spark, parts):
    """With several columns, which a plan may prune apart, and ties that only the last key decides."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
        got = ranking.numbered(orders, [F.col("o_orderstatus"), F.desc("o_custkey"), F.col("o_orderkey")], start=5, name="place").collect()
        wanted = sorted(got, key=lambda r: (r.o_orderstatus, -r.o_custkey, r.o_orderkey))
        assert [r.place for r in wanted] == list(range(6, 6 + orders.count()))
        assert ranking.numbered(orders.limit(0), [F.col("o_orderkey")]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_positional_pairs_of_large_tables(spark):
    left = spark.range(5000).select((F.col("id") * 7 % 5000).alias("a"), F.lit("x").alias("pad"))
    right = spark.range(4000).select((F.col("id") * 3 % 4001 + 10).alias("b"), F.lit(1).alias("more"))
    order = sorted(r.b for r in right.collect())
    for r in joins.positional(left, right, "a", "b").collect():
        assert r.b == (order[r.a] if r.a < 4000 else None)


def test_theme_leaders_are_the_five_best(spark):
    rows = [(str(i), f"s{i}", i % 7, "sealed", float(i % 11), 1.0, i, "20240102", "b") for i in range(300)]
    stocks = spark.createDataFrame(rows, "instrument_id string, name string, ladder_level int, limit_status string, seal_amount double, amount double, rank int, trade_date string, limit_board_text string")
    topics = stocks.select("instrument_id", F.lit("all").alias("topic_name"), F.lit("T").alias("topic_id"), F.col("rank").alias("ordinal"))
    best = sorted(rows, key=lambda r: (-r[2], -r[4], r[6]))[:5]
    got = ladder.theme_rank(stocks, topics).first()
    assert got.leader_instrument_id == best[0][0]
    assert [w.split("（")[0] for w in got.top_stock_summary.split(" ")] == [r[1] for r in best]
    assert ladder.theme_rank(stocks, topics, 1).first().rank == 1
