"""Queries against their SQL on small tables that the driver's don't hold: far days, zero prices, entities."""

import datetime
import random

import duckdb
from pyspark.sql import functions as F

from tests.oracle import rows
from tickloom.functions import money
from tickloom.operators import quality
from tickloom.plans import lake, market
from tickloom.plans import views as v


def differing(spark, folder, name, sql, **tables):
    """The rows of a query over these tables, held against its SQL."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    got = market.QUERIES[name](spark, str(folder)).toPandas()
    assert rows(got) == rows(con.sql(sql).df())
    return got


def test_days_after_the_year_9999(spark, tmp_path):
    ids = spark.range(2_932_895, 2_932_900).selectExpr("id as event_id").union(spark.range(36_000_000, 36_000_001)).union(spark.range(2))
    got = differing(spark, tmp_path, "q_epoch_clock", market.SQL["q_epoch_clock"], events=ids)
    assert {"99991231", "100000101", "1005340827", "19700101"} <= set(got.d)


def ticks(spark, *of):
    """Events of (user, day of January 2024, value), a second apart."""
    made = [(i, u, d, float(x)) for i, (u, d, x) in enumerate(of)]
    return spark.createDataFrame(made, "event_id long, user_id long, d int, value double").selectExpr("event_id", "cast(timestamp_seconds(1704067200 + (d - 1) * 86400 + event_id) as timestamp_ntz) as ts", "user_id", "'view' as event_type", "value", "'{}' as props")


def test_change_from_a_zero_price(spark, tmp_path):
    events = ticks(spark, (1, 1, 0), (1, 2, 5), (1, 3, 4), (2, 1, 0), (2, 2, 0), (2, 3, 1), (3, 1, 2), (3, 2, 3))
    got = differing(spark, tmp_path, "q_pct_change", market.SQL["q_pct_change"], events=events)
    assert sorted(got.pct.dropna()) == [-20.0, 50.0, float("inf"), float("inf")]


def test_zero_from_zero_is_no_number(spark):
    row = spark.range(1).select(F.isnan(money.percent_change(F.lit(0.0), F.lit(0.0), money.float_divide)).alias("x"), money.percent_change(F.lit(-1.0), F.lit(0.0), money.float_divide).alias("y"), money.percent_change(F.lit(None), F.lit(0.0), money.float_divide).alias("z")).first()
    assert (row.x, row.y, row.z) == (True, float("-inf"), None)


def test_a_title_keeps_all_entities_but_the_ampersand(spark, tmp_path):
    html = ["<h1> a &amp; <b>b</b> </h1>", "<h1>x = &quot;y&quot; &lt;z&gt; &#39;&apos;&nbsp;</h1>", "<h1>&amp;quot;</h1>", "<h1>\n<i></i></h1>", "<h1> </h1>", "<p>none</p>", None]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    got = differing(spark, tmp_path, "q_strip_html", market.SQL["q_strip_html"], pages=pages)
    assert {"a & b", "x = &quot;y&quot; &lt;z&gt; &#39;&apos;&nbsp;", "&quot;"} <= set(got.title)


def test_amounts_are_summed_in_the_order_of_time(spark, tmp_path):
    # 100 in one order, a bit less or more in others
    parts = [(33.34, 14.26, 52.4), (66.6, 33.3, 0.1), (0.1, 99.2, 0.7), (70.1, 0.2, 29.7), (0.7, 0.1, 99.2)] + [tuple(round(x + k / 100, 2) for x in (31.0, 41.1, 27.9)) for k in range(60)]
    events = ticks(spark, *((u, 1, x) for u, of in enumerate(parts) for x in of))
    # each user's ticks lie in three files, the last of them first
    events.repartition(3, F.col("event_id") % 3).sortWithinPartitions(F.desc("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    wanted = {u: (a + b) + c for u, (a, b, c) in enumerate(parts)}
    # other orders make other numbers of this
    assert sum(w != a + (b + c) for w, (a, b, c) in zip(wanted.values(), parts, strict=True)) > 3
    assert {r.instrument: r.amount for r in v.daily(spark, str(tmp_path)).collect()} == wanted
    few = sum(w - 100 < 0 for w in wanted.values())
    assert {r.rule: r.n for r in market.QUERIES["q_quality_rules"](spark, str(tmp_path)).collect()}["negative_amount"] == few
    assert lake.QUERIES["q_quality_report"](spark, str(tmp_path)).first().n_negative == few


def test_missing_days_are_counted_without_spelling_them_out(spark, tmp_path):
    rng = random.Random(5)
    made = [(i, rng.randrange(12), datetime.datetime(1995, 1, 1) + datetime.timedelta(days=rng.choice([rng.randrange(20), rng.randrange(60, 200), rng.randrange(900)])), rng.choice("12")) for i in range(150)]
    orders = spark.createDataFrame(made, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string")
    got = differing(spark, tmp_path, "q_symbol_missing_days", market.SQL["q_symbol_missing_days"], orders=orders)
    assert len(got) > 40
    # ranges meet days as blocks: no day of a symbol is ever a row
    plan = market.q_symbol_missing_days(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "getbit" not in plan


def test_missing_days_equal_the_days_spelt_out(spark):
    rng = random.Random(6)
    day = lambda k: (datetime.date(2020, 1, 1) + datetime.timedelta(days=k)).strftime("%Y%m%d")
    rows = [(f"{n:03d}.{rng.choice(['SH', 'SZ', 'XX'])}", day(rng.randrange(400))) for n in range(9) for _ in range(6)] + [("000.SH", "no date"), ("001.SZ", None)]
    held = spark.createDataFrame([(s, d) for n, (s, d) in enumerate(rows)], "symbol string, d string")
    calendar = spark.createDataFrame([(e, day(k), int(rng.random() < share)) for e, share in (("SSE", 0.7), ("SZSE", 0.5), ("ALL", 0.1)) for k in range(400)], "exchange string, cal_date string, is_open int")
    spelt = quality.symbol_coverage(held, calendar, "symbol", "d").groupBy("d").agg(F.count("*"), F.min("symbol")).collect()
    counted = quality.missing_day_counts(held, calendar, "symbol", "d", F.col("symbol")).collect()
    assert sorted(map(tuple, counted)) == sorted(map(tuple, spelt))


def test_outputs_hold_a_duckdb_file(spark, data):
    got = lake.QUERIES["q_write_outputs"](spark, data).collect()
    assert sorted(r.form for r in got) == ["csv", "duckdb", "jsonl", "parquet"]
    assert len({(r.n, r["keys"]) for r in got}) == 1
