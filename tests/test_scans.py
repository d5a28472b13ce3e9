"""Running values in pieces and days as bits, against windows and sets."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import adjust, daybits, joins, quality, scans


def hot_rows(n=900, seed=1):
    """Rows of which a third share a key, some have none."""
    rng = random.Random(seed)
    return [(rng.choice(["hot", None, *map(str, range(20))]) if i % 3 else "hot", i, rng.randrange(100)) for i in range(n)]


@pytest.mark.parametrize("pieces", [1, 7, 60])
def test_running_sums_in_pieces(spark, pieces):
    df = spark.createDataFrame(hot_rows(), "k string, t int, v int").repartition(5)
    got = scans.running_in_pieces(df, ["k"], [F.col("t")], {"total": F.col("v"), "n": F.lit(1)}, pieces)
    over = Window.partitionBy("k").orderBy("t")
    wanted = df.withColumns({"total": F.sum("v").over(over), "n": F.count("*").over(over)})
    assert got.columns == wanted.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_a_hot_key_is_spread_over_pieces(spark):
    df = spark.createDataFrame(hot_rows(3000), "k string, t int, v int")
    rows = scans.in_pieces(df, ["k"], [F.col("t")], 30)
    sizes = [r["count"] for r in rows.where("k = 'hot'").groupBy(scans.PIECE).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 400
    known = scans.carried(rows, ["k"], {"own": F.sum("v")}, {"before": lambda before, _: F.sum("own").over(before)})
    assert known.count() == 3000
    assert known.where("k = 'hot' and before is not null").count() >= 800


@pytest.mark.parametrize("pieces", [1, 9])
def test_asof_in_pieces(spark, pieces):
    rng = random.Random(2)
    left = spark.createDataFrame([(rng.choice(["a", "a", "b", "c", None]), rng.randrange(200), i) for i in range(400)], "k string, t int, i int")
    right = spark.createDataFrame([(rng.choice(["a", "b", "d", None]), rng.randrange(200), rng.randrange(9)) for _ in range(60)], "k string, u int, v int")
    got = scans.asof_in_pieces(left, right, ["k"], "t", "u", ["v"], pieces)
    wanted = joins.asof(left, right, ["k"], "t", "u", ["v"])
    assert got.columns == wanted.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


@pytest.mark.parametrize("pieces", [1, 8, 40])
def test_factors_in_pieces_equal_the_windows(spark, pieces):
    rng = random.Random(3)
    days = [f"2024{m:02d}{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    bars = [("hot", d, rng.randrange(900, 1100)) for d in days] + [(k, d, rng.choice([0, 1000, None, rng.randrange(900, 1100)])) for k in "abcdefgh" for d in rng.sample(days, 40)]
    events = [(rng.choice(["hot", "hot", *"abcz"]), rng.choice([*days, "20230101", "20250101", "20240230"]), rng.choice([1, 1, 1, 2]), i, rng.random() / 100, 1.0, rng.random() / 100, rng.random() / 100) for i in range(80)]
    bars = spark.createDataFrame(bars, "instrument_id string, trade_date string, last_close_milli long")
    events = spark.createDataFrame(events, "instrument_id string, event_date string, category_raw int, ordinal long, c1 double, c2 double, c3 double, c4 double")
    rounded = lambda df: sorted((r.instrument_id, r.trade_date, r.last_close_milli, r.pre_last_close_milli, round(r.hfq, 8), round(r.qfq, 8)) for r in df.collect())
    got, wanted = adjust.adjustment_factors_in_pieces(bars, events, pieces=pieces), adjust.adjustment_factors(bars, events)
    assert got.columns == wanted.columns
    assert rounded(got) == rounded(wanted)


def test_days_as_words(spark):
    rng = random.Random(4)
    first = date(1969, 10, 1)
    days = {k: {first + timedelta(rng.randrange(400)) for _ in range(rng.randrange(1, 90))} for k in "abc"}
    rows = [(k, d.strftime("%Y%m%d" if rng.random() < 0.5 else "%Y-%m-%d")) for k, own in days.items() for d in own for _ in (0, 1)] + [("a", "20240230"), ("a", None), ("d", "x")]
    words = daybits.day_words(spark.createDataFrame(rows, "k string, d string"), ["k"], "d")
    back = defaultdict(set)
    for r in daybits.spelt(words, "word", "bits").collect():
        back[r.k].add(r.d)
    assert back == {k: {d.strftime("%Y%m%d") for d in own} for k, own in days.items()}
    firsts = words.groupBy("k").agg(daybits.day_text(F.min(daybits.first_day(F.col("word"), F.col("bits")))).alias("d"), F.sum(F.bit_count("bits")).alias("n"))
    assert {r.k: (r.d, r.n) for r in firsts.collect()} == {k: (min(own).strftime("%Y%m%d"), len(own)) for k, own in days.items()}
    # every word within every span of days
    spans = spark.range(-3, 4).select(F.col("id").alias("word")).crossJoin(spark.range(-130, 140, 7).select(F.col("id").cast("int").alias("low"))).crossJoin(spark.createDataFrame([(n,) for n in (0, 1, 62, 63, 64, 200)], "more int"))
    for r in spans.withColumn("high", F.col("low") + F.col("more")).withColumn("bits", daybits.within("word", "low", "high")).collect():
        assert r.bits & (2**64 - 1) == sum(1 << i for i in range(64) if r.low <= r.word * 64 + i <= r.high)


def test_symbol_coverage_equals_sets(spark):
    """Symbols of two exchanges and of none, over a calendar with gaps, suspended on some days."""
    rng = random.Random(5)
    days = [(date(2023, 1, 1) + timedelta(i)).strftime("%Y%m%d") for i in range(500)]
    cal = [(e, d, rng.random() < 0.7) for e in ("SSE", "SZSE", "ALL") for d in days]
    held = {s: set(rng.sample(days, rng.randrange(1, 200))) for s in ("600000.SH", "600001.SH", "000001.SZ", "830000.BJ", "odd")}
    halted = {s: set(rng.sample(days, 100)) for s in ("600000.SH", "000001.SZ", "unknown.SH")}
    table = lambda sets: spark.createDataFrame([(s, d) for s, own in sets.items() for d in own], "s string, d string")
    calendar = spark.createDataFrame(cal, "exchange string, cal_date string, is_open boolean")
    opened = {e: {d for x, d, o in cal if o and x == e} for e in ("SSE", "SZSE", "ALL")}
    anywhere = set.union(*opened.values())
    wanted = set()
    for s, own in held.items():
        due = opened["SSE"] if s.endswith("SH") else opened["SZSE"] if s.endswith("SZ") else anywhere
        wanted |= {(s, d, d in halted.get(s, ())) for d in due - own if min(own) <= d <= max(own)}
    got = [tuple(r) for r in quality.symbol_coverage(table(held), calendar, "s", "d", table(halted)).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted
    counts = {(r.symbol, r.explained): (r.n_days, r.first_day) for r in quality.symbol_gap_counts(table(held), calendar, "s", "d", table(halted)).collect()}
    keys = {(s, e) for s, _, e in wanted}
    assert counts == {k: (len(own := [d for s, d, e in wanted if (s, e) == k]), min(own)) for k in keys}
    assert not quality.symbol_coverage(table({}), calendar, "s", "d").collect()
