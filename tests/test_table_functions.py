"""Table functions, pushed filters and bars of several periods."""

import random
from collections import defaultdict

import pytest

from tickloom.operators import bars
from tickloom.plans import lake
from tickloom.sources import gateway, table_functions

ASKED = "k long, n long, text string"


def numbers(params, offset=0, size=0):
    """A fetcher of the tests: rows of a year that pass the filters it is told, and say what it was told."""
    rows = [{"year": params["year"], "n": n, "told": f"{params.get('filters')} {params.get('sort')} {params.get('limit')}"} for n in range(6)]
    return [r for r in rows if all(gateway.holds(r[f], op, v) for f, op, v in params.get("filters", []))]


def entries(row):
    return [{"k": row["k"], "n": n, "text": None if n % 2 else "x"} for n in range(row["k"])]


@pytest.fixture
def ticks(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([True, False, None])) for i in range(200)]
    spark.createDataFrame(rows, "k string, t int, up boolean").repartition(3).createOrReplaceTempView("ticks_")
    table_functions.register(spark)
    return rows


def test_tail_rows(spark, ticks):
    got = spark.sql("SELECT k, t FROM tail_rows(TABLE(ticks_) PARTITION BY k ORDER BY t, n => 3)").collect()
    wanted = defaultdict(list)
    for k, t, _ in ticks:
        wanted[k].append(t)
    assert sorted(map(tuple, got), key=str) == sorted(((k, t) for k, ts in wanted.items() for t in sorted(ts)[-3:]), key=str)
    assert spark.sql("SELECT * FROM tail_rows(TABLE(ticks_) PARTITION BY k ORDER BY t, n => 0)").count() == 0
    with pytest.raises(Exception, match="number of rows"):
        spark.sql("SELECT * FROM tail_rows(TABLE(ticks_) PARTITION BY k, n => 'x')")


def test_streak_rows(spark, ticks):
    got = {r.t: r.streak for r in spark.sql("SELECT t, streak FROM streak_rows(TABLE(ticks_) PARTITION BY k ORDER BY t, flag => 'up')").collect()}
    run = defaultdict(int)
    for k, t, up in sorted(ticks, key=lambda r: r[1]):
        run[k] = run[k] + 1 if up else 0
        assert got[t] == run[k]
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM streak_rows(TABLE(ticks_) PARTITION BY k, flag => 'nothing')")


def test_entry_rows(spark):
    table_functions.register(spark)
    got = spark.sql(f"SELECT * FROM entry_rows(TABLE(SELECT id AS k FROM range(4)), entry => '{__name__}:entries', fields => '{ASKED}')")
    assert got.columns == ["k", "n", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, n, None if n % 2 else "x") for k in range(4) for n in range(k)), key=str)
    for entry, fields in (("nowhere", ASKED), (f"{__name__}:entries", "k decimal")):
        with pytest.raises(Exception, match="entry point|not a field"):
            spark.sql(f"SELECT * FROM entry_rows(TABLE(SELECT 1 AS k), entry => '{entry}', fields => '{fields}')")


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


SOURCE = gateway.Interface("numbers", f"{__name__}:numbers", {"year": "integer", "n": "integer", "told": "string"}, {"year": "array"}, filters=("n",), sorts=True)


def test_filters_reach_the_fetcher(spark):
    years = {"year": [2020, 2021, 2022]}
    rows = gateway.request(spark, SOURCE, years, fanout="year", where=[("n", ">=", 2), ("n", "in", [2, 3, 5]), ("year", ">", 2020)])
    assert sorted((r.year, r.n) for r in rows.collect()) == [(y, n) for y in (2021, 2022) for n in (2, 3, 5)]
    assert all("['n', '>=', 2]" in r.told and "['n', 'in', [2, 3, 5]]" in r.told and "year" not in r.told for r in rows.collect())
    assert "PushedFilters: [GreaterThanOrEqual(n,2), In(n, [2,3,5])]" in formatted(rows)
    # years outside are no partitions; no partition at all is one without rows
    assert rows.rdd.getNumPartitions() == 2
    assert gateway.request(spark, SOURCE, years, fanout="year", where=[("year", "=", 1999)]).count() == 0
    for wrong in (("nothing", "=", 1), ("n", "like", 1)):
        with pytest.raises(ValueError):
            gateway.request(spark, SOURCE, years, where=[wrong])


def test_filters_of_one_plan_hold_in_no_other(spark):
    """A reader is shared by the plans over a frame."""
    df = gateway.request(spark, SOURCE, {"year": [2020]}, fanout="year", where=[("n", "<", 5)])
    one, two, none = df.where("n = 1"), df.where("n = 4"), df.where("n = 2 and n >= 0")
    for plan in (one, two, none):
        plan._jdf.queryExecution().executedPlan()
    assert [[r.n for r in x.collect()] for x in (one, two, none)] == [[1], [4], [2]]
    assert sorted(r.n for r in one.unionByName(two).collect()) == [1, 4]
    assert [tuple(r) for r in one.alias("a").join(two.alias("b"), "year").select("a.n", "b.n").collect()] == [(1, 4)]
    assert sorted(r.n for r in df.collect()) == [0, 1, 2, 3, 4]


def test_order_and_limit_reach_the_fetcher(spark):
    df = gateway.request(spark, SOURCE, {"year": [2020, 2021]}, fanout="year", order=["n"], limit=3)
    rows = df.collect()
    assert len(rows) == 3 and all(r.told.endswith("['n'] 3") for r in rows)


def test_the_plan_of_a_table_source_shows_its_filters(spark, data):
    rows = lake.q_source_filters(spark, data)
    assert "GreaterThan(o_totalprice,200000.0)" in formatted(rows).split("PushedFilters")[1].split("\n")[0]


def test_holds():
    assert [gateway.holds(2, op, v) for op, v in (("=", 2), ("in", [1, 2]), (">", 2), (">=", 2), ("<", 3), ("<=", 1))] == [True, True, False, True, True, False]
    assert not gateway.holds(None, "=", None) and not gateway.holds(1, ">", None)


def test_bars_of_periods_equal_those_of_each(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), f"2024-{rng.randrange(1, 6):02d}-{rng.randrange(1, 29):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", rng.randrange(100), i) for i in range(500)]
    ticks = spark.createDataFrame(rows, "k string, t string, p int, i int").selectExpr("k", "to_timestamp(t) AS t", "p", "i")
    names = ["day", "60m", "week", "month", "year"]
    got = bars.ohlcv_of_periods(ticks, names, ["k"], "t", "p", "i")
    wanted = [(r.k, n, *tuple(r)[1:]) for n in names for r in bars.ohlcv(ticks, n, ["k"], "t", "p", "i").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Scan ExistingRDD") == 1
    with pytest.raises(ValueError):
        bars.ohlcv_of_periods(ticks, ["day", "3d"], ["k"], "t", "p", "i")


def test_functions_of_single_rows_take_no_frame_a_row(spark):
    # Arrow would make a batch of the answer to each row
    table_functions.register(spark)
    spark.range(10).selectExpr("id", "id % 2 = 0 as even").createOrReplaceTempView("numbers_of_test")
    for call in ("tail_rows(TABLE(numbers_of_test) PARTITION BY even ORDER BY id, n => 2)", "streak_rows(TABLE(numbers_of_test) PARTITION BY even ORDER BY id, flag => 'even')"):
        plan = spark.sql(f"SELECT * FROM {call}")._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPythonUDTF" in plan
        assert "ArrowEvalPythonUDTF" not in plan


def test_order_rows_hold_no_row_group(tmp_path):
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tickloom.plans import lake

    n = 1_500_000
    days = pa.array([datetime.datetime(1996 + k, 12, 31) for k in range(3)] * (n // 3))
    orders = pa.table({"o_orderkey": range(n), "o_custkey": range(n), "o_orderstatus": pa.array(["F", "O", "P"] * (n // 3)), "o_totalprice": pa.array([1.0] * n), "o_orderdate": days})
    pq.write_table(orders, tmp_path / "orders.parquet", row_group_size=n)
    del orders, days
    before, most, keys = pa.total_allocated_bytes(), 0, 0
    for k, row in enumerate(lake.order_rows({"path": str(tmp_path / "orders.parquet"), "year": 1997, "filters": [("o_orderstatus", "in", ["O", "P"])]})):
        keys += row["o_orderkey"]
        most = max(most, pa.total_allocated_bytes() - before) if k % 1000 == 0 else most
    assert (k + 1, keys) == (n // 3, sum(range(1, n, 3)))
    assert most < 16 << 20
