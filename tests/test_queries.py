"""Every registered query against its SQL, and the driver's entry points."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, same
from tickloom.plans import lake, market


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(market.SQL))
def test_query_equals_sql(spark, con, data, name):
    same(spark, con, data, market.QUERIES[name], market.SQL[name])


def test_every_query_has_sql():
    assert set(lake.QUERIES) == set(lake.SQL) == set(market.SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_is_only_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scan_pushes_down_and_prunes(spark, data):
    plan = market.q_pushdown_scan(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan
    assert "l_tax" not in plan.split("ReadSchema")[1]


def test_query_table_prunes_by_the_stored_date(spark, tmp_path):
    from tickloom.sources.tables import query_table

    rows = [("a", "20240102"), ("b", "2024-01-02"), ("c", "2024-0103"), ("d", "20240105"), ("e", "2023-12-31"), ("f", None)]
    spark.createDataFrame(rows, "ts_code string, trade_date string").write.parquet(f"{tmp_path}/core/daily.parquet")
    df = query_table(spark, "daily", str(tmp_path), None, ["ts_code"], "2024-01-02", "20240103")
    assert sorted(r.ts_code for r in df.collect()) == ["a", "b", "c"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_date,2024-01-02)" in plan
    assert "LessThanOrEqual(trade_date,202" in plan
