"""Bucketed upserts against a map of keys."""

import random
import re

import pytest

from tickloom.sources import buckets, versions, writers

KIND = "k long, e string, v double"


@pytest.fixture
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_upserts(spark, tmp_path, no_broadcast):
    rng = random.Random(1)
    target, held = f"{tmp_path}/t", {}
    for step in range(3):
        rows = [(rng.randrange(300), rng.choice("ab"), float(step * 1000 + i)) for i in range(200)]
        result = buckets.upsert_bucketed(spark.createDataFrame(rows, KIND).repartition(3), target, ["k", "e"], 6, "v", batch=("s", step))
        before, held = len(held), held | {r[:2]: r for r in rows}
        assert (result.rows_before, result.rows_written, result.rows_after, result.duplicates_dropped) == (before, 200, len(held), before + 200 - len(held))
        assert sorted(map(tuple, buckets.read_bucketed(spark, target).collect())) == sorted(held.values())
    # a batch that comes again, and plain readers
    assert buckets.upsert_bucketed(spark.createDataFrame([(1, "a", -1.0)], KIND), target, ["k", "e"], batch=("s", 2)).rows_written == 0
    assert sorted(map(tuple, writers.read_written(spark, target).collect())) == sorted(held.values())
    assert versions.latest(spark, target).details["buckets"] == 6
    with pytest.raises(ValueError):
        buckets.upsert_bucketed(spark.createDataFrame([(1, "a", -1.0)], KIND), target, ["k"])
    with pytest.raises(ValueError):
        buckets.upsert_bucketed(spark.createDataFrame([(1, "a")], "k long, e string"), target, ["k", "e"])
    with pytest.raises(Exception, match="has no k"):
        buckets.upsert_bucketed(spark.createDataFrame([(None, "a", 1.0)], KIND), target, ["k", "e"])
    assert sorted(map(tuple, buckets.read_bucketed(spark, target).collect())) == sorted(held.values())


def test_old_rows_are_not_exchanged(spark, tmp_path, no_broadcast):
    target = f"{tmp_path}/t"
    buckets.upsert_bucketed(spark.range(1000).selectExpr("id AS k", "'a' AS e", "1.0D AS v"), target, ["k"], 5)
    old = buckets.read_bucketed(spark, target)
    new = spark.range(5, 2000, 7).selectExpr("id AS k", "'b' AS e", "2.0D AS v")
    merged = buckets.upserted_buckets(old, new, ["k"], 5)
    assert merged.count() == 1000 + sum(1 for k in range(5, 2000, 7) if k >= 1000)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # the one exchange is the one the new rows are dealt by, and the old side is scanned by bucket
    assert len(re.findall(r"Exchange hashpartitioning", plan.split("Initial Plan")[-1])) == 1
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 5 out of 5" in plan
