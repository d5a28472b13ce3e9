"""Market-shaped views of the driver tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(column: str):
    return F.date_format(column, "yyyyMMdd")


# Daily bars: the events of a user are an instrument's ticks.
DAILY_SQL = """daily AS (
  SELECT user_id AS instrument, strftime(ts, '%Y%m%d') AS trade_date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close,
         count(*)::DOUBLE AS volume, sum(value) AS amount
  FROM events GROUP BY 1, 2)"""


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts are summed in the order of time: sums of parts, in the order they come in, end in other digits from run to run."""
    order = F.struct("ts", "event_id")
    ticks = load(spark, folder, "events").withColumns({"instrument": F.col("user_id"), "trade_date": day("ts")})
    # a window streams by and spills, however many ticks a day has
    so_far = Window.partitionBy("instrument", "trade_date").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ticks.withColumn("so_far_", F.sum("value").over(so_far))
        .groupBy("instrument", "trade_date")
        .agg(
            F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"),
            F.count("*").cast("double").alias("volume"), F.max_by("so_far_", order).alias("amount"),
        )
    )


# The calendar: days with orders of priority 1 are open, over all natural days from the first order to the last.
CALENDAR_SQL = """calendar AS (
  SELECT 'SSE' AS exchange, strftime(d, '%Y%m%d') AS cal_date,
         CASE WHEN d IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority LIKE '1%') THEN 1 ELSE 0 END AS is_open
  FROM (SELECT CAST(unnest(generate_series((SELECT CAST(min(o_orderdate) AS DATE) FROM orders), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d))"""


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    opened = orders.where("o_orderpriority like '1%'").select(day("o_orderdate").alias("cal_date")).distinct().withColumn("is_open", F.lit(1))
    span = orders.agg(F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high"))
    days = span.select(F.explode(F.sequence("low", "high")).alias("d")).select(day("d").alias("cal_date")).join(opened, "cal_date", "left")
    return days.select(F.lit("SSE").alias("exchange"), "cal_date", F.coalesce("is_open", F.lit(0)).alias("is_open"))


# Lifecycles: a customer's first and last order.
LIFE_SQL = """life AS (
  SELECT c_custkey AS instrument_id, c_name AS symbol, n_regionkey AS region, strftime(min(o_orderdate), '%Y%m%d') AS list_date,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE strftime(max(o_orderdate), '%Y%m%d') END AS delist_date
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3)"""


def life(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    rows = load(spark, folder, "customer").join(orders, "c_custkey", "left").join(load(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.select(
        F.col("c_custkey").alias("instrument_id"), F.col("c_name").alias("symbol"), F.col("n_regionkey").alias("region"),
        day("first").alias("list_date"), F.when(F.col("c_custkey") % 7 != 0, day("last")).alias("delist_date"),
    )


# Securities: parts with codes of five boards, names with flags, and quotes derived from size and price.
SECURITY_SQL = """security AS (
  SELECT p_partkey AS ordinal, [ 'sh600', 'sz000', 'sz300', 'sh688', 'bj830' ][(p_partkey % 5 + 1)::INT] || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS tdx_code,
         [ '', '*ST ', 'ST ', 'N', 'C', 'x ', 'y ', 'z ' ][(p_partkey % 8 + 1)::INT] || p_name AS name,
         p_retailprice AS pre_close, p_size AS size, p_name, p_type, p_brand, p_partkey
  FROM part)"""


def security(spark: SparkSession, folder: str) -> DataFrame:
    heads, flags = F.array(*map(F.lit, ("sh600", "sz000", "sz300", "sh688", "bj830"))), F.array(*map(F.lit, ("", "*ST ", "ST ", "N", "C", "x ", "y ", "z ")))
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("ordinal"),
        F.concat(F.get(heads, (F.col("p_partkey") % 5).cast("int")), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("tdx_code"),
        F.concat(F.get(flags, (F.col("p_partkey") % 8).cast("int")), F.col("p_name")).alias("name"),
        F.col("p_retailprice").alias("pre_close"), F.col("p_size").alias("size"), "p_name", "p_type", "p_brand", "p_partkey",
    )


# The ladder's stocks: levels by size, seals by price, sealed in two of three.
LADDER_SQL = """stocks AS (
  SELECT CAST(p_partkey AS VARCHAR) AS instrument_id, p_name AS name, p_size % 6 + 1 AS ladder_level,
         CASE WHEN p_partkey % 3 = 0 THEN 'touched' ELSE 'sealed' END AS limit_status, p_retailprice * 10 AS seal_amount, p_retailprice * 100 AS amount,
         p_partkey AS rank, '20240102' AS trade_date, CAST(p_size % 6 + 3 AS VARCHAR) || '天' || CAST(p_size % 6 + 1 AS VARCHAR) || '板' AS limit_board_text, p_partkey
  FROM part),
topics AS (
  SELECT CAST(p_partkey AS VARCHAR) AS instrument_id, w AS topic_name, 'T' || w AS topic_id, p_partkey * 10 + i AS ordinal, p_size / 10.0 AS relevance
  FROM (SELECT p_partkey, p_size, unnest(string_split(p_name, ' ') || [ p_type, 'MSCI ' || p_type ]) AS w, generate_subscripts(string_split(p_name, ' ') || [ p_type, 'MSCI ' || p_type ], 1) AS i FROM part)),
own AS (
  SELECT instrument_id, topic_name, min(ordinal) AS ordinal, arg_min(topic_id, ordinal) AS topic_id, arg_min(relevance, ordinal) AS relevance
  FROM topics WHERE topic_name NOT LIKE '%MSCI%' AND trim(topic_name) <> '' GROUP BY 1, 2)"""


def stocks(spark: SparkSession, folder: str) -> DataFrame:
    level = F.col("p_size") % 6
    return load(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("instrument_id"), F.col("p_name").alias("name"), (level + 1).alias("ladder_level"),
        F.when(F.col("p_partkey") % 3 == 0, "touched").otherwise("sealed").alias("limit_status"), (F.col("p_retailprice") * 10).alias("seal_amount"), (F.col("p_retailprice") * 100).alias("amount"),
        F.col("p_partkey").alias("rank"), F.lit("20240102").alias("trade_date"), F.format_string("%d天%d板", (level + 3).cast("int"), (level + 1).cast("int")).alias("limit_board_text"),
    )


def topics(spark: SparkSession, folder: str) -> DataFrame:
    words = F.concat(F.split("p_name", " "), F.array(F.col("p_type"), F.concat(F.lit("MSCI "), F.col("p_type"))))
    rows = load(spark, folder, "part").select("p_partkey", "p_size", F.posexplode(words).alias("i", "topic_name"))
    return rows.select(F.col("p_partkey").cast("string").alias("instrument_id"), "topic_name", F.concat(F.lit("T"), "topic_name").alias("topic_id"), (F.col("p_partkey") * 10 + F.col("i") + 1).alias("ordinal"), (F.col("p_size") / 10.0).alias("relevance"))


# Contracts: parts by brand and size, calls and puts by turns.
CONTRACT_SQL = """contracts AS (
  SELECT p_partkey AS ordinal, CAST(p_partkey AS VARCHAR) AS instrument_id, p_name AS symbol, p_brand AS product_code, p_type AS contract_month,
         CAST(p_size AS DOUBLE) AS strike_price, CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, p_retailprice AS last_price FROM part)"""


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("ordinal"), F.col("p_partkey").cast("string").alias("instrument_id"), F.col("p_name").alias("symbol"), F.col("p_brand").alias("product_code"),
        F.col("p_type").alias("contract_month"), F.col("p_size").cast("double").alias("strike_price"), F.when(F.col("p_partkey") % 2 == 0, "call").otherwise("put").alias("option_type"), F.col("p_retailprice").alias("last_price"),
    )


# Adjustment bars: the last close in milli of an instrument's days; actions: its returned line items.
BARS_SQL = """bars AS (
  SELECT instrument AS instrument_id, trade_date, CAST(round(close * 1000) AS BIGINT) AS last_close_milli FROM daily),
actions AS (
  SELECT l_partkey % 150 AS instrument_id, '202401' || lpad(CAST(l_suppkey % 31 + 1 AS VARCHAR), 2, '0') AS event_date, 1 AS category_raw,
         l_orderkey * 10 + l_linenumber AS ordinal, l_discount * 10 AS c1, 1.0 AS c2, l_tax * 20 AS c3, CAST(l_linenumber % 3 AS DOUBLE) AS c4
  FROM lineitem WHERE l_returnflag = 'R')"""


def bars(spark: SparkSession, folder: str) -> DataFrame:
    return daily(spark, folder).select(F.col("instrument").alias("instrument_id"), "trade_date", F.round(F.col("close") * 1000).cast("long").alias("last_close_milli"))


def actions(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").where("l_returnflag = 'R'")
    return rows.select(
        (F.col("l_partkey") % 150).alias("instrument_id"), F.concat(F.lit("202401"), F.lpad((F.col("l_suppkey") % 31 + 1).cast("string"), 2, "0")).alias("event_date"), F.lit(1).alias("category_raw"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), (F.col("l_discount") * 10).alias("c1"), F.lit(1.0).alias("c2"), (F.col("l_tax") * 20).alias("c3"), (F.col("l_linenumber") % 3).cast("double").alias("c4"),
    )
