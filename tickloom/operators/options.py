"""Option chains: one wide row per strike."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIDES = ("call", "put")
KEYS = ["product_code", "contract_month", "strike_price"]


def first_strikes(contracts: DataFrame, n: int) -> DataFrame:
    """All contracts of the first n strikes of each product and month; a missing strike counts as 0."""
    order = Window.partitionBy("product_code", "contract_month").orderBy(F.coalesce("strike_price", F.lit(0.0)))
    return contracts.withColumn("r_", F.dense_rank().over(order)).where(F.col("r_") <= n).drop("r_")


def chain(contracts: DataFrame, quotes: DataFrame, values: list[str], key: str = "instrument_id", order: str = "ordinal") -> DataFrame:
    """A row per (product, month, strike) with call_ and put_ columns; a side without contract is null, a later contract wins."""
    rows = contracts.join(quotes.select(key, *values), key, "left")
    sides = [
        F.max_by(F.when(F.col("option_type") == s, F.col(v)), F.when(F.col("option_type") == s, F.col(order))).alias(f"{s}_{v}")
        for s in SIDES
        for v in [key, "symbol", *values]
    ]
    return rows.groupBy(*KEYS).agg(*sides).orderBy("product_code", "contract_month", F.coalesce("strike_price", F.lit(0.0)))
