"""Explodes, levels and unions of nested rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked_items(df: DataFrame, column: str) -> DataFrame:
    """Items of a nested list with their place from 1."""
    return df.select(*(c for c in df.columns if c != column), F.posexplode(column).alias("rank", "item")).withColumn("rank", F.col("rank") + 1)


def json_items(df: DataFrame, column: str, fields: Mapping[str, int]) -> DataFrame:
    """Items of a JSON list whose shape is an object with these fields, or a list with them in these places."""
    items = df.select("*", F.posexplode(F.from_json(column, "array<string>")).alias("item_index", "item_"))
    as_list = F.from_json("item_", "array<string>")
    get = {n: F.coalesce(F.when(F.col("item_").startswith("["), F.get(as_list, i)), F.when(F.col("item_").startswith("{"), F.get_json_object("item_", f"$.{n}"))) for n, i in fields.items()}
    return items.withColumns(get).drop("item_")


def map_rows(df: DataFrame, column: str) -> DataFrame:
    return df.select(*(c for c in df.columns if c != column), F.explode(column).alias("key", "value"))


def json_map_rows(df: DataFrame, column: str) -> DataFrame:
    """Entries of a JSON object of texts, one a row."""
    return map_rows(df.withColumn("map_", F.from_json(column, "map<string,string>")).drop(column), "map_")


def code_levels(df: DataFrame, code: str, by: list[str] | None = None) -> DataFrame:
    """A code's level by its length among all lengths, from 0."""
    lengths = df.select(*(by or []), F.length(code).alias("length_")).distinct()
    ranked = lengths.withColumn("level", F.dense_rank().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("length_")) - 1)
    return df.withColumn("length_", F.length(code)).join(F.broadcast(ranked) if not by else ranked, [*(by or []), "length_"]).drop("length_")


def staged_union(tables: Mapping[str, DataFrame], progress: str = "progress", defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Tables of the same kind under each other, with their stage and a default progress."""
    out = None
    for stage, df in tables.items():
        now = F.col(progress) if progress in df.columns else F.lit(None).cast("string")
        df = df.withColumns({"stage": F.lit(stage), progress: F.coalesce(now, F.lit((defaults or {}).get(stage)))})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
