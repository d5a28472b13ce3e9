"""Datasets: what was declared or written, and what their files' footers say."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.dates import undashed
from tickloom.schema import TABLES
from tickloom.sources.layout import exists, table_files
from tickloom.sources.tables import scan_files


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, path, status, updated_at) of all logged runs."""
    rows = spark.read.text(f"{folder}/runs")
    return rows.select(*(F.get_json_object("value", f"$.{n}").alias(n) for n in ("dataset", "path", "status", "updated_at", "write_mode")))


def datasets(spark: SparkSession, root: str, runs: DataFrame | None = None, declared: Mapping[str, str] | None = None) -> DataFrame:
    """Each dataset's latest known entry, newest first; only what exists is listed."""
    entries = [(name, path, "declared", None) for name, path in (declared or {}).items()]
    for name in TABLES:
        try:
            table_files(spark, root, name)
            entries.append((name, f"{root}/core/{name}", "core", None))
        except FileNotFoundError:
            continue
    out = spark.createDataFrame(entries, "dataset string, path string, status string, updated_at string")
    if runs is not None:
        out = out.unionByName(runs.select(out.columns))
    newest = out.groupBy("dataset").agg(F.max_by(F.struct("path", "status", "updated_at"), F.struct(F.coalesce("updated_at", F.lit("")), F.coalesce("path", F.lit("")))).alias("e")).select("dataset", "e.*")
    # the catalog is as long as the list of datasets, so it is looked through on the driver
    kept = [r for r in newest.collect() if r.status == "core" or (r.path and exists(spark, r.path))]
    return spark.createDataFrame(kept, newest.schema).orderBy(F.col("updated_at").desc_nulls_last(), F.desc("dataset"))


def footer_stats(spark: SparkSession, paths: Sequence[str], date_field: str | None = None) -> DataFrame:
    """Rows and least and largest date, answered from Parquet footers: the plan shows PushedAggregation."""
    # a session of its own: other queries of the caller's plan meanwhile
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    columns = [F.count("*").alias("n_rows")] + ([F.min(date_field).alias("min_date"), F.max(date_field).alias("max_date")] if date_field else [])
    found = own.read.parquet(*paths).agg(*columns)
    return spark.createDataFrame([found.first()], found.schema)


def inspect(spark: SparkSession, root: str, table: str) -> dict:
    """A table's files, columns, rows and dates."""
    schema = TABLES[table]
    files = table_files(spark, root, table)
    df = scan_files(spark, files)
    day = undashed(schema.date_field) if schema.date_field in df.columns else F.lit(None).cast("string")
    row = df.agg(F.count("*").alias("n"), F.min(day).alias("low"), F.max(day).alias("high")).first()
    return {"table": table, "files": len(files.paths), "columns": df.columns, "rows": row.n, "date_min": row.low, "date_max": row.high, "key": list(schema.key)}
