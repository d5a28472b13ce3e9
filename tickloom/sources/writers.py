"""Sinks and the five write modes.

``write`` makes a new version of a table (``sources/versions.py``), seen whole or not
at all.  Core tables and outputs are plain folders: written aside, then moved into
place in one step.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.functions.dates import compact
from tickloom.schema import table_schema
from tickloom.sources import versions
from tickloom.sources.tables import union_by_name
from tickloom.storage import stored

NULL_LABEL = "__null__"
MODES = ("snapshot", "append", "overwrite_partition", "replace_range", "upsert_by_key")


@dataclass
class WriteResult:
    rows_before: int
    rows_written: int
    rows_after: int
    duplicates_dropped: int = 0
    partitions: list[str] = field(default_factory=list)
    range_start: str | None = None
    range_end: str | None = None


def _move(spark: SparkSession, source: str, target: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(path(target)):
        system.delete(path(target), True)
    system.mkdirs(path(target).getParent())
    if not system.rename(path(source), path(target)):
        raise OSError(f"{source} can't be moved to {target}")


def _delete(spark: SparkSession, target: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, target: str, form: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write beside the target, then swap."""
    spark = df.sparkSession
    stage = f"{target.rstrip('/')}.staging-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if form == "csv":
        writer = writer.option("header", True).option("encoding", "UTF-8")
    writer.format("json" if form == "jsonl" else form).save(stage)
    _move(spark, stage, target)


def write_core_table(df: DataFrame, table: str, root: str) -> None:
    """Declared columns only, in declared order."""
    schema = table_schema(table)
    staged(df.select(*(c for c in schema.names if c in df.columns)), f"{root}/core/{schema.name}.parquet")


def write_outputs(df: DataFrame, folder: str, stem: str, forms: Sequence[str] = ("parquet",)) -> dict[str, str]:
    """The same rows in several formats, computed once; other formats than parquet are whole snapshots."""
    first = f"{folder}/parquet/{stem}.parquet"
    staged(df, first)
    again = df.sparkSession.read.schema(df.schema).parquet(first)
    out = {"parquet": first}
    for form in forms:
        if form not in ("parquet", "csv", "jsonl", "duckdb"):
            raise ValueError(f"unknown format {form}")
        if form == "duckdb":
            out[form] = f"{folder}/duckdb/{stem}.duckdb"
            write_duckdb(df.sparkSession, first, out[form], stem)
        elif form != "parquet":
            out[form] = f"{folder}/{form}/{stem}.{form}"
            staged(again, out[form], form)
    if "parquet" not in forms:
        _delete(df.sparkSession, first)
        del out["parquet"]
    return out


def write_duckdb(spark: SparkSession, parquet: str, target: str, table: str) -> None:
    """A DuckDB file with one table of a written Parquet folder's rows.

    DuckDB has one writer and a file of its own, so this is an export for one
    machine: the driver lets DuckDB read the Parquet files itself, in its own
    bounded memory, and rows never pass through Python.  The folder must be one
    that the driver sees as a path.
    """
    import os

    import duckdb

    local = [p.removeprefix("file:") for p in (parquet, target)]
    if any("://" in p for p in local):
        raise ValueError("a DuckDB file is written to a path that the driver sees")
    os.makedirs(os.path.dirname(local[1]), exist_ok=True)
    fresh = f"{local[1]}.staging-{uuid.uuid4().hex}"
    files = f"{local[0]}/*.parquet"
    with duckdb.connect(fresh) as db:
        db.execute("SET threads = 1")
        db.execute("SET memory_limit = '512MB'")
        name = '"' + table.replace('"', '""') + '"'
        db.execute(f"CREATE TABLE {name} AS SELECT * FROM read_parquet(?)", [files])
    os.replace(fresh, local[1])


def partition_label(column: Column) -> Column:
    """A partition's text: nulls as a name, slashes as underscores."""
    return F.coalesce(F.replace(column.cast("string"), F.lit("/"), F.lit("_")), F.lit(NULL_LABEL))


def is_flat(partition_by: Sequence[str], date_field: str | None) -> bool:
    """Files named by date stand for partitions by the date field alone."""
    return list(partition_by) == [date_field]


def partition_labels(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The labels touched, one a row."""
    parts = [F.concat(F.lit(f"{k}="), partition_label(F.col(k))) for k in partition_by]
    return df.select(F.concat_ws("/", *parts).alias("label")).distinct()


def key_text(column: Column, is_date: bool, legacy: bool = False) -> Column:
    """A key's text.  Dates are compacted; with ``legacy``, so is any text with eight digits, which merges a day's bars."""
    text = column.cast("string")
    return F.coalesce(compact(text), text) if is_date or legacy else text


def keep_last(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row a key, the last in order; the order has to be total."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(c.desc() for c in order)))
    return df.withColumn("rank_", rank).where("rank_ = 1").drop("rank_")


def keep_first(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_", rank).where("rank_ = 1").drop("rank_")


def upserted(old: DataFrame, new: DataFrame, key: Sequence[str], order: str | None = None, date_field: str | None = None, legacy_keys: bool = False) -> DataFrame:
    """Old and new rows, the new ones last, one a key.  ``order`` ranks rows within either side."""
    rank = F.col(order) if order else F.lit(0)
    both = union_by_name(old.withColumns({"side_": F.lit(0), "order_": rank}), new.withColumns({"side_": F.lit(1), "order_": rank if order in new.columns else F.lit(0)}))
    both = both.withColumns({k: key_text(F.col(k), k == date_field, legacy_keys) for k in key})
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in both.columns if c not in ("side_", "order_")))
    return keep_last(both, [F.col(k) for k in key], [F.col("side_"), F.col("order_"), tie]).drop("side_", "order_")


def range_replaced(old: DataFrame, new: DataFrame, date_field: str, start: str, end: str) -> DataFrame:
    """Old rows outside the dates, or without one, and all new rows."""
    if start > end:
        raise ValueError("the range starts after its end")
    day = compact(date_field)
    return union_by_name(old.where(day.isNull() | ~day.between(start, end)), new)


def _labelled(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.withColumns({f"part_{k}": partition_label(F.col(k)) for k in partition_by})


def _put(df: DataFrame, target: str, partition_by: Sequence[str]) -> tuple[str, ...]:
    if not partition_by:
        return versions.put(df, target)
    names = [f"part_{k}" for k in partition_by]
    # a partition's rows come together, a large one's in several tasks
    return versions.put(_labelled(df, partition_by).hint("rebalance", *names), target, names)


def _counted(df: DataFrame, date_field: str | None = None) -> tuple[DataFrame, Observation]:
    """Rows that are counted, and their dates bounded, by whatever job writes them."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    dates = [F.min(compact(date_field)).alias("low"), F.max(compact(date_field)).alias("high")] if date_field else []
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *dates), seen


def _same_kinds(old: StructType, new: StructType) -> bool:
    kinds = {f.name: f.dataType for f in new.fields}
    return all(kinds.get(f.name, f.dataType) == f.dataType for f in old.fields)


def _united(old: StructType, new: StructType) -> StructType:
    known = set(old.names)
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in [*old.fields, *(f for f in new.fields if f.name not in known)]])


def write(
    df: DataFrame,
    target: str,
    mode: str = "snapshot",
    key: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    date_field: str | None = None,
    start: str | None = None,
    end: str | None = None,
    order: str | None = None,
    legacy_keys: bool = False,
    batch: tuple[str, int] | None = None,
) -> WriteResult:
    """Write rows as the next version of a table, in one of MODES.

    The rows are evaluated once, and what is reported is counted by the jobs that
    write.  Files that hold no row that goes are taken over as they are; the others
    are written anew beside them.  A target that was a plain Parquet folder becomes
    the first version's files.  ``batch`` names a stream and a batch of it: one that
    the table holds already changes nothing.
    """
    spark = df.sparkSession
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode}")
    if mode == "overwrite_partition" and not partition_by:
        raise ValueError("overwrite_partition needs partition_by")
    if mode == "upsert_by_key" and not key:
        raise ValueError("upsert_by_key needs a key")
    if mode == "replace_range" and not date_field:
        raise ValueError("replace_range needs a date field")
    old = versions.adopted(spark, target)
    before = old.rows if old else 0
    if batch and old and old.applied.get(batch[0], batch[1] - 1) >= batch[1]:
        return WriteResult(before, 0, before)
    if old and mode != "snapshot" and set(old.partition_by) != set(partition_by):
        raise ValueError(f"{target} is partitioned by {sorted(old.partition_by)}, not by {sorted(partition_by)}")
    applied = (dict(old.applied) if old else {}) | (dict([batch]) if batch else {})
    partition_by = list(old.partition_by) if old and mode != "snapshot" else list(partition_by)

    def done(files: Sequence[str], kinds: StructType, rows: int, unique: Sequence[str] = ()) -> None:
        versions.commit(spark, target, versions.next_version(old, schema=kinds.json(), files=tuple(files), partition_by=tuple(partition_by), rows=rows, unique=tuple(unique), applied=applied, details={}))

    rows, seen = _counted(df, date_field if mode == "replace_range" else None)
    if mode in ("snapshot", "append", "overwrite_partition"):
        if old and mode != "snapshot" and not _same_kinds(old.struct(), df.schema):
            raise ValueError(f"columns of {target} have other types")
        fresh = _put(rows, target, partition_by)
        result = WriteResult(before, seen.get["n"], seen.get["n"])
        stay: Sequence[str] = ()
        if mode == "append" and old:
            stay, result.rows_after = old.files, before + result.rows_written
        elif mode == "overwrite_partition" and old:
            touched = {versions.label_of(f) for f in fresh}
            stay = [f for f in old.files if versions.label_of(f) not in touched]
            # counts alone come from the files' footers
            result.rows_after = before - versions.read_files(spark, target, old.struct(), [f for f in old.files if f not in set(stay)]).count() + result.rows_written
        result.partitions = sorted({versions.label_of(f) for f in fresh} - {""})
        done([*stay, *fresh], _united(old.struct(), df.schema) if stay else df.schema, result.rows_after)
        return result

    new = stored(rows, "new-rows")
    result = WriteResult(before, seen.get["n"], 0)
    if mode == "replace_range":
        result.range_start, result.range_end = ((a or b or "").replace("-", "") or None for a, b in ((start, seen.get["low"]), (end, seen.get["high"])))
        if not result.range_start or not result.range_end:
            raise ValueError("no row has a date, so there is no range to replace")
        if result.range_start > result.range_end:
            raise ValueError("the range starts after its end")
    had = versions.read_files(spark, target, old.struct(), old.files) if old else new.limit(0)
    # a key that isn't known to be unique is made so over all rows; so are columns that change their types
    whole = mode == "upsert_by_key" and old is not None and tuple(key) != old.unique
    merge = lambda h: upserted(h, new, key, order, date_field, legacy_keys) if mode == "upsert_by_key" else range_replaced(h, new, date_field, result.range_start, result.range_end)
    kinds = merge(had).schema
    going: Sequence[str] = ()
    if old:
        going = old.files if whole or not _same_kinds(old.struct(), kinds) else _files_with(spark, target, _going(had, new, mode, key, date_field, result, legacy_keys))
        had = versions.read_files(spark, target, old.struct(), going)
    had, read = _counted(had)
    merged, kept = _counted(merge(had))
    fresh = _put(merged, target, partition_by)
    gone = read.get["n"] if going else 0
    result.rows_after = before - gone + kept.get["n"]
    if mode == "upsert_by_key":
        result.duplicates_dropped = before + result.rows_written - result.rows_after
    result.partitions = sorted(r.label for r in partition_labels(new, partition_by).collect()) if partition_by else []
    left = [f for f in old.files if f not in set(going)] if old else []
    done([*left, *fresh], _united(old.struct(), kinds) if left else kinds, result.rows_after, key if mode == "upsert_by_key" else ())
    return result


def _files_with(spark: SparkSession, target: str, rows: DataFrame) -> list[str]:
    """The files, relative to the table, that hold the rows; as many as the version has at most."""
    root = f"/{versions.FILES}/"
    found = [unquote(r.file) for r in rows.select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
    plain = target.rstrip("/").removeprefix("file:")
    return [f"{versions.FILES}/{f.rpartition(root)[2]}" if root in f else f[f.index(plain) + len(plain) + 1 :] for f in found]


def _going(old: DataFrame, new: DataFrame, mode: str, key: Sequence[str], date_field: str | None, result: WriteResult, legacy_keys: bool) -> DataFrame:
    """The old rows that a mode takes away, wherever they are, with the file they come from."""
    if mode == "replace_range":
        return old.where(compact(date_field).between(result.range_start, result.range_end))
    texts = lambda d: d.withColumns({f"key_{k}": key_text(F.col(k), k == date_field, legacy_keys) for k in key})
    named, fresh = texts(old.select("*", "_metadata")), texts(new).select(*(f"key_{k}" for k in key)).distinct()
    return named.join(fresh, reduce(and_, (named[f"key_{k}"].eqNullSafe(fresh[f"key_{k}"]) for k in key)), "left_semi")


def read_written(spark: SparkSession, target: str) -> DataFrame:
    """What ``write`` wrote last, or a plain Parquet folder without the folders' own columns."""
    if versions.numbers(spark, target):
        return versions.read(spark, target)
    df = spark.read.option("mergeSchema", True).parquet(target)
    return df.drop(*(c for c in df.columns if c.startswith("part_")))


def write_run_log(entries: DataFrame, folder: str) -> None:
    """A JSON line for each row, a run."""
    entries.select(F.to_json(F.struct(*entries.columns)).alias("value")).coalesce(1).write.mode("append").text(f"{folder}/runs")


def json_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON text: numbers that aren't finite are null, decimals are doubles, dates ISO text."""
    out = {}
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            number = column.cast("double")
            out[name] = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
        elif kind == "date":
            out[name] = F.date_format(column, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            out[name] = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    df = df.withColumns(out) if out else df
    return df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}).alias("json"))


def exchange_scoped(old: DataFrame, new: DataFrame, exchange: str = "exchange") -> DataFrame:
    """Old rows of exchanges that the new batch doesn't hold, and the new batch."""
    return union_by_name(old.join(new.select(exchange).distinct(), exchange, "left_anti").select(old.columns), new)


def shrinking(old: DataFrame, new: DataFrame, group: str = "exchange", least: int = 1, share: float = 0.9) -> DataFrame:
    """Groups of the new batch below a least count, or below a share of what is there."""
    was = old.groupBy(group).agg(F.count("*").alias("was"))
    now = new.groupBy(group).agg(F.count("*").alias("now"))
    return now.join(was, group, "left").where((F.col("now") < least) | (F.col("now") < share * F.coalesce("was", F.lit(0))))


def typed(df: DataFrame, table: str) -> DataFrame:
    """Rows in a table's declared types; what can't be read is null."""
    schema = table_schema(table)
    return df.select(*(F.col(f.name).try_cast(f.type).alias(f.name) for f in schema.fields if f.name in df.columns))


def snapshot_date(df: DataFrame, meta: dict, today: str, date_field: str = "trade_date") -> str:
    """A snapshot's date: from its metadata, else the one date of its rows, else today."""
    for name in ("trade_date", "snapshot_date", "stats_date"):
        if meta.get(name):
            return str(meta[name]).replace("-", "")[:8]
    if date_field in df.columns:
        days = [r.d for r in df.select(compact(date_field).alias("d")).distinct().limit(3).collect() if r.d]
        if len(days) == 1:
            return days[0]
    return today.replace("-", "")


def delete_dataset(spark: SparkSession, root: str, path: str) -> None:
    """Delete a dataset that lies under the data root, and nothing else."""
    root, whole = posixpath.normpath(root), posixpath.normpath(posixpath.join(root, path))
    if not whole.startswith(root + "/"):
        raise ValueError(f"{path} is outside {root}")
    _delete(spark, whole)
