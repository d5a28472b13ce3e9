"""Where a table's files are, listed through Hadoop's file systems.

A table is one file (or a written folder) ``core/<t>.parquet``, which wins over all else, or a folder
``core/table=<t>`` with an optional ``parquet`` folder in it, holding files
named by date or hive folders.  Files whose name or folder puts them outside
the asked dates are never opened, so a damaged one there doesn't matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class TableFiles:
    """root: the folder that hive folders are relative to, or None for a single file."""

    root: str | None
    paths: tuple[str, ...]
    found_any: bool


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(path, is folder) below a folder, sorted; nothing if there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at):
        return []
    return sorted((s.getPath().toString(), s.isDirectory()) for s in system.listStatus(at))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _outside(value: str, start: str | None, end: str | None) -> bool:
    day = value.replace("-", "")
    return bool(re.fullmatch(r"\d{8}", day)) and bool((start and day < start) or (end and day > end))


def _walk(spark: SparkSession, folder: str, date_field: str | None, start: str | None, end: str | None) -> tuple[list[str], bool]:
    from tickloom.sources import versions

    if version := versions.latest(spark, folder):
        # a written table: the files of its newest version
        ours = [f for f in version.files if not any(_outside(v, start, end) for k, _, v in (part.partition("=") for part in versions.label_of(f).split("/")) if k == date_field)]
        return [f"{folder.rstrip('/')}/{f}" for f in ours], bool(version.files)
    kept, seen = [], False
    for path, is_folder in children(spark, folder):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if name.startswith(("_", ".")):
            continue
        if is_folder:
            key, _, value = name.partition("=")
            if key == date_field and _outside(value, start, end):
                seen = True
                continue
            below, any_below = _walk(spark, path, date_field, start, end)
            kept += below
            seen |= any_below
        elif name.endswith(".parquet"):
            seen = True
            if not _outside(name.removesuffix(".parquet").split("_")[0], start, end):
                kept.append(path)
    return kept, seen


def table_files(spark: SparkSession, root: str, table: str, date_field: str | None = None, start: str | None = None, end: str | None = None) -> TableFiles:
    """The files to read; FileNotFoundError tells a missing table from an empty folder."""
    start, end = (b.replace("-", "") if b else None for b in (start, end))
    single = f"{root}/core/{table}.parquet"
    if exists(spark, single):
        return TableFiles(None, (single,), True)
    folders = [f for f in (f"{root}/core/table={table}/parquet", f"{root}/core/table={table}") if exists(spark, f)]
    if not folders:
        raise FileNotFoundError(f"table {table} is not under {root}")
    bounded = bool(date_field and (start or end))
    kept: list[str] = []
    for folder in folders:
        paths, seen = _walk(spark, folder, date_field, start, end)
        if seen:
            kept += [p for p in paths if p not in kept]
            if not bounded:
                return TableFiles(folder, tuple(kept), True)
            bounded_root = folders[-1]
    if not kept and not bounded:
        raise FileNotFoundError(f"table {table} has a folder without files")
    return TableFiles(bounded_root if kept else folders[0], tuple(kept), bool(kept))
