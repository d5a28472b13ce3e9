"""Table scans and the query API.

Files are read with one declared schema.  Columns that a file lacks are null,
whatever is there is cast to its declared type, and the date field is compact
text however it was stored; hive folders add their values where a file has no
such column.  Projection and filters are plain columns, so Catalyst prunes and
pushes them down.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tickloom.functions.dates import between_text, undashed
from tickloom.schema import TableSchema, table_schema
from tickloom.sources.layout import TableFiles, table_files

HIVE_NULL = ("__null__", "__HIVE_DEFAULT_PARTITION__")


def source_columns(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The columns of all files together, in order of first sight; footers only."""
    return spark.read.option("mergeSchema", True).parquet(*paths).columns if paths else []


def _hive_values(path: str, root: str | None) -> dict[str, str | None]:
    parts = path[len(root) :].split("/")[:-1] if root and path.startswith(root) else path.split("/")[:-1]
    out = {}
    for part in parts:
        key, sep, value = part.partition("=")
        if sep and key != "table":
            out[key] = None if unquote(value) in HIVE_NULL else unquote(value)
    return out




def declared(df: DataFrame, schema: TableSchema, names: Sequence[str]) -> list[Column]:
    """Each declared field as a typed column: null if absent, the date field without dashes."""
    out = []
    for name in names:
        field = schema.field(name)
        if name not in df.columns:
            column = F.lit(None).cast(field.type)
        elif name == schema.date_field:
            column = undashed(F.col(f"`{name}`"))
        else:
            column = F.col(f"`{name}`").try_cast(field.type)
        out.append(column.alias(name))
    return out


def scan_files(spark: SparkSession, files: TableFiles) -> DataFrame:
    """All files as one frame by column name; hive values fill in where files lack a column.

    Files are grouped by what their footers hold, and a column in several types
    is read as text, so that mixed layouts of one table can be read together.
    """
    groups: dict[tuple, list[str]] = {}
    for path in files.paths:
        hive = tuple(sorted(_hive_values(path, files.root).items(), key=lambda x: x[0]))
        groups.setdefault(tuple(k for k, _ in hive), []).append(path)
    frames = []
    for keys, paths in groups.items():
        frame = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
        for k in keys:
            value = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), rf"/{k}=([^/]*)/", 1))
            value = F.when(~value.isin(*HIVE_NULL), value)
            # some of the files may have the column, others only the folder's name
            frame = frame.withColumn(k, F.coalesce(F.col(f"`{k}`").cast("string"), value) if k in frame.columns else value)
        frames.append(frame)
    return reduce(lambda a, b: union_by_name(a, b), frames)


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both by column name; a column of two types becomes text, one that a side lacks is null there."""
    types = dict(a.dtypes)
    clash = [c for c, t in b.dtypes if c in types and types[c] != t]
    a, b = (d.withColumns({c: F.col(f"`{c}`").cast("string") for c in clash}) if clash else d for d in (a, b))
    return a.unionByName(b, allowMissingColumns=True)


def condition(column: Column, value: Any) -> Column:
    """= for a scalar, IN for a list (an empty one is never true), IS NULL for None."""
    if value is None:
        return column.isNull()
    if isinstance(value, (list, tuple, set, frozenset)):
        return column.isin(list(value)) if value else F.lit(False)
    return column == F.lit(value)


def query_table(
    spark: SparkSession,
    table: str,
    root: str,
    filters: Mapping[str, Any] | None = None,
    fields: Sequence[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """SELECT fields WHERE all filters AND start <= date <= end LIMIT n of a core table.

    Bounds may be dashed.  ``limit`` 0 gives no rows.  Dates outside all files
    give an empty frame with the asked columns.
    """
    schema = table_schema(table)
    asked = schema.checked(list(fields) if fields else None)
    filters = dict(filters or {})
    schema.checked(list(filters))
    if (start_date or end_date) and not schema.date_field:
        raise ValueError(f"table {schema.name} has no date field")
    files = table_files(spark, root, schema.name, schema.date_field, start_date, end_date)
    if not files.paths:
        return spark.createDataFrame([], StructType([f for n in asked for f in schema.struct() if f.name == n]))
    raw = scan_files(spark, files)
    if schema.date_field in raw.columns:
        raw = raw.where(stored_between(raw, schema.date_field, start_date, end_date))
    needed = list(dict.fromkeys([*asked, *filters, *([schema.date_field] if start_date or end_date else [])]))
    return filtered(raw.select(*declared(raw, schema, needed)), filters, schema.date_field, start_date, end_date, limit).select(*asked)


def stored_between(df: DataFrame, name: str, start: str | None, end: str | None) -> Column:
    """What the stored date column must fulfil to lie within the bounds, whether its text has dashes or not.

    A dash sorts before any digit, so no writing of a day sorts before the dashed
    one or after the compact one.  The bounds go to the Parquet scan as they are;
    the exact comparison of compact text follows.
    """
    out = F.lit(True)
    if not isinstance(df.schema[name].dataType, StringType):
        return out
    column = F.col(f"`{name}`")
    low, high = (re.sub("-", "", b or "") for b in (start, end))
    if re.fullmatch(r"\d{8}", low):
        out = out & (column >= f"{low[:4]}-{low[4:6]}-{low[6:]}")
    if re.fullmatch(r"\d{8}", high):
        out = out & (column <= high)
    return out


def filtered(df: DataFrame, filters: Mapping[str, Any] | None = None, date_field: str | None = None, start: str | None = None, end: str | None = None, limit: int | None = None) -> DataFrame:
    for name, value in (filters or {}).items():
        df = df.where(condition(F.col(f"`{name}`"), value))
    if start or end:
        df = df.where(between_text(F.col(date_field), start, end))
    return df if limit is None else df.limit(limit)


def read_core_table(spark: SparkSession, table: str, root: str) -> DataFrame:
    """All files: declared columns first, then whatever else they hold."""
    schema = table_schema(table)
    raw = scan_files(spark, table_files(spark, root, schema.name))
    extra = [F.col(f"`{c}`") for c in raw.columns if c not in schema.names]
    return raw.select(*declared(raw, schema, schema.names), *extra)


PREVIEW_ROWS, PREVIEW_MOST, QUERY_ROWS, QUERY_MOST = 3, 100, 1000, 100_000


def clamped(limit: int | None, default: int, most: int) -> int:
    return max(1, min(most, default if limit is None else int(limit)))


def preview(df: DataFrame, filters: Mapping[str, Any] | None = None, fields: Sequence[str] | None = None, date_field: str | None = None, start: str | None = None, end: str | None = None, limit: int | None = None) -> DataFrame:
    """A few rows of any dataset.

    Filters whose value is None are dropped, an empty text asks for null, nulls
    in lists don't count, and dates compare without dashes on both sides.
    """
    for name, value in (filters or {}).items():
        if value is None:
            continue
        column = F.col(f"`{name}`").cast("string")
        strip = (lambda v: str(v).replace("-", "")) if name == date_field else str
        column = undashed(column) if name == date_field else column
        if isinstance(value, (list, tuple, set, frozenset)):
            value = [strip(v) for v in value if v is not None]
        else:
            value = None if value == "" else strip(value)
        df = df.where(condition(column, value))
    if date_field and (start or end):
        df = df.where(between_text(undashed(F.col(f"`{date_field}`")), start, end))
    return df.select(*(F.col(f"`{f}`") for f in fields or df.columns)).limit(clamped(limit, PREVIEW_ROWS, PREVIEW_MOST))


SYMBOL_FIELDS = ("ts_code", "instrument_id", "symbol", "code")


def symbol_field(columns: Sequence[str]) -> str | None:
    return next((c for c in SYMBOL_FIELDS if c in columns), None)


def merged_filters(params: Mapping[str, Any] | None, filters: Mapping[str, Any] | None = None) -> tuple[dict[str, Any], str | None, str | None]:
    """Filters and leftover parameters together, parameters first; nulls are dropped, dates come out apart."""
    rest = {k: v for k, v in (params or {}).items() if v is not None}
    start = rest.pop("start_date", None) or rest.pop("start", None)
    end = rest.pop("end_date", None) or rest.pop("end", None)
    return {**{k: v for k, v in (filters or {}).items() if v is not None}, **rest}, start, end


def parsed_filters(values: Sequence[str]) -> dict[str, Any]:
    """``key=value`` words and JSON objects as filters."""
    import json

    out: dict[str, Any] = {}
    for value in values:
        text = value.strip()
        if text.startswith("{"):
            out.update(json.loads(text))
        else:
            key, sep, rest = text.partition("=")
            if not sep or not key.strip():
                raise ValueError(f"a filter is key=value or a JSON object, not {value!r}")
            out[key.strip()] = rest
    return out
