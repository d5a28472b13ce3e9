"""Text, HTML, JSON and sheet sources as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.dates import between_text, compact_if_dashed, undashed
from tickloom.functions.text import clean_text, parse_float, parse_int

CSV_DATES = ("trade_date", "cal_date", "date")


def read_csv(spark: SparkSession, path: str, params: Mapping[str, Any] | None = None, limit: int | None = None) -> DataFrame:
    """A CSV file with a header, all text; params filter by equality on the text, start and end by the first date column."""
    if limit is not None and limit < 0:
        raise ValueError("limit is negative")
    df = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*(c.removeprefix("﻿") for c in df.columns))
    params = dict(params or {})
    start, end = params.pop("start_date", None), params.pop("end_date", None)
    for name, value in params.items():
        if name in df.columns and value is not None:
            df = df.where(F.col(name) == str(value))
    if start or end:
        day = next((c for c in CSV_DATES if c in df.columns), None)
        df = df.where(between_text(undashed(day), start, end)) if day else df.where(F.lit(False))
    return df if limit is None else df.limit(limit)


def text_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files in any encoding that Python knows and that keeps line feeds as bytes of their own."""
    lines = spark.read.text(path)
    if encoding.upper() in ("UTF-8", "UTF8"):
        return lines.select(F.col("value").alias("line"))

    @F.pandas_udf("string")
    def decoded(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: bytes(b).decode(encoding, "replace"))

    # a line is read as its bytes, whatever they spell
    return lines.select(decoded(F.col("value").cast("binary")).alias("line"))


def read_stats(spark: SparkSession, path: str, columns: Mapping[int, str], least: int = 35, encoding: str = "GBK") -> DataFrame:
    """Pipe-separated lines: (market_id, code) and the asked positions; short lines are skipped."""
    lines = text_lines(spark, path, encoding)
    cells = F.split("line", r"\|")
    rows = lines.select(cells.alias("c")).where(F.size("c") >= least)
    return rows.select(F.col("c")[0].try_cast("int").alias("market_id"), F.lpad(F.trim(F.col("c")[1]), 6, "0").alias("code"), *(clean_text(F.col("c")[i]).alias(n) for i, n in columns.items()))


def delimited_rows(df: DataFrame, column: str, row_mark: str, field_mark: str, names: Sequence[str]) -> DataFrame:
    """Text of rows and fields, one row each; rows with fewer fields than names are skipped."""
    rows = df.select("*", F.posexplode(F.split(column, row_mark)).alias("row_index", "row_"))
    rows = rows.withColumn("cells_", F.split("row_", field_mark)).where(F.size("cells_") >= len(names))
    return rows.select(*df.columns, "row_index", *(clean_text(F.col("cells_")[i]).alias(n) for i, n in enumerate(names)))


def unique_columns(names: Sequence[str]) -> list[str]:
    """Names that repeat get __1, __2 and so on."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        k = seen.get(name, 0)
        seen[name] = k + 1
        out.append(f"{name}__{k}" if k else name)
    return out


def result_sets(df: DataFrame, column: str = "json") -> DataFrame:
    """Rows of JSON text {"tables": [{"columns": [..], "rows": [[..]]}]}: table_index, row_index, cells as a map.

    Short rows are padded with nulls; a repeated column name gets a suffix.
    """
    parsed = F.from_json(column, "struct<tables:array<struct<columns:array<string>,rows:array<array<string>>>>>")
    tables = df.select("*", F.posexplode(parsed["tables"]).alias("table_index", "table_"))
    rows = tables.select("*", F.posexplode("table_.rows").alias("row_index", "row_"))
    names = F.col("table_.columns")
    repeats = F.transform(names, lambda c, i: F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == c)))
    suffixed = F.zip_with(names, repeats, lambda n, k: F.when(k > 0, F.concat(n, F.lit("__"), k.cast("string"))).otherwise(n))
    cells = F.transform(F.sequence(F.lit(0), F.size(names) - 1), lambda i: F.get("row_", i))
    return rows.select(*df.columns, "table_index", "row_index", F.map_from_arrays(suffixed, cells).alias("cells"))


def html_tables(df: DataFrame, column: str = "html") -> DataFrame:
    """Cells of HTML table rows: row_index and cells, by tags alone."""
    rows = F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    out = df.select("*", F.posexplode(rows).alias("row_index", "row_"))
    cells = F.regexp_extract_all("row_", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    return out.withColumn("cells", F.transform(cells, lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", "")))).drop("row_")


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of each workbook: path, row_index and cells as text; empty cells are null."""

    def parse(batches):
        import io
        import re
        import zipfile
        from xml.etree import ElementTree

        space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                book = zipfile.ZipFile(io.BytesIO(content))
                shared = []
                if "xl/sharedStrings.xml" in book.namelist():
                    for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{space}si"):
                        shared.append("".join(t.text or "" for t in item.iter(f"{space}t")))
                sheet = ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml"))
                for at, row in enumerate(sheet.iter(f"{space}row")):
                    cells: list[str | None] = []
                    for cell in row.iter(f"{space}c"):
                        place = 0
                        for letter in re.match("[A-Z]*", cell.get("r", ""))[0]:
                            place = place * 26 + ord(letter) - 64
                        value = cell.find(f"{space}v")
                        value = "".join(t.text or "" for t in cell.iter(f"{space}t")) if cell.get("t") == "inlineStr" else value.text if value is not None else None
                        value = shared[int(value)] if cell.get("t") == "s" and value is not None else value
                        while len(cells) < (place or len(cells) + 1):
                            cells.append(None)
                        cells[(place or len(cells)) - 1] = value
                    rows.append((name, at, cells))
            yield pd.DataFrame(rows, columns=["path", "row_index", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, row_index int, cells array<string>")


def mapped_fields(df: DataFrame, spec: Sequence[tuple[str, str | int, str]], cells: str | None = None) -> DataFrame:
    """Columns (name, key or position, kind) of a row, a map or an array; kinds are float, int, date and text."""
    kinds = {"float": parse_float, "int": parse_int, "date": compact_if_dashed, "text": clean_text}

    def value(key: str | int) -> Column:
        if cells is None:
            return F.col(key) if key in df.columns else F.lit(None).cast("string")
        return F.get(cells, key) if isinstance(key, int) else F.try_element_at(cells, F.lit(key))

    return df.select(*(kinds[kind](value(key)).alias(name) for name, key, kind in spec))


def nested_items(df: DataFrame, reports: str, items: str, most_reports: int | None = None, most_items: int | None = None) -> DataFrame:
    """Reports of a document and their items, one row an item, with a limit on each level."""
    out = df.select("*", F.posexplode(reports).alias("report_index", "report"))
    out = out.where(F.col("report_index") < most_reports) if most_reports is not None else out
    out = out.select("*", F.posexplode(F.col("report")[items]).alias("item_index", "item"))
    return out.where(F.col("item_index") < most_items) if most_items is not None else out
