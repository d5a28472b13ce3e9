"""Operators and entry points as table functions, callable from SQL.

    register(spark)
    SELECT * FROM tail_rows(TABLE(quotes) PARTITION BY code ORDER BY time, n => 5)
    SELECT * FROM streak_rows(TABLE(bars) PARTITION BY code ORDER BY day, flag => 'up')
    SELECT * FROM entry_rows(TABLE(SELECT year FROM years) , entry => 'module:function', fields => 'year long, k long')

A partition streams by in its order, and a function keeps no more than its answer
needs: n rows, or a count.  Functions that are called for every row take plain rows,
for Arrow would make a batch of what each call gives; an entry point, which gives many
rows a call, sends them in Arrow batches.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tickloom.sources.gateway import _function


def _columns(table: AnalyzeArgument) -> StructType:
    if not table.isTable:
        raise ValueError("the first argument is a TABLE")
    return table.dataType


KINDS = {"string": StringType, "long": LongType, "int": IntegerType, "double": DoubleType, "boolean": BooleanType, "date": DateType, "timestamp": TimestampType}


def _fields(text: str) -> StructType:
    """A schema of ``name kind, ...``; a worker has no parser of Spark's own."""
    pairs = [part.split() for part in text.split(",")]
    if wrong := [p for p in pairs if len(p) != 2 or p[1].lower() not in KINDS]:
        raise ValueError(f"not a field of {', '.join(KINDS)}: {' '.join(wrong[0])}")
    return StructType([StructField(name, KINDS[kind.lower()]()) for name, kind in pairs])


class TailRows:
    """The last n rows of each partition, in its order."""

    def __init__(self) -> None:
        self.rows: deque | None = None

    @staticmethod
    def analyze(table: AnalyzeArgument, n: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(n.value, int) or n.value < 0:
            raise ValueError("n is a number of rows")
        return AnalyzeResult(schema=StructType(_columns(table).fields))

    def eval(self, table: Any, n: int) -> None:
        if self.rows is None:
            self.rows = deque(maxlen=n)
        self.rows.append(tuple(table))

    def terminate(self) -> Iterator[tuple]:
        yield from self.rows or ()


class StreakRows:
    """Each row with how many in a row, up to it, have had a flag; null is none."""

    def __init__(self) -> None:
        self.run = 0

    @staticmethod
    def analyze(table: AnalyzeArgument, flag: AnalyzeArgument) -> AnalyzeResult:
        columns = _columns(table)
        if flag.value not in columns.names:
            raise ValueError(f"there is no column {flag.value}")
        return AnalyzeResult(schema=StructType([*columns.fields, StructField("streak", LongType())]))

    def eval(self, table: Any, flag: str) -> Iterator[tuple]:
        self.run = self.run + 1 if table[flag] else 0
        yield (*table, self.run)


class EntryRows:
    """The rows of an entry point ``module:function`` for each row of parameters."""

    @staticmethod
    def analyze(table: AnalyzeArgument, entry: AnalyzeArgument, fields: AnalyzeArgument) -> AnalyzeResult:
        _columns(table)
        if ":" not in (entry.value or ""):
            raise ValueError("an entry point is module:function")
        return AnalyzeResult(schema=_fields(fields.value))

    def eval(self, table: Any, entry: str, fields: str) -> Iterator[tuple]:
        names = _fields(fields).names
        for row in _function(entry)(table.asDict()):
            yield tuple(row.get(n) for n in names)


FUNCTIONS = {"tail_rows": TailRows, "streak_rows": StreakRows, "entry_rows": EntryRows}


def register(spark: SparkSession) -> None:
    for name, kind in FUNCTIONS.items():
        spark.udtf.register(name, udtf(kind, useArrow=kind is EntryRows))
