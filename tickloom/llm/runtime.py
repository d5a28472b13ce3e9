"""Tables, Arrow bounds, additive sketches and bit arrays of keys."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.storage import stored

BATCH_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns of ``df`` in the given types.

    Ten thousand rows of text can be any size: without a bound in bytes the JVM
    holds whole batches of them off heap.  A session that names no bound gets one.
    """
    if df.sparkSession.conf.get(BATCH_BOUND, None) is None:
        df.sparkSession.conf.set(BATCH_BOUND, str(BATCH_BYTES))
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SKETCH_SCHEMA = "part int, cells binary"


def sketch_rows(cells: np.ndarray, parts: int) -> pa.RecordBatch:
    """A sketch as ``parts`` compressed pieces."""
    pieces = np.split(cells, parts)
    keep = [i for i, p in enumerate(pieces) if p.any()]
    return pa.record_batch({"part": pa.array(keep, pa.int32()), "cells": pa.array([zlib.compress(pieces[i].tobytes(), 1) for i in keep], pa.binary())})


def merge_sketches(rows: DataFrame, parts: int, dtype: str, salts: int = 4) -> DataFrame:
    """Sum the pieces of partition sketches, saturating, streaming through two rounds.

    Each task holds the sums of its own pieces only; nothing is grouped in memory.
    """
    limit = np.iinfo(np.dtype(dtype)).max

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(zlib.decompress(cells), dtype).astype(np.uint64)
                if part in sums:
                    values = values + sums[part]
                sums[part] = np.minimum(values, limit).astype(dtype)
        if sums:
            keys = sorted(sums)
            yield pa.record_batch({"part": pa.array(keys, pa.int32()), "cells": pa.array([zlib.compress(sums[k].tobytes(), 1) for k in keys], pa.binary())})

    first = rows.withColumn("salt", (F.rand(1) * salts).cast("int")).repartition(parts * salts, "part", "salt").select("part", "cells").mapInArrow(add, SKETCH_SCHEMA)
    return first.repartition(parts, "part").mapInArrow(add, SKETCH_SCHEMA)


def collect_sketch(rows: DataFrame, width: int, parts: int, dtype: str) -> np.ndarray:
    """The merged sketch; its size is fixed by ``width``."""
    out = np.zeros(width, dtype)
    step = width // parts
    for row in rows.collect():
        out[row.part * step : (row.part + 1) * step] = np.frombuffer(zlib.decompress(row.cells), dtype)
    return out


def key_bits(keys: DataFrame, cells: int = 1 << 26, parts: int = 16) -> np.ndarray:
    """A bit array of fixed size in which every key (one long column) has its bit.

    Others may share a bit: it only spares work and is followed by an exact join.
    """
    step = cells // parts

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [key_cells(np.asarray(b.column(0)), cells) for b in batches if b.num_rows]
        if found:
            cell = np.unique(np.concatenate(found))
            rows = []
            for k in range(parts):
                own = cell[(cell >= k * step) & (cell < (k + 1) * step)] - k * step
                if len(own):
                    bits = np.zeros(step, np.uint8)
                    bits[own] = 1
                    rows.append((k, zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)))
            yield pa.record_batch({"part": pa.array([r[0] for r in rows], pa.int32()), "cells": pa.array([r[1] for r in rows], pa.binary())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = np.frombuffer(zlib.decompress(blob), np.uint8)
                bits[k] = bits[k] | one if k in bits else one
        if bits:
            yield pa.record_batch({"part": pa.array(list(bits), pa.int32()), "cells": pa.array([zlib.compress(b.tobytes(), 1) for b in bits.values()], pa.binary())})

    out = np.zeros(cells // 8, np.uint8)
    for part, blob in keys.mapInArrow(mark, SKETCH_SCHEMA).repartition(parts, "part").mapInArrow(join, SKETCH_SCHEMA).collect():
        out[part * step // 8 : (part + 1) * step // 8] = np.frombuffer(zlib.decompress(blob), np.uint8)
    return out


def key_cells(keys: np.ndarray, cells: int) -> np.ndarray:
    mixed = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(20)) & np.uint64(cells - 1)).astype(np.int64)


def may_be_in(docs: DataFrame, names: DataFrame, key: str) -> Column:
    """Whether a row's key has its bit among the names' bits: true for all of them and a few others."""
    bits = docs.sparkSession.sparkContext.broadcast(key_bits(names.select(F.col(key).cast("long")).dropna()).tobytes())

    @F.arrow_udf("boolean")
    def marked(keys: pa.Array) -> pa.Array:
        array = np.frombuffer(bits.value, np.uint8)
        cell = key_cells(np.asarray(keys.fill_null(0)), 8 * len(array))
        return pa.array(((array[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0) & np.asarray(keys.is_valid()))

    return marked(F.col(key).cast("long"))


def without(docs: DataFrame, names: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key isn't in ``names``, an anti join that moves few rows.

    A row whose bit isn't set can't be named and stays where it is; only the
    others, the named ones and a few that share a bit, are joined.
    """
    flag = may_be_in(docs, names, key)
    some = docs.where(flag).join(names.select(key).distinct(), key, "left_anti").select(docs.columns)
    return docs.where(~flag).unionByName(some)


def once(docs: DataFrame, key: str, same: tuple[str, ...]) -> DataFrame:
    """One of the rows that repeat a key and the columns ``same``; rows without a key, or with one of their own, stay where they are."""
    repeated = stored(docs.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key), "repeated")
    if not repeated.limit(1).count():
        return docs
    flag = may_be_in(docs, repeated, key)
    return docs.where(~flag).unionByName(docs.where(flag).dropDuplicates([key, *same]))
