"""Packed payloads: varints, deltas, compact floats, bit-packed text and bar records, decoded in Arrow batches.

All of it is vectorised over the payloads of a batch: a payload is no loop of its own.
A payload that ends too early or holds a letter outside the alphabet is null, or gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

# fixed values: the letters of six bits each
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SIX = np.full(256, -1, np.int16)
_SIX[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary or string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def _lists(values: np.ndarray, counts: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Lists of consecutive values; rows that aren't valid have none and are null."""
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~valid))


def _running(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the values of each list so far."""
    total = np.cumsum(values)
    ends = np.cumsum(counts)
    starts = (ends - counts)[counts > 0]
    before = np.where(starts > 0, total[starts - 1], 0) if len(starts) else np.empty(0, np.int64)
    return total - np.repeat(before, counts[counts > 0])


def varint_values(data: np.ndarray) -> np.ndarray:
    """Signed values of a run of whole varints: six bits and the sign in a first byte, seven in each that follows, the lowest first."""
    if not len(data):
        return np.empty(0, np.int64)
    last = data < 128
    first = np.append(True, last[:-1])
    starts = np.flatnonzero(first)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    bits = np.where(first, data & 63, data & 127).astype(np.int64) << np.where(first, 0, 7 * place - 1)
    size = np.add.reduceat(bits, starts)
    return np.where(data[starts] & 64, -size, size)


def unpack_varints(payload: str | Column, deltas: bool = False) -> Column:
    """The values of a binary column of varints, or with ``deltas`` their running sums, as array<bigint>."""

    @F.arrow_udf("array<bigint>")
    def unpacked(column: pa.Array) -> pa.Array:
        offsets, data = _bytes_of(column)
        ends = np.append(0, np.cumsum(data < 128))
        # a payload's last byte ends a value
        whole = (np.diff(offsets) == 0) | (data[np.maximum(offsets[1:] - 1, 0)] < 128 if len(data) else True)
        keep = np.repeat(whole, np.diff(offsets))
        counts = np.where(whole, np.diff(ends[offsets]), 0)
        values = varint_values(data[keep])
        return _lists(_running(values, counts) if deltas else values, counts, whole & np.asarray(column.is_valid()))

    return unpacked(F.col(payload) if isinstance(payload, str) else payload)


def pack_varints(values: str | Column) -> Column:
    """A list of numbers as varints; null for null."""

    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        flat = np.asarray(column.flatten(), np.int64)
        counts = np.where(np.asarray(column.is_valid()), np.asarray(pc.fill_null(pc.list_value_length(column), 0)), 0)
        size = np.abs(flat)
        more = size >> 6
        length = 1 + sum(((more >> (7 * k)) > 0).astype(np.int64) for k in range(9))
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(first, length)
        shift = np.where(place == 0, 0, 7 * place - 1)
        chunk = (np.repeat(size, length) >> shift) & np.where(place == 0, 63, 127)
        sign = np.where((place == 0) & (np.repeat(flat, length) < 0), 64, 0)
        goes_on = np.where(place < np.repeat(length, length) - 1, 128, 0)
        data = (chunk | sign | goes_on).astype(np.uint8)
        ends = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(counts))]
        out = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(data.tobytes())])
        return pc.if_else(column.is_valid(), out, pa.scalar(None, pa.large_binary())).cast(pa.binary())

    return packed(F.col(values) if isinstance(values, str) else values)


def unpack_bits(payload: str | Column, width: int, signed: bool = False, deltas: bool = False) -> Column:
    """Values of ``width`` bits each, the lowest bit first, of text with six bits a letter; bits left over at the end are padding."""

    @F.arrow_udf("array<bigint>")
    def unpacked(column: pa.Array) -> pa.Array:
        offsets, data = _bytes_of(column)
        six = _SIX[data]
        known = np.append(0, np.cumsum(six < 0))
        whole = np.diff(known[offsets]) == 0
        letters = np.diff(offsets)
        counts = np.where(whole, 6 * letters // width, 0)
        bits = ((six[:, None] >> np.arange(6)) & 1).astype(np.int64).ravel()
        start = np.repeat(6 * offsets[:-1] - width * (np.cumsum(counts) - counts), counts) + width * np.arange(int(counts.sum()))
        values = np.zeros(len(start), np.int64)
        for k in range(width):
            values |= bits[start + k] << k
        if signed:
            values -= np.where(values >> (width - 1) & 1, 1 << width, 0)
        return _lists(_running(values, counts) if deltas else values, counts, whole & np.asarray(column.is_valid()))

    if not 1 <= width <= 62:
        raise ValueError("a value has 1 to 62 bits")
    return unpacked(F.col(payload) if isinstance(payload, str) else payload)


def pack_bits(values: str | Column, width: int) -> Column:
    """A list of numbers with ``width`` bits each as text; the last letter is filled up with zeros."""

    @F.arrow_udf("string")
    def packed(column: pa.Array) -> pa.Array:
        flat = np.asarray(column.flatten(), np.int64)
        counts = np.where(np.asarray(column.is_valid()), np.asarray(pc.fill_null(pc.list_value_length(column), 0)), 0)
        letters = -(-width * counts // 6)
        ends = np.cumsum(letters)
        bits = np.zeros(6 * int(letters.sum()), np.int64)
        start = np.repeat(6 * (ends - letters) - width * (np.cumsum(counts) - counts), counts) + width * np.arange(len(flat))
        for k in range(width):
            bits[start + k] = flat >> k & 1
        six = (bits.reshape(-1, 6) << np.arange(6)).sum(axis=1)
        text = np.frombuffer(ALPHABET.encode(), np.uint8)[six]
        offsets = np.append(0, ends).astype(np.int64)
        out = pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(text.tobytes())])
        return pc.if_else(column.is_valid(), out, pa.scalar(None, pa.large_string())).cast(pa.string())

    return packed(F.col(values) if isinstance(values, str) else values)


def _float_of(raw: np.ndarray) -> np.ndarray:
    """32 bits: a signed half of the exponent, its lowest bit, and 23 bits of fraction; 0 is 0."""
    raw = raw.astype(np.int64)
    half = (raw >> 24) - np.where(raw >> 31 & 1, 256, 0)
    return np.where(raw == 0, 0.0, np.ldexp(1 + (raw & 0x7FFFFF) / (1 << 23), 2 * half + (raw >> 23 & 1) - 127))


def compact_float(raw: str | Column) -> Column:
    """The number of a compact float's 32 bits."""
    bits = (F.col(raw) if isinstance(raw, str) else raw).cast("long")
    half = F.shiftright(bits, 24) - F.when(bits.bitwiseAND(1 << 31) != 0, 256).otherwise(0)
    low = F.shiftright(bits, 23).bitwiseAND(1)
    return F.when(bits == 0, 0.0).otherwise((1 + bits.bitwiseAND(0x7FFFFF) / (1 << 23)) * F.pow(F.lit(2.0), 2 * half + low - 127))


BAR_FIELDS = ("date_raw", "minute", "open_milli", "close_milli", "high_milli", "low_milli", "volume", "amount")


def _take(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n bytes at each place as a number, the lowest first."""
    out = np.zeros(len(at), np.int64)
    for k in range(n):
        out |= data[at + k].astype(np.int64) << (8 * k)
    return out


def _varints_at(data: np.ndarray, at: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A varint at each place, and the places after them; beyond ``limit`` if one has no end."""
    value, negative = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    at, going, k = at.copy(), np.ones(len(at), bool), 0
    while going.any():
        here = going & (at < limit)
        at[going & ~here] = limit[going & ~here] + 1
        byte = data[np.where(here, at, 0)].astype(np.int64)
        if k == 0:
            negative = here & (byte & 64 > 0)
        value = np.where(here, value | (byte & (63 if k == 0 else 127)) << (0 if k == 0 else 7 * k - 1), value)
        at = np.where(here, at + 1, at)
        going = here & (byte & 128 > 0)
        k += 1
    return np.where(negative, -value, value), at


def _bars(keys: Sequence[str], payload: str, intraday: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = _bytes_of(batch.column(payload))
            data = np.append(data, np.zeros(16, np.uint8))
            limit = offsets[1:]
            sized = np.diff(offsets) >= 2
            count = np.where(sized, _take(data, np.where(sized, offsets[:-1], 0), 2), 0)
            at, close = offsets[:-1] + 2, np.zeros(batch.num_rows, np.int64)
            rows: list[np.ndarray] = []
            whole, i = sized.copy(), 0
            # the i-th record of all payloads at a time
            while len(now := np.flatnonzero(whole & (count > i))):
                spot, end = at[now], limit[now]
                time = _take(data, np.minimum(spot, len(data) - 4), 4)
                spot = spot + 4
                deltas = []
                for _ in range(4):
                    value, spot = _varints_at(data, np.minimum(spot, end), end)
                    deltas.append(value)
                fits = spot + 8 <= end
                whole[now[~fits]] = False
                now, spot, time, (opened, closed, high, low) = now[fits], spot[fits], time[fits], [d[fits] for d in deltas]
                first = close[now] + opened
                close[now] = first + closed
                minute = time >> 16 if intraday else np.zeros(len(now), np.int64)
                packed = time & 0xFFFF
                date = ((packed >> 11) + 2004) * 10_000 + packed % 2048 if intraday else time
                rows.append(np.stack([now, np.full(len(now), i), date, minute, first, close[now], first + high, first + low, _take(data, spot, 4), _take(data, spot + 4, 4)], axis=1))
                at[now] = spot + 8
                i += 1
            found = np.concatenate(rows) if rows else np.empty((0, 10), np.int64)
            # a damaged payload gives none of its bars
            found = found[whole[found[:, 0]]]
            found = found[np.lexsort((found[:, 1], found[:, 0]))]
            columns = [batch.column(k).take(pa.array(found[:, 0])) for k in keys]
            columns += [pa.array(found[:, 1].astype(np.int32)), *(pa.array(found[:, c]) for c in range(2, 8)), *(pa.array(_float_of(found[:, c])) for c in (8, 9))]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "place", *BAR_FIELDS])

    return run


def bar_records(df: DataFrame, payload: str, keys: Sequence[str], intraday: bool = False) -> DataFrame:
    """The bars of binary payloads, with ``keys`` of their row: a count, and records of time, price deltas as varints, volume and amount as compact floats.

    ``date_raw`` is yyyymmdd and ``minute`` the minute of the day, 0 for daily bars.
    """
    held = df.select(*keys, F.col(payload).cast("binary").alias("payload_"))
    number = lambda n: StructField(n, LongType())
    schema = StructType([*(f for f in held.schema.fields if f.name != "payload_"), StructField("place", IntegerType()), *map(number, BAR_FIELDS[:6])])
    schema = schema.add("volume", "double").add("amount", "double")
    return held.mapInArrow(_bars(keys, "payload_", intraday), schema)


def little_endian(value: Column, size: int) -> Column:
    """A number's lowest bytes as binary, the lowest first."""
    text = F.lpad(F.hex(value.cast("long")), 2 * size, "0")
    return F.unhex(F.concat(*(F.substring(text, 2 * (size - k) - 1, 2) for k in range(size))))


def compact_bits(value: str | Column) -> Column:
    """The 32 bits of a compact float for a number from 0 on, to single precision."""

    @F.arrow_udf("bigint")
    def bits(column: pa.Array) -> pa.Array:
        raw = np.asarray(column.fill_null(0).cast(pa.float64())).astype(np.float32).view(np.uint32).astype(np.int64)
        return pc.if_else(column.is_valid(), pa.array(raw), pa.scalar(None, pa.int64()))

    return bits((F.col(value) if isinstance(value, str) else value).cast("double"))
