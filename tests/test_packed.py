"""Packed payloads against values decoded one by one."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from tickloom.sources import packed


def varint(n):
    out, size = [], abs(n)
    part = (64 if n < 0 else 0) | size & 63
    size >>= 6
    while size:
        out.append(part | 128)
        part, size = size & 127, size >> 7
    return bytes([*out, part])


def bits_text(values, width):
    bits = [v >> k & 1 for v in values for k in range(width)]
    bits += [0] * (-len(bits) % 6)
    return "".join(packed.ALPHABET[sum(b << k for k, b in enumerate(bits[i : i + 6]))] for i in range(0, len(bits), 6))


NUMBERS = [[], [0], [63, -63, 64, -64, 8191, 8192, -(1 << 40)], [(1 << 55) + 7, 1, -1], list(range(-70, 70))]


def test_varints(spark):
    rows = [(i, b"".join(map(varint, n)), n) for i, n in enumerate(NUMBERS)] + [(90, None, None), (91, b"\x81", [5]), (92, varint(3) + b"\xff", [1])]
    df = spark.createDataFrame(rows, "i int, payload binary, v array<bigint>").repartition(2)
    got = {r.i: r for r in df.select("i", packed.unpack_varints("payload").alias("a"), packed.unpack_varints("payload", deltas=True).alias("b"), packed.pack_varints("v").alias("c")).collect()}
    for i, n in enumerate(NUMBERS):
        assert list(got[i].a) == n and bytes(got[i].c) == rows[i][1]
        assert list(got[i].b) == [sum(n[: k + 1]) for k in range(len(n))]
    # no end, or nothing
    assert all(got[i].a is None and got[i].b is None for i in (90, 91, 92)) and got[90].c is None


@pytest.mark.parametrize("width", [1, 6, 7, 30, 45])
def test_bits(spark, width):
    rng = random.Random(width)
    lists = [[rng.randrange(1 << width) for _ in range(n)] for n in (0, 1, 2, 3, 50)]
    rows = [(i, bits_text(n, width), n) for i, n in enumerate(lists)] + [(90, None, None), (91, "AB-C", [1])]
    df = spark.createDataFrame(rows, "i int, payload string, v array<bigint>")
    got = {r.i: r for r in df.select("i", packed.unpack_bits("payload", width).alias("a"), packed.unpack_bits("payload", width, signed=True).alias("s"), packed.pack_bits("v", width).alias("c")).collect()}
    for i, n in enumerate(lists):
        assert got[i].c == rows[i][1]
        # what is left over may be long enough for more zeros
        assert list(got[i].a)[: len(n)] == n and not any(list(got[i].a)[len(n) :])
        assert list(got[i].s)[: len(n)] == [v - (1 << width) if v >> (width - 1) else v for v in n]
    assert got[90].a is None and got[90].c is None and got[91].a is None
    with pytest.raises(ValueError):
        packed.unpack_bits("payload", 63)


def test_compact_floats(spark):
    values = [0.0, 1.0, 1.5, 12345.0, 1e9, 0.001953125, 3.4e38]
    raws = [struct.unpack("<I", struct.pack("<f", v))[0] for v in values]
    rows = spark.createDataFrame(list(zip(values, raws, strict=True)), "v double, raw long").select("v", "raw", packed.compact_float("raw").alias("x"), packed.compact_bits("v").alias("b")).collect()
    for r, v, raw in zip(rows, values, raws, strict=True):
        assert r.x == struct.unpack("<f", struct.pack("<f", v))[0] and r.b == raw
    # a negative half of the exponent
    tiny = spark.createDataFrame([(0xFF000000,), (0xFFC00000,)], "raw long").select(packed.compact_float("raw").alias("x")).collect()
    assert [r.x for r in tiny] == [2.0**-129, 2.0**-128 * 1.5]


@pytest.mark.parametrize("intraday", [False, True])
def test_bar_records(spark, intraday):
    rng = random.Random(6)

    def payload(bars):
        out, last = struct.pack("<H", len(bars)), 0
        for date, minute, o, c, h, low, vol, amount in bars:
            out += struct.pack("<HH", (date // 10000 - 2004 << 11) + date % 10000, minute) if intraday else struct.pack("<I", date)
            out += varint(o - last) + varint(c - o) + varint(h - o) + varint(low - o) + struct.pack("<ff", vol, amount)
            last = c
        return out

    def bar():
        o = rng.randrange(1, 100_000)
        return (20_240_000 + rng.randrange(1, 13) * 100 + rng.randrange(1, 29), rng.randrange(1440) if intraday else 0, o, o + rng.randrange(-900, 900), o + 900, o - 900, float(rng.randrange(1 << 20)), float(rng.randrange(1 << 20)))

    made = {f"k{i}": [bar() for _ in range(n)] for i, n in enumerate((0, 1, 7, 40, 3))}
    rows = [(k, payload(bars)) for k, bars in made.items()] + [("cut", payload(made["k3"])[:-3]), ("short", b"\x01"), ("none", None), ("open", struct.pack("<HI", 1, 20240102) + b"\xff" * 5)]
    df = spark.createDataFrame(rows, "k string, raw binary").repartition(2)
    got = packed.bar_records(df, "raw", ["k"], intraday)
    assert got.columns == ["k", "place", *packed.BAR_FIELDS]
    assert sorted(map(tuple, got.collect())) == sorted((k, i, *b) for k, bars in made.items() for i, b in enumerate(bars))
    assert packed.bar_records(df.where("k = 'k0'"), "raw", ["k"], intraday).count() == 0


def test_little_endian(spark):
    row = spark.range(1).select(packed.little_endian(F.lit(0x01020304), 4).alias("a"), packed.little_endian(F.lit(5), 2).alias("b")).first()
    assert bytes(row.a) == b"\x04\x03\x02\x01" and bytes(row.b) == b"\x05\x00"
