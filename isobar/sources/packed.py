"""Grids in simple packing: n-bit whole numbers with a reference, scales and a bitmap, read and written in the JVM.

A message is, in order and big-endian: count of points (4 bytes), reference R
(IEEE single), binary scale E and decimal scale D (2 bytes each, sign and
magnitude), bits n of a number (1 byte, 0..32), a flag (1 byte: 1 if a bitmap
follows), the bitmap (a bit a point, from the highest), and the packed numbers
X of the points that are there. A point's value is (R + X * 2^E) / 10^D; with
n = 0 all are R / 10^D. Points without a bit have no value. A null message, or
one shorter than its header says, has no points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.parse import let

HEADER = 14


def unsigned(data: Column, start: Column | int, width: Column | int) -> Column:
    """Bytes [start, start + width) of a binary as a number; up to 7 bytes."""
    part = F.substring(data, (F.lit(start) if isinstance(start, int) else start) + 1, F.lit(width) if isinstance(width, int) else width)
    return F.conv(F.hex(part), 16, 10).cast("long")


def _signed(x: Column) -> Column:
    """Sign and magnitude in 16 bits."""
    return F.when(x >= 32768, 32768 - x).otherwise(x)


def _single(x: Column) -> Column:
    """An IEEE single from its 32 bits (no infinities)."""
    exponent, mantissa = F.shiftright(x, 23).bitwiseAND(F.lit(255).cast("long")), x.bitwiseAND(F.lit((1 << 23) - 1).cast("long"))
    size = F.when(exponent == 0, mantissa * F.pow(F.lit(2.0), F.lit(-149))).otherwise((mantissa + (1 << 23)) * F.pow(F.lit(2.0), exponent - 150))
    return F.when(x >= 1 << 31, -size).otherwise(size)


def _number(data: Column, start: Column, bits: Column, k: Column) -> Column:
    """The k-th number of ``bits`` bits of the section that begins at byte ``start``."""
    first = k.cast("long") * bits
    byte = F.floor(first / 8)
    width = F.floor((first + bits + 7) / 8) - byte
    whole = unsigned(data, start + byte, width)
    drop = (byte + width) * 8 - first - bits
    return F.pmod(F.call_function("shiftright", whole, drop.cast("int")), F.call_function("shiftleft", F.lit(1).cast("long"), bits.cast("int")))


def unpacked(message: Column) -> Column:
    """array<struct<place, value>> of the points of a message that have a value, in order."""
    def read(h: Column) -> Column:
        count, bits = h["count"], h["bits"]
        all_points = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.array().cast("array<long>"))
        byte = lambda i: unsigned(message, F.lit(HEADER) + F.floor(i / 8), F.lit(1))
        there = F.filter(all_points, lambda i: F.pmod(F.call_function("shiftright", byte(i), (7 - F.pmod(i, F.lit(8))).cast("int")), F.lit(2)) == 1)
        places = F.when(h["flag"] == 1, there).otherwise(all_points)
        start = F.lit(HEADER) + F.when(h["flag"] == 1, F.floor((count + 7) / 8)).otherwise(0)
        return let(F.struct(places.alias("places"), start.alias("start")), lambda p: F.transform(p["places"], lambda i, k: F.struct(
            i.cast("int").alias("place"), ((h["r"] + F.when(bits == 0, F.lit(0)).otherwise(_number(message, p["start"], bits, k)) * F.pow(F.lit(2.0), h["e"])) / F.pow(F.lit(10.0), h["d"])).alias("value"),
        )))

    header = F.struct(
        unsigned(message, 0, 4).alias("count"), _single(unsigned(message, 4, 4)).alias("r"), _signed(unsigned(message, 8, 2)).alias("e"), _signed(unsigned(message, 10, 2)).alias("d"),
        unsigned(message, 12, 1).alias("bits"), unsigned(message, 13, 1).alias("flag"),
    )
    return F.when(F.octet_length(message) >= HEADER, let(header, read))


def _hex(x: Column, digits: int) -> Column:
    return F.lpad(F.hex(x.cast("long")), digits, "0")


def _bits_as_hex(bits: Column) -> Column:
    """A text of zeros and ones, filled to whole bytes, as hexadecimal digits."""
    whole = F.rpad(bits, (F.ceil(F.length(bits) / 8) * 8).cast("int"), F.lit("0"))
    return F.when(F.length(bits) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(whole) - 7, F.lit(8)), lambda i: F.lpad(F.conv(F.substring(whole, i, F.lit(8)), 2, 16), 2, "0")), "")).otherwise("")


def packed(values: Column, decimals: int) -> Column:
    """A message of an array of doubles, kept to ``decimals`` places; nulls and NaN have no bit. At most 32 bits a number, and a reference that a single holds (24 bits)."""
    scale = float(10**decimals)
    whole = F.transform(values.cast("array<double>"), lambda v: F.when(~F.isnan(v), F.floor(v * scale + 0.5)))

    def write(xs: Column) -> Column:
        there = F.filter(xs, lambda x: x.isNotNull())
        low = F.coalesce(F.array_min(there), F.lit(0))
        width = F.coalesce(F.length(F.bin(F.nullif(F.array_max(there) - low, F.lit(0).cast("long")))), F.lit(0))

        def body(h: Column) -> Column:
            numbers = F.array_join(F.transform(there, lambda x: F.when(h["width"] == 0, "").otherwise(F.lpad(F.bin(x - h["low"]), h["width"], F.lit("0")))), "")
            bitmap = F.array_join(F.transform(xs, lambda x: F.when(x.isNull(), "0").otherwise("1")), "")
            has = F.size(there) < F.size(xs)
            head = F.concat(_hex(F.size(xs), 8), _single_hex(h["low"]), F.lit("0000"), _hex(F.lit(decimals), 4), _hex(h["width"], 2), F.when(has, "01").otherwise("00"))
            return F.unhex(F.concat(head, F.when(has, _bits_as_hex(bitmap)).otherwise(""), _bits_as_hex(numbers)))

        return let(F.struct(low.alias("low"), width.alias("width")), body)

    return F.when(values.isNotNull(), let(whole, write))


def _single_hex(x: Column) -> Column:
    """A whole number of at most 24 bits as an IEEE single's digits."""
    size = F.abs(x).cast("long")
    top = F.length(F.bin(size)) - 1
    mantissa = F.call_function("shiftleft", size, (23 - top).cast("int")) - (1 << 23)
    bits = F.when(x < 0, 1 << 31).otherwise(0).cast("long") + (top + 127) * (1 << 23) + mantissa
    return F.when(x == 0, "00000000").otherwise(_hex(bits, 8))


def cells(messages: DataFrame, keys: list[str], message: str, width: int) -> DataFrame:
    """The cell table (keys, row, col, value) of row-major grids ``width`` columns wide."""
    each = messages.select(*keys, F.explode(unpacked(F.col(message))).alias("p"))
    return each.select(*keys, F.floor(F.col("p.place") / width).cast("int").alias("row"), F.pmod("p.place", F.lit(width)).cast("int").alias("col"), F.col("p.value").alias("value"))
