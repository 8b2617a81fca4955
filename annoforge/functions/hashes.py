"""64-bit hashes: distance, bands, and making them from pixels or signs."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_hex(c: Column) -> Column:
    """16 hex digits as a signed 64-bit integer."""
    return F.conv(c, 16, -10).cast("bigint")


def to_hex(c: Column) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def band_plan(distance: int, bits: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of distance + 1 bands, most significant first; the first ones take what does not divide."""
    n = distance + 1
    if not 1 <= n <= bits:
        raise ValueError("distance must be from 0 to bits - 1")
    size, longer = divmod(bits, n)
    out, left = [], bits
    for i in range(n):
        width = size + (i < longer)
        left -= width
        out.append((left, width))
    return out


def bands(c: Column, distance: int) -> Column:
    """Array of band values of a 64-bit integer: two hashes within the distance agree in one at least."""
    return F.array(*[F.shiftrightunsigned(c, shift).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else c for shift, width in band_plan(distance)])


def aspect_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(a, b)


def sign_hash(vector: Column) -> Column:
    """Bit i is set where component i is positive."""
    bits = F.transform(F.slice(vector, 1, 64), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for the row, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bits_hex(bits: Column) -> Column:
    """Upper-case hex of an array of 0 and 1, the first the highest; four of them to a digit."""

    def digits(held: Column) -> Column:
        each = lambda i: F.conv(F.array_join(F.slice(held, i * 4 + 1, 4).cast("array<string>"), ""), 2, 16)
        return F.array_join(F.transform(F.sequence(F.lit(0), (F.size(held) / 4).cast("int") - 1), each), "")

    return once(bits, digits)


def dhash(luma: Column, side: int = 8) -> Column:
    """Difference hash of side rows of side + 1 luma values, already resampled: each value against the next in its row."""
    at = F.sequence(F.lit(0), F.lit(side * side - 1))
    place = lambda i: F.floor(i / side).cast("int") * (side + 1) + i % side
    return once(luma, lambda held: bits_hex(F.transform(at, lambda i: (F.get(held, place(i)) > F.get(held, place(i) + 1)).cast("int"))))


def phash(luma: Column, side: int = 8) -> Column:
    """Perceptual hash of a square of 4 * side luma values a side, already resampled: low frequencies of its cosine
    transform against their median, the constant one left out of that."""
    n = 4 * side
    wave = [[math.sqrt((1 if u == 0 else 2) / n) * math.cos(math.pi * (2 * x + 1) * u / (2 * n)) for x in range(n)] for u in range(side)]
    waves = F.array(*[F.array(*map(F.lit, row)) for row in wave])

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)

    def against(low: Column) -> Column:
        median = F.get(F.array_sort(F.slice(low, 2, side * side - 1)), F.lit((side * side - 1) // 2))
        return bits_hex(once(median, lambda m: F.transform(low, lambda v: (v >= m).cast("int"))))

    lines = lambda held: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda r: F.slice(held, r * n + 1, n))
    across = lambda rows: F.transform(waves, lambda w: F.transform(rows, lambda row: dot(row, w)))  # noqa: E731  # [frequency across][row]
    down = lambda columns: F.flatten(F.transform(waves, lambda w: F.transform(columns, lambda column: dot(column, w))))
    return once(once(once(once(luma, lines), across), down), against)
