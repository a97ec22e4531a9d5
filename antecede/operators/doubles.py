"""Sums of doubles that do not depend on the order of addition.

A double is cut into whole numbers by fixed bands of its binary exponent: band ``b``
holds the multiples of ``2 ** (WIDTH * b)`` up to half of the next band's unit. The cuts
are exact, a double touches two or three bands, and whole numbers add up exactly in any
order and however the rows were divided. The band sums become one double at the end.

All doubles together need 36 bands. Where the caller knows that values are zero or of a
magnitude within (low, high), only those bands are summed; a value outside is an error then.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 24
ALL_BANDS = range(math.floor(-1074 / WIDTH), math.floor(1024 / WIDTH) + 1)

# What is summed in a band are numbers of 23 bits, a trillion (2^40) of them before 64 are full,
# which is an error.

# So many bands are joined by one expression.
_INLINE = 12

Within = tuple[float, float]


def bands_within(within: Within | None) -> range:
    """The bands that values of a magnitude between two bounds touch."""
    if within is None:
        return ALL_BANDS
    low, high = (math.frexp(x)[1] for x in within)  # x < 2 ** exponent
    return range(math.floor((low - 54) / WIDTH), math.floor((high + 1) / WIDTH) + 1)


def _scaled(x: Column, exponent: int) -> Column:
    """``x * 2 ** exponent``, in steps a double can hold."""
    while exponent:
        step = max(-1000, min(1000, exponent))
        x, exponent = x * F.lit(math.ldexp(1.0, step)), exponent - step
    return x


def is_finite(x: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def _power(exponent: int) -> Column:
    """``2 ** exponent``, as near as a double comes: 0 below all of them, infinite above."""
    return F.lit(float("inf") if exponent > 1023 else math.ldexp(1.0, exponent))


def band_parts(value: Column, within: Within | None = None) -> dict[int, Column]:
    """The whole number a value has in each band, NULL (or 0) in bands it does not touch. NULL,
    NaN and infinite values are NULL everywhere; zero touches one band."""
    x = value.cast("double")
    size, bands = F.abs(x), bands_within(within)
    finite = is_finite(x)

    def part(b: int) -> Column:
        above = F.rint(_scaled(x, -WIDTH * (b + 1))) * F.lit(math.ldexp(1.0, WIDTH))
        return (F.rint(_scaled(x, -WIDTH * b)) - above).cast("bigint")

    if within is not None and max(map(abs, (bands[0], bands[-1]))) * WIDTH < 400:
        # Nothing can overflow on the way.
        told = F.concat(F.lit(f"not between {within[0]} and {within[1]}: "), x.cast("string"))
        outside = (size < within[0]) & (size > 0) | (size > within[1])
        return {b: F.when(finite, F.when(outside, F.raise_error(told).cast("bigint")).otherwise(part(b))) for b in bands}
    if within is not None:
        return band_parts(value)
    out = {}
    for b in bands:
        touched = finite & (size > _power(WIDTH * b - 1)) & (size < _power(WIDTH * (b + 1) + 53))
        out[b] = F.when(touched, part(b))
        if b == 0:
            out[b] = out[b].when(finite & (size == 0), 0)
    return out


def joined(sums: Mapping[int, Column]) -> Column:
    """The double nearest to the sum of all bands, but for the last place; NULL if every band is,
    infinite beyond the range of doubles. A function of the exact sum alone."""
    bands = sorted(sums)
    some = F.coalesce(*(sums[b] for b in bands)).isNotNull()
    if len(bands) <= _INLINE and max(map(abs, (bands[0], bands[-1]))) * WIDTH < 400:
        total, carry = F.lit(0.0), F.lit(0).cast("bigint")
        for b in bands:
            s = F.coalesce(sums[b], F.lit(0).cast("bigint")) + carry
            carry = _beyond(s)
            rest = s if b == bands[-1] else s - F.shiftleft(carry, WIDTH)
            total = total + rest.cast("double") * F.lit(math.ldexp(1.0, WIDTH * b))
        return F.when(some, total)

    # The band's unit in two factors, as not every power of two is a double. Bands above 0 are
    # added on a scale of their own: the upmost may round to what is no double any more.
    unit_of = {b: WIDTH * b - (4 * WIDTH if b > 0 else 0) for b in bands}
    each = [
        F.struct(
            F.coalesce(sums[b], F.lit(0).cast("bigint")).alias("s"),
            F.lit(math.ldexp(1.0, unit_of[b] // 2)).alias("f"),
            F.lit(math.ldexp(1.0, unit_of[b] - unit_of[b] // 2)).alias("g"),
            F.lit(b > 0).alias("above"),
            F.lit(b == bands[-1]).alias("last"),
        )
        for b in bands
    ]
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"))

    def add(state: Column, band: Column) -> Column:
        s = state["carry"] + band["s"]
        carry = F.when(band["last"], F.lit(0).cast("bigint")).otherwise(_beyond(s))
        term = (s - F.shiftleft(carry, WIDTH)).cast("double") * band["f"] * band["g"]
        low = F.when(band["above"], state["low"]).otherwise(state["low"] + term)
        high = F.when(band["above"], state["high"] + term).otherwise(state["high"])
        return F.struct(carry.alias("carry"), low.alias("low"), high.alias("high"))

    def both(state: Column) -> Column:
        small, large = F.lit(math.ldexp(1.0, -4 * WIDTH)), F.lit(math.ldexp(1.0, 4 * WIDTH))
        return F.when(state["high"] == 0, state["low"]).otherwise((state["high"] + state["low"] * small) * large)

    return F.when(some, F.aggregate(F.array(*each), start, add, both))


def _beyond(s: Column) -> Column:
    """What of a band's sum belongs to the next one, so that the rest is at most half of its unit
    and nothing cancels later."""
    return F.shiftright(s + F.lit(1 << (WIDTH - 1)), WIDTH)
