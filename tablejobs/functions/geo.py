"""Geohash of a point, in column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public geohash alphabet (digits and lower-case letters without a, i, l, o).
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lon: Column | str, lat: Column | str, length: int) -> Column:
    """First ``length`` geohash characters of a point in degrees. A shorter hash is a prefix of a longer one.

    Each coordinate becomes the number of its grid cell; the bits of the two numbers alternate, longitude first, and every
    five bits select one character. A point with a null coordinate has no hash; one outside the degrees of the globe is an
    error.
    """
    bits = 5 * length
    sizes = {"lon": (bits + 1) // 2, "lat": bits // 2}

    def cell(value: Column | str, span: float, size: int) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        scaled = F.floor((value + span / 2) / span * 2**size)
        outside = F.raise_error(F.concat(F.lit("no such coordinate: "), value.cast("string"))).cast("long")
        inside = F.when(value.between(-span / 2, span / 2), F.least(scaled, F.lit(2**size - 1))).otherwise(outside)
        return F.when(value.isNotNull(), inside)

    cells = {"lon": cell(lon, 360.0, sizes["lon"]), "lat": cell(lat, 180.0, sizes["lat"])}

    def bit(i: int) -> Column:
        axis = "lat" if i % 2 else "lon"
        return F.shiftright(cells[axis], sizes[axis] - 1 - i // 2).bitwiseAND(1)

    letters = []
    for c in range(length):
        digit = sum((bit(5 * c + j) * 2 ** (4 - j) for j in range(1, 5)), bit(5 * c) * 16)
        letters.append(F.substring(F.lit(BASE32), (digit + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)
