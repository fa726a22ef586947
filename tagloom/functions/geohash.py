"""Geohash of a coordinate, as one small expression."""

from pyspark.sql import Column, functions as F

# Fixed value: the geohash alphabet.
_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _pair(lon: int, lat: int) -> str:
    """The two characters of five longitude and five latitude bits, longitude first."""
    code = 0
    for bit in range(4, -1, -1):
        code = code << 2 | (lon >> bit & 1) << 1 | lat >> bit & 1
    return _ALPHABET[code >> 5] + _ALPHABET[code & 31]


_PAIRS = ",".join(_pair(lon, lat) for lon in range(32) for lat in range(32))


def geohash(longitude, latitude, length: int = 8) -> Column:
    """Cell of an even number of characters; NULL off the map or without a coordinate.

    Two characters at a time come from a table, which keeps the generated code small enough to
    be compiled.
    """
    if length % 2:
        raise ValueError("length must be even")
    bits = 5 * length // 2
    lon, lat = _cell(longitude, 180.0, bits), _cell(latitude, 90.0, bits)
    pairs = F.split(F.lit(_PAIRS), ",")

    def characters(shift):
        index = (F.shiftright(lon, shift).bitwiseAND(31) * 32
                 + F.shiftright(lat, shift).bitwiseAND(31))
        return F.get(pairs, index.cast("int"))

    on_map = longitude.between(-180, 180) & latitude.between(-90, 90)
    return F.when(on_map, F.concat(*[characters(s) for s in range(bits - 5, -1, -5)]))


def _cell(degrees, half_span, bits):
    """Number of the cell on one axis; the upper end belongs to the last cell."""
    cells = 1 << bits
    cell = F.floor((degrees.cast("double") + half_span) / (2 * half_span) * cells)
    return F.least(cell, F.lit(cells - 1).cast("bigint"))
