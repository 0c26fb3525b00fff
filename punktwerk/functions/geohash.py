"""Geohash as Column math: integer cell index per axis, bit interleave
(longitude first), base-32 text. Entirely code-generated.

A cell index is ``greatest(ceil((v - min) / range * 2^bits) - 1, 0)``: the
bisection with a strict ``v > mid`` step, so values exactly on a cell edge
fall into the lower cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punktwerk.functions.crs import st_transform

# Fixed value: the geohash base-32 alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cell(v: Column, lo: float, span: float, bits: int) -> Column:
    return F.greatest(F.ceil((v - F.lit(lo)) / F.lit(span) * F.lit(float(1 << bits))) - 1,
                      F.lit(0).cast("bigint"))


def _interleave(hi: int, lo: int, nhi: int, nlo: int) -> int:
    """Interleave the bits of ``hi`` (nhi bits) and ``lo`` (nlo bits),
    starting with the most significant bit of ``hi``."""
    out = 0
    for pos in range(nhi + nlo):
        if pos % 2 == 0:
            bit = (hi >> (nhi - 1 - pos // 2)) & 1
        else:
            bit = (lo >> (nlo - 1 - pos // 2)) & 1
        out = (out << 1) | bit
    return out


# A geohash character holds five interleaved bits. For even character
# positions these are three longitude and two latitude bits, for odd
# positions two longitude and three latitude bits. The two lookup strings
# map (lon chunk, lat chunk) to the character; they are derived from the
# alphabet by the interleave rule.
_LUT_EVEN = "".join(BASE32[_interleave(a, b, 3, 2)] for a in range(8) for b in range(4))
_LUT_ODD = "".join(BASE32[_interleave(b, a, 3, 2)] for a in range(4) for b in range(8))


def geohash(lon, lat, precision: int = 6) -> Column:
    """Geohash text of (lon, lat); null for null, NaN or out-of-range input."""
    if not 1 <= precision <= 12:
        raise ValueError("precision must be 1..12")
    lon, lat = _c(lon).cast("double"), _c(lat).cast("double")
    nbits = 5 * precision
    nlon, nlat = (nbits + 1) // 2, nbits // 2
    ilon = _cell(lon, -180.0, 360.0, nlon)
    ilat = _cell(lat, -90.0, 180.0, nlat)
    chars = []
    for k in range(precision):
        if k % 2 == 0:
            first = 5 * k // 2          # index (from the top) of the first lon/lat bit
            a = F.shiftright(ilon, nlon - 3 - first).bitwiseAND(7)
            b = F.shiftright(ilat, nlat - 2 - first).bitwiseAND(3)
            idx, lut = a * 4 + b, _LUT_EVEN
        else:
            first_lat = (5 * k - 1) // 2
            first_lon = (5 * k + 1) // 2
            a = F.shiftright(ilon, nlon - 2 - first_lon).bitwiseAND(3)
            b = F.shiftright(ilat, nlat - 3 - first_lat).bitwiseAND(7)
            idx, lut = a * 8 + b, _LUT_ODD
        chars.append(F.substring(F.lit(lut), (idx + 1).cast("int"), 1))
    valid = (lon >= -180) & (lon <= 180) & (lat >= -90) & (lat <= 90) & ~F.isnan(lon) & ~F.isnan(lat)
    return F.when(valid, F.concat(*chars))


def projected_geohash(x, y, srid: int = 25832, precision: int = 6) -> Column:
    """Geohash of projected coordinates (transform to lon/lat first)."""
    ll = st_transform(x, y, srid, 4326)
    return geohash(ll.x, ll.y, precision)


def with_geohash(df, x: str = "x", y: str = "y", srid: int = 25832, precision: int = 6,
                 out: str = "geohash"):
    """Add a geohash column to a point table (the enrichment step of the
    ingest)."""
    if srid == 4326:
        return df.withColumn(out, geohash(x, y, precision))
    return df.withColumn(out, projected_geohash(x, y, srid, precision))
