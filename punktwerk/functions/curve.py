"""Z-order (Morton) keys of points as plain Column arithmetic: rows sorted by
the key lie near each other in x and in y, so the statistics of a file's row
groups prune a window in both directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The masks that spread 32 bits to every second of 64.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
BITS = 31


def _spread(v: Column) -> Column:
    for shift, mask in _SPREAD:
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def lattice(v: str | Column, low: float, step: float) -> Column:
    """The lattice line at or below a coordinate, within 31 bits. Null and
    NaN count as the lowest line."""
    v = F.col(v) if isinstance(v, str) else v
    at = F.floor((v - F.lit(float(low))) / F.lit(float(step)))
    return F.when(v.isNull() | F.isnan(v), F.lit(0)).otherwise(F.greatest(F.least(at, F.lit((1 << BITS) - 1)), F.lit(0))).cast("long")


def z_order(x: str | Column, y: str | Column, low: tuple[float, float] = (-2.0e7, -2.0e7), step: float = 0.125) -> Column:
    """62-bit Z-order key of a point: the bits of both lattice lines, by
    turns. The default lattice of 1/8 m covers any projected coordinate."""
    return _spread(lattice(x, low[0], step)).bitwiseOR(F.shiftleft(_spread(lattice(y, low[1], step)), 1))
