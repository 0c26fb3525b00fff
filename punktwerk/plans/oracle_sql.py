"""Helpers that build DuckDB oracle text (plain arithmetic SQL: the oracle
engine has no spatial functions)."""

from __future__ import annotations

import re
from types import SimpleNamespace

# GRS80 (rectifying radius in metres, first eccentricity) and the
# coefficients of the Krueger series for it, written out so that the oracles
# don't follow the code under test.
RECT_RADIUS = 6367449.145771048
ECC = 0.08181919104281579
ALPHA = (0.0008377318247344344, 7.608527788826164e-07, 1.1976380191731537e-09, 2.443376242510368e-12)
BETA = (0.000837732168164144, 5.905869626082731e-08, 1.6734889049883464e-10, 2.1677378055967573e-13)
DELTA = (0.0033565514855966932, 6.571873148458866e-06, 1.7646564264542834e-08, 5.400482187759887e-11)
# Central meridian, scale, false easting and northing.
PROJECTIONS = {25832: SimpleNamespace(lon0=9.0, k0=0.9996, fe=500000.0, fn=0.0),
               2180: SimpleNamespace(lon0=19.0, k0=0.9993, fe=500000.0, fn=-5300000.0)}
# Fixed value: the geohash alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def _edges(wkt: str):
    """Edges of a polygon's rings, read from its text."""
    for ring in re.findall(r"\(([^()]+)\)", wkt):
        pts = [tuple(float(v) for v in p.split()) for p in ring.split(",")]
        yield from ((*a, *b) for a, b in zip(pts, pts[1:]))


def d(v: float) -> str:
    """A double literal readable by DuckDB and Spark alike."""
    return f"cast({float(v)!r} as double)"


def edges_values(polys: dict[int, str]) -> str:
    """VALUES rows (poly_id, x1, y1, x2, y2) for the edges of WKT polygons."""
    rows = []
    for pid, wkt in polys.items():
        for x1, y1, x2, y2 in _edges(wkt):
            rows.append(f"({pid}, {d(x1)}, {d(y1)}, {d(x2)}, {d(y2)})")
    return "select * from (values " + ", ".join(rows) + ") as e(poly_id, x1, y1, x2, y2)"


CROSS_SQL = ("case when (e.y1 > p.y) <> (e.y2 > p.y) then "
             "p.x < ((p.y - e.y1) * (e.x2 - e.x1)) / (e.y2 - e.y1) + e.x1 else false end")
ON_SQL = ("(((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1)) = 0 "
          "and p.x between least(e.x1, e.x2) and greatest(e.x1, e.x2) "
          "and p.y between least(e.y1, e.y2) and greatest(e.y1, e.y2))")


def point_in_polys_sql(points_view: str, polys: dict[int, str], key: str) -> str:
    """Rows (poly_id, <key>, inside, on) for every point/polygon pair, by
    counting ray crossings per edge (parity) and an on-edge flag."""
    return (
        f"select e.poly_id, p.{key}, "
        f"sum(case when {CROSS_SQL} then 1 else 0 end) % 2 = 1 as odd, "
        f"bool_or({ON_SQL}) as on_edge "
        f"from {points_view} p, ({edges_values(polys)}) e group by e.poly_id, p.{key}")


# ---- transverse Mercator and geohash as SQL text (oracle side) ----------

def tm_inverse_sql(e: str, n: str, srid: int) -> tuple[str, str]:
    p = PROJECTIONS[srid]
    k = p.k0 * RECT_RADIUS
    xi = f"(({n}) - {d(p.fn)}) / {d(k)}"
    eta = f"(({e}) - {d(p.fe)}) / {d(k)}"
    xi1 = xi + "".join(f" - {d(b)} * sin({xi} * {2 * j}) * cosh({eta} * {2 * j})"
                       for j, b in enumerate(BETA, start=1))
    eta1 = eta + "".join(f" - {d(b)} * cos({xi} * {2 * j}) * sinh({eta} * {2 * j})"
                         for j, b in enumerate(BETA, start=1))
    chi = f"asin(sin({xi1}) / cosh({eta1}))"
    phi = chi + "".join(f" + {d(dd)} * sin({chi} * {2 * j})" for j, dd in enumerate(DELTA, start=1))
    lam = f"{d(p.lon0)} + degrees(atan2(sinh({eta1}), cos({xi1})))"
    return lam, f"degrees({phi})"


def tm_forward_sql(lon: str, lat: str, srid: int) -> tuple[str, str]:
    p = PROJECTIONS[srid]
    phi = f"radians({lat})"
    dlam = f"radians(({lon}) - {d(p.lon0)})"
    s = f"sin({phi})"
    t = f"sinh(atanh({s}) - {d(ECC)} * atanh({d(ECC)} * {s}))"
    xi = f"atan2({t}, cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt({d(1.0)} + {t} * {t}))"
    es = eta + "".join(f" + {d(a)} * cos({xi} * {2 * j}) * sinh({eta} * {2 * j})"
                       for j, a in enumerate(ALPHA, start=1))
    ns = xi + "".join(f" + {d(a)} * sin({xi} * {2 * j}) * cosh({eta} * {2 * j})"
                      for j, a in enumerate(ALPHA, start=1))
    k = p.k0 * RECT_RADIUS
    return f"{d(p.fe)} + {d(k)} * ({es})", f"{d(p.fn)} + {d(k)} * ({ns})"


def geohash_sql(lon: str, lat: str, precision: int) -> str:
    """Geohash text from lon/lat column names (the columns should be plain
    names: the expression repeats them)."""
    nbits = 5 * precision
    nlon, nlat = (nbits + 1) // 2, nbits // 2
    ilon = f"greatest(cast(ceil(({lon} + 180) / 360.0 * {float(1 << nlon)!r}) as bigint) - 1, 0)"
    ilat = f"greatest(cast(ceil(({lat} + 90) / 180.0 * {float(1 << nlat)!r}) as bigint) - 1, 0)"
    chars = []
    for k in range(precision):
        terms = []
        for m in range(5):
            j = 5 * k + m
            src, nb = (ilon, nlon) if j % 2 == 0 else (ilat, nlat)
            terms.append(f"(((({src}) >> {nb - 1 - j // 2}) & 1) << {4 - m})")
        chars.append(f"substring('{BASE32}', cast(({' | '.join(terms)}) + 1 as integer), 1)")
    return "concat(" + ", ".join(chars) + ")"
