"""Geometry as Column expressions.

Bulk points stay as flat ``x``/``y`` double columns. Shapes use one struct

    struct<gtype:string, parts:array<array<array<struct<x:double,y:double>>>>>

(part -> ring -> vertex; ring 0 of a polygon part is the shell, the others
are holes; a point is one part with one ring of one vertex; a linestring is
one part with one open ring).

Everything here is a Catalyst expression. Functions that walk the vertices
of a shape column use higher-order functions (``transform``/``aggregate``),
which are interpreted rather than code-generated, so callers put cheap bbox
comparisons in front of them. A shape known on the driver (a literal WKT) is
unrolled into plain arithmetic instead (``contains_literal``), which stays
inside whole-stage codegen and needs no array at all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

VERTEX_T = "struct<x:double,y:double>"
PARTS_T = f"array<array<array<{VERTEX_T}>>>"
GEOM_T = f"struct<gtype:string,parts:{PARTS_T}>"

GEOM_TYPES = ("POINT", "LINESTRING", "POLYGON", "MULTIPOINT",
              "MULTILINESTRING", "MULTIPOLYGON")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# constructors
# --------------------------------------------------------------------------

def st_point(x, y) -> Column:
    """POINT shape from two numeric columns."""
    v = F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))
    return F.struct(F.lit("POINT").alias("gtype"),
                    F.array(F.array(F.array(v))).alias("parts"))


def st_rect(minx, miny, maxx, maxy) -> Column:
    """Closed counter-clockwise POLYGON for an axis-aligned rectangle."""
    minx, miny, maxx, maxy = (_c(c).cast("double") for c in (minx, miny, maxx, maxy))

    def v(a, b):
        return F.struct(a.alias("x"), b.alias("y"))

    ring = F.array(v(minx, miny), v(maxx, miny), v(maxx, maxy), v(minx, maxy), v(minx, miny))
    return F.struct(F.lit("POLYGON").alias("gtype"), F.array(F.array(ring)).alias("parts"))


def st_linestring(x1, y1, x2, y2) -> Column:
    """Two-point LINESTRING."""
    ring = F.array(F.struct(_c(x1).cast("double").alias("x"), _c(y1).cast("double").alias("y")),
                   F.struct(_c(x2).cast("double").alias("x"), _c(y2).cast("double").alias("y")))
    return F.struct(F.lit("LINESTRING").alias("gtype"), F.array(F.array(ring)).alias("parts"))


def _verts(s: Column) -> Column:
    """'x y, x y, ...' -> array<struct<x,y>>; unparseable numbers -> null."""
    def one(p):
        xy = F.split(F.trim(p), r"\s+")
        return F.struct(F.get(xy, 0).try_cast("double").alias("x"),
                        F.get(xy, 1).try_cast("double").alias("y"))
    return F.transform(F.split(F.trim(s), r"\s*,\s*"), one)


def _strip_parens(s: Column) -> Column:
    return F.regexp_replace(s, r"[()]", "")


_RING_SEP = r"\)\s*,\s*\("
_PART_SEP = r"\)\s*\)\s*,\s*\(\s*\("


def _rings(s: Column) -> Column:
    return F.transform(F.split(F.trim(s), _RING_SEP), lambda r: _verts(_strip_parens(r)))


# Steps that reduce the text behind the type to its skeleton: numbers to n,
# vertices to p, vertex lists to p, bracketed lists to r, lists of those to g.
_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
WKT_STEPS = ((_NUMBER, "n"), (r"n\s+n(?:\s+n){0,2}", "p"), (r"p\s*,\s*(?=p)", ""), (r"\(\s*p\s*\)", "r"),
             (r"r\s*,\s*(?=r)", ""), (r"\(\s*r\s*\)", "g"), (r"g\s*,\s*(?=g)", ""))
#: The skeletons that each type may have.
WKT_SKELETONS = {"POINT": ("r",), "LINESTRING": ("r",), "POLYGON": ("g",), "MULTIPOINT": ("r", "g"),
                 "MULTILINESTRING": ("g",), "MULTIPOLYGON": ("(g)",)}
WKT_TYPE = r"^([A-Za-z]+)"
WKT_HEAD = r"^[A-Za-z]+\s*(?:(?:ZM|Z|M|zm|z|m)\s*)?(?=\(|(?i:EMPTY)$)"


def st_geomfromtext(wkt) -> Column:
    """Parse WKT (POINT, LINESTRING, POLYGON and their MULTI forms, EMPTY;
    further ordinates are read and dropped).

    The whole text must match: unknown types, text before or after the shape,
    misplaced brackets, non-numeric coordinates, a point of several vertices,
    a line of one, and polygon rings that are open or have fewer than four
    vertices give null."""
    w = F.trim(_c(wkt))
    gtype = F.upper(F.regexp_extract(w, WKT_TYPE, 1))
    body = F.trim(F.regexp_replace(w, WKT_HEAD, ""))
    empty = F.upper(body) == F.lit("EMPTY")
    skeleton = body
    for pattern, short in WKT_STEPS:
        skeleton = F.regexp_replace(skeleton, pattern, short)
    formed = F.lit(False)
    for t, shapes in WKT_SKELETONS.items():
        formed = formed | ((gtype == t) & F.regexp_replace(skeleton, r"\s", "").isin(*shapes))
    parts = (
        F.when(empty, F.array().cast(PARTS_T))
        .when(gtype.isin("POINT", "LINESTRING"), F.array(F.array(_verts(_strip_parens(body)))))
        .when(gtype == "POLYGON", F.array(_rings(body)))
        .when(gtype == "MULTIPOINT",
              F.transform(_verts(_strip_parens(body)), lambda v: F.array(F.array(v))))
        .when(gtype == "MULTILINESTRING", F.transform(_rings(body), lambda r: F.array(r)))
        .when(gtype == "MULTIPOLYGON",
              F.transform(F.split(body, _PART_SEP), _rings))
    )
    bad_vertex = F.exists(F.flatten(F.flatten(parts)), lambda v: v.x.isNull() | v.y.isNull())
    rings = F.flatten(parts)
    bad_ring = (F.when(gtype == "POINT", F.exists(rings, lambda r: F.size(r) != 1))
                .when(gtype.isin("LINESTRING", "MULTILINESTRING"), F.exists(rings, lambda r: F.size(r) < 2))
                .when(gtype.isin("POLYGON", "MULTIPOLYGON"), F.exists(
                    rings, lambda r: (F.size(r) < 4) | (F.get(r, 0) != F.element_at(r, -1))))
                .otherwise(F.lit(False)))
    ok = gtype.isin(*GEOM_TYPES) & (empty | formed) & parts.isNotNull() & ~bad_vertex & ~bad_ring
    return F.when(ok, F.struct(gtype.alias("gtype"), parts.alias("parts")))


def _num_text(v: Column) -> Column:
    # shortest decimal text; integral values without the trailing '.0'
    return F.regexp_replace(v.cast("string"), r"\.0$", "")


def _ring_text(ring: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(
        F.transform(ring, lambda v: F.concat(_num_text(v.x), F.lit(" "), _num_text(v.y))),
        ", "), F.lit(")"))


def st_astext(g) -> Column:
    """Shape -> WKT text."""
    g = _c(g)
    parts = g.parts

    def poly_text(part):
        return F.concat(F.lit("("), F.array_join(F.transform(part, _ring_text), ", "), F.lit(")"))

    body = (
        F.when(F.size(parts) == 0, F.lit(" EMPTY"))
        .when(g.gtype.isin("POINT", "LINESTRING"), F.concat(F.lit(" "), _ring_text(F.get(F.get(parts, 0), 0))))
        .when(g.gtype == "POLYGON", F.concat(F.lit(" "), poly_text(F.get(parts, 0))))
        .when(g.gtype == "MULTIPOINT", F.concat(F.lit(" ("), F.array_join(
            F.transform(parts, lambda p: _ring_text(F.get(p, 0))), ", "), F.lit(")")))
        .when(g.gtype == "MULTILINESTRING", F.concat(F.lit(" ("), F.array_join(
            F.transform(parts, lambda p: _ring_text(F.get(p, 0))), ", "), F.lit(")")))
        .when(g.gtype == "MULTIPOLYGON", F.concat(F.lit(" ("), F.array_join(
            F.transform(parts, poly_text), ", "), F.lit(")")))
    )
    return F.concat(g.gtype, body)


# --------------------------------------------------------------------------
# accessors
# --------------------------------------------------------------------------

def st_vertices(g) -> Column:
    """All vertices of a shape as one array (closing vertices included)."""
    return F.flatten(F.flatten(_c(g).parts))


def st_numpoints(g) -> Column:
    return F.size(st_vertices(g))


def st_isempty(g) -> Column:
    return F.size(_c(g).parts) == 0


def st_envelope(g) -> Column:
    """struct<minx,miny,maxx,maxy> of a shape (null for empty shapes)."""
    vs = st_vertices(g)
    xs = F.transform(vs, lambda v: v.x)
    ys = F.transform(vs, lambda v: v.y)
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def with_bbox(df, geom_col: str, prefix: str = ""):
    """Attach flat bbox columns next to a shape column; flat doubles are what
    joins, range filters and Parquet statistics work on."""
    env = st_envelope(geom_col)
    return (df.withColumn("_env", env)
            .withColumn(f"{prefix}minx", F.col("_env.minx"))
            .withColumn(f"{prefix}miny", F.col("_env.miny"))
            .withColumn(f"{prefix}maxx", F.col("_env.maxx"))
            .withColumn(f"{prefix}maxy", F.col("_env.maxy"))
            .drop("_env"))


def _ring_signed_area2(ring: Column) -> Column:
    """Twice the signed shoelace area; works for closed and open rings."""
    n = F.size(ring)
    return F.when(n >= 3, F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0.0),
        lambda acc, i: acc + (F.get(ring, i).x * F.get(ring, (i + 1) % n).y
                              - F.get(ring, (i + 1) % n).x * F.get(ring, i).y))).otherwise(F.lit(0.0))


def st_area(g) -> Column:
    """Planar area: per polygon part |shell| minus |holes|; 0 for points and
    lines."""
    g = _c(g)

    def part_area2(p):
        holes = F.slice(F.transform(p, lambda r: F.abs(_ring_signed_area2(r))), 2, 1 << 30)
        return F.abs(_ring_signed_area2(F.get(p, 0))) - F.aggregate(holes, F.lit(0.0), lambda a, b: a + b)
    total = F.aggregate(F.transform(g.parts, part_area2), F.lit(0.0), lambda acc, a: acc + a)
    return F.when(g.gtype.isin("POLYGON", "MULTIPOLYGON"), total / 2).otherwise(F.lit(0.0))


def _edges(g) -> Column:
    """array<struct<x1,y1,x2,y2>> of consecutive vertex pairs of every ring."""
    def ring_edges(r):
        n = F.size(r)
        return F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(
            F.get(r, i).x.alias("x1"), F.get(r, i).y.alias("y1"),
            F.get(r, i + 1).x.alias("x2"), F.get(r, i + 1).y.alias("y2")))).otherwise(
            F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))
    return F.flatten(F.transform(F.flatten(_c(g).parts), ring_edges))


# --------------------------------------------------------------------------
# point / segment primitives (shared by the literal and the column forms)
# --------------------------------------------------------------------------

def _crosses(x1, y1, x2, y2, px, py) -> Column:
    """Edge crosses the ray from (px,py) towards +x (half-open in y)."""
    return F.when((y1 > py) != (y2 > py),
                  px < ((py - y1) * (x2 - x1)) / (y2 - y1) + x1).otherwise(F.lit(False))


def _on_segment(x1, y1, x2, y2, px, py) -> Column:
    return (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) == 0) \
        & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2)) \
        & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2))


def _seg_point_dist(x1, y1, x2, y2, px, py) -> Column:
    dx, dy = x2 - x1, y2 - y1
    l2 = dx * dx + dy * dy
    t = F.when(l2 == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.when(l2 == 0, 1.0).otherwise(l2))))
    qx, qy = x1 + t * dx, y1 + t * dy
    return F.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))


def point_location(g, px, py) -> Column:
    """struct<n:int, on:boolean>: ray crossings over all rings and whether
    the point lies on an edge. Interior = not on and n odd."""
    px, py = _c(px), _c(py)
    init = F.struct(F.lit(0).alias("n"), F.lit(False).alias("on"))
    return F.aggregate(_edges(g), init, lambda acc, e: F.struct(
        (acc.n + F.when(_crosses(e.x1, e.y1, e.x2, e.y2, px, py), 1).otherwise(0)).alias("n"),
        (acc.on | _on_segment(e.x1, e.y1, e.x2, e.y2, px, py)).alias("on")))


def st_contains_xy(g, px, py) -> Column:
    """Polygon shape contains point (px,py) in its interior (boundary = out)."""
    loc = point_location(g, px, py)
    return _c(g).gtype.isin("POLYGON", "MULTIPOLYGON") & ~loc.on & (loc.n % 2 == 1)


def st_covers_xy(g, px, py) -> Column:
    """Closed version: boundary points count (polygons); for lines/points the
    point must lie on the shape."""
    loc = point_location(g, px, py)
    poly = _c(g).gtype.isin("POLYGON", "MULTIPOLYGON")
    on_pt = F.exists(st_vertices(g), lambda v: (v.x == _c(px)) & (v.y == _c(py)))
    return F.when(poly, loc.on | (loc.n % 2 == 1)).otherwise(loc.on | on_pt)


def st_distance_xy(g, px, py) -> Column:
    """Planar distance from a shape to a point (0 inside polygons)."""
    px, py = _c(px), _c(py)
    g = _c(g)
    edges = _edges(g)
    seg = F.array_min(F.transform(edges, lambda e: _seg_point_dist(e.x1, e.y1, e.x2, e.y2, px, py)))
    vert = F.array_min(F.transform(st_vertices(g), lambda v: F.sqrt((v.x - px) * (v.x - px) + (v.y - py) * (v.y - py))))
    d = F.least(F.coalesce(seg, vert), vert)
    return F.when(st_covers_xy(g, px, py) & g.gtype.isin("POLYGON", "MULTIPOLYGON"), F.lit(0.0)).otherwise(d)


def _segments_intersect(a, b) -> Column:
    """Closed segment intersection (touching and collinear overlap count)."""
    def orient(ax, ay, bx, by, cx, cy):
        return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))
    o1 = orient(a.x1, a.y1, a.x2, a.y2, b.x1, b.y1)
    o2 = orient(a.x1, a.y1, a.x2, a.y2, b.x2, b.y2)
    o3 = orient(b.x1, b.y1, b.x2, b.y2, a.x1, a.y1)
    o4 = orient(b.x1, b.y1, b.x2, b.y2, a.x2, a.y2)

    def within(x1, y1, x2, y2, px, py):
        return (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2)) \
            & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2))
    return (((o1 != o2) & (o3 != o4))
            | ((o1 == 0) & within(a.x1, a.y1, a.x2, a.y2, b.x1, b.y1))
            | ((o2 == 0) & within(a.x1, a.y1, a.x2, a.y2, b.x2, b.y2))
            | ((o3 == 0) & within(b.x1, b.y1, b.x2, b.y2, a.x1, a.y1))
            | ((o4 == 0) & within(b.x1, b.y1, b.x2, b.y2, a.x2, a.y2)))


def st_intersects(a, b) -> Column:
    """Closed intersection test between two shapes: an edge of one meets an
    edge of the other, or a vertex of one is covered by the other. Named
    columns are read in place; an expression (a text's parse, say) is bound
    once: the test names its shapes so often that copies of it fill the heap."""
    if isinstance(a, str) and isinstance(b, str):
        return _intersect(F.col(a), F.col(b))
    both = F.array(F.struct(_c(a).alias("a"), _c(b).alias("b")))
    return F.get(F.transform(both, lambda s: _intersect(s["a"], s["b"])), F.lit(0))


def _intersect(a: Column, b: Column) -> Column:
    segments = _is_segment(a) & _is_segment(b)
    return F.when(segments, _segments_intersect(_first_edge(a), _first_edge(b))).otherwise(_shapes_intersect(a, b))


class _Edge:
    """An edge whose ends are columns of their own, not fields of a struct."""

    def __init__(self, p: Column, q: Column):
        self.x1, self.y1, self.x2, self.y2 = p.x, p.y, q.x, q.y


def _is_segment(g: Column) -> Column:
    """A line of two vertices."""
    return (g.gtype == "LINESTRING") & (F.size(F.get(F.get(g.parts, 0), 0)) == 2)


def _first_edge(g: Column) -> _Edge:
    ring = F.get(F.get(g.parts, 0), 0)
    return _Edge(F.get(ring, 0), F.get(ring, 1))


def _shapes_intersect(a: Column, b: Column) -> Column:
    ea, eb = _edges(a), _edges(b)
    cross = F.exists(ea, lambda e1: F.exists(eb, lambda e2: _segments_intersect(e1, e2)))
    a_in_b = F.exists(st_vertices(a), lambda v: st_covers_xy(b, v.x, v.y))
    b_in_a = F.exists(st_vertices(b), lambda v: st_covers_xy(a, v.x, v.y))
    return cross | a_in_b | b_in_a


def st_distance(a, b) -> Column:
    """Planar distance between two shapes: 0 if they intersect, otherwise the
    smallest vertex-to-shape distance in either direction."""
    meet = st_intersects(a, b)
    a, b = _c(a), _c(b)
    da = F.array_min(F.transform(st_vertices(a), lambda v: st_distance_xy(b, v.x, v.y)))
    db = F.array_min(F.transform(st_vertices(b), lambda v: st_distance_xy(a, v.x, v.y)))
    return F.when(meet, F.lit(0.0)).otherwise(F.least(da, db))


def dist_xy(x1, y1, x2, y2) -> Column:
    """Point-point Euclidean distance on flat columns (codegen)."""
    dx = _c(x1) - _c(x2)
    dy = _c(y1) - _c(y2)
    return F.sqrt(dx * dx + dy * dy)


def rounded(v, digits: int) -> Column:
    """``round(v, digits)`` of a double, to the last bit, as plain arithmetic.

    Spark's own goes through a decimal object for every value. Here only
    values next to a tie (within 1e-6 of a unit, beyond what the product can
    be off) and values of 1e9 units or more do."""
    v = _c(v)
    unit = F.lit(float(10 ** digits))
    at = v * unit
    near = F.rint(at)
    sure = (F.abs(at) < 1e9) & (F.abs(at - near) < 0.5 - 1e-6)
    # a sum with 0.0 has no negative zero, as the decimal has none
    return F.when(sure, (near + 0.0) / unit).otherwise(F.round(v, digits))


# --------------------------------------------------------------------------
# literal shapes, unrolled
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Shape:
    """A shape known on the driver (parsed from a WKT literal)."""
    gtype: str
    parts: tuple  # tuple[tuple[tuple[tuple[float, float], ...], ...], ...]

    @property
    def vertices(self):
        return [v for p in self.parts for r in p for v in r]

    @property
    def bbox(self):
        xs = [v[0] for v in self.vertices]
        ys = [v[1] for v in self.vertices]
        return min(xs), min(ys), max(xs), max(ys)

    @property
    def edges(self):
        out = []
        for p in self.parts:
            for r in p:
                out.extend((r[i][0], r[i][1], r[i + 1][0], r[i + 1][1]) for i in range(len(r) - 1))
        return out

    def wkt(self) -> str:
        def num(v):
            s = repr(float(v))
            return s[:-2] if s.endswith(".0") else s

        def ring(r):
            return "(" + ", ".join(f"{num(x)} {num(y)}" for x, y in r) + ")"

        def poly(p):
            return "(" + ", ".join(ring(r) for r in p) + ")"
        if not self.parts:
            return f"{self.gtype} EMPTY"
        if self.gtype in ("POINT", "LINESTRING"):
            return f"{self.gtype} {ring(self.parts[0][0])}"
        if self.gtype == "POLYGON":
            return f"POLYGON {poly(self.parts[0])}"
        if self.gtype in ("MULTIPOINT", "MULTILINESTRING"):
            return f"{self.gtype} (" + ", ".join(ring(p[0]) for p in self.parts) + ")"
        return "MULTIPOLYGON (" + ", ".join(poly(p) for p in self.parts) + ")"


def parse_wkt_literal(text: str) -> Shape:
    """Parse a WKT literal on the driver (used to unroll predicates)."""
    m = re.match(r"\s*([A-Za-z]+)\s*(.*)$", text, re.S)
    if not m:
        raise ValueError(f"not WKT: {text[:40]!r}")
    gtype, body = m.group(1).upper(), m.group(2).strip()
    if gtype not in GEOM_TYPES:
        raise ValueError(f"unsupported geometry type {gtype}")
    if body.upper() == "EMPTY":
        return Shape(gtype, ())

    def verts(s):
        out = []
        for p in s.replace("(", "").replace(")", "").split(","):
            x, y = p.split()[:2]
            out.append((float(x), float(y)))
        return tuple(out)

    def rings(s):
        return tuple(verts(r) for r in re.split(_RING_SEP, s))
    if gtype in ("POINT", "LINESTRING"):
        parts = ((verts(body),),)
    elif gtype == "POLYGON":
        parts = (rings(body),)
    elif gtype == "MULTIPOINT":
        parts = tuple(((v,),) for v in verts(body))
    elif gtype == "MULTILINESTRING":
        parts = tuple((r,) for r in rings(body))
    else:
        parts = tuple(rings(p) for p in re.split(_PART_SEP, body))
    return Shape(gtype, parts)


def shape_of(row) -> Shape:
    """The driver-side shape of a collected shape value."""
    return Shape(row.gtype, tuple(tuple(tuple((v.x, v.y) for v in r) for r in p) for p in row.parts))


def shape_literal(shape: Shape | str) -> Column:
    """A driver-side shape as a struct literal column."""
    if isinstance(shape, str):
        shape = parse_wkt_literal(shape)

    def v(x, y):
        return F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    parts = F.array(*[F.array(*[F.array(*[v(x, y) for x, y in r]) for r in p]) for p in shape.parts]) \
        if shape.parts else F.array()
    return F.struct(F.lit(shape.gtype).alias("gtype"), parts.cast(PARTS_T).alias("parts"))


def _lit(v: float) -> Column:
    return F.lit(float(v))


def crossings_literal(shape: Shape, px: Column, py: Column) -> Column:
    terms = []
    for x1, y1, x2, y2 in shape.edges:
        if y1 == y2:
            continue  # horizontal edges never cross a horizontal ray
        terms.append(F.when(_crosses(_lit(x1), _lit(y1), _lit(x2), _lit(y2), px, py), 1).otherwise(0))
    if not terms:
        return F.lit(0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def on_boundary_literal(shape: Shape, px: Column, py: Column) -> Column:
    conds = []
    for x1, y1, x2, y2 in shape.edges:
        if y1 == y2:
            conds.append((py == _lit(y1)) & (px >= _lit(min(x1, x2))) & (px <= _lit(max(x1, x2))))
        elif x1 == x2:
            conds.append((px == _lit(x1)) & (py >= _lit(min(y1, y2))) & (py <= _lit(max(y1, y2))))
        else:
            conds.append(_on_segment(_lit(x1), _lit(y1), _lit(x2), _lit(y2), px, py))
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def bbox_filter_literal(shape: Shape, px, py, boundary: bool) -> Column:
    """Range predicates on the raw columns; they reach the Parquet scan as
    pushed filters when px/py are stored columns."""
    minx, miny, maxx, maxy = shape.bbox
    px, py = _c(px), _c(py)
    if boundary:
        return (px >= minx) & (px <= maxx) & (py >= miny) & (py <= maxy)
    return (px > minx) & (px < maxx) & (py > miny) & (py < maxy)


def is_axis_rectangle(shape: Shape) -> bool:
    """A single-ring polygon that is exactly its bounding box."""
    if shape.gtype != "POLYGON" or len(shape.parts) != 1 or len(shape.parts[0]) != 1:
        return False
    ring = shape.parts[0][0]
    if len(ring) != 5 or ring[0] != ring[-1]:
        return False
    minx, miny, maxx, maxy = shape.bbox
    corners = {(minx, miny), (minx, maxy), (maxx, miny), (maxx, maxy)}
    edges_axis = all(x1 == x2 or y1 == y2 for x1, y1, x2, y2 in shape.edges)
    return set(ring[:4]) == corners and edges_axis


def exact_literal(shape: Shape | str, px="x", py="y", boundary: bool = False) -> Column:
    """The exact point-in-polygon part of ``contains_literal`` without the
    bbox pre-filter (for use where the bbox is already applied)."""
    if isinstance(shape, str):
        shape = parse_wkt_literal(shape)
    px, py = _c(px), _c(py)
    if is_axis_rectangle(shape):
        return bbox_filter_literal(shape, px, py, boundary)
    odd = (crossings_literal(shape, px, py) % 2) == 1
    on = on_boundary_literal(shape, px, py)
    return (odd | on) if boundary else (odd & ~on)


def contains_literal(shape: Shape | str, px="x", py="y", boundary: bool = False) -> Column:
    """Point-in-polygon against a driver-side polygon, unrolled into plain
    arithmetic (one term per edge) behind a bbox pre-filter.

    boundary=False: interior only (ST_Contains / ST_Within semantics).
    boundary=True: closed (ST_Covers / ST_Intersects for points)."""
    if isinstance(shape, str):
        shape = parse_wkt_literal(shape)
    if shape.gtype not in ("POLYGON", "MULTIPOLYGON"):
        raise ValueError("contains_literal needs a polygon")
    px, py = _c(px), _c(py)
    bb = bbox_filter_literal(shape, px, py, boundary)
    if is_axis_rectangle(shape):
        return bb
    return bb & exact_literal(shape, px, py, boundary)


def st_within_xy(g, px, py) -> Column:
    """Point (px, py) within polygon g: the same interior test as
    ``st_contains_xy`` with the arguments the other way round."""
    return st_contains_xy(g, px, py)


def st_touches_xy(g, px, py) -> Column:
    """Point touches polygon: on its boundary, not in its interior."""
    return _c(g).gtype.isin("POLYGON", "MULTIPOLYGON") & point_location(g, px, py).on


def st_touches_bbox(a_minx, a_miny, a_maxx, a_maxy, b_minx, b_miny, b_maxx, b_maxy) -> Column:
    """Rectangles touch: closed boxes meet, the intersection has no area."""
    ix0, iy0 = F.greatest(_c(a_minx), _c(b_minx)), F.greatest(_c(a_miny), _c(b_miny))
    ix1, iy1 = F.least(_c(a_maxx), _c(b_maxx)), F.least(_c(a_maxy), _c(b_maxy))
    return (ix0 <= ix1) & (iy0 <= iy1) & ((ix0 == ix1) | (iy0 == iy1))
