"""ST_* functions for SQL strings, registered as SQL-bodied temporary
functions (Spark 4). Their bodies are SQL expressions that Catalyst inlines
into the calling plan, so ``spark.sql("… st_contains(…) …")`` runs the same
JVM expressions as the DataFrame API, without Python.

A theta join written in SQL (``a, b WHERE st_distance(a.g, b.g) < d``)
still plans as a nested-loop join; spatial joins belong to
``punktwerk.operators.joins``, which emits grid equi-joins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from punktwerk.functions.crs import ALPHA, BETA, DELTA, ECC, GEOGRAPHIC, PROJECTIONS, RECT_RADIUS
from punktwerk.functions.geom import WKT_HEAD, WKT_SKELETONS, WKT_STEPS, WKT_TYPE
from punktwerk.functions.wkb import _udf

PARTS = "ARRAY<ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>>"
G = f"STRUCT<gtype: STRING, parts: {PARTS}>"

_EDGES = ("flatten(transform(flatten(g.parts), r -> transform("
          "arrays_zip(slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1)), "
          "e -> named_struct('x1', e['0'].x, 'y1', e['0'].y, 'x2', e['1'].x, 'y2', e['1'].y))))")

_LOCATE = (
    f"aggregate({_EDGES}, named_struct('n', 0, 'on', false), (acc, e) -> named_struct("
    "'n', acc.n + case when (e.y1 > py) <> (e.y2 > py) then "
    "case when px < ((py - e.y1) * (e.x2 - e.x1)) / (e.y2 - e.y1) + e.x1 then 1 else 0 end else 0 end, "
    "'on', acc.on or (((e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (px - e.x1)) = 0 "
    "and px between least(e.x1, e.x2) and greatest(e.x1, e.x2) "
    "and py between least(e.y1, e.y2) and greatest(e.y1, e.y2))))")

_RING_AREA2 = ("aggregate(arrays_zip(slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1)), 0d, "
               "(a, e) -> a + e['0'].x * e['1'].y - e['1'].x * e['0'].y)")



def _edges_of(g: str) -> str:
    return _EDGES.replace("g.parts", f"{g}.parts")


def _verts_of(g: str) -> str:
    return f"flatten(flatten({g}.parts))"


def _covered(g: str, x: str, y: str) -> str:
    """Polygon g covers the point (closed)."""
    at = _LOCATE.replace("g.parts", f"{g}.parts").replace("px", x).replace("py", y)
    return (f"({g}.gtype in ('POLYGON', 'MULTIPOLYGON') and aggregate(array({at}), false, "
            "(s, l) -> l.on or l.n % 2 = 1))")


def _side(a: str, b: str, c: str) -> str:
    """Sign of the turn from a over b to c; each is a pair of names."""
    (ax, ay), (bx, by), (cx, cy) = a, b, c
    return f"signum(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def _segments_meet(e: str, f: str) -> str:
    """Closed segments e and f share a point."""
    a, b = (f"{e}.x1", f"{e}.y1"), (f"{e}.x2", f"{e}.y2")
    c, d = (f"{f}.x1", f"{f}.y1"), (f"{f}.x2", f"{f}.y2")

    def on(p, q, r):
        return (f"({_side(p, q, r)} = 0 and {r[0]} between least({p[0]}, {q[0]}) and greatest({p[0]}, {q[0]}) "
                f"and {r[1]} between least({p[1]}, {q[1]}) and greatest({p[1]}, {q[1]}))")

    return (f"(({_side(a, b, c)} <> {_side(a, b, d)} and {_side(c, d, a)} <> {_side(c, d, b)}) "
            f"or {on(a, b, c)} or {on(a, b, d)} or {on(c, d, a)} or {on(c, d, b)})")


def _same_vertex(a: str, b: str) -> str:
    return f"exists({_verts_of(a)}, v -> exists({_verts_of(b)}, u -> u.x = v.x and u.y = v.y))"


def _vertex_on_edge(a: str, b: str) -> str:
    on = _segments_meet("named_struct('x1', v.x, 'y1', v.y, 'x2', v.x, 'y2', v.y)", "e")
    return f"exists({_verts_of(a)}, v -> exists({_edges_of(b)}, e -> {on}))"


def _intersects(a: str, b: str) -> str:
    return (f"({_same_vertex(a, b)} or exists({_edges_of(a)}, e -> exists({_edges_of(b)}, f -> {_segments_meet('e', 'f')})) "
            f"or {_vertex_on_edge(a, b)} or {_vertex_on_edge(b, a)} "
            f"or exists({_verts_of(a)}, v -> {_covered(b, 'v.x', 'v.y')}) or exists({_verts_of(b)}, v -> {_covered(a, 'v.x', 'v.y')}))")


def _vertex_distance(a: str, b: str) -> str:
    """Least distance from a vertex of a to a vertex or an edge of b."""
    t = ("greatest(0d, least(1d, ((v.x - e.x1) * (e.x2 - e.x1) + (v.y - e.y1) * (e.y2 - e.y1)) / "
         "nullif((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1), 0d)))")
    dx, dy = f"(v.x - e.x1 - coalesce({t}, 0d) * (e.x2 - e.x1))", f"(v.y - e.y1 - coalesce({t}, 0d) * (e.y2 - e.y1))"
    to_edge = f"array_min(transform({_edges_of(b)}, e -> sqrt({dx} * {dx} + {dy} * {dy})))"
    to_vertex = f"array_min(transform({_verts_of(b)}, u -> sqrt((v.x - u.x) * (v.x - u.x) + (v.y - u.y) * (v.y - u.y))))"
    return f"array_min(transform({_verts_of(a)}, v -> least({to_vertex}, {to_edge})))"


_DISTANCE = (f"case when a.gtype = 'POINT' and b.gtype = 'POINT' then {_vertex_distance('a', 'b')} "
             f"when {_intersects('a', 'b')} then 0d "
             f"else least({_vertex_distance('a', 'b')}, {_vertex_distance('b', 'a')}) end")


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "''") + "'"


def _from_text() -> str:
    """WKT by the same steps as ``geom.st_geomfromtext``."""
    w = "trim(wkt)"
    gtype = f"upper(regexp_extract({w}, {_quoted(WKT_TYPE)}, 1))"
    body = f"trim(regexp_replace({w}, {_quoted(WKT_HEAD)}, ''))"
    skeleton = body
    for pattern, short in WKT_STEPS:
        skeleton = f"regexp_replace({skeleton}, {_quoted(pattern)}, '{short}')"
    skeleton = f"regexp_replace({skeleton}, {_quoted('[ ]')}, '')"
    formed = " or ".join(f"({gtype} = '{t}' and {skeleton} in ({', '.join(repr(x) for x in ok)}))" for t, ok in WKT_SKELETONS.items())

    def verts(text):
        plain = f"trim(regexp_replace({text}, {_quoted('[()]')}, ''))"
        num = "try_cast(split(trim(q), {sp})[{i}] as double)"
        sp = _quoted(r"\s+")
        return (f"transform(split({plain}, {_quoted(r'\s*,\s*')}), q -> named_struct('x', {num.format(sp=sp, i=0)}, "
                f"'y', {num.format(sp=sp, i=1)}))")

    rings = f"transform(split({{0}}, {_quoted(r'\)\s*,\s*\(')}), t -> {verts('t')})"
    parts = (f"case when upper({body}) = 'EMPTY' then cast(array() as {PARTS}) "
             f"when {gtype} in ('POINT', 'LINESTRING') then array(array({verts(body)})) "
             f"when {gtype} = 'POLYGON' then array({rings.format(body)}) "
             f"when {gtype} = 'MULTIPOINT' then transform({verts(body)}, p -> array(array(p))) "
             f"when {gtype} = 'MULTILINESTRING' then transform({rings.format(body)}, r -> array(r)) "
             f"when {gtype} = 'MULTIPOLYGON' then transform(split({body}, {_quoted(r'\)\s*\)\s*,\s*\(\s*\(')}), s -> {rings.format('s')}) end")
    good_ring = (f"case when {gtype} = 'POINT' then size(r) = 1 when {gtype} like '%LINESTRING' then size(r) >= 2 "
                 f"when {gtype} like '%POLYGON' then size(r) >= 4 and r[0] = element_at(r, -1) else true end")
    return (f"case when upper({body}) = 'EMPTY' and {gtype} in ({', '.join(repr(t) for t in WKT_SKELETONS)}) "
            f"then named_struct('gtype', {gtype}, 'parts', cast(array() as {PARTS})) "
            f"when ({formed}) then aggregate(array({parts}), cast(null as {G}), (s, p) -> "
            f"case when forall(flatten(p), r -> {good_ring}) then named_struct('gtype', {gtype}, 'parts', p) end) end")


def _as_text() -> str:
    def num(v):
        return f"regexp_replace(cast({v} as string), {_quoted(r'[.]0$')}, '')"

    def ring(r):
        return f"concat('(', array_join(transform({r}, v -> concat({num('v.x')}, ' ', {num('v.y')})), ', '), ')')"

    def poly(p):
        return f"concat('(', array_join(transform({p}, r -> {ring('r')}), ', '), ')')"

    return (f"concat(g.gtype, case when size(g.parts) = 0 then ' EMPTY' "
            f"when g.gtype in ('POINT', 'LINESTRING') then concat(' ', {ring('g.parts[0][0]')}) "
            f"when g.gtype = 'POLYGON' then concat(' ', {poly('g.parts[0]')}) "
            f"when g.gtype = 'MULTIPOLYGON' then concat(' (', array_join(transform(g.parts, p -> {poly('p')}), ', '), ')') "
            f"else concat(' (', array_join(transform(g.parts, p -> {ring('p[0]')}), ', '), ')') end)")


def _from_geojson() -> str:
    c = "get_json_object(js, '$.coordinates')"
    v = "named_struct('x', {0}[0], 'y', {0}[1])"

    def read(depth):
        return f"from_json({c}, '{'array<' * depth}double{'>' * depth}')"

    def ring(r):
        return f"transform({r}, v -> {v.format('v')})"

    kinds = {"Point": f"array(array(array(named_struct('x', {read(1)}[0], 'y', {read(1)}[1]))))",
             "LineString": f"array(array({ring(read(2))}))",
             "MultiPoint": f"transform({read(2)}, q -> array(array({v.format('q')})))",
             "Polygon": f"array(transform({read(3)}, r -> {ring('r')}))",
             "MultiLineString": f"transform({read(3)}, r -> array({ring('r')}))",
             "MultiPolygon": f"transform({read(4)}, p -> transform(p, r -> {ring('r')}))"}
    cases = " ".join(f"when '{k}' then cast({x} as {PARTS})" for k, x in kinds.items())
    return (f"aggregate(array(case get_json_object(js, '$.type') {cases} end), cast(null as {G}), (s, p) -> case when p is not null and "
            "forall(flatten(flatten(p)), v -> v.x is not null and v.y is not null) "
            "then named_struct('gtype', upper(get_json_object(js, '$.type')), 'parts', p) end)")


def _transformed() -> str:
    """Every vertex from one code to another; null for unknown codes."""
    def number(code):
        return f"cast(regexp_extract({code}, '([0-9]+)$', 1) as int)"

    ahead = {GEOGRAPHIC: ("v.x", "v.y")} | {k: _inverse_sql("v.x", "v.y", k) for k in PROJECTIONS}
    lonlat = "case " + " ".join(f"when {number('src')} = {k} then named_struct('x', {x}, 'y', {y})" for k, (x, y) in ahead.items()) + " end"
    back = {GEOGRAPHIC: ("w.x", "w.y")} | {k: _forward_sql("w.x", "w.y", k) for k in PROJECTIONS}
    moved = "case " + " ".join(f"when {number('dst')} = {k} then named_struct('x', {x}, 'y', {y})" for k, (x, y) in back.items()) + " end"
    point = f"case when {number('src')} = {number('dst')} then v else element_at(transform(array({lonlat}), w -> {moved}), 1) end"
    return f"named_struct('gtype', g.gtype, 'parts', transform(g.parts, p -> transform(p, r -> transform(r, v -> {point}))))"


def _num(v: float) -> str:
    return f"cast({float(v)!r} as double)"


def _inverse_sql(e: str, n: str, code: int) -> tuple[str, str]:
    """Transverse Mercator metres to degrees, as SQL text."""
    p = PROJECTIONS[code]
    k = p.k0 * RECT_RADIUS
    xi, eta = f"(({n} - {_num(p.fn)}) / {_num(k)})", f"(({e} - {_num(p.fe)}) / {_num(k)})"
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, start=1):
        xi1 += f" - {_num(b)} * sin({xi} * {2 * j}) * cosh({eta} * {2 * j})"
        eta1 += f" - {_num(b)} * cos({xi} * {2 * j}) * sinh({eta} * {2 * j})"
    chi = f"asin(sin({xi1}) / cosh({eta1}))"
    phi = chi + "".join(f" + {_num(c)} * sin({chi} * {2 * j})" for j, c in enumerate(DELTA, start=1))
    return f"{_num(p.lon0)} + degrees(atan2(sinh({eta1}), cos({xi1})))", f"degrees({phi})"


def _forward_sql(lon: str, lat: str, code: int) -> tuple[str, str]:
    """Degrees to transverse Mercator metres, as SQL text."""
    p = PROJECTIONS[code]
    s, dlam = f"sin(radians({lat}))", f"radians({lon} - {_num(p.lon0)})"
    t = f"sinh(atanh({s}) - {_num(ECC)} * atanh({_num(ECC)} * {s}))"
    xi, eta = f"atan2({t}, cos({dlam}))", f"atanh(sin({dlam}) / sqrt(1d + {t} * {t}))"
    e, n = eta, xi
    for j, a in enumerate(ALPHA, start=1):
        e += f" + {_num(a)} * cos({xi} * {2 * j}) * sinh({eta} * {2 * j})"
        n += f" + {_num(a)} * sin({xi} * {2 * j}) * cosh({eta} * {2 * j})"
    k = p.k0 * RECT_RADIUS
    return f"{_num(p.fe)} + {_num(k)} * ({e})", f"{_num(p.fn)} + {_num(k)} * ({n})"


FUNCTIONS = {
    "st_point": (f"x DOUBLE, y DOUBLE", G,
                 "named_struct('gtype', 'POINT', 'parts', array(array(array(named_struct('x', x, 'y', y)))))"),
    "st_x": (f"g {G}", "DOUBLE", "g.parts[0][0][0].x"),
    "st_y": (f"g {G}", "DOUBLE", "g.parts[0][0][0].y"),
    "st_makeenvelope": ("minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE", G,
                        "named_struct('gtype', 'POLYGON', 'parts', array(array(array("
                        "named_struct('x', minx, 'y', miny), named_struct('x', maxx, 'y', miny), "
                        "named_struct('x', maxx, 'y', maxy), named_struct('x', minx, 'y', maxy), "
                        "named_struct('x', minx, 'y', miny)))))"),
    "st_polygon": ("c ARRAY<DOUBLE>", G,
                   "named_struct('gtype', 'POLYGON', 'parts', array(array("
                   "transform(sequence(0, cast(size(c) / 2 as int) - 1), i -> named_struct('x', c[2 * i], 'y', c[2 * i + 1]))"
                   ")))"),
    "st_distance": (f"a {G}, b {G}", "DOUBLE", _DISTANCE),
    "st_intersects": (f"a {G}, b {G}", "BOOLEAN", _intersects("a", "b")),
    "st_geomfromtext": ("wkt STRING", G, _from_text()),
    "st_geomfromwkt": ("wkt STRING", G, _from_text()),
    "st_astext": (f"g {G}", "STRING", _as_text()),
    "st_geomfromgeojson": ("js STRING", G, _from_geojson()),
    "st_transform": (f"g {G}, src STRING, dst STRING", G, _transformed()),
    "st_area": (f"g {G}", "DOUBLE",
                "case when g.gtype in ('POLYGON', 'MULTIPOLYGON') then aggregate(transform(g.parts, p -> "
                f"abs(aggregate(transform(slice(p, 1, 1), r -> {_RING_AREA2}), 0d, (s, v) -> s + v)) - "
                f"aggregate(transform(slice(p, 2, greatest(size(p) - 1, 0)), r -> abs({_RING_AREA2})), 0d, (s, v) -> s + v)), "
                "0d, (s, v) -> s + v) / 2 else 0d end"),
    "st_locate": (f"g {G}, px DOUBLE, py DOUBLE", "STRUCT<n: INT, on: BOOLEAN>", _LOCATE),
    "st_contains": (f"g {G}, p {G}", "BOOLEAN",
                    "g.gtype in ('POLYGON', 'MULTIPOLYGON') and exists(array("
                    "st_locate(g, p.parts[0][0][0].x, p.parts[0][0][0].y)), l -> not l.on and l.n % 2 = 1)"),
    "st_covers": (f"g {G}, p {G}", "BOOLEAN",
                  "g.gtype in ('POLYGON', 'MULTIPOLYGON') and "
                  "(st_locate(g, p.parts[0][0][0].x, p.parts[0][0][0].y).on or "
                  "st_locate(g, p.parts[0][0][0].x, p.parts[0][0][0].y).n % 2 = 1)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the ST_* temporary functions in this session."""
    for name, (params, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    # WKB needs bytes walked: an Arrow-batched function gives JSON text, and a
    # SQL-bodied one turns that into the shape. (Spark 4.1 has a built-in
    # st_geomfromwkb of its own geometry type, which can't be replaced.)
    spark.udf.register("_wkb_json", _udf("decode"))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION st_shapefromwkb(wkb STRING) RETURNS " + G +
              f" RETURN from_json(_wkb_json(unhex(wkb)), '{G}')")
    return [*FUNCTIONS, "st_shapefromwkb"]
