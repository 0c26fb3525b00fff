"""GeoJSON <-> shape struct, as Column expressions (``from_json`` /
``to_json``); no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punktwerk.functions.geom import PARTS_T

_COORD_SCHEMAS = {
    "Point": "array<double>",
    "LineString": "array<array<double>>",
    "MultiPoint": "array<array<double>>",
    "Polygon": "array<array<array<double>>>",
    "MultiLineString": "array<array<array<double>>>",
    "MultiPolygon": "array<array<array<array<double>>>>",
}
_TYPE_NAMES = {"Point": "POINT", "LineString": "LINESTRING", "Polygon": "POLYGON",
               "MultiPoint": "MULTIPOINT", "MultiLineString": "MULTILINESTRING",
               "MultiPolygon": "MULTIPOLYGON"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _v(a: Column) -> Column:
    return F.struct(F.get(a, 0).alias("x"), F.get(a, 1).alias("y"))


def _ring(r: Column) -> Column:
    return F.transform(r, _v)


def st_geomfromgeojson(geometry_json) -> Column:
    """Parse a GeoJSON geometry object (text) into the shape struct; unknown
    types or malformed coordinates give null."""
    j = _c(geometry_json)
    t = F.get_json_object(j, "$.type")
    coords = F.get_json_object(j, "$.coordinates")

    def parsed(kind):
        return F.from_json(coords, _COORD_SCHEMAS[kind])
    parts = (
        F.when(t == "Point", F.array(F.array(F.array(_v(parsed("Point"))))))
        .when(t == "LineString", F.array(F.array(_ring(parsed("LineString")))))
        .when(t == "MultiPoint", F.transform(parsed("MultiPoint"), lambda a: F.array(F.array(_v(a)))))
        .when(t == "Polygon", F.array(F.transform(parsed("Polygon"), _ring)))
        .when(t == "MultiLineString", F.transform(parsed("MultiLineString"), lambda r: F.array(_ring(r))))
        .when(t == "MultiPolygon", F.transform(parsed("MultiPolygon"), lambda p: F.transform(p, _ring)))
    ).cast(PARTS_T)
    gtype = F.try_element_at(F.create_map(*[x for k, v in _TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))]), t)
    bad = F.exists(F.flatten(F.flatten(parts)), lambda v: v.x.isNull() | v.y.isNull())
    return F.when(gtype.isNotNull() & parts.isNotNull() & ~bad,
                  F.struct(gtype.alias("gtype"), parts.alias("parts")))


def st_asgeojson(g) -> Column:
    """Shape -> GeoJSON geometry text."""
    g = _c(g)

    def ring(r):
        return F.transform(r, lambda v: F.array(v.x, v.y))

    def js(kind, coords):
        return F.to_json(F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")))
    p0 = F.get(g.parts, 0)
    return (
        F.when(g.gtype == "POINT", js("Point", F.array(F.get(p0, 0)[0].x, F.get(p0, 0)[0].y)))
        .when(g.gtype == "LINESTRING", js("LineString", ring(F.get(p0, 0))))
        .when(g.gtype == "POLYGON", js("Polygon", F.transform(p0, ring)))
        .when(g.gtype == "MULTIPOINT", js("MultiPoint", F.transform(g.parts, lambda p: F.array(
            F.get(F.get(p, 0), 0).x, F.get(F.get(p, 0), 0).y))))
        .when(g.gtype == "MULTILINESTRING", js("MultiLineString", F.transform(g.parts, lambda p: ring(F.get(p, 0)))))
        .when(g.gtype == "MULTIPOLYGON", js("MultiPolygon", F.transform(g.parts, lambda p: F.transform(p, ring))))
    )


def feature(g, properties: Column) -> Column:
    """GeoJSON Feature text: type, properties object, geometry object."""
    props = F.to_json(properties)
    return F.concat(F.lit('{"type":"Feature","properties":'), props,
                    F.lit(',"geometry":'), st_asgeojson(g), F.lit("}"))
