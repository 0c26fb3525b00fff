"""The query catalog: one entry per operator of the blueprint's inventory.

Every query reads the driver's tables (or data Spark derives from them) and
runs over them whole. Oracle text is plain DuckDB SQL over the same tables;
derived views are inlined as CTEs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from punktwerk.functions import geom as G
from punktwerk.operators import aggs as A
from punktwerk.plans import fixtures as X
from punktwerk.plans.oracle_sql import d, point_in_polys_sql
from punktwerk.plans.registry import query

PTS = {"pts": X.PTS_SQL}
PTS_SRC = {"pts": X.PTS_SRC_SQL}


# --------------------------------------------------------------------------
# flagship: region statistics (point-in-polygon + global aggregate)
# --------------------------------------------------------------------------

@query("region_stats", X.with_ctes(
    "select count(*) as total_points, "
    "count(case when classification = 2 then 1 end) as ground_points, "
    "min(z) as min_z, max(z) as max_z, round(avg(z), 6) as avg_z "
    f"from pts where x > {d(280000)} and x < {d(288500)} and y > {d(5626000)} and y < {d(5747500)}",
    **PTS))
def q_region_stats(spark, sf):
    return A.region_stats(X.pts(spark, sf), X.REGION_WKT)


@query("st_contains_points", X.with_ctes(
    "select poly_id, cast(sum(case when odd and not on_edge then 1 else 0 end) as bigint) as n_inside, "
    "cast(sum(case when odd or on_edge then 1 else 0 end) as bigint) as n_covered "
    f"from ({point_in_polys_sql('p', X.POLYS, 'rid')}) group by poly_id",
    **PTS, p="select row_number() over () as rid, x, y from pts"))
def q_st_contains_points(spark, sf):
    """Strict (interior) and closed point-in-polygon counts for two polygons
    (one concave with a hole) in a single pass over the points."""
    p = X.pts(spark, sf)
    aggs = []
    for pid, wkt in X.POLYS.items():
        shp = G.parse_wkt_literal(wkt)
        aggs += [F.count_if(G.contains_literal(shp, "x", "y")).alias(f"i{pid}"),
                 F.count_if(G.contains_literal(shp, "x", "y", boundary=True)).alias(f"c{pid}")]
    stack = ", ".join(f"{pid}, i{pid}, c{pid}" for pid in X.POLYS)
    return p.agg(*aggs).selectExpr(f"stack({len(X.POLYS)}, {stack}) as (poly_id, n_inside, n_covered)")


# --------------------------------------------------------------------------
# projections and filters
# --------------------------------------------------------------------------

@query("project_points", X.with_ctes(
    "select x, y, z as elevation, 'abc' as name1 from pts", **PTS))
def q_project_points(spark, sf):
    return X.pts(spark, sf).select("x", "y", F.col("z").alias("elevation"), F.lit("abc").alias("name1"))


@query("filter_ground", X.with_ctes("select * from pts where classification = 2", **PTS))
def q_filter_ground(spark, sf):
    return A.filter_class(X.pts(spark, sf), 2)


@query("class_counts", X.with_ctes(
    "select classification, count(*) as n from pts group by classification", **PTS))
def q_class_counts(spark, sf):
    return A.class_counts(X.pts(spark, sf))


@query("z_counts", X.with_ctes("select z, count(*) as n from pts group by z", **PTS))
def q_z_counts(spark, sf):
    return A.value_counts(X.pts(spark, sf), "z")


@query("class_labels", X.with_ctes(
    "select classification, coalesce(m.label, 'purple') as label, count(*) as n "
    "from pts left join (values " + ", ".join(
        f"({k}, '{v}')" for k, v in sorted(A.CLASS_COLOURS.items())) +
    ") as m(code, label) on pts.classification = m.code group by 1, 2", **PTS))
def q_class_labels(spark, sf):
    return A.class_labels(X.pts(spark, sf)).groupBy("classification", "label").agg(
        F.count(F.lit(1)).alias("n"))


@query("coords_clean", X.with_ctes(
    "select cast(x as float) as x, cast(y as float) as y, classification from pts "
    "where x is not null and y is not null", **PTS))
def q_coords_clean(spark, sf):
    return A.coords_clean(X.pts(spark, sf).select("x", "y", "classification"))


@query("decimal_coords", X.with_ctes(
    "select pid, cast(try_cast(x - 280000 as decimal(24,20)) as double) as dx, "
    "cast(try_cast(y - 5652000 as decimal(24,20)) as double) as dy from sites",
    sites=X.SITES_SQL))
def q_decimal_coords(spark, sf):
    """Coordinates cast to decimal(24,20) (4 integer digits): offsets from
    the tile origin fit, out-of-range values become null (try_cast)."""
    s = X.sites(spark, sf)
    return s.select("pid",
                    (F.col("x") - 280000).try_cast("decimal(24,20)").cast("double").alias("dx"),
                    (F.col("y") - 5652000).try_cast("decimal(24,20)").cast("double").alias("dy"))


@query("distance_to_point", X.with_ctes(
    f"select pid, round(sqrt((x - {d(284000)}) * (x - {d(284000)}) + (y - {d(5654000)}) * (y - {d(5654000)})), 6) as dist "
    "from sites", sites=X.SITES_SQL))
def q_distance_to_point(spark, sf):
    s = X.sites(spark, sf)
    return s.select("pid", F.round(G.dist_xy("x", "y", F.lit(284000.0), F.lit(5654000.0)), 6).alias("dist"))


# --------------------------------------------------------------------------
# aggregates
# --------------------------------------------------------------------------

@query("extent", X.with_ctes(
    "select min(x) as minx, min(y) as miny, max(x) as maxx, max(y) as maxy, count(*) as n from pts", **PTS))
def q_extent(spark, sf):
    return A.extent(X.pts(spark, sf))


@query("dataset_counts", X.with_ctes(
    "select (select count(*) from pts) as n_rows, (select count(*) from (select distinct * from pts)) as n_distinct",
    **PTS))
def q_dataset_counts(spark, sf):
    return A.dataset_counts(X.pts(spark, sf)).select(
        F.col("n_rows").cast("bigint").alias("n_rows"), "n_distinct")


_DESC_COLS = ("x", "y", "z", "intensity")
_DESC_SQL = " union all ".join(
    f"select '{c}' as col_name, '{s}' as stat, round({e}, 6) as value from pts"
    for c in _DESC_COLS for s, e in (
        ("count", f"cast(count({c}) as double)"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
        ("min", f"cast(min({c}) as double)"), ("p25", f"quantile_cont({c}, 0.25)"),
        ("p50", f"quantile_cont({c}, 0.5)"), ("p75", f"quantile_cont({c}, 0.75)"),
        ("max", f"cast(max({c}) as double)")))


@query("describe_points", X.with_ctes(_DESC_SQL, **PTS))
def q_describe_points(spark, sf):
    return A.describe_points(X.pts(spark, sf), _DESC_COLS)


@query("approx_counts_bound", X.with_ctes("select count(*) as n_rows, true as within_bound from pts", **PTS))
def q_approx_counts_bound(spark, sf):
    """The approximate distinct count lies within four standard errors."""
    approx, exact = A.approx_counts(X.pts(spark, sf)), A.dataset_counts(X.pts(spark, sf)).select("n_distinct")
    return approx.crossJoin(exact).select(    # one row each
        "n_rows", (F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= 4 * 0.02 * F.col("n_distinct")).alias("within_bound"))


@query("approx_counts")
def q_approx_counts(spark, sf):
    return A.approx_counts(X.pts(spark, sf))


# --------------------------------------------------------------------------
# first rows, samples
# --------------------------------------------------------------------------

@query("head_points", X.with_ctes(
    "select * from pts order by x, y, z, intensity, return_num, classification limit 5", **PTS))
def q_head_points(spark, sf):
    return A.head(X.pts(spark, sf), 5, "x", "y", "z", "intensity", "return_num", "classification")


@query("sample_points", X.with_ctes(
    "select pid, x, y from sites order by md5(concat_ws('|', cast(pid as varchar), '0')) limit 1000",
    sites=X.SITES_SQL))
def q_sample_points(spark, sf):
    return A.sample_points(X.sites(spark, sf), 1000, seed=0, key="pid")


# --------------------------------------------------------------------------
# tiles: glob over names, metadata join, per-tile geohash counts
# --------------------------------------------------------------------------

@query("tile_name_glob", X.with_ctes(
    "select source_file, count(*) as n from pts where source_file like '3dm_32_283%' group by source_file",
    **PTS_SRC))
def q_tile_name_glob(spark, sf):
    p = X.pts(spark, sf, with_source=True)
    return p.filter(F.col("source_file").like("3dm_32_283%")).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# coordinate transforms and geohash
# --------------------------------------------------------------------------

from punktwerk.functions import crs as CRS  # noqa: E402
from punktwerk.functions import geohash as GH  # noqa: E402
from punktwerk.plans.oracle_sql import geohash_sql, tm_forward_sql, tm_inverse_sql  # noqa: E402

_LON, _LAT = tm_inverse_sql("x", "y", 25832)
_LL_SITES = f"select pid, {_LON} as lon, {_LAT} as lat from sites"


@query("utm_to_lonlat", X.with_ctes(
    "select pid, round(lon, 6) as lon, round(lat, 6) as lat from ll",
    sites=X.SITES_SQL, ll=_LL_SITES))
def q_utm_to_lonlat(spark, sf):
    ll = CRS.st_transform("x", "y", 25832, 4326)
    return X.sites(spark, sf).select("pid", F.round(ll.x, 6).alias("lon"), F.round(ll.y, 6).alias("lat"))


_E2180, _N2180 = tm_forward_sql("lon", "lat", 2180)


@query("lonlat_to_2180", X.with_ctes(
    f"select pid, round({_E2180}, 3) as e2180, round({_N2180}, 3) as n2180 from ll",
    sites=X.SITES_SQL, ll=_LL_SITES))
def q_lonlat_to_2180(spark, sf):
    ll = X.sites(spark, sf).select("pid", CRS.st_transform("x", "y", 25832, 4326).alias("ll"))
    p = CRS.st_transform("ll.x", "ll.y", 4326, 2180)
    return ll.select("pid", F.round(p.x, 3).alias("e2180"), F.round(p.y, 3).alias("n2180"))


_PTS_LL = f"select {_LON} as lon, {_LAT} as lat from pts"


@query("geohash_points", X.with_ctes(
    f"select 6 as precision, {geohash_sql('lon', 'lat', 6)} as geohash, count(*) as n from ll group by 2 "
    f"union all select 7 as precision, {geohash_sql('lon', 'lat', 7)} as geohash, count(*) as n from ll group by 2",
    **PTS, ll=_PTS_LL))
def q_geohash_points(spark, sf):
    """Points per geohash cell at precision 6 and 7 (UTM 32N -> lon/lat ->
    geohash, all Column math). Both precisions come from one scan: the two
    codes are computed per row and exploded before the grouped count."""
    p = X.pts(spark, sf)
    ll = CRS.st_transform("x", "y", 25832, 4326)
    codes = p.select(ll.alias("ll")).select(GH.geohash("ll.x", "ll.y", 6).alias("g6"),
                                            GH.geohash("ll.x", "ll.y", 7).alias("g7"))
    return codes.selectExpr("stack(2, 6, g6, 7, g7) as (precision, geohash)").groupBy(
        "precision", "geohash").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# shapes: WKT / GeoJSON text, vertices, bbox, area, distance, predicates
# --------------------------------------------------------------------------

from punktwerk.functions import geojson as GJ  # noqa: E402

RECTS = {"rects": X.RECTS_SQL}
LINES = {"lines": X.LINES_SQL}


def _num_sql(c: str) -> str:
    return f"regexp_replace(cast({c} as varchar), '\\.0$', '')"


def _pt_sql(x: str, y: str) -> str:
    return f"{_num_sql(x)} || ' ' || {_num_sql(y)}"


_RECT_WKT_SQL = ("'POLYGON ((' || " + " || ', ' || ".join(
    _pt_sql(a, b) for a, b in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"),
                               ("minx", "maxy"), ("minx", "miny"))) + " || '))'")
_RECT_VERTS_SQL = " union all ".join(
    f"select rect_id, {i} as vertex_index, {a} as x, {b} as y from rects"
    for i, (a, b) in enumerate((("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"),
                                ("minx", "maxy"), ("minx", "miny"))))


def rect_shapes(spark, sf):
    r = X.rects(spark, sf)
    return r.withColumn("geom", G.st_rect("minx", "miny", "maxx", "maxy"))


def line_shapes(spark, sf):
    ln = X.lines(spark, sf)
    return ln.withColumn("geom", G.st_linestring("x1", "y1", "x2", "y2"))


@query("st_point", X.with_ctes(
    f"select pid, 'POINT (' || {_pt_sql('x', 'y')} || ')' as wkt from sites", sites=X.SITES_SQL))
def q_st_point(spark, sf):
    s = X.sites(spark, sf)
    return s.select("pid", G.st_astext(G.st_point("x", "y")).alias("wkt"))


@query("rect_wkt", X.with_ctes(f"select rect_id, {_RECT_WKT_SQL} as wkt from rects", **RECTS))
def q_rect_wkt(spark, sf):
    return rect_shapes(spark, sf).select("rect_id", G.st_astext("geom").alias("wkt"))


@query("wkt_vertices", X.with_ctes(_RECT_VERTS_SQL, **RECTS))
def q_wkt_vertices(spark, sf):
    """WKT text -> shape -> one row per vertex (text built from rects)."""
    txt = rect_shapes(spark, sf).select("rect_id", G.st_astext("geom").alias("wkt"))
    g = txt.select("rect_id", G.st_geomfromtext("wkt").alias("g"))
    return g.select("rect_id", F.posexplode(F.get(F.get("g.parts", 0), 0)).alias("vertex_index", "v")) \
        .select("rect_id", "vertex_index", "v.x", "v.y")


@query("geojson_vertices", X.with_ctes(_RECT_VERTS_SQL, **RECTS))
def q_geojson_vertices(spark, sf):
    """GeoJSON geometry text -> shape -> one row per vertex."""
    txt = rect_shapes(spark, sf).select("rect_id", GJ.st_asgeojson("geom").alias("js"))
    g = txt.select("rect_id", GJ.st_geomfromgeojson("js").alias("g"))
    return g.select("rect_id", F.posexplode(F.get(F.get("g.parts", 0), 0)).alias("vertex_index", "v")) \
        .select("rect_id", "vertex_index", "v.x", "v.y")


@query("shape_bbox", X.with_ctes(
    "select line_id, least(x1, x2) as minx, least(y1, y2) as miny, greatest(x1, x2) as maxx, "
    "greatest(y1, y2) as maxy from lines", **LINES))
def q_shape_bbox(spark, sf):
    e = line_shapes(spark, sf).select("line_id", G.st_envelope("geom").alias("e"))
    return e.select("line_id", "e.minx", "e.miny", "e.maxx", "e.maxy")


@query("polygon_area", X.with_ctes(
    "select rect_id, round((maxx - minx) * (maxy - miny), 6) as area from rects", **RECTS))
def q_polygon_area(spark, sf):
    return rect_shapes(spark, sf).select("rect_id", F.round(G.st_area("geom"), 6).alias("area"))


@query("shape_vertices", X.with_ctes(
    "select line_id, 'LINESTRING' as gtype, false as is_empty, 2 as n_vertices, x1 as first_x, y1 as first_y "
    "from lines", **LINES))
def q_shape_vertices(spark, sf):
    g = line_shapes(spark, sf)
    return g.select("line_id", F.col("geom.gtype").alias("gtype"), G.st_isempty("geom").alias("is_empty"),
                    G.st_numpoints("geom").alias("n_vertices"),
                    F.get(F.get(F.get("geom.parts", 0), 0), 0).x.alias("first_x"),
                    F.get(F.get(F.get("geom.parts", 0), 0), 0).y.alias("first_y"))


_PX, _PY = 284000.0, 5654000.0
_SEG_T = (f"greatest(0.0, least(1.0, ((({d(_PX)} - x1) * (x2 - x1) + ({d(_PY)} - y1) * (y2 - y1)) "
          f"/ ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))))")


@query("distance_point_line", X.with_ctes(
    f"select line_id, round(sqrt(({d(_PX)} - (x1 + t * (x2 - x1))) * ({d(_PX)} - (x1 + t * (x2 - x1))) "
    f"+ ({d(_PY)} - (y1 + t * (y2 - y1))) * ({d(_PY)} - (y1 + t * (y2 - y1)))), 6) as dist "
    f"from (select *, {_SEG_T} as t from lines)", **LINES))
def q_distance_point_line(spark, sf):
    """Distance from every linestring to a fixed point (point-segment)."""
    g = line_shapes(spark, sf)
    return g.select("line_id", F.round(G.st_distance_xy("geom", F.lit(_PX), F.lit(_PY)), 6).alias("dist"))


# the query window of the range/intersection queries
WIN = (281000.0, 5653000.0, 285000.0, 5655000.0)
_CORNERS = ((WIN[0], WIN[1]), (WIN[2], WIN[1]), (WIN[2], WIN[3]), (WIN[0], WIN[3]))


def _side_sql(cx, cy):
    return f"sign((x2 - x1) * ({d(cy)} - y1) - (y2 - y1) * ({d(cx)} - x1))"


@query("lines_intersect_rect", X.with_ctes(
    f"select line_id from lines where greatest(x1, x2) >= {d(WIN[0])} and least(x1, x2) <= {d(WIN[2])} "
    f"and greatest(y1, y2) >= {d(WIN[1])} and least(y1, y2) <= {d(WIN[3])} "
    f"and not ({' and '.join(_side_sql(cx, cy) + ' > 0' for cx, cy in _CORNERS)}) "
    f"and not ({' and '.join(_side_sql(cx, cy) + ' < 0' for cx, cy in _CORNERS)})", **LINES))
def q_lines_intersect_rect(spark, sf):
    """Exact closed intersection of every linestring with a window polygon:
    bbox predicates first (cheap, prune), then the edge test."""
    win = G.st_rect(F.lit(WIN[0]), F.lit(WIN[1]), F.lit(WIN[2]), F.lit(WIN[3]))
    g = line_shapes(spark, sf)
    pre = g.filter((F.greatest("x1", "x2") >= WIN[0]) & (F.least("x1", "x2") <= WIN[2])
                   & (F.greatest("y1", "y2") >= WIN[1]) & (F.least("y1", "y2") <= WIN[3]))
    return pre.filter(G.st_intersects("geom", win)).select("line_id")


# --------------------------------------------------------------------------
# spatial joins
# --------------------------------------------------------------------------

from punktwerk.operators import joins as J  # noqa: E402

_PTS_COLS = ["x", "y", "z", "intensity", "return_num", "classification"]
_RECT_CELL = 250.0   # base grid cell (m) for rectangle/point joins


@query("spatial_join_flat", X.with_ctes(
    "select r.rect_id, p.* from rects r join pts p on p.x between r.minx and r.maxx "
    "and p.y between r.miny and r.maxy", **RECTS, **PTS))
def q_spatial_join_flat(spark, sf):
    """(rectangle, point) pairs, closed boundary, as a grid equi-join."""
    out = J.spatial_join(X.rects(spark, sf), X.pts(spark, sf), "covers", cell=_RECT_CELL)
    return out.select("rect_id", *_PTS_COLS)


@query("spatial_join_covered", X.with_ctes(
    "select r.rect_id, p.* from rects r join pts p on p.x > r.minx and p.x < r.maxx "
    "and p.y > r.miny and p.y < r.maxy", **RECTS, **PTS))
def q_spatial_join_covered(spark, sf):
    """Same join with boundary=False: only points in the interior."""
    out = J.spatial_join(X.rects(spark, sf), X.pts(spark, sf), "contains", cell=_RECT_CELL)
    return out.select("rect_id", *_PTS_COLS)


@query("points_per_rect", X.with_ctes(
    "select r.rect_id, count(*) as n from rects r join pts p on p.x between r.minx and r.maxx "
    "and p.y between r.miny and r.maxy group by r.rect_id", **RECTS, **PTS))
def q_points_per_rect(spark, sf):
    """Pairs counted by rectangle: whole cells by their counts."""
    return J.spatial_join_counts(X.rects(spark, sf), X.pts(spark, sf).select("x", "y"), "rect_id", "covers", cell=_RECT_CELL)


@query("points_in_rect_list", X.with_ctes(
    "select r.rect_id, cast(floor(p.x / 250) as bigint) as chunk_x, cast(floor(p.y / 250) as bigint) as chunk_y, count(*) as n, 'MULTIPOINT (' || string_agg('(' || "
    f"{_pt_sql('p.x', 'p.y')} || ')', ', ' order by p.x, p.y) || ')' as points "
    "from rects r join pts p on p.x between r.minx and r.maxx and p.y between r.miny and r.maxy "
    "group by r.rect_id, chunk_x, chunk_y", **RECTS, **PTS))
def q_points_in_rect_list(spark, sf):
    """Grouped join: each rectangle with the list of its points (as
    MULTIPOINT text), a row per cell of 250 m."""
    # a point's text is made once, whatever the number of its rectangles
    p = X.pts(spark, sf).select("x", "y").withColumn("t", F.concat(
        F.lit("("), G._num_text(F.col("x")), F.lit(" "), G._num_text(F.col("y")), F.lit(")")))
    g = J.spatial_join_grouped(X.rects(spark, sf), p, "rect_id", ("x", "y", "t"), cell=_RECT_CELL)
    txt = F.concat(F.lit("MULTIPOINT ("), F.array_join(F.col("points")["t"], ", "), F.lit(")"))
    return g.select("rect_id", "chunk_x", "chunk_y", "n", txt.alias("points"))


SITES = {"sites": X.SITES_SQL}
_DJ_SQL = ("select a.pid as pid_a, b.pid as pid_b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) as dist "
           "from sites a join sites b on abs(a.x - b.x) < 50 and abs(a.y - b.y) < 50 "
           "and sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 50")


@query("distance_join", X.with_ctes(_DJ_SQL, **SITES))
def q_distance_join(spark, sf):
    """Self distance join, strict < 50: identity pairs and both orders."""
    s = X.sites(spark, sf)
    j = J.distance_join(s, s, 50.0)
    return j.select("pid_a", "pid_b", G.rounded(G.dist_xy("x_a", "y_a", "x_b", "y_b"), 6).alias("dist"))


@query("distance_join_grouped", X.with_ctes(
    f"select pid_a as pid, count(*) as n_neighbours from ({_DJ_SQL}) group by pid_a", **SITES))
def q_distance_join_grouped(spark, sf):
    s = X.sites(spark, sf)
    j = J.distance_join(s, s, 50.0)
    return j.groupBy(F.col("pid_a").alias("pid")).agg(F.count(F.lit(1)).alias("n_neighbours"))


@query("range_points", X.with_ctes(
    f"select * from pts where x between {d(WIN[0])} and {d(WIN[2])} and y between {d(WIN[1])} and {d(WIN[3])}",
    **PTS))
def q_range_points(spark, sf):
    return J.range_query(X.pts(spark, sf), WIN, boundary=True)


def _line_bbox(df):
    return df.withColumn("minx", F.least("x1", "x2")).withColumn("maxx", F.greatest("x1", "x2")) \
        .withColumn("miny", F.least("y1", "y2")).withColumn("maxy", F.greatest("y1", "y2"))


@query("range_covered", X.with_ctes(
    f"select line_id from lines where least(x1, x2) >= {d(WIN[0])} and greatest(x1, x2) <= {d(WIN[2])} "
    f"and least(y1, y2) >= {d(WIN[1])} and greatest(y1, y2) <= {d(WIN[3])}", **LINES))
def q_range_covered(spark, sf):
    """Range query, boundary=False: shapes fully covered by the window."""
    g = _line_bbox(line_shapes(spark, sf))
    return J.range_query(g, WIN, boundary=False, x=None).select("line_id")


@query("range_intersects", X.with_ctes(
    f"select line_id from lines where greatest(x1, x2) >= {d(WIN[0])} and least(x1, x2) <= {d(WIN[2])} "
    f"and greatest(y1, y2) >= {d(WIN[1])} and least(y1, y2) <= {d(WIN[3])} "
    f"and not ({' and '.join(_side_sql(cx, cy) + ' > 0' for cx, cy in _CORNERS)}) "
    f"and not ({' and '.join(_side_sql(cx, cy) + ' < 0' for cx, cy in _CORNERS)})", **LINES))
def q_range_intersects(spark, sf):
    """Range query, boundary=True: shapes intersecting the window."""
    g = _line_bbox(line_shapes(spark, sf))
    return J.range_query(g, WIN, boundary=True, x=None, geom="geom").select("line_id")


@query("knn_point", X.with_ctes(
    f"select pid, round(sqrt((x - {d(_PX)}) * (x - {d(_PX)}) + (y - {d(_PY)}) * (y - {d(_PY)})), 6) as dist "
    f"from sites order by sqrt((x - {d(_PX)}) * (x - {d(_PX)}) + (y - {d(_PY)}) * (y - {d(_PY)})), pid limit 5",
    **SITES))
def q_knn_point(spark, sf):
    out = J.knn_point(X.sites(spark, sf), 5, _PX, _PY, "pid")
    return out.select("pid", F.round("dist", 6).alias("dist"))


def _poly_dist_sql(view: str, poly_id: int) -> str:
    """Per point: smallest point-segment distance to the polygon's edges."""
    from punktwerk.plans.oracle_sql import edges_values
    t = ("greatest(0.0, least(1.0, ((p.x - e.x1) * (e.x2 - e.x1) + (p.y - e.y1) * (e.y2 - e.y1)) "
         "/ ((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1))))")
    return (
        "select q.pid, min(sqrt((q.x - (q.x1 + q.t * (q.x2 - q.x1))) * (q.x - (q.x1 + q.t * (q.x2 - q.x1))) "
        "+ (q.y - (q.y1 + q.t * (q.y2 - q.y1))) * (q.y - (q.y1 + q.t * (q.y2 - q.y1))))) as dmin "
        f"from (select p.pid, p.x, p.y, e.x1, e.y1, e.x2, e.y2, {t} as t from {view} p, "
        f"({edges_values({poly_id: X.POLYS[poly_id]})}) e) q group by q.pid")


@query("knn_polygon", X.with_ctes(
    "select s.pid, round(case when l.odd or l.on_edge then 0 else m.dmin end, 6) as dist from sites s "
    "join loc l on l.pid = s.pid join mind m on m.pid = s.pid "
    "order by case when l.odd or l.on_edge then 0 else m.dmin end, s.pid limit 10",
    **SITES, loc=point_in_polys_sql("sites", {2: X.POLY2_WKT}, "pid"), mind=_poly_dist_sql("sites", 2)))
def q_knn_polygon(spark, sf):
    """10 sites nearest to a polygon (distance 0 inside, ties by id)."""
    out = J.knn(X.sites(spark, sf), 10, J.distance_to_literal(X.POLY2_WKT), "pid")
    return out.select("pid", F.round("dist", 6).alias("dist"))


_LL2180 = f"select pid, {_E2180} as x, {_N2180} as y from ll"


@query("reprojected_neighbours", X.with_ctes(
    "select a.pid as id_1, b.pid as id_2, round(a.x, 3) as x, round(a.y, 3) as y from p2180 a join p2180 b "
    "on abs(a.x - b.x) < 50 and abs(a.y - b.y) < 50 "
    "and sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 50",
    **SITES, ll=_LL_SITES, p2180=_LL2180))
def q_reprojected_neighbours(spark, sf):
    """lon/lat points -> EPSG:2180 -> pairs closer than 50 m (ids + point)."""
    ll = X.sites(spark, sf).select("pid", CRS.st_transform("x", "y", 25832, 4326).alias("ll"))
    p = ll.select("pid", CRS.st_transform("ll.x", "ll.y", 4326, 2180).alias("p"))
    # written once: the join then plans on two plain columns, not on the
    # formulas behind them, and no point is transformed a second time
    p = J._staged(p.select("pid", F.col("p.x").alias("x"), F.col("p.y").alias("y")), "reprojected")
    # a point is rounded once, not for each of its pairs
    shown = J._staged(p.select("*", F.round("x", 3).alias("px"), F.round("y", 3).alias("py")), "shown")
    j = J.distance_join(shown, p, 50.0)
    return j.select(F.col("pid_a").alias("id_1"), F.col("pid_b").alias("id_2"), F.col("px_a").alias("x"), F.col("py_a").alias("y"))


# --------------------------------------------------------------------------
# clustering: DBSCAN, hulls, footprints, k-means
# --------------------------------------------------------------------------

from punktwerk.operators import cluster as CL  # noqa: E402
from punktwerk.operators import hull as HU  # noqa: E402

DB_EPS, DB_MIN = 60.0, 10
_DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"
_DBSCAN_CTES = (
    f"with recursive sites as ({X.SITES_SQL}), "
    f"nb as (select a.pid as p, b.pid as q from sites a join sites b on abs(a.x - b.x) <= {DB_EPS} "
    f"and abs(a.y - b.y) <= {DB_EPS} and {_DIST} <= {DB_EPS}), "
    f"core as (select p from nb group by p having count(*) >= {DB_MIN}), "
    "ce as (select nb.p, nb.q from nb join core c1 on c1.p = nb.p join core c2 on c2.p = nb.q), "
    "reach(p, r) as (select p, p from core union select reach.p, ce.q from reach join ce on ce.p = reach.r), "
    "lab as (select p, min(r) as cluster from reach group by p), "
    "brd as (select nb.p, min(lab.cluster) as cluster from nb join lab on lab.p = nb.q "
    "where nb.p not in (select p from core) group by nb.p), "
    "labels as (select s.pid, s.x, s.y, coalesce(lab.cluster, brd.cluster, -1) as cluster, "
    "lab.p is not null as is_core from sites s left join lab on lab.p = s.pid left join brd on brd.p = s.pid) ")


def _dbscan_sites(spark, sf):
    return CL.dbscan(X.sites(spark, sf), DB_EPS, DB_MIN, id_col="pid")


@query("dbscan_labels", _DBSCAN_CTES + "select pid, cluster, is_core from labels")
def q_dbscan_labels(spark, sf):
    """DBSCAN (eps 60, min 10, inclusive, self counted) on every site."""
    return _dbscan_sites(spark, sf).select("pid", "cluster", "is_core")


@query("dbscan_core_points", _DBSCAN_CTES + "select pid from labels where is_core")
def q_dbscan_core_points(spark, sf):
    return _dbscan_sites(spark, sf).filter("is_core").select("pid")


_HULL_CTES = (
    "m as (select pid, cluster, x, y from labels where cluster <> -1), "
    "sz as (select cluster, count(*) as n_points, min(x) as x0, min(y) as y0 from m group by cluster), "
    "hp as (select distinct m.cluster, m.x - sz.x0 as x, m.y - sz.y0 as y from m join sz on sz.cluster = m.cluster), "
    "he as (select a.cluster, a.x as e_ax, a.y as e_ay, b.x as e_bx, b.y as e_by from hp a join hp b "
    "on a.cluster = b.cluster and (a.x <> b.x or a.y <> b.y) where not exists (select 1 from hp r "
    "where r.cluster = a.cluster and (((b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x)) < 0 "
    "or (((b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x)) = 0 and "
    "((r.x - a.x) * (b.x - a.x) + (r.y - a.y) * (b.y - a.y) < 0 "
    "or (r.x - b.x) * (a.x - b.x) + (r.y - b.y) * (a.y - b.y) < 0))))), "
    "hull as (select cluster, cast(count(*) as integer) as n_vertices, "
    "0.5 * sum(e_ax * e_by - e_bx * e_ay) as area from he group by cluster) ")


@query("hull_area", _DBSCAN_CTES + ", " + _HULL_CTES +
       "select sz.cluster, coalesce(hull.n_vertices, 1) as n_vertices, round(coalesce(hull.area, 0), 3) as area "
       "from sz left join hull on hull.cluster = sz.cluster")
def q_hull_area(spark, sf):
    """Convex hull (vertex count, area) of every DBSCAN cluster."""
    lab = _dbscan_sites(spark, sf).filter(F.col("cluster") != -1)
    h = HU.convex_hull(lab, "cluster")
    return h.select("cluster", "n_vertices", F.round("area", 3).alias("area"))


@query("cluster_footprints", _DBSCAN_CTES + ", " + _HULL_CTES +
       "select sz.cluster, sz.n_points, hull.n_vertices, round(hull.area, 3) as area "
       "from sz join hull on hull.cluster = sz.cluster where sz.n_points >= 3")
def q_cluster_footprints(spark, sf):
    """Footprint polygon per cluster (noise and < 3 points skipped)."""
    fp = HU.footprints(_dbscan_sites(spark, sf))
    return fp.select("cluster", "n_points", "n_vertices", F.round("area", 3).alias("area"))


@query("footprint_heights", _DBSCAN_CTES + ", " + _HULL_CTES +
       "select sz.cluster, round(hull.area * 0.05, 3) as height "
       "from sz join hull on hull.cluster = sz.cluster where sz.n_points >= 3")
def q_footprint_heights(spark, sf):
    fp = HU.footprint_heights(HU.footprints(_dbscan_sites(spark, sf)), 0.05, "building")
    return fp.select("cluster", F.round("height", 3).alias("height"))


@query("multipoint_union", _DBSCAN_CTES +
       "select cluster, cast(floor(x / 250) as bigint) as chunk_x, cast(floor(y / 250) as bigint) as chunk_y, count(distinct (x, y)) as n_points, 'MULTIPOINT (' || string_agg(distinct '(' || "
       f"{_pt_sql('x', 'y')} || ')', ', ' order by '(' || {_pt_sql('x', 'y')} || ')') || ')' as points "
       "from labels where cluster <> -1 group by cluster, chunk_x, chunk_y")
def q_multipoint_union(spark, sf):
    """st_aggr_union for points: each cluster as MULTIPOINTs (distinct), a row
    per cell of 250 m."""
    u = A.multipoint_union(_dbscan_sites(spark, sf).filter(F.col("cluster") != -1), "cluster")
    txt = F.array_sort(F.transform("points", lambda v: F.concat(
        F.lit("("), G._num_text(v.x), F.lit(" "), G._num_text(v.y), F.lit(")"))))
    return u.select("cluster", "chunk_x", "chunk_y", F.col("n_points").cast("bigint").alias("n_points"),
                    F.concat(F.lit("MULTIPOINT ("), F.array_join(txt, ", "), F.lit(")")).alias("points"))


CENTRES = [(282000.0, 5653000.0), (286000.0, 5654000.0)]
_ASSIGN_SQL = (f"case when (x - {d(CENTRES[1][0])}) * (x - {d(CENTRES[1][0])}) + (y - {d(CENTRES[1][1])}) * (y - {d(CENTRES[1][1])}) "
               f"< (x - {d(CENTRES[0][0])}) * (x - {d(CENTRES[0][0])}) + (y - {d(CENTRES[0][1])}) * (y - {d(CENTRES[0][1])}) "
               "then 1 else 0 end")


@query("kmeans_assign", X.with_ctes(f"select pid, {_ASSIGN_SQL} as label from sites", **SITES))
def q_kmeans_assign(spark, sf):
    """Nearest of two given centres for every site."""
    return CL.kmeans_assign(X.sites(spark, sf), CENTRES).select("pid", "label")


@query("label_join_back", X.with_ctes(
    f"select s.pid, smp.label from sites s left join (select pid, {_ASSIGN_SQL} as label from sites "
    "order by md5(concat_ws('|', cast(pid as varchar), '0')) limit 1000) smp on smp.pid = s.pid", **SITES))
def q_label_join_back(spark, sf):
    """Labels computed on a 1000-row seeded sample, joined back to all rows
    (null for rows outside the sample)."""
    s = X.sites(spark, sf)
    smp = CL.kmeans_assign(A.sample_points(s, 1000, seed=0, key="pid"), CENTRES)
    return CL.label_join_back(s, smp, "pid").select("pid", "label")


@query("kmeans_fit")
def q_kmeans_fit(spark, sf):
    """k-means (k=2, seed 0) in float32, fitted on and labelling all rows."""
    s = X.sites(spark, sf)
    _, labelled = CL.kmeans_fit(s, k=2, seed=0, id_col="pid")
    return labelled.select("pid", "label")


@query("kmeans_fit_sample")
def q_kmeans_fit_sample(spark, sf):
    """The same on a seeded sample of 1,000 rows (the sample is the feature):
    labels on the sample, null elsewhere."""
    s = X.sites(spark, sf)
    _, labelled = CL.kmeans_fit(s, k=2, seed=0, sample_rows=1000, id_col="pid")
    return CL.label_join_back(s, labelled, "pid").select("pid", "label")


@query("kmeans_fit_properties", X.with_ctes(
    "select count(*) as n_rows, cast(0 as bigint) as n_unlabelled, cast(0 as bigint) as n_not_nearest, cast(2 as bigint) as n_labels from sites", **SITES))
def q_kmeans_fit_properties(spark, sf):
    """What any right fit has: every row labelled, with its nearest centre."""
    model, labelled = CL.kmeans_fit(X.sites(spark, sf), k=2, seed=0, id_col="pid")
    (ax, ay), (bx, by) = (tuple(map(float, c)) for c in model.clusterCenters())
    x, y = F.col("x").cast("float").cast("double"), F.col("y").cast("float").cast("double")
    da, db = (x - ax) * (x - ax) + (y - ay) * (y - ay), (x - bx) * (x - bx) + (y - by) * (y - by)
    nearer = F.when(F.abs(da - db) < 1e-3, F.col("label")).when(da < db, 0).otherwise(1)
    return labelled.agg(F.count("*").alias("n_rows"), F.count(F.when(F.col("label").isNull(), 1)).alias("n_unlabelled"),
                        F.count(F.when(F.col("label") != nearer, 1)).alias("n_not_nearest"), F.countDistinct("label").alias("n_labels"))


# --------------------------------------------------------------------------
# sources and sinks (data derived from the tables, written to the shared
# checkpoint folder, read back through the reader under test)
# --------------------------------------------------------------------------

from punktwerk.functions import wkb as WKB  # noqa: E402
from punktwerk.session import scratch_path  # noqa: E402
from punktwerk.sources import metadata as MD  # noqa: E402
from punktwerk.sources import points as SP  # noqa: E402
from punktwerk.sources import shapes as SS  # noqa: E402
from punktwerk.sources import sinks as SK  # noqa: E402


@query("scan_points_csv", X.with_ctes("select * from pts", **PTS))
def q_scan_points_csv(spark, sf):
    """Points written as CSV with a header, read back with the fixed schema."""
    path = scratch_path(spark, "points-csv")
    SK.write_points_csv(X.pts(spark, sf), path)
    return SP.read_points_csv(spark, path)


@query("source_file_basename", X.with_ctes(
    "select source_file, count(*) as n from pts group by source_file", **PTS_SRC))
def q_source_file_basename(spark, sf):
    """Lineage column from the file path of every row (tile directory)."""
    path = scratch_path(spark, "points-by-tile")
    X.pts(spark, sf, with_source=True).write.partitionBy("source_file").option("header", True).csv(path)
    df = SP.read_points_csv(spark, path).drop("source_file")
    return SP.with_source_file(df, level="dir").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query("scan_headerless", X.with_ctes(
    "select cast(pid as varchar) as _c0, cast(x as varchar) as _c1, cast(y as varchar) as _c2 from sites",
    **SITES))
def q_scan_headerless(spark, sf):
    """Headerless CSV -> positional string columns."""
    path = scratch_path(spark, "sites-headerless")
    X.sites(spark, sf).write.option("header", False).csv(path)
    return SP.read_headerless(spark, path)


@query("read_typed_points", X.with_ctes(
    "select x, y, cast(pid as varchar) as attr1, 'abc' as attr2 from sites", **SITES))
def q_read_typed_points(spark, sf):
    """Point text with the coordinates at offset 1 and carried attributes."""
    path = scratch_path(spark, "typed-points")
    X.sites(spark, sf).select(F.concat_ws(",", F.col("pid").cast("string"), F.col("x").cast("string"),
                                          F.col("y").cast("string"), F.lit("abc")).alias("value")) \
        .write.text(path)
    return SP.read_typed_points(spark, path, offset=1, sep=",", carry_attributes=True)


_RECT_SHAPE_SQL = ("select rect_id, 'POLYGON' as gtype, 5 as n_vertices, "
                   "round((maxx - minx) * (maxy - miny), 6) as area, minx, miny, maxx, maxy from rects")


@query("read_wkt", X.with_ctes(_RECT_SHAPE_SQL, **RECTS))
def q_read_wkt(spark, sf):
    """TSV with WKT in column 0 and attributes after it."""
    path = scratch_path(spark, "rects-wkt")
    rect_shapes(spark, sf).select(G.st_astext("geom").alias("wkt"), "rect_id") \
        .write.option("sep", "\t").csv(path)
    df = SS.read_wkt(spark, path, sep="\t")
    return df.select(F.col("_c1").cast("bigint").alias("rect_id"), F.col("geom.gtype").alias("gtype"),
                     G.st_numpoints("geom").alias("n_vertices"), F.round(G.st_area("geom"), 6).alias("area"),
                     "minx", "miny", "maxx", "maxy")


@query("read_wkb", X.with_ctes(_RECT_SHAPE_SQL, **RECTS))
def q_read_wkb(spark, sf):
    """TSV with hex WKB in column 0 (encode and decode are Arrow UDFs)."""
    path = scratch_path(spark, "rects-wkb")
    rect_shapes(spark, sf).select(F.hex(WKB.st_asbinary("geom")).alias("wkb"), "rect_id") \
        .write.option("sep", "\t").csv(path)
    df = SS.read_wkb(spark, path, sep="\t")
    return df.select(F.col("_c1").cast("bigint").alias("rect_id"), F.col("geom.gtype").alias("gtype"),
                     G.st_numpoints("geom").alias("n_vertices"), F.round(G.st_area("geom"), 6).alias("area"),
                     "minx", "miny", "maxx", "maxy")


@query("read_geojson", X.with_ctes(_RECT_SHAPE_SQL, **RECTS))
def q_read_geojson(spark, sf):
    """GeoJSON Features one per line with trailing commas; properties become
    columns."""
    path = scratch_path(spark, "rects-geojson")
    rect_shapes(spark, sf).select(F.concat(GJ.feature("geom", F.struct("rect_id")), F.lit(",")).alias("value")) \
        .write.text(path)
    df = SS.read_geojson(spark, path, properties_schema="rect_id bigint")
    return df.select("rect_id", F.col("geom.gtype").alias("gtype"), G.st_numpoints("geom").alias("n_vertices"),
                     F.round(G.st_area("geom"), 6).alias("area"), "minx", "miny", "maxx", "maxy")


def _jpt(x, y):
    return f"'[' || cast({x} as varchar) || ',' || cast({y} as varchar) || ']'"


@query("features_geojson", X.with_ctes(
    "select rect_id, '{\"type\":\"Feature\",\"properties\":{\"rect_id\":' || cast(rect_id as varchar) || "
    "'},\"geometry\":{\"type\":\"Polygon\",\"coordinates\":[[' || "
    + " || ',' || ".join(_jpt(a, b) for a, b in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"),
                                                  ("minx", "maxy"), ("minx", "miny")))
    + " || ']]}}' as feature from rects", **RECTS))
def q_features_geojson(spark, sf):
    """Shapes -> GeoJSON Feature text (the form written by write_geojson)."""
    return rect_shapes(spark, sf).select("rect_id", GJ.feature("geom", F.struct("rect_id")).alias("feature"))


@query("ingest_roundtrip", X.with_ctes(
    "select source_file, count(*) as n, round(sum(z), 6) as sum_z from pts group by source_file", **PTS_SRC))
def q_ingest_roundtrip(spark, sf):
    """Append the points to a table partitioned by tile, append them again
    with tile replacement (idempotent re-ingest), read back per tile."""
    path = scratch_path(spark, "point-table")
    p = X.pts(spark, sf, with_source=True)
    SK.append_points(p, path=path)
    SK.append_points(p, path=path)          # re-ingest: same tiles replaced, no duplicates
    back = spark.read.parquet(path)
    return back.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 6).alias("sum_z"))


@query("scan_table", X.with_ctes(
    f"select * from pts where source_file like '3dm_32_28%' and x < {d(283500)} and y >= {d(5653000)}",
    **PTS_SRC))
def q_scan_table(spark, sf):
    """Catalog table (CREATE TABLE … PARTITIONED BY) scanned with a tile
    predicate (partition pruning) and coordinate predicates (pushed to the
    Parquet reader)."""
    import uuid
    name = f"punktwerk_points_{uuid.uuid4().hex[:8]}"
    SK.create_point_table(spark, name, location=scratch_path(spark, "catalog-table"))
    SK.append_points(X.pts(spark, sf, with_source=True), table=name)
    t = spark.table(name)
    return t.filter(F.col("source_file").like("3dm_32_28%") & (F.col("x") < 283500.0) & (F.col("y") >= 5653000.0))


# Fixed value: the base address used to build download URLs in the queries.
TILE_BASE_URL = "https://example.org/tiles/3dm_l_las"
_TM = {"pts": X.PTS_SRC_SQL, "tm": None}


def _tile_ctes(**extra):
    return dict(pts=X.PTS_SRC_SQL, tm=X.tile_meta_sql(), **extra)


@query("tile_urls", X.with_ctes(
    f"select Kachelname || '.laz' as name, '{TILE_BASE_URL}/' || Kachelname || '.laz' as url, "
    "Kachelname || '.laz' as laz_file from tm", **_tile_ctes()))
def q_tile_urls(spark, sf):
    tm = X.tile_meta(spark, sf).select(F.concat("Kachelname", F.lit(".laz")).alias("name"))
    return MD.tile_urls(tm, TILE_BASE_URL)


@query("xml_listing", X.with_ctes(
    "select source_file as name, count(*) as size from pts group by source_file", **PTS_SRC))
def q_xml_listing(spark, sf):
    """Tile listing as XML elements, read back with the XML source."""
    path = scratch_path(spark, "tile-index-xml")
    sizes = X.pts(spark, sf, with_source=True).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    elems = sizes.select(F.pmod(F.xxhash64("source_file"), F.lit(4)).alias("grp"), F.concat(
        F.lit('<file name="'), F.col("source_file"), F.lit('" size="'), F.col("n").cast("string"),
        F.lit('"/>')).alias("value"))
    SK.write_text_files(elems, path, "grp", header=["<files>"], footer=["</files>"])
    df = MD.read_tile_index_xml(spark, path)
    return df.select("name", F.col("_size").cast("bigint").alias("size"))


@query("xml_xpath", X.with_ctes(
    "select Kachelname || '.laz' as name from tm", **_tile_ctes()))
def q_xml_xpath(spark, sf):
    """In-column XPath over XML text (one listing document per tile)."""
    tm = X.tile_meta(spark, sf)
    xml = F.concat(F.lit('<files><file name="'), F.col("Kachelname"), F.lit('.laz"/></files>'))
    return tm.select(F.explode(MD.xml_names(xml)).alias("name"))


_META_SQL = "select * from tm"


@query("tile_metadata_scan", X.with_ctes(_META_SQL, **_tile_ctes()))
def q_tile_metadata_scan(spark, sf):
    """';'-separated metadata files with a 7-line preamble per file."""
    path = scratch_path(spark, "tile-metadata")
    tm = X.tile_meta(spark, sf)
    body = tm.select(F.pmod(F.xxhash64("Kachelname"), F.lit(4)).alias("grp"),
                     F.concat_ws(";", *[F.col(c).cast("string") for c in MD.RAW_META_COLUMNS]).alias("value"))
    SK.write_text_files(body, path, "grp", header=[f"# preamble line {i}" for i in range(7)])
    return MD.read_tile_metadata(spark, path, skip=7)


CURATION_DATE = "2024-01-01"


@query("tile_metadata_curated", X.with_ctes(
    f"select '{MD.CURATED_DEFAULTS['Land']}' as Land, '{MD.CURATED_DEFAULTS['Eigentuemer']}' as Eigentuemer, "
    f"date '{CURATION_DATE}' as Aktualitaet_Kachelinformationen, "
    f"'{MD.CURATED_DEFAULTS['Version_Standard']}' as Version_Standard, "
    f"'{MD.CURATED_DEFAULTS['Punktklassenbelegung']}' as Punktklassenbelegung, "
    "Kachelname || '.laz' as Kachelname, " + ", ".join(MD.RAW_META_COLUMNS[1:]) + " from tm", **_tile_ctes()))
def q_tile_metadata_curated(spark, sf):
    """Curation insert: constants, curation date (a parameter here),
    suffixed tile name, raw columns."""
    return MD.curate_tile_metadata(X.tile_meta(spark, sf), as_of=CURATION_DATE)


@query("tile_join", X.with_ctes(
    "select p.source_file, m.Land as land, m.Aufloesung as aufloesung, count(*) as n from pts p "
    "join (select Kachelname || '.laz' as k, 'Nordrhein-Westfalen' as Land, Aufloesung from tm) m "
    "on p.source_file = m.k group by 1, 2, 3", **_tile_ctes()))
def q_tile_join(spark, sf):
    """Points joined with their tile's metadata by file name."""
    cur = MD.curate_tile_metadata(X.tile_meta(spark, sf), as_of=CURATION_DATE)
    j = MD.tile_join(X.pts(spark, sf, with_source=True), cur)
    return j.groupBy("source_file", F.col("Land").alias("land"), F.col("Aufloesung").alias("aufloesung")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("tile_geohash_counts", X.with_ctes(
    f"select m.Land as land, p.source_file, {geohash_sql('p.lon', 'p.lat', 6)} as geohash, count(*) as n "
    "from (select source_file, " + _LON + " as lon, " + _LAT + " as lat from pts) p "
    "join (select Kachelname || '.laz' as k, 'Nordrhein-Westfalen' as Land from tm) m "
    "on p.source_file = m.k group by 1, 2, 3", **_tile_ctes()))
def q_tile_geohash_counts(spark, sf):
    """Enriched point table (geohash per point) joined with the curated
    metadata, counted per (land, tile, geohash)."""
    pts = GH.with_geohash(X.pts(spark, sf, with_source=True), srid=25832, precision=6)
    cur = MD.curate_tile_metadata(X.tile_meta(spark, sf), as_of=CURATION_DATE)
    j = MD.tile_join(pts, cur)
    return j.groupBy(F.col("Land").alias("land"), "source_file", "geohash").agg(F.count(F.lit(1)).alias("n"))


@query("split_attributes", X.with_ctes(
    "select cast(pid as varchar) as a0, cast(cast(floor(x) as bigint) as varchar) as a1, "
    "cast(cast(floor(y) as bigint) as varchar) as a2 from sites", **SITES))
def q_split_attributes(spark, sf):
    """Tab-joined attribute text split back into columns."""
    s = X.sites(spark, sf).select(F.concat_ws("\t", F.col("pid").cast("string"),
                                              F.floor("x").cast("string"), F.floor("y").cast("string")).alias("ud"))
    parts = F.split("ud", "\t")
    return s.select(F.get(parts, 0).alias("a0"), F.get(parts, 1).alias("a1"), F.get(parts, 2).alias("a2"))


@query("fill_missing", X.with_ctes(
    "select classification, coalesce(m.label, '') as label, count(*) as n "
    "from pts left join (values " + ", ".join(
        f"({k}, '{v}')" for k, v in sorted(A.CLASS_COLOURS.items())) +
    ") as m(code, label) on pts.classification = m.code group by 1, 2", **PTS))
def q_fill_missing(spark, sf):
    """Missing labels (codes outside the dictionary) replaced by ''."""
    m = F.create_map(*[x for k, v in sorted(A.CLASS_COLOURS.items()) for x in (F.lit(k), F.lit(v))])
    p = X.pts(spark, sf).withColumn("label", F.try_element_at(m, F.col("classification"))).fillna("", ["label"])
    return p.groupBy("classification", "label").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# streaming ingest
# --------------------------------------------------------------------------

from punktwerk.streaming import ingest as ST  # noqa: E402


@query("stream_ingest", X.with_ctes(
    "select source_file, count(*) as n, round(sum(z), 6) as sum_z from pts group by source_file", **PTS_SRC))
def q_stream_ingest(spark, sf):
    """Point files arriving in a folder, ingested by a file stream
    (availableNow, at most 8 files per micro-batch, 3 files a tile) into the
    table partitioned by tile; a second run of the same stream finds nothing new."""
    src, table, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-table", "stream-ckpt"))
    X.write_parts(X.pts(spark, sf, with_source=True), src, 3)
    for _ in range(2):   # rerun from the checkpoint: no file is ingested twice
        q = ST.stream_points(spark, src, table, ckpt, max_files=8)
        q.awaitTermination()
    back = spark.read.parquet(table)
    return back.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 6).alias("sum_z"))


@query("route_valid_invalid", X.with_ctes(
    "select source_file, cast(sum(case when intensity < 65000 then 1 else 0 end) as bigint) as n_valid, "
    "cast(sum(case when intensity >= 65000 then 1 else 0 end) as bigint) as n_invalid "
    "from pts group by source_file", **PTS_SRC))
def q_route_valid_invalid(spark, sf):
    """Rows whose elevation field is not a number (here: rows with intensity
    >= 65000 are written with 'n/a') go to the quarantine; per tile counts of
    both sides after a streamed ingest."""
    src, table, bad, ckpt = (scratch_path(spark, n) for n in ("route-src", "route-table", "route-bad", "route-ckpt"))
    p = X.pts(spark, sf, with_source=True)
    p = p.withColumn("z", F.when(F.col("intensity") >= 65000, F.lit("n/a")).otherwise(F.col("z").cast("string")))
    p.repartition("source_file").write.partitionBy("source_file").option("header", True).csv(src)
    ST.stream_points(spark, src, table, ckpt, quarantine_path=bad, max_files=16).awaitTermination()
    ok = spark.read.parquet(table).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_valid"))
    ko = spark.read.parquet(bad).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_invalid"))
    return ok.join(ko, "source_file", "full").select(
        "source_file", F.coalesce("n_valid", F.lit(0)).cast("bigint").alias("n_valid"),
        F.coalesce("n_invalid", F.lit(0)).cast("bigint").alias("n_invalid"))


# --------------------------------------------------------------------------
# SQL strings with the registered ST_* functions
# --------------------------------------------------------------------------

from punktwerk.functions.sql import register_sql_functions  # noqa: E402


def _temp_view(df, stem: str) -> str:
    import uuid
    name = f"{stem}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(name)
    return name


_POLY2_COORDS = ", ".join(f"{v!r}d" for x, y in G.parse_wkt_literal(X.POLY2_WKT).parts[0][0] for v in (float(x), float(y)))


@query("sql_contains", X.with_ctes(
    "select cast(sum(case when odd and not on_edge then 1 else 0 end) as bigint) as n_inside, "
    "cast(sum(case when odd or on_edge then 1 else 0 end) as bigint) as n_covered "
    f"from ({point_in_polys_sql('p', {2: X.POLY2_WKT}, 'rid')})",
    **PTS, p="select row_number() over () as rid, x, y from pts"))
def q_sql_contains(spark, sf):
    """Point-in-polygon written as a SQL string with ST_* functions, the
    bbox spelled out so it can prune before the exact test."""
    register_sql_functions(spark)
    v = _temp_view(X.pts(spark, sf), "pts")
    bx = G.parse_wkt_literal(X.POLY2_WKT).bbox
    return spark.sql(
        f"select count_if(st_contains(st_polygon(array({_POLY2_COORDS})), st_point(x, y))) as n_inside, "
        f"count_if(st_covers(st_polygon(array({_POLY2_COORDS})), st_point(x, y))) as n_covered "
        f"from {v} where x between {bx[0]}d and {bx[2]}d and y between {bx[1]}d and {bx[3]}d")


@query("sql_distance_area", X.with_ctes(
    f"select rect_id, round((maxx - minx) * (maxy - miny), 6) as area, "
    f"round(sqrt((minx - {d(_PX)}) * (minx - {d(_PX)}) + (miny - {d(_PY)}) * (miny - {d(_PY)})), 6) as dist "
    "from rects", **RECTS))
def q_sql_distance_area(spark, sf):
    """st_area / st_distance / st_makeenvelope inside a SQL string."""
    register_sql_functions(spark)
    v = _temp_view(X.rects(spark, sf), "rects")
    return spark.sql(
        "select rect_id, round(st_area(st_makeenvelope(minx, miny, maxx, maxy)), 6) as area, "
        f"round(st_distance(st_point(minx, miny), st_point({_PX}d, {_PY}d)), 6) as dist from {v}")


@query("rects_touch", X.with_ctes(
    "select a.rect_id as rect_id_a, b.rect_id as rect_id_b from rects a join rects b on a.rect_id < b.rect_id "
    "and greatest(a.minx, b.minx) <= least(a.maxx, b.maxx) and greatest(a.miny, b.miny) <= least(a.maxy, b.maxy) "
    "and (greatest(a.minx, b.minx) = least(a.maxx, b.maxx) or greatest(a.miny, b.miny) = least(a.maxy, b.maxy))",
    **RECTS))
def q_rects_touch(spark, sf):
    """Rectangle pairs whose boundaries meet but interiors do not, as a
    grid shape/shape join with reference-point deduplication."""
    r = X.rects(spark, sf)
    j = J.shape_join(r, r, cell=_RECT_CELL, predicate="touches")
    return j.filter(F.col("rect_id_a") < F.col("rect_id_b")).select("rect_id_a", "rect_id_b")


_GRID_ROWS = 500


@query("grid_partition_counts", X.with_ctes(
    "select cast(floor(x / c.cell) as bigint) as cx, cast(floor(y / c.cell) as bigint) as cy, count(*) as n "
    "from pts, (select sqrt(greatest(max(x) - min(x), 1e-9) * greatest(max(y) - min(y), 1e-9) / "
    f"greatest(ceil(count(*) / {_GRID_ROWS}), 1)) as cell from pts) c group by 1, 2", **PTS))
def q_grid_partition_counts(spark, sf):
    """Density-adaptive grid: cell size from extent and count, points
    co-partitioned by cell (hot cells salted), counted per cell."""
    g, _ = J.grid_partition(X.pts(spark, sf), rows_per_cell=_GRID_ROWS)
    return g.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))


@query("rects_overlap", X.with_ctes(
    "select a.rect_id as rect_id_a, b.rect_id as rect_id_b from rects a join rects b on a.rect_id <> b.rect_id "
    "and greatest(a.minx, b.minx) <= least(a.maxx, b.maxx) and greatest(a.miny, b.miny) <= least(a.maxy, b.maxy)",
    **RECTS))
def q_rects_overlap(spark, sf):
    """All ordered pairs of distinct rectangles that meet (closed): each
    pair is emitted once although both span several shared cells."""
    r = X.rects(spark, sf)
    j = J.shape_join(r, r, cell=_RECT_CELL, predicate="intersects")
    return j.filter(F.col("rect_id_a") != F.col("rect_id_b")).select("rect_id_a", "rect_id_b")


@query("lines_bbox_overlap", X.with_ctes(
    "select a.line_id as line_id_a, b.line_id as line_id_b from lines a join lines b on a.line_id < b.line_id "
    "and greatest(least(a.x1, a.x2), least(b.x1, b.x2)) <= least(greatest(a.x1, a.x2), greatest(b.x1, b.x2)) "
    "and greatest(least(a.y1, a.y2), least(b.y1, b.y2)) <= least(greatest(a.y1, a.y2), greatest(b.y1, b.y2))",
    **LINES))
def q_lines_bbox_overlap(spark, sf):
    """Pairs of linestrings whose bounding boxes meet (shape/shape grid join,
    50 m cells, reference-point deduplication)."""
    b = _line_bbox(X.lines(spark, sf)).select("line_id", "minx", "miny", "maxx", "maxy")
    j = J.shape_join(b, b, cell=50.0, predicate="intersects")
    return j.filter(F.col("line_id_a") < F.col("line_id_b")).select("line_id_a", "line_id_b")


@query("region_stats_by_rect", X.with_ctes(
    "select r.rect_id, count(*) as total_points, count(case when p.classification = 2 then 1 end) as ground_points, "
    "min(p.z) as min_z, max(p.z) as max_z, round(avg(p.z), 6) as avg_z from rects r join pts p "
    "on p.x > r.minx and p.x < r.maxx and p.y > r.miny and p.y < r.maxy group by r.rect_id", **RECTS, **PTS))
def q_region_stats_by_rect(spark, sf):
    """Region statistics for every rectangle of a table (interior points)."""
    return A.region_stats_many(X.pts(spark, sf), X.rects(spark, sf), "rect_id", cell=_RECT_CELL)


# --------------------------------------------------------------------------
# appends, re-deliveries, shapes against shapes, statements as SQL text
# --------------------------------------------------------------------------

_PER_TILE = "select source_file, count(*) as n, round(sum(z), 6) as sum_z from pts group by source_file"


def _per_tile(df):
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 6).alias("sum_z"))


@query("append_two_tiles", X.with_ctes(_PER_TILE, **PTS_SRC))
def q_append_two_tiles(spark, sf):
    """Three appends to a catalog table: half of the tiles, the other half,
    and the first half again. No tile is lost and none is doubled."""
    import uuid
    name = f"punktwerk_append_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, "append-table")
    p = X.pts(spark, sf, with_source=True)
    half = F.pmod(F.xxhash64("source_file"), F.lit(2))
    SK.create_point_table(spark, name, location=path)
    for part in (0, 1, 0):
        SK.append_points(p.filter(half == part), table=name)
    SK.drop_point_table(spark, name)        # external: the files stay and are read below
    return _per_tile(spark.read.parquet(path))


@query("stream_two_runs", X.with_ctes(_PER_TILE, **PTS_SRC))
def q_stream_two_runs(spark, sf):
    """Two streams with a checkpoint each into one table: the first ingests
    half of the tiles, the second the other half and the first half again,
    delivered in new files."""
    table = scratch_path(spark, "runs-table")
    p = X.pts(spark, sf, with_source=True)
    half = F.pmod(F.xxhash64("source_file"), F.lit(2))
    for k, rows in enumerate((p.filter(half == 0), p)):
        src = scratch_path(spark, f"runs-src{k}")
        rows.repartition("source_file").write.partitionBy("source_file").option("header", True).csv(src)
        ST.stream_points(spark, src, table, scratch_path(spark, f"runs-ckpt{k}"), max_files=8).awaitTermination()
    return _per_tile(spark.read.parquet(table))


@query("sql_region_stats", X.with_ctes(
    "select count(*) as total_points, count(case when classification = 2 then 1 end) as ground_points, min(z) as min_z, "
    "max(z) as max_z, round(avg(z), 6) as avg_z from p where rid in "
    f"(select rid from ({point_in_polys_sql('p', {2: X.POLY2_WKT}, 'rid')}) where odd and not on_edge)",
    **PTS, p="select row_number() over () as rid, * from pts"))
def q_sql_region_stats(spark, sf):
    """Region statistics as one SQL statement over ST_* functions, with a
    polygon that cuts through the data."""
    register_sql_functions(spark)
    # the text is read once, by a statement of its own, not once a point
    poly = spark.sql(f"select st_geomfromtext('{X.POLY2_WKT}') as g").first().g
    v = _temp_view(X.pts(spark, sf).withColumn("poly", G.shape_literal(G.shape_of(poly))), "pts")
    return spark.sql(
        "select count(*) as total_points, count(case when classification = 2 then 1 end) as ground_points, min(z) as min_z, "
        f"max(z) as max_z, round(avg(z), 6) as avg_z from {v} "
        "where st_contains(poly, st_point(x, y))")


# A rectangle that shapes are measured against.
_BOX = (283000.0, 5653000.0, 284500.0, 5654200.0)
_BOX_WKT = ("POLYGON ((283000 5653000, 284500 5653000, 284500 5654200, 283000 5654200, 283000 5653000))")


def _gap_sql(x0, y0, x1, y1):
    """Distance of a box (column names) to the fixed one."""
    dx = f"greatest({d(_BOX[0])} - {x1}, {x0} - {d(_BOX[2])}, {d(0)})"
    dy = f"greatest({d(_BOX[1])} - {y1}, {y0} - {d(_BOX[3])}, {d(0)})"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


@query("sql_distance_shapes", X.with_ctes(
    f"select rect_id, round({_gap_sql('minx', 'miny', 'maxx', 'maxy')}, 6) as to_polygon, "
    f"round({_gap_sql('minx', 'miny', 'minx', 'miny')}, 6) as point_to_polygon, "
    f"round({_gap_sql('minx', 'miny', 'maxx', 'miny')}, 6) as line_to_polygon from rects", **RECTS))
def q_sql_distance_shapes(spark, sf):
    """st_distance between a polygon and polygons, points and lines (a
    rectangle, its corner, its lower side), as SQL text."""
    register_sql_functions(spark)
    v = _temp_view(X.rects(spark, sf), "rects")
    line = "concat('LINESTRING (', minx, ' ', miny, ', ', maxx, ' ', miny, ')')"
    return spark.sql(
        f"select rect_id, round(st_distance(st_makeenvelope(minx, miny, maxx, maxy), b), 6) as to_polygon, "
        f"round(st_distance(st_point(minx, miny), b), 6) as point_to_polygon, "
        f"round(st_distance(st_geomfromtext({line}), b), 6) as line_to_polygon "
        f"from (select *, st_geomfromtext('{_BOX_WKT}') as b from {v})")


@query("knn_shapes", X.with_ctes(
    f"select rect_id, round({_gap_sql('minx', 'miny', 'maxx', 'maxy')}, 6) as dist from rects "
    f"order by {_gap_sql('minx', 'miny', 'maxx', 'maxy')}, rect_id limit 20", **RECTS))
def q_knn_shapes(spark, sf):
    """The 20 rectangles nearest to a polygon: polygon objects, polygon query."""
    # the text is read once; a small file's rows are measured by all tasks
    box = G.shape_literal(G.shape_of(spark.range(1).select(G.st_geomfromtext(F.lit(_BOX_WKT)).alias("g")).first().g))
    r = X.rects(spark, sf).repartition(2 * spark.sparkContext.defaultParallelism)
    r = r.withColumn("geom", G.st_rect("minx", "miny", "maxx", "maxy"))
    out = J.knn(r, 20, G.st_distance("geom", box), "rect_id")
    return out.select("rect_id", F.round("dist", 6).alias("dist"))


_LINE_MEET = (
    "select a.line_id as line_id_a, b.line_id as line_id_b from lines a join lines b on a.line_id < b.line_id "
    "and least(a.x1, a.x2) <= greatest(b.x1, b.x2) and least(b.x1, b.x2) <= greatest(a.x1, a.x2) "
    "and least(a.y1, a.y2) <= greatest(b.y1, b.y2) and least(b.y1, b.y2) <= greatest(a.y1, a.y2) "
    "where sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) "
    "* sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) <= 0 "
    "and sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) "
    "* sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) <= 0")


# Lines in all directions, long enough to cross.
_CROSSING = ("c_custkey as line_id, cast(280000 + (c_custkey*8191 % 8400) as double) as x1, "
             "cast(5652000 + (c_custkey*4093 % 3900) as double) as y1, "
             "cast(280000 + (c_custkey*8191 % 8400) + (c_custkey*37 % 1000) - 500 as double) as x2, "
             "cast(5652000 + (c_custkey*4093 % 3900) + (c_custkey*91 % 1000) - 500 as double) as y2")


@query("lines_intersect_join", X.with_ctes(_LINE_MEET, lines=f"select {_CROSSING} from customer"))
def q_lines_intersect_join(spark, sf):
    """Pairs of lines that share a point (exact, not their boxes)."""
    raw = X.table(spark, sf, "customer").selectExpr(*_CROSSING.split(", "))
    lines = G.with_bbox(raw.withColumn("geom", G.st_linestring("x1", "y1", "x2", "y2")), "geom") \
        .select("line_id", "geom", "minx", "miny", "maxx", "maxy")
    j = J.shape_join(lines, lines, cell=250.0, geom="geom", only=F.col("line_id_a") < F.col("line_id_b"))
    return j.select("line_id_a", "line_id_b")


# Rectangles laid out on a lattice, so that many of them meet.
_LATTICE = ("s_suppkey as rect_id, cast(280000 + (s_suppkey % 12) * 100 as double) as minx, "
            "cast(5652000 + (floor(s_suppkey / 12) % 12) * 80 as double) as miny, "
            "cast(280000 + (s_suppkey % 12) * 100 + 100 + (s_suppkey % 3) * 20 as double) as maxx, "
            "cast(5652000 + (floor(s_suppkey / 12) % 12) * 80 + 80 as double) as maxy")
_LATTICE_CTE = {"rects": f"select {_LATTICE} from supplier"}
_MEET = ("from rects a join rects b on a.rect_id < b.rect_id and greatest(a.minx, b.minx) <= least(a.maxx, b.maxx) "
         "and greatest(a.miny, b.miny) <= least(a.maxy, b.maxy)")


def _lattice(spark, sf):
    return X.table(spark, sf, "supplier").selectExpr(*_LATTICE.split(", "))


@query("lattice_touch", X.with_ctes(
    f"select a.rect_id as rect_id_a, b.rect_id as rect_id_b {_MEET} and (greatest(a.minx, b.minx) = least(a.maxx, b.maxx) "
    "or greatest(a.miny, b.miny) = least(a.maxy, b.maxy))", **_LATTICE_CTE))
def q_lattice_touch(spark, sf):
    """Rectangles of a lattice that touch."""
    r = _lattice(spark, sf)
    j = J.shape_join(r, r, cell=100.0, predicate="touches")
    return j.filter(F.col("rect_id_a") < F.col("rect_id_b")).select("rect_id_a", "rect_id_b")


@query("lattice_overlap", X.with_ctes(f"select a.rect_id as rect_id_a, b.rect_id as rect_id_b {_MEET}", **_LATTICE_CTE))
def q_lattice_overlap(spark, sf):
    """Rectangles of a lattice that meet, each pair once."""
    r = _lattice(spark, sf)
    j = J.shape_join(r, r, cell=100.0, predicate="intersects")
    return j.filter(F.col("rect_id_a") < F.col("rect_id_b")).select("rect_id_a", "rect_id_b")


import punktwerk.plans.catalog_tiles  # noqa: E402,F401  (registers more queries)
