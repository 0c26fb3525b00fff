"""Aggregations over point tables: region statistics, class and value
counts, summaries, extent, multipoint union, sampling and labels.

All are plain ``groupBy``/``agg`` plans: Spark combines partial aggregates
map-side, so only one row per group and task crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from punktwerk.functions.geom import Shape, bbox_filter_literal, exact_literal, parse_wkt_literal

GROUND = 2

# Class code -> plot colour used by the reference, and the
# colour for codes not in the table.
CLASS_COLOURS = {0: "black", 1: "gray", 2: "brown", 7: "pink", 8: "yellow", 9: "blue",
                 18: "lightgreen", 20: "green", 24: "darkgreen", 26: "red"}
DEFAULT_COLOUR = "purple"


def region_stats(points: DataFrame, region: str | Shape, x: str = "x", y: str = "y",
                 boundary: bool = False) -> DataFrame:
    """Count, ground count and z range/mean of the points strictly inside a
    polygon (boundary points are outside unless ``boundary``).

    Only the polygon's bbox goes into the filter: as four range predicates
    on stored columns it reaches the Parquet scan (row-group pruning). The
    exact test (unrolled into arithmetic, one term per edge; nothing for a
    rectangle) is evaluated inside the aggregate, where x/y stay plain
    attributes instead of being inlined into a pushed-down filter. The
    global aggregate is partial per task: one row per task is shuffled."""
    shape = parse_wkt_literal(region) if isinstance(region, str) else region
    cand = points.filter(bbox_filter_literal(shape, x, y, boundary))
    inside = exact_literal(shape, x, y, boundary)
    z = F.when(inside, F.col("z"))
    return cand.agg(
        F.count_if(inside).alias("total_points"),
        F.count_if(inside & (F.col("classification") == GROUND)).alias("ground_points"),
        F.min(z).alias("min_z"),
        F.max(z).alias("max_z"),
        F.round(F.avg(z), 6).alias("avg_z"),
    )


def region_stats_many(points: DataFrame, regions: DataFrame, key: str, boundary: bool = False,
                      geom: str | None = None, cell: float | None = None) -> DataFrame:
    """Region statistics for a whole table of regions (bbox columns, plus a
    shape column ``geom`` for non-rectangular regions) in one grid join;
    regions without points are absent."""
    from punktwerk.operators.joins import spatial_join
    pairs = spatial_join(regions.select(key, "minx", "miny", "maxx", "maxy", *([geom] if geom else [])),
                         points.select("x", "y", "z", "classification"),
                         "covers" if boundary else "contains", cell=cell, geom=geom)
    return pairs.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_points"),
        F.count(F.when(F.col("classification") == GROUND, 1)).alias("ground_points"),
        F.min("z").alias("min_z"), F.max("z").alias("max_z"), F.round(F.avg("z"), 6).alias("avg_z"))


def class_counts(points: DataFrame) -> DataFrame:
    return points.groupBy("classification").agg(F.count(F.lit(1)).alias("n"))


def value_counts(points: DataFrame, col: str) -> DataFrame:
    """Group count by a (possibly float) column; Spark groups -0.0 with 0.0
    and all NaNs together."""
    return points.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def filter_class(points: DataFrame, code: int = GROUND) -> DataFrame:
    return points.filter(F.col("classification") == code)


def class_labels(points: DataFrame, mapping: dict | None = None,
                 default: str = DEFAULT_COLOUR, col: str = "classification",
                 out: str = "label") -> DataFrame:
    """Map a code to a label with a default for unknown codes; the map is a
    literal (bounded by the dictionary), evaluated in codegen."""
    mapping = CLASS_COLOURS if mapping is None else mapping
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(v))])
    return points.withColumn(out, F.coalesce(F.try_element_at(m, F.col(col)), F.lit(default)))


def describe_points(points: DataFrame, cols=("x", "y", "z", "intensity")) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per column in long form.

    All columns in one job: values are counted per distinct value (combined
    map-side, so a frequent value is one row per task), sorted by range
    partitions, and a running count places every value. Quartiles are exact,
    with linear interpolation between order statistics (the
    ``quantile_cont`` definition): the two order statistics around each are
    found by their positions, never by holding a column in one place."""
    long = points.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("e")) \
        .select("e.*").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    dev = long.groupBy("col_name").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                       F.min("v").alias("lo"), F.max("v").alias("hi"))
    values = long.groupBy("col_name", "v").agg(F.count("*").alias("m"))
    # running count in two levels: within a bucket of values, then over buckets
    b = value_buckets(values, dev)
    before = b.groupBy("col_name", "b").agg(F.sum("m").alias("bm")).withColumn(
        "bb", F.coalesce(F.sum("bm").over(W.partitionBy("col_name").orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    run = W.partitionBy("col_name", "b").orderBy("v")
    placed = b.join(before.select("col_name", "b", "bb"), ["col_name", "b"]).withColumn(
        "end", F.col("bb") + F.sum("m").over(run)).withColumn("start", F.col("end") - F.col("m"))

    def at(rank):       # the value at a 0-based rank, as an aggregate
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col("v")))

    def quartile(p):
        pos = F.lit(p) * (F.col("n") - 1)
        return F.struct(at(F.floor(pos)).alias("a"), at(F.ceil(pos)).alias("b"), F.max(pos - F.floor(pos)).alias("f"))

    q = placed.groupBy("col_name").agg(*[quartile(p).alias(name) for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    want = points.sparkSession.createDataFrame([(c,) for c in cols], "col_name string")
    j = want.join(dev, "col_name", "left").join(q, "col_name", "left")
    mid = {c: F.col(f"{c}.a") + (F.col(f"{c}.b") - F.col(f"{c}.a")) * F.col(f"{c}.f") for c in ("p25", "p50", "p75")}
    stats = (("count", F.coalesce("n", F.lit(0)).cast("double")), ("mean", F.col("mean")), ("std", F.col("std")), ("min", F.col("lo")),
             *mid.items(), ("max", F.col("hi")))
    return j.select("col_name", F.explode(F.array(*[F.struct(F.lit(k).alias("stat"), v.alias("value")) for k, v in stats])).alias("s")) \
        .select("col_name", "s.stat", F.round("s.value", 6).alias("value"))


def value_buckets(values: DataFrame, dev: DataFrame) -> DataFrame:
    """Distinct values (col_name, v, ...) with their column's ``dev`` row and
    a bucket ``b`` that grows with v: pieces between approximate quantiles,
    each cut at equal widths. Whatever the outliers, a bucket holds no more
    than about one piece, 1/256 of a column's distinct values."""
    cuts = values.groupBy("col_name").agg(F.percentile_approx("v", [i / (_COARSE * _FINE) for i in range(1, _COARSE * _FINE)], 10_000).alias("cuts"))
    b = values.join(dev.join(cuts, "col_name"), "col_name")
    # how many cuts lie at or below v, found in two steps
    b = b.withColumn("_p", F.expr(f"size(filter(transform(sequence(1, {_COARSE - 1}), i -> cuts[i * {_FINE} - 1]), c -> c <= v)) * {_FINE}"))
    b = b.withColumn("_p", F.expr(f"_p + size(filter(slice(cuts, _p + 1, {_FINE - 1}), c -> c <= v))"))
    low, high = F.coalesce(F.get("cuts", F.col("_p") - 1), F.col("lo")), F.coalesce(F.get("cuts", F.col("_p")), F.col("hi"))
    share = F.when(high > low, F.nanvl((F.col("v") - low) / (high - low), F.lit(1.0))).otherwise(0.0)
    return b.withColumn("b", (F.col("_p") * _WIDTHS + F.least(F.floor(share * _WIDTHS), F.lit(_WIDTHS - 1))).cast("int")).drop("cuts", "_p")


def describe_points_approx(points: DataFrame, cols=("x", "y", "z", "intensity"),
                           accuracy: int = 10000) -> DataFrame:
    """Same summary with bounded-memory quantile sketches."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
        aggs += [F.count(v).cast("double").alias(f"{c}__count"), F.avg(v).alias(f"{c}__mean"),
                 F.stddev_samp(v).alias(f"{c}__std"), F.min(v).alias(f"{c}__min"),
                 q[0].alias(f"{c}__p25"), q[1].alias(f"{c}__p50"), q[2].alias(f"{c}__p75"),
                 F.max(v).alias(f"{c}__max")]
    return _long_form(points.agg(*aggs), cols)


#: Buckets of the value range in the running count of ``describe_points``.
_COARSE, _FINE, _WIDTHS = 16, 16, 64
_STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _long_form(wide: DataFrame, cols) -> DataFrame:
    stack = ", ".join(f"'{c}', '{s}', `{c}__{s}`" for c in cols for s in _STATS)
    return wide.selectExpr(f"stack({len(cols) * len(_STATS)}, {stack}) as (col_name, stat, value)") \
        .withColumn("value", F.round("value", 6))


def dataset_counts(points: DataFrame) -> DataFrame:
    """Row count and count of distinct rows in one pass over the data."""
    cols = points.columns
    distinct = points.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    return distinct.agg(F.sum("_m").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))


def approx_counts(points: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Exact row count plus an approximate distinct count (HLL++)."""
    key = F.xxhash64(*[F.col(c) for c in points.columns])
    return points.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.approx_count_distinct(key, rsd).alias("approx_distinct"))


def extent(df: DataFrame, minx="x", miny="y", maxx=None, maxy=None) -> DataFrame:
    """Bounding box and count of a data set (the 'analyze' step)."""
    maxx = maxx or minx
    maxy = maxy or miny
    return df.agg(F.min(minx).alias("minx"), F.min(miny).alias("miny"),
                  F.max(maxx).alias("maxx"), F.max(maxy).alias("maxy"),
                  F.count(F.lit(1)).alias("n"))


def multipoint_union(df: DataFrame, by: str, x: str = "x", y: str = "y",
                     chunk_cell: float = 250.0) -> DataFrame:
    """Distinct points of each group as sorted MULTIPOINT vertex lists, one
    row per cell of side ``chunk_cell`` (chunk_x, chunk_y): the rows follow
    from the data alone, and no list grows beyond the points of a cell."""
    pts = df.select(by, F.col(x).alias("x"), F.col(y).alias("y")).distinct()
    cell = [F.floor(F.col(c) / chunk_cell).cast("bigint").alias(f"chunk_{c}") for c in ("x", "y")]
    return pts.groupBy(by, *cell).agg(
        F.sort_array(F.collect_list(F.struct("x", "y"))).alias("points")
    ).withColumn("n_points", F.size("points"))


def sample_points(df: DataFrame, n: int, seed: int = 0, key: str | Column | None = None) -> DataFrame:
    """Seeded sample of ``least(n, count)`` rows without replacement: the n
    rows with the smallest md5(key|seed).

    The hash value of the n-th row is found first, on a histogram of hash
    prefixes (one row per prefix, whatever the size of the input); rows below
    its prefix are taken, and only the rows of that one prefix are sorted.
    Equals ``orderBy(md5).limit(n)``."""
    k = F.col(key) if isinstance(key, str) else key
    if k is None:
        k = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    h = F.md5(F.concat_ws("|", k.cast("string"), F.lit(str(seed))))
    hashed = df.withColumn("_h", h).withColumn("_p", F.substring("_h", 1, 4))
    hist = hashed.groupBy("_p").agg(F.count("*").alias("m"))
    run = hist.withColumn("upto", F.sum("m").over(W.orderBy("_p")))     # at most 65,536 prefixes
    edge = run.filter(F.col("upto") >= n).orderBy("_p").first()
    if edge is None:
        return df
    inside = hashed.filter(F.col("_p") < edge["_p"])
    border = hashed.filter(F.col("_p") == edge["_p"]).orderBy("_h").limit(n - (edge["upto"] - edge["m"]))
    return inside.unionByName(border).drop("_h", "_p")


def head(df: DataFrame, n: int, *order) -> DataFrame:
    """First n rows in a deterministic order."""
    return df.orderBy(*order).limit(n)


def coords_clean(df: DataFrame, cols=("x", "y")) -> DataFrame:
    """Drop rows with missing coordinates and narrow them to float32."""
    out = df.dropna(subset=list(cols))
    for c in cols:
        out = out.withColumn(c, F.col(c).cast("float"))
    return out
