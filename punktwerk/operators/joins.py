"""Spatial joins as grid-cell equi-joins.

A raw theta predicate (``ST_Distance(a, b) < d``, ``ST_Contains(s, p)``)
plans as a nested-loop join. Here every spatial join is rewritten into an
equi-join on an integer cell key plus an exact filter, which Catalyst plans
as an ordinary shuffled (or, when AQE measures a small side, broadcast) hash
join:

* points map to one cell; the other side is replicated to the cells it can
  reach (3x3 block for a distance join, the covered cell range for a shape);
  a distance join of many pairs ships its rows once per tile of cells and
  replicates them behind the exchange;
* shapes too large for ``max_cells`` cells at the base size go to a coarser
  level (cell size doubled per level); points carry one key per level in
  use, so no candidate is ever dropped;
* the pairs of a cell (rows of one side times rows of the other) are counted
  first: a join takes as many partitions as its pairs ask for, and a cell
  whose pairs exceed a block is split into blocks on both sides, so a hot
  cell never lands in one task;
* shape/shape pairs found in several cells are kept only in the cell that
  holds the minimum corner of their bbox intersection (reference point).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punktwerk.functions import geom as G
from punktwerk.session import scratch_path


def cell_index(v, size: float) -> Column:
    """Integer cell of a coordinate for a given cell size."""
    c = F.col(v) if isinstance(v, str) else v
    return F.floor(c / F.lit(float(size))).cast("bigint")


def with_grid(df: DataFrame, cell: float, x: str = "x", y: str = "y",
              names=("cx", "cy")) -> DataFrame:
    return df.withColumn(names[0], cell_index(x, cell)).withColumn(names[1], cell_index(y, cell))


# --------------------------------------------------------------------------
# skew: salt hot cells
# --------------------------------------------------------------------------

#: Rows of one side in one block of a hot cell: a task compares at most
#: BLOCK_ROWS x BLOCK_ROWS pairs of such a cell at a time.
BLOCK_ROWS = 5_000


def hot_cells(df: DataFrame, keys: list[str], max_cell_rows: int) -> DataFrame:
    """Cells holding more than ``max_cell_rows`` rows and how many salt
    buckets each needs. At most count/max_cell_rows rows, so the table is
    small; AQE broadcasts it when its measured size allows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > max_cell_rows).select(
        *keys, F.ceil(F.col("_n") / F.lit(max_cell_rows)).cast("int").alias("_nsalt"))


def key_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` using null-safe equality. It plans as the same
    hash join, but Catalyst infers no ``isnotnull(key)`` filter from it; such
    an inferred filter would be pushed below the projections and inline the
    whole expression behind a derived key (a coordinate transform, say) into
    the scan. Rows with null keys are removed by the exact predicates that
    follow every use here."""
    renamed = b.select(*[F.col(c).alias(f"_r{c}") if c in keys else F.col(c) for c in b.columns])
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(renamed[f"_r{k}"])
        cond = c if cond is None else cond & c
    return a.join(renamed, cond, how).drop(*[f"_r{k}" for k in keys])


def cell_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


#: Pairs of rows that one task of a spread join compares, about, and the most
#: tasks that such a join takes.
PAIRS_PER_TASK = 2_000_000
MAX_TASKS = 4_096


def _wide_join(a: DataFrame, b: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Inner equi-join on integer ``keys`` over ``n`` partitions. Both sides
    are dealt by a hash of the keys, which is never null, so the join adds no
    exchange and no inferred filter; the keys themselves decide."""
    renamed = b.select(*[F.col(c).alias(f"_r{c}") if c in keys else F.col(c) for c in b.columns])
    left = a.withColumn("_h", F.xxhash64(*keys)).repartition(n, "_h")
    right = renamed.withColumn("_rh", F.xxhash64(*[f"_r{k}" for k in keys])).repartition(n, "_rh")
    cond = left["_h"] == right["_rh"]
    for k in keys:
        cond = cond & (F.coalesce(left[k].bitwiseXOR(right[f"_r{k}"]), F.lit(1)) == 0)
    return left.join(right, cond).drop("_h", "_rh", *[f"_r{k}" for k in keys])


def _pairs() -> Column:
    return F.col("_nb").cast("double") * F.col("_ns")


def _met(big: DataFrame, small: DataFrame, keys: list[str], big_counts: DataFrame | None = None,
         small_counts: DataFrame | None = None) -> DataFrame:
    """Keys that both sides have, with the rows of each (_nb, _ns)."""
    nb = big_counts if big_counts is not None else cell_counts(big, keys, "_nb")
    ns = small_counts if small_counts is not None else cell_counts(small, keys, "_ns")
    return _staged(key_join(nb, ns, keys).filter(F.col(keys[0]).isNotNull()), "cell-pairs")


def _tasks(pairs: float | None) -> int:
    return min(math.ceil((pairs or 0) / PAIRS_PER_TASK), MAX_TASKS)


def salted_equi_join(big: DataFrame, small: DataFrame, keys: list[str], block_rows: int | None = BLOCK_ROWS,
                     big_counts: DataFrame | None = None, small_counts: DataFrame | None = None, met: DataFrame | None = None) -> DataFrame:
    """Inner equi-join on integer ``keys`` spread by its number of pairs.

    The pairs of each key are counted first (counts are combined map-side).
    A join of many pairs is dealt over as many partitions as they ask for,
    however few bytes or splits its inputs have; a small one is left to the
    planner. A key is hot when the product of its row counts exceeds
    ``block_rows`` squared. Its rows are dealt, row by row (so that equal
    rows are dealt too), into blocks of about ``block_rows`` on either side,
    and each block meets every block of the other side once: the pairs of a
    hot key spread over many tasks and each pair comes out once."""
    if not block_rows:
        return key_join(big, small, keys)
    met = met if met is not None else _met(big, small, keys, big_counts, small_counts)
    total, most = met.agg(F.sum(_pairs()), F.max(_pairs())).first()
    tasks = _tasks(total)
    on, salts = keys, ["_sb", "_ss"]
    if (most or 0) > block_rows * block_rows:
        hot = _written(met.filter(_pairs() > float(block_rows * block_rows)).select(
            *keys, F.ceil(F.col("_nb") / block_rows).cast("int").alias("_kb"),
            F.ceil(F.col("_ns") / block_rows).cast("int").alias("_ks")), "hot-cells")
        big, small, on = _dealt(big, hot, keys, "b", "s"), _dealt(small, hot, keys, "s", "b"), keys + salts
    if tasks < 2:
        return key_join(big, small, on).drop(*salts)
    return _wide_join(big, small, on, max(tasks, big.sparkSession.sparkContext.defaultParallelism)).drop(*salts)


def _dealt(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
    """Rows of hot cells dealt into the blocks of their side (_s<own>) and
    repeated for those of the other side (_s<other>): none without any there."""
    j = key_join(df.withColumn("_at", F.monotonically_increasing_id()), hot, keys, "left")
    j = j.filter(F.coalesce(F.col(f"_k{other}"), F.lit(1)) > 0)
    mine = F.coalesce(F.pmod(F.col("_at"), F.col(f"_k{own}")).cast("int"), F.lit(0))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"_k{other}"), F.lit(1)) - 1))
    return j.withColumn(f"_s{own}", mine).withColumn(f"_s{other}", every).drop("_at", "_kb", "_ks")


def _staged(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared scratch folder: computed once, and what reads it
    is planned apart from what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _written(df: DataFrame, name: str) -> DataFrame:
    """A small table in the shared scratch folder, with a known size. What is
    filtered before runs in parallel; only the rows that stay meet."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.repartition(1).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------
# distance join (points)
# --------------------------------------------------------------------------

def _valid(x: str, y: str) -> Column:
    return F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)


def _valid_or_null(x: str, y: str, key: Column) -> Column:
    return F.when(_valid(x, y), key)


def _valid_or_unique(x: str, y: str, key: Column, left_side: bool, row_hash: Column) -> Column:
    """Second cell key; rows without valid coordinates get a value from a
    range of their own side (left: [-2^62, -1], right: below -2^62), spread
    by a hash of the row, so with the null first key they match nothing and
    do not pile up in one partition. This keeps invalid rows from meeting
    in a shared key -- without a filter, which Catalyst would push below
    derived coordinates."""
    h = F.pmod(row_hash, F.lit(1 << 62))
    sentinel = (-1 - h) if left_side else (F.lit(-(1 << 62)) - 1 - h)
    return F.when(_valid(x, y), key).otherwise(sentinel)


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix) for c in df.columns])


def distance_join(left: DataFrame, right: DataFrame, d: float, x: str = "x", y: str = "y",
                  inclusive: bool = False, suffixes=("_a", "_b"),
                  block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """All pairs (l, r) with Euclidean distance < d (<= d if inclusive).

    Columns of both inputs come back with the suffixes. A self-join keeps
    identity pairs and both orders. Cell size = d: ``left`` keeps its cell,
    ``right`` is replicated to the 3x3 block around its cell, so every pair
    meets in exactly one cell. Pass the smaller input as ``right``."""
    sa, sb = suffixes
    xa, ya, xb, yb = x + sa, y + sa, x + sb, y + sb
    L = _suffixed(left, sa)
    L = L.withColumn("_cx", _valid_or_null(xa, ya, cell_index(xa, d))) \
         .withColumn("_cy", _valid_or_unique(xa, ya, cell_index(ya, d), True,
                                             F.xxhash64(*[F.col(c) for c in L.columns])))
    offs = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"))
                     for i in (-1, 0, 1) for j in (-1, 0, 1)])
    R = _suffixed(right, sb)
    r_hash = F.xxhash64(*[F.col(c) for c in R.columns])
    # rows per replicated cell, from the cells' counts (not from nine-fold rows)
    own = R.filter(_valid(xb, yb)).groupBy(cell_index(xb, d).alias("_cx"), cell_index(yb, d).alias("_cy")).count()
    reach = own.withColumn("_o", F.explode(offs)).groupBy(
        (F.col("_cx") + F.col("_o.dx")).alias("_cx"), (F.col("_cy") + F.col("_o.dy")).alias("_cy")).agg(F.sum("count").alias("_ns"))
    if block_rows:
        counts = L.filter(_valid(xa, ya)).groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_nb"))
        met = _met(L, R, ["_cx", "_cy"], counts, reach)
        tasks = _tasks(met.agg(F.sum(_pairs())).first()[0])
    flat, r_own = L, R
    R = R.withColumn("_o", F.explode(offs))
    R = R.withColumn("_cx", _valid_or_null(xb, yb, cell_index(xb, d) + F.col("_o.dx"))) \
         .withColumn("_cy", _valid_or_unique(xb, yb, cell_index(yb, d) + F.col("_o.dy"), False, r_hash)) \
         .drop("_o")
    dist = G.dist_xy(xa, ya, xb, yb)
    cond = dist <= d if inclusive else dist < d
    if not block_rows or tasks < 2:
        return salted_equi_join(L, R, ["_cx", "_cy"], block_rows, met=met if block_rows else None).filter(cond).drop("_cx", "_cy")
    # cells too full for lists: their rows are shipped in blocks
    full = met.filter((_pairs() > 16.0 * block_rows * block_rows) | (F.greatest("_nb", "_ns") > 20 * block_rows))
    flat = flat.filter(_valid(xa, ya))
    r_own = r_own.filter(_valid(xb, yb)).withColumn("_cx", cell_index(xb, d)).withColumn("_cy", cell_index(yb, d))
    n = max(tasks, left.sparkSession.sparkContext.defaultParallelism)
    if full.isEmpty():
        return _tiled_pairs(flat, r_own, xb, yb, n).filter(cond).select(*_columns(left, sa), *_columns(right, sb))
    full = _written(full, "full-cells")
    at = [F.col("_cx") == F.col("_fx"), F.col("_cy") == F.col("_fy")]
    cells = full.select(F.col("_cx").alias("_fx"), F.col("_cy").alias("_fy"))
    calm = _tiled_pairs(flat.join(cells, at, "left_anti"), r_own, xb, yb, n)
    hot = salted_equi_join(flat.join(cells, at, "left_semi"), R.filter(_valid(xb, yb)).join(cells, at, "left_semi"),
                           ["_cx", "_cy"], block_rows, met=full)
    out = [*_columns(left, sa), *_columns(right, sb)]
    return calm.select(*out).unionByName(hot.select(*out)).filter(cond)


def _columns(df: DataFrame, suffix: str) -> list[str]:
    return [c + suffix for c in df.columns]


#: Cells of a tile, a side, as a power of two.
TILE_BITS = 2
#: Pairs that may wait between two operators of a tiled join, about, and the
#: most shares that a cell's left rows are cut into for it.
PAIRS_WAITING = 100_000
MAX_SHARES = 1_024


def _tiled_pairs(left: DataFrame, right: DataFrame, xb: str, yb: str, n: int) -> DataFrame:
    """Pairs of rows whose own cells (_cx, _cy) are neighbours or the same.

    A row of ``right`` is shipped once to each tile of cells that its 3x3
    block meets, not once to each cell; it is repeated for the cells of a
    tile behind the exchange. There the rows of a cell are lists, and pairs
    are made by walking them. The generated code of a walk keeps all pairs of
    its input row until it ends, so the left rows come in shares of a cell's,
    with few pairs each. The places ``xb``, ``yb`` are walked as lists of
    numbers; a right row's other columns are looked up for pairs that stay."""
    side = 1 << TILE_BITS

    def tile(c):
        return F.shiftright(c, TILE_BITS)

    def reached(c):
        return F.explode(F.sequence(tile(F.col(c) - 1), tile(F.col(c) + 1)))

    def row(df):
        return F.struct(*[c for c in df.columns if c not in ("_cx", "_cy")])

    a = left.select("_cx", "_cy", tile(F.col("_cx")).alias("_tx"), tile(F.col("_cy")).alias("_ty"), row(left).alias("_l"))
    b = right.select("_cx", "_cy", row(right).alias("_r")).withColumn("_tx", reached("_cx")).withColumn("_ty", reached("_cy"))
    here = a.unionByName(b, allowMissingColumns=True).repartition(n, "_tx", "_ty")
    step = F.when(F.col("_l").isNull(), F.lit(1)).otherwise(F.lit(0))

    def cells(c, t):
        return F.explode(F.sequence(F.greatest(F.col(c) - step, F.col(t) * side), F.least(F.col(c) + step, F.col(t) * side + (side - 1))))

    here = here.withColumn("_gx", cells("_cx", "_tx")).withColumn("_gy", cells("_cy", "_ty"))
    lists = here.groupBy("_tx", "_ty", "_gx", "_gy").agg(F.collect_list("_l").alias("_ls"), F.collect_list("_r").alias("_rs"))
    lists = lists.filter((F.size("_ls") > 0) & (F.size("_rs") > 0)).select("_ls", "_rs", F.col("_rs")[xb].alias("_xs"), F.col("_rs")[yb].alias("_ys"))
    some = F.greatest(F.ceil(F.lit(float(PAIRS_WAITING)) / F.size("_rs")), F.ceil(F.size("_ls") / F.lit(float(MAX_SHARES)))).cast("int")
    shares = F.transform(F.sequence(F.lit(1), F.size("_ls"), some), lambda i: F.slice("_ls", i, some))
    # the left row's columns are taken out once, not for each pair
    each = lists.select(F.explode(shares).alias("_l"), "_rs", "_xs", "_ys").select(F.inline("_l"), "_rs", "_xs", "_ys")
    each = each.select("*", F.posexplode("_xs").alias("_i", "_x"))
    of = {xb: F.col("_x"), yb: F.get("_ys", F.col("_i"))}
    return each.select(*[c for c in left.columns if c not in ("_cx", "_cy")],
                       *[of.get(c, F.get("_rs", F.col("_i"))[c]).alias(c) for c in right.columns if c not in ("_cx", "_cy")])


# --------------------------------------------------------------------------
# shape / point join
# --------------------------------------------------------------------------

def _level_of(minx, miny, maxx, maxy, cell: float, max_cells: int, tries: int = 8) -> Column:
    """Smallest level whose cell size (cell * 2^level) covers the bbox in at
    most ``max_cells`` cells. No level below sqrt(w*h/max_cells) can do it
    (area bound), so at most ``tries`` levels from there are tested; for very
    elongated boxes the fallback is ceil(log2(max side / cell)), where the box
    spans at most 2 x 2 cells (valid, possibly not the smallest)."""
    w = F.col(maxx) - F.col(minx)
    h = F.col(maxy) - F.col(miny)
    tiny = F.lit(1e-300)
    lo = F.greatest(F.lit(0), F.ceil(F.log2(F.sqrt(F.greatest(w * h / max_cells, tiny)) / cell)).cast("int"))
    top = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.greatest(w, h), tiny) / cell)).cast("int"))

    def n_cells(lv):
        size = F.lit(float(cell)) * F.pow(F.lit(2.0), lv)
        return (F.floor(F.col(maxx) / size) - F.floor(F.col(minx) / size) + 1) * \
            (F.floor(F.col(maxy) / size) - F.floor(F.col(miny) / size) + 1)
    expr = top
    for k in range(tries - 1, -1, -1):
        lv = lo + k
        expr = F.when((lv < top) & (n_cells(lv) <= max_cells), lv).otherwise(expr)
    return expr


def _cells_of_bbox(minx, miny, maxx, maxy, size: Column) -> Column:
    """array<struct<cx,cy>> of the cells a bbox covers at a cell size."""
    x0 = F.floor(F.col(minx) / size).cast("bigint")
    x1 = F.floor(F.col(maxx) / size).cast("bigint")
    y0 = F.floor(F.col(miny) / size).cast("bigint")
    y1 = F.floor(F.col(maxy) / size).cast("bigint")
    return F.flatten(F.transform(F.sequence(x0, x1), lambda cx: F.transform(
        F.sequence(y0, y1), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def suggest_cell(shapes: DataFrame, bbox=("minx", "miny", "maxx", "maxy")) -> float:
    """Base cell size from the shapes' mean extent (one small aggregate)."""
    minx, miny, maxx, maxy = bbox
    r = shapes.agg(F.avg(F.greatest(F.col(maxx) - F.col(minx), F.col(maxy) - F.col(miny))).alias("s")).first()
    s = r["s"] if r and r["s"] else 1.0
    return float(max(s, 1e-9))


def _gridded(shapes: DataFrame, points: DataFrame, cell: float, max_cells: int, x: str, y: str,
             bbox) -> tuple[DataFrame, DataFrame]:
    """Shapes repeated for the cells of their box, points with the cell of
    each level in use: both with _lv, _cx, _cy."""
    minx, miny, maxx, maxy = bbox
    s = shapes.withColumn("_lv", _level_of(minx, miny, maxx, maxy, cell, max_cells))
    levels = sorted(r[0] for r in s.select("_lv").distinct().collect())  # a few levels, whatever the number of shapes
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_lv"))
    s = s.withColumn("_c", F.explode(_cells_of_bbox(minx, miny, maxx, maxy, size))) \
         .select("*", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy")).drop("_c")
    keys = F.array(*[F.struct(F.lit(lv).alias("lv"), cell_index(x, cell * 2 ** lv).alias("cx"),
                              cell_index(y, cell * 2 ** lv).alias("cy")) for lv in levels])
    p = points.withColumn("_k", F.explode(keys)).select(
        "*", F.col("_k.lv").alias("_lv"), F.col("_k.cx").alias("_cx"), F.col("_k.cy").alias("_cy")).drop("_k")
    return s, p


#: A shape / point join works on cells this much smaller a side than asked
#: for: fewer points are compared that lie beside a shape.
FINER = 4


def spatial_join(shapes: DataFrame, points: DataFrame, predicate: str = "covers",
                 cell: float | None = None, x: str = "x", y: str = "y",
                 bbox=("minx", "miny", "maxx", "maxy"), geom: str | None = None,
                 max_cells: int = 64, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """All (shape, point) pairs where the shape covers (closed boundary) or
    contains (interior only) the point.

    ``shapes`` carries flat bbox columns; if ``geom`` names a shape column
    the exact test runs on it, otherwise the shapes are the bbox rectangles
    themselves. The output has all shape columns and all point columns.

    A join of few pairs is left to ``salted_equi_join``. One of many ships a
    point once a level and the shapes of a cell as lists (``_listed_pairs``).
    """
    if predicate not in ("covers", "contains", "intersects", "within"):
        raise ValueError(predicate)
    closed = predicate in ("covers", "intersects")
    cell = (cell or suggest_cell(shapes, bbox)) / FINER
    max_cells = max_cells * FINER * FINER

    def hit(col):
        px, py, (x0, y0, x1, y1) = col(x), col(y), [col(c) for c in bbox]
        if closed:
            bb = (px >= x0) & (px <= x1) & (py >= y0) & (py <= y1)
        else:
            bb = (px > x0) & (px < x1) & (py > y0) & (py < y1)
        if geom is not None:
            bb = bb & (G.st_covers_xy(col(geom), px, py) if closed else G.st_contains_xy(col(geom), px, py))
        return bb

    keys = ["_lv", "_cx", "_cy"]
    met = None
    s, p = _gridded(shapes, points, cell, max_cells, x, y, bbox)
    if block_rows:
        p = p.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        held = _staged(cell_counts(p, keys, "_nb").unionByName(cell_counts(s, keys, "_ns"), allowMissingColumns=True).groupBy(*keys).agg(
            F.coalesce(F.sum("_nb"), F.lit(0)).alias("_nb"), F.coalesce(F.sum("_ns"), F.lit(0)).alias("_ns")), "cell-pairs")
        total, rows, most, longest = held.agg(F.sum(_pairs()), F.sum(F.col("_nb") + F.col("_ns")), F.max(_pairs()), F.max("_ns")).first()
        if _tasks(total) > 1:
            hot = None
            if most > block_rows * block_rows or longest > block_rows:
                hot = _written(held.filter((_pairs() > float(block_rows * block_rows)) | (F.col("_ns") > block_rows)).select(
                    *keys, F.ceil(F.col("_nb") / block_rows).cast("int").alias("_kb"),
                    F.ceil(F.col("_ns") / block_rows).cast("int").alias("_ks")), "hot-cells")
            n = min(math.ceil(max(total / PAIRS_PER_LIST_TASK, rows / ROWS_PER_LIST_TASK)), MAX_TASKS)
            return _listed_pairs(p, s, keys, hot, max(n, points.sparkSession.sparkContext.defaultParallelism), hit)
        met = held.filter((F.col("_nb") > 0) & (F.col("_ns") > 0))
    return salted_equi_join(p, s, keys, block_rows, met=met).filter(hit(F.col)).drop(*keys)


#: Pairs that one task of a listed join tests and rows that it takes in, about.
PAIRS_PER_LIST_TASK = 5_000_000
ROWS_PER_LIST_TASK = 500_000


def _listed_pairs(points: DataFrame, shapes: DataFrame, keys: list[str], hot: DataFrame | None, n: int, hit) -> DataFrame:
    """Pairs of rows with equal ``keys`` that pass ``hit``, over ``n``
    partitions; ``hot`` has the blocks of cells that take more than one.

    The shapes of a cell (of a block of it) are one list behind the exchange,
    each point meets it once and walks it: no pair is made before its test,
    points are not sorted, and a point's pairs follow each other. What waits
    between two operators is one point's pairs, never a cell's."""
    if hot is not None:
        points, shapes = _dealt(points, hot, keys, "b", "s"), _dealt(shapes, hot, keys, "s", "b")
        keys = keys + ["_sb", "_ss"]
    # names of their own: the sides may share column names
    ours = {c: f"_p{i}" for i, c in enumerate(c for c in points.columns if c not in keys)}
    theirs = {c: f"_q{i}" for i, c in enumerate(c for c in shapes.columns if c not in keys)}
    h = F.xxhash64(*keys)
    lists = shapes.select(h.alias("_rh"), *[F.col(k).alias(f"_r{k}") for k in keys], F.struct(*[F.col(c).alias(a) for c, a in theirs.items()]).alias("_q"))
    lists = lists.repartition(n, "_rh").groupBy("_rh", *[f"_r{k}" for k in keys]).agg(F.collect_list("_q").alias("_qs"))
    each = points.select(h.alias("_h"), *keys, *[F.col(c).alias(a) for c, a in ours.items()]).repartition(n, "_h")
    cond = each["_h"] == lists["_rh"]
    for k in keys:
        cond = cond & (F.coalesce(each[k].bitwiseXOR(lists[f"_r{k}"]), F.lit(1)) == 0)
    j = each.join(lists.hint("shuffle_hash"), cond).select(*ours.values(), F.inline("_qs"))
    # a name of both sides means the point's, as x and y, or else the shape's
    out = j.filter(hit(lambda c: F.col((theirs | ours)[c])))
    return out.select(*[F.col(a).alias(c) for side in (ours, theirs) for c, a in side.items()])


#: Counting works on cells this much smaller a side than asked for.
COUNT_FINER = 16


def spatial_join_counts(shapes: DataFrame, points: DataFrame, shape_key: str, predicate: str = "covers",
                        cell: float | None = None, x: str = "x", y: str = "y",
                        bbox=("minx", "miny", "maxx", "maxy"), max_cells: int = 64,
                        block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """(shape_key, n): the number of pairs of ``spatial_join`` by rectangle,
    without making them. A cell strictly between the cells of a rectangle's
    sides lies in its interior, so its count is added; only points of cells
    on the sides are compared. Rectangles without points are absent."""
    if predicate not in ("covers", "contains", "intersects", "within"):
        raise ValueError(predicate)
    minx, miny, maxx, maxy = bbox
    cell = (cell or suggest_cell(shapes, bbox)) / COUNT_FINER
    s, p = _gridded(shapes.select(shape_key, *bbox), points.select(x, y), cell, max_cells * COUNT_FINER * COUNT_FINER, x, y, bbox)
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_lv"))
    at = {c: F.floor(F.col(c) / size).cast("bigint") for c in bbox}
    inner = (F.col("_cx") > at[minx]) & (F.col("_cx") < at[maxx]) & (F.col("_cy") > at[miny]) & (F.col("_cy") < at[maxy])
    keys = ["_lv", "_cx", "_cy"]
    held = _staged(cell_counts(p, keys, "_n"), "cell-counts")
    whole = key_join(s.filter(inner).select(shape_key, *keys), held, keys).select(shape_key, "_n")
    px, py = F.col(x), F.col(y)
    if predicate in ("covers", "intersects"):
        hit = (px >= F.col(minx)) & (px <= F.col(maxx)) & (py >= F.col(miny)) & (py <= F.col(maxy))
    else:
        hit = (px > F.col(minx)) & (px < F.col(maxx)) & (py > F.col(miny)) & (py < F.col(maxy))
    sides = salted_equi_join(p, s.filter(~inner), keys, block_rows, big_counts=held.withColumnRenamed("_n", "_nb")).filter(hit)
    sides = sides.groupBy(shape_key).agg(F.count(F.lit(1)).alias("_n"))
    return whole.unionByName(sides).groupBy(shape_key).agg(F.sum("_n").alias("n"))


#: Points that one task of a grouped join tests, about.
TESTS_PER_TASK = 200_000_000
#: Strips that a chunk's list of points is cut into along x.
STRIPS = 16


def spatial_join_grouped(shapes: DataFrame, points: DataFrame, shape_key: str,
                         point_cols=("x", "y"), chunk_cell: float = 250.0, predicate: str = "covers",
                         cell: float | None = None, x: str = "x", y: str = "y",
                         bbox=("minx", "miny", "maxx", "maxy"), geom: str | None = None,
                         max_cells: int = 64, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Shape + list of its points, one row per cell of side ``chunk_cell``
    that the points lie in (chunk_x, chunk_y): the rows follow from the data
    alone, at every size, and no list grows beyond the points of a cell.
    Shapes without points are absent (inner join).

    The pairs are never shipped: a cell's points are one sorted list, in
    strips along x, and each shape whose box meets their extent takes its own
    out of the strips that it reaches. A shape is hash-joined to the list, so
    one shape at a time stands beside it."""
    if predicate not in ("covers", "contains", "intersects", "within"):
        raise ValueError(predicate)
    closed = predicate in ("covers", "intersects")
    chunk, ext = ["_kx", "_ky"], ["_x0", "_y0", "_x1", "_y1"]
    at = with_grid(points.filter(_valid(x, y)), chunk_cell, *point_cols[:2], names=chunk)
    # a point that shows its place is not kept beside it
    own = x in point_cols and y in point_cols
    pt = F.struct(*[F.col(c) for c in point_cols])
    strip = F.floor((F.col(x) / chunk_cell - F.col("_kx")) * STRIPS) if point_cols[0] == x else F.lit(0).cast("long")
    at = at.select(*chunk, strip.alias("_i"), F.col(x).alias("_px"), F.col(y).alias("_py"),
                   (pt if own else F.struct(pt.alias("_pt"), F.col(x).alias("_px"), F.col(y).alias("_py"))).alias("_p"))
    chunks = _staged(at.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_n"), F.min("_px").alias("_x0"), F.min("_py").alias("_y0"),
                                            F.max("_px").alias("_x1"), F.max("_py").alias("_y1")), "chunks")
    cell = cell or suggest_cell(shapes, bbox)
    shape = F.struct(*[F.col(c).alias(f"b{i}") for i, c in enumerate(bbox)], *([F.col(geom).alias("g")] if geom else []))
    boxes = shapes.select(*[F.col(c).alias(e) for c, e in zip(bbox, ext)], F.col(shape_key).alias("_key"), shape.alias("_shape"))
    met = shape_join(boxes, chunks, cell, "intersects", ext, ("_a", "_b"), max_cells, None, block_rows)
    # a key may name several shapes: their points make one list
    met = _staged(met.groupBy(F.col("_key_a").alias("_key"), F.col("_kx_b").alias("_sx"), F.col("_ky_b").alias("_sy")).agg(
        F.collect_list("_shape_a").alias("_shapes"), F.sum("_n_b").alias("_tests")), "chunk-shapes")
    # the tests of a chunk are dealt over blocks of shapes, each with the list
    blocks = _staged(met.groupBy("_sx", "_sy").agg(F.ceil(F.sum("_tests") / TESTS_PER_TASK).cast("int").alias("_k")), "chunk-blocks")
    n = max(min(int(blocks.agg(F.sum("_k")).first()[0] or 1), MAX_TASKS), points.sparkSession.sparkContext.defaultParallelism)
    here = [*chunk, "_s"]
    a = at.join(blocks, (F.col("_sx") == F.col("_kx")) & (F.col("_sy") == F.col("_ky"))).select(
        *chunk, F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_s"), "_i", "_px", "_p").repartition(n, *here)
    a = a.groupBy(*here, "_i").agg(F.min("_px").alias("_x0"), F.max("_px").alias("_x1"), F.sort_array(F.collect_list("_p")).alias("_l"))
    lists = a.groupBy(*here).agg(F.sort_array(F.collect_list(F.struct("_i", "_x0", "_x1", "_l"))).alias("_strips"))
    b = met.withColumn("_at", F.monotonically_increasing_id()).join(blocks.withColumnsRenamed({"_sx": "_bx", "_sy": "_by"}),
                                                                    (F.col("_sx") == F.col("_bx")) & (F.col("_sy") == F.col("_by")))
    # the sides of a key's only shape are columns: they are read for each point
    b = b.select("_sx", "_sy", F.pmod("_at", "_k").cast("int").alias("_t"), "_key", "_shapes",
                 *[F.get("_shapes", F.lit(0))[f"b{i}"].alias(f"_b{i}") for i in range(4)]).repartition(n, "_sx", "_sy", "_t")
    j = b.join(lists.hint("shuffle_hash"), (F.col("_sx") == F.col("_kx")) & (F.col("_sy") == F.col("_ky")) & (F.col("_t") == F.col("_s")))

    def held(box, g):
        x0, y0, x1, y1 = box

        def hit(p, inside):
            px, py = (p[x], p[y]) if own else (p["_px"], p["_py"])
            bb = (py >= y0) & (py <= y1) if closed else (py > y0) & (py < y1)
            if not inside:
                bb = bb & ((px >= x0) & (px <= x1) if closed else (px > x0) & (px < x1))
            if geom is not None:
                bb = bb & (G.st_covers_xy(g, px, py) if closed else G.st_contains_xy(g, px, py))
            return bb

        def taken(s):
            # strictly between the sides, only the height decides
            return F.when((s["_x0"] > x0) & (s["_x1"] < x1), F.filter(s["_l"], lambda p: hit(p, True))).otherwise(
                F.filter(s["_l"], lambda p: hit(p, False)))
        reached = F.filter("_strips", lambda s: (s["_x1"] >= x0) & (s["_x0"] <= x1))
        return F.flatten(F.transform(reached, taken))

    def held_by(s):
        return held([s[f"b{i}"] for i in range(4)], s["g"] if geom else None)
    only = held([F.col(f"_b{i}") for i in range(4)], F.get("_shapes", F.lit(0))["g"] if geom else None)
    found = F.when(F.size("_shapes") == 1, only).otherwise(F.sort_array(F.flatten(F.transform("_shapes", held_by))))
    # behind a generator the list is made once, whatever reads it
    out = j.select(F.col("_key").alias(shape_key), F.col("_kx").alias("chunk_x"), F.col("_ky").alias("chunk_y"), F.explode(F.array(found)).alias("_found"))
    return out.filter(F.size("_found") > 0).select(
        shape_key, "chunk_x", "chunk_y", F.size("_found").cast("long").alias("n"), (F.col("_found") if own else F.col("_found")["_pt"]).alias("points"))


# --------------------------------------------------------------------------
# shape / shape join
# --------------------------------------------------------------------------

def shape_join(a: DataFrame, b: DataFrame, cell: float, predicate="intersects",
               a_bbox=("minx", "miny", "maxx", "maxy"), suffixes=("_a", "_b"),
               max_cells: int = 64, geom: str | None = None, block_rows: int | None = BLOCK_ROWS,
               only: Column | None = None) -> DataFrame:
    """Pairs of shapes from two tables, refined by ``predicate``.

    With ``geom`` (the name of a shape column in both tables) 'intersects'
    is exact: the shapes share a point. Without it the shapes are their
    boxes: 'intersects' (closed boxes meet) and 'touches' (they meet with
    zero area; a box test only). A callable() -> Column over the suffixed
    columns is applied to pairs whose boxes meet. ``only`` is a cheap
    condition over the suffixed columns, tested before the shapes are.

    Each shape gets the smallest level whose cells (cell * 2^level) cover
    its bbox in at most ``max_cells`` cells, and is replicated to its cells
    at that level and at every coarser level in use (fewer cells each). A
    pair meets at level max(level_a, level_b); it is kept only there, in the
    cell holding the minimum corner of the bbox intersection, so every pair
    comes out exactly once and no shape is replicated without bound."""
    sa, sb = suffixes
    minx, miny, maxx, maxy = a_bbox

    def prep(df, sfx):
        d = _suffixed(df, sfx)
        return d.withColumn("_lv", _level_of(minx + sfx, miny + sfx, maxx + sfx, maxy + sfx, cell, max_cells))
    A, B = prep(a, sa), prep(b, sb)
    levels = sorted({r[0] for r in A.select("_lv").distinct().union(B.select("_lv").distinct()).collect()})

    def explode(df, sfx):
        lv_arr = F.array(*[F.lit(lv) for lv in levels])
        d = df.withColumn("_own", F.col("_lv")).withColumn(
            "_lv", F.explode(F.filter(lv_arr, lambda lv: lv >= F.col("_own"))))
        size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_lv"))
        return d.withColumn("_c", F.explode(_cells_of_bbox(minx + sfx, miny + sfx, maxx + sfx, maxy + sfx, size))) \
            .select("*", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy")).drop("_c") \
            .withColumnRenamed("_own", f"_own{sfx}")
    j = salted_equi_join(explode(A, sa), explode(B, sb), ["_lv", "_cx", "_cy"], block_rows)
    ix0 = F.greatest(F.col(minx + sa), F.col(minx + sb))
    iy0 = F.greatest(F.col(miny + sa), F.col(miny + sb))
    ix1 = F.least(F.col(maxx + sa), F.col(maxx + sb))
    iy1 = F.least(F.col(maxy + sa), F.col(maxy + sb))
    meet = (ix0 <= ix1) & (iy0 <= iy1)
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_lv"))
    ref = (F.col("_lv") == F.greatest(F.col(f"_own{sa}"), F.col(f"_own{sb}"))) \
        & (F.floor(ix0 / size).cast("bigint") == F.col("_cx")) & (F.floor(iy0 / size).cast("bigint") == F.col("_cy"))
    # what is cheap comes first: a pair's shapes are looked at once, in one cell
    meet = meet & ref if only is None else meet & only & ref
    if predicate == "intersects":
        cond = meet if geom is None else meet & G.st_intersects(geom + sa, geom + sb)
    elif predicate == "touches":
        if geom is not None:
            raise ValueError("'touches' is a test of boxes")
        cond = meet & ((ix0 == ix1) | (iy0 == iy1))
    elif callable(predicate):
        cond = meet & predicate()
    else:
        raise ValueError(predicate)
    return j.filter(cond).drop("_lv", "_cx", "_cy", f"_own{sa}", f"_own{sb}")


# --------------------------------------------------------------------------
# range and nearest-neighbour queries
# --------------------------------------------------------------------------

def range_query(df: DataFrame, window: tuple[float, float, float, float], boundary: bool = True,
                x: str | None = "x", y: str | None = "y",
                bbox=("minx", "miny", "maxx", "maxy"), geom: str | None = None) -> DataFrame:
    """Objects in a rectangular window.

    Points (x, y given): inside the closed window (``boundary``) or its
    interior. Shapes (x=None, bbox columns): ``boundary=False`` keeps
    shapes fully covered by the window (bbox inside the window, exact for a
    rectangular window); ``boundary=True`` keeps shapes that intersect it
    (bbox overlap, then the exact test on ``geom`` if given). All the range
    predicates are plain comparisons and reach the Parquet scan."""
    wx0, wy0, wx1, wy1 = (float(v) for v in window)
    if x is not None:
        px, py = F.col(x), F.col(y)
        if boundary:
            return df.filter((px >= wx0) & (px <= wx1) & (py >= wy0) & (py <= wy1))
        return df.filter((px > wx0) & (px < wx1) & (py > wy0) & (py < wy1))
    minx, miny, maxx, maxy = (F.col(c) for c in bbox)
    if not boundary:
        return df.filter((minx >= wx0) & (maxx <= wx1) & (miny >= wy0) & (maxy <= wy1))
    out = df.filter((maxx >= wx0) & (minx <= wx1) & (maxy >= wy0) & (miny <= wy1))
    if geom is not None:
        win = G.st_rect(F.lit(wx0), F.lit(wy0), F.lit(wx1), F.lit(wy1))
        out = out.filter(G.st_intersects(geom, win))
    return out


def knn(df: DataFrame, k: int, distance: Column, order_key: str) -> DataFrame:
    """The k rows with the smallest distance, ties broken by ``order_key``.
    Plans as TakeOrderedAndProject: every task keeps its own top k."""
    return df.withColumn("dist", distance).orderBy(F.col("dist"), F.col(order_key)).limit(k)


def knn_point(df: DataFrame, k: int, px: float, py: float, order_key: str,
              x: str = "x", y: str = "y") -> DataFrame:
    return knn(df, k, G.dist_xy(x, y, F.lit(float(px)), F.lit(float(py))), order_key)


def distance_to_literal(shape: G.Shape | str, x: str = "x", y: str = "y") -> Column:
    """Distance from points to a driver-side polygon, unrolled per edge
    (0 for points covered by the polygon)."""
    if isinstance(shape, str):
        shape = G.parse_wkt_literal(shape)
    px, py = F.col(x), F.col(y)
    ds = [G._seg_point_dist(F.lit(x1), F.lit(y1), F.lit(x2), F.lit(y2), px, py)
          for x1, y1, x2, y2 in shape.edges]
    d = ds[0] if len(ds) == 1 else F.least(*ds)
    if shape.gtype in ("POLYGON", "MULTIPOLYGON"):
        return F.when(G.contains_literal(shape, x, y, boundary=True), F.lit(0.0)).otherwise(d)
    return d


def grid_cell_size(extent_row, rows_per_cell: int) -> float:
    """Cell size splitting an extent into squares holding about
    ``rows_per_cell`` rows on average (from the 'analyze' aggregate)."""
    w = max(extent_row["maxx"] - extent_row["minx"], 1e-9)
    h = max(extent_row["maxy"] - extent_row["miny"], 1e-9)
    target = max(math.ceil(extent_row["n"] / rows_per_cell), 1)
    return math.sqrt(w * h / target)


def grid_partition(df: DataFrame, rows_per_cell: int = 100_000, num_partitions: int | None = None,
                   x: str = "x", y: str = "y", max_cell_rows: int | None = None) -> tuple[DataFrame, float]:
    """Spatial co-partitioning: cell size from the data's extent and count,
    rows hash-partitioned by cell so that two data sets partitioned with the
    same cell size and partition count meet cell by cell. A cell with more
    than ``max_cell_rows`` rows (default 4 x rows_per_cell) is spread over
    several partitions by a salt. Returns (partitioned df with cx/cy, cell)."""
    from punktwerk.operators.aggs import extent
    e = extent(df, x, y).first()
    cell = grid_cell_size(e, rows_per_cell)
    g = with_grid(df, cell, x, y)
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    limit = max_cell_rows or 4 * rows_per_cell
    hot = hot_cells(g, ["cx", "cy"], limit)
    g = key_join(g.withColumn("_at", F.monotonically_increasing_id()), hot, ["cx", "cy"], "left").withColumn(
        "_salt", F.when(F.col("_nsalt").isNull(), F.lit(0)).otherwise(
            F.pmod(F.col("_at"), F.col("_nsalt")))).drop("_nsalt", "_at")
    return g.repartition(n, "cx", "cy", "_salt").drop("_salt"), cell
