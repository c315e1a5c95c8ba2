"""Spatial joins as grid-cell equi-joins: point in polygon, nearest feature, points within a radius.

No operator here plans a cross join or a nested-loop join; every pairing goes through an
equality on integer cell coordinates or block numbers, so Spark can hash-partition both sides
and AQE can split skewed cells.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import point_segment_distance
from ..session import cut_lineage, store
from .boxtree import nearest_of

# ---------------------------------------------------------------------------
# point in polygon (strict interior, even-odd rule)
# ---------------------------------------------------------------------------


def _explode_cells(df: DataFrame, keep: Sequence[str], xmin: str, ymin: str, xmax: str, ymax: str, g: float,
                   pad: float = 1e-9) -> DataFrame:
    """``keep`` columns repeated for every integer cell ``(ci, cj)`` (row from y, column from x)
    covered by the box; the box is padded slightly so geometry lying exactly on a cell border
    is indexed on both sides."""
    e = pad * g
    d = df.select(*keep, F.floor((F.col(xmin) - e) / g).alias("_j0"), F.floor((F.col(xmax) + e) / g).alias("_j1"),
                  F.explode(F.sequence(F.floor((F.col(ymin) - e) / g), F.floor((F.col(ymax) + e) / g))).alias("ci"))
    return d.select(*keep, "ci", F.explode(F.sequence(F.col("_j0"), F.col("_j1"))).alias("cj"))


def _split_pieces(edges: DataFrame, g: float, keep: Sequence[str]) -> DataFrame:
    """Cut every edge into pieces no longer than ``g`` along either axis (for indexing only);
    each piece keeps the original edge coordinates for the exact tests."""
    n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))) / g)).cast("int")
    d = edges.withColumn("_n", n).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    fx = lambda t: F.col("x1") + (F.col("x2") - F.col("x1")) * t
    fy = lambda t: F.col("y1") + (F.col("y2") - F.col("y1")) * t
    t0 = F.col("_k") / F.col("_n")
    t1 = (F.col("_k") + 1) / F.col("_n")
    return d.select(
        *keep, "x1", "y1", "x2", "y2",
        F.least(fx(t0), fx(t1)).alias("_pxmin"), F.greatest(fx(t0), fx(t1)).alias("_pxmax"),
        F.least(fy(t0), fy(t1)).alias("_pymin"), F.greatest(fy(t0), fy(t1)).alias("_pymax"),
    )


# a boundary cell with more edges of one feature than this is cut into 16 x 16 finer cells
MAX_CELL_EDGES = 64
FINER = 16
MAX_LEVELS = 4


def join_within_polygon(points: DataFrame, edges: DataFrame, feature: str | Sequence[str] = "country",
                        lon: str = "longitude", lat: str = "latitude", cell_deg: float = 0.1) -> DataFrame:
    """Inner join of points to the polygons that contain them strictly (boundary excluded).

    ``edges`` is a ring-edge table ``(feature..., lon1, lat1, lon2, lat2)`` holding every ring of
    every part of each polygon feature; holes and multipolygons follow from the even-odd rule.
    ``feature`` names the columns that tell one feature from another. A point inside two features
    appears twice, also when they share a name but not the other columns. Output: the point
    columns plus the feature columns. NULL coordinates lie in no polygon, NULLs in feature columns are values.

    Method (all coordinates planar lon/lat, cell side ``cell_deg``):
    * each cell (row i, column j) has a reference point R = (right border x, row middle y);
      its inside/outside status is the parity of the ring crossings of the horizontal ray from
      R, found with a running count over the crossings of the row (window per feature and row);
    * a point p in cell (i, j) walks p -> (px, y_mid) -> (right border, y_mid); only edges
      touching the cell can cross that path, so p's parity is the cell status XOR the crossings
      of the path with the cell's edges; cells without edges need no edge work at all;
    * a point exactly on an edge is removed;
    * points in cells that no edge touches take the cell status directly (no edge join and no
      aggregation), so only boundary cells pay for the walk;
    * points of a boundary cell with more than ``MAX_CELL_EDGES`` edges of the feature go on to cells
      of a 16th of the side, at most ``MAX_LEVELS`` grids deep, so a detailed coast does not cost
      points x edges. A finer grid is laid only where such points lie.
    """
    names = [feature] if isinstance(feature, str) else list(feature)
    e = edges.select(F.struct(*names).alias("_f"), F.col("lon1").alias("x1"), F.col("lat1").alias("y1"),
                     F.col("lon2").alias("x2"), F.col("lat2").alias("y2")).where(
        (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    g = float(cell_deg)
    # feature bounding boxes -> cells they cover (candidate feature per point cell)
    fbox = e.groupBy("_f").agg(
        F.min(F.least("x1", "x2")).alias("bx0"), F.max(F.greatest("x1", "x2")).alias("bx1"),
        F.min(F.least("y1", "y2")).alias("by0"), F.max(F.greatest("y1", "y2")).alias("by1"))
    fcells = _explode_cells(fbox, ["_f", "bx0", "bx1", "by0", "by1"], "bx0", "by0", "bx1", "by1", g, pad=0.0)
    pts = points.select(F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_pt"), F.col(lon).alias("_px"), F.col(lat).alias("_py"))
    pts = _with_cell(pts, g)
    cand = pts.join(fcells, ["ci", "cj"], "inner").where(
        (F.col("_px") > F.col("bx0")) & (F.col("_px") < F.col("bx1")) & (F.col("_py") > F.col("by0")) & (F.col("_py") < F.col("by1"))
    ).select("_pt", "_px", "_py", "_f", "ci", "cj")
    # cells that need a status: from the distinct point cells (small), so the large point table is
    # joined to the feature cells only once
    needed = pts.select("ci", "cj").distinct().join(fcells.select("_f", "ci", "cj"), ["ci", "cj"], "inner").select("_f", "ci", "cj")

    found, near = [], e
    for level in range(MAX_LEVELS):
        ecell = _edge_cells(near, g)
        if level:
            ecell = ecell.join(needed, ["_f", "ci", "cj"], "left_semi")
        weights = ecell.groupBy("_f", "ci", "cj").agg(F.count(F.lit(1)).alias("_m"))
        weights = cut_lineage(weights) if level < MAX_LEVELS - 1 else weights
        last = level == MAX_LEVELS - 1 or weights.where(F.col("_m") > MAX_CELL_EDGES).isEmpty()
        if not last:
            crowded = weights.where(F.col("_m") > MAX_CELL_EDGES).select("_f", "ci", "cj")
            heavy = cut_lineage(_with_cell(cand.join(crowded, ["_f", "ci", "cj"], "left_semi"), g / FINER))
            cand = cand.join(crowded, ["_f", "ci", "cj"], "left_anti")
        found.append(_inside(cand, e, ecell, weights, needed, g))
        if last or heavy.isEmpty():
            break
        # finer cells meet only edges of the crowded cells that they lie in
        near = cut_lineage(ecell.join(crowded, ["_f", "ci", "cj"], "left_semi").select("_f", "x1", "y1", "x2", "y2").distinct())
        g /= FINER
        cand = heavy
        needed = cand.select("_f", "ci", "cj").distinct()
        e = e.join(needed.select("_f").distinct(), "_f", "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("_pt.*", *[F.col(f"_f.{n}").alias(n) for n in names])


def _with_cell(pts: DataFrame, g: float) -> DataFrame:
    """Points with the row ``ci`` and column ``cj`` of their cell of side ``g``."""
    return pts.withColumns({"ci": F.floor(F.col("_py") / g), "cj": F.floor(F.col("_px") / g)})


def _edge_cells(e: DataFrame, g: float) -> DataFrame:
    """Every edge once for each cell it touches."""
    pieces = _split_pieces(e, g, ["_f"])
    return _explode_cells(pieces, ["_f", "x1", "y1", "x2", "y2"], "_pxmin", "_pymin", "_pxmax", "_pymax", g).distinct()


def _cell_status(e: DataFrame, needed: DataFrame, g: float) -> DataFrame:
    """``_f, ci, cj, _status``: parity of the ring crossings right of each needed cell's reference point."""
    rows_lo = F.floor(F.least("y1", "y2") / g - 0.5)
    rows_hi = F.ceil(F.greatest("y1", "y2") / g - 0.5)
    rc = e.withColumn("ci", F.explode(F.sequence(rows_lo, rows_hi))).withColumn("_ym", (F.col("ci") + 0.5) * g)
    rc = rc.where((F.col("y1") > F.col("_ym")) != (F.col("y2") > F.col("_ym"))).join(
        needed.select("_f", "ci").distinct(), ["_f", "ci"], "left_semi").select(
        "_f", "ci", (F.col("x1") + (F.col("_ym") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("_x"),
        F.lit(1).alias("_is_x"), F.lit(None).cast("bigint").alias("cj"))
    marks = needed.select("_f", "ci", ((F.col("cj") + 1) * g).alias("_x"), F.lit(0).alias("_is_x"), "cj")
    w = Window.partitionBy("_f", "ci").orderBy(F.col("_x").desc(), F.col("_is_x").asc()).rowsBetween(Window.unboundedPreceding, 0)
    return rc.unionByName(marks).withColumn("_cum", F.sum("_is_x").over(w)).where(F.col("_is_x") == 0).select(
        "_f", "ci", "cj", (F.col("_cum") % 2).alias("_status"))


def _inside(cand: DataFrame, e: DataFrame, ecell: DataFrame, edge_keys: DataFrame, needed: DataFrame, g: float) -> DataFrame:
    """``_pt, _f`` of the candidate points (of cells of side ``g``) that lie strictly inside their feature."""
    pts = cand.withColumns({"_pid": F.monotonically_increasing_id(), "_xr": (F.col("cj") + 1) * g, "_ym": (F.col("ci") + 0.5) * g})
    with_status = pts.join(_cell_status(e, needed, g), ["_f", "ci", "cj"], "inner").join(
        edge_keys.select("_f", "ci", "cj", F.lit(True).alias("_edged")), ["_f", "ci", "cj"], "left")
    # points in cells that no edge touches take the cell status as it is (no edge join, no
    # aggregation); only points in boundary cells go through the edge tests below
    interior = with_status.where(F.col("_edged").isNull() & (F.col("_status") == 1)).select("_pt", "_f")
    border = with_status.where(F.col("_edged"))
    touched = border.join(ecell, ["_f", "ci", "cj"], "inner")
    px, py, xr, ym = F.col("_px"), F.col("_py"), F.col("_xr"), F.col("_ym")
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    # vertical walk at x = px from py to ym
    v_cross = (x1 > px) != (x2 > px)
    v_y = F.when(v_cross, y1 + (px - x1) * (y2 - y1) / (x2 - x1))
    # the row middle counts as infinitesimally higher on both legs, so an edge through the corner of the walk meets exactly one
    v_hit = F.coalesce(v_cross & ((v_y > py) != (v_y > ym)), F.lit(False))
    # horizontal walk at y = ym from px to the right border
    h_cross = (y1 > ym) != (y2 > ym)
    h_x = F.when(h_cross, x1 + (ym - y1) * (x2 - x1) / (y2 - y1))
    right_of = (h_x > px) | ((h_x == px) & ((x2 > x1) == (y2 > y1)) & (x1 != x2))
    h_hit = F.coalesce(h_cross & right_of & (h_x <= xr), F.lit(False))
    # point on the edge
    on_edge = ((px - x1) * (y2 - y1) == (py - y1) * (x2 - x1)) & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2)) \
        & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2))
    agg = touched.groupBy("_pid", "_f").agg(
        F.first("_pt").alias("_pt"), F.first("_status").alias("_status"),
        (F.sum(F.when(v_hit, 1).otherwise(0)) + F.sum(F.when(h_hit, 1).otherwise(0))).alias("_walk"),
        F.max(F.when(on_edge, 1).otherwise(0)).alias("_on"),
    )
    inside = agg.where(((F.col("_status") + F.col("_walk")) % 2 == 1) & (F.col("_on") == 0))
    return inside.select("_pt", "_f").unionByName(interior)


def _block3(df: DataFrame, ci0: str, cj0: str, ci: str, cj: str) -> DataFrame:
    """Each row repeated for the 3 x 3 block of cells around ``(ci0, cj0)``."""
    offs = F.array(*[F.lit(v) for v in (-1, 0, 1)])
    d = df.withColumn("_di", F.explode(offs)).withColumn("_dj", F.explode(offs))
    return d.withColumns({ci: F.col(ci0) + F.col("_di"), cj: F.col(cj0) + F.col("_dj")}).drop("_di", "_dj", ci0, cj0)


# ---------------------------------------------------------------------------
# nearest feature (exact, two pyramids of boxes)
# ---------------------------------------------------------------------------


def nearest_feature(left: DataFrame, right: DataFrame, left_key: str, right_key: str, carry: Sequence[str] = (),
                    lx: str = "x", ly: str = "y", dist_col: str = "distance_m") -> DataFrame:
    """For each left point, the nearest right geometry (segments; points are zero-length segments).

    ``left``: ``(left_key, lx, ly)``; ``right``: ``(right_key, x1, y1, x2, y2, carry...)`` in the
    same planar metres. Output: ``left_key, dist_col, right_key, carry...`` with one row per left
    key; ties are broken by the smallest ``right_key``. An empty right side gives NULLs, and right rows without coordinates take no part.

    Equal geometries count once (the smallest key), so a place that holds a third of all rows is one row. Segments
    are cut to the mean spacing of the right side, which keeps boxes small, but into no more than some four pieces a segment
    and one a point in all; distances use the whole segment.
    Points and pieces are then walked as two pyramids of boxes (:func:`boxtree.nearest_of`): a point meets the
    few blocks of pieces whose boxes can hold its nearest geometry, wherever and however densely they lie.
    """
    carry = list(carry)
    base0 = store(left.select(F.col(left_key).alias("_lk"), F.col(lx).alias("_x"), F.col(ly).alias("_y")))
    base = base0.where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    placed = right.select(F.col(right_key).alias("_rk"), "x1", "y1", "x2", "y2", *carry)
    once = placed.groupBy("x1", "y1", "x2", "y2").agg(F.min_by(F.struct("_rk", *carry), "_rk").alias("_r"))
    segs = store(once.select(F.monotonically_increasing_id().alias("_sid"), "x1", "y1", "x2", "y2", *[F.col(f"_r.{c}").alias(c) for c in ["_rk", *carry]]))
    # a filter on projected coordinates before the store is pushed below the projection, which is then computed some twenty times a row
    segs = segs.where(F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull())
    ext = segs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))).alias("long"),
                   F.min(F.least("x1", "x2")).alias("x0"), F.max(F.greatest("x1", "x2")).alias("x1"),
                   F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("y1", "y2")).alias("y1")).first()
    if not ext["n"] or base.isEmpty():
        empty = base0.select(F.col("_lk").alias(left_key)).distinct().withColumn(dist_col, F.lit(None).cast("double"))
        empty = empty.withColumn(right_key, F.lit(None).cast(right.schema[right_key].dataType))
        for c in carry:
            empty = empty.withColumn(c, F.lit(None).cast(right.schema[c].dataType))
        return empty
    area = max((ext["x1"] - ext["x0"]) * (ext["y1"] - ext["y0"]), 1.0)
    # the cuts must not outgrow the input: at most some four pieces a segment on average, and one more a point
    least = ext["long"] / (4 * ext["n"] + base.count())
    pieces = _split_pieces(segs, max(math.sqrt(area / ext["n"]), least, 1.0), ["_rk", "_sid"])
    best = nearest_of(base, pieces)
    # points without coordinates have no nearest geometry but a row, unless their key has another point
    nowhere = base0.where(F.col("_x").isNull() | F.col("_y").isNull()).select("_lk", F.lit(None).cast(best.schema["_best"].dataType).alias("_best"))
    res = best.unionByName(nowhere).groupBy("_lk").agg(F.min("_best").alias("_best"))
    res = res.select("_lk", F.col("_best._d").alias(dist_col), F.col("_best._rk").alias(right_key), F.col("_best._sid").alias("_sid"))
    if carry:
        res = res.join(segs.select("_sid", *carry), "_sid", "left")
    return store(res.drop("_sid")).withColumnRenamed("_lk", left_key)


# ---------------------------------------------------------------------------
# points within a radius
# ---------------------------------------------------------------------------


def join_within_radius(left: DataFrame, right: DataFrame, radius: float, lx: str = "x", ly: str = "y",
                       rx: str = "rx", ry: str = "ry", dist_col: str = "distance_m", how: str = "inner") -> DataFrame:
    """Pairs of left and right points at planar distance ``<= radius`` (cells of side ``radius``,
    right points in one cell each, left points probing their 3 x 3 block). ``how='left_semi'``
    keeps the left rows that have at least one partner."""
    r = float(radius)
    rr = right.withColumns({"_ci": F.floor(F.col(ry) / r), "_cj": F.floor(F.col(rx) / r)})
    ll = left.withColumns({"_pi": F.floor(F.col(ly) / r), "_pj": F.floor(F.col(lx) / r)})
    probe = _block3(ll, "_pi", "_pj", "_ci", "_cj")
    dx = F.col(rx) - F.col(lx)
    dy = F.col(ry) - F.col(ly)
    d = F.sqrt(dx * dx + dy * dy)
    pairs = probe.join(rr, ["_ci", "_cj"], "inner").withColumn(dist_col, d).where(F.col(dist_col) <= r)
    if how == "left_semi":
        cols = left.columns
        return left.join(pairs.select(*[F.col(c).alias(f"_k_{c}") for c in cols]).distinct(),
                         [left[c].eqNullSafe(F.col(f"_k_{c}")) for c in cols], "left_semi")
    return pairs.drop("_ci", "_cj", "_pi", "_pj")
