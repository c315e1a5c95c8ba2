"""Searches over pyramids of boxes: nearest geometry, close groups, weight within a radius.

A side's rows are put in Z-order (a distributed sort) and every 2^``LEAF_BITS`` rows in a row are a block with its box; 2^``FAN_BITS`` blocks make a node of the level
above, and so on. Rows per block do not depend on how densely they lie, so a city and an empty coast cost the same per row, and there is no cell size to
choose. Two such pyramids are walked from their tops at once, as joins of (left node, right node) pairs: what the boxes rule out leaves the walk, what stays is replaced by pairs of
children. Every step is an equi-join on node numbers and a reduction per left node; no step forms all pairs of anything but the two tops (at most ``TOP`` nodes each).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import point_segment_distance
from ..session import cut_lineage, ship_package
from .rank import global_row_number

#: Rows per block, as a power of two; children per node, as a power of two; nodes at the top of a walk.
LEAF_BITS, FAN_BITS, TOP = 3, 3, 256
#: Bits per axis of the Z-order.
Z_BITS = 26
#: Bounds that are this close (metres) are not told apart; exact distances decide.
MARGIN = 1e-6
_BOX = ("x0", "x1", "y0", "y1")


def z_order(df: DataFrame, x: Column, y: Column, corner: tuple[float, float], side: float, out: str = "_z") -> DataFrame:
    """Add the Z-order number of ``(x, y)`` in the square of ``side`` at ``corner``."""
    top = (1 << Z_BITS) - 1

    def grid(c: Column, low: float) -> Column:
        return F.least(F.greatest(F.floor((c - low) / side * top), F.lit(0)), F.lit(top)).cast("bigint")

    df = df.withColumns({"_zx": grid(x, corner[0]), "_zy": grid(y, corner[1])})
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        df = df.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask)) for c in ("_zx", "_zy")})
    return df.withColumn(out, F.col("_zx").bitwiseOR(F.shiftleft("_zy", 1))).drop("_zx", "_zy")


def _extent(df: DataFrame, box: dict[str, Column]) -> tuple[int, tuple[float, float], float]:
    """(rows, lower corner, side of the square that holds all boxes)."""
    e = df.agg(F.count(F.lit(1)).alias("n"), *[(F.min if c.endswith("0") else F.max)(box[c]).alias(c) for c in _BOX]).first()
    if not e["n"]:
        return 0, (0.0, 0.0), 1.0
    return e["n"], (e["x0"], e["y0"]), max(e["x1"] - e["x0"], e["y1"] - e["y0"], 1e-9)


def _packed(df: DataFrame, box: dict[str, Column], key: str) -> tuple[DataFrame, DataFrame, int]:
    """(rows with ``_rn`` and block ``_b``, blocks ``(_b, box)``, number of blocks); rows of one place are ordered by ``key``."""
    n, corner, side = _extent(df, box)
    placed = z_order(df, (box["x0"] + box["x1"]) / 2, (box["y0"] + box["y1"]) / 2, corner, side)
    rows = global_row_number(placed, [F.col("_z"), F.col(key)], "_rn").withColumn("_b", F.shiftright(F.col("_rn") - 1, LEAF_BITS)).drop("_z")
    blocks = cut_lineage(rows.groupBy("_b").agg(*[(F.min if c.endswith("0") else F.max)(box[c]).alias(c) for c in _BOX]))
    return rows, blocks, -(-n // (1 << LEAF_BITS))


def _level(blocks: DataFrame, level: int, name: str) -> DataFrame:
    """Nodes of a level: ``name``, its parent ``name_up`` and the box as ``name_x0 ...``."""
    if level:
        blocks = blocks.groupBy(F.shiftright("_b", FAN_BITS * level).alias("_b")).agg(*[(F.min if c.endswith("0") else F.max)(c).alias(c) for c in _BOX])
    return blocks.select(F.col("_b").alias(name), F.shiftright("_b", FAN_BITS).alias(f"{name}_up"), *[F.col(c).alias(f"{name}_{c}") for c in _BOX])


def _gap(a0, a1, b0, b1) -> Column:
    return F.greatest(F.lit(0.0), b0 - a1, a0 - b1)


def least_distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Distance of two boxes (x0, x1, y0, y1)."""
    dx, dy = _gap(a[0], a[1], b[0], b[1]), _gap(a[2], a[3], b[2], b[3])
    return F.sqrt(dx * dx + dy * dy)


def most_distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Largest distance of two points of the boxes."""
    dx, dy = F.greatest(a[1] - b[0], b[1] - a[0]), F.greatest(a[3] - b[2], b[3] - a[2])
    return F.sqrt(dx * dx + dy * dy)


def sure_distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """A distance within which every point of box ``a`` has some geometry of box ``b``: something touches each side of a tight box.

    Per axis, the farthest that a point of ``a`` is from ``b``'s nearer side, together with the farthest end of that side; the smaller of both axes.
    """

    def nearer(a0, a1, b0, b1):
        at_end = lambda v: F.least(F.abs(v - b0), F.abs(v - b1))
        mid = (b0 + b1) / 2
        return F.greatest(at_end(a0), at_end(a1), F.when((a0 < mid) & (mid < a1), (b1 - b0) / 2).otherwise(F.lit(0.0)))

    far_x, far_y = F.greatest(a[1] - b[0], b[1] - a[0]), F.greatest(a[3] - b[2], b[3] - a[2])
    near_x, near_y = nearer(a[0], a[1], b[0], b[1]), nearer(a[2], a[3], b[2], b[3])
    return F.sqrt(F.least(near_x * near_x + far_y * far_y, near_y * near_y + far_x * far_x))


def _cols(name: str) -> list[Column]:
    return [F.col(f"{name}_{c}") for c in _BOX]


def _prune(pairs: DataFrame, sure: Column, by: Sequence[str]) -> DataFrame:
    """Pairs whose right box can hold the nearest geometry of something on their left; ``by`` names the left node. Adds the node's bound ``_sure``."""
    d = pairs.withColumns({"_low": least_distance(_cols("l"), _cols("r")), "_sure": sure})
    d = d.withColumn("_sure", F.min("_sure").over(Window.partitionBy(*by)) * (1 + 1e-9) + MARGIN)
    return d.where(F.col("_low") <= F.col("_sure")).drop("_low")


def _farthest_corner(box: Sequence[Column], seg: Sequence[str]) -> Column:
    """A distance within which every point of the box has the segment: the distance is convex, so a corner is farthest."""
    return F.greatest(*[point_segment_distance(x, y, *seg) for x in box[:2] for y in box[2:]])


#: Left nodes of this level are settled point by point against lists of their pieces, of about that many each.
LIST_LEVEL, LIST_PIECES = 1, 256
_SEGMENT = ("x1", "y1", "x2", "y2")


def _walk(points: DataFrame, pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points ``l, _pid, _lk, _x, _y``, pieces ``l, _p, _n``): ``_p`` are the ``_n`` pieces that can be nearest to a point of left node ``l``.

    ``points``: ``(_lk, _x, _y)``; ``pieces``: ``(_rk, x1, y1, x2, y2, _pxmin, _pxmax, _pymin, _pymax)`` and maybe ``_sid``, both without NULL coordinates and not empty.
    The nearest piece of each point is among its node's, and so is every other one at the same distance.

    The two pyramids are walked with levels of about the same number of nodes: the side with fewer rows has fewer rows in a node, down to single points on the left.
    A pair row carries its left box and that node's bound, so the children of a right node are sorted out before they are shuffled. Left nodes of
    up to 64 points keep the pieces that can be nearest as lists beside the node; each point takes the least of them (Arrow batches).
    """
    at = {"x0": F.col("_x"), "x1": F.col("_x"), "y0": F.col("_y"), "y1": F.col("_y")}
    box = {"x0": F.col("_pxmin"), "x1": F.col("_pxmax"), "y0": F.col("_pymin"), "y1": F.col("_pymax")}
    left, lblocks, nl = _packed(points, at, "_lk")
    right, rblocks, nr = _packed(pieces, box, "_rk")
    # level -1 on the left: the points themselves
    single = left.select((F.col("_rn") - 1).alias("l"), F.col("_b").alias("l_up"), *[at[c].alias(f"l_{c}") for c in _BOX])
    ahead = round(math.log2(nl / nr) / FAN_BITS)

    def of_left(level: int) -> DataFrame:
        return _level(lblocks, level, "l") if level >= 0 else single

    def lower_left(pairs: DataFrame, level: int, sure) -> DataFrame:
        kept = pairs.withColumnRenamed("l", "l_up").drop("_sure", *[f"l_{c}" for c in _BOX])
        return _prune(kept.join(of_left(level), "l_up"), sure, ["l_up", "l"]).drop("l_up")

    level = 0
    while max(nr - 1 >> (FAN_BITS * level), nl - 1 >> (FAN_BITS * max(level + ahead, 0))) >= TOP:
        level += 1
    here = max(level + ahead, 0)
    top = ((nr - 1) >> (FAN_BITS * level)) + 1
    by_box = lambda: sure_distance(_cols("l"), _cols("r"))
    pairs = of_left(here).drop("l_up").withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(top - 1).cast("bigint"))))
    pairs = _prune(pairs.join(_level(rblocks, level, "r").drop("r_up"), "r"), by_box(), ["l"])
    near = least_distance(_cols("l"), _cols("r")) <= F.col("_sure")
    while level:
        level -= 1
        up = pairs.withColumnRenamed("r", "r_up").select("r_up", "l", *[f"l_{c}" for c in _BOX], "_sure")
        pairs = up.join(_level(rblocks, level, "r"), "r_up").where(near).drop("r_up")
        if max(level + ahead, -1) < here:
            here -= 1
            pairs = lower_left(pairs, here, by_box())
        else:
            pairs = _prune(pairs, by_box(), ["l"])
    seg, keys = list(_SEGMENT), [c for c in ("_rk", "_sid") if c in pieces.columns]
    rows = right.select(F.col("_b").alias("r"), *keys, *seg, *[box[c].alias(f"r_{c}") for c in _BOX])
    pairs = pairs.select("r", "l", *[f"l_{c}" for c in _BOX], "_sure").join(rows, "r").where(near).drop("r")
    pairs = _prune(pairs, _farthest_corner(_cols("l"), seg), ["l"])
    while here > LIST_LEVEL:
        here -= 1
        pairs = lower_left(pairs, here, _farthest_corner(_cols("l"), seg))
    asks = left.select(F.shiftright(F.col("_rn") - 1, LEAF_BITS + FAN_BITS * here if here >= 0 else 0).alias("l"), F.col("_rn").alias("_pid"), "_lk", "_x", "_y")
    found = pairs.select("l", F.struct(*keys, *seg).alias("_p"))
    return asks, found.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("l")))


def nearest_pairs(points: DataFrame, pieces: DataFrame) -> DataFrame:
    """For every point all pieces of its node's list, with the distance ``_d``: what :func:`nearest_of` looks at."""
    asks, found = _walk(points, pieces)
    rows = asks.join(found, "l").select("_lk", "_x", "_y", "_p.*")
    return rows.withColumn("_d", point_segment_distance("_x", "_y", *_SEGMENT)).drop("_x", "_y", *_SEGMENT)


def _least(xs: pd.Series, ys: pd.Series, x1s: pd.Series, y1s: pd.Series, x2s: pd.Series, y2s: pd.Series) -> pd.Series:
    """Per row: for each point of a node the distance to its nearest segment of the list (first on ties), then the places of those in the list."""
    out = []
    for px, py, x1, y1, x2, y2 in zip(xs, ys, x1s, y1s, x2s, y2s):
        px, py, dx, dy = px[:, None], py[:, None], x2 - x1, y2 - y1
        len2 = dx * dx + dy * dy
        t = np.clip(((px - x1) * dx + (py - y1) * dy) / np.where(len2 > 0, len2, 1.0), 0.0, 1.0) * (len2 > 0)
        qx, qy = px - (x1 + t * dx), py - (y1 + t * dy)
        d = np.sqrt(qx * qx + qy * qy)
        i = d.argmin(axis=1)
        out.append(np.concatenate([d[np.arange(len(i)), i], i]))
    return pd.Series(out)


def nearest_of(points: DataFrame, pieces: DataFrame) -> DataFrame:
    """``_lk, _best``: the struct ``(_d, _rk, _sid)`` of the nearest piece of every row of ``points`` (ties: smallest ``_rk``, then ``_sid``).

    A point whose node has more than ``LIST_PIECES`` pieces comes once for each part of the list, with the nearest of that part.
    """
    ship_package(points.sparkSession)
    asks, found = _walk(points, pieces)
    keys = [c for c in ("_rk", "_sid") if c in pieces.columns]
    part = F.pmod(F.xxhash64("_p"), F.ceil(F.col("_n") / LIST_PIECES))
    lists = found.groupBy("l", part.alias("_part")).agg(F.array_sort(F.collect_list("_p")).alias("_ps"))
    nodes = asks.groupBy("l").agg(F.collect_list(F.struct("_lk", "_x", "_y")).alias("_qs")).join(lists, "l")
    least = F.pandas_udf(_least, "array<double>")
    nodes = nodes.select("_qs", "_ps", least("_qs._x", "_qs._y", *[f"_ps.{c}" for c in _SEGMENT]).alias("_at"))

    def answer(q: Column, i: Column) -> Column:
        piece = F.get("_ps", F.get("_at", i + F.size("_qs")).cast("int"))
        return F.struct(q["_lk"].alias("_lk"), F.struct(F.get("_at", i).alias("_d"), *[piece[c].alias(c) for c in keys]).alias("_best"))

    return nodes.select(F.explode(F.transform("_qs", answer)).alias("_r")).select("_r.*")


# ---------------------------------------------------------------------------
# groups of points (cells): which are close, how much lies within a radius
# ---------------------------------------------------------------------------


def grouped_points(points: DataFrame, group: str, key: str) -> tuple[DataFrame, int]:
    """(``g, k, x, y`` and ``w`` if there is one, levels): the points of each group numbered in Z-order from 0, materialised.

    A group's pyramid is made of the numbers: node ``k >> FAN_BITS * level`` of a level.
    """
    _, corner, side = _extent(points, {"x0": F.col("x"), "x1": F.col("x"), "y0": F.col("y"), "y1": F.col("y")})
    keep = ["x", "y", *(["w"] if "w" in points.columns else [])]
    placed = z_order(points.select(F.col(group).alias("g"), F.col(key).alias("_key"), *keep), F.col("x"), F.col("y"), corner, side)
    rows = global_row_number(placed, [F.col("g"), F.col("_z"), F.col("_key")], "_rn")
    first = rows.groupBy("g").agg(F.min("_rn").alias("_first"))
    rows = cut_lineage(rows.join(first, "g").select("g", (F.col("_rn") - F.col("_first")).alias("k"), *keep))
    last = rows.agg(F.max("k").alias("m")).first()["m"] or 0
    return rows, -(-last.bit_length() // FAN_BITS)


def _nodes(points: DataFrame, level: int, side: str) -> DataFrame:
    """Nodes of a level as ``{side}g, {side}k``, box, one of the points and the weight."""
    k = F.shiftright("k", FAN_BITS * level)
    first = F.min(F.struct("k", "x", "y"))
    w = [F.sum("w").alias(f"{side}w")] if "w" in points.columns else []
    out = points.groupBy(F.col("g").alias(f"{side}g"), k.alias(f"{side}k")).agg(
        F.min("x").alias(f"{side}_x0"), F.max("x").alias(f"{side}_x1"), F.min("y").alias(f"{side}_y0"), F.max("y").alias(f"{side}_y1"), first.alias("_one"), *w)
    return out.withColumns({f"{side}x": F.col("_one.x"), f"{side}y": F.col("_one.y")}).drop("_one")


def _children(k: str) -> Column:
    return F.explode(F.sequence(F.shiftleft(k, FAN_BITS), F.shiftleft(k, FAN_BITS) + ((1 << FAN_BITS) - 1)))


def _dist(ax, ay, bx, by) -> Column:
    dx, dy = F.col(bx) - F.col(ax), F.col(by) - F.col(ay)
    return F.sqrt(dx * dx + dy * dy)


def close_groups(a: tuple[DataFrame, int], b: tuple[DataFrame, int], candidates: DataFrame, eps: float) -> DataFrame:
    """The ``candidates`` (``ag, bg``) that have a point of either group within ``eps`` of each other, once each.

    Per level a pair of groups is settled as soon as two actual points, one of a node on either side, are within ``eps``; node pairs whose boxes are farther apart leave; the rest
    goes on with its children, down to single points.
    """
    level = max(a[1], b[1])
    state = candidates.withColumns({"ak": F.lit(0).cast("bigint"), "bk": F.lit(0).cast("bigint")})
    found = None
    while True:
        tested = state.join(_nodes(a[0], level, "a"), ["ag", "ak"]).join(_nodes(b[0], level, "b"), ["bg", "bk"])
        tested = tested.withColumn("near", _dist("ax", "ay", "bx", "by") <= eps)
        tested = tested.where(F.col("near") | (least_distance(_cols("a"), _cols("b")) <= eps + MARGIN))
        tested = cut_lineage(tested.select("ag", "ak", "bg", "bk", "near"))
        hits = tested.where("near").select("ag", "bg").distinct()
        found = hits if found is None else found.unionByName(hits)
        if level == 0:
            return found
        level -= 1
        rest = tested.where("NOT near").join(hits, ["ag", "bg"], "left_anti")
        state = rest.select("ag", "bg", _children("ak").alias("ak"), "bk").select("ag", "bg", "ak", _children("bk").alias("bk"))


def weight_within(points: DataFrame, groups: tuple[DataFrame, int], candidates: DataFrame, eps: float, enough: int) -> DataFrame:
    """``(node, weight)``: the weight within ``eps`` of each point, exact where it is below ``enough`` and at least ``enough`` elsewhere.

    ``points``: ``(node, px, py, have)``, ``have`` is what is known to be there; ``candidates``: ``(node, bg)``, the groups to look at. Nodes whose box lies within
    ``eps`` count whole, the rim goes on with its children, and points that have enough leave.
    """
    here = cut_lineage(points)
    level = groups[1]
    state = candidates.withColumn("bk", F.lit(0).cast("bigint"))
    while True:
        p = [F.col("px"), F.col("px"), F.col("py"), F.col("py")]
        near = state.join(here.where(F.col("have") < enough), "node").join(_nodes(groups[0], level, "b"), ["bg", "bk"])
        whole = _dist("px", "py", "bx", "by") <= eps if level == 0 else most_distance(p, _cols("b")) <= eps - MARGIN
        near = near.withColumn("whole", whole)
        if level:
            near = near.where(F.col("whole") | (least_distance(p, _cols("b")) <= eps + MARGIN))
        near = cut_lineage(near.select("node", "bg", "bk", "bw", "whole"))
        more = near.where("whole").groupBy("node").agg(F.sum("bw").alias("more"))
        here = cut_lineage(here.join(more, "node", "left").withColumn("have", F.col("have") + F.coalesce("more", F.lit(0))).drop("more"))
        if level == 0:
            return here.select("node", F.col("have").alias("weight"))
        level -= 1
        state = near.where("NOT whole").select("node", "bg", _children("bk").alias("bk"))
