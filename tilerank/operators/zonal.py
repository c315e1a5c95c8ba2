"""Sums over disks from partial sums per cell.

A disk is covered by squares of a quadtree: squares that lie inside as a whole, as large as possible, and small squares along the rim. The cover follows from the site's
place alone (no join); whole squares meet one row of summed pixels each, only rim squares meet pixels. So work per site goes with the disk's perimeter in pixels, not
with its area, and a pixel is not repeated for every disk that holds it.

Defined cases: sites or pixels without coordinates take no part; a band without any value in a disk has NULL mean and sum; sites whose disk holds no pixel centre are absent;
rows of one key are added up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Squares this close to the circle (metres) count as rim; exact distances decide there.
MARGIN = 1e-6
#: Pixels that a rim square should hold, and the deepest quadtree level.
RIM_PIXELS, MAX_LEVEL = 16, 12


def cover_level(pixels: DataFrame, radius: float, x: str = "rx", y: str = "ry") -> int:
    """Quadtree level whose squares (of side ``radius / 2^level``) hold about ``RIM_PIXELS`` pixels: one scan, one row."""
    cell = F.xxhash64(F.floor(F.col(x) / radius), F.floor(F.col(y) / radius))
    r = pixels.agg(F.count(x).alias("n"), F.approx_count_distinct(F.when(F.col(x).isNotNull(), cell)).alias("cells")).first()
    per = (r["n"] or 0) / max(r["cells"] or 0, 1) / RIM_PIXELS
    return min(math.ceil(math.log(per, 4)), MAX_LEVEL) if per > 1 else 0


def disk_cover(sites: DataFrame, radius: float, level: int, x: str = "x", y: str = "y") -> DataFrame:
    """The rows of ``sites``, one per square ``(_lv, _ci, _cj)`` of the site's disk; ``_whole`` tells squares inside it from rim squares (all of level ``level``)."""
    r = float(radius)
    near3 = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    c = sites.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_o", F.explode(near3)).withColumns({
        "_lv": F.lit(0), "_ci": (F.floor(F.col(y) / r) + F.col("_o.a")).cast("bigint"), "_cj": (F.floor(F.col(x) / r) + F.col("_o.b")).cast("bigint"),
        "_whole": F.lit(False)}).drop("_o")
    for lv in range(level + 1):
        side = r / (1 << lv)
        dx0, dx1 = F.col("_cj") * side - F.col(x), (F.col("_cj") + 1) * side - F.col(x)
        dy0, dy1 = F.col("_ci") * side - F.col(y), (F.col("_ci") + 1) * side - F.col(y)
        zero = F.lit(0.0)
        gx, gy = F.greatest(dx0, -dx1, zero), F.greatest(dy0, -dy1, zero)
        fx, fy = F.greatest(-dx0, dx1), F.greatest(-dy0, dy1)
        c = c.where(F.col("_whole") | (F.sqrt(gx * gx + gy * gy) <= r + MARGIN))
        c = c.withColumn("_whole", F.col("_whole") | (F.sqrt(fx * fx + fy * fy) <= r - MARGIN))
        if lv < level:
            square = lambda lv_, ci, cj: F.struct(lv_.alias("lv"), ci.alias("ci"), cj.alias("cj"))
            kids = [square(F.lit(lv + 1), F.col("_ci") * 2 + a, F.col("_cj") * 2 + b) for a in (0, 1) for b in (0, 1)]
            same = square(F.col("_lv"), F.col("_ci"), F.col("_cj"))
            c = c.withColumn("_k", F.explode(F.when(F.col("_whole"), F.array(same)).otherwise(F.array(*kids))))
            c = c.withColumns({"_lv": F.col("_k.lv"), "_ci": F.col("_k.ci"), "_cj": F.col("_k.cj")}).drop("_k")
    return c


def _spread(sites: DataFrame) -> DataFrame:
    """The sites, projected once and dealt out: each grows into many squares, so few input files must not mean few tasks."""
    return cut_lineage(sites.repartition(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _celled(pixels: DataFrame, radius: float, level: int) -> DataFrame:
    side = float(radius) / (1 << level)
    return pixels.where(F.col("rx").isNotNull() & F.col("ry").isNotNull()).withColumns({
        "_ci": F.floor(F.col("ry") / side).cast("bigint"), "_cj": F.floor(F.col("rx") / side).cast("bigint")})


def _every_level(level: int) -> list:
    """The squares that hold a square of the finest level, itself included."""
    ups = F.array(*[F.struct(F.lit(lv).alias("lv"), F.lit(level - lv).alias("up")) for lv in range(level + 1)])
    return [F.explode(ups).alias("_u")]


def _up(cells: DataFrame, level: int, keep: Sequence[str]) -> DataFrame:
    up = cells.select("_ci", "_cj", *keep, *_every_level(level))
    shift = lambda c: F.expr(f"shiftright({c}, _u.up)").alias(c)
    return up.select(F.col("_u.lv").alias("_lv"), shift("_ci"), shift("_cj"), *keep)


def _in_disk(radius: float):
    dx, dy = F.col("rx") - F.col("x"), F.col("ry") - F.col("y")
    return F.sqrt(dx * dx + dy * dy) <= float(radius)


def disk_sums(sites: DataFrame, pixels: DataFrame, bands: Sequence[str], radius: float, key: str, level: int | None = None) -> DataFrame:
    """``key`` and ``{band}_mean``, ``{band}_sum`` over the pixel centres within ``radius``.

    ``sites``: ``(key, x, y)``; ``pixels``: ``(rx, ry, bands...)``, both in the same planar metres.
    """
    sites, pixels = _spread(sites.select(key, "x", "y")), cut_lineage(pixels.select("rx", "ry", *bands))
    level = cover_level(pixels, radius) if level is None else level
    px = _celled(pixels, radius, level)
    parts = [f"_s{i}" for i in range(len(bands))] + [f"_n{i}" for i in range(len(bands))]
    sums = [F.sum(b).alias(f"_s{i}") for i, b in enumerate(bands)] + [F.count(b).alias(f"_n{i}") for i, b in enumerate(bands)]
    fine = px.groupBy("_ci", "_cj").agg(*sums)
    kinds = dict(fine.dtypes)
    cells = _up(fine, level, parts).groupBy("_lv", "_ci", "_cj").agg(*[F.sum(p).cast(kinds[p]).alias(p) for p in parts])
    cover = disk_cover(sites, radius, level)
    whole = cover.where("_whole").join(cells, ["_lv", "_ci", "_cj"]).select(key, *parts)
    rim = cover.where("NOT _whole").join(px, ["_ci", "_cj"]).where(_in_disk(radius))
    each = [F.col(b).cast(kinds[f"_s{i}"]).alias(f"_s{i}") for i, b in enumerate(bands)]
    ones = [F.when(F.col(b).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(f"_n{i}") for i, b in enumerate(bands)]
    total = whole.unionByName(rim.select(key, *each, *ones)).groupBy(key).agg(*[F.sum(p).cast(kinds[p]).alias(p) for p in parts])
    out = []
    for i, b in enumerate(bands):
        n = F.col(f"_n{i}")
        out += [F.when(n > 0, F.col(f"_s{i}").cast("double") / n).alias(f"{b}_mean"), F.col(f"_s{i}").alias(f"{b}_sum")]
    return total.select(key, *out)


def places_reached(places: DataFrame, pixels: DataFrame, radius: float, level: int | None = None) -> DataFrame:
    """The rows of ``places`` (``x, y`` and others, each row once) whose disk holds a pixel centre: occupied squares, exact tests on the rim only."""
    places, pixels = _spread(places), cut_lineage(pixels.select("rx", "ry"))
    level = cover_level(pixels, radius) if level is None else level
    px = _celled(pixels, radius, level)
    cells = _up(px.select("_ci", "_cj").distinct(), level, []).distinct()
    cover = disk_cover(places, radius, level)
    sure = cover.where("_whole").join(cells, ["_lv", "_ci", "_cj"], "left_semi")
    rim = cover.where("NOT _whole").join(px, ["_ci", "_cj"]).where(_in_disk(radius))
    return sure.select(*places.columns).union(rim.select(*places.columns)).distinct()
