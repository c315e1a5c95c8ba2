"""Tower sites: antenna clustering, dissolve to sites, infrastructure distances."""

from __future__ import annotations

import math
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.geo import mean_longitude_zone, with_lonlat, with_utm
from ..operators.boxtree import close_groups, grouped_points, weight_within
from ..operators.graph import connected_components
from ..session import cut_lineage, store
from ..operators.spatial import join_within_polygon, join_within_radius, nearest_feature
from ..sources.files import bbox_filter, layer_segments, select_layer


def one_hot_radio(df: DataFrame, radio: str = "radio") -> DataFrame:
    """``radio_LTE, radio_UMTS, radio_GSM, radio_NR`` as 0/1 (NULL radio -> all 0); other radios get no column."""
    return df.withColumns({f"radio_{r}": F.when(F.col(radio) == r, 1).otherwise(0) for r, _ in K.RADIO_COLUMNS})


def filter_mcc_bbox(antennas: DataFrame, bounds, mccs=K.MCC_CODES) -> DataFrame:
    return antennas.where(F.col("mcc").isin(*mccs) & bbox_filter("longitude", "latitude", bounds))


def node_key(lon: str = "longitude", lat: str = "latitude"):
    """Integer key of a position, ordered like (longitude, latitude) at 1e-7 degree resolution."""
    return (F.round((F.col(lon) + 180.0) * 1e7).cast("bigint") * F.lit(2_000_000_000)
            + F.round((F.col(lat) + 90.0) * 1e7).cast("bigint"))


def eps_self_join(points: DataFrame, eps: float = K.CLUSTER_EPS_M, key: str = "node") -> DataFrame:
    """All pairs of projected points ``(key, x, y)`` at distance ``<= eps`` (each pair both ways, self included)."""
    right = points.select(F.col(key).alias("dst"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    left = points.select(F.col(key).alias("src"), "x", "y")
    return join_within_radius(left, right, eps).select("src", "dst", "distance_m")


def _cells(nodes: DataFrame, eps: float) -> DataFrame:
    """``nodes`` with their cell ``ci, cj`` (side ``eps / sqrt(2)``, so all nodes of one cell are within ``eps``) and ``rep``, the cell's smallest node."""
    c = eps / math.sqrt(2.0)
    n = nodes.withColumns({"ci": F.floor(F.col("y") / c), "cj": F.floor(F.col("x") / c)})
    return cut_lineage(n.join(n.groupBy("ci", "cj").agg(F.min("node").alias("rep")), ["ci", "cj"]))


def _around(cells: DataFrame, half: bool) -> DataFrame:
    """Each row for every cell up to two cells away (``half``: one direction of each pair, own cell left out)."""
    offs = [(di, dj) for di in range(-2, 3) for dj in range(-2, 3) if (di, dj) > (0, 0) or not half and (di, dj) != (0, 0)]
    o = F.explode(F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b in offs]))
    d = cells.withColumn("_o", o)
    return d.withColumns({"ci": F.col("ci") + F.col("_o.di"), "cj": F.col("cj") + F.col("_o.dj")}).drop("_o")


def _cell_graph(n: DataFrame, eps: float) -> DataFrame:
    """Edges ``src, dst`` with the components of the ``<= eps`` graph: every node with its cell's representative, and one edge per pair of close cells.

    Whether two cells are close is settled on pyramids of their nodes (:func:`boxtree.close_groups`), so a cell of thousands of
    positions costs a few box tests per neighbour cell, not all pairs.
    """
    star = n.select(F.col("node").alias("src"), F.col("rep").alias("dst"))
    cells = n.select("ci", "cj", "rep").distinct()
    pairs = _around(cells.withColumnRenamed("rep", "ag"), half=True).join(cells.withColumnRenamed("rep", "bg"), ["ci", "cj"]).select("ag", "bg")
    points = grouped_points(n, "rep", "node")
    close = close_groups(points, points, pairs, eps)
    return star.unionByName(close.select(F.col("ag").alias("src"), F.col("bg").alias("dst")))


def cluster_antennas(df: DataFrame, eps: float = K.CLUSTER_EPS_M, min_samples: int = 1, zone=None) -> DataFrame:
    """DBSCAN in UTM metres; with ``min_samples=1`` clusters are the connected components of the
    ``<= eps`` graph over distinct positions. Adds ``cluster_id`` (smallest position key in the
    cluster), ``x, y`` (projected) and ``node``; with ``min_samples > 1`` non-core points that
    reach no core point get ``cluster_id = -1`` and border points join the smallest adjacent cluster.

    No pairs of positions are formed. A cell that weighs ``min_samples`` holds core points only; the others count what lies around them by
    whole nodes of pyramids, until they have enough. Core points of one cell are one cluster, so a border point asks per cell.

    The antennas are projected once; ``zone`` is that of their mean longitude where it is not given."""
    if zone is None:
        zone = mean_longitude_zone(df)
    pts = store(with_utm(df.withColumn("node", node_key()), zone))
    nodes = store(pts.select("node", "x", "y").dropDuplicates(["node"]))
    if min_samples <= 1:
        labels = connected_components(nodes.select("node"), _cell_graph(_cells(nodes, eps), eps))
        return pts.join(labels.withColumnRenamed("label", "cluster_id"), "node", "left")
    # the degree counts every antenna row within eps, itself included
    n = _cells(nodes.join(pts.groupBy("node").agg(F.count(F.lit(1)).alias("w")), "node"), eps)
    cells = cut_lineage(n.groupBy("ci", "cj", "rep").agg(F.sum("w").alias("have")))
    thin = n.join(cells.where(F.col("have") < min_samples), ["ci", "cj", "rep"])
    look = _around(thin.select("node", "ci", "cj"), half=False).join(cells.select("ci", "cj", F.col("rep").alias("bg")), ["ci", "cj"]).select("node", "bg")
    degree = weight_within(thin.select("node", F.col("x").alias("px"), F.col("y").alias("py"), "have"), grouped_points(n, "rep", "node"), look, eps, min_samples)
    full = n.join(cells.where(F.col("have") >= min_samples), ["ci", "cj", "rep"], "left_semi").select("node")
    core = cut_lineage(full.unionByName(degree.where(F.col("weight") >= min_samples).select("node")))
    cored = _cells(n.join(core, "node", "left_semi").select("node", "x", "y"), eps)
    labels = cut_lineage(connected_components(core, _cell_graph(cored, eps)))
    rest = n.join(core, "node", "left_anti").select("node", "x", "y", "ci", "cj")
    of_cell = cored.select("ci", "cj", "rep").distinct()
    own = rest.join(of_cell, ["ci", "cj"]).select("node", "rep")
    ask = _around(rest.select(F.col("node").alias("ag"), "ci", "cj"), half=False).join(of_cell.withColumnRenamed("rep", "bg"), ["ci", "cj"]).select("ag", "bg")
    border = close_groups(grouped_points(rest, "node", "node"), grouped_points(cored, "rep", "node"), ask, eps).select(F.col("ag").alias("node"), F.col("bg").alias("rep"))
    named = own.unionByName(border).join(labels.withColumnRenamed("node", "rep"), "rep").groupBy("node").agg(F.min("label").alias("label"))
    out = pts.join(labels.unionByName(named).withColumnRenamed("label", "cluster_id"), "node", "left")
    return out.withColumn("cluster_id", F.coalesce(F.col("cluster_id"), F.lit(-1).cast("bigint")))


def dissolve_sites(clustered: DataFrame, zone=None) -> DataFrame:
    """One site per cluster: antenna count (non-NULL radio), mean range, one-hot sums, and the
    centroid of the cluster's distinct projected positions, returned in WGS84."""
    if zone is None:
        zone = mean_longitude_zone(clustered)
    # one pass: sums per distinct position of a cluster, then sums and the mean position per cluster
    places = one_hot_radio(clustered).groupBy("cluster_id", "x", "y").agg(
        F.count("radio").alias("_n"), F.sum("range").alias("_range"), F.count("range").alias("_ranges"),
        *[F.sum(f"radio_{r}").alias(col) for r, col in K.RADIO_COLUMNS],
    )
    sites = places.groupBy("cluster_id").agg(
        F.sum("_n").cast("bigint").alias("antenna_count"), F.try_divide(F.sum("_range"), F.sum("_ranges")).alias("range"),
        *[F.sum(col).cast("bigint").alias(col) for _, col in K.RADIO_COLUMNS], F.avg("x").alias("x"), F.avg("y").alias("y"),
    )
    return store(with_lonlat(sites, zone).drop("x", "y"))


def layer_tables_from_fixtures(spark: SparkSession, sf_dir: str, layers) -> dict[str, DataFrame]:
    """Segment tables of the fixture layers, through the same selection and WKB decoding as a scan."""
    from ..sources.fixtures import layer_frame

    out = {}
    for lay in layers:
        sel = select_layer(layer_frame(spark, sf_dir, lay), K.REGION_BOUNDS["Malaysia"], lay)
        out[lay] = layer_segments(sel)
    return out


def nearest_all_layers(sites: DataFrame, layers: Mapping[str, DataFrame], key: str = "cluster_id") -> DataFrame:
    """``distance_to_{power,road,amenity,tier1_hub}_m`` in UTM metres (zone of the sites' mean
    longitude) from each site to the nearest geometry of each layer; an empty layer gives NULL."""
    zone = mean_longitude_zone(sites)
    sp = store(with_utm(sites, zone).select(key, "x", "y"))

    def one(item):
        lay, segs = item
        name = f"distance_to_{K.LAYERS[lay][0]}_m"
        if "kind" in segs.columns:
            segs = store(segs)  # decoded once; the polygons are looked for below
        s = with_utm(with_utm(segs, zone, "lon1", "lat1", "x1", "y1"), zone, "lon2", "lat2", "x2", "y2")
        near = nearest_feature(sp, s.select(F.col("feature_id"), "x1", "y1", "x2", "y2"), key, "feature_id", dist_col=name)
        if "kind" in segs.columns:
            # a site inside a polygon feature is at distance 0 from it (the edges only give the
            # distance to its boundary)
            rings = segs.where(F.col("kind") == "ring").select("feature_id", "lon1", "lat1", "lon2", "lat2")
            if not rings.isEmpty():
                inside = join_within_polygon(sites.select(key, "longitude", "latitude"), rings, feature="feature_id")
                near = near.join(inside.select(key).distinct().withColumn("_in", F.lit(True)), key, "left").withColumn(
                    name, F.when(F.col("_in"), F.lit(0.0)).otherwise(F.col(name))).drop("_in")
        return name, near

    # the layers are independent searches: submit them concurrently
    with ThreadPoolExecutor(max_workers=max(1, len(layers))) as ex:
        results = list(ex.map(one, layers.items()))
    out = sites
    for name, near in results:
        out = out.join(near.select(key, name), key, "left")
    return out


def build_tower_sites(antennas: DataFrame, layers: Mapping[str, DataFrame], bounds, eps: float = K.CLUSTER_EPS_M) -> DataFrame:
    """Bound the antennas, cluster them, dissolve clusters to sites and attach infrastructure distances."""
    bounded = filter_mcc_bbox(antennas, bounds)
    zone = mean_longitude_zone(bounded)
    clustered = cluster_antennas(bounded.select("radio", "longitude", "latitude", "range"), eps, zone=zone)
    sites = dissolve_sites(clustered, zone)
    return nearest_all_layers(sites, layers)
