"""Antenna clustering and tower sites.
The oracle finds components with a recursive CTE over all node pairs within 500 m."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..plans import towers as TW
from ..sources.fixtures import fixture
from . import chain as C
from . import register
from .joins import _LAYER_SPECS
from .sqltext import seg_dist_sql, unutm_sql, utm_sql

MY = K.REGION_BOUNDS["Malaysia"]
_ZA = "(SELECT zone FROM za)"
_AX, _AY = utm_sql("longitude", "latitude", _ZA)
_ROUNDS = 24
_KEY = "CAST(round((longitude + 180) * 1e7) AS BIGINT) * 2000000000 + CAST(round((latitude + 90) * 1e7) AS BIGINT)"


def _cluster_ctes() -> list[tuple[str, str]]:
    return [
        ("ab", f"""SELECT * FROM fx_antennas WHERE mcc IN {tuple(K.MCC_CODES)}
            AND longitude >= {MY[0]} AND longitude <= {MY[2]} AND latitude >= {MY[1]} AND latitude <= {MY[3]}"""),
        ("za", "SELECT CAST(floor((avg(longitude) + 180) / 6) + 1 AS INTEGER) AS zone FROM ab"),
        ("ap", f"SELECT *, {_KEY} AS node, {_AX} AS x, {_AY} AS y FROM ab"),
        ("nd", "SELECT DISTINCT node, x, y, CAST(floor(x / 500.0) AS BIGINT) AS ci, CAST(floor(y / 500.0) AS BIGINT) AS cj FROM ap"),
        ("pairs", f"""SELECT a.node AS src, b.node AS dst, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS d
            FROM nd a CROSS JOIN (VALUES (-1), (0), (1)) di(o) CROSS JOIN (VALUES (-1), (0), (1)) dj(o)
            JOIN nd b ON b.ci = a.ci + di.o AND b.cj = a.cj + dj.o
            WHERE sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) <= {C.d(K.CLUSTER_EPS_M)}"""),
        ("lab0", "SELECT node, node AS label FROM nd"),
    ] + [
        # min-label propagation, unrolled: exact once the round count exceeds the component
        # diameter (7 rounds suffice for the fixture; 24 are run)
        (f"lab{k}", f"SELECT p.src AS node, min(l.label) AS label FROM pairs p JOIN lab{k - 1} l ON l.node = p.dst GROUP BY p.src")
        for k in range(1, _ROUNDS + 1)
    ] + [
        ("cc", f"SELECT node, label AS cluster_id FROM lab{_ROUNDS}"),
        ("clu", "SELECT ap.*, cc.cluster_id FROM ap JOIN cc USING (node)"),
    ]


_LON, _LAT = unutm_sql("cx", "cy", _ZA)


def _dissolve_ctes() -> list[tuple[str, str]]:
    return _cluster_ctes() + [
        ("st", """SELECT cluster_id, CAST(count(radio) AS BIGINT) AS antenna_count, avg(range_m) AS range,
            CAST(sum(CASE WHEN radio = 'LTE' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_4G,
            CAST(sum(CASE WHEN radio = 'UMTS' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_3G,
            CAST(sum(CASE WHEN radio = 'GSM' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_2G,
            CAST(sum(CASE WHEN radio = 'NR' THEN 1 ELSE 0 END) AS BIGINT) AS antennas_5G FROM clu GROUP BY cluster_id"""),
        ("ce", "SELECT cluster_id, avg(x) AS cx, avg(y) AS cy FROM (SELECT DISTINCT cluster_id, x, y FROM clu) u GROUP BY cluster_id"),
        ("sites", f"SELECT st.*, {_LON} AS longitude, {_LAT} AS latitude FROM st JOIN ce USING (cluster_id)"),
    ]


def _antennas(spark, sf_dir):
    return TW.filter_mcc_bbox(fixture(spark, sf_dir, "fx_antennas").withColumnRenamed("range_m", "range"), MY)


@register("eps_self_join", C.render(["fx_antennas"], _cluster_ctes(), "SELECT src, dst, round(d, 3) AS distance_m FROM pairs"))
def eps_self_join(spark, sf_dir):
    from ..functions.geo import mean_longitude_zone, with_utm

    a = _antennas(spark, sf_dir)
    nodes = with_utm(a.withColumn("node", TW.node_key()), mean_longitude_zone(a)).select("node", "x", "y").dropDuplicates(["node"])
    return TW.eps_self_join(nodes).withColumn("distance_m", F.round("distance_m", 3))


@register("cluster_antennas", C.render(["fx_antennas"], _cluster_ctes(), "SELECT DISTINCT node, cluster_id FROM clu"))
def cluster_antennas(spark, sf_dir):
    return TW.cluster_antennas(_antennas(spark, sf_dir)).select("node", "cluster_id").distinct()


@register("one_hot_radio", C.render(["fx_antennas"], [], """SELECT radio, lon_e6, lat_e6,
    CASE WHEN radio = 'LTE' THEN 1 ELSE 0 END AS radio_LTE, CASE WHEN radio = 'UMTS' THEN 1 ELSE 0 END AS radio_UMTS,
    CASE WHEN radio = 'GSM' THEN 1 ELSE 0 END AS radio_GSM, CASE WHEN radio = 'NR' THEN 1 ELSE 0 END AS radio_NR FROM fx_antennas"""))
def one_hot_radio(spark, sf_dir):
    return TW.one_hot_radio(fixture(spark, sf_dir, "fx_antennas")).select(
        "radio", "lon_e6", "lat_e6", "radio_LTE", "radio_UMTS", "radio_GSM", "radio_NR")


_SITE_COLS = "cluster_id, antenna_count, range, antennas_4G, antennas_3G, antennas_2G, antennas_5G"


@register("dissolve_sites", C.render(["fx_antennas"], _dissolve_ctes(),
                                     f"SELECT {_SITE_COLS}, round(longitude, 7) AS longitude, round(latitude, 7) AS latitude FROM sites"))
def dissolve_sites(spark, sf_dir):
    s = TW.dissolve_sites(TW.cluster_antennas(_antennas(spark, sf_dir)))
    return s.select(*_SITE_COLS.split(", "), F.round("longitude", 7).alias("longitude"), F.round("latitude", 7).alias("latitude"))




def _tower_sites_sql() -> str:
    zs = "(SELECT zone FROM zs)"
    sx, sy = utm_sql("longitude", "latitude", zs)
    ctes = _dissolve_ctes() + [
        ("zs", "SELECT CAST(floor((avg(longitude) + 180) / 6) + 1 AS INTEGER) AS zone FROM sites"),
        ("sp", f"SELECT cluster_id, {sx} AS x, {sy} AS y FROM sites"),
    ]
    cols, joins, fixtures = [], [], ["fx_antennas"]
    for lay, (fx, kind, where) in _LAYER_SPECS.items():
        fixtures.append(fx)
        if kind == "seg":
            x1, y1 = utm_sql("lon1", "lat1", zs)
            x2, y2 = utm_sql("lon2", "lat2", zs)
            body = f"SELECT {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM {fx} WHERE {where}"
        else:
            x, y = utm_sql("lon", "lat", zs)
            body = f"SELECT {x} AS x1, {y} AS y1, {x} AS x2, {y} AS y2 FROM {fx} WHERE {where}"
        ctes.append((f"l_{lay}", body))
        ctes.append((f"d_{lay}", f"SELECT s.cluster_id, min({seg_dist_sql('s.x', 's.y', 'l.x1', 'l.y1', 'l.x2', 'l.y2')}) AS d FROM sp s, l_{lay} l GROUP BY s.cluster_id"))
        name = K.LAYERS[lay][0]
        cols.append(f"round(d_{lay}.d, 3) AS distance_to_{name}_m")
        joins.append(f"LEFT JOIN d_{lay} ON d_{lay}.cluster_id = s.cluster_id")
    return C.render(fixtures, ctes, f"""SELECT s.cluster_id, s.antenna_count, s.range, s.antennas_4G, s.antennas_3G, s.antennas_2G, s.antennas_5G,
        round(s.longitude, 7) AS longitude, round(s.latitude, 7) AS latitude, {', '.join(cols)} FROM sites s {' '.join(joins)}""")


@register("build_tower_sites", _tower_sites_sql())
def build_tower_sites(spark, sf_dir):
    """Antennas -> bounded -> clustered -> dissolved -> distances to the four infrastructure layers."""
    layers = TW.layer_tables_from_fixtures(spark, sf_dir, list(_LAYER_SPECS))
    s = TW.build_tower_sites(fixture(spark, sf_dir, "fx_antennas").withColumnRenamed("range_m", "range"), layers, MY)
    dist = [f"distance_to_{K.LAYERS[l][0]}_m" for l in _LAYER_SPECS]
    return s.select(*_SITE_COLS.split(", "), F.round("longitude", 7).alias("longitude"), F.round("latitude", 7).alias("latitude"),
                    *[F.round(c, 3).alias(c) for c in dist])
