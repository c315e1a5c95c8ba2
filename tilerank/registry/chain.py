"""DuckDB SQL for the screening -> imputation -> tier -> scoring -> rank chain (oracle side).

Each builder returns a list of ``(cte_name, body)``; :func:`render` prefixes the fixture CTEs.
Float literals are written ``x::DOUBLE`` so DuckDB does not fold them as DECIMAL.
"""

from __future__ import annotations

from .. import constants as K
from ..sources.fixtures import fixture_sql


def d(x: float) -> str:
    return f"({x!r}::DOUBLE)"


def render(fixtures: list[str], ctes: list[tuple[str, str]], query: str) -> str:
    parts = [f"{n} AS ({fixture_sql(n)}\n)" for n in fixtures] + [f"{n} AS (\n{b}\n)" for n, b in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + query


EVIDENCE = f"(tests >= {K.MIN_TESTS} AND devices >= {K.MIN_DEVICES})"


def screening(src: str, name: str) -> list[tuple[str, str]]:
    q0, q1 = K.POPULATION_QUANTILES
    return [
        (f"{name}_valid", f"SELECT * FROM {src} WHERE {EVIDENCE}"),
        (f"{name}_cut", f"SELECT quantile_cont(population_total, {d(q0)}) AS c0, quantile_cont(population_total, {d(q1)}) AS c1, "
                        f"count(*) AS n FROM {name}_valid"),
        (f"{name}_strat", f"""SELECT t.*, CASE WHEN c.n = 0 THEN NULL WHEN t.population_total <= c.c0 THEN '{K.STRATUM_RURAL}'
            WHEN t.population_total <= c.c1 THEN '{K.STRATUM_PERI_URBAN}' ELSE '{K.STRATUM_URBAN}' END AS demographic_stratum
            FROM {src} t CROSS JOIN {name}_cut c"""),
        (f"{name}_thr", f"""SELECT demographic_stratum, quantile_cont(CAST(download_kbps AS DOUBLE), {d(K.SPEED_QUANTILE)}) AS thr
            FROM {name}_strat WHERE {EVIDENCE} GROUP BY demographic_stratum"""),
        (name, f"""SELECT s.*, COALESCE({EVIDENCE.replace('tests', 's.tests').replace('devices', 's.devices')}
            AND s.download_kbps < COALESCE(h.thr, 0.0::DOUBLE), false) AS is_underserved_target
            FROM {name}_strat s LEFT JOIN {name}_thr h ON s.demographic_stratum = h.demographic_stratum"""),
    ]


def impute(src: str, name: str, columns: list[str]) -> list[tuple[str, str]]:
    present = set(columns)
    geo = [c for c in K.GEOGRAPHY_COLUMNS if c in present]
    repl = []
    for c in K.ANTENNA_COLUMNS:
        if c in present:
            repl.append(f"COALESCE({c}, 0) AS {c}")
    for c in K.DISTANCE_COLUMNS:
        if c in present:
            repl.append(f"COALESCE({c}, {d(K.MISSING_DISTANCE_FILL_M)}) AS {c}")
    for c in geo:
        repl.append(f"COALESCE({c}, (SELECT median({c}) FROM {src})) AS {c}")
    return [(name, f"SELECT * REPLACE ({', '.join(repl)}) FROM {src}")]


def engineer(src: str, name: str) -> list[tuple[str, str]]:
    return [(name, f"""SELECT *, COALESCE(population_total, 0.0::DOUBLE) / (antenna_count + 1) AS congestion_proxy,
        (antennas_4G + antennas_5G) / (antenna_count + 1) AS pct_4g_5g FROM {src}""")]


def spatial_block(src: str, name: str) -> list[tuple[str, str]]:
    s = d(K.BLOCK_SIZE_DEG)
    return [(name, f"""SELECT *, CAST(trunc(latitude / {s}) AS INTEGER) AS lat_block, CAST(trunc(longitude / {s}) AS INTEGER) AS lon_block,
        CAST(CAST(trunc(latitude / {s}) AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(trunc(longitude / {s}) AS INTEGER) AS VARCHAR) AS spatial_block
        FROM {src}""")]


def tier_expr() -> str:
    ev = f"COALESCE({EVIDENCE}, false)"
    near = f"COALESCE(distance_to_nearest_tower <= {d(K.TOWER_DISTANCE_LIMIT_M)}, false)"
    return (f"CASE WHEN {ev} AND {near} AND COALESCE(is_underserved_target, false) THEN '{K.TIER_APPROVED}' "
            f"WHEN {ev} AND {near} THEN '{K.TIER_ABOVE_BASELINE}' "
            f"WHEN COALESCE(tests > 0, false) THEN '{K.TIER_THIN}' ELSE '{K.TIER_NO_DATA}' END")


def tier(src: str, name: str) -> list[tuple[str, str]]:
    return [(name, f"SELECT *, {tier_expr()} AS confidence_tier FROM {src}")]


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN (CASE WHEN ({a}) > 0 THEN 'inf'::DOUBLE WHEN ({a}) < 0 THEN '-inf'::DOUBLE END) ELSE ({a}) / ({b}) END)"


def clip_hi(x: str, hi: float) -> str:
    return f"(CASE WHEN ({x}) > {d(hi)} THEN {d(hi)} ELSE ({x}) END)"


def clip_lo(x: str, lo: float) -> str:
    return f"(CASE WHEN ({x}) < {d(lo)} THEN {d(lo)} ELSE ({x}) END)"


def off_grid_sql() -> str:
    wp, wr, wn, wq = K.OFF_GRID_WEIGHTS
    return (f"((({clip_hi(f'distance_to_power_m / {d(K.POWER_SCALE_M)}', 1.0)} * {d(wp)}) + "
            f"({clip_hi(f'distance_to_road_m / {d(K.ROAD_SCALE_M)}', 1.0)} * {d(wr)})) + "
            f"({div(d(1.0), f'night_radiance_nw_cm2_sr + {d(K.RADIANCE_OFFSET)}')} * {d(wn)})) + "
            f"({clip_hi(f'population_total / {d(K.POPULATION_SCALE)}', 1.0)} * {d(wq)})")


def aspect_sql() -> str:
    opt = f"(CASE WHEN latitude > 0 THEN {d(180.0)} ELSE {d(0.0)} END)"
    dd = f"abs(aspect_degrees - {opt})"
    dmin = f"(CASE WHEN {dd} IS NULL THEN NULL ELSE least({dd}, {d(360.0)} - {dd}) END)"
    return f"({d(1.0)} - ({dmin} / {d(180.0)}))"


def solar_sql(max_solar: str) -> str:
    wr, ws, wa, wn = K.SOLAR_WEIGHTS
    v = (f"((((({div('solar_radiation_mj', max_solar)} * {d(wr)}) + ({div(d(1.0), f'slope_degrees + {d(1.0)}')} * {d(ws)})) + "
         f"({aspect_sql()} * {d(wa)})) - (rainfall_mm_hr * {d(wn)})))")
    return clip_lo(v, K.FLOOR_VALUE)


def logistics_sql(weights=K.LOGISTICS_WEIGHTS) -> str:
    ws, we, wr, wg = weights
    ss, se, sr, sg = K.LOGISTICS_SCALES
    v = (f"((((slope_degrees / {d(ss)}) * {d(ws)}) + ((elevation_m / {d(se)}) * {d(we)})) + "
         f"((distance_to_road_m / {d(sr)}) * {d(wr)})) + ((terrain_ruggedness / {d(sg)}) * {d(wg)})")
    return clip_lo(v, K.FLOOR_VALUE)


def raw_sql(logistics: str) -> str:
    num = ("(((indicative_abatement_tco2e_yr * solar_viability) * (population_total + essential_service_weight)) "
           "* underperformance_residual)")
    return div(num, logistics)


def score(src: str, name: str) -> list[tuple[str, str]]:
    fill = ", ".join(f"COALESCE({c}, {d(K.MISSING_DISTANCE_FILL_M)}) AS {c}"
                     for c in ("distance_to_power_m", "distance_to_road_m", "distance_to_amenity_m"))
    abat = (f"(CASE WHEN off_grid_likelihood < {d(K.MIN_LIKELIHOOD)} THEN {d(0.0)} ELSE "
            f"(({d(K.DIESEL_BASELINE_TCO2E)} * {d(K.ABATEMENT_FACTOR)}) * {clip_hi('off_grid_likelihood', 1.0)}) END)")
    opex = (f"(CASE WHEN off_grid_likelihood < {d(K.MIN_LIKELIHOOD)} THEN {d(0.0)} ELSE "
            f"({d(K.OPEX_BASELINE_USD)} * {clip_hi('off_grid_likelihood', 1.0)}) END)")
    resid = (f"(CASE WHEN {d(K.MIN_RESIDUAL)} > (cv_predicted_speed - download_kbps) THEN {d(K.MIN_RESIDUAL)} "
             f"ELSE (cv_predicted_speed - download_kbps) END)")
    ess = (f"(CASE WHEN distance_to_amenity_m <= {d(K.ESSENTIAL_SERVICE_RADIUS_M)} THEN {d(K.ESSENTIAL_SERVICE_WEIGHT)} "
           f"ELSE {d(0.0)} END)")
    return [
        (f"{name}_1", f"SELECT * REPLACE ({fill}) FROM {src}"),
        (f"{name}_2", f"SELECT *, {off_grid_sql()} AS off_grid_likelihood FROM {name}_1"),
        (f"{name}_3", f"""SELECT *, {solar_sql('(SELECT max(solar_radiation_mj) FROM ' + name + '_2)')} AS solar_viability,
            {logistics_sql()} AS logistics_difficulty FROM {name}_2"""),
        (f"{name}_4", f"""SELECT *, {abat} AS indicative_abatement_tco2e_yr, {opex} AS indicative_opex_saving_usd,
            {resid} AS underperformance_residual, {ess} AS essential_service_weight FROM {name}_3"""),
        (f"{name}_5", f"SELECT *, {raw_sql('logistics_difficulty')} AS _raw FROM {name}_4"),
        (name, f"""SELECT t.* EXCLUDE (_raw),
            CASE WHEN b.hi = b.lo THEN {d(50.0)} ELSE round(((_raw - b.lo) / (b.hi - b.lo)) * {d(100.0)}, 2) END AS priority_score,
            CASE WHEN indicative_abatement_tco2e_yr > 0 THEN population_total / indicative_abatement_tco2e_yr ELSE {d(0.0)} END
              AS people_connected_per_tonne_co2
            FROM {name}_5 t CROSS JOIN (SELECT min(_raw) AS lo, max(_raw) AS hi FROM {name}_5) b"""),
    ]


def govern_score_rank(src: str, name: str) -> list[tuple[str, str]]:
    approved = f"COALESCE(contains(confidence_tier, '{K.APPROVED_MARKER}'), false)"
    return tier(src, f"{name}_t") + [(f"{name}_a", f"SELECT * FROM {name}_t WHERE {approved}")] + score(f"{name}_a", f"{name}_s") + [
        (f"{name}_u", f"SELECT * FROM {name}_s UNION ALL BY NAME SELECT * FROM {name}_t WHERE NOT {approved}"),
        (f"{name}_st", f"SELECT *, '{K.INFERENCE_STATUS}' AS inference_status, {approved} AS field_survey_triggered FROM {name}_u"),
        (name, f"""SELECT *, CAST(row_number() OVER (ORDER BY field_survey_triggered DESC, priority_score DESC NULLS LAST, site_id ASC) AS BIGINT)
            AS national_rank FROM {name}_st"""),
    ]


def fx_prepared() -> list[tuple[str, str]]:
    """fx_matrix -> screening -> imputation -> features -> spatial blocks (the modelled-matrix stand-in)."""
    from ..sources.fixtures import FIXTURE_SQL  # noqa: F401

    cols = FX_MATRIX_COLUMNS + ["demographic_stratum", "is_underserved_target"]
    return (screening("fx_matrix", "m_scr") + impute("m_scr", "m_imp", cols) + engineer("m_imp", "m_eng")
            + spatial_block("m_eng", "m_prep"))


FX_MATRIX_COLUMNS = [
    "site_id", "longitude", "latitude", "download_kbps", "tests", "devices", "population_total", "elevation_m", "slope_degrees",
    "aspect_degrees", "terrain_ruggedness", "rainfall_mm_hr", "night_radiance_nw_cm2_sr", "solar_radiation_mj", "tree_canopy",
    "distance_to_power_m", "distance_to_road_m", "distance_to_amenity_m", "distance_to_tier1_hub_m", "distance_to_nearest_tower",
    "antenna_count", "antennas_4G", "antennas_3G", "antennas_2G", "antennas_5G", "cv_predicted_speed",
]
