"""Fixed values that must equal the original pipeline's for identical results.

Every list, threshold, label and weight below is a fixed value of the screening,
scoring and governance rules; they are stated here once, in natural order.
"""

# --- fixed values: mobile country codes kept by the antenna filter ---
MCC_CODES = (414, 452, 456, 457, 502, 510, 515, 520, 525, 528)

# --- fixed values: region bounding boxes [west, south, east, north] in degrees ---
REGION_BOUNDS = {
    "Malaysia": (99.6, 0.8, 119.3, 7.5),
    "Indonesia": (95.0, -11.0, 141.0, 6.0),
    "Vietnam": (102.1, 8.5, 109.5, 23.4),
    "Philippines": (116.9, 4.6, 126.6, 19.5),
    "Thailand": (97.3, 5.6, 105.6, 20.5),
    "Singapore": (103.6, 1.15, 104.1, 1.48),
    "Cambodia": (102.3, 10.4, 107.6, 14.7),
    "Myanmar": (92.2, 9.6, 101.2, 28.5),
    "Laos": (100.1, 13.9, 107.7, 22.5),
    "Brunei": (114.2, 4.0, 115.4, 4.6),
}

# --- fixed values: model feature list, in order ---
MODEL_FEATURES = (
    "population_total",
    "elevation_m",
    "slope_degrees",
    "terrain_ruggedness",
    "distance_to_power_m",
    "distance_to_road_m",
    "antenna_count",
    "distance_to_nearest_tower",
    "night_radiance_nw_cm2_sr",
    "solar_radiation_mj",
    "rainfall_mm_hr",
    "congestion_proxy",
    "pct_4g_5g",
    "antennas_4G",
    "antennas_3G",
    "antennas_2G",
    "antennas_5G",
    "tree_canopy",
    "distance_to_tier1_hub_m",
)
TARGET = "download_kbps"
TARGET_ALTERNATIVES = ("download_speed", "speed_down", "ookla_download_speed")

# --- fixed values: radio technologies and their tower columns ---
RADIO_COLUMNS = (("LTE", "antennas_4G"), ("UMTS", "antennas_3G"), ("GSM", "antennas_2G"), ("NR", "antennas_5G"))

# --- fixed values: infrastructure layers (layer name, column suffix, selector field, accepted values) ---
LAYERS = {
    "power": ("power", "class", ("power_line",)),
    "roads": ("road", "class", ("primary", "secondary", "tertiary", "trunk")),
    "amenities": ("amenity", "categories.primary", ("school", "hospital", "clinic")),
    "tier1_hubs": ("tier1_hub", "subtype", ("locality",)),
}

# --- fixed values: distances and thresholds ---
CLUSTER_EPS_M = 500.0
BUFFER_RADIUS_M = 2750.0
MIN_TESTS = 15
MIN_DEVICES = 5
POPULATION_QUANTILES = (0.33, 0.66)
SPEED_QUANTILE = 0.20
LOW_QUARTILE = 0.25
TOWER_DISTANCE_LIMIT_M = 2750.0
MISSING_TOWER_DISTANCE_M = 99999.0
MISSING_DISTANCE_FILL_M = 10000.0
ESSENTIAL_SERVICE_RADIUS_M = 2500.0
ESSENTIAL_SERVICE_WEIGHT = 50.0
BLOCK_SIZE_DEG = 0.5
N_SPLITS = 5
SEED = 42
TOP_K = 20
STABLE_OVERLAP_PCT = 80.0

# --- fixed values: imputation column groups ---
ANTENNA_COLUMNS = ("antenna_count", "antennas_4G", "antennas_3G", "antennas_2G", "antennas_5G")
DISTANCE_COLUMNS = (
    "distance_to_power_m",
    "distance_to_road_m",
    "distance_to_amenity_m",
    "distance_to_nearest_tower",
    "distance_to_tier1_hub_m",
)
GEOGRAPHY_COLUMNS = (
    "elevation_m",
    "slope_degrees",
    "terrain_ruggedness",
    "night_radiance_nw_cm2_sr",
    "solar_radiation_mj",
    "rainfall_mm_hr",
    "tree_canopy",
)

# --- fixed values: scoring constants ---
POWER_SCALE_M = 5000.0
ROAD_SCALE_M = 2000.0
POPULATION_SCALE = 1000.0
OFF_GRID_WEIGHTS = (0.35, 0.25, 0.25, 0.15)  # power, road, radiance, population
RADIANCE_OFFSET = 0.1
SOLAR_WEIGHTS = (0.5, 0.3, 0.2, 0.1)  # radiation, slope, aspect, rainfall penalty
FLOOR_VALUE = 0.1
LOGISTICS_WEIGHTS = (0.4, 0.3, 0.3, 0.2)  # slope, elevation, road, ruggedness
ALT_LOGISTICS_WEIGHTS = (0.2, 0.5, 0.2, 0.3)
LOGISTICS_SCALES = (15.0, 1000.0, 1000.0, 50.0)
DIESEL_BASELINE_TCO2E = 34.2
ABATEMENT_FACTOR = 0.65
OPEX_BASELINE_USD = 17000.0
MIN_LIKELIHOOD = 0.10
MIN_RESIDUAL = 1.0

# --- fixed values: labels ---
STRATUM_RURAL = "rural"
STRATUM_PERI_URBAN = "peri-urban"
STRATUM_URBAN = "urban"
TIER_APPROVED = "Sufficient Evidence - Ranked Screening Approved"
TIER_ABOVE_BASELINE = "Sufficient Evidence - Performing Above Baseline (Excluded)"
TIER_THIN = "Thin Evidence - Masked from Prioritization"
TIER_NO_DATA = "No Data - Excluded"
APPROVED_MARKER = "Ranked Screening Approved"
SUFFICIENT_MARKER = "Sufficient"
INFERENCE_STATUS = "Candidate Site - Validation Required"

# --- fixed values: zonal band renames (raw reducer output -> matrix column) ---
# Composite of each band as (name, band of the images, reducer, first day, day after the last); no days: all images.
ENVIRONMENT_RECIPES = (
    ("night_radiance", "night_radiance", "median", "2022-01-01", "2023-01-01"),
    ("solar_radiation", "solar_radiation", "mean", "2023-01-01", "2024-01-01"),
    ("population", "population", "mean", "2020-01-01", "2021-01-01"),
    ("elevation", "elevation", "mean", None, None),
    ("rainfall", "rainfall", "mean", "2023-01-01", "2024-01-01"),
    ("tree_canopy", "tree_canopy", "mean", None, None),
)
ZONAL_RENAMES = (
    ("elevation_mean", "elevation_m"),
    ("slope_mean", "slope_degrees"),
    ("aspect_mean", "aspect_degrees"),
    ("terrain_ruggedness_mean", "terrain_ruggedness"),
    ("rainfall_mean", "rainfall_mm_hr"),
    ("night_radiance_mean", "night_radiance_nw_cm2_sr"),
    ("population_sum", "population_total"),
    ("solar_radiation_mean", "solar_radiation_raw"),
    ("tree_canopy_mean", "tree_canopy"),
)
ZONAL_DROPS = (
    "elevation_sum",
    "population_mean",
    "night_radiance_sum",
    "rainfall_sum",
    "slope_sum",
    "aspect_sum",
    "solar_radiation_sum",
    "solar_radiation_raw",
    "terrain_ruggedness_sum",
    "tree_canopy_sum",
)
# earlier (notebook) variant
ZONAL_RENAMES_V1 = (
    ("elevation_mean", "elevation_m"),
    ("slope_mean", "slope_degrees"),
    ("rainfall_mean", "rainfall_mm_hr"),
    ("night_radiance_mean", "night_radiance_nw_cm2_sr"),
    ("population_sum", "population_total"),
)
ZONAL_DROPS_V1 = (
    "site_id",
    "elevation_sum",
    "population_mean",
    "night_radiance_sum",
    "rainfall_sum",
    "slope_sum",
    "solar_radiation_mean",
    "solar_radiation_sum",
)
J_PER_MJ = 1.0e6

# --- fixed values: gradient-boosting parameters ---
GBT_PARAMS = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05, "seed": 42}

# WGS84 ellipsoid
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
