"""tilerank: Spark-native site prioritisation for mobile coverage.

Functions from DataFrame to DataFrame (or to Column) that cluster antennas into tower
sites, clip speed-test tiles to country polygons, attach nearest-feature distances,
aggregate raster bands around sites, screen underserved tiles, model speed with
spatially blocked cross-validation, and score and rank sites.
"""

__version__ = "0.1.0"
