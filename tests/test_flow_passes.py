"""The flows read what is costly once."""

from pyspark.sql import functions as F

from tilerank.operators.contributions import top_driver, with_top_driver
from tilerank.plans import flows as FL
from tilerank.plans import model as MD
from tilerank.registry.common import fx_prepared
from tilerank.sources.fixtures import fixture
from tilerank.sources.wkb import decode_segments, encode_linestring, encode_point, encode_polygon, wkb_to_segments


def test_matrix_is_computed_once(spark, sf_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    m = fixture(spark, sf_dir, "fx_matrix").drop("cv_predicted_speed")
    n = m.count()
    ranked = FL.rank_sites(m.mapInPandas(count, m.schema), maxIter=2)
    assert ranked.count() == n and seen.value == n


def test_rows_are_predicted_where_they_lie(spark, sf_dir):
    """No join by row: predictions and drivers are columns of the rows, with the fold's own model in its fold."""
    prepared = fx_prepared(spark, sf_dir).drop("cv_predicted_speed", "lat_block", "lon_block", "spatial_block").cache()
    feats = [f for f in ("population_total", "elevation_m", "slope_degrees", "antenna_count") if f in prepared.columns]
    out, final = MD.spatial_block_cv(prepared, feats, "download_kbps", maxIter=3)
    pool = F.col("is_underserved_target")
    rest = out.where(~pool & (F.col("cv_predicted_speed") != F.col("predicted_download_kbps"))).count()
    other = out.where(pool & (F.col("cv_predicted_speed") != F.col("predicted_download_kbps"))).count()
    assert rest == 0 and other > 0 and out.count() == prepared.count()
    drv = with_top_driver(out, final, feats)
    plan = drv._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and "Exchange" not in plan
    want = top_driver(prepared, final, feats).select("site_id", F.col("top_shap_driver").alias("d"), F.col("top_shap_value").alias("v"))
    both = drv.join(want, "site_id")
    assert both.where((F.col("d") != F.col("top_shap_driver")) | (F.abs(F.col("v") - F.col("top_shap_value")) > 1e-9)).count() == 0 and both.count() == prepared.count()


def test_geometries_decoded_together_equal_one_by_one():
    import struct

    import pandas as pd

    big = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    blobs = [encode_point(1.0, 2.0), encode_linestring([(0.0, 0.0), (1.0, 1.0), (2.0, 0.5)]), None, big, encode_point(float("nan"), 0.0), encode_linestring([(5.0, 5.0)]),
             encode_polygon([[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]), encode_linestring([(1.5, 0.0), (1.0, 1.25)]), encode_linestring([]), encode_point(7.0, 8.0)]
    pdf = pd.DataFrame({"id": [str(i) if i != 9 else None for i in range(len(blobs))], "type": [None if i == 1 else "t" for i in range(len(blobs))], "wkb": blobs})
    got = pd.concat(list(decode_segments(iter([pdf, pdf.iloc[:0]]), "id", "type", "wkb")))
    want = [(i, t, *row) for i, t, b in zip(pdf["id"], pdf["type"], blobs) if b is not None for row in wkb_to_segments(b, with_kind=True)]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, got.itertuples(index=False, name=None))) == sorted(map(key, want)) and len(got) == 10


def test_looked_up_predictions_are_the_models(spark):
    """Shallow trees and paths of more conditions than a table holds, with missing values."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    feats = [f"f{i}" for i in range(11)]
    d = spark.range(600).select("id", *[F.rand(i).alias(f) for i, f in enumerate(feats)]).withColumn("y", sum((F.col(f) * (i + 1) for i, f in enumerate(feats)), F.rand(99)) * 100).cache()
    for depth in (2, 4, 11):
        vec = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
        model = GBTRegressor(labelCol="y", maxIter=3, maxDepth=depth, seed=1).fit(vec.transform(d))
        holed = d.withColumn("f3", F.when(F.col("id") % 5 != 0, F.col("f3")))
        got = MD.predict_all(holed, model, feats, "p").select("id", "p")
        both = got.join(model.transform(vec.transform(holed.withColumn("f3", F.coalesce("f3", F.lit(float("nan")))))).select("id", "prediction"), "id")
        assert both.count() == 600 and both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0


def test_coordinates_are_projected_once_per_geometry(spark):
    """No filter on a projected coordinate below the store of the geometries: it would compute the projection again for every mention."""
    from tilerank.functions.geo import with_utm
    from tilerank.operators import spatial

    plans = []
    kept = spatial.store

    def store(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    pts = spark.createDataFrame([(i, 100.0 + i / 100, 1.0 + i / 300) for i in range(50)], "id long, lon double, lat double")
    left = with_utm(pts, F.lit(47), "lon", "lat").select(F.col("id").alias("k"), "x", "y")
    right = with_utm(pts.unionByName(spark.createDataFrame([(99, None, None)], pts.schema)), F.lit(47), "lon", "lat", "x1", "y1").withColumns({"x2": F.col("x1"), "y2": F.col("y1")})
    spatial.store = store
    try:
        out = spatial.nearest_feature(left.unionByName(spark.createDataFrame([(77, None, 1.0)], left.schema)), right.select("id", "x1", "y1", "x2", "y2"), "k", "id").collect()
    finally:
        spatial.store = kept
    assert len(out) == 51 and all(r["id"] == r["k"] and r["distance_m"] < 1e-6 for r in out if r["k"] != 77) and [r["id"] for r in out if r["k"] == 77] == [None]
    assert not any("Filter" in line and "COSH" in line.upper() for p in plans for line in p.splitlines())
