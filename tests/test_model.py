"""Model invariants: folds partition the blocks, every row is predicted, contributions add up."""

import pytest
from pyspark.sql import functions as F

from tilerank import constants as K
from tilerank.operators.contributions import top_driver
from tilerank.plans import model as MD
from tilerank.registry.common import fx_prepared


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    return fx_prepared(spark, sf_dir).drop("cv_predicted_speed", "lat_block", "lon_block", "spatial_block").cache()


def test_folds_partition_blocks(prepared):
    pool = MD.with_blocks(prepared.where(F.col("is_underserved_target")))
    folds = MD.spatial_folds(pool).collect()
    blocks = {r["spatial_block"] for r in pool.select("spatial_block").distinct().collect()}
    assert {r["spatial_block"] for r in folds} == blocks
    sizes = {}
    for r in folds:
        sizes[r["fold"]] = sizes.get(r["fold"], 0) + 1
    assert len(sizes) == min(5, len(blocks)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_fewer_than_two_blocks_skip_cv(spark):
    df = spark.createDataFrame([("a", 0.1, 0.1), ("b", 0.2, 0.2)], "site_id string, latitude double, longitude double")
    assert MD.spatial_folds(MD.with_blocks(df)) is None


def test_every_row_predicted_and_contributions_add_up(prepared):
    feats = [f for f in K.MODEL_FEATURES if f in prepared.columns]
    out, model = MD.spatial_block_cv(prepared, feats, K.TARGET, maxIter=10)
    assert out.where(F.col("cv_predicted_speed").isNull()).count() == 0
    assert out.count() == prepared.count()
    pred = MD.predict_all(prepared, model, feats).select("site_id", "predicted_download_kbps")
    drv = top_driver(prepared, model, feats).join(pred, "site_id")
    err = drv.select(F.max(F.abs(F.col("shap_base") + F.col("shap_sum") - F.col("predicted_download_kbps")))).first()[0]
    assert err < 1e-6


def test_fit_gbt_query_reports_every_tree(spark, sf_dir):
    import __spark_entry__ as E

    rows = E.queries()["fit_gbt"](spark, sf_dir).collect()
    assert len(rows) == K.GBT_PARAMS["maxIter"]
    w = sorted((r["treeID"], r["tree_weight"]) for r in rows)
    assert w[0][1] == 1.0 and all(x[1] == pytest.approx(K.GBT_PARAMS["stepSize"]) for x in w[1:])


def test_repeated_keys_keep_the_row_count(prepared):
    feats = [f for f in K.MODEL_FEATURES if f in prepared.columns]
    rows = prepared.limit(300).cache()
    twice = rows.unionByName(rows)
    assert MD.model_and_drivers(twice, feats, K.TARGET, maxIter=2).count() == twice.count()
    folds = MD.spatial_folds(MD.with_blocks(twice).where(F.col("is_underserved_target")))
    if folds is not None:
        assert MD.cv_mean_baseline(MD.with_blocks(twice), K.TARGET, folds).count() == twice.count()


def test_contributions_are_looked_up_not_played_per_row():
    """Tables equal the game played per row, for shallow trees and for paths of more conditions than a shared table holds, and cost little a row."""
    import random
    import time

    import numpy as np

    from tilerank.operators.contributions import _contrib_batch, contribution_tables

    rng = random.Random(3)

    def grow(depth, path, leaves):
        if depth == 0:
            leaves.append((rng.gauss(0, 1), list(path)))
            return
        f, thr, share = rng.randrange(6), rng.random(), rng.random()
        grow(depth - 1, path + [(f, thr, True, share)], leaves)
        grow(depth - 1, path + [(f, thr, False, 1 - share)], leaves)

    def value(leaves, x, known):
        out = 0.0
        for v, path in leaves:
            w = v
            for f, thr, left, share in path:
                w *= float((x[f] <= thr) == left) if f in known else share
            out += w
        return out

    from itertools import permutations

    X = np.random.default_rng(1).random((2, 6))
    X[1, 2] = np.nan
    for depth in (2, 4, 10):
        leaves = []
        grow(depth, [], leaves)
        leaves = leaves[:40]
        tables, base = contribution_tables([(0.5, leaves)])
        got = _contrib_batch(X, tables, 6)
        assert base == pytest.approx(0.5 * value(leaves, X[0], set()))
        for r, x in enumerate(X):
            seen = {}
            want = np.zeros(6)
            orders = list(permutations(range(6)))
            for order in orders:
                known = frozenset()
                for f in order:
                    for k in (known, known | {f}):
                        if k not in seen:
                            seen[k] = value(leaves, x, k)
                    want[f] += seen[known | {f}] - seen[known]
                    known = known | {f}
            assert np.allclose(got[:, r], 0.5 * want / len(orders), atol=1e-12)
    # 200 trees of depth 4: some 20 microseconds a row, not half a millisecond
    model = []
    for _ in range(200):
        leaves = []
        grow(4, [], leaves)
        model.append((0.05, leaves))
    tables, _ = contribution_tables(model)
    rows = np.random.default_rng(2).random((10_000, 6))
    start = time.process_time()
    _contrib_batch(rows, tables, 6)
    assert time.process_time() - start < 2


def test_stored_tables_keep_rows_names_and_types_in_less_space(spark):
    import os

    from tilerank.session import cut_lineage, ensure_checkpoint_dir, store

    def size():
        base = ensure_checkpoint_dir(spark).removeprefix("file:")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(base) for f in fs)

    df = spark.range(20_000).select("id", *[(F.col("id") % (i + 2)).cast("double").alias(f"a b;{i}") for i in range(30)], F.lit("tier").alias("A"), F.lit(None).cast("string").alias("a"))
    before = size()
    kept = store(df)
    small = size() - before
    assert kept.columns == df.columns and [f.dataType for f in kept.schema] == [f.dataType for f in df.schema]
    assert kept.toDF(*map(str, range(33))).exceptAll(df.toDF(*map(str, range(33)))).isEmpty() and kept.count() == 20_000
    before = size()
    cut_lineage(df)
    assert small * 3 < size() - before
    assert store(spark.range(3).withColumn("n", F.lit(None))).count() == 3 and store(df.limit(0)).count() == 0
