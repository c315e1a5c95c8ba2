"""Model operators. Folds and the mean baseline have SQL oracles;
the tree model outputs are checked by row counts here and by invariants in tests/."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators.contributions import top_driver as top_driver_op
from ..plans import model as MD
from ..session import scratch_path
from . import chain as C
from . import register
from .common import fx_prepared

PREP = C.fx_prepared()
_FOLDS = [
    ("pool", "SELECT * FROM m_prep WHERE is_underserved_target"),
    ("blk", f"""SELECT spatial_block, row_number() OVER (ORDER BY md5(spatial_block || '|{K.SEED}'), spatial_block) AS rn,
        count(*) OVER () AS n FROM (SELECT DISTINCT spatial_block FROM pool) b"""),
    ("kk", f"SELECT *, least({K.N_SPLITS}, n) AS k, n // least({K.N_SPLITS}, n) AS q, n % least({K.N_SPLITS}, n) AS r FROM blk"),
    ("folds", """SELECT spatial_block, CAST(CASE WHEN rn <= r * (q + 1) THEN (rn - 1) // (q + 1) + 1
        ELSE r + (rn - 1 - r * (q + 1)) // q + 1 END AS INTEGER) AS fold FROM kk"""),
]


def _model_input(spark, sf_dir):
    """The prepared matrix without the stand-in prediction column."""
    return fx_prepared(spark, sf_dir).drop("cv_predicted_speed", "lat_block", "lon_block", "spatial_block")


@register("spatial_folds", C.render(["fx_matrix"], PREP + _FOLDS, "SELECT spatial_block, fold FROM folds"))
def spatial_folds(spark, sf_dir):
    pool = fx_prepared(spark, sf_dir).where(F.col("is_underserved_target"))
    return MD.spatial_folds(pool).select("spatial_block", F.col("fold").cast("int").alias("fold"))


@register("fold_membership", C.render(["fx_matrix"], PREP + _FOLDS,
                                      "SELECT p.site_id, p.spatial_block, f.fold FROM pool p JOIN folds f USING (spatial_block)"))
def fold_membership(spark, sf_dir):
    pool = fx_prepared(spark, sf_dir).where(F.col("is_underserved_target"))
    folds = MD.spatial_folds(pool)
    return MD.fold_membership(pool, folds).select("site_id", "spatial_block", F.col("fold").cast("int").alias("fold"))


@register("cv_mean_baseline", C.render(["fx_matrix"], PREP + _FOLDS + [
    ("pf", "SELECT p.site_id, f.fold, CAST(p.download_kbps AS DOUBLE) AS y FROM pool p JOIN folds f USING (spatial_block)"),
    ("tot", "SELECT sum(y) AS s, CAST(count(y) AS DOUBLE) AS n FROM pf"),
    ("per", "SELECT fold, sum(y) AS sk, CAST(count(y) AS DOUBLE) AS nk FROM pf GROUP BY fold"),
], """SELECT m.site_id, pf.fold,
    round(COALESCE(CASE WHEN tot.n - per.nk > 0 THEN (tot.s - per.sk) / (tot.n - per.nk) END, CASE WHEN tot.n > 0 THEN tot.s / tot.n END), 6) AS cv_pred
    FROM m_prep m LEFT JOIN pf USING (site_id) LEFT JOIN per USING (fold) CROSS JOIN tot"""))
def cv_mean_baseline(spark, sf_dir):
    """Blocked-CV mechanics with the training-fold mean as the predictor."""
    df = fx_prepared(spark, sf_dir)
    folds = MD.spatial_folds(df.where(F.col("is_underserved_target")))
    out = MD.cv_mean_baseline(df, K.TARGET, folds)
    return out.select("site_id", F.col("fold").cast("int").alias("fold"), F.round("cv_pred", 6).alias("cv_pred"))


@register("fit_gbt")
def fit_gbt(spark, sf_dir):
    """Production model on the training pool; output: one row per tree (weight, node and leaf counts)."""
    df = _model_input(spark, sf_dir)
    pool = df.where(F.col("is_underserved_target"))
    feats = [f for f in K.MODEL_FEATURES if f in df.columns]
    model = MD.fit_gbt(pool, feats, K.TARGET)
    path = scratch_path(spark, "gbt")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    per_tree = nodes.groupBy("treeID").agg(F.count(F.lit(1)).alias("n_nodes"),
                                           F.count_if(F.col("nodeData.leftChild") < 0).alias("n_leaves"))
    meta = spark.read.parquet(f"{path}/treesMetadata")  # columns: tree id, metadata json, weight
    weights = meta.select(F.col(meta.columns[0]).cast("int").alias("treeID"), F.col(meta.columns[-1]).cast("double").alias("tree_weight"))
    return per_tree.join(weights, "treeID")


@register("predict_all")
def predict_all(spark, sf_dir):
    """The production model predicts every row, inside and outside the training pool."""
    df = _model_input(spark, sf_dir)
    feats = [f for f in K.MODEL_FEATURES if f in df.columns]
    model = MD.fit_gbt(df.where(F.col("is_underserved_target")), feats, K.TARGET)
    return MD.predict_all(df, model, feats).select("site_id", "predicted_download_kbps")


@register("spatial_block_cv")
def spatial_block_cv(spark, sf_dir):
    df = _model_input(spark, sf_dir)
    feats = [f for f in K.MODEL_FEATURES if f in df.columns]
    out, _ = MD.spatial_block_cv(df, feats, K.TARGET)
    return out.select("site_id", "spatial_block", "cv_predicted_speed", "predicted_download_kbps")


@register("top_driver")
def top_driver(spark, sf_dir):
    """Top contribution per row, with the additivity residual |base + sum(phi) - prediction|."""
    df = _model_input(spark, sf_dir)
    feats = [f for f in K.MODEL_FEATURES if f in df.columns]
    model = MD.fit_gbt(df.where(F.col("is_underserved_target")), feats, K.TARGET)
    pred = MD.predict_all(df, model, feats).select("site_id", "predicted_download_kbps")
    drv = top_driver_op(df, model, feats)
    j = drv.join(pred, "site_id")
    return j.select("site_id", "top_shap_driver", "top_shap_value", "predicted_download_kbps",
                    F.abs(F.col("shap_base") + F.col("shap_sum") - F.col("predicted_download_kbps")).alias("additivity_error"))
