"""Speed model: spatial blocks and folds, gradient-boosted trees, blocked cross-validation,
per-row top driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.screening import spatial_block
from ..operators.boosting import fit_models
from ..operators.contributions import with_prediction, with_top_driver
from ..session import store


def with_blocks(df: DataFrame, size: float = K.BLOCK_SIZE_DEG) -> DataFrame:
    lat_b, lon_b, blk = spatial_block(size=size)
    return df.withColumns({"lat_block": lat_b, "lon_block": lon_b, "spatial_block": blk})


def spatial_folds(pool: DataFrame, n_splits: int = K.N_SPLITS, seed: int = K.SEED, block: str = "spatial_block") -> DataFrame | None:
    """``(block, fold)``: k = min(n_splits, #blocks) folds over the distinct blocks in a seeded
    hash order, sizes differing by at most one (larger folds first). None for fewer than two blocks.

    The block table is bounded by geography (one row per 0.5-degree cell), so the ordered window
    over it is small.
    """
    blocks = pool.select(block).where(F.col(block).isNotNull()).distinct()
    n = blocks.count()
    if n < 2:
        return None
    k = min(n_splits, n)
    w = Window.orderBy(F.md5(F.concat(F.col(block), F.lit(f"|{seed}"))), F.col(block))
    return blocks.withColumn("fold", F.ntile(k).over(w))


def fold_membership(df: DataFrame, folds: DataFrame, block: str = "spatial_block") -> DataFrame:
    """Attach each row's fold via its block (block table broadcast: one row per block)."""
    return df.join(F.broadcast(folds), block, "left")


def cv_mean_baseline(df: DataFrame, target: str, folds: DataFrame, key: str = "site_id",
                     pool_flag: str = "is_underserved_target") -> DataFrame:
    """Fold mechanics with the training-fold mean as the predictor: pool rows get
    ``(S - S_k) / (N - N_k)``, other rows the mean of the whole pool."""
    marked = fold_membership(df, folds).withColumn("fold", F.when(F.col(pool_flag), F.col("fold")))
    rows = marked.select(key, "fold", F.when(F.col(pool_flag), F.col(target).cast("double")).alias("_y"))
    tot = rows.agg(F.sum("_y").alias("s"), F.count("_y").alias("n")).first()
    per = rows.where(F.col("fold").isNotNull()).groupBy("fold").agg(F.sum("_y").alias("sk"), F.count("_y").alias("nk"))
    s, n = F.lit(tot["s"]).cast("double"), F.lit(tot["n"]).cast("double")
    held_out = F.when(n - F.col("nk") > 0, (s - F.col("sk")) / (n - F.col("nk")))
    return rows.join(F.broadcast(per), "fold", "left").select(key, "fold", F.coalesce(held_out, F.when(n > 0, s / n)).alias("cv_pred"))


def fit_gbt(df: DataFrame, features: Sequence[str], target: str, **params):
    """Gradient-boosted regression trees (defaults: 200 trees, depth 4, rate 0.05, seed 42) on the rows with a target.

    The training set is cut first, with whatever parallelism its plan has, so the fit never reaches into the plan before.
    """
    data = store(df.select(*features, F.col(target).alias("_target"), F.lit(None).cast("int").alias("_fold")))
    (model,) = fit_models(data, features, "_target", "_fold", [None], {**K.GBT_PARAMS, **params})
    if model is None:
        raise ValueError("no row to train the model on")
    return model


def predict_all(df: DataFrame, model, features: Sequence[str], out: str = "predicted_download_kbps") -> DataFrame:
    """Every row's prediction; the features become doubles, a missing one goes right in every tree."""
    return with_prediction(df.withColumns({f: F.col(f).cast("double") for f in features}), model, features, out)


def spatial_block_cv(df: DataFrame, features: Sequence[str], target: str, n_splits: int = K.N_SPLITS, key: str = "site_id",
                     pool_flag: str = "is_underserved_target", **params) -> tuple[DataFrame, object]:
    """Blocked cross-validation and the production model.

    Adds ``lat_block, lon_block, spatial_block``, ``cv_predicted_speed`` (out-of-block prediction
    for training-pool rows, production prediction elsewhere) and ``predicted_download_kbps``.
    The fold fits and the production fit are independent and run at once. Returns
    ``(frame, production_model)``.
    """
    return _cross_predicted(store(with_blocks(df)), features, target, n_splits, pool_flag, **params)


def _cross_predicted(data: DataFrame, features: Sequence[str], target: str, n_splits: int = K.N_SPLITS, pool_flag: str = "is_underserved_target",
                     **params) -> tuple[DataFrame, object]:
    """:func:`spatial_block_cv` of rows with blocks. They are read three times: hand in a stored table, or columns computed from one.

    Every row is predicted where it lies: the rows outside the pool by the production model, those of a fold by that and by the model that did not see the fold. Nothing is joined back.
    """
    in_pool = F.coalesce(F.col(pool_flag), F.lit(False))
    pool, rest = data.where(in_pool), data.where(~in_pool)
    folds = spatial_folds(pool, n_splits)
    k = 0
    if folds is None:
        pool = pool.withColumn("fold", F.lit(None).cast("int"))
    else:
        pool = store(fold_membership(pool, folds).select(*data.columns, "fold"))
        k = folds.agg(F.max("fold")).first()[0]
    final, *held_out = fit_models(pool, features, target, "fold", [None, *range(1, k + 1)], {**K.GBT_PARAMS, **params})
    if final is None:
        raise ValueError("no row to train the model on")

    def predicted(rows: DataFrame, model) -> DataFrame:
        out = predict_all(rows, final, features)
        if model is None:
            return out.withColumn("cv_predicted_speed", F.col("predicted_download_kbps"))
        return predict_all(out, model, features, "cv_predicted_speed")

    out = predicted(rest, None).unionByName(predicted(pool.where(F.col("fold").isNull()).drop("fold"), None))
    for i, model in enumerate(held_out, start=1):
        out = out.unionByName(predicted(pool.where(F.col("fold") == i).drop("fold"), model))
    return out, final


def model_and_drivers(df: DataFrame, features: Sequence[str], target: str, key: str = "site_id", **params) -> DataFrame:
    """Cross-validated predictions plus each row's top driver and its contribution. ``df`` is read three times: a stored table, or columns computed from one."""
    out, final = _cross_predicted(with_blocks(df), features, target, **params)
    return with_top_driver(out, final, features)
