"""Per-row feature contributions of a Spark gradient-boosted tree model (path-dependent
Shapley values, Lundberg et al. 2018), computed in Arrow batches inside Spark tasks.

For a tree, the expected prediction given a known feature set S weights every leaf by the
product, over the nodes on its path, of ``1[x goes that way]`` when the node's feature is in
S and of the training cover fraction of that branch otherwise. That product depends only on
the distinct features of the leaf's own path (at most the tree depth), so each leaf is a small
cooperative game whose Shapley values are found exactly by enumerating subsets of those
features; the model's contributions are the weighted sum over leaves and trees. The games are
played once per pattern of answers on the driver (a few tables of 256 entries a tree, whatever
the number of rows); the tables travel to the tasks, where a row looks its patterns up.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship_package


def flatten_model(model) -> list[tuple[float, list[tuple[float, list[tuple[int, float, bool, float]]]]]]:
    """``[(tree_weight, [(leaf_value, [(feature, threshold, goes_left, cover_fraction), ...]), ...]), ...]``; kept beside the model."""
    kept = getattr(model, "_tilerank_trees", None)
    if kept is not None:
        return kept
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "gbt_model")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        split = r["split"]
        trees.setdefault(r["treeID"], {})[r["id"]] = (r["prediction"], r["leftChild"], r["rightChild"], split["featureIndex"],
                                                      (split["leftCategoriesOrThreshold"] or [0.0])[0], r["rawCount"])
    return keep_trees(model, [trees[i] for i in sorted(trees)])


def keep_trees(model, trees: Sequence[dict[int, tuple]]) -> list:
    """Flatten ``{node id: (prediction, left child, right child, feature, threshold, rows)}`` of each tree and keep the result beside the model."""
    out = []
    for weight, nodes in zip(model.treeWeights, trees):
        leaves = []

        def walk(nid: int, path: list) -> None:
            prediction, left_child, right_child, f, thr, total = nodes[nid]
            if left_child < 0:
                leaves.append((float(prediction), list(path)))
                return
            for child, left in ((left_child, True), (right_child, False)):
                frac = float(nodes[child][5]) / float(total) if total > 0 else 0.0
                walk(child, path + [(int(f), float(thr), left, frac)])

        walk(0, [])
        out.append((weight, leaves))
    model._tilerank_trees = out
    return out


def _shapley_weights(m: int) -> dict[int, float]:
    return {s: math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)}


#: Leaves share one table as long as they ask no more than this many conditions together (2**8 patterns).
GROUP_CONDITIONS = 8


def _condition_groups(leaves) -> list[list]:
    """The leaves of a tree in runs that ask at most ``GROUP_CONDITIONS`` different conditions; a leaf that asks more is a group of its own."""
    groups, asked = [], set()
    for leaf in leaves:
        own = {(f, thr) for f, thr, _, _ in leaf[1]}
        if not groups or len(asked | own) > GROUP_CONDITIONS:
            groups.append([])
            asked = set()
        groups[-1].append(leaf)
        asked |= own
    return groups


def _leaf_table(value: float, path, answer, rows: int) -> dict[int, np.ndarray]:
    """Shapley values of one leaf by feature, for ``rows`` patterns; ``answer(question)`` is 1 in the patterns that say yes to it."""
    feats = sorted({f for f, _, _, _ in path})
    m = len(feats)
    # per feature: does the row pass all of the path's conditions on it, and what share of the training rows does
    passes, share = [np.ones(rows) for _ in feats], [1.0] * m
    for f, thr, left, frac in path:
        i = feats.index(f)
        passes[i] = passes[i] * answer(f, thr, left)
        share[i] *= frac
    weight = []
    for mask in range(1 << m):
        acc = np.ones(rows)
        for i in range(m):
            acc = acc * (passes[i] if (mask >> i) & 1 else share[i])
        weight.append(acc)
    coef = _shapley_weights(m)
    out = {}
    for j, f in enumerate(feats):
        tot = np.zeros(rows)
        for mask in range(1 << m):
            if not (mask >> j) & 1:
                tot += coef[bin(mask).count("1")] * (weight[mask | 1 << j] - weight[mask])
        out[f] = value * tot
    return out


def _questions(group) -> tuple[list, Callable, int]:
    """What a group of leaves asks, the answers ``(feature, threshold, left) -> 0 or 1`` in every pattern, and the number of patterns."""
    asked = sorted({(f, thr) for _, path in group for f, thr, _, _ in path})
    if len(asked) > GROUP_CONDITIONS:
        path = group[0][1]
        questions = [[(f, thr, left) for f, thr, left, _ in path if f == g] for g in sorted({f for f, _, _, _ in path})]
    else:
        questions = [[(f, thr, True)] for f, thr in asked]
    bit_of = {c: i for i, q in enumerate(questions) for c in q}
    patterns = np.arange(1 << len(questions))

    def answer(f, thr, left):
        yes = (f, thr, left) in bit_of
        bit = (patterns >> bit_of[(f, thr, left) if yes else (f, thr, not left)]) & 1
        return bit if yes else 1 - bit

    return questions, answer, len(patterns)


def prediction_tables(model) -> list:
    """``[(questions, table), ...]`` of a flattened model: a row's prediction is the sum of what its patterns of answers look up."""
    tables = []
    for w_t, leaves in model:
        for group in _condition_groups(leaves):
            questions, answer, patterns = _questions(group)
            table = np.zeros(patterns)
            for value, path in group:
                passes = np.ones(patterns)
                # the answers of a deep leaf are per feature: each of them counts once
                for f, thr, left, _ in path:
                    passes = passes * answer(f, thr, left)
                table += w_t * value * passes
            tables.append((questions, table))
    return tables


def contribution_tables(model) -> tuple[list, float]:
    """``([(questions, {feature: table}), ...], expected value)`` of a flattened model.

    A row's contributions depend on nothing but its answers to ``x[feature] <= threshold``. Per group of leaves, the exact Shapley values
    of all patterns of answers are found once; a row then looks its pattern up instead of playing the game of every leaf again. A question
    is a list of conditions ``(feature, threshold, left)`` that all must hold: one condition each, or, for a leaf deeper than a
    group's limit, all of its conditions on one feature (the table then has two entries per subset of the leaf's features).
    """
    tables, base = [], 0.0
    for w_t, leaves in model:
        for group in _condition_groups(leaves):
            questions, answer, patterns = _questions(group)
            phi: dict[int, np.ndarray] = {}
            for value, path in group:
                base += w_t * value * math.prod(frac for _, _, _, frac in path)
                for f, t in _leaf_table(w_t * value, path, answer, patterns).items():
                    phi[f] = phi.get(f, 0.0) + t
            if phi:
                tables.append((questions, phi))
    return tables, base


def _contrib_batch(X: np.ndarray, tables, n_features: int) -> np.ndarray:
    """Contributions (feature x row) of a batch."""
    phi = np.zeros((n_features, X.shape[0]))
    for pattern, by_feature in _patterns(X, tables):
        for f, table in by_feature.items():
            phi[f] += table.take(pattern, mode="clip")
    return phi


def _predict_batch(X: np.ndarray, tables) -> np.ndarray:
    """Predictions of a batch."""
    out = np.zeros(X.shape[0])
    for pattern, table in _patterns(X, tables):
        out += table.take(pattern, mode="clip")
    return out


def _patterns(X: np.ndarray, tables) -> Iterator[tuple]:
    """Each group's pattern of answers per row, with what the group looks up; a missing value answers no, as in the trees.

    A condition that many trees ask is answered once, and a group's answers are put together as bytes.
    """
    columns = np.ascontiguousarray(X.T)
    answers: dict[tuple, np.ndarray] = {}

    def answer(f, thr, left) -> np.ndarray:
        if (f, thr) not in answers:
            answers[f, thr] = (columns[f] <= thr).view(np.uint8)
        return answers[f, thr] if left else 1 - answers[f, thr]

    for questions, found in tables:
        pattern = np.zeros(X.shape[0], dtype=np.uint8 if len(questions) <= 8 else np.intp)
        for i, conditions in enumerate(questions):
            yes = answer(*conditions[0])
            for c in conditions[1:]:
                yes = yes & answer(*c)
            pattern |= yes.astype(pattern.dtype, copy=False) << pattern.dtype.type(i)
        yield pattern.astype(np.intp, copy=False), found


def _top(X: np.ndarray, tables, feats: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names of the features with the largest absolute contribution, first on ties; their contributions; sums of all contributions) of a batch."""
    phi = _contrib_batch(X, tables, len(feats))
    idx = np.abs(phi).argmax(axis=0) if len(X) else np.zeros(0, dtype=int)
    return np.array(feats, dtype=object)[idx], phi[idx, np.arange(len(X))], phi.sum(axis=0)


def _matrix(columns: Sequence[pd.Series]) -> np.ndarray:
    return np.column_stack([c.to_numpy(dtype="float64", na_value=np.nan) for c in columns])


def with_prediction(df: DataFrame, model, features: Sequence[str], out: str) -> DataFrame:
    """``df`` with the model's prediction, looked up in tables (Spark ML walks the 200 trees of a row as objects, node by node)."""
    ship_package(df.sparkSession)
    look_up = getattr(model, "_tilerank_look_up", None)
    if look_up is None:  # made once a model: a model predicts several parts of a table
        tables = prediction_tables(flatten_model(model))

        def run(*columns: pd.Series) -> pd.Series:
            return pd.Series(_predict_batch(_matrix(columns), tables))

        look_up = model._tilerank_look_up = F.pandas_udf(run, T.DoubleType())
    return df.withColumn(out, look_up(*[F.col(c).cast("double") for c in features]))


def with_top_driver(df: DataFrame, model, features: Sequence[str], driver: str = "top_shap_driver", value: str = "top_shap_value") -> DataFrame:
    """``df`` with each row's top driver and its contribution (see :func:`top_driver`), added where the row lies."""
    ship_package(df.sparkSession)
    tables, _ = contribution_tables(flatten_model(model))
    feats = list(features)

    def run(*columns: pd.Series) -> pd.DataFrame:
        names, values, _ = _top(_matrix(columns), tables, feats)
        return pd.DataFrame({driver: names, value: values})

    schema = T.StructType([T.StructField(driver, T.StringType()), T.StructField(value, T.DoubleType())])
    found = F.pandas_udf(run, schema)(*[F.col(c).cast("double") for c in feats])
    return df.withColumn("_driver", found).select(*df.columns, f"_driver.{driver}", f"_driver.{value}")


def top_driver(df: DataFrame, model, features: Sequence[str], key: str = "site_id",
               driver: str = "top_shap_driver", value: str = "top_shap_value") -> DataFrame:
    """``key``, the feature with the largest absolute contribution (first on ties), its contribution,
    the model's expected value ``shap_base`` and the sum of contributions ``shap_sum``."""
    tables, base = contribution_tables(flatten_model(model))
    feats = list(features)
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField(driver, T.StringType()), T.StructField(value, T.DoubleType()),
        T.StructField("shap_base", T.DoubleType()), T.StructField("shap_sum", T.DoubleType()),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            X = pdf[feats].to_numpy(dtype="float64", na_value=np.nan)
            names, values, sums = _top(X, tables, feats)
            yield pd.DataFrame({key: pdf[key].to_numpy(), driver: names, value: values, "shap_base": np.full(len(pdf), base), "shap_sum": sums})

    cols = [key] + [F.col(c).cast("double").alias(c) for c in feats]
    return df.select(*cols).mapInPandas(run, schema)

