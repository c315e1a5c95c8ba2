"""What the training-data operators share: the query registry, table access, materialising, skew-safe joins.

Nothing outside this subpackage imports it.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A key with at least this share of all rows is joined by broadcast; there are at most 1 / HEAVY_SHARE such keys.
HEAVY_SHARE = 1 / 2000
#: Bytes of an Arrow batch that goes to Python, unless the session sets its own; 10,000 long texts in one would be held by the JVM and Python at once.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def register(key: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage is cut and every row is fixed.

    The files survive the loss of any executor, and later reads prune columns, which ``checkpoint`` cannot.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, needed: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The columns ``needed`` and one struct ``carried`` of all others, numbered, so that no name of theirs can meet a name used inside an operator."""
    others = [c for c in docs.columns if c not in needed]
    fields = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]
    return docs.select(*needed, F.struct(F.lit(True).alias("row"), *fields).alias("carried"))


def unpacked(rows: DataFrame, like: DataFrame, needed: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The columns of ``like``, in its order and types, from rows made by ``packed`` (``needed`` as there)."""
    kinds = dict(like.dtypes)
    others = {c: f"carried.c{i}" for i, c in enumerate(c for c in like.columns if c not in needed)}
    return rows.select(*(F.col(others.get(c, c)).cast(kinds[c]).alias(c) for c in like.columns))


def join_counted(rows: DataFrame, keys: DataFrame, on: list[str], n: str = "n") -> DataFrame:
    """Inner join of ``rows`` with ``keys`` (one row per key; column ``n`` counts the key's rows in ``rows``).

    A key that holds ``HEAVY_SHARE`` of the rows or more would land in one task. There can be only
    ``1 / HEAVY_SHARE`` of them, so they are broadcast with a proven bound; the rest join by shuffle. ``keys`` should
    be a materialised table, it is read three times.
    """
    total = keys.agg(F.coalesce(F.sum(n), F.lit(0)).alias("t")).first()["t"]
    cut = max(1000, int(total * HEAVY_SHARE))
    heavy = keys.where(F.col(n) >= cut)
    light = rows.join(keys.where(F.col(n) < cut), on)
    if heavy.limit(1).count() == 0:
        return light
    return light.unionByName(rows.join(F.broadcast(heavy), on))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds at most ``max_bytes`` of ``column`` (one row at least)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        at = np.cumsum(sizes)
        lo = 0
        while lo < b.num_rows:
            base = at[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(at, base + max_bytes, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


@functools.lru_cache(maxsize=1)
def _malloc_trim():
    """The C library's own call for it, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return lambda pad: 0


def give_back() -> None:
    """Memory that this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    _malloc_trim()(0)


def lean(emit):
    """``emit`` (batches to batches) with its freed memory given back after every batch it yields and at its end.

    Spark keeps Python workers for later tasks of any kind; what their allocators hold would add to what those tasks need.
    """

    def run(batches):
        try:
            for out in emit(batches):
                yield out
                del out
                give_back()
        finally:
            give_back()

    return run


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hashes (fixed key) of byte strings, the same in every process."""
    import pandas as pd

    if not words:
        return np.empty(0, np.uint64)
    a = np.empty(len(words), dtype=object)
    a[:] = words
    return pd.util.hash_array(a, categorize=False)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads 64-bit values evenly (public-domain constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (``len(h) - k + 1`` of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return out
