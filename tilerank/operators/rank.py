"""Global ordering operators: dense 1..n row numbers, top-k, seeded samples.

``row_number()`` over a window without ``partitionBy`` moves every row into one task.
:func:`global_row_number` instead range-partitions and sorts the data (a normal
distributed sort), tags each row with ``monotonically_increasing_id`` (partition index in
the high bits, position in the low bits), stores that under the checkpoint folder so the
tags are stable under recomputation, counts rows per partition (one small row per
partition), turns the counts into offsets with a window over that small table, and adds
the offset back with a broadcast join whose size is bounded by the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

_LOW_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Append ``name`` = 1..n following ``order`` (which must be a total order for a unique result)."""
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    tagged = store(tagged)
    part = F.shiftright(F.col("_mid"), _LOW_BITS)
    pos = F.col("_mid") - F.shiftleft(part, _LOW_BITS)
    counts = tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), part == F.col("_p"), "inner")
    return out.withColumn(name, (F.col("_off") + pos + 1).cast("bigint")).drop("_mid", "_p", "_off")


def top_k(df: DataFrame, score: str, k: int, key: str = "site_id") -> DataFrame:
    """The ``k`` rows with the largest non-NULL ``score`` (ties by ``key``): a bounded top-k."""
    return df.where(F.col(score).isNotNull()).orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)


def sample_rows(df: DataFrame, n: int, seed: int, key: str = "site_id") -> DataFrame:
    """Deterministic seeded sample of ``n`` rows: smallest ``md5(key || seed)``."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
