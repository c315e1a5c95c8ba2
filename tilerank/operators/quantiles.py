"""Exact quantiles with linear interpolation, without gathering a group into one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation
buffer, which does not survive a global median over billions of rows. Here the ranks are
found by counting ranges of values:

1. ``percentile_approx`` (bounded-memory summary, map-side partial aggregation) gives, per
   group and probability, a bracket ``[lo, hi]`` around the target ranks; ``count`` gives n.
2. One scan counts, per group and probability, the rows below the bracket, above it, and every
   value inside it. Each side is one row however many rows it has, and a hot value is one row.
3. The counts are range-partitioned in the order (group, side, value) and written once. One sum
   per group and partition gives every partition its offset, and only the partitions that
   hold a target rank are looked at: the window there runs over a part of one range partition,
   so no task grows with n, whatever the group or bracket holds.

The values at ranks ``floor(k)`` and ``floor(k) + 1`` with ``k = p (n - 1)`` are interpolated as
``lo + (hi - lo) * frac``: the same definition as pandas ``quantile``, Spark ``percentile`` and
DuckDB ``quantile_cont``. Steps 2 and 3 count exactly, so a rank that lies beside its bracket
is seen to fall on a side; the groups concerned are counted again without brackets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# of the summary that finds the brackets; they hold 6 / accuracy of the rows, counted exactly. A summary grows with it, and all summaries of a group are merged in one task
DEFAULT_ACCURACY = 2000
# half width of a bracket in units of 1 / accuracy (the summary's rank error is one unit)
BRACKET_UNITS = 3.0
# a bracket table of at most this many rows is broadcast; a longer one is joined by shuffle
BROADCAST_ROWS = 20000


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    accuracy: int = DEFAULT_ACCURACY,
    count_name: str | None = None,
) -> DataFrame:
    """Per group in ``by`` (or globally), one column per probability (NULLs ignored).

    Groups without any non-NULL value are absent from the result; the global result is one row of NULLs then.
    """
    by = list(by)
    keys = by + ["_i"]
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    base = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    brackets = cut_lineage(_brackets(base, by, probs, accuracy))
    picked = cut_lineage(_pick(_ranges(base, brackets, by), keys))
    missed = picked.where(F.col("_beside"))
    if not missed.isEmpty():
        wide = _join(brackets, missed, keys, "left_semi").withColumns({c: F.lit(None).cast("double") for c in ("_lo", "_hi")})
        again = _pick(_ranges(base, cut_lineage(wide), by), keys)
        picked = picked.where(~F.col("_beside")).unionByName(again)
    q = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_k") - F.floor("_k"))
    aggs = [F.max(F.when(F.col("_i") == i, q)).alias(names[i]) for i in range(len(probs))]
    if count_name:
        aggs.append(F.max("_n").alias(count_name))
    return picked.groupBy(*by).agg(*aggs)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys of the left side stay."""
    a, b = left.alias("_a"), right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]).alias("_b")
    out = a.join(b, [F.col(f"_a.{c}").eqNullSafe(F.col(f"_b._r_{c}")) for c in keys], how)
    return out if how == "left_semi" else out.drop(*[f"_r_{c}" for c in keys])


def _brackets(base: DataFrame, by: Sequence[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """``by, _n, _i, _lo, _hi, _k`` per group and probability; a NULL end is open.

    A group smaller than ``4 * accuracy`` is its own bracket (at most that many distinct values).
    """
    m, margin = len(probs), BRACKET_UNITS / accuracy
    lo_p = [max(p - margin, 0.0) for p in probs]
    hi_p = [min(p + margin, 1.0) for p in probs]
    stats = base.groupBy(*by).agg(F.count("_v").alias("_n"), F.percentile_approx("_v", lo_p + hi_p, accuracy).alias("_a"))
    big = F.col("_n") >= 4 * accuracy
    per_prob = F.array(*[
        F.struct(
            F.lit(i).alias("_i"),
            (F.lit(None).cast("double") if lo_p[i] <= 0.0 else F.when(big, F.col("_a")[i])).alias("_lo"),
            (F.lit(None).cast("double") if hi_p[i] >= 1.0 else F.when(big, F.col("_a")[m + i])).alias("_hi"),
            (F.lit(float(probs[i])) * (F.col("_n") - 1)).alias("_k"),
        )
        for i in range(m)
    ])
    return stats.where(F.col("_n") > 0).select(*by, "_n", F.explode(per_prob).alias("_b")).select(*by, "_n", "_b.*")


def _ranges(base: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact counts ``_c`` of the rows below (``_side`` -1), of each value inside (0) and above (1) the bracket of
    every group and probability: one scan of ``base``, combined before the shuffle."""
    if by:
        small = brackets.count() <= BROADCAST_ROWS
        joined = _join(base, F.broadcast(brackets) if small else brackets, by)
    else:
        joined = _attach(base, brackets)
    side = F.when(F.col("_v") < F.col("_lo"), -1).when(F.col("_v") > F.col("_hi"), 1).otherwise(0)
    sided = joined.withColumn("_side", side).withColumn("_v", F.when(F.col("_side") == 0, F.col("_v")))
    return sided.groupBy(*by, "_i", "_n", "_k", "_side", "_v").agg(F.count(F.lit(1)).alias("_c"))


def _attach(base: DataFrame, brackets: DataFrame) -> DataFrame:
    """Global case: one bracket per probability. They are fetched (a few numbers) and every row of ``base``
    meets them by exploding a literal array, so no join and no cross join is planned."""
    rows = brackets.collect()
    if not rows:
        return base.select("_v", *[F.lit(None).cast(f.dataType).alias(f.name) for f in brackets.schema]).where(F.lit(False))
    arr = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in brackets.schema]) for r in rows])
    return base.select("_v", F.explode(arr).alias("_b")).select("_v", "_b.*")


def _pick(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, _n, _k, _v0, _v1, _beside``: the values at the two target ranks, and whether a rank fell on a side."""
    part = F.spark_partition_id().alias("_p")
    placed = cut_lineage(ranges.repartitionByRange(*keys, "_side", "_v").select("*", part))
    sums = placed.groupBy(*keys, "_p").agg(F.sum("_c").alias("_s"), F.first("_n").alias("_n"), F.first("_k").alias("_k"))
    w = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    r0 = F.floor("_k")
    r1 = F.least(r0 + 1, F.col("_n") - 1)
    offsets = sums.withColumn("_off", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    holding = offsets.where((r0 < F.col("_off") + F.col("_s")) & (r1 >= F.col("_off"))).select(*keys, "_p", "_off")
    run = Window.partitionBy(*keys, "_p").orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _join(placed, holding, [*keys, "_p"]).withColumn("_end", F.col("_off") + F.sum("_c").over(run))
    start = F.col("_end") - F.col("_c")
    hit0, hit1 = (r0 >= start) & (r0 < F.col("_end")), (r1 >= start) & (r1 < F.col("_end"))
    return ranked.where(hit0 | hit1).groupBy(*keys).agg(
        F.first("_n").alias("_n"), F.first("_k").alias("_k"),
        F.max(F.when(hit0, F.col("_v"))).alias("_v0"), F.max(F.when(hit1, F.col("_v"))).alias("_v1"),
        F.max(F.col("_side") != 0).alias("_beside"))


def global_quantiles(df: DataFrame, value: str, probs: Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> tuple[list, int]:
    """Global exact quantiles as Python floats plus the non-NULL count (one small result row).

    Used where a handful of scalars parametrise a later plan (cut-offs, medians), so the later
    plan carries literals instead of re-running the quantile jobs inside every subquery.
    """
    names = [f"q{i}" for i in range(len(probs))]
    row = exact_quantiles(df, value, probs, names=names, accuracy=accuracy, count_name="_n").collect()
    # a global aggregate over no rows still yields one all-NULL row
    if not row or row[0]["_n"] is None:
        return [None] * len(probs), 0
    return [row[0][c] for c in names], row[0]["_n"]


def scalar_row(df: DataFrame):
    """Evaluate a one-row aggregate and return its Row (a few numbers reach the driver)."""
    return df.first()
