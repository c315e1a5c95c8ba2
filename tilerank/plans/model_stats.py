"""Model-quality and pool statistics: R², block counts, flag counts, matrix profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles


def _r2(ss_res: Column, ss_tot: Column) -> Column:
    """``1 - SSres/SStot``; a constant target gives 1.0 for a perfect fit, else 0.0."""
    return F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - ss_res / ss_tot)


def r2_score(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """R² over rows with a prediction, globally or per group (two aggregate passes, no collect)."""
    d = df.where(F.col(p).isNotNull()).select(*by, F.col(y).cast("double").alias("_y"), F.col(p).cast("double").alias("_p"))
    means = d.groupBy(*by).agg(F.avg("_y").alias("_m"), F.count(F.lit(1)).alias("n"))
    if by:
        j = d.join(means, list(by), "inner")
    else:
        r = means.first()
        j = d.withColumns({"_m": F.lit(r["_m"] if r else None).cast("double"), "n": F.lit(r["n"] if r else 0).cast("bigint")})
    sums = j.groupBy(*by).agg(
        F.sum((F.col("_y") - F.col("_p")) * (F.col("_y") - F.col("_p"))).alias("ss_res"),
        F.sum((F.col("_y") - F.col("_m")) * (F.col("_y") - F.col("_m"))).alias("ss_tot"),
        F.first("n").alias("n"),
    )
    return sums.select(*by, "n", _r2(F.col("ss_res"), F.col("ss_tot")).alias("r2"))


def r2_by_stratum(df: DataFrame, y: str, p: str, by: str = "demographic_stratum") -> DataFrame:
    """Per-stratum R², only for strata with more than one predicted row."""
    return r2_score(df, y, p, [by]).where(F.col("n") > 1)


def count_blocks(pool: DataFrame, block: str = "spatial_block") -> DataFrame:
    """Distinct blocks in sorted order with a 1-based index and the total.

    The block table is bounded by geography (0.5-degree cells), so one ordered window over it is small.
    """
    blocks = pool.select(block).where(F.col(block).isNotNull()).distinct()
    w = Window.orderBy(block)
    return blocks.select(
        block,
        F.row_number().over(w).cast("bigint").alias("block_index"),
        F.count(F.lit(1)).over(Window.partitionBy()).cast("bigint").alias("n_blocks"),
    )


def count_flags(df: DataFrame, flag: str = "is_underserved_target") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_tiles"),
        F.count_if(F.coalesce(F.col(flag), F.lit(False))).cast("bigint").alias("n_flagged"),
    )


def describe_by(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact, linear) and max, per group and overall."""
    keys = [by] if by else []
    base = df.select(*keys, F.col(col).cast("double").alias("_v"))
    stats = base.groupBy(*keys).agg(
        F.count("_v").cast("bigint").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"), F.max("_v").alias("max"),
    )
    qs = exact_quantiles(base, "_v", [0.25, 0.5, 0.75], by=keys, names=["p25", "p50", "p75"])
    if keys:
        return stats.join(qs, keys, "left")
    r = qs.first()
    return stats.withColumns({c: F.lit(r[c] if r else None).cast("double") for c in ("p25", "p50", "p75")})


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type and non-NULL count (one aggregation, then a stack)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                 F.col(f"c{i}").cast("bigint").alias("non_null"))
        for i, c in enumerate(df.columns)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
