"""Shared Spark-side building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.tables import engineer_features, impute_domain
from ..plans.model import with_blocks
from ..plans.ranking import apply_confidence_tier, score_matrix, split_by_tier
from ..plans.screening import stratified_screening
from ..sources.fixtures import fixture


def fx_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_matrix -> screening -> imputation -> features -> spatial blocks."""
    m = fixture(spark, sf_dir, "fx_matrix")
    return with_blocks(engineer_features(impute_domain(stratified_screening(m))))


def fx_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_confidence_tier(fx_prepared(spark, sf_dir))


def fx_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    approved, _ = split_by_tier(fx_tiered(spark, sf_dir))
    return score_matrix(approved)
