"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bisector, inverted_multi_index, line_dedup, mixing, ngram_join, piece_lattice, prob_minhash, quality_rules, spelling, suffix_dedup, token_files, toxicity, url_filter
from .common import register, table


@register("op1_weak_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_multi_index")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100."""
    rows = inverted_multi_index.valid_vectors(table(spark, sf_dir, "embeddings"))
    return inverted_multi_index.search(rows, rows.where("vec_id % 100 = 0"))


@register("op3_line_windows", line_dedup.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@register("op4_prob_minhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op5_url_trees")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@register("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_digest(manifest)


@register("op7_rule_ledger", quality_rules.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


@register("op8_source_mix")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


@register("op9_piece_lattice")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_lattice.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op10_merged_transforms")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


@register("op11_ngram_join", ngram_join.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@register("op12_permuterm")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@register("op13_bisector", bisector.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisector.cluster(table(spark, sf_dir, "embeddings"))
