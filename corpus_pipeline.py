"""A training-data pipeline over ``documents``: toxicity, line dedup, near-duplicates, source mix, SentencePiece ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents, of the same columns; the last
returns the encoded rows. ``run`` writes every stage's result as Parquet to the shared scratch folder and reads it again. Each stage works
on all that the one before kept.

Defined cases are those of the operators (see their modules): nulls, empty and very long texts, repeated rows and empty tables pass every stage.
Columns that a stage does not read travel as one struct, so they may have any name, those used inside the operators included, and keep their values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilerank.llm import line_dedup, mixing, piece_lattice, prob_minhash, toxicity
from tilerank.llm.common import packed, prepare, stage, table, unpacked

#: No SQL: the classifier, the sketches and the tokenizer are beyond it; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None
#: A character that is in a word.
IN_WORD = r"[^\x20\x09-\x0D]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision classifier rejects (score >= 0.3) go."""
    prepare(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(packed(docs), model, ("text", "carried"))
    return unpacked(scored.where(F.col("score") < toxicity.THRESHOLD), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; so do documents that lose their last word by it. ``n_chars`` counts what is left."""
    prepare(spark)
    needed = ("doc_id", "text", *(c for c in docs.columns if c == "n_chars"))
    cut = line_dedup.line_dedup(packed(docs, needed), (*needed[2:], "carried"))
    left = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(IN_WORD))
    if "n_chars" in needed:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return unpacked(left, docs, needed)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one of the smallest doc_id; documents without a word stay."""
    prepare(spark)
    rows = packed(docs)
    worded = F.coalesce(F.col("text").rlike(IN_WORD), F.lit(False))
    found = prob_minhash.near_duplicates(docs.select("doc_id", "text")).where("rep AND key IS NOT NULL")
    name = lambda key: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), key)
    reps = found.select(name(F.col("key")).alias("rid")).distinct()
    named = rows.where(worded).withColumn("rid", name(F.md5("text")))
    one = named.join(reps.hint("merge"), "rid").groupBy("rid").agg(F.first(F.struct(*rows.columns)).alias("d")).select("d.*")
    return unpacked(one.unionByName(rows.where(~worded)), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their target weights: documents come once per epoch that takes words of them, cut to those words."""
    prepare(spark)
    needed = ("doc_id", "text", "source")
    mixed = unpacked(mixing.mixed_documents(packed(docs, needed)), docs, needed)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return mixed


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding gives the text back."""
    import public_tokenizers

    prepare(spark)
    return piece_lattice.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("piece_ids", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
