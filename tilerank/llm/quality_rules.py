"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one ``long`` whose bit *b* says that
rule *b* failed. A policy is a named, versioned mask of bits; applying one, or asking what a policy would keep without one of
its rules, is bit arithmetic on the ledger and never reads the texts again.

Measurements (words are runs of characters other than space and U+0009..U+000D; null text: no words):
``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_lines`` (lines with a word),
``n_dup_lines`` (such lines equal to an earlier one), ``n_repeat_words`` (words inside a 3-word window that the text holds
twice or more, first included), ``n_upper_words`` (words with a letter A-Z and none of a-z).

Defined cases: null and empty texts have zero everywhere and fail ``few_words``; repeated rows give repeated ledger rows; a null
doc_id stays null; other columns of the input are ignored, whatever their names; an empty table gives an empty ledger.
Each task holds a slice of at most ``SLICE_BYTES`` of text (or one longer text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices, window_hashes, word_hashes

SLICE_BYTES = 4 << 20
SYMBOLS = "#*$%&|<>"
WHITE = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words")

#: Rules in bit order: name -> condition for failure on the measurements (integer arithmetic, so that any engine agrees).
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "shouting": "100 * n_upper_words > 50 * n_words",
}

#: Policies by version: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": tuple(RULES),
}


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def measure_text(text: str | None) -> tuple[int, ...]:
    """Measurements of one text, in the order of ``MEASURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly the six ASCII white-space characters
    n = len(words)
    word_chars = len(text or "") - sum(raw.count(s) for s in WHITE)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeat = 0
    if n >= 3:
        w = window_hashes(word_hashes(words), 3)
        _, inverse, counts = np.unique(w, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(counts[inverse] > 1)
        covered = np.zeros(n, bool)
        for j in range(3):
            covered[hit + j] = True
        repeat = int(covered.sum())
    upper = sum(map(bytes.isupper, words))
    return n, word_chars, sum(raw.count(s.encode()) for s in SYMBOLS), len(lines), len(lines) - len(set(lines)), repeat, upper


def _measure(batches):
    for b in text_slices(batches, "text", SLICE_BYTES):
        cols = list(zip(*(measure_text(t) for t in b.column("text").to_pylist())))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", *MEASURES]
        )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the measurements and ``fail_bits``."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure, schema)
    bits = " | ".join(f"(CASE WHEN {c} THEN {1 << i}L ELSE 0L END)" for i, c in enumerate(RULES.values()))
    return measured.withColumn("fail_bits", F.expr(bits))


def passes(policy: str) -> Column:
    """Does the policy keep the ledger row?"""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of ``policy``: documents that fail it, that fail it alone, and what is kept without it.

    The ledger is first counted by ``fail_bits`` (2^rules rows at most, combined before the shuffle).
    """
    mask = mask_of(POLICIES[policy])
    by_bits = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask_of((r,))).cast("long").alias("bit")) for r in POLICIES[policy]))
    per = by_bits.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    one = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return per.groupBy("rule").agg(
        one(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        one(F.col("bits") == F.col("bit")).alias("n_failed_alone"),
        one(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: measurements, ``base_failed`` and ``kept`` (policies ``base-1`` and ``full-1``)."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base-1")).alias("base_failed"), passes("full-1").alias("kept"), "fail_bits",
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
             doc_id, t FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i FROM w),
k AS (SELECT g.r, g.i, ws[g.i] || ' ' || ws[g.i + 1] || ' ' || ws[g.i + 2] AS x FROM g JOIN w USING (r)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM k),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words
      FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
             + CASE WHEN 10 * n_symbols > 2 * n_words THEN 16 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
             + CASE WHEN 100 * n_upper_words > 50 * n_words THEN 64 ELSE 0 END AS fail_bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits FROM f
"""
