"""URL filter: host and path rules, and gradient-boosted trees on lexical features for what no rule covers.

All native: expressions, aggregations and Spark ML's trees. The rules label the URLs they fit; trees trained on those labels give the verdict of
the rest. ``suffix statistics`` are counts over all URLs of the host's last label and last two labels, hashed to ``SUFFIX_BUCKETS``
buckets so that their table has a fixed bound and can be broadcast.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and gets the trees' verdict on its
features (a null counts as the empty string); empty hosts fit no rule; repeated rows are judged each; with labels of one
class only, that class is the verdict, with none at all it is ``allow``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: (verdict, host, path): the longest that fits wins. Fixed values of the filter list.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: URLs that train the trees at most, chosen by hash among the labelled ones.
TRAIN_ROWS = 50_000
TREES, DEPTH, SEED = 20, 4, 7
SUFFIX_BUCKETS = 4096

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column) -> Column:
    """Text of the longest rule that fits, else null. Rules are tried from the longest on."""
    out = F.lit(None).cast("string")
    for _, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p)).otherwise(out)
    return out


def rule_verdict(rule: Column) -> Column:
    out = F.lit(None).cast("string")
    for v, h, p in RULES:
        out = F.when(rule == h + p, F.lit(v)).otherwise(out)
    return out


def _entropy(s: Column) -> Column:
    """Shannon entropy in bits of the characters of ``s``."""
    n = F.greatest(F.length(s), F.lit(1)).cast("double")
    chars = F.filter(F.array_distinct(F.split(s, "")), lambda c: c != "")
    part = F.transform(chars, lambda c: (F.length(s) - F.length(F.replace(s, c, F.lit("")))) / n)
    return F.aggregate(part, F.lit(0.0), lambda a, p: a - p * F.log2(p))


FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_labels", "f_depth", "f_params", "f_digits", "f_path_digits", "f_letters", "f_hyphens",
    "f_upper", "f_entropy", "f_last_length", "f_fragment", "f_https", "f_suffix1", "f_suffix2",
)


def lexical(pages: DataFrame) -> DataFrame:
    """page_id, url parts, rule and the features but the suffix counts."""
    u = F.coalesce(F.col("url"), F.lit(""))
    p = pages.select("page_id", u.alias("u"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.withColumn("rule", rule_of(F.col("host"), F.col("path")))
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    length = lambda c: F.length(c).cast("double")
    share = lambda c, pattern: count(c, pattern) / F.greatest(length(c), F.lit(1.0))
    query = F.regexp_extract("u", r"\?([^#]*)", 1)
    u, h, t = F.col("u"), F.col("host"), F.col("path")
    bucket = lambda n: F.pmod(F.crc32(F.substring_index(h, ".", -n).cast("binary")), F.lit(SUFFIX_BUCKETS)).cast("int")
    return p.select(
        "page_id", "host", "path", "rule", bucket(1).alias("s1"), bucket(2).alias("s2"),
        length(u).alias("f_length"), length(h).alias("f_host_length"), length(t).alias("f_path_length"),
        count(h, r"\.").alias("f_labels"), count(t, "/").alias("f_depth"),
        (count(query, "&") + (query != "").cast("double")).alias("f_params"), share(u, "[0-9]").alias("f_digits"), share(t, "[0-9]").alias("f_path_digits"),
        share(u, "[A-Za-z]").alias("f_letters"), count(u, "-").alias("f_hyphens"), share(u, "[A-Z]").alias("f_upper"), _entropy(u).alias("f_entropy"),
        length(F.substring_index(t, "/", -1)).alias("f_last_length"), u.contains("#").cast("double").alias("f_fragment"), u.startswith("https:").cast("double").alias("f_https"),
    )


def with_suffixes(lex: DataFrame) -> DataFrame:
    """Adds the suffix statistics: log counts of the host's last label and last two labels over all rows."""
    for s, f in (("s1", "f_suffix1"), ("s2", "f_suffix2")):
        per = lex.groupBy(s).agg(F.log1p(F.count("*")).alias(f))  # SUFFIX_BUCKETS rows at most
        lex = lex.join(F.broadcast(per), s)
    return lex


def judge(pages: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and ``p_block`` (the trees' probability of ``block``; null where there are no trees)."""
    rows = with_suffixes(stage(lexical(pages), "url-features"))
    labelled = rows.where(F.col("rule").isNotNull()).withColumn("label", (rule_verdict(F.col("rule")) == "block").cast("double"))
    seen = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        verdict, p = F.lit("block" if 1.0 in seen else "allow"), F.lit(None).cast("double")
        return rows.select("page_id", "host", "path", "rule", F.coalesce(rule_verdict(F.col("rule")), verdict).alias("verdict"), p.alias("p_block"))
    keep = min(1.0, train_rows / sum(seen.values()))
    chosen = labelled.where(F.pmod(F.xxhash64(F.lit("train"), "page_id", "host", "path"), F.lit(1 << 20)) < int(keep * (1 << 20)) + (keep == 1.0))
    to_vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = stage(to_vector.transform(chosen).select("features", "label"), "url-train").coalesce(2)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=SEED).fit(train)
    scored = model.transform(to_vector.transform(rows)).withColumn("p_block", vector_to_array("probability")[1])
    own = F.when(F.col("p_block") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce(rule_verdict(F.col("rule")), own).alias("verdict"), "p_block")
