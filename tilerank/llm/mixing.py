"""Mixing sources to target weights with a low-discrepancy schedule.

Sizes are words (runs of characters other than space and U+0009..U+000D). Sources in code-point order, null last, weigh 3, 1, 2, repeating,
and share ``SHARE`` of all words; a target stops at ``EPOCHS`` times its source's words and the excess is shared again by weight until none
is above. Each source's documents, shuffled by a keyed hash, form an endless stream that starts over after its last word; the mix
takes the first ``floor(target)`` words of it, cut into blocks of ``BLOCK`` words (the last one shorter).

Schedule: with ``M`` blocks in all and ``2^k >= M``, slot ``i`` has the van der Corput point ``reverse_k(i) / 2^k``. The cumulated block
counts of the sources cut ``[0, M / 2^k)`` into one interval per source; a slot belongs to the source its point falls into, points
beyond are skipped. So a source gets exactly its blocks, spread evenly over the mix. The rank of a slot among its source's slots names the
block it takes: ranks come from counts per chunk of ``CHUNK`` slots plus a window inside the chunk, no source is one task.
Stream positions come the same way, from sums per (source, bucket) and a window inside the bucket.

Defined cases: null and empty texts have size 0 and are never taken; equal rows are separate documents; sources without a word have target
0; an empty table gives no rows; other columns are ignored. Everything is a function of the rows, so reruns agree.
"""

from __future__ import annotations

import itertools
import re
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, stage, text_slices

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
EPOCHS = 2
BLOCK = 128
CHUNK = 1 << 14
BUCKET_ROWS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[int], share: Fraction = SHARE, epochs: int = EPOCHS) -> list[Fraction]:
    """Exact targets: shares of ``share * sum(sizes)`` by weight, stopped at ``epochs`` times the size, the excess reshared."""
    total, out = share * sum(sizes), [Fraction(0)] * len(sizes)
    open_ = [i for i in range(len(sizes))]
    left = Fraction(total)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w > epochs * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = Fraction(epochs * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sized(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("text")).alias("h"),
        *extra,
    )


def source_targets(rows: DataFrame) -> DataFrame:
    """(source, sid, source_size, target, take, n_docs): one row per source, few enough for the driver (checked)."""
    spark = rows.sparkSession
    per = rows.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them first")
    per.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # Python orders strings by code point
    t = targets([r["s"] for r in per], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(per))])
    out = [(r["source"], i, r["s"], float(x), int(x), r["n"]) for i, (r, x) in enumerate(zip(per, t))]
    return spark.createDataFrame(out, "source string, sid int, source_size long, target double, take long, n_docs long")


MAX_SOURCES = 100_000


def streamed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``sid, source_size, target, take`` and ``p``, the document's place in its source's stream, and ``rn``, unique per row in (sid, bucket)."""
    r = rows.alias("r").join(F.broadcast(sources).alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    r = r.select("r.*", "sid", "source_size", "target", "take", "n_docs")
    r = r.withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 8), F.ceil(F.col("n_docs") / BUCKET_ROWS))).drop("n_docs")
    per = r.groupBy("sid", "bucket").agg(F.sum("size").alias("b"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("sid", "bucket", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("p0"))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size")
    r = r.withColumn("rn", F.row_number().over(inside)).withColumn("pi", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return r.join(per, ["sid", "bucket"]).withColumn("p", F.col("p0") + F.col("pi")).drop("p0", "pi")


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix's slots: (slot, sid, block): slot order is mix order; ``block`` counts the source's blocks from 0."""
    spark = sources.sparkSession
    counts = [(r["sid"], -(-r["take"] // block)) for r in sources.orderBy("sid").collect()]
    m = sum(c for _, c in counts)
    k = max(1, (m - 1).bit_length())
    edges, at = [], 0
    for sid, c in counts:
        if c:
            edges.append((sid, at, at + c))
        at += c
    cut = spark.createDataFrame(edges or [(-1, 0, 0)], "sid int, lo long, hi long")
    n = 1 << k
    i = spark.range(0, n, 1, max(1, min(n >> 16, 4096)))
    point = F.expr(f"CAST(conv(substring(reverse(lpad(conv(id, 10, 2), {k}, '0')), 1, {k}), 2, 10) AS BIGINT)")
    slots = i.select(F.col("id").alias("slot"), point.alias("v")).where(F.col("v") < m)
    slots = _owner(slots, cut, edges)
    chunk = F.shiftright(F.col("slot"), CHUNK.bit_length() - 1)
    slots = slots.withColumn("chunk", chunk)
    per = slots.groupBy("sid", "chunk").agg(F.count("*").alias("c"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("sid", "chunk", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("r0"))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = slots.withColumn("r", F.row_number().over(inside) - 1).join(per, ["sid", "chunk"])
    return ranked.select("slot", "sid", (F.col("r0") + F.col("r")).alias("block"))


def _owner(slots: DataFrame, cut: DataFrame, edges: list[tuple]) -> DataFrame:
    """The source whose interval holds the point, by binary search in the sorted upper bounds (one literal array)."""
    his = F.array(*(F.lit(e[2]).cast("long") for e in edges)) if edges else F.array(F.lit(0).cast("long"))
    sids = F.array(*(F.lit(e[0]) for e in edges)) if edges else F.array(F.lit(-1))
    steps = max(1, len(edges).bit_length())
    bounded = slots.withColumn("his", his).withColumn("sids", sids)
    search = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("a"), F.lit(max(0, len(edges) - 1)).alias("b")),
        lambda s, _: F.when(s["a"] >= s["b"], s).otherwise(
            F.when(F.col("v") < F.get("his", F.floor((s["a"] + s["b"]) / 2).cast("int")), F.struct(s["a"].alias("a"), F.floor((s["a"] + s["b"]) / 2).cast("int").alias("b")))
            .otherwise(F.struct((F.floor((s["a"] + s["b"]) / 2).cast("int") + 1).alias("a"), s["b"].alias("b")))
        ),
    )
    return bounded.select("slot", F.get("sids", search["a"]).alias("sid"))


def pieces(placed: DataFrame, keep: list[str], block: int = BLOCK) -> DataFrame:
    """A row per (document, epoch, block) with ``words``, the document's words in that block of its source's stream, from word ``first`` of it.

    A document without words has one row with a null block.
    """
    epochs = F.explode(F.array(*(F.lit(e) for e in range(EPOCHS))))
    e = placed.withColumn("epoch", epochs).withColumn("lo", F.col("p") + F.col("epoch") * F.col("source_size")).withColumn("hi", F.col("lo") + F.col("size"))
    b = F.explode_outer(F.expr(f"CASE WHEN size > 0 THEN sequence(lo div {block}, (hi - 1) div {block}) END"))
    x = e.withColumn("block", b)
    start, end = F.greatest("lo", F.col("block") * block), F.least("hi", (F.col("block") + 1) * block, "take")
    return x.select(*keep, "epoch", "block", (start - F.col("lo")).alias("first"), F.greatest(end - start, F.lit(0)).alias("words"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as rows (slot, sid, block, doc_id, epoch, first, words): ordered by slot, then place in the block."""
    rows = stage(sized(docs), "mix-sizes")
    sources = source_targets(rows)
    got = pieces(streamed(rows, sources), ["sid", "bucket", "rn", "doc_id"], block)
    return got.where("words > 0").join(schedule(sources, block), ["sid", "block"]).select("slot", "sid", "block", "doc_id", "bucket", "rn", "epoch", "first", "words")


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The contract's digest: doc_id, size, source_size, target and ``taken``, the words that the scheduled blocks take of each document."""
    rows = stage(sized(docs), "mix-sizes")
    sources = source_targets(rows)
    keys = ["sid", "bucket", "rn", "doc_id", "size"]
    got = pieces(streamed(rows, sources), keys, block)
    hit = got.join(schedule(sources, block).select("sid", "block", F.lit(1).alias("on")), ["sid", "block"], "left")
    per = hit.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("on") == 1, F.col("words"))), F.lit(0)).alias("taken"))
    out = per.join(F.broadcast(sources.select("sid", "source", "source_size", "target")), "sid")
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def row_id(docs: DataFrame) -> DataFrame:
    """Adds ``rid``: doc_id and text as one key, never null; equal rows share it."""
    return docs.withColumn("rid", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce(F.md5("text"), F.lit("none"))))


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents: a row per document and epoch that the scheduled blocks take words of, all columns kept, ``text`` cut to the words taken.

    Placing and counting run on sizes only; texts are joined once, by ``rid``.
    """
    cols = docs.columns
    rows = stage(sized(row_id(docs), ("rid",)), "mix-sizes")
    sources = source_targets(rows)
    keys = ["sid", "bucket", "rn", "rid", "size"]
    got = pieces(streamed(rows, sources), keys, block).where("words > 0")
    hit = got.join(schedule(sources, block).select("sid", "block"), ["sid", "block"])
    per = hit.groupBy(*keys, "epoch").agg(F.sum("words").alias("w")).groupBy("rid").agg(F.collect_list(F.struct("w", "size")).alias("takes"))
    joined = row_id(docs).join(per.hint("merge"), "rid").groupBy("rid").agg(F.first(F.struct(*cols)).alias("d"), F.first("takes").alias("takes"))
    out = joined.select("d.*", F.explode("takes").alias("take")).select(*cols, "take.w", "take.size")

    def cut(batches):
        for b in text_slices(batches, "text", 8 << 20):
            texts = [t if w >= n else first_words(t, w) for t, w, n in zip(b.column("text").to_pylist(), b.column("w").to_pylist(), b.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in cols], names=cols)

    return out.mapInArrow(lean(cut), docs.schema)


def first_words(text: str, n: int) -> str:
    """``text`` up to the end of its ``n``-th word."""
    at = 0
    for m in itertools.islice(re.finditer(WORD, text), n):
        at = m.end()
    return text[:at]
