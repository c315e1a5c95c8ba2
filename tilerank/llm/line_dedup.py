"""Line deduplication over overlapping windows of three lines.

A document's lines are its text cut at ``\\n``. Every window of three consecutive lines gets a 128-bit hash (windows of blank lines
only take no part). Of the windows with one hash the first by (doc_id, text hash, line) stays; every other one covers its three
lines. Covered lines, merged over overlapping windows, are removed; the first occurrence's lines stay, unless another window covers them.

Plan: only hashes travel. Counts per hash are combined before the shuffle; windows meet their hash's row by ``join_counted``, so that a
line block of a third of all rows is not one task; the covered lines come back per document, where a text's own lines bound them.

Defined cases: null text stays null with no line; an empty text is one empty line; texts of one or two lines have no window and stay
whole; rows with one doc_id are told apart by their text, and rows equal in both are one occurrence (all of them keep or lose the same
lines); a null doc_id comes first; an empty table gives an empty result. ``line_dedup`` keeps all other columns of its input.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, lean, stage, text_slices

WINDOW = 3
SLICE_BYTES = 4 << 20


def line_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pos, h) of every window; ``th`` tells texts of one doc_id apart, ``h`` is the window's md5."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"), F.split("text", "\n").alias("ls")).where(F.size("ls") >= WINDOW)
    windows = lines.select(
        "doc_id",
        "th",
        F.posexplode(
            F.expr(
                f"transform(sequence(1, size(ls) - {WINDOW - 1}), i -> CASE WHEN exists(slice(ls, i, {WINDOW}), x -> trim(x) <> '') "
                f"THEN unhex(md5(concat_ws('\n', slice(ls, i, {WINDOW})))) END)"
            )
        ).alias("pos", "h"),
    )
    return windows.where(F.col("h").isNotNull())


def covered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, at): sorted starts of the windows that cover lines to remove, per document that has any."""
    w = stage(line_windows(docs), "line-windows")
    place = F.struct(F.col("doc_id"), F.col("th"), F.col("pos"))
    firsts = stage(w.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "line-firsts")
    later = join_counted(w, firsts, ["h"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("at"))


def keep_lines(text: str, at: list[int]) -> tuple[str, int, int]:
    """(text without the covered lines, lines removed, runs removed)."""
    lines, gone, spans, end = text.split("\n"), set(), 0, -1
    for i in at:
        spans += i > end
        gone.update(range(i, i + WINDOW))
        end = i + WINDOW
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone), spans


def _rebuild(batches):
    for b in text_slices(batches, "text", SLICE_BYTES):
        rows = []
        for text, at in zip(b.column("text").to_pylist(), b.column("at").to_pylist()):
            rows.append((text, 0, 0) if text is None or not at else keep_lines(text, at))
        n_lines = [0 if t is None else t.count("\n") + 1 for t in b.column("text").to_pylist()]
        kept, removed, spans = zip(*rows)
        names = [n for n in b.schema.names if n not in ("text", "at")]
        new = [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
        yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + new, names=[*names, "text", "n_lines", "n_removed", "n_spans"])


def line_dedup(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``extra``, ``text`` without removed lines, ``n_lines`` (before), ``n_removed`` and ``n_spans`` (runs of lines)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    at = covered_lines(base.select("doc_id", "text"))
    keyed = base.withColumn("th", F.xxhash64("text"))
    hit = keyed.alias("b").join(at.alias("a"), F.col("b.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("b.th") == F.col("a.th")), "left")
    rows = hit.select("b.doc_id", *(F.col(f"b.{c}") for c in extra), F.col("b.text").alias("text"), F.col("a.at").alias("at"))
    kinds = dict(base.dtypes)
    schema = ", ".join(["doc_id long", *(f"`{c}` {kinds[c]}" for c in extra), "text string, n_lines long, n_removed long, n_spans long"])
    return rows.mapInArrow(lean(_rebuild), schema)


ORACLE = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
g AS (SELECT doc_id, text, ls, unnest(range(1, len(ls) - 1)) AS i FROM l WHERE len(ls) >= 3),
w AS (SELECT doc_id, text, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS x FROM g
      WHERE trim(ls[i], ' ') <> '' OR trim(ls[i + 1], ' ') <> '' OR trim(ls[i + 2], ' ') <> ''),
o AS (SELECT doc_id, text, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k FROM w),
c AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM o WHERE k > 1),
s AS (SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN i = p + 1 THEN 0 ELSE 1 END) AS n_spans
      FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -9) AS p FROM c) GROUP BY doc_id),
a AS (SELECT doc_id, unnest(ls) AS x, unnest(range(1, len(ls) + 1)) AS i FROM l),
k AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS text FROM a ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT l.doc_id, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, CAST(coalesce(len(l.ls), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM l LEFT JOIN s USING (doc_id) LEFT JOIN k USING (doc_id)
"""
