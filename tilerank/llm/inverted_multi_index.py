"""Nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised apart, each with its own k-means codebook of up to ``CODES`` centroids, fitted on a hash sample of at most
``SAMPLE`` rows. Every row is indexed in the cell of its two centroids. A query walks the pairs of centroids by rising sum of
distances with a heap (the multi-sequence walk) until the cells passed hold the share of rows that reached ``AIM`` of the exact neighbours
in a calibration on the sample, and at least ``k`` rows; the entries of those cells are ranked by their exact distance.

Why a share: it follows the data (well clustered vectors need little, vectors without structure need much), and it is measured, not set.

Plan: entries are dealt by (first centroid, block); a block holds about ``BLOCK`` rows, so a centroid with a third of all rows is many
blocks, and a query's row goes to every block of the first centroids it visits, with the second centroids it visits there. Queries
are dealt in chunks of about ``QUERIES`` per block group. A task compares one block with one chunk and returns ``k`` rows per query at
most; those are ranked per query at last.

Defined cases: vectors that are null, all zero, of another length than the most common one, or that hold nulls or non-finite values take no part, nor do null
ids; rows with one vec_id count as one, the smallest vector; ties go to the smaller vec_id; with fewer than ``k`` other rows all are
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

K = 10
CODES = 64
SAMPLE = 16_384
AIM = 0.97
CALIBRATE = 256
BLOCK = 8192
QUERIES = 1024
RESULT = "query_id long, vec_id long, score double"


def valid_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec double[]) of the rows that take part, one per id."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).where("vec_id IS NOT NULL AND size(vec) > 0")
    v = v.where(F.expr("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x <> 0)"))
    dim = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dim:
        return v
    return v.where(F.size("vec") == dim[0]["d"]).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        a = codes_of(x, c)
        n = np.bincount(a, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, a, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)[None], 0)


def codes_of(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return squares(x, c).argmin(1)


def walk(d1: np.ndarray, d2: np.ndarray):
    """Pairs (i, j) by rising ``d1[i] + d2[j]``: a heap over the frontier of the two sorted lists."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b = d1[o1], d2[o2]
    heap, next_row = [(a[0] + b[0], 0, 0)], [0] * len(a)
    while heap:
        _, r, c = heapq.heappop(heap)
        yield int(o1[r]), int(o2[c])
        next_row[r] = c + 1
        if c + 1 < len(b):
            heapq.heappush(heap, (a[r] + b[c + 1], r, c + 1))
        if c == 0 and r + 1 < len(a):
            heapq.heappush(heap, (a[r + 1] + b[0], r + 1, 0))


class MultiIndex:
    """Codebooks, rows per cell and the share of rows a query visits."""

    def __init__(self, sample: np.ndarray, k: int = K, codes: int = CODES):
        self.half, self.k = sample.shape[1] // 2, k
        n = max(1, min(codes, len(sample) // 8))
        self.c1, self.c2 = kmeans(sample[:, : self.half], n), kmeans(sample[:, self.half :], n)
        self.share = self._calibrate(sample)
        self.cells = None

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squares(x[:, : self.half], self.c1), squares(x[:, self.half :], self.c2)

    def _calibrate(self, s: np.ndarray) -> float:
        """Share of the sample that a walk must pass to meet ``AIM`` of the exact neighbours of some sample rows."""
        if len(s) <= 2 * self.k + 2:
            return 1.0
        q = np.arange(min(CALIBRATE, len(s)))
        d = squares(s[q], s)
        d[q, q] = np.inf
        near = np.argsort(d, 1)[:, : self.k]
        d1, d2 = self.distances(s)
        cell = d1.argmin(1) * len(self.c2) + d2.argmin(1)
        n = np.bincount(cell, minlength=len(self.c1) * len(self.c2))
        order = np.argsort((d1[q][:, :, None] + d2[q][:, None, :]).reshape(len(q), -1), 1, kind="stable")
        before = np.empty(order.shape)
        np.put_along_axis(before, order, np.cumsum(n[order], 1), 1)
        need = np.take_along_axis(before, cell[near], 1).ravel() / len(s)
        return float(min(1.0, np.quantile(need, AIM)))

    def visit(self, vec: np.ndarray) -> dict[int, list[int]]:
        """First centroid -> second centroids of the cells that a query visits."""
        d1, d2 = self.distances(vec[None])
        want, got, out = max(self.share * self.cells.sum(), 2 * self.k + 1), 0, {}
        for i, j in walk(d1[0], d2[0]):
            n = self.cells[i, j]
            if n:
                out.setdefault(i, []).append(j)
                got += n
                if got >= want:
                    break
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(x), -1)


def search(index_rows: DataFrame, query_rows: DataFrame, k: int = K) -> DataFrame:
    """``query_rows`` (vec_id, vec) against all ``index_rows`` (vec_id, vec), as ``valid_vectors`` returns them."""
    spark = index_rows.sparkSession
    entries0 = stage(index_rows, "imi-vectors")
    n = entries0.count()
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    slots = 1 << 20
    keep = min(1.0, 1.2 * SAMPLE / n)
    sample = entries0.where(F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(slots)) <= int(keep * slots)).orderBy(F.xxhash64(F.lit("fit"), "vec_id")).limit(SAMPLE)
    index = MultiIndex(_matrix(sample.select("vec").toArrow().column(0)), k)

    def assign(batches):
        for b in batches:
            if b.num_rows:
                d1, d2 = index.distances(_matrix(b.column("vec")))
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vec"), pa.array(d1.argmin(1), pa.int32()), pa.array(d2.argmin(1), pa.int32())], names=["vec_id", "vec", "c1", "c2"])

    entries = stage(entries0.mapInArrow(assign, "vec_id long, vec array<double>, c1 int, c2 int"), "imi-entries")
    cells = entries.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect()  # CODES^2 rows at most
    index.cells = np.zeros((len(index.c1), len(index.c2)), np.int64)
    for r in cells:
        index.cells[r["c1"], r["c2"]] = r["n"]
    blocks = [int(x) for x in -(-index.cells.sum(1) // BLOCK)]
    queries = stage(query_rows, "imi-queries")
    chunks = max(1, -(-queries.count() // QUERIES))

    def probe(batches):
        for b in batches:
            rows = []
            for q, v in zip(b.column("vec_id").to_pylist(), _matrix(b.column("vec")) if b.num_rows else []):
                for c1, c2s in index.visit(v).items():
                    rows += [(q, v.tolist(), c1, blk, c2s) for blk in range(blocks[c1])]
                if len(rows) > 5000:
                    yield _probes(rows)
                    rows = []
            if rows:
                yield _probes(rows)

    def _probes(rows):
        q, v, c1, blk, c2s = zip(*rows)
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((q, v, c1, blk, c2s), kinds)], names=["query_id", "vec", "c1", "blk", "c2s"])

    probes = queries.mapInArrow(probe, "query_id long, vec array<double>, c1 int, blk int, c2s array<int>")
    probes = probes.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    n_blocks = F.element_at(F.array(*(F.lit(max(1, x)) for x in blocks)), F.col("c1") + 1)
    dealt = entries.withColumn("blk", F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            x, ids, c2 = _matrix(right.column("vec")), right.column("vec_id").to_numpy(), right.column("c2").to_numpy()
            sq = (x**2).sum(1)
            for q, v, c2s in zip(left.column("query_id").to_pylist(), _matrix(left.column("vec")), left.column("c2s").to_pylist()):
                seen = np.zeros(len(index.c2), bool)
                seen[c2s] = True
                at = np.flatnonzero(seen[c2] & (ids != q))
                if len(at) == 0:
                    continue
                rough = sq[at] - 2 * (x[at] @ v)
                if len(at) > k:  # all that can be among the nearest, ties included
                    cut = np.partition(rough, k - 1)[k - 1]
                    at = at[rough <= cut + 1e-9 * (1 + abs(cut) + (v**2).sum())]
                d = np.sqrt(((x[at] - v) ** 2).sum(1))
                best = np.lexsort((ids[at], d))[:k]
                out[0].extend([q] * len(best))
                out[1].extend(ids[at][best].tolist())
                out[2].extend(d[best].tolist())
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    key = ["c1", "blk", "chunk"]
    found = probes.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(rerank, RESULT)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
