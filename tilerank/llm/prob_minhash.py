"""Near-duplicates by ProbMinHash: probability Jaccard of weighted five-word shingles, banding, verification.

A text's shingles are its runs of ``SHINGLE`` words (runs of characters other than space and U+0009..U+000D; a shorter text is one
shingle), weighted by how often they occur. Every shingle is a Poisson process of arrivals at rate *weight*; an arrival hits a random
register, and each of the ``REGISTERS`` registers keeps the shingle of its first arrival. Shingles stop as soon as their next arrival is
later than the latest first arrival of any register (early termination). Two texts agree in a register with the probability Jaccard of their
weighted shingles, J_P = sum over common x of 1 / sum over y of max(p_y / p_x, q_y / q_x); for texts without repeated shingles this is the
ordinary Jaccard. ``BANDS`` bands of ``ROWS`` registers make candidates: a pair of J_P 0.8 is missed with probability 3e-6.

Plan. Equal texts collapse to one node first (counts are combined before the shuffle). In every bucket each node is paired with the bucket's
first node, its leader, only; these pairs are verified by their exact J_P on the whole texts, and their links make components. A leader's group (the
nodes it was paired with) whose nodes lie in several components is then compared in blocks of ``BLOCK`` nodes, pairs within one component
left out: what leaves a task are links that join components, never the pairs. So every pair of nodes in one bucket is either in one component or has been
verified, a group of mutual copies costs one comparison per copy, and no task holds more than two blocks. Nodes are keyed by their text's
md5, so texts are joined, never collected.

Every pair is judged without rounding: J_P of exactly 0.8 is a link, in the star check as in the blocks.

Defined cases: null texts and texts without a word are alone in their class (class id: the own doc_id); equal texts are one class; repeated doc_ids are separate rows; the
class id is the smallest doc_id of the class (null if it has none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import give_back, join_counted, lean, mix64, stage, text_slices, window_hashes, word_hashes

SHINGLE = 5
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
THRESHOLD = 0.8
#: Rounding of a sum of parts is far below this; closer to the threshold the sum is taken without rounding.
NEAR = 1e-9
SLICE_BYTES = 2 << 20
#: Nodes per block of a group's comparison.
BLOCK = 512
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(words: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the distinct shingles of a text given by its word hashes."""
    if len(words) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(window_hashes(words, min(k, len(words))), return_counts=True)


def text_shingles(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    h = word_hashes([w for ws in split for w in ws])
    out, at = [], 0
    for ws in split:
        out.append(shingles_of(h[at : at + len(ws)]))
        at += len(ws)
    return out


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (n x m) of weighted sets; all of them advance together, one arrival per live element and round.

    Arrival i of element x comes Exp(weight) after the one before; gap and register are hashes of (x, i), so that an element behaves alike in
    every set. An empty set has zeros.
    """
    n = len(sets)
    first, owner = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    x = np.concatenate([s for s, _ in sets]) if n else np.empty(0, np.uint64)
    rate = np.concatenate([c for _, c in sets]).astype(float) if n else np.empty(0)
    row = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    at, i = np.zeros(len(x)), 0
    while len(x):
        draw = mix64(x + np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log(_uniform(draw)) / rate
        slot = row * m + (mix64(draw + GOLDEN) % np.uint64(m)).astype(np.int64)
        better = np.flatnonzero(at < first[slot])
        if len(better):
            late_first = better[np.argsort(-at[better], kind="stable")]  # the earliest arrival is written last
            first[slot[late_first]], owner[slot[late_first]] = at[late_first], x[late_first]
        live = at < first.reshape(n, m).max(1)[row]
        x, rate, row, at, i = x[live], rate[live], row[live], at[live], i + 1
    return owner.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(n x bands) 64-bit bucket ids; the band's number is part of the hash."""
    r = sig.shape[1] // bands
    out = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN), (len(sig), bands)).copy()
    for j in range(r):
        out = mix64(out * GOLDEN + sig[:, j::r][:, :bands])
    return out


def _parts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers (above, below): J_P of two weighted sets (sorted hashes, counts) is the sum of above / below.

    J_P does not change with the scale of a set, so counts p, q stand for the shares. For common x the denominator is sum over y of
    max(p_y / p_x, q_y / q_x); over the ratio r_y = p_y / q_y sorted, the maximum is the first term where r_y >= r_x and the second elsewhere, so
    prefix sums P, Q give 1 / (P / p_x + Q / q_x) for all x in one pass. Shingles of one ratio u / v (lowest terms) are one part,
    sum of p_x / u * u * v / (P v + Q u); texts without repeated shingles have the one part |common| / |union|. All fit 64 bits below 2^31 words.
    """
    (xa, ca), (xb, cb) = a, b
    none = np.empty(0, np.int64)
    if not len(xa) or not len(xb):
        return none, none
    total_a, total_b = int(ca.sum()), int(cb.sum())
    if total_a == len(xa) and total_b == len(xb):
        n = len(np.intersect1d(xa, xb, assume_unique=True))
        return np.array([n]), np.array([len(xa) + len(xb) - n])
    common, ia, ib = np.intersect1d(xa, xb, assume_unique=True, return_indices=True)
    if not len(common):
        return none, none
    p, q = ca[ia].astype(np.int64), cb[ib].astype(np.int64)
    k = np.gcd(p, q)
    order = np.lexsort((p // k, p / q))
    p, q, k = p[order], q[order], k[order]
    u, v = p // k, q // k
    start = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
    u, v, p, q, k = u[start], v[start], np.add.reduceat(p, start), np.add.reduceat(q, start), np.add.reduceat(k, start)
    p_above = total_a - np.cumsum(p) + p  # ratios not below the own one, and what only a has
    q_below = total_b - q.sum() + np.cumsum(q) - q
    return k * u * v, p_above * v + q_below * u


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets as a float; ``similar`` decides without rounding."""
    above, below = _parts(a, b)
    return float((above / below).sum())


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> bool:
    """J_P >= threshold (the decimal that it is written as). Near it the parts are summed as whole fractions, halves by halves."""
    above, below = _parts(a, b)
    near = float((above / below).sum()) - threshold
    if abs(near) > NEAR:
        return near > 0
    parts = list(zip(above.tolist(), below.tolist()))
    while len(parts) > 1:
        odd = parts[len(parts) // 2 * 2 :]
        parts = [(n * e + m * d, d * e) for (n, d), (m, e) in zip(parts[::2], parts[1::2])] + odd
    t = Fraction(str(threshold))
    return bool(parts) and t.denominator * parts[0][0] >= t.numerator * parts[0][1]


def block_links(sets: list[tuple[np.ndarray, np.ndarray]], comp: list, side: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Links of J_P >= threshold that join different components, between sets of side 0 and 1 (of one side, if there is no other).

    Texts without repeated shingles have J_P = |common| / |union| from one matrix product of the shingles that occur twice or more; other pairs are
    verified one by one if the common support allows the threshold (J_P <= the smaller mass of the common shingles).
    """
    n = len(sets)
    flat = np.concatenate([x for x, _ in sets])
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    doc = np.repeat(np.arange(n), [len(x) for x, _ in sets])
    shared = counts[inverse] > 1
    support = np.zeros((n, int((counts > 1).sum())), np.float32)
    support[doc[shared], column[inverse[shared]]] = 1
    mass = np.zeros_like(support)
    share = np.concatenate([c / c.sum() for _, c in sets])
    mass[doc[shared], column[inverse[shared]]] = share[shared]
    size = np.array([len(x) for x, _ in sets], float)
    plain = np.array([bool((c == 1).all()) for _, c in sets])
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    inter = support[left] @ support[right].T
    union = size[left][:, None] + size[right][None] - inter
    both_plain = plain[left][:, None] & plain[right][None]
    sure = both_plain & (inter >= threshold * union - 1e-3)  # settled in whole numbers below
    maybe = ~both_plain & (mass[left] @ support[right].T >= threshold - 1e-4) & ((support[left] @ mass[right].T) >= threshold - 1e-4)
    limit = Fraction(str(threshold))
    root = {c: c for c in comp}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in np.argwhere(sure | maybe):
        a, b = int(left[i]), int(right[j])
        ra, rb = find(comp[a]), find(comp[b])
        if a == b or ra == rb:
            continue
        whole = both_plain[i, j] and limit.denominator * round(float(inter[i, j])) >= limit.numerator * round(float(union[i, j]))
        if whole or not both_plain[i, j] and similar(sets[a], sets[b], threshold):
            root[ra] = rb
            out.append((a, b))
    return out


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands): ``key`` is the text's md5, null where it has no word; ``bands`` its bucket ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("key"), F.col("text").cast("string").alias("text"))

    def emit(batches):
        for b in text_slices(batches, "text", SLICE_BYTES):
            sets = text_shingles(b.column("text").to_pylist())
            bands = band_hashes(signatures(sets)).view(np.int64)
            key = pa.array([None if len(x) == 0 else k for (x, _), k in zip(sets, b.column("key").to_pylist())], pa.string())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), key, lists], names=["doc_id", "key", "bands"])

    return rows.mapInArrow(lean(emit), "doc_id long, key string, bands array<long>")


def _verify(batches):
    cache: dict[str, tuple] = {}
    for b in batches:
        u, v = b.column("leader").to_pylist(), b.column("key").to_pylist()
        keep = []
        for k, (a, x, y) in enumerate(zip(u, b.column("leader_text").to_pylist(), b.column("text").to_pylist())):
            if a not in cache:
                cache = {a: text_shingles([x])[0]}  # rows come sorted by leader
            if similar(cache[a], text_shingles([y])[0]):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([pa.array([u[k] for k in keep], pa.string()), pa.array([v[k] for k in keep], pa.string())], names=["src", "dst"])


def _compare(t: pa.Table) -> pa.Table:
    keys, comps = t.column("key").to_pylist(), t.column("comp").to_pylist()
    side = (t.column("own").to_numpy() != t.column("bi").to_numpy()).astype(int)
    links = block_links(text_shingles(t.column("text").to_pylist()), comps, side) if len(set(comps)) > 1 else []
    give_back()
    return pa.table([pa.array([keys[a] for a, _ in links], pa.string()), pa.array([keys[b] for _, b in links], pa.string())], names=["src", "dst"])


def _components(links: DataFrame) -> DataFrame:
    nodes = links.select(F.col("src").alias("key")).union(links.select(F.col("dst").alias("key")))
    return connected_components(nodes, links, node="key").withColumnRenamed("label", "comp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``copies`` (rows with the same text), ``key`` (the text's md5, null without words) and ``rep``.

    ``rep`` marks the class's representative, the row of its smallest doc_id (rows equal in doc_id and text are all marked).
    """
    rows = stage(signed(docs), "pmh-rows")
    nodes = stage(rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("node_doc"), F.first("bands").alias("bands"), F.count("*").alias("n")), "pmh-nodes")
    slots = stage(nodes.select("key", F.explode("bands").alias("bucket")), "pmh-slots")
    multi = stage(slots.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("n")).where("n > 1"), "pmh-buckets")
    pairs = stage(join_counted(slots, multi, ["bucket"]).where("key <> leader").select("leader", "key").distinct(), "pmh-pairs")
    texts = _texts(docs, nodes, pairs)
    links = stage(_star_links(pairs, texts), "pmh-links")
    comps = stage(_components(links), "pmh-comps")
    rest = stage(_open_links(pairs, texts, comps), "pmh-rest")
    if rest.limit(1).count():
        comps = stage(_components(links.union(rest)), "pmh-classes")
    named = nodes.select("key", "node_doc", "n").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    named = stage(named, "pmh-named")
    first = F.min(F.struct(F.col("node_doc").isNull().alias("none"), "node_doc", "key"))
    ids = named.groupBy("comp").agg(first.alias("first"), F.count("*").alias("nodes")).select("comp", "nodes", F.col("first.node_doc").alias("class_id"), F.col("first.key").alias("rep_key"))
    keys = stage(join_counted(named.withColumnRenamed("n", "copies"), ids.withColumnRenamed("nodes", "n"), ["comp"]).select("key", "class_id", "rep_key", F.col("copies").alias("n")), "pmh-keys")
    rep = (F.col("key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    out = join_counted(rows.select("doc_id", "key"), keys, ["key"]).select("doc_id", "class_id", F.col("n").alias("copies"), "key", rep.alias("rep"))
    alone = rows.where("key IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("copies"), "key", F.lit(True).alias("rep"))
    return out.unionByName(alone)


def _texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, text) of the nodes in pairs."""
    wanted = pairs.select("key").union(pairs.select(F.col("leader").alias("key"))).distinct().join(nodes.select("key", "node_doc"), "key")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("k"), F.col("text").cast("string").alias("text"))
    hit = d.join(wanted.hint("merge"), (d["k"] == wanted["key"]) & d["doc_id"].eqNullSafe(wanted["node_doc"]))
    return stage(hit.groupBy("key").agg(F.first("text").alias("text")), "pmh-texts")


def _star_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links between leaders and the nodes of their buckets."""
    lead = texts.select(F.col("key").alias("leader"), F.col("text").alias("leader_text"))
    both = pairs.join(texts.hint("merge"), "key").join(lead.hint("merge"), "leader").sortWithinPartitions("leader")
    return both.select("leader", "key", "text", "leader_text").mapInArrow(lean(_verify), "src string, dst string")


def _open_links(pairs: DataFrame, texts: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between components inside the groups of leaders, compared in blocks."""
    members = pairs.union(pairs.select("leader", F.col("leader").alias("key")).distinct())
    members = members.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    members = stage(members, "pmh-members")
    open_ = members.groupBy("leader").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo <> hi AND n > 2")
    open_ = stage(open_.select("leader", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")), "pmh-open")
    m = join_counted(members, open_, ["leader"]).withColumn("own", F.pmod(F.xxhash64("key"), F.col("nb")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    m = m.select("leader", "key", "comp", "own", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"))
    with_text = m.join(texts.hint("merge"), "key").select("leader", "key", "comp", "own", "bi", "bj", "text")
    return with_text.groupBy("leader", "bi", "bj").applyInArrow(_compare, "src string, dst string")
