"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters, one verification per pair.

A text's set holds its distinct four-word shingles (words are runs of characters other than space and U+0009..U+000D, A-Z lower-cased; a text of
fewer words is one shingle). Two texts link when 100 * |common| >= 85 * |union|. So a text of n shingles can miss at most
``slack(n) = n - ceil(0.85 n)`` of them in a linked one, and in any common order of all shingles two linked texts share one of
their first ``slack + 1``: the prefix. The order here is rare-first: document frequency, then hash.

Plan. Equal sets are one node.

1. *Single shingles.* A shingle of one node only can match nothing; a node with more than ``slack`` of them links with nothing. That is first
   counted on the quarter of the hash space that ``SCREEN_BITS`` names, over all documents; most nodes leave with it. It is a proof of absence, not a sample: who
   stays is judged on all its shingles.
2. *Rare-first prefixes.* The frequencies of all shingles of the nodes that stayed give the order; singles stand first in it, so that a
   prefix is what they leave of ``slack + 1``. Nodes keep their other shingles, sorted rare-first (``toks``).
3. *Candidates.* Nodes that share a prefix shingle meet in its bucket, each with the bucket's smallest node only, its leader. A pair passes the length filter
   (100 * min >= 85 * max) and the positional filter (match at places i, j: overlap <= min(i, j) + 1 + what the shorter rest holds), over all buckets
   that it shares; then it is one row, the suffix filter (binary partitions of the rests bound their overlap) and the exact overlap settle it.
4. *Open groups.* Links make components. Where a leader's group still lies in several, its nodes outside the leader's component are joined with the whole group
   by the same filters, in blocks of ``BLOCK_TOKENS`` shingles and per length class; only links that join components leave a task. Members of one component are never compared
   again, so a group of mutual copies costs one verification per copy, and what is shipped twice are the nodes outside.

A hot shingle cannot fill a task: it has one row per node, copies of one text beyond ``HEAVY_SHARE`` of all rows are dropped by a broadcast of these
texts before the shuffle (at most 1 / HEAVY_SHARE rows), and shingles that a sample of about ``HOT_SAMPLE`` nodes (by hash) shows to be common are counted by partial
aggregates instead. The sample steers the shuffle only, every count is exact.

Shingles are 64-bit hashes: a link of two given texts is misjudged with a probability of about (n / 2^32)^2.

Defined cases: null texts and texts without a word have no shingle and link with nothing (component: the own doc_id); equal sets are linked; rows
that share a doc_id are told apart by their text; the component is the smallest doc_id in it, null doc_ids count only where there is no other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import HEAVY_SHARE, join_counted, stage, text_slices, window_hashes, word_hashes

SHINGLE = 4
#: A link has PART * |common| >= LEAST * |union|.
LEAST, PART = 85, 100
SLICE_BYTES = 4 << 20
#: The screen counts shingles whose top bits are zero.
SCREEN_BITS = 2
#: Nodes looked at for common shingles, and the share of them that makes a shingle common.
HOT_SAMPLE, HOT_SHARE = 4096, 0.01
#: Shingles per side of a block.
BLOCK_TOKENS = 1 << 18
#: Candidates of one node up to this number are verified one by one.
FEW = 16
SUFFIX_DEPTH = 4
#: Base of the length classes; linked lengths are at most one class apart.
CLASS_BASE = math.log(1 / 0.84)


def slack(n):
    """How many of n shingles a linked text may lack."""
    return n - -(-LEAST * n // PART)


def least_overlap(a, b):
    """The smallest number of common shingles that links sets of a and b."""
    return -(-LEAST * (a + b) // (LEAST + PART))


def text_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]  # bytes lower-case A-Z only
    h = word_hashes([w for ws in split for w in ws])
    out, at = [], 0
    for ws in split:
        own = h[at : at + len(ws)]
        at += len(ws)
        out.append(np.unique(window_hashes(own, min(k, len(own)))) if len(own) else np.empty(0, np.uint64))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    at = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=at[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))


def _screened(batches):
    """(doc_id, th, key, node, n, n_low, low): ``key`` names the set, ``node`` is its first 60 bits, ``low`` the set's part in the screen."""
    for b in text_slices(batches, "text", SLICE_BYTES):
        sets = text_sets(b.column("text").to_pylist())
        keys = [hashlib.md5(s.tobytes()).hexdigest() if len(s) else None for s in sets]
        low = [s[: np.searchsorted(s, np.uint64(1 << (64 - SCREEN_BITS)))] for s in sets]
        cols = [pa.array(keys, pa.string()), pa.array([None if k is None else int(k[:15], 16) for k in keys], pa.int64())]
        cols += [pa.array([len(s) for s in sets], pa.int64()), pa.array([len(s) for s in low], pa.int64()), _lists(low)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), *cols], names=["doc_id", "th", "key", "node", "n", "n_low", "low"])


def _full(batches):
    for b in text_slices(batches, "text", SLICE_BYTES):
        sets = text_sets(b.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)], names=["key", "n", "hs"])


def _shared(sets: DataFrame, hs: str) -> DataFrame:
    """(node, h, df) of the shingles that two nodes or more hold; ``sets`` is a materialised table, df counts its rows."""
    rows = sets.select("node", F.explode(hs).alias("h"))
    every = max(1, sets.count() // HOT_SAMPLE)
    seen = sets.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).select(F.explode(hs).alias("h"))
    hot = stage(seen.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") >= HOT_SAMPLE * HOT_SHARE).select("h"), "ngram-hot")
    some = hot.limit(1).count() > 0
    light = (rows.join(F.broadcast(hot), "h", "left_anti") if some else rows).repartition("h")
    w = Window.partitionBy("h")
    light = light.withColumns({"df": F.count("*").over(w), "lo": F.min("node").over(w), "hi": F.max("node").over(w)})
    light = light.where("lo <> hi").select("node", "h", "df")
    if not some:
        return light
    heavy = rows.join(F.broadcast(hot), "h")
    counts = heavy.groupBy("h").agg(F.count("*").alias("df"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    return light.unionByName(heavy.join(F.broadcast(stage(counts.select("h", "df"), "ngram-hot-counts")), "h").select("node", "h", "df"))


def _survivors(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes whose screen part holds no more singles than a link allows."""
    total = nodes.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("t")).first()["t"]
    copied = nodes.where(F.col("copies") >= max(1000, int(total * HEAVY_SHARE))).select("key", F.col("node_doc").alias("first_doc"))
    once = rows.where("key IS NOT NULL")
    if copied.limit(1).count():
        once = once.join(F.broadcast(copied), "key", "left").where(F.col("first_doc").isNull() | F.col("doc_id").eqNullSafe(F.col("first_doc")))
        once = stage(once.select("node", "low"), "ngram-once")  # read several times
    shared = _shared(once, "low").select("node", "h").distinct().groupBy("node").agg(F.count("*").alias("shared"))
    singles = F.col("n_low") - F.coalesce(F.col("shared"), F.lit(0))
    return nodes.join(shared.hint("merge"), "node", "left").where(singles <= _slack("n"))


def _slack(n: str):
    return F.col(n) - F.expr(f"({n} * {LEAST} + {PART - 1}) div {PART}")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, text) of each node, from the row that stands for it."""
    d = docs.select("doc_id", "th", "text")
    hit = d.join(nodes.select("key", "node_doc", "node_th").hint("merge"), F.col("th").eqNullSafe(F.col("node_th")) & F.col("doc_id").eqNullSafe(F.col("node_doc")))
    return hit.groupBy("key").agg(F.first("text").alias("text"))


def _ordered(texts: DataFrame) -> DataFrame:
    """(nid, key, n, u, toks): nodes that can still link, u of whose n shingles are singles; toks are the others, rare-first."""
    sets = stage(texts.mapInArrow(_full, "key string, n long, hs array<long>").withColumn("node", F.monotonically_increasing_id()), "ngram-sets")
    toks = _shared(sets, "hs").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("t")).select("node", F.col("t.h").alias("toks"))
    out = sets.select("node", "key", "n").join(toks.hint("merge"), "node").withColumn("u", F.col("n") - F.size("toks")).where(F.col("u") <= _slack("n"))
    return stage(out.select(F.col("node").alias("nid"), "key", "n", "u", "toks"), "ngram-ordered")


def _meetings(alive: DataFrame) -> DataFrame:
    """(leader, nid, lead_n, lead_w, n, w, at): one row per pair of a node and the leader of a bucket that it is in.

    n counts shingles, w those that are no singles; ``at`` is the match with the lowest positional bound: struct (bound, i, j), i and j the places in the leader's and in the node's order.
    """
    prefix = F.slice("toks", F.lit(1), (_slack("n") + 1 - F.col("u")).cast("int"))
    slots = alive.select("nid", "n", "u", F.size("toks").cast("long").alias("w"), F.posexplode(prefix).alias("j", "h"))
    slots = stage(slots.select("nid", "n", "w", (F.col("u") + F.col("j")).alias("j"), "h"), "ngram-slots")
    lead = F.min(F.struct("nid", "n", "j", "w")).alias("lead")
    buckets = stage(slots.groupBy("h").agg(lead, F.count("*").alias("members")).where("members > 1"), "ngram-buckets")
    both = join_counted(slots, buckets, ["h"], "members").where("nid <> lead.nid").select(F.col("lead.nid").alias("leader"), "nid", F.col("lead.n").alias("lead_n"), F.col("lead.w").alias("lead_w"), "n", "w", F.col("lead.j").alias("i"), "j")
    bound = F.least("i", "j") + 1 + F.least(F.col("lead_n") - F.col("i") - 1, F.col("n") - F.col("j") - 1)
    return stage(both.groupBy("leader", "nid", "lead_n", "lead_w", "n", "w").agg(F.min(F.struct(bound.alias("bound"), "i", "j")).alias("at")), "ngram-meetings")


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = SUFFIX_DEPTH) -> int:
    """An upper bound of |x and y| for sorted arrays: parts on either side of a pivot of y cannot match across it."""
    if not len(x) or not len(y):
        return 0
    if depth == 0:
        return min(len(x), len(y))
    m = len(y) // 2
    a = int(np.searchsorted(x, y[m]))
    hit = int(a < len(x) and x[a] == y[m])
    return suffix_bound(x[:a], y[:m], depth - 1) + hit + suffix_bound(x[a + hit :], y[m + 1 :], depth - 1)


def linked(a: np.ndarray, b: np.ndarray, na: int, nb: int, ua: int, ub: int, i: int, j: int) -> bool:
    """Suffix filter after the match at places i, j, then the exact overlap. ``a``, ``b`` are rare-first without their ua, ub singles."""
    need = least_overlap(na, nb)
    if min(i, j) + 1 + suffix_bound(np.sort(a[i - ua + 1 :]), np.sort(b[j - ub + 1 :])) < need:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[lo:hi] for lo, hi in zip(at[:-1], at[1:])]


def _verify(batches):
    for b in batches:
        num = {c: b.column(c).to_pylist() for c in ("leader", "nid", "lead_n", "n", "lead_u", "u", "i", "j")}
        cases = zip(_arrays(b.column("lead_toks")), _arrays(b.column("toks")), num["lead_n"], num["n"], num["lead_u"], num["u"], num["i"], num["j"])
        ok = np.array([linked(*case) for case in cases], bool)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(num[c], np.int64)[ok]) for c in ("leader", "nid")], names=["src", "dst"])


def _star_links(met: DataFrame, alive: DataFrame) -> DataFrame:
    need = F.expr(f"({LEAST} * (lead_n + n) + {LEAST + PART - 1}) div {LEAST + PART}")
    pairs = met.where((F.least("lead_n", "n") * PART >= F.greatest("lead_n", "n") * LEAST) & (F.col("at.bound") >= need))
    pairs = pairs.select("leader", "nid", "lead_n", "n", "at.i", "at.j")
    lead = alive.select(F.col("nid").alias("leader"), F.col("u").alias("lead_u"), F.col("toks").alias("lead_toks"))
    rows = pairs.join(alive.select("nid", "u", "toks").hint("merge"), "nid").join(lead.hint("merge"), "leader")
    return rows.mapInArrow(_verify, "src long, dst long")


def block_links(nid, comp, n, u, toks, probe) -> list[tuple[int, int]]:
    """Links that join components between the rows marked ``probe`` and all others of a block (rows that are both come twice)."""
    own, ask = np.flatnonzero(~probe), np.flatnonzero(probe)
    if not len(own) or not len(ask):
        return []
    root = {c: c for c in comp}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    room = slack(n) + 1 - u  # prefix lengths
    of = np.repeat(np.arange(len(own)), room[own])
    place = np.concatenate([u[k] + np.arange(room[k]) for k in own])
    index = np.concatenate([toks[k][: room[k]] for k in own])
    order = np.argsort(index, kind="stable")
    index, of, place = index[order], of[order], place[order]
    every = None
    out = []
    for k in ask:
        mine = toks[k][: room[k]]
        lo, hi = np.searchsorted(index, mine, "left"), np.searchsorted(index, mine, "right")
        reach = hi - lo
        if not reach.sum():
            continue
        hit = np.repeat(lo - np.r_[0, np.cumsum(reach)[:-1]], reach) + np.arange(reach.sum())
        c, j, i = of[hit], place[hit], np.repeat(u[k] + np.arange(room[k]), reach)
        nc = n[own[c]]
        need = least_overlap(nc, n[k])
        bound = np.minimum(i, j) + 1 + np.minimum(n[k] - i - 1, nc - j - 1)
        fits = (np.minimum(nc, n[k]) * PART >= np.maximum(nc, n[k]) * LEAST) & (bound >= need)
        c, first = np.unique(c[fits], return_index=True)
        i, j = i[fits][first], j[fits][first]
        open_ = np.array([find(comp[own[x]]) != find(comp[k]) for x in c], bool)
        c, i, j = c[open_], i[open_], j[open_]
        if len(c) > FEW:  # count the overlaps of all of them at once
            if every is None:
                every = np.concatenate([toks[x] for x in own])
                holder = np.repeat(np.arange(len(own)), [len(toks[x]) for x in own])
                by = np.argsort(every, kind="stable")
                every, holder = every[by], holder[by]
            lo, hi = np.searchsorted(every, toks[k], "left"), np.searchsorted(every, toks[k], "right")
            reach = hi - lo
            common = np.bincount(holder[np.repeat(lo - np.r_[0, np.cumsum(reach)[:-1]], reach) + np.arange(reach.sum())], minlength=len(own))
            sure = common[c] >= least_overlap(n[own[c]], n[k])
            c, i, j = c[sure], i[sure], j[sure]
        else:
            sure = None
        for x, pi, pj in zip(c, i, j):
            o = own[x]
            a, b = find(comp[o]), find(comp[k])
            if a != b and (sure is not None or linked(toks[k], toks[o], int(n[k]), int(n[o]), int(u[k]), int(u[o]), int(pi), int(pj))):
                root[a] = b
                out.append((int(nid[k]), int(nid[o])))
    return out


def _join_block(t: pa.Table) -> pa.Table:
    t = t.combine_chunks()
    col = {c: t.column(c).to_numpy() for c in ("nid", "comp", "n", "u")}
    toks = [a for chunk in t.column("toks").chunks for a in _arrays(chunk)]
    links = block_links(col["nid"], col["comp"].tolist(), col["n"], col["u"], toks, t.column("probe").to_numpy(zero_copy_only=False))
    return pa.table([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["src", "dst"])


def _open_links(met: DataFrame, alive: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between components inside the groups of leaders."""
    members = met.select("leader", "nid", "n", "w").union(met.select("leader", F.col("leader").alias("nid"), F.col("lead_n").alias("n"), F.col("lead_w").alias("w")).distinct())
    members = members.join(comps, "nid", "left").withColumns({"comp": F.coalesce("comp", "nid"), "cls": F.floor(F.ln("n") / CLASS_BASE).cast("int")})
    members = stage(members, "ngram-members")
    main = F.max(F.when(F.col("nid") == F.col("leader"), F.col("comp"))).alias("main")
    open_ = members.groupBy("leader").agg(main, F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("g")).where("lo <> hi AND g > 2")
    open_ = stage(open_.select("leader", "main", "g"), "ngram-open")
    m = stage(join_counted(members, open_, ["leader"], "g").select("leader", "nid", "comp", "cls", "w", (F.col("comp") != F.col("main")).alias("out")), "ngram-groups")
    outside = m.where("out").groupBy("leader").agg(F.ceil(F.sum("w") / BLOCK_TOKENS).cast("int").alias("nr"))
    near = m.where("out").select("leader", F.explode(F.array(F.col("cls") - 1, "cls", F.col("cls") + 1)).alias("cls")).distinct()
    classes = m.groupBy("leader", "cls").agg(F.ceil(F.sum("w") / BLOCK_TOKENS).cast("int").alias("na"), F.count("*").alias("g"))
    classes = stage(classes.join(near, ["leader", "cls"]).join(outside, "leader"), "ngram-classes")
    spread = lambda c, k: F.pmod(F.xxhash64(c), F.col(k)).cast("int")
    upto = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    cols = ["leader", "cls", "a", "r", "nid", "comp", "probe"]
    own = join_counted(m.select("leader", "nid", "comp", "cls"), classes, ["leader", "cls"], "g").withColumn("r", upto("nr")).withColumn("a", spread("nid", "na"))
    ask = m.where("out").select("leader", "nid", "comp", F.explode(F.array(F.col("cls") - 1, "cls", F.col("cls") + 1)).alias("cls"))
    ask = join_counted(ask, classes, ["leader", "cls"], "g").withColumn("a", upto("na")).withColumn("r", spread("nid", "nr"))
    rows = own.withColumn("probe", F.lit(False)).select(cols).unionByName(ask.withColumn("probe", F.lit(True)).select(cols))
    rows = rows.join(alive.select("nid", "n", "u", "toks").hint("merge"), "nid").select(*cols, "n", "u", "toks")
    return rows.groupBy("leader", "cls", "a", "r").applyInArrow(_join_block, "src long, dst long")


def _components(links: DataFrame) -> DataFrame:
    nodes = links.select(F.col("src").alias("nid")).union(links.select(F.col("dst").alias("nid")))
    return connected_components(nodes, links, node="nid").withColumnRenamed("label", "comp")


def ngram_join(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``copies`` (rows with the same set, null without shingles) and ``key`` (names the set)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    rows = stage(d.mapInArrow(_screened, "doc_id long, th long, key string, node long, n long, n_low long, low array<long>"), "ngram-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("f")
    nodes = rows.where("key IS NOT NULL").groupBy("key", "node", "n", "n_low").agg(first, F.count("*").alias("copies"))
    nodes = stage(nodes.select("key", "node", "n", "n_low", "copies", F.col("f.doc_id").alias("node_doc"), F.col("f.th").alias("node_th")), "ngram-nodes")
    left = stage(_survivors(rows, nodes).select("key", "node_doc", "node_th"), "ngram-left")
    alive = _ordered(_texts(d, left))
    met = _meetings(alive)
    links = stage(_star_links(met, alive), "ngram-links")
    comps = stage(_components(links), "ngram-comps")
    rest = stage(_open_links(met, alive, comps), "ngram-rest")
    if rest.limit(1).count():
        comps = stage(_components(links.union(rest)), "ngram-classes")
    names = comps.join(alive.select("nid", "key"), "nid").select("key", "comp")
    named = nodes.select("key", "n", "copies", "node_doc").join(names.hint("merge"), "key", "left")
    named = stage(named.withColumn("comp", F.coalesce(F.col("comp").cast("string"), F.col("key"))), "ngram-named")
    ids = named.groupBy("comp").agg(F.min("node_doc").alias("component_id"), F.count("*").alias("g"))  # min passes over nulls
    keys = join_counted(named, stage(ids, "ngram-ids"), ["comp"], "g").select("key", "component_id", "copies")
    out = join_counted(rows.select("doc_id", "key", "n"), stage(keys, "ngram-keys"), ["key"], "copies")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "copies", "key")
    alone = rows.where("key IS NULL").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("copies"), "key")
    return out.unionByName(alone)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS ss FROM w),
x AS MATERIALIZED (SELECT doc_id, len(ss) AS n, unnest(ss) AS g FROM s),
links AS MATERIALIZED (SELECT a.doc_id AS p, b.doc_id AS q FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.q FROM reach r JOIN links l ON r.other = l.p)
SELECT s.doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""
