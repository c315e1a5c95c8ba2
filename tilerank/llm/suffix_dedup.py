"""Removal of every byte covered by a ``LENGTH``-byte string that starts twice, by merging Burrows-Wheeler transforms of shards.

Texts are UTF-8 bytes; matches never cross documents; all strings are judged on the input.

1. *Anchors.* Every window of ``LENGTH`` bytes names the leftmost smallest hash among its ``GRAM``-byte grams as its anchor, so equal windows have
   equal anchors at equal places, and each window belongs to one anchor. A run of windows with one anchor becomes a row with two hashes: of the gram (``key``)
   and of all bytes of the run (``ch``). Counts are combined before the shuffle. Keys that occur once are done: no window there repeats. Keys
   with one ``ch`` are done too: all their windows repeat.
2. *Transforms.* What is left are keys with different surroundings, once each. A task sorts the suffixes of shards of them and takes each shard's
   transform, with ``STEP`` preceding bytes per entry in place of one. The shards' transforms are merged by interleave refinement: an
   interleave that is right for the first d bytes of all suffixes becomes right for d + STEP by placing the shards' entries in its order, stably
   by symbol. Block borders found on the way are the places where the common prefix ends; a block of one suffix leaves the interleave, and the
   blocks left at depth ``LENGTH`` are the repeated intervals. Suffixes are never sorted again after their shard.
3. *Large groups.* A key with more than ``BIG`` different surroundings does not go to one task: its windows are halved by the anchor's place in
   them, keyed by the bytes that all windows of a half share, and counted again; halves that occur once or look all alike are done,
   and a half of one window always is, so this ends after eight rounds with every window judged.
4. *Removal.* The runs found go back to all rows with that key and ``ch``, and per document to its text.

Defined cases: null text counts as empty; texts under ``LENGTH`` bytes lose nothing; equal rows are separate documents, so all their windows
repeat; a null doc_id is an id like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, mix64, stage, text_slices

LENGTH = 200
GRAM = 72
#: Bytes per symbol of a transform; LENGTH is a multiple of it.
STEP = 8
#: Bytes of surroundings per shard and per merge.
SHARD, CHUNK = 48 << 10, 192 << 10
#: Different surroundings of a key that one task may take.
BIG = 8192
#: No byte of UTF-8.
END = 0xFF
SLICE_BYTES = 4 << 20
SPAN = LENGTH - GRAM + 1
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def _powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    size, step = 1, base
    while size < n:
        m = min(size, n - size)
        out[size : size + m] = out[:m] * np.uint64(step)
        size, step = size + m, step * step & MASK
    return out[:n]


class Prefix:
    """Polynomial hashes (mod 2^64) of any stretch of a byte array."""

    inverse = pow(BASE, -1, 1 << 64)
    code = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def __init__(self, data: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.code[data] * _powers(len(data), BASE), dtype=np.uint64)])
        self.back = _powers(len(data) + 1, self.inverse)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix64((self.sums[hi] - self.sums[lo]) * self.back[lo])


def leftmost_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost minimum of every window of ``w`` values, from running minima of blocks of ``w``."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    rows = -(-len(h) // w)
    x = np.full(rows * w, MASK, np.uint64)
    x[: len(h)] = h
    x = x.reshape(rows, w)
    at = np.arange(rows * w).reshape(rows, w)
    run = np.minimum.accumulate(x, 1)
    fresh = np.ones_like(x, bool)
    fresh[:, 1:] = x[:, 1:] < run[:, :-1]
    head = np.maximum.accumulate(np.where(fresh, at, 0), 1).ravel()  # leftmost minimum of the block up to here
    back = x[:, ::-1]
    run = np.minimum.accumulate(back, 1)
    fresh = np.ones_like(x, bool)
    fresh[:, 1:] = back[:, 1:] <= run[:, :-1]
    tail = np.minimum.accumulate(np.where(fresh, at[:, ::-1], rows * w), 1)[:, ::-1].ravel()  # of the block from here
    flat = x.ravel()
    i = np.arange(n)
    a, b = tail[i], head[i + w - 1]
    return np.where(flat[a] <= flat[b], a, b)


def anchors(data: np.ndarray, ends: np.ndarray):
    """Runs of windows with one anchor, in a concatenation of texts that end at ``ends``.

    Returns arrays (text, key, ch, lo, hi, p): starts lo..hi (in the concatenation) share the anchor p, the leftmost smallest hash among the grams of
    the window; key hashes the gram, ch all bytes of the windows and where the anchor lies in them.
    """
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none
    pre = Prefix(data)
    g = np.arange(len(data) - GRAM + 1)
    h = pre.of(g, g + GRAM)
    p = leftmost_minimum(h, SPAN)
    start = np.arange(len(p))
    text = np.searchsorted(ends, start, side="right")
    ok = start + LENGTH <= ends[np.minimum(text, len(ends) - 1)]
    start, p, text = start[ok], p[ok], text[ok]
    if not len(start):
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none
    new = np.ones(len(start), bool)
    new[1:] = (p[1:] != p[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    lo, hi = start[first], start[np.concatenate([first[1:], [len(start)]]) - 1]
    p, text = p[first], text[first]
    ch = mix64(pre.of(lo, hi + LENGTH) + (p - lo).astype(np.uint64) * np.uint64(BASE) + (hi - lo).astype(np.uint64))
    return text, h[p], ch, lo, hi, p


def _symbols(data: np.ndarray) -> np.ndarray:
    """Dense ranks of the STEP bytes from every position on (exact: eight bytes are one integer)."""
    padded = np.concatenate([data, np.full(STEP, END, np.uint8)])
    packed = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, STEP)[: len(data)]).view(">u8").ravel()
    return np.unique(packed, return_inverse=True)[1].astype(np.int64)


def _stable_order(x: np.ndarray) -> np.ndarray:
    """Stable argsort of small non-negative integers by 16-bit radix passes."""
    order = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    if len(x) and x.max() > 0xFFFF:
        order = order[np.argsort((x[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _shard_suffixes(sym: np.ndarray, pad: np.ndarray) -> np.ndarray:
    """Suffix array of a shard by prefix doubling; suffixes that start in a terminator come first, in order."""
    n, n_pad = len(sym), int(pad.sum())
    rank = sym + n_pad
    rank[pad] = np.arange(n_pad)
    h = STEP
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - h] = rank[h:] + 1 if h < n else 0
        values, rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)
        if len(values) == n or h > n:
            return np.argsort(rank, kind="stable")
        h *= 2


def repeated_starts(texts: list[bytes], weights: list[int]) -> list[np.ndarray]:
    """Per text, the starts of LENGTH-byte strings that start twice or more in all of the texts (a text counts ``weight`` times).

    Shard transforms are merged all at once: ``place`` holds the interleave as places in the concatenated transforms. Suffixes whose
    block weighs less than 2 leave at once: nothing longer that starts there, or at any place before, can repeat.
    """
    lens = np.array([len(t) for t in texts])
    at = np.concatenate([[0], np.cumsum(lens + STEP)])
    data = np.full(at[-1], END, np.uint8)
    where = np.concatenate([np.arange(a, a + n) for a, n in zip(at, lens)]) if len(texts) else np.empty(0, np.int64)
    data[where] = np.frombuffer(b"".join(texts), np.uint8)
    pad = np.ones(len(data), bool)
    pad[where] = False
    sym = _symbols(data)
    begins = np.zeros(len(data), np.int64)  # place in the own text
    begins[at[:-1]] = 1
    text_of = np.cumsum(begins) - 1
    inside = np.arange(len(data)) - at[text_of]
    # Shards: consecutive texts.
    shard_of_text = (at[:-1] // SHARD).astype(np.int64)
    shards = []
    for z in np.unique(shard_of_text):
        mine = np.flatnonzero(shard_of_text == z)
        lo, hi = at[mine[0]], at[mine[-1] + 1]
        shards.append(_shard_suffixes(sym[lo:hi].copy(), pad[lo:hi]) + lo)
    suffixes = np.concatenate(shards) if shards else np.empty(0, np.int64)
    ahead = (inside[suffixes] >= STEP) & (inside[suffixes] <= lens[text_of[suffixes]])  # STEP bytes of the text stand before the suffix
    before = np.maximum(suffixes - STEP, 0)
    transform = np.where(ahead, sym[before], -1).astype(np.int32)  # the shards' transforms
    place_of = np.empty(len(data), np.int32)
    place_of[suffixes] = np.arange(len(suffixes))
    back = place_of[before]  # last to first: the place of the suffix that starts STEP bytes before
    heavy = np.minimum(np.asarray(weights, np.int64), 2)[text_of[suffixes]] if len(texts) else np.empty(0, np.int64)
    place = np.arange(len(suffixes), dtype=np.int32)
    block = np.zeros(len(place), np.int32)  # nothing differs in the first 0 bytes
    for _ in range(LENGTH // STEP):
        entry = transform[place]  # the shards' entries in the interleave's order
        live = np.flatnonzero(entry >= 0)
        if not len(live):
            place = place[:0]
            break
        live = live[_stable_order(entry[live])]
        s, b, place = entry[live], block[live], back[place[live]]
        border = np.ones(len(live), bool)
        border[1:] = (s[1:] != s[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(border)
        sizes = np.diff(first, append=len(live))
        again = np.add.reduceat(heavy[place], first) >= 2
        place, block = place[np.repeat(again, sizes)], np.repeat(np.arange(np.count_nonzero(again), dtype=np.int32), sizes[again])
    starts = np.sort(suffixes[place])
    return np.split(inside[starts], np.searchsorted(text_of[starts], np.arange(1, len(texts)))) if len(texts) else []


def runs_of(starts: np.ndarray) -> list[dict]:
    """Runs of consecutive starts as first and last."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"a": int(starts[i]), "b": int(starts[j])} for i, j in zip(np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(starts) - 1]]))]


PLACE = "doc_id long, th long, key long, ch long, lo int, hi int, off int"
CONTEXT = "key long, ch long, n long, d long, off int, ctx binary, root_key long, root_ch long, shift int"
RUNS = "root_key long, root_ch long, runs array<struct<a:int,b:int>>"
RUN_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """Step 1's rows: places lo..hi of the first byte of windows in the document, and the anchor's distance ``off`` from lo."""

    def emit(batches):
        for b in text_slices(batches, "text", SLICE_BYTES):
            raw = _bytes(b.column("text"))
            ends = np.cumsum([len(x) for x in raw])
            text, key, ch, lo, hi, p = anchors(np.frombuffer(b"".join(raw), np.uint8), ends)
            base = np.concatenate([[0], ends])[text]
            take = pa.array(text)
            cols = [b.column("doc_id").take(take), b.column("th").take(take), pa.array(key.view(np.int64)), pa.array(ch.view(np.int64))]
            cols += [pa.array(x.astype(np.int32)) for x in (lo - base, hi - base, p - lo)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "th", "key", "ch", "lo", "hi", "off"])

    return docs.select("doc_id", "th", "text").mapInArrow(emit, PLACE)


def _contexts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The bytes around one place of every (key, ch) in ``mixed`` (key, ch, n, d, doc_id, th, lo, hi, off)."""
    per = mixed.groupBy("doc_id", "th").agg(F.collect_list(F.struct("key", "ch", "n", "d", "lo", "hi", "off")).alias("at"))
    a, b = docs.alias("a"), per.alias("b")
    hit = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th"))).select("a.text", "b.at")

    def emit(batches):
        for x in text_slices(batches, "text", SLICE_BYTES):
            rows = []
            for raw, at in zip(_bytes(x.column("text")), x.column("at").to_pylist()):
                rows += [(r["key"], r["ch"], r["n"], r["d"], r["off"], raw[r["lo"] : r["hi"] + LENGTH], r["key"], r["ch"], 0) for r in at]
            yield _context_batch(rows)

    return hit.mapInArrow(emit, CONTEXT)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["key", "ch", "n", "d", "off", "ctx", "root_key", "root_ch", "shift"])


def _runs_batch(rows: list[tuple]) -> pa.RecordBatch:
    k, c, r = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c, pa.int64()), pa.array(r, RUN_TYPE)], names=["root_key", "root_ch", "runs"])


def _merge_chunk(rows: list[tuple]) -> list[tuple]:
    """rows: (key, ch, n, root_key, root_ch, shift, ctx) of whole keys -> (root_key, root_ch, runs)."""
    one: dict[tuple, list] = {}
    for key, ch, n, *root, ctx in rows:
        x = one.setdefault((key, ch), [0, ctx, []])
        x[0] += n
        x[2].append(root)
    found = repeated_starts([x[1] for x in one.values()], [min(x[0], 2) for x in one.values()])
    out = []
    for (_, _, roots), starts in zip(one.values(), found):
        if len(starts):
            out += [(k, c, runs_of(starts + shift)) for k, c, shift in roots]
    return out


def _merge(batches):
    held, size, last = [], 0, None
    for b in batches:
        names = ("key", "ch", "n", "root_key", "root_ch", "shift", "ctx")
        for row in zip(*(b.column(c).to_pylist() for c in names)):
            if size >= CHUNK and row[0] != last:
                yield _runs_batch(_merge_chunk(held))
                held, size = [], 0
            held.append(row)
            size, last = size + len(row[-1]), row[0]
    if held:
        yield _runs_batch(_merge_chunk(held))


def _halves(level: int):
    """Split the windows of each row by the anchor's distance: cells of ``256 >> level`` distances."""
    s = 256 >> level

    def emit(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                ctx, off = r["ctx"], r["off"]
                lo, hi = off - (len(ctx) - LENGTH), off  # distances of the row's windows
                for c in range(lo // s, hi // s + 1):
                    o1, o2 = max(lo, c * s), min(hi, c * s + s - 1)
                    core = ctx[off - c * s : off - (c * s + s - 1) + LENGTH]
                    sub = ctx[off - o2 : off - o1 + LENGTH]
                    key = xxhash.xxh3_64_intdigest(core, seed=c * 16 + level) ^ (r["key"] & 0xFFFFFFFFFFFFFFFF)
                    ch = xxhash.xxh3_64_intdigest(sub, seed=o2)
                    rows.append((_signed(key), _signed(ch), r["n"], 0, o2, sub, r["root_key"], r["root_ch"], r["shift"] + off - o2))
            yield _context_batch(rows)

    return emit


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _all_windows() -> F.Column:
    return F.array(F.struct(F.col("shift").alias("a"), (F.col("shift") + F.length("ctx") - LENGTH).cast("int").alias("b")))


def _runs(contexts: DataFrame) -> list[DataFrame]:
    """Steps 2 and 3: tables (root_key, root_ch, runs)."""
    out, rows, level = [], contexts, 0
    while True:
        small = rows.where(F.col("d") <= BIG)
        dealt = small.repartition("key").sortWithinPartitions("key")
        out.append(stage(dealt.mapInArrow(_merge, RUNS), "bwt-runs"))
        big = rows.where(F.col("d") > BIG)
        if big.limit(1).count() == 0:
            return out
        level += 1
        parts = stage(big.mapInArrow(_halves(level), CONTEXT).drop("d"), "bwt-halves")
        per = parts.groupBy("key").agg(F.sum("n").alias("kn"), F.count("*").alias("d"), F.min("ch").alias("c0"), F.max("ch").alias("c1"))
        joined = stage(join_counted(parts, stage(per.where("kn > 1"), "bwt-keys"), ["key"], "d"), "bwt-level")
        out.append(joined.where("c0 = c1").select("root_key", "root_ch", _all_windows().alias("runs")))
        rows = joined.where("c0 <> c1")


def removed_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, th, spans): byte spans [s, e) to remove, per document that has any (spans may overlap)."""
    places = stage(anchor_rows(docs), "bwt-anchors")
    keys = places.groupBy("key").agg(F.count("*").alias("n"), F.min("ch").alias("c0"), F.max("ch").alias("c1")).where("n > 1")
    hits = stage(join_counted(places, stage(keys, "bwt-repeated"), ["key"]).withColumn("alike", F.expr("c0 = c1")).drop("n", "c0", "c1"), "bwt-hits")
    mixed = hits.where("NOT alike")
    seen = mixed.groupBy("key", "ch").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "lo", "hi", "off")).alias("rep"))
    seen = stage(seen, "bwt-seen")
    known = stage(join_counted(seen, stage(seen.groupBy("key").agg(F.count("*").alias("d")), "bwt-mixed"), ["key"], "d"), "bwt-known")
    tables = _runs(stage(_contexts(docs, known.select("key", "ch", "n", "d", "rep.*")), "bwt-contexts"))
    runs = functools.reduce(DataFrame.unionByName, tables).select(F.col("root_key").alias("key"), F.col("root_ch").alias("ch"), F.explode("runs").alias("r"))
    counted = stage(runs.groupBy("key", "ch").agg(F.collect_list("r").alias("runs")).join(known.select("key", "ch", "n"), ["key", "ch"]), "bwt-found")
    hit = join_counted(mixed.select("doc_id", "th", "key", "ch", "lo"), counted, ["key", "ch"])
    span = lambda a, b: F.struct(a.alias("s"), (b + LENGTH).alias("e"))
    spans = F.transform("runs", lambda r: span(F.col("lo") + r["a"], F.col("lo") + r["b"]))
    whole = hits.where("alike").select("doc_id", "th", F.array(span(F.col("lo"), F.col("hi"))).alias("spans"))
    return hit.select("doc_id", "th", spans.alias("spans")).unionByName(whole).groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def cut(raw: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, maximal removed runs)."""
    kept, end, removed, n = [], 0, 0, 0
    for s, e in sorted((x["s"], x["e"]) for x in spans or []):
        if s > end or n == 0:
            kept.append(raw[end:s])
            n += 1
        elif e <= end:
            continue
        removed += e - max(s, end)
        end = max(end, e)
    kept.append(raw[end:])
    return b"".join(kept), removed, n


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256, the digest of the bytes that stay."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    spans = removed_runs(base)
    a, b = base.alias("a"), spans.alias("b")
    rows = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th")), "left").select("a.doc_id", "a.text", "b.spans")

    def emit(batches):
        for x in text_slices(batches, "text", SLICE_BYTES):
            raw = _bytes(x.column("text"))
            done = [cut(t, s) for t, s in zip(raw, x.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    x.column("doc_id"), pa.array([len(t) for t in raw], pa.int64()), pa.array([r for _, r, _ in done], pa.int64()),
                    pa.array([n for _, _, n in done], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in done]),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.mapInArrow(emit, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
