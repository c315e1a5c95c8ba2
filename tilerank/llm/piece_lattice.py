"""SentencePiece encoding and decoding over a suffix array.

Texts are cut wherever no piece of the vocabulary holds the two characters beside the cut, as no merge ever crosses such a place. A batch's distinct runs are put into one
text. Its suffix array, right for the longest piece, is searched for every piece of the vocabulary at once; the ranges found are all places of
all pieces, the edges of one lattice. Edges are sorted by where they end and relaxed in that order.

Relaxing: for a BPE model an encoding is right exactly if each two neighbours would also come out of encoding them alone, and every prefix has one right
encoding. So an edge reaches its end if its start is reached and its piece fits the piece that reached the start; one piece does. Scores
decide nothing else, so ids equal the library's (tested). Characters without a piece become their UTF-8 bytes' pieces.

Runs met before come from a cache of ``CACHE_RUNS`` runs per Python worker, of which the half used most stays when it is full. Decoding joins the ids' bytes and gives the marks
back as spaces; text that holds the mark itself decodes to spaces there.

Defined cases: null text encodes like an empty one, to no ids, and decodes to an empty text; repeated rows are encoded each; null doc_ids stay; very long runs
are one lattice of linear size; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_slices

MARK = "▁"
#: Runs kept per Python worker, about.
CACHE_RUNS = 200_000
SLICE_BYTES = 1 << 20
#: Slots for verdicts on neighbouring pieces, as a power of two, per Python worker.
PAIR_BITS = 20
#: Characters of new runs per suffix array.
INDEX_CHARS = 200_000
LAST_CHAR = chr(0x10FFFF)


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` characters from there on (prefix doubling)."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    h = 1
    while h < depth:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-h] = rank[h:] + 1
        rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)[1]
        h *= 2
    return np.argsort(rank, kind="stable")


class PieceModel:
    """A BPE model's pieces with what the lattice needs."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = {}
        self.id_of: dict[str, int] = {}
        for i in range(n):
            p = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                self.byte_id[int(p[1:-1], 16)] = i
                self.bytes_of[i] = bytes([int(p[1:-1], 16)])
            elif not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i)):
                self.id_of[p] = i
                self.bytes_of[i] = p.replace(MARK, " ").encode()
        if len(self.byte_id) != 256:
            raise ValueError("the model has no pieces for single bytes")
        if any("\x00" in p or any(c not in self.id_of for c in p) for p in self.id_of):
            raise ValueError("a piece holds a zero byte, or a character that is no piece")
        self.score = {p: self.sp.get_score(i) for p, i in self.id_of.items()}
        self.text_of = {i: p for p, i in self.id_of.items()}
        whole = [p for p in self.id_of if len(p) == 1 or self.merge(p) == [p]]  # others never come out
        whole.sort()
        self.whole = set(whole)
        self.depth = max(map(len, whole))
        self.pieces = np.array(whole, dtype=f"U{self.depth}")
        self.above = np.array([p + LAST_CHAR * (self.depth - len(p)) for p in whole], dtype=f"U{self.depth}")
        self.lens = np.array([len(p) for p in whole])
        self.ids = np.array([self.id_of[p] for p in whole])
        # Characters of pieces of two or more, by number (0: all others), and which of them stand side by side in a piece.
        chars = sorted({c for p in self.id_of if len(p) > 1 for c in p})
        number = {c: i + 1 for i, c in enumerate(chars)}
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.id_of:
            for a, b in itertools.pairwise(p):
                self.joined[number[a], number[b]] = True
        self.pair_key, self.pair_fits = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.index: dict[str, int] = {}
        self.begin, self.found, self.uses = np.zeros(1, np.int64), np.empty(0, np.int32), np.zeros(0, np.int64)
        self.singles: list[tuple[str, list[int]]] = []

    def merge(self, text: str) -> list[str]:
        """Plain merging, for short texts: the best-scored neighbours first, leftmost among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, pair: int) -> bool:
        """Do the two pieces (a * 2^20 + b) stay apart when encoded together?"""
        a, b = self.text_of[pair >> 20], self.text_of[pair & 0xFFFFF]
        return a + b not in self.whole and self.merge(a + b) == [a, b]

    def fits(self, pairs: np.ndarray) -> np.ndarray:
        """:meth:`apart` of every pair; verdicts are kept, one per slot, until another pair takes the slot."""
        slot = lambda x: (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)
        at = slot(pairs)
        out = self.pair_fits[at]
        miss = np.flatnonzero(self.pair_key[at] != pairs)
        if len(miss):
            unique, inverse = np.unique(pairs[miss], return_inverse=True)
            verdict = np.fromiter(map(self.apart, unique.tolist()), bool, len(unique))
            at = slot(unique)
            _, one = np.unique(at, return_index=True)
            self.pair_key[at[one]], self.pair_fits[at[one]] = unique[one], verdict[one]
            out[miss] = verdict[inverse]
        return out

    def lattice(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per run) of distinct runs of characters that are pieces."""
        text = "\x00".join(runs) + "\x00"
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(codes)
        stops = np.cumsum([len(w) + 1 for w in runs]) - 1  # each run's end
        starts = np.concatenate([[0], stops[:-1] + 1])
        order = suffix_order(codes, self.depth)
        wide = np.lib.stride_tricks.sliding_window_view(np.concatenate([codes, np.zeros(self.depth, np.uint32)]), self.depth)
        sorted_ = np.ascontiguousarray(wide[order]).view(f"U{self.depth}").ravel()
        lo, hi = np.searchsorted(sorted_, self.pieces, "left"), np.searchsorted(sorted_, self.above, "right")
        count = hi - lo
        piece = np.repeat(np.arange(len(count)), count)
        at = order[np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
        run = np.repeat(np.arange(len(runs)), stops - starts + 1)  # of every place
        end = at + self.lens[piece]
        ok = (end <= stops[run[at]]) & (codes[at] != 0)
        at, end, ids = at[ok], end[ok], self.ids[piece[ok]]
        depth = end - starts[run[at]]
        by_end = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth, kind="stable")
        at, end, ids, depth = at[by_end], end[by_end], ids[by_end], depth[by_end]
        first = np.zeros(n + 1, bool)
        first[starts] = True
        last, back = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)  # the piece that reached a place, and from where
        level = np.flatnonzero(np.diff(depth, prepend=-1))
        for a, b in zip(level, [*level[1:], len(depth)]):
            s, e, p = at[a:b], end[a:b], ids[a:b]
            prev = last[s]
            good = first[s]
            ask = np.flatnonzero(~good & (prev >= 0))
            good[ask] = self.fits((prev[ask] << 20) | p[ask])
            last[e[good]], back[e[good]] = p[good], s[good]
        # Walk all runs back from their ends at once.
        passed, who, here = np.zeros(n + 1, bool), np.arange(len(starts)), stops.copy()
        while len(who):
            go = here > starts[who]
            who, here = who[go], here[go]
            passed[here] = True
            here = back[here]
        places = np.flatnonzero(passed)
        return last[places].astype(np.int32), np.diff(np.searchsorted(places, stops, side="right"), prepend=0)

    def runs(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(all runs, runs per text): texts cut wherever no piece holds the two characters beside the cut."""
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = self.kind[codes]
        bounds = np.cumsum([0, *map(len, texts)])
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.joined[kind[:-1], kind[1:]]
        cut[bounds[bounds < len(codes)]] = True
        at = np.flatnonzero(cut)
        cuts = [*at.tolist(), len(codes)]
        return [whole[a:b] for a, b in itertools.pairwise(cuts)], np.diff(np.searchsorted(at, bounds))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        found, n_runs = self.runs([self.sp.normalize(t) if t else "" for t in texts])
        if len(self.index) > CACHE_RUNS:
            self.trim()
        batch, size = [], 0
        for w in set(found).difference(self.index):
            if len(w) == 1:  # a piece, or its bytes' pieces
                ids = [self.id_of[w]] if w in self.id_of else [self.byte_id[x] for x in w.encode()]
                self.singles.append((w, ids))
                continue
            batch.append(w)
            size += len(w) + 1
            if size >= INDEX_CHARS:
                self._learn(batch, *self.lattice(batch))
                batch, size = [], 0
        if batch:
            self._learn(batch, *self.lattice(batch))
        if self.singles:
            self._learn([w for w, _ in self.singles], np.array([i for _, ids in self.singles for i in ids], np.int32), np.array([len(ids) for _, ids in self.singles]))
            self.singles = []
        w = np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))
        self.uses += np.bincount(w, minlength=len(self.uses))
        flat, ends = self._ids(w)
        bounds = np.concatenate([[0], np.cumsum(n_runs)])
        return flat, ends[bounds[1:]] - ends[bounds[:-1]]

    def _ids(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of known runs one after another, where each ends, from 0)."""
        lens = self.begin[w + 1] - self.begin[w]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return self.found[np.repeat(self.begin[w] - ends[:-1], lens) + np.arange(ends[-1])], ends

    def _learn(self, runs: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.index.update(zip(runs, range(len(self.index), len(self.index) + len(runs))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        self.found = np.concatenate([self.found, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(runs), np.int64)])

    def trim(self) -> None:
        """Keep the half of the cache that was used most."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: CACHE_RUNS // 2])
        names = list(self.index)
        ids, ends = self._ids(keep)
        self.index = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.found, self.begin, self.uses = ids, ends, self.uses[keep] // 2

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the mark that stands before every text is not part of it."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """One model per Python worker and path."""
    return PieceModel(path)


def encode(docs: DataFrame, model_file: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``n_tokens`` and ``ids`` of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c for c in keep if c != "text"])
    names = ["doc_id", *keep]

    def emit(batches):
        for b in text_slices(batches, "text", SLICE_BYTES):
            ids, counts = load_model(model_file).encode(b.column("text").to_pylist())
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(counts, pa.int64()), lists], names=[*names, "n_tokens", "ids"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(emit, ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "n_tokens long, ids array<int>"]))


def decode(encoded: DataFrame, model_file: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text of ``ids`` (null ids: null)."""
    rows = encoded.select(*dict.fromkeys([*keep, "ids"]))
    kinds = dict(rows.dtypes)

    def emit(batches):
        for b in batches:
            ids = b.column("ids")
            flat, at = ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            one = load_model(model_file).decode
            null = ids.is_null().to_numpy(zero_copy_only=False)
            if len(flat) != at[-1]:  # null lists may hide values
                out = [None if x is None else one(x) for x in ids.to_pylist()]
            else:
                out = [None if null[k] else one(flat[at[k] : at[k + 1]].tolist()) for k in range(len(ids))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(out, pa.string())], names=[*keep, "decoded"])

    return rows.mapInArrow(emit, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "decoded string"]))


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids and ``same``: does decoding give the text back (an empty one for null)? One pass, so one Python worker a task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def emit(batches):
        for b in text_slices(batches, "text", SLICE_BYTES):
            model, texts = load_model(model_file), b.column("text").to_pylist()
            ids, counts = model.encode(texts)
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            same = [model.decode(ids[at[k] : at[k + 1]].tolist()) == (t or "") for k, t in enumerate(texts)]
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(same)], names=["doc_id", "n_tokens", "ids", "same"])

    return rows.mapInArrow(lean(emit), "doc_id long, n_tokens long, ids array<int>, same boolean")
