"""Token ids in Arrow IPC files of fixed-size lists.

A shard is one Arrow *file* (footer, random access) whose record batches hold ``ids`` and ``mask``, two fixed-size lists of
``SEQ_LEN`` values per row: equal-length sequences of one token stream, the last one padded under a zero mask. The buffers
are uncompressed and aligned, so a memory-mapped shard serves any sequence as a numpy view without copying. Beside each shard lies an
index file (``.index.arrow``) with ``doc_id, start, n_tokens`` of its documents; starts count from the shard's first token.

Documents are dealt by ranges of doc_id, encoded, and written by the task that holds the range, in order. File names carry a random
part per attempt and only files named in the materialised manifest are read, so retried or speculative tasks do no harm. A file's
place in the whole stream is the sum of the tokens of the files before it: one manifest row per file.

Words are cached: this tokenizer cuts at white space before anything else and never looks across it, so a text's ids are the ids of
its white-space-separated pieces in a row (tested against whole-text encoding). New words of common Latin letters, digits and marks (``LETTERS``,
``MARKS``) are lower-cased and cut into runs as the tokenizer does, and runs are cached too: ``The``, ``the`` and ``the,`` share one. New runs go to the
tokenizer's model ``WORDS_A_CALL`` at a time; each ends at its one word-end piece (``</w>``). Other words go alone, through the whole tokenizer.
Beyond ``CACHE_WORDS`` keys a cache keeps those that came again since the last such cut. A tokenizer with other rules gets whole texts.

Defined cases: null text counts as empty (only the end id); repeated rows are written each; a null doc_id comes first; equal
doc_ids are ordered by a hash of their text; an empty table writes no file and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import os
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import stage, text_slices

SEQ_LEN = 2048
BATCH_SEQS = 512
FILE_TOKENS = 64 << 20
CACHE_WORDS = 300_000
WORDS_A_CALL = 256
SLICE_BYTES = 4 << 20
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, n_sequences long"


#: The tokenizers whose words and runs are cached: normalised and cut as these do, nothing else looks across white space or across runs.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
CUTS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Letters and marks that these normalizers only lower-case, one by one: ASCII, Latin-1, Latin Extended-A, dashes, quotes, dots.
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f"
MARKS = r"!-/:-@\[-`{-~\xa1-\xa9\xab\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027"
RUNS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[{MARKS}]+|\n")


class _Spans:
    """Token ids by key, bounded. Keys are numbered as they are first seen; ``add`` then gives the new ones their ids."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.index: defaultdict = defaultdict(itertools.count().__next__)
        self.ids, self.begin = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)

    def forget(self) -> None:
        """Above ``CACHE_WORDS`` keys, keeps those that came again; starts anew where these are more than half a cache."""
        if len(self.index) <= CACHE_WORDS:
            return
        kept = np.flatnonzero(self.again)
        if len(kept) > CACHE_WORDS // 2:
            return self.reset()
        self.index = defaultdict(itertools.count(len(kept)).__next__, zip(itertools.compress(self.index, self.again), itertools.count()))
        self.ids, lens = self.get(kept)
        self.begin, self.again = np.concatenate([[0], np.cumsum(lens)]), np.zeros(len(kept), bool)

    def numbers(self, keys: Iterable) -> tuple[np.ndarray, list]:
        """(number of every key, the new keys in the order of their numbers)."""
        known = len(self.again)
        w = np.fromiter(map(self.index.__getitem__, keys), np.int64)
        self.again[w[w < known]] = True
        return w, list(itertools.islice(self.index, known, None))

    def add(self, ids: np.ndarray, lens: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(lens)])
        self.again = np.concatenate([self.again, np.zeros(len(lens), bool)])

    def get(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the keys numbered ``w`` in a row, ids per key)."""
        lens = self.begin[w + 1] - self.begin[w]
        ends = np.cumsum(lens)
        return self.ids[np.repeat(self.begin[w] - ends + lens, lens) + np.arange(lens.sum())], lens


class WordEncoder:
    """Encodes texts through bounded caches of white-space-separated words and of the runs in them."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok, self.bare = Tokenizer.from_file(tokenizer_file), None
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [(spec[k] or {}).get(of) for k, of in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if steps == [NORMALIZERS, CUTS] and not (spec["truncation"] or spec["padding"] or spec["model"].get("dropout")) and spec["model"].get("end_of_word_suffix") == "</w>":
            cuts = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, CUTS[1]]}
            self.bare = Tokenizer.from_str(json.dumps({**spec, "normalizer": None, "pre_tokenizer": cuts, "added_tokens": []}))  # for runs, already lower-case and cut
        self.odd = re.compile("|".join([rf"[^0-9{LETTERS}{MARKS}]", *(re.escape(t["content"]) for t in spec["added_tokens"])]))
        vocab = self.tok.get_vocab()
        self.ends_word = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends_word[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.words, self.runs = _Spans(), _Spans()

    @staticmethod
    def _each(tok, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def _learn_runs(self, new: list[str]) -> None:
        given = [r for r in new if r != "\n"]
        calls = [" ".join(given[i : i + WORDS_A_CALL]) for i in range(0, len(given), WORDS_A_CALL)]
        ids, _ = self._each(self.bare, calls)
        found = np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        if len(found) != len(given):  # a vocabulary that lacks some byte
            ids, found = self._each(self.bare, given)
        lens = np.zeros(len(new), np.int64)
        lens[[r != "\n" for r in new]] = found
        self.runs.add(ids, lens)

    def _learn(self, new: list[bytes]) -> None:
        words = b"\n".join(new).decode("utf-8").split("\n")
        odd = np.fromiter((self.odd.search(w) is not None for w in words), bool, len(words))
        self.runs.forget()
        r, unknown = self.runs.numbers(RUNS.findall("\n".join([*itertools.compress(words, ~odd), ""]).lower()))
        if unknown:
            self._learn_runs(unknown)
        ids, per_run = self.runs.get(r)
        ends = np.cumsum(per_run)[r == self.runs.index["\n"]] if len(r) else np.empty(0, np.int64)
        other, per_other = self._each(self.tok, list(itertools.compress(words, odd)))
        lens = np.empty(len(words), np.int64)
        lens[~odd], lens[odd] = np.diff(ends, prepend=0), per_other
        both, of_odd = np.empty(len(ids) + len(other), np.uint32), np.repeat(odd, lens)
        both[~of_odd], both[of_odd] = ids, other
        self.words.add(both, lens)

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text); each text ends with ``end_id``. Cycle collection rests meanwhile: nothing here has cycles."""
        was = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts, end_id)
        except BaseException:
            self.words.reset()  # keys that were numbered may lack their ids
            self.runs.reset()
            raise
        finally:
            if was:
                gc.enable()

    def _encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        if self.bare is None:
            flat, per_text = self._each(self.tok, [t or "" for t in texts])
            return np.insert(flat, np.cumsum(per_text), end_id), per_text + 1
        split = [(t or "").encode("utf-8").split() for t in texts]
        self.words.forget()
        w, new = self.words.numbers(itertools.chain.from_iterable(split))
        if new:
            self._learn(new)
        flat, lens = self.words.get(w)
        ends = np.concatenate([[0], np.cumsum(lens)])
        bounds = np.cumsum([0, *map(len, split)])
        per_text = ends[bounds[1:]] - ends[bounds[:-1]]
        return np.insert(flat, ends[bounds[1:]], end_id), per_text + 1


@functools.lru_cache(maxsize=2)
def load_encoder(tokenizer_file: str) -> WordEncoder:
    """One encoder, and so one cache of words, per Python worker and file."""
    return WordEncoder(tokenizer_file)


def _shared(path: str):
    """File system and path of a folder that all executors see (a plain path is a mounted one)."""
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + os.path.abspath(path))


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


class _Shard:
    """Writes one shard and its index."""

    def __init__(self, folder: str, part: int, seq: int, dtype: str, seq_len: int):
        self.part, self.seq, self.len = part, seq, seq_len
        self.path = f"{folder}/tokens-{part:06d}-{seq:04d}-{uuid.uuid4().hex[:8]}.arrow"
        self.fs, at = _shared(self.path)
        self.fs.create_dir(os.path.dirname(at), recursive=True)
        self.type, self.np = pa.from_numpy_dtype(np.dtype(dtype)), np.dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(self.type, seq_len)), ("mask", pa.list_(pa.uint8(), seq_len))])
        self.sink = self.fs.open_output_stream(at, compression=None)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.held, self.n_held, self.n_tokens, self.n_seqs, self.docs = [], 0, 0, 0, []

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_tokens + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.docs.append((doc_ids, starts, counts))
        self.held.append(ids.astype(self.np))
        self.n_held += len(ids)
        self.n_tokens += len(ids)
        if self.n_held >= BATCH_SEQS * self.len:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.np)
        whole = len(flat) // self.len * self.len
        rest = flat[whole:]
        if last and len(rest):
            flat, mask = np.concatenate([flat, np.zeros(self.len - len(rest), self.np)]), np.ones(whole + self.len, np.uint8)
            mask[whole + len(rest) :] = 0
            rest = rest[:0]
        else:
            flat, mask = flat[:whole], np.ones(whole, np.uint8)
        step = BATCH_SEQS * self.len
        for i in range(0, len(flat), step):
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x[i : i + step]), self.len) for x in (flat, mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))
        self.n_seqs += len(flat) // self.len
        self.held, self.n_held = [rest], len(rest)

    def close(self) -> tuple:
        self._flush(last=True)
        self.out.close()
        self.sink.close()
        ids = [i for d, _, _ in self.docs for i in d]
        index = pa.table(
            [pa.array(ids, pa.int64()), pa.array(np.concatenate([s for _, s, _ in self.docs])), pa.array(np.concatenate([c for _, _, c in self.docs]))],
            names=["doc_id", "start", "n_tokens"],
        )
        fs, at = _shared(self.path + ".index.arrow")
        with fs.open_output_stream(at) as sink, pa.ipc.new_file(sink, index.schema) as out:
            out.write_table(index, max_chunksize=1 << 16)
        return self.part, self.seq, self.path, len(ids), self.n_tokens, self.n_seqs


class TokenShard:
    """Random access to a shard; on a mounted folder the sequences are views of the mapped file."""

    def __init__(self, path: str):
        fs, at = _shared(path)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.file = pa.memory_map(at) if local else fs.open_input_file(at)
        self.reader = pa.ipc.open_file(self.file)
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self._at, self._batch = -1, None
        self._bounds = None

    def _rows(self, i: int):
        """(batch, row in it) of sequence ``i``; batches may differ in size, their sizes come from the footer once."""
        if self._bounds is None:
            self._bounds = np.cumsum([0] + [self.reader.get_batch(k).num_rows for k in range(self.reader.num_record_batches)])
        k = int(np.searchsorted(self._bounds, i, side="right")) - 1
        if k != self._at:
            self._at, self._batch = k, self.reader.get_batch(k)
        return self._batch, i - int(self._bounds[k])

    def sequence(self, i: int, column: str = "ids") -> np.ndarray:
        b, r = self._rows(i)
        return b.column(column).flatten().to_numpy(zero_copy_only=True)[r * self.seq_len : (r + 1) * self.seq_len]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the shard's stream."""
        first, last = start // self.seq_len, (start + n - 1) // self.seq_len
        parts = [self.sequence(i) for i in range(first, last + 1)] if n else []
        flat = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return flat[start - first * self.seq_len :][:n]


def write_token_files(
    docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = 1, seq_len: int = SEQ_LEN, vocab_size: int = 1 << 16, parts: int | None = None
) -> DataFrame:
    """Encode and write ``docs`` in ascending doc_id order; returns the manifest (one row per file).

    ``vocab_size`` sets the id type (uint16 up to 65,536 ids). ``parts``: ranges of doc_id, by default Spark's shuffle
    partitions; a range becomes one file per ``FILE_TOKENS`` tokens.
    """
    spark = docs.sparkSession
    folder = _uri(folder or scratch_path(spark, "token-files"))
    dtype = "uint16" if vocab_size <= 1 << 16 else "uint32"
    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *key).sortWithinPartitions(*key)

    def write(batches):
        from pyspark import TaskContext

        part, seq, shard, done = TaskContext.get().partitionId(), 0, None, []
        for b in text_slices(batches, "text", SLICE_BYTES):
            ids, counts = load_encoder(tokenizer_file).encode(b.column("text").to_pylist(), end_id)
            shard = shard or _Shard(folder, part, seq, dtype, seq_len)
            shard.add(b.column("doc_id").to_pylist(), ids, counts)
            if shard.n_tokens >= FILE_TOKENS:
                done.append(shard.close())
                shard, seq = None, seq + 1
        if shard:
            done.append(shard.close())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "seq", "path", "n_docs", "n_tokens", "n_sequences"), r)) for r in done], schema=MANIFEST_ARROW)

    return stage(dealt.mapInArrow(write, MANIFEST), "token-manifest")


MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_sequences", pa.int64())])
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_digest(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: its global start, its number of ids and their crc32 (as little-endian uint32)."""
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a set number: small rows, much work behind each
    files = placed.select("path", "base").repartition(tasks, F.col("path"))

    def read(batches):
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                shard = TokenShard(path)
                fs, at = _shared(path + ".index.arrow")
                index = pa.ipc.open_file(fs.open_input_file(at))
                for k in range(index.num_record_batches):
                    x = index.get_batch(k)
                    starts, counts = x.column("start").to_numpy(), x.column("n_tokens").to_numpy()
                    crc = [zlib.crc32(shard.tokens(int(s), int(n)).astype("<u4").tobytes()) for s, n in zip(starts, counts)]
                    yield pa.RecordBatch.from_arrays(
                        [x.column("doc_id"), pa.array(starts + base), x.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    return files.mapInArrow(read, READ)
