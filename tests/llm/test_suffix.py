"""Removal of repeated 200-byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np

from tilerank.llm import suffix_dedup as S


def brute(texts, n=S.LENGTH):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i : i + n] for x in raw for i in range(len(x) - n + 1))
    out = []
    for x in raw:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - n + 1):
            if seen[x[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(x) else 0
        out.append((len(x), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(x, np.uint8)[~gone])).hexdigest()))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.repeated_bytes(df).collect())
    assert got == sorted((str(d), *b) for (d, _), b in zip(rows, brute([t for _, t in rows])))


def word_text(rnd, n):
    return " ".join("".join(rnd.choice("abé") for _ in range(rnd.randrange(2, 9))) for _ in range(n))


def test_leftmost_minimum():
    rng = np.random.default_rng(0)
    for n, w in ((50, 7), (7, 7), (6, 7), (100, 1), (33, 16)):
        h = rng.integers(0, 6, n).astype(np.uint64)
        assert S.leftmost_minimum(h, w).tolist() == [i + int(np.argmin(h[i : i + w])) for i in range(n - w + 1)]


def test_merged_transforms_find_repeats(monkeypatch):
    monkeypatch.setattr(S, "SHARD", 900)
    rnd = random.Random(2)
    base = word_text(rnd, 150).encode()
    texts, weights = [], []
    for i in range(24):
        a = rnd.randrange(200)
        texts.append(word_text(rnd, 20).encode() + base[a : a + rnd.randrange(150, 420)] + word_text(rnd, 10).encode())
        weights.append(2 if i == 5 else 1)
    texts += [b"", b"ab" * 300]
    weights += [1, 1]
    seen = Counter()
    for t, w in zip(texts, weights):
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] += w
    for t, got in zip(texts, S.repeated_starts(texts, weights)):
        assert got.tolist() == [i for i in range(len(t) - 199) if seen[t[i : i + 200]] > 1]


def test_settled_suffixes_leave_the_merge(monkeypatch):
    """Random texts with one shared passage: after the first rounds only the passage is sorted on, not all bytes in all rounds."""
    rnd = random.Random(5)
    passage = bytes(rnd.choices(range(32, 127), k=400))
    texts = [bytes(rnd.choices(range(32, 127), k=1500)) + passage * (i in (3, 17)) for i in range(30)]
    sorted_ = []
    order = S._stable_order
    monkeypatch.setattr(S, "_stable_order", lambda x: (sorted_.append(len(x)), order(x))[1])
    found = S.repeated_starts(texts, [1] * 30)
    assert [x.tolist() for x in found] == [list(range(1500, 1701)) if i in (3, 17) else [] for i in range(30)]
    assert sum(sorted_) < 3 * sum(map(len, texts))  # all suffixes in all rounds: 24 times


def test_documents(spark, docs):
    check(spark, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_hot_groups_are_split(spark, monkeypatch):
    """A passage in many documents, with more surroundings than one task may take."""
    monkeypatch.setattr(S, "BIG", 5)
    rnd = random.Random(3)
    passage = word_text(rnd, 60)
    rows = [(i, word_text(rnd, 30) + passage[rnd.randrange(40) : len(passage) - rnd.randrange(40)] + word_text(rnd, 30)) for i in range(60)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(20)] + [(200, "x" * 900), (201, "x" * 500), (202, "ab" * 400), (203, word_text(rnd, 400))]
    check(spark, rows)


def test_edges(spark, weird, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in weird.select("doc_id", "text").collect()]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.repeated_bytes(weird).collect())
    assert got == sorted((str(d), *b) for (d, _), b in zip(rows, brute([t for _, t in rows])))
    assert S.repeated_bytes(no_docs).count() == 0
    exact = "q" * 50 + "".join(map(str, range(60)))
    check(spark, [(1, exact[:200]), (1, exact[:200]), (None, exact[:199]), (2, None), (3, ""), (4, "z" + exact[:200])])
