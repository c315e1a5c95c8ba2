"""The n-gram Jaccard join against brute force on word tuples."""

import random
from fractions import Fraction

import numpy as np

from tilerank.llm import ngram_join as J

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    ws = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    return {tuple(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))} if ws else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(sets[i]), ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def joined(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.ngram_join(df).collect()), key=str)


def test_bounds():
    for n in range(1, 3000):
        assert J.slack(n) == n - -(-85 * n // 100)
    for a in range(1, 60):
        for b in range(1, 60):
            for c in range(min(a, b) + 1):
                assert (c >= J.least_overlap(a, b)) == (Fraction(c, a + b - c) >= Fraction(85, 100))
    rng = np.random.default_rng(4)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 90, rng.integers(0, 60))) for _ in range(2))
        common = len(np.intersect1d(x, y))
        assert all(common <= J.suffix_bound(x, y, d) <= min(len(x), len(y)) for d in range(5)) and J.suffix_bound(x, y, 9) == common
    for n in range(1, 4000):  # linked lengths are at most one class apart
        cls = lambda v: int(np.floor(np.log(v) / J.CLASS_BASE))
        assert cls(n) - cls(-(-85 * n // 100)) <= 1


def test_edges(weird, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in weird.select("doc_id", "text").collect()]
    assert joined(weird) == brute(rows)
    assert J.ngram_join(no_docs).count() == 0


def test_case_spacing_and_short_texts(spark):
    rows = [(1, "Hello World"), (2, " hello\tworld\n"), (3, "hello world again"), (4, "É b c d"), (5, "é b c d"), (6, "A B C D E F G"), (7, "a b c d e f g"), (8, "\x1fx"), (9, "\x1fx")]
    rows += [(None, "only here no id is given"), (None, "a b c  d e f G"), (10, "a b c d e f g h"), (2, "A b c"), (11, "a b c")]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_groups_around_the_threshold(spark, monkeypatch):
    """Near copies of different distance, chains, a common passage, exact copies: same components as brute force, in small blocks and either way of verifying."""
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(9999)}" for _ in range(130)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(rnd.randrange(7)):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(t[: len(t) - rnd.randrange(12)])))
    chain = [f"c{i}" for i in range(200)]
    rows += [(300 + i, " ".join(chain[3 * i : 3 * i + 70])) for i in range(40)]
    rows += [(400 + i, " ".join(passage + [f"u{i}_{k}" for k in range(rnd.randrange(1, 12))])) for i in range(90)]
    rows += [(600 + i, rows[3][1]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    for tokens, few, share in ((1 << 20, 16, 0.01), (3000, 2, 1e-4), (3000, 10**6, 0.01)):
        monkeypatch.setattr(J, "BLOCK_TOKENS", tokens)
        monkeypatch.setattr(J, "FEW", few)
        monkeypatch.setattr(J, "HOT_SHARE", share)
        assert joined(df) == want


def test_hot_copies_are_dropped_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(J, "HEAVY_SHARE", 1e-9)
    rows = [(i, "one text that has a great many copies in this table") for i in range(1500)] + [(5000 + i, f"one text that has a great many copies in this {i}") for i in range(3)]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(((i, 8, 0 if i < 1500 else i) for i, _ in rows), key=str)
