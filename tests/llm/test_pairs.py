"""ProbMinHash near-duplicates and the inverted multi-index against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest

from tilerank.llm import inverted_multi_index as I
from tilerank.llm import prob_minhash as P


def brute_jp(a, b):
    pa_ = dict(zip(a[0].tolist(), (a[1] / a[1].sum()).tolist()))
    pb = dict(zip(b[0].tolist(), (b[1] / b[1].sum()).tolist()))
    both = set(pa_) | set(pb)
    return sum(1 / sum(max(pa_.get(y, 0) / pa_[x], pb.get(y, 0) / pb[x]) for y in both) for x in set(pa_) & set(pb))


def test_probability_jaccard_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(1, 2**63, 400).astype(np.uint64)
    for _ in range(8):
        a = np.sort(rng.choice(x, 150, replace=False))
        b = np.unique(np.concatenate([rng.choice(a, 120, replace=False), rng.choice(x, 40)]))
        sa, sb = (a, rng.integers(1, 4, len(a))), (b, rng.integers(1, 4, len(b)))
        exact = P.probability_jaccard(sa, sb)
        assert exact == pytest.approx(brute_jp(sa, sb), abs=1e-12)
        s = P.signatures([sa, sb, (np.empty(0, np.uint64), np.empty(0, np.int64))], 4096)
        assert (s[0] == s[1]).mean() == pytest.approx(exact, abs=0.04)
    ones = lambda v: (v, np.ones(len(v), np.int64))
    assert P.probability_jaccard(ones(a), ones(b)) == pytest.approx(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))


def exact_jp(a, b):
    """J_P as a Fraction, by the definition."""
    p, q = ({x: Fraction(int(c), int(s[1].sum())) for x, c in zip(s[0].tolist(), s[1].tolist())} for s in (a, b))
    return sum((1 / sum(max(p.get(y, 0) / p[x], q.get(y, 0) / q[x]) for y in set(p) | set(q)) for x in set(p) & set(q)), Fraction(0))


def test_exact_threshold_is_kept():
    limit, exact = Fraction(4, 5), 0
    span = lambda lo, hi: np.arange(lo, hi, dtype=np.uint64)
    ones = lambda x: (x, np.ones(len(x), np.int64))
    shapes = [(n, m, c) for n in range(1, 90) for m in range(1, n + 1) for c in [(n + m) * 4 // 9] if c <= m]
    for n, m, c in shapes:
        a, b = ones(span(0, n)), ones(span(n - c, n - c + m))
        want = Fraction(c, n + m - c) >= limit
        exact += Fraction(c, n + m - c) == limit
        assert P.similar(a, b) == want == bool(P.block_links([a, b], [0, 1], np.zeros(2, int))), (n, m, c)
    assert exact > 50
    rng = np.random.default_rng(11)
    weighted = []
    for _ in range(3000):  # weighted sets, most of them near the threshold
        n = int(rng.integers(2, 7))
        ca = rng.integers(1, 5, n)
        cb = np.maximum(1, ca + rng.integers(-1, 2, n) * (rng.random(n) < 0.4))
        weighted.append(((span(0, n), ca), (span(0, n), cb)))
    for k in (1, 3, 7):  # one part in five is not common, with unequal scales
        weighted.append(((span(0, 5), np.array([1, 1, 1, 1, 1]) * k), (span(0, 4), np.array([2, 2, 2, 2]) * k)))
        weighted.append(((span(0, 3), np.array([2, 2, 1]) * k), (span(0, 2), np.array([3, 3]))))
    hits = 0
    for a, b in weighted:
        value = exact_jp(a, b)
        assert P.probability_jaccard(a, b) == pytest.approx(float(value), abs=1e-12)
        assert P.similar(a, b) == (value >= limit) == bool(P.block_links([a, b], [0, 1], np.zeros(2, int)))
        hits += value == limit
    assert hits >= 6


def test_pair_of_exact_threshold_alone_and_in_a_group(spark):
    """15 and 12 shingles with 12 common: 0.8. The pair is one class, alone with its leader or with a third text beside."""
    words = [f"w{i}" for i in range(40)]
    for third in ([], [(3, " ".join(words[1:16]))]):
        rows = [(1, " ".join(words[:19])), (2, " ".join(words[:16])), *third]
        a, b = P.text_shingles([t for _, t in rows[:2]])
        assert exact_jp(a, b) == Fraction(4, 5)
        got = {r["doc_id"]: r["class_id"] for r in P.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got[1] == got[2] == 1


def brute_classes(rows):
    """rows: (doc_id, text) -> class id per row, by all pairs."""
    sets = P.text_shingles([t for _, t in rows])
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and brute_jp_fast(sets[i], sets[j]) >= P.THRESHOLD:
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted((str(d), str(ids.get(find(i)))) for i, (d, _) in enumerate(rows))


def brute_jp_fast(a, b):
    return P.probability_jaccard(a, b) if np.isin(a[0], b[0]).any() else 0.0


def test_near_duplicates_of_documents(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted((str(r["doc_id"]), str(r["class_id"])) for r in P.near_duplicates(docs).collect())
    assert got == brute_classes(rows)


def test_large_group_is_whole(spark, monkeypatch):
    """Copies with edits around the threshold: classes equal brute force, with blocks smaller than the group."""
    monkeypatch.setattr(P, "BLOCK", 40)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(9999)}" for _ in range(140)]
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(rnd.randrange(6)):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(t) + (" and again" * 20 if i % 9 == 0 else "")))
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + [(2000 + i, " ".join(f"y{rnd.randrange(9999)}" for _ in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = P.near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == brute_classes(rows)
    same = sum(t == rows[0][1] for _, t in rows)
    assert {r["copies"] for r in got if r["doc_id"] >= 1000 and r["doc_id"] < 2000} == {same}


def test_near_duplicates_edges(weird, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in weird.select("doc_id", "text").collect()]
    got = P.near_duplicates(weird).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == brute_classes(rows)
    assert P.near_duplicates(no_docs).count() == 0


def brute_nearest(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    return [(int(ids[i]), float(d[i])) for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]


def test_multi_index_recall(spark, sf_dir):
    rows = spark.read.parquet(sf_dir.replace("0.001", "0.1") + "/embeddings.parquet")
    v = I.valid_vectors(rows)
    got = {}
    for r in I.search(v, v.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    pdf = v.toPandas()
    ids, x = pdf["vec_id"].to_numpy(), np.stack(pdf["vec"].to_numpy())
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        want, have = brute_nearest(ids, x, q), got[int(ids[q])]
        exact = dict(zip(ids.tolist(), np.sqrt(((x - x[q]) ** 2).sum(1)).tolist()))
        assert len(have) == 10 and all(s == pytest.approx(exact[i], abs=1e-12) for i, s in have) and [s for _, s in have] == sorted(s for _, s in have)
        hit += len({i for i, _ in want} & {i for i, _ in have})
        total += len(want)
    assert hit / total >= 0.9


def test_multi_index_edges(spark):
    schema = "vec_id long, embedding array<float>, score int, c1 int"
    rows = [(i, [float(i % 3), 1.0, 2.0], 1, 1) for i in range(30)] + [(100, None, 1, 1), (200, [0.0, 0.0, 0.0], 1, 1), (300, [1.0, None, 1.0], 1, 1), (400, [1.0, float("nan"), 1.0], 1, 1)]
    rows += [(500, [1.0], 1, 1), (600, [float("inf"), 1.0, 1.0], 1, 1), (None, [1.0, 1.0, 1.0], 1, 1), (0, [0.0, 1.0, 2.0], 1, 1), (700, [5.0, 5.0, 5.0], 1, 1)]
    v = I.valid_vectors(spark.createDataFrame(rows, schema))
    got = [tuple(r) for r in I.search(v, v.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert [r[2] for r in got if r[0] == 0] == [3, 6, 9, 12, 15, 18, 21, 24, 27, 1] and {r[0] for r in got} == {0, 700}
    assert [r[1] for r in got] == list(range(1, 11)) * 2
    few = v.where("vec_id IN (0, 1, 2)")
    assert [tuple(r)[:3] for r in I.search(few, few.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert I.search(v.limit(0), v.limit(0)).count() == 0


def test_walk_is_in_order():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(9)
    order = list(I.walk(a, b))
    assert len(order) == len(set(order)) == 63
    sums = [a[i] + b[j] for i, j in order]
    assert sums == sorted(sums)


def test_hot_vector_is_split(spark, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 50)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    x[:300] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    v = I.valid_vectors(df)
    got = I.search(v, v.where("vec_id % 100 = 0")).where("query_id = 100").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(10)) and {r["score"] for r in got} == {0.0}
