"""Spelling variants by permuterm rotations against brute force on edit distance."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tilerank.llm import spelling as S


def damaged_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    ws = damaged_words(rows)
    near = {w: [v for v in ws if abs(len(v) - len(w)) <= 1 and one_edit(v, w)] for w in ws}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-ws[v], v), default=None)
        form[w] = best if best is not None and ws[best] >= 2 * ws[w] else None
    out = []
    for w in ws:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, ws[w], len(near[w]), ws[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted((tuple(r) for r in S.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


def test_documents_equal_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert got(docs) == want and any(r[1] != r[2] for r in want if r[1])


def test_repeated_letters_case_ties_and_chains(spark):
    """Runs of equal letters (one indel, many places), letters next to the ranges' ends, ties of n, a chain of forms, words of one and two letters."""
    rnd = random.Random(3)
    rows, at = [], 0
    counts = {"aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 15, "aaaabaa": 40, "hello": 9, "hallo": 9, "hella": 4, "hell÷": 3, "HELLO": 2, "Àbcde": 5, "àbcde": 11, "zebra": 3, "zebras": 6, "zebrass": 12, "zebrasss": 30}
    counts |= {"".join(rnd.choice("ab") for _ in range(rnd.randrange(4, 8))): rnd.randrange(1, 40) for _ in range(60)}
    for w, n in counts.items():
        for _ in range(n):
            at += 1
            rows.append((at, f"{w} x_1{w}'1 ƀ ¿ a ab 99"))
    rows += [(None, "hello hello hello"), (5, None), (6, ""), (7, "- 1 -")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)


def test_small_tables_of_a_task_and_edges(spark, weird, no_docs, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 3)
    clash = weird.withColumns({c: F.lit("x") for c in ("word", "form", "root", "n_near", "prefix", "last", "once", "ms", "m", "k", "b", "best", "less", "near")})
    assert got(clash) == brute([(r["doc_id"], r["text"]) for r in weird.select("doc_id", "text").collect()])
    assert got(no_docs) == []


def test_damage_of_a_run_that_is_a_cut_run(spark):
    """In one text a cut run may equal another run of it; both count."""
    def crc(d, w):
        return zlib.crc32(f"{d}:{w}".encode())

    hit = next((d, w, w[: crc(d, w) % len(w)] + w[crc(d, w) % len(w) + 1 :]) for d in range(9999) for w in ("letter", "matter") if crc(d, w) % 97 == 0)
    text = f"{hit[1]} {hit[2]} {hit[2]} {hit[1]}"
    assert S.text_words(hit[0], text)[S.MARK + hit[2]] == 2
    assert got(spark.createDataFrame([(hit[0], text)], "doc_id long, text string")) == brute([(hit[0], text)])
