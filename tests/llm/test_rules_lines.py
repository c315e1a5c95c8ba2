"""Rule ledger and line windows against DuckDB and plain Python."""

import re

import duckdb
import pytest

from tilerank.llm import line_dedup, load_llm, quality_rules as Q
from tools.check_oracles import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("key", ["op3_line_windows", "op7_rule_ledger"])
def test_oracle(spark, sf_dir, key):
    queries, oracles = load_llm()
    df = queries[key](spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    res = con.execute(oracles[key])
    cols = [x[0] for x in res.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def brute_measure(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 500 else {g for g in set(grams) if sum(x == g for x in grams) > 1}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(s) for s in Q.SYMBOLS), len(lines), len(lines) - len(set(lines)),
        len({i + j for i, g in enumerate(grams) if g in twice for j in range(3)}),
        sum(1 for w in words if re.search("[A-Z]", w) and not re.search("[a-z]", w)),
    )


def test_ledger_edges(weird, no_docs):
    got = sorted((tuple(r) for r in Q.ledger(weird).collect()), key=str)
    want = []
    for r in weird.collect():
        m = brute_measure(r["text"])
        v = dict(zip(Q.MEASURES, m))
        bits = sum(1 << i for i, c in enumerate(Q.RULES.values()) if eval(c, {}, v))
        want.append((r["doc_id"], *m, bits))
    assert got == sorted(want, key=str)
    assert Q.ledger(no_docs).count() == 0 and Q.digest(no_docs).count() == 0


def test_ablations(spark, docs):
    led = Q.ledger(docs)
    rows = [r["fail_bits"] for r in led.collect()]
    got = {r["rule"]: r for r in Q.ablations(led, "full-1").collect()}
    for i, rule in enumerate(Q.RULES):
        assert got[rule]["n_failed"] == sum(1 for b in rows if b >> i & 1)
        assert got[rule]["n_failed_alone"] == sum(1 for b in rows if b == 1 << i)
        assert got[rule]["n_kept_without"] == sum(1 for b in rows if b & ~(1 << i) == 0)


def brute_lines(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first, gone = {}, {}
    for d, th, text in order:
        ls = text.split("\n")
        for i in range(len(ls) - 2):
            w = tuple(ls[i : i + 3])
            if any(x.strip(" ") for x in w) and first.setdefault(w, (d, th, i)) != (d, th, i):
                gone.setdefault((d, th), set()).update((i, i + 1, i + 2))
    return {(d, th): "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get((d, th), ())) for d, th, t in order}


def test_lines_edges(weird, no_docs):
    from pyspark.sql import functions as F

    texts = [tuple(r) for r in weird.where("text IS NOT NULL").select("doc_id", F.xxhash64("text"), "text").collect()]
    want = brute_lines(texts)
    got = line_dedup.line_dedup(weird, ("lang", "source")).collect()
    assert len(got) == weird.count()
    assert sorted((r["text"] for r in got if r["text"] is not None)) == sorted(want[d, th] for d, th, _ in texts)
    null = [r for r in got if r["text"] is None]
    assert [(r["n_lines"], r["n_removed"], r["n_spans"]) for r in null] == [(0, 0, 0)]
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_hot_window_is_whole(spark):
    block = "shared one\nshared two\nshared three"
    df = spark.range(3000).selectExpr("id AS doc_id", f"concat('own ', id, '\n{block}\nend ', id) AS text")
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(df).collect()}
    assert got[0] == f"own 0\n{block}\nend 0" and all(got[i] == f"own {i}\nend {i}" for i in range(1, 3000))
