"""The pipeline's stages against plain Python on small tables."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tilerank.llm import mixing, piece_lattice, toxicity

from .test_pairs import brute_classes
from .test_rules_lines import brute_lines

COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    """The documents before each stage, and the last stage's result."""
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, step in C.STAGES:
        docs.append(C.stage(step(spark, docs[-1], sf_dir), "test-stage"))
    return docs


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_and_run(spark, sf_dir, inputs):
    assert [sorted(d.columns) for d in inputs[:-1]] == [sorted(COLS)] * 5 and len({tuple(sorted(d.dtypes)) for d in inputs[:-1]}) == 1
    assert C.run(spark, sf_dir).count() == inputs[-1].count() > 0
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "source_mix", "piece_ids"]


def test_toxicity(spark, sf_dir, inputs):
    scores = toxicity.score(inputs[0], toxicity.fit(inputs[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))).collect()
    assert sorted(d for d, _ in rows(inputs[1])) == sorted(r["doc_id"] for r in scores if r["score"] < 0.3)


def test_lines(inputs):
    texts = [(r["doc_id"], r["th"], r["text"]) for r in inputs[1].select("doc_id", F.xxhash64("text").alias("th"), "text").collect()]
    want = brute_lines(texts)
    kept = {d: want[d, th] for d, th, t in texts if want[d, th] == t or re.search(C.IN_WORD, want[d, th])}
    assert dict(rows(inputs[2])) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in inputs[2].collect() if r["text"] != dict(rows(inputs[1]))[r["doc_id"]])


def test_near_duplicates(inputs):
    before = rows(inputs[2])
    classes = brute_classes(before)
    assert sorted(str(d) for d, _ in rows(inputs[3])) == sorted(d for d, c in classes if d == c)


def test_mix(inputs):
    size, got, text = Counter(), Counter(), {}
    for r in inputs[3].collect():
        n = len(re.findall(mixing.WORD, r["text"] or ""))
        size[r["source"]] += n
        text[r["doc_id"]] = r["text"]
    per = defaultdict(list)
    for r in inputs[4].collect():
        got[r["source"]] += len(re.findall(mixing.WORD, r["text"]))
        per[r["doc_id"]].append(r["text"])
        assert text[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    order = sorted(size)
    t = mixing.targets([size[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))])
    assert [got[s] for s in order] == [int(x) for x in t]
    assert max(map(len, per.values())) <= 2


def test_pieces(inputs):
    import public_tokenizers

    sp = piece_lattice.load_model(public_tokenizers.path("piece_bpe_32k.model")).sp
    out = inputs[5].collect()
    assert all(r["same"] and r["n_tokens"] == len(r["ids"]) for r in out)
    assert Counter(tuple(r["ids"]) for r in out) == Counter(tuple(sp.encode(t)) for _, t in rows(inputs[4]))


def test_edges(spark, sf_dir, weird, no_docs):
    docs = weird.select(*COLS, "h", "rn").withColumn("n_chars", F.col("n_chars").cast("int"))
    for _, step in C.STAGES[:-1]:
        out = C.stage(step(spark, docs, sf_dir), "weird")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
    assert C.STAGES[-1][1](spark, docs, sf_dir).where("not same").count() == 0
    empty = no_docs
    for _, step in C.STAGES:
        empty = step(spark, empty, sf_dir)
    assert empty.count() == 0


#: Names used inside the operators of the stages, some in another case, and two that are awkward to write.
INSIDE = ("score", "th", "AT", "n_lines", "n_removed", "N_spans", "rid", "w", "takes", "take", "size", "d", "key", "rep", "class_id", "copies", "epoch", "block",
          "sid", "bucket", "rn", "h", "p", "carried", "row", "c0", "a.b", "comp", "n", "leader", "ids", "label")


def test_clashing_names(spark, sf_dir, weird):
    """Every stage keeps the values of columns named like its internals, and decides as it does without them."""
    plain = weird.select(*COLS)
    clash = plain.select(*COLS, *(F.concat_ws("/", F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in INSIDE))
    for name, step in C.STAGES[:-1]:
        out, want = C.stage(step(spark, clash, sf_dir), "clash"), C.stage(step(spark, plain, sf_dir), "plain")
        assert out.columns == clash.columns and out.dtypes == clash.dtypes, name
        got = out.collect()
        assert all(r[c] == f"{c}/{'none' if r['doc_id'] is None else r['doc_id']}" for r in got for c in INSIDE), name
        assert Counter(tuple(r[c] for c in COLS) for r in got) == Counter(tuple(r) for r in want.collect()), name
        clash, plain = out, want
    ids = [Counter((r["doc_id"], tuple(r["ids"])) for r in C.STAGES[-1][1](spark, x, sf_dir).collect()) for x in (clash, plain)]
    assert ids[0] == ids[1]


def test_equal_rows(spark, sf_dir):
    """Equal rows are one class (one stays), and separate documents of the mix."""
    df = spark.createDataFrame([(1, "a b c d e f g", "en", "s", 7)] * 3 + [(2, "h i j k l m n", "en", "t", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in C.drop_near_duplicates(spark, df, sf_dir).collect()) == [1, 2]
    words = Counter()
    for r in C.mix_sources(spark, df, sf_dir).collect():
        words[r["source"]] += len(r["text"].split())
    want = mixing.targets([21, 7], [3, 1])
    assert words == {"s": int(want[0]), "t": int(want[1])}
