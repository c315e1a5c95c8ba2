"""Weak supervision: held-out accuracy, the split, and the label model."""

import numpy as np

from tilerank.llm import toxicity as T


def test_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    out = T.judge(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == docs.count()
    tp = sum(r["predicted"] and r["toxic"] for r in rows)
    assert tp >= 0.8 * sum(r["toxic"] for r in rows) and tp >= 0.9 * sum(r["predicted"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_labels_change_nothing(spark, docs, sf_dir):
    from pyspark.sql import functions as F

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({(r["doc_id"], round(r["score"], 12)) for r in T.judge(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_edges(spark, weird, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    for notes in (labels, labels.limit(0), labels.where("toxic = 1")):
        got = T.judge(weird, notes).collect()
        assert len(got) == weird.count() and all(0 <= r["score"] <= 1 for r in got)
        assert not [r for r in got if r["doc_id"] is None][0]["held_out"]
    assert T.judge(no_docs, labels).count() == 0
    insult = spark.createDataFrame([(1, "You are an IDIOT."), (2, "A quiet day."), (3, None)], "doc_id long, text string")
    assert [r["predicted"] for r in T.judge(insult, labels.limit(0)).orderBy("doc_id").collect()] == [1, 0, 0]


def test_label_model_finds_accurate_voters():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.2
    names = T.Lexicon.VOTERS
    p = {n: (0.02, 0.02) for n in names} | {"seed": (0.9, 0.01), "word strong": (0.85, 0.02), "masked": (0.3, 0.3), "no hit": (0.05, 0.9), "toxic note": (0.97, 0.01), "clean note": (0.03, 0.97)}
    fires = np.column_stack([rng.random(len(y)) < np.where(y, *p[n]) for n in names])
    bits, counts = np.unique(fires @ (1 << np.arange(len(names))), return_counts=True)
    m = T.LabelModel(bits.astype(np.int64), counts.astype(float), len(names))
    q = m.posterior((fires @ (1 << np.arange(len(names)))).astype(np.int64))
    assert ((q > 0.5) == y).mean() > 0.99
    lift = dict(zip((names[j] for j in m.used), m.theta[1, : m.m] - m.theta[0, : m.m]))
    assert lift["seed"] > 3 and lift["no hit"] < -1.5 and abs(lift["masked"]) < 1


def test_copies_and_long_texts_push_nothing_out(spark):
    """Copies count once for a term, and every term that passes is kept: insults that also occur in clean rows stay beside thousands of stronger terms."""
    letters = "abcdefghijklmnop"
    code = lambda i: "".join(letters[int(d, 16)] for d in f"{i:04x}")
    long_ = " ".join(f"zq{code(i)}" for i in range(3000))
    spread = " ".join(f"yx{code(i)}" for i in range(4500))
    rows = [(f"{long_}", 1)] * 40 + [(f"{spread} {code(i)}", 1) for i in range(12)]
    rows += [(f"such a blorf {code(100 + i)}", 1) for i in range(80)] + [(f"a fine blorf {code(300 + i)}", 0) for i in range(20)] + [(f"quiet day {code(500 + i)}", 0) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    notes = T.training_notes(docs, labels)
    lex = T.mine_lexicon(T.training_texts(docs, notes, 1.0))
    has = lambda w: T.terms_of(w)[0] in set(lex.ids.tolist())
    assert has("blorf") and not has("zq" + code(5)), "the insult stays; a word of one copied text has one text"
    assert all(has(f"yx{code(i)}") for i in range(4500)) and len(lex.ids) > 4000
    per = {(r["y"]): r["n"] for r in notes.groupBy("y").count().withColumnRenamed("count", "n").collect()}
    got = T.training_texts(docs, notes, 1.0).selectExpr("sum(n1) a", "sum(n0) b", "max(n1) m").first()
    assert (got["a"], got["b"]) == (per[1], per[0]) and got["m"] > 20  # rows are all counted for the voters
    scores = {r["doc_id"]: r["score"] for r in T.judge(docs, labels).collect()}
    assert min(scores[i] for i in range(52, 132)) >= T.THRESHOLD > max(scores[i] for i in range(152, 452))


def test_read_of_many_is_read_of_each():
    lex = T.Lexicon(*(np.array(x, t) for x, t in zip(zip(*sorted((t, i % 3 + 1) for i, t in enumerate(T.terms_of("blorfing") + T.terms_of("snark")))), (np.uint64, np.uint8))))
    texts = ["You blorfing idiot", None, "", "BLORF snark", "sn**rk here", "a snark a snark"]
    assert lex.read(texts) == [lex.read([t])[0] for t in texts] and lex.read([]) == []
    v = T.Lexicon.VOTERS.index
    none, some = lex.read(["quiet"])[0], lex.read(["snark"])[0]
    assert none[0] == 1 << v("no hit") and some[1] and not some[0] >> v("no hit") & 1
