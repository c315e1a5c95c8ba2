"""The piece lattice against the sentencepiece library."""

import random

import pytest

from tilerank.llm import piece_lattice as L

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return L.load_model(PATH)


def ids_of(model, texts):
    flat, counts = model.encode(texts)
    out, at = [], 0
    for c in counts:
        out.append(flat[at : at + c].tolist())
        at += c
    return out


def test_random_texts_equal_the_library(model):
    rnd = random.Random(4)
    sets = ["ab ", "aeinrst ", "the ing ", " \n\t", "éüñßç a", "漢字かな한국 ", "01239 .,;", "▁ a", "zq́xé👍🏽‍", "\x00\x01a ", "==--__ ", "    a"]
    texts = ["".join(rnd.choice(s) for _ in range(rnd.randrange(1, 60))) for s in sets for _ in range(60)]
    texts += [" " * k for k in range(1, 40)] + ["a" * k for k in range(1, 40)] + ["", None, "<s> </s> <unk> <0x41>"]
    got = ids_of(model, texts)
    for t, g in zip(texts, got):
        assert g == model.sp.encode(t or ""), repr(t)
    for t, g in zip(texts, got):
        assert model.decode(g) == (t or "").replace("▁", " ") and model.decode(g) == model.sp.decode(g)


def test_documents_equal_the_library(spark, docs, model):
    got = {r["doc_id"]: r for r in L.round_trip(docs, PATH).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]]["ids"] == model.sp.encode(r["text"] or "") and got[r["doc_id"]]["same"]
        assert got[r["doc_id"]]["n_tokens"] == len(got[r["doc_id"]]["ids"])


def test_edges(spark, weird, no_docs, model):
    rows = weird.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), model.sp.encode(r["text"] or "")) for r in rows)
    got = L.round_trip(weird, PATH).collect()
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want and all(r["same"] for r in got)
    assert L.round_trip(no_docs, PATH).count() == 0
    long_word = spark.createDataFrame([(1, "xyz" * 20000)], "doc_id long, text string")
    assert L.round_trip(long_word, PATH).first()["ids"] == model.sp.encode("xyz" * 20000)
    nulls = spark.createDataFrame([(1, None), (2, [5, 6])], "doc_id long, ids array<int>")
    assert [r["decoded"] is None for r in L.decode(nulls, PATH).orderBy("doc_id").collect()] == [True, False]
