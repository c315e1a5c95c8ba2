"""Token files, source mix and URL filter."""

import glob
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tilerank.llm import mixing, token_files as TF, url_filter as U

public_tokenizers = pytest.importorskip("public_tokenizers")


def brute_ids(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in rows]


def test_token_files_equal_whole_text_encoding(spark, docs, tmp_path):
    manifest = TF.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), folder=str(tmp_path / "a"), parts=5, seq_len=64)
    got = sorted(tuple(r) for r in TF.read_digest(manifest).collect())
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want, at = [], 0
    for (d, _), ids in zip(rows, brute_ids([t for _, t in rows])):
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_token_files_random_access(spark, tmp_path):
    df = spark.createDataFrame([(i, f"w{i} " * (i * 7 % 50)) for i in range(60)], "doc_id long, text string")
    m = TF.write_token_files(df, public_tokenizers.path("word_bpe_49k.json"), folder=str(tmp_path / "b"), parts=2, seq_len=16).orderBy("part", "seq").collect()
    ids = [i for x in brute_ids([f"w{i} " * (i * 7 % 50) for i in range(60)]) for i in x]
    stream = []
    for r in m:
        shard = TF.TokenShard(r["path"])
        seqs = [shard.sequence(i) for i in range(r["n_sequences"])]
        mask = [shard.sequence(i, "mask") for i in range(r["n_sequences"])]
        assert not seqs[0].flags.owndata and all(len(s) == 16 for s in seqs)
        assert int(np.concatenate(mask).sum()) == r["n_tokens"]
        stream += np.concatenate(seqs)[np.concatenate(mask) == 1].tolist()
        assert shard.tokens(3, 40).tolist() == stream[-r["n_tokens"] :][3:43]
    assert stream == ids


def test_token_files_edges(weird, no_docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in TF.read_digest(TF.write_token_files(weird, path)).collect()))
    rows = weird.select("doc_id", "text").collect()
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, x in zip(rows, brute_ids([r["text"] for r in rows])))
    assert got == want
    assert TF.read_digest(TF.write_token_files(no_docs, path)).count() == 0


class Counted:
    """A tokenizer that counts the characters it is given."""

    given = 0

    def __init__(self, tok):
        self.tok = tok

    def __getattr__(self, name):
        return getattr(self.tok, name)

    def encode_batch_fast(self, texts, **kw):
        Counted.given += sum(map(len, texts))
        return self.tok.encode_batch_fast(texts, **kw)


def test_runs_of_known_letters_are_encoded_once(monkeypatch):
    enc = TF.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for k, v in vars(enc).items():
        if type(v).__name__ == "Tokenizer":
            monkeypatch.setattr(enc, k, Counted(v))
    words = [f"{a}{b}wörtchen" for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [" ".join(form.format(w) for w in words) for form in ("{}", "{},", "\u201c{}\u201d", "({})", "{}!!", "{}'s", "1{}2")] + [" ".join(words).title()]
    Counted.given = 0
    ids, counts = enc.encode(texts, 1)
    assert np.split(ids, np.cumsum(counts)[:-1])[2].tolist() == brute_ids(texts)[2] and ids.tolist() == [i for x in brute_ids(texts) for i in x]
    assert 0 < Counted.given <= 1.2 * sum(len(w) + 1 for w in words)


def test_runs_equal_whole_text_encoding(monkeypatch):
    fast = [c for c in map(chr, range(0x2100)) if re.fullmatch(f"[0-9{TF.LETTERS}{TF.MARKS}]", c)]
    texts = [f"{c} a{c}b {c}{c} '{c} {c}' A{c}{c}S 1{c}1 .{c}. {c}\u0301" for c in fast]
    texts += ["it's 'Sam I'LL'd <|startoftext|> x<|EndOfText|>y <|endoftext|>. </w> a\u030a, \u0130\u0131 \u03a3\u03a3 a\x1cb \xa0c\x85d", None, "", " \n", "caf\xe9... CAFE\u0301"]
    monkeypatch.setattr(TF, "CACHE_WORDS", 50)
    enc = TF.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for some in (texts, texts[::-1], texts[:20], texts):
        ids, counts = enc.encode(some, 1)
        want = brute_ids(some)
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    with pytest.raises(UnicodeEncodeError):
        enc.encode(["neu", "\ud800"], 1)
    assert enc.encode(["neu"], 1)[0].tolist() == brute_ids(["neu"])[0]


def test_other_tokenizers_get_whole_texts(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}  # not cut at white space
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    texts = ["the cat sat", None, "on  the mat, the cat"]
    ids, counts = TF.WordEncoder(path).encode(texts, 1)
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("name", ["docs", "weird"])
def test_mix(request, name):
    df = request.getfixturevalue(name)
    got = mixing.taken(df).collect()
    assert len(got) == df.count()
    sizes = [len(re.findall(mixing.WORD, r["text"] or "")) for r in df.select("text").collect()]
    assert sorted(r["size"] for r in got) == sorted(sizes)
    per, size, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        per[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert r["target"] <= 2 * r["source_size"]
    assert all(per[s] == int(target[s]) for s in target) and all(size[s] == x for s, x in {r["source"]: r["source_size"] for r in got}.items())
    again = mixing.taken(df.repartition(7)).collect()
    key = lambda rows: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rows)
    assert key(again) == key(got)


def test_mix_targets_and_empty(no_docs):
    assert [float(x) for x in mixing.targets([100, 100, 10], [3, 1, 2])] == [200.0, 95.0, 20.0]
    assert mixing.targets([0, 0], [3, 1]) == [0, 0] and mixing.taken(no_docs).count() == 0


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([("a", 0, 0, 0.0, 128 * 700, 1), ("b", 1, 0, 0.0, 128 * 250 - 5, 1), ("c", 2, 0, 0.0, 0, 1)], "source string, sid int, source_size long, target double, take long, n_docs long")
    rows = mixing.schedule(sources).orderBy("slot").collect()
    by = defaultdict(list)
    for k, r in enumerate(rows):
        by[r["sid"]].append((k, r["block"]))
    assert {s: [b for _, b in x] for s, x in by.items()} == {0: list(range(700)), 1: list(range(250))}
    worst = max(abs(k * 700 / 950 - b) for k, b in by[0])
    assert worst < 12


def test_urls(spark):
    urls = [
        ("http://A.Example.ORG/en/123?x=1", "a.example.org", "/en/123", "example.org/en/1", "block"), ("https://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
        ("http://x.org", "x.org", "", None, None), ("ftp://x.org/a#b", "x.org", "/a", "org/", "allow"), ("nothing", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
        ("http://shop.com/de/1", "shop.com", "/de/1", "com/de/", "block"), ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"), ("http://notcom/fr/", "notcom", "/fr/", None, None),
        ("http://x.com/en/?u=http://y.org/", "x.com", "/en/", None, None), ("http://" + "l" * 50000 + ".net/" + "é" * 50000, "l" * 50000 + ".net", "/" + "é" * 50000, None, None),
    ]
    df = spark.createDataFrame([(i, u[0], "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in U.judge(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block") and verdict in (None, r["verdict"])
    assert U.judge(df.limit(0)).count() == 0
    only = U.judge(df.where("page_id IN (1, 4)")).collect()
    assert {r["verdict"] for r in only} == {"block"}


def test_url_trees_agree_with_held_out_rules(spark, sf_dir):
    """Trained on the rules' labels of half of the URLs, the trees find the labels of the others."""
    pages = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/pages.parquet")
    rows = U.judge(pages).where("rule IS NOT NULL").collect()
    right = sum((r["p_block"] >= 0.5) == (r["verdict"] == "block") for r in rows)
    assert right >= 0.95 * len(rows)
