"""Spelling variant grouping by permuterm rotations: words one insertion, deletion or replacement apart, and the form and root of each word.

Words come from the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z lower-cased. With h = crc32 of ``<doc_id>:<run>``, a run whose h is divisible by
``DAMAGE`` loses its code point h % length (planted misspellings). Results of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences are the words.

Method. A word w marked with the terminator, ``w$``, has the rotations ``b$a`` for every cut w = ab. Rotating so that the edited character c of w = a c b comes last
gives ``b$a`` + c: all words that differ from w in that character only have rotations with the same prefix ``b$a`` and one more character, and the word without it
has ``b$a`` as a whole rotation. So the rotations are grouped (sorted) by the prefix that skips the edited character. In a group the last characters differ, so that it has at most
one member per character of the alphabet and one whole rotation (91), whatever the table's size. Two of the former are a replacement; one of the former and the whole one
are an indel. A run of equal letters gives the same indel at each of its places: only its last place counts, so every near pair meets exactly once.
A group emits one row per member: how many neighbours it has there and the best of them; no pairs.

A word's form is its near word of largest n (ties: smallest in code-point order) if that n is at least ``RATIO`` times its own. n at least doubles from form to form, so
following forms ends after log2(n) steps; roots are found by pointer doubling, log2 of that in rounds.

Plan. Words are counted in the tasks that read the texts (tables of at most ``FLUSH`` words, then sent on), so a word of a third of all occurrences travels as a few partial counts.
What is shuffled after that grows with the vocabulary only.

Defined cases: null and empty texts have no run; a null doc_id is written as nothing before the colon; rows that repeat count each time; a table
without words gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_slices

MARK = "$"
DAMAGE = 97
MIN_LENGTH, MIN_COUNT = 5, 3
RATIO = 2
SLICE_BYTES = 8 << 20
#: Words held by a task before their counts are sent on.
FLUSH = 1 << 18
RUN = re.compile("[a-zÀ-ÿ]+")


def text_words(doc_id: int | None, text: str | None) -> Counter:
    """Occurrences of the words of one text, damage included."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes lower-case A-Z only
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs = Counter(RUN.findall(low))
    for run, n in list(runs.items()):
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            del runs[run]
            cut = run[:at] + run[at + 1 :]
            runs[MARK + cut] += n  # under another name: the shorter run may still have to be looked at
    return runs


def _counts(batches):
    held: Counter = Counter()

    def sent():
        words = [w for w in held if len(w) >= MIN_LENGTH]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], names=["word", "n"])

    for b in text_slices(batches, "text", SLICE_BYTES):
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            for word, n in text_words(doc_id, text).items():
                held[word.lstrip(MARK)] += n
            if len(held) >= FLUSH:
                yield sent()
                held.clear()
    yield sent()


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def rotations(counted: DataFrame) -> DataFrame:
    """(prefix, last, once, word, n): all rotations of the marked words, as prefix and skipped last character (none for a whole rotation).

    ``once`` marks the one place of a run of equal letters at which its indel counts (true for whole rotations).
    """
    cut = f"concat(substring(word, {{0}}), '{MARK}', substring(word, 1, i - 1))"
    skip = f"transform(sequence(1, length(word)), i -> struct({cut.format('i + 1')} AS prefix, substring(word, i, 1) AS last, substring(word, i, 1) <> substring(word, i + 1, 1) AS once))"
    whole = f"transform(sequence(1, length(word) + 1), i -> struct({cut.format('i')} AS prefix, '' AS last, true AS once))"
    return counted.select("word", "n", F.explode(F.expr(f"concat({skip}, {whole})")).alias("r")).select("r.*", "word", "n")


def neighbours(counted: DataFrame) -> DataFrame:
    """(word, n_near, best): number of near words and the best of them, struct (less = -n, word), for words that have any."""
    member = F.struct((-F.col("n")).alias("less"), "word", "last", "once")
    groups = rotations(counted).groupBy("prefix").agg(F.collect_list(member).alias("ms")).where(F.size("ms") > 1)
    near = F.expr("filter(ms, o -> o.word <> m.word AND ((o.last <> '' AND m.last <> '') OR (o.last = '' AND m.once) OR (m.last = '' AND o.once)))")
    each = groups.select("ms", F.explode("ms").alias("m")).select(F.col("m.word").alias("word"), near.alias("near")).where(F.size("near") > 0)
    best = F.expr("array_min(transform(near, o -> struct(o.less AS less, o.word AS word)))")
    return each.select("word", F.size("near").cast("long").alias("k"), best.alias("b")).groupBy("word").agg(F.sum("k").alias("n_near"), F.min("b").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word on each word's way along ``forms`` (word, form), of the words that have a form."""
    at = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = stage(at.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        at = step.select("word", "root")
        if step.where("moved").limit(1).count() == 0:
            return at


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row per word."""
    counted = stage(words(docs), "spelling-words")
    near = neighbours(counted)
    has = -F.col("best.less") >= RATIO * F.col("n")
    found = counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")
    )
    found = stage(found, "spelling-forms")
    out = found.join(roots(found.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
