"""Toxicity by weak supervision.

1. *Lexicons.* Terms (words and their first four to seven letters) of the labelled training rows are counted over all of those rows, each
   distinct text once per label; every term whose texts are toxic more often than not (lower Wilson bound) enters a lexicon, by kind
   and strength. There is no cap: terms are 64-bit ids in one sorted table of 9 bytes a term (17 with the weights), which the
   voters, the regression and the scores search. A short fixed list of insults is the seed lexicon.
2. *Voters.* Every lexicon, some patterns, the absence of any hit, and the annotation itself vote or abstain on each training row.
3. *Label model.* A generative model over the vote patterns with a hidden class: one weight per voter and class (its accuracy and coverage) and one
   per correlated pair of voters, fitted by EM. The rows enter as counts per vote pattern (``2^voters`` at most, combined before the shuffle), so
   the fit on the driver has a fixed size; expectations are exact sums over all patterns.
4. *Classifier.* Logistic regression on lexicon terms and patterns, trained on the posterior labels of at most ``TRAIN_ROWS`` rows (a hash sample);
   every row counts once as toxic and once as clean, weighted by its posterior.
5. *Scores.* Every whole text gets the regression's probability. Neither labels nor lang, source or doc_id enter a score.

Rows whose crc32(doc_id as text) mod 4 is 2 are held out of steps 1 to 4.

Defined cases: null and empty texts score as a text without words; a doc_id labelled twice is toxic if half of its labels or more are; null labels
are no labels; repeated rows score the same; a null doc_id is never held out; without labels of both classes the
score is 0.9 for a seed-lexicon hit and 0.05 else; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, stage, text_slices

#: Fixed seed lexicon.
SEED = ("clown", "dumb", "garbage", "idiot", "idiots", "loser", "losers", "moron", "morons", "pathetic", "scum", "stupid", "trash", "vermin", "worthless")
#: Letters of the prefixes counted beside whole words.
PREFIXES = (4, 5, 6, 7)
#: Standard errors of the Wilson bound: rare terms need many toxic rows, as very many terms are tried.
WILSON_Z = 2.5
#: A term must occur in MIN_TOXIC different toxic training texts.
MIN_TOXIC = 3
STRONG, WEAK = 0.8, 0.5
#: Rows that train the regression at most.
TRAIN_ROWS = 40_000
HELD_OUT_MOD, HELD_OUT = 4, 2
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20

WORD = re.compile(r"[^\W\d_]+")
ADDRESSED = re.compile(r"\b(?:you|your|du|ihr|tu|vous|usted|eres)\b[^.!?\n]{0,30}\b(?:" + "|".join(SEED) + r")\b")
MASKED = re.compile(r"\b[a-z]+\*{2,}[a-z]+\b")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MOD == HELD_OUT, F.lit(False))


def terms_of(word: str) -> list[int]:
    """Ids of a word's terms: the word and its first letters, by 61 bits of a hash; the low three bits tell the kind (0 or the prefix's letters)."""
    out = [xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~7]
    out += [xxhash.xxh3_64_intdigest(word[:k].encode("utf-8", "surrogatepass")) & ~7 | k for k in PREFIXES if len(word) > k]
    return out


def words_of(texts: list[str | None]) -> tuple[list[str], list[set[str]]]:
    """(lower-case text, its set of words) of each text."""
    low = [(t or "").lower() for t in texts]
    return low, [set(WORD.findall(t)) for t in low]


@dataclass
class Lexicon:
    """Terms of the model as sorted ids (a term's place is its feature) with their voters; and the patterns that follow them as features."""

    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    voters: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint8))

    VOTERS = ("seed", "word strong", "word weak", *(f"prefix {k}" for k in PREFIXES), "prefix weak", "addressed", "masked", "several hits", "no hit", "toxic note", "clean note")
    #: Those of them that read the text only.
    TEXT_VOTERS = len(VOTERS) - 2
    N_PATTERNS = 5

    @property
    def size(self) -> int:
        return len(self.ids) + self.N_PATTERNS

    def _hits(self, words: set[str]) -> dict[str, list[int]]:
        """word -> features, of the words that have any."""
        words = list(words)
        terms = [terms_of(w) for w in words]
        flat = np.array([t for ts in terms for t in ts], np.uint64)
        if not len(flat) or not len(self.ids):
            return {}
        at = np.searchsorted(self.ids, flat)
        found = np.flatnonzero(self.ids[np.minimum(at, len(self.ids) - 1)] == flat)
        owner = np.repeat(np.arange(len(words)), [len(ts) for ts in terms])
        out: dict[str, list[int]] = {}
        for i, f in zip(owner[found].tolist(), at[found].tolist()):
            out.setdefault(words[i], []).append(f)
        return out

    def read(self, texts: list[str | None]) -> list[tuple[int, list[int]]]:
        """(vote bits of the text voters, active features) of each text; a word is looked up once for all of them."""
        low, words = words_of(texts)
        hits, n, v = self._hits(set().union(*words)), len(self.ids), self.VOTERS.index
        names = [1 << v(x) for x in ("seed", "addressed", "masked", "several hits", "no hit")]
        bits_of = {w: sum({1 << int(self.voters[f]) for f in fs}) for w, fs in hits.items()}
        out = []
        for t, ws in zip(low, words):
            seeds, roots = ws.intersection(SEED), ws & hits.keys()
            flags = [bool(seeds), bool(seeds) and bool(ADDRESSED.search(t)), "*" in t and bool(MASKED.search(t)), len(roots | seeds) > 1, not roots and not seeds]
            bits = 0
            for w in roots:
                bits |= bits_of[w]
            for one, on in zip(names, flags):
                bits |= one * on
            out.append((bits, sorted({*(f for w in roots for f in hits[w]), *(n + i for i, on in enumerate(flags) if on)})))
        return out


def _key(text: str) -> Column:
    return F.coalesce(F.md5(F.col(text).cast("string")), F.lit(""))


def training_notes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, key, y) of the labelled rows that are not held out; ``key`` is the text's md5."""
    notes = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("y"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key("text").alias("key"))
    return rows.where(~held_out(F.col("doc_id"))).join(notes.where(~held_out(F.col("doc_id"))).hint("merge"), "doc_id")


def training_texts(docs: DataFrame, notes: DataFrame, keep: float) -> DataFrame:
    """(text, n1, n0, s1, s0) per distinct text of ``notes``: its toxic and clean rows, and those of them in the hash sample of share ``keep``."""
    chosen = F.lit(True) if keep == 1.0 else F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 20)) < int(keep * (1 << 20))
    count = lambda on, name: F.sum(on.cast("long")).alias(name)
    toxic = F.col("y") == 1
    per = notes.groupBy("key").agg(count(toxic, "n1"), count(~toxic, "n0"), count(toxic & chosen, "s1"), count(~toxic & chosen, "s0"))
    open_ = docs.where(~held_out(F.col("doc_id").cast("long"))).select(_key("text").alias("key"), F.col("text").cast("string").alias("text"))
    texts = open_.groupBy("key").agg(F.first("text").alias("text"))  # copies are combined before the shuffle
    return texts.join(per.hint("merge"), "key").drop("key")


def mine_lexicon(train: DataFrame) -> Lexicon:
    """Count terms over all training texts, each once per label, and keep all that tell toxic ones."""

    def emit(batches):
        for b in text_slices(batches, "text", SLICE_BYTES):
            _, words = words_of(b.column("text").to_pylist())
            ids = {w: terms_of(w) for w in set().union(*words)}
            terms = [list({t for w in ws for t in ids[w]}) for ws in words]
            flat = pa.array(np.array([t for ts in terms for t in ts], np.uint64).view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(ts) for ts in terms])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("t"), b.column("n"), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["t", "n", "terms"])

    once = train.select("text", (F.col("n1") > 0).cast("int").alias("t"), ((F.col("n1") > 0).cast("int") + (F.col("n0") > 0).cast("int")).alias("n"))
    per = once.mapInArrow(lean(emit), "t int, n int, terms array<long>").select("t", "n", F.explode("terms").alias("term"))
    counts = per.groupBy("term").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).where(F.col("t") >= MIN_TOXIC)
    p, n, z = F.col("t") / F.col("n"), F.col("n"), WILSON_Z
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    best = counts.withColumn("low", low).where(F.col("low") >= WEAK).select("term", (F.col("low") >= STRONG).alias("strong")).toArrow()
    ids, strong = best.column("term").to_numpy().view(np.uint64), best.column("strong").to_numpy()
    order = np.argsort(ids)
    ids, strong = ids[order], strong[order]
    name = lambda kind, on: f"word {'strong' if on else 'weak'}" if kind == 0 else f"prefix {kind}" if on else "prefix weak"
    voter = np.array([[Lexicon.VOTERS.index(name(k, on)) if k in (0, *PREFIXES) else 0 for on in (False, True)] for k in range(8)], np.uint8)
    return Lexicon(ids, voter[(ids & np.uint64(7)).astype(int), strong.astype(int)])


def votes(train: DataFrame, lex: Lexicon) -> DataFrame:
    """(bits, active, n, s): all votes and active features of each training text and label, its rows and its rows in the sample."""
    held = spark_broadcast(train, lex)

    def emit(batches):
        lex = held.value
        for b in text_slices(batches, "text", SLICE_BYTES):
            got = lex.read(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _ in got], pa.int64()), pa.array([a for _, a in got], pa.list_(pa.int32())), *(b.column(c) for c in ("n1", "n0", "s1", "s0"))],
                names=["read", "active", "n1", "n0", "s1", "s0"],
            )

    pos, neg = (1 << Lexicon.VOTERS.index(x) for x in ("toxic note", "clean note"))
    per = train.select("text", "n1", "n0", "s1", "s0").mapInArrow(lean(emit), "read long, active array<int>, n1 long, n0 long, s1 long, s0 long")
    note = lambda bit, n, s: F.struct(F.col("read").bitwiseOR(F.lit(bit).cast("long")).alias("bits"), F.col(n).alias("n"), F.col(s).alias("s"))
    both = per.select("active", F.explode(F.array(note(pos, "n1", "s1"), note(neg, "n0", "s0"))).alias("x"))
    return both.select("x.bits", "active", "x.n", "x.s").where("n > 0")


class LabelModel:
    """p(votes, class) with a weight per voter and class and one per correlated pair, by EM over counts of vote patterns.

    log p(v | c) = a_c . v + sum over pairs b_jk v_j v_k - log Z_c. Only voters that fired on some but not all rows take part.
    """

    def __init__(self, bits: np.ndarray, counts: np.ndarray, n_voters: int, max_pairs: int = 12, rounds: int = 6, steps: int = 100):
        v = (bits[:, None] >> np.arange(n_voters)) & 1
        share = counts @ v / counts.sum()
        self.used = np.flatnonzero((share > 0) & (share < 1))
        v, w = v[:, self.used].astype(float), counts / counts.sum()
        m = len(self.used)
        names = [Lexicon.VOTERS[j] for j in self.used]
        note = {n: v[:, i] for i, n in enumerate(names)}
        none = np.zeros(len(v))
        q = 0.1 + 0.88 * note.get("toxic note", none) - 0.099 * note.get("clean note", none)  # starts from the annotation, as one good voter
        # Correlations: covariance within the classes of the first guess.
        cov = np.zeros((m, m))
        for k in (q, 1 - q):
            mean = (w * k) @ v / max((w * k).sum(), 1e-12)
            cov += (v - mean).T @ ((v - mean) * (w * k)[:, None])
        d = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        corr = np.triu(np.abs(cov / d / d[:, None]), 1)
        self.pairs = [divmod(int(i), m) for i in np.argsort(-corr, axis=None)[: min(max_pairs, m * (m - 1) // 2)] if corr.flat[i] > 0.1]
        grid = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)
        feats = lambda x: np.column_stack([x, *(x[:, i] * x[:, j] for i, j in self.pairs)]) if self.pairs else x
        g, x = feats(grid), feats(v)
        theta = np.zeros((2, g.shape[1]))
        theta[:, :m] = np.log(np.clip([((1 - q) * w) @ v / ((1 - q) @ w), (q * w) @ v / (q @ w)], 1e-3, 1 - 1e-3))
        theta[:, m:] = 0
        self.prior = np.array([(1 - q) @ w, q @ w])
        for _ in range(rounds):
            rows = np.column_stack([1 - q, q]) * w[:, None]
            want = (rows.T @ x) / rows.sum(0)[:, None]
            for _ in range(steps):
                s = g @ theta.T
                p = np.exp(s - s.max(0))
                p /= p.sum(0)
                have = p.T @ g
                grad = want - have - 1e-3 * theta
                grad[:, m:] = (grad[:, m:] * self.prior[:, None]).sum(0)  # a pair's weight is shared by the classes
                theta += 2.0 * grad
            self.prior = np.clip(rows.sum(0), 1e-4, 1)
            s = g @ theta.T
            self.log_z = s.max(0) + np.log(np.exp(s - s.max(0)).sum(0))
            self.theta, self.m = theta, m
            q = self._posterior(x)
        self._feats = feats

    def _posterior(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.theta.T - self.log_z + np.log(self.prior)
        return 1 / (1 + np.exp(np.clip(s[:, 0] - s[:, 1], -50, 50)))

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        return self._posterior(self._feats(((bits[:, None] >> self.used) & 1).astype(float)))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        s = np.array([self.weights[active].sum() for _, active in self.lexicon.read(texts)], float)
        return 1 / (1 + np.exp(-np.clip(self.bias + s, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Steps 1 to 4 of the module's text."""
    spark = docs.sparkSession
    notes = stage(training_notes(docs, labels), "toxic-notes")
    seen = {r["y"]: r["n"] for r in notes.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        lex = Lexicon()
        weights = np.zeros(lex.size)
        weights[0] = np.log(0.9 / 0.1) - np.log(0.05 / 0.95)
        return ToxicityModel(lex, weights, float(np.log(0.05 / 0.95)))
    train = stage(training_texts(docs, notes, min(1.0, train_rows / sum(seen.values()))), "toxic-train")
    lex = mine_lexicon(train)
    voted = stage(votes(train, lex), "toxic-votes")
    counts = voted.groupBy("bits").agg(F.sum("n").alias("n")).collect()  # 2^voters rows at most
    bits = np.array([r["bits"] for r in counts], np.int64)
    model = LabelModel(bits, np.array([r["n"] for r in counts], float), len(Lexicon.VOTERS))
    post = spark.createDataFrame([(int(b), float(q)) for b, q in zip(bits, model.posterior(bits))], "bits long, q double")
    q, s = F.col("q"), F.col("s")
    rows = voted.where("s > 0").join(F.broadcast(post), "bits").groupBy("active").agg(F.sum(q * s).alias("q1"), F.sum((1 - q) * s).alias("q0"))
    size = lex.size
    vector = F.udf(lambda a: SparseVector(size, sorted(a), [1.0] * len(a)), VectorUDT())
    both = rows.select(vector("active").alias("features"), F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("q1").alias("w")), F.struct(F.lit(0.0).alias("label"), F.col("q0").alias("w")))).alias("x"))
    data = stage(both.select("features", "x.label", "x.w").where("w > 1e-9"), "toxic-regression")
    lr = LogisticRegression(weightCol="w", regParam=1e-5, maxIter=100, standardization=False).fit(data)
    return ToxicityModel(lex, lr.coefficients.toArray(), float(lr.intercept))


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, and ``score`` of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c for c in keep if c != "text"])
    held = spark_broadcast(rows, model)
    names = ["doc_id", *keep]

    def emit(batches):
        m = held.value
        for b in text_slices(batches, "text", SLICE_BYTES):
            s = m.score(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(s, pa.float64())], names=[*names, "score"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(lean(emit), ", ".join([f"`{n}` {kinds[n]}" for n in names] + ["score double"]))


def spark_broadcast(df: DataFrame, value):
    """A broadcast variable; a lexicon takes 9 bytes a term, a model 17."""
    return df.sparkSession.sparkContext.broadcast(value)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
