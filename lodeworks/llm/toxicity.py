"""Toxicity by maximum-scoring segments: token log-odds with an informative Dirichlet prior [Monroe et al. 2008] of texts,
of either sign where they are MIN_Z standard errors away from zero, less a drift, make each token's score; a linear-time scan
finds every maximal-scoring segment [Ruzzo and Tompa 1999]; extreme-value statistics [Karlin and Altschul 1990], whose
lambda and K are fitted to the segments of texts labelled 0, say which are significant in a text of that length, and a
logistic curve over their summed evidence gives the score.

Learning reads labelled rows outside the held-out fold only, and of those at most MAX_LABELLED (the ones with the
smallest hash of the id), so that their ids may be broadcast and no text is shuffled. The model holds every word of those
texts, and beginning of one, with such log-odds; the bound on rows bounds it. Scoring is one pass over
all texts.

Defined cases: null and empty texts have no segments and get the score of a text without any; a null id is not held
out and never learnt from; of several labels of an id the largest counts, null labels count as none; without labels of
both kinds the model is empty and every score 0; repeated rows get equal rows; extra columns pass by unread.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, alnum_words, byte_codes, mix, runs_of_text, table

#: Most labelled rows that are read for learning.
MAX_LABELLED = 20_000
#: Weight of the prior as a share of the learning texts, standard errors that log-odds must be away from zero, drift per
#: token, largest log-odds.
PRIOR, MIN_Z, DRIFT, MOST = 0.1, 4.0, 0.3, 8.0
#: Lengths (bytes) of the beginnings of words that are features too, longest first.
PREFIXES = (6, 5, 4)
DOCS = np.uint64(1)
#: Expected number of chance segments below which one is significant.
MAX_E = 0.05
BINS = 400


def folds(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end exclusive, score) of a sequence. Linear in its length: Ruzzo and Tompa's
    list with links back, over the positive scores only."""
    found: list[list[float]] = []  # start, end, total before, total after
    link: list[int] = []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    at = np.flatnonzero(scores > 0)
    for i, before, after in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist(), strict=True):
        now = [i, i + 1, before, after]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j = link[j]
            if j < 0 or found[j][3] >= now[3]:
                found.append(now)
                link.append(j)
                break
            now = [found[j][0], now[1], found[j][2], now[3]]
            del found[j:], link[j:]
    return [(int(a), int(b), r - l) for a, b, l, r in found]


class Model:
    """Word hashes (ascending) with their log-odds, and the constants of the extreme-value law and the logistic curve."""

    def __init__(self, words: np.ndarray, odds: np.ndarray, lam: float = 1.0, k: float = 1.0, a: float = 0.0, b: float = 1.0):
        self.words, self.odds, self.lam, self.k, self.a, self.b = words, odds, lam, k, a, b

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> tuple[float, list]:
        """Summed -ln E of the significant segments, and those."""
        out, kept = 0.0, []
        for start, end, s in found:
            log_e = math.log(self.k * max(n, 1)) - self.lam * s
            if log_e <= math.log(MAX_E):
                out -= log_e
                kept.append((start, end, s, log_e))
        return out, kept

    def score(self, x: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.a + self.b * x)))) if len(self.words) else 0.0

    def found(self, texts: pa.Array):
        """(n words, maximal segments) of each text."""
        inside = alnum_words()
        codes = byte_codes(True, inside)
        for low, high, data, offsets in runs_of_text(texts):
            w = Words(data, offsets, inside, codes)
            score = np.zeros(len(w.hash))
            if len(self.words):
                open_ = np.ones(len(score), bool)
                for f in features(w, codes):  # the word itself, else its longest known beginning
                    where = np.minimum(np.searchsorted(self.words, f), len(self.words) - 1)
                    known = open_ & (self.words[where] == f)
                    score[known] = self.odds[where[known]]
                    open_ &= ~known
            score -= DRIFT
            some = np.concatenate([[0], np.cumsum(score > 0)])
            for i in range(high - low):
                a, b = int(w.first[i]), int(w.first[i + 1])
                yield b - a, segments(score[a:b]) if some[b] > some[a] else []

    def scan(self, texts: pa.Array):
        """(n words, evidence, significant segments) of each text."""
        for n, found in self.found(texts):
            yield n, *self.evidence(found, n)


def features(w: Words, codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word and, for longer words, of its PREFIXES: so inflected forms that were not learnt still count."""
    out = [w.hash]
    size = w.end - w.start
    for k in PREFIXES:
        part = np.zeros(len(size), np.uint64)
        for j in range(k):
            at = np.minimum(w.start + j, len(w.data) - 1)
            part = (part + codes[w.data[at]]) * np.uint64(0xD6E8FEB86659FD93)
        out.append(np.where(size > k, mix(part + np.uint64(k)), np.uint64(0)))
    return out


def _count(batches):
    """Texts of each kind in which a feature occurs, summed over a partition; the feature DOCS holds their totals."""
    inside = alnum_words()
    codes = byte_codes(True, inside)
    hashes, counts = [], []

    def merge():
        u, back = np.unique(np.concatenate(hashes), return_inverse=True)
        t = np.concatenate(counts)
        hashes[:], counts[:] = [u], [np.stack([np.bincount(back, weights=t[:, k], minlength=len(u)) for k in (0, 1)], 1)]

    for batch in batches:
        label = np.asarray(batch.column("y").to_pylist(), np.int64)
        for low, high, data, offsets in runs_of_text(batch.column("text")):
            w = Words(data, offsets, inside, codes)
            every = features(w, codes)
            for i in range(high - low):
                part = slice(w.first[i], w.first[i + 1])
                u = np.unique(np.concatenate([f[part] for f in every]))
                u = np.append(u[u > DOCS], DOCS)
                n = np.ones(len(u))
                hashes.append(u)
                counts.append(np.stack([n * (label[low + i] == 0), n * (label[low + i] != 0)], 1))
            merge()
    if hashes:
        u, t = hashes[0], counts[0].astype(np.int64)
        for i in range(0, len(u), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(u[i : i + 50_000].view(np.int64)), pa.array(t[i : i + 50_000, 1]), pa.array(t[i : i + 50_000, 0])], ["word", "n1", "n0"])


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, y) of at most MAX_LABELLED labelled rows outside fold 0, by smallest hash of the id."""
    ids = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y"))
        .where("_id is not null and y is not null")
        .where(folds("_id") != 0)
        .groupBy("_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(MAX_LABELLED)  # the documented bound: so many ids may be broadcast
    )
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "_id").select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    train = table(labelled(docs, labels, id_col, text_col, label_col), "toxic-rows")
    counts = table(train.mapInArrow(_count, "word long, n1 long, n0 long").groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "toxic-words")
    sums = {r.word: r for r in counts.where(F.col("word") == int(DOCS)).collect()}
    empty = Model(np.zeros(0, np.uint64), np.zeros(0))
    if int(DOCS) not in sums or not sums[int(DOCS)].n1 or not sums[int(DOCS)].n0:
        return empty
    n1, n0 = float(sums[int(DOCS)].n1), float(sums[int(DOCS)].n0)
    weight = PRIOR * (n1 + n0)
    prior = PRIOR * (F.col("n1") + F.col("n0"))
    log_odds = lambda y, n: F.log((F.col(y) + prior) / F.greatest(F.lit(0.5), n + weight - F.col(y) - prior))
    d = F.least(F.lit(MOST), F.greatest(F.lit(-MOST), log_odds("n1", n1) - log_odds("n0", n0)))
    error = F.sqrt(1 / (F.col("n1") + prior) + 1 / (F.col("n0") + prior))
    scored = counts.where(F.col("word") != int(DOCS)).withColumn("odds", d).where(F.abs("odds") >= MIN_Z * error)
    rows = scored.select("word", "odds").collect()  # words of at most MAX_LABELLED texts
    if not any(r.odds > DRIFT for r in rows):
        return empty
    words = np.array([r.word for r in rows], np.int64).view(np.uint64)
    order = np.argsort(words)
    model = Model(words[order], np.array([r.odds for r in rows])[order])
    return _calibrated(_extreme_values(model, train), train)


def _extreme_values(model: Model, train: DataFrame) -> Model:
    """Fit lambda and K to the segments of the texts labelled 0: a text of n words is expected to hold
    K n exp(-lambda x) segments that score beyond x, for x from their least score on. So 1 / lambda is their mean score
    beyond that, and K exp(-lambda x) at it their number a word."""

    @F.arrow_udf("struct<n:long,k:long,total:double,least:double>")
    def sums(texts: pa.Array) -> pa.Array:
        every = [(n, [s for *_, s in found]) for n, found in model.found(texts)]
        n, k = pa.array([n for n, _ in every], pa.int64()), pa.array([len(x) for _, x in every], pa.int64())
        total, least = pa.array([sum(x, 0.0) for _, x in every], pa.float64()), pa.array([min(x, default=None) for _, x in every], pa.float64())
        return pa.StructArray.from_arrays([n, k, total, least], ["n", "k", "total", "least"])

    other = train.where("y = 0").select(sums("text").alias("s"))
    n, k, total, least = other.agg(F.sum("s.n"), F.sum("s.k"), F.sum("s.total"), F.min("s.least")).first()
    if k:
        model.lam = 1 / max(total / k - least, 0.1 * least)
        model.k = k / n * math.exp(model.lam * least)
    return model


def _calibrated(model: Model, train: DataFrame) -> Model:
    """Fit the logistic curve on binned evidence of the learning rows."""

    @F.arrow_udf("int")
    def bins(texts: pa.Array) -> pa.Array:
        return pa.array([min(BINS - 1, int(4 * x)) for _, x, _ in model.scan(texts)], pa.int32())

    binned = train.select(bins("text").alias("bin"), "y").groupBy("bin").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0")).collect()
    x = np.array([r.bin / 4 for r in binned])
    n1, n0 = (np.array([float(r[k]) for r in binned]) for k in ("n1", "n0"))
    a, b = 0.0, 0.5
    for _ in range(200):  # Newton with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        n, v = n1 + n0, p * (1 - p) * (n1 + n0)
        g = np.array([(n1 - n * p).sum() - 1e-2 * a, ((n1 - n * p) * x).sum() - 1e-2 * b])
        h = np.array([[v.sum() + 1e-2, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    model.a, model.b = float(a), float(b)
    return model


def toxicity(model: Model, text: Column | str) -> Column:
    """Struct: score (0 to 1), n_segments, evidence, and the significant segments in words (start, end, score, ln E)."""

    @F.arrow_udf("struct<score:double,n_words:long,evidence:double,segments:array<struct<start:long,end:long,score:double,log_e:double>>>")
    def score(texts: pa.Array) -> pa.Array:
        n, x, kept = (list(c) for c in zip(*model.scan(texts), strict=True)) if len(texts) else ([], [], [])
        segment = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("log_e", pa.float64())])
        rows = [[dict(zip(("start", "end", "score", "log_e"), s, strict=True)) for s in ss] for ss in kept]
        return pa.StructArray.from_arrays(
            [pa.array([model.score(v) for v in x], pa.float64()), pa.array(n, pa.int64()), pa.array(x, pa.float64()), pa.array(rows, pa.list_(segment))],
            ["score", "n_words", "evidence", "segments"],
        )

    return score(text)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", F.coalesce(folds() == 0, F.lit(False)).alias("held_out"), toxicity(model, F.col("text")).alias("t"))
    return scored.select("doc_id", "held_out", F.col("t.score").alias("score"), (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.size("t.segments").cast("long").alias("n_segments"))
