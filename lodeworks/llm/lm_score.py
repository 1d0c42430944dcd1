"""LM scoring by masked pseudo-likelihood: a bidirectional window network, trained in numpy, predicts every token from
the tokens on both sides; the summed conditional log-probabilities score a document.

Vocabulary: words `[^\\x20\\x09-\\x0D]+` lower-cased in A-Z. Their counts over the whole corpus are summed in Spark; the
VOCAB - 1 most frequent are tokens of their own, all others share one, whose probability is spread over them by their
corpus counts: (n + 1) / (N + K + 1) for a word seen n times, where the K others are seen N times in all, and what is
left for words the corpus does not hold. So p(word | context) is a proper distribution. The model carries the counts of
at most KNOWN frequent words; those of all others are joined (`scored`).

Network: the embeddings of SPAN words on either side (zeros beyond the ends) make a hidden tanh layer, and that a
two-level softmax: the token's class, then the token within its class, CLASS tokens each. It begins as the corpus's
unigram model (output weights 0, biases the logarithms of the counts) and is warmed up on WARM tokens, those of the documents
with the smallest hashes of their texts, so that all partitions start in the same basin. Training then is one pass over
all documents: every partition runs minibatch SGD (Adagrad) from that start over all its tokens, and the partitions'
parameters are averaged by tokens, packed and in two steps, so that no task adds up more than FAN sets. In how many
partitions the corpus comes therefore matters little; a test and the README say how much. What is gathered grows with
the input (word counts, and one set of parameters a partition); what reaches the driver is one set of parameters and at
most VOCAB + KNOWN words.

Defined cases: null and empty texts have no tokens, a sum of 0 and a null mean; repeated rows are scored alike; an
empty table gives an empty result; whole texts are scored whatever their length; extra columns pass by, whatever their
names, but for the three results, which are replaced; equally frequent words enter the vocabulary by their hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, byte_codes, free_name, runs_of_text, space_words, table

#: Tokens, tokens in a class, words seen on either side, sizes of embedding and hidden layer.
VOCAB, CLASS, SPAN, WIDTH, HIDDEN = 1024, 32, 2, 16, 32
#: Most words whose counts the model carries.
KNOWN = 65_536
#: Tokens in a minibatch, learning rate, seed of the common start.
BATCH, RATE, SEED = 4096, 0.05, 7
#: Documents and tokens of the warm-up, at most, with its minibatch and rate.
WARM_DOCS, WARM, WARM_BATCH, WARM_RATE = 4_000, 1_000_000, 1024, 0.1
#: Pieces in which parameters are sent, and sets of them that one task adds up.
PIECES, FAN = 16, 256

_SHAPES = {
    "e": (VOCAB + 1, WIDTH),  # the last row is the padding
    "h": (2 * SPAN * WIDTH, HIDDEN),
    "hb": (HIDDEN,),
    "c": (HIDDEN, VOCAB // CLASS),
    "cb": (VOCAB // CLASS,),
    "w": (VOCAB // CLASS, HIDDEN, CLASS),
    "wb": (VOCAB // CLASS, CLASS),
}


def initial(counts: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The common start: random embeddings and hidden layer, and the tokens' counts as the output."""
    rng = np.random.default_rng(SEED)
    p = {k: (rng.normal(0, 0.1, s) if k in ("e", "h") else np.zeros(s)).astype(np.float32) for k, s in _SHAPES.items()}
    p["e"][VOCAB] = 0
    if counts is not None:
        by_class = (counts + 0.5).reshape(VOCAB // CLASS, CLASS)
        p["cb"], p["wb"] = (np.log(x).astype(np.float32) for x in (by_class.sum(1) / by_class.sum(), by_class / by_class.sum(1, keepdims=True)))
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _SHAPES]).astype(np.float32)


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def contexts(tokens: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The 2 SPAN tokens around each; VOCAB beyond a document's ends."""
    n = len(tokens)
    out = np.full((n, 2 * SPAN), VOCAB, np.int32)
    for j, d in enumerate([*range(-SPAN, 0), *range(1, SPAN + 1)]):
        a, b = max(0, -d), min(n, n - d)
        if b > a:
            same = doc[a:b] == doc[a + d : b + d]
            out[a:b, j] = np.where(same, tokens[a + d : b + d], VOCAB)
    return out


def forward(p: dict, near: np.ndarray, tokens: np.ndarray, grads: bool = False):
    """Log-probability of each token given those around it; with `grads`, also the gradients of their negated mean."""
    n, rows, kind = len(tokens), np.arange(len(tokens)), p["e"].dtype
    order = np.argsort((tokens // CLASS).astype(np.uint8), kind="stable")  # class by class
    tokens, near = tokens[order], near[order]
    group, within = tokens // CLASS, tokens % CLASS
    cut = np.searchsorted(group, np.arange(VOCAB // CLASS + 1))
    x = p["e"][near].reshape(n, -1)
    h = np.tanh(x @ p["h"] + p["hb"])

    def softmax(z: np.ndarray, at: tuple) -> np.ndarray:
        """Log-probabilities at `at`; `z` becomes their gradients over n."""
        picked = z[at]
        np.exp(np.clip(z, -60, 60, out=z), out=z)
        total = z @ np.ones(z.shape[1], kind)
        if grads:
            z /= (total * n)[:, None]
            z[at] -= 1 / n
        return picked - np.log(total)

    z = h @ p["c"] + p["cb"]
    logp = softmax(z, (rows, group))
    if grads:
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["c"], g["cb"], dh = h.T @ z, z.sum(0), z @ p["c"].T
    for k in range(VOCAB // CLASS):
        part = slice(cut[k], cut[k + 1])
        if cut[k] == cut[k + 1]:
            continue
        z = h[part] @ p["w"][k] + p["wb"][k]
        logp[part] += softmax(z, (rows[: len(z)], within[part]))
        if grads:
            g["w"][k], g["wb"][k] = h[part].T @ z, z.sum(0)
            dh[part] += z @ p["w"][k].T
    out = np.empty_like(logp)
    out[order] = logp
    if not grads:
        return out
    dz = dh * (1 - h * h)
    g["h"], g["hb"] = x.T @ dz, dz.sum(0)
    dx = (dz @ p["h"].T).reshape(-1, WIDTH)
    seen = near.ravel().astype(np.uint16)
    order = np.argsort(seen, kind="stable")
    seen = seen[order]
    first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
    g["e"][seen[first]] = np.add.reduceat(dx[order], first, axis=0)
    g["e"][VOCAB] = 0
    return out, g


def _tokens(texts: pa.Array, vocab: np.ndarray, ids: np.ndarray):
    """(first row, Words, token of each word) of runs of texts."""
    inside = space_words()
    codes = byte_codes(True, inside)
    for low, high, data, offsets in runs_of_text(texts):
        w = Words(data, offsets, inside, codes)
        if len(vocab):
            at = np.minimum(np.searchsorted(vocab, w.hash), len(vocab) - 1)
            tokens = np.where(vocab[at] == w.hash, ids[at], VOCAB - 1)
        else:
            tokens = np.full(len(w.hash), VOCAB - 1)
        yield low, high, w, tokens.astype(np.int32)


def _count(batches):
    inside = space_words()
    codes = byte_codes(True, inside)
    held: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def merged():
        u, back = np.unique(np.concatenate(held), return_inverse=True)
        return u, np.bincount(back, weights=np.concatenate(counts), minlength=len(u)).astype(np.int64)

    for batch in batches:
        for _, _, data, offsets in runs_of_text(batch.column(0)):
            u, n = np.unique(Words(data, offsets, inside, codes).hash, return_counts=True)
            held.append(u), counts.append(n)
            if len(held) >= 16:
                u, n = merged()
                held, counts = [u], [n]
    if held:
        u, n = merged()
        for i in range(0, len(u), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(u[i : i + 50_000].view(np.int64)), pa.array(n[i : i + 50_000])], ["word", "n"])


class Model:
    """Parameters; the tokens' words; the words the model carries with their log(n + 1); log(N + K + 1); and the table of
    the words it does not carry (word, n)."""

    def __init__(self, params: np.ndarray, vocab: np.ndarray, ids: np.ndarray, known: np.ndarray, known_log: np.ndarray, norm: float, rest: DataFrame):
        self.params, self.vocab, self.ids, self.known, self.known_log, self.norm, self.rest = params, vocab, ids, known, known_log, norm, rest


class _Trainer:
    """Adagrad over minibatches of the tokens that come in."""

    def __init__(self, params: np.ndarray, squares: np.ndarray, batch: int, rate: float):
        self.p, self.squares, self.batch, self.rate = shaped(params), shaped(squares), batch, rate
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.total = 0

    def add(self, tokens: np.ndarray, near: np.ndarray) -> None:
        self.held.append((tokens, near))
        self.size += len(tokens)
        self.total += len(tokens)
        if self.size >= self.batch:
            self._steps(self.batch)

    def finish(self) -> None:
        if self.size:
            self._steps(1)

    def _steps(self, least: int) -> None:
        tokens, near = (np.concatenate([x[k] for x in self.held]) for k in (0, 1))
        at = 0
        while at < len(tokens) and len(tokens) - at >= least:
            part = slice(at, at + self.batch)
            at += len(tokens[part])
            _, g = forward(self.p, near[part], tokens[part], True)
            for k in self.p:
                self.squares[k] += g[k] * g[k]
                self.p[k] -= self.rate * g[k] / np.sqrt(self.squares[k])
        self.held = [(tokens[at:], near[at:])]
        self.size = len(tokens) - at


def _train(params: np.ndarray, squares: np.ndarray, vocab: np.ndarray, ids: np.ndarray):
    def train(batches):
        trainer = _Trainer(params, squares, BATCH, RATE)
        for batch in batches:
            for _, _, w, tokens in _tokens(batch.column(0), vocab, ids):
                trainer.add(tokens, contexts(tokens, w.doc))
        trainer.finish()
        if trainer.total:
            salt = TaskContext.get().partitionId() // FAN
            pieces = [x.tobytes() for x in np.array_split(flat(trainer.p).astype(np.float64) * trainer.total, PIECES)]
            full = lambda v, t: pa.array(np.full(PIECES, v), t)
            yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), full(salt, pa.int32()), pa.array(pieces, pa.binary()), full(trainer.total, pa.int64())], ["piece", "salt", "x", "n"])

    return train


def _warmed(params: np.ndarray, vocab: np.ndarray, ids: np.ndarray):
    def warm(batches):
        trainer = _Trainer(params, np.full(len(params), 1e-6, np.float32), WARM_BATCH, WARM_RATE)
        for batch in batches:
            for _, _, w, tokens in _tokens(batch.column(0), vocab, ids):
                part = slice(0, WARM - trainer.total)
                if trainer.total < WARM:
                    trainer.add(tokens[part], contexts(tokens, w.doc)[part])
        trainer.finish()
        yield pa.RecordBatch.from_arrays([pa.array([flat(x).tobytes()], pa.binary()) for x in (trainer.p, trainer.squares)], ["params", "squares"])

    return warm


def warm_start(texts: DataFrame, text_col: str, params: np.ndarray, vocab: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parameters and sums of squared gradients after the warm-up, which runs in one task."""
    h = F.xxhash64(text_col)
    last = texts.where(F.col(text_col).isNotNull()).select(h.alias("h")).orderBy("h").limit(WARM_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return params, np.full(len(params), 1e-6, np.float32)
    few = texts.where(F.col(text_col).isNotNull() & (h <= last)).orderBy(h, text_col).coalesce(1)
    row = few.mapInArrow(_warmed(params, vocab, ids), "params binary, squares binary").collect()[0]
    return tuple(np.frombuffer(row[c], np.float32) for c in ("params", "squares"))


_SUMS = "piece int, salt int, x binary, n long"


def _added(rows: pa.Table) -> pa.Table:
    x = np.sum([np.frombuffer(v, np.float64) for v in rows.column("x").to_pylist()], axis=0)
    head = [rows.column(c).combine_chunks()[:1] for c in ("piece", "salt")]
    return pa.Table.from_arrays([*head, pa.array([x.tobytes()], pa.binary()), pa.array([sum(rows.column("n").to_pylist())], pa.int64())], ["piece", "salt", "x", "n"])


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    texts = docs.select(F.col(text_col))
    counts = table(texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCAB - 1).collect()  # the vocabulary: a fixed number of words
    words = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    vocab, ids = words[order], np.arange(len(words), dtype=np.int32)[order]
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    norm = float(np.log(total - sum(r.n for r in top) + kinds - len(top) + 1))
    # Steps of counts, eight for each power of two: the highest ones that hold at most KNOWN words are carried.
    step = F.floor(F.log2("n") * 8)
    least, held = 512, 0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect(), reverse=True):
        held += r.k
        if held > KNOWN:
            break
        least = r.step
    more = counts.where(step >= least).collect()
    known = np.array([r.word for r in more], np.int64).view(np.uint64)
    order = np.argsort(known)
    known, known_log = known[order], np.log1p(np.array([r.n for r in more], np.float64)[order])
    rest = counts.where(step < least)
    seen = np.zeros(VOCAB)
    seen[: len(top)] = [r.n for r in top]
    seen[VOCAB - 1] = total - seen.sum()
    params = flat(initial(seen))
    params, squares = warm_start(texts, text_col, params, vocab, ids)
    trained = texts.mapInArrow(_train(params, squares, vocab, ids), _SUMS)
    sums = trained.groupBy("piece", "salt").applyInArrow(_added, _SUMS).groupBy("piece").applyInArrow(_added, _SUMS).collect()
    if sums:
        params = np.concatenate([np.frombuffer(r.x, np.float64) / r.n for r in sorted(sums, key=lambda r: r.piece)]).astype(np.float32)
    return Model(params, vocab, ids, known, known_log, norm, rest)


def score(model: Model, text: Column | str) -> Column:
    """Struct: n_tokens, log_prob (summed), mean_log_prob (null without tokens), and rest: the words the model does not
    carry, here taken as words the corpus does not hold."""
    params, vocab, ids, known, known_log, norm = model.params, model.vocab, model.ids, model.known, model.known_log, model.norm

    @F.arrow_udf("struct<n_tokens:long,log_prob:double,mean_log_prob:double,rest:array<long>>")
    def f(texts: pa.Array) -> pa.Array:
        p = shaped(params)
        n, total, rest, n_rest = [], [], [], []
        for _, _, w, tokens in _tokens(texts, vocab, ids):
            near = contexts(tokens, w.doc)
            logp = np.concatenate([forward(p, near[i : i + BATCH], tokens[i : i + BATCH]) for i in range(0, len(tokens), BATCH)] or [np.zeros(0)])
            logp = logp.astype(np.float64)
            rare = np.flatnonzero(tokens == VOCAB - 1)
            hashes = w.hash[rare]
            logp[rare] -= norm
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                carried = known[at] == hashes
                logp[rare] += np.where(carried, known_log[at], 0.0)
                rare, hashes = rare[~carried], hashes[~carried]
            sums = np.concatenate([[0.0], np.cumsum(logp)])
            n.append(np.diff(w.first))
            total.append(sums[w.first[1:]] - sums[w.first[:-1]])
            rest.append(hashes.view(np.int64))
            n_rest.append(np.diff(np.searchsorted(rare, w.first)))
        n, total = np.concatenate(n or [np.zeros(0, np.int64)]), np.concatenate(total or [np.zeros(0)])
        total = np.where(n > 0, total, 0.0)
        mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
        ends = np.concatenate([[0], *n_rest]).cumsum().astype(np.int32)
        words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rest or [np.zeros(0, np.int64)]), pa.int64()))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(total), mean, words], ["n_tokens", "log_prob", "mean_log_prob", "rest"])

    return f(text)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` without the text, with n_tokens, log_prob and mean_log_prob by the counts of all words of the corpus."""
    kept = [F.col(c) for c in docs.columns if c not in (text_col, "n_tokens", "log_prob", "mean_log_prob")]
    t = free_name(docs, "_lm_")
    part = table(docs.select(*kept, F.monotonically_increasing_id().alias(f"{t}row"), score(model, text_col).alias(f"{t}s")), "lm-scores")
    found = part.select(f"{t}row", F.explode(f"{t}s.rest").alias("word")).join(model.rest, "word")
    found = found.groupBy(f"{t}row").agg(F.sum(F.log1p("n")).alias(f"{t}more"))
    s = F.col(f"{t}s")
    total = s["log_prob"] + F.coalesce(f"{t}more", F.lit(0.0))
    mean = F.when(s["n_tokens"] > 0, total / s["n_tokens"])
    return part.join(found, f"{t}row", "left").select(*kept, s["n_tokens"].alias("n_tokens"), total.alias("log_prob"), mean.alias("mean_log_prob"))


def op6_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, fit(docs))
