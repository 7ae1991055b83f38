"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

A token is a run of letters, of digits or of other characters that are no white
space. Each has a sparse random index vector that its hash alone determines. A
token's vector is its own index vector plus, normalised, the sum of those of its
neighbours in the training sample; a token that the sample has less than MIN_SEEN
times stands for its shape (case, digits, first sign). A document's vector is the
mean over its tokens, shapes and a sign for each word that repeats the one before
it included. The network (one hidden layer) is fitted on
a sample of at most SAMPLE labelled rows by hash of their doc_id, none over
MAX_CHARS characters; a fifth of the sample is held back to fit the temperature by
which the logits are divided. Every row is scored from its whole text alone.

Null texts count as empty, and an empty text has the score of the zero vector;
repeated rows have equal scores; a null doc_id is not held out; without labels of
both classes the score is the share of label 1 (0.5 without any); an empty table
gives an empty table; further columns are ignored by `quality_scores` and kept by
`keep_good`.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, table

SAMPLE, MAX_CHARS, DIMS, HIDDEN, WINDOW, MIN_SEEN, MAX_WORDS, CUT = 8000, 200_000, 64, 32, 2, 3, 40_000, 0.3
#: Words (between white space) that a worker remembers.
CACHE = 300_000
#: Stands for a word that repeats the one before it.
AGAIN = " again"
TOKENS = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+").findall


def shape(token: str) -> str:
    if token[0].isalpha():
        return " upper" if token.isupper() and len(token) > 1 else " lower" if token.islower() else " title" if token.istitle() else " mixed"
    if token[0].isdigit():
        return f" digits {min(len(token), 9)}"
    return f" sign {token[0]} {min(len(token), 4)}"


def index_vector(token: str) -> np.ndarray:
    """Eight entries of +1 or -1 at places that the token's hash gives."""
    rng = np.random.default_rng(zlib.crc32(token.encode("utf-8", "surrogatepass")))
    out = np.zeros(DIMS, np.float32)
    out[rng.choice(DIMS, 8, replace=False)] = rng.choice([-1.0, 1.0], 8)
    return out


class Model:
    """Token vectors and the network."""

    def __init__(self, texts: list[str], labels: list[int], seed: int = 7):
        self.known: dict[str, int] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.prior = float(np.mean(labels)) if labels else 0.5
        self.net = None
        seen = Counter(t for text in texts for t in TOKENS(text))
        names = [t for t, n in seen.most_common(MAX_WORDS) if n >= MIN_SEEN]
        self.known = {t: k for k, t in enumerate(names)}
        for s in [AGAIN, *sorted({shape(t) for t in seen})]:
            self.known.setdefault(s, len(self.known))
        self.vectors = np.stack([index_vector(t) for t in self.known]) if self.known else np.zeros((0, DIMS), np.float32)
        self._contexts(texts)
        if len(set(labels)) == 2:
            self._fit(np.stack([self.pooled(t) for t in texts]), np.array(labels, np.float32), seed)
        self.words = {}

    def ids(self, token: str) -> list[int]:
        """A token's own row, where it has one, and its shape's."""
        return [self.known[x] for x in (token, shape(token)) if x in self.known]

    def _contexts(self, texts: list[str]) -> None:
        index, sums = self.vectors.copy(), np.zeros_like(self.vectors)
        for at in range(0, len(texts), 200):  # so that the rows gathered at once stay few
            some = [[(self.ids(t) or [-1])[0] for t in TOKENS(text)] + [-1] * WINDOW for text in texts[at : at + 200]]
            ids = np.array([i for x in some for i in x], np.int64)
            for k in range(1, WINDOW + 1):
                for own, near in ((ids[:-k], ids[k:]), (ids[k:], ids[:-k])):
                    both = (own >= 0) & (near >= 0)
                    own, near = own[both], near[both]
                    if not len(own):
                        continue
                    order = np.argsort(own, kind="stable")
                    first = np.flatnonzero(np.diff(own[order], prepend=-1))
                    for low in range(0, len(first), 2000):
                        upto = first[low + 2000] if low + 2000 < len(first) else len(order)
                        here = order[first[low] : upto]
                        sums[own[order[first[low : low + 2000]]]] += np.add.reduceat(index[near[here]], first[low : low + 2000] - first[low])
        self.vectors = index + sums / np.maximum(1e-6, np.linalg.norm(sums, axis=1, keepdims=True))

    def pooled(self, text: str) -> np.ndarray:
        """The mean vector of a whole text."""
        split = text.split()
        again = sum(map(eq, split, split[1:]))
        rows, counts = ([self.known[AGAIN]], [again]) if again and self.known else ([], [])
        for word, n in Counter(split).items():
            ids = self.words.get(word)
            if ids is None:
                if len(self.words) >= CACHE:
                    self.words.clear()
                ids = self.words[word] = tuple(i for t in TOKENS(word) for i in self.ids(t))
            rows += ids
            counts += [n] * len(ids)
        if not rows:
            return np.zeros(DIMS, np.float32)
        weights = np.array(counts, np.float32)
        return weights @ self.vectors[rows] / weights.sum()

    def _fit(self, x: np.ndarray, y: np.ndarray, seed: int) -> None:
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        held, used = order[: len(x) // 5], order[len(x) // 5 :]
        mean, spread = x[used].mean(0), x[used].std(0) + 1e-6
        z = ((x - mean) / spread).astype(np.float32)
        w = [rng.normal(0, DIMS**-0.5, (DIMS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        step = 0
        for _ in range(60):
            shuffled = rng.permutation(used)
            for low in range(0, len(shuffled), 256):
                step += 1
                some = shuffled[low : low + 256]
                h = np.tanh(z[some] @ w[0] + w[1])
                e = (1 / (1 + np.exp(-(h @ w[2] + w[3]))) - y[some]) / len(some)
                back = np.outer(e, w[2]) * (1 - h * h)
                grads = [z[some].T @ back + 1e-4 * w[0], back.sum(0), h.T @ e + 1e-4 * w[2], e.sum(keepdims=True)]
                for a, g, m, v in zip(w, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    a -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.net = (mean, spread, *w)
        self.temperature = 1.0
        if len(held):
            logits = self._logits(x[held])
            heats = np.geomspace(0.5, 8, 61)
            losses = [np.mean(np.logaddexp(0, logits / t) - y[held] * logits / t) for t in heats]
            self.temperature = float(heats[int(np.argmin(losses))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        mean, spread, a, b, c, d = self.net
        return np.tanh((x - mean) / spread @ a + b) @ c + d

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.prior)
        if not texts:
            return np.zeros(0)
        x = np.stack([self.pooled(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -40, 40)))


def in_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` labelled rows that are not held out."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~in_held_out(F.col("doc_id")))
    few = usable.select(F.col("doc_id").alias("__id"), "quality").orderBy(F.xxhash64("__id"), "__id", "quality").limit(sample)
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= MAX_CHARS)
    rows = own.join(F.broadcast(few), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "quality").dropDuplicates()
    # Repeated ids may have more texts than labels: no more rows than the sample reach the driver.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text", "quality").limit(sample).toPandas()
    rows = rows.sort_values(["doc_id", "text", "quality"])
    return Model(list(rows.text), [int(q) for q in rows.quality])


def scorer(spark: SparkSession, model: Model):
    """A column function: text -> score."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        forget()  # the model is what this worker needs now
        return pd.Series(held.value.scores(list(text)), dtype="float64")

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    score = scorer(docs.sparkSession, train(docs, labels, sample))
    rows = docs.select("doc_id", in_held_out(F.col("doc_id")).alias("held_out"), score(F.coalesce("text", F.lit(""))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that the classifier accepts."""
    score = scorer(docs.sparkSession, train(docs, labels, sample))
    return docs.where(score(F.coalesce("text", F.lit(""))) >= CUT)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
