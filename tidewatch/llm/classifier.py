"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Words are letter runs, digit runs and runs of other characters; each word also gives a word for its case. A word falls into one
of `BUCKETS` buckets by its hash and has a sparse ternary index vector drawn from that bucket's seed. Its word vector is the index
vector plus the normalised sum of its neighbours' index vectors over all texts of the corpus. A document's vector holds the mean of the word vectors over its tokens,
the norm of its difference from the mean over distinct buckets, the mean vector of the forms, and two figures of size. A network with one hidden layer is trained on these by Adam; a
temperature fitted on rows that it has not seen calibrates its probabilities.

Only labelled rows whose crc32(doc_id) mod 4 is not 2 are learnt from, at most `FIT_ROWS` of them, chosen by a hash of the id; texts
are read whole. Labels, lang, source and doc_id are never inputs. Context sums cover every document: each task adds up a table of
BUCKETS x DIMS whole numbers, and these are added level by level (`ADDED` tables a task), so nothing grows in one place. The driver
receives the pooled vectors of the fit rows and at most ADDED such tables, all of fixed size.

Defined cases: null and empty texts pool to zeros and get a score like any other; repeated rows get equal scores; several labels of
one id count as their maximum; without labels of both classes every score is the share of label 1 (0.5 without labels), and
`keep_good` keeps all rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, kept, materialise

BUCKETS, DIMS, NONZERO, SEED = 8192, 48, 6, 17
FIT_ROWS, HIDDEN, EPOCHS, RATE, DECAY, KEEP = 6_000, 32, 120, 3e-3, 1e-4, 0.7
#: A context reaches so many words to each side. Tables of context sums that one task adds up.
REACH, ADDED = 2, 16
#: Runs between white space that a worker remembers, about 200 bytes each.
WORDS = 500_000
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Buckets of the words for forms; they use the first vectors.
FORMS = 512


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors of all buckets."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIMS), np.float32)
    for row in out:
        row[rng.choice(DIMS, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


def case_word(token: str) -> str:
    """A word for the form of a token."""
    if token.isalpha():
        return "<upper>" if token.isupper() and len(token) > 1 else "<title>" if token[0].isupper() else "<lower>"
    return "<digits>" if token.isdigit() else f"<{token[0]}{min(len(token), 4)}>"


@cache
def form_bucket(word: str) -> int:
    return BUCKETS + zlib.crc32(word.encode()) % FORMS


def buckets(run: str) -> tuple[int, ...]:
    """Of what stands between white space, the buckets of its words, then BUCKETS plus the buckets of their forms."""
    found = (run,) if run.isalpha() else TOKEN.findall(run)
    return tuple([zlib.crc32(t.lower().encode()) % BUCKETS for t in found] + [form_bucket(case_word(t)) for t in found])


class Words:
    """Buckets of all that this worker has met between white space, in one array; emptied beyond `WORDS` of them."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The buckets of each text."""
        runs = [t.split() for t in texts]
        count = np.fromiter(map(len, runs), np.int64, len(runs))
        every = list(chain.from_iterable(runs))
        if len(self.number) > WORDS:
            self.__init__()
        ids = list(map(self.number.get, every))
        if None in ids:
            new = list({run for run, i in zip(every, ids, strict=True) if i is None})
            cut = list(map(buckets, new))
            size = np.fromiter(map(len, cut), np.int64, len(cut))
            self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(cut), np.int64, int(size.sum())))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            ids = [self.number[run] if i is None else i for run, i in zip(every, ids, strict=True)]
        ids = np.array(ids, np.int64)
        size = self.size[ids]
        end = np.append(0, np.cumsum(size))
        out = self.flat[np.repeat(self.start[ids] - end[:-1], size) + np.arange(end[-1])]
        return np.split(out, end[np.cumsum(count)[:-1]])


def buckets_of(texts: list[str]) -> list[np.ndarray]:
    return kept("classifier words", Words).of(texts) if texts else []


def context_sums(texts: list[str], index: np.ndarray) -> np.ndarray:
    """For each bucket the sum of index vectors (small whole numbers) of its words' neighbours. Blank words stand between texts, so that no context reaches over an end."""
    gap = np.full(REACH, BUCKETS, np.int64)
    flat = np.concatenate([x for b in buckets_of(texts) for x in (b[b < BUCKETS], gap)] or [gap]).astype(np.uint16)
    own = np.vstack([index, np.zeros((1, DIMS))]).astype(np.int8)[flat]
    near = np.zeros_like(own)
    for d in range(1, REACH + 1):
        near[d:] += own[:-d]
        near[:-d] += own[d:]
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    sums = np.zeros((BUCKETS + 1, DIMS), np.int64)
    sums[flat[start]] = np.add.reduceat(near[order], start, axis=0, dtype=np.int32)
    return sums[:BUCKETS]


def corpus_sums(docs: DataFrame, text: str = "text") -> np.ndarray:
    """`context_sums` of all texts of docs."""
    index = index_vectors()

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((BUCKETS, DIMS), np.int64)
        for batch in batches:
            texts = [x or "" for x in batch["text"]]
            for a, b in blocks(texts, 1_000_000):
                sums += context_sums(texts[a:b], index)
        yield pd.DataFrame({"sums": [sums.tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((BUCKETS, DIMS), np.int64)
        for batch in batches:
            for raw in batch["sums"]:
                sums += np.frombuffer(raw, np.int64).reshape(BUCKETS, DIMS)
        yield pd.DataFrame({"sums": [sums.tobytes()]})

    now = materialise(docs.select(F.col(text).cast("string").alias("text")).mapInPandas(first, "sums binary"), "context-sums")
    while (n := now.count()) > ADDED:
        now = materialise(now.repartition(-(-n // ADDED)).mapInPandas(add, "sums binary"), "context-sums")
    return sum((np.frombuffer(r["sums"], np.int64).reshape(BUCKETS, DIMS) for r in now.toLocalIterator()), np.zeros((BUCKETS, DIMS), np.int64))


def word_vectors(sums: np.ndarray, index: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return (index / np.sqrt(NONZERO) + sums / np.maximum(norm, 1e-6)).astype(np.float32)


FEATURES = 2 * DIMS + 3


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """The vector of each document."""
    parts = [buckets_of(texts[a:b]) for a, b in blocks(texts, 1_000_000)]
    return np.array([_pool(b, vectors) for part in parts for b in part], np.float64).reshape(-1, FEATURES)


def _pool(own: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    out = np.zeros(FEATURES, np.float32)
    count = np.bincount(own, minlength=BUCKETS + FORMS)
    word, form = np.flatnonzero(count[:BUCKETS]), np.flatnonzero(count[BUCKETS:])
    if not len(word):
        return out
    n, seen = count[word].astype(np.float32), vectors[word]
    total = float(n.sum())
    mean = n @ seen / total
    out[:DIMS], out[DIMS : 2 * DIMS] = mean, count[BUCKETS + form].astype(np.float32) @ vectors[form] / total
    out[2 * DIMS :] = np.linalg.norm(mean - seen.mean(axis=0)), len(word) / total, np.log1p(total) / 10
    return out


class Network:
    """Two layers and a temperature; score(x) is the probability of label 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.flat = len(np.unique(y)) < 2
        if self.flat:
            return
        self.mid, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        order = rng.permutation(len(x))
        held, fit = order[: max(1, len(x) // 5)], order[max(1, len(x) // 5) :]
        z = (x - self.mid) / self.scale
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [0 * a for a in p], [0 * a for a in p], 0
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
                if not len(at):
                    continue
                hidden = np.tanh(z[at] @ p[0] + p[1])
                g = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -40, 40))) - y[at]) / len(at)
                back = np.outer(g, p[2]) * (1 - hidden**2)
                grad, step = [z[at].T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ g + DECAY * p[2], np.array([g.sum()])], step + 1
                for i, d in enumerate(grad):
                    m[i], v[i] = 0.9 * m[i] + 0.1 * d, 0.999 * v[i] + 0.001 * d * d
                    p[i] = p[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = p
        logits = self._logits(x[held])
        heat = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
        # The rows held back may all be right, and then no finite temperature is best: labels count as 0.995 and 0.005.
        soft = np.clip(y[held], 0.005, 0.995)
        loss = [np.mean(np.logaddexp(0, logits / t) - soft * logits / t) for t in heat]
        self.temperature = float(heat[int(np.argmin(loss))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mid) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.prior) if self.flat else 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -40, 40)))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all texts of docs, and the network from at most `rows` labelled ones that are not held out."""
    chosen = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = materialise(chosen.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id")).limit(rows), "fit-ids")
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # `rows` ids: a broadcast of fixed size.
    sample = own.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select(F.col("quality").cast("double").alias("quality"), "text").repartition(6)
    sample = materialise(sample, "fit-texts")
    vectors = word_vectors(corpus_sums(docs), index_vectors())

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"quality": batch["quality"], "x": [x.astype(np.float32).tobytes() for x in pooled(list(batch["text"]), vectors)]})

    got = sample.mapInPandas(pool, "quality double, x binary").collect()
    got.sort(key=lambda r: (bytes(r["x"]), r["quality"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], np.float64).reshape(-1, FEATURES)
    return vectors, Network(x, np.array([r["quality"] for r in got], np.float64))


def score(docs: DataFrame, vectors: np.ndarray, network: Network, name: str = "score") -> DataFrame:
    """docs with the column `name`, which replaces one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        vectors, network = shared.value
        return pd.Series(network.score(pooled([t or "" for t in texts], vectors)))

    return docs.withColumn(name, scored(F.col("text").cast("string")))


def scores(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    marked = score(docs.select("doc_id", "text"), *fit(docs, labels))
    return marked.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= keep, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """Rows of docs that the classifier fitted on them doesn't reject; all of them if it has no labels of both classes."""
    vectors, network = fit(docs, labels)
    if network.flat:
        return docs
    name = "_score"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return score(docs, vectors, network, name).where(F.col(name) >= keep).drop(name)
