"""Operator 2: toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are taken as labelled; every other training text is unlabelled and may be
toxic too. With class prior ``p`` the risk of a linear classifier f is

    p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)]),      l(z) = log(1 + exp(-z)),

where the second term estimates the risk on clean texts and is kept from going below zero: while it
is below, a step raises it instead of lowering the sum (that is what stops a flexible model from
fitting the unlabelled texts as clean one by one).

Features are words and word beginnings of 4 to 7 letters that stand in a text once, twice or three
times at least. Spark counts them over
all training texts (summed in parts before the shuffle) and keeps the ones that confirmed texts have
more often than chance, up to a number of features. Numpy then fits the weights on the sparse rows of a bounded
sample of the training texts, so a feature that no sampled text has keeps the weight 0. Scoring
is one narrow pass over whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import packed, slices, stored

_WORDS = re.compile(r"\w+").findall
LEVELS = (1, 2, 3)  # occurrences at which a word or beginning counts as a further feature
MIN_GAIN = 9.0  # deviance a feature needs, about the logarithm of the number of features tried
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 4000, 12000, 8192  # bounds of the sample the weights are fitted on, and of the model
PART = 1_000_000  # features of texts held before they are summed


def _features(word: str) -> list[int]:
    return [zlib.crc32(b"=" + word.encode("utf-8", "replace"))] + [zlib.crc32(b"^" + word[:n].encode("utf-8", "replace")) for n in (4, 5, 6, 7) if len(word) > n]


class _Rows:
    """Features of texts, restricted to ``index`` (feature -> number) if given. A feature is a word or
    beginning and a level: it is present if words with it stand in the text that often at least."""

    def __init__(self, index: dict[int, int] | None = None, memo: int = 100_000):
        self.index, self.memo, self.known = index, memo, {}
        self.bases = None if index is None else {f & 0xFFFFFFFF for f in index}

    def __call__(self, text: str) -> list[int]:
        if len(self.known) > self.memo:
            self.known.clear()
        total: dict[int, int] = {}
        known = self.known
        for w, n in Counter(_WORDS(text.lower())).items():
            got = known.get(w)
            if got is None:
                got = _features(w)
                if self.bases is not None:
                    got = [x for x in got if x in self.bases]
                known[w] = got = tuple(got)
            for x in got:
                total[x] = total.get(x, 0) + n
        found = [level << 32 | x for x, n in total.items() for level in LEVELS if n >= level]
        return found if self.index is None else [self.index[f] for f in found if f in self.index]


@dataclass(frozen=True)
class Model:
    index: dict[int, int]  # feature -> position in weights
    weights: np.ndarray
    bias: float
    prior: float


def _positive_risk(z, prior):
    return prior * np.logaddexp(0, -z).mean() if len(z) else 0.0


def fit_nnpu(cols: np.ndarray, starts: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = 250, rate: float = 0.05, l2: float = 2e-4, slack: float = 0.0):
    """Weights and bias that minimise the non-negative risk, by Adam on the full sample.

    Sparse binary rows: row i has the features ``cols[starts[i]:starts[i + 1]]``.
    """
    n = len(positive)
    row = np.repeat(np.arange(n), np.diff(starts))
    n_pos, n_unl = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[cols], minlength=n) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        clean = np.logaddexp(0, z)
        rest = clean[~positive].sum() / n_unl - prior * clean[positive].sum() / n_pos
        g = np.empty(n)
        if rest >= -slack:
            g[positive] = prior / n_pos * ((s[positive] - 1) - s[positive])
            g[~positive] = s[~positive] / n_unl
        else:  # climb back: the gradient of the second term with its sign turned
            g[positive] = prior / n_pos * s[positive]
            g[~positive] = -s[~positive] / n_unl
        grad = np.append(np.bincount(cols, weights=g[row], minlength=n_features), g.sum())
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, positive: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> Model:
    """Fit on ``docs``, of which the rows whose id is in ``positive`` (one id column) are confirmed.

    Features are counted over every text, confirmed or not, and the ``max_features`` of greatest gain are kept.
    The weights are fitted on a sample bounded by ``max_positive`` and ``max_unlabelled`` rows, taken in order of
    a hash of the id; only its chosen features reach the driver. Null ids and texts, and ids of ``positive``
    without a text, take no part. Without a confirmed text the model scores every text ``prior``.
    """
    prior = float(min(max(prior, 1e-3), 0.5))
    ids = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id")).where("id is not null").distinct()
    # written, so that Spark knows their size and broadcasts them only while they are few
    confirmed = stored(positive.select(F.col(positive.columns[0]).alias("id")).where("id is not null").distinct(), "confirmed")
    marks = confirmed.withColumn("pos", F.lit(True))
    marked = stored(ids.join(marks, "id", "left").withColumn("pos", F.coalesce("pos", F.lit(False))).withColumn("h", F.xxhash64("id")), "marked")
    # the unlabelled sample stands for all texts, so it may hold confirmed ones as well
    pos = {r.id for r in marked.where("pos").orderBy("h", "id").limit(max_positive).select("id").collect()}
    unl = {r.id for r in marked.orderBy("h", "id").limit(max_unlabelled).select("id").collect()}
    if not pos:
        return Model({}, np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    side = {i: (i in pos, i in unl) for i in pos | unl}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(side)  # at most max_positive + max_unlabelled ids
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = sample.where("id is not null and text is not null").join(marks, "id", "left").select("text", F.coalesce("pos", F.lit(False)).alias("pos"))

    def count(batches):
        rows, found, held = _Rows(memo=50_000), ([], []), 0
        for b in slices(batches):
            for t, p in zip(b["text"].to_pylist(), b["pos"].to_pylist()):
                got = np.array(rows(t), dtype=np.int64)
                found[1].append(got)
                if p:
                    found[0].append(got)
                held += len(got)
                if held > PART:  # counted in parts, so that memory stays bounded
                    yield counted(found)
                    found, held = ([], []), 0
        yield counted(found)

    def counted(found):
        none = np.empty(0, np.int64)
        pos, unl = (np.unique(np.concatenate([none, *f]), return_counts=True) for f in found)
        f = np.concatenate([pos[0], unl[0]])
        a, z = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
        a[: len(pos[0])], z[len(pos[0]) :] = pos[1], unl[1]
        return pa.RecordBatch.from_arrays([pa.array(f), pa.array(a), pa.array(z)], names=["f", "a", "z"])

    n_pos, n_unl = marked.agg(F.count_if("pos"), F.count("*")).first()
    counts = texts.mapInArrow(count, "f long, a long, z long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("z").alias("z"))
    # a feature is kept if chance would hardly give it so many confirmed texts (Poisson deviance)
    due = (F.col("a") + F.col("z")) * (n_pos / (n_pos + n_unl))
    gain = F.col("a") * F.log(F.col("a") / due) - F.col("a") + due
    best = counts.where((F.col("a") > 0) & (F.col("a") > 2 * due)).withColumn("gain", gain).where(F.col("gain") > MIN_GAIN)
    index = {r.f: k for k, r in enumerate(best.orderBy(F.desc("gain"), "f").limit(max_features).collect())}
    sent = spark.sparkContext.broadcast(index)

    def sparse(batches):
        side, rows = shared.value, _Rows(sent.value)
        for b in slices(batches):
            got = [(i, sorted(rows(t))) for i, t in zip(b["id"].to_pylist(), b["text"].to_pylist()) if i in side and t is not None]
            got = [(k == 0, f) for i, f in got for k in range(2) if side[i][k]]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in got]), pa.array([f for _, f in got], pa.list_(pa.int32()))], names=["pos", "f"])

    rows = sample.mapInArrow(sparse, "pos boolean, f array<int>").toArrow()
    f = rows["f"].combine_chunks()
    f = pa.concat_arrays(f.chunks) if isinstance(f, pa.ChunkedArray) else f
    starts = np.concatenate(([0], np.cumsum(f.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    w, bias = fit_nnpu(f.flatten().to_numpy(zero_copy_only=False), starts, rows["pos"].to_numpy(), len(index), prior)
    return Model(index, w, bias, prior)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, text, score): every column but the text in ``row``; ``score`` from 0 to 1, higher is
    likelier toxic. A null text scores as an empty one; repeated rows score alike; an empty table
    gives an empty result."""
    src = packed(docs, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        rows = _Rows(m.index)
        for b in slices(batches):
            z = np.array([m.bias + sum(m.weights[k] for k in rows(t or "")) for t in b["text"].to_pylist()], dtype=np.float64)
            s = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([b["row"], b["text"], pa.array(s)], names=["row", "text", "score"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType())]))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row belongs to the held-out fold: crc32 of the id's text is divisible by 5 (a null
    id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train_on_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``documents`` and ``labels``: labels of the held-out fold are never seen. The
    prior is the share of toxic rows among the labelled rows of the other folds."""
    seen = labels.where(~held_out()).where("toxic is not null and doc_id is not null")
    toxic = seen.where("toxic = 1").select("doc_id")
    prior = seen.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return train(docs.where(~held_out()), toxic, 0.1 if prior is None else prior)
