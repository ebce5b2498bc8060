"""Quality classifier by positive-unlabelled learning.

Trusted positives are the texts labelled good; the unlabelled set is web text as it comes, never told which of
it is bad. With the class prior (share of good text, estimated from the training labels) the risk of the bad
class is the unlabelled risk less the prior-weighted positive risk; it is kept from going below zero (the
non-negative estimator of Kiryo et al., 2017). The classifier is a small network over statistics of form: case,
symbols, separators, repetition of words and word runs, word lengths, line shapes.

Both samples are bounded (``POSITIVES``, ``UNLABELLED``; smallest hashes of the id); the class prior counts all
training labels; scoring reads every whole text once, in parallel.

Defined results: a null or empty text has the statistics of an empty text (all zero); label rows that are null
or neither 0 nor 1 are ignored, of repeated ones the larger counts; without positives or unlabelled texts every
score is the prior; extra columns of the input are kept by ``score_texts`` (its own column replaces one of the
same name); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm import folds, kernels

POSITIVES, UNLABELLED = 8000, 16000  # bounds of the training samples
HIDDEN, EPOCHS, BATCH, RATE = 16, 60, 1000, 5e-3

_KIND = np.zeros((6, 256))
_KIND[0, ord("A"): ord("Z") + 1] = 1
_KIND[1, ord("a"): ord("z") + 1] = 1
_KIND[2, ord("0"): ord("9") + 1] = 1
_KIND[3, [ord(c) for c in "!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"]] = 1
_KIND[4, [ord(c) for c in ".,"]] = 1
_KIND[5, 0x0A] = 1
_SYMBOL = _KIND[3] > 0


def statistics(arr: pa.Array) -> np.ndarray:
    """Matrix (texts x statistics) of shares, all of them computed over the whole text."""
    out = []
    for _, _, raw, off in kernels.chunked(arr):
        w = kernels.Words(raw, off)
        n_docs, count = w.n_docs, w.count
        size = np.maximum(np.diff(off), 1)
        upto = lambda v: np.concatenate(([0.0], np.cumsum(v)))
        share = [np.diff(upto(k[raw])[off]) for k in _KIND]
        letters = np.maximum(share[0] + share[1], 1)
        words = np.maximum(count, 1)
        per = lambda mask: np.bincount(w.doc, weights=mask, minlength=n_docs) / words
        h = w.hashes()
        same = np.zeros(len(h))
        if len(h):
            same[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
            last, first = raw[w.end - 1], raw[w.start]
            symbol_end = _SYMBOL[last].astype(float)
            bare = (_SYMBOL[first] & (w.end - w.start == 1)).astype(float)
            caps = upto(_KIND[0][raw])
            caps = ((caps[w.end] - caps[w.start]) * 2 > (w.end - w.start)).astype(float)
            length = (w.end - w.start).astype(float)
        else:
            symbol_end = bare = caps = length = np.zeros(0)
        sh, bounds = kernels.shingles(h, w.first, 3)
        distinct_words = _distinct(h, w.first) / words
        distinct_runs = _distinct(sh, bounds) / np.maximum(np.diff(bounds), 1)
        out.append(np.column_stack([
            share[0] / letters, share[2] / size, share[3] / size, share[4] / size, share[5] / size,
            per(same), per(symbol_end), per(bare), per(caps), np.minimum(per(length) / 10, 3), per((length > 14).astype(float)),
            1 - distinct_runs, np.where(count > 0, 1 - distinct_words, 0) / np.log(words + 2.0), np.log1p(count) / 10]))
    return np.concatenate(out) if out else np.zeros((0, 14))


def _distinct(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((h, doc))
    h, d = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d, weights=new, minlength=len(bounds) - 1)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss, by Adam."""
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    norm = lambda x: np.clip((x - mean) / scale, -8, 8)
    xp, xu = norm(positive), norm(unlabelled)
    d = xp.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def forward(x):
        a = np.tanh(x @ params[0] + params[1])
        return a, a @ params[2] + params[3][0]

    def backward(x, a, g):
        ga = np.outer(g, params[2]) * (1 - a * a)
        return [x.T @ ga, ga.sum(0), a.T @ g, np.array([g.sum()])]

    steps = max(1, len(xu) // BATCH)
    t = 0
    for _ in range(EPOCHS):
        op, ou = rng.permutation(len(xp)), rng.permutation(len(xu))
        for k in range(steps):
            bp, bu = xp[op[k::steps]], xu[ou[k::steps]]
            if not len(bp) or not len(bu):
                continue
            (ap, fp), (au, fu) = forward(bp), forward(bu)
            bad = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            gp_bad, gu = -prior * sigmoid(fp) / len(bp), sigmoid(fu) / len(bu)
            gp = -prior * sigmoid(-fp) / len(bp)
            if bad >= 0:
                grads = [x + y for x, y in zip(backward(bp, ap, gp + gp_bad), backward(bu, au, gu), strict=True)]
            else:  # the negative part is over-fitted: walk it back
                grads = [-(x + y) for x, y in zip(backward(bp, ap, gp_bad), backward(bu, au, gu), strict=True)]
            t += 1
            for i, g in enumerate(grads):
                g = g + 1e-4 * params[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - RATE * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, params[0], params[1], params[2], float(params[3][0]))


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(batch.column(0))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds_: int = 4,
        held: int = 2, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[Model | None, float]:
    """(model, prior). The labels tell trusted positives and the class prior, nothing else."""
    known = folds.training_labels(labels, key, label, folds_, held)
    n, good = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    prior = ((good or 0) + 1) / (n + 2)
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    trusted = folds.bounded(known.filter("y = 1"), positives, "trusted").select("id", F.lit(1).alias("y"))
    open_ids = texts.select("id").filter(F.col("id").isNotNull() & (folds.fold(F.col("id"), folds_) != held))
    web = folds.bounded(open_ids.distinct(), unlabelled, "web").select("id", F.lit(0).alias("y"))
    drawn = texts.join(F.broadcast(trusted.union(web)), "id").groupBy("id", "y").agg(F.min("text").alias("text"))  # an id is one text
    got = drawn.select("text", "y").mapInArrow(_arrays, "y int, x array<double>").toArrow()
    y = got["y"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return None, prior
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    return fit_nnpu(x[y == 1], x[y == 0], min(prior, 0.99)), prior


def score_of(model: Model | None, prior: float, text: Column) -> Column:
    """Probability of good quality as a column."""
    if model is None:
        return F.lit(float(prior))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            yield pa.array(1 / (1 + np.exp(-np.clip(model.margin(statistics(arr)), -30, 30))))

    return score(text.cast("string"))


def score_texts(df: DataFrame, fitted: tuple[Model | None, float], text: str = "text", out: str = "quality") -> DataFrame:
    return df.withColumn(out, score_of(*fitted, F.col(text)))
