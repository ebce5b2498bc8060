"""Toxicity: a linear classifier regularised with counterfactuals.

Features are the distinct words of a text, their four-byte beginnings (for inflected insults), and which of them
occur more than once, hashed. In
the labelled sample, every text with identity terms is paired with its counterfactual, where each term is
swapped for the next of its group; the squared change of the score between the two is added to the loss, so a
neutral mention of a group moves the score as little as possible, whichever group it is.

The model is fitted on a bounded sample (``PER_CLASS`` texts of either label, by hash of the id). Scoring reads every whole text once, in parallel.

Defined results: a null or empty text has no features and gets the score of the intercept; label rows that
are null or neither 0 nor 1 are ignored, of repeated ones the larger counts; without both labels in the sample
every score is the smoothed share of toxic labels; extra columns of the input are kept by ``score_texts`` (its
own column replaces one of the same name); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm import folds, kernels

PER_CLASS = 4000  # bound of the training sample, texts per label
DIMENSIONS = 1 << 20
L1, L2, COUNTERFACTUAL = 2e-5, 1e-6, 1.0
MIN_Z = 1.6  # features whose shares in the two classes differ by fewer standard errors are left out
STEPS = 600

#: Groups of identity terms; a term is swapped for the next of its group.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native"), ("immigrants", "natives"), ("african", "european", "american", "chinese", "indian", "mexican"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)

_U = np.uint64


def _features(w: kernels.Words) -> tuple[np.ndarray, np.ndarray]:
    """(owner, feature) without repeats: whole words, four-byte beginnings of longer words, and which of both recur."""
    long = np.flatnonzero(w.end - w.start > 4)
    whole = w.hashes()
    begin = kernels.mix(w.span_hash(w.start[long], w.start[long] + 4) + _U(0x5851F42D4C957F2D))
    f = np.concatenate([whole, begin]) & _U(DIMENSIONS - 1)
    both, times = np.unique((np.concatenate([w.doc, w.doc[long]]).astype(_U) << _U(20)) | f, return_counts=True)
    more = both[times > 1]
    again = kernels.mix((more & _U(DIMENSIONS - 1)) + _U(0x2545F4914F6CDD1D)) & _U(DIMENSIONS - 1)
    both = np.unique(np.concatenate([both, (more & ~_U(DIMENSIONS - 1)) | again]))
    return (both >> _U(20)).astype(np.int64), (both & _U(DIMENSIONS - 1)).astype(np.int32)


def _of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return _features(kernels.Words(np.frombuffer(b"".join(texts), dtype=np.uint8), off, kernels.LETTERS_ONLY))


def swapped(text: bytes, groups=IDENTITY_GROUPS) -> bytes | None:
    """The lower-cased text with every identity term replaced by the next of its group; None without terms."""
    import re

    following = {a.encode(): b.encode() for g in groups for a, b in zip(g, g[1:] + g[:1], strict=True)}
    changed = False

    def swap(m):
        nonlocal changed
        new = following.get(m[0])
        changed |= new is not None
        return m[0] if new is None else new

    out = re.sub(rb"[a-z0-9\x80-\xff]+", swap, text.lower())
    return out if changed else None


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow mapper over (text, y): the features of a text and of its counterfactual (null without terms)."""
    for batch in batches:
        plain, other = [], []
        for text in batch.column(0).to_pylist():
            raw = (text or "").encode()
            twin = swapped(raw)
            plain.append(_of([raw])[1])
            other.append(None if twin is None else _of([twin])[1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(plain, pa.list_(pa.int32())), pa.array(other, pa.list_(pa.int32()))], names=["y", "x", "twin"])


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted feature numbers
    weights: np.ndarray
    intercept: float


def _rows(lists, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the entries whose feature is in the sorted ``columns``."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    f = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    at = np.searchsorted(columns, f)
    ok = (at < len(columns)) & (columns[np.minimum(at, len(columns) - 1)] == f)
    return row[ok], at[ok]


def fit_linear(x: list, y: np.ndarray, twins: list, prior: float = 0.5, strength: float = COUNTERFACTUAL) -> Model:
    """L1/L2 logistic regression plus ``strength`` * mean squared score change between a text and its twin.

    Scores are probabilities for a corpus with ``prior`` toxic texts: equal classes unless told otherwise, as missing
    a toxic text weighs as much as losing a clean one.
    """
    pos = np.bincount(np.concatenate([f for f, t in zip(x, y, strict=True) if t]), minlength=DIMENSIONS)
    neg = np.bincount(np.concatenate([f for f, t in zip(x, y, strict=True) if not t]), minlength=DIMENSIONS)
    n_pos, n_neg = int(y.sum()), int((1 - y).sum())
    p, q = (pos + 0.5) / (n_pos + 1), (neg + 0.5) / (n_neg + 1)
    z = np.abs(p - q) / np.sqrt(p * (1 - p) / n_pos + q * (1 - q) / n_neg)
    columns = np.flatnonzero((pos + neg >= 3) & (z > MIN_Z))
    if not len(columns):
        return Model(columns.astype(np.int32), np.zeros(0), float(np.log(prior / (1 - prior))))
    row, col = _rows(x, columns)
    # a text and its twin differ in the swapped terms only
    pairs = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in zip(x, twins, strict=True) if b is not None]
    row_a, col_a = _rows([a for a, _ in pairs], columns)
    row_b, col_b = _rows([b for _, b in pairs], columns)
    w, v, b, t = np.zeros(len(columns)), np.zeros(len(columns)), 0.0, 1.0
    # one over a bound of the curvature: traces of the two quadratic forms
    apart = (len(row_a) + len(row_b)) / max(len(pairs), 1)
    step = 1.0 / (0.25 * (len(row) / len(y) + 1) + 2 * strength * apart + L2)
    vb = b
    for _ in range(STEPS):
        margin = np.bincount(row, weights=v[col], minlength=len(y)) + vb
        err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
        grad = np.bincount(col, weights=err[row], minlength=len(w)) + L2 * v
        if pairs:
            gap = (np.bincount(row_a, weights=v[col_a], minlength=len(pairs))
                   - np.bincount(row_b, weights=v[col_b], minlength=len(pairs))) * (2 * strength / len(pairs))
            grad += np.bincount(col_a, weights=gap[row_a], minlength=len(w)) - np.bincount(col_b, weights=gap[row_b], minlength=len(w))
        new = v - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        new_b = vb - step * err.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    used = np.flatnonzero(w)
    shift = np.log(prior / (1 - prior)) - np.log(n_pos / n_neg)  # from the sample's share of toxic texts
    return Model(columns[used].astype(np.int32), w[used], float(b + shift))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        folds_: int = 3, held: int = 1, per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``per_class`` labelled texts of either class outside the held-out fold."""
    known = folds.training_labels(labels, key, label, folds_, held)
    n, toxic = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    prior = ((toxic or 0) + 1) / (n + 2)
    sample = folds.bounded(known.filter("y = 1"), per_class, "toxic").union(folds.bounded(known.filter("y = 0"), per_class, "clean"))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    drawn = texts.join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min("text").alias("text"))  # an id is one text
    got = drawn.select("text", "y").mapInArrow(sample_features, "y int, x array<int>, twin array<int>").toArrow()
    y = got["y"].to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(0, np.int32), np.zeros(0), float(np.log(prior / (1 - prior))))
    return fit_linear(_lists(got["x"]), y, _lists(got["twin"]))


def _lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """The lists of a column as views of its one buffer."""
    lists = column.combine_chunks()
    off, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[a:b] if ok else None for a, b, ok in zip(off[:-1], off[1:], lists.is_valid().to_numpy(zero_copy_only=False), strict=True)]


def score_of(model: Model, text: Column) -> Column:
    """Probability of the toxic label as a column."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = np.zeros(DIMENSIONS)
        dense[model.features] = model.weights
        for arr in batches:
            out = np.full(len(arr), model.intercept)
            for i, j, raw, off in kernels.chunked(arr):
                owner, f = _features(kernels.Words(raw, off, kernels.LETTERS_ONLY))
                out[i:j] += np.bincount(owner, weights=dense[f], minlength=j - i)
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return score(text.cast("string"))


def score_texts(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    return df.withColumn(out, score_of(model, F.col(text)))
