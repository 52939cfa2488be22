"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; the unlabelled set is a sample of all texts.  The
model minimises the non-negative unbiased risk ``p R+(P) + max(0, R-(U) - p R-(P))`` with
logistic loss.  The class prior ``p`` is estimated from the same two sets: a first model ranks
held-back halves of both, and among all cuts of its score the least ratio of unlabelled to
positive texts above the cut, with a margin for chance, bounds the share of positives.  Features describe how a text is
written, not its language: shares of single punctuation marks, of capitals, digits, line
breaks, and how often words and word triples repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import Words, sample_texts, share_below, text_of_each, text_pieces

#: Bounds of the fit: about so many rows of each kind, whatever the table's size.
POSITIVES, UNLABELLED = 6000, 12000

_UPPER, _LOWER, _DIGIT, _BEYOND = range(4)
_GROUP = np.zeros(256, np.int64)
_GROUP[0x41:0x5B], _GROUP[0x61:0x7B], _GROUP[0x30:0x3A], _GROUP[0x80:] = _UPPER, _LOWER, _DIGIT, _BEYOND
_MARKS = [b for b in range(0x80) if not chr(b).isalnum()]
_GROUP[_MARKS] = 4 + np.arange(len(_MARKS))
_GROUPS = 4 + len(_MARKS)


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each text; the top bits of a key hold the text's index."""
    bits = np.uint64(max(1, int(n).bit_length()))
    keys = np.sort((doc.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[new] >> (np.uint64(64) - bits)).astype(np.int64), minlength=n)[:n]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text, empty ones included."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    counts = np.bincount(doc * _GROUPS + _GROUP[data], minlength=n * _GROUPS).reshape(n, _GROUPS)
    share = np.log1p(1000 * counts / np.maximum(size, 1)[:, None])
    words = Words(data, offsets)
    own = words.counts()
    word_doc = np.repeat(np.arange(n), own)
    triples, first = words.shingles(3)
    triple_doc = np.repeat(np.arange(n), np.diff(first))
    length = np.bincount(word_doc, weights=words.ends - words.starts, minlength=n)[:n]
    some = np.maximum(own, 1)
    more = np.stack(
        [
            1 - _distinct(word_doc, words.hashes, n) / some,
            1 - _distinct(triple_doc, triples, n) / np.maximum(np.diff(first), 1),
            length / some / 10,
            np.log1p(own) / 10,
            own == 0,
        ],
        axis=1,
    )
    return np.concatenate([share, np.minimum(share, 1), more, np.sqrt(more)], axis=1).astype(np.float32)


@dataclass
class Model:
    """A linear model over standardised features."""

    prior: float
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.center) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def non_negative_fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.03, decay: float = 1e-3
) -> Model:
    """Adam on the non-negative risk; where the negative part falls below zero, its own
    gradient is followed back up instead, so that the model doesn't fit the positives' noise."""
    center, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - center) / scale, -8, 8).astype(np.float64) for x in (positive, unlabelled))
    w = np.zeros(p.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    loss = lambda z: np.logaddexp(0, -z)
    slope = lambda z: -1 / (1 + np.exp(np.clip(z, -30, 30)))  # noqa: E731  of the loss
    grad = lambda x, d: np.append(x.T @ d, d.sum()) / len(d)
    for step in range(1, steps + 1):
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        negative = loss(-zu).mean() - prior * loss(-zp).mean()
        g_negative = grad(u, -slope(-zu)) - prior * grad(p, -slope(-zp))
        g = -g_negative if negative < 0 else prior * grad(p, slope(zp)) + g_negative
        g[:-1] += decay * w[:-1]
        m += 0.1 * (g - m)
        v += 0.01 * (g**2 - v)
        w -= rate * (1 - 0.9 * step / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(prior, center, scale, w[:-1], float(w[-1]))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, chance: float = 0.1, folds: int = 2) -> float:
    """Share of positives among the unlabelled, from nothing but the two sets.

    Where the score of a model is high, the unlabelled texts are positives, if there is such a
    place at all: there ``P(above | unlabelled) / P(above | positive)`` is the prior.  The cut is the
    one with the least upper confidence bound of that ratio (best-bin estimation).  Every text
    is scored by a model that was fitted to the other fold.  The result is one standard error
    below the ratio: the non-negative risk bears a prior that is too low better than one that
    is too high.
    """
    rng = np.random.default_rng(0)
    fold_p, fold_u = (rng.permutation(len(x)) % folds for x in (positive, unlabelled))
    p, u = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for k in range(folds):
        rest_p, rest_u = positive[fold_p != k], unlabelled[fold_u != k]
        model = non_negative_fit(rest_p if len(rest_p) else positive, rest_u if len(rest_u) else unlabelled, 0.5)
        p[fold_p == k], u[fold_u == k] = model.score(positive[fold_p == k]), model.score(unlabelled[fold_u == k])
    above = lambda scores, cuts: 1 - np.searchsorted(np.sort(scores), cuts, side="left") / len(scores)
    cuts = np.unique(p)
    of_p, of_u = above(p, cuts), above(u, cuts)
    margin = sum(np.sqrt(np.log(4 / chance) / (2 * len(x))) for x in (p, u))
    best = int(np.argmin((of_u + 1.01 * margin) / of_p))
    ratio, of_p, of_u = of_u[best] / of_p[best], of_p[best], of_u[best]
    error = np.sqrt(of_u * (1 - of_u) / len(u)) / of_p + ratio * np.sqrt((1 - of_p) / (of_p * len(p)))
    least = 1 / (len(unlabelled) + 2)
    return float(np.clip(ratio - error, least, 1 - least))


def _rows(docs: DataFrame) -> np.ndarray:
    """Features of a bounded set of rows, at the driver."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in text_pieces(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(data, offsets).tobytes()], pa.binary())], ["x"])

    width = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    blocks = [np.frombuffer(bytes(r.x), np.float32) for r in docs.select("text").mapInArrow(compute, "x binary").collect()]
    return np.concatenate([np.zeros(0, np.float32), *blocks]).reshape(-1, width)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on ``text`` of ``docs`` and ``doc_id, quality`` of ``labels``, both only the rows to
    learn from.  None if there is no positive label with a text, or no text.

    Labels of bad rows are not used.  Labels without id or value count for nothing, and of several
    labels of one id the best counts; of several texts of one id one is taken.
    """
    labels = labels.where("doc_id IS NOT NULL AND quality = 1").select("doc_id").distinct()
    good = labels.count()
    total = docs.count()
    if not good or not total:
        return None
    positive = _rows(text_of_each(docs, labels.where(share_below("doc_id", POSITIVES / good, 21))))
    unlabelled = _rows(sample_texts(docs.select("doc_id", "text"), UNLABELLED / total, 22))
    if not len(positive) or not len(unlabelled):
        return None
    return non_negative_fit(positive, unlabelled, estimated_prior(positive, unlabelled))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score`` of every row; null texts count as empty.  Without a model: 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            model = shared.value
            found = model.score(features(data, offsets)) if model else np.full(rows.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found.astype(np.float64))], schema.names)

    return docs.select("doc_id", "text").mapInArrow(predict, schema)
