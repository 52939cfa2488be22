"""Toxicity by cumulative-link ordinal regression over sparse word features.

The chance that a text's severity is above grade ``k`` is ``sigmoid(w x - theta_k)`` with one
weight vector for all thresholds and ``theta_0 < theta_1 < ...``.  Labels only say toxic or
not, so toxic training rows are graded 1 to 3 by terciles of how many of their terms are
marked: seen far more often in toxic rows than in others.  ``x`` holds ``1 + ln tf`` of
the words, and of the beginnings of longer words (inflected and compound forms share
them), that a likelihood-ratio test ties to toxic rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import BYTE_CODES, LOWER, Words, Workspace, mix, prefix_hash, share_below, span_hash, text_of_each, text_pieces

#: Bounds of the fit: about so many rows of each kind.
TOXIC_ROWS, OTHER_ROWS = 3000, 5000
#: A term needs so many toxic rows to be selected.
LEAST_ROWS = 4
SLACK = 0.01
#: Beginnings of so many bytes are terms of their own.
STEMS = (4, 5)
GRADES = 3


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and hash of every term, and the number of words of each text."""
    words = Words(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), words.counts())
    sums = prefix_hash(BYTE_CODES[LOWER[data]])
    docs, hashes = [doc], [words.hashes]
    for size in STEMS:
        longer = np.flatnonzero(words.ends - words.starts > size)
        starts = words.starts[longer]
        docs.append(doc[longer])
        hashes.append(mix(span_hash(sums, starts, starts + size) + np.uint64(size)))
    return np.concatenate(docs), np.concatenate(hashes), words.counts()


def _term_counts(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct term of each text."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def sample_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of a bounded sample of the labelled rows, one text for each id."""
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic, known = labels.agg(F.count_if(F.col("toxic") == 1), F.count("*")).first()
    share = F.when(F.col("toxic") == 1, TOXIC_ROWS / max(toxic, 1)).otherwise(OTHER_ROWS / max(known - toxic, 1))
    sample = text_of_each(docs, labels.where(share_below("doc_id", share, 23)))
    return sample.select("text", F.col("toxic").cast("long").alias("toxic"))


def select_terms(sample: DataFrame, n_toxic: int, n: int, workspace: Workspace) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms tied to toxic rows, in order, and which of them mark a row.

    Rows are counted by term in Spark; only the selected terms come to the driver, all of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            doc, hashes, _ = _term_counts(*terms(data, offsets)[:2])
            found, which = np.unique(hashes, return_inverse=True)
            toxic = rows.column(1).to_numpy()[doc] == 1
            a = np.bincount(which[toxic], minlength=len(found))
            both = np.bincount(which, minlength=len(found))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (found.view(np.int64), a, both)], ["term", "a", "both"])

    counts = sample.mapInArrow(count, "term long, a long, both long").groupBy("term")
    counts = workspace.stage(counts.agg(F.sum("a").alias("a"), F.sum("both").alias("both")), "terms")
    expected, b = F.col("both") * (n_toxic / n), F.col("both") - F.col("a")
    part = lambda seen, mean: F.when(seen > 0, seen * F.log(seen / mean)).otherwise(0.0)
    ratio = 2 * (part(F.col("a"), expected) + part(b, F.col("both") - expected))
    # So strict that of all terms about one would pass by chance.
    tied = (F.col("a") > expected) & (F.col("a") >= LEAST_ROWS) & (ratio >= 2 * np.log(max(counts.count(), 2)))
    odds = (F.col("a") + 0.5) / (n_toxic + 1) / ((b + 0.5) / (n - n_toxic + 1))
    chosen = counts.where(tied).select("term", ratio.alias("ratio"), (odds > float(np.exp(2))).alias("marks"))
    chosen = chosen.collect()
    hashes = np.array([r.term for r in chosen], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r.marks for r in chosen], bool)[order]


@dataclass
class Rows:
    """Training rows: counts of selected terms by row and place of the term, and labels."""

    row: np.ndarray
    term: np.ndarray
    count: np.ndarray
    toxic: np.ndarray


def training_rows(sample: DataFrame, vocabulary: np.ndarray) -> Rows:
    """The sample's rows over the selected terms, at the driver."""
    shared = sample.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            doc, hashes, counts = _term_counts(*terms(data, offsets)[:2])
            doc, term, counts = _known(shared.value, doc, hashes, counts)
            first = np.searchsorted(doc, np.arange(rows.num_rows + 1))
            cut = lambda x: [x[first[i] : first[i + 1]].astype(np.int32).tobytes() for i in range(rows.num_rows)]
            columns = [rows.column(1), *(pa.array(cut(x), pa.binary()) for x in (term, counts))]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "terms", "counts"])

    rows = sample.mapInArrow(count, "toxic long, terms binary, counts binary").collect()
    found = [np.frombuffer(bytes(r.terms), np.int32) for r in rows]
    counts = [np.frombuffer(bytes(r["counts"]), np.int32) for r in rows]
    join = lambda x: np.concatenate([np.zeros(0, np.int32), *x])
    row = np.repeat(np.arange(len(rows)), [len(x) for x in found])
    return Rows(row, join(found), join(counts), np.array([r.toxic for r in rows], np.int64))


def _known(vocabulary: np.ndarray, doc: np.ndarray, hashes: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """The occurrences of known terms: text, place in the sorted vocabulary, and the rest."""
    if not len(vocabulary):
        return tuple(x[:0] for x in (doc, doc, *more))
    known = np.zeros(1 << 16, bool)
    known[(vocabulary >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(known[(hashes >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(vocabulary, hashes[maybe]), len(vocabulary) - 1)
    hit = vocabulary[at] == hashes[maybe]
    return doc[maybe[hit]], at[hit], *(x[maybe[hit]] for x in more)


def severity_grades(rows: Rows, marks: np.ndarray) -> np.ndarray:
    """Grade 0 for other rows; toxic ones by terciles of their marked terms."""
    weights = marks[rows.term] * (1 + np.log(rows.count))
    amount = np.bincount(rows.row, weights=weights, minlength=len(rows.toxic))
    cuts = np.quantile(amount[rows.toxic == 1], [1 / 3, 2 / 3])
    return np.where(rows.toxic == 1, 1 + np.searchsorted(cuts, amount, side="left"), 0)


@dataclass
class Model:
    """Weights by term hash (sorted), thresholds in rising order, and the chance of a grade
    above 0 from which a text is called toxic."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def above(self, z: np.ndarray) -> np.ndarray:
        """Chance that the severity is above each grade."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - z[:, None], -30, 30)))

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``w x`` of each text."""
        n = len(offsets) - 1
        doc, word = _known(self.words, *terms(data, offsets)[:2])
        if not len(doc):
            return np.zeros(n)
        pairs, count = np.unique(doc * len(self.words) + word, return_counts=True)
        doc, word = np.divmod(pairs, len(self.words))
        return np.bincount(doc, weights=self.weights[word] * (1 + np.log(count)), minlength=n)


def ordinal_fit(
    row: np.ndarray,
    column: np.ndarray,
    x: np.ndarray,
    grade: np.ndarray,
    size: int,
    steps: int = 400,
    rate: float = 0.1,
    decay: float = 3e-5,
) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the likelihood; thresholds are a first value and positive gaps, so they stay in order."""
    n, levels = len(grade), int(grade.max())
    params = np.zeros(size + levels)
    m, v = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -30, 30)))
    for step in range(1, steps + 1):
        w, raw = params[:size], params[size:]
        gaps = np.append(raw[0], np.logaddexp(0, raw[1:]))
        theta = np.concatenate([[-np.inf], np.cumsum(gaps), [np.inf]])
        z = np.bincount(row, weights=w[column] * x, minlength=n)
        # Grade g has probability s(theta[g + 1] - z) - s(theta[g] - z).
        upper, lower = sigmoid(theta[grade + 1] - z), sigmoid(theta[grade] - z)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        dz = (du - dl) / n
        g = np.empty_like(params)
        g[:size] = np.bincount(column, weights=dz[row] * x, minlength=size) + decay * w
        d_theta = np.zeros(levels + 2)
        np.add.at(d_theta, grade + 1, -du / n)
        np.add.at(d_theta, grade, dl / n)
        tail = np.cumsum(d_theta[1:-1][::-1])[::-1]
        g[size:] = tail * np.append(1, sigmoid(raw[1:]))
        m += 0.1 * (g - m)
        v += 0.01 * (g**2 - v)
        params -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return params[:size], np.cumsum(np.append(params[size], np.logaddexp(0, params[size + 1 :])))


def fit(docs: DataFrame, labels: DataFrame, workspace: Workspace | None = None) -> Model | None:
    """Train on ``text`` of ``docs`` and ``doc_id, toxic`` of ``labels``; None unless both kinds occur."""
    workspace = workspace or Workspace(docs.sparkSession, "toxicity")
    sample = sample_rows(docs, labels)
    n_toxic, n = sample.agg(F.count_if(F.col("toxic") == 1), F.count("*")).first()
    if not 0 < n_toxic < n:
        return None
    vocabulary, marks = select_terms(sample, n_toxic, n, workspace)
    rows = training_rows(sample, vocabulary)
    x = 1 + np.log(rows.count)
    weights, thresholds = ordinal_fit(rows.row, rows.term, x, severity_grades(rows, marks), len(vocabulary))
    model = Model(vocabulary, weights, thresholds)
    z = np.bincount(rows.row, weights=weights[rows.term] * x, minlength=len(rows.toxic))
    model.cut = best_cut(model.above(z)[:, 0], rows.toxic == 1)
    return model


def best_cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with about fewest errors.

    Errors count by the share of their kind; ``SLACK`` more than the fewest are allowed, so
    that a few odd training rows don't push the cut to the edge of a kind.
    """
    order = np.argsort(chance)
    chance, toxic = chance[order], toxic[order]
    missed = np.concatenate([[0], np.cumsum(toxic)]) / toxic.sum()
    false = 1 - np.concatenate([[0], np.cumsum(~toxic)]) / (~toxic).sum()
    edges = np.concatenate([[0], chance, [1]])
    errors, gap = missed + false, np.diff(edges)
    best = int(np.argmax(np.where(errors <= errors[gap > 0].min() + SLACK, gap, -1)))
    return float(np.clip((edges[best] + edges[best + 1]) / 2, 0.05, 0.95))


def severity(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, severity`` (expected grade), ``grade`` (likeliest) and ``toxic`` of every row.

    ``toxic`` holds where the chance of a grade above 0 reaches the model's cut.  Null texts count as empty;
    without a model everything has severity 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    more = (("severity", T.DoubleType()), ("grade", T.IntegerType()), ("toxic", T.BooleanType()))
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in more)])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            model, n = shared.value, rows.num_rows
            above = model.above(model.evidence(data, offsets)) if model else np.zeros((n, GRADES))
            chances = -np.diff(np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1), axis=1)
            found = above.sum(axis=1), chances.argmax(axis=1).astype(np.int32), above[:, 0] >= (model.cut if model else 0.5)
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, found)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(predict, schema)
