"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the letters of a text as bytes, one word (or a part of a long word) as
one sequence in both directions, and labels every byte position.  A document's language
probabilities are the mean over all its positions.  As the state starts anew at each word,
a word's labels depend on its bytes alone: each distinct word runs through the network
once, and the whole text is still labelled.  The network is trained here, in numpy, by
backpropagation through time on a bounded sample of labelled documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import (
    BYTE_CODES,
    LETTER_BYTES,
    LOWER,
    WordTable,
    prefix_hash,
    ragged,
    runs,
    sample_texts,
    span_hash,
    text_pieces,
)

UNKNOWN = "und"
LONGEST = 24
#: The fit takes about so many documents of each language, and words of each document.
SAMPLE_DOCS = 300
SAMPLE_WORDS = 150
#: The network and its training are made for so many languages, and grow beyond.
USUAL_LANGUAGES = 64
#: Labels by language that a worker holds, and that are summed at once.
TABLE_CELLS, SUM_CELLS = 1 << 26, 1 << 22


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the letter runs, long ones in parts of at most ``LONGEST`` bytes.

    A part begins with a whole character: its cut moves back to where the character starts.
    """
    starts, ends = runs(LETTER_BYTES[data], offsets)
    if not (ends - starts > LONGEST).any():
        return starts, ends
    wide = np.concatenate([[0], np.cumsum(data >= 0x80)])
    step = np.where(wide[ends] > wide[starts], LONGEST - 3, LONGEST)
    parts = np.where(ends - starts > LONGEST, -(-(ends - starts) // step), 1)
    own = np.repeat(np.arange(len(parts)), parts)
    place = ragged(np.zeros(len(parts), np.int64), parts)
    first = starts[own] + step[own] * place
    for _ in range(3):
        first -= (place > 0) & ((data[first] & 0xC0) == 0x80) & (first > starts[own])
    after = np.append(first[1:], 0)
    last = np.append(own[1:] != own[:-1], True)
    return first, np.where(last, ends[own], after)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Direction:
    """One gated recurrent layer over byte columns; its input weights are a row for each byte."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.params = {
            "inputs": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
            "state": rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32),
        }

    def forward(self, columns: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each column, shape (steps, batch, hidden)."""
        k, (batch, steps) = self.hidden, columns.shape
        state, out, trace = np.zeros((batch, k), np.float32), [], []
        for t in range(steps):
            given = self.params["inputs"][columns[:, t]]
            own = state @ self.params["state"]
            gates = _sigmoid(given[:, : 2 * k] + own[:, : 2 * k])
            update, reset = gates[:, :k], gates[:, k:]
            fresh = np.tanh(given[:, 2 * k :] + reset * own[:, 2 * k :])
            before, state = state, fresh + update * (state - fresh)
            out.append(state)
            if keep:
                trace.append((before, own[:, 2 * k :], update, reset, fresh))
        return np.stack(out), trace

    def backward(self, columns: np.ndarray, trace: list, upstream: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weights, given those of every state."""
        k = self.hidden
        grads = {name: np.zeros_like(p) for name, p in self.params.items()}
        carry = np.zeros_like(upstream[0])
        for t in range(len(trace) - 1, -1, -1):
            before, own, update, reset, fresh = trace[t]
            d = upstream[t] + carry
            d_fresh = d * (1 - update) * (1 - fresh**2)
            d_gates = np.concatenate(
                [d * (before - fresh) * update * (1 - update), d_fresh * own * reset * (1 - reset)], axis=1
            )
            np.add.at(grads["inputs"], columns[:, t], np.concatenate([d_gates, d_fresh], axis=1))
            d_own = np.concatenate([d_gates, d_fresh * reset], axis=1)
            grads["state"] += before.T @ d_own
            carry = d * update + d_own @ self.params["state"].T
        return grads


class BiGru:
    """Forward and backward layers and one softmax over languages at every position."""

    def __init__(self, languages: list[str], hidden: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.layers = (Direction(rng, hidden), Direction(rng, hidden))
        self.out = rng.normal(0, 0.2, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        #: The least score of an accepted text, by language.
        self.least = np.zeros(len(languages))

    def label(self, columns: np.ndarray) -> np.ndarray:
        """Language probabilities of every position of equally long sequences."""
        ahead, _ = self.layers[0].forward(columns)
        back, _ = self.layers[1].forward(columns[:, ::-1])
        return self._softmax(np.concatenate([ahead, back[::-1]], axis=2))

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.out + self.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def _step(self, columns: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        ahead, trace_a = self.layers[0].forward(columns, keep=True)
        back, trace_b = self.layers[1].forward(columns[:, ::-1], keep=True)
        states = np.concatenate([ahead, back[::-1]], axis=2)
        p = self._softmax(states)
        steps, batch, _ = p.shape
        rows = np.arange(batch)
        loss = -np.log(p[:, rows, target] + 1e-9).mean()
        p[:, rows, target] -= 1
        p /= steps * batch
        d_states = p @ self.out.T
        k = self.layers[0].hidden
        grads_a = self.layers[0].backward(columns, trace_a, d_states[:, :, :k])
        grads_b = self.layers[1].backward(columns[:, ::-1], trace_b, d_states[::-1, :, k:])
        d_out = np.einsum("tbh,tbl->hl", states, p)
        return loss, [*grads_a.values(), *grads_b.values(), d_out, p.sum(axis=(0, 1))]

    def fit(
        self,
        data: np.ndarray,
        first: np.ndarray,
        lengths: np.ndarray,
        target: np.ndarray,
        drawn: np.ndarray,
        steps: int = 600,
        batch: int = 256,
        rate: float = 0.01,
    ) -> float:
        """Adam over batches of equally long words of ``data``; ``drawn`` names words, some several
        times.  Returns the last losses' mean."""
        rng = np.random.default_rng(0)
        params = [*self.layers[0].params.values(), *self.layers[1].params.values(), self.out, self.bias]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        groups = {int(n): drawn[lengths[drawn] == n] for n in np.unique(lengths)}
        groups = {n: own for n, own in groups.items() if len(own)}
        chance = np.array([n * len(own) for n, own in groups.items()], float)
        losses = []
        for step in range(1, steps + 1):
            n = rng.choice(list(groups), p=chance / chance.sum())
            pick = groups[n][rng.integers(0, len(groups[n]), batch)]
            loss, grads = self._step(data[first[pick, None] + np.arange(n)], target[pick])
            losses.append(loss)
            slow = rate * (1 - 0.9 * step / steps)
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g**2 - v)
                p -= slow * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return float(np.mean(losses[-50:]))


class Labeller:
    """Sums of position labels of words, each distinct word labelled once."""

    def __init__(self, net: BiGru):
        bits = min(20, max(10, int(TABLE_CELLS // len(net.languages)).bit_length() - 1))
        self.net, self.table = net, WordTable(bits)
        self.sums = np.zeros((1024, len(net.languages)), np.float32)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        fresh = np.empty((len(keys), self.sums.shape[1]), np.float32)
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            for part in np.array_split(own, -(-len(own) // 4096)):
                fresh[part] = self.net.label(data[starts[part, None] + np.arange(n)]).sum(axis=0)
        used = self.table.used
        while used + len(keys) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.sums[used : used + len(keys)] = fresh
        self.table.add(keys, np.arange(used, used + len(keys), dtype=np.int32))

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean label probabilities of each text, and whether it has an ASCII letter."""
        data = LOWER[data]
        starts, ends = segments(data, offsets)
        keys = span_hash(prefix_hash(BYTE_CODES[data]), starts, ends)
        keys[keys == 0] = 1
        first = np.searchsorted(starts, offsets)
        sums = np.zeros((len(offsets) - 1, len(self.net.languages)))
        text = np.repeat(np.arange(len(sums)), np.diff(first))
        most = max(1, min(self.table.most, SUM_CELLS // sums.shape[1]))
        for low in range(0, len(keys), most):
            part = slice(low, low + most)
            place = self._places(keys[part], data, starts[part], (ends - starts)[part])
            own = text[part]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            sums[own[heads]] += np.add.reduceat(self.sums[place], heads, axis=0, dtype=np.float64)
        letters = np.concatenate([[0], np.cumsum(LETTER_BYTES[data])])
        ascii_letters = np.concatenate([[0], np.cumsum((data >= 0x61) & (data <= 0x7A))])
        positions = np.maximum(np.diff(letters[offsets]), 1)
        return sums / positions[:, None], np.diff(ascii_letters[offsets]) > 0

    def _places(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Places of the words' sums; unknown words are labelled first."""
        if self.table.used + len(keys) > self.table.most:
            self.table.clear()
        place = self.table.find(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            fresh, which = np.unique(keys[new], return_index=True)
            which = new[which]
            self._learn(fresh, data, starts[which], lengths[which])
            place[new] = self.table.find(keys[new])
        return place


def training_texts(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Of a sample of documents, bounded for each language: language, and some words with spaces between."""
    counts = docs.groupBy("lang").count().collect()
    shares = [x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, SAMPLE_DOCS / r["count"])))]
    if not shares:
        return []
    sample = sample_texts(docs, F.create_map(*shares)[F.col("lang")], 11)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            data = LOWER[data]
            starts, ends = segments(data, offsets)
            first = np.searchsorted(starts, offsets)
            out = []
            for i in range(len(offsets) - 1):
                own = np.arange(first[i], first[i + 1])
                if len(own) > SAMPLE_WORDS:
                    own = np.sort(np.random.default_rng(0).choice(own, SAMPLE_WORDS, replace=False))
                out.append(b" ".join(data[starts[k] : ends[k]].tobytes() for k in own))
            yield pa.RecordBatch.from_arrays([rows.column(1), pa.array(out, pa.binary())], ["lang", "words"])

    found = sample.select("text", "lang").mapInArrow(cut, "lang string, words binary")
    return sorted((r.lang, bytes(r.words)) for r in found.toLocalIterator() if r.words)


def fit(docs: DataFrame, steps: int = 600, cuts: bool = True) -> BiGru | None:
    """Train on ``text`` and non-null ``lang`` of the given rows; None without such rows.

    Every language is learned.  Beyond ``USUAL_LANGUAGES`` the network's states and the steps
    grow with their number.  With ``cuts`` all those rows are then scored for ``BiGru.least``;
    else every score is accepted.
    """
    labelled = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    texts = training_texts(labelled)
    if not texts:
        return None
    languages = sorted({lang for lang, _ in texts})
    index = {lang: i for i, lang in enumerate(languages)}
    data = np.frombuffer(b" ".join(w for _, w in texts), np.uint8)
    first, ends = (x.astype(np.int32) for x in runs(data != 0x20, np.array([0, len(data)])))
    sizes = np.array([len(w) for _, w in texts])
    heads = np.cumsum(sizes + 1) - sizes - 1
    label = np.array([index[lang] for lang, _ in texts], np.int32)
    target = label[np.searchsorted(heads, first, side="right") - 1]
    counts = np.bincount(target)
    rng = np.random.default_rng(0)
    # Each language as often as the others.
    drawn = np.empty((len(counts), counts.max()), np.int32)
    for i, n in enumerate(counts):
        drawn[i] = counts[:i].sum() + rng.integers(0, n, drawn.shape[1])
    grown = max(1.0, len(languages) / USUAL_LANGUAGES)
    net = BiGru(languages, hidden=int(16 * np.sqrt(grown)))
    net.fit(data, first, (ends - first).astype(np.uint8), target, drawn.ravel(), int(steps * grown))
    if cuts:
        net.least = least_scores(labelled, net)
    return net


def least_scores(docs: DataFrame, net: BiGru) -> np.ndarray:
    """The least score that is accepted, by language, from all rows of ``docs``.

    A text without any sign of a language scores about one part in the number of languages.
    The cut lies above that by a tenth of the way to the lowest score of the given texts
    that get the language (short texts vary more), so it falls with the number of languages
    and where close ones share the chance.
    """
    n = len(net.languages)
    if n == 1:
        return np.zeros(1)
    found = identify(docs, net).groupBy("lang_pred").agg(F.min("score").alias("score"))
    scores = {r.lang_pred: r.score for r in found.where(F.col("lang_pred") != UNKNOWN).collect()}
    lowest = np.array([scores.get(lang, 1.0) for lang in net.languages])
    return 1 / n + (lowest - 1 / n) / 10 - 1e-6


_labellers: dict[str, Labeller] = {}


def _labels(net, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a piece; ``net`` is a broadcast network."""
    if net is None:
        return [UNKNOWN] * rows.num_rows, np.zeros(rows.num_rows)
    if net.id not in _labellers:
        _labellers.clear()
        _labellers[net.id] = Labeller(net.value)
    labeller = _labellers[net.id]
    p, sure = labeller.probabilities(data, offsets)
    best = p.argmax(axis=1)
    names = [labeller.net.languages[i] for i in best]
    score = np.minimum(p[np.arange(len(best)), best], 1.0)
    for i in np.flatnonzero(~sure):
        if not any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace"))):
            names[i], score[i] = UNKNOWN, 0.0
    return names, score


class _Shared:
    """A broadcast network under an id of its own, so that workers keep what they labelled."""

    def __init__(self, docs: DataFrame, net: BiGru):
        self.cast = docs.sparkSession.sparkContext.broadcast(net)
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> BiGru:
        return self.cast.value


def identify(docs: DataFrame, net: BiGru | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row.

    A null text, or one without any letter, is ``und`` with score 0; so is everything if
    there was nothing to learn from.
    """
    shared = net and _Shared(docs, net)
    more = (("lang_pred", T.StringType()), ("score", T.DoubleType()))
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in more)])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            names, score = _labels(shared, rows, data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names), pa.array(score)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(predict, schema)


def keep_identified(docs: DataFrame, net: BiGru | None, least: np.ndarray | float = 0.0) -> DataFrame:
    """The rows whose language is known with at least the score ``least``, all columns.

    ``least`` is one score, or one for each of the network's languages (see ``BiGru.least``).
    """
    shared = net and _Shared(docs, net)
    cuts = dict(zip(net.languages, np.broadcast_to(least, len(net.languages)).tolist(), strict=True)) if net else {}

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            names, score = _labels(shared, rows, data, offsets)
            yield rows.filter(pa.array([n != UNKNOWN and s >= cuts[n] for n, s in zip(names, score, strict=True)]))

    return docs.mapInArrow(keep, docs.schema)

