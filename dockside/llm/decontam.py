"""Benchmark decontamination with training suffix arrays.

The benchmark is the query set: it goes out in blocks of bounded size, and every task
holds one block at a time.  The training texts are the shards: each task builds, piece by
piece, the suffix array of its words and looks up every test suffix in it by binary
search.  Suffixes that can't begin with a whole window (a word that no test item has comes
too early) are left out of the array; no match starts there.  Each hit is extended to its
longest verbatim match over all places of its window in the benchmark: a block has a suffix
array of its own, and a match narrows the range of the suffixes that go on like the text.
All matches of a document lie in one task, so nothing is joined.

A window is ``size`` consecutive item words; an item of fewer words, but not none, is one
window.  Missing texts have no words; a null item id counts as an empty one; repeated items
count once; without items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import Words, byte_column, ragged, text_pieces
from .trie import RangeMin

WINDOW = 10
BLOCK_BYTES = 2 << 20


class TestBlock:
    """Some test items: word ids, one search key for each distinct window, items by key.

    ``suffixes`` has the places of all windows, those of one key together, from
    ``first_suffix`` on, and sorted by the words that follow up to the item's end.
    """

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str], size: int):
        data, offsets = byte_column(pa.array(texts, pa.large_string()))
        words = Words(data, offsets)
        self.size = size
        self.vocabulary, inverse = np.unique(words.hashes, return_inverse=True)
        self.known = np.zeros(1 << 16, bool)
        self.known[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        self.sequence = np.concatenate([inverse + 1, np.zeros(size, np.int64)]).astype(np.uint32)
        n = words.counts()
        each = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        starts = ragged(words.first[:-1], each)
        lengths = np.repeat(np.minimum(n, size), each)
        item = np.repeat(np.arange(len(ids)), each)
        keys = self._keys(self.sequence, starts, lengths)
        self.keys, first, key_of = np.unique(keys, return_index=True, return_inverse=True)
        self.starts, self.lengths = starts[first], lengths[first]
        self.last = self._keys(self.sequence, self.starts, self.lengths, fill=0xFFFFFFFF)
        pairs = np.unique(np.stack([key_of.ravel(), item]), axis=1) if len(item) else np.zeros((2, 0), np.int64)
        self.items, self.first_item = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.keys) + 1))
        self.tails, places = self._tails(inverse + 1, words.first, starts, item)
        order = np.lexsort((_ranks(self.tails, int(n.max(initial=0)) + 1)[places], key_of.ravel()))
        self.suffixes = places[order].astype(np.int32)
        self.first_suffix = np.searchsorted(key_of.ravel()[order], np.arange(len(self.keys) + 1))
        self.ids = np.array(ids, dtype=object)
        # Of the items that share a match, the one that is named: the least id, then place.
        self.item_of, self.place_of = item[order], (starts - words.first[item])[order]
        by_name = np.lexsort((self.place_of, _text_ranks(ids)[self.item_of]))
        name = np.empty(len(order), np.int64)
        name[by_name] = np.arange(len(order))
        self.by_name, self.names = by_name, RangeMin(name) if len(name) else None
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0

    def _keys(self, sequence, starts, lengths, fill: int = 0) -> np.ndarray:
        """The next ``size`` word ids as text of fixed width that sorts like the ids."""
        steps = np.arange(self.size)
        places = np.minimum(starts[:, None] + steps, len(sequence) - 1)
        table = np.where(steps < lengths[:, None], sequence[places], np.uint32(fill)).astype(">u4")
        return np.ascontiguousarray(table).view(f"S{4 * self.size}").ravel()

    @staticmethod
    def _tails(sequence, first, starts, item) -> tuple[np.ndarray, np.ndarray]:
        """The word ids with a zero after each item, and the windows' places among them."""
        out = np.zeros(len(sequence) + len(first), np.uint32)
        out[np.arange(len(sequence)) + np.repeat(np.arange(len(first) - 1), np.diff(first))] = sequence
        return out, starts + item

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.uint32)
        maybe = np.flatnonzero(self.known[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == hashes[maybe]
        out[maybe[same]] = at[same] + 1
        return out

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Place of every occurrence of a window in the training words, and its key."""
        none = np.zeros(0, np.int64)
        if not self.shortest or not len(words.hashes):
            return none, none
        ids = self.word_ids(words.hashes)
        # How many known words follow in the same text, from each place.
        stop = np.zeros(len(ids) + 1, bool)
        stop[words.first] = True
        stop[:-1] |= ids == 0
        stops = np.flatnonzero(stop)
        places = np.flatnonzero(ids)
        ahead = stops[np.searchsorted(stops, places, side="right")] - places
        keep = ahead >= self.shortest
        places, ahead = places[keep], ahead[keep]
        if not len(places):
            return none, none
        suffixes = self._keys(np.append(ids, np.uint32(0)), places, ahead)
        order = np.argsort(suffixes, kind="stable")
        array, suffixes = places[order], suffixes[order]
        low = np.searchsorted(suffixes, self.keys, side="left")
        high = np.searchsorted(suffixes, self.last, side="right")
        # A shorter known run is padded with zeros, which no key has inside.
        found = ragged(low, high - low)
        return array[found], np.repeat(np.arange(len(self.keys)), high - low)

    def longest(
        self, words: Words, at: np.ndarray, key: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The longest verbatim match that starts at each occurrence, over all items: its words, and
        the item and place it is found in."""
        ids = self.word_ids(words.hashes)
        room = words.first[np.searchsorted(words.first, at, side="right")] - at
        length = self.lengths[key].copy()
        low, high = self.first_suffix[key], self.first_suffix[key + 1]
        live = np.flatnonzero((length < room) & (length == self.size))  # a short item is one window
        while len(live):
            step, symbol = length[live], ids[at[live] + length[live]]
            start = self._bound(low[live], high[live], step, symbol)
            end = self._bound(start, high[live], step, symbol + np.uint32(1))
            go = (start < end) & (symbol > 0)
            live = live[go]
            low[live], high[live] = start[go], end[go]
            length[live] += 1
            live = live[length[live] < room[live]]
        suffix = self.by_name[self.names.over(low, high - 1)]
        return length, self.item_of[suffix], self.place_of[suffix]

    def _bound(self, low: np.ndarray, high: np.ndarray, step: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """First suffix of each range whose word after ``step`` words is at least ``symbol``."""
        low, high = low.copy(), high.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) // 2
            less = self.tails[self.suffixes[middle] + step[live]] < symbol[live]
            low[live[less]] = middle[less] + 1
            high[live[~less]] = middle[~less]
            live = live[low[live] < high[live]]
        return low


def _text_ranks(texts: list[str]) -> np.ndarray:
    """Ranks of texts by their UTF-8 bytes."""
    return np.unique(np.array([t.encode() for t in texts] or [b""], dtype=object), return_inverse=True)[1].ravel()


def _ranks(sequence: np.ndarray, most: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``most`` symbols, by doubling."""
    rank, width = sequence.astype(np.int64), 1
    while width < most:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:] + 1
        _, rank = np.unique(rank * (len(rank) + int(rank.max(initial=0)) + 2) + after, return_inverse=True)
        rank, width = rank.ravel(), 2 * width
    return rank


def test_blocks(benchmark: DataFrame, size: int, block_bytes: int) -> list:
    """The benchmark as broadcast blocks; the driver holds one block of texts at a time."""
    context, blocks, ids, texts, held = benchmark.sparkSession.sparkContext, [], [], [], 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    )
    for item, text in rows.toLocalIterator():
        ids.append(item)
        texts.append(text)
        held += len(text.encode())
        if held >= block_bytes:
            blocks.append(context.broadcast(TestBlock(ids, texts, size)))
            ids, texts, held = [], [], 0
    if ids:
        blocks.append(context.broadcast(TestBlock(ids, texts, size)))
    return blocks


test_blocks.__test__ = False


@dataclass
class Found:
    """What the benchmark has in common with consecutive texts, text by text."""

    hit: np.ndarray
    items: list[set]
    longest: np.ndarray
    #: Matches as (start word, words, item id, start word in the item), in order.
    spans: list[list[tuple[int, int, str, int]]]


def _search(words: Words, blocks: list) -> Found:
    """Hit words, item ids, the longest match and all maximal matches of consecutive texts."""
    n = len(words.first) - 1
    hit = np.zeros(len(words.hashes) + 1, np.int64)
    items: list[set] = [set() for _ in range(n)]
    longest = np.zeros(n, np.int64)
    matches: dict[int, tuple[int, bytes, int]] = {}
    for block in (b.value for b in blocks):
        at, key = block.matches(words)
        if not len(at):
            continue
        np.add.at(hit, at, 1)
        np.add.at(hit, at + block.lengths[key], -1)
        doc = np.searchsorted(words.first, at, side="right") - 1
        length, item, place = block.longest(words, at, key)
        np.maximum.at(longest, doc, length)
        for d, k in np.unique(np.stack([doc, key]), axis=1).T:
            items[d].update(block.ids[block.items[block.first_item[k] : block.first_item[k + 1]]])
        for i, m, t, q in zip(at.tolist(), length.tolist(), item.tolist(), place.tolist(), strict=True):
            best = (-m, block.ids[t].encode(), q)
            matches[i] = min(matches.get(i, best), best)
    spans: list[list] = [[] for _ in range(n)]
    reach = 0
    for i in sorted(matches):
        m, name, q = matches[i]
        if i - m > reach:  # else it lies inside an earlier match
            reach = i - m
            d = int(np.searchsorted(words.first, i, side="right")) - 1
            spans[d].append((i - int(words.first[d]), -m, name.decode(), q))
    covered = np.cumsum(hit[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(covered)])
    return Found(np.diff(total[words.first]), items, longest, spans)


#: A match: words of the document, and the same number of words of an item.
SPAN = T.StructType(
    [
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("item", T.StringType()), T.StructField("item_start", T.LongType()),
    ]
)
_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item", pa.string()), ("item_start", pa.int64())])


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row a document: ``doc_id, n_words, n_hit, longest_match, items`` (sorted texts) and
    ``spans``: its maximal matches in order, as ``start, length, item, item_start`` in words from 0.

    Of the items that hold a match, the one with the least id (as text) is named, at its first place.
    Null texts have no words; repeated rows each give a row; an empty benchmark gives rows without
    matches, no rows give none; columns other than ``doc_id`` and ``text`` are ignored.
    """
    blocks = test_blocks(benchmark, size, block_bytes)
    fields = [docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "longest_match"))]
    schema = T.StructType(
        [*fields, T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN))]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            words = Words(data, offsets)
            found = _search(words, blocks)
            columns = [rows.column(0), *map(pa.array, (words.counts(), found.hit, found.longest))]
            columns.append(pa.array([sorted(x) for x in found.items], pa.list_(pa.string())))
            spans = [[dict(zip(SPAN.names, x, strict=True)) for x in own] for own in found.spans]
            columns.append(pa.array(spans, pa.list_(_SPAN)))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", "text").mapInArrow(search, schema)


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows without any window of the benchmark, with all their columns, repeated rows each.

    Null texts have no window; without items nothing goes; no rows give none.
    """
    blocks = test_blocks(benchmark, size, block_bytes)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches):
            found = _search(Words(data, offsets), blocks)
            yield rows.filter(pa.array(found.hit == 0))

    return docs.mapInArrow(clean, docs.schema)

