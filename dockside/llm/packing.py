"""Best-two-fit packing of token sequences.

Only a document's length matters for its place, and lengths end at the sequence size, so
the packing itself works on one count for each length: a table of bounded size, made by
all tasks.  A bin is filled greedily with the longest document that fits, again and again.
Then its smallest document goes back if two unpacked documents fit the gap it leaves more
tightly.  The same bin is repeated as long as its lengths last, as the same choices would
come again.  The plan says which documents of a length, by rank, go to which sequences;
ranks come from counts of tasks, so nothing is sorted and no group is gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import Workspace, text_pieces

SEQUENCE = 2048
END_ID = 0
#: Bytes of text that are tokenized at once; the arrays take about fifty times as much.
PIECE = 1 << 19

_tokenizers: dict = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        from .tokens import BatchTokenizer

        _tokenizers[path] = BatchTokenizer(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE) -> DataFrame:
    """Tokenize all texts and cut those of more than ``size`` tokens.

    Returns a row a piece: ``doc_id, piece, start, length, ids_crc32, block, nth`` where the
    last two number the pieces of one length within the task that made them.
    """
    kinds = (("piece", T.IntegerType()), *((c, T.LongType()) for c in ("start", "length", "ids_crc32")))
    kinds += (("block", T.IntegerType()), ("nth", T.LongType()))
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, k) for n, k in kinds)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, block = _tokenizer(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for rows, data, offsets in text_pieces(batches, most=PIECE):
            ids, at = tokenizer.encode(data, offsets)
            total = np.diff(at) + 1
            each = -(-total // size)
            doc = np.repeat(np.arange(len(total)), each)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
            start = piece * size
            length = np.minimum(size, total[doc] - start)
            crc = np.empty(len(doc), np.int64)
            end = np.full(1, END_ID, "<u4").tobytes()
            for k in range(len(doc)):
                low = at[doc[k]] + start[k]
                high = min(low + length[k], at[doc[k] + 1])
                value = zlib.crc32(memoryview(ids[low:high]))
                crc[k] = zlib.crc32(end, value) if high - low < length[k] else value
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            nth = np.empty(len(doc), np.int64)
            nth[order] = np.arange(len(doc)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=size + 1)
            columns = [piece.astype(np.int32), start, length, crc, np.full(len(doc), block, np.int32), nth]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(doc)), *map(pa.array, columns)], schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _tightest_pair(lengths: np.ndarray, free: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two free documents whose lengths add up closest to ``room`` from below."""
    lengths = lengths[free[lengths] > 0]
    small = lengths[2 * lengths <= room]
    if not len(small):
        return None
    at = np.searchsorted(lengths, room - small, side="right") - 1
    alone = (lengths[at] == small) & (free[small] < 2)
    at = at - alone
    fits = at >= 0
    if not fits.any():
        return None
    small, large = small[fits], lengths[at[fits]]
    best = int(np.argmax(small + large))
    return int(small[best]), int(large[best])


def best_two_fit(counts: np.ndarray, size: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """Bins for ``counts[length]`` documents: how many of each length, and how often."""
    left = counts.astype(np.int64).copy()
    bins = []
    while True:
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return bins
        content: dict[int, int] = {}
        gap, top = size, len(lengths)
        while gap and top:
            top = int(np.searchsorted(lengths[:top], gap, side="right"))
            if not top:
                break
            length = int(lengths[top - 1])
            content[length] = min(int(left[length]), gap // length)
            gap -= length * content[length]
            top -= 1
        if gap:
            smallest = min(content)
            free = left.copy()
            for length, n in content.items():
                free[length] -= n
            pair = _tightest_pair(lengths, free, gap + smallest)
            if pair and sum(pair) > smallest:
                content[smallest] -= 1
                for length in pair:
                    content[length] = content.get(length, 0) + 1
                content = {length: n for length, n in content.items() if n}
        times = min(int(left[length]) // n for length, n in content.items())
        for length, n in content.items():
            left[length] -= n * times
        bins.append((content, times))


class Plan:
    """Ranks of each length to sequences and offsets; its size depends on the lengths only."""

    def __init__(self, counts: np.ndarray, size: int):
        rows, sequence, used = [], 0, np.zeros(size + 1, np.int64)
        for content, times in best_two_fit(counts, size):
            offset = 0
            for length in sorted(content, reverse=True):
                n = content[length]
                rows.append((length, used[length], n, sequence, offset))
                used[length] += n * times
                offset += n * length
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.each, self.sequence, self.offset = table.T
        self.first = np.searchsorted(self.length, np.arange(size + 2))
        self.sequences = sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        for value in np.unique(length):
            own = length == value
            low, high = self.first[value], self.first[value + 1]
            at[own] = low + np.searchsorted(self.rank[low:high], rank[own], side="right") - 1
        nth = rank - self.rank[at]
        return self.sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = SEQUENCE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Every document's pieces with their sequences.

    Takes ``doc_id`` and ``text``.  A null or empty text is the end id alone.  Null ids and
    repeated rows are packed like any other row; no rows give no rows.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark, "packing")
    pieces = workspace.stage(token_pieces(docs, tokenizer_path, size), "pieces")
    blocks = pieces.groupBy("block", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(size + 1, np.int64)
    for length, n in blocks.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = spark.sparkContext.broadcast(Plan(counts, size))
    before = W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(offsets, ["block", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    places = (("sequence_id", T.LongType()), ("offset", T.LongType()))
    schema = T.StructType([*ranked.schema.fields[:-1], *(T.StructField(n, k) for n, k in places)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            found = plan.value.place(length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], schema.names)

    return ranked.mapInArrow(place, schema)
