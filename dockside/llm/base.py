"""What the operators share: staged tables, text columns as byte arrays, words, hashes.

Texts are handled as UTF-8 byte arrays straight from Arrow buffers; a missing text counts
as empty everywhere.  Work inside a task goes over pieces of bounded size, so that memory
depends on the piece (or the longest single text), not on the table.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import drop_folder, scratch_path

U64 = np.uint64
PIECE_BYTES = 1 << 20


# ---- staged tables ----


class Workspace:
    """A folder of its own under ``spark.checkpoint.dir`` for the tables one run stages.

    ``close`` removes the folder; the end of the Python process does it at the latest, as
    a result that is not computed yet may still read from it.
    """

    _open: set[Workspace] = set()

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self._open.add(self)
        atexit.register(self.close)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table: its lineage is cut, and it outlives executors."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        self._open.discard(self)
        atexit.unregister(self.close)
        if self.spark.sparkContext._jsc is not None:  # else the session ended before
            drop_folder(self.spark, self.root)


@contextmanager
def passing_workspaces() -> Iterator[None]:
    """Close the workspaces that are opened inside, once what they are for has been staged."""
    before = set(Workspace._open)
    yield
    for workspace in Workspace._open - before:
        workspace.close()


def text_size(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def fold(modulus: int) -> Column:
    """The remainder that decides which rows are held out; -1 for a null id."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(key, F.lit(modulus)), F.lit(-1))


def share_below(key: str, share: Column | float, seed: int) -> Column:
    """Holds for about this share of the rows, chosen by a seeded hash of the key.

    Rows with one key go together: only for keys that do not repeat.
    """
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30) < share


def sample_texts(docs: DataFrame, share: Column | float, seed: int) -> DataFrame:
    """About this share of the distinct rows, chosen by a seeded hash of doc_id and text.

    Repeated rows count once, and rows that share an id, or have none, are drawn each by itself,
    so no id brings more rows than its share.
    """
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30) < share
    return docs.where(drawn).dropDuplicates()


def text_of_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``ids`` (a bounded number of rows, each doc_id once) with one ``text``: of the texts that
    share an id, the one with the least hash."""
    found = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id")), "doc_id")
    found = found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return found.join(F.broadcast(ids), "doc_id")


def take_rows(docs: DataFrame, decided: DataFrame, digest: Column) -> DataFrame:
    """The rows of ``docs`` that a decision keeps, with all their columns.

    ``decided`` has ``_id, _digest, kept`` for every row; ``digest`` gives a row's digest.  Rows
    that agree in both are told apart by nothing: one of them stands for all, if one is kept.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"),
        F.col("doc_id").alias("_id"),
        digest.alias("_digest"),
    )
    same = lambda a, b: a["_id"].eqNullSafe(b["_id"]) & (a["_digest"] == b["_digest"])
    told = decided.groupBy("_id", "_digest").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    keep, repeated = told.where("kept"), told.where("kept AND n > 1")
    stay = rows.join(keep, same(rows, keep), "leftsemi")
    if not repeated.isEmpty():
        once = stay.join(repeated, same(stay, repeated), "leftanti")
        more = stay.join(repeated, same(stay, repeated), "leftsemi")
        more = more.groupBy(F.struct("_id", "_digest").alias("_key")).agg(F.first("_doc").alias("_doc"))
        stay = once.select("_doc").unionByName(more.select("_doc"))
    return stay.select("_doc.*")


# ---- Arrow columns as arrays ----


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its ``n + 1`` offsets, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if binary else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``most`` bytes, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of every run, one run after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


# ---- hashes ----


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1)
        table = np.full(size, U64(base))
        table[0] = 1
        have = np.cumprod(table, dtype=U64)
        if size <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums over 64-bit codes; :func:`span_hash` cuts hashes out of them."""
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * _power_table(_STEP, len(codes))[: len(codes)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``[start, end)``, equal for equal content at any place."""
    back = _power_table(_BACK, len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64))


# ---- words ----

#: Word bytes: ASCII digits and letters, and every byte of a character beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    WORD_BYTES[low:high] = True
LETTER_BYTES = WORD_BYTES.copy()
LETTER_BYTES[0x30:0x3A] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes that stay within one text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    end[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


class Words:
    """The lower-cased words of consecutive texts: places, hashes, and first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends = runs(WORD_BYTES[data], offsets)
        sums = prefix_hash(BYTE_CODES[LOWER[data]])
        self.hashes = span_hash(sums, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` consecutive words and the first shingle of each text.

        A text with fewer words, but not none, is one shingle.
        """
        counts = self.counts()
        sums = prefix_hash(self.hashes)
        each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        starts = ragged(self.first[:-1], each)
        length = np.repeat(np.minimum(counts, size), each)
        first = np.zeros(len(each) + 1, np.int64)
        np.cumsum(each, out=first[1:])
        return span_hash(sums, starts, starts + length), first


class WordTable:
    """Word hash to place, open addressing over arrays; emptied when full, so of bounded size."""

    def __init__(self, bits: int = 22):
        self.bits, self.most = bits, int(0.6 * (1 << bits))
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.place = np.zeros(1 << self.bits, np.int32)
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 where unknown."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.place[slot], -1)
        live = np.flatnonzero((there != keys) & (there != 0))
        while len(live):
            slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[live]]
            hit = there == keys[live]
            out[live[hit]] = self.place[slot[live[hit]]]
            live = live[~hit & (there != 0)]
        return out

    def add(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Insert distinct keys that are not there yet."""
        slot, live = self._slot(keys), np.arange(len(keys))
        while len(live):
            free = self.keys[slot[live]] == 0
            self.keys[slot[live[free]]] = keys[live[free]]
            won = self.keys[slot[live]] == keys[live]
            self.place[slot[live[won]]] = places[live[won]]
            live = live[~won]
            slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
        self.used += len(keys)


def text_pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their text bytes and offsets, each of bounded size."""
    for batch in batches:
        data, offsets = byte_column(batch.column(batch.schema.get_field_index(column)))
        for i, j in pieces(offsets, most):
            yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
