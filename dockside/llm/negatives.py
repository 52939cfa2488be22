"""Hard-negative mining: anchors against all rows, tile by tile, by Strassen multiplication.

Vectors become integers, ``floor(256 * x)``, so that a score is an exact integer inner product.
The anchors are a stated query set and meet every row in a grid of cells: rows are dealt evenly
into ``stripes``, anchors into ``bands`` of bounded size, and each cell, one stripe and one band,
is one unit of work.  A cell holds its anchors and streams its rows past them in tiles.  A tile
of scores is one product of int64 matrices by Strassen's recursion, zero-padded to an even split
at every level.  Sums wrap at 64 bits in between, which leaves a product that fits exact.

Heaps are small sorted lists of (score, identifier), the best of each slot.  Two heaps of a slot
merge by keeping the best of both, so cells give theirs and Spark merges them: first the
positives of each anchor, then, with the score windows those fix, the negatives of each window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Workspace, ragged

SCALE = 256
STRIPES = 64
BAND_ROWS = 1 << 16
TILE = 1024
#: Inner size from which the recursion multiplies plainly.
LEAF = 32
LOWEST = np.iinfo(np.int64).min


# ---- matrices ----


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact modulo 2**64."""
    rows, columns, inner = len(a), len(b), max(a.shape[1], b.shape[1], 1)
    levels = 0
    while min(rows, columns, inner) >> levels > leaf:
        levels += 1
    if 0 in (rows, columns):
        return np.zeros((rows, columns), np.int64)
    even = lambda n: -(-n >> levels) << levels
    return _multiply(_padded(a, even(rows), even(inner)), _padded(b, even(columns), even(inner)), levels)[
        :rows, :columns
    ]


def _padded(m: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if m.shape == (rows, columns):
        return m
    out = np.zeros((rows, columns), np.int64)
    out[: m.shape[0], : m.shape[1]] = m
    return out


def _multiply(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return np.einsum("ik,jk->ij", a, b)
    i, j, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    # The right factor is held transposed: its upper right block is b's lower left one.
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    down = levels - 1
    m1 = _multiply(a11 + a22, b11 + b22, down)
    m2 = _multiply(a21 + a22, b11, down)
    m3 = _multiply(a11, b12 - b22, down)
    m4 = _multiply(a22, b21 - b11, down)
    m5 = _multiply(a11 + a12, b22, down)
    m6 = _multiply(a21 - a11, b11 + b12, down)
    m7 = _multiply(a12 - a22, b21 + b22, down)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = m1 + m4 - m5 + m7
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[i:, j:] = m1 - m2 + m3 + m6
    return out


def integer_rows(column: pa.Array) -> np.ndarray:
    """Vectors as an integer matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    lengths = np.diff(at)
    x = np.floor(SCALE * column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].astype(np.float64))
    if len(x) and np.abs(x).max() >= 2.0**53:
        raise ValueError("a vector has a component beyond 2**45: its score does not fit in 64 bits")
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), ragged(np.zeros_like(lengths), lengths)] = x
    return out


def check_range(a: np.ndarray, b: np.ndarray, factor: int) -> None:
    """Scores times the percentages of the windows have to fit in 63 bits."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if factor * most * max(min(a.shape[1], b.shape[1]), 1) >= 1 << 63:
        raise ValueError("scores of these vectors may not fit in 63 bits")


# ---- heaps ----


class Heaps:
    """For each slot its best ``k`` entries: higher scores first, ties by smaller identifier."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: Score below which an entry of a slot cannot stay.
        self.floor = np.full(slots, LOWEST)

    def merge(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ident = (
            np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ident))
        )
        order = np.lexsort((ident, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        keep = order[place < self.k]
        self.slot, self.score, self.id = slot[place < self.k], score[keep], ident[keep]
        full = place == self.k - 1
        self.floor[slot[full]] = score[order[full]]


# ---- cells ----

OUT = "anchor long, goal int, score long, id long"
_ARROW = pa.schema([("anchor", pa.int64()), ("goal", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


class _Cell:
    """The anchors of a cell, and its heaps while rows stream past."""

    def __init__(self, anchors: pa.Table, k: int, window: tuple[int, int], goals: int):
        column = lambda name: anchors.column(name).to_numpy()
        self.row, self.id, self.label = column("row"), column("vec_id"), column("label")
        self.vectors = integer_rows(anchors.column("vector"))
        self.goals, self.factor = goals, max(*window, 1)
        if goals:
            wanted = anchors.column("goals").combine_chunks()
            at = wanted.offsets.to_numpy()
            score = wanted.values.to_numpy()[at[0] : at[-1]]
            slot = np.repeat(np.arange(len(self.row)) * goals, np.diff(at)) + ragged(
                np.zeros(len(self.row), np.int64), np.diff(at)
            )
            # No window: its lowest score lies above its highest.
            self.low, self.high = np.ones(len(self.row) * goals, np.int64), np.zeros(len(self.row) * goals, np.int64)
            self.low[slot] = -(-window[0] * score // 100)
            self.high[slot] = window[1] * score // 100
        self.heaps = Heaps(len(self.row) * max(goals, 1), k)

    def meet(self, rows: pa.Table) -> None:
        ident, label = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        vectors = integer_rows(rows.column("vector"))
        check_range(self.vectors, vectors, self.factor)
        for at in range(0, len(self.row), TILE):
            part = slice(at, at + TILE)
            scores = strassen(self.vectors[part], vectors)
            same = self.label[part, None] == label
            if self.goals:
                self._negatives(at, scores, ~same, ident)
            else:
                same &= self.id[part, None] != ident
                same &= scores >= self.heaps.floor[part, None]
                a, r = np.nonzero(same)
                self.heaps.merge(at + a, scores[a, r], ident[r])

    def _negatives(self, at: int, scores: np.ndarray, other: np.ndarray, ident: np.ndarray) -> None:
        found = []
        for goal in range(self.goals):
            slots = (at + np.arange(len(scores))) * self.goals + goal
            low = np.maximum(self.low[slots], self.heaps.floor[slots])
            a, r = np.nonzero(other & (scores >= low[:, None]) & (scores <= self.high[slots][:, None]))
            found.append((slots[a], scores[a, r], ident[r]))
        self.heaps.merge(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def batches(self) -> Iterator[pa.RecordBatch]:
        goals = max(self.goals, 1)
        for i in range(0, len(self.heaps.slot), 50_000):
            slot = self.heaps.slot[i : i + 50_000]
            yield pa.record_batch(
                [
                    self.row[slot // goals],
                    (slot % goals).astype(np.int32),
                    self.heaps.score[i : i + 50_000],
                    self.heaps.id[i : i + 50_000],
                ],
                schema=_ARROW,
            )


def _search(k: int, window: tuple[int, int], goals: int) -> Callable:
    """Rows sorted by cell, anchors before rows: heaps of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = number = None
        waiting: list[pa.RecordBatch] = []

        def flush() -> None:
            if waiting and cell is not None:
                cell.meet(pa.Table.from_batches(waiting))
            waiting.clear()

        for batch in batches:
            key = batch.column("cell").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                here, kind = divmod(int(key[i]), 2)
                if here != number:  # a new cell starts, with its anchors if it has any
                    if cell is not None:
                        flush()
                        yield from cell.batches()
                    cell, number, anchors = None, here, []
                if kind == 0:
                    anchors.append(batch.slice(i, j - i))
                    continue
                if cell is None and anchors:
                    cell, anchors = _Cell(pa.Table.from_batches(anchors), k, window, goals), []
                for p in range(i, j, TILE) if cell is not None else ():
                    waiting.append(batch.slice(p, min(j, p + TILE) - p))
                    if sum(map(len, waiting)) >= TILE:
                        flush()
        if cell is not None:
            flush()
            yield from cell.batches()

    return run


def _cells(rows: DataFrame, anchors: DataFrame, stripes: int, bands: int) -> DataFrame:
    """Every row once in each band of its stripe, every anchor once in each stripe of its band."""
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cell = (F.col("_stripe") * bands + F.col("_band")).alias("cell")
    columns = (cell, "kind", "row", "vec_id", "label", "vector", "goals")
    left = anchors.select("*", F.lit(0).alias("kind"), deal(bands, 2).alias("_band"), each(stripes).alias("_stripe"))
    right = rows.select("*", F.lit(1).alias("kind"), deal(stripes, 1).alias("_stripe"), each(bands).alias("_band"))
    right = right.withColumn("goals", F.lit(None).cast("array<long>"))
    both = left.select(*columns).unionByName(right.select(*columns))
    return both.repartition(stripes * bands, "cell").sortWithinPartitions("cell", "kind")


def _best(k: int) -> Column:
    """The merged heap of a group: at most ``k`` entries from each of its cells meet here."""
    entry = F.struct((-F.col("score")).alias("down"), F.col("id"), F.col("score"))
    return F.slice(F.array_sort(F.collect_list(entry)), 1, k)


def usable(rows: DataFrame) -> DataFrame:
    """Rows with identifier, label and vector, all components finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").alias("vector"),
        finite.alias("_finite"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND _finite").drop("_finite")


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    workspace: Workspace | None = None,
    stripes: int = STRIPES,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """Negatives of each anchor whose scores come close to that of one of its positives.

    Takes ``vec_id, label, embedding``; other columns are ignored.  ``anchor`` is a condition on
    ``vec_id`` and ``label``.  An anchor's positives are the ``positives`` best rows of its label
    under another ``vec_id``; the negatives of a positive are the ``negatives`` best rows of other
    labels whose score lies between ``window`` percent of the positive's.  Higher scores come
    first, ties by smaller ``vec_id``.

    Rows without identifier, label, vector or with a component that is null or not finite take no
    part.  A shorter vector counts as ending in zeros.  Repeated rows are rows of their own: each
    may be an anchor, and each fills a place in a list.  Scores that may not fit in 63 bits end
    the run with a message.  No rows, or no anchors, give no rows.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    workspace = workspace or Workspace(rows.sparkSession, "negatives")
    rows = workspace.stage(usable(rows).withColumn("row", F.monotonically_increasing_id()), "rows")
    anchors = rows.where(anchor)
    bands = max(1, -(-anchors.count() // band_rows))

    def search(asking: DataFrame, k: int, goals: int) -> DataFrame:
        return _cells(rows, asking, stripes, bands).mapInArrow(_search(k, window, goals), OUT)

    first = search(anchors.withColumn("goals", F.lit(None).cast("array<long>")), positives, 0)
    first = workspace.stage(first.groupBy("anchor").agg(_best(positives).alias("best")), "positives")
    asking = anchors.join(first, anchors["row"] == first["anchor"]).select(
        "row", "vec_id", "label", "vector", F.col("best.score").alias("goals")
    )
    found = search(asking, negatives, positives).groupBy("anchor", "goal").agg(_best(negatives).alias("close"))
    wanted = first.join(anchors.select("row", "vec_id"), F.col("anchor") == F.col("row")).select(
        "anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("best").alias("goal", "positive")
    )
    return found.join(wanted, ["anchor", "goal"]).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        F.posexplode("close").alias("rank", "negative"),
        F.col("positive.score").alias("positive_score"),
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("rank") + 1).alias("rank"),
        F.col("negative.id").alias("negative_id"),
        "positive_score",
        F.col("negative.score").alias("negative_score"),
    )
