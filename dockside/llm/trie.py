"""Prefix trie of conversations, from sorted sequences and range minima of common prefixes.

A conversation is one row: the digests of its turns, 16 bytes each, in order.  All rows are put
in one order over range partitions, so that the members of any prefix stand side by side, and
each partition is worked on in pieces of bounded size.  In a piece, every candidate prefix (a
row and a depth) searches the first and the last row of its members: by halving steps over a
sparse table of range minima of the common prefixes between neighbours, left and right
independently.  No stack is kept, and no prefix waits for another.

A prefix that goes on in a neighbouring piece is open: pieces give its sums, and Spark adds
them up under the prefix's hash.  All measures are sums over members, since they follow from a
member's common prefix with its neighbours:

- a member opens a leaf if its successor does not go on from it;
- it saves the bytes of the prefix it shares with its predecessor, so a subtree saves the sum
  of those bytes, less those above the subtree, over all members but the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import Workspace, byte_column, mix, ragged

DIGEST = 16
PIECE_ROWS = 1 << 15
PIECE_BYTES = 4 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---- sequences ----


def sequences(turns: DataFrame) -> DataFrame:
    """One row a conversation: ``conv_id`` and its ``turns`` as (digest in hex, bytes of text).

    Turns are in order of ``turn``, null first, ties by role and digest.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn"),
            role.alias("role"),
            F.substring(F.sha2(whole, 256), 1, 2 * DIGEST).alias("digest"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("at"),
    )
    ordered = F.array_sort(F.collect_list("at"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")
    )


def with_shared_heads(seqs: DataFrame, source: Column, head: Column, longest: int) -> DataFrame:
    """Each conversation's first ``head`` turns are those of conversation ``source``.

    The source gives all it has if that is fewer, none if it is absent; ``head`` is at most
    ``longest``.
    """
    heads = seqs.select(F.col("conv_id").alias("_source"), F.slice("turns", 1, longest).alias("_head"))
    own = seqs.select("*", source.alias("_from"), head.cast("int").alias("_n"))
    first = F.slice(F.coalesce("_head", F.slice("turns", 1, 0)), F.lit(1), F.col("_n"))
    rest = F.slice("turns", F.col("_n") + 1, F.size("turns"))
    return own.join(heads, F.col("_from") == F.col("_source"), "left").select(
        "conv_id", F.concat(first, rest).alias("turns")
    )


# ---- pieces ----


class RangeMin:
    """Sparse table: the minimum of every run of a power of two of values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of the ranges from ``first`` to ``last``, both within."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            out[at] = np.minimum(table[first[at]], table[last[at] - (1 << int(k)) + 1])
        return out

    def extend_left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest ``p`` such that the values after ``p``, up to ``at``, are ``least`` or more."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            table, step = self.levels[k], 1 << k
            from_ = at - step
            ok = (from_ >= 0) & (table[np.clip(from_ + 1, 0, len(table) - 1)] >= least)
            at[ok] = from_[ok]
        return at

    def extend_right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The largest ``p`` such that the values after ``at``, up to ``p``, are ``least`` or more."""
        at, n = at.copy(), len(self.levels[0])
        for k in reversed(range(len(self.levels))):
            table, step = self.levels[k], 1 << k
            ok = (at + step < n) & (table[np.clip(at + 1, 0, len(table) - 1)] >= least)
            at[ok] += step
        return at


def common_prefixes(digests: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Turns that each row but the first shares with the row before it."""
    lengths = np.diff(offsets)
    both = np.minimum(lengths[:-1], lengths[1:])
    row = np.repeat(np.arange(len(both)), both)
    place = ragged(np.zeros_like(both), both)
    differ = (digests[offsets[row] + place] != digests[offsets[row + 1] + place]).any(axis=1)
    np.minimum.at(both, row[differ], place[differ])
    return both


PARTIAL = (
    "piece long, open boolean, depth long, a long, b long, pa long, pb long, parent_open boolean,"
    " parent_conv_id long, conv_id long, n_convs long, n_children long, n_leaves long,"
    " shared long, above long, ends string, first_end long, ends_sha256 string"
)
_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, PARTIAL.split(","))])


def _piece(table: pa.Table, before: bool, after: bool, piece: int, root: int) -> pa.RecordBatch | None:
    """The nodes of consecutive rows; ``before`` and ``after``: the outer rows are neighbours only."""
    data, offsets = byte_column(table.column("key"))
    digests = data.copy().view(np.uint64).reshape(-1, 2)
    offsets = offsets // DIGEST
    near = np.r_[-1, common_prefixes(digests, offsets), -1]
    lo, hi = int(before), table.num_rows - int(after)
    n = hi - lo
    if n <= 0:
        return None
    left, right = near[lo:hi], near[lo + 1 : hi + 1]
    conv = table.column("conv_id").to_numpy()[lo:hi]
    sizes = table.column("sizes").slice(lo, n).combine_chunks()
    at = sizes.offsets.to_numpy().astype(np.int64)
    sizes = sizes.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    digests = digests[offsets[lo] : offsets[hi]]
    at -= at[0]
    lengths = np.diff(at)

    # Bytes and hash of every prefix; ``cut`` is a running sum without what lies before its row.
    row = np.repeat(np.arange(n), lengths)
    depth = np.arange(len(row)) - at[row] + 1
    cut = lambda x, sums: sums[1:] - sums[:-1][at[row]]
    running = lambda x: cut(x, np.concatenate([np.zeros(1, x.dtype), np.cumsum(x, dtype=x.dtype)]))
    level = depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    size = running(sizes.astype(np.int64))
    a = running(mix(digests[:, 0] ^ mix(digests[:, 1] + level))).view(np.int64)
    b = running(mix(digests[:, 1] ^ mix(digests[:, 0] - level))).view(np.int64)

    # Extents of every candidate prefix; a node is one whose first member is its own row.
    shared = RangeMin(left)
    first = shared.extend_left(row, depth)
    node = np.flatnonzero(first == row)
    index = np.zeros(len(row), np.int64)
    index[node] = np.arange(len(node)) + 1  # 0 is the root
    l, d = np.r_[0, row[node]], np.r_[0, depth[node]]
    r = np.r_[n - 1, shared.extend_right(row[node], depth[node])]
    begun, goes_on = left[l] >= d, right[r] >= d
    open_ = begun | goes_on
    open_[0] = True

    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    bytes_at = lambda rows, turns: np.where(turns > 0, np.r_[size, 0][at[rows] + np.maximum(turns, 1) - 1], 0)
    x = bytes_at(np.arange(n), left)
    x_sums, leaf_sums = sums(x), sums(right < lengths)
    above = bytes_at(l, d - 1)
    parent = np.zeros(len(l), np.int64)
    deep = np.flatnonzero(d > 1)
    up = at[l[deep]] + d[deep] - 2
    parent[deep] = index[at[first[up]] + d[deep] - 2]
    children = np.bincount(parent[1:][~begun[1:]], minlength=len(l))
    least = RangeMin(conv).over(l, r)

    # Members that end at a node are its first rows, in order of their identifiers.
    full = np.zeros(n, np.int64)
    some = np.flatnonzero(lengths)
    full[some] = index[at[first[at[some] + lengths[some] - 1]] + lengths[some] - 1]
    n_ends = np.bincount(full, minlength=len(l))
    ends: list[str | None] = [None] * len(l)
    digest: list[str | None] = [NO_ENDS] * len(l)
    first_end = np.zeros(len(l), np.int64)
    for v in np.flatnonzero(n_ends):
        members = conv[l[v] : l[v] + n_ends[v]]
        text = ",".join(map(str, members.tolist()))
        first_end[v] = members[0]
        ends[v], digest[v] = (text, None) if open_[v] else (None, hashlib.sha256(text.encode()).hexdigest())

    hashes = lambda h: np.r_[0, h[node]]
    ha, hb = hashes(a), hashes(b)
    parent_open = open_[parent] & (d > 1)
    parent_conv = np.where(d > 1, least[parent], root)
    columns = {
        "piece": np.full(len(l), piece, np.int64), "open": open_, "depth": d, "a": ha, "b": hb,
        "pa": ha[parent], "pb": hb[parent], "parent_open": parent_open,
        "parent_conv_id": pa.array(parent_conv, mask=parent_open | (d == 0)),
        "conv_id": least, "n_convs": r - l + 1, "n_children": children,
        "n_leaves": leaf_sums[r + 1] - leaf_sums[l],
        "shared": x_sums[r + 1] - x_sums[l + 1] + np.where(begun, x[l], 0), "above": above,
        "ends": ends, "first_end": first_end, "ends_sha256": digest,
    }
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in _ARROW], schema=_ARROW)


def _pieces(root: int, most_rows: int, most_bytes: int):
    """Rows sorted by partition, edge rows outermost: the nodes of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, before, number = None, [], False, 0

        def flush(after: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, before, number
            table = pa.Table.from_batches(held)
            out = _piece(table, before, after, (part << 32) + number, root)
            if out is not None:
                number += 1
                yield out
            # The last row is the first of the next piece, and the one before it its neighbour.
            held, before = table.slice(max(table.num_rows - 2, 0)).to_batches(), table.num_rows > 1

        for batch in batches:
            pid, edge = batch.column("pid").to_numpy(), batch.column("edge").to_numpy()
            cuts = np.r_[0, np.flatnonzero(pid[1:] != pid[:-1]) + 1, len(pid)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if pid[i] != part:
                    if part is not None:
                        yield from flush(ended)
                    part, held, before, number = int(pid[i]), [], bool(edge[i] < 0), 0
                for p in range(i, j, most_rows):
                    held.append(batch.slice(p, min(j, p + most_rows) - p))
                    ended = bool(edge[min(j, p + most_rows) - 1] > 0)
                    if sum(map(len, held)) > most_rows or sum(x.nbytes for x in held) > most_bytes:
                        if sum(map(len, held)) > 1 + before:
                            yield from flush(True)
        if part is not None:
            yield from flush(ended)

    return run


# ---- open nodes ----

NODE = ("depth", "a", "b")


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and identifier: one running digest at a time."""
    node, state = None, None
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("digest", pa.string())])
    done = lambda: pa.record_batch([[x] for x in (*node, state.hexdigest())], schema=schema)
    for batch in batches:
        for depth, a, b, ends in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ends")), strict=True):
            if (depth, a, b) != node:
                if node:
                    yield done()
                node, state = (depth, a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
    if node:
        yield done()


def _merged(partial: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """Open nodes: the sums of their pieces and the digest of their ends; the same with parents."""
    shares = partial.where("open")
    total = shares.groupBy(*NODE).agg(
        *(F.max(c).alias(c) for c in ("pa", "pb", "above")),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")),
    )
    ended = shares.where("ends IS NOT NULL").select(*NODE, "first_end", "ends")
    ended = ended.repartition(*NODE).sortWithinPartitions(*NODE, "first_end")
    ended = ended.mapInArrow(_digest_ends, "depth long, a long, b long, digest string")
    total = total.join(ended, list(NODE), "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS)))
    total = workspace.stage(total.drop("digest"), "open")
    parents = total.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return total, total.join(parents, ["depth", "pa", "pb"], "left")


def prefix_trie(
    seqs: DataFrame,
    workspace: Workspace | None = None,
    partitions: int | None = None,
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """The trie of all conversations, one row a node, from the root (depth 0) down.

    Takes ``conv_id`` and ``turns`` as :func:`sequences` gives them; other columns are ignored.
    A node is a distinct sequence of first turns; its members are the conversations that start
    with it.  Conversations without turns are members of the root.  A null ``conv_id`` names no
    conversation and :func:`sequences` leaves it out; null roles and texts count as empty, and
    repeated rows are turns of their own, next to each other.  No conversations give no rows, not
    even a root.

    Returns ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.
    """
    workspace = workspace or Workspace(seqs.sparkSession, "trie")
    rows = seqs.select(
        "conv_id",
        F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"),
        F.col("turns.size").alias("sizes"),
    )
    order = ("key", "conv_id")
    spread = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    rows = workspace.stage(spread.withColumn("pid", F.spark_partition_id()), "sorted")
    root = rows.agg(F.min("conv_id")).first()[0]
    if root is None:
        root = 0  # no rows
    # One row a partition: the last row of the partition before it, the first of the one after.
    outer = rows.groupBy("pid").agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"))
    along = W.orderBy("pid")
    outer = outer.select("pid", F.lag("high").over(along).alias("low"), F.lead("low").over(along).alias("high"))
    edges = [
        outer.where(f"{c} IS NOT NULL").select(
            "pid", F.lit(edge).alias("edge"), f"{c}.key", f"{c}.conv_id", F.array().cast("array<long>").alias("sizes")
        )
        for c, edge in (("low", -1), ("high", 1))
    ]
    rows = rows.select("pid", F.lit(0).alias("edge"), "key", "conv_id", "sizes")
    rows = rows.unionByName(edges[0]).unionByName(edges[1])
    rows = rows.repartition("pid").sortWithinPartitions("pid", "edge", *order)
    partial = workspace.stage(rows.mapInArrow(_pieces(root, piece_rows, piece_bytes), PARTIAL), "partial")

    total, merged = _merged(partial, workspace)
    closed = partial.where("NOT open")
    # A hot parent meets its children piece by piece, never all of them in one task.
    of_piece = partial.where("open").select("piece", *NODE).join(total.select(*NODE, "conv_id"), list(NODE))
    of_piece = of_piece.select(
        "piece", (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("conv_id").alias("_parent"),
    )
    below = closed.where("parent_open").drop("parent_conv_id").join(of_piece, ["piece", "depth", "pa", "pb"])
    below = below.withColumnRenamed("_parent", "parent_conv_id")
    columns = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"), "ends_sha256",
    )
    inner = closed.where("NOT parent_open").select(*columns)
    return inner.unionByName(below.select(*columns)).unionByName(merged.select(*columns))
