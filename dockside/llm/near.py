"""Near-duplicate classes by improved consistent weighted sampling.

A document is its set of five-word shingles (fewer words, but not none: one shingle), each
with weight ``(1 + ln tf) * idf``.  Frequent shingles, those in at least a 65,536th of all
(document, shingle) pairs, are counted exactly: there are no more than 65,536 of them in any
corpus.  All others count as if they just reached that floor.  So a weight depends on the share
of the documents that hold a shingle, not on how many documents there are, and two documents
are as similar in a large corpus as in a small one of the same kind.  The idf part is held
between 1 and ``1 + IDF_SHARE``, so that a large group of copies, which makes its own shingles
frequent, does not pull its members below the threshold.

Steps: equal word sequences become one node.  Every node gets ``BANDS * ROWS`` samples; equal
samples in a band put nodes in one bucket.  In each bucket all members are compared with one
pivot, the member whose buckets are largest, that is, the one most like all others.  Members
that the links leave outside the pivot's component are then compared with all members, in
blocks of bounded size.  Every pair that shares a bucket is thus compared or already in one
component, and no list of pairs is made.  A link needs weighted Jaccard similarity of at least
``THRESHOLD``, on the exact sets.  Components of the links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Words, Workspace, mix, prefix_hash, span_hash, take_rows, text_pieces

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3
IDF_SHARE = 0.25
#: At most so many shingles are frequent.
FREQUENT = 1 << 16
#: Two tables of this many counters bound the frequency of every shingle from above.
SKETCH_BITS, TABLES = 20, 2
SEGMENTS = 128
#: Counted shingles a task holds before it sends them on.
HELD = 1 << 20
#: Shingles on either side of a block that is compared in one piece, a longer text excepted.
LEFT, RIGHT = 1 << 15, 1 << 18

_TEXTS = 4096  # texts in a piece; their index shares a 64-bit key with 52 hash bits
_HASH_BITS = 52
_HASH = np.uint64((1 << _HASH_BITS) - 1)


# ---- weighted sets ----


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words; then document, shingle hash and count of each distinct shingle, in order."""
    words = Words(data, offsets)
    hashes, first = words.shingles(SHINGLE)
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    keys = np.sort((doc << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    keys, count = keys[at], np.diff(np.append(at, len(keys)))
    return words, (keys >> np.uint64(_HASH_BITS)).astype(np.int64), keys & _HASH, count


def _pieces(batches: Iterator[pa.RecordBatch]):
    for rows, data, offsets in text_pieces(batches):
        for i in range(0, rows.num_rows, _TEXTS):
            j = min(i + _TEXTS, rows.num_rows)
            yield rows.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


@dataclass
class Frequencies:
    """Documents in all; the floor; and the frequent shingles, sorted, with their documents."""

    documents: int
    floor: float
    hashes: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.hashes >> np.uint64(_HASH_BITS - 20)).astype(np.int64)] = True

    def weights(self, hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
        seen = np.full(len(hashes), self.floor)
        maybe = np.flatnonzero(self.known[(hashes >> np.uint64(_HASH_BITS - 20)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes[maybe]
            seen[maybe[hit]] = self.counts[at[hit]]
        widest = np.log(self.documents / self.floor) if self.documents > self.floor else 0.0
        rare = np.log(self.documents / np.minimum(seen, self.documents)) / widest if widest else np.ones(len(seen))
        return ((1 + np.log(count)) * (1 + IDF_SHARE * rare)).astype(np.float32)


def _features(hashes: np.ndarray) -> list[np.ndarray]:
    """The counter of each shingle in each table."""
    second = mix(hashes) >> np.uint64(64 - SKETCH_BITS)
    return [(hashes >> np.uint64(_HASH_BITS - SKETCH_BITS)).astype(np.int64), second.astype(np.int64)]


def _sketch(docs: DataFrame) -> tuple[int, int, np.ndarray]:
    """Documents, (document, shingle) pairs, and the tables of counters over all texts."""
    size = 1 << SKETCH_BITS
    width = TABLES * size // SEGMENTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents, pairs = np.zeros((TABLES, size), np.int64), 0, 0
        for rows, data, offsets in _pieces(batches):
            _, _, hashes, _ = _sets(data, offsets)
            for table, feature in zip(counts, _features(hashes), strict=True):
                table += np.bincount(feature, minlength=size)
            documents, pairs = documents + rows.num_rows, pairs + len(hashes)
        parts = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in counts.reshape(SEGMENTS, -1)]
        none = [0] * (SEGMENTS - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SEGMENTS, dtype=np.int32)), pa.array(parts, pa.binary()),
             pa.array([documents, *none]), pa.array([pairs, *none])],
            ["segment", "counts", "documents", "pairs"],
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents, pairs = np.zeros(width, np.int64), 0, 0
        for batch in batches:
            for part in batch.column(1):
                raw = pa.decompress(part.as_py(), total.nbytes, "zstd", asbytes=True)
                total += np.frombuffer(raw, np.int64)
            documents += sum(batch.column(2).to_pylist())
            pairs += sum(batch.column(3).to_pylist())
        packed = pa.compress(total.tobytes(), "zstd", asbytes=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([packed], pa.binary()), pa.array([documents]), pa.array([pairs])],
            ["segment", "counts", "documents", "pairs"],
        )

    schema = "segment int, counts binary, documents long, pairs long"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("segment").applyInArrow(add, schema).collect()
    counts = np.zeros((SEGMENTS, width), np.int64)
    for r in rows:
        counts[r.segment] = np.frombuffer(pa.decompress(bytes(r["counts"]), counts[0].nbytes, "zstd", asbytes=True), np.int64)
    return sum(r.documents for r in rows), sum(r.pairs for r in rows), counts.reshape(TABLES, size)


def document_frequencies(docs: DataFrame) -> Frequencies:
    """Exact document counts of the frequent shingles, over all texts.

    No counter of the sketch is below the count of any of its shingles, so only shingles whose
    counters all reach the floor are counted one by one.
    """
    documents, pairs, counts = _sketch(docs)
    floor = max(1.0, pairs / FREQUENT)
    shared = docs.sparkSession.sparkContext.broadcast(counts >= floor)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["hash", "n"])

        for _, data, offsets in _pieces(batches):
            _, _, hashes, _ = _sets(data, offsets)
            maybe = np.ones(len(hashes), bool)
            for table, feature in zip(shared.value, _features(hashes), strict=True):
                maybe &= table[feature]
            held.append(hashes[maybe])
            if sum(map(len, held)) >= HELD:
                yield flush()
        if held:
            yield flush()

    rows = docs.select("text").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    rows = rows.where(F.col("n") >= floor).orderBy("hash").collect()
    hashes, counts = (np.array([r[k] for r in rows], np.int64) for k in ("hash", "n"))
    return Frequencies(documents, floor, hashes.view(np.uint64), counts)


# ---- samples ----


class Sampler:
    """Improved consistent weighted sampling; the random draws of a shingle come from tables
    that its hash, multiplied anew for each sample, points into."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 3, bits: int = 16):
        rng = np.random.default_rng(seed)
        self.shift = np.uint64(64 - bits)
        self.r = rng.gamma(2, 1, 1 << bits).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.c = np.log(rng.gamma(2, 1, 1 << bits)).astype(np.float32)
        self.beta = rng.random(1 << bits, dtype=np.float32)
        self.odd = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Samples of non-empty sets that start at ``first``: one row a sample."""
        logs, place = np.log(weights), np.arange(len(hashes), dtype=np.int64)
        spread = mix(hashes)
        out = np.empty((len(self.odd), len(first)), np.uint64)
        for k, odd in enumerate(self.odd):
            at = ((spread * odd) >> self.shift).astype(np.int32)
            r, beta = self.r[at], self.beta[at]
            t = np.floor(logs * self.inverse[at] + beta)
            a = self.c[at] - r * (t - beta + 1)
            order = a.view(np.int32)
            order = order ^ ((order >> 31) & 0x7FFFFFFF)  # sorts like the floats
            best = np.minimum.reduceat((order.astype(np.int64) << 32) | place, first) & 0xFFFFFFFF
            out[k] = mix(hashes[best] ^ (t[best].astype(np.int64).astype(np.uint64) << np.uint64(_HASH_BITS)))
        return out


def _content_keys(words: Words) -> list[bytes]:
    """128-bit keys of the word sequences."""
    first = words.first
    one = span_hash(prefix_hash(words.hashes), first[:-1], first[1:])
    two = span_hash(prefix_hash(mix(words.hashes ^ np.uint64(0x5851F42D4C957F2D))), first[:-1], first[1:])
    raw = np.stack([one, two], axis=1).astype("<u8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def _identified(docs: DataFrame, *more: str) -> DataFrame:
    """Rows with ``at``, the doc_id or else a hash of the text, to find texts again."""
    at = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    return docs.select(at.alias("at"), "doc_id", "text", F.xxhash64("text").alias("text_hash"), *more)


def signatures(docs: DataFrame, frequencies: Frequencies) -> DataFrame:
    """``at, doc_id, text_hash, row, key, shingles, buckets`` of every row.

    ``shingles`` is their distinct number; without words there is no key and no bucket.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequencies, Sampler()))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequencies, sampler = shared.value
        row = TaskContext.get().partitionId() << 36
        for rows, data, offsets in _pieces(batches):
            words, doc, hashes, count = _sets(data, offsets)
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            n, filled = rows.num_rows, words.counts() > 0
            buckets = np.zeros((0, BANDS), np.uint64)
            if len(first):
                samples = sampler.draw(hashes, frequencies.weights(hashes, count), first)
                bands = samples.reshape(BANDS, ROWS, -1)
                key = np.zeros_like(bands[:, 0])
                for i in range(ROWS):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, i])
                buckets = mix(key + np.arange(BANDS, dtype=np.uint64)[:, None]).T
            ends = np.concatenate([[0], np.cumsum(filled) * BANDS]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(buckets).view(np.int64).ravel()))
            keys = [k if f else None for k, f in zip(_content_keys(words), filled, strict=True)]
            sizes = pa.array(np.bincount(doc, minlength=n))
            columns = [rows.column(i) for i in (0, 1, 3)]
            columns += [pa.array(row + np.arange(n)), pa.array(keys, pa.binary()), sizes, lists]
            row += n
            yield pa.RecordBatch.from_arrays(columns, ["at", "doc_id", "text_hash", "row", "key", "shingles", "buckets"])

    rows = _identified(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        sign, f"at long, doc_id {kind}, text_hash long, row long, key binary, shingles long, buckets array<long>"
    )


def weighted_sets(docs: DataFrame, nodes: DataFrame, frequencies: Frequencies) -> DataFrame:
    """``key, hashes, weights`` (arrays as bytes) of the given nodes (``at, text_hash, key``).

    A node finds its own text alone, once, however many rows and texts share its doc_id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _pieces(batches):
            words, doc, hashes, count = _sets(data, offsets)
            weights = shared.value.weights(hashes, count)
            first = np.searchsorted(doc, np.arange(rows.num_rows + 1))
            keys, wanted = _content_keys(words), rows.column(1).to_pylist()
            own = [i for i in range(rows.num_rows) if keys[i] == wanted[i]]
            blobs = [[x[first[i] : first[i + 1]].tobytes() for i in own] for x in (hashes, weights)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in own], pa.binary()), *(pa.array(b, pa.binary()) for b in blobs)],
                ["key", "hashes", "weights"],
            )

    own = ("at", "text_hash")
    texts = _identified(docs).select(*own, "text").join(nodes.select(*own, "key"), list(own))
    texts = texts.groupBy(*own, "key").agg(F.first("text").alias("text")).select("text", "key")
    return texts.mapInArrow(build, "key binary, hashes binary, weights binary")


# ---- links ----


def _similar(left: list, right: list) -> Iterator[tuple[int, np.ndarray]]:
    """Of (hashes, weights) sets: each left one, and the right ones with weighted Jaccard
    similarity at the threshold."""
    all_hashes = np.concatenate([h for h, _ in right])
    all_weights = np.concatenate([w for _, w in right]).astype(np.float64)
    sizes = np.array([len(h) for h, _ in right])
    first = np.cumsum(sizes) - sizes
    total = np.add.reduceat(all_weights, first)
    for i, (hashes, weights) in enumerate(left):
        at = np.minimum(np.searchsorted(hashes, all_hashes), len(hashes) - 1)
        shared = np.where(hashes[at] == all_hashes, np.minimum(weights[at], all_weights), 0)
        both = np.add.reduceat(shared, first)
        own = weights.astype(np.float64).sum()
        yield i, np.flatnonzero(both >= (THRESHOLD - 1e-9) * (total + own - both))


def _joining(similar: Iterator[tuple[int, np.ndarray]], left: list, right: list) -> Iterator[tuple[int, int]]:
    """Of the similar pairs, those that join two parts which the pairs before them left apart.

    ``left`` and ``right`` tell each member's part.  There are fewer such pairs than parts, and
    they connect the same members as all pairs do.
    """
    _, code = np.unique(np.array([*left, *right], dtype=object), return_inverse=True)
    code = code.ravel()
    mine, theirs = code[: len(left)], code[len(left) :]
    joined = np.arange(code.max(initial=-1) + 1)
    for i, found in similar:
        parts, first = np.unique(joined[theirs[found]], return_index=True)
        new = parts != joined[mine[i]]
        if new.any():
            yield from ((i, int(j)) for j in found[first[new]])
            joined[np.isin(joined, parts)] = joined[mine[i]]


def verified_links(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between the two sides of each block (``block, is_left, key, part``).

    All members of both sides are compared.  Links that would not join two parts, after those of
    the same block, are left out: a block gives fewer links than it has members, and their
    components are those of all links.
    """

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).to_pydict()
        sides: tuple[list, list] = ([], [])
        for is_left, node, part, hashes, weights in zip(
            *(table[c] for c in ("is_left", "key", "part", "hashes", "weights")), strict=True
        ):
            arrays = np.frombuffer(hashes, np.uint64), np.frombuffer(weights, np.float32)
            sides[not is_left].append((node, part, arrays))
        links = []
        if all(sides):
            similar = _similar(*([x[2] for x in side] for side in sides))
            for i, j in _joining(similar, *([x[1] for x in side] for side in sides)):
                links.append((sides[0][i][0], sides[1][j][0]))
        columns = list(zip(*links, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["a", "b"])

    return blocks.join(sets, "key").groupBy("block").applyInArrow(compare, "a binary, b binary")


def components(edges: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """``key, part`` of every linked node: the least key of its component.

    Alternates star steps: each node's larger neighbours move to its least neighbour, then
    all its smaller ones do, until nothing moves; hubs are aggregated, never gathered.
    """
    step = 0
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = workspace.stage(edges.where("a <> b").distinct(), f"{name}-0")
    while True:
        step += 1
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(joined.select("a", F.col("m").alias("b")))
        after = workspace.stage(small.where("a <> b").distinct(), f"{name}-{step}")
        mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        done = mark(after) == mark(stars)
        stars = after
        if done:
            break
    roots = stars.select(F.col("b").alias("key")).distinct().withColumn("part", F.col("key"))
    members = stars.select(F.col("a").alias("key"), F.col("b").alias("part"))
    return workspace.stage(members.unionByName(roots), f"{name}-parts")


def _deal(key: str, size: Column, most: int) -> Column:
    """A block number that deals members with ``size`` shingles into blocks of about ``most``."""
    return F.pmod(F.xxhash64(key, F.lit(5)), F.greatest(F.ceil(size / most), F.lit(1)).cast("long")).cast("long")


def near_classes(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """One row a document: ``doc_id, class_id, class_size, kept, text_hash``.

    Takes ``doc_id`` (an integer) and ``text``.  class_id is the smallest doc_id of the class
    (null if it has none); one row of each class is kept, of equal ids the first in the table.
    Texts without any word, null ones too, are alone in their class and kept.  No rows give
    no rows.
    """
    workspace = workspace or Workspace(docs.sparkSession, "near")
    frequencies = document_frequencies(docs)
    signed = workspace.stage(signatures(docs, frequencies), "signatures")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row", "at", "text_hash"))
    nodes = workspace.stage(
        signed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            first.alias("first"),
            F.count("*").alias("n"),
            F.first("buckets").alias("buckets"),
            F.first("shingles").alias("shingles"),
        ),
        "nodes",
    )
    members = nodes.select("key", "shingles", F.explode("buckets").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("shingles").alias("total")).where("size > 1")
    members = members.join(sizes, "bucket")
    weight = members.groupBy("key").agg(F.sum("size").alias("weight"))
    members = workspace.stage(members.join(weight, "key"), "members")
    wanted = nodes.join(weight.select("key"), "key", "leftsemi").select(
        "key", F.col("first.at").alias("at"), F.col("first.text_hash").alias("text_hash")
    )
    sets = workspace.stage(weighted_sets(docs, wanted, frequencies), "sets")

    # Every member against its buckets' pivots.
    pivots = members.groupBy("bucket").agg(F.max_by("key", F.struct("weight", "key")).alias("pivot"))
    pivots = workspace.stage(pivots, "pivots")
    pairs = members.join(pivots, "bucket").where("key <> pivot").select("key", "pivot", "shingles").distinct()
    fans = pairs.groupBy("pivot").agg(F.sum("shingles").alias("fan"))
    dealt = workspace.stage(pairs.join(fans, "pivot").withColumn("b", _deal("key", F.col("fan"), RIGHT)), "pairs")
    block = F.struct("pivot", "b")
    right = dealt.select(block.alias("block"), F.lit(False).alias("is_left"), "key", F.col("key").alias("part"))
    left = dealt.select(block.alias("block"), F.col("pivot").alias("key")).distinct()
    left = left.select("block", F.lit(True).alias("is_left"), "key", F.col("key").alias("part"))
    links = workspace.stage(verified_links(left.unionByName(right), sets), "links-1")
    parts = components(links, workspace, "parts-1")

    # Members outside their pivot's component against all members of their bucket.
    placed = members.join(parts, "key", "left").select(
        "bucket", "key", "size", "shingles", "total", F.coalesce("part", "key").alias("part")
    )
    main = pivots.withColumnRenamed("pivot", "key").join(parts, "key", "left")
    main = main.select("bucket", F.coalesce("part", "key").alias("main"))
    placed = workspace.stage(placed.join(main, "bucket").withColumn("stray", F.col("part") != F.col("main")), "placed")
    strays = placed.where("stray").groupBy("bucket").agg(F.sum("shingles").alias("strays"))
    # Two members were compared at once if one is the pivot and the other the only stray.
    open_ = placed.join(strays, "bucket").where("size > 2")
    blocks_l = F.greatest(F.ceil(F.col("strays") / LEFT), F.lit(1)).cast("long")
    blocks_r = F.greatest(F.ceil(F.col("total") / RIGHT), F.lit(1)).cast("long")
    open_ = open_.withColumns({"bl": blocks_l, "br": blocks_r})
    name = lambda l, r: F.struct("bucket", l.alias("l"), r.alias("r"))  # noqa: E731, E741
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = open_.where("stray").withColumn("r", span("br")).select(
        name(_deal("key", F.col("strays"), LEFT), F.col("r")).alias("block"), F.lit(True).alias("is_left"), "key", "part"
    )
    right = open_.withColumn("l", span("bl")).select(
        name(F.col("l"), _deal("key", F.col("total"), RIGHT)).alias("block"), F.lit(False).alias("is_left"), "key", "part"
    )
    more = workspace.stage(verified_links(left.unionByName(right), sets), "links-2")
    parts = components(links.unionByName(more), workspace, "parts-2") if not more.isEmpty() else parts

    found = nodes.join(parts, "key", "left").withColumn("part", F.coalesce("part", "key"))
    classes = found.groupBy("part").agg(F.min("first").alias("head"), F.sum("n").alias("class_size"))
    told = found.select("key", "part").join(classes, "part").select("key", "head", "class_size")
    alone = signed.where("key IS NULL").select(
        "doc_id",
        F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
        "text_hash",
    )
    rest = signed.join(told, "key").select(
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("head.row")).alias("kept"),
        "text_hash",
    )
    return rest.unionByName(alone)


def keep_one(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """The kept row of each class, with all columns of ``docs``."""
    workspace = workspace or Workspace(docs.sparkSession, "near")
    classes = workspace.stage(near_classes(docs, workspace), "classes")
    keep = classes.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_digest"), "kept")
    return take_rows(docs, keep, F.xxhash64("text"))
