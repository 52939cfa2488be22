"""Removal of repeated passages by a column-wise Burrows-Wheeler construction.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier in the corpus.

Texts are cut so that equal strings meet.  Every window of ``LENGTH`` bytes has an anchor: its
``GRAM`` bytes with the least hash, the leftmost of equals.  The anchor depends on the window's
bytes alone, so equal windows have equal anchors at equal distances.  Windows that follow each
other and share an anchor form a fragment.  Fragments are dealt by anchor; those whose anchor
occurs once are done.  Of equal fragments the first in the corpus stands for all, in the block
of texts it comes from and again in its bucket, so that a passage which a third of all
documents hold is one fragment a block, and then one.

An anchor with very many distinct fragments, such as a common line in different texts, would bring
them all to one task.  Its fragments are dealt window by window instead: each block sends one
hash for each distinct window, windows whose hash occurs in other blocks too go on as fragments
of one window, dealt by that hash, and all others are done.  Equal windows still meet, and no
anchor brings more than its share to a task.

The remaining fragments are the documents of the construction.  They are aligned on their
anchors and written to a file column by column.  Round by round, from the last column to the
first, each fragment gets one more symbol in front: a stable sort of the symbols that precede
the suffixes in order (the Burrows-Wheeler transform of the column) gives the new order, and
least common prefixes of neighbours follow from those of the round before.  Neighbours that
share ``LENGTH`` bytes start equal windows, all in the same round as they are aligned.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import BYTE_CODES, Workspace, byte_column, mix, pieces, prefix_hash, ragged, runs, span_hash, text_size

LENGTH = 100
GRAM = 32
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
#: Texts are cut into fragments in pieces of this size, whose 64-bit arrays set the memory of a task.
ANCHOR_BYTES = 1 << 18

#: An anchor with more distinct fragments is dealt by window, over so many times the buckets.
HOT, SPREAD = 4096, 8
#: Symbols that are laid out in columns at once.
COLUMN_CELLS = 1 << 20

TEXT, COPIES, CHOSEN, MARKS, CROWDED, SHARED = range(6)
_NO_ID = np.iinfo(np.int64).max


# ---- arrays as one compressed value ----


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes; equal byte places of the numbers lie together, which compresses better."""
    out = [np.int32(len(arrays)).tobytes()]
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        data = pa.compress(raw, "zstd", asbytes=True)
        out += [a.dtype.str.encode().ljust(8), np.array([len(a), len(data)], np.int64).tobytes(), data]
    return b"".join(out)


def unpack(value: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(int(np.frombuffer(value, np.int32, 1)[0])):
        kind = np.dtype(value[at : at + 8].decode().strip())
        n, size = np.frombuffer(value, np.int64, 2, at + 8).tolist()
        at += 24
        raw = pa.decompress(value[at : at + size], n * kind.itemsize, "zstd", asbytes=True)
        at += size
        planes = np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
    return out


# ---- anchors and fragments ----


def _anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every window start (text ends ignored): anchor place; and the grams' hashes."""
    n = len(data)
    h, width = BYTE_CODES[data], 1
    while width < gram:
        h = h[: n - 2 * width + 1] * np.uint64(0xD6E8FEB86659FD93) + mix_light(h[width : n - width + 1])
        width *= 2
    h = mix(h)
    bits = np.uint64(max(1, int(n).bit_length()))
    least = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
    wide, step = length - gram + 1, 1
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = wide - step
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), h


def mix_light(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(29))


class Fragments:
    """All fragments of some texts: anchors, content hashes and places."""

    def __init__(self, keys: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
        rank = np.empty(len(keys), np.int64)  # the texts in the order of the corpus
        rank[np.argsort(keys, kind="stable")] = np.arange(len(keys))
        parts = []
        for i, j in pieces(offsets, ANCHOR_BYTES):
            parts.append(self._cut(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, gram, i))
        names = ("anchor", "content", "text", "start", "n", "left")
        kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)
        for k, (name, kind) in enumerate(zip(names, kinds, strict=True)):
            setattr(self, name, np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)]))
        # Equal fragments stand together, the first in the corpus first.
        order = np.lexsort((self.start, rank[self.text], self.content, self.anchor))
        for name in names:
            setattr(self, name, getattr(self, name)[order])
        new = np.ones(len(order), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.content[1:] != self.content[:-1])
        self.first = np.flatnonzero(new)
        self.entry = np.cumsum(new) - 1

    @staticmethod
    def _cut(data, offsets, length, gram, text0):
        sizes = np.diff(offsets)
        windows = np.maximum(sizes - length + 1, 0)
        if not windows.sum():
            return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 4
        anchors, hashes = _anchors(data, length, gram)
        valid = ragged(offsets[:-1], windows)
        text = np.repeat(np.arange(len(sizes)), windows)
        place = anchors[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(valid)))
        begin, own = valid[at], text[at]
        content = span_hash(prefix_hash(BYTE_CODES[data]), begin, begin + n - 1 + length)
        # Anchors have small hashes; hashed again, they are dealt out evenly.
        return mix(~hashes[place[at]]), content, own + text0, begin - offsets[own], n, place[at] - begin


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts in blocks: ``block, kind, value`` with ids, whether an id is null, sizes, and bytes."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ids, texts = TaskContext.get().partitionId() << 24, 0, [], []

        def full() -> pa.RecordBatch:
            data, offsets = byte_column(pa.chunked_array(texts).cast(pa.large_string()))
            column = pa.concat_arrays(ids)
            none = np.array(column.is_null())
            keys = np.array(column.fill_null(_NO_ID).cast(pa.int64()))
            value = pack(keys, none, np.diff(offsets), data)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([TEXT], pa.int32()), pa.array([value], pa.binary())],
                ["block", "kind", "value"],
            )

        for batch in batches:
            _, offsets = byte_column(batch.column(1))
            for i, j in pieces(offsets, block_bytes):
                ids.append(batch.column(0).slice(i, j - i))
                texts.append(batch.column(1).slice(i, j - i))
                held += int(offsets[j] - offsets[i])
                if held >= block_bytes // 2:
                    yield full()
                    block, held, ids, texts = block + 1, 0, [], []
        if ids:
            yield full()

    return docs.select("doc_id", "text").mapInArrow(collect, "block long, kind int, value binary")


def _block_text(value: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, null marks, bytes and offsets."""
    keys, none, sizes, data = unpack(value)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return keys, none, data, offsets


def _deal(values: np.ndarray, parts: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in kinds.items()], list(kinds))


#: A distinct fragment of a block on its way to its bucket, in one array: few bytes more than
#: its numbers even where a bucket gets a single one.
_ROW = np.dtype(
    [
        ("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("text", "<u4"), ("start", "<u4"),
        ("n", "u1"), ("left", "u1"), ("repeated", "?"), ("entry", "<u4"),
    ]
)

_REPLY = {"block": pa.int64(), "kind": pa.int32(), "value": pa.binary()}
_DEALT = {"bucket": pa.int64(), "block": pa.int64(), "value": pa.binary()}
_REPLY_SQL, _DEALT_SQL = "block long, kind int, value binary", "bucket long, block long, value binary"


def anchored(texts: DataFrame, buckets: int) -> DataFrame:
    """Distinct fragments of each block, dealt by anchor: ``bucket, block, value``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                keys, _, data, offsets = _block_text(value.as_py())
                f = Fragments(keys, data, offsets)
                own = f.first
                if not len(own):
                    continue
                bucket = _deal(f.anchor[own], buckets)  # rises with the anchor, as they do
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(cuts[1:], len(own))
                repeated = np.diff(np.append(own, len(f.anchor))) > 1
                out: dict[str, list] = {c: [] for c in _DEALT}
                rows = np.empty(len(own), _ROW)
                rows["anchor"], rows["content"], rows["doc"] = f.anchor[own], f.content[own], keys[f.text[own]]
                rows["text"], rows["start"], rows["n"], rows["left"] = f.text[own], f.start[own], f.n[own], f.left[own]
                rows["repeated"], rows["entry"] = repeated, np.arange(len(own))
                for low, high in zip(cuts, ends, strict=True):
                    out["bucket"].append(int(bucket[low]))
                    out["block"].append(block)
                    out["value"].append(pack(rows[low:high]))
                yield _rows(out, _DEALT)

    return texts.mapInArrow(deal, _DEALT_SQL)


def _meet(hot: int):
    """In one bucket: tell each block which of its fragments are copies, and which are chosen, as
    whole fragments or, where their anchor is hot, window by window."""

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for block, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                rows = unpack(value.as_py())[0].view(_ROW)
                parts.append((rows, np.full(len(rows), block, np.int64)))
        rows, block = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        anchor, content, doc, text, start, n, left, repeated, entry = (rows[c] for c in _ROW.names)
        # An anchor that occurs once, in one block, has no equal window anywhere.
        _, which, seen = np.unique(anchor, return_inverse=True, return_counts=True)
        keep = np.flatnonzero((seen[which] > 1) | repeated)
        order = keep[np.lexsort((start[keep], text[keep], block[keep], doc[keep], content[keep], anchor[keep]))]
        new = np.ones(len(order), bool)
        new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (content[order][1:] != content[order][:-1])
        copies, chosen = order[~new], order[new]
        _, which, fragments = np.unique(anchor[chosen], return_inverse=True, return_counts=True)
        crowded = fragments[which] > hot
        out: dict[str, list] = {c: [] for c in _REPLY}
        for kind, own in ((COPIES, copies), (CHOSEN, chosen[~crowded]), (CROWDED, chosen[crowded])):
            own = own[np.argsort(block[own], kind="stable")]
            cuts = np.flatnonzero(np.diff(block[own], prepend=-1))
            for at in np.split(own, cuts[1:]) if len(own) else ():
                more = () if kind == COPIES else (anchor[at], doc[at], text[at], start[at], n[at], left[at])
                out["block"].append(int(block[at[0]]))
                out["kind"].append(kind)
                out["value"].append(pack(entry[at], *more))
        yield _rows(out, _REPLY)

    return meet


def _fragments(values: list[bytes]) -> list[np.ndarray]:
    """Entry, anchor, doc, text, start, n and left of the fragments of some replies."""
    return [np.concatenate(x) for x in zip(*map(unpack, values), strict=True)]


def _crowded_windows(buckets: int):
    """Of a block's crowded fragments: a hash of each distinct window, dealt by it; and, in bucket
    -1, the windows that an earlier one of the block equals."""

    def cut(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, values = _group(batches)
        out: dict[str, list] = {c: [] for c in _DEALT}
        if values[CROWDED]:
            _, _, data, offsets = _block_text(values[TEXT][0])
            entry, _, doc, text, start, n, left = _fragments(values[CROWDED])
            place = np.lexsort((start.astype(np.int64) + left, text, doc))
            rank = np.empty(len(place), np.int32)
            rank[place] = np.arange(len(place))
            own = np.repeat(np.arange(len(n), dtype=np.int32), n)
            window = ragged(np.zeros(len(n), np.int64), n.astype(np.int64))
            begin = offsets[text[own]] + start[own] + window
            hashes = span_hash(prefix_hash(BYTE_CODES[data]), begin, begin + LENGTH)
            del begin
            order = np.lexsort((rank[own], hashes))
            hashes, own, window = hashes[order], own[order], window[order].astype(np.uint8)
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]

            def send(bucket: int, *arrays: np.ndarray) -> None:
                out["bucket"].append(bucket)
                out["block"].append(block)
                out["value"].append(pack(*arrays))

            if not new.all():
                send(-1, entry[own[~new]], window[~new])
            hashes, own, window = hashes[new], own[new], window[new]
            bucket = _deal(hashes, buckets)  # rises with the hash, as they do
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for low, high in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
                send(int(bucket[low]), hashes[low:high], entry[own[low:high]], window[low:high])
        yield _rows(out, _DEALT)

    return cut


def _shared_windows(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In one bucket of hashes: tell each block which of its windows occur in others too."""
    parts = []
    for batch in batches:
        for block, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            hashes, entry, window = unpack(value.as_py())
            parts.append((hashes, entry, window, np.full(len(hashes), block, np.int64)))
    hashes, entry, window, block = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, which, seen = np.unique(hashes, return_inverse=True, return_counts=True)
    own = np.flatnonzero(seen[which] > 1)
    own = own[np.argsort(block[own], kind="stable")]
    out: dict[str, list] = {c: [] for c in _REPLY}
    cuts = np.flatnonzero(np.diff(block[own], prepend=-1))
    for at in np.split(own, cuts[1:]) if len(own) else ():
        out["block"].append(int(block[at[0]]))
        out["kind"].append(SHARED)
        out["value"].append(pack(hashes[at], entry[at], window[at]))
    yield _rows(out, _REPLY)


def _group(batches: Iterator[pa.RecordBatch]) -> tuple[int, dict[int, list[bytes]]]:
    """The block of a group and its values by kind."""
    values: dict[int, list[bytes]] = {k: [] for k in (TEXT, COPIES, CHOSEN, MARKS, CROWDED, SHARED)}
    block = 0
    for batch in batches:
        for b, kind, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            block = b
            values[kind].append(value)
    return block, values


def _cut_chosen(buckets: int):
    """Bytes of the chosen fragments of a block, dealt by anchor, and of its shared windows."""

    def cut(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, values = _group(batches)
        out: dict[str, list] = {c: [] for c in _DEALT}
        parts = []  # entry, doc, text, start, n, left, first window, bucket
        if values[CHOSEN]:
            entry, anchor, doc, text, start, n, left = _fragments(values[CHOSEN])
            parts.append((entry, doc, text, start, n, left, np.zeros(len(n), np.uint8), _deal(mix(anchor), buckets)))
        if values[SHARED]:
            entry, _, doc, text, start, n, left = _fragments(values[CROWDED])
            hashes, of, window = (np.concatenate(x) for x in zip(*map(unpack, values[SHARED]), strict=True))
            by_entry = np.argsort(entry)
            at = by_entry[np.searchsorted(entry[by_entry], of)]
            one = np.ones(len(at), n.dtype)
            # Buckets of their own: fragments of one window need less room side by side.
            bucket = buckets + _deal(mix(hashes), SPREAD * buckets)
            parts.append((of, doc[at], text[at], start[at] + window, one, left[at] - window, window, bucket))
        if parts:
            _, _, data, offsets = _block_text(values[TEXT][0])
            entry, doc, text, start, n, left, window, bucket = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for at in np.split(order, cuts[1:]):
                size = n[at].astype(np.int64) + LENGTH - 1
                content = data[ragged(offsets[text[at]] + start[at], size)]
                out["bucket"].append(int(bucket[at[0]]))
                out["block"].append(block)
                out["value"].append(
                    pack(entry[at], doc[at], text[at], start[at], n[at], left[at], window[at], content)
                )
        yield _rows(out, _DEALT)

    return cut


def repeated_windows(content: np.ndarray, n: np.ndarray, left: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which windows of anchored fragments also start in a fragment of lower ``order``.

    ``content`` has the fragments one after the other, each of ``n + length - 1`` bytes with
    ``left`` of them before its anchor.  Returns marks by fragment and window.
    """
    m, size = len(n), n.astype(np.int64) + length - 1
    marks = np.zeros((m, int(n.max(initial=1))), bool)
    reach, tail = int(left.max(initial=0)), size - left  # columns before the anchor; after it
    width = reach + int(tail.max(initial=0))
    first = np.cumsum(size) - size
    with tempfile.TemporaryFile() as columns, tempfile.TemporaryFile() as transform:
        # One file of columns, last one first, so that it is read from start to end.
        some = max(1, min(32, COLUMN_CELLS // max(m, 1)))
        for low in range(0, width, some):
            steps = width - 1 - np.arange(low, min(low + some, width))
            at = steps[:, None] - reach + left
            inside = (at >= 0) & (at < size)
            table = np.where(inside, content[np.minimum(first + np.maximum(at, 0), max(len(content) - 1, 0))], 0)
            columns.write(table.astype(np.uint8).tobytes())
        columns.seek(0)
        ranks = np.zeros(0, np.int64)  # fragments by their suffix from the last column on
        common = np.zeros(0, np.uint8)  # bytes shared with the one before
        ends = np.argsort(-tail, kind="stable")
        joined = 0
        for column in range(width - 1 - reach, -reach - 1, -1):
            symbols = np.frombuffer(columns.read(m), np.uint8)
            fresh = joined
            while fresh < m and tail[ends[fresh]] > column:
                fresh += 1
            if fresh > joined:  # their suffix was empty so far, so they come first
                ranks = np.concatenate([ends[joined:fresh], ranks])
                common = np.concatenate([np.zeros(fresh - joined, np.uint8), common])
                joined = fresh
            live = -left[ranks] <= column
            if not live.all():  # fragments that begin behind this column are complete
                ranks, common = _leave_out(ranks, common, live)
            if not len(ranks):
                continue
            before = symbols[ranks]
            transform.write(before.tobytes())
            moved = np.argsort(before, kind="stable")
            same = np.zeros(len(ranks), bool)
            same[1:] = before[moved[1:]] == before[moved[:-1]]
            shared = np.zeros(len(ranks), np.uint8)
            pairs = np.flatnonzero(same)
            if len(pairs):
                shared[pairs] = _range_least(common, moved[pairs - 1] + 1, moved[pairs] + 1) + 1
            ranks, common = ranks[moved], shared
            equal = common >= length
            if equal.any():
                group = np.cumsum(~equal) - 1
                least = np.minimum.reduceat(order[ranks], np.flatnonzero(~equal))
                later = order[ranks] > least[group]
                marks[ranks[later], column + left[ranks[later]]] = True
    return marks


def _leave_out(ranks: np.ndarray, common: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without some suffixes, neighbours share the least of what lay between them."""
    stay = np.flatnonzero(live)
    if not len(stay):
        return ranks[:0], common[:0]
    bounds = np.append(0, stay[:-1] + 1)
    least = np.minimum.reduceat(common[: stay[-1] + 1], bounds)
    least[0] = 0
    return ranks[stay], least


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low:high]`` for non-empty ranges."""
    near = high - low == 1
    out = values[low]
    far = np.flatnonzero(~near)
    if len(far):
        ends = np.stack([low[far], high[far]], axis=1).ravel()
        out[far] = np.minimum.reduceat(np.append(values, np.uint8(255)), ends)[::2]
    return out


def _construct(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows among the chosen fragments of a bucket, told to their blocks."""
    parts = []
    for batch in batches:
        for block, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            arrays = unpack(value.as_py())
            parts.append([*arrays, np.full(len(arrays[0]), block, np.int64)])
    entry, doc, text, start, n, left, base, content, block = (np.concatenate(x) for x in zip(*parts, strict=True))
    left = left.astype(np.int64)
    order = np.empty(len(n), np.int64)
    order[np.lexsort((start + left, text, block, doc))] = np.arange(len(n))
    marks = repeated_windows(content, n, left, order)
    own = np.flatnonzero(marks.any(axis=1))
    own = own[np.argsort(block[own], kind="stable")]
    out: dict[str, list] = {c: [] for c in _REPLY}
    cuts = np.flatnonzero(np.diff(block[own], prepend=-1))
    for at in np.split(own, cuts[1:]) if len(own) else ():
        row, window = np.nonzero(marks[at])
        out["block"].append(int(block[at[0]]))
        out["kind"].append(MARKS)
        out["value"].append(pack(entry[at][row], window.astype(np.uint8) + base[at][row]))
    yield _rows(out, _REPLY)


def _finish(schema_kind: pa.DataType, names: list[str]):
    """Removed runs and remaining bytes of a block's texts."""

    def finish(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, values = _group(batches)
        keys, none, data, offsets = _block_text(values[TEXT][0])
        f = Fragments(keys, data, offsets)
        copy = np.zeros(len(f.first), bool)
        for value in values[COPIES]:
            copy[unpack(value)[0]] = True
        whole = copy[f.entry]
        later = np.ones(len(f.entry), bool)
        later[f.first] = False  # equal to an earlier fragment of this block
        whole |= later
        begin = offsets[f.text] + f.start
        starts, counts = [begin[whole]], [f.n[whole] + LENGTH - 1]
        for value in values[MARKS]:
            entry, window = unpack(value)
            starts.append(begin[f.first[entry]] + window)
            counts.append(np.full(len(entry), LENGTH, np.int64))
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, np.concatenate(starts), 1)
        np.add.at(edge, np.concatenate([s + c for s, c in zip(starts, counts, strict=True)]), -1)
        gone = np.cumsum(edge[:-1]) > 0
        low, high = runs(gone, offsets)
        kept = data[~gone]
        total = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        first = np.searchsorted(low, offsets)
        text = np.searchsorted(offsets, low, side="right") - 1
        spans = pa.StructArray.from_arrays([pa.array(low - offsets[text]), pa.array(high - offsets[text])], ["start", "end"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, mask=none).cast(schema_kind),
                pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), spans),
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(keys), [None, pa.py_buffer(total.astype(np.int64)), pa.py_buffer(kept)]
                ).cast(pa.binary()),
            ],
            names,
        )

    return finish


def remove_repeats(
    docs: DataFrame,
    workspace: Workspace | None = None,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """One row a document: ``doc_id, n_bytes, spans`` (removed runs of bytes), ``kept`` (the rest).

    Takes ``doc_id`` (an integer) and ``text``, as UTF-8; null counts as empty.  Earlier means a
    smaller doc_id (null ids last, repeated ids in the order of the table), or an earlier start
    in the same document.  Texts shorter than ``LENGTH`` bytes stay whole.  No rows give no rows.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark, "suffix")
    buckets = max(1, -(-text_size(docs) // bucket_bytes))
    texts = workspace.stage(blocks(docs, block_bytes), "texts")
    replies = workspace.stage(
        anchored(texts, buckets).groupBy("bucket").applyInArrow(_meet(hot), _REPLY_SQL), "replies"
    )
    crowded = replies.where(F.col("kind") == CROWDED)
    theirs = texts.join(crowded.select("block").distinct(), "block", "leftsemi").unionByName(crowded)
    windows = workspace.stage(theirs.groupBy("block").applyInArrow(_crowded_windows(buckets), _DEALT_SQL), "windows")
    within = windows.where("bucket < 0").select("block", F.lit(MARKS).alias("kind"), "value")
    shared = windows.where("bucket >= 0").groupBy("bucket").applyInArrow(_shared_windows, _REPLY_SQL)
    chosen = replies.where(F.col("kind").isin(CHOSEN, CROWDED)).unionByName(workspace.stage(shared, "shared"))
    # About as many fragments in a bucket as text bytes would allow.
    cut = texts.unionByName(chosen).groupBy("block").applyInArrow(_cut_chosen(buckets), _DEALT_SQL)
    marks = workspace.stage(cut.groupBy("bucket").applyInArrow(_construct, _REPLY_SQL), "marks")
    kind = docs.schema["doc_id"].dataType
    arrow = pa.int32() if kind.simpleString() == "int" else pa.int64()
    names = ["doc_id", "n_bytes", "spans", "kept"]
    told = texts.unionByName(replies.where(F.col("kind") == COPIES)).unionByName(marks).unionByName(within)
    return told.groupBy("block").applyInArrow(
        _finish(arrow, names),
        f"doc_id {kind.simpleString()}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary",
    )
