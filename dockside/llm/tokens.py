"""Token ids of many texts at once, by the word tokenizer of the ``tokenizers`` library.

The tokenizer lower-cases, splits at fixed character classes, and then treats every word
alone.  So texts are cut into words over arrays of code points, each distinct word goes
through the library once, and its ids are looked up from then on.  Texts with characters
whose normal form needs more than a table (combining marks, scripts beyond Latin) and
texts that spell a special token go through the library whole.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from tokenizers import Tokenizer

from .base import WordTable, mix, prefix_hash, ragged, span_hash

SPACE, LETTER, NUMBER, OTHER = range(4)
SIMPLE = 0x300
#: Slots of the table of known words, as a power of two.
TABLE_BITS = 20


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(SIMPLE + 1, OTHER, np.uint8)
    lower = np.arange(SIMPLE + 1, dtype=np.uint32)
    simple = np.ones(SIMPLE + 1, bool)
    simple[SIMPLE] = False
    for c in range(SIMPLE):
        group, small = unicodedata.category(chr(c))[0], chr(c).lower()
        kind[c] = LETTER if group == "L" else NUMBER if group == "N" else OTHER
        if len(small) == 1 and ord(small) < SIMPLE:
            lower[c] = ord(small)
        else:
            simple[c] = False
    kind[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
    return kind, lower, simple


KIND, LOWER, IS_SIMPLE = _tables()
_CODES = mix(np.arange(1, SIMPLE + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class BatchTokenizer:
    """Ids of texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = WordTable(TABLE_BITS)
        self._forget()

    def _forget(self) -> None:
        self.table.clear()
        self.ids = np.zeros(1 << 20, np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)
        self.start = np.zeros(1 << 18, np.int64)
        self.words = self.filled = 0

    def _learn(self, keys: np.ndarray, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes = ends - starts
        spaced = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint32)
        spaced[ragged(np.cumsum(sizes + 1) - sizes - 1, sizes)] = chars[ragged(starts, sizes)]
        words = spaced.tobytes().decode("utf-32-le").split(" ")[:-1]
        lines = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        ids = np.concatenate(
            [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        )
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) != len(words):
            raise ValueError("a word's tokens don't end where the word ends")
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.words + len(words) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.start[self.words + 1 : self.words + 1 + len(words)] = self.filled + stop
        self.table.add(keys, np.arange(self.words, self.words + len(words), dtype=np.int32))
        self.words += len(words)
        self.filled += len(ids)

    def _split(self, chars: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words; ``cut`` marks the first character of each text."""
        kind = KIND[chars]
        start = np.ones(len(chars), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER) | cut[1 : len(chars)]
        quote = np.flatnonzero((chars == 0x27) & start)
        if len(quote):
            padded = np.concatenate([np.where(cut[: len(chars)], 0, chars), np.zeros(2, np.uint32)])
            one, two = padded[quote + 1], padded[quote + 2]
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.zeros(len(quote), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            start[quote[short | long] + 1] = False
            after = np.concatenate([quote[short] + 2, quote[long] + 3])
            start[after[after < len(chars)]] = True
        space = kind == SPACE
        bound = np.flatnonzero(np.append(start | space, True))
        starts = np.flatnonzero(start & ~space)
        return starts, bound[np.searchsorted(bound, starts, side="right")]

    def _places(self, keys: np.ndarray, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the words' ids; unknown words go through the library first."""
        if self.table.used + len(keys) > self.table.most:
            self._forget()
        place = self.table.find(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            fresh, which = np.unique(keys[new], return_index=True)
            self._learn(fresh, chars, starts[new[which]], ends[new[which]])
            place[new] = self.table.find(keys[new])
        return place

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts and the offsets of each text's ids."""
        n = len(offsets) - 1
        raw = data.tobytes()
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        try:
            points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:  # not text; byte by byte, as the library would be given it
            points, first = np.full(len(data), SIMPLE, np.uint32), offsets
        chars = np.minimum(points, SIMPLE)
        odd = np.zeros(len(chars) + 1, np.int64)
        np.cumsum(~IS_SIMPLE[chars], out=odd[1:])
        slow = np.diff(odd[first]) > 0
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                slow[np.searchsorted(offsets, at, side="right") - 1] = True
                at = raw.find(token, at + 1)
        cut = np.zeros(len(chars) + 1, bool)
        cut[first] = True
        chars = LOWER[chars]
        starts, ends = self._split(chars, cut)
        if slow.any():
            fast = ~slow[np.searchsorted(first, starts, side="right") - 1]
            starts, ends = starts[fast], ends[fast]
        keys = span_hash(prefix_hash(_CODES[chars]), starts, ends)
        keys[keys == 0] = 1
        found, counts = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for low in range(0, len(keys), self.table.most):  # a long text may have more words than the table
            part = slice(low, low + self.table.most)
            place = self._places(keys[part], chars, starts[part], ends[part])
            counts.append(self.start[place + 1] - self.start[place])
            found.append(self.ids[ragged(self.start[place], counts[-1])].astype("<u4"))
        ids, before = np.concatenate(found), np.cumsum(np.concatenate(counts))
        at = before[np.searchsorted(starts, first)]
        if not slow.any():
            return ids, at
        parts, sizes = [], np.diff(at)
        for i in range(n):
            if slow[i]:
                text = raw[offsets[i] : offsets[i + 1]].decode(errors="replace")
                own = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
                sizes[i] = len(own)
                parts.append(own)
            else:
                parts.append(ids[at[i] : at[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])
