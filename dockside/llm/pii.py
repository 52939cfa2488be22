"""Personal data: fixed rules, and contexts bootstrapped from what they find.

The rules find e-mail addresses, IP addresses, card and phone numbers.  These seed entities
induce lexical patterns: the word before and the word after an entity, whatever its shape, or
the marks around it with its shape.  Numbers of many digits with any marks between them, and
e-mail addresses that are spelled out, are instances of the same patterns if no rule took
them.  A pattern is trusted as far as its distinct instances are, and an instance as far as
its patterns are; Spark scores this graph in rounds, seeds staying at 1.  Instances that come
to be trusted support further patterns in the next round.  Patterns that end with high
confidence and enough support name further spans; a span is added only if it is a well-formed
identifier of that kind.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Workspace, text_pieces

# The kinds in order, and the rules' patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

ROUNDS = 4
CONFIDENCE = 0.7
SEEDS = 3
LEAST_DIGITS, MOST_DIGITS = 7, 19

_MARKS = r"[./()_·‐-―-]"
#: Numbers with marks and single spaces between them, with marks alone, and without.
_CHAINS = (
    re.compile(rf"\(?[0-9]+(?:{_MARKS}{{0,2}}[  ]?{_MARKS}{{0,2}}[0-9]+)*"),
    re.compile(rf"\(?[0-9]+(?:{_MARKS}{{1,2}}[0-9]+)*"),
    re.compile(r"[0-9]+"),
)
_AT = re.compile(r"\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s", re.IGNORECASE)
_DOT = re.compile(r"\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s", re.IGNORECASE)
_LOCAL = re.compile(rf"[A-Za-z0-9_%+-]+(?:(?:\.|{_DOT.pattern})[A-Za-z0-9_%+-]+)*$", re.IGNORECASE)
_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:(?:\.|{_DOT.pattern})[A-Za-z0-9-]+)+", re.IGNORECASE)
#: What a text with an e-mail address that is spelled out has at least.
_SPELLED = re.compile(rb"dot|[\[({<]\s?at", re.IGNORECASE)
#: Text without spaces between its words: the nearest two characters stand for a word.
_UNSPACED = re.compile("[฀-໿぀-ヿ㐀-鿿]")
_BEFORE = re.compile(r"([^\W_]+)(\W{0,4})$")
_AFTER = re.compile(r"^(\W{0,4})([^\W_]+)")
_NUMBER = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part can only end at an ``@``, so only those are looked at."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        found = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each chain of dotted numbers falls into fours from the left."""
    for chain in DOTTED.finditer(text):
        parts = list(_NUMBER.finditer(chain[0])) if "." in chain[0] else ()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in four):
                yield chain.start() + four[0].start(), chain.start() + four[3].end()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of everything that the rules find, in order."""
    rules = (emails, addresses, cards, phones)
    return sorted((s, k, e) for k, rule in enumerate(rules) for s, e in rule(text))


def shape(value: str) -> str:
    """Letters as ``a``, digits as their count; marks stay."""
    return _NUMBER.sub(lambda m: str(len(m[0])), _LETTERS.sub("a", value))


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns that a span is an instance of."""
    form = shape(text[start:end])
    before = _BEFORE.search(text[max(0, start - 40) : start])
    after = _AFTER.search(text[end : end + 40])
    word = lambda w: shape(w) if any(map(str.isdigit, w)) else w.lower()
    near = lambda w, part: w[part] if _UNSPACED.search(w[part]) else w
    marks = lambda m: re.sub(r"\s+", " ", m)
    edge = lambda c: " " if c.isspace() or not c else "a" if c.isalnum() else c
    out = [f"around {edge(text[start - 1 : start])}_{edge(text[end : end + 1])} {form}"]
    if before:
        out.append(f"after {word(near(before[1], slice(-2, None)))}{marks(before[2])}_")
    if after:
        out.append(f"before _{marks(after[1])}{word(near(after[2], slice(2)))}")
    return out


def spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses such as ``ann (at) example dot org``; a bare ``at`` needs a spelled dot."""
    for at in _AT.finditer(text):
        low = max(0, at.start() - 64)
        local, domain = _LOCAL.search(text[low : at.start()]), _DOMAIN.match(text[at.end() : at.end() + 256])
        if local and domain and (at[0].strip().lower() != "at" or _DOT.search(domain[0])):
            yield low + local.start(), at.end() + domain.end()


def candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Numbers with many digits, cut out at letters and other marks, and spelled addresses,
    outside the given spans.  Cuts of one place can overlap."""
    spans = sorted((s, e) for s, _, e in taken)
    starts = [s for s, _ in spans]
    ends = list(accumulate((e for _, e in spans), max))
    found = set(spelled_emails(text))
    for chain in _CHAINS:
        for m in chain.finditer(text):
            if LEAST_DIGITS <= sum(c.isdigit() for c in m[0]) <= MOST_DIGITS:
                start = m.start() + (m[0][0] == "(" and ")" not in m[0])
                found.add((start, m.end()))
    for start, end in sorted(found):
        i = bisect_left(starts, end)
        if not i or ends[i - 1] <= start:
            yield start, end


def well_formed(kind: str, value: str) -> bool:
    """Whether a found token can be an identifier of the kind at all."""
    digits = _digits(value)
    if kind == "email":
        value = _DOT.sub(".", _AT.sub("@", value))
        return list(emails(value)) == [(0, len(value))]
    if _LETTERS.search(value):
        return False
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        return list(addresses(value)) == [(0, len(value))]
    return 9 <= len(digits) <= 15


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SPAN = "struct<start: int, kind: int, end: int>"
_FOUND = "struct<start: int, end: int, value: string, kinds: array<int>, patterns: array<string>>"
_SEED = "struct<kind: int, value: string, patterns: array<string>>"


def findings(docs: DataFrame) -> DataFrame:
    """A row a document: ``row, doc_id``, the rules' spans, seeds and candidates with their patterns."""
    digit = np.zeros(256, bool)
    digit[[*range(0x30, 0x3A), 0x40]] = True

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for rows, data, offsets in text_pieces(batches):
            marks = digit[data]
            marks[[m.start() for m in _SPELLED.finditer(data.tobytes())]] = True
            some = np.concatenate([[0], np.cumsum(marks)])[offsets]
            n = rows.num_rows
            base, seeds, found = ([[] for _ in range(n)] for _ in range(3))
            for i in np.flatnonzero(np.diff(some)):
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace")
                spans = base_spans(text)
                base[i] = [{"start": s, "kind": k, "end": e} for s, k, e in spans]
                instance = lambda s, e: {"value": text[s:e].lower(), "patterns": patterns(text, s, e)}  # noqa: B023, E731
                seeds[i] = [{"kind": k} | instance(s, e) for s, k, e in spans]
                for s, e in candidates(text, spans):
                    kinds = [k for k, name in enumerate(KINDS) if well_formed(name, text[s:e])]
                    found[i].append({"start": s, "end": e, "kinds": kinds} | instance(s, e))
            names = [_text_of([(b["start"], b["kind"], b["end"]) for b in x]) for x in base]
            columns = [pa.array(row + np.arange(n)), rows.column(0), pa.array(names)]
            columns += [pa.array(x, t) for x, t in zip((base, seeds, found), kinds_of, strict=True)]
            row += n
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "base_text", "base", "seeds", "found"])

    integer, text = pa.int32(), pa.string()
    span = pa.struct([("start", integer), ("kind", integer), ("end", integer)])
    seed = pa.struct([("kind", integer), ("value", text), ("patterns", pa.list_(text))])
    other = pa.struct(
        [("start", integer), ("end", integer), ("value", text), ("kinds", pa.list_(integer)), ("patterns", pa.list_(text))]
    )
    kinds_of = [pa.list_(t) for t in (span, seed, other)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        find,
        f"row long, doc_id {kind}, base_text string, base array<{_SPAN}>, seeds array<{_SEED}>, found array<{_FOUND}>",
    )


def score_patterns(edges: DataFrame, workspace: Workspace, rounds: int = ROUNDS) -> DataFrame:
    """``pattern, kind, confidence, seeds`` from distinct edges ``pattern, value, kind, kinds``.

    ``kind`` is null but for seeds, ``kinds`` says what the value can be.  Each round: a
    pattern's confidence is its instances' sum over their count and one; an instance's is the
    chance that at least one of its patterns is right.  A pattern's ``seeds`` are its seeds and
    the instances that are trusted by then; patterns with too few of them trust nothing.
    """
    seeded = edges.where("kind IS NOT NULL").select("value", "kind").distinct()
    instances = edges.groupBy("pattern").agg(F.countDistinct("value").alias("n")).where(F.col("n") >= SEEDS)
    links = workspace.stage(edges.select("pattern", "value", "kinds").distinct().join(instances, "pattern"), "links")
    trust = seeded.withColumn("trust", F.lit(1.0))
    own = links.select("pattern", "value", "n").distinct()
    for k in range(rounds):
        sure = F.count(F.when(F.col("trust") >= CONFIDENCE, 1))
        sums = own.join(trust, "value").groupBy("pattern", "kind").agg(
            (F.sum("trust") / (F.first("n") + 1)).alias("confidence"), sure.alias("seeds")
        )
        scored = workspace.stage(sums.where(F.col("seeds") >= SEEDS), f"patterns-{k}")
        if k + 1 < rounds:
            miss = F.sum(F.log(1 - 0.9 * F.least("confidence", F.lit(1.0))))
            felt = links.join(scored, "pattern").where(F.array_contains("kinds", F.col("kind")))
            felt = felt.groupBy("value", "kind").agg((1 - F.exp(miss)).alias("felt"))
            trust = felt.join(seeded.withColumn("is_seed", F.lit(True)), ["value", "kind"], "full").select(
                "value", "kind", F.when(F.col("is_seed"), 1.0).otherwise(F.col("felt")).alias("trust")
            )
    return scored


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted cuts, those that don't overlap an earlier one."""
    integer = pa.int32()
    kind = pa.list_(pa.struct([("start", integer), ("kind", integer), ("end", integer)]))
    for batch in batches:
        out = []
        for cuts in batch.column(1).to_pylist():
            last, own = 0, []
            for x in cuts:
                if x["start"] >= last:
                    last = -x["back"]
                    own.append({"start": x["start"], "kind": x["kind"], "end": last})
            out.append(own)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["row", "added"])


def detect(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """One row a document: ``doc_id, base_text, base`` (the rules' spans), ``added`` and ``spans``.

    Takes ``doc_id`` and ``text``; null texts count as empty and have no spans.  Offsets are
    code points, ends exclusive.  Repeated rows are treated each on its own.  No rows give no
    rows.
    """
    workspace = workspace or Workspace(docs.sparkSession, "pii")
    rows = workspace.stage(findings(docs), "findings")
    each = lambda column, kind, kinds: (
        rows.select(F.explode(column).alias("x")).select(F.explode("x.patterns").alias("pattern"), "x.value", kind, kinds)
    )
    none = F.lit(None).cast("int").alias("kind")
    seeds = each("seeds", F.col("x.kind"), F.array("x.kind").alias("kinds"))
    edges = workspace.stage(seeds.unionByName(each("found", none, F.col("x.kinds"))).distinct(), "edges")
    trusted = score_patterns(edges, workspace).where((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= SEEDS))
    hits = rows.select("row", F.explode("found").alias("x")).select("row", "x.*").withColumn("pattern", F.explode("patterns"))
    hits = hits.join(trusted, "pattern").where(F.array_contains("kinds", F.col("kind")))
    best = hits.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
    # Of overlapping cuts the first and longest stays.
    longest = F.sort_array(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), "kind")))
    added = best.groupBy("row").agg(longest.alias("x"))
    added = added.mapInArrow(_apart, f"row long, added array<{_SPAN}>")
    names = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    whole = F.sort_array(F.concat("base", "added"))
    return rows.join(added, "row", "left").select(
        "doc_id",
        "base_text",
        "base",
        F.coalesce("added", F.array().cast(f"array<{_SPAN}>")).alias("added"),
        F.when(F.col("added").isNull(), F.col("base_text")).otherwise(F.array_join(F.transform(whole, text), ",")).alias("spans"),
    )
