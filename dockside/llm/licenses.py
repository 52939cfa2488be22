"""License scan: ordered signature rules behind a keyword prefilter.

A text becomes its lower-cased words.  The words it shares with the rules' keywords decide which
patterns run at all; most texts share none and cost one look at their words.  The patterns that
remain run over the words joined by single spaces, and each match is an interval of words.
Overlaps are resolved by containment: a detection inside one of the same or a higher priority
goes, of equal intervals the earlier rule's stays.  A text's intervals are swept once, in order of
their start, the longer first: then an earlier detection contains a later one if it ends no
sooner, so the farthest end of each priority is all the sweep has to know.

Only DataFrame functions are used, each row by itself: there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import RULES, WEIGHTS, Rule

#: What parts words in a lower-cased text: the ASCII characters beside digits and a to z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks around a match; no word holds them.
OPEN, CLOSE = "\x01", "\x02"
#: Detections handled together in a sweep, so that a text with very many stays linear.
BLOCK = 256

HIT = "array<struct<start:int,down:int,priority:int,rule:int>>"


def lower_words(text: Column) -> Column:
    """The words of a text with A to Z lower-cased; none for null.

    Cut at what lies between them: picking the matches out costs the square of a text's length.
    """
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def _table(rules: tuple[Rule, ...]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(r.priority).alias("priority"),
                F.array(*map(F.lit, r.keywords)).alias("keywords"),
                F.lit(r.whole_words).alias("pattern"),
            )
            for i, r in enumerate(rules)
        )
    )


def _matches(joined: Column, rule: Column) -> Column:
    """Every match of a rule as an interval of words: the match is marked, then its words found."""
    marked = F.split(F.regexp_replace(joined, rule["pattern"], F.lit(f"{OPEN}$0{CLOSE}")), " ")
    places = lambda is_one: F.filter(
        F.transform(marked, lambda w, i: F.when(is_one(w), i)), lambda i: i.isNotNull()
    )
    starts, lasts = places(lambda w: w.startswith(OPEN)), places(lambda w: w.endswith(CLOSE))
    # Matches of one rule never overlap: the n-th start belongs to the n-th end.
    return F.zip_with(
        starts,
        lasts,
        lambda i, j: F.struct(
            i.alias("start"), (-j - 1).alias("down"), rule["priority"].alias("priority"), rule["rule"].alias("rule")
        ),
    )


def detections(words: Column, joined: Column, found: Column, rules: tuple[Rule, ...]) -> Column:
    """All matches of the rules whose keywords were found.

    Most of those do not match either, so the pattern is tried before its matches are placed.
    """
    awake = F.filter(
        _table(rules), lambda r: F.arrays_overlap(r["keywords"], found) & F.regexp_like(joined, r["pattern"])
    )
    return F.when(F.size(found) > 0, F.flatten(F.transform(awake, lambda r: _matches(joined, r))))


def _sweep(hits: Column) -> Column:
    """The hits, in order of start and longer first, that none of their priority or higher contains."""
    levels = len(WEIGHTS)
    nothing = F.slice(hits, 1, 0)

    def step(state: Column, hit: Column) -> Column:
        end = -hit["down"]
        inside = F.element_at(state["ends"], hit["priority"]) >= end
        ends = F.transform(
            state["ends"], lambda e, p: F.when(p + 1 >= hit["priority"], F.greatest(e, end)).otherwise(e)
        )
        kept = F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(hit)))
        return F.struct(ends.alias("ends"), kept.alias("kept"))

    def block(state: Column, k: Column) -> Column:
        start = F.struct(state["ends"].alias("ends"), nothing.alias("kept"))
        done = F.aggregate(F.slice(hits, k * BLOCK + 1, F.lit(BLOCK)), start, step)
        return F.struct(done["ends"].alias("ends"), F.concat(state["kept"], F.array(done["kept"])).alias("kept"))

    blocks = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int"))
    start = F.struct(
        F.array(*[F.lit(-1)] * levels).alias("ends"), F.array().cast(f"array<{HIT}>").alias("kept")
    )
    return F.flatten(F.aggregate(blocks, start, block)["kept"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What the rules find in every text.

    Takes ``doc_id`` and ``text``; other columns are ignored.  A null text counts as empty, and an
    empty one has no words and no detections.  Repeated rows each give a row; no rows give none.

    Returns ``doc_id, n_words``, ``base`` (start words of all matches of base rules, in order),
    ``base_labels``, ``labels`` (both sorted; the labels of base rules always stay), ``detections``
    (label, rule, first word, word after the last, priority) and ``score``: the chance that one of
    the detections counts, if each of their priorities is taken once and independently.
    """
    words = docs.select("doc_id", lower_words(F.col("text")).alias("words"))
    keywords = F.array(*map(F.lit, sorted({k for r in rules for k in r.keywords})))
    gated = words.withColumn("found", F.array_intersect("words", keywords))
    gated = gated.withColumn("joined", F.when(F.size("found") > 0, F.array_join("words", " ")))
    hits = gated.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(
            F.array_sort(detections(F.col("words"), F.col("joined"), F.col("found"), rules)),
            F.array().cast(HIT),
        ).alias("hits"),
    )
    kept = F.when(F.size("hits") > 1, _sweep(F.col("hits"))).otherwise(F.col("hits"))
    swept = hits.withColumn("kept", kept)

    label = F.array(*(F.lit(r.label) for r in rules))
    is_base = F.array(*(F.lit(r.base) for r in rules))
    of = lambda table, h: F.get(table, h["rule"])
    base_hits = F.filter("hits", lambda h: of(is_base, h))
    labels = lambda found: F.transform(found, lambda h: of(label, h))
    sure = F.lit(1.0)
    for priority, weight in enumerate(WEIGHTS, 1):
        there = F.array_contains("kept.priority", priority)
        sure = sure * F.when(there, 1.0 - weight).otherwise(1.0)
    return swept.select(
        "doc_id",
        "n_words",
        F.transform(base_hits, lambda h: h["start"].cast("long")).alias("base"),
        F.array_sort(F.array_distinct(labels(base_hits))).alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(labels(base_hits), labels(F.col("kept"))))).alias("labels"),
        F.transform(
            "kept",
            lambda h: F.struct(
                of(label, h).alias("label"), h["rule"].alias("rule"), h["start"].alias("start"),
                (-h["down"]).alias("end"), h["priority"].alias("priority"),
            ),
        ).alias("detections"),
        (1.0 - sure).alias("score"),
    )
