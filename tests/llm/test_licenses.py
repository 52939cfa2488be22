"""License scan against plain regular expressions and pairwise containment."""

import random
import re

import pytest
from pyspark.sql import functions as F

from dockside.llm import licenses
from dockside.llm.license_rules import BASE, RULES, WEIGHTS
from dockside.llm.queries import QUERIES

COMPILED = [re.compile(r.whole_words, re.ASCII) for r in RULES]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text):
    """Every rule on every text, every pair of detections compared."""
    words = words_of(text)
    joined = " ".join(words)
    hits = []
    for i, rule in enumerate(RULES):
        for m in COMPILED[i].finditer(joined):
            start = joined.count(" ", 0, m.start())
            hits.append((start, start + m.group().count(" ") + 1, rule.priority, i))
    inside = lambda a, b: b[0] <= a[0] and b[1] >= a[1] and b[2] <= a[2]
    wins = lambda a, b: (b[2], b[3]) < (a[2], a[3]) if a[:2] == b[:2] else True
    kept = [a for a in hits if not any(inside(a, b) and wins(a, b) for b in hits if b != a)]
    places = []
    base_labels = set()
    for label, _, phrase in BASE:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        if at:
            base_labels.add(label)
    score = 1.0
    for p, w in enumerate(WEIGHTS, 1):
        score *= 1 - w if any(k[2] == p for k in kept) else 1
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        sorted(base_labels),
        sorted(base_labels | {RULES[k[3]].label for k in kept}),
        sorted(kept),
        round(1 - score, 9),
    )


def scanned(df):
    out = []
    for r in licenses.scan(df).collect():
        kept = sorted((d.start, d.end, d.priority, d.rule) for d in r.detections)
        places = (len(r.base), min(r.base, default=None), max(r.base, default=None))
        out.append((r.doc_id, (r.n_words, *places, r.base_labels, r.labels, kept, round(r.score, 9))))
    return sorted(out, key=str)


def example(pattern, rng):
    """A text the pattern covers: random choices of its alternatives, optional parts in or out."""
    while m := re.search(r"\(\?:([^()]*)\)(\?|\{1,[0-9]\})?", pattern):
        some = rng.choice(m[1].split("|")) if m[2] != "?" or rng.random() < 0.5 else ""
        pattern = pattern[: m.start()] + some + pattern[m.end() :]
    pattern = re.sub(r"\\S\+", "holder", pattern)
    pattern = re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)
    return re.sub(r".\?", "", pattern) if rng.random() < 0.5 else pattern.replace("?", "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    marks = [" ", " ", "\n * ", ", ", "-", ".", "\t# ", " \u00a0 ", "/"]
    filler = "the license mit gnu apache cc by of 2 0 and word \u00e9t\u00e9 \U0001f600".split()
    out = []
    for i in range(600):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += example(rng.choice(RULES).pattern, rng).split(" ")
            words += rng.choices(filler, k=rng.randint(0, 3))
        words = [w.upper() if rng.random() < 0.3 and w.isascii() else w for w in words]
        out.append((i, "".join(w + rng.choice(marks) for w in words)))
    return out


def test_hundreds_of_rules_whose_matches_hold_a_keyword():
    rng = random.Random(0)
    assert len(RULES) >= 200 and len({r.pattern for r in RULES}) == len(RULES)
    for rule, compiled in zip(RULES, COMPILED, strict=True):
        for _ in range(20):
            text = example(rule.pattern, rng)
            assert compiled.fullmatch(text), (rule, text)
            assert set(rule.keywords) & set(text.split(" ")), (rule, text)


def test_against_brute_force(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert scanned(df) == sorted(((i, brute(t)) for i, t in texts), key=str)


def test_suppression_by_containment_and_priority(spark):
    text = "Creative Commons Attribution-ShareAlike 4.0 License; SPDX-License-Identifier: MIT"
    row = scanned(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0][1]
    assert row[5] == ["cc-by-sa-4.0", "mit"]
    assert row == brute(text)


def test_very_many_detections_in_one_text(spark):
    text = "MIT License, CC BY 4.0 apache license version 2.0. " * 3000
    row = scanned(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0][1]
    assert row[1] == 9000 and len(row[6]) == 9000
    assert row[5] == ["apache", "apache-2.0", "cc-by", "cc-by-4.0", "mit"]


def test_awkward_rows_and_empty_table(awkward, empty):
    clash = awkward.withColumns({c: F.lit("x") for c in ("words", "found", "joined", "hits", "kept")})
    rows = clash.select("doc_id", "text").collect()
    assert scanned(clash) == sorted(((r.doc_id, brute(r.text)) for r in rows), key=str)
    assert scanned(empty) == []


def test_query_on_the_documents(spark, sf_dir, documents):
    want = {r.doc_id: brute(r.text) for r in documents.select("doc_id", "text").collect()}
    got = QUERIES["op11_license_scan"](spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == w[:4]
        assert (r.base_labels, r.labels, round(r.score, 9)) == (",".join(w[4]), ",".join(w[5]), w[7])
    assert sum(r.n_base > 0 for r in got) > 0


def test_plan_has_no_python_and_no_shuffle(spark, sf_dir):
    plan = QUERIES["op11_license_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
