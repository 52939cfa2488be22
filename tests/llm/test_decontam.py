import random
import re

import pytest

from dockside.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(item or "")
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    found |= own
        out.append((str(doc), len(w), len(hit), sorted(found)))
    return sorted(out)


ITEMS = [
    ("q1", "Lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem"), ("q2", "word"), ("q3", ""), ("q4", None),
    (None, "OTHER word"), ("q2", "word"), ("q5", "b c"), ("q6", "Ünïcode 'tis"),
]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_awkward_rows(spark, awkward, block_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = decontam.contamination(awkward, bench, 10, block_bytes).collect()
    given = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.items) for r in rows) == brute(given, ITEMS, 10)
    clean = decontam.remove_contaminated(awkward, bench, 10, block_bytes)
    assert clean.columns == awkward.columns
    assert clean.count() == sum(r.n_hit == 0 for r in rows)


def test_empty_tables(spark, awkward, empty):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert decontam.contamination(empty, bench).collect() == []
    rows = decontam.contamination(awkward, bench.where("false")).collect()
    assert all(r.n_hit == 0 and r.items == [] for r in rows) and len(rows) == awkward.count()


def test_longest_match_goes_past_the_window(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x " + text[: text.index(" w25")] + " y")], "doc_id int, text string")
    bench = spark.createDataFrame([(7, text)], "item_id int, text string")
    row = decontam.contamination(docs, bench).first()
    assert (row.n_hit, row.longest_match, row["items"]) == (25, 25, ["7"])


def test_longest_match_over_all_items_that_share_a_passage(spark):
    """Ten shared words and own ones: the window occurs in both items, the longest match in one."""
    shared = [f"w{i}" for i in range(1, 11)]
    items = [("a", " ".join([*shared, "x"])), ("b", " ".join([*shared, "y", "z"]))]
    long = " ".join(f"p{i}" for i in range(100))
    items += [(f"q{k}", f"{long} " + " ".join(f"o{k}x{i}" for i in range(20))) for k in range(5)]
    texts = {
        1: items[1][1], 2: f"0 {items[0][1]} z", 3: " ".join(shared), 4: f"{items[5][1]} more", 5: long, 6: f"x y z {long} o9x0",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    for order in (items, items[::-1]):
        bench = spark.createDataFrame(order, "item_id string, text string")
        found = {r.doc_id: r.longest_match for r in decontam.contamination(docs, bench).collect()}
        assert found == {1: 12, 2: 11, 3: 10, 4: 120, 5: 100, 6: 100}


def longest_brute(doc, items, size):
    """Longest common run of words with an item, of a whole window at least."""
    w, best = words(doc), 0
    for text in items:
        v = words(text)
        k = min(size, len(v))
        for i in range(len(w)):
            for j in range(len(v)):
                n = 0
                while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                    n += 1
                best = max(best, n) if k and n >= k else best
    return best


def test_longest_match_against_brute_force(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items, docs = [text(rng.randrange(30)) for _ in range(12)], [text(rng.randrange(40)) + rng.choice(["", " c a"]) for _ in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    for block_bytes in (1, 1 << 20):
        rows = decontam.contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string"), bench, 4, block_bytes)
        found = {r.doc_id: r.longest_match for r in rows.collect()}
        assert found == {i: longest_brute(d, items, 4) for i, d in enumerate(docs)}


def spans_brute(doc, items, size):
    """Maximal matches: from each word on the longest one, unless an earlier one holds it."""
    w, out, reach = words(doc), [], 0
    for i in range(len(w)):
        found = []
        for name, text in items:
            v = words(text)
            k = min(size, len(v))
            for j in range(len(v)):
                n = 0
                while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                    n += 1
                if k and n >= k and j + k <= len(v):
                    found.append((-n, name, j))
        if found and i - min(found)[0] > reach:
            n, name, j = min(found)
            reach = i - n
            out.append((i, -n, name, j))
    return out


@pytest.mark.parametrize("block_bytes", [1, 30, 1 << 20])
def test_spans_against_brute_force(spark, block_bytes):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(f"q{i}", text(rng.randrange(25))) for i in range(14)]
    docs = [text(rng.randrange(50)) + rng.choice(["", " d a b"]) for _ in range(80)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = decontam.contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string"), bench, 4, block_bytes)
    for r in rows.collect():
        assert [tuple(s) for s in r.spans] == spans_brute(docs[r.doc_id], items, 4)
