import hashlib
import random
import re

import pytest

from dockside.llm import pii
from dockside.llm.queries import op7_pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def as_text(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


@pytest.mark.parametrize("alphabet", ["a1.@-", "0123456789 -.+", "+1() 23-.5", "4111 -", "ab@.c_ é1"])
def test_rules_match_the_plain_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_rules_are_fast_on_long_runs():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 300_000, "a@" * 100_000, "+1 " * 80_000, "1 " * 100_000):
        pii.base_spans(text)
        list(pii.candidates(text, []))


def test_query(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op7_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(as_text(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert not base or set(as_text(base).split(",")) <= set(r.spans.split(","))


def valid_card(rng):
    while True:
        number = f"{rng.randrange(10**15, 10**16)}"
        if pii.luhn(number):
            return number


def test_contexts_find_what_the_rules_drop(spark):
    rng = random.Random(2)
    rows = [(i, f"he paid with card {valid_card(rng)} in town") for i in range(30)]
    two = f"{valid_card(rng)} {valid_card(rng)}"
    bad = "1234567890123456"
    rows += [(100, f"she paid with card {two} in town"), (101, f"order with card {bad} in town"), (102, "nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.detect(docs).collect()}
    assert [r.kind for r in found[100].added] == [2, 2] and found[100].base_text == ""
    assert found[100].spans == "card:19:35,card:36:52"
    assert found[101].spans == found[102].spans == "" and not found[101].added


def test_awkward_rows(awkward, empty):
    rows = pii.detect(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id for r in rows if r.spans} == {10}
    assert [r.spans for r in rows if r.doc_id == 10] == ["ip:0:7"]
    assert pii.detect(empty).collect() == []


def test_contexts_find_unseen_formats(spark):
    rng = random.Random(3)
    digits = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    rows = [(i, f"please call me at +1 {digits(3)} {digits(3)} {digits(4)} tonight") for i in range(20)]
    rows += [(100 + i, f"he paid with card {valid_card(rng)} in town") for i in range(20)]
    rows += [(200 + i, f"write to contact mail user{i}@example.org for help") for i in range(20)]
    dotted = ".".join(re.findall("....", valid_card(rng)))
    expected = {300: "phone:18:30", 301: f"card:18:{18 + len(dotted)}", 302: "email:22:44", 303: "email:22:40"}
    rows += [(300, "please call me at 555-867-5309 tonight"), (301, f"he paid with card {dotted} in town")]
    rows += [(302, "write to contact mail ann at example dot org for help"), (303, "write to contact mail ann[at]example.org for help")]
    rows += [(304, "look at example.com and the dot there"), (305, "build number 555-867-5309 passed")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.detect(docs).collect()}
    for i, end in ((302, len("ann at example dot org")), (303, len("ann[at]example.org"))):
        expected[i] = f"email:22:{22 + end}"
    assert {i: found[i].spans for i in range(300, 306)} == expected | {304: "", 305: ""}


def test_trusted_instances_induce_patterns(spark):
    """Contexts that no seed has, but numbers that trusted contexts found elsewhere."""
    numbers = [f"555-867-{i}" for i in range(5300, 5312)]
    rows = [(i, f"call me at +1 202 555 {i + 1000} now") for i in range(40)]
    rows += [(100 + i, f"call me at {n} now") for i, n in enumerate(numbers[:8])]
    rows += [(200 + i, f"hotline: {n} daily") for i, n in enumerate(numbers[:9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.detect(docs).collect()}
    assert found[100] == "phone:11:23" and found[208] == "phone:9:21"


@pytest.mark.parametrize("wrap", [
    lambda n, i: '{"a":"' + "x" * 100 + f'","card":"{n}","b":"' + "y" * 100 + '"}',
    lambda n, i: "汉" * 90 + f"卡号{n}支付" + "字" * 90,
])
def test_candidates_in_text_without_spaces(spark, wrap):
    rng = random.Random(6)
    numbers = [valid_card(rng) for _ in range(20)]
    dotted = ".".join(re.findall("....", valid_card(rng)))
    rows = [(i, wrap(n, i)) for i, n in enumerate([*numbers, dotted])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.detect(docs).collect()}
    start = rows[20][1].index(dotted)
    assert found[20].spans == f"card:{start}:{start + len(dotted)}"
