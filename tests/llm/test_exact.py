import hashlib
import re
from collections import Counter

from dockside.llm import exact


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_awkward_rows(awkward):
    rows = exact.exact_groups(awkward, fan_in=2, rounds=3).collect()
    given = [(r.doc_id, plain(r.text)) for r in awkward.collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    sizes = Counter(sha(t) for _, t in given)
    assert Counter((r.doc_id, r.text_sha256) for r in rows) == Counter((i, sha(t)) for i, t in given)
    for r in rows:
        ids = [i for i, t in given if sha(t) == r.text_sha256 and i is not None]
        assert r.keep_id == min(ids, default=None)
        assert r.group_size == sizes[r.text_sha256]
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(set(sizes))


def test_empty_table(empty):
    assert exact.exact_groups(empty).collect() == []
    assert exact.drop_copies(empty).collect() == []


def test_drop_copies_keeps_one_row_of_each_text(awkward):
    kept = exact.drop_copies(awkward)
    assert kept.columns == awkward.columns
    texts = [plain(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({plain(r.text) for r in awkward.collect()})


def test_only_dataframe_functions(awkward):
    plan = exact.exact_groups(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
