from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
import test_decontam
import test_exact
import test_near
import test_packing
from pyspark.sql import functions as F

from dockside.llm import langid
from dockside.llm.base import Workspace, fold


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents, tmp_path_factory):
    """The input of each stage, and the last result."""
    tables, root = [documents], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], sf_dir).write.parquet(f"{root}/{name}")
        tables.append(spark.read.parquet(f"{root}/{name}"))
    return tables


def test_columns_and_order(stages, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "decontamination", "packing"]
    assert all(t.columns == documents.columns for t in stages[:-1])


def test_language_stage_keeps_what_the_operator_accepts(stages):
    net = langid.fit(stages[0].where(fold(5) != 0))
    cuts = dict(zip(net.languages, net.least.tolist(), strict=True))
    found = langid.identify(stages[0], net).where("lang_pred <> 'und'").collect()
    assert {r.doc_id for r in found if r.score >= cuts[r.lang_pred]} == {r.doc_id for r in stages[1].collect()}
    assert stages[1].count() > 0.97 * stages[0].count()


def test_exact_stage(stages):
    first = {}
    for r in stages[1].collect():
        key = test_exact.plain(r.text)
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert sorted(first.values()) == sorted(r.doc_id for r in stages[2].collect())


def test_near_stage(stages):
    kept = sorted(g[0] for g in test_near.brute_classes(stages[2].collect()))
    assert kept == sorted(r.doc_id for r in stages[3].collect())


def test_decontamination_stage(spark, sf_dir, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    given = [(r.doc_id, r.text) for r in stages[3].collect()]
    clean = sorted(doc for doc, _, hit, _ in test_decontam.brute(given, items, 10) if not hit)
    assert clean == sorted(str(r.doc_id) for r in stages[4].collect())


def test_packing_stage(stages):
    test_packing.check(stages[5].collect(), stages[4].collect())


@pytest.fixture(scope="module")
def odd(awkward):
    """Awkward rows as documents: languages here and there, columns with clashing names."""
    lang = F.when(F.col("doc_id") % 3 == 0, "en").when(F.col("doc_id") % 3 == 1, "de")
    return awkward.withColumns({"lang": lang, "source": F.lit("s"), "n_chars": F.length("text").cast("long")})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_on_awkward_rows(spark, sf_dir, odd, name):
    kept = dict(corpus_pipeline.STAGES)[name](spark, odd, sf_dir)
    assert kept.columns == odd.columns
    count = lambda df: Counter(tuple(r) for r in df.collect())
    given, found = count(odd), count(kept)
    assert not found - given
    ids = Counter(r[0] for r in found.elements())
    words = {i: n for i, n in ids.items() if i not in (4, 5, 6, None)}
    if name == "language":  # no text with letters is lost, all others go
        assert set(words) == {1, 2, 3, 7, 8, 9, 11, 13} and not {4, 5, 6} & set(ids) and ids[2] == 3
    elif name == "exact":
        assert ids == Counter({1: 1, None: 0, 4: 1, 6: 1, 7: 1, 8: 1, 10: 1, 11: 1, 12: 1, 13: 2})
    elif name == "near":
        assert ids == Counter({1: 1, None: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 10: 1, 11: 1, 12: 1, 13: 2})
    else:
        assert found == given


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_without_rows(spark, sf_dir, odd, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, odd.where("false"), sf_dir).collect() == []


def test_packing_stage_on_awkward_rows(spark, sf_dir, odd):
    test_packing.check(corpus_pipeline.pack_sequences(spark, odd, sf_dir).collect(), odd.collect())


def test_run_leaves_only_its_last_rows(spark, sf_dir):
    before = set(Workspace._open)
    corpus_pipeline.run(spark, sf_dir)
    left = {Path(w.root).name.rsplit("-", 1)[0] for w in Workspace._open - before}
    assert left <= {"pipeline-decontamination", "packing"} and "pipeline-decontamination" in left


def test_run(spark, sf_dir, stages):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(key, rows)) == sorted(map(key, stages[-1].collect()))
