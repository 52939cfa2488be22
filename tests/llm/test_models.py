"""Quality and toxicity: held-out accuracy and defined results for awkward rows."""

import zlib

import numpy as np
import pytest

from dockside.llm import quality, toxicity
from dockside.llm.base import Words, fold, sample_texts, text_of_each
from dockside.llm.queries import op2_quality, op6_toxicity


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_quality_on_held_out_rows(spark, sf_dir, documents, labels):
    rows = op2_quality(spark, sf_dir)
    assert rows.count() == documents.count()
    for r in rows.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_toxicity_on_held_out_rows(spark, documents, labels):
    sf_dir = "/root/testdata/sf0.1"
    rows = op6_toxicity(spark, sf_dir).where("held_out")
    given = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "toxic AS label")
    held = rows.join(given, "doc_id").collect()
    assert np.mean([r.toxic for r in held if r.label]) > 0.85
    assert np.mean([r.toxic for r in held if not r.label]) < 0.01
    assert all(0 <= r.severity <= 3 for r in held)


def test_awkward_rows(documents, labels, awkward, empty):
    one, two = quality.fit(documents, labels), toxicity.fit(documents, labels)
    for given in (awkward, empty):
        assert quality.score(given, one).count() == given.count()
        assert toxicity.severity(given, two).count() == given.count()
    found = {r.doc_id: r.severity for r in toxicity.severity(awkward, two).collect()}
    assert found[4] == found[5] < 0.5
    assert all(0 <= r.score <= 1 for r in quality.score(awkward, one).collect())


def test_nothing_to_learn_from(awkward, labels):
    none = labels.where("false")
    assert quality.fit(awkward, none) is None and toxicity.fit(awkward, none) is None
    assert {r.score for r in quality.score(awkward, None).collect()} == {0.5}
    assert {r.severity for r in toxicity.severity(awkward, None).collect()} == {0.0}


def test_non_negative_risk_finds_the_hidden_class():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (3000, 4)), rng.normal(-1, 1, (400, 4))
    unlabelled = np.concatenate([good[1500:], bad])
    model = quality.non_negative_fit(good[:1500], unlabelled, 1500 / 1900)
    assert model.score(good[1500:]).mean() > 0.9 > 0.3 > model.score(bad).mean()


@pytest.mark.parametrize("prior", [0.1, 0.5, 0.85])
def test_the_prior_comes_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1.5, 1, (6000, 3)), rng.normal(-1.5, 1, (4000, 3))
    n = int(4000 * prior)
    unlabelled = np.concatenate([good[2000 : 2000 + n], bad[: 4000 - n]])
    assert abs(quality.estimated_prior(good[:2000], unlabelled) - prior) < 0.06


def test_bad_labels_do_not_move_the_prior(spark, documents, labels):
    learn = fold(4) != 2
    docs, known = documents.where(learn), labels.where(learn)
    both = quality.fit(docs, known)
    good_only = quality.fit(docs, known.where("quality = 1"))
    assert both.prior == pytest.approx(good_only.prior, abs=0.01) and 0.75 < both.prior < 0.95


def test_one_id_or_none_for_very_many_rows(spark):
    """A sample stays bounded where one id, or no id, has a third of all rows each."""
    rows = [(7, f"same id {i}") for i in range(3000)] + [(None, f"no id {i}") for i in range(3000)]
    rows += [(100 + i, f"own id {i}") for i in range(3000)] + [(8, "one row")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for seed in range(3):
        drawn = sample_texts(docs, 0.1, seed).collect()
        assert 700 < len(drawn) < 1100 and sum(r.doc_id == 8 for r in drawn) <= 1
    ids = spark.createDataFrame([(7, 1), (8, 0), (150, 1), (99, 1)], "doc_id long, label int")
    found = text_of_each(docs, ids).collect()
    assert sorted((r.doc_id, r.label) for r in found) == [(7, 1), (8, 0), (150, 1)]


def test_thresholds_stay_in_order_and_severity_grows():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 4, 500)
    row, column = np.arange(500), np.zeros(500, np.int64)
    weights, thresholds = toxicity.ordinal_fit(row, column, grade + rng.normal(0, 0.2, 500), grade, 1)
    assert (np.diff(thresholds) > 0).all() and weights[0] > 0
    model = toxicity.Model(np.zeros(1, np.uint64), weights, thresholds)
    expected = model.above(weights[0] * np.arange(4.0)).sum(axis=1)
    assert (np.diff(expected) > 0.3).all()


def test_beginnings_of_words_are_terms():
    data = np.frombuffer("scumbags Scumbag scum".encode(), np.uint8)
    doc, hashes, size = toxicity.terms(data, np.array([0, len(data)]))
    assert list(size) == [3] and len(hashes) == 3 + 2 + 2 and len(set(hashes.tolist())) == 5
    assert len(Words(data, np.array([0, len(data)])).hashes) == 3


def test_the_cut_separates_what_can_be_separated():
    chance, toxic = np.array([0.05, 0.1, 0.3, 0.4, 0.9]), np.array([False, False, True, True, True])
    assert toxicity.best_cut(chance, toxic) == 0.2
    assert 0.05 <= toxicity.best_cut(np.array([0.0, 1.0]), np.array([True, False])) <= 0.95
