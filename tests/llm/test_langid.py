import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from dockside.llm import langid
from dockside.llm.queries import op10_language_id


def test_query_on_held_out_rows(spark, sf_dir, documents):
    rows = op10_language_id(spark, sf_dir).join(documents, "doc_id").collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_awkward_rows(documents, awkward, empty):
    net = langid.fit(documents.limit(300), steps=30)
    rows = langid.identify(awkward, net).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 2, 13)}
    for i in (4, 5, 6, 10, 12):  # null, empty, blank, digits, symbols
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[8].lang_pred == by_id[9].lang_pred != "und"
    kept = langid.keep_identified(awkward, net)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r.lang_pred != "und" for r in rows)
    assert langid.identify(empty, net).collect() == []


def test_nothing_to_learn_from(awkward, empty):
    assert langid.fit(empty.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))) is None
    assert {r.lang_pred for r in langid.identify(awkward, None).collect()} == {"und"}


def test_gradients_match_differences():
    net = langid.BiGru(["a", "b", "c"], hidden=3)
    for layer in net.layers:
        layer.params = {k: v.astype(np.float64) for k, v in layer.params.items()}
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    columns = np.array([[97, 98, 99, 97], [100, 97, 97, 101]], np.uint8)
    target = np.array([2, 0])
    _, grads = net._step(columns, target)
    params = [*net.layers[0].params.values(), *net.layers[1].params.values(), net.out, net.bias]
    for p, g in zip(params, grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, step = p[at], 1e-5
        p[at] = old + step
        up, _ = net._step(columns, target)
        p[at] = old - step
        down, _ = net._step(columns, target)
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 1e-3 * max(1e-3, abs(g[at]))


def test_long_words_are_labelled_in_parts():
    data = np.frombuffer(b"a" * 60 + b" " + b"b" * 24, np.uint8)
    starts, ends = langid.segments(data, np.array([0, len(data)]))
    assert list(ends - starts) == [24, 24, 12, 24]


def test_every_language_is_learned(spark):
    """Seventy languages, the last ones with the fewest rows."""
    rng = np.random.default_rng(1)
    consonants, vowels = "bcdfghjklmn", "aeiou"
    codes = [a + b for a in consonants for b in consonants if a != b][:70]
    word = lambda c: c + "".join(rng.choice(list(vowels), 2)) + c
    rows = [(100 * i + k, " ".join(word(c) for _ in range(30)), f"l{i}") for i, c in enumerate(codes) for k in range(6 - i // 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.fit(docs)
    assert sorted(net.languages) == sorted({r[2] for r in rows})
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, net).collect()}
    right = [found[i] == lang for i, _, lang in rows]
    assert sum(right) >= 0.95 * len(rows)
    assert sum(found[i] == lang for i, _, lang in rows if int(lang[1:]) >= 64) >= 15
    assert (net.least > 1 / 70).all() and langid.keep_identified(docs, net, net.least).count() == len(rows)


def test_close_languages_are_kept_by_the_pipeline(spark):
    """Five languages that share all their words get a fifth of the chance each."""
    words = ["lorem", "ipsum", "dolor", "amet"]
    rows = [(i, " ".join(words[(i + k) % 4] for k in range(20)), f"l{i % 5}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert corpus_pipeline.identify_language(spark, docs, "").count() == 100


def test_long_runs_are_cut_between_characters():
    text = ("a" * 50 + " " + "\u4e2d\u6587" * 40 + " kurz " + "\u00e9" * 13 + "\U00020000" * 9).encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends = langid.segments(data, np.array([0, len(data)]))
    assert (ends - starts).max() <= langid.LONGEST and (ends > starts).all()
    parts = [text[i:j].decode() for i, j in zip(starts, ends, strict=True)]
    assert "".join(parts) == text.decode().replace(" ", "")


def test_cuts_come_from_all_labelled_rows(spark, documents, monkeypatch):
    """The cut follows the lowest score of all rows, not of those the network is fitted on."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 20)
    monkeypatch.setattr(langid, "SAMPLE_WORDS", 10)
    docs = documents.select("doc_id", "text", "lang").where("lang IS NOT NULL")
    net = langid.fit(docs, steps=100)
    lowest = dict.fromkeys(net.languages, 1.0)
    for r in langid.identify(docs, net).where("lang_pred <> 'und'").collect():
        lowest[r.lang_pred] = min(lowest[r.lang_pred], r.score)
    chance = 1 / len(net.languages)
    assert np.allclose(net.least, [chance + (lowest[x] - chance) / 10 - 1e-6 for x in net.languages], atol=1e-9)
    assert not langid.fit(docs, steps=1, cuts=False).least.any()
