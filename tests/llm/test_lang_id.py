import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers
from conftest import SF_ORACLE
from respawn.llm import lang_id as op


@pytest.fixture(scope="module")
def model(spark):
    return op.fit(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = op.language_id(docs).where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    spoiled = docs.withColumn("lang", F.when(op.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    pick = lambda d: sorted((r.doc_id, r.lang_pred, r.score) for r in op.language_id(d).collect())
    assert pick(docs) == pick(spoiled)


def best_path(scores, switch):
    """All paths of a short text."""
    import itertools
    n, k = scores.shape
    value = lambda p: sum(scores[i, p[i]] for i in range(n)) - switch * sum(a != b for a, b in zip(p, p[1:]))
    return max(value(p) for p in itertools.product(range(k), repeat=n)), value


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 6, 1, 5])
    scores = rng.normal(size=(int(sizes.sum()), 3)) * 3
    labels = op.viterbi(scores, sizes, 2.0)
    for lo, hi in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        best, value = best_path(scores[lo:hi], 2.0)
        assert abs(value(labels[lo:hi].tolist()) - best) < 1e-9


def test_mixed_text_gets_spans(spark, model):
    by = {r.lang: r.text for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where("length(text) between 400 and 900").collect()}
    text = by["en"] + "\n" + by["de"]
    lang, share, spans = op.label(model, [text])[0]
    assert {s[0] for s in spans} == {"en", "de"} and lang in ("en", "de") and 0.4 < share < 0.7
    assert spans[0][1] == 0 and spans[-1][2] == len(text) and all(a[2] == b[1] for a, b in zip(spans, spans[1:]))
    border = next(s for s in spans if s[0] == "de")[1]
    assert abs(border - len(by["en"])) < 60


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, t, la, "s", 1) for i, (t, la) in enumerate(
        [("привет мир это текст", "ru"), ("hello world this is text", "en"), ("γεια σου κόσμε", "el")] * 10)]
    model = op.fit(helpers.docs(spark, rows))
    got = [x[0] for x in op.label(model, ["совсем другие слова", "entirely other words", "άλλες λέξεις", "你好 世界", "123 !!", ""])]
    assert got[:3] == ["ru", "en", "el"] and got[3] in model.langs and got[4:] == [op.UNKNOWN] * 2


def test_number_signs_are_no_letters(spark, model):
    assert [x[0] for x in op.label(model, ["½ ² ③", "Ⅷ ①", "१२३", "²"])] == [op.UNKNOWN] * 4
    assert op.words_of("a²b x½ Ⅷth 7up ªº") == ["a", "b", "x", "th", "up", "ªº"]


def test_labels_without_words_and_copies(spark):
    rows = [(1, "", "xx", "s", 0), (2, "12 34", "yy", "s", 5)] + [(i, "the same english text again", "en", "s", 1) for i in range(10, 3000)]
    rows += [(i, f"ein deutscher satz nummer {chr(97 + i % 26)}", "de", "s", 1) for i in range(3000, 3040)]
    model = op.fit(helpers.docs(spark, rows), sample=50)
    assert model.langs == ["de", "en"] and [x[0] for x in op.label(model, ["the english text", "ein satz"])] == ["en", "de"]
    assert op.fit(helpers.docs(spark, rows[:2])).langs == []


def test_odd_rows(spark):
    odd = helpers.clashing(helpers.odd(spark))
    out = op.language_id(odd)
    rows = out.collect()
    assert len(rows) == len(helpers.ODD) and len(out.columns) == len(set(out.columns))
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == op.UNKNOWN) == (not letters) and (letters or (r.score == 0 and r.lang_spans == []))
    assert op.language_id(helpers.empty(spark)).count() == 0
    unlabelled = helpers.docs(spark, [(1, "some words", None, None, None)])
    assert op.language_id(unlabelled).first().lang_pred == op.UNKNOWN
