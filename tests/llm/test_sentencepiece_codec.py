import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

import helpers
from conftest import SF_SMALL
from respawn.llm import sentencepiece_codec as op


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=op.MODEL)


def test_same_ids_as_the_library(spark, model):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = op.encode_and_check(docs).collect()
    assert [r.ids for r in rows] == model.encode([r.text for r in rows]) and all(r.round_trip for r in rows)


def test_random_texts(model):
    rng, own = random.Random(4), op.vocabulary(op.MODEL)
    parts = ["a", "the", "ing", " ", "   ", " " * 17, " " * 45, "\n", "\t", "é", "ß", "日本", "\U0001F600", "==", "aaaa", "er", "1", "\r\n", "\x00", "qu",
             "...", '"', "ﬁ", "кий", "▁"] + [model.id_to_piece(i) for i in range(300, 32000, 997)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    ids = [x.tolist() for x in own.encode(texts)]
    assert ids == model.encode(texts)
    assert [own.decode(x) for x in ids] == [t.replace("▁", " ") for t in texts]


def test_suffix_array_finds_every_occurrence(model):
    own = op.vocabulary(op.MODEL)
    text = " the theory of nothing in particular"
    start, end, piece = own.edges(own.codes[[ord(c) for c in text]])
    pieces = {own.raw[i].decode(): i for i in own.pieces.tolist()}
    want = {(a, b, pieces[text[a:b]]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in pieces}
    assert set(zip(start.tolist(), end.tolist(), piece.tolist())) == want


def test_odd_rows(spark, model):
    odd = helpers.clashing(helpers.odd(spark))
    out = op.encode_and_check(odd)
    rows = out.collect()
    assert len(rows) == len(helpers.ODD) and len(out.columns) == len(set(out.columns))
    for r in rows:
        assert (r.ids is None) == (r.text is None)
        assert r.text is None or (r.ids == model.encode(r.text) and r.round_trip and r.n_ids == len(r.ids))
    both = op.decode(op.encode(helpers.odd(spark)))
    assert both.where(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0
    assert op.encode_and_check(helpers.empty(spark)).count() == 0


def test_broken_ids_decode():
    own = op.vocabulary(op.MODEL)
    assert own.decode([own.bytes[0xFF], 1, 2]) == "�" and own.decode([]) == ""
