import hashlib

import numpy as np

import helpers
from conftest import SF_SMALL
from respawn.llm import simhash as op


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


def check(spark, df, rows):
    rows = order(rows)
    texts = [t or "" for _, t in rows]
    fps = op.simhash(texts)
    want = []
    for k, (i, _) in enumerate(rows):
        t, nxt = texts[k], texts[(k + 1) % len(rows)]
        e = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        fe = op.simhash([e])[0]
        near = sum(int(np.bitwise_count(f ^ fps[k])) <= 3 for f in fps) - 1 if i is not None and i % 100 == 0 else None
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{int(fps[k]):016x}", f"{int(fe):016x}",
                     1 - int(np.bitwise_count(fps[k] ^ fe)) / 64, 1 - int(np.bitwise_count(fps[k] ^ fps[(k + 1) % len(rows)])) / 64, near))
    assert sorted(map(tuple, op.document_fingerprints(df).collect()), key=str) == sorted(want, key=str)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(spark, docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    check(spark, helpers.clashing(helpers.odd(spark)), [r[:2] for r in helpers.ODD])
    check(spark, helpers.docs(spark, [(100, "only one", None, None, None)]), [(100, "only one")])
    nulls = [(None, "a b", None, None, None), (None, "c d", None, None, None)]
    check(spark, helpers.docs(spark, nulls), [r[:2] for r in nulls])
    big = [(1 << 62, "a b c d e f", None, None, None), ((1 << 62) + 1, "g h i", None, None, None), (None, None, None, None, None)]
    check(spark, helpers.docs(spark, big), [r[:2] for r in big])
    assert op.document_fingerprints(helpers.empty(spark)).count() == 0


def test_block_tables_miss_nothing():
    rng = np.random.default_rng(1)
    for radius, match in ((3, 2), (3, 1), (5, 3), (0, 1)):
        masks = op.block_masks(radius, match)
        for _ in range(200):
            far = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert any(far & m == 0 for m in masks)


def test_equal_texts_and_distance():
    a, b, c = op.simhash(["the cat sat on the mat " * 9, "the cat sat on the mat " * 9, "nothing of the sort was ever said by anyone"])
    assert a == b != c
